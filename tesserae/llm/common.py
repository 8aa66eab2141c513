"""What the operators of this subpackage share: tables, scratch tables in the shared folder, prefix sums."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import functools
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: A word is a run of other characters than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table `name` of the data directory."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


_LOCAL: dict[str, str] = {}


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder of spark.checkpoint.dir; a temporary one only where that is unset (local mode)."""
    given = spark.conf.get("spark.checkpoint.dir", None)
    if given:
        return given.rstrip("/")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL:
        _LOCAL[app] = "file://" + tempfile.mkdtemp(prefix="tesserae-")
    return _LOCAL[app]


@contextlib.contextmanager
def spent_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files go as soon as the query that wrote them has ended: a table was written, and no later plan reads them."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


class Scratch:
    """Tables written to the shared folder: they cut lineage and survive the loss of an executor."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.at = spark, f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"
        atexit.register(_drop_at_exit, self)

    def save(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.at}/{name}"
        with spent_shuffles(self.spark):
            df.write.mode("overwrite").option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def _folder(self, name: str = ""):
        """The Hadoop file system and path of a table, or of all."""
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.at}/{name}".rstrip("/"))
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), path

    def drop(self, name: str = "") -> None:
        """Deletes a table that no later plan reads; without a name, all."""
        store, path = self._folder(name)
        store.delete(path, True)

    def keep(self, *names: str) -> None:
        """Deletes all tables but these, which the result reads; they go when the application ends."""
        store, path = self._folder()
        for own in store.listStatus(path):
            if own.getPath().getName() not in names:
                store.delete(own.getPath(), True)


def _drop_at_exit(scratch: Scratch) -> None:
    with contextlib.suppress(Exception):  # the application's own end may come first
        scratch.drop()


def _trim() -> None:
    """Gives memory that is free back to the system: Python workers live on after a task, and other tasks' workers need it."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other C libraries have no such function
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def tidied(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """run, a function for mapInArrow, after which the worker's free memory goes back to the system."""

    @functools.wraps(run)
    def tidy(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            _trim()

    return tidy


#: Rows of a few numbers each that are sent to every executor at most (some 50 bytes a row there); beyond, joins shuffle.
BROADCAST = 400_000


def small(df: DataFrame) -> DataFrame:
    """df, sent to every executor if it is counted to be small; the same rows come of a join either way."""
    return F.broadcast(df) if df.count() <= BROADCAST else df


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def n_words(text: Column) -> Column:
    """Number of words of a text (null: 0), counted as gaps so that no array of words is built."""
    trimmed = F.regexp_replace(F.coalesce(text, F.lit("")), rf"^{GAP}|{GAP}$", "")
    return F.when(trimmed == "", F.lit(0)).otherwise(F.regexp_count(trimmed, F.lit(GAP)) + 1).cast("long")


def unit_hash(*parts: Column, seed: str) -> Column:
    """A number from 0 to 2**52 - 1 from the md5 of the seed and the parts: the same in any engine, and evenly spread."""
    text = F.concat_ws("|", F.lit(seed), *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long")


#: Range of unit_hash.
UNIT = 1 << 52
#: Rows of a bucket within which one task sorts and sums.
BUCKET_ROWS = 65536
LEAST_BUCKETS = 16


def running_total(df: DataFrame, groups: list[str], rank: str, ties: list[str], size: str, out: str, per_group: DataFrame | None = None) -> DataFrame:
    """Adds `out`: the sum of `size` over the rows of the same group that come before by (rank, ties).

    rank is a unit_hash. Its range is cut into as many equal buckets as hold BUCKET_ROWS rows each, so that no
    task sorts a whole group however large; the buckets' own totals (a small table) give each its start.
    per_group, one row a group, adds its other columns by way of that small table. Null groups form a group of their own.
    """
    buckets = LEAST_BUCKETS + -(-df.count() // BUCKET_ROWS)
    bucket = F.floor(F.col(rank) * F.lit(buckets) / F.lit(float(UNIT))).cast("int")
    keys = [f"_g{i}" for i in range(len(groups))]

    def keyed(rows: DataFrame) -> DataFrame:
        return rows.withColumns({k: F.coalesce(F.concat(F.lit("="), F.col(g).cast("string")), F.lit("")) for k, g in zip(keys, groups)})

    rows = keyed(df).withColumn("_bucket", bucket)
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy(*keys, "_bucket").agg(F.sum(size).alias("_total")).select(*keys, "_bucket", F.coalesce(F.sum("_total").over(before), F.lit(0)).cast("long").alias("_start"))
    if per_group is not None:
        starts = starts.join(keyed(per_group).drop(*groups), keys)
    within = Window.partitionBy(*keys, "_bucket").orderBy(rank, *ties).rowsBetween(Window.unboundedPreceding, -1)
    summed = rows.withColumn("_within", F.coalesce(F.sum(size).over(within), F.lit(0)).cast("long"))
    joined = summed.join(starts, [*keys, "_bucket"])
    return joined.withColumn(out, F.col("_start") + F.col("_within")).drop("_start", "_within", "_bucket", *keys)


class Shield:
    """Gives the columns that an operator does not read names of their own, so that none clashes with its own columns."""

    def __init__(self, df: DataFrame, needed: list[str]):
        self.names = df.columns
        self.inner = {n: n if n in needed else f"__c{i}" for i, n in enumerate(self.names)}
        self.df = df.toDF(*self.inner.values())

    def back(self, df: DataFrame) -> DataFrame:
        """The original columns alone, under their names."""
        return df.select(*[F.col(k).alias(n) for n, k in self.inner.items()])
