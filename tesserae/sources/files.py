"""Readers and writers: tab-separated sources, Parquet stage tables, label-first CSV, JSON artefacts, archives.

Every path is one of a Hadoop file system, so tables and artefacts lie side by side wherever the cluster keeps its data.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


SOURCE = ("entity_id", "business_name", "business_address", "country")
TRUTH = ("source1_entity_id", "matched_entity_ids")
MATCHING = ("source1_entity_id", "matched_entity_ids")
CANDIDATES = ("source1_entity_id", "candidate_entity_ids")


def file_system(spark: SparkSession, path: str) -> tuple:
    """The path's file system and the path, as objects of the JVM. Local files are written without checksum files."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return (fs.getRaw() if fs.getUri().getScheme() == "file" else fs), at


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = file_system(spark, path)
    return fs.exists(at)


def fingerprint(spark: SparkSession, path: str) -> str:
    """Path, size and time of change of a file or of the files of a folder."""
    fs, at = file_system(spark, path)
    return ";".join(sorted(f"{f.getPath()}|{f.getLen()}|{f.getModificationTime()}" for f in fs.listStatus(at)))


def find_data(spark: SparkSession, places: list[str]) -> str:
    """The first place that holds the first training source, in a folder `train` or beside the others."""
    for place in places:
        if any(exists(spark, f"{place}/{p}train_source1.tsv") for p in ("train/", "")):
            return place
    raise FileNotFoundError(f"no train_source1.tsv in any of {places}")


def require_columns(df: DataFrame, required: tuple[str, ...], what: str = "table") -> DataFrame:
    """df, or an error that names the missing columns; more columns are allowed."""
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"{what} lacks columns {missing}; it has {df.columns}")
    return df


def layout(spark: SparkSession, path: str) -> tuple[str, bool]:
    """Encoding, and whether a quoted field may hold a line break (a line with an odd number of quotes): one pass, in splits."""
    quotes = F.octet_length("value") - F.octet_length(F.replace("value", F.lit('"'), F.lit("")))
    found = spark.read.text(path).agg(F.max(~F.is_valid_utf8("value")).alias("latin"), F.max(quotes % 2 == 1).alias("broken")).first()
    return ("ISO-8859-1" if found["latin"] else "UTF-8"), bool(found["broken"])


def read_tsv(spark: SparkSession, path: str, required: tuple[str, ...] = (), rows: int | None = None) -> DataFrame:
    """Every column as string, names stripped, empty fields as '' and never null. `NA` stays text. Latin-1 where the bytes are no
    UTF-8. A file is read in splits unless a quoted field may hold a line break."""
    encoding, broken = layout(spark, path)
    raw = spark.read.option("sep", "\t").option("header", True).option("quote", '"').option("escape", '"').option("multiLine", broken)
    df = raw.option("encoding", encoding).option("inferSchema", False).csv(path)
    df = df.toDF(*[c.strip() for c in df.columns])
    df = df.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c) for c in df.columns])
    if required:
        require_columns(df, required, path)
    return df if rows is None else df.limit(rows)


def read_source(spark: SparkSession, path: str, rows: int | None = None) -> DataFrame:
    return read_tsv(spark, path, SOURCE, rows)


def write_tsv(df: DataFrame, path: str) -> str:
    """One file with a header, fields as they are (tabs and line breaks in fields are not allowed).

    All partitions write at once; their files are then copied behind the header in order, as bytes through a small buffer.
    """
    spark, parts = df.sparkSession, f"{path}.parts"
    plain = df.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c) for c in df.columns])
    plain.write.mode("overwrite").csv(parts, sep="\t", header=False, emptyValue="", quote="\u0000", escapeQuotes=False)
    fs, folder = file_system(spark, parts)
    _, target = file_system(spark, path)
    _, growing = file_system(spark, f"{path}.growing")
    out = fs.create(growing, True)
    try:
        out.write(("\t".join(df.columns) + "\n").encode())
        for name, part in sorted((f.getPath().getName(), f.getPath()) for f in fs.listStatus(folder)):
            if name.startswith("part-"):
                _copy(spark, fs, part, out)
    finally:
        out.close()
    fs.delete(target, False)
    if not fs.rename(growing, target):
        raise OSError(f"could not move {growing} to {path}")
    fs.delete(folder, True)
    return path


def _copy(spark: SparkSession, fs, path, out) -> None:
    part = fs.open(path)
    try:
        spark.sparkContext._jvm.org.apache.hadoop.io.IOUtils.copyBytes(part, out, 1 << 20, False)
    finally:
        part.close()


def write_parquet(df: DataFrame, path: str, compression: str = "snappy") -> DataFrame:
    """Writes a stage table and reads it back: lineage ends here."""
    df.write.mode("overwrite").option("compression", compression).parquet(path)
    return df.sparkSession.read.parquet(path)


def append_parquet(df: DataFrame, path: str) -> None:
    """Adds rows to a table that grows by batches."""
    df.write.mode("append").parquet(path)


def write_label_first_csv(features: DataFrame, names: list[str], path: str, label: str = "is_match") -> None:
    """Label, then features with six decimals, no header."""
    require_columns(features, (label, *names))
    features.select(F.col(label).cast("int"), *[F.format_string("%.6f", F.col(n).cast("double")).alias(n) for n in names]).write.mode("overwrite").csv(path, header=False)


def write_json(path: str, value: dict) -> None:
    fs, at = file_system(SparkSession.active(), path)
    out = fs.create(at, True)
    try:
        out.write(json.dumps(value, indent=2, sort_keys=True).encode())
    finally:
        out.close()


def read_json(path: str) -> dict:
    return json.loads(SparkSession.active().read.text(path, wholetext=True).first()[0])


def save_threshold(path: str, threshold: float, **more) -> None:
    write_json(path, {"threshold": float(threshold), **more})


def load_threshold(path: str) -> float:
    return float(read_json(path)["threshold"])


def pack(folder: str, archive: str) -> str:
    """A zip of a folder's files (not of folders in it), copied as bytes through a small buffer."""
    spark = SparkSession.active()
    fs, at = file_system(spark, folder)
    target, place = file_system(spark, archive)
    zipped = spark.sparkContext._jvm.java.util.zip.ZipOutputStream(target.create(place, True))
    try:
        for name, file in sorted((f.getPath().getName(), f.getPath()) for f in fs.listStatus(at) if f.isFile()):
            if file.toUri().getPath() != place.toUri().getPath():
                zipped.putNextEntry(spark.sparkContext._jvm.java.util.zip.ZipEntry(name))
                _copy(spark, fs, file, zipped)
                zipped.closeEntry()
    finally:
        zipped.close()
    return archive
