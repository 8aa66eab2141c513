"""Ground truth: parsing, expansion, checks, and the split of reference entities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def id_list(column: str) -> Column:
    """Distinct, trimmed, non-blank ids of a comma list, sorted."""
    parts = F.transform(F.split(F.coalesce(F.col(column), F.lit("")), ","), lambda x: F.trim(x))
    return F.sort_array(F.array_distinct(F.filter(parts, lambda x: x != "")))


def parse(truth: DataFrame) -> DataFrame:
    """source1_entity_id, matched (array). Duplicate rows of an id: the one with the largest list text counts."""
    last = truth.groupBy("source1_entity_id").agg(F.max("matched_entity_ids").alias("matched_entity_ids"))
    return last.select("source1_entity_id", id_list("matched_entity_ids").alias("matched"))


def expand(parsed: DataFrame) -> DataFrame:
    """source1_entity_id, candidate_entity_id of every true pair; singletons drop out."""
    return parsed.select("source1_entity_id", F.explode("matched").alias("candidate_entity_id"))


def invalid_ids(parsed: DataFrame, targets: DataFrame) -> DataFrame:
    """source1_entity_id, matched_id, reason: ids of the reference source itself, and ids that no target has."""
    pairs = expand(parsed).withColumnRenamed("candidate_entity_id", "matched_id")
    itself = pairs.where(F.col("matched_id").startswith("S1-")).withColumn("reason", F.lit("self"))
    unknown = pairs.join(targets.select(F.col("entity_id").alias("matched_id")).distinct(), "matched_id", "left_anti")
    unknown = unknown.where(~F.col("matched_id").startswith("S1-")).withColumn("reason", F.lit("unknown"))
    return itself.unionByName(unknown)


def by_source(parsed: DataFrame, source: str) -> DataFrame:
    """Entities with matches of the source, and those alone."""
    own = F.filter("matched", lambda x: x.startswith(f"{source}-"))
    return parsed.select("source1_entity_id", own.alias("matched")).where(F.size("matched") > 0)


def summary(parsed: DataFrame) -> DataFrame:
    some = F.size("matched") > 0
    return parsed.agg(F.count("*").alias("entities"), F.count_if(some).alias("with_matches"), F.count_if(~some).alias("singletons"), F.coalesce(F.sum(F.size("matched")), F.lit(0)).alias("matched_ids"))


def for_ids(parsed: DataFrame, ids: DataFrame) -> DataFrame:
    """Every given id with its matches, empty where the truth has none."""
    return ids.select("source1_entity_id").join(parsed, "source1_entity_id", "left").select("source1_entity_id", F.coalesce("matched", F.array().cast("array<string>")).alias("matched"))


def hash_order(seed: int, *columns: str) -> Column:
    """A reproducible random order that any engine can repeat."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *columns))


def _cut(keyed: DataFrame, n: int) -> tuple[str | None, int]:
    """The prefix (four hexadecimal digits of _h, an md5) that holds the n-th row of the order, and how many rows come before it."""
    counts = keyed.groupBy(F.substring("_h", 1, 4).alias("_p")).agg(F.count("*").alias("c")).orderBy("_p").collect()
    before = 0
    for row in counts:
        if before + row["c"] > n:
            return row["_p"], before
        before += row["c"]
    return None, before


def smallest(keyed: DataFrame, n: int, *ties: str) -> DataFrame:
    """keyed with _first: whether a row is among the n smallest in the order of _h (an md5), then `ties`.

    Hashes are even, so one prefix of four hexadecimal digits holds the cut. The counts of prefixes (at most 65,536) tell
    which; only the rows of that prefix are ranked, no window or top-n holds all rows.
    """
    cut, before = _cut(keyed, n)
    if cut is None:
        return keyed.withColumn("_first", F.lit(True))
    prefix = F.substring("_h", 1, 4)
    ranked = keyed.where(prefix == cut).withColumn("_r", F.row_number().over(Window.orderBy("_h", *ties)))
    ranked = ranked.withColumn("_first", F.col("_r") <= n - before).drop("_r")
    return keyed.where(prefix != cut).withColumn("_first", prefix < cut).unionByName(ranked)


#: Rows that a task may hold to find the first ones.
HELD = 10_000


def first_rows(keyed: DataFrame, n: int, *ties: str) -> DataFrame:
    """The n smallest rows of that order alone.

    Few are kept by each task, and keyed is read once; for many, it is read once for counts, once more for the rows up to the cut.
    """
    if n <= HELD:
        return keyed.orderBy("_h", *ties).limit(n)
    cut, before = _cut(keyed, n)
    if cut is None:
        return keyed
    prefix = F.substring("_h", 1, 4)
    # rows before the cut's prefix share no window: each is a group of its own
    group = F.when(prefix < cut, F.col("_h")).otherwise(F.lit(""))
    ranked = keyed.where(prefix <= cut).withColumn("_r", F.row_number().over(Window.partitionBy(group).orderBy("_h", *ties)))
    return ranked.where((prefix < cut) | (F.col("_r") <= n - before)).drop("_r")


def split(ids: DataFrame, ratio: float = 0.2, seed: int = 42) -> DataFrame:
    """source1_entity_id, part (train or validation): max(1, int(n * ratio)) ids validate, those with the smallest hashes."""
    if not 0 < ratio < 1:
        raise ValueError("ratio must lie between 0 and 1")
    keyed = ids.select("source1_entity_id").withColumn("_h", hash_order(seed, "source1_entity_id"))
    want = max(1, int(keyed.count() * ratio))
    return smallest(keyed, want, "source1_entity_id").select("source1_entity_id", F.when(F.col("_first"), "validation").otherwise("train").alias("part"))


def split_pack(split_ids: DataFrame, source1: DataFrame, parsed: DataFrame, part: str) -> dict[str, DataFrame]:
    """Ids, records and truth of one part."""
    ids = split_ids.where(F.col("part") == part).select("source1_entity_id")
    records = source1.join(ids, source1["entity_id"] == ids["source1_entity_id"], "left_semi")
    return {"ids": ids, "records": records, "truth": for_ids(parsed, ids)}
