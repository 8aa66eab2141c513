"""Gates on the cleaning of a source."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MOST_EMPTIED, MOST_COLLAPSED = 2.0, 0.5


def cleaning_quality(raw: DataFrame, cleaned: DataFrame) -> DataFrame:
    """One row: counts, ids lost or added, share of names emptied (per cent), reduction of distinct names, and the verdicts."""
    left = raw.agg(F.count("*").alias("raw_rows"), F.count_if(F.trim(F.coalesce("business_name", F.lit(""))) == "").alias("_e0"), F.count_distinct("business_name").alias("raw_names"))
    right = cleaned.agg(F.count("*").alias("clean_rows"), F.count_if(F.trim("business_name_norm") == "").alias("_e1"), F.count_distinct("business_name_norm").alias("clean_names"))
    ids = lambda df: df.select("entity_id").distinct()
    lost = ids(raw).join(ids(cleaned), "entity_id", "left_anti").agg(F.count("*").alias("ids_lost"))
    added = ids(cleaned).join(ids(raw), "entity_id", "left_anti").agg(F.count("*").alias("ids_added"))
    one = left.join(F.broadcast(right)).join(F.broadcast(lost)).join(F.broadcast(added))
    emptied = F.when(F.col("clean_rows") > 0, (F.col("_e1") - F.col("_e0")) / F.greatest("clean_rows", F.lit(1)) * 100).otherwise(0.0)
    collapsed = F.when(F.col("raw_names") > 0, (F.col("raw_names") - F.col("clean_names")) / F.greatest("raw_names", F.lit(1))).otherwise(0.0)
    one = one.withColumns({"empty_diff_pct": emptied, "collision_ratio": collapsed})
    good = (F.col("raw_rows") == F.col("clean_rows")) & (F.col("ids_lost") == 0) & (F.col("ids_added") == 0) & (F.col("empty_diff_pct") <= MOST_EMPTIED)
    return one.drop("_e0", "_e1").withColumns({"passed": good.cast("int"), "collision_warning": (F.col("collision_ratio") > MOST_COLLAPSED).cast("int")})


def require_quality(raw: DataFrame, cleaned: DataFrame) -> dict:
    """The figures, or an error where a gate fails."""
    row = cleaning_quality(raw, cleaned).first().asDict()
    if not row["passed"]:
        raise ValueError(f"cleaning gates failed: {row}")
    return row


def top_collisions(cleaned: DataFrame, n: int = 5) -> DataFrame:
    return cleaned.groupBy("business_name_norm").agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), "business_name_norm").limit(n)


def samples(cleaned: DataFrame, n: int = 5, seed: int = 42) -> DataFrame:
    """Raw and cleaned names and addresses of n records in hash order."""
    key = F.md5(F.concat_ws("|", F.lit(str(seed)), "entity_id"))
    return cleaned.orderBy(key, "entity_id").limit(n).select("entity_id", "business_name", "business_name_norm", "business_name_core", "business_address", "business_address_norm")
