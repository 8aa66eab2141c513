"""Labelled pairs and samples. Random order is a hash of seed and ids: the same in any layout."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tesserae.operators.truth import first_rows, hash_order

KEY = ["source1_entity_id", "candidate_entity_id"]


def by_ids(df: DataFrame, ids: DataFrame, column: str = "source1_entity_id") -> DataFrame:
    return df.join(ids.select(F.col("source1_entity_id").alias(column)), column, "left_semi")


def label(candidates: DataFrame, true_pairs: DataFrame) -> DataFrame:
    """Candidates with is_match."""
    truth = true_pairs.select(*KEY).distinct().withColumn("_m", F.lit(1))
    return candidates.join(truth, KEY, "left").withColumn("is_match", F.coalesce("_m", F.lit(0))).drop("_m")


def label_by_list(pairs: DataFrame, matched: str) -> DataFrame:
    """Pairs that carry the true ids of their reference record, with is_match in the place of that list."""
    return pairs.withColumn("is_match", F.coalesce(F.array_contains(matched, F.col("candidate_entity_id")).cast("int"), F.lit(0))).drop(matched)


def positives(true_pairs: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    own = true_pairs if ids is None else by_ids(true_pairs, ids)
    source = F.when(F.col("candidate_entity_id").startswith("S2-"), "S2").otherwise("S3")
    return own.select(*KEY, source.alias("candidate_source"), F.lit(1).alias("is_match"))


def _draw(df: DataFrame, n: int, seed: int) -> DataFrame:
    return first_rows(df.withColumn("_h", hash_order(seed, *KEY)), n, *KEY).drop("_h")


def easy_negatives(labelled: DataFrame, n: int, seed: int = 42) -> DataFrame:
    return _draw(labelled.where("is_match = 0"), n, seed)


def hard_pool(labelled: DataFrame) -> DataFrame:
    """Negatives of reference entities that have a positive."""
    return labelled.where("is_match = 0").join(labelled.where("is_match = 1").select("source1_entity_id"), "source1_entity_id", "left_semi")


def hard_pool_multiplied(labelled: DataFrame) -> DataFrame:
    """The same by an inner join: a negative counts once for each positive of its entity."""
    some = labelled.where("is_match = 1").select("source1_entity_id")
    return labelled.where("is_match = 0").join(some, "source1_entity_id")


def hard_negatives(labelled: DataFrame, n: int, seed: int = 42, pool: DataFrame | None = None) -> DataFrame:
    """From the hard pool (made here unless given), or from all negatives where it is smaller than n."""
    pool = hard_pool(labelled) if pool is None else pool
    return _draw(pool if pool.limit(n).count() >= n else labelled.where("is_match = 0"), n, seed + 1)


def training(labelled: DataFrame, true_pairs: DataFrame, ids: DataFrame | None = None, ratio: int = 4, hard: float = 0.5, seed: int = 42) -> DataFrame:
    """All positives, ratio times as many negatives, `hard` of them hard; pairs once, positives first."""
    own = labelled if ids is None else by_ids(labelled, ids)
    good = positives(true_pairs, ids)
    n = good.count()
    if not n:
        return own
    n_hard = int(n * ratio * hard)
    bad = hard_negatives(own, n_hard, seed).unionByName(easy_negatives(own, n * ratio - n_hard, seed))
    every = good.unionByName(bad.select(good.columns))
    return every.groupBy(*KEY).agg(F.max_by("candidate_source", "is_match").alias("candidate_source"), F.max("is_match").alias("is_match")).select(good.columns)


def validation(candidates: DataFrame, true_pairs: DataFrame, ids: DataFrame) -> DataFrame:
    return label(by_ids(candidates, ids), true_pairs)


def capture_rate(labelled: DataFrame, true_pairs: DataFrame) -> DataFrame:
    """captured, positives, rate: how many true pairs the candidates hold."""
    held = labelled.where("is_match = 1").select(*KEY).distinct().withColumn("_h", F.lit(1))
    both = true_pairs.select(*KEY).distinct().join(held, KEY, "left").agg(F.count("_h").alias("captured"), F.count("*").alias("positives"))
    return both.withColumn("rate", F.when(F.col("positives") > 0, F.col("captured") / F.col("positives")).otherwise(1.0))


def entity_lookup(*sources: DataFrame) -> DataFrame:
    """One record an id, the first in the order of the sources given."""
    found = None
    for rank, df in enumerate(sources):
        one = df.withColumn("_rank", F.lit(rank))
        found = one if found is None else found.unionByName(one)
    fields = [c for c in found.columns if c not in ("entity_id", "_rank")]
    best = found.groupBy("entity_id").agg(F.min_by(F.struct(*fields), F.struct("_rank", *fields)).alias("r"))
    return best.select("entity_id", "r.*")


FIELDS = ("business_name_norm", "business_name_core", "business_address_norm", "country_norm")


def with_record(rows: DataFrame, records: DataFrame, n: int) -> DataFrame:
    """Rows with the four strings of their side's record (n: 1 or 2, the suffix); unknown ids get empty strings."""
    side = records.select(F.col("entity_id").alias(KEY[n - 1]), *[F.col(f).alias(f"{f}_{n}") for f in FIELDS])
    return rows.join(side, KEY[n - 1], "left").na.fill("", [f"{f}_{n}" for f in FIELDS])


def with_records(pairs: DataFrame, records: DataFrame) -> DataFrame:
    """Pairs with the four strings of both sides (suffix _1 and _2)."""
    return with_record(with_record(pairs, records, 1), records, 2)
