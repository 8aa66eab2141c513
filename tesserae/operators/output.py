"""Result tables and their rules."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def id_lists(pairs: DataFrame, ids: DataFrame, targets: DataFrame | None, out: str) -> DataFrame:
    """One row a reference id: known target ids, sorted, joined by commas; empty if none. Without targets, all are known."""
    own = pairs.select("source1_entity_id", "candidate_entity_id").where(~F.col("candidate_entity_id").startswith("S1-"))
    if targets is not None:
        own = own.join(targets.select(F.col("entity_id").alias("candidate_entity_id")).distinct(), "candidate_entity_id", "left_semi")
    lists = own.groupBy("source1_entity_id").agg(F.array_join(F.sort_array(F.collect_set("candidate_entity_id")), ",").alias(out))
    return ids.select("source1_entity_id").join(lists, "source1_entity_id", "left").select("source1_entity_id", F.coalesce(out, F.lit("")).alias(out))


def joined_lists(found: DataFrame, ids: DataFrame, out: str) -> DataFrame:
    """The same from rows that hold several known ids of a reference id each (source1_entity_id, _found)."""
    every = found.groupBy("source1_entity_id").agg(F.array_join(F.sort_array(F.array_distinct(F.flatten(F.collect_list("_found")))), ",").alias(out))
    return ids.select("source1_entity_id").join(every, "source1_entity_id", "left").select("source1_entity_id", F.coalesce(out, F.lit("")).alias(out))


def matching_results(pairs: DataFrame, ids: DataFrame, targets: DataFrame | None) -> DataFrame:
    return id_lists(pairs, ids, targets, "matched_entity_ids")


def candidate_pairs(pairs: DataFrame, ids: DataFrame, targets: DataFrame | None) -> DataFrame:
    return id_lists(pairs, ids, targets, "candidate_entity_ids")


def subset_violations(matched: DataFrame, candidates: DataFrame) -> DataFrame:
    """Pairs of the first table's lists that the second's lack."""
    wide = lambda df, c: df.where(F.col(c) != "").select("source1_entity_id", F.explode(F.split(c, ",")).alias("candidate_entity_id"))
    return wide(matched, "matched_entity_ids").join(wide(candidates, "candidate_entity_ids"), ["source1_entity_id", "candidate_entity_id"], "left_anti")
