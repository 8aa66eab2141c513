"""Decisions at a threshold, the sweep over all thresholds, and tables of errors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tesserae.operators.metrics import with_scores

FIRST, LAST = 10, 99  # hundredths


def predictions_at(scored: DataFrame, ids: DataFrame, threshold: float) -> DataFrame:
    """Every id with its predicted candidates (sorted), empty where none reaches the threshold."""
    hit = scored.where(F.col("probability") >= F.lit(threshold)).groupBy("source1_entity_id").agg(F.sort_array(F.collect_set("candidate_entity_id")).alias("predicted"))
    return ids.select("source1_entity_id").join(hit, "source1_entity_id", "left").select("source1_entity_id", F.coalesce("predicted", F.array().cast("array<string>")).alias("predicted"))


def decided(scored: DataFrame, threshold: float, own: dict[str, float | None] | None = None) -> DataFrame:
    """Pairs that reach the threshold, or the one of their source where `own` gives one."""
    cut = F.lit(float(threshold))
    for source, value in (own or {}).items():
        if value is not None:
            cut = F.when(F.col("candidate_source") == source, F.lit(float(value))).otherwise(cut)
    return scored.where(F.col("probability") >= cut)


def sweep(scored: DataFrame, truth: DataFrame, first: int = FIRST, last: int = LAST, source: str | None = None) -> DataFrame:
    """One row a threshold: macro scores and totals over all entities of the truth, against the whole truth.

    A pair counts up to the largest hundredth that its probability reaches. Counts of an entity change only at its own
    pairs' steps, so each entity gives one row an interval between steps (not one a threshold), spread to thresholds after scoring
    and summed: no pair is copied 90 times.
    """
    if source is not None:
        scored = scored.where(F.col("candidate_source") == source)
    true_pairs = truth.select("source1_entity_id", F.explode("matched").alias("candidate_entity_id")).withColumn("_t", F.lit(1))
    # floor can be one off at a boundary: try the neighbours
    near = F.floor(F.col("probability") * 100).cast("int")
    step = F.when(F.col("probability") >= (near + 1) / F.lit(100.0), near + 1).when(F.col("probability") >= near / F.lit(100.0), near).otherwise(near - 1)
    pairs = scored.groupBy("source1_entity_id", "candidate_entity_id").agg(F.max("probability").alias("probability"))
    steps = pairs.withColumn("_i", F.least(step, F.lit(last))).where(F.col("_i") >= first).join(true_pairs, ["source1_entity_id", "candidate_entity_id"], "left")
    at = steps.groupBy("source1_entity_id", "_i").agg(F.count("*").alias("_p"), F.count("_t").alias("_tp"))
    entities = truth.select("source1_entity_id", F.size("matched").alias("n_actual"))
    # a step of no pairs at the top makes the interval in which nothing is predicted
    grid = entities.select("source1_entity_id", F.lit(last + 1).alias("_i"), F.lit(0).cast("long").alias("_p"), F.lit(0).cast("long").alias("_tp")).unionByName(at.join(entities.select("source1_entity_id"), "source1_entity_id", "left_semi"))
    down = Window.partitionBy("source1_entity_id").orderBy(F.col("_i").desc())
    so_far = down.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    spans = grid.withColumns({"n_predicted": F.sum("_p").over(so_far), "tp": F.sum("_tp").over(so_far), "_next": F.coalesce(F.lead("_i").over(down), F.lit(first - 1))})
    scores = with_scores(spans.join(entities, "source1_entity_id")).where(F.least(F.col("_i"), F.lit(last)) > F.col("_next"))
    weights = scores.groupBy(F.least("_i", F.lit(last)).alias("_hi"), (F.col("_next") + 1).alias("_lo")).agg(
        F.count("*").alias("n"), *[F.sum(c).alias(c) for c in ("f05", "precision", "recall", "tp", "fp", "fn", "n_predicted", "is_singleton", "singleton_correct")]
    )  # at most (last - first + 1) squared rows
    every = weights.withColumn("_i", F.explode(F.sequence("_lo", "_hi"))).groupBy("_i").agg(F.sum("n").alias("n"), *[F.sum(c).alias(c) for c in ("f05", "precision", "recall", "tp", "fp", "fn", "n_predicted", "is_singleton", "singleton_correct")])
    return every.select(
        (F.col("_i") / F.lit(100.0)).alias("threshold"), (F.col("f05") / F.col("n")).alias("macro_f05"), (F.col("precision") / F.col("n")).alias("macro_precision"),
        (F.col("recall") / F.col("n")).alias("macro_recall"), "tp", "fp", "fn", F.col("n_predicted").alias("predicted"),
        F.when(F.col("is_singleton") > 0, F.col("singleton_correct") / F.greatest("is_singleton", F.lit(1))).otherwise(1.0).alias("singleton_accuracy"), F.col("n").alias("entities"),
    )


def best_threshold(swept: DataFrame) -> DataFrame:
    """The threshold with the largest macro score; the smallest of several."""
    score = F.round("macro_f05", 9)
    return swept.agg(F.max_by("threshold", F.struct(score, -F.col("threshold"))).alias("threshold"), F.max(score).alias("macro_f05"))


def report(swept: DataFrame, n: int = 10) -> DataFrame:
    return swept.orderBy(F.round("macro_f05", 9).desc(), "threshold").limit(n)


def errors(scored: DataFrame, truth: DataFrame, threshold: float, n: int = 50) -> dict[str, DataFrame]:
    """The n most probable false positives, missed candidates, and matches of entities that have none."""
    alone = truth.where(F.size("matched") == 0).select("source1_entity_id")
    true_pairs = truth.select("source1_entity_id", F.explode("matched").alias("candidate_entity_id")).withColumn("_t", F.lit(1))
    told = scored.join(true_pairs, ["source1_entity_id", "candidate_entity_id"], "left").withColumns({"predicted_match": (F.col("probability") >= F.lit(threshold)).cast("int"), "is_true_match": F.coalesce("_t", F.lit(0))}).drop("_t")
    return error_tables(told, told.join(alone, "source1_entity_id", "left_semi"), n)


def labelled_errors(scored: DataFrame, alone: DataFrame, threshold: float, n: int = 50) -> dict[str, DataFrame]:
    """The same for pairs that carry is_match of the whole truth, and those of them whose entities have no match."""
    tell = lambda df: df.withColumns({"predicted_match": (F.col("probability") >= F.lit(threshold)).cast("int"), "is_true_match": F.col("is_match")})
    return error_tables(tell(scored), tell(alone), n)


def error_tables(told: DataFrame, alone: DataFrame, n: int) -> dict[str, DataFrame]:
    top = lambda df: df.orderBy(F.col("probability").desc(), "source1_entity_id", "candidate_entity_id").limit(n)
    return {
        "high_conf_fp": top(told.where("predicted_match = 1 and is_true_match = 0")),
        "false_negatives": top(told.where("predicted_match = 0 and is_true_match = 1")),
        "singleton_fp": top(alone.where("predicted_match = 1")),
    }
