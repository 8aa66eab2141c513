"""Entity-level evaluation and the quality of candidates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BETA = 0.5


def precision(tp: Column, predicted: Column) -> Column:
    """1 where nothing is predicted (tp is 0 where nothing is true)."""
    return F.when(predicted == 0, 1.0).otherwise(tp / F.greatest(predicted, F.lit(1)))


def recall(tp: Column, actual: Column, predicted: Column) -> Column:
    return F.when(actual == 0, 1.0).otherwise(tp / F.greatest(actual, F.lit(1)))


def f_beta(tp: Column, actual: Column, predicted: Column, beta: float = BETA) -> Column:
    """Without truth 1 or 0, as nothing or something is predicted; else the weighted harmonic mean, 0 without hits."""
    p, r, b = precision(tp, predicted), recall(tp, actual, predicted), beta * beta
    mean = F.when(b * p + r > 0, (1 + b) * p * r / F.when(b * p + r > 0, b * p + r).otherwise(F.lit(1.0))).otherwise(0.0)
    return F.when(actual == 0, F.when(predicted == 0, 1.0).otherwise(0.0)).otherwise(mean)


def with_scores(counts: DataFrame) -> DataFrame:
    """From tp, n_actual, n_predicted: the per-entity scores."""
    tp, a, p = F.col("tp"), F.col("n_actual"), F.col("n_predicted")
    return counts.withColumns({
        "fp": p - tp, "fn": a - tp, "precision": precision(tp, p), "recall": recall(tp, a, p), "f05": f_beta(tp, a, p),
        "is_singleton": (a == 0).cast("int"), "singleton_correct": ((a == 0) & (p == 0)).cast("int"),
    })


def per_entity(ids: DataFrame, truth: DataFrame, predicted: DataFrame) -> DataFrame:
    """One row a reference id of `ids`; truth (matched) and predicted pairs (source1_entity_id, candidate_entity_id)."""
    actual = truth.select("source1_entity_id", F.explode("matched").alias("candidate_entity_id")).withColumn("_a", F.lit(1))
    own = predicted.select("source1_entity_id", "candidate_entity_id").distinct().withColumn("_p", F.lit(1))
    both = actual.join(own, ["source1_entity_id", "candidate_entity_id"], "full").groupBy("source1_entity_id")
    counts = both.agg(F.count("_a").alias("n_actual"), F.count("_p").alias("n_predicted"), F.count_if(F.col("_a").isNotNull() & F.col("_p").isNotNull()).alias("tp"))
    every = ids.select("source1_entity_id").join(counts, "source1_entity_id", "left").na.fill(0, ["n_actual", "n_predicted", "tp"])
    return with_scores(every)


def per_entity_labelled(ids: DataFrame, truth: DataFrame, predicted: DataFrame) -> DataFrame:
    """The same for pairs that carry is_match of that truth: they are counted before anything is shuffled.

    A pair may come more than once where `_many` says that an id has several records: only such are told apart.
    """
    several = predicted.groupBy("source1_entity_id", F.when(F.col("_many"), F.col("candidate_entity_id")).alias("_c")).agg(F.count("*").alias("n"), F.sum("is_match").alias("tp"))
    once = lambda c: F.sum(F.when(F.col("_c").isNull(), F.col(c)).otherwise(F.least(F.col(c), F.lit(1))))
    own = several.groupBy("source1_entity_id").agg(once("n").alias("n_predicted"), once("tp").alias("tp"))
    actual = truth.select("source1_entity_id", F.size("matched").alias("n_actual"))
    every = ids.select("source1_entity_id").join(actual, "source1_entity_id", "left").join(own, "source1_entity_id", "left")
    return with_scores(every.na.fill(0, ["n_actual", "n_predicted", "tp"]).select("source1_entity_id", "n_actual", "n_predicted", "tp"))


def macro(entities: DataFrame) -> DataFrame:
    """macro_f05, macro_precision, macro_recall over all rows; 0 without rows."""
    mean = lambda c: F.coalesce(F.avg(c), F.lit(0.0))
    return entities.agg(F.count("*").alias("entities"), mean("f05").alias("macro_f05"), mean("precision").alias("macro_precision"), mean("recall").alias("macro_recall"))


def singletons(entities: DataFrame) -> DataFrame:
    n, good = F.sum("is_singleton"), F.sum("singleton_correct")
    found = entities.agg(F.coalesce(n, F.lit(0)).alias("n_singletons"), F.coalesce(good, F.lit(0)).alias("n_correct"))
    return found.withColumn("accuracy", F.when(F.col("n_singletons") > 0, F.col("n_correct") / F.col("n_singletons")).otherwise(1.0))


def candidate_recall(candidates: DataFrame, true_pairs: DataFrame) -> DataFrame:
    """overall, s2, s3, found, total; 1 where there is nothing to find."""
    held = candidates.select("source1_entity_id", "candidate_entity_id").distinct().withColumn("_h", F.lit(1))
    joined = true_pairs.join(held, ["source1_entity_id", "candidate_entity_id"], "left")
    second = F.col("candidate_entity_id").startswith("S2-")
    share = lambda hit, all_: F.when(all_ > 0, hit / F.greatest(all_, F.lit(1))).otherwise(1.0)
    sums = joined.agg(
        F.count("_h").alias("found"), F.count("*").alias("total"),
        F.count_if(second & F.col("_h").isNotNull()).alias("_f2"), F.count_if(second).alias("_t2"),
        F.count_if(~second & F.col("_h").isNotNull()).alias("_f3"), F.count_if(~second).alias("_t3"),
    )
    return sums.select(share(F.col("found"), F.col("total")).alias("overall"), share(F.col("_f2"), F.col("_t2")).alias("s2"), share(F.col("_f3"), F.col("_t3")).alias("s3"), "found", "total")


def candidate_stats(candidates: DataFrame) -> DataFrame:
    """mean, median, p95, max and min of the number of candidates of an entity that has some, and totals."""
    n = candidates.groupBy("source1_entity_id").agg(F.count("*").alias("c"))
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    return n.agg(
        zero(F.avg("c")).alias("mean"), zero(F.median("c")).alias("median"), zero(F.percentile("c", 0.95)).alias("p95"),
        F.coalesce(F.max("c"), F.lit(0)).alias("max"), F.coalesce(F.min("c"), F.lit(0)).alias("min"),
        F.coalesce(F.sum("c"), F.lit(0)).alias("total_pairs"), F.count("*").alias("unique_s1"),
    )


def reduction_ratio(candidates: DataFrame, s1: DataFrame, s2: DataFrame, s3: DataFrame) -> DataFrame:
    """1 - candidates / all pairs; 0 without pairs. Four counts meet in one row."""
    count = lambda df, name: df.agg(F.count("*").alias(name))
    one = count(candidates, "candidates")
    for df, name in ((s1, "n1"), (s2, "n2"), (s3, "n3")):
        one = one.join(F.broadcast(count(df, name)))
    space = F.col("n1") * (F.col("n2") + F.col("n3"))
    return one.select("candidates", space.alias("full_space"), F.when(space > 0, 1 - F.col("candidates") / F.greatest(space, F.lit(1))).otherwise(0.0).alias("reduction_ratio"))


def blocking_report(candidates: DataFrame, true_pairs: DataFrame, s1: DataFrame, s2: DataFrame, s3: DataFrame, found: DataFrame | None = None) -> DataFrame:
    """Recall, reduction and volume in one row; `found` may give the candidates that are true pairs."""
    r = candidate_recall(candidates if found is None else found, true_pairs).select(F.col("overall").alias("recall_overall"), F.col("s2").alias("recall_s2"), F.col("s3").alias("recall_s3"))
    c = candidate_stats(candidates).select(F.col("mean").alias("mean_candidates"), F.col("p95").alias("p95_candidates"))
    return r.join(F.broadcast(c)).join(F.broadcast(reduction_ratio(candidates, s1, s2, s3).select("reduction_ratio")))


def recall_by(candidates: DataFrame, truth: DataFrame, records: DataFrame, true_pairs: DataFrame | None = None) -> DataFrame:
    """Candidate recall by country and number of true matches (0, 1, 2 or more), over the truth's pairs or the list given."""
    held = candidates.select("source1_entity_id", "candidate_entity_id").distinct().withColumn("_h", F.lit(1))
    bucket = F.when(F.size("matched") == 1, "1").otherwise("2+")
    some = truth.where(F.size("matched") > 0)
    if true_pairs is None:
        pairs = some.select("source1_entity_id", bucket.alias("bucket"), F.explode("matched").alias("candidate_entity_id"))
    else:
        pairs = some.select("source1_entity_id", bucket.alias("bucket")).join(true_pairs, "source1_entity_id")
    country = records.select(F.col("entity_id").alias("source1_entity_id"), "country_norm")
    joined = pairs.join(held, ["source1_entity_id", "candidate_entity_id"], "left").join(country, "source1_entity_id", "left")
    return joined.groupBy("country_norm", "bucket").agg(F.count("*").alias("total"), F.count("_h").alias("found")).withColumn("recall", F.col("found") / F.col("total"))
