"""The match classifier: gradient-boosted trees of Spark ML, and a fixed linear scorer for checks by SQL."""

from __future__ import annotations

import logging

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tesserae.operators.features import ID_COLUMNS, feature_names

log = logging.getLogger(__name__)

#: Weights of the fixed scorer over native features; they sum to 1.
LINEAR = {"name_exact": 0.15, "name_core_exact": 0.25, "name_jaccard": 0.15, "name_containment": 0.1, "numeric_token_overlap": 0.15, "has_exact_digit_match": 0.15, "country_match": 0.05}


def assemble(features: DataFrame, names: list[str] | None = None) -> DataFrame:
    """Adds the vector `features`, in the given order; id and label columns may not be among the names, missing ones are left out with a warning."""
    wanted = names or feature_names(features)
    if bad := set(wanted) & set(ID_COLUMNS):
        raise ValueError(f"no features: {sorted(bad)}")
    if lost := [n for n in wanted if n not in features.columns]:
        log.warning("features that the table lacks: %s", lost)
    return VectorAssembler(inputCols=[n for n in wanted if n in features.columns], outputCol="features").transform(features)


def train(features: DataFrame, rounds: int = 300, depth: int = 6, rate: float = 0.05, subsample: float = 0.8, seed: int = 42, validation: str | None = None) -> GBTClassificationModel:
    """Boosted trees on is_match; early stop on the rows that the column `validation` marks."""
    if "is_match" not in features.columns:
        raise ValueError("is_match is missing")
    options = {"validationIndicatorCol": validation, "validationTol": 0.001} if validation else {}
    names = [n for n in feature_names(features) if n != validation]
    learner = GBTClassifier(labelCol="is_match", featuresCol="features", maxIter=rounds, maxDepth=depth, stepSize=rate, subsamplingRate=subsample, featureSubsetStrategy=str(subsample), seed=seed, **options)
    return learner.fit(assemble(features, names))


def score(model: GBTClassificationModel, features: DataFrame, names: list[str] | None = None) -> DataFrame:
    """Id columns and probability."""
    scored = model.transform(assemble(features, names))
    return scored.select(*[c for c in ID_COLUMNS if c in features.columns], vector_to_array("probability")[1].alias("probability"))


def linear_score(features: DataFrame) -> DataFrame:
    total = sum((F.col(c).cast("double") * w for c, w in LINEAR.items()), F.lit(0.0))
    return features.select(*[c for c in ID_COLUMNS if c in features.columns], F.round(total, 6).alias("probability"))


def save(model: GBTClassificationModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> GBTClassificationModel:
    return GBTClassificationModel.load(path)


def area_under_pr(model: GBTClassificationModel, features: DataFrame, names: list[str] | None = None) -> float:
    return BinaryClassificationEvaluator(labelCol="is_match", metricName="areaUnderPR").evaluate(model.transform(assemble(features, names)))


def search(taught: DataFrame, held: DataFrame, space: dict[str, tuple], **start) -> tuple[dict, float]:
    """One parameter of `train` after the other: the value with the largest area under precision and recall on `held` stays.

    Returns the parameters and that area; of equal areas the earlier value counts, the starting one first.
    """
    names = feature_names(taught)
    tried: dict[tuple, float] = {}

    def area(options: dict) -> float:
        key = tuple(sorted(options.items()))
        if key not in tried:
            tried[key] = area_under_pr(train(taught, **options), held, names)
        return tried[key]

    best, most = dict(start), area(start)
    for name, values in space.items():
        for value in values:
            if (found := area({**best, name: value})) > most:
                best, most = {**best, name: value}, found
    return best, most
