"""The staged linkage pipeline: load, clean, split, block, pair, train, choose a threshold, infer, write, validate.

Each of the STAGES can be called alone, also in a later process: tables that later stages read are Parquet, named by the
configuration and by size and time of change of the input files, so a run resumes only on its own tables. The model, its
feature schema and the threshold are artefacts of the output folder; the test stages need only those and the test sources.
"""

from __future__ import annotations

import hashlib
import logging
import time
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tesserae.functions.text import clean
from tesserae.operators import blocking, features, metrics, model, output, pairs, quality, threshold, truth, validate
from tesserae.plans import memory
from tesserae.plans.config import Config
from tesserae.sources import files

log = logging.getLogger(__name__)


@dataclass
class Run:
    """Lazy tables and paths of one run."""

    spark: SparkSession
    data: str
    out: str
    config: Config = field(default_factory=Config)
    facts: dict = field(default_factory=dict)

    # --- places

    def file(self, kind: str, name: str) -> str:
        """An input file, in a folder of its kind or beside the others."""
        own = f"{self.data}/{kind}/{kind}_{name}.tsv"
        return own if files.exists(self.spark, own) else f"{self.data}/{kind}_{name}.tsv"

    def key(self, kind: str) -> str:
        """The configuration and the inputs; for results of the model, also the model."""
        inputs = [self.file("test" if kind == "scored" else kind, f"source{n}") for n in (1, 2, 3)]
        inputs += {"train": [self.file(kind, "ground_truth")], "scored": [f"{self.out}/model/metadata"]}.get(kind, [])
        told = [self.config.key(), *[files.fingerprint(self.spark, p) for p in inputs]]
        return hashlib.sha256("\n".join(told).encode()).hexdigest()[:12]

    def path(self, kind: str, name: str) -> str:
        return f"{self.out}/stages/{kind}-{self.key(kind)}/{name}"

    def table(self, kind: str, name: str, make) -> DataFrame:
        """The written table of that name, made first where it is not there."""
        path = self.path(kind, name)
        if files.exists(self.spark, f"{path}/_SUCCESS"):
            return self.spark.read.parquet(path)
        return files.write_parquet(make(), path)

    # --- tables

    def raw(self, kind: str, n: int) -> DataFrame:
        return files.read_source(self.spark, self.file(kind, f"source{n}"), self.config.debug_rows if n == 1 else None)

    def sources(self, kind: str) -> dict[str, DataFrame]:
        """The cleaned sources."""
        return {f"s{n}": self.table(kind, f"clean{n}", lambda n=n: clean(self.raw(kind, n))) for n in (1, 2, 3)}

    def ids(self, kind: str) -> DataFrame:
        return self.sources(kind)["s1"].select(F.col("entity_id").alias("source1_entity_id"))

    @cached_property
    def truth(self) -> DataFrame:
        return truth.for_ids(truth.parse(files.read_tsv(self.spark, self.file("train", "ground_truth"), files.TRUTH)), self.ids("train"))

    def split(self) -> DataFrame:
        return self.table("train", "split", lambda: truth.split(self.ids("train"), self.config.validation_ratio, self.config.sampling.seed))

    def part(self, name: str) -> DataFrame:
        return self.split().where(F.col("part") == name).select("source1_entity_id")

    def candidates(self, kind: str) -> DataFrame:
        b, s = self.config.blocking, self.sources(kind)
        fuzzy = any(p.startswith("fuzzy") for p in b.passes)
        return self.table(kind, "candidates", lambda: blocking.all_passes(s["s1"], {"S2": s["s2"], "S3": s["s3"]}, list(b.passes), fuzzy, b.rare_cap))

    def training_pairs(self) -> DataFrame:
        c, true_pairs = self.config.sampling, truth.expand(self.truth)
        return self.table("train", "pairs", lambda: pairs.training(pairs.label(self.candidates("train"), true_pairs), true_pairs, self.part("train"), c.negatives, c.hard, c.seed))

    def featured(self, kind: str, name: str, make) -> DataFrame:
        s = self.sources(kind)
        every = s["s1"].unionByName(s["s2"]).unionByName(s["s3"])
        return self.table(kind, name, lambda: features.features(pairs.with_records(make(), every)))

    def train_features(self) -> DataFrame:
        return self.featured("train", "features", self.training_pairs)

    def held_features(self) -> DataFrame:
        return self.featured("train", "held-features", lambda: pairs.validation(self.candidates("train"), truth.expand(self.truth), self.part("validation")))

    def held_scores(self) -> DataFrame:
        return self.table("train", "held-scores", lambda: model.score(self.model(), self.held_features(), self.schema()))

    # --- artefacts

    def model(self):
        return model.load(f"{self.out}/model")

    def schema(self) -> list[str]:
        return files.read_json(f"{self.out}/model_feature_schema.json")["feature_columns"]

    def threshold(self) -> float:
        fixed = self.config.thresholds.best
        return files.load_threshold(f"{self.out}/threshold.json") if fixed is None else fixed

    def _save_facts(self) -> None:
        told = {k: {a: str(b) for a, b in v.items()} for k, v in self.facts.items()}
        files.write_json(f"{self.out}/experiment.json", {"experiment": self.config.experiment, "config": self.config.to_dict(), "facts": told})

    # --- stages on training data

    def load(self, kind: str = "train") -> None:
        for n in (1, 2, 3):
            self.raw(kind, n)

    def clean(self, kind: str = "train") -> None:
        """The cleaned sources, with the cleaning gates passed."""
        for n in (1, 2, 3):
            self.facts[f"{kind}-s{n}"] = quality.require_quality(self.raw(kind, n), self.sources(kind)[f"s{n}"])

    def recall(self) -> None:
        s = self.sources("train")
        self.facts["blocking"] = metrics.blocking_report(self.candidates("train"), truth.expand(self.truth), s["s1"], s["s2"], s["s3"]).first().asDict()

    def features(self) -> None:
        self.train_features()
        self.held_features()

    def train(self) -> None:
        """Boosted trees with an early stop on the validation entities' pairs; saved with their feature schema."""
        t, taught, held = self.config.training, self.train_features(), self.held_features()
        names = features.feature_names(taught)
        if t.early_stop:
            taught = taught.withColumn("_held", F.lit(False)).unionByName(held.select(taught.columns).withColumn("_held", F.lit(True)))
        fitted = model.train(taught, t.rounds, t.depth, t.rate, t.subsample, t.seed, "_held" if t.early_stop else None)
        model.save(fitted, f"{self.out}/model")
        files.write_json(f"{self.out}/model_feature_schema.json", {"feature_columns": names})
        files.file_system(self.spark, self.path("train", "held-scores"))[0].delete(files.file_system(self.spark, self.path("train", "held-scores"))[1], True)

    def optimize(self) -> None:
        own, t = truth.for_ids(self.truth, self.part("validation")), self.config.thresholds
        best = threshold.best_threshold(threshold.sweep(self.held_scores(), own, t.first, t.last)).first()
        self.facts["threshold"] = best.asDict()
        files.save_threshold(f"{self.out}/threshold.json", best["threshold"], macro_f05=best["macro_f05"])

    def errors(self) -> None:
        own = truth.for_ids(self.truth, self.part("validation"))
        for name, rows in threshold.errors(self.held_scores(), own, self.threshold()).items():
            files.write_parquet(rows, self.path("train", f"errors-{name}"))

    # --- stages on test data

    def test_candidates(self) -> None:
        self.clean("test")
        self.candidates("test")

    def test_features(self) -> DataFrame:
        return self.featured("test", "features", lambda: self.candidates("test"))

    def scores(self) -> DataFrame:
        return self.table("scored", "scores", lambda: model.score(self.model(), self.test_features(), self.schema()))

    def results(self) -> tuple[list[str], list[str]]:
        """Writes the two result files and returns the validator's errors and warnings; a match that is no candidate is an error."""
        s, t = self.sources("test"), self.config.thresholds
        targets = s["s2"].select("entity_id").unionByName(s["s3"].select("entity_id"))
        chosen = threshold.decided(self.scores(), self.threshold(), {"S2": t.s2, "S3": t.s3})
        matched = output.matching_results(chosen, self.ids("test"), targets)
        listed = output.candidate_pairs(self.candidates("test"), self.ids("test"), targets)
        paths = [files.write_tsv(rows.orderBy("source1_entity_id"), f"{self.out}/{n}.tsv") for rows, n in ((matched, "matching_results"), (listed, "candidate_pairs"))]
        errors, warnings = validate.validate_files(self.spark, paths[0], s["s1"], paths[1], targets)
        strangers = output.subset_violations(*[files.read_tsv(self.spark, p) for p in paths])
        if lost := strangers.count():
            errors = [*errors, f"{lost} predicted matches are no candidates, such as {tuple(strangers.first())}"]
        return errors, warnings


#: Name and step, in order; each may be called alone once those before it have run, in this process or an earlier one.
STAGES = (
    ("load", Run.load), ("clean", Run.clean), ("split", Run.split), ("candidates", lambda r: r.candidates("train")), ("recall", Run.recall),
    ("pairs", Run.training_pairs), ("features", Run.features), ("train", Run.train), ("score", Run.held_scores), ("threshold", Run.optimize),
    ("errors", Run.errors), ("test-candidates", Run.test_candidates), ("test-features", Run.test_features), ("test-scores", Run.scores), ("results", Run.results),
)


def call(whole: Run, names: list[str]):
    """Runs the named stages in order, with their times in the log; returns what the last one gives."""
    steps, given = dict(STAGES), None
    for name in names:
        begun = time.monotonic()
        given = steps[name](whole)
        log.info("stage %s took %.1f s", name, time.monotonic() - begun)
        memory.report(whole.spark, name)
    if whole.facts:
        whole._save_facts()
    return given


def run(spark: SparkSession, data: str, out: str, config: Config | None = None) -> tuple[list[str], list[str]]:
    """All stages."""
    return call(Run(spark, data, out, config or Config()), [name for name, _ in STAGES])


def infer(spark: SparkSession, data: str, out: str, config: Config | None = None) -> tuple[list[str], list[str]]:
    """The test stages, by the model, schema and threshold that an earlier run left in `out`."""
    return call(Run(spark, data, out, config or Config()), [name for name, _ in STAGES[11:]])
