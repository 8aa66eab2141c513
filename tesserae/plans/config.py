"""Parameters of the pipeline."""

from __future__ import annotations

import hashlib
import json
import logging
from dataclasses import asdict, dataclass, field

#: Passes of candidate generation, each with its switch: the names in Blocking.passes.
PASSES = ("exact_name", "exact_core", "exact_address", "numeric_address", "rare_name", "rare_address", "fuzzy_name", "fuzzy_address")


@dataclass(frozen=True)
class Blocking:
    passes: tuple[str, ...] = PASSES[:6]  # the fuzzy passes are off unless named
    rare_cap: int = 1000

    def __post_init__(self):
        if unknown := set(self.passes) - set(PASSES):
            raise ValueError(f"no passes: {sorted(unknown)}")


@dataclass(frozen=True)
class Sampling:
    negatives: int = 4
    hard: float = 0.5
    seed: int = 42


@dataclass(frozen=True)
class Training:
    rounds: int = 300
    depth: int = 6
    rate: float = 0.05
    subsample: float = 0.8
    seed: int = 42
    early_stop: bool = True


#: What a search over the learner's parameters tries, one parameter after the other.
SEARCH = {
    "depth": (4, 5, 6, 7, 8),
    "rate": (0.03, 0.05, 0.08, 0.10),
    "subsample": (0.7, 0.8, 0.9, 1.0),
    "rounds": (200, 300, 500),
}


@dataclass(frozen=True)
class Thresholds:
    """The sweep's hundredths, and thresholds that replace the one found, for all pairs or those of one source."""

    first: int = 10
    last: int = 99
    best: float | None = None
    s2: float | None = None
    s3: float | None = None


@dataclass(frozen=True)
class Config:
    blocking: Blocking = field(default_factory=Blocking)
    sampling: Sampling = field(default_factory=Sampling)
    training: Training = field(default_factory=Training)
    thresholds: Thresholds = field(default_factory=Thresholds)
    validation_ratio: float = 0.2
    debug_rows: int | None = None
    experiment: str = "exp_001"
    versions: tuple[tuple[str, str], ...] = (("features", "v1"), ("blocking", "v1"), ("model", "v1"))
    log_level: str = "INFO"

    def to_dict(self) -> dict:
        return asdict(self)

    def key(self) -> str:
        """Names stage tables: another configuration writes others."""
        told = {k: v for k, v in self.to_dict().items() if k != "log_level"}
        return hashlib.sha256(json.dumps(told, sort_keys=True).encode()).hexdigest()[:12]

    def configure_logging(self) -> None:
        logging.basicConfig(format="%(asctime)s %(levelname)s %(name)s %(message)s")
        logging.getLogger("tesserae").setLevel(self.log_level)
