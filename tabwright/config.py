"""Settings of one estimator and how they are read from a settings file."""

from __future__ import annotations

import json
from dataclasses import dataclass, field, replace
from pathlib import Path

# Accepted spellings.
TRUE_WORDS = {"true", "1", "yes", "on", "t", "y"}
METRICS = [
    "accuracy", "balanced_accuracy", "f1_macro", "f1_micro", "roc_auc", "precision_macro",
    "precision_micro", "average_precision", "recall_macro", "recall_micro", "log_loss",
]
BALANCE_MODES = {"none": "none", "equalize": "equalize", "equal": "equalize", "average": "average"}


@dataclass(frozen=True)
class SchemaOptions:
    min_present: float = 0.8
    min_typealign: float = 0.8
    max_categorical: int = 10
    string_numbers: str = "reference"   # "promote": numeric strings win the tie
    int_is_float: bool = False          # native ints also count toward float

    def __post_init__(self):
        if self.string_numbers not in ("reference", "promote"):
            raise ValueError(f"string_numbers must be 'reference' or 'promote', not {self.string_numbers!r}")


@dataclass(frozen=True)
class BalanceOptions:
    mode: str = "none"
    max_oversample: float = 2.0

    def __post_init__(self):
        if self.mode not in BALANCE_MODES:
            raise ValueError(f"unknown balancing {self.mode!r}; use one of {sorted(BALANCE_MODES)}")
        object.__setattr__(self, "mode", BALANCE_MODES[self.mode])


@dataclass(frozen=True)
class SearchOptions:
    metric: str = "accuracy"
    num_folds: int = 5
    parallelism: int = 1
    #: Seconds; unset means no budget, so results do not depend on the machine's speed.
    max_global_time: int | None = None
    max_permodel_time: int | None = None
    ensemble_size: int = 50
    ensemble_nbest: float | int = 0.2
    #: Candidates to try, in their fixed order; unset means all.
    max_models: int | None = None
    include: frozenset[str] | None = None
    exclude: frozenset[str] = frozenset()
    include_preprocessors: frozenset[str] | None = None
    exclude_preprocessors: frozenset[str] = frozenset()
    importance_repeats: int = 10

    def __post_init__(self):
        name = self.metric.lower()
        object.__setattr__(self, "metric", name if name in METRICS else "accuracy")


@dataclass(frozen=True)
class EstimatorSpec:
    """One learning task: which table, which target, which settings."""

    name: str
    target: str
    source: str | None = None
    pos: str | None = "pos"
    is_classification: bool = True
    is_regression: bool = False
    random_seed: int = 10001
    strict_target: bool = False
    schema: SchemaOptions = field(default_factory=SchemaOptions)
    balance: BalanceOptions = field(default_factory=BalanceOptions)
    search: SearchOptions = field(default_factory=SearchOptions)

    def __post_init__(self):
        if self.is_classification == self.is_regression:
            raise ValueError(f"estimator {self.name!r} must be either a classification or a regression")


def is_true(word: object) -> bool:
    return str(word).strip().lower() in TRUE_WORDS


def read_nbest(value: object) -> float | int:
    """A whole number means that many models, a fraction that share of them."""
    try:
        return int(str(value))
    except ValueError:
        return float(str(value))


_SEARCH_KEYS = {
    "metric": ("metric", str),
    "num_folds": ("num_folds", int),
    "allowed_cpus": ("parallelism", int),
    "max_global_time": ("max_global_time", int),
    "max_permodel_time": ("max_permodel_time", int),
    "ensemble_size": ("ensemble_size", int),
    "ensemble_nbest": ("ensemble_nbest", read_nbest),
}
_SCHEMA_KEYS = {
    "attr_type_min_present": ("min_present", float),
    "attr_type_min_typealign": ("min_typealign", float),
    "max_categorical_values": ("max_categorical", int),
}
_BALANCE_KEYS = {
    "target_category_balancing": ("mode", str),
    "category_max_oversample": ("max_oversample", float),
}


def _overridden(base, keys: dict, *layers: dict):
    """Later layers win."""
    found = {}
    for layer in layers:
        for key, (attr, convert) in keys.items():
            if layer.get(key) is not None:
                found[attr] = convert(layer[key])
    return replace(base, **found)


def specs_from_settings(settings: dict) -> list[EstimatorSpec]:
    """Global settings first, then the estimator's own."""
    shared = settings.get("global_properties", {})
    schema_part = settings.get("schema_properties", {})
    model_part = settings.get("model_properties", {})
    specs = []
    for entry in shared.get("est_list", []):
        is_regression = is_true(entry.get("is_regression", "false"))
        specs.append(
            EstimatorSpec(
                name=entry.get("name", entry["src_collname"]),
                source=entry["src_collname"],
                target=entry["target_name"],
                pos=entry.get("pos", "pos"),
                is_classification=is_true(entry.get("is_classification", str(not is_regression))),
                is_regression=is_regression,
                random_seed=int(entry.get("random_seed", shared.get("random_seed", 10001))),
                schema=_overridden(SchemaOptions(), _SCHEMA_KEYS, schema_part, entry),
                balance=_overridden(BalanceOptions(), _BALANCE_KEYS, model_part, entry),
                search=_overridden(SearchOptions(), _SEARCH_KEYS, shared, entry),
            )
        )
    names = [s.name for s in specs]
    if len(set(names)) != len(names):
        raise ValueError("two estimators share a name; give each its own 'name'")
    return specs


def load_specs(path: str) -> list[EstimatorSpec]:
    return specs_from_settings(json.loads(Path(path).read_text()))
