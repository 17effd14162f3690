"""Hyper-parameter search: sampled parameter sets scored on shared folds."""

from __future__ import annotations

import logging
import math
import random
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.ml import Estimator, Pipeline
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame

from tabforge.plans.folds import Scores, cross_validate
from tabforge.plans.linear_sweep import ridge_scores, sweep_table
from tabforge.plans.models import FEATURES_COL, PenalizedRegression

log = logging.getLogger(__name__)


def sample_space(space: Mapping[str, Mapping[str, Any]], n: int, seed: int = 42
                 ) -> list[dict[str, Any]]:
    """``n`` draws from {name: {type, low, high, log, choices}}, reproducible by seed."""
    rng = random.Random(seed)

    def draw(spec: Mapping[str, Any]) -> Any:
        kind = spec["type"]
        if kind == "suggest_categorical":
            return rng.choice(list(spec["choices"]))
        low, high = spec["low"], spec["high"]
        if kind == "suggest_int":
            return rng.randint(int(low), int(high))
        if kind == "suggest_float":
            if spec.get("log"):
                return math.exp(rng.uniform(math.log(low), math.log(high)))
            return rng.uniform(float(low), float(high))
        raise ValueError(f"unknown parameter type {kind!r}")

    return [{name: draw(spec) for name, spec in space.items()} for _ in range(n)]


# Configuration name -> ML Param name, per model family.
_BOOSTING = {"n_estimators": "maxIter", "iterations": "maxIter", "max_depth": "maxDepth",
             "depth": "maxDepth", "learning_rate": "stepSize", "subsample": "subsamplingRate",
             "min_child_samples": "minInstancesPerNode", "border_count": "maxBins",
             "colsample_bytree": "featureSubsetStrategy", "gamma": "minInfoGain"}
PARAM_NAMES: dict[str, dict[str, str]] = {
    "catboost": _BOOSTING, "xgboost": _BOOSTING, "lightgbm": _BOOSTING,
    "randomforest": {"n_estimators": "numTrees", "max_depth": "maxDepth",
                     "min_samples_leaf": "minInstancesPerNode",
                     "max_features": "featureSubsetStrategy"},
    "ridge": {"alpha": "alpha", "fit_intercept": "fitIntercept"},
}
MAX_DEPTH = 30
# Search range of the ridge penalty.
RIDGE_SPACE = {"alpha": {"type": "suggest_float", "low": 0.1, "high": 100.0, "log": True}}
RIDGE_ALPHAS = tuple(p["alpha"] for p in sample_space(RIDGE_SPACE, 100))


def build_regressor(family: str, params: Mapping[str, Any], target: str,
                    seed: int = 42) -> Estimator:
    """Regressor of a family with sampled parameters; unsupported names are warned about."""
    if family not in PARAM_NAMES:
        raise ValueError(f"unknown model family {family!r}")
    known = PARAM_NAMES[family]
    unknown = sorted(set(params) - set(known))
    if unknown:
        log.warning("%s: parameters without counterpart are ignored: %s", family, unknown)
    chosen = {known[k]: v for k, v in params.items() if k in known}
    if "maxDepth" in chosen and int(chosen["maxDepth"]) > MAX_DEPTH:
        log.warning("%s: depth %s is cut to the engine's limit %d", family, chosen["maxDepth"],
                    MAX_DEPTH)
        chosen["maxDepth"] = MAX_DEPTH
    if "featureSubsetStrategy" in chosen:
        chosen["featureSubsetStrategy"] = str(chosen["featureSubsetStrategy"])
    common = {"featuresCol": FEATURES_COL, "labelCol": target}
    if family == "ridge":
        return PenalizedRegression(**common, **chosen)
    if family == "randomforest":
        return RandomForestRegressor(seed=seed, **common, **chosen)
    return GBTRegressor(seed=seed, **common, **chosen)


@dataclass
class Trial:
    number: int
    params: dict[str, Any]
    scores: Scores


@dataclass
class Study:
    trials: list[Trial]

    @property
    def best(self) -> Trial:
        done = [t for t in self.trials if t.scores.error is None]
        if not done:
            raise ValueError("no trial succeeded")
        return min(done, key=lambda t: (t.scores.mean, t.number))

    def table(self, spark) -> DataFrame:
        rows = [(t.number, str(sorted(t.params.items())), t.scores.mean, t.scores.std)
                for t in self.trials if t.scores.error is None]
        return spark.createDataFrame(
            rows, "trial int, params string, mean_rmse double, std_rmse double"
        ).orderBy("mean_rmse", "trial")


def tune(
    df: DataFrame, target: str, folds: Sequence[str], k: int,
    space: Mapping[str, Mapping[str, Any]], build: Callable[[Mapping[str, Any]], Estimator],
    preparation: Pipeline | None = None, n_trials: int = 100, seed: int = 42,
    parallelism: int = 4,
) -> Study:
    """Score ``n_trials`` sampled parameter sets; every fold is prepared once for all of them."""
    drawn = sample_space(space, n_trials, seed)
    candidates = {str(i): build(p) for i, p in enumerate(drawn)}
    scores = cross_validate(df, target, folds, k, candidates, preparation, parallelism)
    return Study([Trial(i, p, scores[str(i)]) for i, p in enumerate(drawn)])


def tune_ridge(df: DataFrame, target: str, folds: Sequence[str], k: int,
               space: Mapping[str, Mapping[str, Any]] = RIDGE_SPACE, kind: str = "linear_models",
               n_trials: int = 100, seed: int = 42) -> Study:
    """``tune`` for ridge: all trials from the sums of one pass, preparation in every fold."""
    drawn = sample_space(space, n_trials, seed)
    table = sweep_table(df, target, folds, k, [kind])
    return Study([Trial(i, p, s) for i, (p, s) in enumerate(zip(
        drawn, ridge_scores(table, kind, drawn)))])


def improvement(base: float, tuned: float) -> tuple[float, float]:
    """Absolute and percentage gain over the untuned score."""
    return base - tuned, (base - tuned) / base * 100.0
