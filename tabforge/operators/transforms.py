"""Per-feature choice of a variable transform by its squared correlation with the target."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark import keyword_only
from pyspark.ml import Estimator
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabforge.config import TREND_NAMES
from tabforge.functions.scalar import (
    TRANSFORM_SYNONYMS, TRANSFORMS, as_double, col, long_form, numeric_columns,
)
from tabforge.operators.profile import lookup, rows_from_aggregate
from tabforge.operators.stage import FittedStage

# Name parts that mark a flag column, and features that may take a logarithm.
BINARY_PATTERNS = (
    "Outlier_", "High_", "Low_", "is_zero", "is_", "has_", "flag_", "binary_", "_bin", "_flag",
)
LOG_FEATURES = ("Age",)


def named_binary(name: str) -> bool:
    return any(p.lower() in name.lower() for p in BINARY_PATTERNS)


def allowed_transforms(name: str) -> list[str]:
    return [t for t in TRANSFORMS if t != "Log" or name in LOG_FEATURES]


def _extremes(df: DataFrame, features: Sequence[str]) -> dict[str, Any]:
    x = F.col("x")
    rows = long_form(df, list(features)).groupBy("feature").agg(
        F.min(x).alias("lo"), F.max(x).alias("hi"), F.count_if(x.isNull()).alias("gaps")).collect()
    return {r["feature"]: r for r in rows}


def binary_features(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """(feature, by_name, by_values, is_binary); by values means at most two distinct ones.

    Missing counts as one value. Instead of counting distinct values, the second pass looks
    for a row that is neither the minimum nor the maximum.
    """
    ends = _extremes(df, features)
    records = []
    for name in features:
        x, e = as_double(name), ends[name]
        between = F.count_if((x != F.lit(e["lo"])) & (x != F.lit(e["hi"])))
        values = len({v for v in (e["lo"], e["hi"]) if v is not None}) + (e["gaps"] > 0)
        few = (between == 0) & F.lit(values <= 2)
        records.append({"feature": name, "by_name": F.lit(named_binary(name)), "by_values": few,
                        "is_binary": F.lit(named_binary(name)) | few})
    return rows_from_aggregate(df, records)


def choose_transform(scores: Mapping[str, float], alpha: float) -> tuple[str, float]:
    """First best score; Linear when its score is within ``alpha`` of the best."""
    valid = {k: v for k, v in scores.items() if v > -math.inf}
    if not valid:
        return "Linear", -math.inf
    best = max(valid, key=valid.get)
    linear = valid.get("Linear", -math.inf)
    if best != "Linear" and linear >= valid[best] * (1 - alpha):
        best = "Linear"
    return best, valid[best]


class FeatureTransformer(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    targetCol = Param(Params._dummy(), "targetCol", "target", TypeConverters.toString)
    names = Param(Params._dummy(), "names", "transforms to try, in tie-breaking order",
                  TypeConverters.toListString)
    alpha = Param(Params._dummy(), "alpha", "tolerance in favour of Linear", TypeConverters.toFloat)
    features = Param(Params._dummy(), "features", "features; all numeric columns if unset",
                     TypeConverters.toListString)

    passCols = Param(Params._dummy(), "passCols", "row keys, left alone",
                     TypeConverters.toListString)

    @keyword_only
    def __init__(self, *, targetCol="Strength", names=None, alpha=0.2, features=None,
                 passCols=None):
        super().__init__()
        self._setDefault(targetCol="Strength", names=list(TREND_NAMES), alpha=0.2, passCols=[])
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, df: DataFrame) -> FeatureTransformerModel:
        target = self.getOrDefault(self.targetCol)
        if target not in df.columns:
            raise ValueError(f"target {target!r} is not in the table")
        names = [TRANSFORM_SYNONYMS.get(n, n) for n in self.getOrDefault(self.names)]
        names = [n for n in names if n in TRANSFORMS]
        features = (
            self.getOrDefault(self.features) if self.isDefined(self.features)
            else numeric_columns(df, [target, *self.getOrDefault(self.passCols)])
        )
        alpha = self.getOrDefault(self.alpha)
        ends = _extremes(df, features) if features else {}

        x, y, f = F.col("x"), F.col("__y"), F.col("feature")
        tested = [c for c in features if not named_binary(c)]
        report: dict[str, dict[str, Any]] = {}
        found = {}
        if tested:
            low = lookup(f, {c: ends[c]["lo"] for c in tested})
            high = lookup(f, {c: ends[c]["hi"] for c in tested})
            aggs = [F.count_if((x != low) & (x != high)).alias("between"),
                    F.var_pop(y).alias("yvar"), F.count_if(y.isNull()).alias("ygaps")]
            aggs += [F.regr_r2(y, TRANSFORMS[n](x)).alias(f"r{i}") for i, n in enumerate(names)]
            table = long_form(df.withColumn("__y", as_double(target)), tested, ["__y"])
            found = {r["feature"]: r for r in table.groupBy("feature").agg(*aggs).collect()}
        for c in features:
            e, r = ends.get(c), found.get(c)
            if e is None:
                continue
            few = r is not None and r["between"] == 0 and (
                len({v for v in (e["lo"], e["hi"]) if v is not None}) + (e["gaps"] > 0) <= 2)
            if r is None or few:
                report[c] = {"best": "Linear", "best_r2": None, "r2": {"Linear": None},
                             "is_binary": True}
                continue
            if e["gaps"] or math.inf in (abs(e["lo"]), abs(e["hi"])):
                continue
            scores = {}
            for i, n in enumerate(names):
                if n in allowed_transforms(c):
                    r2 = r[f"r{i}"]
                    # A constant target has no correlation although regr_r2 reports 1.
                    usable = (r2 is not None and math.isfinite(r2) and r["yvar"]
                              and not r["ygaps"])
                    scores[n] = r2 if usable else -math.inf
            best, value = choose_transform(scores, alpha)
            report[c] = {
                "best": best, "best_r2": value if math.isfinite(value) else None,
                "r2": {n: v if math.isfinite(v) else None for n, v in scores.items()},
                "is_binary": False,
            }
        return FeatureTransformerModel({"target": target, "report": report})


class FeatureTransformerModel(FittedStage):
    def _transform(self, df: DataFrame) -> DataFrame:
        s = self.fitted
        chosen = {c: r["best"] for c, r in s["report"].items() if r["best"] != "Linear"}
        body = [
            TRANSFORMS[chosen[c]](as_double(c)).alias(c) if c in chosen else col(c)
            for c in df.columns if c != s["target"]
        ]
        return df.select(*body, *([col(s["target"])] if s["target"] in df.columns else []))

    @property
    def best(self) -> dict[str, str]:
        return {c: r["best"] for c, r in self.fitted["report"].items()}

    def report(self, spark) -> DataFrame:
        """One row per feature; R² is NULL where a transform was invalid or not tried."""
        rows = []
        for c, r in self.fitted["report"].items():
            rows.append((c, r["best"], r["best_r2"], r["is_binary"],
                         *[r["r2"].get(n) for n in TRANSFORMS]))
        return spark.createDataFrame(
            rows,
            "feature string, best_transformation string, best_r2 double, is_binary boolean, "
            "r2_linear double, r2_log double, r2_sqrt double, r2_reciprocal double, "
            "r2_square double")
