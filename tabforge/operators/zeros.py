"""Does it matter that a feature is zero? Group tests and the flag encoder built on them."""

from __future__ import annotations

import math
import warnings
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark import keyword_only
from pyspark.ml import Estimator
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabforge.functions.pvalues import f_upper, t_two_sided
from tabforge.functions.quantiles import exact_quantiles
from tabforge.functions.scalar import as_double, flag, holds
from tabforge.operators.stage import FittedStage

# Features tested by the exploratory report and by the encoder.
REPORT_FEATURES = ("Blast Furnace Slag", "Fly Ash", "Superplasticizer")
ENCODER_FEATURES = ("Blast Furnace Slag", "Fly Ash", "Sp/C_pct")


def _groups(feature: str, target: str, rest_is_zero: bool) -> tuple[Column, Column]:
    """Target values of the zero group and of the positive group.

    With ``rest_is_zero`` all rows that are not positive (negative, missing) count as zero;
    otherwise they belong to neither group.
    """
    x, y = as_double(feature), as_double(target)
    positive = holds(x > 0)
    zero = ~positive if rest_is_zero else holds(x == 0)
    return F.when(zero, y), F.when(positive, y)


def group_statistics(df: DataFrame, features: Sequence[str], target: str,
                     rest_is_zero: bool) -> dict[str, dict[str, float]]:
    """Sizes, means, variances and median-centred spreads of both groups of every feature.

    Two rounds: exact group medians, then one aggregate with all moments.
    """
    if not features:
        return {}
    columns: dict[str, Column] = {}
    for i, f in enumerate(features):
        columns[f"z{i}"], columns[f"p{i}"] = _groups(f, target, rest_is_zero)
    medians = {k: v[0] for k, v in exact_quantiles(df, columns, [0.5]).items()}
    table = df.select(*[c.alias(k) for k, c in columns.items()])
    aggs = []
    for k in columns:
        y = F.col(k)
        spread = F.abs(y - F.lit(medians[k]).cast("double"))
        aggs += [
            F.count(y).alias(f"{k}_n"), F.avg(y).alias(f"{k}_mean"),
            F.var_samp(y).alias(f"{k}_var"), F.min(y).alias(f"{k}_min"), F.max(y).alias(f"{k}_max"),
            F.avg(spread).alias(f"{k}_zmean"), F.var_pop(spread).alias(f"{k}_zvar"),
        ]
    row = table.agg(*aggs).first()
    out = {}
    for i, f in enumerate(features):
        stats = {}
        for side, k in (("zero", f"z{i}"), ("positive", f"p{i}")):
            for m in ("n", "mean", "var", "min", "max", "zmean", "zvar"):
                stats[f"{side}_{m}"] = row[f"{k}_{m}"]
            stats[f"{side}_median"] = medians[k]
        out[f] = stats
    return out


def levene(s: Mapping[str, float]) -> tuple[float, float]:
    """Median-centred Levene statistic of the two groups and its p-value."""
    n0, n1 = s["zero_n"], s["positive_n"]
    n = n0 + n1
    if not n0 or not n1 or n < 3:
        return math.nan, math.nan
    centre = (n0 * s["zero_zmean"] + n1 * s["positive_zmean"]) / n
    between = n0 * (s["zero_zmean"] - centre) ** 2 + n1 * (s["positive_zmean"] - centre) ** 2
    within = n0 * s["zero_zvar"] + n1 * s["positive_zvar"]
    if within == 0:
        stat = math.inf if between > 0 else math.nan
    else:
        stat = (n - 2) * between / within
    return stat, f_upper(stat, 1, n - 2)


def t_test(s: Mapping[str, float], equal_var: bool) -> tuple[float, float, float]:
    """(t, degrees of freedom, p) of positive minus zero."""
    n0, n1 = s["zero_n"], s["positive_n"]
    v0, v1 = s["zero_var"], s["positive_var"]
    if n0 < 2 or n1 < 2 or v0 is None or v1 is None:
        return math.nan, math.nan, math.nan
    gap = s["positive_mean"] - s["zero_mean"]
    if equal_var:
        df = float(n0 + n1 - 2)
        se2 = ((n0 - 1) * v0 + (n1 - 1) * v1) / df * (1 / n0 + 1 / n1)
    else:
        a, b = v0 / n0, v1 / n1
        se2 = a + b
        df = se2**2 / (a * a / (n0 - 1) + b * b / (n1 - 1)) if se2 > 0 else math.nan
    if se2 == 0:
        t = math.nan if gap == 0 else math.copysign(math.inf, gap)
    else:
        t = gap / math.sqrt(se2)
    return t, df, t_two_sided(t, df)


def zero_effect_tests(df: DataFrame, features: Sequence[str], target: str,
                      alpha: float = 0.05) -> dict[str, dict[str, Any]]:
    """Exploratory form: exact zeros against positives, Welch when Levene p < alpha."""
    out = {}
    for f, s in group_statistics(df, features, target, rest_is_zero=False).items():
        w, levene_p = levene(s)
        equal = not levene_p < alpha
        t, dof, p = t_test(s, equal)
        out[f] = {**s, "levene": w, "levene_p": levene_p, "test": "student" if equal else "welch",
                  "t": t, "df": dof, "p": p, "significant": p < alpha}
    return out


def analyze_zeros(df: DataFrame, config: Mapping[str, Any], target: str = "Strength",
                  features: Sequence[str] = REPORT_FEATURES) -> dict[str, Any]:
    """Configuration with ``binary_features.from_zeros`` set to the significant features."""
    tests = zero_effect_tests(df, features, target)
    chosen = [f for f in features if tests[f]["significant"]]
    return {**config,
            "binary_features": {**config.get("binary_features", {}), "from_zeros": chosen}}


def encoder_test(s: Mapping[str, float], alpha: float, levene_alpha: float) -> dict[str, Any]:
    """Encoder form: Student only when Levene's p exceeds its level, else Welch."""
    out: dict[str, Any] = {
        "group_non_zero_size": s["positive_n"], "group_zero_size": s["zero_n"],
        "group_non_zero_mean": None, "group_zero_mean": None, "levene": None,
        "levene_p_value": None, "t": None, "df": None,
    }
    if min(s["zero_n"], s["positive_n"]) < 2:
        return {**out, "p_value": 1.0, "test_type": "insufficient", "significant": False}
    varied = s["zero_min"] != s["zero_max"] and s["positive_min"] != s["positive_max"]
    w, levene_p = levene(s) if varied else (math.nan, math.nan)
    equal = levene_p > levene_alpha
    t, dof, p = t_test(s, equal)
    return {
        **out, "p_value": p, "levene": w, "levene_p_value": levene_p, "t": t, "df": dof,
        "test_type": "student" if equal else "welch", "significant": p < alpha,
        "group_non_zero_mean": s["positive_mean"], "group_zero_mean": s["zero_mean"],
    }


class ZeroBinaryEncoder(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Learns for which features being positive shifts the target's mean."""

    targetCol = Param(Params._dummy(), "targetCol", "target", TypeConverters.toString)
    features = Param(Params._dummy(), "features", "tested features", TypeConverters.toListString)
    alpha = Param(Params._dummy(), "alpha", "level of the t test", TypeConverters.toFloat)
    leveneAlpha = Param(Params._dummy(), "leveneAlpha", "level of Levene's test",
                        TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, targetCol="Strength", features=None, alpha=0.05, leveneAlpha=0.05):
        super().__init__()
        self._setDefault(targetCol="Strength", features=list(ENCODER_FEATURES), alpha=0.05,
                         leveneAlpha=0.05)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, df: DataFrame) -> ZeroBinaryModel:
        wanted = self.getOrDefault(self.features)
        present = [f for f in wanted if f in df.columns]
        for f in wanted:
            if f not in present:
                warnings.warn(f"feature {f} is not in the table; skipped", stacklevel=2)
        alpha, levene_alpha = self.getOrDefault(self.alpha), self.getOrDefault(self.leveneAlpha)
        stats = group_statistics(df, present, self.getOrDefault(self.targetCol), True)
        tests = {f: encoder_test(stats[f], alpha, levene_alpha) for f in present}
        for f in present:
            if tests[f]["test_type"] == "insufficient":
                warnings.warn(f"too few rows in a group of {f}", stacklevel=2)
        return ZeroBinaryModel({
            "alpha": alpha, "levene_alpha": levene_alpha, "tests": tests,
            "significant": [f for f in present if tests[f]["significant"]],
        })


class ZeroBinaryModel(FittedStage):
    def _transform(self, df: DataFrame) -> DataFrame:
        hits = [f for f in self.fitted["significant"] if f in df.columns]
        if not hits:
            return df
        return df.withColumns({f"{f}_binary": flag(as_double(f) > 0) for f in hits})

    def report(self, spark: SparkSession) -> DataFrame:
        """One row per tested feature with its test, and the flag column it got, if any."""
        s = self.fitted
        rows = [(f, t["test_type"], t["group_zero_size"], t["group_non_zero_size"],
                 t["group_zero_mean"], t["group_non_zero_mean"], t["levene_p_value"], t["p_value"],
                 f"{f}_binary" if f in s["significant"] else None)
                for f, t in s["tests"].items()]
        return spark.createDataFrame(
            rows, "feature string, test string, zero_rows long, positive_rows long, "
            "zero_mean double, positive_mean double, levene_p double, p double, flag string")


def zero_flags(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """The encoder's flags for a given feature list."""
    return df.withColumns({f"{f}_binary": flag(as_double(f) > 0) for f in features})


