"""Trend curves a*f(x)+b per feature: fit quality, coefficients and choice.

The curves are linear in a and b, so least squares has a closed form and the fit quality is
the squared correlation of f(x) and y: one aggregate serves all features and curves.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabforge.config import TREND_NAMES
from tabforge.functions.scalar import CURVES, as_double, long_form, numeric_columns

# Report column of each curve.
R2_COLUMNS = {
    "Linear": "linear_r2_score", "Log": "log_r2_score", "Sqrt": "sqrt_r2_score",
    "1/x": "reciprocal_r2_score", "x²": "square_r2_score",
}
INVALID = -math.inf


def _pairs(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    return long_form(df.withColumn("__y", as_double(target)), list(features), ["__y"])


def _complete(fx: Column) -> Column:
    """True when the curve is defined on every row and the target is never missing."""
    return F.count_if(fx.isNull() | F.isnan(fx) | F.col("__y").isNull()) == 0


def trend_metrics(df: DataFrame, features: Sequence[str], target: str,
                  names: Sequence[str] = TREND_NAMES) -> DataFrame:
    """R² per feature and curve; -inf when a curve is undefined on some row.

    ``names`` labels the curves by position; a curve whose label is not one of the five known
    ones is left out (NULL).
    """
    labels = dict(zip(TREND_NAMES, names))
    x, y = F.col("x"), F.col("__y")
    aggs = []
    for curve, column in R2_COLUMNS.items():
        source = next((c for c in TREND_NAMES if labels.get(c) == curve), None)
        if source is None:
            aggs.append(F.max(F.lit(None).cast("double")).alias(column))
            continue
        fx = CURVES[source](x)
        # A constant regressor explains nothing; regr_r2 is NULL there.
        fit = F.coalesce(F.regr_r2(y, fx), F.lit(0.0))
        aggs.append(F.when(_complete(fx), fit).otherwise(F.lit(INVALID)).alias(column))
    return _pairs(df, features, target).groupBy("feature").agg(*aggs)


def select_best(metrics: DataFrame, alpha: float = 0.2) -> DataFrame:
    """Highest R² (first curve on ties); Linear instead when it is within ``alpha`` of it."""
    cols = {n: F.coalesce(F.col(c), F.lit(INVALID)) for n, c in R2_COLUMNS.items()}
    top = F.greatest(*cols.values())
    best = F.coalesce(*[F.when(c == top, F.lit(n)) for n, c in cols.items()])
    keep_linear = (best != "Linear") & (cols["Linear"] >= top * (1 - alpha))
    return metrics.withColumns({
        "best_transformation": F.when(keep_linear, F.lit("Linear")).otherwise(best),
        "best_r2_score": F.when(keep_linear, cols["Linear"]).otherwise(top),
    })


def trend_select(df: DataFrame, target: str, alpha: float = 0.2,
                 features: Sequence[str] | None = None) -> DataFrame:
    names = list(features) if features is not None else numeric_columns(df, [target])
    return select_best(trend_metrics(df, names, target), alpha)


def trend_coefficients(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """(feature, curve, slope, intercept) of every valid curve, as drawn over a scatter plot."""
    y, x = F.col("__y"), F.col("x")
    aggs = []
    for i, (curve, build) in enumerate(CURVES.items()):
        fx = build(x)
        aggs += [
            F.when(_complete(fx), F.regr_slope(y, fx)).alias(f"s{i}"),
            F.when(_complete(fx), F.regr_intercept(y, fx)).alias(f"i{i}"),
        ]
    wide = _pairs(df, features, target).groupBy("feature").agg(*aggs)
    return wide.select("feature", F.inline(F.array(*[
        F.struct(F.lit(curve).alias("curve"), F.col(f"s{i}").alias("slope"),
                 F.col(f"i{i}").alias("intercept"))
        for i, curve in enumerate(CURVES)]))).filter(F.col("slope").isNotNull())
