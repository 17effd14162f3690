"""Column profiles: missing values, moments, quantiles, mode share, outlier summary."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tabforge.config import config_key
from tabforge.functions.quantiles import exact_quantiles
from tabforge.functions.scalar import (
    as_double, col, holds, is_missing, long_form, numeric_columns, outside,
)

IQR_FACTOR = 1.5
NO_BOUNDS = {"q1": None, "q3": None, "lower": None, "upper": None}


def number(value: float | None) -> Column:
    return F.lit(value).cast("double")


def rows_from_aggregate(df: DataFrame, records: Sequence[Mapping[str, Any]]) -> DataFrame:
    """One aggregate over ``df`` turned into one output row per record.

    Record values may be aggregate Columns or plain values; all records share their keys.
    Without records the result has no rows and the column ``feature`` alone.
    """
    if not records:
        return df.sparkSession.createDataFrame([], "feature string")
    structs = []
    for r in records:
        structs.append(F.struct(*[
            (v if isinstance(v, Column) else F.lit(v)).alias(k) for k, v in r.items()]))
    return df.agg(F.array(*structs).alias("rows")).select(F.inline("rows"))


def lookup(key: Column, values: Mapping[str, Any], kind: str = "double") -> Column:
    """Per-key literal as a CASE expression; for the handful of features of a report."""
    out = F
    for k, v in values.items():
        out = out.when(key == k, F.lit(v).cast(kind))
    return out.otherwise(F.lit(None).cast(kind)) if values else F.lit(None).cast(kind)


def iqr_bounds(df: DataFrame, columns: Sequence[str] | None = None) -> dict[str, dict[str, float]]:
    """q1, q3 and the fences 1.5 IQR outside them; columns without values are left out."""
    names = numeric_columns(df) if columns is None else list(columns)
    bounds = {}
    for name, (q1, q3) in exact_quantiles(df, names, [0.25, 0.75]).items():
        if q1 is not None:
            gap = IQR_FACTOR * (q3 - q1)
            bounds[name] = {"q1": q1, "q3": q3, "lower": q1 - gap, "upper": q3 + gap}
    return bounds


def iqr_bounds_table(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    bounds = iqr_bounds(df, columns)
    rows = [(n, b["q1"], b["q3"], b["lower"], b["upper"]) for n, b in bounds.items()]
    return df.sparkSession.createDataFrame(
        rows, "feature string, q1 double, q3 double, lower double, upper double")


def detect_outliers(
    df: DataFrame, config: Mapping[str, Any] | None = None, compare_to_standard: bool = True,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Quartiles, fences and outlier counts per numeric column, most outliers first.

    A column without values keeps its row, with NULL quartiles and no outliers.
    """
    standard = (config or {}).get("standard_value", {}) if compare_to_standard else {}
    records = []
    names = numeric_columns(df) if columns is None else list(columns)
    bounds = iqr_bounds(df, names)
    for name in names:
        b = bounds.get(name, NO_BOUNDS)
        limits = standard.get(config_key(name))
        low, high = (limits.get("min"), limits.get("max")) if limits else (None, None)
        beyond = (
            F.count_if(holds(outside(as_double(name), low, high)))
            if limits else F.lit(None).cast("long")
        )
        records.append({
            "feature": name,
            "Q1": F.round(number(b["q1"]), 3),
            "Q3": F.round(number(b["q3"]), 3),
            "IQR": F.round(number(b["q3"]) - number(b["q1"]), 3),
            "Lower_Bound": F.round(number(b["lower"]), 3),
            "Upper_Bound": F.round(number(b["upper"]), 3),
            "n_outliers_IQR": F.count_if(holds(outside(as_double(name), b["lower"], b["upper"]))),
            "standard_min": F.lit(low).cast("double"),
            "standard_max": F.lit(high).cast("double"),
            "n_outliers_standard": beyond,
        })
    if not records:
        return rows_from_aggregate(df, records)
    return rows_from_aggregate(df, records).orderBy(F.desc("n_outliers_IQR"), "feature")


def outlier_masks(
    df: DataFrame, columns: Sequence[str] | None = None, keep: Sequence[str] = (),
) -> DataFrame:
    """Boolean column per feature: value outside its IQR fences. ``keep`` names row keys."""
    names = numeric_columns(df) if columns is None else list(columns)
    bounds = iqr_bounds(df, names)
    fences = {n: bounds.get(n, NO_BOUNDS) for n in names}
    return df.select(
        *[col(k) for k in keep],
        *[holds(outside(as_double(n), b["lower"], b["upper"])).alias(n)
          for n, b in fences.items()],
    )


def count_iqr_outliers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, n_outliers) with the fences of this very table; empty columns count 0."""
    bounds = iqr_bounds(df, columns)
    return rows_from_aggregate(df, [
        {"feature": n,
         "n_outliers": F.count_if(holds(outside(as_double(n), bounds[n]["lower"],
                                                bounds[n]["upper"])))
         if n in bounds else F.lit(0).cast("long")}
        for n in columns])


def quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float]) -> DataFrame:
    found = exact_quantiles(df, columns, probs)
    rows = [(n, float(p), v) for n, vs in found.items() for p, v in zip(probs, vs)]
    return df.sparkSession.createDataFrame(rows, "feature string, p double, value double")


def missing_values(df: DataFrame) -> DataFrame:
    """(column_name, n_missing) of every column that has any missing value."""
    return rows_from_aggregate(df, [
        {"column_name": c, "n_missing": F.count_if(is_missing(df, c))} for c in df.columns
    ]).filter(F.col("n_missing") > 0)


def missing_report(df: DataFrame) -> dict[str, Any]:
    by_column = {r["column_name"]: r["n_missing"] for r in missing_values(df).collect()}
    return {
        "total_missing": sum(by_column.values()),
        "columns_with_missing": {c: by_column[c] for c in df.columns if c in by_column},
        "num_columns_with_missing": len(by_column),
    }


def describe(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """count, mean, std, min, quartiles and max per numeric column."""
    names = numeric_columns(df) if columns is None else list(columns)
    quarts = exact_quantiles(df, names, [0.25, 0.5, 0.75])
    x, f = F.col("x"), F.col("feature")
    return long_form(df, names).groupBy("feature").agg(
        F.count(x).alias("count"), F.avg(x).alias("mean"), F.stddev(x).alias("std"),
        F.min(x).alias("min"), F.max(x).alias("max"),
    ).select(
        "feature", "count", "mean", "std", "min",
        *[lookup(f, {n: v[i] for n, v in quarts.items()}).alias(q)
          for i, q in enumerate(("q25", "q50", "q75"))],
        "max",
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(col(column)).count().orderBy(F.desc("count"), col(column))


def value_histogram(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, value, cnt) of the non-missing values; numbers as double, the rest as text."""
    numeric = [c for c in numeric_columns(df) if c in columns]
    other = [c for c in columns if c not in numeric]
    parts = []
    if numeric:
        parts.append(long_form(df, numeric).select(
            "feature", F.col("x").alias("num"), F.lit(None).cast("string").alias("txt")))
    if other:
        texts = df.select(*[col(c).cast("string").alias(c) for c in other]).unpivot(
            [], [col(c) for c in other], "feature", "txt")
        parts.append(texts.select("feature", F.lit(None).cast("double").alias("num"), "txt"))
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return rows.filter(F.col("num").isNotNull() | F.col("txt").isNotNull()).groupBy(
        "feature", "num", "txt").agg(F.count("*").alias("cnt"))


def mode_share(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Most frequent value per column and its share of the non-missing values.

    Ties go to the smallest value. Counting by value combines map-side, so a dominating value
    costs one row per task.
    """
    names = list(df.columns) if columns is None else list(columns)
    best = F.max_by(F.struct("num", "txt"),
                    F.struct(F.col("cnt"), -F.coalesce(F.col("num"), F.lit(0.0))))
    return value_histogram(df, names).groupBy("feature").agg(
        best.alias("mode"), F.max("cnt").alias("mode_count"), F.sum("cnt").alias("n_values"),
    ).select(
        "feature", F.col("mode.num").alias("mode_number"), F.col("mode.txt").alias("mode_text"),
        "mode_count", "n_values", (F.col("mode_count") / F.col("n_values")).alias("share"),
    )


def boxplot_stats(df: DataFrame, columns: Sequence[str] | None = None,
                  max_plots: int | None = None) -> DataFrame:
    """Five-number summary, whisker ends and outlier count, most outliers first.

    All features, or the first ``max_plots``; one without values has NULLs and no outliers.
    """
    names = numeric_columns(df) if columns is None else list(columns)
    quarts = exact_quantiles(df, names, [0.25, 0.5, 0.75])
    records = []
    for n, (q1, q2, q3) in quarts.items():
        x, low, high = as_double(n), None, None
        if q1 is not None:
            gap = IQR_FACTOR * (q3 - q1)
            low, high = q1 - gap, q3 + gap
        records.append({
            "feature": n, "min": F.min(x), "q1": number(q1), "median": number(q2),
            "q3": number(q3), "max": F.max(x), "whisker_low": F.min(F.when(x >= number(low), x)),
            "whisker_high": F.max(F.when(x <= number(high), x)),
            "n_outliers": F.count_if(holds(outside(x, low, high))),
        })
    if not records:
        return rows_from_aggregate(df, records)
    ordered = rows_from_aggregate(df, records).orderBy(F.desc("n_outliers"), "feature")
    return ordered if max_plots is None else ordered.limit(max_plots)


def duplicate_rows(df: DataFrame) -> int:
    """Rows that repeat an earlier identical row."""
    return df.groupBy(*[col(c) for c in df.columns]).count().agg(
        F.coalesce(F.sum(F.col("count") - 1), F.lit(0))).first()[0]


def profile(df: DataFrame, columns: Sequence[str] | None = None,
            exact_distinct: bool = False) -> DataFrame:
    """One row per numeric column: size, missing, distinct, zeros, range, moments, quartiles.

    The distinct count is a sketch unless ``exact_distinct``, which shuffles distinct values.
    """
    names = numeric_columns(df) if columns is None else list(columns)
    quarts = exact_quantiles(df, names, [0.25, 0.5, 0.75])
    x, f = F.col("x"), F.col("feature")
    long = long_form(df, names)
    base = long.groupBy("feature").agg(
        F.count("*").alias("n"), F.count_if(x.isNull()).alias("n_missing"),
        F.count_if(x == 0).alias("n_zero"), F.min(x).alias("min"), F.max(x).alias("max"),
        F.avg(x).alias("mean"), F.stddev(x).alias("std"),
        F.approx_count_distinct(x).alias("n_distinct"),
    )
    if exact_distinct:
        exact = value_histogram(df, names).groupBy("feature").agg(
            F.count("*").alias("n_distinct"))
        base = base.drop("n_distinct").join(exact, "feature", "left").fillna(0, ["n_distinct"])
    return base.select(
        "feature", "n", "n_missing", "n_distinct", "n_zero", "min",
        *[lookup(f, {k: v[i] for k, v in quarts.items()}).alias(q)
          for i, q in enumerate(("q25", "q50", "q75"))],
        "max", "mean", "std",
    )


def profile_warnings(
    profiled: DataFrame, correlations: DataFrame | None = None, missing_share: float = 0.05,
    zero_share: float = 0.1, correlation: float = 0.9,
) -> DataFrame:
    """(warning, feature, other) rows drawn from a profile and an (a, b, r) table."""
    n = F.col("n")
    rules = [
        ("constant", F.col("n_distinct") <= 1),
        ("missing", F.col("n_missing") > n * missing_share),
        ("zeros", F.col("n_zero") > n * zero_share),
    ]
    hits = profiled.select("feature", F.explode(F.filter(
        F.array(*[F.when(cond, F.lit(name)) for name, cond in rules]),
        lambda w: w.isNotNull())).alias("warning"))
    out = hits.select("warning", "feature", F.lit(None).cast("string").alias("other"))
    if correlations is not None:
        pairs = correlations.filter((F.col("a") < F.col("b")) & (F.abs("r") > correlation))
        out = out.unionByName(pairs.select(
            F.lit("high_correlation").alias("warning"), F.col("a").alias("feature"),
            F.col("b").alias("other")))
    return out


def should_write_report(exists: bool, resave: bool) -> bool:
    return resave or not exists


def report_dir(config: Mapping[str, Any], base: str) -> str:
    """Folder of the profile report; a configuration without it is an error."""
    try:
        return f"{base}/{config['output']['eda_report_dir']}"
    except (KeyError, TypeError) as err:
        raise ValueError("configuration lacks output/eda_report_dir") from err


