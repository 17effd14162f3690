"""Association of features with the target and with each other."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabforge.functions.gram import gram, vif_centred, vif_uncentred
from tabforge.functions.pvalues import correlation_p
from tabforge.functions.ranks import spearman
from tabforge.functions.scalar import as_double, col, long_form, numeric_columns

ANALYSIS_SCHEMA = (
    "feature string, pearson_corr double, spearman_corr double, spearman_p_value double, "
    "skewness double, kurtosis double")


def pearson(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """(feature, n, pearson_corr, skewness, kurtosis) in one pass; NULL for constants.

    Skewness and excess kurtosis are the biased moment ratios.
    """
    y, x = F.col("__y"), F.col("x")
    table = df.withColumn("__y", as_double(target))
    both = F.when(x.isNotNull() & y.isNotNull(), x)
    ys = F.when(x.isNotNull() & y.isNotNull(), y)
    spread = F.stddev_pop(both) * F.stddev_pop(ys)
    return long_form(table, list(features), ["__y"]).groupBy("feature").agg(
        F.count(both).alias("n"),
        F.when(spread > 0, F.covar_pop(both, ys) / spread).alias("pearson_corr"),
        F.skewness(x).alias("skewness"),
        F.kurtosis(x).alias("kurtosis"),
    )


def feature_analysis(df: DataFrame, target: str = "Strength",
                     features: Sequence[str] | None = None) -> DataFrame:
    """Pearson, Spearman with p-value, skewness and kurtosis per feature, by Spearman desc.

    Without the target column, or without rows, the result is empty.
    """
    spark = df.sparkSession
    if target not in df.columns:
        return spark.createDataFrame([], ANALYSIS_SCHEMA)
    names = list(features) if features is not None else numeric_columns(df, [target])
    if not names:
        return spark.createDataFrame([], ANALYSIS_SCHEMA)
    ranked = {r["feature"]: r for r in spearman(df, names, target).collect()}
    moments = {r["feature"]: r for r in pearson(df, names, target).collect()}
    rows = []
    for name in names:
        m, s = moments.get(name), ranked.get(name)
        if m is None:
            continue
        rho = s["spearman"] if s else None
        p = correlation_p(rho, s["n"] if s else 0)
        rows.append((name, m["pearson_corr"], rho, None if p != p else round(p, 4),
                     m["skewness"], m["kurtosis"]))
    return spark.createDataFrame(rows, ANALYSIS_SCHEMA).orderBy(
        F.desc_nulls_last("spearman_corr"), "feature")


def correlation_table(source: DataFrame, features: Sequence[str] | None = None) -> DataFrame:
    """Pearson matrix in long form (a, b, r), both triangles and the diagonal.

    Each pair uses the rows in which both are present; NULL beside a constant column.
    """
    names = list(features) if features is not None else numeric_columns(source)
    rows = source.select(*[as_double(c).alias(f"x{i}") for i, c in enumerate(names)])
    pairs = [(i, j) for i in range(len(names)) for j in range(i + 1, len(names))]
    if not names:
        return source.sparkSession.createDataFrame([], "a string, b string, r double")
    found = rows.agg(*[F.min(f"x{i}") < F.max(f"x{i}") for i in range(len(names))],
                     *[F.corr(f"x{i}", f"x{j}") for i, j in pairs]).first()
    varies, r = found[:len(names)], dict(zip(pairs, found[len(names):]))
    cells = []
    for i, a in enumerate(names):
        for j, b in enumerate(names):
            value = 1.0 if i == j else r[min(i, j), max(i, j)]
            known = varies[i] and varies[j] and value is not None and value == value
            cells.append((a, b, float(value) if known else None))
    return source.sparkSession.createDataFrame(cells, "a string, b string, r double")


def lower_triangle(correlations: DataFrame, order: Sequence[str]) -> DataFrame:
    """The cells a heat map shows: row below column in the given feature order."""
    at = {name: i for i, name in enumerate(order)}
    position = F.create_map(*[F.lit(v) for kv in at.items() for v in kv])
    return correlations.filter(position[F.col("a")] > position[F.col("b")])


def _vif_table(spark, scores: Mapping[str, float]) -> DataFrame:
    rows = [(n, None if v != v else float(v)) for n, v in scores.items()]
    return spark.createDataFrame(rows, "Feature string, VIF double").orderBy(
        F.desc_nulls_last("VIF"), "Feature")


def check_multicollinearity(df: DataFrame, target: str = "Strength",
                            features: Sequence[str] | None = None) -> DataFrame:
    """(Feature, VIF) of the regressions with intercept, highest first."""
    if target not in df.columns:
        return df.sparkSession.createDataFrame([], "Feature string, VIF double")
    names = list(features) if features is not None else numeric_columns(df, [target])
    return _vif_table(df.sparkSession, vif_centred(gram(df, names)))


def vif_without_intercept(df: DataFrame, features: Sequence[str]) -> DataFrame:
    return _vif_table(df.sparkSession, vif_uncentred(gram(df, list(features))))


def vif_bands(vifs: DataFrame, high: float = 10, medium: float = 5) -> DataFrame:
    """Severity per feature: 'high' from ``high`` up, 'medium' from ``medium``, else 'none'."""
    v = col("VIF")
    return vifs.withColumn(
        "severity", F.when(v >= high, "high").when(v >= medium, "medium").otherwise("none"))


def extreme_pairs(correlations: DataFrame, order: Sequence[str], threshold: float) -> DataFrame:
    """Pairs (a before b in the feature order) whose absolute correlation exceeds the threshold."""
    at = {name: i for i, name in enumerate(order)}
    position = F.create_map(*[F.lit(v) for kv in at.items() for v in kv])
    return correlations.filter(
        (position[F.col("a")] < position[F.col("b")]) & (F.abs("r") > threshold))
