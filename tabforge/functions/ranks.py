"""Average ranks and Spearman correlation without a global sort in one partition.

A plain ``Window.orderBy`` over a whole column puts every row into one task. Ranks only
depend on the distinct values and their counts, so the column is first counted by value
(combined map-side: a value that fills a third of the table becomes one row). That histogram is
dealt to value ranges by Spark's range partitioning and stored; ranges are numbered in the
order of their values, so a range's offset is the sum of the sizes before it, and positions are
accumulated inside ranges only. The same plan serves every size.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tabforge.functions.scalar import as_double, col
from tabforge.session import materialize


def value_histogram(df: DataFrame, features: Sequence[str],
                    sums: Mapping[str, Column] | None = None) -> DataFrame:
    """(feature, value, cnt, <sums>) for all values that are not missing."""
    sums = sums or {}
    kept = df.select(*[as_double(f).alias(f) for f in features],
                     *[e.alias(n) for n, e in sums.items()])
    cells = kept.unpivot([F.col(n) for n in sums], [col(f) for f in features], "feature", "value")
    return cells.filter(F.col("value").isNotNull()).groupBy("feature", "value").agg(
        F.count("*").alias("cnt"), *[F.sum(n).alias(n) for n in sums])


def with_positions(histogram: DataFrame) -> DataFrame:
    """Add ``avg_rank``, the mean of the tied positions of a value, starting at 1."""
    dealt = materialize(histogram.repartitionByRange("feature", "value").withColumn(
        "part", F.spark_partition_id()))
    # One row per feature and range: as many as there are ranges, whatever the table's size.
    sizes = dealt.groupBy("feature", "part").agg(F.sum("cnt").alias("size"))
    before = F.sum("size").over(W.partitionBy("feature").orderBy("part")) - F.col("size")
    offsets = sizes.select("feature", "part", before.alias("offset"))
    inside = W.partitionBy("feature", "part").orderBy("value")
    upto = F.sum("cnt").over(inside)
    located = dealt.withColumn("upto", upto).join(offsets, ["feature", "part"])
    last = F.col("upto") + F.col("offset")
    return located.withColumn("avg_rank", (last - F.col("cnt") + 1 + last) / F.lit(2.0)).drop(
        "part", "upto", "offset")


def ranked_values(df: DataFrame, features: Sequence[str],
                  sums: Mapping[str, Column] | None = None) -> DataFrame:
    """Distinct values per feature: (feature, value, cnt, avg_rank, <sums>).

    ``sums`` adds sums of other columns of ``df`` over the rows that carry the value.
    """
    return with_positions(value_histogram(df, features, sums)).select(
        "feature", "value", "cnt", "avg_rank", *(sums or {}))


def _spearman_of(rows: DataFrame, features: Sequence[str], target: str, n: int) -> DataFrame:
    """Correlations of features that are present in all of the ``n`` rows.

    Only the target's rank is joined back to rows. Each feature needs no join: rows with equal
    feature value share its rank, so it is enough to sum the target's ranks per value.
    """
    mid = (n + 1) / 2.0
    by_target = ranked_values(rows, [target]).select(
        F.col("value").alias("__y"), (F.col("avg_rank") - mid).alias("__ry"))
    # No hint: small target domains are broadcast by size, otherwise sort-merge with AQE
    # splitting a target value that dominates.
    ranked = rows.join(by_target, col(target) == F.col("__y")).drop("__y")
    values = ranked_values(ranked, features, {
        "sy": F.col("__ry"), "syy": F.col("__ry") * F.col("__ry")})
    rx = F.col("avg_rank") - mid
    sums = values.groupBy("feature").agg(
        F.sum("cnt").alias("n"),
        F.sum(rx * F.col("sy")).alias("sxy"),
        F.sum(rx * rx * F.col("cnt")).alias("sxx"),
        F.sum("syy").alias("syy"),
    )
    scale = F.sqrt(F.col("sxx") * F.col("syy"))
    return sums.select(
        "feature", "n", F.when(scale > 0, F.col("sxy") / scale).alias("spearman"))


def spearman(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """(feature, n, spearman), each feature over the rows where it and the target are present.

    Features without a gap share one ranking of the target; a feature with gaps has its own,
    over its own rows.
    """
    features = list(features)
    rows = df.select(*[as_double(c).alias(c) for c in dict.fromkeys([*features, target])])
    rows = rows.filter(col(target).isNotNull())
    counts = rows.agg(F.count("*"), *[F.count(col(f)) for f in features]).first()
    n, present = counts[0], dict(zip(features, counts[1:]))
    whole = [f for f in features if present[f] == n]
    parts = [_spearman_of(rows.select(*[col(c) for c in dict.fromkeys([*whole, target])]),
                          whole, target, n)] if whole and n else []
    for f in features:
        if f not in whole and present[f]:
            own = rows.select(col(f), col(target)).filter(col(f).isNotNull())
            parts.append(_spearman_of(own, [f], target, present[f]))
    if not parts:
        return df.sparkSession.createDataFrame([], "feature string, n long, spearman double")
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
