"""Scalar expressions, quantiles, ranks, cross products and p-values."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabforge.functions.fold_quantiles import training_quantiles
from tabforge.functions import quantiles as q
from tabforge.functions import ranks
from tabforge.functions.gram import gram, vif_centred, vif_uncentred
from tabforge.functions.pvalues import correlation_p, f_upper, incomplete_beta, t_two_sided
from tabforge.functions.scalar import CURVES, TRANSFORMS, nan_to_null, numeric_columns, ratio


def test_numeric_columns_skip_text(frame):
    df = frame({"a": [1, 2], "b": [0.5, 1.5], "c": ["x", "y"]})
    assert numeric_columns(df) == ["a", "b"]
    assert numeric_columns(df, ["a"]) == ["b"]


def test_nan_becomes_null(frame):
    df = nan_to_null(frame({"a": [1.0, math.nan], "b": [1, 2]}, 1))
    assert df.filter(F.col("a").isNull()).count() == 1


def test_ratio_guards_zero(frame):
    df = frame({"n": [1.0, 2.0], "d": [0.0, 4.0]}, 1)
    got = [r[0] for r in df.select(ratio(F.col("n"), F.col("d"))).collect()]
    assert sorted(got, key=str) == sorted([None, 0.5], key=str)
    assert df.select(ratio(F.col("n"), F.col("d"), 0.0).alias("r")).agg(F.sum("r")).first()[0] == 0.5


def test_transforms_clamp_and_keep_null(spark):
    df = spark.createDataFrame([(-4.0,), (0.0,), (2.0,), (None,)], "x double")
    rows = df.select("x", *[b(F.col("x")).alias(n) for n, b in TRANSFORMS.items()]).collect()
    got = {r["x"]: r for r in rows}
    assert got[-4.0]["Log"] == pytest.approx(math.log(1e-8))
    assert got[-4.0]["Sqrt"] == 0.0
    assert got[-4.0]["1/x"] == 0.25
    assert got[0.0]["1/x"] == pytest.approx(1e8)
    assert got[2.0]["x²"] == 4.0
    assert all(got[None][n] is None for n in TRANSFORMS)


def test_curves_are_undefined_on_negatives(spark):
    df = spark.createDataFrame([(-4.0,), (0.0,)], "x double")
    rows = {r["x"]: r for r in df.select(
        "x", *[b(F.col("x")).alias(n) for n, b in CURVES.items()]).collect()}
    assert rows[-4.0]["Log"] is None and rows[-4.0]["Sqrt"] is None
    assert rows[0.0]["Log"] == pytest.approx(math.log(1e-10))
    assert rows[0.0]["1/x"] == pytest.approx(1e10)


PROBS = [0.0, 0.013, 0.25, 0.5, 0.75, 0.99, 1.0]


@pytest.mark.parametrize("limit", [200_000, 300, 1])
def test_quantiles_match_pandas(frame, rng, limit):
    """Fetch at once, narrow in rounds, and a value with half of the rows."""
    n = 3000
    data = {
        "smooth": rng.normal(size=n),
        "hot": np.where(rng.random(n) < 0.5, 7.0, rng.normal(7, 1, n)),
        "few": rng.integers(-2, 3, n).astype(float),
        "constant": np.full(n, 3.25),
        "gaps": np.where(rng.random(n) < 0.3, np.nan, rng.exponential(size=n)),
    }
    got = q.exact_quantiles(frame(data, 5), list(data), PROBS, limit=limit)
    want = pd.DataFrame(data).quantile(PROBS)
    for c in data:
        np.testing.assert_allclose(got[c], want[c].to_numpy(), rtol=1e-12, atol=1e-12)


@pytest.mark.parametrize("limit", [100_000, 1])
def test_quantiles_of_neighbouring_and_infinite_values(frame, limit):
    inf = math.inf
    data = {
        "rounded": [0.3, 0.1 + 0.2] * 50,
        "next": [1.0, math.nextafter(1.0, 2), math.nextafter(1.0, 0), -0.0, 0.0] * 20,
        "ends": [-inf, inf, 1.0, 2.0, inf] * 20,
        "hot": [5.0] * 40 + [float(i) for i in range(60)],
    }
    got = q.exact_quantiles(frame(data), list(data), [0.0, 0.3, 0.5, 0.9, 1.0], limit=limit)
    want = pd.DataFrame(data)
    for c in ("rounded", "next", "hot"):
        assert got[c] == pytest.approx(list(want[c].quantile([0.0, 0.3, 0.5, 0.9, 1.0])), abs=1e-15)
    assert got["ends"] == [-inf, 1.0, 2.0, inf, inf]


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([(None, 1.0)], "a double, b double")
    assert q.exact_quantiles(df, ["a", "b"], [0.25]) == {"a": [None], "b": [1.0]}
    assert q.exact_quantiles(df.limit(0), ["a"], [0.25]) == {"a": [None]}


@pytest.fixture(params=[3, 40])
def ranges(request, spark):
    """Number of ranges that a histogram is dealt to."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", request.param)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield request.param
    spark.conf.set("spark.sql.shuffle.partitions", before)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_average_ranks(frame, rng, ranges):
    n = 1000
    data = {"hot": np.where(rng.random(n) < 0.4, 0.0, rng.normal(size=n)),
            "ties": rng.integers(0, 5, n).astype(float)}
    got = ranks.ranked_values(frame(data, 4), ["hot", "ties"]).toPandas()
    for c, values in data.items():
        part = got[got.feature == c].sort_values("value")
        want = pd.DataFrame({"v": values, "r": pd.Series(values).rank()}).drop_duplicates()
        want = want.sort_values("v")
        np.testing.assert_array_equal(part["value"], want["v"])
        np.testing.assert_allclose(part["avg_rank"], want["r"])
        assert part["cnt"].sum() == n


def test_spearman_matches_pandas(frame, rng, ranges):
    n = 600
    y = np.where(rng.random(n) < 0.35, 1.0, rng.normal(size=n))
    data = {"a": y + rng.normal(size=n), "b": rng.integers(0, 4, n).astype(float),
            "c": np.full(n, 2.0), "gaps": np.where(rng.random(n) < 0.3, np.nan, y * y), "y": y}
    names = ["a", "b", "c", "gaps"]
    got = {r["feature"]: r for r in ranks.spearman(frame(data), names, "y").collect()}
    table = pd.DataFrame(data)
    for c in ("a", "b", "gaps"):
        pair = table[[c, "y"]].dropna()
        assert got[c]["n"] == len(pair)
        assert got[c]["spearman"] == pytest.approx(pair.rank().corr().iloc[0, 1], abs=1e-12)
    assert got["c"]["spearman"] is None and got["a"]["n"] == n


def test_spearman_of_nothing(spark):
    empty = spark.createDataFrame([], "a double, y double")
    assert ranks.spearman(empty, ["a"], "y").count() == 0
    gone = spark.createDataFrame([(None, 1.0), (None, 2.0)], "a double, y double")
    assert ranks.spearman(gone, ["a"], "y").count() == 0


def test_ranks_use_no_global_window(spark, frame, rng):
    df = ranks.ranked_values(frame({"a": rng.normal(size=50)}), ["a"])
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in text and "percentile" not in text.lower()


@pytest.mark.parametrize("limit", [100_000, 20])
def test_quantiles_of_training_sets(frame, rng, limit):
    n, k = 900, 3
    data = {"x": rng.normal(size=n), "hot": np.where(rng.random(n) < 0.4, 7.0, rng.random(n)),
            "gaps": np.where(rng.random(n) < 0.5, np.nan, rng.random(n)),
            "f0": rng.integers(0, k, n), "f1": np.arange(n) % (k + 1)}
    names = ["x", "hot", "gaps"]
    got = training_quantiles(frame(data), {c: F.col(c) for c in names},
                             {"x": [0.25, 0.75], "hot": [0.5], "gaps": [0.0, 0.9, 1.0]},
                             ["f0", "f1"], k, limit)
    for (c, r, f), values in got.items():
        inside = np.array(data[c])[np.array(data[r]) != f]
        probs = {"x": [0.25, 0.75], "hot": [0.5], "gaps": [0.0, 0.9, 1.0]}[c]
        np.testing.assert_allclose(values, np.nanquantile(inside, probs), rtol=1e-12)
    assert len(got) == len(names) * 2 * k


def test_training_quantiles_of_nothing(spark):
    df = spark.createDataFrame([(None, 0), (1.0, 1)], "x double, f int")
    got = training_quantiles(df, {"x": F.col("x")}, {"x": [0.5]}, ["f"], 2)
    assert got == {("x", "f", 0): [1.0], ("x", "f", 1): [None]}


def _vif_by_regression(x, i, intercept):
    rest = np.delete(x, i, axis=1)
    if intercept:
        rest = np.column_stack([np.ones(len(x)), rest])
    fit = rest @ np.linalg.lstsq(rest, x[:, i], rcond=None)[0]
    centre = x[:, i].mean() if intercept else 0.0
    left = ((x[:, i] - fit) ** 2).sum() / ((x[:, i] - centre) ** 2).sum()
    return 1 / left


def test_vif_matches_least_squares(frame, rng):
    n = 300
    base = rng.normal(5, 1, n)
    x = np.column_stack([base, base + rng.normal(0, 0.1, n), rng.normal(2, 1, n),
                         rng.uniform(size=n)])
    g = gram(frame({f"f{i}": x[:, i] for i in range(4)}), [f"f{i}" for i in range(4)])
    with_c, without = vif_centred(g), vif_uncentred(g)
    for i in range(4):
        assert with_c[f"f{i}"] == pytest.approx(_vif_by_regression(x, i, True), rel=1e-6)
        assert without[f"f{i}"] == pytest.approx(_vif_by_regression(x, i, False), rel=1e-6)


def test_many_columns_use_the_vector_kernel(frame, rng):
    x = rng.normal(100, 5, (150, 15))
    x[:, 14] = 3.0
    names = [f"f{i}" for i in range(15)]
    g = gram(frame({n: x[:, i] for i, n in enumerate(names)}), names)
    d = x - x.mean(0)
    np.testing.assert_allclose(g.centred, d.T @ d, atol=1e-6)


def test_vif_extremes(frame, rng):
    x1 = rng.normal(size=50)
    df = frame({"x1": x1, "x2": x1, "x3": 2 * x1, "x4": rng.normal(size=50)})
    scores = vif_centred(gram(df, ["x1", "x2", "x3", "x4"]))
    assert math.isinf(scores["x1"]) and scores["x4"] < 10
    single = gram(frame({"Cement": [100.0, 200.0, 300.0, 400.0, 500.0]}), ["Cement"])
    assert vif_centred(single) == {"Cement": 1.0}


def test_uncentred_vif_sees_hidden_constant(frame, rng):
    """Two complementary flags add up to one, so the third column's model has an intercept."""
    a = rng.integers(0, 2, 200).astype(float)
    x = rng.normal(10, 1, 200)
    g = gram(frame({"a": a, "b": 1 - a, "x": x}), ["a", "b", "x"])
    groups = np.column_stack([a, 1 - a])
    fit = groups @ np.linalg.lstsq(groups, x, rcond=None)[0]
    want = ((x - x.mean()) ** 2).sum() / ((x - fit) ** 2).sum()
    assert vif_uncentred(g)["x"] == pytest.approx(want, rel=1e-6)


def test_gram_has_no_expression_per_pair(frame, rng, monkeypatch):
    """Pairs of 24 columns as aggregates made a method too long to be compiled."""
    x = rng.normal(size=(60, 24)) + 1e6
    x[::7, 3] = np.nan
    df = frame({f"f{i}": x[:, i] for i in range(24)})
    asked = []
    agg = type(df).agg
    monkeypatch.setattr(type(df), "agg", lambda d, *e: asked.extend(e) or agg(d, *e))
    g = gram(df, df.columns)
    whole = x[~np.isnan(x).any(axis=1)]
    assert len(asked) <= 2 * 24 and g.n == len(whole)
    assert np.allclose(g.means, whole.mean(axis=0))
    assert np.allclose(g.centred, (whole - whole.mean(axis=0)).T @ (whole - whole.mean(axis=0)))


def test_gram_of_no_complete_row(frame):
    g = gram(frame({"a": [1.0, float("nan")], "b": [float("nan"), 2.0]}), ["a", "b"])
    assert g.n == 0 and not g.centred.any() and not g.means.any()


def test_gram_statistics(frame, rng):
    x = rng.normal(1000, 1, (200, 3))
    x[:, 2] = 4.0
    g = gram(frame({f"f{i}": x[:, i] for i in range(3)}), ["f0", "f1", "f2"])
    np.testing.assert_allclose(g.std()[:2], x[:, :2].std(axis=0, ddof=1), rtol=1e-9)
    r = g.correlation()
    assert r[0, 1] == pytest.approx(np.corrcoef(x[:, 0], x[:, 1])[0, 1], abs=1e-9)
    assert math.isnan(r[0, 2])
    np.testing.assert_allclose(g.raw, x.T @ x, rtol=1e-12)


def test_p_values_agree_with_the_jvm(spark):
    dist = spark._jvm.org.apache.commons.math3.distribution
    for t, df in ((0.3, 4), (2.5, 17.3), (-4.0, 998), (1.96, 1e6)):
        want = 2 * dist.TDistribution(float(df)).cumulativeProbability(-abs(float(t)))
        assert t_two_sided(t, df) == pytest.approx(want, rel=1e-7)
    for f, d1, d2 in ((0.2, 1, 8), (4.1, 1, 98), (9.0, 3, 1e5)):
        want = 1 - dist.FDistribution(float(d1), float(d2)).cumulativeProbability(float(f))
        assert f_upper(f, d1, d2) == pytest.approx(want, rel=1e-7)


def test_p_value_edges():
    assert incomplete_beta(2, 3, 0) == 0 and incomplete_beta(2, 3, 1) == 1
    assert incomplete_beta(1, 1, 0.3) == pytest.approx(0.3)
    assert t_two_sided(0.0, 10) == pytest.approx(1.0)
    assert correlation_p(1.0, 10) == 0.0
    assert math.isnan(correlation_p(None, 10))
