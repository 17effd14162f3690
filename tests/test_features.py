"""Association, zero tests, trends, transforms, derived features, selection."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabforge.operators import association as assoc
from tabforge.operators import trends, zeros
from tabforge.operators.engineering import FeatureEngineer, FeatureEngineerModel
from tabforge.operators.scaling import StandardScaler
from tabforge.operators.selection import CollinearityModel, CollinearityReducer
from tabforge.operators.transforms import (
    FeatureTransformer, FeatureTransformerModel, allowed_transforms, binary_features,
    choose_transform, named_binary,
)


# ---- association ----

def test_feature_analysis(frame, rng):
    n = 100
    y = rng.normal(40, 8, n)
    data = {"up": y + rng.normal(0, 4, n), "down": -y + rng.normal(0, 4, n),
            "skewed": rng.exponential(size=n), "Category": ["c"] * n, "Strength": y}
    rows = assoc.feature_analysis(frame(data)).collect()
    pdf = pd.DataFrame(data).drop(columns="Category")
    assert [r["feature"] for r in rows][0] == "up" and rows[-1]["feature"] == "down"
    assert rows[0]["spearman_p_value"] == 0.0
    for r in rows:
        x = pdf[r["feature"]].to_numpy()
        d = x - x.mean()
        assert r["pearson_corr"] == pytest.approx(np.corrcoef(x, y)[0, 1])
        assert r["skewness"] == pytest.approx((d**3).mean() / (d**2).mean() ** 1.5)
        assert r["kurtosis"] == pytest.approx((d**4).mean() / (d**2).mean() ** 2 - 3)


def test_feature_analysis_without_target_or_rows(frame):
    df = frame({"a": [1.0, 2.0]}, 1)
    assert assoc.feature_analysis(df).count() == 0
    assert assoc.feature_analysis(df.withColumn("Strength", F.col("a")).limit(0)).count() == 0
    assert assoc.check_multicollinearity(df).columns == ["Feature", "VIF"]


def test_constant_feature_has_no_correlation(frame):
    df = frame({"c": [1.0] * 5, "Strength": [1.0, 2.0, 3.0, 4.0, 5.0]})
    assert assoc.feature_analysis(df).first()["pearson_corr"] is None


def test_vif_table_and_bands(frame, rng):
    a = rng.normal(size=100)
    df = frame({"a": a, "b": a + rng.normal(0, 0.1, 100), "c": rng.normal(size=100),
                "Strength": rng.normal(size=100)})
    rows = assoc.vif_bands(assoc.check_multicollinearity(df)).collect()
    assert [r["VIF"] for r in rows] == sorted((r["VIF"] for r in rows), reverse=True)
    assert {r["Feature"]: r["severity"] for r in rows} == {"a": "high", "b": "high", "c": "none"}


def test_extreme_pairs_and_triangle(frame, rng):
    a = rng.normal(size=80)
    df = frame({"a": a, "b": -a + rng.normal(0, 0.01, 80), "c": rng.normal(size=80)})
    table = assoc.correlation_table(df)
    pairs = assoc.extreme_pairs(table, ["a", "b", "c"], 0.95).collect()
    assert [(r["a"], r["b"]) for r in pairs] == [("a", "b")]
    assert assoc.lower_triangle(table, ["a", "b", "c"]).count() == 3


# ---- zero tests ----

def _welch(a, b):
    va, vb = a.var(ddof=1) / len(a), b.var(ddof=1) / len(b)
    return (b.mean() - a.mean()) / math.sqrt(va + vb)


def test_zero_statistics(frame, rng):
    n = 400
    x = rng.choice([0.0, 50.0, 100.0], n, p=[0.3, 0.4, 0.3])
    y = rng.normal(40, 8, n) + np.where(x > 0, rng.normal(5, 9, n), 0)
    s = zeros.zero_effect_tests(frame({"x": x, "Strength": y}), ["x"], "Strength")["x"]
    a, b = y[x == 0], y[x > 0]
    za, zb = abs(a - np.median(a)), abs(b - np.median(b))
    zc = np.concatenate([za, zb]).mean()
    w = (n - 2) * (len(a) * (za.mean() - zc) ** 2 + len(b) * (zb.mean() - zc) ** 2) / (
        ((za - za.mean()) ** 2).sum() + ((zb - zb.mean()) ** 2).sum())
    assert s["levene"] == pytest.approx(w)
    assert s["test"] == "welch" and s["t"] == pytest.approx(_welch(a, b))
    assert s["significant"]


def test_analyze_zeros_writes_decision(frame, rng):
    n = 200
    x = rng.choice([0.0, 1.0], n)
    data = {"Blast Furnace Slag": x, "Fly Ash": rng.choice([0.0, 1.0], n),
            "Superplasticizer": x, "Strength": rng.normal(40, 1, n) + 5 * x}
    out = zeros.analyze_zeros(frame(data), {"keep": 1, "binary_features": {"other": 2}})
    assert out["keep"] == 1 and out["binary_features"]["other"] == 2
    assert out["binary_features"]["from_zeros"][:1] == ["Blast Furnace Slag"]
    assert "Superplasticizer" in out["binary_features"]["from_zeros"]


def test_encoder(frame, rng):
    n = 200
    x = rng.choice([0.0, 50.0, -1.0], n)
    df = frame({"Blast Furnace Slag": x, "Fly Ash": [1.0] * n,
                "Strength": rng.normal(40, 1, n) + 5 * (x > 0)})
    with pytest.warns(UserWarning):
        model = zeros.ZeroBinaryEncoder().fit(df)
    tests = {r["feature"]: r for r in model.report(df.sparkSession).collect()}
    assert "Sp/C_pct" not in tests
    assert tests["Fly Ash"]["test"] == "insufficient" and tests["Fly Ash"]["p"] == 1.0
    assert tests["Blast Furnace Slag"]["positive_rows"] == (x > 0).sum()
    out = model.transform(df)
    assert {f: r["flag"] for f, r in tests.items()} == {
        "Blast Furnace Slag": "Blast Furnace Slag_binary", "Fly Ash": None}
    assert out.agg(F.sum("Blast Furnace Slag_binary")).first()[0] == (x > 0).sum()


def test_encoder_counts_missing_as_zero(spark):
    rows = [(None, 1.0), (float("nan"), 2.0), (0.0, 3.0), (5.0, 9.0), (6.0, 9.5), (7.0, 8.0)]
    df = spark.createDataFrame(rows, "x double, Strength double")
    s = zeros.group_statistics(df, ["x"], "Strength", True)["x"]
    assert (s["zero_n"], s["positive_n"]) == (3, 3)
    s = zeros.group_statistics(df, ["x"], "Strength", False)["x"]
    assert (s["zero_n"], s["positive_n"]) == (1, 3)


def test_equal_variances_use_student(frame, rng):
    x = np.repeat([0.0, 1.0], 100)
    y = rng.normal(0, 1, 200)
    y[100:] = y[:100] + 0.5
    s = zeros.zero_effect_tests(frame({"x": x, "Strength": y}), ["x"], "Strength")["x"]
    assert s["test"] == "student" and s["df"] == 198


# ---- trends ----

def test_trend_r2_is_the_fit_quality(frame, rng):
    x = np.linspace(1, 10, 50) + rng.normal(0, 0.2, 50)
    y = np.log(x) * 3 + rng.normal(0, 0.3, 50)
    row = trends.trend_metrics(frame({"x": x, "y": y}), ["x"], "y").first()
    for f, c in ((x, "linear_r2_score"), (np.log(x + 1e-10), "log_r2_score"),
                 (np.sqrt(x), "sqrt_r2_score"), (1 / (x + 1e-10), "reciprocal_r2_score"),
                 (x**2, "square_r2_score")):
        fit = np.polyval(np.polyfit(f, y, 1), f)
        assert row[c] == pytest.approx(1 - ((y - fit) ** 2).sum() / ((y - y.mean()) ** 2).sum())
    coef = {r["curve"]: r for r in trends.trend_coefficients(
        frame({"x": x, "y": y}), ["x"], "y").collect()}
    a, b = np.polyfit(x**2, y, 1)
    assert coef["x²"]["slope"] == pytest.approx(a)
    assert coef["x²"]["intercept"] == pytest.approx(b)


def test_undefined_curves(frame):
    df = frame({"neg": [-1.0, 2.0, 3.0], "const": [2.0] * 3, "y": [1.0, 2.0, 4.0]})
    rows = {r["feature"]: r for r in trends.trend_metrics(df, ["neg", "const"], "y").collect()}
    assert rows["neg"]["log_r2_score"] == -math.inf and rows["neg"]["sqrt_r2_score"] == -math.inf
    r = np.corrcoef([-1.0, 2.0, 3.0], [1.0, 2.0, 4.0])[0, 1]
    assert rows["neg"]["linear_r2_score"] == pytest.approx(r * r)
    assert rows["const"]["linear_r2_score"] == 0.0
    renamed = trends.trend_metrics(df, ["neg"], "y", ["Linear", "A", "Sqrt", "1/x", "x²"]).first()
    assert renamed["log_r2_score"] is None


@pytest.mark.parametrize("scores,alpha,best,value", [
    ((0.8, 0.82, 0.7, 0.5, 0.6), 0.2, "Linear", 0.8),
    ((0.5, 0.9, 0.6, 0.4, 0.7), 0.2, "Log", 0.9),
    ((0.7, 0.8, 0.6, 0.4, 0.5), 0.1, "Log", 0.8),
    ((0.7, 0.8, 0.6, 0.4, 0.5), 0.3, "Linear", 0.7),
    ((0.5, 0.9, 0.9, 0.4, 0.9), 0.2, "Log", 0.9),
    ((-math.inf, 0.1, -math.inf, 0.2, -math.inf), 0.2, "1/x", 0.2),
])
def test_alpha_rule(spark, scores, alpha, best, value):
    cols = list(trends.R2_COLUMNS.values())
    df = spark.createDataFrame([("f", *scores)], ["feature", *cols])
    row = trends.select_best(df, alpha).first()
    assert (row["best_transformation"], row["best_r2_score"]) == (best, value)


# ---- transforms ----

@pytest.fixture
def variables(frame, rng):
    n = 100
    age = rng.lognormal(3, 1, n)
    return frame({
        "feature_1": rng.lognormal(1, 1, n), "feature_2": rng.chisquare(5, n),
        "binary_feature": rng.choice([0, 1], n, p=[0.7, 0.3]), "High_x": rng.normal(size=n),
        "Age": age, "Strength": 5 * np.log(age) + rng.normal(0, 0.5, n)})


def test_transformer(variables, tmp_path, spark):
    model = FeatureTransformer(
        names=["Linear", "Log", "Sqrt", "1/x", "square_func"], alpha=0.05).fit(variables)
    assert model.best["Age"] == "Log"
    assert model.best["binary_feature"] == "Linear" and model.best["High_x"] == "Linear"
    assert model.best["feature_1"] != "Log"
    out = model.transform(variables)
    assert out.columns[-1] == "Strength"
    before = variables.select("Age", "binary_feature").toPandas()
    after = out.select("Age", "binary_feature").toPandas()
    np.testing.assert_allclose(np.sort(after["Age"]), np.sort(np.log(before["Age"])))
    assert set(after["binary_feature"]) == {0, 1}
    rows = {r["feature"]: r for r in model.report(spark).collect()}
    assert rows["Age"]["r2_log"] > 0.9 and rows["binary_feature"]["is_binary"]
    assert rows["feature_1"]["r2_log"] is None
    model.write().overwrite().save(str(tmp_path / "t"))
    assert FeatureTransformerModel.load(str(tmp_path / "t")).best == model.best


def test_transformer_skips_gaps_and_needs_target(spark):
    df = spark.createDataFrame([(None, 1.0, 1.0), (2.0, 2.0, 3.0), (3.0, 4.0, 2.0), (5.0, 7.0, 9.0)],
                               "gap double, full double, Strength double")
    model = FeatureTransformer().fit(df)
    assert "gap" not in model.best and "full" in model.best
    with pytest.raises(ValueError):
        FeatureTransformer(targetCol="none").fit(df)


def test_constant_target_falls_back_to_linear(frame):
    df = frame({"x": [1.0, 2.0, 3.0, 4.0], "Strength": [1.0] * 4})
    assert FeatureTransformer().fit(df).best == {"x": "Linear"}


def test_choice_and_names():
    assert choose_transform({"Linear": 0.5, "Sqrt": 0.55}, 0.2) == ("Linear", 0.5)
    assert choose_transform({"Linear": 0.3, "Sqrt": 0.55}, 0.2) == ("Sqrt", 0.55)
    assert choose_transform({"Linear": -math.inf}, 0.2) == ("Linear", -math.inf)
    assert named_binary("Outlier_x") and named_binary("my_flag") and not named_binary("Cement")
    assert "Log" in allowed_transforms("Age") and "Log" not in allowed_transforms("Water")


def test_binary_detection(spark):
    df = spark.createDataFrame(
        [(1, 0.0, None), (2, 5.0, 1.0), (3, 5.0, 2.0)], "three int, two double, gap double")
    got = {r["feature"]: r["is_binary"] for r in binary_features(
        df, ["three", "two", "gap"]).collect()}
    assert got == {"three": False, "two": True, "gap": False}


# ---- derived features ----

def test_feature_engineering(mixture, tmp_path):
    lin = FeatureEngineer(modelType="linear_models").fit(mixture)
    trees = FeatureEngineer(modelType="trees_models").fit(mixture)
    assert len(lin.transform(mixture).columns) == len(mixture.columns) + 3
    assert len(trees.transform(mixture).columns) == len(mixture.columns) + 10
    assert len(lin.descriptions()) == 3 and len(trees.descriptions()) == 10
    pdf = trees.transform(mixture).toPandas()
    low, high = pdf["W/C"].quantile([0.25, 0.75])
    assert (pdf["Low_WC_ratio"] == (pdf["W/C"] < low)).all()
    assert (pdf["High_WC_ratio"] == (pdf["W/C"] > high)).all()
    assert (pdf["High_WC_tech"] == (pdf["W/C"] > 0.6)).all()
    without = FeatureEngineer().fit(mixture.drop("W/C")).transform(mixture.drop("W/C"))
    assert "W/C" in without.columns
    trees.write().overwrite().save(str(tmp_path / "f"))
    assert FeatureEngineerModel.load(str(tmp_path / "f")).fitted == trees.fitted


def test_feature_engineering_guards(frame, mixture):
    with pytest.raises(ValueError):
        FeatureEngineer().fit(mixture.drop("Cement"))
    with pytest.raises(ValueError):
        FeatureEngineer(modelType="regression").fit(mixture)
    zero = frame({c: [1.0, 0.0] for c in (
        "Cement", "Blast Furnace Slag", "Fly Ash", "Coarse Aggregate", "Fine Aggregate", "Water",
        "Superplasticizer")}, 1)
    row = FeatureEngineer().fit(zero).transform(zero).filter("Cement = 0").first()
    assert row["Aggregate_ratio"] == 0.0 and row["Binder_water_ratio"] == 0.0 and row["W/C"] is None


def test_scaler(frame, rng):
    x = rng.normal(5, 3, 60)
    df = frame({"x": x, "c": [2.0] * 60, "Strength": x})
    out = StandardScaler(passCols=["Strength"]).fit(df).transform(df).toPandas()
    assert out["x"].mean() == pytest.approx(0, abs=1e-12)
    assert out["x"].std(ddof=0) == pytest.approx(1)
    assert (out["c"] == 0).all() and out["Strength"].mean() == pytest.approx(x.mean())


# ---- selection ----

@pytest.fixture
def collinear(frame, rng):
    n = 100
    base = rng.normal(size=n)
    return frame({"feature_1": base, "feature_2": base + rng.normal(0, 0.1, n),
                  "feature_3": 2 * base + rng.normal(0, 0.1, n), "feature_4": rng.normal(size=n),
                  "feature_5": rng.normal(size=n), "Water": rng.normal(180, 20, n),
                  "Cement": rng.normal(300, 50, n), "Strength": rng.normal(size=n)})


def test_reducer_respects_cap_and_protection(collinear, tmp_path):
    reducer = CollinearityReducer(vifThreshold=5.0, protected=["Water", "Cement"],
                                  passCols=["Strength"], maxShare=0.3)
    model = reducer.fit(collinear)
    assert len(model.removed) == 2 and not {"Water", "Cement"} & set(model.removed)
    assert set(model.removed) < {"feature_1", "feature_2", "feature_3"}
    assert model.transform(collinear).columns[-1] == "Strength"
    report = {r["feature"]: r for r in model.report(collinear.sparkSession).collect()}
    assert len(report) == 7 and {f for f, r in report.items() if r["removed_by"]} == set(
        model.removed)
    assert {f for f, r in report.items() if r["protected"]} == {"Water", "Cement"}
    rounds = model.rounds(collinear.sparkSession)
    assert [r["feature"] for r in rounds.filter("removed").orderBy("round").collect()] == (
        model.removed)
    assert rounds.filter("round = 2").count() == 6
    model.write().overwrite().save(str(tmp_path / "c"))
    assert CollinearityModel.load(str(tmp_path / "c")).removed == model.removed


def test_reducer_priorities(collinear):
    def first(**kw):
        return CollinearityReducer(vifThreshold=5.0, passCols=["Strength"], maxShare=0.15,
                                   protected=["Water", "Cement"], **kw).fit(collinear).removed
    listed = ["feature_1", "feature_2", "feature_3"]
    assert first(strategy="domain_priority", priority=listed) == ["feature_3"]
    assert first(strategy="domain_priority", priority=listed[1:]) == ["feature_1"]
    assert first(strategy="vif_based")[0] in listed
    std = collinear.agg(*[F.stddev(c).alias(c) for c in listed]).first().asDict()
    assert first(strategy="statistical") == [min(std, key=std.get)]


def test_reducer_drops_extreme_correlation(frame, rng):
    """Below the inflation limit, but correlated beyond the correlation limit."""
    a = rng.normal(size=200)
    df = frame({"a": a, "b": a + rng.normal(0, 0.3, 200), "c": rng.normal(size=200),
                "d": rng.normal(size=200)})
    model = CollinearityReducer(vifThreshold=1000.0, correlationThreshold=0.9, protected=[],
                                priority=["a", "b"]).fit(df)
    assert model.removed == ["b"] and len(model.fitted["extreme_pairs"]) == 1


def test_reducer_without_room(frame, rng):
    df = frame({"a": rng.normal(size=20), "b": rng.normal(size=20)})
    model = CollinearityReducer().fit(df)
    assert model.removed == [] and model.rounds(df.sparkSession).isEmpty()
