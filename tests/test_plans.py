"""Pipelines, folds, sweep, tuning, ensembles, sources and sinks."""

import math
from datetime import datetime

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tabforge.config import default_config
from tabforge.operators.clean import add_ratios, clean
from tabforge.operators.engineering import FeatureEngineer
from tabforge.operators.outliers import OutlierHandler
from tabforge.operators.selection import CollinearityReducer, UninformativeRemover
from tabforge.operators.zeros import ZeroBinaryEncoder
from tabforge.plans import ensembles as ens
from tabforge.plans import experiments as exp
from tabforge.plans import folds as fo
from tabforge.plans import models as mo
from tabforge.plans import preparation as prep
from tabforge.plans import tuning
from tabforge.session import materialize, shared_dir, temporary
from tabforge.sources import readers, writers


@pytest.fixture
def regression(frame, rng):
    """Vector-ready rows whose target is linear plus noise."""
    n = 300
    x = rng.normal(size=(n, 4))
    x = (x - x.mean(0)) / x.std(0)
    y = 20 + x @ np.array([9.0, -5.0, 1.0, 0.0]) + rng.normal(0, 3, n)
    df = frame({"row_id": np.arange(n), **{f"x{i}": x[:, i] for i in range(4)}, "y": y})
    return df, x, y


def vectors(df):
    from pyspark.ml.feature import VectorAssembler
    return VectorAssembler(inputCols=[f"x{i}" for i in range(4)], outputCol="features").transform(df)


def coordinate_descent(x, y, alpha, rho):
    w, yc, n = np.zeros(x.shape[1]), y - y.mean(), len(y)
    for _ in range(5000):
        for j in range(x.shape[1]):
            z = x[:, j] @ (yc - x @ w + x[:, j] * w[j]) / n
            w[j] = np.sign(z) * max(abs(z) - alpha * rho, 0) / (
                (x[:, j] ** 2).mean() + alpha * (1 - rho))
    return w


@pytest.mark.parametrize("alpha,rho", [(1.0, 1.0), (1.0, 0.5), (0.3, 0.1)])
def test_penalties_match_coordinate_descent(regression, alpha, rho):
    df, x, y = regression
    model = mo.PenalizedRegression(alpha=alpha, l1Ratio=rho, labelCol="y").fit(vectors(df))
    np.testing.assert_allclose(
        model.coefficients.toArray(), coordinate_descent(x, y, alpha, rho), atol=1e-5)


def test_ridge_matches_closed_form(regression):
    df, x, y = regression
    for alpha in (0.0, 1.0, 50.0):
        model = mo.PenalizedRegression(alpha=alpha, labelCol="y").fit(vectors(df))
        want = np.linalg.solve(x.T @ x + alpha * np.eye(4), x.T @ (y - y.mean()))
        np.testing.assert_allclose(model.coefficients.toArray(), want, atol=1e-8)
        assert model.intercept == pytest.approx(y.mean() - want @ x.mean(0), abs=1e-6)


def test_repeats_put_other_rows_together(spark):
    rows = spark.range(3000).select(F.col("id").alias("row_id"))
    folds = fo.with_folds(rows, ["row_id"], 6, 5, arithmetic=True).toPandas()
    names = fo.fold_columns(5)
    for i, a in enumerate(names):
        sizes = folds[a].value_counts()
        assert len(sizes) == 6 and sizes.max() < 1.2 * sizes.min()
        for b in names[:i]:
            # Rows of one fold spread over all folds of another repeat.
            assert (folds.groupby([a, b]).size().unstack() > 30).to_numpy().all()


def test_linear_cv_gram_uses_all_predictors(spark, sf):
    from tabforge.plans import catalog as c
    folds = fo.fold_columns(5)
    rows = fo.with_folds(c.table(spark, sf), c.KEYS, k=6, repeats=5, arithmetic=True).select(
        *[f"`{n}`" for n in (*c.PREDICTORS, c.TARGET)], *folds).toPandas().dropna()
    assert {"W/C", "Sp/C_pct"} < set(c.PREDICTORS)
    x = np.column_stack([np.ones(len(rows)), rows[c.PREDICTORS].to_numpy(float)])
    y, rmse = rows[c.TARGET].to_numpy(float), []
    for name in folds:
        for f in range(6):
            out = rows[name].to_numpy() == f
            b = np.linalg.lstsq(x[~out], y[~out], rcond=None)[0]
            rmse.append(np.sqrt(np.mean((y[out] - x[out] @ b) ** 2)))
    got = {r.alpha: r.mean_rmse for r in c.linear_cv_gram(spark, sf).collect()}
    assert got[0.0] == pytest.approx(np.mean(rmse), rel=1e-6)


def test_linear_cv_leaves_incomplete_rows_out(spark):
    rows = [(i, float(i % 7) if i % 5 else None, 2.0 * (i % 7) + (i % 3)) for i in range(300)]
    df = fo.with_folds(spark.createDataFrame(rows, "row_id long, x double, y double"), ["row_id"], 3)
    whole = fo.linear_cv(df.dropna(), ["x"], "y", ["fold_0"], 3)
    assert fo.linear_cv(df, ["x"], "y", ["fold_0"], 3)[0.0] == pytest.approx(whole[0.0])
    with pytest.raises(ValueError):
        fo.linear_cv(df.filter("fold_0 <> 1"), ["x"], "y", ["fold_0"], 3)


def test_best_of_an_empty_report(spark):
    with pytest.raises(ValueError):
        exp.best_model_strategy(spark.createDataFrame([], exp.REPORT_SCHEMA))
    with pytest.raises(ValueError):
        exp.best_model_strategy(spark.createDataFrame([("m",)], "model_name string"))


def test_folds_are_stable_and_cover(regression):
    df = regression[0]
    a = fo.with_folds(df, ["row_id"], 6, 5)
    b = fo.with_folds(df.repartition(7), ["row_id"], 6, 5)
    assert a.select("row_id", *fo.fold_columns(5)).exceptAll(
        b.select("row_id", *fo.fold_columns(5))).count() == 0
    counts = [r["count"] for r in a.groupBy("fold_0").count().collect()]
    assert len(counts) == 6 and sum(counts) == 300 and min(counts) > 20
    assert a.filter("fold_0 != fold_1").count() > 100


def test_gram_cv_equals_refitting(regression):
    """All fold fits from one pass against fitting every fold by itself."""
    df, x, y = regression
    table = fo.with_folds(df, ["row_id"], 3, 2)
    got = fo.linear_cv(table, [f"x{i}" for i in range(4)], "y", fo.fold_columns(2), 3, (0.0, 10.0))
    pdf = table.toPandas()
    for alpha in (0.0, 10.0):
        want = []
        for c in fo.fold_columns(2):
            for k in range(3):
                tr, te = pdf[pdf[c] != k], pdf[pdf[c] == k]
                cols = [f"x{i}" for i in range(4)]
                mu, sd = tr[cols].mean().to_numpy(), tr[cols].std(ddof=0).to_numpy()
                z = (tr[cols].to_numpy() - mu) / sd
                w = np.linalg.solve(z.T @ z + alpha * np.eye(4), z.T @ (tr.y - tr.y.mean()))
                p = tr.y.mean() + ((te[cols].to_numpy() - mu) / sd) @ w
                want.append(math.sqrt(((te.y - p) ** 2).mean()))
        np.testing.assert_allclose(sorted(got[alpha]), sorted(want), rtol=1e-9)


def test_cross_validate_matches_gram_and_isolates_failures(regression):
    df = regression[0]
    table = materialize(vectors(fo.with_folds(df, ["row_id"], 3)).drop("row_id"))
    pool = mo.regressors("y")
    broken = mo.PenalizedRegression(labelCol="nothing")
    scores = fo.cross_validate(table, "y", fo.fold_columns(1), 3,
                               {"ok": pool["LinearRegression"], "broken": broken})
    want = fo.linear_cv(table, [f"x{i}" for i in range(4)], "y", fo.fold_columns(1), 3)[0.0]
    np.testing.assert_allclose(sorted(scores["ok"].rmse), sorted(want), rtol=1e-6)
    assert scores["broken"].error and not scores["broken"].rmse
    assert fo.scores_table(df.sparkSession, scores).count() == 1


def test_full_pipeline_round_trip(mixture, tmp_path):
    pool = mo.regressors("Strength")
    model = mo.full_pipeline("trees_models", pool["Ridge"], "Strength", keep=["row_id"]).fit(mixture)
    out = model.transform(mixture)
    assert out.count() == 200 and out.filter(F.col("prediction").isNull()).count() == 0
    path = writers.save_tuned(model, "Ridge", 6.50149, str(tmp_path))
    assert path.endswith("Ridge_6_5015")
    again = writers.load_tuned(path).transform(mixture)
    a = out.select("row_id", F.round("prediction", 9)).collect()
    assert sorted(a) == sorted(again.select("row_id", F.round("prediction", 9)).collect())
    writers.save_submission(out, str(tmp_path / "sub"), "row_id", "Strength")
    sub = mixture.sparkSession.read.csv(str(tmp_path / "sub"), header=True)
    assert sub.columns == ["row_id", "Strength"] and sub.count() == 200


def test_feature_chain_keeps_rows(mixture):
    handler = OutlierHandler(strategies=["abnormal"], config=default_config(),
                             targetCol="Strength", keyCols=["row_id"])
    model = handler.fit(mixture)
    df = model.transform(mixture)
    n = 200 - model.summary(mixture)["removed_rows"]
    for stage in (FeatureEngineer(), ZeroBinaryEncoder(),
                  UninformativeRemover(passCols=["row_id", "Strength"]),
                  CollinearityReducer(vifThreshold=15.0, passCols=["row_id", "Strength"])):
        df = stage.fit(df).transform(df)
        assert df.count() == n
    assert "Water" in df.columns and "Cement" in df.columns
    bad = df.filter(" OR ".join(f"`{c}` IS NULL OR isnan(`{c}`)" for c in df.columns))
    assert bad.count() == 0


def test_transform_works_on_a_stream(spark, mixture, tmp_path):
    """Fitted stages are row-local, so the same model scores a stream."""
    mixture.write.parquet(str(tmp_path / "in"))
    model = mo.preprocessing("linear_models", "Strength", vector=False,
                             keep=["row_id"]).fit(mixture)
    stream = spark.readStream.schema(mixture.schema).parquet(str(tmp_path / "in"))
    run = (model.transform(stream).writeStream.format("memory").queryName("scored")
           .trigger(availableNow=True).start())
    run.awaitTermination(60)
    assert spark.table("scored").count() == 200


def test_experiments_and_best(mixture, tmp_path):
    pool = mo.regressors("Strength")
    models = {"Ridge": pool["Ridge"], "Broken": mo.PenalizedRegression(labelCol="nothing")}
    report = exp.run_experiments(
        mixture, ["row_id"], "Strength", [["gost_binar", "combine"], ["abnormal"]],
        ["linear_models"], models, default_config(), k=2, repeats=1)
    rows = report.collect()
    assert len(rows) == 2 and {r["model_name"] for r in rows} == {"Ridge"}
    assert rows[0]["mean_rmse"] <= rows[1]["mean_rmse"]
    path = writers.save_experiment_report(report, str(tmp_path))
    again = readers.load_experiment_report(mixture.sparkSession, path)
    assert again.count() == 2 and again.schema == report.schema
    best = exp.best_model_strategy(again)
    assert best["rmse"] == rows[0]["mean_rmse"]
    assert exp.strategy_array(again).schema["outlier_strategy"].dataType.simpleString() == (
        "array<string>")
    model, kept, _ = exp.fit_best(mixture, best, models, default_config(), "Strength", ["row_id"])
    paths = writers.save_best_pipeline(model, rows[0].asDict(), default_config(), str(tmp_path))
    assert isinstance(PipelineModel.load(paths["pipeline"]), PipelineModel)
    saved = writers.save_without_outliers(kept, "Strength", str(tmp_path))
    assert mixture.sparkSession.read.parquet(saved["target"]).count() == kept.count()


def test_best_row_and_strategy_text(spark):
    rows = [("['abnormal']", "ModelA", "t", 1, 1.5, 0.1, 1.0, None),
            ("['gost_binar', 'combine']", "ModelB", "t", 1, 1.2, 0.1, 1.0, None),
            ("['abnormal']", "ModelC", "t", 1, 2.0, 0.1, 1.0, None)]
    report = spark.createDataFrame(rows, readers.REPORT_SCHEMA)
    best = exp.best_model_strategy(report)
    assert best["model"] == "ModelB"
    assert exp.parse_strategy(best["outlier_strategy"]) == ["gost_binar", "combine"]
    assert exp.parse_strategy("['abnormal']") == ["abnormal"]
    with pytest.raises(FileNotFoundError):
        readers.load_experiment_report(spark, "/tmp/none-such.csv")


def test_grid():
    grid = exp.experiment_grid(exp.SWEEP_STRATEGIES, ["linear_models", "trees_models"],
                               list(mo.regressors("y")))
    assert set(mo.FAMILY_PRESET.values()) == set(mo.BOOSTING_PRESETS)
    assert len(grid) == 100 and grid[0] == (["abnormal"], "linear_models", "RandomForestRegressor")


@pytest.mark.parametrize("rows,features,expected", [
    (1000, 5, ["LinearRegression", "Ridge", "Lasso", "RandomForestRegressor",
               "GradientBoostingRegressor", "XGBRegressor", "LGBMRegressor",
               "DecisionTreeRegressor"]),
    (10, 5, ["DecisionTreeRegressor"]),
    (100, 5, ["LinearRegression", "Ridge", "Lasso", "DecisionTreeRegressor"]),
])
def test_nepv_regression(spark, rows, features, expected):
    assert mo.check_models_by_nepv(spark.range(rows), features, "regression") == expected


def test_nepv_classification(frame):
    df = frame({"y": [0] * 100 + [1] * 50})
    assert mo.check_models_by_nepv(df, 2, "classif", "y") == [
        "LogisticRegression", "DecisionTreeClassifier"]
    assert mo.check_models_by_nepv(frame({"y": [0] * 10 + [1] * 2}), 2, "classif", "y") == [
        "DecisionTreeClassifier"]
    with pytest.raises(ValueError):
        mo.check_models_by_nepv(df, 2, "ranking")


def test_sampler():
    space = {"a": {"type": "suggest_int", "low": 3, "high": 5},
             "b": {"type": "suggest_float", "low": 0.1, "high": 100.0, "log": True},
             "c": {"type": "suggest_float", "low": 0.5, "high": 0.6},
             "d": {"type": "suggest_categorical", "choices": ["x", "y"]}}
    draws = tuning.sample_space(space, 200, 7)
    assert draws == tuning.sample_space(space, 200, 7) != tuning.sample_space(space, 200, 8)
    assert {d["a"] for d in draws} == {3, 4, 5} and {d["d"] for d in draws} == {"x", "y"}
    assert all(0.1 <= d["b"] <= 100 and 0.5 <= d["c"] <= 0.6 for d in draws)
    assert np.median([d["b"] for d in draws]) < 12
    with pytest.raises(ValueError):
        tuning.sample_space({"a": {"type": "other", "low": 0, "high": 1}}, 1)


def test_families(caplog):
    for family, params in (
        ("xgboost", {"n_estimators": 20, "max_depth": 4, "learning_rate": 0.1, "subsample": 0.8,
                     "colsample_bytree": 0.7, "gamma": 0.1}),
        ("lightgbm", {"n_estimators": 20, "min_child_samples": 7}),
        ("catboost", {"iterations": 15, "depth": 5, "border_count": 64}),
        ("randomforest", {"n_estimators": 10, "max_depth": 50, "max_features": "sqrt"}),
        ("ridge", {"alpha": 3.0, "fit_intercept": False}),
    ):
        built = tuning.build_regressor(family, params, "y")
        assert built.getOrDefault("labelCol") == "y"
        if family == "randomforest":
            assert built.getMaxDepth() == tuning.MAX_DEPTH
    tuning.build_regressor("ridge", {"solver": "svd"}, "y")
    assert "solver" in caplog.text
    with pytest.raises(ValueError):
        tuning.build_regressor("unknown", {}, "y")


def test_tuning_finds_the_weak_penalty(regression):
    df = regression[0]
    table = materialize(vectors(fo.with_folds(df, ["row_id"], 2)).select("features", "y", "fold_0"))
    study = tuning.tune(table, "y", ["fold_0"], 2,
                        {"alpha": {"type": "suggest_categorical", "choices": [0.1, 100000.0]}},
                        lambda p: tuning.build_regressor("ridge", p, "y"), n_trials=6, seed=1)
    assert study.best.params["alpha"] == 0.1
    assert study.table(df.sparkSession).first()["trial"] == study.best.number
    assert tuning.improvement(4.0, 3.0) == (1.0, 25.0)


def test_voting(regression):
    df = vectors(regression[0])
    pool = mo.regressors("y", rounds=2)
    bases = {"a": pool["LinearRegression"], "b": pool["Lasso"], "c": pool["gbt_d3_s01"]}
    out = ens.voting(bases, ens.WEIGHTS_THREE).fit(df).transform(df)
    want = out.select((F.col("__p0") * 0.45 + F.col("__p1") * 0.35 + F.col("__p2") * 0.2).alias("w"),
                      "prediction")
    assert want.filter(F.abs(F.col("w") - F.col("prediction")) > 1e-9).count() == 0
    with pytest.raises(ValueError):
        ens.voting(bases, [1.0])
    assert set(ens.ensemble_set(bases, "y")) == {
        "voting_equal", "voting_weighted", "voting_weighted_2", "stacking_ridge", "stacking_linear"}


def test_stacking_prefers_the_better_base(regression, tmp_path):
    df = vectors(regression[0])
    pool = mo.regressors("y", rounds=1)
    constant = mo.PenalizedRegression(alpha=1000.0, l1Ratio=1.0, labelCol="y")
    model = ens.Stacking(bases={"good": pool["LinearRegression"], "flat": constant}, targetCol="y",
                         k=3, final=pool["Ridge"]).fit(df)
    rmse = fo.rmse_of(model.transform(df), "y")
    assert rmse == pytest.approx(fo.rmse_of(pool["LinearRegression"].fit(df).transform(df), "y"),
                                 rel=0.02)
    model.write().overwrite().save(str(tmp_path / "stack"))
    again = PipelineModel.load(str(tmp_path / "stack")).transform(df)
    assert fo.rmse_of(again, "y") == pytest.approx(rmse)


# ---- sources and sinks ----

RAW = """Id,Cement,Blast Furnace Slag,Fly Ash,Water,Superplasticizer,Coarse Aggregate,Fine Aggregate,Age
1,200 ,0 ,10.5 ,100 ,2 ,900.5 ,700 ,28
2,100 ,5 ,0 ,50 ,1 ,901 ,701 ,7
3,200 ,0 ,10.5 ,100 ,2 ,900.5 ,700 ,28
"""


def _config(tmp_path):
    return {"data": {"raw_dir": str(tmp_path), "processed_dir": str(tmp_path / "out"),
                     "test_file": "test.csv", "train_file": "train.csv"},
            "processed_files": {"test_file": {"parquet": "eda_data_test.parquet"}}}


def test_raw_to_prepared(spark, tmp_path):
    (tmp_path / "test.csv").write_text(RAW)
    config = _config(tmp_path)
    raw = readers.load_raw(spark, "test", config)
    assert raw.count() == 3 and dict(raw.dtypes)["Age"] == "int"
    df = add_ratios(clean(raw))
    assert df.count() == 2 and df.columns[-2:] == ["W/C", "Sp/C_pct"]
    paths = writers.save_prepared(df, "test", config["data"]["processed_dir"])
    again = readers.load_prepared(spark, "test", config)
    assert again.exceptAll(df).count() == 0 and df.exceptAll(again).count() == 0
    text = readers.read_csv(spark, paths["csv"])
    assert text.count() == 2 and sorted(text.columns) == sorted(df.columns)
    assert dict(readers.read_csv(spark, str(tmp_path / "test.csv")).dtypes)["Age"] == "int"


def test_reader_errors(spark, tmp_path):
    with pytest.raises(ValueError):
        readers.load_raw(spark, "validation", _config(tmp_path))
    with pytest.raises(FileNotFoundError):
        readers.load_raw(spark, "train", _config(tmp_path))
    with pytest.raises(FileNotFoundError):
        readers.load_prepared(spark, "test", _config(tmp_path))
    with pytest.raises(ValueError):
        writers.save_prepared(spark.range(1), "other", str(tmp_path))


def test_report_file_name(spark, tmp_path):
    path = writers.save_report(spark.range(2), str(tmp_path), now=datetime(2024, 5, 6, 7, 8))
    assert path.endswith("eda_outliers_2024_05_06_07-08.csv")
    assert spark.read.csv(path, header=True).count() == 2


def test_shared_dir_is_the_configured_one(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        assert shared_dir(spark) == configured.rstrip("/")
    else:
        assert shared_dir(spark) == shared_dir(spark)


def test_temporary_table_is_deleted(spark):
    with temporary(spark.range(5)) as table:
        assert table.count() == 5
        folder = table.inputFiles()[0].rsplit("/", 1)[0]
    with pytest.raises(FileNotFoundError):
        readers.require(spark, folder)


def test_vectors_survive_materialize(spark):
    df = spark.createDataFrame([(Vectors.dense([1.0, 2.0]), 1.0)], ["features", "y"])
    assert materialize(df).first()["features"] == Vectors.dense([1.0, 2.0])


def test_profile_and_clean(mixture):
    raw = mixture.drop("W/C", "Sp/C_pct").withColumnRenamed("row_id", "Id")
    raw = raw.unionByName(raw.limit(20).withColumn("Id", F.col("Id") + 1000))
    done = prep.profile_and_clean(raw, default_config())
    assert done.table.count() == 200 and "Id" not in done.table.columns
    assert done.reports["missing"].count() == 0
    for name in ("describe", "outliers"):
        assert done.reports[name].count() == 11
    for name in ("analysis", "trends", "vif"):
        assert done.reports[name].count() == 10
    assert "from_zeros" in done.config["binary_features"]
    assert done.models == ["DecisionTreeRegressor"]


def test_compare_strategies_reports_errors(mixture):
    rows = {r["strategy"]: r for r in prep.compare_strategies(
        mixture, default_config(), "Strength", ["row_id"],
        [["abnormal"], ["gost_remove"]]).collect()}
    assert rows["abnormal"]["error"] is None and rows["abnormal"]["engineered"] == 10
    assert rows["abnormal"]["final_features"] > 3
    broken = prep.compare_strategies(mixture.drop("Cement"), default_config(), "Strength",
                                     ["row_id"], [["abnormal"]]).first()
    assert "Cement" in broken["error"] and broken["final_features"] is None
