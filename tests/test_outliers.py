"""Outlier policies: row removal, flags, summaries, persistence."""

import numpy as np
import pytest

from tabforge.config import default_config
from tabforge.operators.outliers import OutlierHandler, OutlierModel, limits

CONFIG = {
    "standard_value": {
        "cement": {"min": 200, "max": 600}, "water": {"min": 120, "max": 220},
        "fine_aggregate": {"min": 600, "max": 800}, "sp_c_pct": {"min": 0.005, "max": 0.025},
    },
    "abnormal_value": {"sp_c_pct": 0.07, "fine_aggregate": 970},
}


@pytest.fixture
def table(frame, rng):
    n = 100
    data = {
        "row_id": np.arange(n), "Cement": rng.normal(300, 50, n), "Water": rng.normal(180, 20, n),
        "Fine Aggregate": np.clip(rng.normal(700, 100, n), 500, 960),
        "Sp/C_pct": np.clip(rng.normal(0.015, 0.005, n), 0, 0.06),
        "Age": rng.normal(28, 10, n), "Strength": rng.normal(40, 10, n),
    }
    data["Sp/C_pct"][10] = 0.1
    data["Fine Aggregate"][20] = 1000
    data["Cement"][30] = 50
    data["Water"][40] = 300
    return frame(data)


def handle(*strategies, config=CONFIG):
    return OutlierHandler(strategies=list(strategies), config=config, targetCol="Strength",
                          keyCols=["row_id"])


def ids(df):
    return {r["row_id"] for r in df.select("row_id").collect()}


def test_abnormal_removes_planted_rows(table):
    model = handle("abnormal").fit(table)
    assert ids(table) - ids(model.transform(table)) == {10, 20}
    assert ids(model.removed(table)) == {10, 20}
    summary = model.summary(table)
    assert summary["removed_rows"] == 2 and summary["strategies_applied"] == ["abnormal: 2 rows"]
    assert summary["original_shape"] == (100, 7) and summary["final_shape"] == (98, 7)


def test_limits_are_strict_only_where_meant(frame):
    df = frame({"row_id": [0, 1], "Sp/C_pct": [0.07, 0.01], "Fine Aggregate": [700.0, 970.0],
                "Strength": [1.0, 2.0]}, 1)
    assert ids(handle("abnormal").fit(df).transform(df)) == {1}
    assert ids(handle("combine").fit(df).transform(df)) == set()


def test_combine_flags_before_removal(table):
    model = handle("combine").fit(table)
    out = model.transform(table)
    assert {"High_SP", "High_FA"} <= set(out.columns) and ids(table) - ids(out) == {10, 20}
    pdf = table.toPandas()
    summary = model.summary(table)
    assert summary["outliers_by_feature"]["High_SP"][0]["count"] == (pdf["Sp/C_pct"] >= 0.025).sum()
    assert summary["binary_features_created"] == ["High_SP", "High_FA"]


def test_range_flags_and_removal(table):
    pdf = table.toPandas()
    bad = ((pdf["Cement"] < 200) | (pdf["Cement"] > 600) | (pdf["Water"] < 120)
           | (pdf["Water"] > 220) | (pdf["Fine Aggregate"] < 600) | (pdf["Fine Aggregate"] > 800)
           | (pdf["Sp/C_pct"] < 0.005) | (pdf["Sp/C_pct"] > 0.025))
    flags = handle("gost_binar").fit(table).transform(table)
    assert flags.count() == 100
    assert {c for c in flags.columns if c.startswith("Outlier_")} == {
        "Outlier_cement", "Outlier_water", "Outlier_fine_aggregate", "Outlier_sp_c_pct"}
    kept = handle("gost_remove").fit(table).transform(table)
    assert ids(kept) == set(pdf.row_id[~bad])


def test_iqr_remove_uses_fences_of_the_fit_table(table):
    pdf = table.toPandas().drop(columns=["Strength"])
    bad = np.zeros(len(pdf), bool)
    for c in pdf.columns.drop("row_id"):
        q1, q3 = pdf[c].quantile([0.25, 0.75])
        bad |= (pdf[c] < q1 - 1.5 * (q3 - q1)) | (pdf[c] > q3 + 1.5 * (q3 - q1))
    model = handle("abnormal", "iqr_remove").fit(table)
    assert ids(model.transform(table)) == set(pdf.row_id[~bad]) - {10, 20}
    part = table.filter("row_id < 50")
    assert ids(model.transform(part)) == ids(model.transform(table)) & ids(part)


def test_chain_counts_only_surviving_rows(table):
    summary = handle("gost_binar", "combine", "abnormal").fit(table).summary(table)
    assert summary["removed_rows"] == 2
    assert summary["outliers_by_feature"]["Fine Aggregate"][0]["count"] == 0
    assert summary["strategies_applied"] == ["combine: 2 rows"]


def test_missing_values_are_kept(spark):
    df = spark.createDataFrame(
        [(0, None, 700.0), (1, float("nan"), 1000.0), (2, 0.2, None), (3, 0.01, None)],
        "row_id int, `Sp/C_pct` double, `Fine Aggregate` double")
    model = OutlierHandler(strategies=["abnormal", "gost_remove", "combine"], config=CONFIG,
                           keyCols=["row_id"]).fit(df)
    assert ids(model.transform(df)) == {0, 3}


def test_unknown_strategy_is_skipped(table, caplog):
    out = handle("nonsense").fit(table).transform(table)
    assert out.count() == 100 and "nonsense" in caplog.text


def test_transform_needs_fit(table):
    with pytest.raises(ValueError):
        OutlierModel().transform(table)


def test_default_limits():
    lim = limits({})
    assert (lim["sp_critical"], lim["fa_critical"]) == (0.07, 970)
    assert (lim["sp_warning"], lim["fa_warning"]) == (0.025, 800)
    assert limits(default_config())["ranges"]["water"] == {"min": 120, "max": 220}


def test_names_and_target(table):
    model = handle("gost_remove", config=default_config()).fit(table)
    assert model.feature_names_out() == ["Cement", "Water", "Fine Aggregate", "Sp/C_pct", "Age"]
    assert all(r.label != "strength" for s in model.steps(table.columns) for r in s.drops)


def test_persistence(table, tmp_path):
    model = handle("iqr_remove", "combine").fit(table)
    model.write().overwrite().save(str(tmp_path / "m"))
    again = OutlierModel.load(str(tmp_path / "m"))
    assert again.fitted == model.fitted
    assert ids(again.transform(table)) == ids(model.transform(table))
    handle("combine").write().overwrite().save(str(tmp_path / "e"))
    assert OutlierHandler.load(str(tmp_path / "e")).fit(table).fitted["strategies"] == ["combine"]
