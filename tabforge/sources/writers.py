"""Sinks: prepared tables, reports, fitted models and score files."""

from __future__ import annotations

import json
from collections.abc import Mapping
from datetime import datetime
from typing import Any

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabforge.functions.scalar import col

# Table names in the output folder.
PREPARED_NAMES = {"train": "eda_data_train", "test": "eda_data_test"}
OUTLIER_FREE_TABLE = "data_train_outliers"
TARGET_TABLE = "y_train_outliers"
REPORT_NAME = "modeling_experiments.csv"


def _write_pair(df: DataFrame, base: str) -> dict[str, str]:
    """Snappy Parquet as the working format, CSV next to it for reading by hand."""
    paths = {"parquet": f"{base}.parquet", "csv": f"{base}.csv"}
    df.write.mode("overwrite").option("compression", "snappy").parquet(paths["parquet"])
    written = df.sparkSession.read.schema(df.schema).parquet(paths["parquet"])
    written.write.mode("overwrite").option("header", True).option("encoding", "UTF-8").csv(
        paths["csv"])
    return paths


def save_prepared(df: DataFrame, data_type: str, out_dir: str) -> dict[str, str]:
    if data_type not in PREPARED_NAMES:
        raise ValueError(f"unknown data type {data_type!r}")
    return _write_pair(df, f"{out_dir}/{PREPARED_NAMES[data_type]}")


def save_without_outliers(df: DataFrame, target: str, out_dir: str) -> dict[str, str]:
    """Feature table plus the target as a table of its own."""
    paths = _write_pair(df, f"{out_dir}/{OUTLIER_FREE_TABLE}")
    paths["target"] = f"{out_dir}/{TARGET_TABLE}.parquet"
    df.select(col(target)).write.mode("overwrite").parquet(paths["target"])
    return paths


def save_report(report: DataFrame, out_dir: str, prefix: str = "eda_outliers",
                now: datetime | None = None) -> str:
    """One-row-per-feature report as a single CSV file with a minute stamp in its name."""
    stamp = (now or datetime.now()).strftime("%Y_%m_%d_%H-%M")
    path = f"{out_dir}/{prefix}_{stamp}.csv"
    report.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
    return path


def save_experiment_report(report: DataFrame, out_dir: str) -> str:
    path = f"{out_dir}/{REPORT_NAME}"
    report.orderBy("mean_rmse").coalesce(1).write.mode("overwrite").option("header", True).csv(path)
    return path


def save_best_pipeline(
    model: PipelineModel, best: Mapping[str, Any], config: Mapping[str, Any], out_dir: str,
) -> dict[str, str]:
    """Fitted pipeline, and beside it one JSON row: the report's row, the time and the settings."""
    name = best["model_name"]
    paths = {
        "pipeline": f"{out_dir}/best_pipeline_{name}",
        "metadata": f"{out_dir}/pipeline_metadata_{name}",
    }
    model.write().overwrite().save(paths["pipeline"])
    spark = SparkSession.active()
    row = {f"report_{k}": v for k, v in best.items()}
    row |= {"saved_at": datetime.now().isoformat(timespec="seconds"), "settings": dict(config)}
    spark.createDataFrame([(json.dumps(row, ensure_ascii=False),)], "value string").coalesce(
        1).write.mode("overwrite").text(paths["metadata"])
    return paths


def save_tuned(model: PipelineModel, name: str, rmse: float, out_dir: str) -> str:
    """Model folder whose name carries the score, dots replaced."""
    score = f"{rmse:.4f}".replace(".", "_")
    path = f"{out_dir}/{name}_{score}"
    model.write().overwrite().save(path)
    return path


def load_tuned(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def submission(scored: DataFrame, id_col: str, target: str, prediction: str = "prediction") -> DataFrame:
    return scored.select(col(id_col), F.col(prediction).alias(target))


def save_submission(scored: DataFrame, path: str, id_col: str, target: str) -> None:
    submission(scored, id_col, target).write.mode("overwrite").option("header", True).csv(path)
