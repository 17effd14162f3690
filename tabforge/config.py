"""Threshold configuration: defaults, YAML loading and key normalisation."""

from __future__ import annotations

import json
from collections.abc import Mapping
from typing import Any

import yaml
from pyspark.sql import SparkSession

# Published default limits per measured quantity and the critical limits.
STANDARD_RANGES = {
    "age": {"min": 1, "max": 365},
    "cement": {"min": 200, "max": 600},
    "coarse_aggregate": {"min": 1000, "max": 1300},
    "fine_aggregate": {"min": 600, "max": 800},
    "fly_ash": {"min": 0, "max": 200},
    "sp_c_pct": {"min": 0.005, "max": 0.025},
    "strength": {"min": 5, "max": 100},
    "w_c": {"min": 0.3, "max": 0.7},
    "water": {"min": 120, "max": 220},
}
CRITICAL_LIMITS = {"sp_c_pct": 0.07, "fine_aggregate": 970}

# Accepted column spellings for each configuration key.
COLUMN_ALIASES = {
    "age": ("Age", "age"),
    "cement": ("Cement", "cement"),
    "coarse_aggregate": ("Coarse Aggregate", "CoarseAggregate", "coarse_aggregate"),
    "fine_aggregate": ("Fine Aggregate", "FineAggregate", "fine_aggregate"),
    "fly_ash": ("Fly Ash", "FlyAsh", "fly_ash"),
    "sp_c_pct": ("Sp/C_pct", "Superplasticizer_pct", "sp_c_pct"),
    "strength": ("Strength", "strength"),
    "w_c": ("W/C", "Water_Cement_Ratio", "w_c"),
    "water": ("Water", "water"),
}

# Curve names in the order the selection rule breaks ties.
TREND_NAMES = ("Linear", "Log", "Sqrt", "1/x", "x²")


def default_config() -> dict[str, Any]:
    return {
        "standard_value": {k: dict(v) for k, v in STANDARD_RANGES.items()},
        "abnormal_value": dict(CRITICAL_LIMITS),
        "trend_settings": {"names": list(TREND_NAMES)},
        "task_type": "regression",
        "cross_validation": {"n_splits": 5, "n_repeats": 5, "random_state": 42},
    }


def load_config(path: str) -> dict[str, Any]:
    """Read a YAML file; a missing file raises FileNotFoundError, bad YAML ValueError."""
    with open(path, encoding="utf-8") as handle:
        try:
            return yaml.safe_load(handle)
        except yaml.YAMLError as err:
            raise ValueError(f"{path} is not valid YAML: {err}") from err


def save_decisions(spark: SparkSession, config: Mapping[str, Any], path: str) -> None:
    """Store a configuration (for instance with test decisions added) as one JSON document."""
    row = [(json.dumps(config, ensure_ascii=False),)]
    spark.createDataFrame(row, "value string").coalesce(1).write.mode("overwrite").text(path)


def load_decisions(spark: SparkSession, path: str) -> dict[str, Any]:
    return json.loads(spark.read.text(path, wholetext=True).first()["value"])


def config_key(column: str) -> str:
    return column.lower().replace(" ", "_").replace("/", "_")


def matching_column(columns: list[str], key: str) -> str | None:
    """Column of the table that a configuration key stands for, or None."""
    for name in (key, *COLUMN_ALIASES.get(key, ())):
        if name in columns:
            return name
    return None
