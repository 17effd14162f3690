"""Typed readers for the mixture tables, prepared tables and experiment reports."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tabforge.functions.scalar import nan_to_null
from tabforge.session import spread

# Columns of the raw input files.
MIX_SCHEMA = T.StructType(
    [
        T.StructField("Id", T.IntegerType()),
        T.StructField("Cement", T.DoubleType()),
        T.StructField("Blast Furnace Slag", T.DoubleType()),
        T.StructField("Fly Ash", T.DoubleType()),
        T.StructField("Water", T.DoubleType()),
        T.StructField("Superplasticizer", T.DoubleType()),
        T.StructField("Coarse Aggregate", T.DoubleType()),
        T.StructField("Fine Aggregate", T.DoubleType()),
        T.StructField("Age", T.IntegerType()),
    ]
)
TARGET = "Strength"

REPORT_SCHEMA = T.StructType(
    [
        T.StructField("outlier_strategy", T.StringType()),
        T.StructField("model_name", T.StringType()),
        T.StructField("model_type", T.StringType()),
        T.StructField("dataset_size", T.LongType()),
        T.StructField("mean_rmse", T.DoubleType()),
        T.StructField("std_rmse", T.DoubleType()),
        T.StructField("training_time_sec", T.DoubleType()),
        T.StructField("memory_used_mb", T.DoubleType()),
    ]
)
KINDS = ("train", "test")


def _kind(data_type: str) -> str:
    if data_type not in KINDS:
        raise ValueError(f"unknown data type {data_type!r}, expected one of {KINDS}")
    return data_type


def require(spark: SparkSession, path: str) -> str:
    """The path, if it exists on whatever file system it names."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(target):
        raise FileNotFoundError(path)
    return path


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """CSV with header; cells may carry blanks. Without a schema the types are inferred."""
    reader = spark.read.option("header", True).option("ignoreLeadingWhiteSpace", True).option(
        "ignoreTrailingWhiteSpace", True)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return nan_to_null(reader.csv(path))


def load_raw(spark: SparkSession, data_type: str, config: Mapping[str, Any]) -> DataFrame:
    """Raw train or test file as named by the configuration."""
    data = config["data"]
    path = require(spark, f"{data['raw_dir']}/{data[_kind(data_type) + '_file']}")
    schema = MIX_SCHEMA
    if data_type == "train":
        schema = T.StructType([*MIX_SCHEMA.fields, T.StructField(TARGET, T.DoubleType())])
    return read_csv(spark, path, schema)


def load_prepared(spark: SparkSession, data_type: str, config: Mapping[str, Any]) -> DataFrame:
    """Prepared Parquet table written by ``save_prepared``."""
    name = config["processed_files"][_kind(data_type) + "_file"]["parquet"]
    path = require(spark, f"{config['data']['processed_dir']}/{name}")
    return spark.read.parquet(path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_facts(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table that is read for computing, spread over the cores when it is small."""
    return spread(read_table(spark, sf_dir, name))


def load_experiment_report(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(require(spark, path), header=True, schema=REPORT_SCHEMA)
