"""Mixture-shaped view over the star-schema test tables, so that every operator can run on them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabforge.sources.readers import read_facts, read_table

KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
FEATURES = [
    "Cement", "Blast Furnace Slag", "Fly Ash", "Water", "Superplasticizer",
    "Coarse Aggregate", "Fine Aggregate", "Age",
]
TARGET = "Strength"


def mix(spark: SparkSession, sf_dir: str, keys: bool = False) -> DataFrame:
    """lineitem with its order and part, renamed and scaled to the mixture columns.

    Both joins are plain equi-joins: the optimizer broadcasts ``part`` or ``orders`` only below its
    size threshold and otherwise sort-merges, where adaptive execution splits skewed keys.
    """
    item = read_facts(spark, sf_dir, "lineitem")
    orders = read_table(spark, sf_dir, "orders")
    part = read_table(spark, sf_dir, "part")
    joined = item.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(
        part, F.col("l_partkey") == F.col("p_partkey"))
    c = F.col
    shown = [c(k) for k in KEYS] if keys else []
    return joined.select(
        *shown,
        (c("l_quantity") * 10 + 150).alias("Cement"),
        (c("l_discount") * 2000).alias("Blast Furnace Slag"),
        F.when(c("p_size") > 20, c("p_size") * 4 - 40).otherwise(0).cast("double").alias("Fly Ash"),
        ((c("p_retailprice") - 900) * 1.5 + 100).alias("Water"),
        (c("l_tax") * 350).alias("Superplasticizer"),
        (c("o_totalprice") / 1000 + 800).alias("Coarse Aggregate"),
        ((c("l_suppkey") % 100) * 4 + 580).cast("double").alias("Fine Aggregate"),
        F.datediff(c("l_shipdate"), c("o_orderdate")).alias("Age"),
        (c("l_extendedprice") / 1000).alias(TARGET),
    )


MIX_SQL = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       l_quantity * 10 + 150 AS "Cement",
       l_discount * 2000 AS "Blast Furnace Slag",
       CAST(CASE WHEN p_size > 20 THEN p_size * 4 - 40 ELSE 0 END AS DOUBLE) AS "Fly Ash",
       (p_retailprice - 900) * CAST(1.5 AS DOUBLE) + 100 AS "Water",
       l_tax * 350 AS "Superplasticizer",
       o_totalprice / 1000 + 800 AS "Coarse Aggregate",
       CAST((l_suppkey % 100) * 4 + 580 AS DOUBLE) AS "Fine Aggregate",
       CAST(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS INTEGER) AS "Age",
       l_extendedprice / 1000 AS "Strength"
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
"""
