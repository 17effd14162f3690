"""Connected components of an edge table, on the executors."""

from __future__ import annotations

from contextlib import ExitStack

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabforge.session import materialize, temporary


def _large_star(edges: DataFrame) -> DataFrame:
    """Hang each larger neighbour of u on the smallest of u and its neighbours."""
    both = edges.union(edges.select("v", "u")).toDF("u", "v")
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    return both.join(least, "u").filter("v > u").select(
        F.col("v").alias("u"), F.least("u", "m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Hang the smaller neighbours of u, and u, on the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), "m")
    return moved.union(least.select("u", "m")).toDF("u", "v")


def connected_components(edges: DataFrame) -> DataFrame:
    """(id, component), component being the smallest id reachable; the smallest have no row.

    ``edges`` has the ids in its two columns; directions, repeats and loops do not matter.
    Minima are combined before they are shuffled, and a hub's edges meet its minimum in a join
    that adaptive execution can split, so a hub may hold a third of the edges. Rounds grow
    with the logarithm of the longest path; only two numbers per round reach the driver.
    """
    a, b = (F.col(f"`{c}`") for c in edges.columns)
    now = edges.select(a.alias("u"), b.alias("v")).filter("u <> v").distinct()
    seen = None
    with ExitStack() as last:
        table = last.enter_context(temporary(now))
        while True:
            held = ExitStack()
            stars = _small_star(_large_star(table).distinct()).distinct()
            stars = held.enter_context(temporary(stars))
            mark = tuple(stars.agg(
                F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
            last.close()
            last, table = held, stars
            if mark == seen:
                result = table.select(F.col("u").alias("id"), F.col("v").alias("component"))
                return _kept(result, last)
            seen = mark


def _kept(result: DataFrame, stack: ExitStack) -> DataFrame:
    """Store the result under the session's tables before its sources go."""
    with stack:
        return materialize(result)
