"""Session construction for local runs and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "8", app: str = "tabforge", memory: str = "12g") -> SparkSession:
    """Session for tests and the benchmark; on a cluster the caller brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", cores if cores.isdigit() else "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


SPREAD_BELOW = 16


def spread(scan: DataFrame) -> DataFrame:
    """Give a small table one partition per core.

    A small file is often a single row group, which one task reads while the other cores idle.
    Only scans of less than ``SPREAD_BELOW`` splits are redistributed (at most 2 GB with default
    split size); anything larger is left as it lies and never shuffled here.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    if scan.rdd.getNumPartitions() < min(cores, SPREAD_BELOW):
        return scan.repartition(cores)
    return scan


def shared_dir(spark: SparkSession) -> str:
    """Folder that outlives executors, as named by ``spark.checkpoint.dir``.

    Only a local-mode session may go without one; it then gets a temporary folder once.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
    chosen = getattr(spark.sparkContext, "_tabforge_dir", None)
    if chosen is None:
        chosen = tempfile.mkdtemp(prefix="tabforge-")
        spark.sparkContext._tabforge_dir = chosen
    return chosen


def _store(df: DataFrame) -> tuple[DataFrame, str]:
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Used before several passes over the same joined or filtered rows. Compared with a
    cached plan, a lost executor costs no recomputation, and later passes still prune columns.
    The table stays until ``release_all``; see ``temporary`` for a scoped one.
    """
    table, path = _store(df)
    _stored(df.sparkSession).append(path)
    return table


def _stored(spark: SparkSession) -> list[str]:
    context = spark.sparkContext
    if not hasattr(context, "_tabforge_tables"):
        context._tabforge_tables = []
    return context._tabforge_tables


def _delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def temporary(df: DataFrame) -> Iterator[DataFrame]:
    """A materialized table that is deleted when the block ends."""
    table, path = _store(df)
    try:
        yield table
    finally:
        _delete(df.sparkSession, path)


def release_all(spark: SparkSession) -> None:
    """Delete every table this process has materialized; frames that read them become invalid."""
    paths = _stored(spark)
    while paths:
        _delete(spark, paths.pop())
