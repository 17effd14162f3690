"""Column and batch helpers shared by the corpus operators."""

from __future__ import annotations

import shutil
import tempfile
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import tabforge


def whole_text(column: str) -> Column:
    """The text itself; null counts as empty."""
    return F.coalesce(F.col(f"`{column}`").cast("string"), F.lit(""))


def id_remainder(column: str, modulus: int) -> Column:
    """crc32 of an id written as text, modulo ``modulus``; a null id counts as empty text."""
    text = F.coalesce(F.col(f"`{column}`").cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % F.lit(modulus)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Give the executors this package's code, once per application.

    They need not have it installed. The archive is made on the driver, and Spark sends it.
    """
    context = spark.sparkContext
    if getattr(context, "_tabforge_code", None) is None:
        root = Path(next(iter(tabforge.__path__))).parent
        folder = tempfile.mkdtemp(prefix="tabforge-code-")
        for source in (root / "tabforge").rglob("*.py"):
            target = Path(folder, "code", source.relative_to(root))
            target.parent.mkdir(parents=True, exist_ok=True)
            shutil.copyfile(source, target)
        context._tabforge_code = shutil.make_archive(
            str(Path(folder, "tabforge-code")), "zip", Path(folder, "code"))
        context.addPyFile(context._tabforge_code)


def map_arrow(df: DataFrame, function: Callable, schema) -> DataFrame:
    """``mapInArrow`` whose function may use this package on the executors."""
    ship(df.sparkSession)
    return df.mapInArrow(function, schema)


def slices(batches: Iterable[pa.RecordBatch], column: str, most: int) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each holds about ``most`` bytes of ``column``, or one row.

    Arrow batches are bounded by rows, not bytes; this keeps the working memory of a task
    independent of how long the texts are.
    """
    for batch in batches:
        texts = batch.column(batch.schema.get_field_index(column))
        begin, held = 0, 0
        for i, size in enumerate(byte_lengths(texts)):
            if held and held + size > most:
                yield batch.slice(begin, i - begin)
                begin, held = i, 0
            held += size
        if begin < batch.num_rows:
            yield batch.slice(begin)


def byte_lengths(texts: pa.Array) -> list[int]:
    import pyarrow.compute as pc

    return pc.fill_null(pc.binary_length(texts), 0).to_pylist()
