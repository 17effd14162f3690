"""Exact deduplication by skew-safe combining, in DataFrame operations only.

Every map task first combines equal texts of its own split. The survivors meet per
(digest, salt), where the salt names a group of map tasks, and the winners of the salts
meet per digest. All three steps group by the text besides its digest, so two texts are
merged only if they are identical, whatever the digest. A text that fills a third of the
table reaches a reducer once per map task of a salt, and the last step once per salt.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabforge.llm.common import whole_text
from tabforge.session import materialize


def sha256_hex(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def winners(docs: DataFrame, id_col: str, text: Column, digest: Callable[[Column], Column],
            salts: int) -> DataFrame:
    """One row per distinct text: digest, text, keep_id (largest id), group_size."""
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), text.alias("text"))
    rows = rows.select("id", "text", digest(F.col("text")).alias("digest"),
                       F.pmod(F.spark_partition_id(), F.lit(salts)).alias("salt"))
    salted = rows.groupBy("digest", "salt", "text").agg(
        F.max("id").alias("id"), F.count("*").alias("n"))
    return salted.groupBy("digest", "text").agg(
        F.max("id").alias("keep_id"), F.sum("n").alias("group_size"))


def exact_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    normalise: Callable[[Column], Column] = lambda text: text,
    digest: Callable[[Column], Column] = sha256_hex, salts: int = 64,
) -> DataFrame:
    """Each document with the one that stays for its text.

    Returns doc_id, keep_id, group_size, kept, digest, one row per input row. Of equal texts
    (after ``normalise``) the row with the largest id stays.

    Null text counts as empty, so null and empty texts form one group. A repeated row counts
    and is returned as often as it occurs, with the same mark. A null id never wins over
    another id; if a group has only null ids, they stay. Other columns are not read, so their
    names cannot clash. An empty table gives an empty result.
    """
    text = normalise(whole_text(text_col))
    whole = winners(docs, id_col, text, digest, salts)
    # Only the digests are kept for marking rows; the texts need not be stored.
    won = materialize(whole.select("digest", "keep_id", "group_size"))
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), text.alias("text"))
    rows = rows.withColumn("digest", digest(F.col("text")))
    shared = won.groupBy("digest").count().filter("count > 1")
    if shared.isEmpty():
        marked = rows.drop("text").join(won, "digest")
    else:  # different texts under one digest: tell them apart by the text itself
        marked = rows.join(whole, ["digest", "text"])
    return marked.select(
        "doc_id", "keep_id", F.col("group_size").cast("long").alias("group_size"),
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "digest")


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                **options) -> DataFrame:
    """The documents that stay, with all their columns; repeated rows of a kept id stay."""
    kept = exact_duplicates(docs, id_col, text_col, **options).filter("kept")
    kept = kept.select(F.col("doc_id").alias("__keep")).distinct()
    return docs.join(kept, F.col(f"`{id_col}`").eqNullSafe(F.col("__keep")), "left_semi")
