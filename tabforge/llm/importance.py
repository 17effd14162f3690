"""Importance resampling towards a target distribution.

Words come from an untrained regex split of the tokenizers library over ASCII-lowered text,
with their offsets. Features are windows of one to three consecutive words, from the start of
the first to the end of the last, and only their CRC bucket is kept: the CRC of a window is put
together from those of its words, for a whole block of documents at a time. Histograms of the
buckets in the raw documents and in the target give each bucket a gain, a document's weight is
the sum of its gains, and a seeded Gumbel draw keeps the highest scores.

Chunks between white space are split once per task as long as its word table has room, since
white space never belongs to a word; the table is emptied when full, so a task's memory
depends on its block and not on the table.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from functools import cache, lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tabforge.llm.common import map_arrow, slices, whole_text
from tabforge.session import materialize

# What words consist of, and the reflected polynomial of CRC-32.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
POLYNOMIAL = 0xEDB88320

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
BLOCK_BYTES = 4 << 20
MOST_CHUNKS = 300_000
FEATURES = "doc_id long, n_words long, n_features long, buckets binary"


# ---- CRC of joined parts ----------------------------------------------------------------------


@cache
def _zero_byte_table() -> np.ndarray:
    """What one zero byte does to each low byte of a CRC."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(POLYNOMIAL), table >> 1)
    return table.astype(np.uint32)


def _apply(tables: np.ndarray, crc: np.ndarray) -> np.ndarray:
    """A linear map of CRCs, given as its images of the four bytes' values."""
    return (tables[..., 0, :][crc & 255] ^ tables[..., 1, :][(crc >> 8) & 255]
            ^ tables[..., 2, :][(crc >> 16) & 255] ^ tables[..., 3, :][crc >> 24])


@cache
def _doubled_shifts() -> list[np.ndarray]:
    """Maps of 1, 2, 4, ... zero bytes, up to the longest text that a column can hold."""
    one = _zero_byte_table()
    values = np.arange(256, dtype=np.uint32)
    images = [values << np.uint32(8 * k) for k in range(4)]
    maps = [np.stack([(x >> 8) ^ one[x & 255] for x in images])]
    while len(maps) < 32:
        maps.append(np.stack([_apply(maps[-1], row) for row in maps[-1]]))
    return maps


@lru_cache(maxsize=1)
def _short_shifts(most: int = 64) -> np.ndarray:
    """Maps of 0 to ``most`` zero bytes."""
    values = np.arange(256, dtype=np.uint32)
    maps = [np.stack([values << np.uint32(8 * k) for k in range(4)])]
    for _ in range(most):
        maps.append(np.stack([_apply(_doubled_shifts()[0], row) for row in maps[-1]]))
    return np.stack(maps)


def shifted(crc: np.ndarray, zeros: np.ndarray) -> np.ndarray:
    """CRCs after ``zeros`` zero bytes: crc(a + b) is shifted(crc(a), len(b)) ^ crc(b)."""
    table = _short_shifts()
    at = np.minimum(zeros, len(table) - 1)
    out = (table[at, 0, crc & 255] ^ table[at, 1, (crc >> 8) & 255]
           ^ table[at, 2, (crc >> 16) & 255] ^ table[at, 3, crc >> 24])
    long = np.flatnonzero(zeros >= len(table))
    if len(long):
        value, left = crc[long], zeros[long]
        for k, step in enumerate(_doubled_shifts()):
            odd = (left >> k) & 1 == 1
            value = np.where(odd, _apply(step, value), value)
        out[long] = value
    return out


# ---- words and windows ------------------------------------------------------------------------


@cache
def splitter():
    from tokenizers import Regex, pre_tokenizers

    return pre_tokenizers.Split(Regex(WORD), "removed", invert=True)


def words_of(text: str) -> list[tuple[str, tuple[int, int]]]:
    """Words of ASCII-lowered text with their offsets in characters."""
    return splitter().pre_tokenize_str(text.encode().translate(LOWER).decode())


class Chunks(dict):
    """Numbers of chunks in the order of their first use; ``new`` gathers those not yet split."""

    def __init__(self) -> None:
        self.new: list[bytes] = []

    def __missing__(self, chunk: bytes) -> int:
        number = self[chunk] = len(self)
        self.new.append(chunk)
        return number


class WordTable:
    """CRC and byte length of every word of the chunks seen so far, and where a chunk's begin."""

    def __init__(self) -> None:
        self.chunks = Chunks()
        self.first = np.zeros(0, np.int64)
        self.count = np.zeros(0, np.int64)
        self.crc = np.zeros(0, np.uint32)
        self.size = np.zeros(0, np.int64)

    def _learn(self) -> None:
        """Split the new chunks in one call; a word belongs to the chunk that its offsets lie in."""
        texts = b" ".join(self.chunks.new).decode()
        found = words_of(texts)
        starts = np.fromiter((start for _, (start, _) in found), np.int64, len(found))
        borders = np.cumsum([len(t) + 1 for t in texts.split(" ")])
        ends = np.searchsorted(starts, borders)
        words = " ".join([word for word, _ in found]).encode().split(b" ") if found else []
        self.first = np.append(self.first, len(self.crc) + np.append(0, ends[:-1]))
        self.count = np.append(self.count, np.diff(ends, prepend=0))
        self.crc = np.append(self.crc, np.fromiter(map(zlib.crc32, words), np.uint32, len(words)))
        self.size = np.append(self.size, np.fromiter(map(len, words), np.int64, len(words)))
        self.chunks.new = []

    def numbered(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Places in the table of all words of all texts, and how many words each text has."""
        if len(self.chunks) > MOST_CHUNKS:
            self.__init__()
        parts = [text.translate(LOWER).split() for text in texts]
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        numbers = np.fromiter(map(self.chunks.__getitem__, chain.from_iterable(parts)), np.int64,
                              int(sizes.sum()))
        if self.chunks.new:
            self._learn()
        count = self.count[numbers]
        ends = np.cumsum(count)
        words = np.arange(int(count.sum())) + np.repeat(self.first[numbers] - (ends - count), count)
        total = np.append(0, ends)[np.append(0, np.cumsum(sizes))]
        return words, np.diff(total)


def window_buckets(words: np.ndarray, counts: np.ndarray, table: WordTable, grams: int,
                   buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all windows of 1 to ``grams`` words, and the owner of each.

    A window never reaches into the next text. Extending a window by a word appends a space
    and the word, so its CRC is shifted by their length and combined with theirs.
    """
    crc, size = table.crc[words], table.size[words]
    appended = shifted(np.full(len(words), zlib.crc32(b" "), np.uint32), size) ^ crc
    owner = np.repeat(np.arange(len(counts)), counts)
    out, owners = [], []
    window = crc
    for width in range(1, grams + 1):
        if width > 1:
            last = width - 1
            window = shifted(window[:-1], size[last:] + 1) ^ appended[last:]
        inside = owner[:len(window)] == owner[width - 1:]
        out.append(window[inside] % np.uint32(buckets))
        owners.append(owner[:len(window)][inside])
        if len(window) < 2:
            break
    return np.concatenate(out), np.concatenate(owners)


def feature_buckets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    grams: int = 3, buckets: int = 10_000) -> DataFrame:
    """doc_id, n_words, n_features and the bucket of every feature as unsigned 16-bit numbers.

    One row per input row, also for repeated rows. Null and empty texts, and texts without a
    word, have no features. Other columns are not read, so their names cannot clash; a column
    may serve as id and text at once. An empty table gives an empty result.
    """
    if not 0 < buckets <= 1 << 16:
        raise ValueError("buckets must fit in 16 bits")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = WordTable()
        for batch in slices(batches, "text", BLOCK_BYTES):
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            words, counts = table.numbered(texts)
            if len(words):
                found, owners = window_buckets(words, counts, table, grams, buckets)
                found = found[np.argsort(owners, kind="stable")].astype("<u2")
                features = np.bincount(owners, minlength=len(texts))
            else:
                found, features = np.zeros(0, "<u2"), np.zeros(len(texts), np.int64)
            ends = np.cumsum(features) * 2
            data = found.tobytes()
            yield pa.record_batch([
                batch.column(0), pa.array(counts), pa.array(features),
                pa.array([data[e - 2 * n:e] for e, n in zip(ends.tolist(), features.tolist())],
                         pa.binary())], names=["doc_id", "n_words", "n_features", "buckets"])

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                       whole_text(text_col).alias("text"))
    return map_arrow(rows, run, FEATURES)


# ---- histograms, gains, weights ---------------------------------------------------------------


def histogram(features: DataFrame, buckets: int = 10_000) -> DataFrame:
    """bucket, n: how many features of all documents lie in each bucket; empty buckets count 0.

    Every task counts its rows in one array, so that at most ``buckets`` rows a task are shuffled.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, np.int64)
        for batch in batches:
            for data in batch.column(0):
                counts += np.bincount(np.frombuffer(data.as_buffer() or b"", "<u2"),
                                      minlength=buckets)
        held = np.flatnonzero(counts)
        yield pa.record_batch([pa.array(held.astype(np.int32)), pa.array(counts[held])],
                              names=["bucket", "n"])

    parts = map_arrow(features.select("buckets"), run, "bucket int, n long")
    every = features.sparkSession.range(buckets).select(
        F.col("id").cast("int").alias("bucket"), F.lit(0).cast("long").alias("n"))
    return parts.unionByName(every).groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(raw: DataFrame, target: DataFrame, buckets: int = 10_000) -> np.ndarray:
    """1000 times the smoothed log-likelihood ratio of target to raw, floored, of every bucket.

    One row per bucket reaches the driver.
    """
    counts = np.zeros((buckets, 2))
    both = raw.select("bucket", F.col("n").alias("s")).join(
        target.select("bucket", F.col("n").alias("t")), "bucket")
    for row in both.collect():
        counts[row["bucket"]] = row["s"], row["t"]
    all_s, all_t = counts.sum(axis=0) + buckets
    return np.array([math.floor(1000 * math.log(((t + 1) * all_s) / ((s + 1) * all_t)))
                     for s, t in counts.tolist()], np.int64)


def weighed(features: DataFrame, gain: np.ndarray) -> DataFrame:
    """doc_id, n_words, n_features and weight, the sum of the gains of a row's features."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            weight = [int(gain[np.frombuffer(data.as_buffer() or b"", "<u2")].sum())
                      for data in batch.column(3)]
            yield pa.record_batch([*batch.columns[:3], pa.array(weight, pa.int64())],
                                  names=["doc_id", "n_words", "n_features", "weight"])

    return map_arrow(features, run, "doc_id long, n_words long, n_features long, weight long")


# ---- the draw ---------------------------------------------------------------------------------


def gumbel_noise(id_col: str, seed: int) -> Column:
    """1000 times a standard Gumbel number that follows from the id alone, floored."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(float(1 << 32)))))


def numbered_head(rows: DataFrame, order: list[Column], keep: int) -> DataFrame:
    """``rows`` with ``rank``, 1, 2, ... in ``order`` for the first ``keep`` rows, else null.

    Rows are dealt to value ranges and written, so that ranges stay as they are; the driver sees
    one count per range, and only ranges that reach the head are numbered.
    """
    spark = rows.sparkSession
    dealt = materialize(rows.repartitionByRange(*order).withColumn(
        "__range", F.spark_partition_id()))
    before, offsets = 0, []
    for r in dealt.groupBy("__range").count().orderBy("__range").collect():
        if before < keep:
            offsets.append((r["__range"], before))
        before += r["count"]
    if not offsets:
        return dealt.drop("__range").withColumn("rank", F.lit(None).cast("long"))
    head = spark.createDataFrame(offsets, "__range int, __before long")
    place = F.row_number().over(Window.partitionBy("__range").orderBy(*order))
    reached = dealt.join(F.broadcast(head), "__range").withColumn("rank", place + F.col("__before"))
    reached = reached.withColumn("rank", F.when(F.col("rank") <= keep, F.col("rank")))
    rest = dealt.filter(F.col("__range") > offsets[-1][0]).withColumn(
        "rank", F.lit(None).cast("long"))
    return reached.drop("__before").unionByName(rest).drop("__range")


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             target_id: str = "item_id", target_text: str = "text", grams: int = 3,
             buckets: int = 10_000, least_words: int = 20, share: int = 5, per: int = 100,
             seed: int = 42) -> DataFrame:
    """doc_id, n_features, weight, score and rank of every document; undrawn ones have no rank.

    Of the N documents with at least ``least_words`` words, the ``share * N // per`` highest
    scores are drawn; ties go to the smaller id, null ids first. Repeated rows are documents of
    their own and are drawn one by one. Without target texts all counts of the target are 0.
    Null texts have no words, so they weigh 0 and are never drawn. An empty table gives an
    empty result.
    """
    features = materialize(feature_buckets(docs, id_col, text_col, grams, buckets))
    wanted = feature_buckets(target.withColumn("__no", F.lit(0)), "__no", target_text, grams,
                             buckets)
    gain = gains(histogram(features, buckets), histogram(wanted, buckets), buckets)
    scored = materialize(weighed(features, gain).withColumn(
        "score", F.col("weight") + gumbel_noise("doc_id", seed)))
    able = scored.filter(F.col("n_words") >= least_words)
    keep = share * able.count() // per
    drawn = numbered_head(able, [F.col("score").desc(), F.col("doc_id").asc()], keep)
    rest = scored.filter(F.col("n_words") < least_words).withColumn(
        "rank", F.lit(None).cast("long"))
    return drawn.unionByName(rest).select("doc_id", "n_features", "weight", "score", "rank")
