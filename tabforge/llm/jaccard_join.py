"""Jaccard self-join of word n-grams by parity sketches.

Every shingle of a document falls into one of the blocks of its size band; a block's sketch
is the exclusive-or of its shingles, as bits and as a hash. Two documents whose sets differ in
d shingles differ in at most d blocks, so among the first d + 1 non-empty blocks of each, in
an order that both share, at least one is equal (pigeonhole). Blocks with many shingles come
first, which keeps frequent shingles from bringing strangers together. Documents that meet in
a block are compared with the smallest id there, and only blocks that then still hold several
components are compared in full; so a group of near copies costs a star, not all its pairs.
Of documents with the same set only the one with the smallest id is compared at all. The bits
of a whole document give a lower bound of the difference that discards most false candidates
before whole texts are compared.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from contextlib import ExitStack

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabforge.llm.common import map_arrow, slices, whole_text
from tabforge.llm.components import connected_components
from tabforge.session import materialize, temporary

SKETCH_LONGS = 16
FLUSH = 1 << 18
ROWS = "kind byte, key long, a long, b long, n long, digest binary, sketch array<long>"
INFO, BLOCK, MET = 0, 1, 2


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str, width: int) -> np.ndarray:
    """Sorted distinct hashes of the word n-grams; words are cut at ASCII white space.

    A-Z is lower-cased. Fewer words than ``width`` form one shingle, no word none.
    """
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    width = min(width, len(words))
    out = np.full(len(words) - width + 1, width, np.uint64)
    for i in range(width):
        out = _mix(out * np.uint64(0x9E3779B97F4A7C15) + hashes[i:len(words) - width + 1 + i])
    return np.unique(out)


class Bands:
    """Size bands for Jaccard similarity of at least num/den, in whole numbers.

    A set and any partner that is not smaller lie in the same band or in neighbouring ones.
    """

    def __init__(self, num: int, den: int, ratio: float = 1.6):
        self.num, self.den = num, den
        self.ratio = ratio
        self.lows = [1]

    def of(self, n: int) -> int:
        while self.lows[-1] <= n:
            low = self.lows[-1]
            self.lows.append(max(low * self.den // self.num + 1, int(self.ratio * low)))
        return bisect_right(self.lows, n) - 1

    def high(self, band: int) -> int:
        if band + 1 >= len(self.lows):
            self.of(self.lows[-1])
        return self.lows[band + 1] - 1

    def differences(self, total: int) -> int:
        """Most differences of two similar sets whose sizes add up to ``total``."""
        return (self.den - self.num) * total // (self.den + self.num)

    def most(self, n: int) -> int:
        """Most differences of a set of size n and any similar partner."""
        return (self.den - self.num) * n // self.num

    def blocks(self, band: int) -> int:
        worst = self.most(self.high(band))
        return 1 if worst == 0 else 3 * (worst + 1) // 2 + 1

    def roles(self, n: int) -> list[tuple[int, int]]:
        """(band, differences to survive) of the groups in which a set of size n meets others."""
        band = self.of(n)
        found = [(band, self.most(n))]
        if band and self.high(band - 1) * self.den >= n * self.num:
            found.append((band - 1, self.differences(n + self.high(band - 1))))
        return found


def block_keys(shingles: np.ndarray, bands: Bands) -> np.ndarray:
    """Keys of the blocks in which a document must meet every similar one."""
    keys = []
    bits = np.uint64(1) << (shingles & np.uint64(63))
    spread = _mix(shingles)
    for band, differences in bands.roles(len(shingles)):
        blocks = bands.blocks(band)
        block = ((shingles >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32)
        start = np.flatnonzero(np.concatenate(([True], block[1:] != block[:-1])))
        parity = np.bitwise_xor.reduceat(bits, start)
        folded = np.bitwise_xor.reduceat(spread, start)
        held = np.diff(np.append(start, len(shingles)))
        key = _mix(_mix(_mix(folded) + parity) + block[start] * np.uint64(1 << 20)
                   + np.uint64(band + 1))
        if len(key) <= differences:
            # Too few blocks are filled: also meet the others of this kind by single shingles.
            single = _mix(spread + np.uint64((band + 1) << 32) + np.uint64(1))
            key = np.concatenate((key, np.sort(single)[:differences + 1]))
        elif len(key) > differences + 1:
            key = key[np.lexsort((key, -held))[:differences + 1]]
        keys.append(key)
    return np.concatenate(keys)


def parity_bits(shingles: np.ndarray) -> np.ndarray:
    """The whole document as bits: each shingle flips one."""
    count = np.bincount((shingles >> np.uint64(7) & np.uint64(64 * SKETCH_LONGS - 1)).astype(int),
                        minlength=64 * SKETCH_LONGS)
    return np.packbits(count & 1).view(np.int64)


def _met(keys: list[np.ndarray], ids: list[np.ndarray]) -> pa.RecordBatch:
    """Combine before the shuffle: of the ids in one block, the smallest goes on for all."""
    key, of = np.concatenate(keys).view(np.int64), np.concatenate(ids)
    order = np.lexsort((of, key))
    key, of = key[order], of[order]
    first = np.concatenate(([True], key[1:] != key[:-1]))
    hub = of[np.maximum.accumulate(np.where(first, np.arange(len(of)), 0))]
    member = ~first & (of != hub)
    return _batch(
        np.concatenate((np.full(first.sum(), BLOCK), np.full(member.sum(), MET))),
        np.concatenate((key[first], key[member])), np.concatenate((of[first], of[member])),
        np.concatenate((of[first], hub[member])))


def _batch(kind, key, a, b, n=None, digest=None, sketch=None) -> pa.RecordBatch:
    bits = pa.list_(pa.int64())
    return pa.RecordBatch.from_arrays(
        [pa.array(kind, pa.int8()), pa.array(key, pa.int64()), pa.array(a, pa.int64()),
         pa.array(b, pa.int64()),
         pa.nulls(len(kind), pa.int64()) if n is None else pa.array(n, pa.int64()),
         pa.nulls(len(kind), pa.binary()) if n is None else pa.array(digest, pa.binary()),
         pa.nulls(len(kind), bits) if n is None else pa.array(sketch, bits)],
        names=["kind", "key", "a", "b", "n", "digest", "sketch"])


def sketch_rows(docs: DataFrame, width: int, num: int, den: int) -> DataFrame:
    """Per document its size, digest and bits; per block key the ids that hold it."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands = Bands(num, den)
        keys, ids, held = [], [], 0
        for batch in slices(batches, "text", 4 << 20):
            of, sizes, digests, bits = batch.column(0).to_pylist(), [], [], []
            for key, text in zip(of, batch.column(1).to_pylist()):
                shingles = shingle_set(text, width)
                sizes.append(len(shingles))
                digests.append(xxhash.xxh3_128_digest(shingles.tobytes()))
                bits.append(parity_bits(shingles))
                if len(shingles):
                    found = block_keys(shingles, bands)
                    keys.append(found)
                    ids.append(np.full(len(found), key, np.int64))
                    held += len(found)
                if held >= FLUSH:
                    yield _met(keys, ids)
                    keys, ids, held = [], [], 0
            yield _batch([INFO] * len(of), [0] * len(of), of, of, sizes, digests, bits)
        if keys:
            yield _met(keys, ids)

    return map_arrow(docs, rows, ROWS)


def _near(num: int, den: int, longs: int = SKETCH_LONGS) -> Column:
    """Whether na, nb and the bits sa, sb allow the similarity.

    Every shingle flips one bit, so the Hamming distance never exceeds the difference.
    """
    apart = " + ".join(f"bit_count(sa[{i}] ^ sb[{i}])" for i in range(longs))
    return F.expr(f"least(na, nb) * {den} >= greatest(na, nb) * {num} AND "
                  f"{apart} <= {den - num} * (na + nb) div {den + num}")


def _similar(pairs: DataFrame, texts: DataFrame, info: DataFrame, width: int, num: int,
             den: int, stack: ExitStack) -> DataFrame:
    """Those (a, b) whose sets have at least the similarity; compares whole texts."""
    both = pairs.join(info.toDF("a", "na", "da", "sa"), "a").join(
        info.toDF("b", "nb", "db", "sb"), "b")
    both = both.withColumn("same", F.col("da") == F.col("db")).filter(
        F.col("same") | _near(num, den)).select("a", "b", "same")
    both = stack.enter_context(temporary(both))
    open_pairs = both.filter("NOT same").select("a", "b")
    needed = open_pairs.select(F.col("a").alias("id")).union(
        open_pairs.select(F.col("b").alias("id"))).distinct()
    held = stack.enter_context(temporary(texts.join(needed, "id", "left_semi")))
    ready = open_pairs.join(held.toDF("a", "ta"), "a").join(held.toDF("b", "tb"), "b")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "ta", 4 << 20):
            ok, last, right = [], None, None
            for left, other in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                if other != last:
                    last, right = other, shingle_set(other, width)
                mine = shingle_set(left, width)
                shared = len(np.intersect1d(mine, right, assume_unique=True))
                ok.append(shared * den >= (len(mine) + len(right) - shared) * num)
            keep = pa.array(ok, pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).filter(keep), batch.column(1).filter(keep)], names=["a", "b"])

    checked = map_arrow(ready.select("a", "b", "ta", "tb"), verify, "a long, b long")
    return both.filter("same").select("a", "b").union(checked)


def similar_components(
    docs: DataFrame, width: int = 4, num: int = 85, den: int = 100, id_col: str = "doc_id",
    text_col: str = "text", hub_rounds: int = 2,
) -> DataFrame:
    """Components of the documents whose n-gram sets have Jaccard similarity >= num/den.

    Returns doc_id, n_shingles, component_id (smallest id reachable by links), one row per
    distinct doc_id. Null and empty texts, and texts of white space, have size 0 and no links.
    A repeated row is the same document; if an id comes with different texts, a link of any of
    them counts and the largest size is given. Rows without an id are left out, since they
    could not be told apart. Other columns are not read. An empty table gives an empty result.

    In every block all members are first compared with the smallest id, then, where they are
    not yet in one component, with the member that has most links (``hub_rounds`` times). What
    is left in different components after that is compared pair by pair, if sizes and bits
    allow it, so the result does not depend on the rounds.
    """
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"),
                       whole_text(text_col).alias("text")).filter("id IS NOT NULL")
    with ExitStack() as stack:
        def keep(df: DataFrame) -> DataFrame:
            return stack.enter_context(temporary(df))

        with temporary(sketch_rows(rows, width, num, den)) as sketched:
            info = materialize(
                sketched.filter(F.col("kind") == INFO).groupBy(F.col("a").alias("id")).agg(
                    F.max(F.struct("n", "digest", "sketch")).alias("s")).select("id", "s.*"))
            copies = keep(_copies(sketched))
            starred = sketched.filter(F.col("kind") == BLOCK).select("key", "a").withColumn(
                "b", F.expr("min(a) OVER (PARTITION BY key)")).filter("a <> b")
            met = keep(_without_copies(starred.union(
                sketched.filter(F.col("kind") == MET).select("key", "a", "b")), copies))
        compared = keep(met.select("a", "b").distinct())
        partnered = compared.select(F.col("a").alias("id")).union(compared.select("b")).distinct()
        # Shuffled at every size: what has a partner grows with the documents.
        texts = keep(rows.join(partnered.hint("merge"), "id", "left_semi"))
        links = keep(_similar(compared, texts, info, width, num, den, stack))
        found = connected_components(links)
        members = keep(_unsettled(met, compared, found))
        rounds = -1 if members.isEmpty() else hub_rounds
        for left in range(rounds, -1, -1):
            mixed = keep(_mixed(members, found, links))
            if mixed.isEmpty():
                break
            pairs = _with_hub(mixed) if left else _pairwise(mixed, info, num, den)
            pairs = keep(pairs.join(compared, ["a", "b"], "left_anti"))
            if pairs.isEmpty():
                continue
            more = keep(_similar(pairs, texts, info, width, num, den, stack))
            compared = compared.union(pairs)
            if not more.isEmpty():
                links = links.union(more)
                # The components found so far stand in for the links behind them.
                found = connected_components(found.union(more))
        # Each copy has the component of the document that stood for it.
        copied = copies.toDF("copy", "id").join(found, "id", "left").select(
            F.col("copy").alias("id"), F.coalesce("component", "id").alias("component"))
        found = materialize(found.union(copied))
    return info.join(found, "id", "left").select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"),
        F.coalesce("component", "id").alias("component_id"))


def _copies(sketched: DataFrame) -> DataFrame:
    """(id, first) of documents whose set a document with a smaller id has as well.

    Ids with different texts stand for themselves, and so do empty sets, which have no links.
    """
    single = sketched.filter(F.col("kind") == INFO).groupBy(F.col("a").alias("id")).agg(
        F.max("n").alias("n"), F.min("digest").alias("digest"), F.max("digest").alias("other"))
    single = single.filter("n > 0 AND digest = other").select("id", "digest")
    first = single.groupBy("digest").agg(F.min("id").alias("first"), F.count("*").alias("times"))
    first = first.filter("times > 1").select("digest", "first")
    return single.join(first, "digest").filter("id <> first").select("id", "first")


def _without_copies(met: DataFrame, copies: DataFrame) -> DataFrame:
    """(key, a, b) with each copy replaced by the document that stands for it."""
    for side in "ab":
        met = met.join(copies.toDF(side, "first"), side, "left").withColumn(
            side, F.coalesce("first", side)).drop("first")
    return met.filter("a <> b").select("key", "a", "b").distinct()


def _unsettled(met: DataFrame, compared: DataFrame, found: DataFrame) -> DataFrame:
    """(key, id) of the blocks that hold several components after the first comparison.

    In a block whose members were all linked to its smallest id, nothing is left to compare.
    """
    apart = compared.join(found.toDF("a", "ca"), "a", "left").join(
        found.toDF("b", "cb"), "b", "left").filter(
        F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b")
    keys = met.join(apart, ["a", "b"], "left_semi").select("key").distinct()
    left = met.join(keys, "key", "left_semi")
    return left.select("key", F.col("a").alias("id")).union(left.select("key", "b")).distinct()


def _mixed(members: DataFrame, found: DataFrame, links: DataFrame) -> DataFrame:
    """Members of blocks with several components now: key, id, c, and the block's hub, hub_c.

    The hub is the member with most links, of equals the smallest id.
    """
    degree = links.select(F.col("a").alias("id")).union(links.select("b")).groupBy("id").agg(
        F.count("*").alias("degree"))
    named = members.join(found, "id", "left").join(degree, "id", "left").select(
        "key", "id", F.coalesce("component", "id").alias("c"),
        F.coalesce("degree", F.lit(0)).alias("degree"))
    blocks = named.groupBy("key").agg(
        F.min("c").alias("low"), F.max("c").alias("high"),
        F.max(F.struct("degree", (-F.col("id")).alias("id"), "c")).alias("hub"))
    blocks = blocks.filter("low <> high").select(
        "key", (-F.col("hub.id")).alias("hub"), F.col("hub.c").alias("hub_c"))
    return named.drop("degree").join(blocks, "key")


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _with_hub(mixed: DataFrame) -> DataFrame:
    """In each block, members of other components beside the hub."""
    return _ordered(mixed.filter("c <> hub_c").select(
        F.col("id").alias("a"), F.col("hub").alias("b")))


def _pairwise(mixed: DataFrame, info: DataFrame, num: int, den: int) -> DataFrame:
    """All pairs of different components in a block whose sizes and bits allow a link.

    Bits are folded to half, which keeps the bound and halves what is shuffled.
    """
    half = SKETCH_LONGS // 2
    bits = F.array(*[F.expr(f"sketch[{i}] ^ sketch[{i + half}]") for i in range(half)])
    rows = mixed.select("key", "id", "c").join(
        info.select("id", "n", bits.alias("bits")), "id")
    sides = [rows.select("key", *[F.col(c).alias(f"{n}{s}") for c, n in (
        ("id", ""), ("c", "c"), ("n", "n"), ("bits", "s"))]) for s in "ab"]
    apart = (F.col("a") > F.col("b")) & (F.col("ca") != F.col("cb"))
    return _ordered(sides[0].join(sides[1], "key").filter(apart & _near(num, den, half)))
