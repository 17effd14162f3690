"""Best-fit packing by exact-complement hashing.

Documents are tokenised and cut on the executors. How pieces share sequences depends only on
how many pieces there are of each length, and there are at most ``capacity`` lengths. So the
counts (never the pieces) go to the driver, which plans groups of equal sequences: it fills
gaps exactly by single, pair and triple complements that are available, then packs the rest
best-fit. Executors then look up the place of the r-th piece of its length in the plan.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabforge.llm.common import map_arrow, slices, whole_text
from tabforge.llm.tokens import byte_level_encoder

PIECES = "doc_id long, piece int, start long, length long, ids binary"


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens; only the first may be shorter."""
    first = n % capacity or capacity
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)]


def tokenised_pieces(
    docs: DataFrame, vocabulary: str, capacity: int = 1024, end_id: int = 2,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Token ids of every document and the end id, in pieces of at most ``capacity``.

    Returns doc_id, piece (from 0), start, length, ids (little-endian unsigned 32-bit). Null
    and empty text give one piece that holds the end id alone. Text is never cut before it is
    tokenised; the memory of a task is bounded by its longest document. Repeated rows give
    repeated pieces. Other columns are not read.
    """
    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = byte_level_encoder(vocabulary)
        for batch in slices(batches, "text", 4 << 20):
            doc, no, start, length, ids = [], [], [], [], []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                tokens = np.array([*encode(text), end_id], dtype="<u4")
                for i, (s, n) in enumerate(cut(len(tokens), capacity)):
                    doc.append(key)
                    no.append(i)
                    start.append(s)
                    length.append(n)
                    ids.append(tokens[s:s + n].tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc, pa.int64()), pa.array(no, pa.int32()), pa.array(start, pa.int64()),
                 pa.array(length, pa.int64()), pa.array(ids, pa.binary())],
                names=["doc_id", "piece", "start", "length", "ids"])

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                       whole_text(text_col).alias("text"))
    return map_arrow(rows, pieces, PIECES)


# ---- the plan, from counts per length ----------------------------------------------------


class _Counts:
    """Available pieces per length, with the complements of a gap."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.left = np.zeros(capacity + 1, dtype=np.int64)
        for length, n in counts.items():
            self.left[length] = n

    def fits(self, lengths: tuple[int, ...]) -> int:
        """How often these lengths can be taken together."""
        return min(int(self.left[x]) // lengths.count(x) for x in set(lengths))

    def take(self, lengths: tuple[int, ...], times: int) -> None:
        for x in lengths:
            self.left[x] -= times

    def single(self, gap: int) -> tuple[int, ...] | None:
        return (gap,) if gap > 0 and self.left[gap] > 0 else None

    def pair(self, gap: int) -> tuple[int, ...] | None:
        """The pair of available lengths with sum ``gap`` whose larger member is largest."""
        high = np.arange(gap - 1, (gap - 1) // 2, -1)
        low = gap - high
        ok = (self.left[high] > 0) & (self.left[low] > 0) & (
            (high != low) | (self.left[high] > 1))
        hit = np.flatnonzero(ok)
        return (int(high[hit[0]]), int(low[hit[0]])) if len(hit) else None

    def triple(self, gap: int) -> tuple[int, ...] | None:
        for top in np.flatnonzero(self.left[:gap - 1])[::-1]:
            top = int(top)
            if 3 * top < gap:
                return None
            self.left[top] -= 1
            rest = self.pair(gap - top)
            self.left[top] += 1
            if rest and rest[0] <= top:
                return (top, *rest)
        return None

    def complement(self, length: int, capacity: int) -> tuple[int, ...] | None:
        """Lengths that fill a sequence exactly beside one piece of ``length``."""
        gap = capacity - length
        if gap == 0:
            return ()
        self.left[length] -= 1
        try:
            return self.single(gap) or self.pair(gap) or self.triple(gap)
        finally:
            self.left[length] += 1


def plan_sequences(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Groups of equal sequences: (lengths in one sequence, number of such sequences).

    ``counts`` has the pieces per length. Every step empties a length or a group, so the plan
    is bounded by the capacity and not by the number of pieces.
    """
    have = _Counts(counts, capacity)
    groups: list[tuple[tuple[int, ...], int]] = []
    for length in range(capacity, 0, -1):
        while have.left[length]:
            rest = have.complement(length, capacity)
            if rest is None:
                break
            lengths = (length, *rest)
            times = have.fits(lengths)
            have.take(lengths, times)
            groups.append((lengths, times))
    return groups + _best_fit(have.left, capacity)


def _best_fit(left: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing over counts: groups of equal sequences take equal pieces together."""
    open_gaps: list[int] = []
    by_gap: dict[int, list[tuple[tuple[int, ...], int]]] = {}

    def put(lengths: tuple[int, ...], times: int) -> None:
        gap = capacity - sum(lengths)
        if gap not in by_gap:
            by_gap[gap] = []
            insort(open_gaps, gap)
        by_gap[gap].append((lengths, times))

    for length in range(capacity, 0, -1):
        n = int(left[length])
        while n:
            at = bisect_left(open_gaps, length)
            if at == len(open_gaps):
                each = capacity // length
                if n >= each:
                    put((length,) * each, n // each)
                if n % each:
                    put((length,) * (n % each), 1)
                break
            gap = open_gaps[at]
            lengths, times = by_gap[gap].pop()
            if not by_gap[gap]:
                del by_gap[gap]
                open_gaps.pop(at)
            each = min(gap // length, n)
            if n >= each * times:
                put(lengths + (length,) * each, times)
                n -= each * times
            else:
                used = n // each
                put(lengths + (length,) * each, used)
                put(lengths, times - used)
                n -= used * each
    return [group for groups in by_gap.values() for group in groups]


def lookup_table(groups: list[tuple[tuple[int, ...], int]]) -> dict[int, tuple[np.ndarray, ...]]:
    """Per length, sorted runs of ranks: (first rank, first sequence, pieces in each, offset)."""
    runs: dict[int, list[tuple[int, int, int, int]]] = {}
    used: dict[int, int] = {}
    sequence = 0
    for lengths, times in groups:
        offset = 0
        for length in sorted(set(lengths), reverse=True):
            each = lengths.count(length)
            rank = used.get(length, 0)
            runs.setdefault(length, []).append((rank, sequence, each, offset))
            used[length] = rank + each * times
            offset += each * length
        sequence += times
    return {length: tuple(np.array(x, dtype=np.int64) for x in zip(*rows))
            for length, rows in runs.items()}


def place(table: dict[int, tuple[np.ndarray, ...]], length: np.ndarray,
          rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of the rank-th pieces of their lengths."""
    sequence, offset = np.empty_like(rank), np.empty_like(rank)
    for value in np.unique(length):
        at = np.flatnonzero(length == value)
        ranks, first, each, begin = table[int(value)]
        run = np.searchsorted(ranks, rank[at], side="right") - 1
        inside = rank[at] - ranks[run]
        sequence[at] = first[run] + inside // each[run]
        offset[at] = begin[run] + inside % each[run] * value
    return sequence, offset


def pack(pieces: DataFrame, capacity: int = 1024, salts: int = 64) -> DataFrame:
    """Add sequence_id and offset to a stored table of pieces with doc_id, piece and length.

    Pieces of one length are numbered without a global order: per (length, salt) by a window
    of one salt's share, after the counts of the salts before it. ``pieces`` should be a
    stored table, since it is read twice. Further columns are carried along; they must not be
    called sequence_id, offset, __salt, __before or __rank.
    """
    pieces = pieces.withColumn(
        "__salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)).cast("int"))
    per_salt = pieces.groupBy("length", "__salt").agg(F.count("*").alias("n"))
    counts = {int(r["length"]): int(r["n"]) for r in
              per_salt.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    runs = lookup_table(plan_sequences(counts, capacity))
    names = pieces.columns[:-1]
    before = per_salt.select("length", "__salt", F.expr(
        "sum(n) OVER (PARTITION BY length ORDER BY __salt) - n").alias("__before"))
    order = ", ".join(f"`{c}`" for c in names if c != "length")
    ranked = pieces.withColumn("__rank", F.expr(
        f"row_number() OVER (PARTITION BY length, __salt ORDER BY {order}) - 1"))
    ranked = ranked.join(before, ["length", "__salt"]).select(
        *names, (F.col("__rank") + F.col("__before")).cast("long").alias("__rank"))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            sequence, offset = place(runs, of["length"].to_numpy(zero_copy_only=False),
                                     of.pop("__rank").to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_pydict(
                {**of, "sequence_id": pa.array(sequence), "offset": pa.array(offset)})

    schema = T.StructType([f for f in ranked.schema.fields if f.name != "__rank"])
    schema = schema.add("sequence_id", "long").add("offset", "long")
    return map_arrow(ranked, assign, schema)


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences themselves: sequence_id, ids (joined in offset order), pieces.

    ``packed`` must still carry ``ids``. A group is one sequence, so at most ``capacity``
    tokens meet.
    """
    rows = packed.groupBy("sequence_id").agg(
        F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("r"),
        F.count("*").alias("pieces"))
    return rows.select("sequence_id", "pieces", F.expr(
        "unhex(aggregate(r, '', (a, x) -> concat(a, hex(x.ids))))").alias("ids"))
