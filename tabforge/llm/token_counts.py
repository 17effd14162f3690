"""Token counts that follow edits.

A document is cut into leaves at places where no pre-token can reach across: a single space
between two letters or digits. The counts of the leaves are kept with the document; sums over
them form a segment tree. An edit descends by character sums to the leaves it touches, takes
in neighbours until both ends are safe places again, encodes that region only, and updates the
sums above it. The total is always that of the whole text encoded anew.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabforge.llm.common import map_arrow, slices, whole_text
from tabforge.llm.tokens import byte_level_encoder

LEAF = 256
EDIT = "struct<start:int,end:int,replacement:string>"
TREES = "doc_id long, text string, leaf_chars array<int>, leaf_tokens array<int>, n_tokens long"


def safe(left: str, right: str) -> bool:
    """Whether pre-tokens of ``left + right`` are those of both: right is " x", left ends in x."""
    return (len(right) > 1 and right[0] == " " and right[1].isalnum()
            and left != "" and left[-1].isalnum())


def leaves_of(text: str, size: int = LEAF) -> list[str]:
    """Pieces of at least ``size`` characters, cut at safe places; the last may be shorter."""
    out, begin = [], 0
    at = text.find(" ", size)
    while at > 0:
        if text[at - 1].isalnum() and text[at + 1:at + 2].isalnum():
            out.append(text[begin:at])
            begin = at
            at = text.find(" ", at + size)
        else:
            at = text.find(" ", at + 1)
    out.append(text[begin:])
    return out


class CountTree:
    """Segment tree of characters and tokens over the leaves of one document."""

    def __init__(self, leaves: list[str], tokens: list[int], count: Callable[[str], int]):
        self.leaves, self.count = leaves, count
        self.width = 1
        while self.width < len(leaves):
            self.width *= 2
        self.chars = [0] * (2 * self.width)
        self.tokens = [0] * (2 * self.width)
        for i, (leaf, n) in enumerate(zip(leaves, tokens)):
            self.chars[self.width + i], self.tokens[self.width + i] = len(leaf), n
        for i in range(self.width - 1, 0, -1):
            self._sum(i)
        self.encoded = 0

    def _sum(self, i: int) -> None:
        self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]
        self.tokens[i] = self.tokens[2 * i] + self.tokens[2 * i + 1]

    @property
    def total(self) -> int:
        return self.tokens[1]

    def find(self, place: int) -> tuple[int, int]:
        """Leaf that holds a character, and the characters before that leaf."""
        i, before = 1, 0
        while i < self.width:
            i *= 2
            if place >= before + self.chars[i]:
                before += self.chars[i]
                i += 1
        return min(i - self.width, len(self.leaves) - 1), before

    def _set(self, leaf: int, text: str, tokens: int) -> None:
        self.leaves[leaf] = text
        i = self.width + leaf
        self.chars[i], self.tokens[i] = len(text), tokens
        while i > 1:
            i //= 2
            self._sum(i)

    def edit(self, start: int, end: int, replacement: str) -> None:
        """Replace characters [start, end) of the present text."""
        whole = self.chars[1]
        start = min(max(start, 0), whole)
        end = min(max(end, start), whole)
        first, before = self.find(max(start - 1, 0))
        last, _ = self.find(max(end - 1, start - 1, 0))
        last = max(first, last)
        region = "".join(self.leaves[first:last + 1])
        region = region[:start - before] + replacement + region[end - before:]
        # Boundary context: take in neighbours until both borders are safe again.
        while first > 0 and not safe(self._last_char(first), region):
            first -= 1
            region = self.leaves[first] + region
        while last < len(self.leaves) - 1 and not safe(region, self._next_chars(last)):
            last += 1
            region += self.leaves[last]
        self.encoded += len(region)
        self._set(first, region, sum(map(self.count, leaves_of(region))))
        for leaf in range(first + 1, last + 1):
            self._set(leaf, "", 0)

    def _last_char(self, leaf: int) -> str:
        return next((t[-1] for t in reversed(self.leaves[:leaf]) if t), "")

    def _next_chars(self, leaf: int) -> str:
        following = ""
        for t in self.leaves[leaf + 1:]:
            following += t[:2]
            if len(following) > 1:
                break
        return following


def segment_trees(docs: DataFrame, vocabulary: str, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """Leaves and token counts of every whole text: doc_id, text, leaf_chars, leaf_tokens, n_tokens.

    Null and empty text have one empty leaf and no tokens. Repeated rows are repeated; other
    columns are not read.
    """
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = byte_level_encoder(vocabulary)
        for batch in slices(batches, "text", 4 << 20):
            chars, tokens = [], []
            for text in batch.column(1).to_pylist():
                leaves = leaves_of(text)
                chars.append([len(x) for x in leaves])
                tokens.append([len(encode(x)) for x in leaves])
            yield _trees(batch.column(0), batch.column(1), chars, tokens)

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                       whole_text(text_col).alias("text"))
    return map_arrow(rows, build, TREES)


def _trees(ids, texts, chars, tokens, **more) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({
        "doc_id": ids, "text": texts, "leaf_chars": pa.array(chars, pa.list_(pa.int32())),
        "leaf_tokens": pa.array(tokens, pa.list_(pa.int32())),
        "n_tokens": pa.array([sum(t) for t in tokens], pa.int64()), **more})


def with_edits(trees: DataFrame, edits: DataFrame) -> DataFrame:
    """Add the edits of each document, in order of ``seq``, as the column ``edits``.

    ``edits`` has doc_id, seq, start, end and replacement. All edits of a document meet in one
    row, as does its text; edits of unknown documents and of a null id are left out.
    """
    lists = edits.groupBy("doc_id").agg(F.expr(
        "transform(sort_array(collect_list(struct(seq, start, end, replacement))), "
        f"e -> CAST(struct(e.start, e.end, e.replacement) AS {EDIT}))").alias("edits"))
    return trees.join(lists, "doc_id", "left")


def apply_edits(trees: DataFrame, vocabulary: str) -> DataFrame:
    """Edited documents: the columns of ``segment_trees`` with n_before, n_edits, encoded_chars.

    ``trees`` has those columns and ``edits``, an array of (start, end, replacement) that are
    applied one after the other, each to the text as it then is, in code points. Places outside
    the text are moved to its ends; a null replacement is empty; a null list has no edits.
    """
    def recount(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = byte_level_encoder(vocabulary)
        for batch in slices(batches, "text", 4 << 20):
            texts, chars, tokens, before, edits, encoded = [], [], [], [], [], []
            columns = [batch.column(batch.schema.get_field_index(c)).to_pylist()
                       for c in ("text", "leaf_chars", "leaf_tokens", "edits")]
            for text, sizes, counts, changes in zip(*columns):
                leaves, at = [], 0
                for n in sizes:
                    leaves.append(text[at:at + n])
                    at += n
                tree = CountTree(leaves, counts, lambda x: len(encode(x)))
                before.append(tree.total)
                for e in changes or ():
                    tree.edit(e["start"] or 0, e["end"] or 0, e["replacement"] or "")
                kept = [(x, tree.tokens[tree.width + i]) for i, x in enumerate(tree.leaves) if x]
                texts.append("".join(x for x, _ in kept))
                chars.append([len(x) for x, _ in kept] or [0])
                tokens.append([n for _, n in kept] or [0])
                edits.append(len(changes or ()))
                encoded.append(tree.encoded)
            yield _trees(batch.column(0), pa.array(texts, pa.string()), chars, tokens,
                         n_before=pa.array(before, pa.int64()), n_edits=pa.array(edits, pa.int32()),
                         encoded_chars=pa.array(encoded, pa.int64()))

    rows = trees.select("doc_id", "text", "leaf_chars", "leaf_tokens", "edits")
    return map_arrow(rows, recount, f"{TREES}, n_before long, n_edits int, encoded_chars long")
