"""Alignment of two tokenizers' tokens over the same bytes.

Each text is tokenised whole by both. Where both have a token end at the same byte and both
next tokens begin with a space, the text is cut: such ends are found from the byte lengths of
the tokens and hold once the joined bytes of either side are verified to be the text. A
window between two cuts is a pair of id tuples; inside it, every further shared end separates
two groups, and the tokens of a group are linked. Windows recur all the time, so what a window
gives is kept under its id tuples, as long as the table has room.

How often an id pair is linked is counted over all documents. A block of documents sends each
of its distinct pairs once, with the number of its documents that hold it, gets back one count
a pair, and its documents' sums are taken from those; no document's own links are shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tabforge.llm.common import map_arrow, slices, whole_text
from tabforge.llm.tokens import byte_alphabet, plain_byte_level_encoder
from tabforge.session import materialize

BLOCK_BYTES = 3 << 19
# The table of windows is emptied when it holds more.
MEMO_WINDOWS = 120_000
# Tokens whose bytes are joined at a time.
SPELLED = 1 << 15

DOCUMENT = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
            "pairs binary, times binary")
BLOCK = f"block long, keys array<long>, held array<long>, docs array<struct<{DOCUMENT}>>"


def repeated(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """first, first + 1, ... for ``count`` numbers each."""
    ends = np.cumsum(count)
    return np.arange(int(count.sum())) + np.repeat(first - (ends - count), count)


@dataclass(frozen=True)
class Tokens:
    """A tokenizer as text -> ids, with bytes, byte length and leading space of every id."""

    encode: Callable[[str], list[int]]
    data: np.ndarray
    first: np.ndarray
    size: np.ndarray
    spaced: np.ndarray

    def spell(self, ids: np.ndarray, whole: bytes) -> bool:
        """Whether the joined bytes of tokens are ``whole``."""
        at = 0
        for i in range(0, len(ids), SPELLED):
            part = ids[i:i + SPELLED]
            said = self.data[repeated(self.first[part], self.size[part])].tobytes()
            if whole[at:at + len(said)] != said:
                return False
            at += len(said)
        return at == len(whole)


def _tokens(encode: Callable[[str], list[int]], data: list[bytes]) -> Tokens:
    size = np.array([len(d) for d in data], np.int64)
    return Tokens(encode, np.frombuffer(b"".join(data), np.uint8), np.cumsum(size) - size, size,
                  np.array([d[:1] == b" " for d in data]))


@lru_cache(maxsize=2)
def byte_level_tokens(vocabulary: str) -> Tokens:
    """Ids of a space and the text; strings of special tokens are plain text."""
    import json

    with open(vocabulary, encoding="utf-8") as handle:
        entries = json.load(handle)["model"]["vocab"]
    letters = byte_alphabet()
    data = [b""] * (max(entries.values()) + 1)
    for piece, i in entries.items():
        if all(c in letters for c in piece):
            data[i] = bytes(letters[c] for c in piece)
    encode = plain_byte_level_encoder(vocabulary)
    return _tokens(lambda text: encode(" " + text), data)


@lru_cache(maxsize=2)
def piece_tokens(model: str) -> Tokens:
    """Ids of the text, to which the model adds the space; strings of control pieces are plain text."""
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=model)
    data = []
    for i in range(library.get_piece_size()):
        piece = library.id_to_piece(i)
        data.append(bytes([int(piece[3:-1], 16)]) if library.is_byte(i)
                    else piece.replace("▁", " ").encode())
    return _tokens(library.encode, data)


class Windows(dict):
    """Numbers of windows by their ids, packed; ``new`` gathers those not yet aligned."""

    def __init__(self) -> None:
        self.new: list[bytes] = []

    def __missing__(self, window: bytes) -> int:
        number = self[window] = len(self)
        self.new.append(window)
        return number


def groups_of(size_a: np.ndarray, size_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Group of every token of two sequences over the same bytes: it ends at the next shared end."""
    ends_a, ends_b = np.cumsum(size_a), np.cumsum(size_b)
    at = np.minimum(np.searchsorted(ends_b, ends_a), len(ends_b) - 1)
    shared = ends_a[ends_b[at] == ends_a]
    return np.searchsorted(shared, ends_a), np.searchsorted(shared, ends_b)


def group_links(group_a: np.ndarray, a: np.ndarray, group_b: np.ndarray,
                b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Group, key and times of the distinct links of every group; a key is both ids in one number."""
    of_a, times_a = np.unique(group_a << 32 | a, return_counts=True)
    of_b, times_b = np.unique(group_b << 32 | b, return_counts=True)
    groups = np.arange(int(group_a[-1]) + 1)
    first_b = np.searchsorted(of_b >> 32, groups)
    count_b = np.append(first_b[1:], len(of_b)) - first_b
    mine = of_a >> 32
    left = np.repeat(np.arange(len(of_a)), count_b[mine])
    right = repeated(first_b[mine], count_b[mine])
    key = (of_a[left] & 0xFFFFFFFF) << 32 | (of_b[right] & 0xFFFFFFFF)
    return mine[left], key, times_a[left] * times_b[right]


class Aligner:
    """Aligns texts block by block, and remembers the windows that it has seen.

    Windows are numbered; ``text`` and the arrays hold what each of them gives: its groups as
    text, their number, its links with repeats, and where its distinct links lie.
    """

    def __init__(self, a: Tokens, b: Tokens):
        self.a, self.b = a, b
        self.marks = [f"{i}{sign}" for n, last in ((len(a.size), "|"), (len(b.size), ";"))
                      for i in range(n) for sign in (",", last)]
        self.forget()

    def forget(self) -> None:
        self.windows = Windows()
        self.text: list[str] = []
        empty = np.zeros(0, np.int64)
        self.groups, self.links, self.first, self.count, self.keys, self.times = [empty] * 6

    def _tokenised(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of both kinds for every text; none where either do not spell a space and the text."""
        none = np.zeros(0, np.int32)
        both = [[np.array(side.encode(t), np.int32) if t else none for t in texts]
                for side in (self.a, self.b)]
        for i, text in enumerate(texts):
            whole = b" " + text.encode()
            if not (self.a.spell(both[0][i], whole) and self.b.spell(both[1][i], whole)):
                both[0][i] = both[1][i] = none
        return both[0], both[1]

    def _numbers(self, a: np.ndarray, b: np.ndarray, n_a: np.ndarray
                 ) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the windows of all texts, and how many each text has.

        Put one after another the texts' tokens are over the same bytes, and every text begins
        with a space, so that windows end with it.
        """
        if not len(a):
            return a, np.zeros(len(n_a), np.int64)
        ends_a, ends_b = np.cumsum(self.a.size[a]), np.cumsum(self.b.size[b])
        # The last shared end is that of all, which no token follows.
        at_b = np.searchsorted(ends_b, ends_a[:-1])
        at_a = np.flatnonzero(ends_b[at_b] == ends_a[:-1])
        at_b = at_b[at_a]
        spaced = self.a.spaced[a[at_a + 1]] & self.b.spaced[b[at_b + 1]]
        # Ids of both in the order of the windows; those of the second lie above the first's.
        cuts_a, cuts_b = at_a[spaced] + 1, at_b[spaced] + 1
        ids = np.zeros(len(a) + len(b), "<i4")
        count_a = np.diff(cuts_a, prepend=0, append=len(a))
        count_b = np.diff(cuts_b, prepend=0, append=len(b))
        del ends_a, ends_b
        ids[np.arange(len(a)) + np.repeat(np.append(0, cuts_b), count_a)] = a
        ids[np.arange(len(b)) + np.repeat(np.append(cuts_a, len(a)), count_b)] = (
            b + len(self.a.size))
        data, ends = ids.tobytes(), (4 * np.cumsum(count_a + count_b)).tolist()
        keys = map(data.__getitem__, map(slice, [0, *ends], ends))
        numbers = np.fromiter(map(self.windows.__getitem__, keys), np.int64, len(ends))
        upto = np.searchsorted(np.append(cuts_a, len(a)), np.cumsum(n_a), side="right")
        return numbers, np.diff(upto, prepend=0)

    def _learn(self) -> None:
        """Align all new windows in one go; put one after another they are over the same bytes."""
        new, self.windows.new = self.windows.new, []
        ids = np.frombuffer(b"".join(new), "<i4").astype(np.int64)
        second = ids >= len(self.a.size)
        a, b = ids[~second], ids[second] - len(self.a.size)
        owner = np.repeat(np.arange(len(new)), np.fromiter(map(len, new), np.int64, len(new)) >> 2)
        n_a, n_b = (np.bincount(owner[side], minlength=len(new)) for side in (~second, second))
        group_a, group_b = groups_of(self.a.size[a], self.b.size[b])
        total = int(group_a[-1]) + 1
        count_a, count_b = (np.bincount(g, minlength=total) for g in (group_a, group_b))
        last_a, last_b = np.cumsum(count_a), np.cumsum(count_b)
        # The marks of all tokens in the order of the text: a group's first ids, then its second.
        marks = np.zeros(len(a) + len(b), np.int64)
        marks[np.arange(len(a)) + (last_b - count_b)[group_a]] = (
            2 * a + (np.arange(1, len(a) + 1) == last_a[group_a]))
        marks[np.arange(len(b)) + last_a[group_b]] = 2 * len(self.a.size) + (
            2 * b + (np.arange(1, len(b) + 1) == last_b[group_b]))
        shown = list(map(self.marks.__getitem__, marks.tolist()))
        ends = np.cumsum(n_a + n_b).tolist()
        self.text += ["".join(shown[i:j])[:-1] for i, j in zip([0, *ends], ends)]
        # Links lie group by group, and groups window by window.
        group, key, times = group_links(group_a, a, group_b, b)
        window = np.repeat(np.arange(len(new)), n_a)[last_a - 1]
        count = np.bincount(window[group], minlength=len(new))
        self.first = np.append(self.first, len(self.keys) + np.cumsum(count) - count)
        self.count = np.append(self.count, count)
        self.keys, self.times = np.append(self.keys, key), np.append(self.times, times)
        self.groups = np.append(self.groups, np.bincount(window, minlength=len(new)))
        links = np.zeros(len(new), np.int64)
        np.add.at(links, window, count_a * count_b)
        self.links = np.append(self.links, links)

    def block(self, ids: list[int | None], texts: list[str]) -> dict:
        """Numbers of the documents, and the distinct keys of the block with their documents."""
        if len(self.windows) > MEMO_WINDOWS:
            self.forget()
        ids_a, ids_b = self._tokenised(texts)
        n_a, n_b = (np.array([len(i) for i in side], np.int64) for side in (ids_a, ids_b))
        a, b = np.concatenate(ids_a), np.concatenate(ids_b)
        del ids_a, ids_b
        windows, sizes = self._numbers(a, b, n_a)
        del a, b
        if self.windows.new:
            self._learn()
        doc = np.repeat(np.arange(len(texts)), sizes)
        groups, links = np.zeros((2, len(texts)), np.int64)
        np.add.at(groups, doc, self.groups[windows])
        np.add.at(links, doc, self.links[windows])
        # Every window once a document, then its distinct links, then the document's.
        seen, often = np.unique(doc << 32 | windows, return_counts=True)
        window = seen & 0xFFFFFFFF
        count = self.count[window]
        at = repeated(self.first[window], count)
        keys, place = np.unique(self.keys[at], return_inverse=True)
        pairs, which = np.unique(np.repeat(seen >> 32, count) << 32 | place, return_inverse=True)
        times = np.zeros(len(pairs), np.int64)
        np.add.at(times, which, np.repeat(often, count) * self.times[at])
        place = (pairs & 0xFFFFFFFF).astype("<i4")
        ends = np.searchsorted(pairs >> 32, np.arange(1, len(texts) + 1)).tolist()
        numbers, upto = windows.tolist(), np.cumsum(sizes).tolist()
        rows = []
        for i, (begin, end, first, last) in enumerate(zip([0, *ends], ends, [0, *upto], upto)):
            text = ";".join(map(self.text.__getitem__, numbers[first:last]))
            rows.append({
                "doc_id": ids[i], "n_a": int(n_a[i]), "n_b": int(n_b[i]),
                "n_groups": int(groups[i]), "n_links": int(links[i]),
                "groups_sha256": hashlib.sha256(text.encode()).hexdigest() if text else "",
                "pairs": place[begin:end].tobytes(), "times": times[begin:end].astype("<i8").tobytes()})
        return {"keys": keys, "held": np.bincount(place, minlength=len(keys)), "docs": rows}


def aligned_blocks(docs: DataFrame, id_col: str, text_col: str, vocabulary: str,
                   model: str) -> DataFrame:
    """Blocks of documents with their numbers; links by place in the block's distinct keys."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(byte_level_tokens(vocabulary), piece_tokens(model))
        first = TaskContext.get().partitionId() << 32
        for i, batch in enumerate(slices(batches, "text", BLOCK_BYTES)):
            row = aligner.block(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            yield pa.RecordBatch.from_pylist([{"block": first + i, **row}], SCHEMA)

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                       whole_text(text_col).alias("text"))
    return map_arrow(rows, run, BLOCK)


SCHEMA = pa.schema([
    ("block", pa.int64()), ("keys", pa.list_(pa.int64())), ("held", pa.list_(pa.int64())),
    ("docs", pa.list_(pa.struct([
        ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()),
        ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups_sha256", pa.string()),
        ("pairs", pa.binary()), ("times", pa.binary())])))])

RESULT = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, "
          "count_sum long, groups_sha256 string")


def pair_counts(blocks: DataFrame) -> DataFrame:
    """key, n (documents that hold the pair linked) and best (n is the highest of its first id)."""
    counts = blocks.select(F.explode(F.arrays_zip("keys", "held")).alias("p")).groupBy(
        F.col("p.keys").alias("key")).agg(F.sum("p.held").alias("n"))
    highest = Window.partitionBy(F.shiftright("key", 32))
    return counts.withColumn("best", F.col("n") == F.max("n").over(highest))


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links"]
    for batch in batches:
        for i in range(batch.num_rows):
            found, docs = batch.column(1)[i].values, batch.column(0)[i].values
            place, n, best = (found.field(c).to_numpy(zero_copy_only=False)
                              for c in ("place", "n", "best"))
            count, high = np.zeros((2, len(found)), np.int64)
            count[place], high[place] = n, best
            n_best, count_sum = [], []
            for pairs, times in zip(docs.field("pairs"), docs.field("times")):
                at = np.frombuffer(pairs.as_buffer(), "<i4")
                often = np.frombuffer(times.as_buffer(), "<i8")
                n_best.append(int(high[at] @ often))
                count_sum.append(int(count[at] @ often))
            yield pa.RecordBatch.from_arrays(
                [*[docs.field(c) for c in names], pa.array(n_best, pa.int64()),
                 pa.array(count_sum, pa.int64()), docs.field("groups_sha256")],
                names=[*names, "n_best", "count_sum", "groups_sha256"])


def token_links(docs: DataFrame, vocabulary: str, model: str, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """Per document how its tokens of both kinds group and link, and how usual its links are.

    Returns doc_id, n_a, n_b, n_groups, n_links, n_best (links whose count is the highest of
    their first id, ties included), count_sum (counts of all links) and groups_sha256.
    The count of an id pair is the number of documents that hold it linked. Null and empty
    texts, and texts whose tokens do not spell a space and the text, have no tokens: zeros and an
    empty digest. Repeated rows are documents of their own and count as often as they occur.
    Other columns are not read, so their names cannot clash. An empty table gives an empty result.
    """
    blocks = materialize(aligned_blocks(docs, id_col, text_col, vocabulary, model))
    wanted = blocks.select("block", F.posexplode("keys").alias("place", "key"))
    found = wanted.join(pair_counts(blocks), "key").groupBy("block").agg(
        F.collect_list(F.struct("place", "n", "best")).alias("found"))
    ready = blocks.select("block", "docs").join(found, "block", "left").select(
        "docs", F.coalesce("found", F.array().cast(found.schema["found"].dataType)).alias("found"))
    return map_arrow(ready, _summed, RESULT)
