"""SentencePiece encoding of giant documents by a max-plus scan over chunks.

The ids are those of the SentencePiece library for a byte-pair model. A path of pieces is the
library's segmentation if and only if each two neighbours stay two pieces when they are merged
by themselves; so segmentation is a best path whose steps score the piece if it is compatible
with the one before and minus infinity otherwise. A chunk, cut anywhere, is summed up by a
matrix from the pieces that may reach into it to those that may reach out of it. Matrices of
neighbours combine associatively in the (max, +) algebra; going back through the combination
gives the piece at every cut, and each chunk then fills in its own ids.

Inside a chunk a place before a word start is passed by every path, so the matrix is an entry
part and an exit part, a few characters each, and the words between are encoded by the library.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import ExitStack
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabforge.llm.common import map_arrow, ship, slices, whole_text
from tabforge.session import materialize, temporary

SPACE = "▁"
START = ""  # state of a cut that no piece reaches across
ENCODED = "row long, chunk int, ids binary"

State = str  # "k:piece": the last piece and how many of its characters lie beyond the cut


class BytePairModel:
    """The pieces of a byte-pair model, with merging of short strings."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        lib = self.library
        self.rank: dict[str, float] = {}
        self.id: dict[str, int] = {}
        self.byte = [0] * 256
        for i in range(lib.get_piece_size()):
            piece = lib.id_to_piece(i)
            if lib.is_byte(i):
                self.byte[int(piece[3:5], 16)] = i
            elif not (lib.is_control(i) or lib.is_unknown(i) or lib.is_unused(i)):
                self.rank[piece] = lib.get_score(i)
                self.id[piece] = i
        self.longest = max(map(len, self.rank), default=1)
        self.unknown = lib.unk_id()
        self.compatible = lru_cache(maxsize=1 << 16)(self._compatible)

    def merge(self, text: str) -> list[str]:
        """Merge the neighbours whose union scores best, the leftmost of equals, to the end."""
        parts = list(text)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = self.rank.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                return parts
            parts[at:at + 2] = [parts[at] + parts[at + 1]]

    def _compatible(self, before: str, piece: str) -> bool:
        return self.merge(before + piece) == [x for x in (before, piece) if x]

    def ids(self, pieces: list[str]) -> list[int]:
        out = []
        for p in pieces:
            if p in self.id:
                out.append(self.id[p])
            else:
                out += [self.byte[b] or self.unknown for b in p.encode("utf-8", "surrogatepass")]
        return out

    def encode_marked(self, text: str) -> list[int]:
        """Ids of normalised text that begins with a space mark, or is empty."""
        if len(text) < 2:  # of no text the library gives no mark
            return self.ids(list(text))
        return self.library.encode(text[1:].replace(SPACE, " "))

    def pieces_at(self, text: str, at: int) -> Iterator[str]:
        """Pieces that begin there; a single character always is one."""
        for n in range(1, min(self.longest, len(text) - at) + 1):
            piece = text[at:at + n]
            if n == 1 or piece in self.rank:
                yield piece

    def paths(self, text: str, begin: int, before: str, limit: int,
              hard: bool) -> dict[State, tuple[float, list[str]]]:
        """Best path from a place after piece ``before`` to each state at ``limit``.

        At a hard limit no piece crosses. Scores of compatible steps add up.
        """
        best: dict[tuple[int, str], tuple[float, tuple[int, str] | None]] = {
            (begin, before): (0.0, None)}
        todo: dict[int, list[str]] = {begin: [before]}
        out: dict[State, tuple[float, list[str]]] = {}
        for place in range(begin, limit + self.longest):
            for last in todo.pop(place, ()):
                node = (place, last)
                if place >= limit:
                    state = START if hard else f"{place - limit}:{last}"
                    if best[node][0] > out.get(state, (-np.inf, []))[0]:
                        out[state] = (best[node][0], self._back(best, node))
                    continue
                for piece in self.pieces_at(text, place):
                    end = place + len(piece)
                    if hard and end > limit or not self.compatible(last, piece):
                        continue
                    score = best[node][0] + max(self.rank.get(piece, 0.0), -1e6)
                    if (end, piece) not in best:
                        todo.setdefault(end, []).append(piece)
                    elif best[(end, piece)][0] >= score:
                        continue
                    best[(end, piece)] = (score, node)
        return out

    @staticmethod
    def _back(best, node) -> list[str]:
        pieces = []
        while best[node][1] is not None:
            pieces.append(node[1])
            node = best[node][1]
        return pieces[::-1]


@lru_cache(maxsize=2)
def load(path: str) -> BytePairModel:
    return BytePairModel(path)


def word_start(text: str, at: int) -> bool:
    """No piece reaches across: pieces have the space mark in front only, or are runs of it."""
    return 0 < at < len(text) and text[at] == SPACE and text[at - 1] != SPACE


def entry_states(model: BytePairModel, text: str, cut: int) -> list[State]:
    """Pieces that may end at a cut or reach across it."""
    if cut == 0 or cut == len(text) or word_start(text, cut):
        return [START]
    found = []
    for begin in range(max(0, cut - model.longest), cut):
        found += [f"{begin + len(p) - cut}:{p}" for p in model.pieces_at(text, begin)
                  if begin + len(p) >= cut]
    return found


def _resolve(state: State) -> tuple[int, str]:
    if state == START:
        return 0, ""
    k, piece = state.split(":", 1)
    return int(k), piece


Part = dict[State, dict[State, tuple[float, list[str]]]]


def transfer(model: BytePairModel, left: str, body: str, right: str, first: bool,
             last: bool) -> tuple[Part, list[int] | None, Part]:
    """Entry part, ids of the whole words between, exit part; ids are None without a word start.

    Texts are normalised: spaces are marks, and the first chunk begins with one. Then the entry
    part alone is the matrix from entry to exit states.
    """
    text, cut, end = left + body + right, len(left), len(left) + len(body)
    entries = [START] if first else entry_states(model, text, cut)
    closed = last or word_start(text, end)
    starts = [0] if first else []
    if not first:
        at = next((i for i in range(cut, end) if word_start(text, i)), None)
        starts = [] if at is None else [at]
    if not starts:
        matrix = {}
        for state in entries:
            k, piece = _resolve(state)
            # Without a word start a long piece may reach over the whole chunk.
            if k > len(body):
                matrix[state] = {f"{k - len(body)}:{piece}": (0.0, [])}
            else:
                matrix[state] = model.paths(text, cut + k, piece, end, closed)
        return matrix, None, {}
    begin = starts[0] if not first else cut
    entry = {}
    for state in entries:
        k, piece = _resolve(state)
        if state == START and begin == cut:
            entry[state] = {START: (0.0, [])}
        elif cut + k <= begin:
            entry[state] = model.paths(text, cut + k, piece, begin, True)
    if closed:
        tail = end
    else:
        tail = next((i for i in range(end - 1, begin, -1) if word_start(text, i)), begin)
    exits = {START: {START: (0.0, [])} if closed else model.paths(text, tail, "", end, False)}
    return entry, model.encode_marked(text[begin:tail]), exits


def combine(a: dict, b: dict) -> dict:
    """Product in the (max, +) algebra: {(from, to): (score, state between)}."""
    by_entry: dict[State, list] = {}
    for (s, t), (score, _) in b.items():
        by_entry.setdefault(s, []).append((t, score))
    out: dict = {}
    for (s, middle), (score, _) in a.items():
        for t, more in by_entry.get(middle, ()):
            if score + more > out.get((s, t), (-np.inf, ""))[0]:
                out[s, t] = (score + more, middle)
    return out


def scan(matrices: list[dict]) -> list[State]:
    """States at all cuts of the best path, from START to START, by a tree of products."""
    levels = [matrices]
    while len(levels[-1]) > 1:
        now = levels[-1]
        levels.append([combine(*now[i:i + 2]) if i + 1 < len(now) else now[i]
                       for i in range(0, len(now), 2)])
    ends = [(START, START)]
    for below in reversed(levels[:-1]):
        nexts = []
        for i, (s, t) in enumerate(ends):
            if 2 * i + 1 < len(below):
                middle = combine(below[2 * i], below[2 * i + 1])[s, t][1]
                nexts += [(s, middle), (middle, t)]
            else:
                nexts.append((s, t))
        ends = nexts
    return [START] + [t for _, t in ends]


def _pack(ids: list[int]) -> bytes:
    return np.array(ids, dtype="<u4").tobytes()


def _flat(model: BytePairModel, part: Part) -> list[dict]:
    return [{"entry": s, "exit": t, "score": score, "ids": _pack(model.ids(pieces))}
            for s, row in part.items() for t, (score, pieces) in row.items()]


PART = pa.list_(pa.struct([("entry", pa.string()), ("exit", pa.string()),
                           ("score", pa.float64()), ("ids", pa.binary())]))
PART_SQL = "array<struct<entry:string,exit:string,score:double,ids:binary>>"


def encode(docs: DataFrame, model_path: str, chunk: int = 16_384, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """Ids of every whole text in chunks: doc_id, chunk (from 0), chunks, ids (little-endian
    unsigned 32-bit).

    Joined in order, the ids of the chunks of a row are the library's ids of the whole text. A
    piece that reaches across a cut belongs to the chunk where it begins. Null and empty text
    give one chunk without ids. A repeated row is encoded as often as it occurs (its chunks then
    occur repeatedly). Other columns are not read. Only the matrices of one document, a few
    numbers per chunk, meet in one task.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                       whole_text(text_col).alias("text"))
    with ExitStack() as stack:
        short = _encode_short(rows.filter(F.length("text") <= chunk), model_path)
        cut = _cut(rows.filter(F.length("text") > chunk).withColumn(
            "row", F.monotonically_increasing_id()), model_path, chunk)
        cut = cut.repartition("row", "chunk")
        parts = stack.enter_context(temporary(_transfer(cut, model_path)))
        states = parts.select("row", "chunk", "entry", "whole", "exit").groupBy("row").applyInPandas(
            _states, "row long, chunk int, arrives string, leaves string")
        done = parts.join(states, ["row", "chunk"])
        ids = F.expr(
            "concat(filter(entry, x -> x.entry = arrives AND x.exit = IF(whole IS NULL, leaves, ''))"
            "[0].ids, IF(whole IS NULL, X'', concat(whole, "
            "filter(exit, x -> x.exit = leaves)[0].ids)))")
        long = materialize(done.select("doc_id", "chunk", "chunks", ids.alias("ids")))
        return short.union(long)


def _encode_short(rows: DataFrame, model_path: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(model_path)
        for batch in slices(batches, "text", 4 << 20):
            n = batch.num_rows
            ids = [_pack(x) for x in model.library.encode(batch.column(1).to_pylist())] if n else []
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([0] * n, pa.int32()), pa.array([1] * n, pa.int32()),
                 pa.array(ids, pa.binary())], names=["doc_id", "chunk", "chunks", "ids"])

    return map_arrow(rows, run, "doc_id long, chunk int, chunks int, ids binary")


def _cut(rows: DataFrame, model_path: str, size: int) -> DataFrame:
    """Chunks with as much of their neighbours as a piece can span."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reach = load(model_path).longest
        for batch in slices(batches, "text", 1 << 20):
            for doc, text, row in zip(*(c.to_pylist() for c in batch.columns)):
                text = SPACE + text.replace(" ", SPACE)
                places = range(0, len(text), size)
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array([doc] * len(places), pa.int64()),
                    "row": pa.array([row] * len(places), pa.int64()),
                    "chunk": pa.array(range(len(places)), pa.int32()),
                    "chunks": pa.array([len(places)] * len(places), pa.int32()),
                    "before": pa.array([text[max(0, p - reach):p] for p in places]),
                    "body": pa.array([text[p:p + size] for p in places]),
                    "after": pa.array([text[p + size:p + size + reach] for p in places])})

    return map_arrow(rows, run, "doc_id long, row long, chunk int, chunks int, before string, "
                                "body string, after string")


def _transfer(chunks: DataFrame, model_path: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(model_path)
        for batch in slices(batches, "body", 1 << 20):
            entry, whole, leave = [], [], []
            of = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            for left, body, right, at, n in zip(*(of[c].to_pylist() for c in (
                    "before", "body", "after", "chunk", "chunks"))):
                a, ids, b = transfer(model, left, body, right, at == 0, at == n - 1)
                entry.append(_flat(model, a))
                whole.append(None if ids is None else _pack(ids))
                leave.append(_flat(model, b))
            yield pa.RecordBatch.from_arrays(
                [of["doc_id"], of["row"], of["chunk"], of["chunks"], pa.array(entry, PART),
                 pa.array(whole, pa.binary()), pa.array(leave, PART)],
                names=["doc_id", "row", "chunk", "chunks", "entry", "whole", "exit"])

    return map_arrow(chunks, run, f"doc_id long, row long, chunk int, chunks int, "
                                  f"entry {PART_SQL}, whole binary, exit {PART_SQL}")


def _states(frame: pd.DataFrame) -> pd.DataFrame:
    """States at the cuts of one document, from the matrices of its chunks."""
    frame = frame.sort_values("chunk")
    matrices = []
    for entry, whole, leave in zip(frame["entry"], frame["whole"], frame["exit"]):
        if whole is None:
            matrices.append({(x["entry"], x["exit"]): (x["score"], "") for x in entry})
        else:
            matrices.append({(x["entry"], y["exit"]): (x["score"] + y["score"], "")
                             for x in entry for y in leave})
    states = scan(matrices)
    return pd.DataFrame({"row": frame["row"], "chunk": frame["chunk"],
                         "arrives": states[:-1], "leaves": states[1:]})


def decode(encoded: DataFrame, model_path: str, keep: Sequence[str] = ()) -> DataFrame:
    """Text of each chunk of ids: doc_id, chunk, chunks, the columns ``keep``, text.

    Joined in order, the chunks of a row give its text; a space mark in the text reads as a
    space. Bytes that are no valid UTF-8 become replacement characters.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(model_path)
        size = model.library.get_piece_size()
        table = [model.library.id_to_piece(i).replace(SPACE, " ").encode() for i in range(size)]
        for value, i in enumerate(model.byte):
            table[i] = bytes([value])
        pieces = np.array(table, dtype=object)
        for batch in slices(batches, "ids", 4 << 20):
            texts = []
            for at, ids in zip(batch.column(1).to_pylist(), batch.column(last).to_pylist()):
                raw = b"".join(pieces[np.frombuffer(ids, "<u4")])
                text = raw.decode("utf-8", "replace")
                texts.append(text[1:] if at == 0 and text[:1] == " " else text)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:last], pa.array(texts, pa.string())], names=[*names, "text"])

    names = ["doc_id", "chunk", "chunks", *keep]
    last = len(names)
    rows = encoded.select(*names, "ids")
    schema = T.StructType(rows.schema.fields[:last]).add("text", "string")
    return map_arrow(rows, run, schema)
