"""Language identification by mixture inference.

Training counts hashed letter trigrams per language over all training rows; the model is a
table of fixed size (buckets x languages). Each word of a document is explained by one
language; expectation-maximisation estimates the proportions, and languages leave the set
while the penalised likelihood gains. All documents of a batch are worked on together with
segment sums, so there is no Python step per word or per document.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabforge.llm.common import map_arrow, slices, whole_text

BUCKETS = 1 << 15
BATCH_BYTES = 1 << 20


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


@dataclass
class Words:
    """Trigram buckets of a batch, with the word of each and the document of each word."""

    grams: np.ndarray
    word_start: np.ndarray
    doc_of_word: np.ndarray
    docs: int

    @classmethod
    def of(cls, texts: list[str]) -> Words:
        lowered = [t.lower() for t in texts]
        points = np.frombuffer("\n".join(lowered).encode("utf-32-le", "surrogatepass"), "<u4")
        at = np.flatnonzero(_letters()[points])
        letter = points[at].astype(np.uint64)
        joined = np.zeros(len(at), bool)
        joined[1:] = at[1:] == at[:-1] + 1
        before = np.zeros_like(letter)
        before[1:] = np.where(joined[1:], letter[:-1], 0)
        first = np.zeros_like(letter)
        first[1:] = np.where(joined[1:], before[:-1], 0)
        mixed = (letter * np.uint64(0x9E3779B97F4A7C15)) ^ (
            before * np.uint64(0xC2B2AE3D27D4EB4F)) ^ (first * np.uint64(0x165667B19E3779F9))
        mixed ^= mixed >> np.uint64(29)
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
        grams = (mixed >> np.uint64(64 - 15)).astype(np.int32)
        start = np.flatnonzero(~joined)
        ends = np.cumsum([len(t) + 1 for t in lowered])
        return cls(grams, start, np.searchsorted(ends, at[start], side="right"), len(texts))

    def of_letters(self) -> np.ndarray:
        """Document of each trigram."""
        sizes = np.diff(np.append(self.word_start, len(self.grams)))
        return np.repeat(self.doc_of_word, sizes)


@dataclass
class MixtureModel:
    """Log-likelihood of each trigram bucket (rows) under each language (columns)."""

    languages: list[str]
    table: np.ndarray

    def proportions(self, texts: list[str], penalty: float = 2.0,
                    rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
        """Proportions (documents x languages) and the number of words of each document."""
        words = Words.of(texts)
        sizes = np.bincount(words.doc_of_word, minlength=words.docs)
        k = len(self.languages)
        share = np.zeros((words.docs, k))
        if k == 0 or not len(words.word_start):
            return share, sizes
        likely = np.add.reduceat(self.table[words.grams], words.word_start, axis=0)
        likely = np.exp(likely - likely.max(axis=1, keepdims=True), dtype=np.float64)
        mix = _Mixture(likely, words.doc_of_word, sizes)
        full = np.full((len(mix.present), k), 1.0 / k)
        share[mix.present] = mix.select(mix.climb(full, rounds), penalty, rounds)
        return share, sizes


class _Mixture:
    """EM over the words of the documents that have any."""

    def __init__(self, likely: np.ndarray, doc_of_word: np.ndarray, sizes: np.ndarray):
        self.likely = likely
        self.present = np.flatnonzero(sizes)
        self.sizes = sizes[self.present]
        self.doc = np.repeat(np.arange(len(self.present)), self.sizes)
        self.starts = np.concatenate(([0], np.cumsum(self.sizes)[:-1]))

    def _weighted(self, share: np.ndarray) -> np.ndarray:
        return self.likely * share[self.doc]

    def climb(self, share: np.ndarray, rounds: int) -> np.ndarray:
        for _ in range(rounds):
            got = self._weighted(share)
            total = got.sum(axis=1, keepdims=True)
            got /= np.where(total > 0, total, 1.0)
            share = np.add.reduceat(got, self.starts, axis=0) / self.sizes[:, None]
            share /= np.maximum(share.sum(axis=1, keepdims=True), 1e-300)
        return share

    def loglik(self, share: np.ndarray) -> np.ndarray:
        total = np.log(np.maximum(self._weighted(share).sum(axis=1), 1e-300))
        return np.add.reduceat(total, self.starts)

    def select(self, share: np.ndarray, penalty: float, rounds: int) -> np.ndarray:
        """Drop the smallest language of a document while that costs less than the penalty."""
        price = penalty * np.log(self.sizes + 1.0)
        now, going = self.loglik(share), np.ones(len(share), bool)
        for _ in range(share.shape[1] - 1):
            held = share > 0
            going &= held.sum(axis=1) > 1
            if not going.any():
                break
            weakest = np.where(held, share, np.inf).argmin(axis=1)
            trial = share.copy()
            trial[np.arange(len(share)), weakest] = 0.0
            trial /= np.maximum(trial.sum(axis=1, keepdims=True), 1e-300)
            trial = self.climb(trial, rounds // 3)
            then = self.loglik(trial)
            going &= now - then < price
            share = np.where(going[:, None], trial, share)
            now = np.where(going, then, now)
        return share


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang",
          smoothing: float = 0.5) -> MixtureModel:
    """Trigram counts per language over all rows with text and language.

    What reaches the driver is bounded by buckets x languages. Rows without language or text
    are left out; without any training row the model has no languages.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, np.ndarray] = {}
        for batch in slices(batches, "text", BATCH_BYTES):
            langs = np.array(batch.column(1).to_pylist(), dtype=object)
            words = Words.of(batch.column(0).to_pylist())
            lang_of = langs[words.of_letters()]
            for lang in set(langs):
                held = np.bincount(words.grams[lang_of == lang], minlength=BUCKETS)
                seen[lang] = seen.get(lang, 0) + held
        for lang, held in seen.items():
            at = np.flatnonzero(held)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at)), pa.array(at.astype(np.int32)),
                 pa.array(held[at].astype(np.int64))], names=["lang", "bucket", "n"])

    rows = docs.select(whole_text(text_col).alias("text"),
                       F.col(f"`{lang_col}`").cast("string").alias("lang"))
    partial = map_arrow(rows.filter("lang IS NOT NULL"), count, "lang string, bucket int, n long")
    found = partial.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(found["lang"].unique())
    counts = np.zeros((BUCKETS, len(languages)))
    column = {lang: i for i, lang in enumerate(languages)}
    counts[found["bucket"].to_numpy(dtype=int), found["lang"].map(column).to_numpy(dtype=int)] = (
        found["n"].to_numpy(dtype=float))
    table = np.log(counts + smoothing) - np.log(counts.sum(axis=0) + smoothing * BUCKETS)
    return MixtureModel(languages, table.astype(np.float32))


def predict(docs: DataFrame, model: MixtureModel, id_col: str = "doc_id",
            text_col: str = "text", unknown: str = "und") -> DataFrame:
    """Language of each whole text: doc_id, lang_pred, score, languages, shares.

    ``lang_pred`` has the largest share of the words and ``score`` is that share; ties go to
    the first language in alphabetical order. Null text and text without a letter give
    ``unknown`` with score 0, as does a model without languages. ``languages`` and ``shares``
    are the selected mixture, largest first. One row per input row; repeated rows are
    repeated, other columns are not read.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        names = np.array([*model.languages, unknown], dtype=object)
        for batch in slices(batches, "text", BATCH_BYTES):
            share, sizes = model.proportions(batch.column(1).to_pylist())
            known = (sizes > 0) & bool(model.languages)
            best = np.where(known, share.argmax(axis=1) if model.languages else 0,
                            len(model.languages))
            score = np.where(known, share.max(axis=1) if model.languages else 0.0, 0.0)
            order = [[j for j in np.argsort(-row, kind="stable") if row[j] > 0] for row in share]
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column(0), "lang_pred": pa.array(names[best], pa.string()),
                "score": pa.array(np.clip(score, 0.0, 1.0)),
                "languages": pa.array([[model.languages[j] for j in o] for o in order],
                                      pa.list_(pa.string())),
                "shares": pa.array([[float(row[j]) for j in o] for o, row in zip(order, share)],
                                   pa.list_(pa.float64()))})

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                       whole_text(text_col).alias("text"))
    return map_arrow(
        rows, label, "doc_id long, lang_pred string, score double, languages array<string>, "
               "shares array<double>")
