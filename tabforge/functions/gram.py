"""Cross-product matrices of a feature set and the variance inflation derived from them.

The data is read once, as Arrow batches whose products are added up in two levels; everything
after that works on k x k numbers on the driver.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tabforge.functions.scalar import as_double

SINGULAR = 1e-12
RANK_TOL = 1e-10
# Partial matrices are added up in so many groups first.
GROUPS = 32


@dataclass
class Gram:
    """Row count, means and centred cross products of the complete rows."""

    names: list[str]
    n: int
    means: np.ndarray
    centred: np.ndarray

    def subset(self, names: Sequence[str]) -> Gram:
        at = [self.names.index(x) for x in names]
        return Gram(list(names), self.n, self.means[at], self.centred[np.ix_(at, at)])

    @property
    def raw(self) -> np.ndarray:
        return self.centred + self.n * np.outer(self.means, self.means)

    def std(self, ddof: int = 1) -> np.ndarray:
        return np.sqrt(np.diag(self.centred) / max(self.n - ddof, 1))

    def correlation(self) -> np.ndarray:
        """Pearson matrix; pairs with a constant column are NaN."""
        s = np.sqrt(np.diag(self.centred))
        with np.errstate(invalid="ignore", divide="ignore"):
            return self.centred / np.outer(s, s)


def gram(df: DataFrame, features: Sequence[str]) -> Gram:
    """Cross products of the rows that are complete in all features, from one pass.

    The products of a batch are one matrix product; an aggregate would evaluate one expression
    per pair of features for every row, in a method too long to be compiled.
    """
    features = list(features)
    k = len(features)
    if not k:
        return Gram(features, df.count(), np.zeros(0), np.zeros((0, 0)))
    wide = df.select(*[as_double(f).alias(f"x{i}") for i, f in enumerate(features)])

    # Nested, so that workers without this package can run it.
    def joined(parts: Iterable[tuple[float, np.ndarray, np.ndarray]]
               ) -> tuple[float, np.ndarray, np.ndarray]:
        n, means, centred = 0.0, np.zeros(k), np.zeros((k, k))
        with np.errstate(invalid="ignore"):
            for size, mean, own in parts:
                if size:
                    gap = mean - means
                    centred = centred + own + np.outer(gap, gap) * (n * size / (n + size))
                    means = means + gap * (size / (n + size))
                    n += size
        return n, means, centred

    def packed(part: tuple[float, np.ndarray, np.ndarray]) -> bytes:
        return np.concatenate(([part[0]], part[1], part[2].ravel())).tobytes()

    def unpacked(data: bytes) -> tuple[float, np.ndarray, np.ndarray]:
        v = np.frombuffer(data)
        return v[0], v[1:1 + k], v[1 + k:].reshape(k, k)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        def part(batch: pa.RecordBatch) -> tuple[float, np.ndarray, np.ndarray]:
            x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])
            x = x[~np.isnan(x).any(axis=1)]
            if not len(x):
                return 0.0, np.zeros(k), np.zeros((k, k))
            mean = x.mean(axis=0)
            x -= mean
            return float(len(x)), mean, x.T @ x

        yield pa.RecordBatch.from_arrays(
            [pa.array([TaskContext.get().partitionId() % GROUPS], pa.int32()),
             pa.array([packed(joined(map(part, batches)))], pa.binary())],
            names=["g", "m"])

    def add(frame):
        return frame[:1].assign(m=[packed(joined(map(unpacked, frame["m"])))])

    schema = "g int, m binary"
    rows = wide.mapInArrow(products, schema).groupBy("g").applyInPandas(add, schema).collect()
    n, means, centred = joined(unpacked(r["m"]) for r in rows)
    return Gram(features, int(n), means, centred)


def _unit(matrix: np.ndarray) -> np.ndarray:
    d = np.sqrt(np.diag(matrix))
    d = np.where(d > 0, d, 1.0)
    return matrix / np.outer(d, d)


def _unexplained(matrix: np.ndarray, i: int) -> float:
    """Share of column i's sum of squares left after regressing it on the other columns."""
    unit = _unit(matrix)
    rest = [j for j in range(len(unit)) if j != i]
    if not rest:
        return 1.0
    cross = unit[rest, i]
    coef = np.linalg.pinv(unit[np.ix_(rest, rest)], rcond=1e-12, hermitian=True) @ cross
    return float(1.0 - cross @ coef)


def _as_vif(left: float) -> float:
    return float("inf") if left < SINGULAR else 1.0 / left


def vif_centred(g: Gram) -> dict[str, float]:
    """Variance inflation of each feature in a model with intercept."""
    out = {}
    for i, name in enumerate(g.names):
        constant = g.centred[i, i] <= SINGULAR * max(g.raw[i, i], 1e-300)
        out[name] = float("nan") if constant else _as_vif(_unexplained(g.centred, i))
    return out


def vif_uncentred(g: Gram) -> dict[str, float]:
    """Variance inflation in models without intercept.

    When the other columns span a constant such a model has an intercept after all, and
    the share is taken around the mean.
    """
    raw = g.raw
    sums = g.n * g.means
    out = {}
    for i, name in enumerate(g.names):
        rest = [j for j in range(len(g.names)) if j != i]
        left = _unexplained(raw, i)
        if rest:
            wide = np.block([
                [np.array([[float(g.n)]]), sums[rest][None, :]],
                [sums[rest][:, None], raw[np.ix_(rest, rest)]],
            ])
            if _unexplained(wide, 0) < RANK_TOL and g.centred[i, i] > 0:
                left = left * raw[i, i] / g.centred[i, i]
        out[name] = _as_vif(left)
    return out
