"""Nearest neighbours by inner product with a forest of hash prefixes.

Every tree gives a vector a long string of sign bits. In a sorted array of these strings the
vectors that share a prefix lie side by side, so one array serves prefixes of every length.
Queries start at the length at which a bounded sample of them reaches the wanted recall against
all vectors. From there each ascends by itself, all trees at once, until it has k vectors and
the angles to those say that so short a prefix misses few others. Arrays are spread by tree and
leading bits, large ones are cut by salt, and every piece returns the best of its own, so no
task holds a whole tree.
"""

from __future__ import annotations

from contextlib import ExitStack
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabforge.llm.common import ship
from tabforge.session import materialize, temporary

BITS = 32


@dataclass
class Forest:
    """Random hyperplanes of all trees; ``reach`` is the largest norm among the vectors."""

    trees: int
    dims: int
    reach: float
    seed: int = 42

    def planes(self) -> np.ndarray:
        rng = np.random.default_rng(self.seed)
        return rng.standard_normal((self.dims + 1, self.trees * BITS))

    def strings(self, vectors: np.ndarray, stored: bool) -> np.ndarray:
        """Hash strings (rows x trees). A further coordinate gives stored vectors one norm, so
        that the angle to a query orders them by inner product."""
        lift = np.zeros(len(vectors))
        if stored:
            lift = np.sqrt(np.maximum(self.reach ** 2 - (vectors ** 2).sum(axis=1), 0.0))
        bits = np.column_stack((vectors, lift)) @ self.planes() > 0
        weights = np.uint64(1) << np.arange(BITS - 1, -1, -1, dtype=np.uint64)
        return (bits.reshape(len(vectors), self.trees, BITS) * weights).sum(
            axis=2, dtype=np.uint64).astype(np.int64)


def usable(vector: str, dims: int) -> Column:
    """Vectors of the right length that are not zero and have finite components only."""
    v = F.col(vector)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return v.isNotNull() & (F.size(v) == dims) & finite & F.exists(v, lambda x: x != 0)


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64) if len(column) else np.empty((0, 0))


def best(scores: np.ndarray, ids: np.ndarray, own: int, k: int) -> np.ndarray:
    """Positions of the k largest scores but those of ``own``; ties to the smaller id."""
    keep = np.flatnonzero(ids != own)
    if len(keep) > k:
        floor = np.partition(scores[keep], len(keep) - k)[len(keep) - k]
        keep = keep[scores[keep] >= floor]
    return keep[np.lexsort((ids[keep], -scores[keep]))][:k]


FOUND = "query_id long, vec_id long, score double"


def exact_search(stored: DataFrame, queries: list[tuple[int, list[float]]], k: int) -> DataFrame:
    """All vectors against a bounded list of queries, block by block; k per query and block."""
    of = np.array([q for q, _ in queries], dtype=np.int64)
    wanted = np.array([v for _, v in queries], dtype=np.float64)

    def search(frames):
        for frame in frames:
            ids = frame["vec_id"].to_numpy()
            scores = wanted @ _matrix(frame["v"]).T if len(frame) else np.empty((len(of), 0))
            for i, q in enumerate(of):
                at = best(scores[i], ids, q, k)
                yield pd.DataFrame({"query_id": q, "vec_id": ids[at], "score": scores[i, at]})

    return stored.select("vec_id", "v").mapInPandas(search, FOUND)


def top(found: DataFrame, k: int) -> DataFrame:
    """Best k per query with their rank; a vector found by several trees counts once."""
    once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    ranked = once.withColumn("rank", F.expr(
        "row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)").cast("int"))
    return ranked.filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def prefix_length(stored: DataFrame, queries: DataFrame, forest: Forest, k: int, recall: float,
                  sample: int) -> int:
    """Longest prefix at which the sampled queries reach the recall, by exact search.

    At most ``sample`` queries, those of lowest hash, go through the driver.
    """
    picked = [(r["vec_id"], r["v"]) for r in queries.orderBy(
        F.xxhash64("vec_id"), "vec_id").limit(sample).collect()]
    if not picked:
        return BITS
    vectors = {q: np.array(v, dtype=np.float64) for q, v in picked}
    true = top(exact_search(stored, picked, k), k).join(
        stored.select("vec_id", "v"), "vec_id").select("query_id", "v").collect()
    if not true:
        return BITS
    a = forest.strings(np.array([vectors[r["query_id"]] for r in true]), stored=False)
    b = forest.strings(np.array([r["v"] for r in true], dtype=np.float64), stored=True)
    shared = BITS - np.ceil(np.log2((a ^ b).astype(np.float64) + 1.0))
    longest = np.sort(shared.max(axis=1))[::-1]
    need = min(len(longest), int(np.ceil(recall * len(longest))))
    return int(longest[need - 1])


def nearest(
    vectors: DataFrame, queries: DataFrame, k: int = 20, trees: int = 24, recall: float = 0.96,
    dims: int | None = None, id_col: str = "vec_id", vector_col: str = "embedding",
    sample: int = 256, rows: int = 20_000, seed: int = 42, least: float = 0.9,
) -> DataFrame:
    """The k stored vectors of largest inner product for each query: query_id, rank, vec_id, score.

    A query never finds its own id. Scores are exact, in double precision; equal ones go to the
    smaller id. Vectors that are null, zero, of another length than ``dims`` (by default the
    commonest length) or with null or non-finite components take no part. Of equal vectors the
    k + 1 smallest ids are searched, which is all that can be returned. A repeated row counts
    once. Tables without usable vectors give no rows.

    ``recall`` is the mean over the sampled queries at the common prefix length. A query that
    finds fewer than k vectors there, or whose own expected recall is below ``least``, is
    searched again with shorter prefixes, at worst against all vectors; so every query gets k
    rows if there are as many other vectors.
    """
    spark = vectors.sparkSession
    ship(spark)
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if dims is None:
        lengths = vectors.groupBy(F.size(f"`{vector_col}`").alias("n")).count().filter("n > 0")
        commonest = lengths.orderBy(F.desc("count"), "n").first()
        if commonest is None:
            return empty
        dims = commonest["n"]

    def clean(df: DataFrame) -> DataFrame:
        named = df.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"),
                          F.col(f"`{vector_col}`").cast("array<double>").alias("v"))
        return named.filter(F.col("vec_id").isNotNull() & usable("v", dims)).distinct()

    with ExitStack() as stack:
        stored = clean(vectors).withColumn("copy", F.expr(
            "row_number() OVER (PARTITION BY v ORDER BY vec_id)")).filter(F.col("copy") <= k + 1)
        stored = stack.enter_context(temporary(stored.drop("copy")))
        asked = stack.enter_context(temporary(clean(queries)))
        reach = stored.agg(F.max(F.sqrt(F.expr(
            "aggregate(v, 0D, (s, x) -> s + x * x)")))).first()[0]
        if reach is None:
            return empty
        forest = Forest(trees, dims, float(reach), seed)
        length = prefix_length(stored, asked, forest, k, recall, sample)
        pending = stack.enter_context(temporary(asked.withColumn("depth", F.lit(length))))
        found = spark.createDataFrame([], FOUND)
        while depths := sorted(r["depth"] for r in pending.select("depth").distinct().collect()):
            # The best of a shorter prefix hold those of the longer one.
            again = stack.enter_context(temporary(
                top(_ascend(stored, pending, forest, depths, k, rows), k)))
            found = found.join(again, "query_id", "left_anti").union(again.select(found.columns))
            pending = stack.enter_context(temporary(_shorter(pending, again, forest, k, least)))
        return materialize(top(found, k))


def _ascend(stored: DataFrame, asked: DataFrame, forest: Forest, depths: list[int], k: int,
            rows: int) -> DataFrame:
    """Search by the queries' own prefix lengths, in arrays spread by up to as many bits."""
    leads, lead = [], max(0, depths[-1] - 2)
    while lead:
        leads.append(lead)
        lead //= 2
    found, top_depth = [], BITS + 1
    for lead in [*leads, 0]:
        if any(lead <= d < top_depth for d in depths):
            mine = asked.filter((F.col("depth") >= lead) & (F.col("depth") < top_depth))
            found.append(_search(stored, mine, forest, lead, k, rows))
        top_depth = lead
    return reduce(DataFrame.union, found)


def expected_recall(cosines: np.ndarray, depth: int, trees: int) -> np.ndarray:
    """Chance, meaned over each row, to share ``depth`` bits with such vectors in some tree."""
    same = 1.0 - np.arccos(np.clip(cosines, -1.0, 1.0)) / np.pi
    return (1.0 - (1.0 - same ** depth) ** trees).mean(axis=1)


def _shorter(asked: DataFrame, found: DataFrame, forest: Forest, k: int, least: float) -> DataFrame:
    """The queries to search again, with the depth for it.

    What was found is no nearer than what there is, so a depth at which it is expected with
    ``least`` does for the true neighbours as well. Without k vectors the depth is halved.
    """
    scores = found.groupBy(F.col("query_id").alias("vec_id")).agg(
        F.collect_list("score").alias("scores"))

    def next_depth(frames):
        for frame in frames:
            full = frame["scores"].map(lambda x: x is not None and len(x) == k).to_numpy(bool)
            out = frame["depth"].to_numpy() // 2
            if full.any():
                norms = np.linalg.norm(_matrix(frame["v"][full]), axis=1)
                cosines = _matrix(frame["scores"][full]) / (norms * forest.reach)[:, None]
                old, new = frame["depth"].to_numpy()[full], np.zeros(full.sum(), dtype=int)
                for depth in range(1, int(old.max()) + 1):
                    enough = expected_recall(cosines, depth, forest.trees) >= least
                    new = np.where(enough & (depth <= old), depth, new)
                out[full] = new
            keep = out < frame["depth"].to_numpy()
            yield frame.assign(depth=out)[keep][["vec_id", "v", "depth"]]

    return asked.join(scores, "vec_id", "left").select("vec_id", "v", "depth", "scores").mapInPandas(
        next_depth, "vec_id long, v array<double>, depth int")


def _hashed(df: DataFrame, forest: Forest, lead: int, stored: bool) -> DataFrame:
    """One row per vector and tree with its hash string and leading bits; queries keep their
    depth, and without any bit to share one tree, which holds all vectors, does for them."""
    extra = "" if stored else ", depth int"

    def rows(frames):
        for frame in frames:
            if not len(frame):
                continue
            strings = forest.strings(_matrix(frame["v"]), stored)
            for tree in range(forest.trees):
                out = frame.assign(tree=np.int32(tree), bucket=strings[:, tree] >> (BITS - lead),
                                   string=strings[:, tree])
                yield out if stored or not tree else out[out["depth"] > 0]

    return df.mapInPandas(
        rows, f"tree int, bucket long, string long, vec_id long, v array<double>{extra}")


def _search(stored: DataFrame, asked: DataFrame, forest: Forest, lead: int, k: int,
            rows: int) -> DataFrame:
    index = _hashed(stored, forest, lead, stored=True)
    asked = _hashed(asked, forest, lead, stored=False)
    # Arrays of more than ``rows`` vectors are cut in parts, each searched by itself.
    parts = index.groupBy("tree", "bucket").count().select(
        "tree", "bucket", F.ceil(F.col("count") / rows).cast("int").alias("parts"))
    parts = parts.join(asked.select("tree", "bucket").distinct(), ["tree", "bucket"])
    index = index.join(parts, ["tree", "bucket"]).withColumn(
        "part", F.pmod(F.xxhash64("vec_id"), F.col("parts")).cast("int"))
    asked = asked.join(parts, ["tree", "bucket"]).withColumn(
        "part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))

    def descend(key, array: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if not len(array) or not len(queries):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        array = array.sort_values("string", kind="stable")
        strings, ids, held = array["string"].to_numpy(), array["vec_id"].to_numpy(), _matrix(array["v"])
        out = []
        shifts = (BITS - queries["depth"]).to_numpy()
        for (shift, prefix), group in queries.groupby([shifts, queries["string"].to_numpy() >> shifts]):
            low, high = np.searchsorted(strings, [prefix << shift, (prefix + 1) << shift])
            scores = _matrix(group["v"]) @ held[low:high].T
            for q, line in zip(group["vec_id"].to_numpy(), scores):
                at = best(line, ids[low:high], q, k)
                out.append((np.full(len(at), q), ids[low:high][at], line[at]))
        return pd.DataFrame(dict(zip(("query_id", "vec_id", "score"),
                                     (np.concatenate(x) for x in zip(*out)))))

    by = ["tree", "bucket", "part"]
    return index.select(*by, "string", "vec_id", "v").groupBy(*by).cogroup(
        asked.select(*by, "string", "vec_id", "v", "depth").groupBy(*by)).applyInPandas(descend, FOUND)
