"""Quality classifier as a sparse rule ensemble.

Statistics of a text are built-in column expressions. Shallow trees grown on a bounded sample
of labelled rows give conjunctive rules, a lasso logistic regression keeps few of them, and
the kept rules are compiled into one column expression, so that scoring is a projection.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field
from functools import reduce
from operator import and_

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabforge.llm.common import whole_text
from tabforge.session import temporary

# Patterns whose matched characters are counted.
CLASSES = {
    "letter": r"\p{L}", "upper": r"\p{Lu}", "digit": r"\p{N}", "stop": r"[.,;:]",
    "symbol": r"[#$%&*+=<>@^_~|/\\{}\[\]]", "excited": r"[!?]", "space": r"\s",
}
STATISTICS = (
    "log_chars", "letters", "uppers", "digits", "stops", "symbols", "excited", "spaces",
    "mean_word", "distinct_words", "richness", "mean_line", "log_lines", "distinct_lines",
)


def _matched(text: Column, pattern: str) -> Column:
    """Number of characters of the class: what is lost when all of them are removed."""
    return F.length(text) - F.length(F.regexp_replace(text, f"{pattern}+", ""))


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the statistics of each whole text; all are finite, also for empty text."""
    base = docs.select(F.col(f"`{id_col}`").alias("doc_id"), whole_text(text_col).alias("text"))
    counted = base.select(
        "doc_id", F.length("text").alias("n"),
        *[_matched(F.col("text"), p).alias(c) for c, p in CLASSES.items()],
        F.split(F.lower("text"), r"\s+").alias("words"), F.split("text", "\n").alias("lines"))
    n = F.greatest(F.col("n"), F.lit(1))
    words, lines = F.size("words"), F.size("lines")
    return counted.select(
        "doc_id",
        F.log1p("n").alias("log_chars"), (F.col("letter") / n).alias("letters"),
        (F.col("upper") / F.greatest("letter", F.lit(1))).alias("uppers"),
        (F.col("digit") / n).alias("digits"), (F.col("stop") / n).alias("stops"),
        (F.col("symbol") / n).alias("symbols"), (F.col("excited") / n).alias("excited"),
        (F.col("space") / n).alias("spaces"),
        ((F.col("n") - F.col("space")) / words).alias("mean_word"),
        (F.size(F.array_distinct("words")) / words).alias("distinct_words"),
        # How distinct words grow with words, which hardly depends on the length.
        (F.log1p(F.size(F.array_distinct("words"))) / F.log1p(words)).alias("richness"),
        (F.col("n") / lines).alias("mean_line"), F.log(lines).alias("log_lines"),
        (F.size(F.array_distinct("lines")) / lines).alias("distinct_lines"))


@dataclass(frozen=True)
class Condition:
    name: str
    above: bool
    threshold: float

    def column(self) -> Column:
        x = F.col(self.name)
        return x > F.lit(self.threshold) if self.above else x <= F.lit(self.threshold)


Rule = tuple[Condition, ...]


def rule_column(rule: Rule) -> Column:
    return reduce(and_, [c.column() for c in rule]).cast("double")


@dataclass
class RuleEnsemble:
    """Weighted rules over statistics; without rules the intercept is the score's log-odds."""

    intercept: float
    weights: dict[Rule, float] = field(default_factory=dict)

    def score(self) -> Column:
        total = F.lit(float(self.intercept))
        for rule, weight in self.weights.items():
            total = total + F.lit(float(weight)) * rule_column(rule)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def tree_rules(printed: str, names: tuple[str, ...]) -> set[Rule]:
    """Rules of the inner and outer nodes of a tree in its printed form: one per path."""
    rules: set[Rule] = set()
    path: list[Condition] = []
    for line in printed.splitlines():
        found = re.match(r"( *)(?:If|Else) \(feature (\d+) (<=|>) ([^)]+)\)", line)
        if found:
            indent, index, sign, value = found.groups()
            del path[len(indent) - 2:]
            path.append(Condition(names[int(index)], sign == ">", float(value)))
            rules.add(_merged(path))
    return rules


def _merged(path: list[Condition]) -> Rule:
    """The tightest bound per statistic and side, in a fixed order."""
    tight: dict[tuple[str, bool], float] = {}
    for c in path:
        pick = max if c.above else min
        key = (c.name, c.above)
        tight[key] = pick(tight.get(key, c.threshold), c.threshold)
    return tuple(Condition(n, a, t) for (n, a), t in sorted(tight.items()))


def train(
    labelled: DataFrame, label: str = "label", most: int = 20_000, trees: int = 16,
    depth: int = 3, lasso: float = 0.002, seed: int = 42,
) -> RuleEnsemble:
    """Fit on at most ``most`` rows (lowest hash of the id first) with statistics and label.

    Rows without a label are left out. With one class or no rows the ensemble has no rules
    and its score is the smoothed share of positives.
    """
    known = labelled.filter(F.col(label).isNotNull())
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most).select(
        F.col(label).cast("double").alias("label"), *STATISTICS)
    with temporary(sample) as rows:
        n, positive = rows.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0.0))).first()
        if positive in (0, n):
            return RuleEnsemble(math.log((positive + 1.0) / (n - positive + 1.0)))
        ready = VectorAssembler(inputCols=list(STATISTICS), outputCol="features").transform(rows)
        forest = RandomForestClassifier(
            numTrees=trees, maxDepth=depth, seed=seed, maxBins=64, minInstancesPerNode=5,
            subsamplingRate=0.8).fit(ready)
        rules = sorted({r for t in forest.trees for r in tree_rules(t.toDebugString, STATISTICS)},
                       key=repr)
        if not rules:
            return RuleEnsemble(math.log((positive + 1.0) / (n - positive + 1.0)))
        flags = [f"r{i}" for i in range(len(rules))]
        hits = rows.select("label", *[rule_column(r).alias(f) for r, f in zip(rules, flags)])
        hits = VectorAssembler(inputCols=flags, outputCol="features").transform(hits)
        with temporary(hits.select("label", "features")) as ready:
            fitted = LogisticRegression(regParam=lasso, elasticNetParam=1.0, maxIter=30,
                                        standardization=False).fit(ready)
    weights = {r: float(w) for r, w in zip(rules, fitted.coefficients.toArray()) if w != 0.0}
    return RuleEnsemble(float(fitted.intercept), weights)


def score(stats: DataFrame, model: RuleEnsemble, threshold: float = 0.7) -> DataFrame:
    """doc_id, score (0 to 1) and predicted (1 from ``threshold`` on) for rows of statistics."""
    scored = stats.select("doc_id", model.score().alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
