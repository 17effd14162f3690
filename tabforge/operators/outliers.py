"""Outlier policies as an Estimator/Model pair.

Every policy is an in-row predicate, so applying a chain of them is one projection and one
filter; only the IQR fences need a pass over the data, in ``fit``.
"""

from __future__ import annotations

import json
import logging
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import or_
from typing import Any

from pyspark import keyword_only
from pyspark.ml import Estimator
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabforge.config import CRITICAL_LIMITS, default_config, matching_column
from tabforge.functions.scalar import as_double, flag, holds, outside
from tabforge.operators.profile import iqr_bounds, rows_from_aggregate
from tabforge.operators.stage import FittedStage

log = logging.getLogger(__name__)

# Policy names accepted in a strategy list.
STRATEGIES = ("abnormal", "combine", "gost_binar", "gost_remove", "iqr_remove")


@dataclass
class Rule:
    """A predicate with the label and limit it is reported under."""

    label: str
    hit: Column
    limit: Any


@dataclass
class Step:
    strategy: str
    drops: list[Rule] = field(default_factory=list)
    flags: list[tuple[str, Rule]] = field(default_factory=list)

    def any_drop(self) -> Column | None:
        return reduce(or_, [holds(r.hit) for r in self.drops]) if self.drops else None


def limits(config: Mapping[str, Any]) -> dict[str, Any]:
    """Critical and warning limits: configured values, else the defaults."""
    critical = {**CRITICAL_LIMITS, **{
        k: v for k, v in config.get("abnormal_value", {}).items() if k in CRITICAL_LIMITS}}
    ranges = config.get("standard_value", {})
    return {
        "ranges": ranges,
        "sp_critical": critical["sp_c_pct"],
        "fa_critical": critical["fine_aggregate"],
        "sp_warning": ranges.get("sp_c_pct", {}).get("max", 0.025),
        "fa_warning": ranges.get("fine_aggregate", {}).get("max", 800),
    }


def _pick(columns: Sequence[str], *names: str) -> str | None:
    return next((n for n in names if n in columns), None)


def build_step(strategy: str, columns: Sequence[str], lim: Mapping[str, Any],
               fences: Mapping[str, Mapping[str, float]]) -> Step:
    """Predicates of one policy for a table with these columns."""
    step = Step(strategy)
    sp = _pick(columns, "Sp/C_pct", "sp_c_pct")
    fa = _pick(columns, "Fine Aggregate", "fine_aggregate")
    if strategy == "abnormal":
        # The two limits differ on purpose: the ratio is hit at the limit, the mass above it.
        if sp:
            step.drops.append(Rule("Sp/C_pct", as_double(sp) >= lim["sp_critical"],
                                   lim["sp_critical"]))
        if fa:
            step.drops.append(Rule("Fine Aggregate", as_double(fa) > lim["fa_critical"],
                                   lim["fa_critical"]))
    elif strategy == "combine":
        for source, name, kind in ((sp, "High_SP", "sp"), (fa, "High_FA", "fa")):
            if source:
                x = as_double(source)
                critical, warning = lim[f"{kind}_critical"], lim[f"{kind}_warning"]
                step.drops.append(Rule(source, x >= critical, critical))
                step.flags.append((name, Rule(name, x >= warning, warning)))
    elif strategy in ("gost_binar", "gost_remove"):
        for key, span in lim["ranges"].items():
            source = matching_column(list(columns), key)
            low, high = span.get("min"), span.get("max")
            if source is None or low is None or high is None:
                continue
            rule = Rule(key, outside(as_double(source), low, high), f"{low}-{high}")
            if strategy == "gost_remove":
                step.drops.append(rule)
            else:
                step.flags.append((f"Outlier_{key}", rule))
    elif strategy == "iqr_remove":
        for name, b in fences.items():
            if name in columns:
                step.drops.append(Rule(
                    f"IQR_{name}", outside(as_double(name), b["lower"], b["upper"]),
                    f"{b['lower']:.2f}-{b['upper']:.2f}"))
    else:
        log.warning("unknown outlier strategy %r is skipped", strategy)
    return step


class OutlierHandler(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Chain of outlier policies, applied in the listed order.

    The fences of ``iqr_remove`` always come from the table given to ``fit``, whatever policies
    precede it in the chain.
    """

    strategies = Param(Params._dummy(), "strategies", "policy names", TypeConverters.toListString)
    config = Param(Params._dummy(), "config", "threshold configuration as JSON",
                   TypeConverters.toString)
    targetCol = Param(Params._dummy(), "targetCol", "target, left out of every rule",
                      TypeConverters.toString)
    keyCols = Param(Params._dummy(), "keyCols", "row keys, left out of every rule",
                    TypeConverters.toListString)

    @keyword_only
    def __init__(self, *, strategies=None, config=None, targetCol=None, keyCols=None):
        super().__init__()
        self._setDefault(strategies=["abnormal"], config=json.dumps(default_config()), keyCols=[])
        given = {k: v for k, v in self._input_kwargs.items() if v is not None}
        if isinstance(given.get("config"), Mapping):
            given["config"] = json.dumps(dict(given["config"]))
        self._set(**given)

    def _fit(self, df: DataFrame) -> OutlierModel:
        strategies = self.getOrDefault(self.strategies)
        skip = set(self.getOrDefault(self.keyCols))
        if self.isDefined(self.targetCol):
            skip.add(self.getOrDefault(self.targetCol))
        fences = {}
        if "iqr_remove" in strategies:
            fences = iqr_bounds(df.drop(*skip))
        return OutlierModel({
            "strategies": strategies,
            "limits": limits(json.loads(self.getOrDefault(self.config))),
            "fences": fences,
            "input": [c for c in df.columns if c not in skip],
            "skip": sorted(skip),
        })


class OutlierModel(FittedStage):
    def steps(self, columns: Sequence[str]) -> list[Step]:
        """Predicates per policy; target and keys are never tested."""
        s = self.fitted
        tested = [c for c in columns if c not in s["skip"]]
        return [build_step(name, tested, s["limits"], s["fences"]) for name in s["strategies"]]

    def _transform(self, df: DataFrame) -> DataFrame:
        for step in self.steps(df.columns):
            if step.flags:
                df = df.withColumns({name: flag(rule.hit) for name, rule in step.flags})
            drop = step.any_drop()
            if drop is not None:
                df = df.filter(~drop)
        return df

    def removed(self, df: DataFrame) -> DataFrame:
        """The rows any policy of the chain drops."""
        drops = [d for d in (s.any_drop() for s in self.steps(df.columns)) if d is not None]
        return df.filter(reduce(or_, drops)) if drops else df.limit(0)

    def feature_names_out(self) -> list[str]:
        """Names seen by ``fit``; flags added by the chain are not included."""
        return self.fitted["input"]

    def _counted(self, df: DataFrame) -> list[dict[str, Any]]:
        """One record per rule: its hits among the rows the earlier policies left over."""
        alive: Column = F.lit(True)
        records = []
        for i, step in enumerate(self.steps(df.columns)):
            def record(kind: str, rule: Rule) -> dict[str, Any]:
                return {"step": i, "strategy": step.strategy, "kind": kind,
                        "feature": rule.label, "threshold": str(rule.limit),
                        "hits": F.count_if(alive & holds(rule.hit))}
            # The combine policy reports its warning flags, not the rows it drops.
            shown = step.drops if step.strategy != "combine" else []
            records += [record("drop", r) for r in shown]
            records += [record("flag", r) for _, r in step.flags]
            drop = step.any_drop()
            if drop is not None:
                records.append({
                    "step": i, "strategy": step.strategy, "kind": "removed_rows",
                    "feature": None, "threshold": None, "hits": F.count_if(alive & drop)})
                alive = alive & ~drop
        records.append({"step": -1, "strategy": None, "kind": "input_rows", "feature": None,
                        "threshold": None, "hits": F.count("*")})
        records.append({"step": -1, "strategy": None, "kind": "final_rows", "feature": None,
                        "threshold": None, "hits": F.count_if(alive)})
        return records

    def summary_table(self, df: DataFrame) -> DataFrame:
        """(step, strategy, kind, feature, threshold, hits) from a single aggregate."""
        return rows_from_aggregate(df, [
            {**r, **{k: F.lit(r[k]).cast("string") for k in ("strategy", "feature", "threshold")}}
            for r in self._counted(df)])

    def summary(self, df: DataFrame) -> dict[str, Any]:
        """Shapes, removed rows, flags with hits and hits per feature, as a driver dict."""
        rows = self.summary_table(df).collect()
        total = {r["kind"]: r["hits"] for r in rows if r["step"] == -1}
        by_feature: dict[str, list[dict[str, Any]]] = {}
        created, applied = [], []
        for r in sorted((r for r in rows if r["step"] >= 0), key=lambda r: r["step"]):
            if r["kind"] == "removed_rows":
                if r["hits"]:
                    applied.append(f"{r['strategy']}: {r['hits']} rows")
                continue
            if r["strategy"] in ("gost_binar", "gost_remove", "iqr_remove") and not r["hits"]:
                continue
            if r["kind"] == "flag":
                created.append(
                    r["feature"] if r["strategy"] == "combine" else f"Outlier_{r['feature']}")
            by_feature.setdefault(r["feature"], []).append(
                {"count": r["hits"], "threshold": r["threshold"]})
        return {
            "original_shape": (total["input_rows"], len(df.columns)),
            "final_shape": (total["final_rows"], len(self.transform(df).columns)),
            "removed_rows": total["input_rows"] - total["final_rows"],
            "strategies_applied": applied,
            "binary_features_created": created,
            "outliers_by_feature": by_feature,
        }
