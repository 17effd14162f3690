"""The two preparation runs: profile and clean a raw table, and compare outlier strategies
through the whole feature chain."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame

from tabforge.functions.scalar import numeric_columns
from tabforge.operators import association as assoc
from tabforge.operators import profile as prof
from tabforge.operators.clean import add_ratios, clean
from tabforge.operators.engineering import FeatureEngineer
from tabforge.operators.outliers import OutlierHandler
from tabforge.operators.selection import (
    DOMAIN_PRIORITY, CollinearityReducer, UninformativeRemover,
)
from tabforge.operators.transforms import FeatureTransformer
from tabforge.operators.trends import trend_select
from tabforge.operators.zeros import ZeroBinaryEncoder, analyze_zeros
from tabforge.plans.models import SAFE_TRANSFORMS, check_models_by_nepv
from tabforge.session import materialize, temporary

log = logging.getLogger(__name__)

# The compared outlier strategies and the limits of the feature chain.
COMPARED = (("abnormal",), ("combine",), ("gost_binar",), ("gost_remove",), ("iqr_remove",),
            ("gost_binar", "combine"))
CHAIN_VIF, CHAIN_CORRELATION, CHAIN_SHARE, TREND_ALPHA = 15.0, 0.90, 0.95, 0.25

COMPARISON_SCHEMA = (
    "strategy string, original_rows long, final_rows long, removed_rows long, removed_pct double, "
    "engineered int, transformed int, zero_flags int, uninformative_removed int, "
    "collinear_removed int, final_features int, error string")


@dataclass
class Prepared:
    """Cleaned table, its reports (one small frame each) and the configuration with decisions."""

    table: DataFrame
    reports: dict[str, DataFrame]
    config: dict[str, Any]
    models: list[str]


def profile_and_clean(raw: DataFrame, config: Mapping[str, Any], target: str = "Strength",
                      id_col: str = "Id") -> Prepared:
    """Drop id and duplicates, add ratios, store the result once and derive every report from it."""
    table = materialize(add_ratios(clean(raw, id_col)))
    numbers = numeric_columns(table, [target])
    reports = {
        "missing": prof.missing_values(table),
        "describe": prof.describe(table),
        "profile": prof.profile(table),
        "outliers": prof.detect_outliers(table, config),
        "analysis": assoc.feature_analysis(table, target, numbers),
        "trends": trend_select(table, target, TREND_ALPHA, numbers),
        "vif": assoc.vif_bands(assoc.check_multicollinearity(table, target, numbers)),
        "correlations": assoc.correlation_table(table, numbers),
    }
    # The rule counts the target among the columns here, as the whole table is handed to it.
    models = check_models_by_nepv(table, len(table.columns), config.get("task_type", "regression"))
    return Prepared(table, reports, analyze_zeros(table, config, target), models)


def feature_chain(df: DataFrame, target: str, keys: Sequence[str] = (),
                  model_type: str = "trees_models",
                  names: Sequence[str] = SAFE_TRANSFORMS) -> tuple[DataFrame, dict[str, int]]:
    """Derived features, transforms, zero flags, then removal of uninformative and collinear
    columns. Returns the table and the counts of each step."""
    keep = [target, *keys]
    engineer = FeatureEngineer(modelType=model_type).fit(df)
    df = engineer.transform(df)
    transformer = FeatureTransformer(targetCol=target, names=list(names),
                                     passCols=list(keys)).fit(df)
    df = transformer.transform(df)
    encoder = ZeroBinaryEncoder(targetCol=target).fit(df)
    df = encoder.transform(df)
    # The selection steps read many derived columns several times; they are stored once for them.
    with temporary(df) as flat:
        remover = UninformativeRemover(threshold=CHAIN_SHARE, passCols=keep).fit(flat)
        reducer = CollinearityReducer(
            vifThreshold=CHAIN_VIF, correlationThreshold=CHAIN_CORRELATION,
            strategy="domain_priority", priority=list(DOMAIN_PRIORITY), passCols=keep,
        ).fit(remover.transform(flat))
    df = reducer.transform(remover.transform(df))
    return df, {
        "engineered": len(engineer.descriptions()),
        "transformed": len(transformer.best),
        "zero_flags": len(encoder.fitted["significant"]),
        "uninformative_removed": len(remover.removed),
        "collinear_removed": len(reducer.removed),
        "final_features": len(reducer.kept),
    }


def compare_strategies(df: DataFrame, config: Mapping[str, Any], target: str,
                       keys: Sequence[str] = (),
                       strategies: Sequence[Sequence[str]] = COMPARED,
                       parallelism: int = 4) -> DataFrame:
    """One row per outlier strategy after the whole chain; a failing one becomes an error row.

    The strategies do not depend on each other, so their jobs are submitted side by side.
    """
    total = df.count()
    steps = ("engineered", "transformed", "zero_flags", "uninformative_removed",
             "collinear_removed", "final_features")

    def run(strategy: Sequence[str]) -> tuple:
        name = "+".join(strategy)
        try:
            handler = OutlierHandler(strategies=list(strategy), config=dict(config),
                                     targetCol=target, keyCols=list(keys))
            with temporary(handler.fit(df).transform(df)) as kept:
                left = kept.count()
                _, counts = feature_chain(kept, target, keys)
            return (name, total, left, total - left, 100.0 * (total - left) / total,
                    *[counts[s] for s in steps], None)
        except Exception as err:  # reported per strategy, the others still run
            log.warning("strategy %s failed: %s", name, err)
            return (name, total, total, 0, 0.0, 0, 0, 0, 0, 0, None, str(err))

    with ThreadPool(max(1, min(parallelism, len(strategies)))) as pool:
        rows = pool.map(inheritable_thread_target(df.sparkSession)(run), strategies)
    return df.sparkSession.createDataFrame(rows, COMPARISON_SCHEMA)
