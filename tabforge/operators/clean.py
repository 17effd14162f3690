"""Cleaning: derived ratios, id removal, de-duplication, column-order check."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from tabforge.functions.scalar import col, ratio

# Ratio columns of a mixture table as name -> (numerator, denominator).
MIX_RATIOS = {"W/C": ("Water", "Cement"), "Sp/C_pct": ("Superplasticizer", "Cement")}


def add_ratios(df: DataFrame, ratios: Mapping[str, tuple[str, str]] | None = None) -> DataFrame:
    """Add quotient columns; a zero denominator gives NULL."""
    pairs = MIX_RATIOS if ratios is None else ratios
    return df.withColumns({name: ratio(col(n), col(d)) for name, (n, d) in pairs.items()})


def drop_id(df: DataFrame, id_col: str = "Id") -> DataFrame:
    return df.drop(id_col)


def clean(df: DataFrame, id_col: str = "Id") -> DataFrame:
    """Drop the id, then identical rows."""
    return drop_id(df, id_col).dropDuplicates()


def same_feature_order(train: DataFrame, test: DataFrame, target: str = "Strength") -> bool:
    """True if the train columns without the target are the test columns, in order."""
    return [c for c in train.columns if c != target] == test.columns
