"""Derived mixture features for linear and for tree models."""

from __future__ import annotations


from pyspark import keyword_only
from pyspark.ml import Estimator
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabforge.functions.quantiles import exact_quantiles
from tabforge.functions.scalar import as_double, col, flag, holds, ratio
from tabforge.operators.stage import FittedStage

# Needed input columns, derived names with their meaning, technical limits.
REQUIRED = (
    "Cement", "Blast Furnace Slag", "Fly Ash", "Coarse Aggregate", "Fine Aggregate", "Water",
    "Superplasticizer",
)
LINEAR_DESCRIPTIONS = {
    "Total_powder": "total binder (cement, slag, ash)",
    "Aggregate_ratio": "coarse to fine aggregate",
    "Binder_water_ratio": "binder to water",
}
TREE_DESCRIPTIONS = {
    "Has_Slag": "mixture contains slag (0/1)",
    "Has_FlyAsh": "mixture contains ash (0/1)",
    "Has_Superplasticizer": "mixture contains superplasticizer (0/1)",
    "Low_WC_ratio": "water/cement below its lower quartile",
    "High_WC_ratio": "water/cement above its upper quartile",
    "Low_WC_tech": "water/cement below 0.4",
    "High_WC_tech": "water/cement above 0.6",
}
LOW_TECH, HIGH_TECH = 0.4, 0.6
MODEL_TYPES = ("linear_models", "trees_models")


def _quotient_or_zero(num: Column, den: Column) -> Column:
    return F.when(holds(den > 0), num / den).otherwise(F.lit(0.0))


def _water_cement(df: DataFrame, wc_col: str) -> Column:
    return as_double(wc_col) if wc_col in df.columns else ratio(as_double("Water"),
                                                                as_double("Cement"))


class FeatureEngineer(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    modelType = Param(Params._dummy(), "modelType", "linear_models or trees_models",
                      TypeConverters.toString)
    wcCol = Param(Params._dummy(), "wcCol", "water/cement column", TypeConverters.toString)
    fitThresholds = Param(Params._dummy(), "fitThresholds",
                          "compute the adaptive thresholds also where only the summary shows them",
                          TypeConverters.toBoolean)

    @keyword_only
    def __init__(self, *, modelType="trees_models", wcCol="W/C", fitThresholds=True):
        super().__init__()
        self._setDefault(modelType="trees_models", wcCol="W/C", fitThresholds=True)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, df: DataFrame) -> FeatureEngineerModel:
        kind, wc = self.getOrDefault(self.modelType), self.getOrDefault(self.wcCol)
        if kind not in MODEL_TYPES:
            raise ValueError(f"model type {kind!r} is not one of {MODEL_TYPES}")
        missing = [c for c in REQUIRED if c not in df.columns]
        if missing:
            raise ValueError(f"columns missing from the table: {missing}")
        low = high = None
        if kind == "trees_models" or self.getOrDefault(self.fitThresholds):
            low, high = exact_quantiles(df, {"wc": _water_cement(df, wc)}, [0.25, 0.75])["wc"]
        return FeatureEngineerModel({
            "model_type": kind, "wc_col": wc, "low": low, "high": high, "input": df.columns})


class FeatureEngineerModel(FittedStage):
    def _transform(self, df: DataFrame) -> DataFrame:
        s = self.fitted
        powder = col("Cement") + col("Blast Furnace Slag") + col("Fly Ash")
        new = {
            "Total_powder": powder,
            "Aggregate_ratio": _quotient_or_zero(col("Coarse Aggregate"), col("Fine Aggregate")),
            "Binder_water_ratio": _quotient_or_zero(powder, col("Water")),
        }
        if s["model_type"] == "trees_models":
            wc = _water_cement(df, s["wc_col"])
            for name, source in (("Has_Slag", "Blast Furnace Slag"), ("Has_FlyAsh", "Fly Ash"),
                                 ("Has_Superplasticizer", "Superplasticizer")):
                new[name] = flag(as_double(source) > 0)
            if s["wc_col"] not in df.columns:
                new["W/C"] = wc
            new["Low_WC_ratio"] = flag(wc < F.lit(s["low"]))
            new["High_WC_ratio"] = flag(wc > F.lit(s["high"]))
            new["Low_WC_tech"] = flag(wc < LOW_TECH)
            new["High_WC_tech"] = flag(wc > HIGH_TECH)
        return df.withColumns(new)

    def descriptions(self) -> dict[str, str]:
        trees = self.fitted["model_type"] == "trees_models"
        return {**LINEAR_DESCRIPTIONS, **(TREE_DESCRIPTIONS if trees else {})}
