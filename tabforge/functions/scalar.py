"""Column builders shared by the operators. Everything stays a built-in expression."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Small offsets that keep logarithm and reciprocal finite.
TRANSFORM_EPS = 1e-8
CURVE_EPS = 1e-10


def col(name: str) -> Column:
    """Column by exact name; names here may hold '/', blanks or dots."""
    return F.col("`" + name.replace("`", "``") + "`")


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    skip = set(exclude)
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.NumericType) and f.name not in skip
    ]


def nan_to_null(df: DataFrame) -> DataFrame:
    """Make NULL the only missing marker: in Spark NaN compares greater than any number."""
    return df.select(*[
        F.nanvl(col(f.name), F.lit(None).cast(f.dataType)).alias(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else col(f.name)
        for f in df.schema.fields
    ])


def is_missing(df: DataFrame, name: str) -> Column:
    kind = df.schema[name].dataType
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return col(name).isNull() | F.isnan(col(name))
    return col(name).isNull()


def as_double(name: str) -> Column:
    """Double value with NaN as NULL."""
    return F.nanvl(col(name).cast("double"), F.lit(None).cast("double"))


def holds(predicate: Column) -> Column:
    """Three-valued predicate to boolean: unknown counts as not hit."""
    return F.coalesce(predicate, F.lit(False))


def flag(predicate: Column) -> Column:
    return holds(predicate).cast("int")


def ratio(num: Column, den: Column, default: float | None = None) -> Column:
    """num/den where den is not zero, else ``default`` (NULL when not given)."""
    safe = F.when(den != 0, num / den)
    return safe if default is None else safe.otherwise(F.lit(default))


def outside(x: Column, low: float | None, high: float | None) -> Column:
    return (x < F.lit(low).cast("double")) | (x > F.lit(high).cast("double"))


def log_clamped(x: Column) -> Column:
    return F.when(x.isNotNull(), F.log(F.greatest(x, F.lit(TRANSFORM_EPS))))


def sqrt_clamped(x: Column) -> Column:
    return F.when(x.isNotNull(), F.sqrt(F.greatest(x, F.lit(0.0))))


def inverse_abs(x: Column) -> Column:
    return F.lit(1.0) / F.when(x == 0, F.lit(TRANSFORM_EPS)).otherwise(F.abs(x))


# Transforms applied to stored features. "x²" and "square_func" name the same function.
TRANSFORMS: dict[str, Callable[[Column], Column]] = {
    "Linear": lambda x: x,
    "Log": log_clamped,
    "Sqrt": sqrt_clamped,
    "1/x": inverse_abs,
    "x²": lambda x: x * x,
}
TRANSFORM_SYNONYMS = {"square_func": "x²"}

# Regressors of the trend curves a*f(x)+b; unlike TRANSFORMS they do not clamp, so a curve
# that is undefined on some row (NULL or NaN here) is invalid for the whole feature.
CURVES: dict[str, Callable[[Column], Column]] = {
    "Linear": lambda x: x,
    "Log": lambda x: F.when(x + CURVE_EPS > 0, F.log(x + CURVE_EPS)),
    "Sqrt": lambda x: F.when(x >= 0, F.sqrt(x)),
    "1/x": lambda x: ratio(F.lit(1.0), x + CURVE_EPS),
    "x²": lambda x: x * x,
}


def long_form(df: DataFrame, features: list[str], keep: Iterable[str] = ()) -> DataFrame:
    """One row (feature, x) per row and feature, with the ``keep`` columns repeated.

    Grouping this by feature gives one report row per feature in a single aggregate whose
    map-side combine leaves only a few rows per task to shuffle, however large a group is.
    """
    kept = list(keep)
    slim = df.select(*[col(k) for k in kept], *[as_double(f).alias(f) for f in features])
    return slim.unpivot([col(k) for k in kept], [col(f) for f in features], "feature", "x")
