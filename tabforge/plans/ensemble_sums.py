"""Errors of voting and stacking ensembles from products of their base predictions.

Within a fold the error of any weighted mix of predictions is a quadratic form in the products
of the predictions and the target, so all weight sets, and the final model of a stack, come from
one small matrix. For linear bases that matrix follows from the products of the features, kept per
cell of outer and inner fold; then nested cross-validation of every ensemble needs one pass.
For other bases it is taken from their out-of-fold predictions.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabforge.functions.scalar import as_double
from tabforge.plans.ensembles import WEIGHTS_THREE, WEIGHTS_THREE_SECOND, WEIGHTS_TWO
from tabforge.plans.folds import Scores
from tabforge.plans.sums import (
    coordinate_descent, error_form, fold_moments, least_squares, ridge_path, rmse_from,
    standardised,
)


@dataclass(frozen=True)
class LinearBase:
    """A linear base model: its features, its penalty and the share of the absolute penalty."""

    features: tuple[str, ...]
    alpha: float = 0.0
    l1_ratio: float = 0.0


def weight_sets(bases: int) -> dict[str, Sequence[float]]:
    """The compared weights for three, or for two, base models."""
    sets: dict[str, Sequence[float]] = {"voting_equal": [1.0] * bases}
    if bases == 3:
        sets |= {"voting_weighted": WEIGHTS_THREE, "voting_weighted_2": WEIGHTS_THREE_SECOND}
    elif bases == 2:
        sets["voting_weighted"] = WEIGHTS_TWO
    return sets


def final_coefficients(products: np.ndarray, alpha: float) -> np.ndarray:
    """Final model of a stack, with intercept, from products of (1, predictions, target).

    Returns its error as a linear form of the same columns.
    """
    s = standardised(products, scaled=False)
    coef = ridge_path(s, [alpha])[0] if alpha > 0 else least_squares(s)
    return error_form(s, coef)


def ensemble_errors(held_out: np.ndarray, tested: np.ndarray, ridge_alpha: float = 1.0
                    ) -> dict[str, float]:
    """RMSE of every ensemble on ``tested``; final models are fitted on ``held_out``.

    Both are products of (1, predictions, target).
    """
    n = len(tested) - 2
    out = {}
    for name, weights in weight_sets(n).items():
        w = np.array(weights) / sum(weights)
        out[name] = rmse_from(tested, np.concatenate(([0.0], -w, [1.0])))
    out["stacking_ridge"] = rmse_from(tested, final_coefficients(held_out, ridge_alpha))
    out["stacking_linear"] = rmse_from(tested, final_coefficients(held_out, 0.0))
    return out


def _forms(trains: Sequence[np.ndarray], names: Sequence[str],
           bases: Sequence[LinearBase]) -> list[np.ndarray]:
    """Per training matrix the columns (1, predictions, target) in terms of (1, features, target)."""
    width = len(names) + 2
    out = [np.zeros((width, len(bases) + 2)) for _ in trains]
    for form in out:
        form[0, 0] = form[-1, -1] = 1.0
    for b, base in enumerate(bases):
        at = np.array([0, *[1 + names.index(f) for f in base.features], width - 1])
        sets = [standardised(t[np.ix_(at, at)], scaled=False) for t in trains]
        if base.l1_ratio > 0 and base.alpha > 0:
            coefs = coordinate_descent(sets, base.alpha, base.l1_ratio)
        else:
            coefs = [ridge_path(s, [base.alpha])[0] for s in sets]
        for form, s, c in zip(out, sets, coefs):
            form[at[:-1], 1 + b] = -error_form(s, c)[:-1]
    return out


def linear_ensembles(df: DataFrame, target: Column | str, outer: str, k: int, inner: str,
                     inner_k: int, bases: Mapping[str, LinearBase], ridge_alpha: float = 1.0,
                     columns: Mapping[str, Column] | None = None) -> dict[str, Scores]:
    """RMSE of every ensemble of linear bases on every outer fold, from one pass.

    The final models are fitted on predictions for the inner folds of the training rows, made
    by bases fitted on the other inner folds; the bases that score the outer fold are fitted on
    all training rows. Rows with a missing value are left out.
    """
    chosen = list(bases.values())
    names = list(dict.fromkeys(f for b in chosen for f in b.features))
    given = columns or {}
    y = as_double(target) if isinstance(target, str) else target
    wide = {n: given.get(n, as_double(n)) for n in names} | {"__target": y}
    celled = df.withColumn("__cell", F.col(outer) * inner_k + F.col(inner))
    cells = fold_moments(celled, wide, ["__cell"], k * inner_k).test

    def add(outside: int, leave: int | None = None) -> np.ndarray:
        return sum(cells["__cell", o * inner_k + i] for o in range(k) for i in range(inner_k)
                   if o != outside and i != leave)

    sets = [(f, j) for f in range(k) for j in (None, *range(inner_k))]
    forms = dict(zip(sets, _forms([add(f, j) for f, j in sets], names, chosen)))
    result: dict[str, Scores] = {}
    for f in range(k):
        held_out = sum(
            forms[f, j].T @ sum(cells["__cell", o * inner_k + j] for o in range(k) if o != f)
            @ forms[f, j] for j in range(inner_k))
        own = sum(cells["__cell", f * inner_k + i] for i in range(inner_k))
        tested = forms[f, None].T @ own @ forms[f, None]
        for name, rmse in ensemble_errors(held_out, tested, ridge_alpha).items():
            result.setdefault(name, Scores()).rmse.append(rmse)
    return result


def prediction_products(scored: DataFrame, predictions: Sequence[str], target: str,
                        fold: str, k: int) -> dict[int, np.ndarray]:
    """Products of (1, predictions, target) per fold, for predictions of any models."""
    columns = {p: F.col(p) for p in predictions} | {"__target": as_double(target)}
    found = fold_moments(scored, columns, [fold], k)
    # Back from the shifted columns, whose means differ between predictions and target.
    back = np.eye(len(found.names) + 1)
    back[1:, 0] = found.shift
    return {f: back @ found.test[fold, f] @ back.T for f in range(k)}
