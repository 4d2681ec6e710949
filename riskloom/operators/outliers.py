"""Outlier filters over the numeric features of training rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from riskloom.functions.columns import numeric_columns
from riskloom.functions.quantiles import exact_quantiles
from riskloom.operators import isolation

METHODS = ("none", "iqr", "isolation_forest")


@dataclass
class OutlierState:
    method: str
    bounds: dict[str, tuple[float, float]] = field(default_factory=dict)
    forest: isolation.IsolationState | None = None


def fit_outliers(
    df: DataFrame, method: str = "isolation_forest", exclude: Sequence[str] = (), keys: Sequence[str] = (), **params
) -> OutlierState:
    if method not in METHODS:
        raise ValueError(f"unsupported outlier method: {method}")
    cols = numeric_columns(df, [*exclude, *keys])
    state = OutlierState(method)
    if method == "none" or not cols:
        return OutlierState("none")
    if method == "iqr":
        m = float(params.get("multiplier", 1.5))
        for c, (q1, q3) in exact_quantiles(df, cols, [0.25, 0.75]).items():
            if q1 is not None:
                state.bounds[c] = (q1 - m * (q3 - q1), q3 + m * (q3 - q1))
    else:
        state.forest = isolation.fit_isolation(
            df, cols, keys, int(params.get("n_estimators", 100)), params.get("contamination", "auto")
        )
        if state.forest is None:
            return OutlierState("none")
    return state


def apply_outliers(df: DataFrame, state: OutlierState) -> DataFrame:
    """A filter in place; a NULL cell never makes a row an outlier for the quartile rule."""
    if state.method == "iqr" and state.bounds:
        outside = reduce(
            lambda a, b: a | b,
            [F.coalesce((F.col(c) < lo) | (F.col(c) > hi), F.lit(False)) for c, (lo, hi) in state.bounds.items()],
        )
        return df.filter(~outside)
    if state.method == "isolation_forest" and state.forest is not None:
        return isolation.keep_inliers(df, state.forest)
    return df


def remove_outliers(df: DataFrame, method: str, exclude: Sequence[str] = (), keys: Sequence[str] = (), **params) -> DataFrame:
    """Fit and filter; if nothing would be left the input is returned."""
    out = apply_outliers(df, fit_outliers(df, method, exclude, keys, **params))
    return df if method != "none" and out.isEmpty() else out
