"""Feature scaling: one aggregate to fit, one projection to apply."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F

from riskloom.functions.columns import numeric_columns, replace_columns

METHODS = ("none", "standard", "minmax")


@dataclass
class ScaleState:
    """Per column (shift, divisor): scaled = (x - shift) / divisor."""

    method: str
    stats: dict[str, tuple[float, float]] = field(default_factory=dict)


def fit_scale(
    df: DataFrame, method: str = "standard", exclude: Sequence[str] = (), with_mean: bool = True, with_std: bool = True
) -> ScaleState:
    if method not in METHODS:
        raise ValueError(f"unknown scaling method: {method}")
    cols = numeric_columns(df, exclude)
    if method == "none" or not cols:
        return ScaleState(method)
    low, spread = (F.avg, F.stddev_pop) if method == "standard" else (F.min, F.max)
    row = df.agg(
        *[low(F.col(c).cast("double")).alias(f"a{i}") for i, c in enumerate(cols)],
        *[spread(F.col(c).cast("double")).alias(f"b{i}") for i, c in enumerate(cols)],
    ).first()
    state = ScaleState(method)
    for i, c in enumerate(cols):
        a, b = row[f"a{i}"], row[f"b{i}"]
        if a is None:
            continue
        if method == "standard":
            shift, div = (a if with_mean else 0.0), (b if with_std else 1.0)
            if with_std and abs(b) <= 1e-14 * max(1.0, abs(a)):
                div = 1.0
        else:
            shift, div = a, b - a
        state.stats[c] = (float(shift), float(div) if div else 1.0)
    return state


def apply_scale(df: DataFrame, state: ScaleState, strict: bool = False) -> DataFrame:
    """Scale the fitted columns that are present; strict raises if any is absent."""
    absent = [c for c in state.stats if c not in df.columns]
    if strict and absent:
        raise ValueError(f"columns to scale are missing: {absent}")
    return replace_columns(
        df,
        {
            c: (F.col(c).cast("double") - F.lit(shift)) / F.lit(div)
            for c, (shift, div) in state.stats.items() if c in df.columns
        },
    )
