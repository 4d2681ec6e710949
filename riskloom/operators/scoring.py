"""Result columns of a scored table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

RAW = "_raw_row"


def with_raw(df: DataFrame) -> DataFrame:
    """Carry the original row beside the columns that will be transformed."""
    return df.select(F.struct(*df.columns).alias(RAW), *df.columns)


def risk_level(score: Column, orientation: str = "as_scored") -> Column:
    """Low above 0.7, Medium above 0.4, else High; both limits exclusive.

    ``as_scored`` treats the score as creditworthiness. ``higher_is_riskier`` swaps
    Low and High for a score that is a default probability.
    """
    if orientation not in ("as_scored", "higher_is_riskier"):
        raise ValueError(f"unknown orientation: {orientation}")
    top, bottom = ("Low", "High") if orientation == "as_scored" else ("High", "Low")
    return F.when(score > 0.7, top).when(score > 0.4, "Medium").otherwise(bottom)


def format_results(scored: DataFrame, classes: Sequence[int], orientation: str = "as_scored") -> DataFrame:
    """Original columns, prediction in target codes, probability_class_i per class; for two
    classes also credit_score and risk_level."""
    original = [F.col(f"{RAW}.{c}") for c in scored.schema[RAW].dataType.names] if RAW in scored.columns else [
        F.col(c) for c in scored.columns if c not in ("prediction", "probabilities")
    ]
    codes = F.array(*[F.lit(int(c)) for c in classes])
    probs = [F.col("probabilities")[i].alias(f"probability_class_{i}") for i in range(len(classes))]
    out = [*original, F.get(codes, F.col("prediction")).alias("prediction"), *probs]
    if len(classes) == 2:
        p = F.col("probabilities")[1]
        out += [p.alias("credit_score"), risk_level(p, orientation).alias("risk_level")]
    return scored.select(*out)
