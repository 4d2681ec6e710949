"""Seeded train/test splits of exact size that never move a row."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from riskloom.functions.hashing import order_hash
from riskloom.functions.ranking import at_or_below, hash_cutoffs


def holdout_test(df: DataFrame, keys: Sequence[str], fraction: float = 0.2, seed: int = 42) -> tuple[Column, int]:
    """(test for the ceil(fraction * n) rows of smallest seeded key hash, n)."""
    h = order_hash(seed, *keys)
    cuts, sizes = hash_cutoffs(df, h, lambda n: {g: math.ceil(fraction * c) for g, c in n.items()})
    return at_or_below(h, cuts) if cuts else F.lit(False), sum(sizes.values())


def holdout_split(df: DataFrame, keys: Sequence[str], fraction: float = 0.2, seed: int = 42) -> DataFrame:
    """Adds _split with train and test. ``keys`` must identify a row."""
    test, _ = holdout_test(df, keys, fraction, seed)
    return df.withColumn("_split", F.when(test, "test").otherwise("train"))


def stratified_takes(sizes: dict, fraction: float) -> dict:
    """Test rows per class: proportional, the remainder to the largest fractions."""
    n = sum(sizes.values())
    total = math.ceil(fraction * n)
    share = {g: total * c / n for g, c in sizes.items()}
    out = {g: math.floor(s) for g, s in share.items()}
    order = sorted(share, key=lambda g: (out[g] - share[g], str(g)))
    for g in order[: total - sum(out.values())]:
        out[g] += 1
    return out


def stratified_split(
    df: DataFrame, label: str | Column, keys: Sequence[str], fraction: float = 0.2, seed: int = 42
) -> DataFrame:
    """Adds _split with each class cut in the same proportion."""
    h = order_hash(seed, *keys)
    group = F.col(label) if isinstance(label, str) else label
    cuts, _ = hash_cutoffs(df, h, lambda n: stratified_takes(n, fraction), group)
    return df.withColumn("_split", F.when(at_or_below(h, cuts, group), "test").otherwise("train"))


def evaluation_split(
    train: DataFrame, test: DataFrame | None, target: str, keys: Sequence[str], fraction: float = 0.2, seed: int = 42
) -> tuple[DataFrame, DataFrame, str]:
    """The test table if it has known targets, else a validation cut of train."""
    if test is not None and target in test.columns:
        known = test.filter(F.col(target).isNotNull())
        if not known.isEmpty():
            return train, known, "test_set"
    stat = train.agg(F.count(target).alias("n"), F.countDistinct(target).alias("d")).first()
    if 1 < stat["d"] < stat["n"]:
        cut = stratified_split(train, target, keys, fraction, seed)
    else:
        cut = holdout_split(train, keys, fraction, seed)
    return (
        cut.filter("_split = 'train'").drop("_split"),
        cut.filter("_split = 'test'").drop("_split"),
        "validation_set_from_train",
    )
