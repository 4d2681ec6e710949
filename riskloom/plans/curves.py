"""Tables behind learning curves and training histories."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession, functions as F

from riskloom.functions.hashing import order_hash
from riskloom.functions.ranking import at_or_below, hash_cutoffs
from riskloom.operators import models
from riskloom.session import hold

HISTORY = "epoch int, loss double, val_loss double, val_accuracy double, val_auprc double"


def learning_curve(
    df: DataFrame, features: Sequence[str], label: str, key: str, kind: str = "logistic_regression", params: dict | None = None,
    folds: int = 5, sizes: Sequence[float] = tuple(i / 10 for i in range(1, 11)), seed: int = 42, parallel: int = 4,
) -> DataFrame:
    """(train_size, train_mean, train_std, test_mean, test_std) of accuracy over folds.

    Each class is cut into folds of equal size by seeded hash rank, and a training size takes the same share of
    every class among the other folds, one row at least.
    """
    h, group = order_hash(f"{seed}:fold", key), F.col(label)
    fold_of = F.lit(0)
    for f in range(1, folds):
        cuts, _ = hash_cutoffs(df, h, lambda c, f=f: {g: f * m // folds for g, m in c.items()}, group)
        fold_of = fold_of + F.when(at_or_below(h, cuts, group), 0).otherwise(1)
    data = hold(df.select(key, label, *features, fold_of.alias("_fold"), order_hash(f"{seed}:size", key).alias("_h")))

    def run(fold: int, size: float):
        rest = data.filter(F.col("_fold") != fold)
        cuts, n = hash_cutoffs(rest, F.col("_h"), lambda c: {g: max(1, int(size * m)) for g, m in c.items()}, group)
        part = rest.filter(at_or_below(F.col("_h"), cuts, group))
        model = models.fit_model(part, kind, features, label, params, seed, key)
        both = part.withColumn("_train", F.lit(True)).unionByName(
            data.filter(F.col("_fold") == fold).withColumn("_train", F.lit(False))
        )
        right = (F.col("prediction") == F.col(label)).cast("double")
        acc = {r["_train"]: r["a"] for r in models.score(both, model).groupBy("_train").agg(F.avg(right).alias("a")).collect()}
        return float(size), fold, acc.get(True), acc.get(False)

    with ThreadPoolExecutor(parallel) as pool:
        rows = list(pool.map(lambda a: run(*a), [(f, s) for s in sizes for f in range(folds)]))
    data.unpersist()
    table = df.sparkSession.createDataFrame(rows, "train_size double, fold int, train_accuracy double, test_accuracy double")
    return table.groupBy("train_size").agg(
        F.avg("train_accuracy").alias("train_mean"), F.stddev_pop("train_accuracy").alias("train_std"),
        F.avg("test_accuracy").alias("test_mean"), F.stddev_pop("test_accuracy").alias("test_std"),
    ).orderBy("train_size")


def training_history(df: DataFrame, features: Sequence[str], label: str, key: str, params: dict | None = None, seed: int = 42) -> DataFrame:
    """One row per epoch of a network fit."""
    return history_table(df.sparkSession, models.fit_model(hold(df), "neural_network", features, label, {**(params or {}), "track_auprc": True}, seed, key))


def history_table(spark: SparkSession, model: models.FittedModel) -> DataFrame:
    """The epochs of a fitted network."""
    rows = [(h["epoch"], h["loss"], h["val_loss"], h["val_accuracy"], h["val_auprc"]) for h in model.history]
    return spark.createDataFrame(rows, HISTORY)
