"""Isolation forest (Liu, Ting & Zhou 2008): trees grown in parallel tasks, rows scored in place."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from riskloom.functions.quantiles import exact_quantiles
from riskloom.functions.ranking import smallest_by_hash
from riskloom.session import hold, ship

SAMPLE = 256
EULER = 0.5772156649015329
_TREE = "tree int, node int, feature int, cut double, left int, right int, size int"


@dataclass
class IsolationState:
    columns: list[str]
    psi: int
    trees: list[tuple]
    threshold: float


def mean_path(n):
    """Average depth of an unsuccessful search among n points."""
    n = np.asarray(n, dtype=float)
    with np.errstate(divide="ignore", invalid="ignore"):
        value = 2.0 * (np.log(n - 1.0) + EULER) - 2.0 * (n - 1.0) / n
    return np.where(n > 2, value, np.where(n == 2, 1.0, 0.0))


def finite_rows(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    keep = F.lit(True)
    for c in cols:
        x = F.col(c).cast("double")
        keep = keep & x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    return df.filter(F.coalesce(keep, F.lit(False)))


def _grow(points: np.ndarray, rng: np.random.Generator, limit: int) -> list[tuple]:
    nodes: list[list] = []
    stack = [(points, 0, -1, 0)]
    while stack:
        rows, depth, parent, side = stack.pop()
        me = len(nodes)
        nodes.append([-1, 0.0, -1, -1, len(rows)])
        if parent >= 0:
            nodes[parent][2 + side] = me
        if depth >= limit or len(rows) <= 1:
            continue
        low, high = rows.min(axis=0), rows.max(axis=0)
        open_dims = np.flatnonzero(high > low)
        if not len(open_dims):
            continue
        f = int(rng.choice(open_dims))
        cut = float(rng.uniform(low[f], high[f]))
        goes = rows[:, f] <= cut
        nodes[me][0], nodes[me][1] = f, cut
        stack.append((rows[goes], depth + 1, me, 0))
        stack.append((rows[~goes], depth + 1, me, 1))
    return [tuple(x) for x in nodes]


def fit_isolation(
    df: DataFrame, cols: Sequence[str], keys: Sequence[str], n_estimators: int = 100, contamination="auto", seed: int = 42
) -> IsolationState | None:
    """None when no row has all columns finite.

    The tree samples come from one uniform pool of at most n_estimators * 256 rows,
    which is the only data that reaches the tree tasks.
    """
    cols = list(cols)
    clean = finite_rows(df, cols)
    n = clean.count()
    if n == 0:
        return None
    psi = min(SAMPLE, n)
    wide = clean.select(
        F.array(*[F.col(c).cast("double") for c in cols]).alias("x"),
        F.to_json(F.struct(*(keys or cols))).alias("key"),
    )
    pool = np.array(
        [r["x"] for r in smallest_by_hash(wide, ["key"], min(n, n_estimators * SAMPLE), n, seed).select("x").collect()]
    )
    pool = pool[np.lexsort(pool.T[::-1])]
    limit = max(1, math.ceil(math.log2(max(psi, 2))))
    spark = df.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(pool)

    def plant(batches):
        for pdf in batches:
            for t in pdf["id"]:
                rng = np.random.default_rng([seed, int(t)])
                points = shared.value[rng.choice(len(shared.value), psi, replace=False)]
                grown = _grow(points, rng, limit)
                yield pd.DataFrame(
                    [(int(t), i, *node) for i, node in enumerate(grown)],
                    columns=["tree", "node", "feature", "cut", "left", "right", "size"],
                )

    slices = max(1, min(n_estimators, spark.sparkContext.defaultParallelism))
    nodes = spark.range(0, n_estimators, 1, slices).mapInPandas(plant, _TREE).toPandas()
    trees = []
    for _, t in nodes.sort_values(["tree", "node"]).groupby("tree"):
        trees.append(tuple(t[c].to_numpy() for c in ("feature", "cut", "left", "right", "size")))
    shared.unpersist()
    state = IsolationState(cols, psi, trees, 0.5)
    if contamination != "auto":
        scores = hold(anomaly_score(clean.select(*cols), state).select("_score"))
        state.threshold = exact_quantiles(scores, ["_score"], [1.0 - float(contamination)])["_score"][0]
        scores.unpersist()
    return state


def _walkable(tree: tuple) -> tuple:
    """Arrays for a walk of fixed length: a leaf leads to itself; ends holds its path length."""
    feature, cut, left, right, size = (np.asarray(a) for a in tree)
    depth = np.zeros(len(feature))
    for i in range(len(feature)):
        if feature[i] >= 0:
            depth[left[i]] = depth[right[i]] = depth[i] + 1
    me = np.arange(len(feature), dtype=np.int32)
    leaf = feature < 0
    return (
        np.where(leaf, 0, feature).astype(np.int32), cut, np.where(leaf, me, left).astype(np.int32),
        np.where(leaf, me, right).astype(np.int32), depth + mean_path(size), int(depth.max()),
    )


def anomaly_score(df: DataFrame, state: IsolationState) -> DataFrame:
    """Adds _score = 2^(-mean path length / c(psi)); rows must be finite.

    Only the scored columns leave the JVM.
    """
    ship(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast([_walkable(t) for t in state.trees])
    scale = max(float(mean_path(state.psi)), 1e-12)

    @F.pandas_udf("double")
    def score(parts: pd.DataFrame) -> pd.Series:
        flat = np.ascontiguousarray(parts.to_numpy(dtype=float)).ravel()
        start = np.arange(len(parts)) * len(state.columns)
        depth = np.zeros(len(parts))
        for feature, cut, left, right, ends, levels in shared.value:
            at = np.zeros(len(parts), dtype=np.int32)
            for _ in range(levels):
                at = np.where(flat[start + feature[at]] <= cut[at], left[at], right[at])
            depth += ends[at]
        return pd.Series(2.0 ** (-(depth / len(shared.value)) / scale))

    return df.withColumn("_score", score(F.struct(*[F.col(c).cast("double").alias(c) for c in state.columns])))


def keep_inliers(df: DataFrame, state: IsolationState) -> DataFrame:
    """Finite rows scoring at or below the threshold, numeric columns first."""
    scored = anomaly_score(finite_rows(df, state.columns), state)
    rest = [c for c in df.columns if c not in state.columns]
    return scored.filter(F.col("_score") <= state.threshold).select(*state.columns, *rest)
