"""Exact k-nearest-neighbour join in Euclidean space.

Points are grouped around pivots (a bounded uniform sample). Distances to the
pivots bound the distance to every cell, so a query visits only the cells that can
hold one of its k neighbours; the search inside a visited cell is a vectorised block
computation that emits at most k rows per query, only those within the reach that its own cell has shown, never a pair table.
The cells of a query are kept as one list; its vector is copied where the blocks are dealt, never in a Python worker. Cells are cut into
blocks of bounded size, so a crowded cell is many tasks. Equal vectors are handled
once: only their k smallest tie values can ever be neighbours.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F, types as T

from riskloom import limits
from riskloom.functions.ranking import smallest_by_hash
from riskloom.session import keep_small, settle, ship

_MAX_PIVOTS = 16_384
_POINTS_PER_PIVOT = 2_000
_MATRIX = 1_000_000
_MOST_TASKS = 20_000


def knn_join(
    queries: DataFrame, donors: DataFrame, k: int, tie_type: str = "bigint", block_rows: int = limits.BLOCK_ROWS
) -> DataFrame:
    """For every distinct ``vec`` in queries, its k nearest rows of donors.

    queries(vec array<double>); donors(vec array<double>, tie, payload...), unique on
    (vec, tie). Neighbours are ordered by (distance, tie). Returns
    (vec, rank, dist, tie, payload...); fewer than k rows only if donors has fewer.
    """
    extra = [c for c in donors.columns if c not in ("vec", "tie")]
    per_vec = Window.partitionBy("vec").orderBy("tie")
    s = keep_small(
        donors.withColumn("_rn", F.row_number().over(per_vec)).filter(F.col("_rn") <= k).drop("_rn"),
        limits.LOCAL_VECTORS,
    )
    q = keep_small(queries.select("vec").distinct(), limits.LOCAL_VECTORS)
    n = s.count()
    schema = T.StructType(
        [T.StructField("vec", T.ArrayType(T.DoubleType())), T.StructField("dist", T.DoubleType())]
        + [s.schema["tie"]] + [s.schema[c] for c in extra]
    )
    if n == 0:
        empty = s.limit(0)
        return empty.select(
            "vec", F.lit(1).alias("rank"), F.lit(0.0).alias("dist"), "tie", *extra
        )
    p = max(1, min(_MAX_PIVOTS, math.ceil(n / _POINTS_PER_PIVOT)))
    sample = None if p == 1 else smallest_by_hash(s.select("vec", F.to_json(F.struct("vec", "tie")).alias("key")), ["key"], p, n, "pivot")
    if p == 1:
        blocks = np.array([math.ceil(n / block_rows)])
        cells = _with_blocks(s.withColumn("cell", F.lit(0)), blocks)
        return _ranked(_search(q.withColumn("cell", F.lit(0)), cells, blocks, k, schema, block_rows), k, extra)
    pivots = np.unique(np.array([r["vec"] for r in sample.select("vec").collect()], dtype=float), axis=0)

    s_cells = settle(_nearest_cell(s, pivots))
    stat = s_cells.groupBy("cell").agg(F.count("*").alias("n"), F.max("pd").alias("radius")).collect()
    count = np.zeros(len(pivots))
    radius = np.full(len(pivots), -1.0)
    for r in stat:
        count[r["cell"]], radius[r["cell"]] = r["n"], r["radius"]
    blocks = np.maximum(1, np.ceil(count / block_rows)).astype(int)
    s_cells = _with_blocks(s_cells, blocks)

    own = _visits(q, pivots, radius, count, k, own=True)
    first = _search(own, s_cells, blocks, k, schema, block_rows)
    first = settle(_ranked(first, k, extra))
    reach = first.filter(F.col("rank") == k).select("vec", F.col("dist").alias("reach"))
    rest = _visits(q.join(reach, "vec", "left"), pivots, radius, count, k, own=False)
    second = _search(rest, s_cells, blocks, k, schema, block_rows)
    return _ranked(first.drop("rank").unionByName(second), k, extra)


def _ranked(hits: DataFrame, k: int, extra: list[str]) -> DataFrame:
    order = Window.partitionBy("vec").orderBy("dist", "tie")
    return (
        hits.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("vec", "rank", "dist", "tie", *extra)
    )


def _with_blocks(s: DataFrame, blocks: np.ndarray) -> DataFrame:
    sized = s.join(_per_cell(s, {i: int(b) for i, b in enumerate(blocks)}, "_blocks"), "cell")
    return sized.withColumn("block", F.pmod(F.xxhash64("vec", "tie"), F.col("_blocks")).cast("int")).drop("_blocks")


def _per_cell(df: DataFrame, values: dict[int, int], name: str) -> DataFrame:
    """At most one row per pivot, to broadcast."""
    rows = pd.DataFrame({"cell": list(values), name: list(values.values())})
    return F.broadcast(df.sparkSession.createDataFrame(rows, f"cell int, {name} int"))


def _chunks(batches, width: int):
    """Slices of the input batches whose distance matrix to ``width`` points stays small."""
    step = max(1, _MATRIX // max(1, width))
    for pdf in batches:
        for start in range(0, len(pdf), step):
            yield pdf.iloc[start:start + step]


def _to_pivots(vecs: pd.Series, pivots: np.ndarray) -> np.ndarray:
    a = np.stack(vecs.to_numpy()).astype(float)
    return block_distances(a, pivots)


def block_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances, one dimension at a time so that equal rows give exactly 0."""
    total = np.zeros((len(a), len(b)))
    for j in range(a.shape[1]):
        gap = a[:, j, None] - b[None, :, j]
        total += gap * gap
    return np.sqrt(total)


def nearest(a: np.ndarray, b: np.ndarray, k: int, reach: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of a, row of b, distance): the k nearest rows of b for each row of a, in order; ties go to the first row of b.

    Inner products leave out what is certainly farther than the k-th or beyond the reach; the distances of the rest are those of
    :func:`block_distances`. Values that are not finite leave out nothing.
    """
    with np.errstate(invalid="ignore", over="ignore"):
        size, other = (a * a).sum(axis=1), (b * b).sum(axis=1)
        rough = (size[:, None] + other[None, :]) - 2.0 * (a @ b.T)
        # Far more than rounding can make of a sum of squares.
        slack = 1e-12 * (1 + a.shape[1]) * (size + other.max())
        bar = np.full(len(a), np.inf) if k >= len(b) else np.partition(rough, k - 1, axis=1)[:, k - 1] + 2 * slack
        if reach is not None:
            bar = np.minimum(bar, (reach * (1 + 1e-9) + 1e-12) ** 2 + slack)
        who, which = np.nonzero(~(rough > bar[:, None]))
    total = np.zeros(len(who))
    for j in range(a.shape[1]):
        gap = a[who, j] - b[which, j]
        total += gap * gap
    dist = np.sqrt(total)
    order = np.lexsort((which, dist, who))
    who, which, dist = who[order], which[order], dist[order]
    kept = np.arange(len(who)) - np.searchsorted(who, who) < k
    return who[kept], which[kept], dist[kept]


def _nearest_cell(df: DataFrame, pivots: np.ndarray) -> DataFrame:
    ship(df.sparkSession)
    schema = T.StructType(
        [*df.schema.fields, T.StructField("cell", T.IntegerType()), T.StructField("pd", T.DoubleType())]
    )

    def assign(batches):
        for pdf in _chunks(batches, len(pivots)):
            d = _to_pivots(pdf["vec"], pivots)
            cell = d.argmin(axis=1)
            yield pdf.assign(cell=cell.astype("int32"), pd=d[np.arange(len(pdf)), cell])

    return df.mapInPandas(assign, schema)


def _visits(q: DataFrame, pivots, radius, count, k: int, own: bool) -> DataFrame:
    """(vec, cell) rows: the nearest non-empty cell, or every other cell within reach, with the reach.

    Without a known reach the bound is the smallest radius around the query that is
    certain to hold k points. What is stored is one row per query.
    """
    filled = np.flatnonzero(count > 0)
    centre, rad, size = pivots[filled], radius[filled], count[filled]

    def plan(batches):
        for pdf in _chunks(batches, len(centre)):
            d = _to_pivots(pdf["vec"], centre)
            near = d.argmin(axis=1)
            if own:
                yield pd.DataFrame({"vec": pdf["vec"], "cells": list(filled[near].astype("int32")[:, None])})
                continue
            sure = d + rad[None, :]
            order = sure.argsort(axis=1)
            enough = size[order].cumsum(axis=1) >= k
            at = np.where(enough.any(axis=1), enough.argmax(axis=1), -1)
            rows = np.arange(len(pdf))
            bound = np.where(at >= 0, sure[rows, order[rows, np.maximum(at, 0)]], np.inf)
            reach = pdf["reach"].to_numpy(dtype=float)
            bound = np.where(np.isnan(reach), bound, np.minimum(reach, bound))
            with np.errstate(divide="ignore", invalid="ignore"):
                gaps = block_distances(centre[near], centre)
                plane = (d**2 - d[rows, near][:, None] ** 2) / (2 * gaps)
            lower = np.maximum(d - rad[None, :], np.nan_to_num(plane, nan=0.0, posinf=0.0, neginf=0.0))
            visit = lower <= bound[:, None] * (1 + 1e-9) + 1e-12
            visit[rows, near] = False
            yield pd.DataFrame({"vec": pdf["vec"], "cells": [filled[v].astype("int32") for v in visit], "reach": bound})

    stored = settle(q.mapInPandas(plan, "vec array<double>, cells array<int>" + ("" if own else ", reach double")))
    return stored.select(*[c for c in stored.columns if c != "cells"], F.explode("cells").alias("cell"))


def _search(visits: DataFrame, s_cells: DataFrame, blocks, k: int, schema, block_rows: int) -> DataFrame:
    """Top k of each query within each visited block, as bounded block-by-block tasks; nothing beyond a query's ``reach``."""
    ship(visits.sparkSession)
    if len(blocks) == 1:
        load = {0: visits.count()}
    else:
        load = {r["cell"]: r["count"] for r in visits.groupBy("cell").count().collect()}
    lane_count = {int(c): max(1, math.ceil(n / block_rows)) for c, n in load.items()}
    lanes = _per_cell(visits, lane_count, "_lanes")
    parts = _per_cell(visits, {int(c): int(blocks[c]) for c in load}, "_blocks")
    left = (
        visits.join(lanes, "cell").join(parts, "cell")
        .withColumn("lane", F.pmod(F.xxhash64("vec"), F.col("_lanes")).cast("int"))
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
        .drop("_lanes", "_blocks")
    )
    right = s_cells.join(lanes, "cell").withColumn("lane", F.explode(F.sequence(F.lit(0), F.col("_lanes") - 1))).drop("_lanes")
    names = schema.names

    def top(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if not len(a) or not len(b):
            return pd.DataFrame({n: [] for n in names})
        b = b.sort_values("tie", kind="stable").reset_index(drop=True)
        bm = np.stack(b["vec"].to_numpy()).astype(float)
        pieces = []
        for start in range(0, len(a), 512):
            part = a.iloc[start:start + 512]
            reach = part["reach"].to_numpy(dtype=float) if "reach" in part else None
            who, which, dist = nearest(np.stack(part["vec"].to_numpy()).astype(float), bm, k, reach)
            hit = b.iloc[which].reset_index(drop=True)
            hit["dist"] = dist
            hit["vec"] = part["vec"].to_numpy()[who]
            pieces.append(hit[names])
        return pd.concat(pieces, ignore_index=True)

    keys = ["cell", "block", "lane"]
    # As many tasks as pairs of blocks: a task stays as long as a few of them, however many there are.
    tasks = max(1, min(_MOST_TASKS, sum(m * int(blocks[c]) for c, m in lane_count.items())))
    right = right.select(*[F.col(c).alias(c) for c in right.columns])
    left, right = left.repartition(tasks, *keys), right.repartition(tasks, *keys)
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(top, schema)
