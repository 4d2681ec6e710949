"""Missing-value imputation: fitted on training rows, applied anywhere."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F, types as T

from riskloom import limits
from riskloom.functions.columns import (
    categorical_columns, non_numeric_columns, numeric_columns, replace_columns,
)
from riskloom.functions.lookup import lookup
from riskloom.functions.quantiles import medians
from riskloom.operators import iterative
from riskloom.operators.neighbors import knn_join
from riskloom.session import keep_small, ship

METHODS = ("knn", "median", "missforest")
MOST_PATTERN_PAIRS = 16
# Fill texts.
NO_MODE = "__MISSING__"
NO_CATEGORY = "Unknown"
FINAL_TEXT = "__UNKNOWN_FINAL__"
CATEGORY_BLANKS = ["nan", "None", ""]


@dataclass
class ImputeState:
    method: str
    modes: dict[str, str | None] = field(default_factory=dict)
    medians: dict[str, float | None] = field(default_factory=dict)
    means: dict[str, float | None] = field(default_factory=dict)
    knn_columns: list[str] = field(default_factory=list)
    k: int = 5
    donors: DataFrame | None = None
    forests: iterative.ForestState | None = None


def column_modes(df: DataFrame, cols: Sequence[str]) -> dict[str, str | None]:
    """Most frequent value per column as text, smallest on ties, None if all NULL.

    Values are counted with map-side combine before anything is compared, so a
    column with many values never sits in one task.
    """
    cols = list(cols)
    if not cols:
        return {}
    cells = df.select(
        F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in cols])).alias("r")
    ).select("r.*")
    top = (
        cells.filter("value IS NOT NULL").groupBy("column", "value").count()
        .groupBy("column").agg(F.min_by("value", F.struct(-F.col("count"), F.col("value"))).alias("mode"))
    )
    found = {r["column"]: r["mode"] for r in top.collect()}
    return {c: found.get(c) for c in cols}


def impute_mode(df: DataFrame, modes: dict[str, str | None]) -> DataFrame:
    """Fill non-numeric columns with their mode, or the fallback text."""
    new = {}
    for c, mode in modes.items():
        if c in df.columns:
            kind = df.schema[c].dataType
            fill = mode if mode is not None else (NO_MODE if isinstance(kind, T.StringType) else None)
            new[c] = F.coalesce(F.col(c), F.lit(fill).cast(kind))
    return replace_columns(df, new)


def blanks_to_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return replace_columns(df, {c: F.when(~F.col(c).cast("string").isin(CATEGORY_BLANKS), F.col(c).cast("string")) for c in cols})


def impute_categorical(train: DataFrame, df: DataFrame) -> DataFrame:
    """Text columns: nan/None/empty count as missing, filled by the training mode."""
    cols = categorical_columns(train)
    modes = column_modes(blanks_to_null(train, cols), cols)
    clean = blanks_to_null(df, [c for c in cols if c in df.columns])
    return replace_columns(
        clean, {c: F.coalesce(F.col(c), F.lit(m if m is not None else NO_CATEGORY)) for c, m in modes.items() if c in df.columns}
    )


def impute_median(df: DataFrame, fitted: dict[str, float | None]) -> DataFrame:
    """Fill numeric columns with stored medians; an all-NULL column gets 0.

    A numeric column that was not fitted uses its own median.
    """
    unseen = [c for c in numeric_columns(df) if c not in fitted]
    return _filled(df, {**fitted, **(medians(df, unseen) if unseen else {})})


def _filled(df: DataFrame, values: dict[str, float | None]) -> DataFrame:
    return replace_columns(
        df,
        {
            c: F.coalesce(F.col(c).cast("double"), F.lit(0.0 if m is None else m))
            for c, m in values.items() if c in df.columns
        },
    )


def final_sweep(df: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    """Whatever is still NULL: numbers 0, text a marker, booleans false."""
    new = {}
    for f in df.schema:
        if f.name in exclude:
            continue
        if isinstance(f.dataType, T.NumericType):
            new[f.name] = F.coalesce(F.col(f.name), F.lit(0).cast(f.dataType))
        elif isinstance(f.dataType, T.StringType):
            new[f.name] = F.coalesce(F.col(f.name), F.lit(FINAL_TEXT))
        elif isinstance(f.dataType, T.BooleanType):
            new[f.name] = F.coalesce(F.col(f.name), F.lit(False))
    return replace_columns(df, new)


def null_bearing(df: DataFrame, cols: Sequence[str]) -> list[str]:
    if not cols:
        return []
    row = df.agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(f"_{i}") for i, c in enumerate(cols)]).first()
    return [c for i, c in enumerate(cols) if row[f"_{i}"]]


def profiles(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Distinct value combinations of the columns with their row counts."""
    return df.groupBy(*[F.col(c).cast("double").alias(c) for c in cols]).agg(F.count("*").alias("n"))


def knn_fill_table(receivers: DataFrame, donors: DataFrame, cols: Sequence[str], k: int) -> DataFrame:
    """Per incomplete value combination, the kNN estimate of each missing column.

    Distance uses the coordinates both sides have, scaled by width / shared count;
    donors must have the wanted column; the estimate is the plain mean of the k
    nearest donor rows, smaller donor value first on equal distance. Rows with equal
    values are one weighted donor. With few missing patterns each pair of patterns is
    one pruned neighbour join in the shared coordinates; with many, all are searched
    together block by block. Both are exact.
    Returns (*cols, column, estimate); combinations without any comparable donor are
    absent.
    """
    cols = list(cols)
    pattern = F.array(*[F.col(c).isNotNull() for c in cols])
    any_null = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols])
    recv = keep_small(receivers.select(*cols).distinct().filter(any_null).withColumn("_p", pattern))
    give = keep_small(donors.withColumn("_p", pattern))
    r_patterns = [tuple(r["_p"]) for r in recv.select("_p").distinct().collect()]
    d_patterns = [tuple(r["_p"]) for r in give.select("_p").distinct().collect()]
    pairs = [
        (rp, dp, target)
        for rp in r_patterns for dp in d_patterns for i, target in enumerate(cols)
        if not rp[i] and dp[i] and any(a and b for a, b in zip(rp, dp))
    ]
    if len(pairs) > MOST_PATTERN_PAIRS:
        hits = masked_knn(recv.drop("_p"), give.drop("_p"), cols, k)
    else:
        hits = None
        for rp, dp, target in pairs:
            part = _pattern_hits(recv, give, cols, rp, dp, target, k)
            hits = part if hits is None else hits.unionByName(part)
    if hits is None:
        return recv.limit(0).select(*cols, F.lit("").alias("column"), F.lit(0.0).alias("estimate"))
    order = Window.partitionBy(*cols, "column").orderBy("dist", "tie").rowsBetween(Window.unboundedPreceding, -1)
    used = (
        hits.withColumn("before", F.coalesce(F.sum("w").over(order), F.lit(0)))
        .withColumn("take", F.least(F.col("w"), F.lit(k) - F.col("before")))
        .filter("take > 0")
    )
    return used.groupBy(*cols, "column").agg((F.sum(F.col("tie") * F.col("take")) / F.sum("take")).alias("estimate"))


def _pattern_hits(recv: DataFrame, give: DataFrame, cols: list[str], rp: tuple, dp: tuple, target: str, k: int) -> DataFrame:
    """(*cols, column, dist, tie, w) of one pair of missing patterns."""
    shared = [c for c, a, b in zip(cols, rp, dp) if a and b]
    vec = F.array(*[F.col(c) for c in shared])
    mine = recv.filter(F.col("_p") == F.array(*map(F.lit, rp))).select(vec.alias("vec"), *cols)
    theirs = (
        give.filter(F.col("_p") == F.array(*map(F.lit, dp)))
        .groupBy(vec.alias("vec"), F.col(target).alias("tie")).agg(F.sum("n").alias("w"))
    )
    near = knn_join(mine, theirs, k).withColumn("dist", F.col("dist") * (len(cols) / len(shared)) ** 0.5)
    return mine.join(near, "vec").select(*cols, F.lit(target).alias("column"), "dist", "tie", "w")


def masked_knn(recv: DataFrame, give: DataFrame, cols: list[str], k: int, block_rows: int = limits.BLOCK_ROWS) -> DataFrame:
    """(*cols, column, dist, tie, w): k nearest weighted donors per receiver and missing column.

    Every block of receivers meets every block of donors; a task holds two blocks and
    emits at most k rows per receiver and column.
    """
    ship(recv.sparkSession)
    r_blocks = max(1, math.ceil(recv.count() / block_rows))
    d_blocks = max(1, math.ceil(give.count() / block_rows))

    def in_blocks(df: DataFrame, own: str, n: int, other: str, m: int) -> DataFrame:
        return df.withColumn(own, F.pmod(F.xxhash64(*cols), F.lit(n)).cast("int")).withColumn(
            other, F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
        )

    schema = ", ".join(f"`{c}` double" for c in cols) + ", `column` string, dist double, tie double, w bigint"

    def top(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        names = [*cols, "column", "dist", "tie", "w"]
        pieces = [pd.DataFrame({n: [] for n in names})]
        if not len(a) or not len(b):
            return pieces[0]
        x, y, w = a[cols].to_numpy(dtype=float), b[cols].to_numpy(dtype=float), b["n"].to_numpy()
        for start in range(0, len(x), 256):
            part = x[start:start + 256]
            total, shared = np.zeros((len(part), len(y))), np.zeros((len(part), len(y)))
            for j in range(len(cols)):
                gap = part[:, j, None] - y[None, :, j]
                both = ~np.isnan(gap)
                total += np.where(both, gap * gap, 0.0)
                shared += both
            dist = np.where(shared > 0, np.sqrt(total * (len(cols) / np.maximum(shared, 1))), np.inf)
            for j, c in enumerate(cols):
                who, usable = np.flatnonzero(np.isnan(part[:, j])), np.flatnonzero(~np.isnan(y[:, j]))
                if not len(who) or not len(usable):
                    continue
                by_value = usable[y[usable, j].argsort(kind="stable")]
                d = dist[np.ix_(who, by_value)]
                best = d.argsort(axis=1, kind="stable")[:, :k]
                rows, hit = np.repeat(who, best.shape[1]), by_value[best.ravel()]
                found = pd.DataFrame(part[rows], columns=cols)
                found["column"], found["dist"], found["tie"], found["w"] = c, dist[rows, hit], y[hit, j], w[hit]
                pieces.append(found[np.isfinite(found["dist"])])
        return pd.concat(pieces, ignore_index=True)[names]

    left = in_blocks(recv, "_rb", r_blocks, "_db", d_blocks)
    right = in_blocks(give, "_db", d_blocks, "_rb", r_blocks)
    right = right.select(*[F.col(c).alias(c) for c in right.columns])
    found = left.groupBy("_rb", "_db").cogroup(right.groupBy("_rb", "_db")).applyInPandas(top, schema)
    return found.select(*[F.when(~F.isnan(c), F.col(c)).alias(c) for c in cols], "column", "dist", "tie", "w")


def impute_knn(df: DataFrame, donors: DataFrame, means: dict[str, float | None], cols: Sequence[str], k: int) -> DataFrame:
    """Fill ``cols`` from the k nearest training profiles, else the training mean."""
    cols = [c for c in cols if c in df.columns]
    own = profiles(df, cols)
    any_null = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols])
    receivers = own.filter(any_null)
    key = F.concat_ws("|", *[F.coalesce(F.col(c).cast("double").cast("string"), F.lit("~")) for c in cols])
    fill = (
        knn_fill_table(receivers, donors, cols, k)
        .withColumn("column", F.concat(F.lit("_e_"), "column"))
        .groupBy(*cols).pivot("column", [f"_e_{c}" for c in cols]).agg(F.first("estimate"))
        .select(key.alias("_key"), *[f"_e_{c}" for c in cols])
    ) if len(cols) > 1 else None
    mean = {c: F.lit(means.get(c) if means.get(c) is not None else 0.0) for c in cols}
    if fill is None:
        return replace_columns(df, {c: F.coalesce(F.col(c).cast("double"), mean[c]) for c in cols})
    weights = receivers.select(key.alias("_key"), F.col("n").alias("_n"))
    table = keep_small(weights.join(fill, "_key", "left"))
    joined = lookup(df.withColumn("_key", key), table, "_key", [f"_e_{c}" for c in cols], "_n")
    return joined.select(
        *[
            F.coalesce(F.col(c).cast("double"), F.col(f"_e_{c}"), mean[c]).alias(c) if c in cols else F.col(c)
            for c in df.columns
        ]
    )


def fit_impute(df: DataFrame, method: str = "knn", exclude: Sequence[str] = (), **params) -> ImputeState:
    """Learn every fill from training rows; ``exclude`` names target and identifiers.

    Every non-numeric column gets its mode, however many values it has: values are counted before they are compared.
    """
    if method not in METHODS:
        raise ValueError(f"unknown imputation method: {method}")
    numeric = numeric_columns(df, exclude)
    holes = null_bearing(df, numeric) if method != "median" else []
    modes = column_modes(df, non_numeric_columns(df, exclude))
    state = ImputeState(method, modes, medians(df, [c for c in numeric if c not in holes]))
    if method == "knn" and holes:
        state.knn_columns = holes
        state.k = int(params.get("n_neighbors", 5))
        row = df.agg(*[F.avg(F.col(c).cast("double")).alias(f"_{i}") for i, c in enumerate(holes)]).first()
        state.means = {c: row[f"_{i}"] for i, c in enumerate(holes)}
        state.donors = keep_small(profiles(df, holes))
    elif method == "missforest" and holes:
        state.forests = iterative.fit_forests(df, holes, **params)
    return state


def apply_impute(df: DataFrame, state: ImputeState, exclude: Sequence[str] = ()) -> DataFrame:
    """Modes, then the numeric method, then medians for columns that had no NULL in training."""
    out = impute_mode(df, {c: m for c, m in state.modes.items() if c not in exclude})
    if state.donors is not None:
        out = impute_knn(out, state.donors, state.means, state.knn_columns, state.k)
    if state.forests is not None:
        out = iterative.apply_forests(out, state.forests)
    known = {c: m for c, m in state.medians.items() if c not in exclude}
    return final_sweep(_filled(out, known), exclude)
