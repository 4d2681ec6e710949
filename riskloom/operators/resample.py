"""Class rebalancing of training rows.

Random draws are functions of (seed, class, draw number) or of the row key, so a
result does not depend on partitioning. Synthetic rows carry the key of their base
row and a positive _copy number; original rows have _copy 0.
"""

from __future__ import annotations

import logging
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from riskloom import limits
from riskloom.functions.hashing import order_hash, pick, unit
from riskloom.functions.lookup import lookup
from riskloom.functions.ranking import at_or_below, dense_index, hash_cutoffs
from riskloom.operators.neighbors import knn_join
from riskloom.session import keep_small

METHODS = ("none", "oversample", "undersample", "smote", "adasyn")
log = logging.getLogger(__name__)


class CannotResample(ValueError):
    """A precondition of the method does not hold; the data is left as it is."""


def class_counts(df: DataFrame, label: str) -> dict:
    return {r[label]: r["count"] for r in df.groupBy(label).count().orderBy(label).collect()}


def class_targets(counts: dict, strategy="auto", method: str = "oversample") -> dict:
    """Wanted rows per class.

    auto: every smaller class up to the largest (undersample: every larger class down
    to the smallest). minority: only the smallest class. A ratio is minority/majority
    after resampling and needs two classes; smote and adasyn read it as auto otherwise.
    """
    big = max(counts, key=lambda c: counts[c])
    small = min(counts, key=lambda c: counts[c])
    out = dict(counts)
    if isinstance(strategy, (int, float)) and len(counts) > 2:
        if method not in ("smote", "adasyn"):
            raise CannotResample("a ratio needs a binary target")
        strategy = "auto"
    if method == "undersample":
        if strategy == "auto":
            out = {c: min(n, counts[small]) for c, n in counts.items()}
        elif isinstance(strategy, (int, float)):
            out[big] = int(counts[small] / strategy)
            if out[big] > counts[big]:
                raise CannotResample("the ratio would need more majority rows")
        else:
            raise CannotResample(f"strategy {strategy!r} does not apply to undersampling")
    elif strategy == "auto":
        out = {c: counts[big] for c in counts}
    elif strategy == "minority":
        out[small] = counts[big]
    elif isinstance(strategy, (int, float)):
        for c in counts:
            if c != big:
                grow = int(counts[big] * strategy - counts[c])
                if grow <= 0:
                    raise CannotResample("the ratio would remove minority rows")
                out[c] = counts[c] + grow
    else:
        raise CannotResample(f"unknown strategy {strategy!r}")
    return out


def targets_table(df: DataFrame, label: str, strategy="auto", method: str = "oversample") -> DataFrame:
    """(label, n, target), one row per class."""
    counts = class_counts(df, label)
    try:
        goal = class_targets(counts, strategy, method)
    except CannotResample as reason:
        log.warning("targets unchanged: %s", reason)
        goal = counts
    rows = [(c, n, goal[c]) for c, n in counts.items()]
    kind = df.schema[label].dataType.simpleString()
    return df.sparkSession.createDataFrame(rows, f"{label} {kind}, n bigint, target bigint")


def resample(
    df: DataFrame, label: str, key: str, method: str = "none", features: Sequence[str] = (), seed: int = 42, **params
) -> DataFrame:
    """Rebalanced rows; a method whose preconditions fail returns the input, logged."""
    if method not in METHODS:
        raise ValueError(f"unsupported resampling method: {method}")
    if method == "none":
        return df.withColumn("_copy", F.lit(0).cast("bigint"))
    strategy = params.get("sampling_strategy", "auto")
    try:
        if method == "oversample":
            return oversample(df, label, key, strategy, seed)
        if method == "undersample":
            return undersample(df, label, key, strategy, seed).withColumn("_copy", F.lit(0).cast("bigint"))
        if method == "smote":
            return smote(df, label, key, features, int(params.get("k_neighbors", 5)), strategy, seed)
        return adasyn(df, label, key, features, int(params.get("n_neighbors", 5)), strategy, seed)
    except CannotResample as reason:
        log.warning("%s left the data unchanged: %s", method, reason)
        return df.withColumn("_copy", F.lit(0).cast("bigint"))


def oversample(df: DataFrame, label: str, key: str, strategy="auto", seed: int = 42) -> DataFrame:
    """Original rows plus draws with replacement up to each class target.

    Draw j of a class takes the row at position hash(j) mod n; draws are counted per
    position before they meet the rows, and each row is then repeated in place.
    """
    counts = class_counts(df, label)
    goal = class_targets(counts, strategy)
    grow = {c: goal[c] - n for c, n in counts.items() if goal[c] > n}
    if not grow:
        return df.withColumn("_copy", F.lit(0).cast("bigint"))
    spark = df.sparkSession
    kind = df.schema[label].dataType
    draws = reduce(
        DataFrame.unionByName,
        [
            spark.range(g).select(
                F.lit(c).cast(kind).alias(label),
                pick(order_hash(f"{seed}:base", F.lit(c), F.col("id")), F.lit(counts[c])).alias("_idx"),
            )
            for c, g in grow.items()
        ],
    ).groupBy(label, "_idx").agg(F.count("*").alias("_times"))
    growing = F.coalesce(F.col(label).isin(list(grow)), F.lit(False))
    rows = dense_index(df.filter(growing), order_hash(seed, key), [label])
    repeated = rows.join(draws, [label, "_idx"], "left").withColumn(
        "_copy", F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce(F.col("_times"), F.lit(0))))
    )
    # Classes that do not grow stay where they are.
    others = df.filter(~growing).withColumn("_copy", F.lit(0).cast("bigint"))
    return others.unionByName(repeated.select(*df.columns, "_copy"))


def undersample(df: DataFrame, label: str, key: str, strategy="auto", seed: int = 42) -> DataFrame:
    """The rows of smallest key hash per class; a filter, no row moves."""
    h = order_hash(seed, key)
    cuts, sizes = hash_cutoffs(
        df, h, lambda n: class_targets(dict(sorted(n.items(), key=lambda x: str(x[0]))), strategy, "undersample"), F.col(label)
    )
    return df.filter(at_or_below(h, cuts, F.col(label)))


def _points(df: DataFrame, label: str, key: str, features: Sequence[str]) -> DataFrame:
    return df.select(
        F.col(key).alias("_key"), F.col(label).alias("_label"),
        F.array(*[F.col(c).cast("double") for c in features]).alias("vec"),
    )


def near_lists(rows: DataFrame, donors: DataFrame, k: int) -> DataFrame:
    """rows(_key, vec, ...) plus nb: the k nearest donors other than the row itself, in order.

    donors(vec, _key, payload...). Each element of nb has rank, dist, tie and the
    payload. Equal vectors share one search for k + 1 donors.
    """
    payload = [c for c in donors.columns if c not in ("vec", "_key")]
    tie = donors.schema["_key"].dataType.simpleString()
    hits = knn_join(rows.select("vec"), donors.withColumnRenamed("_key", "tie"), k + 1, tie)
    lists = hits.groupBy("vec").agg(
        F.sort_array(F.collect_list(F.struct("rank", "dist", "tie", *payload))).alias("nb")
    )
    weights = rows.groupBy("vec").agg(F.count("*").alias("_n"))
    table = keep_small(weights.join(lists, "vec"), limits.LOCAL_VECTORS)
    joined = lookup(rows, table, "vec", ["nb"], "_n")
    others = F.filter("nb", lambda x: x["tie"] != F.col("_key"))
    return joined.withColumn("nb", F.slice(others, 1, k))


def _between(a: Column, b: Column, u: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x + u * (y - x))


def _finish(df: DataFrame, synthetic: DataFrame, label: str, key: str, features: Sequence[str]) -> DataFrame:
    """Original rows and synthetic(_key, _label, _copy, vec) under one schema."""
    cols = [key, label, *features]
    real = df.select(
        key, label, *[F.col(c).cast("double").alias(c) for c in features], F.lit(0).cast("bigint").alias("_copy")
    )
    made = synthetic.select(
        F.col("_key").alias(key), F.col("_label").alias(label),
        *[F.col("vec")[i].alias(c) for i, c in enumerate(features)], F.col("_copy").cast("bigint").alias("_copy"),
    )
    return real.unionByName(made.select(*cols, "_copy"))


def smote(
    df: DataFrame, label: str, key: str, features: Sequence[str], k: int = 5, strategy="auto", seed: int = 42
) -> DataFrame:
    """Points between a drawn row and one of its k same-class neighbours (Chawla et al. 2002).

    Draw j picks its base row, neighbour and position by hash. Output columns: key,
    label, features as double, _copy.
    """
    counts = class_counts(df, label)
    goal = class_targets(counts, strategy, "smote")
    points = _points(df, label, key, features)
    made = []
    for c, n in counts.items():
        g = goal[c] - n
        if g <= 0:
            continue
        if n <= k:
            raise CannotResample(f"class {c} has {n} rows, too few for {k} neighbours")
        mine = keep_small(dense_index(points.filter(F.col("_label") == F.lit(c)), order_hash(seed, "_key")), limits.LOCAL_VECTORS)
        j = F.col("id")
        draws = df.sparkSession.range(g).select(
            (j + 1).alias("_copy"),
            pick(order_hash(f"{seed}:base", F.lit(c), j), F.lit(n)).alias("_idx"),
            (pick(order_hash(f"{seed}:near", F.lit(c), j), F.lit(k)) + 1).cast("int").alias("_pick"),
            unit(order_hash(f"{seed}:gap", F.lit(c), j)).alias("_u"),
        )
        drawn = draws.join(mine, "_idx")
        near = near_lists(drawn, mine.select("vec", "_key", F.col("vec").alias("other")), k)
        made.append(
            near.select(
                "_key", "_label", "_copy",
                _between(F.col("vec"), F.element_at("nb", F.col("_pick"))["other"], F.col("_u")).alias("vec"),
            )
        )
    if not made:
        return _finish(df, points.limit(0).withColumn("_copy", F.lit(0)), label, key, features)
    return _finish(df, reduce(DataFrame.unionByName, made), label, key, features)


def adasyn_weights(
    df: DataFrame, label: str, key: str, features: Sequence[str], k: int, cls, grow: int
) -> DataFrame:
    """(_key, _label, vec, ratio, draws) for the rows of one class (He et al. 2008).

    ratio is the share of other-class rows among the k nearest in the whole table;
    draws = round(ratio / sum of ratios * grow), halves to even.
    """
    points = keep_small(_points(df, label, key, features), limits.LOCAL_VECTORS)
    mine = points.filter(F.col("_label") == F.lit(cls))
    near = near_lists(mine, points.select("vec", "_key", F.col("_label").alias("other")), k)
    rated = keep_small(
        near.withColumn("ratio", F.size(F.filter("nb", lambda x: x["other"] != F.lit(cls))) / F.lit(float(k)))
        .select("_key", "_label", "vec", "ratio"),
        limits.LOCAL_VECTORS,
    )
    total = rated.agg(F.sum("ratio").alias("s")).first()["s"]
    if not total:
        raise CannotResample(f"class {cls} has no other-class neighbours")
    return rated.withColumn("draws", F.rint(F.col("ratio") / F.lit(float(total)) * F.lit(float(grow))).cast("bigint"))


def adasyn(
    df: DataFrame, label: str, key: str, features: Sequence[str], k: int = 5, strategy="auto", seed: int = 42
) -> DataFrame:
    """Like smote, with more draws for rows surrounded by other classes."""
    counts = class_counts(df, label)
    goal = class_targets(counts, strategy, "adasyn")
    points = _points(df, label, key, features)
    made = []
    for c, n in counts.items():
        g = goal[c] - n
        if g <= 0:
            continue
        if n <= k:
            raise CannotResample(f"class {c} has {n} rows, too few for {k} neighbours")
        rated = adasyn_weights(df, label, key, features, k, c, g)
        busy = keep_small(rated.filter("draws > 0"), limits.LOCAL_VECTORS)
        near = near_lists(busy, rated.select("vec", "_key", F.col("vec").alias("other")), k)
        draws = _repeat(near)
        chosen = (pick(order_hash(f"{seed}:near", F.lit(c), "_key", "_copy"), F.lit(k)) + 1).cast("int")
        u = unit(order_hash(f"{seed}:gap", F.lit(c), "_key", "_copy"))
        made.append(
            draws.select(
                "_key", "_label", "_copy",
                _between(F.col("vec"), F.element_at("nb", chosen)["other"], u).alias("vec"),
            )
        )
    if not made:
        return _finish(df, points.limit(0).withColumn("_copy", F.lit(0)), label, key, features)
    return _finish(df, reduce(DataFrame.unionByName, made), label, key, features)


def _repeat(near: DataFrame) -> DataFrame:
    """One row per draw, _copy counting from 1.

    Rows with very many draws are first cut into ranges that are spread over tasks.
    """
    one = F.lit(1).cast("bigint")
    step = F.lit(limits.ONE_TASK_ROWS).cast("bigint")
    top = near.agg(F.max("draws").alias("m")).first()["m"] or 0
    if top <= limits.ONE_TASK_ROWS:
        return near.withColumn("_copy", F.explode(F.sequence(one, F.col("draws"))))
    ranges = near.withColumn("_from", F.explode(F.sequence(one, F.col("draws"), step)))
    return (
        ranges.repartition("_key", "_from")
        .withColumn("_copy", F.explode(F.sequence(F.col("_from"), F.least(F.col("draws"), F.col("_from") + step - 1))))
        .drop("_from")
    )
