"""Exact ranks without a global sort in one task."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, functions as F

from riskloom.functions.hashing import order_hash

_STEP = 3
_TAIL = 20_000


def hash_cutoffs(
    df: DataFrame,
    hashed: Column,
    take: Callable[[dict], dict],
    group: Column | None = None,
) -> tuple[dict, dict]:
    """Per group, the k-th smallest hash; rows at or below it are exactly k.

    Works by narrowing a hex prefix: each pass counts rows per next three hex
    digits (at most 4096 counts per group reach the driver), so no row moves.
    ``take`` maps group sizes to wanted k. Returns (cutoffs, sizes); a cutoff is
    None for k = 0.
    """
    base = df.select((group if group is not None else F.lit(0)).alias("g"), hashed.alias("h"))
    counts = _prefix_counts(base, _STEP)
    sizes = {g: sum(n for _, n in rows) for g, rows in counts.items()}
    wanted = take(sizes)
    cutoffs: dict = {}
    open_groups: dict = {}
    for g, k in wanted.items():
        if k <= 0:
            cutoffs[g] = None
        elif k >= sizes[g]:
            cutoffs[g] = "g"
        else:
            open_groups[g] = ("", k)
    while open_groups:
        tails = []
        for g, (prefix, left) in list(open_groups.items()):
            for p, n in sorted(counts[g]):
                if left > n:
                    left -= n
                    continue
                if left == n:
                    cutoffs[g] = p + "g"
                    del open_groups[g]
                else:
                    open_groups[g] = (p, left)
                    if n <= _TAIL or len(p) >= 30:
                        tails.append(g)
                break
        if tails:
            # Equal hashes arrive as one row with their count, so a key that repeats is no burden.
            rows = _inside(base, {g: open_groups[g][0] for g in tails}).groupBy("g", "h").count().collect()
            for g in tails:
                left = open_groups[g][1]
                for h, n in sorted((r["h"], r["count"]) for r in rows if r["g"] == g):
                    left -= n
                    if left <= 0:
                        cutoffs[g] = h
                        break
                del open_groups[g]
        if open_groups:
            width = {len(p) for p, _ in open_groups.values()}.pop() + _STEP
            counts = _prefix_counts(_inside(base, {g: p for g, (p, _) in open_groups.items()}), width)
    return cutoffs, sizes


def _prefix_counts(base: DataFrame, width: int) -> dict:
    rows = base.groupBy("g", F.substring("h", 1, width).alias("p")).count().collect()
    out: dict = {}
    for r in rows:
        out.setdefault(r["g"], []).append((r["p"], r["count"]))
    return out


def _inside(base: DataFrame, prefixes: dict) -> DataFrame:
    keep = F.lit(False)
    for g, p in prefixes.items():
        same = F.col("g").isNull() if g is None else F.col("g") == F.lit(g)
        keep = keep | (same & F.col("h").startswith(p))
    return base.filter(keep)


def at_or_below(hashed: Column, cutoffs: dict, group: Column | None = None) -> Column:
    """Row-local test that a row is among the first k of its group."""
    if group is None:
        cut = cutoffs[0]
        return F.lit(False) if cut is None else hashed <= F.lit(cut)
    test = F.lit(False)
    for g, cut in cutoffs.items():
        if cut is not None:
            same = group.isNull() if g is None else group == F.lit(g)
            test = test | (same & (hashed <= F.lit(cut)))
    return F.coalesce(test, F.lit(False))


def dense_index(
    df: DataFrame, hashed: Column, by: Sequence[str] = (), out: str = "_idx", bucket_rows: int = 250_000
) -> DataFrame:
    """0-based position of each row in hash order within its group.

    Rows are cut into hash-prefix buckets, which are even by construction whatever
    the key distribution; the position is the bucket's offset plus the rank inside.
    """
    by = list(by)
    work = df.withColumn("_h", hashed)
    n = df.count()
    digits = 1
    while n / 16**digits > bucket_rows and digits < 4:
        digits += 1
    work = work.withColumn("_b", F.substring("_h", 1, digits))
    totals = work.groupBy(*by, "_b").agg(F.count("*").alias("_n"))
    ahead = Window.partitionBy(*by, F.lit(0)).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*by, "_b", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_off"))
    inside = Window.partitionBy(*by, "_b").orderBy("_h")
    return (
        work.join(F.broadcast(offsets), [*by, "_b"])
        .withColumn(out, F.row_number().over(inside) - 1 + F.col("_off"))
        .drop("_h", "_b", "_off")
    )


def smallest_by_hash(df: DataFrame, keys: Sequence[str], m: int, n: int, seed: int | str) -> DataFrame:
    """The m rows of smallest seeded hash out of n: a uniform sample of known size."""
    h = order_hash(seed, *keys)
    work = df.withColumn("_h", h)
    if n > 4 * m:
        digits = 8
        bar = min(16**digits - 1, int(16**digits * (2.0 * m + 200) / n))
        work = work.filter(F.substring("_h", 1, digits) <= F.lit(f"{bar:0{digits}x}"))
    return work.orderBy("_h").limit(m).drop("_h")


def value_buckets(df: DataFrame, col: str, out: str = "_bucket", parts: int = 64) -> DataFrame:
    """Order-preserving buckets of about equal row counts for a double column."""
    probs = [i / parts for i in range(1, parts)]
    cuts = df.agg(F.percentile_approx(col, probs, 10_000).alias("c")).first()["c"] or []
    splits = sorted({float(c) for c in cuts})
    if not splits:
        return df.withColumn(out, F.lit(0.0))
    edges = [float("-inf"), *splits, float("inf")]
    return Bucketizer(splits=edges, inputCol=col, outputCol=out, handleInvalid="error").transform(df)
