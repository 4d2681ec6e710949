"""Exact interpolated quantiles whose memory does not grow with the data."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from riskloom import limits

_DRIVER_VALUES = 10_000
#: Tasks that summarise a column: one task merges all their summaries.
_SUMMARIES = 64


def exact_quantiles(
    df: DataFrame,
    cols: Sequence[str],
    probs: Sequence[float],
    one_task_values: int = limits.ONE_TASK_ROWS,
) -> dict[str, list[float | None]]:
    """Linear-interpolated quantiles per column, NULLs ignored.

    Columns with few distinct values use the built-in exact percentile of their distinct
    values, counted first. For the others the two neighbouring order
    statistics are bracketed by approximate percentiles until few distinct values
    remain between the brackets, and are then read off exactly. All columns and
    probabilities share each pass.
    """
    cols = list(cols)
    if not cols:
        return {}
    data = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(cols)])
    head = data.agg(
        *[F.count(f"c{i}").alias(f"n{i}") for i in range(len(cols))],
        *[F.approx_count_distinct(f"c{i}").alias(f"d{i}") for i in range(len(cols))],
    ).first()
    out: dict[str, list[float | None]] = {c: [None] * len(probs) for c in cols}
    small = [i for i in range(len(cols)) if head[f"n{i}"] and head[f"d{i}"] <= one_task_values]
    if small:
        cells = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.col(f"c{i}").alias("v")) for i in small]))
        tally = data.select(cells.alias("r")).select("r.*").filter("v IS NOT NULL").groupBy("i", "v").agg(F.count("*").alias("n"))
        for row in tally.groupBy("i").agg(F.percentile("v", F.array(*map(F.lit, probs)), F.col("n")).alias("q")).collect():
            out[cols[row["i"]]] = [float(v) for v in row["q"]]
    targets = [
        _Target(i, j, p, head[f"n{i}"]) for i in range(len(cols)) if head[f"n{i}"] and i not in small for j, p in enumerate(probs)
    ]
    for t in _selected(data, targets, min(one_task_values, _DRIVER_VALUES)):
        out[cols[t.col]][t.slot] = t.value
    return out


@dataclass
class _Target:
    """One wanted quantile: ranks first and second lie between lo and hi."""

    col: int
    slot: int
    prob: float
    n: int
    lo: float | None = None
    hi: float | None = None
    below: int = 0
    inside: int = 0
    eps: float = 2e-4
    value: float | None = None

    def __post_init__(self):
        self.inside = self.n
        pos = self.prob * (self.n - 1)
        self.first, self.second, self.part = math.floor(pos), math.ceil(pos), pos - math.floor(pos)

    def cell(self):
        c = F.col(f"c{self.col}")
        return c if self.lo is None else F.when((c >= self.lo) & (c <= self.hi), c)


def _selected(data: DataFrame, targets: list[_Target], enough: int) -> list[_Target]:
    narrow: list[_Target] = []
    work = list(targets)
    while work:
        cuts = data.coalesce(_SUMMARIES).agg(*[
            F.percentile_approx(
                t.cell(),
                [max(0.0, (t.first - t.below) / t.inside - t.eps), min(1.0, (t.second - t.below) / t.inside + t.eps)], 10_000,
            ).alias(f"t{i}")
            for i, t in enumerate(work)
        ]).first()
        aggs = []
        for i, t in enumerate(work):
            a, b = cuts[f"t{i}"]
            mid = F.when((t.cell() >= a) & (t.cell() <= b), t.cell())
            aggs += [
                F.count(F.when(t.cell() < a, 1)).alias(f"lt{i}"), F.count(mid).alias(f"mid{i}"),
                F.approx_count_distinct(mid).alias(f"d{i}"),
            ]
        stat = data.agg(*aggs).first()
        again = []
        for i, t in enumerate(work):
            below = t.below + stat[f"lt{i}"]
            if not (below <= t.first and t.second < below + stat[f"mid{i}"]):
                t.eps *= 4
                again.append(t)
                continue
            t.lo, t.hi = cuts[f"t{i}"]
            t.below, t.inside = below, stat[f"mid{i}"]
            if t.lo == t.hi:
                t.value = float(t.lo)
            elif stat[f"d{i}"] <= enough:
                narrow.append(t)
            else:
                again.append(t)
        work = again
    if narrow:
        cells = F.explode(F.array(*[F.struct(F.lit(i).alias("t"), t.cell().alias("v")) for i, t in enumerate(narrow)]))
        tally = data.select(cells.alias("r")).select("r.*").filter("v IS NOT NULL").groupBy("t", "v").count().collect()
        for i, t in enumerate(narrow):
            seen, found = t.below, {}
            for v, n in sorted((r["v"], r["count"]) for r in tally if r["t"] == i):
                for rank in (t.first, t.second):
                    if seen <= rank < seen + n:
                        found[rank] = float(v)
                seen += n
            t.value = found[t.first] + (found[t.second] - found[t.first]) * t.part
    return targets


def medians(df: DataFrame, cols: Sequence[str]) -> dict[str, float | None]:
    return {c: q[0] for c, q in exact_quantiles(df, cols, [0.5]).items()}
