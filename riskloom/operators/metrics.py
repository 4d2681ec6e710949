"""Exact classification metrics.

Threshold-free metrics group rows by score first, so a score shared by many rows is
one record, and accumulate over score ranges in parallel.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from riskloom import limits
from riskloom.functions.ranking import value_buckets
from riskloom.session import hold, settle

REPORT_SCHEMA = "class string, metric string, value double"


def confusion(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """(y, p, n): at most classes squared rows."""
    return df.groupBy(F.col(label).cast("int").alias("y"), F.col(prediction).cast("int").alias("p")).agg(
        F.count("*").alias("n")
    )


def _ratio(a: float, b: float) -> float:
    return a / b if b else 0.0


def class_scores(cells: Sequence) -> dict[int, dict[str, float]]:
    """Precision, recall, f1 and support per class seen in labels or predictions; 0/0 = 0."""
    classes = sorted({r["y"] for r in cells} | {r["p"] for r in cells})
    out = {}
    for c in classes:
        hit = sum(r["n"] for r in cells if r["y"] == c and r["p"] == c)
        said = sum(r["n"] for r in cells if r["p"] == c)
        true = sum(r["n"] for r in cells if r["y"] == c)
        p, r = _ratio(hit, said), _ratio(hit, true)
        out[c] = {"precision": p, "recall": r, "f1-score": _ratio(2 * p * r, p + r), "support": float(true)}
    return out


def averaged(scores: dict[int, dict[str, float]], metric: str, kind: str) -> float:
    if kind == "macro":
        return sum(s[metric] for s in scores.values()) / len(scores)
    total = sum(s["support"] for s in scores.values())
    return _ratio(sum(s[metric] * s["support"] for s in scores.values()), total)


def label_metrics(df: DataFrame, label: str, prediction: str, classes: int) -> tuple[dict, list[tuple]]:
    """Metrics that need only labels and predictions, and the long report, from one job."""
    cells = confusion(df, label, prediction).collect()
    scores = class_scores(cells)
    n = sum(r["n"] for r in cells)
    accuracy = _ratio(sum(r["n"] for r in cells if r["y"] == r["p"]), n)
    binary = classes == 2
    one = scores.get(1, {"precision": 0.0, "recall": 0.0, "f1-score": 0.0})
    metrics = {
        "accuracy": accuracy,
        "f1_score": one["f1-score"] if binary else averaged(scores, "f1-score", "macro"),
        "f1_score_weighted": averaged(scores, "f1-score", "weighted"),
        "f1_score_micro": accuracy,
        "f1_score_macro": averaged(scores, "f1-score", "macro"),
        "precision": one["precision"] if binary else averaged(scores, "precision", "macro"),
        "recall": one["recall"] if binary else averaged(scores, "recall", "macro"),
    }
    report = [(str(c), m, v) for c, s in scores.items() for m, v in s.items()]
    report.append(("accuracy", "accuracy", accuracy))
    for kind in ("macro", "weighted"):
        report += [(f"{kind} avg", m, averaged(scores, m, kind)) for m in ("precision", "recall", "f1-score")]
        report.append((f"{kind} avg", "support", float(n)))
    return metrics, report


def classification_report(df: DataFrame, label: str, prediction: str) -> DataFrame:
    _, report = label_metrics(df, label, prediction, 2)
    return df.sparkSession.createDataFrame(report, REPORT_SCHEMA)


def ranked_scores(cells: DataFrame, bucket_rows: int = limits.ONE_TASK_ROWS, at_most: int | None = None) -> DataFrame:
    """cells(cls, score, hit 0/1) -> per class and distinct score: pos, neg and the
    running totals tp, fp from the highest score down.

    ``at_most`` is a known bound on the number of cells; within one bucket's size no
    count is needed.
    """
    groups = cells.groupBy("cls", "score").agg(F.sum("hit").alias("pos"), F.sum(1 - F.col("hit")).alias("neg"))
    m = at_most
    if m is None or m > bucket_rows:
        groups = settle(groups)
        m = groups.count()
    parts = min(10_000, max(1, math.ceil(m / bucket_rows)))
    work = value_buckets(groups, "score", parts=parts) if parts > 1 else groups.withColumn("_bucket", F.lit(0.0))
    inside = Window.partitionBy("cls", "_bucket").orderBy(F.desc("score"))
    run = work.withColumn("tp", F.sum("pos").over(inside)).withColumn("fp", F.sum("neg").over(inside))
    if parts == 1:
        return run.drop("_bucket")
    ahead = Window.partitionBy("cls").orderBy(F.desc("_bucket")).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        work.groupBy("cls", "_bucket").agg(F.sum("pos").alias("p"), F.sum("neg").alias("f"))
        .select("cls", "_bucket", F.coalesce(F.sum("p").over(ahead), F.lit(0)).alias("_p"), F.coalesce(F.sum("f").over(ahead), F.lit(0)).alias("_f"))
    )
    return run.join(F.broadcast(offsets), ["cls", "_bucket"]).select(
        "cls", "score", "pos", "neg", (F.col("tp") + F.col("_p")).alias("tp"), (F.col("fp") + F.col("_f")).alias("fp")
    )


def rank_metrics(cells: DataFrame, bucket_rows: int = limits.ONE_TASK_ROWS, at_most: int | None = None) -> DataFrame:
    """(cls, roc_auc, auprc) per class; NULL where a class has one side only.

    auprc is average precision: the sum over distinct scores of recall gained times
    precision. roc_auc counts ties as one half.
    """
    run = ranked_scores(cells, bucket_rows, at_most)
    pos, neg = F.col("pos"), F.col("neg")
    total = run.groupBy("cls").agg(
        F.sum("pos").alias("P"), F.sum("neg").alias("N"),
        F.sum(neg * (F.col("tp") - pos) + 0.5 * pos * neg).alias("wins"),
        F.sum(pos * (F.col("tp") / (F.col("tp") + F.col("fp")))).alias("area"),
    )
    return total.select(
        "cls",
        F.when((F.col("P") > 0) & (F.col("N") > 0), F.col("wins") / (F.col("P").cast("double") * F.col("N"))).alias("roc_auc"),
        F.when(F.col("P") > 0, F.col("area") / F.col("P")).alias("auprc"),
    )


def binary_cells(df: DataFrame, label: str, score: str | Column) -> DataFrame:
    s = F.col(score) if isinstance(score, str) else score
    return df.select(F.lit(1).alias("cls"), s.cast("double").alias("score"), (F.col(label) == 1).cast("bigint").alias("hit"))


def class_cells(df: DataFrame, label: str, probabilities: str) -> DataFrame:
    """One row per class and input row: one-vs-rest form."""
    return df.select(F.col(label).alias("y"), F.posexplode(probabilities).alias("cls", "score")).select(
        "cls", F.col("score").cast("double").alias("score"), (F.col("y") == F.col("cls")).cast("bigint").alias("hit")
    )


def evaluate(scored: DataFrame, label: str, prediction: str, probabilities: str, classes: int) -> tuple[dict, list[tuple]]:
    """All metrics of one scored table: two jobs whatever its size."""
    base = hold(scored.select(label, prediction, probabilities))
    metrics, report = label_metrics(base, label, prediction, classes)
    support = int(report[-1][2])
    if classes == 2:
        cells, n = binary_cells(base, label, F.element_at(probabilities, 2)), support
    else:
        cells, n = class_cells(base, label, probabilities), support * classes
    rows = rank_metrics(cells, at_most=n).collect()
    for name in ("roc_auc", "auprc"):
        values = [r[name] for r in rows]
        metrics[name] = sum(values) / len(values) if values and None not in values else None
    # Per-class average precision weighted by support; with two classes that of the positive class.
    support_of = {c: v for c, m, v in report if m == "support"}
    known = [(support_of.get(str(r["cls"]), 0.0), r["auprc"]) for r in rows if r["auprc"] is not None]
    whole = sum(n for n, _ in known)
    metrics["average_precision_weighted"] = sum(n * v for n, v in known) / whole if whole else None
    base.unpersist()
    return metrics, report
