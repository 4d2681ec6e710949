"""Gradient boosting of a class target: one residual state for all classes, Newton steps in the leaves.

A round is one job on the rows' state (features, class, one score per class): the softmax (two classes: logistic) residuals of all classes
are taken from the same scores, one regression tree per class (two classes: one) is grown on them by the forest's grower, and
the next round adds its leaves to the scores. The state is kept in packed blocks of rows, the cuts of the features are taken once. It is held round by
round, a round at a time, and checkpointed every ``CUT`` rounds, so a lost executor recomputes a few rounds and plans stay short. Trees are shallow; the driver holds them all.
"""

from __future__ import annotations

import json
import pickle
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from riskloom.operators import trees
from riskloom.session import hold, settle, ship

CUT = 4


def probabilities(scores: np.ndarray) -> np.ndarray:
    """Class probabilities of raw scores, one column per class; a single column is the log odds of the second class."""
    if scores.shape[1] == 1:
        p = 1.0 / (1.0 + np.exp(-np.clip(scores, -700, 700)))
        return np.hstack([1.0 - p, p])
    raised = np.exp(scores - scores.max(axis=1, keepdims=True))
    return raised / raised.sum(axis=1, keepdims=True)


def residuals(scores: np.ndarray, y: np.ndarray) -> np.ndarray:
    p = probabilities(scores)
    if scores.shape[1] == 1:
        return (y - p[:, 1])[:, None]
    return (y[:, None] == np.arange(scores.shape[1])) - p


@dataclass
class Boosted:
    """Start scores and the trees of every round, one per column of scores (None: that tree saw no row)."""

    start: np.ndarray
    rate: float
    rounds: list[list[trees.Tree | None]] = field(default_factory=list)
    importance: np.ndarray | None = None

    def scores(self, x: np.ndarray) -> np.ndarray:
        out = np.tile(self.start, (len(x), 1))
        for turn in self.rounds:
            self.add(out, x, turn)
        return out

    def add(self, scores: np.ndarray, x: np.ndarray, turn: Sequence[trees.Tree | None]) -> None:
        for k, tree in enumerate(turn):
            if tree is not None:
                scores[:, k] += self.rate * tree.value[tree.find(x), 0]

    def save(self, spark: SparkSession, path: str) -> None:
        rows = [(r, k, bytearray(pickle.dumps(t))) for r, turn in enumerate(self.rounds) for k, t in enumerate(turn)]
        spark.createDataFrame(rows, "round int, k int, data binary").coalesce(1).write.mode("overwrite").parquet(f"{path}/trees")
        head = {"start": self.start.tolist(), "rate": self.rate, "importance": self.importance.tolist(), "rounds": len(self.rounds)}
        spark.createDataFrame([(json.dumps(head),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/head")

    @staticmethod
    def load(spark: SparkSession, path: str) -> Boosted:
        head = json.loads(spark.read.text(f"{path}/head").first()["value"])
        out = Boosted(np.array(head["start"]), head["rate"], [[None] * len(head["start"]) for _ in range(head["rounds"])], np.array(head["importance"]))
        for r in spark.read.parquet(f"{path}/trees").collect():
            out.rounds[r["round"]][r["k"]] = pickle.loads(bytes(r["data"]))
        return out


def fit_boosted(rows: DataFrame, width: int, classes: int, counts: dict[int, int], rounds: int = 100, rate: float = 0.1, max_depth: int | None = 3,
                min_split: int = 2, min_leaf: int = 1, share: float = 1.0, seed: int = 42, local_rows: int = trees.LOCAL_ROWS) -> Boosted:
    """Boost rows ``h, x, y`` (class index); ``counts`` are the rows of each class. ``share`` of the rows is drawn by hash in each round."""
    spark = rows.sparkSession
    ship(spark)
    n = sum(counts.values())
    prior = np.maximum(np.array([counts.get(k, 0) for k in range(classes)], dtype=np.float64) / n, np.finfo(np.float32).eps)
    start = np.array([np.log(prior[1] / prior[0])]) if classes == 2 else np.log(prior)
    model = Boosted(start, rate, [], np.zeros(width))
    schema = ", ".join(f"{c} binary" for c in "hmxkfy")

    def state(df: DataFrame, turn: list[trees.Tree | None] | None) -> DataFrame:
        """Scores after the trees of a round (none yet: the start), and their residuals."""
        sent = spark.sparkContext.broadcast((turn, Boosted(start, rate)))

        def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            turn, own = sent.value
            for batch in batches:
                for block in batch.to_pylist():
                    x = np.frombuffer(block["x"]).reshape(-1, width)
                    if turn is None:
                        y, f = np.frombuffer(block["y"]).astype(np.int32), np.tile(own.start, (len(x), 1))
                    else:
                        y, f = np.frombuffer(block["k"], dtype=np.int32), np.frombuffer(block["f"]).reshape(len(x), -1).copy()
                        own.add(f, x, turn)
                    found = {"k": y.tobytes(), "f": trees._bytes(f), "y": trees._bytes(residuals(f, y))}
                    yield pa.RecordBatch.from_pydict({c: [found.get(c, block.get(c))] for c in "hmxkfy"})

        return df.mapInArrow(step, schema)

    rows = rows.select("h", F.lit(1.0).alias("m"), "x", "y")
    cuts = trees.cuts_of(rows, width) if n > local_rows else None
    current = hold(state(trees.packed(rows, width, n), None))
    held = [current]
    for r in range(int(rounds)):
        rules = trees.Rules(
            max_depth=max_depth, min_split=min_split, min_leaf=min_leaf, bootstrap=False, seed=seed + 7919 * r,
            newton=1.0 if classes == 2 else (classes - 1) / classes, share=share)
        grown = trees.fit_forest(current, width, rules, len(start), local_rows=local_rows, model_bytes=1 << 40, count=n, cuts=cuts)
        model.rounds.append(grown.trees())
        model.importance += grown.gains
        # The state of the round before has served.
        while len(held) > 1:
            held.pop(0).unpersist()
        if r + 1 < int(rounds):
            current = state(current, model.rounds[-1])
            if (r + 1) % CUT == 0:
                current = settle(current)
                while held:
                    held.pop().unpersist()
            else:
                held.append(hold(current))
    for df in held:
        df.unpersist()
    total = model.importance.sum()
    model.importance = model.importance / total if total > 0 else model.importance
    return model


def predict(df: DataFrame, model: Boosted, features: Sequence[str], out: str) -> DataFrame:
    """Adds the class probabilities; map-only."""
    spark = df.sparkSession
    ship(spark)
    sent = spark.sparkContext.broadcast(model)

    def run(*columns: pd.Series) -> pd.Series:
        x = np.column_stack([c.to_numpy(dtype=np.float64) for c in columns])
        return pd.Series(list(probabilities(sent.value.scores(x))))

    return df.withColumn(out, F.pandas_udf(run, "array<double>")(*[F.col(f"`{c}`").cast("double") for c in features]))
