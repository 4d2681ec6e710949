"""Dense ReLU network trained data-parallel.

Each epoch every partition runs mini-batch Adam over its own rows from the shared
weights; Spark averages the resulting weights by row count. Only weights and a loss
per partition ever leave a task.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from riskloom.functions.hashing import order_hash
from riskloom.operators.metrics import binary_cells, class_cells, rank_metrics
from riskloom.session import hold, ship

ROWS_PER_PART = 5_000
MOST_ROWS_PER_PART = 1_000_000
MOST_PARTS = 64
_TINY = 1e-7


@dataclass
class Network:
    sizes: list[int]
    weights: np.ndarray

    @property
    def classes(self) -> int:
        return 2 if self.sizes[-1] == 1 else self.sizes[-1]


def unpack(flat: np.ndarray, sizes: Sequence[int]) -> list[tuple[np.ndarray, np.ndarray]]:
    layers, at = [], 0
    for a, b in zip(sizes, sizes[1:]):
        w = flat[at:at + a * b].reshape(a, b)
        at += a * b
        layers.append((w, flat[at:at + b]))
        at += b
    return layers


def start_weights(sizes: Sequence[int], seed: int) -> np.ndarray:
    rng = np.random.default_rng(seed)
    parts = []
    for a, b in zip(sizes, sizes[1:]):
        reach = math.sqrt(6.0 / (a + b))
        parts += [rng.uniform(-reach, reach, a * b), np.zeros(b)]
    return np.concatenate(parts)


def _head(z: np.ndarray) -> np.ndarray:
    if z.shape[1] == 1:
        return 1.0 / (1.0 + np.exp(-np.clip(z, -60, 60)))
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def forward(x: np.ndarray, flat: np.ndarray, sizes: Sequence[int]) -> np.ndarray:
    layers = unpack(flat, sizes)
    for w, b in layers[:-1]:
        x = np.maximum(x @ w + b, 0.0)
    w, b = layers[-1]
    return _head(x @ w + b)


def _targets(y: np.ndarray, width: int) -> np.ndarray:
    return y.reshape(-1, 1).astype(float) if width == 1 else np.eye(width)[y.astype(int)]


def _loss(p: np.ndarray, t: np.ndarray) -> float:
    p = np.clip(p, _TINY, 1 - _TINY)
    if p.shape[1] == 1:
        return float(-(t * np.log(p) + (1 - t) * np.log(1 - p)).sum())
    return float(-(t * np.log(p)).sum())


def _gradient(x, t, flat, sizes, dropout: float, l1: float, l2: float, rng) -> tuple[np.ndarray, float]:
    layers = unpack(flat, sizes)
    seen, masks = [x], []
    for w, b in layers[:-1]:
        h = np.maximum(seen[-1] @ w + b, 0.0)
        mask = (rng.random(h.shape) >= dropout) / (1.0 - dropout) if dropout > 0 else None
        masks.append(mask)
        seen.append(h if mask is None else h * mask)
    w, b = layers[-1]
    p = _head(seen[-1] @ w + b)
    delta = (p - t) / len(x)
    parts: list[np.ndarray] = []
    for i in range(len(layers) - 1, -1, -1):
        w, _ = layers[i]
        gw = seen[i].T @ delta
        if i < len(layers) - 1:
            gw = gw + l1 * np.sign(w) + 2.0 * l2 * w
        parts = [gw.ravel(), delta.sum(axis=0), *parts]
        if i:
            delta = delta @ w.T
            if masks[i - 1] is not None:
                delta = delta * masks[i - 1]
            delta = delta * (seen[i] > 0)
    return np.concatenate(parts), _loss(p, t)


#: Rows that are shuffled together, and states that are added in one task.
SHUFFLED, FAN = 8_192, 16
_MOVED = "part bigint, n bigint, loss double, steps bigint, w array<double>"


def _matrix(col: pd.Series) -> np.ndarray:
    return np.stack(col.to_numpy()).astype(float)


def fit_network(
    train: DataFrame, features: Sequence[str], label: str, classes: int, params: dict, seed: int = 42, key: str | None = None
) -> tuple[Network, list[dict]]:
    """Early stopping watches a tenth of the training rows, picked by key hash."""
    spark = train.sparkSession
    ship(spark)
    hidden = [int(u) for u in params.get("hidden_layer_sizes", (64, 32))]
    width = 1 if classes == 2 else classes
    sizes = [len(features), *hidden, width]
    dropout = float(params.get("dropout_rate", 0.2))
    rate = float(params.get("learning_rate", 0.001))
    batch = int(params.get("batch_size", 32))
    epochs = int(params.get("epochs", 50))
    patience = int(params.get("early_stopping_patience", 5))
    l1, l2 = float(params.get("l1_reg", 0.0)), float(params.get("l2_reg", 0.0))

    x = F.array(*[F.col(c).cast("double") for c in features])
    h = order_hash(seed, key) if key else F.md5(F.to_json(F.struct(x.alias("x"), F.col(label))))
    data = train.select(x.alias("x"), F.col(label).cast("int").alias("y"), h.alias("h"))
    n = train.count()
    # The number of averaged workers follows the rows alone, so a cluster of another size fits the same network.
    parts = max(1, min(math.ceil(n / ROWS_PER_PART), max(MOST_PARTS, math.ceil(n / MOST_ROWS_PER_PART))))
    split = F.substring("h", 1, 4) < F.lit(f"{int(65536 * 0.1):04x}")
    fit_rows = hold(data.filter(~split).repartition(parts, "h").sortWithinPartitions("h"))
    watch = hold(data.filter(split))
    if watch.isEmpty() or fit_rows.isEmpty():
        fit_rows = hold(data.repartition(parts, "h").sortWithinPartitions("h"))
        watch = fit_rows

    size = len(start_weights(sizes, seed))
    state = np.concatenate([start_weights(sizes, seed), np.zeros(2 * size)])
    steps, best, best_loss, waited = 0, state[:size], math.inf, 0
    history: list[dict] = []
    for epoch in range(epochs):
        sent = spark.sparkContext.broadcast((state, steps))
        moved = fit_rows.select("x", "y").mapInPandas(_epoch(sent, sizes, rate, batch, dropout, l1, l2, seed, epoch), _MOVED)
        total = _added(moved, parts)
        state = total["w"] / total["n"]
        steps = total["steps"]
        sent.unpersist()
        val_loss, val_acc = _watch(watch, state[:size], sizes)
        history.append(
            {
                "epoch": epoch + 1, "loss": total["loss"] / total["n"], "val_loss": val_loss, "val_accuracy": val_acc,
                "val_auprc": _watch_auprc(watch, Network(sizes, state[:size])) if params.get("track_auprc") else None,
            }
        )
        if val_loss < best_loss:
            best, best_loss, waited = state[:size].copy(), val_loss, 0
        else:
            waited += 1
            if 0 < patience <= waited:
                break
    fit_rows.unpersist()
    watch.unpersist()
    return Network(sizes, best), history


def _epoch(sent, sizes, rate, batch, dropout, l1, l2, seed, epoch):
    def run(batches):
        state, t = sent.value
        size = len(state) // 3
        w, m, v = state[:size].copy(), state[size:2 * size].copy(), state[2 * size:].copy()
        part = TaskContext.get().partitionId()
        rng = np.random.default_rng([seed, epoch, part])
        n, loss = 0, 0.0
        for x, y in _blocks(batches):
            y = _targets(y, sizes[-1])
            order = rng.permutation(len(x))
            for start in range(0, len(x), batch):
                pick = order[start:start + batch]
                g, gone = _gradient(x[pick], y[pick], w, sizes, dropout, l1, l2, rng)
                t += 1
                m = 0.9 * m + 0.1 * g
                v = 0.999 * v + 0.001 * g * g
                w = w - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-7)
                n, loss = n + len(pick), loss + gone
        if n:
            yield pd.DataFrame({"part": [part], "n": [n], "loss": [loss], "steps": [t], "w": [np.concatenate([w, m, v]) * n]})

    return run


def _blocks(batches):
    """Rows in blocks of ``SHUFFLED`` by their place in hash order, however the session cuts Arrow batches."""
    held, size = [], 0
    for pdf in batches:
        while len(pdf):
            take = pdf.iloc[: SHUFFLED - size]
            held.append((_matrix(take["x"]), take["y"].to_numpy()))
            size, pdf = size + len(take), pdf.iloc[len(take):]
            if size == SHUFFLED:
                yield tuple(np.concatenate(c) for c in zip(*held, strict=True))
                held, size = [], 0
    if held:
        yield tuple(np.concatenate(c) for c in zip(*held, strict=True))


def _sum(rows: pd.DataFrame) -> dict:
    """Workers' weighted states added in the order of their partitions."""
    rows = rows.sort_values("part")
    return {"part": int(rows["part"].iloc[0]) // FAN, "n": int(rows["n"].sum()), "loss": float(rows["loss"].sum()), "steps": int(rows["steps"].max()), "w": np.add.reduce(np.stack(rows["w"].to_numpy()))}


def _added(moved: DataFrame, parts: int) -> dict:
    """The workers' states as arrays, added ``FAN`` at a time until ``FAN`` or fewer come to the driver; one job an epoch."""
    while parts > FAN:
        moved = moved.groupBy(F.floor(F.col("part") / FAN).alias("g")).applyInPandas(lambda rows: pd.DataFrame([_sum(rows)]), _MOVED)
        parts = -(-parts // FAN)
    return _sum(moved.toPandas())


def _watch(rows: DataFrame, weights: np.ndarray, sizes: Sequence[int]) -> tuple[float, float]:
    def run(batches):
        n, loss, right = 0, 0.0, 0
        for pdf in batches:
            if len(pdf):
                p = forward(_matrix(pdf["x"]), weights, sizes)
                y = pdf["y"].to_numpy()
                said = (p[:, 0] > 0.5).astype(int) if p.shape[1] == 1 else p.argmax(axis=1)
                n, loss, right = n + len(y), loss + _loss(p, _targets(y, sizes[-1])), right + int((said == y).sum())
        if n:
            yield pd.DataFrame({"n": [n], "loss": [loss], "right": [right]})

    s = rows.select("x", "y").mapInPandas(run, "n bigint, loss double, right bigint").agg(
        F.sum("n").alias("n"), F.sum("loss").alias("l"), F.sum("right").alias("r")
    ).first()
    return s["l"] / s["n"], s["r"] / s["n"]


def _watch_auprc(rows: DataFrame, network: Network) -> float | None:
    """Average precision on the watched rows, macro over classes."""
    scored = rows.select("y", _probabilities(rows, network, F.col("x")).alias("p"))
    cells = binary_cells(scored, "y", F.element_at("p", 2)) if network.classes == 2 else class_cells(scored, "y", "p")
    values = [r["auprc"] for r in rank_metrics(cells).collect()]
    return sum(values) / len(values) if values and None not in values else None


def predict(df: DataFrame, network: Network, features: Sequence[str]) -> Column:
    """Class probabilities of the feature columns."""
    return _probabilities(df, network, F.array(*[F.col(c).cast("double") for c in features]))


def _probabilities(df: DataFrame, network: Network, x: Column) -> Column:
    sent = df.sparkSession.sparkContext.broadcast(network.weights)
    sizes = network.sizes

    @F.pandas_udf("array<double>")
    def run(x: pd.Series) -> pd.Series:
        p = forward(_matrix(x), sent.value, sizes)
        if p.shape[1] == 1:
            p = np.hstack([1.0 - p, p])
        return pd.Series(list(p))

    return run(x)
