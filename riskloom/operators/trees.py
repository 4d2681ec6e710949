"""Decision forests grown to the end: histograms while a node is large, then each node whole in one task.

A forest is fitted on rows ``(h, m, x, y)``: a hash that identifies the row, its number of copies, features, and a number or class index.

1. Each tree draws a bag: a row counts Poisson(m) times, drawn from its hash, so a bag depends on the rows alone, not on where they lie.
2. *Top.* Nodes of more than ``LOCAL_ROWS`` rows are split level by level, from rows that are packed once. Tasks sum their rows into histograms of ``BINS``
   quantile cuts, for as many nodes at a time as ``HISTOGRAM_BYTES`` hold; Spark adds them per node, where the best cut is chosen. Only splits reach the driver. A large node that the cuts
   of the whole table cannot part gets cuts of its own.
3. *Subtrees.* The rows of a smaller node go, packed, to one task and are split at every value there until they are pure or the limits stop them:
   ``min_split`` and ``min_leaf`` count rows drawn, depth is unlimited unless given. Thresholds lie half way between neighbouring values.
4. Subtrees of at most ``MODEL_BYTES`` in all are broadcast to score; beyond, they stay in the shared folder, and rows go to them by node.

A node's features are drawn by its place in the tree; features that are constant in the node do not count. Ties go to the first feature and the smallest threshold.
"""

from __future__ import annotations

import json
import math
import pickle
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from riskloom.session import hold, scratch_path, ship

LOCAL_ROWS, BINS, HISTOGRAM_BYTES = 200_000, 255, 64 << 20
MODEL_BYTES = 96 << 20
#: Drawn rows of one task, as far as nodes can be dealt that evenly.
TASK_ROWS, MOST_TASKS = 1 << 15, 20_000
_PACK_ROWS, _PACK_BYTES = 1 << 15, 16 << 20
#: Rows of a task that packs rows or sums histograms; fewer tasks sum them where the histograms of all tasks would be more bytes.
PACKED_ROWS, SHUFFLED_BYTES = 1 << 16, 2 << 30
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _uniform(x: np.ndarray) -> np.ndarray:
    return (_mixed(x) >> np.uint64(11)).astype(np.float64) / float(1 << 53)


_STEPS = np.cumsum([math.exp(-1.0) / math.factorial(k) for k in range(18)])


def bag(h: np.ndarray, m: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """How often a tree draws each row: Poisson(m). Many copies are drawn by the normal limit."""
    key = h.view(np.uint64) * _GOLD + np.uint64((seed * 1_000_003 + tree) & 0xFFFFFFFF)
    u = _uniform(key)
    out = np.searchsorted(_STEPS, u, "right").astype(np.float64)
    some = np.flatnonzero((m > 1) & (m <= 64))
    for n in np.unique(m[some]):
        at = some[m[some] == n]
        steps = np.cumsum([math.exp(k * math.log(n) - n - math.lgamma(k + 1)) for k in range(int(n + 12 * math.sqrt(n) + 12))])
        out[at] = np.searchsorted(steps, u[at], "right")
    many = np.flatnonzero(m > 64)
    if len(many):
        z = np.sqrt(-2 * np.log1p(-u[many])) * np.cos(2 * np.pi * _uniform(key[many] + _GOLD))
        out[many] = np.maximum(np.rint(m[many] + np.sqrt(m[many]) * z), 0)
    return out


def tried_of(max_features: str | int | float | None, width: int) -> int | None:
    """Features per node: ``sqrt``, ``log2``, a number, a share, or all of them."""
    if max_features in (None, "", "all", "auto") or width < 1:
        return None
    if max_features in ("sqrt", "log2"):
        return max(1, int(math.sqrt(width) if max_features == "sqrt" else math.log2(width)))
    if isinstance(max_features, float):
        return max(1, int(max_features * width))
    return int(max_features)


@dataclass
class Rules:
    """``classes`` 0 for numbers; ``tried``: features per node, None for all.

    ``newton``: trees of one boosting round. Each has a residual of its own in ``y``, draws the same share of the rows, and its leaves
    hold ``newton`` times the sum of the residuals over the sum of their curvature.
    """

    classes: int = 0
    max_depth: int | None = None
    min_split: int = 2
    min_leaf: int = 1
    tried: int | None = None
    bootstrap: bool = True
    seed: int = 42
    newton: float | None = None
    share: float = 1.0

    @property
    def width(self) -> int:
        return max(1, self.classes)

    def of(self, y: np.ndarray, tree: int) -> np.ndarray:
        """What a tree learns, of one or more columns."""
        return y[:, tree if self.newton is not None else 0]

    def targets(self, y: np.ndarray) -> np.ndarray:
        return (y[:, None] == np.arange(self.classes)).astype(np.float64) if self.classes else y[:, None]

    def leaf(self, stats: np.ndarray) -> np.ndarray:
        """Value of a leaf of (weight, rows, sums, curvature): the mean, or a Newton step."""
        if self.newton is None:
            return np.asarray(stats[2:]) / stats[0]
        return np.array([self.newton * stats[2] / stats[3] if abs(stats[3]) > 1e-150 else 0.0])

    def draws(self, h: np.ndarray, m: np.ndarray, tree: int) -> np.ndarray:
        if self.newton is not None:
            return np.where(_uniform(h.view(np.uint64) * _GOLD + np.uint64(self.seed & 0xFFFFFFFF)) < self.share, m, 0.0)
        return bag(h, m, tree, self.seed) if self.bootstrap else m.astype(np.float64)


@dataclass
class Tree:
    """Nodes as arrays: ``feature`` -1 is a leaf; the right child follows the left."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    value: np.ndarray

    def find(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each row."""
        out, flat, width = np.zeros(len(x), dtype=np.int64), np.ascontiguousarray(x).ravel(), x.shape[1]
        rows, node = np.arange(len(x)), out.copy()
        while len(rows):
            feature = self.feature.take(node)
            inner = feature >= 0
            if not inner.all():
                out[rows[~inner]] = node[~inner]
                rows, node, feature = rows[inner], node[inner], feature[inner]
            node = self.left.take(node) + (flat.take(rows * width + feature) > self.threshold.take(node))
        return out


def _tried(seeds: np.ndarray, varied: np.ndarray, tried: int | None) -> np.ndarray:
    """Which features a node looks at: the first ``tried`` of those that vary in it, in an order drawn by the node."""
    if tried is None or tried >= varied.shape[1]:
        return varied
    draw = _mixed(seeds[:, None] + np.arange(1, varied.shape[1] + 1, dtype=np.uint64) * _GOLD)
    order = np.argsort(np.where(varied, draw >> np.uint64(1), np.uint64(2**64 - 1)), axis=1, kind="stable")
    rank = np.empty_like(order)
    np.put_along_axis(rank, order, np.arange(varied.shape[1])[None, :].repeat(len(order), axis=0), axis=1)
    return varied & (rank < tried)


def _better(gain: np.ndarray, best: np.ndarray) -> np.ndarray:
    """Larger by more than rounding."""
    known = np.where(np.isfinite(best), best, 0.0)
    return np.isfinite(gain) & (~np.isfinite(best) | (gain > known + 1e-10 * np.abs(known)))


def _halved(o: np.ndarray, v: np.ndarray, size: np.ndarray, side: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of consecutive nodes dealt to their children (``side`` 0 left, 1 right, 2 none) in their order; sizes of left and right children in turn."""
    begin = np.cumsum(size) - size
    parts = [np.flatnonzero(side == k) for k in (0, 1)]
    count = np.stack([np.diff(np.searchsorted(p, np.append(begin, len(o)))) for p in parts], axis=1).ravel()
    start = np.cumsum(count) - count
    turn = np.empty(len(parts[0]) + len(parts[1]), dtype=np.int64)
    for k, p in enumerate(parts):
        mine = count[k::2]
        turn[np.arange(len(p)) + np.repeat(start[k::2] - (np.cumsum(mine) - mine), mine)] = p
    return o.take(turn), v.take(turn), count


def grow(x: np.ndarray, y: np.ndarray, w: np.ndarray, c: np.ndarray, rules: Rules, seed: int = 0, depth: int = 0) -> tuple[Tree, np.ndarray]:
    """A tree on rows with whole weights ``w`` and row counts ``c``, all nodes of a level at once, and the impurity that each feature takes away.

    Rows are kept sorted by (node, value) for every feature that still varies in their node, with their values beside them, so a level costs
    one pass over the rows of the nodes that it may split, in their order.
    """
    targets, n_features = rules.targets(y), x.shape[1]
    importance = np.zeros(n_features)
    feature, threshold, left, value = [np.array([-1], dtype=np.int16)], [np.zeros(1)], [np.zeros(1, dtype=np.int32)], [np.average(targets, axis=0, weights=w)[None, :]]
    plain, flat, learnt = bool((c == 1).all()), np.ascontiguousarray(x).ravel(), np.ascontiguousarray(targets.T)
    weighed = learnt * w
    # Two classes mirror each other: one of them tells the gain of both.
    told = [1] if rules.classes == 2 else range(len(learnt))
    residual, side = np.empty((len(learnt), 0 if rules.classes else len(x))), np.empty(len(x), dtype=np.uint8)

    def stats_of(rows: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, ...]:
        """Weights, sums and means of nodes, and which of them may be split."""
        first = np.cumsum(size) - size
        weight = np.add.reduceat(w.take(rows), first)
        drawn = size if plain else np.add.reduceat(c.take(rows), first)
        sums = np.stack([np.add.reduceat(t.take(rows), first) for t in weighed], axis=1)
        mine = y.take(rows)
        can = (drawn >= max(rules.min_split, 2 * rules.min_leaf)) & (np.minimum.reduceat(mine, first) < np.maximum.reduceat(mine, first))
        return weight, drawn, sums, sums / weight[:, None], can

    # Of the nodes that may be split: rows by node, sizes, sums, places in the arrays above, seeds. Of each feature: rows, values, nodes, sizes.
    rows, size = np.arange(len(x)), np.array([len(x)])
    weight, drawn, sums, mean, can = stats_of(rows, size)
    rows, order = rows[: len(rows) * can[0]], []
    for v in x.T:
        o = np.argsort(v, kind="stable")[: len(rows)]
        order.append((o, v.take(o), np.zeros(1, dtype=np.int64), size))
    place, seeds, total = np.zeros(1, dtype=np.int64), np.array([seed], dtype=np.uint64), 1
    while len(rows) and (rules.max_depth is None or depth < rules.max_depth):
        n = len(size)
        if not rules.classes:
            for k, t in enumerate(learnt):
                residual[k][rows] = w.take(rows) * (t.take(rows) - np.repeat(mean[:, k], size))
        varied = np.zeros((n, n_features), dtype=bool)
        for j, (o, v, nodes, many) in enumerate(order):
            if not len(o):
                continue
            end = np.cumsum(many)
            stays = v[end - many] < v[end - 1]
            varied[nodes, j] = stays
            # What does not vary in a node does not vary below it either.
            if not stays.all():
                kept = np.repeat(stays, many)
                order[j] = o[kept], v[kept], nodes[stays], many[stays]
        looked = _tried(seeds, varied, rules.tried)
        best, by, cut = np.full(n, -np.inf), np.full(n, -1), np.zeros(n)
        for j, (o, v, nodes, many) in enumerate(order):
            seen = looked[nodes, j]
            if not seen.any():
                continue
            if not seen.all():
                kept = np.repeat(seen, many)
                o, v, nodes, many = o[kept], v[kept], nodes[seen], many[seen]
            end = np.cumsum(many)
            begin = end - many
            ok = np.empty(len(o), dtype=bool)
            np.less(v[:-1], v[1:], out=ok[:-1])
            ok[end - 1] = False
            if rules.min_leaf > 1:
                below = np.cumsum(c.take(o))
                below -= np.repeat(below[begin] - c.take(o[begin]), many)
                ok &= (below >= rules.min_leaf) & (np.repeat(drawn[nodes], many) - below >= rules.min_leaf)
            at = np.flatnonzero(ok)
            if not len(at):
                continue
            # Where few places part values, only those are computed.
            some = None if 2 * len(at) > len(o) else at
            each = many if some is None else np.diff(np.searchsorted(at, np.append(begin, len(o))))

            def upto(a: np.ndarray) -> np.ndarray:
                """Sums of a node's rows up to and with each place."""
                a = np.cumsum(a)
                before = a.take(begin - 1)
                before[0] = 0.0
                if some is not None:
                    a = a.take(some)
                a -= np.repeat(before, each)
                return a

            wl, whole = upto(w.take(o)), np.repeat(weight[nodes], each)
            gain = np.zeros(len(wl))
            for k in told:
                if rules.classes:
                    d = upto(weighed[k].take(o))
                    d -= wl * np.repeat(mean[nodes, k], each)
                else:
                    d = upto(residual[k].take(o))
                d *= d
                gain += d
            gain *= 2 * whole if rules.classes == 2 else whole
            whole -= wl
            wl *= whole
            with np.errstate(divide="ignore", invalid="ignore"):
                gain /= wl
            if some is None:
                gain[~ok] = -np.inf
                start = begin
            else:
                here = np.flatnonzero(each)
                nodes, each = nodes[here], each[here]
                start = np.cumsum(each) - each
            top = np.full(n, -np.inf)
            top[nodes] = np.maximum.reduceat(gain, start)
            take = _better(top, best)
            if take.any():
                least = np.where(take, top - 1e-10 * np.abs(top), np.inf)
                near = np.flatnonzero(gain >= np.repeat(least[nodes], each))
                taken = take[nodes]
                here = near[np.searchsorted(near, start[taken])]
                if some is not None:
                    here = some[here]
                a, b = v[here], v[here + 1]
                mid = a + (b - a) / 2
                best[take], by[take], cut[take] = top[take], j, np.where(mid < b, mid, a)
        done = by >= 0
        if not done.any():
            break
        np.add.at(importance, by[done], best[done])
        kids = total + 2 * np.arange(done.sum())
        total += 2 * len(kids)
        # Levels are appended one by one; the parents' entries are in the level before.
        f, t, low = feature[-1], threshold[-1], left[-1]
        start = total - 2 * len(kids) - len(f)
        at = place[done] - start
        f[at], t[at], low[at] = by[done], cut[done], kids
        side[rows] = 2
        if not done.all():
            rows, size = rows[np.repeat(done, size)], size[done]
        right = flat.take(rows * n_features + np.repeat(by[done], size)) > np.repeat(cut[done], size)
        rows, _, size = _halved(rows, rows, size, right)
        weight, drawn, sums, mean, can = stats_of(rows, size)
        value.append(mean)
        feature.append(np.full(len(size), -1, dtype=np.int16))
        threshold.append(np.zeros(len(size)))
        left.append(np.zeros(len(size), dtype=np.int32))
        place = start + len(f) + np.flatnonzero(can)
        seeds = _mixed(np.repeat(seeds[done], 2) * np.uint64(2) + np.tile(np.array([1, 2], dtype=np.uint64), len(kids)))[can]
        side[rows] = np.repeat(np.where(can, np.tile(np.array([0, 1], dtype=np.uint8), len(kids)), 2).astype(np.uint8), size)
        child, number = np.full(n, -1), np.cumsum(can) - 1
        child[done] = np.arange(len(kids))
        for j, (o, v, nodes, many) in enumerate(order):
            if len(o):
                o, v, many = _halved(o, v, many, side.take(o))
                nodes = (2 * np.repeat(child[nodes], 2) + np.tile([0, 1], len(nodes)))[many > 0]
                order[j] = o, v, number[nodes], many[many > 0]
        rows, size = rows[np.repeat(can, size)], size[can]
        weight, drawn, mean = weight[can], drawn[can], mean[can]
        depth += 1
    return Tree(*[np.concatenate(x) for x in (feature, threshold, left, value)]), importance


def _bytes(a: np.ndarray) -> bytes:
    return np.ascontiguousarray(a, dtype=np.float64).tobytes()


def _table(column: pa.Array) -> np.ndarray:
    """One column, or those of a list column."""
    return _matrix(column, -(-len(column.flatten()) // len(column))) if pa.types.is_list(column.type) else column.to_numpy()[:, None]


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


@dataclass
class Top:
    """The upper part of one tree; ``open`` nodes are split further, ``local`` ones are grown in a task, the rest are leaves."""

    tree: Tree
    depth: list[int]
    seeds: list[int]
    open: list[int] = field(default_factory=list)
    local: list[int] = field(default_factory=list)
    #: Rows drawn, of nodes that were large or are local.
    drawn: dict[int, float] = field(default_factory=dict)

    @staticmethod
    def root(width: int, seed: int, large: bool) -> Top:
        tree = Tree(np.array([-1], dtype=np.int16), np.zeros(1), np.zeros(1, dtype=np.int32), np.zeros((1, width)))
        return Top(tree, [0], [seed], [0] if large else [], [] if large else [0])

    def split(self, node: int, feature: int, threshold: float, values: np.ndarray) -> tuple[int, int]:
        t, n = self.tree, len(self.tree.feature)
        t.feature[node], t.threshold[node], t.left[node] = feature, threshold, n
        t.feature, t.threshold = np.append(t.feature, np.array([-1, -1], dtype=np.int16)), np.append(t.threshold, [0.0, 0.0])
        t.left, t.value = np.append(t.left, np.zeros(2, dtype=np.int32)), np.concatenate([t.value, values])
        self.depth += [self.depth[node] + 1] * 2
        seed = np.array([self.seeds[node]], dtype=np.uint64)
        self.seeds += [int(_mixed(seed * np.uint64(2) + np.uint64(k))[0]) for k in (1, 2)]
        return n, n + 1


def _chunks(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(h, m, x, y) in pieces of many rows, of plain or packed rows."""
    held, size, most = [], 0, max(1, min(_PACK_ROWS, _PACK_BYTES // (8 * max(width, 1))))
    for batch in batches:
        if not batch.num_rows:
            continue
        if is_packed(batch.schema):
            for pack in zip(*[batch.column(c) for c in "hmxy"], strict=True):
                yield unpacked(*[p.as_buffer() for p in pack], width)
            continue
        held.append((batch.column("h").to_numpy(), batch.column("m").to_numpy(), _matrix(batch.column("x"), width), _table(batch.column("y"))))
        size += batch.num_rows
        if size >= most:
            yield tuple(np.concatenate(c) for c in zip(*held, strict=True))
            held, size = [], 0
    if held:
        yield tuple(np.concatenate(c) for c in zip(*held, strict=True))


def is_packed(schema: pa.Schema) -> bool:
    return pa.types.is_binary(schema.field("h").type) or pa.types.is_large_binary(schema.field("h").type)


def unpacked(h, m, x, y, width: int) -> tuple[np.ndarray, ...]:
    h, m = np.frombuffer(h, dtype=np.int64), np.frombuffer(m)
    return h, m, np.frombuffer(x).reshape(-1, width), np.frombuffer(y).reshape(len(h), -1)


def packed(rows: DataFrame, width: int, count: int) -> DataFrame:
    """Rows ``(h, m, x, y)`` as blocks of bytes, so that a pass over them is not a pass over cells."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for h, m, x, y in _chunks(batches, width):
            yield pa.RecordBatch.from_pydict({"h": [h.tobytes()], "m": [_bytes(m)], "x": [_bytes(x)], "y": [_bytes(y)]})

    return rows.coalesce(max(1, -(-count // PACKED_ROWS))).mapInArrow(run, "h binary, m binary, x binary, y binary")


def cuts_of(rows: DataFrame, width: int) -> list[np.ndarray]:
    """Quantile cuts of every feature: a row is in bin k if k cuts lie below its value."""
    asked = [k / (BINS + 1) for k in range(1, BINS + 1)]
    # Summaries of few large tasks: one task merges them all.
    row = rows.coalesce(32).agg(*[F.percentile_approx(F.col("x")[j], asked, 4000).alias(f"q{j}") for j in range(width)]).first()
    return [np.unique(np.array(row[f"q{j}"] or [], dtype=np.float64)) for j in range(width)]


def _histograms(rows: DataFrame, tops: list[Top], pairs: list[tuple[int, int]], cuts: list[np.ndarray], rules: Rules, width: int, count: int) -> list[dict]:
    """The best cut of every (tree, node): weights, sums and rows by bin, added by Spark per node."""
    spark, stats, bins = rows.sparkSession, rules.width + 2 + (rules.newton is not None), max(len(c) for c in cuts) + 1
    trees = sorted({t for t, _ in pairs})
    sent = spark.sparkContext.broadcast(({t: tops[t].tree for t in trees}, pairs, cuts))
    seeds = [tops[t].seeds[n] for t, n in pairs]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, pairs, cuts = sent.value
        total = np.zeros((len(pairs), width, bins, stats))
        number = {t: np.array([[n, k] for k, (s, n) in enumerate(pairs) if s == t]) for t in held}
        for h, m, x, y in _chunks(batches, width):
            places = [np.searchsorted(c, x[:, j], "left") for j, c in enumerate(cuts)]
            for t, tree in held.items():
                targets = rules.targets(rules.of(y, t))
                w = rules.draws(h, m, t)
                lookup = np.full(len(tree.feature), -1)
                lookup[number[t][:, 0]] = number[t][:, 1]
                pair = np.where(w > 0, lookup[tree.find(x)], -1)
                own = np.flatnonzero(pair >= 0)
                if not len(own):
                    continue
                # The pairs of a tree follow one another.
                w, low, some = w[own], number[t][0, 1], len(number[t])
                cells = (pair[own] - low) * bins
                learnt = targets[own]
                parts = [w, np.minimum(w, m[own]), *[w * learnt[:, k] for k in range(learnt.shape[1])]]
                if rules.newton is not None:
                    parts.append(w * _curvature(learnt[:, 0]))
                for j in range(width):
                    cell = cells + places[j][own]
                    for s, part in enumerate(parts):
                        total[low : low + some, j, :, s] += np.bincount(cell, part, some * bins).reshape(some, bins)
        full = np.flatnonzero(total[:, 0, :, 0].sum(axis=1))
        if len(full):
            yield pa.RecordBatch.from_pydict({"pair": pa.array(full, pa.int32()), "data": [_bytes(total[k]) for k in full]})

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cuts, now, total = sent.value[2], None, None
        for batch in batches:
            for k, data in zip(batch.column("pair").to_pylist(), batch.column("data").to_pylist(), strict=True):
                if k != now and total is not None:
                    yield best(now, total, cuts)
                    total = None
                now = k
                total = np.frombuffer(data).reshape(width, bins, stats) + (0 if total is None else total)
        if total is not None:
            yield best(now, total, cuts)

    def best(k: int, total: np.ndarray, cuts: list[np.ndarray]) -> pa.RecordBatch:
        whole = total[0].sum(axis=0)
        below = np.cumsum(total, axis=1)
        wl, cl = below[:, :-1, 0], below[:, :-1, 1]
        wr, cr = whole[0] - wl, whole[1] - cl
        sums = slice(2, 2 + rules.width)
        d = below[:, :-1, sums] - wl[:, :, None] * (whole[sums] / whole[0])
        ok = (wl > 0) & (wr > 0) & (cl >= rules.min_leaf) & (cr >= rules.min_leaf)
        for j, c in enumerate(cuts):
            ok[j, len(c) :] = False
        looked = _tried(np.array([seeds[k]], dtype=np.uint64), ((total[:, :, 0] > 0).sum(axis=1) > 1)[None, :], rules.tried)[0]
        gain = np.where(ok & looked[:, None], (d**2).sum(axis=2) * whole[0] / np.where(ok, wl * wr, 1.0), -np.inf)
        j, at = divmod(int(gain.argmax()), gain.shape[1])
        found = bool(np.isfinite(gain[j, at]))
        lo = below[j, at] if found else whole
        return pa.RecordBatch.from_pydict({
            "pair": pa.array([k], pa.int32()), "feature": pa.array([j if found else -1], pa.int32()), "threshold": [float(cuts[j][at]) if found else 0.0],
            "gain": [float(gain[j, at]) if found else 0.0], "whole": [whole.tolist()], "low": [lo.tolist()]})

    tasks = max(1, min(-(-count // PACKED_ROWS), max(32, SHUFFLED_BYTES // (len(pairs) * width * bins * stats * 8))))
    sums = rows.coalesce(tasks).mapInArrow(add, "pair int, data binary").repartition(min(len(pairs), tasks), "pair").sortWithinPartitions("pair")
    return sums.mapInArrow(choose, "pair int, feature int, threshold double, gain double, whole array<double>, low array<double>").toArrow().to_pylist()


def _curvature(residual: np.ndarray) -> np.ndarray:
    return np.abs(residual) * (1 - np.abs(residual))


def _pure(stats: Sequence[float], rules: Rules) -> bool:
    """Classes: one of them has all the weight. Numbers cannot be told from sums and are never called pure."""
    return bool(rules.classes) and max(stats[2:]) >= stats[0]


def _grow_tops(rows: DataFrame, tops: list[Top], rules: Rules, width: int, local_rows: int, count: int, cuts: list[np.ndarray]) -> np.ndarray:
    """Split the large nodes of all trees, level by level; returns the impurity each feature took away by tree."""
    importance = np.zeros((len(tops), width))
    most = max(1, HISTOGRAM_BYTES // (width * (BINS + 1) * (rules.width + 3) * 8))
    own: list[tuple[int, int]] = []

    def settled(t: int, node: int, stats: Sequence[float]) -> None:
        top = tops[t]
        top.tree.value[node] = rules.leaf(stats)
        deep = rules.max_depth is not None and top.depth[node] >= rules.max_depth
        if deep or _pure(stats, rules) or stats[1] < max(rules.min_split, 2 * rules.min_leaf):
            return
        (top.open if stats[1] > local_rows else top.local).append(node)
        top.drawn[node] = stats[1]

    def taken(found: list[dict], pairs: list[tuple[int, int]], retry: bool) -> None:
        for r in found:
            t, node = pairs[r["pair"]]
            whole, low = np.array(r["whole"]), np.array(r["low"])
            tops[t].tree.value[node] = rules.leaf(whole)
            if r["feature"] < 0:
                if retry and not _pure(whole, rules):
                    own.append((t, node))
                continue
            importance[t, r["feature"]] += r["gain"]
            for child, stats in zip(tops[t].split(node, r["feature"], r["threshold"], np.zeros((2, rules.width))), (low, whole - low), strict=True):
                settled(t, child, stats)

    while any(top.open for top in tops) or own:
        waiting = [(t, n) for t, top in enumerate(tops) for n in top.open]
        for top in tops:
            top.open = []
        for a in range(0, len(waiting), most):
            pairs = waiting[a : a + most]
            taken(_histograms(rows, tops, pairs, cuts, rules, width, count), pairs, True)
        for t, node in own:
            taken(_histograms(rows, tops, [(t, node)], cuts_of(_inside(rows, tops[t], t, node, rules, width), width), rules, width, count), [(t, node)], False)
        own.clear()
    return importance


def _inside(rows: DataFrame, top: Top, t: int, node: int, rules: Rules, width: int) -> DataFrame:
    """Features of the rows that a tree drew in a node."""
    tree = top.tree

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for h, m, x, _ in _chunks(batches, width):
            yield pa.RecordBatch.from_pydict({"x": lists(x[(rules.draws(h, m, t) > 0) & (tree.find(x) == node)])})

    return rows.mapInArrow(keep, "x array<double>")


def lists(a: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(np.arange(len(a) + 1, dtype=np.int32) * a.shape[1], pa.array(a.ravel()))


@dataclass
class Forest:
    """``parts``: (tree, node of the top, subtree) in the driver while they are few bytes, else ``table`` in the shared folder."""

    rules: Rules
    tops: list[Top]
    importance: np.ndarray
    width: int
    table: DataFrame | None = None
    parts: list[tuple[int, int, bytes]] | None = None
    gains: np.ndarray | None = None
    _sent: tuple | None = field(default=None, repr=False)

    def trees(self) -> list[Tree | None]:
        """Whole trees of a forest that the driver holds; None where a tree drew no row."""
        return [_joined(top, {n: pickle.loads(d) for t, n, d in self.parts if t == k}) for k, top in enumerate(self.tops)]

    def sent(self, spark: SparkSession):
        """The broadcast trees, once per session."""
        app = spark.sparkContext.applicationId
        if self._sent is None or self._sent[0] != app:
            self._sent = (app, spark.sparkContext.broadcast([t for t in self.trees() if t is not None]))
        return self._sent[1]

    def save(self, spark: SparkSession, path: str) -> None:
        ship(spark)
        rows = self.table if self.parts is None else spark.createDataFrame([(t, n, bytearray(d)) for t, n, d in self.parts], "tree int, node int, data binary")
        rows.write.mode("overwrite").parquet(f"{path}/subtrees")
        head = {"rules": self.rules.__dict__, "importance": self.importance.tolist(), "width": self.width, "local": self.parts is not None, "tops": [
            {"depth": t.depth, "seeds": [str(s) for s in t.seeds], "local": t.local, **{k: v.tolist() for k, v in t.tree.__dict__.items()}} for t in self.tops]}
        spark.createDataFrame([(json.dumps(head),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/head")

    @staticmethod
    def load(spark: SparkSession, path: str) -> Forest:
        head, table = json.loads(spark.read.text(f"{path}/head").first()["value"]), spark.read.parquet(f"{path}/subtrees")
        kinds = {"feature": np.int16, "threshold": np.float64, "left": np.int32, "value": np.float64}
        tops = [Top(Tree(**{k: np.array(t[k], dtype=d) for k, d in kinds.items()}), t["depth"], [int(s) for s in t["seeds"]], [], t["local"]) for t in head["tops"]]
        parts = [(r["tree"], r["node"], bytes(r["data"])) for r in table.collect()] if head["local"] else None
        return Forest(Rules(**head["rules"]), tops, np.array(head["importance"]), head["width"], None if head["local"] else table, parts)


def _joined(top: Top, subtrees: dict[int, Tree]) -> Tree | None:
    """One tree of a top and its subtrees; None where the tree drew no row."""
    if top.local == [0]:
        return subtrees.get(0)
    f, t, left, value = (a.copy() for a in (top.tree.feature, top.tree.threshold, top.tree.left, top.tree.value))
    parts = [(f, t, left, value)]
    size = len(f)
    for node, sub in sorted(subtrees.items()):
        # The subtree's root takes the place of the node; its other nodes follow.
        f[node], t[node], value[node] = sub.feature[0], sub.threshold[0], sub.value[0]
        left[node] = sub.left[0] + size - 1
        parts.append((sub.feature[1:], sub.threshold[1:], sub.left[1:] + (size - 1), sub.value[1:]))
        size += len(sub.feature) - 1
    return Tree(*[np.concatenate(x) for x in zip(*parts, strict=True)])


def fit_forest(rows: DataFrame, width: int, rules: Rules, trees: int, local_rows: int = LOCAL_ROWS, model_bytes: int = MODEL_BYTES, count: int | None = None,
               cuts: list[np.ndarray] | None = None) -> Forest:
    """A forest on rows ``h long, m long, x array<double>, y double``, which the caller keeps.

    Rows that the caller packed (``y`` one or more numbers, one for each boosted tree) come with their number and, if they are many, their cuts.
    """
    spark = rows.sparkSession
    ship(spark)
    kept = None
    if dict(rows.dtypes)["h"] != "binary":
        rows = rows.select("h", F.col("m").cast("double").alias("m"), "x", "y")
        count = rows.count() if count is None else count
        if count > local_rows:
            cuts = cuts_of(rows, width)
            rows = kept = hold(packed(rows, width, count))
    roots = _mixed(np.arange(trees, dtype=np.uint64) * _GOLD + np.uint64(rules.seed & 0xFFFFFFFF))
    tops = [Top.root(rules.width, int(s), count > local_rows) for s in roots]
    if count <= local_rows:
        for top in tops:
            top.drawn[0] = count
    importance = _grow_tops(rows, tops, rules, width, local_rows, count, cuts) if count > local_rows else np.zeros((trees, width))
    grown = _subtrees(rows, tops, rules, width)
    # At most two nodes a row, and what the depth allows.
    nodes = min(2 * count, 1 << (min(rules.max_depth, 60) + 1)) if rules.max_depth is not None else 2 * count
    small = nodes * trees * (14 + 8 * rules.width) <= model_bytes
    forest = Forest(rules, tops, importance, width)
    if small:
        found = [r.asDict() for r in grown.collect()] if any(t.local for t in tops) else []
        forest.parts = sorted((r["tree"], r["node"], bytes(r["data"])) for r in found)
        gains = sorted((r["tree"], r["node"], r["gains"]) for r in found)
    else:
        path = scratch_path(spark, "subtrees")
        grown.write.parquet(path)
        table = spark.read.parquet(path)
        forest.table = table.select("tree", "node", "data")
        summed = table.groupBy("tree").agg(*[F.sum(F.col("gains")[j]).alias(f"g{j}") for j in range(width)]).toArrow().to_pylist()
        gains = [(r["tree"], 0, [r[f"g{j}"] for j in range(width)]) for r in summed]
    if kept is not None:
        kept.unpersist()
    for t, _, g in gains:
        importance[t] += g
    forest.gains = importance.sum(axis=0)
    total = importance.sum(axis=1, keepdims=True)
    used = np.divide(importance, total, out=np.zeros_like(importance), where=total > 0)
    mean = used[total[:, 0] > 0].mean(axis=0) if (total > 0).any() else np.zeros(width)
    forest.importance = mean / mean.sum() if mean.sum() > 0 else mean
    return forest


def dealt(tops: list[Top]) -> tuple[list[dict[int, int]], int]:
    """The task of each local node, by tree, and the number of tasks: a large node has one of its own, small ones share one of at most ``TASK_ROWS`` drawn rows."""
    most = max(TASK_ROWS, sum(t.drawn[n] for t in tops for n in t.local) / MOST_TASKS)
    tasks, task, held = [], 0, 0.0
    for top in tops:
        tasks.append({})
        for node in top.local:
            if held and held + top.drawn[node] > most:
                task, held = task + 1, 0.0
            tasks[-1][node] = task
            held += top.drawn[node]
    return tasks, task + 1


def _subtrees(rows: DataFrame, tops: list[Top], rules: Rules, width: int) -> DataFrame:
    """(tree, node, data, gains): the rows of every node that fits a task, sent there and grown."""
    spark = rows.sparkSession
    plain = all(t.local == [0] for t in tops)
    owner, tasks = dealt(tops)
    sent = spark.sparkContext.broadcast([
        (None if plain else t.tree, t.local, [t.depth[n] for n in t.local], [t.seeds[n] for n in t.local], own) for t, own in zip(tops, owner, strict=True)])
    names = ["h", "x", "y", "w", "c"]

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for h, m, x, y in _chunks(batches, width):
            for t, (tree, local, _, _, own) in enumerate(sent.value):
                w = rules.draws(h, m, t)
                node = np.zeros(len(x), dtype=np.int64) if tree is None else tree.find(x)
                drawn = np.flatnonzero((w > 0) & np.isin(node, local))
                if not len(drawn):
                    continue
                drawn = drawn[np.argsort(node[drawn], kind="stable")]
                cut = np.flatnonzero(np.diff(node[drawn], prepend=-1))
                found = node[drawn][cut]
                out = {"tree": pa.array([t] * len(cut), pa.int32()), "node": pa.array(found, pa.int32()), "task": pa.array([own[int(k)] for k in found], pa.int32())}
                for name, a in zip(names, (h.view(np.float64), x, rules.of(y, t), w, np.minimum(w, m)), strict=True):
                    out[name] = [_bytes(p) for p in np.split(a[drawn], cut[1:])]
                yield pa.RecordBatch.from_pydict(out)

    def finish(key: tuple[int, int], packs: list[tuple]) -> pa.RecordBatch:
        t, node = key
        h, x, y, w, c = (np.frombuffer(b"".join(p)) for p in zip(*packs, strict=True))
        x = x.reshape(-1, width)
        # In an order of their own, whatever order they came in.
        turn = np.lexsort([*x.T[::-1], y, h.view(np.int64)])
        _, local, depth, seeds, _ = sent.value[t]
        at = local.index(node)
        x, y, w = x[turn], y[turn], w[turn]
        tree, gains = grow(x, y, w, c[turn], rules, seeds[at], depth[at])
        if rules.newton is not None:
            leaf, size = tree.find(x), len(tree.feature)
            sums = np.stack([np.bincount(leaf, v, size) for v in (w, w, w * y, w * _curvature(y))], axis=1)
            for k in np.flatnonzero(tree.feature < 0):
                tree.value[k] = rules.leaf(sums[k])
        return pa.RecordBatch.from_pydict({"tree": pa.array([t], pa.int32()), "node": pa.array([node], pa.int32()), "data": [pickle.dumps(tree)], "gains": [gains.tolist()]})

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, packs = None, []
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("tree", "node", *names)]
            for t, node, *pack in zip(*columns, strict=True):
                if (t, node) != now and packs:
                    yield finish(now, packs)
                    packs = []
                now = (t, node)
                packs.append(pack)
        if packs:
            yield finish(now, packs)

    packed = rows.mapInArrow(send, "tree int, node int, task int, " + ", ".join(f"{c} binary" for c in names))
    return packed.repartitionById(tasks, "task").sortWithinPartitions("tree", "node").mapInArrow(
        made, "tree int, node int, data binary, gains array<double>")


def _mean(trees: list[Tree], x: np.ndarray, width: int) -> np.ndarray:
    total = np.zeros((len(x), width))
    for tree in trees:
        total += tree.value[tree.find(x)]
    return total / max(len(trees), 1)


def predict(df: DataFrame, forest: Forest, features: Sequence[str], out: str, where: Column | None = None) -> DataFrame:
    """Adds the mean of the trees: a number, or an array of class shares. Rows outside ``where`` get NULL and visit no tree."""
    spark = df.sparkSession
    ship(spark)
    wanted = F.lit(True) if where is None else where
    if forest.parts is None:
        return _routed(df, forest, features, out, wanted)
    sent, width, classes = forest.sent(spark), forest.rules.width, forest.rules.classes

    def run(asked: pd.Series, *columns: pd.Series) -> pd.Series:
        at = np.flatnonzero(asked.to_numpy())
        found = np.full(len(asked), None, dtype=object)
        if len(at):
            x = np.column_stack([c.to_numpy(dtype=np.float64)[at] for c in columns])
            mean = _mean(sent.value, x, width)
            found[at] = list(mean) if classes else mean[:, 0]
        return pd.Series(found)

    kind = T.ArrayType(T.DoubleType()) if classes else T.DoubleType()
    udf = F.pandas_udf(run, kind)
    return df.withColumn(out, udf(wanted, *[F.col(f"`{c}`").cast("double") for c in features]))


def _routed(df: DataFrame, forest: Forest, features: Sequence[str], out: str, wanted: Column) -> DataFrame:
    """The same with subtrees that are too large to broadcast: rows go to the nodes, their sums come back by row number."""
    spark, width, n = df.sparkSession, forest.rules.width, forest.width
    path = scratch_path(spark, "to-score")
    df.withColumn("_row_number", F.monotonically_increasing_id()).withColumn("_asked", wanted).write.parquet(path)
    kept = spark.read.parquet(path)
    sent = spark.sparkContext.broadcast([(t.tree, set(t.local)) for t in forest.tops])
    asked = kept.where("_asked").select(F.col("_row_number").alias("r"), F.array(*[F.col(f"`{c}`").cast("double") for c in features]).alias("x"))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            r, x = batch.column("r").to_numpy(), _matrix(batch.column("x"), n)
            for t, (tree, local) in enumerate(sent.value):
                node = tree.find(x)
                for k in np.unique(node):
                    own = node == k
                    value = b"" if int(k) in local else _bytes(np.tile(tree.value[k], (own.sum(), 1)))
                    yield pa.RecordBatch.from_pydict({"tree": pa.array([t], pa.int32()), "node": pa.array([int(k)], pa.int32()), "kind": pa.array([1], pa.int32()), "data": [r[own].tobytes()], "x": [_bytes(x[own])], "value": [value]})

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, tree = None, None
        for batch in batches:
            for t, k, kind, data, x, value in zip(*[batch.column(c).to_pylist() for c in ("tree", "node", "kind", "data", "x", "value")], strict=True):
                if (t, k) != now:
                    now, tree = (t, k), None
                if kind == 0:
                    tree = pickle.loads(data)
                    continue
                if tree is None and not value:
                    continue  # a tree that drew no row
                rows = np.frombuffer(data, dtype=np.int64)
                found = np.frombuffer(value).reshape(-1, width) if value else tree.value[tree.find(np.frombuffer(x).reshape(-1, n))]
                yield pa.RecordBatch.from_pydict({"r": rows, **{f"v{j}": found[:, j] for j in range(width)}})

    none = F.lit(None).cast("binary")
    packs = forest.table.select("tree", "node", F.lit(0).alias("kind"), "data", none.alias("x"), none.alias("value")).unionByName(
        asked.mapInArrow(send, "tree int, node int, kind int, data binary, x binary, value binary"))
    groups = sum(max(1, len(t.local)) for t in forest.tops)
    sums = packs.repartition(max(1, min(groups, 20_000)), "tree", "node").sortWithinPartitions("tree", "node", "kind").mapInArrow(
        score, "r long, " + ", ".join(f"v{j} double" for j in range(width)))
    means = sums.groupBy("r").agg(*[F.avg(f"v{j}").alias(f"v{j}") for j in range(width)])
    result = F.array(*[F.col(f"v{j}") for j in range(width)]) if forest.rules.classes else F.col("v0")
    back = kept.join(means.select("r", result.alias(out)), kept["_row_number"] == means["r"], "left")
    return back.drop("_row_number", "_asked", "r")
