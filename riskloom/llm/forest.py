"""Nearest neighbours by cosine: a forest of sorted hash-prefix arrays.

A tree gives every vector a string of ``BITS`` bits: symbols that name the largest coordinate, with its sign, of random rotations (64 of them for the
first symbol, 16 for each later one). The strings of one tree, sorted, are a trie: a prefix is a range. All trees stand one after the other in one sorted array, as the tree's
number is the head of its keys; Spark sorts it by range and cuts it into blocks, and a directory holds the first key and the size of each block.

1. *Descent.* A query's key lies between two neighbours in each tree, and every prefix of it is a range. The directory says in which blocks the
   ends of a range lie; those blocks, and no others, find the exact positions by binary search.
2. *Ascent.* All trees go up together, one bit at a time, from the longest prefix to the first level where their ranges hold ``wanted`` rows in all.
   Levels that the directory alone shows to hold enough need no search.
3. All rows of the ranges of that level are candidates, however many. They are compared exactly: ids go to the task that holds a share of the
   vectors, which keeps the best of each query.

Equal vectors are one entry, so a vector that a third of all rows hold is one key; of its ids the smallest k + 1 are kept, as ties go to the smaller id. A query without
a prefix that holds enough ascends to the root and meets all vectors. Candidates grow with the square root of the table (``wanted_of``), which keeps recall level
where the nearest rows are hardly nearer than the others; it is a parameter. Directory: at most ``MAX_BLOCKS`` entries of 16 bytes, beyond which blocks
grow. Rotations: trees x 224 x dimension floats. Nothing else is broadcast, and blocks and shares are read as streams.

Defined cases: rows take no part whose id is null or whose vector is null, empty, zero, holds null or non-finite components or has another
length than most vectors (ties: the shorter). Repeated rows count once; rows of one id with other vectors are queries of their own, and none is a candidate of its own id. Other columns are
not read. Fewer than k other rows give them all; an empty table gives none.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from riskloom.llm.files import ready, stored
from riskloom.llm.words import lean, release

TREES, BITS = 48, 57
FIRST, LATER, SYMBOLS = 64, 16, 10
BLOCK_ROWS, MAX_BLOCKS, SHARE_ROWS = 1 << 16, 1 << 20, 1 << 13
SEED = 20731


def wanted_of(n: int) -> int:
    """Rows that the ranges of all trees must hold before the ascent ends."""
    return 2_000 + math.ceil(40 * math.sqrt(n))


class Rotations:
    """Hash strings of unit vectors; the tree's number heads its keys."""

    def __init__(self, size: int, trees: int, seed: int) -> None:
        if not 0 < trees <= 64:
            raise ValueError("between 1 and 64 trees")
        rng, self.trees = np.random.Generator(np.random.PCG64(seed)), trees
        self.wide = [min(FIRST, 1 << (size.bit_length() - 1))] + [min(LATER, 1 << (size.bit_length() - 1))] * SYMBOLS
        self.axes = [[np.linalg.qr(rng.standard_normal((size, w)))[0].astype(np.float32) for w in self.wide] for _ in range(trees)]

    def keys(self, units: np.ndarray) -> np.ndarray:
        """One row per vector, one column per tree."""
        x, out = units.astype(np.float32), np.zeros((len(units), self.trees), dtype=np.int64)
        for t, axes in enumerate(self.axes):
            h, bits = np.zeros(len(x), dtype=np.int64), 0
            for w, axis in zip(self.wide, axes, strict=True):
                turned = x @ axis
                at = np.abs(turned).argmax(axis=1)
                more = w.bit_length()
                h = (h << more) | ((turned[np.arange(len(x)), at] > 0).astype(np.int64) << (more - 1)) | at
                bits += more
            out[:, t] = (t << BITS) | (h << (BITS - bits))
        return out


def units_of(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one, safe from overflow."""
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


@dataclass
class Directory:
    """Blocks in the order of their first keys: number, first key, rows before."""

    number: np.ndarray
    first: np.ndarray
    before: np.ndarray

    def low(self, key: np.ndarray) -> np.ndarray:
        """Place of the block in which the keys from ``key`` on begin."""
        return np.maximum(np.searchsorted(self.first, key, "left") - 1, 0)

    def high(self, key: np.ndarray) -> np.ndarray:
        """Place of the block in which the keys up to ``key`` end."""
        return np.maximum(np.searchsorted(self.first, key, "right") - 1, 0)


def span(keys: np.ndarray, level: int | np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last key of the range of a prefix of ``level`` bits."""
    rest = BITS - level
    low = (keys >> rest) << rest
    return low, low | ((1 << rest) - 1)


def valid(vector: Column) -> Column:
    whole = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return vector.isNotNull() & whole & F.exists(vector, lambda x: x != 0)


@dataclass
class Forest:
    """``classes``: c (a number), v, ids (the smallest few) of each distinct vector; ``blocks``: number, keys, ids; the directory and the rotations."""

    classes: DataFrame
    blocks: DataFrame
    directory: Directory
    rotations: Rotations
    count: int
    kept: int


def index(rows: DataFrame, trees: int, kept: int, seed: int) -> Forest | None:
    """The forest of (i, v) rows that are valid; all of them are indexed."""
    spark = rows.sparkSession
    sizes = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).toArrow().to_pylist()
    if not sizes:
        return None
    size = sizes[0]["d"]
    # The smallest ids of each vector; Spark keeps as many in every task before it shuffles.
    ranked = rows.where(F.size("v") == size).distinct().withColumn("at", F.row_number().over(Window.partitionBy("v").orderBy("i"))).where(F.col("at") <= kept)
    classes = stored(ranked.groupBy("v").agg(F.sort_array(F.collect_list("i")).alias("ids")).select(F.monotonically_increasing_id().alias("c"), "v", "ids"), "forest-classes")
    count = classes.count()
    rotations = Rotations(size, trees, seed)
    sent = spark.sparkContext.broadcast(rotations)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean()
        for batch in batches:
            keys = sent.value.keys(units_of(matrix(batch.column("v"))))
            yield pa.RecordBatch.from_pydict({"key": keys.ravel(), "c": np.repeat(batch.column("c").to_numpy(), keys.shape[1])})
        release()

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = list(batches)
        keys = np.concatenate([b.column("key").to_numpy() for b in whole]) if whole else []
        if len(keys):
            ids = np.concatenate([b.column("c").to_numpy() for b in whole])
            yield pa.RecordBatch.from_pydict({
                "number": pa.array([TaskContext.get().partitionId()], pa.int32()), "first": keys[:1], "n": [len(keys)],
                "keys": pa.ListArray.from_arrays([0, len(keys)], pa.array(keys)), "ids": pa.ListArray.from_arrays([0, len(ids)], pa.array(ids))})

    entries = stored(classes.select("c", "v").repartition(max(1, -(-count // 2_000)), "c").mapInArrow(hashed, "key long, c long"), "forest-keys")
    blocks = max(1, -(-count * trees // max(BLOCK_ROWS, -(-count * trees // MAX_BLOCKS))))
    entries = entries.repartitionByRange(blocks, "key", "c").sortWithinPartitions("key", "c")
    arrays = stored(entries.mapInArrow(packed, "number int, first long, n long, keys array<long>, ids array<long>"), "forest-blocks")
    sparse = arrays.select("number", "first", "n").orderBy("first", "number").toArrow()
    n = sparse.column("n").to_numpy()
    return Forest(classes, arrays, Directory(sparse.column("number").to_numpy(), sparse.column("first").to_numpy(), np.cumsum(n) - n), rotations, count, kept)


def _rows_of(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[tuple]:
    """Rows of a stream, one at a time; list columns as arrays."""
    for batch in batches:
        columns = []
        for name in names:
            column = batch.column(name)
            if pa.types.is_list(column.type) or pa.types.is_large_list(column.type):
                start, flat = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)
                columns.append([flat[a:b] for a, b in zip(start[:-1], start[1:], strict=True)])
            else:
                columns.append(column.to_pylist())
        yield from zip(*columns, strict=True)


def _levels(forest: Forest, asked: DataFrame, wanted: int) -> DataFrame:
    """(q, keys, level) of every query vector: descent into the blocks, ascent over all trees."""
    spark = asked.sparkSession
    sent = spark.sparkContext.broadcast((forest.rotations, forest.directory))
    size = forest.count * forest.rotations.trees

    def routed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rotations, directory = sent.value
        after = np.append(directory.before, size)
        for batch in batches:
            keys = rotations.keys(units_of(matrix(batch.column("v"))))
            floor, visits = np.zeros(len(keys), dtype=np.int64), []
            for level in range(BITS, 0, -1):
                low, high = span(keys, level)
                a, b = directory.low(low), directory.high(high)
                enough = np.maximum(after[b] - after[np.minimum(a + 1, len(after) - 1)], 0).sum(axis=1) >= wanted
                floor = np.where((floor == 0) & enough, level, floor)
                live = np.flatnonzero(floor == 0)
                if not len(live):
                    break
                for end in (a[live], b[live]):
                    visits.append(np.unique(live[:, None] * len(after) + end))
            q = batch.column("q").to_numpy()
            every = np.divmod(np.unique(np.concatenate([*visits, np.zeros(0, dtype=np.int64)])), len(after))
            lists = lambda rows: pa.ListArray.from_arrays(np.arange(len(rows) + 1) * keys.shape[1], pa.array(keys[rows].ravel()))
            yield pa.RecordBatch.from_pydict({
                "number": pa.array(directory.number[every[1]], pa.int32()), "q": q[every[0]], "floor": pa.array(floor[every[0]], pa.int32()), "keys": lists(every[0])})
            # One row without a block for each query, so that none is lost.
            yield pa.RecordBatch.from_pydict({"number": pa.array([-1] * len(q), pa.int32()), "q": q, "floor": pa.array(floor, pa.int32()), "keys": lists(np.arange(len(q)))})

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, directory = sent.value
        place = {int(n): k for k, n in enumerate(directory.number)}
        tree = np.append(directory.first >> BITS, 1 << 6)
        held, mine, found = None, -1, []
        for number, kind, q, floor, keys, array in _rows_of(batches, ["number", "kind", "q", "floor", "keys", "array"]):
            if kind == 0:
                held, mine = array, place[number]
                continue
            # Ranges of other trees neither begin nor end here.
            low, high = span(keys[tree[mine] : tree[mine + 1] + 1], np.arange(floor + 1, BITS + 1)[:, None])
            begins, ends = directory.low(low) == mine, directory.high(high) == mine
            counts = np.zeros(BITS, dtype=np.int64)
            counts[floor:] = (np.searchsorted(held, high, "right") + directory.before[mine]).sum(axis=1, where=ends)
            counts[floor:] -= (np.searchsorted(held, low, "left") + directory.before[mine]).sum(axis=1, where=begins)
            found.append((q, counts))
            if len(found) == 1_000:
                yield flat(found)
                found = []
        if found:
            yield flat(found)

    def flat(found: list) -> pa.RecordBatch:
        table = np.stack([x[1] for x in found])
        return pa.RecordBatch.from_pydict({"q": [x[0] for x in found], **{f"l{k + 1}": table[:, k] for k in range(BITS)}})

    routes = stored(asked.select("q", "v").mapInArrow(routed, "number int, q long, floor int, keys array<long>"), "forest-routes")
    none = F.lit(None)
    visits = routes.where("number >= 0").select("number", F.lit(1).alias("kind"), "q", "floor", "keys", none.cast("array<long>").alias("array"))
    blocks = forest.blocks.select("number", F.lit(0).alias("kind"), none.cast("long").alias("q"), none.cast("int").alias("floor"), none.cast("array<long>").alias("keys"), F.col("keys").alias("array"))
    sums = _by_block(blocks.unionByName(visits), len(forest.directory.number)).mapInArrow(searched, "q long, " + ", ".join(f"l{k} long" for k in range(1, BITS + 1)))
    sums = sums.groupBy("q").agg(*[F.sum(f"l{k}").alias(f"l{k}") for k in range(1, BITS + 1)])
    best = F.greatest(*[F.when(F.col(f"l{k}") >= wanted, k).otherwise(0) for k in range(1, BITS + 1)])
    own = routes.where("number = -1").select("q", "keys", "floor")
    return own.join(sums.select("q", best.alias("best")), "q", "left").select("q", "keys", F.greatest("floor", F.coalesce("best", F.lit(0))).alias("level"))


def _by_block(rows: DataFrame, blocks: int) -> DataFrame:
    """A block's array, then its visitors."""
    return rows.repartition(max(1, min(blocks, rows.sparkSession.sparkContext.defaultParallelism * 64)), "number").sortWithinPartitions("number", "kind")


def _candidates(forest: Forest, chosen: DataFrame, shares: int) -> DataFrame:
    """(p, q, ids): all rows of a query's ranges, by the share of the vectors that holds them. An id may come once from each tree."""
    sent = chosen.sparkSession.sparkContext.broadcast(forest.directory)

    def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        directory = sent.value
        for batch in batches:
            out = []
            for q, keys, level in _rows_of([batch], ["q", "keys", "level"]):
                # The root of one tree holds every row.
                low, high = span(keys if level else keys[:1], level)
                for a, b, x, y in zip(directory.low(low), directory.high(high), low, high, strict=True):
                    out.append(np.stack([directory.number[a : b + 1], np.full(b + 1 - a, q), np.full(b + 1 - a, x), np.full(b + 1 - a, y)]))
            table = np.concatenate([*out, np.zeros((4, 0), dtype=np.int64)], axis=1)
            yield pa.RecordBatch.from_pydict({"number": pa.array(table[0], pa.int32()), **dict(zip(["q", "low", "high"], table[1:], strict=True))})

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, order, out, size = None, None, [], 0
        for _, kind, q, low, high, array, ids in _rows_of(batches, ["number", "kind", "q", "low", "high", "array", "ids"]):
            if kind == 0:
                held, order, share = array, ids, share_of(ids, shares)
                continue
            a, b = np.searchsorted(held, low, "left"), np.searchsorted(held, high, "right")
            if a == b:
                continue
            turn = np.argsort(share[a:b], kind="stable")
            part = share[a:b][turn]
            cut = np.flatnonzero(np.diff(part)) + 1
            out.append((part[np.append(0, cut)], q, order[a:b][turn], np.append(cut, b - a) - np.append(0, cut)))
            size += b - a
            if size >= 1 << 20:
                yield listed(out)
                out, size = [], 0
        if out:
            yield listed(out)

    def listed(out: list) -> pa.RecordBatch:
        ends = np.cumsum(np.concatenate([x[3] for x in out]))
        return pa.RecordBatch.from_pydict({
            "p": pa.array(np.concatenate([x[0] for x in out]), pa.int32()), "q": np.repeat([x[1] for x in out], [len(x[0]) for x in out]),
            "ids": pa.ListArray.from_arrays(np.append(0, ends), pa.array(np.concatenate([x[2] for x in out])))})

    none = F.lit(None)
    asked = chosen.mapInArrow(ranges, "number int, q long, low long, high long").select(
        "number", F.lit(1).alias("kind"), "q", "low", "high", none.cast("array<long>").alias("array"), none.cast("array<long>").alias("ids"))
    blocks = forest.blocks.select(
        "number", F.lit(0).alias("kind"), *[none.cast("long").alias(c) for c in ("q", "low", "high")], F.col("keys").alias("array"), "ids")
    return _by_block(blocks.unionByName(asked), len(forest.directory.number)).mapInArrow(read, "p int, q long, ids array<long>")


def share_of(ids: np.ndarray, shares: int) -> np.ndarray:
    x = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((x >> np.uint64(32)) % np.uint64(shares)).astype(np.int32)


def _compared(forest: Forest, asked: DataFrame, hits: DataFrame, shares: int) -> DataFrame:
    """(q, c, low, score): the best vectors of each query in each share, in double precision."""
    most = forest.kept

    def shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"p": pa.array(share_of(batch.column("c").to_numpy(), shares), pa.int32()), "c": batch.column("c"), "low": batch.column("low"), "v": batch.column("v")})

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean()
        at, ids, lows, vectors, units, own, unit, lists = None, [], [], [], None, None, None, []
        out: list[tuple] = []

        def best() -> None:
            found = np.unique(np.concatenate(lists))
            place = np.searchsorted(ids, found)
            score = units[place] @ unit
            first = np.lexsort((lows[place], -score))[:most]
            out.append((np.full(len(first), own), found[first], lows[place][first], score[first]))

        def flushed() -> pa.RecordBatch:
            q, c, low, score = (np.concatenate(x) for x in zip(*out, strict=True))
            out.clear()
            return pa.RecordBatch.from_pydict({"q": q, "c": c, "low": low, "score": score})

        for p, kind, q, late, c, low, v, more in _rows_of(batches, ["p", "kind", "q", "late", "c", "low", "v", "ids"]):
            if lists and (p != at or kind == 0 or q != own):
                best()
                lists = []
                if len(out) >= 2_000:
                    yield flushed()
            if p != at:
                at, ids, lows, vectors, units, own = p, [], [], [], None, None
            if kind == 0:
                ids.append(c)
                lows.append(low)
                vectors.append(v)
                continue
            if units is None:
                order = np.argsort(ids, kind="stable")
                ids, lows, units = np.asarray(ids, dtype=np.int64)[order], np.asarray(lows, dtype=np.int64)[order], units_of(np.stack(vectors).astype(np.float64))[order]
                vectors = []
            if late == 0:
                own, unit = q, units_of(np.asarray(v, dtype=np.float64)[None, :])[0]
            else:
                lists.append(more)
        if lists:
            best()
        if out:
            yield flushed()
        release()

    none, kind = F.lit(None), forest.classes.schema["v"].dataType
    vectors = forest.classes.select("c", F.col("ids")[0].alias("low"), "v").mapInArrow(shared, f"p int, c long, low long, v {kind.simpleString()}")
    vectors = vectors.select("p", F.lit(0).alias("kind"), none.cast("long").alias("q"), F.lit(0).alias("late"), "c", "low", "v", none.cast("array<long>").alias("ids"))
    lists = hits.select("p", F.lit(1).alias("kind"), "q", F.lit(1).alias("late"), none.cast("long").alias("c"), none.cast("long").alias("low"), none.cast(kind).alias("v"), "ids")
    heads = hits.select("p", "q").distinct().join(asked, "q").select("p", F.lit(1).alias("kind"), "q", F.lit(0).alias("late"), none.cast("long").alias("c"), none.cast("long").alias("low"), "v", none.cast("array<long>").alias("ids"))
    rows = vectors.unionByName(lists).unionByName(heads)
    return rows.repartition(shares, "p").sortWithinPartitions("p", "kind", "q", "late").mapInArrow(compare, "q long, c long, low long, score double")


def nearest(rows: DataFrame, every: int, k: int = 5, key: str = "vec_id", vector: str = "embedding", trees: int = TREES, wanted: int | None = None, seed: int = SEED) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest rows found for each row whose id ``every`` divides."""
    spark = rows.sparkSession
    ready(spark)
    rows = rows.select(rows[f"`{key}`"].cast("long").alias("i"), rows[f"`{vector}`"].alias("v"))
    rows = rows.where(F.col("i").isNotNull() & valid(F.col("v")))
    forest = index(rows, trees, k + 1, seed)
    if forest is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    asking = stored(rows.where(F.col("i") % every == 0).distinct().join(forest.classes.select("c", "v"), "v").select("i", F.col("c").alias("q")), "forest-asking")
    asked = stored(asking.select("q").distinct().join(forest.classes.select(F.col("c").alias("q"), "v"), "q"), "forest-asked")
    wanted = wanted_of(forest.count) if wanted is None else wanted
    shares = max(1, -(-forest.count // SHARE_ROWS))
    hits = stored(_candidates(forest, stored(_levels(forest, asked, wanted), "forest-levels"), shares), "forest-hits")
    by = lambda *c: Window.partitionBy(*c).orderBy(F.desc("score"), "low")
    best = _compared(forest, asked, hits, shares).withColumn("at", F.row_number().over(by("q"))).where(F.col("at") <= k + 1)
    best = stored(best.join(forest.classes.select("c", "ids"), "c").select("q", "score", F.explode("ids").alias("low")), "forest-best")
    best = asking.join(best, "q").where(F.col("low") != F.col("i"))
    ranked = best.withColumn("rank", F.row_number().over(by("i", "q"))).where(F.col("rank") <= k)
    return ranked.select(F.col("i").alias("query_id"), "rank", F.col("low").alias("vec_id"), "score")
