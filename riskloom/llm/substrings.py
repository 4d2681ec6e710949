"""Removal of repeated byte strings by prefix doubling over sampled positions.

A position's rank is the class of the bytes that follow it. Doubling names the class of ``length`` bytes by the pair of the ranks of its two
halves, one at the position and one at the offset behind it; a position whose class is unique leaves. Names are 64-bit fingerprints
of the bytes, so equal bytes have equal ranks in every task without a number that one place would have to deal out.

Ranking every position of the corpus would move it many times over. Three exact reductions come first:

* Ranks up to half the length (25 of 50 bytes) are rolling hashes, computed in place.
* Only anchors are sorted in the first round: of the half-length strings inside each window of ``length`` bytes the one with the least hash. Equal windows have equal
  anchors at equal places, so two documents that share a window share an anchor's rank. About 7.5 % of positions are anchors.
* An anchor stands for the run of windows that chose it. If the whole run, with its context, equals that of a smaller document, all its windows
  are repeats and the anchor leaves; one copy per distinct context stays.

What is left, anchors whose rank several contexts share, goes through the second round: every window of their runs gets the pair of ranks at offsets 0 and
half, pairs are sorted together, and a window is a repeat if a smaller document has the pair.

Ranks travel packed as arrays, dealt by hash segments. A task first settles what it can: of equal entries in one slice of text only those of the
smallest document go on, so a string that a third of all documents share is at most one entry per slice.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from riskloom.llm.files import packed as packed_row, ready, stored
from riskloom.llm.words import _BYTE, _POWERS, byte_texts, mix, release, slices

LENGTH = 50
#: Entries of one segment, which one task sorts (about 40 bytes each).
SEGMENT_ENTRIES = 600_000
#: Windows of a text that are ranked together.
CHUNK = 1 << 19
BROADCAST_ROWS = 500_000
_LAST = np.iinfo(np.int64).max


class Ranks:
    """Fingerprints of the substrings of one stretch of bytes."""

    def __init__(self, data: np.ndarray) -> None:
        up, self.down = _POWERS.to(len(data) + 1)
        self.total = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(_BYTE[data] * up[: len(data)], out=self.total[1:])

    def of(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return mix((self.total[stop] - self.total[start]) * self.down[start] + (stop - start).astype(np.uint64))

    def all(self, size: int) -> np.ndarray:
        n = max(0, len(self.total) - size)
        return mix((self.total[size:] - self.total[:n]) * self.down[:n] + np.uint64(size))


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the first least value in each window of ``width``."""
    best, place, reach = values, np.arange(len(values), dtype=np.int32), 1
    while reach < width:
        step = min(reach, width - reach)
        right = best[step:] < best[:-step]
        place = np.where(right, place[step:], place[:-step])
        best = np.where(right, best[step:], best[:-step])
        reach += step
    return place


def anchors(data: bytes, length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, Ranks, int]]:
    """Per chunk of windows: first window, number of windows, rank and context fingerprint of each anchor; the chunk's ranks and begin."""
    half = length // 2
    whole = np.frombuffer(data, dtype=np.uint8)
    for begin in range(0, len(whole) - length + 1, CHUNK):
        ranks = Ranks(whole[begin : begin + CHUNK + length - 1])
        windows = len(ranks.total) - length
        short = ranks.all(half)
        place = _least(short, length - half + 1)[:windows]
        first = np.flatnonzero(np.diff(place, prepend=-1))
        count = np.diff(np.append(first, windows))
        yield first + begin, count, short[place[first]], ranks.of(first, first + count + (length - 1)), ranks, begin


def text_hash(value: Column) -> Column:
    """31 bits that tell apart texts under one id."""
    return F.pmod(F.xxhash64(value), F.lit(1 << 31))


def _cut(order: np.ndarray) -> list[tuple[int, int]]:
    """Runs of equal values of a sorted array."""
    if not len(order):
        return []
    at = np.flatnonzero(np.diff(order)) + 1
    return list(zip([0, *at.tolist()], [*at.tolist(), len(order)], strict=True))


def _bytes(x: np.ndarray) -> bytes:
    return np.ascontiguousarray(x).tobytes()


def _planes(x: np.ndarray, keep: int) -> bytes:
    """The low ``keep`` bytes of unsigned values, all lowest bytes first: high bytes that are mostly zero then take no room in a shuffle."""
    return _bytes(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :keep].T)


def _from_planes(data: bytes, keep: int) -> np.ndarray:
    out = np.zeros((len(data) // keep, 8), dtype=np.uint8)
    out[:, :keep] = np.frombuffer(data, dtype=np.uint8).reshape(keep, -1).T
    return out.view("<u8").ravel()


def _steps(x: np.ndarray) -> np.ndarray:
    return np.diff(x.astype(np.int64), prepend=0).view(np.uint64)


def _sums(x: np.ndarray) -> np.ndarray:
    return np.cumsum(x.view(np.int64))


def _smallest(keys: list[np.ndarray], docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order that sorts by keys, then document; and for each entry in that order whether a smaller document has its keys."""
    turn = np.lexsort((docs, *reversed(keys)))
    doc = docs[turn]
    new = np.ones(len(turn), dtype=bool)
    if len(turn) > 1:
        new[1:] = np.logical_or.reduce([k[turn][1:] != k[turn][:-1] for k in keys])
    head = np.maximum.accumulate(np.where(new, np.arange(len(turn)), 0))
    return turn, doc > doc[head]


_PACKED = "segment int, ids binary, hashes binary, owner binary, rank binary, context binary, start binary, count binary"


def _pack(segment: int, ids, hashes, owner, rank, context, start, count) -> dict:
    """Entries of one segment and slice, with a table of their texts."""
    used, local = np.unique(owner, return_inverse=True)
    return {
        "segment": segment, "ids": _planes(_steps(ids[used]), 8), "hashes": _planes(hashes[used].astype(np.uint32), 4), "owner": _planes(_steps(local), 4),
        "rank": _planes(rank, 4), "context": _planes(context, 6), "start": _planes(start, 4), "count": _planes(count, 1),
    }


def _first_round(rows: DataFrame, length: int, segments: int) -> DataFrame:
    """Anchors packed by segment of their rank; segments below 0 hold what a slice of text settles as repeated."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "t", 4 << 20):
                ids = part.column("i").fill_null(_LAST).to_numpy(zero_copy_only=False)
                hashes = part.column("h").to_numpy(zero_copy_only=False)
                found: list[tuple[np.ndarray, ...]] = []
                for k, data in enumerate(byte_texts(part.column("t"))):
                    found += [(np.full(len(a[0]), k), *a[:4]) for a in anchors(data, length)]
                if not found:
                    continue
                owner, start, count, rank, context = (np.concatenate(x) for x in zip(*found, strict=True))
                turn, repeated = _smallest([rank, context], ids[owner])
                segment = (mix(rank) >> np.uint64(33)).astype(np.int64) % segments
                segment[turn[repeated]] = -1 - int(hashes[0] % segments)
                by = np.argsort(segment, kind="stable")
                out = []
                for a, b in _cut(segment[by]):
                    x = by[a:b]
                    out.append(_pack(int(segment[by[a]]), ids, hashes, owner[x], rank[x], context[x], start[x], count[x]))
                yield pa.RecordBatch.from_pylist(out, schema=_arrow(_PACKED))

    return rows.mapInArrow(run, _PACKED)


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_()}
    return pa.schema([(f.split()[0], kinds[f.split()[1]]) for f in ddl.split(", ")])


def _unpack(table: pa.Table) -> tuple[np.ndarray, ...]:
    ids, hashes, rank, context, start, count = [], [], [], [], [], []
    for row in table.select(["ids", "hashes", "owner", "rank", "context", "start", "count"]).to_pylist():
        own = _sums(_from_planes(row["owner"], 4))
        ids.append(_sums(_from_planes(row["ids"], 8))[own])
        hashes.append(_from_planes(row["hashes"], 4)[own].astype(np.int64))
        rank.append(_from_planes(row["rank"], 4))
        context.append(_from_planes(row["context"], 6))
        start.append(_from_planes(row["start"], 4).astype(np.int64))
        count.append(_from_planes(row["count"], 1).astype(np.int64))
    return tuple(np.concatenate(x) for x in (ids, hashes, rank, context, start, count))


_RUNS = "doc long, hash long, start int, count int, settled boolean"


def _runs(doc: np.ndarray, h: np.ndarray, start: np.ndarray, count: np.ndarray, settled: np.ndarray) -> pa.Table:
    return pa.table({
        "doc": pa.array(doc, mask=doc == _LAST), "hash": pa.array(h), "start": pa.array(start.astype(np.int32)),
        "count": pa.array(count.astype(np.int32)), "settled": pa.array(settled),
    })


def _rank_anchors(table: pa.Table) -> pa.Table:
    """Of one segment: runs that a smaller document repeats whole, and runs whose rank has several contexts."""
    release()
    doc, h, rank, context, start, count = _unpack(table)
    if table.column("segment")[0].as_py() < 0:
        return _runs(doc, h, start, count, np.ones(len(doc), bool))
    turn, repeated = _smallest([rank, context], doc)
    doc, h, rank, context, start, count = (x[turn] for x in (doc, h, rank, context, start, count))
    group = np.cumsum(np.concatenate([[0], rank[1:] != rank[:-1]]))
    mixed = np.zeros(group[-1] + 1, dtype=bool)
    other = (group[1:] == group[:-1]) & (context[1:] != context[:-1])
    mixed[group[1:][other]] = True
    least, most = np.full(len(mixed), _LAST), np.full(len(mixed), np.iinfo(np.int64).min)
    np.minimum.at(least, group, doc)
    np.maximum.at(most, group, doc)
    open_ = ~repeated & (mixed & (least < most))[group]
    keep = repeated | open_
    return _runs(doc[keep], h[keep], start[keep], count[keep], repeated[keep])


_PAIRS = "segment int, ids binary, hashes binary, start binary, count binary, pairs binary, checks binary"


def _second_round(rows: DataFrame, length: int, segments: int) -> DataFrame:
    """The windows of open runs, each with its pair of ranks, packed by the segment of the anchor's rank; rows carry ``starts``."""
    half = length // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "t"):
                found: list[tuple] = []
                ids = part.column("i").fill_null(_LAST).to_pylist()
                for i, h, data, starts in zip(ids, part.column("h").to_pylist(), byte_texts(part.column("t")), part.column("starts").to_pylist(), strict=True):
                    wanted = np.unique(np.array(starts, dtype=np.int64))
                    for first, count, rank, _, ranks, begin in anchors(data, length):
                        at = np.flatnonzero(np.isin(first, wanted, assume_unique=True))
                        if not len(at):
                            continue
                        n = count[at]
                        window = np.repeat(first[at] - begin - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
                        left, right = ranks.of(window, window + half), ranks.of(window + half, window + length)
                        pair = mix(left * np.uint64(0xD6E8FEB86659FD93) + right)
                        check = ((left >> np.uint64(32)) ^ right).astype("<u4")
                        found.append((i, h, first[at], n, rank[at], pair, check))
                if not found:
                    continue
                n_all = np.concatenate([f[3] for f in found])
                each = [len(f[3]) for f in found]
                ids_all = np.repeat(np.array([f[0] for f in found], np.int64), each)
                hash_all = np.repeat(np.array([f[1] for f in found], np.int64), each)
                start, rank, pair, check = (np.concatenate([f[k] for f in found]) for k in (2, 4, 5, 6))
                segment = (mix(rank) >> np.uint64(33)) % np.uint64(segments)
                by = np.argsort(segment, kind="stable")
                offset = np.concatenate([[0], np.cumsum(n_all)])
                out = []
                for a, b in _cut(segment[by]):
                    x = by[a:b]
                    w = np.repeat(offset[x] - np.concatenate([[0], np.cumsum(n_all[x])[:-1]]), n_all[x]) + np.arange(n_all[x].sum())
                    out.append({
                        "segment": int(segment[by[a]]), "ids": _bytes(ids_all[x]), "hashes": _bytes(hash_all[x]), "start": _bytes(start[x].astype("<u4")),
                        "count": _bytes(n_all[x].astype("u1")), "pairs": _bytes(pair[w]), "checks": _bytes(check[w]),
                    })
                yield pa.RecordBatch.from_pylist(out, schema=_arrow(_PAIRS))

    return rows.mapInArrow(run, _PAIRS)


def _rank_pairs(table: pa.Table) -> pa.Table:
    """Of one segment: the stretches of windows that a smaller document has too."""
    release()
    kinds = {"ids": np.int64, "hashes": np.int64, "start": "<u4", "count": "u1", "pairs": np.uint64, "checks": "<u4"}
    ids, hashes, start, count, pair, check = (np.frombuffer(b"".join(table.column(c).to_pylist()), k) for c, k in kinds.items())
    n = count.astype(np.int64)
    owner = np.repeat(np.arange(len(n)), n)
    turn, repeated = _smallest([pair, check], ids[owner])
    hit = np.zeros(len(owner), dtype=bool)
    hit[turn] = repeated
    # stretches of hits, none of which passes from one run to the next
    before = np.concatenate([[False], hit[:-1] & (owner[1:] == owner[:-1])]) if len(hit) else hit
    after = np.concatenate([hit[1:] & (owner[1:] == owner[:-1]), [False]]) if len(hit) else hit
    a, b = np.flatnonzero(hit & ~before), np.flatnonzero(hit & ~after)
    place = np.arange(len(owner)) - np.concatenate([[0], np.cumsum(n)[:-1]])[owner] if len(hit) else owner
    who = owner[a]
    return _runs(ids[who], hashes[who], start[who].astype(np.int64) + place[a], b - a + 1, np.ones(len(a), bool))


def _apply(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "t"):
                kept, removed, spans, size = [], [], [], []
                for data, runs in zip(byte_texts(part.column("t")), part.column("runs").to_pylist(), strict=True):
                    size.append(len(data))
                    if not runs:
                        kept.append(data)
                        removed.append(0)
                        spans.append(0)
                        continue
                    change = np.zeros(len(data) + 1, dtype=np.int32)
                    at = np.array([(r["start"], r["start"] + r["count"] + length - 1) for r in runs])
                    np.add.at(change, at[:, 0], 1)
                    np.add.at(change, at[:, 1], -1)
                    gone = np.cumsum(change[:-1]) > 0
                    kept.append(np.frombuffer(data, np.uint8)[~gone].tobytes())
                    removed.append(int(gone.sum()))
                    spans.append(int((gone & ~np.concatenate([[False], gone[:-1]])).sum()))
                yield pa.RecordBatch.from_arrays(
                    [part.column("row"), pa.array(kept, pa.binary()), pa.array(size, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64())],
                    names=["row", "_kept", "_n_bytes", "_n_removed", "_n_spans"])

    return run


def drop_repeated_substrings(docs: DataFrame, length: int = LENGTH, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with ``_kept`` (the remaining bytes), ``_n_bytes``, ``_n_removed`` and ``_n_spans`` (maximal removed runs).

    A byte goes if a ``length``-byte string that covers it also starts in a document with a smaller id; strings are judged on the
    input. Texts are UTF-8; null and empty texts have no byte and stay. Rows with one id do not remove each other's bytes, whatever
    their texts; up to two billion bytes a text. A null id counts as larger than every id, and null ids do not remove each other's bytes. All columns stay, whatever their names;
    an empty table gives an empty result. ``length`` is 4 to 500.
    """
    ready(docs.sparkSession)
    value = F.coalesce(docs[f"`{text}`"].cast("string"), F.lit(""))
    rows = docs.select(docs[f"`{doc_id}`"].cast("long").alias("i"), value.alias("t"), text_hash(value).alias("h"))
    total = rows.agg(F.sum(F.octet_length("t")).alias("b")).first()["b"] or 0
    density = 2 / (length - length // 2 + 2)
    segments = max(8, int(total * density) // SEGMENT_ENTRIES)

    runs = stored(_first_round(rows, length, segments).groupBy("segment").applyInArrow(_rank_anchors, _RUNS), "runs")

    open_ = runs.where("not settled").groupBy("doc", "hash").agg(F.collect_list("start").alias("starts"))
    open_ = stored(open_, "open")
    few = F.broadcast(open_.select("doc", "hash")) if open_.count() <= BROADCAST_ROWS else None
    left = rows.join(few, rows["i"].eqNullSafe(few["doc"]) & (rows["h"] == few["hash"]), "left_semi") if few is not None else rows
    joined = left.join(open_, left["i"].eqNullSafe(open_["doc"]) & (left["h"] == open_["hash"])).select("i", "t", "h", "starts")
    pairs = _second_round(joined, length, segments).groupBy("segment").applyInArrow(_rank_pairs, _RUNS)
    every = runs.where("settled").unionAll(pairs)
    grouped = stored(every.groupBy("doc", "hash").agg(F.collect_list(F.struct("start", "count")).alias("runs")), "repeats")

    names, row = packed_row(docs, "_kept", "_n_bytes", "_n_removed", "_n_spans")
    whole = docs.select(docs[f"`{doc_id}`"].cast("long").alias("i"), value.alias("t"), text_hash(value).alias("h"), row.alias("row"))
    keys = grouped.select("doc", "hash")
    run = _apply(length)
    schema = f"row {whole.schema['row'].dataType.simpleString()}, _kept binary, _n_bytes bigint, _n_removed bigint, _n_spans bigint"

    def same(x: DataFrame, y: DataFrame):
        return x["i"].eqNullSafe(y["doc"]) & (x["h"] == y["hash"])

    if keys.count() <= BROADCAST_ROWS:
        # Texts that lose nothing need not shuffle.
        small = F.broadcast(keys)
        hit = whole.join(small, same(whole, small), "left_semi")
        hit = hit.join(grouped, same(hit, grouped)).select("row", "t", "runs")
        rest = whole.join(small, same(whole, small), "left_anti").select("row", "t", F.lit(None).cast("array<struct<start:int,count:int>>").alias("runs"))
        out = hit.mapInArrow(run, schema).unionAll(rest.mapInArrow(run, schema))
    else:
        out = whole.join(grouped, same(whole, grouped), "left").select("row", "t", "runs").mapInArrow(run, schema)
    return out.select(*[F.col("row").getField(c).alias(c) for c in names], "_kept", "_n_bytes", "_n_removed", "_n_spans")
