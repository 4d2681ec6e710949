"""N-gram Jaccard join: globally ordered shingle sets, prefix filter, and a trie that confirms the candidates.

1. One pass writes per document its set size and a 64-bit key of its set, and counts shingles that repeat inside a task. Documents with equal
   sets form a class; from here on a class counts once, however many copies it has.
2. Shingles are ordered globally: uncounted ones first by hash, then the frequent ones by rising count class and hash. Any order
   is right as long as it is one order; this one keeps frequent passages out of the prefixes.
3. Two sets with Jaccard >= t share a shingle among the first ``n - ceil(t n) + 1`` of each. Prefix shingles meet by hash
   segment, packed as arrays; only those that two classes share go on as rows. Frequent ones are dealt evenly and all go on, so no group
   of them is gathered in a task.
4. Two sets are candidates if what both have left where they meet a common shingle can still reach the needed overlap
   (:meth:`Threshold.reach`; linked sets do so at their first). Some classes of each shared shingle are its centers; every class is compared with the
   centers that share most with it (stars, linear in the group), and links form components. After two such rounds
   what is left are candidates in *different* components; they are confirmed too. No link between different components is missed, and a
   group of near copies never becomes all its pairs.
5. To confirm, the sets on the other end of one set are stored in a trie in the global order, in blocks of bounded size. The set walks the trie;
   branches share the overlap counted so far, and a subtree whose remaining length cannot reach the threshold is cut.
   Candidates that a hot shingle brings together never become rows, one a pair: their classes go to their block a second time, with whole sets, and
   the block gives one link for each two components that it joins.

Sets are compared by 64-bit shingle hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from riskloom.functions.lookup import lookup
from riskloom.llm.components import components
from riskloom.llm.files import ready, stored
from riskloom.llm.words import Words, byte_texts, mix, release, slices

WORDS = 5
#: Shingles counted together in a task, and how often one must occur there to be reported as frequent.
COUNT_ROWS, COUNT_LEAST = 2_000_000, 3
#: Frequent shingles in the global order at most (12 bytes each); others are ordered by hash, which is as right.
FREQUENT = 500_000
SEGMENT_POSTINGS = 400_000
#: Shingles of the sets in one trie.
BLOCK_SHINGLES = 100_000
#: Rounds of stars, centers per shingle in a round, and centers that one class is compared with in a round.
STAR_ROUNDS, CENTERS, TRIED = 2, 3, 2
#: Classes from which on a prefix shingle's classes meet in blocks, and classes of one block.
HOT, BLOCK_CLASSES = 16, 256
#: Document ids that may be broadcast (8 bytes each); beyond, the join shuffles.
BROADCAST_IDS = 1_000_000


@dataclass(frozen=True)
class Threshold:
    """Jaccard similarity as a whole number of hundredths."""

    hundredths: int = 75

    def prefix(self, n: np.ndarray) -> np.ndarray:
        return n - -(-self.hundredths * n // 100) + 1

    def need(self, a: int, b: int) -> int:
        """Fewest shared shingles of sets with a and b shingles."""
        return -(-self.hundredths * (a + b) // (100 + self.hundredths))

    def near(self, a: str, b: str) -> Column:
        """Sizes that can reach the similarity at all."""
        return F.least(a, b) * 100 >= F.greatest(a, b) * self.hundredths

    def reach(self, na: str, a: str, nb: str, b: str) -> Column:
        """Whether sets of sizes na and nb whose first common shingle stands at places a and b can reach the similarity."""
        left = F.least(F.col(na) - F.col(a), F.col(nb) - F.col(b))
        return left * (100 + self.hundredths) >= (F.col(na) + F.col(nb)) * self.hundredths

    def least(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Fewest shingles that the prefixes of sets of sizes a and b share if the sets reach the threshold.

        Up to the end of the prefix that ends first in the global order, the other prefix holds all that its set holds; and a set of
        size n lacks at most n - need of its shingles in the other.
        """
        need = -(-self.hundredths * (a + b) // (100 + self.hundredths))
        return np.maximum(1, need + 1 - np.maximum(-(-self.hundredths * a // 100), -(-self.hundredths * b // 100)))

    def enough(self, common: str, a: str, b: str) -> Column:
        """Whether so many common prefix shingles are not fewer than :meth:`least`."""
        whole = lambda top, low: F.floor((top + F.lit(low - 1)) / F.lit(low))
        need = whole((F.col(a) + F.col(b)) * self.hundredths, 100 + self.hundredths)
        return F.col(common) >= F.greatest(F.lit(1), need + 1 - whole(F.greatest(a, b) * self.hundredths, 100))


def _sets(texts: list[bytes], size: int) -> list[np.ndarray]:
    hashes, at = Words(texts).shingles(size)
    return [np.unique(hashes[a:b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]


def _summaries(rows: DataFrame, size: int) -> DataFrame:
    """kind 0: (document id, set key, set size, text hash); kind 1: (shingle, times seen, 0, 0) for shingles that repeat nearby."""

    def frequent(waiting: list[np.ndarray]) -> pa.RecordBatch | None:
        value, times = np.unique(np.concatenate(waiting), return_counts=True)
        value, times = value[times >= COUNT_LEAST], times[times >= COUNT_LEAST]
        n = len(value)
        return _batch(1, pa.array(value.view(np.int64)), times.astype(np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)) if n else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[np.ndarray] = []
        total = 0
        for batch in batches:
            for part in slices(batch, "t"):
                sets = _sets(byte_texts(part.column("t")), size)
                key = np.array([xxhash.xxh3_64_intdigest(s.tobytes()) for s in sets], dtype=np.uint64)
                yield _batch(0, part.column("i"), key.view(np.int64), np.array([len(s) for s in sets], dtype=np.int64), part.column("h"))
                waiting += sets
                total += sum(map(len, sets))
                if total >= COUNT_ROWS:
                    found = frequent(waiting)
                    waiting, total = [], 0
                    if found:
                        yield found
        found = frequent(waiting) if waiting else None
        if found:
            yield found

    return rows.mapInArrow(run, "kind int, a long, b long, c long, d long")


def _batch(kind: int, a, b, c, d) -> pa.RecordBatch:
    n = len(b)
    return pa.RecordBatch.from_pydict({"kind": pa.array(np.full(n, kind, np.int32)), "a": a, "b": pa.array(b), "c": pa.array(c), "d": d if isinstance(d, pa.Array) else pa.array(d)})


class Order:
    """The global order of shingles; ``of`` arranges one set."""

    def __init__(self, values: np.ndarray, classes: np.ndarray) -> None:
        self.values, self.classes = values, classes

    def of(self, s: np.ndarray) -> tuple[np.ndarray, int]:
        """The sorted set in global order, and how many of it are not frequent."""
        if not len(self.values) or not len(s):
            return s, len(s)
        place = np.minimum(np.searchsorted(self.values, s), len(self.values) - 1)
        known = self.values[place] == s
        if not known.any():
            return s, len(s)
        often, rank = s[known], self.classes[place[known]]
        return np.concatenate([s[~known], often[np.lexsort((often, rank))]]), int(len(s) - known.sum())


def _frequent(summary: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    counted = summary.where("kind = 1").groupBy("a").agg(F.sum("b").alias("n"))
    kept = counted.orderBy(F.desc("n"), "a").limit(FREQUENT).toArrow()
    value = kept.column("a").to_numpy().astype(np.int64).view(np.uint64)
    times = kept.column("n").to_numpy().astype(np.int64)
    order = np.argsort(value)
    return value[order], np.floor(np.log2(np.maximum(times, 1))).astype(np.int8)[order]


def _postings(rows: DataFrame, order, size: int, limit: Threshold, segments: int) -> DataFrame:
    """Prefix shingles packed by segment: shingle, set key and place in the set; segments below 0 hold the frequent ones, dealt by set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrange = Order(*order.value)
        for batch in batches:
            for part in slices(batch, "t"):
                tokens, places, plain, keys = [], [], [], []
                for s in _sets(byte_texts(part.column("t")), size):
                    if not len(s):
                        continue
                    key = xxhash.xxh3_64_intdigest(s.tobytes())
                    line, light = arrange.of(s)
                    prefix = line[: int(limit.prefix(np.int64(len(s))))]
                    place = np.arange(len(prefix), dtype=np.uint32)
                    tokens.append(prefix)
                    places.append(place)
                    plain.append(place < light)
                    keys.append(key)
                if not keys:
                    continue
                own = np.repeat(np.array(keys, dtype=np.uint64), [len(x) for x in tokens])
                token, place = np.concatenate(tokens), np.concatenate(places)
                dealt = (mix(token) % np.uint64(segments)).astype(np.int64)
                segment = np.where(np.concatenate(plain), dealt, -1 - int(own[0] % np.uint64(segments)))
                turn = np.lexsort((own, token, segment))
                turn = turn[_new(segment[turn], token[turn], own[turn])]
                segment = segment[turn]
                cut = np.flatnonzero(_new(segment))
                out = [(int(segment[a]), turn[a:b]) for a, b in zip(cut, [*cut[1:], len(segment)], strict=True)]
                yield pa.RecordBatch.from_pydict({
                    "segment": pa.array([x[0] for x in out], pa.int32()), "tokens": pa.array([token[x].tobytes() for _, x in out], pa.binary()),
                    "keys": pa.array([own[x].tobytes() for _, x in out], pa.binary()), "places": pa.array([place[x].tobytes() for _, x in out], pa.binary()),
                })

    return rows.mapInArrow(run, "segment int, tokens binary, keys binary, places binary")


def _new(*sorted_columns: np.ndarray) -> np.ndarray:
    """Where a row differs from the row before."""
    out = np.ones(len(sorted_columns[0]), dtype=bool)
    if len(out) > 1:
        out[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in sorted_columns])
    return out


def _shared(table: pa.Table) -> pa.Table:
    """Of one segment: the postings whose shingle two classes or more have in their prefix, or may have if it is frequent."""
    kinds = {"tokens": np.int64, "keys": np.int64, "places": np.int32}
    token, key, place = (np.frombuffer(b"".join(table.column(c).to_pylist()), dtype=k) for c, k in kinds.items())
    release()
    if table.column("segment")[0].as_py() >= 0:
        turn = np.lexsort((key, token))
        turn = turn[_new(token[turn], key[turn])]
        first = _new(token[turn])
        turn = turn[~(first & np.append(first[1:], True))]
        token, key, place = token[turn], key[turn], place[turn]
    return pa.table({"token": token, "key": key, "place": place})


def walk(center: np.ndarray, others: list[np.ndarray], limit: Threshold) -> Iterator[tuple[int, int]]:
    """(index, overlap) of the sets that reach the threshold with ``center``; all sets are in the global order.

    The others form a trie with joined chains. A node holds the sets that agree up to its depth; its chain is looked up in
    ``center`` once for all of them. A set is dropped as soon as what it has matched and what it has left fall short.
    """
    mine = np.sort(center)
    need = [limit.need(len(center), len(o)) for o in others]
    nodes = [([k for k, o in enumerate(others) if min(len(center), len(o)) >= need[k] > 0], 0, 0)]
    while nodes:
        members, depth, matched = nodes.pop()
        members = [k for k in members if matched + min(len(others[k]) - depth, len(mine) - matched) >= need[k]]
        if not members:
            continue
        first = others[members[0]]
        end = min(len(others[k]) for k in members)
        for k in members[1:]:
            differ = np.flatnonzero(first[depth:end] != others[k][depth:end])
            end = depth + int(differ[0]) if len(differ) else end
        if end > depth:
            chain = first[depth:end]
            place = np.minimum(np.searchsorted(mine, chain), len(mine) - 1)
            matched += int((mine[place] == chain).sum())
        branches: dict[int, list[int]] = {}
        for k in members:
            if len(others[k]) == end:
                if matched >= need[k]:
                    yield k, matched
            else:
                branches.setdefault(int(others[k][end]), []).append(k)
        nodes += [(b, end, matched) for b in branches.values()]


def _confirmed(pairs: DataFrame, sets: DataFrame, limit: Threshold) -> DataFrame:
    """Of the pairs (a, b) those that reach the threshold, by tries over the sets of b that one a meets."""
    blocks = pairs.groupBy("a").agg(F.ceil(F.sum("nb") / BLOCK_SHINGLES).cast("long").alias("blocks"))
    dealt = pairs.join(blocks, "a").withColumn("block", F.pmod(F.xxhash64("b"), F.greatest("blocks", F.lit(1))))
    ends = dealt.select("a", "block", F.col("b").alias("key"), F.lit(False).alias("center")).unionAll(
        dealt.select("a", "block", F.col("a").alias("key"), F.lit(True).alias("center")).distinct())
    rows = ends.join(sets, "key")

    def run(table: pa.Table) -> pa.Table:
        release()
        keys, middle = table.column("key").to_pylist(), table.column("center").to_pylist()
        tokens = [np.frombuffer(x, dtype=np.uint64) for x in table.column("tokens").to_pylist()]
        found: list[tuple[int, int]] = []
        if True in middle:
            c = middle.index(True)
            rest = [k for k in range(len(keys)) if k != c]
            found = [(keys[c], keys[rest[k]]) for k, _ in walk(tokens[c], [tokens[k] for k in rest], limit)]
        return pa.table({"a": pa.array([x[0] for x in found], pa.int64()), "b": pa.array([x[1] for x in found], pa.int64())})

    return rows.groupBy("a", "block").applyInArrow(run, "a long, b long")


def jaccard_components(
    docs: DataFrame, size: int = WORDS, hundredths: int = 75, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id.

    Sets hold the distinct runs of ``size`` words, A-Z in lower case; a text with fewer words has its whole sequence as
    one. Null and empty texts have an empty set, linked with nothing. The component is the smallest id reachable by links,
    itself included. Repeated rows come out repeated; a null id links like any other, but is never the smallest (a
    component of null ids alone has null). Other columns do not matter; an empty table gives an empty result.
    """
    return _grouped(docs, size, hundredths, doc_id, text).select("doc_id", "n_shingles", "component_id")


def _grouped(docs: DataFrame, size: int, hundredths: int, doc_id: str, text: str) -> DataFrame:
    """doc_id, text_hash, n_shingles, group (the component's smallest set key) and component_id."""
    spark, limit = docs.sparkSession, Threshold(hundredths)
    ready(spark)
    value = docs[f"`{text}`"].cast("string")
    rows = docs.select(docs[f"`{doc_id}`"].cast("long").alias("i"), value.alias("t"), _text_hash(value).alias("h"))
    summary = stored(_summaries(rows, size), "summary")
    meta = summary.where("kind = 0").select(F.col("a").alias("doc_id"), F.col("b").alias("key"), F.col("c").alias("n"), F.col("d").alias("text_hash"))
    total = meta.agg(F.sum(F.col("n")).alias("n")).first()["n"] or 0
    classes = meta.where("n > 0").groupBy("key").agg(F.min("doc_id").alias("doc"), F.max("n").alias("n"), F.count("*").alias("copies"))
    order = spark.sparkContext.broadcast(_frequent(summary))

    segments = max(16, -(-total * (100 - hundredths) // 100 // SEGMENT_POSTINGS))
    packed = _postings(rows, order, size, limit, segments)
    shared = packed.groupBy("segment").applyInArrow(_shared, "token long, key long, place int")
    sizes = classes.select("key", "n")
    # Joined by key first, so that equal postings already lie together.
    shared = stored(shared.join(sizes, "key").distinct(), "shared")

    def sets_of(*keys: DataFrame) -> DataFrame:
        ends = reduce(DataFrame.unionAll, keys).distinct()
        return _sets_of(rows, stored(classes.join(ends, "key", "left_semi").select("key", "doc"), "wanted"), order, size)

    def both(pairs: DataFrame) -> DataFrame:
        return pairs.select(F.col("a").alias("key")).unionAll(pairs.select(F.col("b").alias("key")))

    links = label = known = None
    for turn in range(STAR_ROUNDS):
        postings = shared.withColumn("part", F.col("key")) if label is None else _open(shared, label)
        stars = stored(_stars(postings, limit, turn), "stars")
        found = stored(_confirmed(stars, sets_of(both(stars)), limit), "links")
        links = found if links is None else links.unionAll(found)
        known = stars if known is None else known.unionAll(stars)
        label = components(links, "a", "b")

    left = stored(_open(shared, label), "open")
    rest, met = _candidates(left, limit)
    tried = known.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    rest = stored(rest.join(tried, ["a", "b"], "left_anti").select("a", "b", "na", "nb"), "rest")
    met = stored(met, "met")
    sets = sets_of(both(rest), met.select("key"))
    label = components(links.unionAll(_confirmed(rest, sets, limit)).unionAll(_joined(met, sets, limit)), "a", "b")

    joined = classes.join(label.withColumnRenamed("node", "key"), "key", "left").withColumn("component", F.coalesce("component", "key"))
    least = joined.groupBy("component").agg(F.min("doc").alias("component_id"))
    moved = (F.col("copies") > 1) | (F.col("component") != F.col("key")) | ~F.col("component_id").eqNullSafe(F.col("doc"))
    grouped = stored(joined.join(least, "component").where(moved).select("key", "component", "component_id", "copies"), "groups")
    # A set that a third of all documents have is broadcast or salted, never one task.
    out = lookup(meta, grouped, "key", ["component", "component_id"], weight="copies")
    known = F.col("component").isNotNull() & (F.col("n") > 0)
    return out.select(
        "doc_id", "text_hash", F.col("n").alias("n_shingles"), F.coalesce("component", "key").alias("group"),
        F.when(known, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def _text_hash(value: Column) -> Column:
    return F.xxhash64(F.coalesce(value, F.lit("")))


def _open(shared: DataFrame, label: DataFrame) -> DataFrame:
    """Prefix postings (token, key, n, place, part, df) of the shingles that two components or more have.

    part is the component, df the number of classes that have the shingle.
    """
    label = label.withColumnRenamed("node", "key")
    label = F.broadcast(label) if label.count() <= BROADCAST_IDS else label
    marked = shared.join(label, "key", "left").select("token", "key", "n", "place", F.coalesce("component", "key").alias("part"))
    several = marked.groupBy("token").agg(F.min("part").alias("x"), F.max("part").alias("y"), F.count("*").alias("df")).where("x < y").select("token", "df")
    return marked.join(several, "token")


def _candidates(postings: DataFrame, limit: Threshold) -> tuple[DataFrame, DataFrame]:
    """(a, b, na, nb) of classes in different components that may be linked, from their open prefix postings; and (token, i, j, own, key, part) of
    the classes that may be linked with another one of their block.

    Shingles of fewer than ``HOT`` classes are joined with themselves and the pairs' open prefixes compared. The classes of the others meet in blocks, each with its open
    prefix, and a block only gives out the classes of the pairs that meet there first and share enough. Beyond one block, the classes of a shingle's largest component
    have blocks of their own, which meet those of the other classes but not each other: a group of near copies that is joined already costs
    one row a class for each block of strangers.
    """
    left, hot = postings.where(F.col("df") < HOT), postings.where(F.col("df") >= HOT)
    right = left.select("token", *[F.col(c).alias(f"{c}_") for c in ("key", "n", "part", "place")])
    other = (F.col("key") < F.col("key_")) & (F.col("part") != F.col("part_"))
    pairs = left.join(right, "token").where(other & limit.near("n", "n_") & limit.reach("n", "place", "n_", "place_"))
    pairs = pairs.select(F.col("key").alias("a"), F.col("key_").alias("b"), F.col("n").alias("na"), F.col("n_").alias("nb")).distinct()
    line = F.transform(F.sort_array(F.collect_list(F.struct("place", "token"))), lambda x: x["token"])
    lines = stored(postings.groupBy("key").agg(line.alias("line")), "lines")
    for end in ("a", "b"):
        pairs = pairs.join(lines.select(F.col("key").alias(end), F.col("line").alias(f"line_{end}")), end)
    pairs = pairs.withColumn("common", F.size(F.array_intersect("line_a", "line_b"))).where(limit.enough("common", "na", "nb")).select("a", "b", "na", "nb")

    largest = hot.groupBy("token", "part").agg(F.count("*").alias("c")).groupBy("token").agg(F.max(F.struct("c", "part")).alias("x"))
    hot = hot.join(largest.select("token", F.col("x.part").alias("big"), F.col("x.c").alias("m")), "token")
    one, big = F.col("df") <= BLOCK_CLASSES, F.col("part") == F.col("big")
    strangers, friends = (F.ceil(x / BLOCK_CLASSES).cast("long") for x in (F.col("df") - F.col("m"), F.col("m")))
    zero, h = F.lit(0).cast("long"), F.xxhash64("key")
    own = F.when(one, zero).when(big, strangers + F.pmod(h, friends)).otherwise(F.pmod(h, strangers))
    last = F.when(one, zero).when(big, strangers - 1).otherwise(strangers + friends - 1)
    met = hot.withColumn("own", own).withColumn("other", F.explode(F.sequence(zero, last)))
    met = met.join(lines, "key").select("token", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "key", "n", "part", "place", "line")

    def run(table: pa.Table) -> pa.Table:
        return _meet(table, limit)

    return pairs, met.groupBy("token", "i", "j").applyInArrow(run, "token long, i long, j long, own long, key long, part long")


def _meet(table: pa.Table, limit: Threshold) -> pa.Table:
    """The classes of one shingle, in one pair of blocks, that are in a pair that meets there first and can be linked."""
    release()
    column = lambda c: table.column(c).to_numpy()
    key, n, part, place, own = (column(c).astype(np.int64) for c in ("key", "n", "part", "place", "own"))
    here, i, j = table.column("token")[0].as_py(), table.column("i")[0].as_py(), table.column("j")[0].as_py()
    lines = [np.array(x, dtype=np.int64) for x in table.column("line").to_pylist()]
    _, code, times = np.unique(np.concatenate(lines), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(lines)), [len(x) for x in lines])
    before = np.concatenate([np.arange(len(x)) < np.flatnonzero(x == here)[0] for x in lines])
    several = times[code] > 1
    row, before, code = row[several], before[several], np.unique(code[several], return_inverse=True)[1]
    x, y = np.flatnonzero(own == i), np.flatnonzero(own == j)
    common, sooner = np.zeros((len(x), len(y)), np.float32), np.zeros((len(x), len(y)), np.float32)
    turn = np.argsort(code, kind="stable")
    for a in range(0, int(code.max(initial=-1)) + 1, 2048):
        now = turn[np.searchsorted(code[turn], a) : np.searchsorted(code[turn], a + 2048)]
        every, early = np.zeros((len(lines), 2048), np.float32), np.zeros((len(lines), 2048), np.float32)
        every[row[now], code[now] - a] = 1
        early[row[now], code[now] - a] = before[now]
        common += every[x] @ every[y].T
        sooner += early[x] @ early[y].T
    nx, ny = n[x][:, None], n[y][None, :]
    need = -(-limit.hundredths * (nx + ny) // (100 + limit.hundredths))
    good = (sooner == 0) & (common >= limit.least(nx, ny)) & (part[x][:, None] != part[y][None, :])
    good &= (np.minimum(nx - place[x][:, None], ny - place[y][None, :]) >= need) & (np.minimum(nx, ny) * 100 >= np.maximum(nx, ny) * limit.hundredths)
    if i == j:
        good &= key[x][:, None] < key[y][None, :]
    some = np.unique(np.concatenate([x[good.any(axis=1)], y[good.any(axis=0)]]))
    return table.select(["token", "i", "j", "own", "key", "part"]).take(pa.array(some))


def _overlaps(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Shared shingles of every set of a with every set of b."""
    both = np.intersect1d(np.concatenate(a), np.concatenate(b))
    out = np.zeros((len(a), len(b)), np.float32)
    ends = []
    for sets in (a, b):
        token, row = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(x) for x in sets])
        code = np.minimum(np.searchsorted(both, token), max(len(both) - 1, 0))
        known = np.flatnonzero(both[code] == token) if len(both) else code[:0]
        turn = known[np.argsort(code[known], kind="stable")]
        ends.append((row[turn], code[turn]))
    for start in range(0, len(both), 2048):
        sides = []
        for sets, (row, code) in zip((a, b), ends, strict=True):
            now = slice(*np.searchsorted(code, [start, start + 2048]))
            side = np.zeros((len(sets), 2048), np.float32)
            side[row[now], code[now] - start] = 1
            sides.append(side)
        out += sides[0] @ sides[1].T
    return out


def _tiles(rows: np.ndarray, n: np.ndarray) -> list[np.ndarray]:
    """Rows in pieces of about ``BLOCK_SHINGLES`` shingles."""
    piece = np.cumsum(n[rows]) // BLOCK_SHINGLES
    return np.split(rows, np.flatnonzero(np.diff(piece)) + 1) if len(rows) else []


def _joined(met: DataFrame, sets: DataFrame, limit: Threshold) -> DataFrame:
    """Links (a, b) between the classes of each pair of blocks: one for every two components that are linked there."""

    def run(table: pa.Table) -> pa.Table:
        release()
        key, part, own = (table.column(c).to_numpy() for c in ("key", "part", "own"))
        i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
        tokens = [np.frombuffer(x, dtype=np.uint64) for x in table.column("tokens").to_pylist()]
        n = np.array([len(x) for x in tokens])
        found: dict[tuple[int, int], tuple[int, int]] = {}
        for x in _tiles(np.flatnonzero(own == i), n):
            for y in _tiles(np.flatnonzero(own == j), n):
                need = -(-limit.hundredths * (n[x][:, None] + n[y][None, :]) // (100 + limit.hundredths))
                good = (part[x][:, None] != part[y][None, :]) & (_overlaps([tokens[k] for k in x], [tokens[k] for k in y]) >= need)
                a, b = np.nonzero(good)
                least, most = np.minimum(part[x[a]], part[y[b]]), np.maximum(part[x[a]], part[y[b]])
                turn = np.lexsort((most, least))
                turn = turn[_new(least[turn], most[turn])] if len(turn) else turn
                for k in turn.tolist():
                    found.setdefault((int(least[k]), int(most[k])), (int(key[x[a[k]]]), int(key[y[b[k]]])))
        return pa.table({"a": pa.array([p for p, _ in found.values()], pa.int64()), "b": pa.array([q for _, q in found.values()], pa.int64())})

    return met.join(sets, "key").groupBy("token", "i", "j").applyInArrow(run, "a long, b long")


def _stars(postings: DataFrame, limit: Threshold, turn: int) -> DataFrame:
    """For each class the few centers of other components that share most prefix shingles with it.

    The centers of a shingle are those of its classes with the least hashes under ``CENTERS`` seeds, so classes with many common
    shingles mostly meet the same centers. The pairs are linear in the classes; a link that they miss is found among what is left.
    """
    center = [F.col("key").alias("a"), F.col("n").cast("int").alias("na"), F.col("part").alias("pa")]
    least = [F.min(F.struct(F.xxhash64("key", F.lit(turn * CENTERS + k)).alias("order"), *center)).alias(f"c{k}") for k in range(CENTERS)]
    centers = postings.groupBy("token").agg(*least)
    plain = F.array(*[F.struct(*[F.col(f"c{k}.{f}").alias(f) for f in ("a", "na", "pa")]) for k in range(CENTERS)])
    centers = centers.select("token", F.explode(F.array_distinct(plain)).alias("c")).select("token", "c.a", F.col("c.na").cast("long").alias("na"), "c.pa")
    met = postings.join(centers, "token").where((F.col("pa") != F.col("part")) & limit.near("na", "n"))
    counted = met.groupBy("a", F.col("key").alias("b"), "na", F.col("n").alias("nb")).agg(F.count("*").alias("common")).where(limit.enough("common", "na", "nb"))
    best = Window.partitionBy("b").orderBy(F.desc("common"), "a")
    return counted.withColumn("order", F.row_number().over(best)).where(F.col("order") <= TRIED).select("a", "b", "na", "nb")


def _sets_of(rows: DataFrame, wanted: DataFrame, order, size: int) -> DataFrame:
    """Ordered sets of the wanted classes (key, doc), from the text of one document each."""
    ids = wanted.select(F.col("doc").alias("i")).distinct()
    small = wanted.count() <= BROADCAST_IDS
    ids, keys = (F.broadcast(x) if small else x for x in (ids, wanted.select("key")))
    # a null id belongs to a class of null ids alone: its rows are found by the null itself
    mine = rows.join(ids, rows["i"].eqNullSafe(ids["i"]), "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrange = Order(*order.value)
        for batch in batches:
            for part in slices(batch, "t"):
                sets = _sets(byte_texts(part.column("t")), size)
                key = np.array([xxhash.xxh3_64_intdigest(s.tobytes()) for s in sets], dtype=np.uint64).view(np.int64)
                yield pa.RecordBatch.from_pydict({"key": pa.array(key), "tokens": pa.array([arrange.of(s)[0].tobytes() for s in sets], pa.binary())})

    # Equal rows under one id give a set twice, which confirms a link twice and does no harm.
    return stored(mine.mapInArrow(run, "key long, tokens binary").join(keys, "key", "left_semi"), "sets")


def one_of_each(docs: DataFrame, size: int = WORDS, hundredths: int = 75, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows of ``docs`` of which each group of linked documents keeps one: the smallest id, then the smallest text hash.

    A null id is kept only by a group without ids. Of rows that agree in id and text one stays. Documents without words are no group and stay.
    All columns are kept; an empty table gives an empty result.
    """
    found = stored(_grouped(docs, size, hundredths, doc_id, text).where("n_shingles > 0"), "components")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", "text_hash"))
    kept = found.groupBy("group").agg(first.alias("w"), F.count("*").alias("n")).where("n > 1")
    kept = stored(kept.select("group", F.col("w.doc_id").alias("best"), F.col("w.text_hash").alias("best_hash"), "n"), "kept")
    judged = lookup(found.select("group", "doc_id", "text_hash"), kept, "group", ["best", "best_hash"], weight="n").where("best_hash is not null")
    stays = F.col("doc_id").eqNullSafe(F.col("best")) & (F.col("text_hash") == F.col("best_hash"))
    judged = stored(judged.withColumn("stays", stays).groupBy("doc_id", "text_hash", "stays").agg(F.count("*").alias("rows")), "judged")
    mine = _text_hash(docs[f"`{text}`"].cast("string"))

    def same(table: DataFrame) -> Column:
        return docs[f"`{doc_id}`"].cast("long").eqNullSafe(table["_doc"]) & (mine == table["_hash"])

    def small(table: DataFrame) -> DataFrame:
        table = table.select(F.col("doc_id").alias("_doc"), F.col("text_hash").alias("_hash"))
        return F.broadcast(table) if table.count() <= BROADCAST_IDS else table

    gone, again = small(judged.where("not stays")), judged.where("stays and rows > 1")
    out = docs.join(gone, same(gone), "left_anti")
    if again.isEmpty():
        return out
    again = small(again)
    return out.join(again, same(again), "left_anti").unionAll(out.join(again, same(again), "left_semi").dropDuplicates([doc_id, text]))
