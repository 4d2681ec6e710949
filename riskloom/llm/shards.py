"""Sharding by best-fit-decreasing bin packing of indivisible groups.

Groups of equal texts are packed into the fewest shards of a fixed capacity, or into a given number of shards of the smallest
capacity that suffices. Items enter in falling order of size; a balanced tree over the remaining capacities finds the
tightest shard that still holds the item.

The number of items that one place sorts is bounded whatever the table holds. A group of at least ``total / (shards * GRAIN)`` bytes is an item of its own; there
are at most ``shards * GRAIN`` of them. The smaller groups are dealt by the hash of their text into ``shards * GRAIN`` parcels, each an item.
A group above a shard's capacity cannot stay whole: its rows are dealt by id hash into pieces that fit, and only such a group is split.
Rows are summed by group before any shuffle, texts never move, and slots are numbered inside hash buckets of bounded size whose offsets are summed.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from riskloom.llm.files import packed, stored

#: Items per shard that the packing sorts at most, counted twice: large groups, and parcels of small ones.
GRAIN = 1_024
BUCKET_ROWS = 50_000
PIECES = 64


class Remaining:
    """Remaining capacities of open shards: a treap ordered by (capacity, shard)."""

    def __init__(self) -> None:
        self.root: list | None = None
        self._seed = 1

    def _merge(self, a: list | None, b: list | None) -> list | None:
        if a is None or b is None:
            return a or b
        if a[1] > b[1]:
            a[3] = self._merge(a[3], b)
            return a
        b[2] = self._merge(a, b[2])
        return b

    def _split(self, node: list | None, key: tuple[int, int]) -> tuple[list | None, list | None]:
        """Nodes below the key, and the others."""
        if node is None:
            return None, None
        if node[0] < key:
            left, right = self._split(node[3], key)
            node[3] = left
            return node, right
        left, right = self._split(node[2], key)
        node[2] = right
        return left, node

    def add(self, capacity: int, shard: int) -> None:
        self._seed = self._seed * 6364136223846793005 + 1442695040888963407 & (1 << 64) - 1
        left, right = self._split(self.root, (capacity, shard))
        self.root = self._merge(self._merge(left, [(capacity, shard), self._seed >> 16, None, None]), right)

    def take(self, size: int) -> tuple[int, int] | None:
        """Remove and return the tightest (capacity, shard) that holds ``size``."""
        left, right = self._split(self.root, (size, -1))
        if right is None:
            self.root = left
            return None
        node, path = right, []
        while node[2] is not None:
            path.append(node)
            node = node[2]
        if path:
            path[-1][2] = node[3]
        else:
            right = node[3]
        self.root = self._merge(left, right)
        return node[0]


def best_fit(sizes: Sequence[int], capacity: int, most: int | None = None) -> list[int] | None:
    """Shard of each item, items taken in falling order of size; None if more than ``most`` shards are needed.

    Ties are taken in the given order and go to the lowest shard. An item above the capacity raises.
    """
    tree, shards, out = Remaining(), 0, [0] * len(sizes)
    for k in sorted(range(len(sizes)), key=lambda k: (-sizes[k], k)):
        if sizes[k] > capacity:
            raise ValueError(f"an item of {sizes[k]} does not fit a shard of {capacity}")
        room = tree.take(sizes[k])
        if room is None:
            if shards == most:
                return None
            room = (capacity, shards)
            shards += 1
        out[k] = room[1]
        tree.add(room[0] - sizes[k], room[1])
    return out


def smallest_capacity(sizes: Sequence[int], shards: int) -> list[int]:
    """Packing into ``shards`` shards at the smallest capacity that bisection finds to suffice."""
    if not sizes:
        return []
    low, high = max(max(sizes), -(-sum(sizes) // shards)), max(sizes) + -(-sum(sizes) // shards)
    best = best_fit(sizes, high, shards)
    while low < high:
        middle = (low + high) // 2
        found = best_fit(sizes, middle, shards)
        if found is None:
            low = middle + 1
        else:
            best, high = found, middle
    return best


def _sized(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    value = F.coalesce(docs[f"`{text}`"].cast("string"), F.lit(""))
    return docs.select(
        docs[f"`{doc_id}`"].cast("long").alias("doc_id"), (F.octet_length(value) + F.lit(1)).cast("long").alias("size"),
        F.crc32(value.cast("binary")).alias("text_crc32"), F.unhex(F.sha2(value, 256)).alias("digest"),
    )


def _parcel(count: int) -> Column:
    return F.pmod(F.xxhash64("digest"), F.lit(count))


def assign_shards(
    docs: DataFrame, shards: int | None = 8, capacity: int | None = None, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per row: doc_id, size, text_crc32, shard, slot, and whether its group had to be split.

    Give ``shards`` for that many shards of about equal bytes, or ``capacity`` for the fewest shards of that many bytes.
    Size is the text's UTF-8 bytes plus one; a null text counts as empty and forms one group with empty texts. Equal texts share a
    shard unless the group alone passes a shard's capacity. Slots count from 0 without gaps in each
    shard, rows with equal ids included; null ids are numbered too. An empty table gives an empty result; extra columns are left out.
    """
    spark = docs.sparkSession
    rows = stored(_sized(docs, doc_id, text), "sizes")
    total, count = rows.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()
    n = shards if shards is not None else max(1, math.ceil(total / capacity))
    bound = capacity if shards is None else max(1, -(-total // n))
    groups = rows.groupBy("digest").agg(F.sum("size").alias("bytes"), F.max("size").alias("row"))
    parcels = n * GRAIN
    least = max(1, math.ceil(total / parcels))
    large = groups.where((F.col("bytes") >= least) | (F.col("bytes") > bound)).orderBy("digest").toArrow().to_pylist()
    small = groups.where((F.col("bytes") < least) & (F.col("bytes") <= bound)).groupBy(_parcel(parcels).alias("parcel")).agg(F.sum("bytes").alias("bytes"))
    small = small.orderBy("parcel").toArrow().to_pylist()

    fine = {}
    cut = [g for g in large if g["bytes"] > bound]
    if cut:
        # A group that no shard holds: its rows go into pieces by id hash, many to a shard, so that no piece is large.
        wide = spark.createDataFrame([(bytes(g["digest"]),) for g in cut], "digest binary")
        piece = F.pmod(F.xxhash64("doc_id"), F.lit(n * PIECES))
        pieces = rows.join(F.broadcast(wide), "digest").groupBy("digest", piece.alias("piece")).agg(F.sum("size").alias("bytes"))
        fine = {(bytes(r["digest"]), r["piece"]): r["bytes"] for r in pieces.orderBy("digest", "piece").toArrow().to_pylist()}
    whole = [g for g in large if g["bytes"] <= bound]
    items = [("large", bytes(g["digest"]), -1, g["bytes"]) for g in whole]
    items += [("piece", d, p, b) for (d, p), b in fine.items()] + [("small", b"", r["parcel"], r["bytes"]) for r in small]
    sizes = [x[3] for x in items]
    packed = smallest_capacity(sizes, n) if shards is not None else best_fit(sizes, capacity)

    plan = [(*x[:3], s) for x, s in zip(items, packed, strict=True)]
    by_group = spark.createDataFrame([(x[1], x[3]) for x in plan if x[0] == "large"], "digest binary, a int")
    by_piece = spark.createDataFrame([(x[1], x[2], x[3]) for x in plan if x[0] == "piece"], "digest binary, piece long, b int")
    by_parcel = spark.createDataFrame([(x[2], x[3]) for x in plan if x[0] == "small"], "parcel long, c int")
    # The three tables hold at most shards * GRAIN rows each (pieces: shards * PIECES for each of at most `shards` such groups).
    out = rows.join(F.broadcast(by_group), "digest", "left")
    if fine:
        out = out.withColumn("piece", F.pmod(F.xxhash64("doc_id"), F.lit(n * PIECES))).join(F.broadcast(by_piece), ["digest", "piece"], "left")
    else:
        out = out.withColumn("b", F.lit(None).cast("int"))
    out = out.withColumn("parcel", _parcel(parcels)).join(F.broadcast(by_parcel), "parcel", "left")
    out = out.select("doc_id", "size", "text_crc32", F.coalesce("a", "b", "c").alias("shard"), F.col("b").isNotNull().alias("split"))

    buckets = max(1, -(-count // BUCKET_ROWS))
    out = stored(out.withColumn("bucket", F.pmod(F.xxhash64("doc_id"), F.lit(buckets * 4))), "shards")
    held = out.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    before = held.withColumn("before", F.sum("n").over(Window.partitionBy("shard").orderBy("bucket")) - F.col("n")).drop("n")
    place = F.row_number().over(Window.partitionBy("shard", "bucket").orderBy("doc_id", "text_crc32", "size")) - 1
    numbered = out.withColumn("place", place).join(before, ["shard", "bucket"])
    return numbered.select("doc_id", "size", "text_crc32", "shard", (F.col("before") + F.col("place")).cast("long").alias("slot"), "split")


def write_shards(docs: DataFrame, path: str, **options) -> DataFrame:
    """Write each shard's rows, in slot order inside a file, under ``path/shard=k``; returns the assignment."""
    doc_id = options.get("doc_id", "doc_id")
    plan = stored(assign_shards(docs, **options), "assignment")
    text = F.coalesce(docs[f"`{options.get('text', 'text')}`"].cast("string"), F.lit(""))
    names, row = packed(docs, "shard", "slot")
    rows = docs.select(row.alias("_row"), docs[f"`{doc_id}`"].cast("long").alias("_doc"), F.crc32(text.cast("binary")).alias("_crc"))
    # Rows that agree in id and text take the slots of that id and text in turn.
    rows = rows.withColumn("_turn", F.row_number().over(Window.partitionBy("_doc", "_crc").orderBy("_crc")))
    turn = F.row_number().over(Window.partitionBy("doc_id", "text_crc32").orderBy("shard", "slot"))
    placed = plan.select(F.col("doc_id").alias("_id"), F.col("text_crc32").alias("_crc_"), turn.alias("_turn_"), F.col("shard").alias("_shard"), F.col("slot").alias("_slot"))
    same = rows["_doc"].eqNullSafe(placed["_id"]) & (rows["_crc"] == placed["_crc_"]) & (rows["_turn"] == placed["_turn_"])
    rows = rows.join(placed, same).select(*[F.col("_row").getField(c).alias(c) for c in names], F.col("_shard").alias("shard"), F.col("_slot").alias("slot"))
    rows.repartition("shard", F.floor(F.col("slot") / BUCKET_ROWS)).sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
    return plan
