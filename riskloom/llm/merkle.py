"""Merkle manifest of a dataset: a content-addressed DAG, and proofs by descent from its root.

Every row is a leaf, the SHA-256 of its fields. Leaves of one group (a source) ascend by key; ``FAN`` consecutive nodes become the digest of
their digests until one is left, the group's subroot; subroots, ordered by group, become the root in the same way. What is stored are
records ``digest -> children``, one folder per height, equal digests once, and a table of the groups.

A request names a leaf by the place of its group and its rank there. The digits of both numbers in base ``FAN`` are its way down from the
root: at every height the requests that still share their digits are one frontier row, which looks its record up by digest, collects the children that it
does not follow as a path segment, and goes on with those that some request wants. Segments are put before the ones from above, so a
path reads from the leaf to the root, as folding needs it.

Work and memory: ranks come from one range sort and one row per (task, group), so a group that holds a third of all rows is spread like
the rest; nodes are grouped by sixteen; a frontier row, not a request, carries the path, so it is shipped once per sixteen leaves. The driver
sees one number per task of the sort, the largest group's size and the root.

Defined cases: a null field is ``-``; null keys and null groups come first; rows of one key in one group are ordered by leaf; repeated rows are leaves of their
own with equal digests; a single leaf is its group's subroot, a single group's subroot the root; an empty table has no root and proves nothing.
Columns that are not named as fields take no part.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from riskloom.llm.files import ready, stored

FAN, BITS = 16, 4
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def field(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, a colon and the value as text."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(values: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def height(n: int) -> int:
    """Levels above ``n`` leaves."""
    levels = 0
    while n > 1:
        n, levels = -(-n // FAN), levels + 1
    return levels


def _height(n: Column, most: int) -> Column:
    """The same for a column whose largest value needs ``most`` levels."""
    return sum((F.when(n > FAN**k, 1).otherwise(0) for k in range(most)), F.lit(0)).cast("int")


@dataclass
class Manifest:
    """``leaves``: key, claim, s (place of the group), r (rank). ``groups``: s, g, n, h (levels), subroot. ``records`` and ``top``: digest and children by height, from 1."""

    spark: SparkSession
    leaves: DataFrame
    groups: DataFrame
    records: list[DataFrame]
    top: list[DataFrame]
    root: str | None
    count: int


def _ordered(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows with place and rank, and the groups (s, g, n)."""
    order = [F.col("g").asc_nulls_first(), F.col("k").asc_nulls_first(), F.col("leaf"), F.col("u")]
    at = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    rows = stored(rows.repartitionByRange(*order).sortWithinPartitions(*order).select("*", F.spark_partition_id().alias("task"), at.alias("at")).drop("u"), "merkle-ordered")
    runs = rows.groupBy("task", "g").agg(F.min("at").alias("first"), F.count("*").alias("m"))
    mine = Window.partitionBy("g")
    runs = stored(runs.select(
        "*", F.coalesce(F.sum("m").over(mine.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"), F.sum("m").over(mine).alias("n")), "merkle-runs")
    # Places: the groups that begin in one task follow those that begin in earlier tasks. One number per task comes to the driver.
    starts = runs.where("before = 0")
    begun = sorted((r["task"], r["c"]) for r in starts.groupBy("task").agg(F.count("*").alias("c")).toArrow().to_pylist())
    base, total = [], 0
    for task, c in begun:
        base.append((task, total))
        total += c
    base = rows.sparkSession.createDataFrame(base, "task int, base long")
    place = F.col("base") + F.row_number().over(Window.partitionBy("task").orderBy("first")) - 1
    groups = stored(starts.join(F.broadcast(base), "task").select(place.alias("s"), "g", "n"), "merkle-groups")
    runs = runs.alias("a").join(groups.select("s", F.col("g").alias("h")).alias("b"), F.expr("a.g <=> b.h")).select("task", F.col("g").alias("rg"), "first", "before", "s", "n")
    found = rows.alias("a").join(runs.alias("b"), F.expr("a.task = b.task and a.g <=> b.rg"))
    return stored(found.select("k", "leaf", "claim", "s", (F.col("at") - F.col("first") + F.col("before")).alias("r"), "n"), "merkle-leaves"), groups


def _grown(nodes: DataFrame, levels: int, name: str) -> tuple[list[DataFrame], DataFrame]:
    """Records of every height, and the last node of each group: (s, digest)."""
    records, ends = [], nodes.where("n = 1").select("s", "digest")
    for k in range(1, levels + 1):
        up = nodes.where("n > 1").groupBy("s", F.shiftright("r", BITS).alias("r"), F.ceil(F.col("n") / FAN).alias("n")).agg(
            F.sort_array(F.collect_list(F.struct("r", "digest"))).alias("c"))
        up = up.select("s", "r", "n", F.col("c.digest").alias("children")).withColumn("digest", F.sha2(F.array_join("children", ""), 256))
        nodes = stored(up, f"{name}-{k}")
        records.append(nodes.select("digest", "children").dropDuplicates(["digest"]))
        ends = ends.unionByName(nodes.where("n = 1").select("s", "digest"))
    return records, ends


def build(docs: DataFrame, fields: Sequence[str] = FIELDS, key: str = "doc_id", group: str = "source", claim: Sequence[Column] | None = None) -> Manifest:
    """The manifest of a table. ``claim``: the fields as a second party holds them, in the order of ``fields``; default: the same."""
    spark = docs.sparkSession
    ready(spark)
    own = [docs[f"`{c}`"] for c in fields]
    leaf = leaf_digest(own)
    rows = docs.select(
        docs[f"`{key}`"].alias("k"), docs[f"`{group}`"].cast("string").alias("g"), leaf.alias("leaf"),
        (leaf if claim is None else leaf_digest(claim)).alias("claim"), F.monotonically_increasing_id().alias("u"))
    leaves, groups = _ordered(stored(rows, "merkle-rows"))
    size = groups.agg(F.max("n").alias("n"), F.count("*").alias("c")).first()
    if not size["c"]:
        return Manifest(spark, leaves, groups, [], [], None, 0)
    levels = height(size["n"])
    records, ends = _grown(leaves.select("s", "r", "n", F.col("leaf").alias("digest")), levels, "merkle-records")
    groups = stored(groups.join(ends, "s").select("s", "g", "n", _height(F.col("n"), levels).alias("h"), F.col("digest").alias("subroot")), "merkle-subroots")
    top, last = _grown(
        groups.select(F.lit(0).cast("long").alias("s"), F.col("s").alias("r"), F.lit(size["c"]).alias("n"), F.col("subroot").alias("digest")), height(size["c"]), "merkle-top")
    return Manifest(spark, leaves, groups, records, top, last.first()["digest"], size["c"])


def _segment(children: Column, digit: Column) -> Column:
    """The children left and right of the one that is followed."""
    left = F.array_join(F.slice(children, F.lit(1), digit), "")
    right = F.array_join(F.slice(children, digit + 2, F.lit(FAN)), "")
    return F.struct(left.alias("left"), right.alias("right"))


def _down(front: DataFrame, records: DataFrame, wanted: DataFrame, on: list[str]) -> DataFrame:
    """One height lower: every frontier row's children that some request wants, each with one more segment before its path."""
    kept = [c for c in front.columns if c not in ("q", "digest", "path")]
    below = front.join(records, "digest").select(*kept, "q", "path", "children", F.posexplode("children").alias("d", "child"))
    below = below.select(
        *kept, (F.col("q") * FAN + F.col("d")).alias("q"), F.col("child").alias("digest"), F.concat(F.array(_segment(F.col("children"), F.col("d"))), F.col("path")).alias("path"))
    return below.join(wanted, on, "left_semi")


def prove(manifest: Manifest, requests: DataFrame | None = None) -> DataFrame:
    """(k, leaf, subroot, root, path, folded_root, verified) of the requested leaves: rows with k, claim, s and r, by default all of them.

    ``leaf`` is the digest at which the descent ends, ``path`` its segments from the leaf to the root, ``folded_root`` what the claimed digest folds to.
    A request beyond its group's last rank finds nothing.
    """
    spark = manifest.spark
    asked = (manifest.leaves if requests is None else requests).select("k", "claim", "s", "r")
    if manifest.root is None:
        return spark.createDataFrame([], asked.schema).select("k", *[F.lit("").alias(c) for c in ("leaf", "subroot", "root")], F.array(F.struct(F.lit("").alias("left"), F.lit("").alias("right"))).alias("path"), F.lit("").alias("folded_root"), F.lit(True).alias("verified"))
    places = stored(asked.select("s").distinct(), "merkle-wanted")
    segment = "array<struct<left:string,right:string>>"
    front = spark.createDataFrame([(0, manifest.root)], "q long, digest string").withColumn("path", F.array().cast(segment))
    for t in range(len(manifest.top), 0, -1):
        wanted = places.select(F.shiftright("s", BITS * (t - 1)).alias("q")).distinct()
        front = stored(_down(front, manifest.top[t - 1], wanted, ["q"]), f"merkle-top-front-{t}")
    begun = front.withColumnRenamed("q", "s").join(manifest.groups.select("s", "h"), "s").select("s", F.lit(0).cast("long").alias("q"), "digest", "path", F.col("digest").alias("subroot"), "h")
    begun = stored(begun, "merkle-begun")
    entering = lambda t: begun.where(F.col("h") == t).drop("h")
    levels = len(manifest.records)
    front = entering(levels)
    for t in range(levels, 1, -1):
        wanted = asked.select("s", F.shiftright("r", BITS * (t - 1)).alias("q")).distinct()
        front = stored(_down(front, manifest.records[t - 1], wanted, ["s", "q"]).unionByName(entering(t - 1)), f"merkle-front-{t}")
    alone = begun.where("h = 0").join(asked.where("r = 0"), "s").select("k", "claim", F.col("digest").alias("leaf"), "subroot", "path")
    if levels:
        digit = F.col("r").bitwiseAND(F.lit(FAN - 1)).cast("int")
        asked = asked.withColumn("q", F.shiftright("r", BITS))
        found = front.join(manifest.records[0], "digest").join(asked, ["s", "q"]).where(digit < F.size("children"))
        alone = alone.unionByName(found.select(
            "k", "claim", F.col("children")[digit].alias("leaf"), "subroot", F.concat(F.array(_segment(F.col("children"), digit)), F.col("path")).alias("path")))
    folded = F.aggregate("path", F.col("claim"), lambda acc, x: F.sha2(F.concat(x["left"], acc, x["right"]), 256))
    out = alone.select("k", "leaf", "subroot", F.lit(manifest.root).alias("root"), "path", folded.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def proof_digest(path: Column) -> Column:
    """SHA-256 of all siblings of a path, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda x: F.concat(x["left"], x["right"])), ""), 256)
