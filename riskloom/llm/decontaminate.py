"""Benchmark decontamination: MinHash containment search in size classes, confirmed on exact shingles.

A short item inside a long document has a tiny Jaccard similarity, so the search asks for containment: the share of the
item's shingles that the document holds. An item keeps the bottom-k MinHash sketch of its shingles, where k depends on
its size class: ``k = n - ceil(threshold * n) + 1``. A document that holds the wanted share lacks fewer than k
shingles, so it holds at least one of the sketch: the sketch loses no pair. Items are partitioned by size (powers of two) and a document
probes only the classes whose smallest item it is long enough to contain.

The items are the stated query set. They are read in blocks of bounded size, each broadcast as sorted arrays; documents never shuffle.
Pairs that the hashes let through are confirmed on the words themselves.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from riskloom.llm.files import packed, ready, stored
from riskloom.llm.words import LOWER, Words, byte_texts, slices

WORDS = 5
THRESHOLD = 0.75
#: Shingles of items in one broadcast block (24 bytes each) and text bytes of its items.
BLOCK_SHINGLES = 1_000_000
BLOCK_BYTES = 32 << 20
#: Keys of contaminated rows that may be broadcast (8 bytes each); beyond, the join shuffles.
BROADCAST_KEYS = 1_000_000

_SPLIT = bytes(32 if b in (9, 10, 11, 12, 13) else b for b in LOWER)


def _words(text: bytes) -> list[bytes]:
    return [w for w in text.translate(_SPLIT).split(b" ") if w]


def _exact(words: list[bytes], size: int) -> set[tuple[bytes, ...]]:
    return {tuple(words[k : k + size]) for k in range(len(words) - size + 1)}


class ItemIndex:
    """Sketches of one block of items, grouped by size class, and their full shingle hashes."""

    def __init__(self, ids: list[int | None], texts: list[bytes], size: int, threshold: float) -> None:
        self.ids, self.texts, self.size, self.threshold = ids, texts, size, threshold
        words = Words(texts)
        hashes, at = words.shingles(size)
        count = np.diff(words.first)
        self.sets = [np.unique(hashes[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]
        self.need = np.array([math.ceil(threshold * len(s) - 1e-9) for s in self.sets], dtype=np.int64)
        #: Words in one shingle of each item: fewer only where the item itself is shorter.
        self.run = np.minimum(count, size)
        self.classes: list[tuple[int, int, np.ndarray, np.ndarray]] = []
        by_class: dict[tuple[int, int], list[int]] = {}
        for k, s in enumerate(self.sets):
            if len(s):
                by_class.setdefault((int(self.run[k]), len(s).bit_length()), []).append(k)
        for (run, _), members in sorted(by_class.items()):
            keys = [self.sets[k][: len(self.sets[k]) - self.need[k] + 1] for k in members]
            owner = np.repeat(members, [len(x) for x in keys])
            flat = np.concatenate(keys)
            order = np.argsort(flat, kind="stable")
            self.classes.append((run, int(min(self.need[k] for k in members)), flat[order], owner[order]))
        self.runs = sorted({c[0] for c in self.classes})
        self.keys = {run: np.unique(np.concatenate([c[2] for c in self.classes if c[0] == run])) for run in self.runs}
        #: One bit for each sketch key, by its low bits: most shingles of a document stop here.
        self.gate = {}
        for run in self.runs:
            self.gate[run] = np.zeros(1 << 20, dtype=bool)
            self.gate[run][self.keys[run] & np.uint64((1 << 20) - 1)] = True

    def search(self, texts: list[bytes]) -> Iterator[tuple[int, int, int, int]]:
        """(text, item, shared shingles, shingles of the item) for every contained item."""
        words = Words(texts)
        count = np.diff(words.first)
        for run in self.runs:
            # A text with fewer words than the run holds no such shingle; its own short sequence has another length.
            hashes, at = words.shingles(run)
            short = count < run
            passed = np.flatnonzero(self.gate[run][hashes & np.uint64((1 << 20) - 1)])
            keys = self.keys[run]
            place = np.minimum(np.searchsorted(keys, hashes[passed]), len(keys) - 1)
            passed = passed[keys[place] == hashes[passed]]
            owner = np.searchsorted(at, passed, side="right") - 1
            for doc in np.unique(owner[~short[owner]]).tolist():
                own = hashes[passed[np.searchsorted(owner, doc) : np.searchsorted(owner, doc, "right")]]
                yield from self._confirm(doc, texts[doc], own, hashes[at[doc] : at[doc + 1]], run)

    def _confirm(self, doc: int, text: bytes, own: np.ndarray, every: np.ndarray, run: int) -> Iterator[tuple[int, int, int, int]]:
        found: set[int] = set()
        for r, least, keys, owner in self.classes:
            if r == run and len(every) >= least:
                a, b = np.searchsorted(keys, own), np.searchsorted(keys, own, side="right")
                for x, y in zip(a[b > a].tolist(), b[b > a].tolist(), strict=True):
                    found.update(owner[x:y].tolist())
        if not found:
            return
        every = np.unique(every)
        exact: set[tuple[bytes, ...]] | None = None
        for item in sorted(found):
            if np.isin(self.sets[item], every, assume_unique=True).sum() < self.need[item]:
                continue
            if exact is None:
                exact = _exact(_words(text), run)
            wanted = _exact(_words(self.texts[item]), run)
            shared = len(wanted & exact)
            if shared >= math.ceil(self.threshold * len(wanted) - 1e-9):
                yield doc, item, shared, len(wanted)


def _blocks(items: DataFrame, item_id: str, text: str) -> Iterator[tuple[list[int | None], list[bytes]]]:
    """Distinct item rows in blocks of bounded text bytes and shingles; one block at a time reaches the driver."""
    rows = items.select(items[f"`{item_id}`"].cast("long").alias("i"), items[f"`{text}`"].cast("string").alias("t"))
    rows = rows.where(F.length(F.trim(F.coalesce("t", F.lit("")))) > 0).distinct()
    bound = rows.agg(F.sum(F.octet_length("t")).alias("b")).first()["b"] or 0
    # A word takes two bytes at least, a space included, so the bytes bound the shingles too.
    parts = max(1, math.ceil(1.5 * bound / min(BLOCK_BYTES, 2 * BLOCK_SHINGLES)))
    if parts > 1:
        rows = stored(rows, "items")
    for k in range(parts):
        block = rows.where(F.pmod(F.xxhash64("i", "t"), F.lit(parts)) == k).orderBy("i", "t").toArrow()
        if block.num_rows:
            yield block.column("i").to_pylist(), byte_texts(block.column("t"))


def contained_items(
    docs: DataFrame,
    items: DataFrame,
    size: int = WORDS,
    threshold: float = THRESHOLD,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """One row per document row and contained item: doc_id, item_id, n_shared, n_item, containment.

    Words are compared with A-Z in lower case. An item shorter than ``size`` words counts as its whole sequence, which must
    occur as such. Null and empty texts hold nothing and, as items, are never found; equal item rows
    count once; a document row that occurs twice is reported twice; null ids are carried as null. Extra columns do not
    matter; an empty table on either side gives an empty result.
    """
    spark = docs.sparkSession
    ready(spark)
    rows = docs.select(docs[f"`{doc_id}`"].cast("long").alias("i"), docs[f"`{text}`"].cast("string").alias("t"))
    schema = "doc_id long, item_id long, n_shared long, n_item long, containment double"
    out = None
    for ids, texts in _blocks(items, item_id, item_text):
        shared = spark.sparkContext.broadcast((ids, texts))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = ItemIndex(*shared.value, size, threshold)
            for batch in batches:
                for part in slices(batch, "t"):
                    found = [*index.search(byte_texts(part.column("t")))]
                    if found:
                        doc, item, n, whole = (list(x) for x in zip(*found, strict=True))
                        yield pa.RecordBatch.from_pydict({
                            "doc_id": part.column("i").take(pa.array(doc)), "item_id": pa.array([index.ids[k] for k in item], pa.int64()),
                            "n_shared": pa.array(n, pa.int64()), "n_item": pa.array(whole, pa.int64()),
                            "containment": pa.array([a / b for a, b in zip(n, whole, strict=True)], pa.float64()),
                        })

        part = rows.mapInArrow(run, schema)
        out = part if out is None else out.unionAll(part)
    return spark.createDataFrame([], schema) if out is None else out


def without_contaminated(docs: DataFrame, items: DataFrame, folder_name: str = "contained", **options) -> DataFrame:
    """Rows of ``docs`` that contain no item, with all columns.

    Rows are matched back by id and, because ids may repeat or be null, by the text's hash. The pairs are few next to
    the documents; they are written once.
    """
    doc_id, text = options.get("doc_id", "doc_id"), options.get("text", "text")
    names, row = packed(docs)
    keyed = docs.select(row.alias("row"), F.xxhash64(docs[f"`{doc_id}`"], docs[f"`{text}`"]).alias("row_key"), docs[f"`{text}`"].alias("text"))
    found = contained_items(keyed, items, **(options | {"doc_id": "row_key", "text": "text"}))
    bad = stored(found.select(F.col("doc_id").alias("row_key")).distinct(), folder_name)
    bad = F.broadcast(bad) if bad.count() <= BROADCAST_KEYS else bad
    return keyed.join(bad, "row_key", "left_anti").select(*[F.col("row").getField(c).alias(c) for c in names])
