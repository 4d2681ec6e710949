"""Line dedup by two Bloom filters.

1. Every task keeps two Bloom filters of the same bounded size over the line keys of its documents: seen once, seen twice. They are merged
   piece by piece: ``once = a.once | b.once``, ``twice = a.twice | b.twice | (a.once & b.once)``, which is associative and
   never forgets a key of two documents.
2. Only keys that the merged second filter holds are suspected repeats; they alone shuffle, as 128-bit hashes, for the exact
   number of documents and the document that keeps the line.
3. The lines to drop, few next to the text, go back to their documents by id.

The filter size follows the text size up to ``MAX_BITS``, a documented bound of what is broadcast. A fuller filter suspects more
lines and shuffles more; it changes no result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from riskloom.functions.lookup import lookup
from riskloom.llm.files import packed, stored
from riskloom.llm.words import LOWER, STRIP, byte_texts, slices

MIN_CHARS, MIN_DOCS = 40, 5
#: Bits of one filter: at least, and at most (16 MB).
MIN_BITS, MAX_BITS = 1 << 17, 1 << 27
PROBES = 2
_PIECE = 1 << 16


def line_keys(text: bytes, min_chars: int) -> list[tuple[int, bytes]]:
    """(line number, key) of the lines whose key is long enough to count."""
    out = []
    for k, line in enumerate(text.translate(LOWER).split(b"\n")):
        line = line.strip(STRIP)
        if len(line) >= min_chars and (line.isascii() or len(line.decode("utf-8", "replace")) >= min_chars):
            out.append((k, line))
    return out


class Filter:
    """One Bloom filter over 64-bit hashes."""

    def __init__(self, bits: int, data: np.ndarray | None = None) -> None:
        self.mask = np.uint64(bits - 1)
        self.data = np.zeros(bits // 8, dtype=np.uint8) if data is None else data

    def _places(self, h: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        step = (h >> np.uint64(32)) | np.uint64(1)
        for k in range(PROBES):
            at = (h + np.uint64(k) * step) & self.mask
            yield (at >> np.uint64(3)).astype(np.int64), (np.uint64(1) << (at & np.uint64(7))).astype(np.uint8)

    def add(self, h: np.ndarray) -> None:
        for byte, bit in self._places(h):
            np.bitwise_or.at(self.data, byte, bit)

    def has(self, h: np.ndarray) -> np.ndarray:
        found = np.ones(len(h), dtype=bool)
        for byte, bit in self._places(h):
            found &= (self.data[byte] & bit) > 0
        return found


class Pair:
    """Once-seen and twice-seen filters of one task."""

    def __init__(self, bits: int) -> None:
        self.once, self.twice = Filter(bits), Filter(bits)

    def add(self, h: np.ndarray) -> None:
        """Keys of some documents, each key once per document."""
        value, times = np.unique(h, return_counts=True)
        self.twice.add(value[(times > 1) | self.once.has(value)])
        self.once.add(value)


def _bits(docs: DataFrame, text: str, per_line: int = 16, line_bytes: int = 64) -> int:
    total = docs.agg(F.sum(F.octet_length(docs[f"`{text}`"].cast("string"))).alias("b")).first()["b"] or 0
    return min(MAX_BITS, max(MIN_BITS, 1 << int(total * per_line // line_bytes).bit_length()))


def _twice(rows: DataFrame, bits: int, min_chars: int) -> np.ndarray:
    """The merged second filter; its size is the bound of what reaches the driver."""

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Pair(bits)
        for batch in batches:
            for part in slices(batch, "t"):
                keys = [xxhash.xxh3_64_intdigest(k) for t in byte_texts(part.column("t")) for k in {k for _, k in line_keys(t, min_chars)}]
                own.add(np.array(keys, dtype=np.uint64))
        once, twice = own.once.data.reshape(-1, min(_PIECE, bits // 8)), own.twice.data.reshape(-1, min(_PIECE, bits // 8))
        for k in range(0, len(once), 32):
            yield pa.RecordBatch.from_pydict({
                "piece": pa.array(range(k, min(k + 32, len(once))), pa.int32()),
                "once": pa.array([x.tobytes() for x in once[k : k + 32]], pa.binary()),
                "twice": pa.array([x.tobytes() for x in twice[k : k + 32]], pa.binary()),
            })

    def merge(table: pa.Table) -> pa.Table:
        once = twice = None
        for a, b in zip(table.column("once"), table.column("twice"), strict=True):
            x, y = np.frombuffer(a.as_py(), np.uint8), np.frombuffer(b.as_py(), np.uint8)
            once, twice = (x, y) if once is None else (once | x, twice | y | (once & x))
        return pa.table({"piece": table.column("piece")[:1], "twice": pa.array([twice.tobytes()], pa.binary())})

    parts = rows.mapInArrow(fill, "piece int, once binary, twice binary")
    merged = parts.groupBy("piece").applyInArrow(merge, "piece int, twice binary").toArrow().sort_by("piece")
    data = b"".join(merged.column("twice").to_pylist())
    return np.frombuffer(data, np.uint8) if data else np.zeros(bits // 8, np.uint8)


def repeated_lines(
    docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, doc_id: str = "doc_id", text: str = "text", bits: int | None = None
) -> DataFrame:
    """(doc, text_hash, lines): per id and text the numbers, from 0, of the lines that another document keeps.

    A line's key is the line without space and the controls 9 to 13 at both ends, A-Z in lower case. Keys of ``min_chars`` code points or more in
    ``min_docs`` different ids or more stay in the largest id alone.
    """
    words = docs[f"`{text}`"].cast("string")
    rows = docs.select(docs[f"`{doc_id}`"].cast("long").alias("i"), words.alias("t"), F.xxhash64(F.coalesce(words, F.lit(""))).alias("h"))
    bits = bits or _bits(docs, text)
    twice = docs.sparkSession.sparkContext.broadcast(_twice(rows, bits, min_chars))

    def suspects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Filter(bits, twice.value)
        for batch in batches:
            for part in slices(batch, "t"):
                owner, number, keys = [], [], []
                for row, t in enumerate(byte_texts(part.column("t"))):
                    for k, key in line_keys(t, min_chars):
                        owner.append(row)
                        number.append(k)
                        keys.append(key)
                if not keys:
                    continue
                hit = np.flatnonzero(known.has(np.array([xxhash.xxh3_64_intdigest(k) for k in keys], dtype=np.uint64))).tolist()
                rows_of = pa.array([owner[k] for k in hit], pa.int64())
                yield pa.RecordBatch.from_pydict({
                    "doc": part.column("i").take(rows_of), "text_hash": part.column("h").take(rows_of), "line": pa.array([number[k] for k in hit], pa.int32()),
                    "key": pa.array([xxhash.xxh3_128_digest(keys[k]) for k in hit], pa.binary()),
                })

    found = stored(rows.mapInArrow(suspects, "doc long, text_hash long, line int, key binary"), "suspects")
    each = found.groupBy("key", "doc").agg(F.lit(1).alias("one"))
    often = each.groupBy("key").agg(F.count("*").alias("documents"), F.max("doc").alias("keeper")).where(F.col("documents") >= min_docs)
    # A key that a third of all documents hold is broadcast or salted, never one task.
    kept = lookup(found, stored(often, "often"), "key", ["documents", "keeper"], weight="documents")
    lost = kept.where(F.col("documents").isNotNull() & ~F.col("doc").eqNullSafe(F.col("keeper")))
    return lost.groupBy("doc", "text_hash").agg(F.sort_array(F.collect_set("line")).alias("lines"))


def drop_repeated_lines(
    docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, doc_id: str = "doc_id", text: str = "text", bits: int | None = None
) -> DataFrame:
    """``docs`` with ``_kept`` (the text that stays), ``_n_lines`` and ``_n_dropped``.

    A null or empty text is one empty line and stays empty. Rows with one id count as one document; equal rows lose the same lines, and
    different texts under one id are told apart by their hash. Null ids count as one document, which never keeps a
    line that an id holds. All columns stay; an empty table gives an empty result.
    """
    names, row = packed(docs, "_kept", "_n_lines", "_n_dropped")
    value = F.coalesce(docs[f"`{text}`"].cast("string"), F.lit(""))
    keyed = docs.select(row.alias("_row"), docs[f"`{doc_id}`"].cast("long").alias("doc_id"), value.alias("_text"))
    lost = repeated_lines(keyed.select("doc_id", F.col("_text").alias("text")), min_chars, min_docs, bits=bits)
    lost = lost.select(F.col("doc").alias("_doc"), F.col("text_hash").alias("_hash"), F.col("lines").alias("_lines"))
    same = keyed["doc_id"].eqNullSafe(lost["_doc"]) & (F.xxhash64(keyed["_text"]) == lost["_hash"])
    joined = keyed.join(lost, same, "left")
    parts = F.split("_text", "\n", -1)
    keep = F.when(F.col("_lines").isNull(), F.col("_text")).otherwise(
        F.array_join(F.filter(parts, lambda _, k: ~F.array_contains("_lines", k)), "\n"))
    return joined.select(
        *[F.col("_row").getField(c).alias(c) for c in names], keep.alias("_kept"), F.size(parts).cast("long").alias("_n_lines"),
        F.coalesce(F.size("_lines"), F.lit(0)).cast("long").alias("_n_dropped"),
    )
