"""Token ids as fixed-width bit-packed files with random access.

Every id takes the fewest bits that hold the vocabulary. A file holds blocks of ``BLOCK_IDS`` ids, then a footer with
the block offsets and, for its documents, id, null flag and start; the last 16 bytes locate the footer. A reader unpacks a
whole block by numpy and reaches any id range by reading only the blocks that cover it.

    header   8 bytes magic
    blocks   ceil(n * bits / 8) bytes each, ids little-endian in a little-endian bit stream
    footer   uint32 bits, uint32 block ids, uint64 ids, uint64 blocks, uint64 documents, uint64 offset per block,
             int64 doc_id, uint8 null flag and uint64 start per document
    tail     uint64 footer offset, 8 bytes magic

Documents are range partitioned and sorted by id, so a file is one range and files follow each other in id order.
A task holds one Arrow batch of texts and one block; nothing but one manifest row per file leaves it.
"""

from __future__ import annotations

import array
import itertools
import json
import os
import re
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from riskloom.llm.files import Reader, ready, stored, whole_file
from riskloom.llm.words import LOWER, byte_texts, slices
from riskloom.session import scratch_path

MAGIC = b"RLIDS\x00\x01\n"
BLOCK_IDS = 1 << 16
#: Chunks whose ids a worker remembers.
CACHE = 900_000
_HEAD = struct.Struct("<IIQQQ")
#: ASCII marks at the end of a chunk; an apostrophe may begin a contraction and is none.
_TAIL = re.compile(rb"[!-&(-/:-@\[-`{-~]+\Z")


def bits_for(vocabulary: int) -> int:
    """Fewest bits that hold the ids 0 to ``vocabulary - 1``."""
    return max(1, (int(vocabulary) - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    grid = (ids.astype(np.uint64)[:, None] >> np.arange(bits, dtype=np.uint64)) & np.uint64(1)
    return np.packbits(grid.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack(data: bytes, bits: int, count: int) -> np.ndarray:
    if bits in (8, 16, 32):
        return np.frombuffer(data, dtype=f"<u{bits // 8}", count=count).astype(np.uint32)
    grid = np.unpackbits(np.frombuffer(data, dtype=np.uint8), bitorder="little", count=count * bits).reshape(count, bits)
    return (grid.astype(np.uint64) << np.arange(bits, dtype=np.uint64)).sum(axis=1).astype(np.uint32)


class Encoder:
    """Ids of whole texts, by the library, with the ids of repeated chunks remembered.

    A text is cut at spaces and line feeds. The tokenizer's split pattern never joins text across white space
    and its normalizer lowers letters and maps each white-space run to one space that no token holds, so the ids of the text are those of
    its chunks in order, whatever the case of A-Z. That is a
    property of the vocabulary file, which :func:`splits_at_space` checks; for another the whole text is encoded.
    """

    def __init__(self, path: str, end_id: int) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tool = Tokenizer.from_file(path)
        self.end = array.array("I", [end_id]).tobytes()
        self.by_chunk = splits_at_space(path)
        self.marks = [x.content.encode().translate(LOWER) for x in self.tool.get_added_tokens_decoder().values()]
        self.known: dict[bytes, bytes] = {b"": b""}

    def _ids(self, texts: list[bytes]) -> list[bytes]:
        fast = getattr(self.tool, "encode_batch_fast", self.tool.encode_batch)
        return [array.array("I", x.ids).tobytes() for x in fast([t.decode() for t in texts], add_special_tokens=False)]

    def _learn(self, chunks: set[bytes]) -> None:
        """Ids of new chunks.

        Marks behind a letter or digit are a chunk of their own, since no piece holds both. Words of a-z pass the normalizer and the
        splitting steps as they are, so their ids come from the library's merge model alone. A chunk with an added token, which holds
        both and skips the model, is encoded whole by the library.
        """
        known, tails = self.known, {}
        whole = {c for c in chunks if any(m in c.translate(LOWER) for m in self.marks)}
        for c in chunks:
            if not c.isalpha() and c not in whole:
                found = _TAIL.search(c)
                if found and found.start() and c[: found.start()].decode().lower()[-1].isalnum():
                    tails[c] = (c[: found.start()], found[0])
        new = {c for c in chunks if c not in tails}.union(*tails.values())
        word, rest = self.tool.model.tokenize, []
        for c in new:
            if c in known:
                continue
            if c.isalpha() and c.islower() and c not in whole:
                known[c] = array.array("I", [x.id for x in word(c.decode())]).tobytes()
            else:
                rest.append(c)
        for a in range(0, len(rest), 20_000):
            known.update(zip(rest[a : a + 20_000], self._ids(rest[a : a + 20_000]), strict=True))
        known.update((c, known[a] + known[b]) for c, (a, b) in tails.items())

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """32-bit ids of each UTF-8 text with the end id behind, in the machine's byte order."""
        if not self.by_chunk:
            return [x + self.end for x in self._ids(texts)]
        if len(self.known) > CACHE:
            self.known = {b"": b""}
        get, work, new = self.known.get, [], set()
        for t in texts:
            low = t.translate(LOWER)
            chunks = (t if any(m in low for m in self.marks) else low).replace(b"\n", b" ").split(b" ")
            ids = list(map(get, chunks))
            holes = [(k, chunks[k]) for k, x in enumerate(ids) if x is None]
            new.update(c for _, c in holes)
            work.append((ids, holes))
        self._learn(new)
        for ids, holes in work:
            for k, c in holes:
                ids[k] = self.known[c]
            ids.append(self.end)
        return [b"".join(ids) for ids, _ in work]


def splits_at_space(path: str) -> bool:
    """Whether the file describes a tokenizer whose words end at white space, which itself gives no token."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
    first = steps[0] if steps else {}
    pattern = first.get("pattern", {}).get("Regex", "")
    parts = (spec.get("normalizer") or {}).get("normalizers", [])
    plain = [p.get("type") for p in parts] == ["NFC", "Replace", "Lowercase"]
    inverse = first.get("type") == "Split" and first.get("behavior") == "Removed" and first.get("invert")
    bare = pattern.endswith(r"[^\s\p{L}\p{N}]+") and " " not in pattern and spec.get("post_processor") is None
    added = all(not x["content"].count(" ") and not x["lstrip"] and not x["rstrip"] for x in spec.get("added_tokens", []))
    return bool(plain and inverse and bare and added)


_ENCODERS: dict[tuple[str, int], Encoder] = {}


def encoder(path: str, end_id: int) -> Encoder:
    """One encoder for each worker process."""
    if (path, end_id) not in _ENCODERS:
        _ENCODERS[path, end_id] = Encoder(path, end_id)
    return _ENCODERS[path, end_id]


class FileWriter:
    """Appends documents to one open file."""

    def __init__(self, out, bits: int) -> None:
        self.out, self.bits, self.offset, self.total = out, bits, len(MAGIC), 0
        self.blocks: list[int] = []
        self.ids: list[int] = []
        self.null: list[bool] = []
        self.start: list[int] = []
        self.rest: list[np.ndarray] = []
        self.waiting = 0
        out.write(MAGIC)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        if len(ids) and int(ids.max()) >> self.bits:
            raise ValueError(f"an id does not fit {self.bits} bits")
        self.ids.append(doc_id or 0)
        self.null.append(doc_id is None)
        self.start.append(self.total)
        self.total += len(ids)
        self.rest.append(ids)
        self.waiting += len(ids)
        if self.waiting >= BLOCK_IDS:
            self._flush(False)

    def _flush(self, last: bool) -> None:
        ids = np.concatenate([np.zeros(0, "<u4"), *self.rest])
        stop = len(ids) if last else len(ids) - len(ids) % BLOCK_IDS
        for a in range(0, stop, BLOCK_IDS):
            data = pack(ids[a : min(stop, a + BLOCK_IDS)], self.bits)
            self.blocks.append(self.offset)
            self.out.write(data)
            self.offset += len(data)
        self.rest = [ids[stop:]]
        self.waiting = len(ids) - stop

    def close(self) -> None:
        self._flush(True)
        self.out.write(_HEAD.pack(self.bits, BLOCK_IDS, self.total, len(self.blocks), len(self.ids)))
        for values, kind in ((self.blocks, "<u8"), (self.ids, "<i8"), (self.null, "u1"), (self.start, "<u8")):
            self.out.write(np.array(values, dtype=kind).tobytes())
        self.out.write(struct.pack("<Q", self.offset) + MAGIC)


@dataclass
class TokenFile:
    """A file opened for random access: ``ids(start, count)`` reads only the blocks that cover the range."""

    path: str
    reader: Reader

    def __post_init__(self) -> None:
        size = self.reader.size(self.path)
        tail = self.reader.read(self.path, size - 16, 16)
        if tail[8:] != MAGIC:
            raise ValueError(f"{self.path} is not a token file")
        foot = struct.unpack("<Q", tail[:8])[0]
        data = self.reader.read(self.path, foot, size - 16 - foot)
        self.bits, self.block_ids, self.total, blocks, docs = _HEAD.unpack_from(data)
        at = _HEAD.size
        self.offsets = np.frombuffer(data, "<u8", blocks, at)
        self.doc_ids = np.frombuffer(data, "<i8", docs, at + 8 * blocks)
        self.null = np.frombuffer(data, "u1", docs, at + 8 * (blocks + docs)).astype(bool)
        self.starts = np.frombuffer(data, "<u8", docs, at + 8 * (blocks + docs) + docs).astype(np.int64)
        self._last: tuple[int, np.ndarray] = (-1, np.zeros(0, np.uint32))

    def block(self, k: int) -> np.ndarray:
        if self._last[0] != k:
            n = min(self.block_ids, self.total - k * self.block_ids)
            self._last = (k, unpack(self.reader.read(self.path, int(self.offsets[k]), (n * self.bits + 7) // 8), self.bits, n))
        return self._last[1]

    def ids(self, start: int, count: int) -> Iterator[np.ndarray]:
        """The ids from ``start`` on, in pieces of a block at most."""
        stop = start + count
        while start < stop:
            k, a = divmod(start, self.block_ids)
            piece = self.block(k)[a : a + stop - start]
            yield piece
            start += len(piece)


def write_tokens(
    docs: DataFrame, folder: str, tokenizer: str, end_id: int, vocabulary: int, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Encode every whole text and write the files to ``folder``; returns the stored manifest, one row per file.

    Each document ends with ``end_id``. A null or empty text gives that id alone; a null id sorts first; rows with
    equal ids stay side by side, each with its own range; extra columns are left out; an empty table writes no file.
    """
    ready(docs.sparkSession)
    bits = bits_for(max(vocabulary, end_id + 1))
    rows = docs.select(docs[f"`{doc_id}`"].cast("long").alias("i"), docs[f"`{text}`"].cast("string").alias("t"))
    rows = rows.repartitionByRange("i").sortWithinPartitions("i")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        tool = encoder(tokenizer, end_id)
        parts = (p for b in batches for p in slices(b, "t"))
        first = next(parts, None)
        if first is None:
            return
        name = f"ids-{part:07d}.bin"
        with whole_file(folder, name) as out:
            writer = FileWriter(out, bits)
            for batch in itertools.chain([first], parts):
                _append(writer, tool, batch)
            writer.close()
        yield pa.RecordBatch.from_pydict({
            "part": pa.array([part], pa.int64()), "path": [f"{folder}/{name}"],
            "ids": pa.array([writer.total], pa.int64()), "documents": pa.array([len(writer.ids)], pa.int64()),
        })

    return stored(rows.mapInArrow(run, "part long, path string, ids long, documents long"), "manifest", folder)


def _append(writer: FileWriter, tool: Encoder, batch: pa.RecordBatch) -> None:
    for i, data in zip(batch.column("i").to_pylist(), tool.encode(byte_texts(batch.column("t"))), strict=True):
        writer.add(i, np.frombuffer(data, dtype=np.uintc))


def read_tokens(manifest: DataFrame, ids: bool = False) -> DataFrame:
    """One row per document from the files: doc_id, start, n_tokens, ids_crc32 and, if wanted, the ids themselves.

    ``start`` counts the ids of all documents before it, over all files; the running sum takes one row per file.
    """
    files = manifest.withColumn("base", F.sum("ids").over(Window.orderBy("part")) - F.col("ids"))
    files = files.repartition(max(1, manifest.count()), "path").select("path", "base")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader()
        for batch in batches:
            for path, base in zip(batch.column("path").to_pylist(), batch.column("base").to_pylist(), strict=True):
                file = TokenFile(path, reader)
                lengths = np.diff(np.append(file.starts, file.total))
                for a in range(0, len(lengths), 2_000):
                    crc, kept = [], []
                    for start, n in zip(file.starts[a : a + 2_000].tolist(), lengths[a : a + 2_000].tolist(), strict=True):
                        c, pieces = 0, []
                        for piece in file.ids(start, n):
                            c = zlib.crc32(piece.astype("<u4").tobytes(), c)
                            if ids:
                                pieces.append(piece)
                        crc.append(c)
                        kept.append(np.concatenate(pieces).astype(np.int64) if pieces else np.zeros(0, np.int64))
                    columns = {
                        "doc_id": pa.array(file.doc_ids[a : a + 2_000], mask=file.null[a : a + 2_000]),
                        "start": pa.array(file.starts[a : a + 2_000] + base, pa.int64()),
                        "n_tokens": pa.array(lengths[a : a + 2_000], pa.int64()), "ids_crc32": pa.array(crc, pa.int64()),
                    }
                    if ids:
                        columns["ids"] = pa.array(kept, pa.list_(pa.int64()))
                    yield pa.RecordBatch.from_pydict(columns)
        reader.close()

    return files.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * ids)


def encode_and_read(docs: DataFrame, tokenizer: str, end_id: int, vocabulary: int) -> DataFrame:
    """Write ``docs`` to a new folder of the shared place and read the files back."""
    folder = scratch_path(docs.sparkSession, "tokens")
    return read_tokens(write_tokens(docs, folder, tokenizer, end_id, vocabulary))
