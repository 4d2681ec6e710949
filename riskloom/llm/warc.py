"""WARC archives of pages with a two-level capture index.

Archives hold one gzip member per record, so a record is one range read. A payload that an earlier page (smaller id) holds already,
and that has ``MIN_REVISIT`` bytes or more, becomes a revisit record that names its response by page id and digest.

The index sorts captures by reversed-host key (``org,example)/path``), then page id. Sorted lines are
cut into compressed blocks of ``BLOCK_LINES``; a sparse directory keeps the first and last key, place and size of every block, for each index
file at its end and for all in one table. A look-up binary-searches the directory, reads one range per block that can hold the key,
binary-searches its lines, and reads the records' ranges.

Payloads are compared by digest; only (page id, digest) rows are grouped, in partial sums, so a payload that a third of all pages share
is no burden. Archives are written once per task, whole or not at all; blocks of captures are read by many tasks.
"""

from __future__ import annotations

import bisect
import gzip
import hashlib
import json
import struct
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from riskloom.llm.files import Reader, stored, whole_file
from riskloom.llm.words import slices

MIN_REVISIT = 100
BLOCK_LINES = 512
LEVEL = 3
DATE = "2024-01-01T00:00:00Z"


def reversed_host(url: Column) -> Column:
    """Sort key of a URL: host labels in reverse order, then port, path and query; scheme, user and fragment go.

    ``https://m.example.org:80/a?b#c`` gives ``org,example,m:80)/a?b``. Host letters are lowered. A null URL has an empty key.
    """
    rest = F.regexp_replace(F.coalesce(url.cast("string"), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://|#.*$", "")
    host = F.regexp_extract(rest, r"^([^/?]*)", 1)
    tail = F.substring(rest, F.length(host) + F.lit(1), F.length(rest))
    host = F.lower(F.regexp_replace(host, "^.*@", ""))
    name, port = F.regexp_extract(host, r"^([^:]*)", 1), F.regexp_extract(host, r"(:.*)$", 1)
    return F.when(rest == "", F.lit("")).otherwise(F.concat(F.array_join(F.reverse(F.split(name, r"\.")), ","), port, F.lit(")"), tail))


def plan_records(pages: DataFrame, page_id: str, url: str, html: str) -> DataFrame:
    """Pages with key, digest, size and, for revisits, the page id they refer to."""
    body = F.encode(F.coalesce(pages[f"`{html}`"].cast("string"), F.lit("")), "UTF-8")
    rows = pages.select(
        pages[f"`{page_id}`"].cast("long").alias("i"), pages[f"`{url}`"].cast("string").alias("u"), body.alias("body"),
        reversed_host(pages[f"`{url}`"]).alias("k"), F.sha2(body, 256).alias("d"), F.octet_length(body).cast("long").alias("n"),
    )
    held = rows.where(F.col("n") >= MIN_REVISIT).groupBy("d").agg(F.min("i").alias("first"), F.count("*").alias("copies")).where("copies > 1")
    copies = rows.select("i", "d", "n").where(F.col("n") >= MIN_REVISIT).join(held, "d").where(F.col("first").isNotNull() & ~F.col("i").eqNullSafe(F.col("first")))
    # One id may repeat with other payloads: the digest tells them apart.
    refers = stored(copies.select(F.col("i").alias("ri"), F.col("d").alias("rd"), F.col("first").alias("refers")).distinct(), "revisits")
    return rows.join(refers, rows["i"].eqNullSafe(refers["ri"]) & (rows["d"] == refers["rd"]), "left").select("i", "u", "k", "body", "d", "n", "refers")


def record(page_id: int | None, url: str | None, body: bytes, digest: str, refers: int | None) -> bytes:
    """One WARC record: a response with its payload, or a revisit with none."""
    kind = "response" if refers is None else "revisit"
    head = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Date: {DATE}",
        "WARC-Target-URI: " + json.dumps(url)[1:-1] if url is not None else "WARC-Target-URI-Missing: 1",
        f"WARC-Payload-Digest: sha256:{digest}", f"WARC-Payload-Length: {len(body)}",
    ]
    if refers is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers}>"]
        body = b""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(http) + len(body)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + http + body + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """The fields and the payload of one record; a response whose payload does not match its digest raises."""
    head, _, block = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = block[: int(fields["Content-Length"])]
    body = block.partition(b"\r\n\r\n")[2]
    name = lambda v: int(v) if (v := v[len("<urn:page:") : -1]) else None
    out = {
        "page_id": name(fields["WARC-Record-ID"]), "payload_bytes": int(fields["WARC-Payload-Length"]),
        "payload_digest": fields["WARC-Payload-Digest"].removeprefix("sha256:"), "record_type": fields["WARC-Type"],
        "refers_to": name(fields["WARC-Refers-To"]) if "WARC-Refers-To" in fields else None, "payload": body,
        "url": json.loads(f'"{fields["WARC-Target-URI"]}"') if "WARC-Target-URI" in fields else None,
    }
    if out["record_type"] == "response" and (len(body) != out["payload_bytes"] or hashlib.sha256(body).hexdigest() != out["payload_digest"]):
        raise ValueError(f"page {out['page_id']}: the payload does not match its digest")
    return out


def write_archives(pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Write ``folder/pages-*.warc.gz``; returns the stored captures: key, page id, file, offset, length.

    A null payload is empty; a null URL or id is kept as missing. Of equal payloads of ``MIN_REVISIT`` bytes or more the smallest id is the response; rows that share
    that id and payload are all responses, and so are null ids if no id holds the payload. Extra columns are
    left out; an empty table writes no file.
    """
    rows = plan_records(pages, page_id, url, html)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = (p for b in batches for p in slices(b, "body"))
        first = next(parts, None)
        if first is None:
            return
        name = f"pages-{TaskContext.get().partitionId():07d}.warc.gz"
        with whole_file(folder, name) as out:
            offset, part = 0, first
            while part is not None:
                at, length = [], []
                for row in part.to_pylist():
                    data = gzip.compress(record(row["i"], row["u"], row["body"], row["d"], row["refers"]), LEVEL, mtime=0)
                    out.write(data)
                    at.append(offset)
                    length.append(len(data))
                    offset += len(data)
                yield pa.RecordBatch.from_pydict({
                    "key": part.column("k"), "page_id": part.column("i"), "file": [name] * len(at), "offset": pa.array(at, pa.int64()), "length": pa.array(length, pa.int64()),
                })
                part = next(parts, None)

    return stored(rows.mapInArrow(run, "key string, page_id long, file string, offset long, length long"), "captures", folder)


def write_index(captures: DataFrame, folder: str) -> DataFrame:
    """Sort captures by (key, page id) into compressed blocks; returns the stored directory, one row per block.

    An index file ends with its own directory, compressed, and that directory's length in eight bytes.
    """
    rows = captures.repartitionByRange("key", "page_id", "file", "offset").sortWithinPartitions("key", "page_id", "file", "offset")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lines = (r for b in batches for r in b.to_pylist())
        line = next(lines, None)
        if line is None:
            return
        part = TaskContext.get().partitionId()
        name, offset, entries = f"index-{part:07d}.gz", 0, []
        with whole_file(folder, name) as out:
            while line is not None:
                block = []
                while line is not None and len(block) < BLOCK_LINES:
                    block.append([line["key"], line["page_id"], line["file"], line["offset"], line["length"]])
                    line = next(lines, None)
                data = gzip.compress("\n".join(json.dumps(x, ensure_ascii=False) for x in block).encode(), LEVEL, mtime=0)
                out.write(data)
                entries.append((part, block[0][0], block[-1][0], name, offset, len(data)))
                offset += len(data)
            foot = gzip.compress(json.dumps([x[1:3] + x[4:] for x in entries]).encode(), LEVEL, mtime=0)
            out.write(foot + struct.pack("<Q", len(foot)))
        columns = dict(zip(["part", "first", "last", "file", "offset", "length"], (list(x) for x in zip(*entries, strict=True)), strict=True))
        yield pa.RecordBatch.from_pydict(columns)

    schema = "part long, first string, last string, file string, offset long, length long"
    return stored(rows.mapInArrow(run, schema), "directory", folder)


def _block(reader: Reader, folder: str, file: str, offset: int, length: int) -> list[list]:
    return [json.loads(x) for x in gzip.decompress(reader.read(f"{folder}/{file}", offset, length)).decode().split("\n")]


def read_captures(folder: str, directory: DataFrame, payload: bool = False) -> DataFrame:
    """Every record, read by way of the index: a task takes directory rows, reads their blocks and then the records' ranges."""
    blocks = directory.repartition(max(1, -(-directory.count() // 4)), "file", "offset").select("file", "offset", "length")
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"] + ["url", "payload"] * payload
    kinds = {"page_id": pa.int64(), "payload_bytes": pa.int64(), "refers_to": pa.int64(), "payload": pa.binary()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(keep=64)
        for batch in batches:
            for row in batch.to_pylist():
                lines = sorted(_block(reader, folder, row["file"], row["offset"], row["length"]), key=lambda x: (x[2], x[3]))
                for a in range(0, len(lines), 64):
                    found = [parse(zlib.decompress(reader.read(f"{folder}/{x[2]}", x[3], x[4]), 31)) for x in lines[a : a + 64]]
                    yield pa.RecordBatch.from_pydict({c: pa.array([f[c] for f in found], kinds.get(c, pa.string())) for c in names})
        reader.close()

    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long" + ", url string, payload binary" * payload
    return blocks.mapInArrow(run, schema)


class IndexFile:
    """One index file opened by its directory; ``lines`` yields the captures of a key in order of page id."""

    def __init__(self, reader: Reader, folder: str, file: str) -> None:
        self.reader, self.folder, self.file = reader, folder, file
        size = reader.size(f"{folder}/{file}")
        foot = struct.unpack("<Q", reader.read(f"{folder}/{file}", size - 8, 8))[0]
        self.blocks = json.loads(gzip.decompress(reader.read(f"{folder}/{file}", size - 8 - foot, foot)))
        self.last = [b[1] for b in self.blocks]

    def lines(self, key: str) -> Iterator[list]:
        for first, _, offset, length in self.blocks[bisect.bisect_left(self.last, key) :]:
            if first > key:
                return
            block = _block(self.reader, self.folder, self.file, offset, length)
            keys = [x[0] for x in block]
            yield from block[bisect.bisect_left(keys, key) : bisect.bisect_right(keys, key)]


def look_up(wanted: DataFrame, folder: str, url: str = "url") -> DataFrame:
    """(key, page_id, record_type, payload) of every capture of the wanted URLs, distinct keys counted once.

    The driver holds the first and last key of each index file. A wanted key goes to the files that can hold it, spread by its hash
    so that many keys of one file are no single task; the task searches the file's directory and reads ranges only. Keys are compared by
    code points, as they were sorted.
    """
    spark: SparkSession = wanted.sparkSession
    files = spark.read.parquet(f"{folder}/directory").groupBy("file").agg(F.min("first").alias("first"), F.max("last").alias("last"))
    ranges = [(r["file"], r["first"], r["last"]) for r in files.orderBy("file").toArrow().to_pylist()]
    last = [r[2] for r in ranges]
    keys = wanted.select(reversed_host(wanted[f"`{url}`"]).alias("key")).distinct()

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for key in batch.column("key").to_pylist():
                for file, first, _ in ranges[bisect.bisect_left(last, key) :]:
                    if first > key:
                        break
                    out.append((file, key))
            yield pa.RecordBatch.from_pydict({"file": pa.array([x[0] for x in out], pa.string()), "key": pa.array([x[1] for x in out], pa.string())})

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, index = Reader(keep=64), None
        for batch in batches:
            for row in batch.to_pylist():
                if index is None or index.file != row["file"]:
                    index = IndexFile(reader, folder, row["file"])
                for x in index.lines(row["key"]):
                    found = parse(zlib.decompress(reader.read(f"{folder}/{x[2]}", x[3], x[4]), 31))
                    yield pa.RecordBatch.from_pydict({
                        "key": [row["key"]], "page_id": pa.array([found["page_id"]], pa.int64()), "record_type": [found["record_type"]], "payload": pa.array([found["payload"]], pa.binary()),
                    })
        reader.close()

    sent = keys.mapInArrow(places, "file string, key string").repartition("file", F.pmod(F.xxhash64("key"), F.lit(64))).sortWithinPartitions("file", "key")
    return sent.mapInArrow(read, "key string, page_id long, record_type string, payload binary")
