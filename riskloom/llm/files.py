"""Files that tasks write to, and read by ranges from, the folder that all executors share.

A file appears under its name only when it is whole: a task writes beside it and moves it, so a task that runs
twice, or is lost, leaves the same file. Paths are URIs that pyarrow's file systems open, or plain paths.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from riskloom.session import scratch_path, ship


def open_fs(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a URI or path, and the path inside it."""
    if "://" not in path and not path.startswith("file:"):
        return pafs.LocalFileSystem(), path
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return pafs.FileSystem.from_uri(path)


@contextmanager
def whole_file(folder: str, name: str) -> Iterator:
    """A binary stream for ``folder/name``; the file shows when the block ends without an error."""
    fs, inner = open_fs(folder)
    fs.create_dir(inner, recursive=True)
    beside = f"{inner}/_{name}.{os.getpid()}.{uuid.uuid4().hex[:8]}"
    with fs.open_output_stream(beside) as out:
        yield out
    fs.move(beside, f"{inner}/{name}")


class Reader:
    """Range reads, with the last few files kept open."""

    def __init__(self, keep: int = 8) -> None:
        self._open: dict[str, object] = {}
        self._keep = keep

    def file(self, path: str):
        if path not in self._open:
            if len(self._open) >= self._keep:
                self._open.pop(next(iter(self._open))).close()
            fs, inner = open_fs(path)
            self._open[path] = fs.open_input_file(inner)
        return self._open[path]

    def read(self, path: str, offset: int, length: int) -> bytes:
        return self.file(path).read_at(length, offset)

    def size(self, path: str) -> int:
        return self.file(path).size()

    def close(self) -> None:
        for f in self._open.values():
            f.close()
        self._open = {}


#: Rows and bytes of one Arrow batch of documents, unless the session says otherwise.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": ("10000", "2000"), "spark.sql.execution.arrow.maxBytesPerBatch": ("67108864b", "8m")}


def ready(spark: SparkSession) -> None:
    """Ship the package and bound the batches that tasks get; settings that differ from Spark's defaults stay."""
    ship(spark)
    for key, (default, ours) in BATCH.items():
        if spark.conf.get(key, None) == default:
            spark.conf.set(key, ours)


def packed(docs: DataFrame, *added: str) -> tuple[list[str], Column]:
    """The columns of a table that an operator passes on, and one struct of them; columns that it adds itself are replaced.

    Inside one struct their names can clash with none of the operator's own.
    """
    ready(docs.sparkSession)
    names = [c for c in docs.columns if c not in added]
    return names, F.struct(*[docs[f"`{c}`"] for c in names])


def stored(df: DataFrame, name: str, folder: str | None = None) -> DataFrame:
    """``df`` written once as Parquet in the shared folder (or ``folder``) and read again."""
    spark: SparkSession = df.sparkSession
    ready(spark)
    path = f"{folder.rstrip('/')}/{name}" if folder else scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
