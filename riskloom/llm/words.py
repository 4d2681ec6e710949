"""Words, word hashes and shingle hashes of many texts at once, by numpy over their UTF-8 bytes.

A word is a longest run of bytes other than space and the controls 9 to 13. Hashes have 64 bits and depend on
the word alone, so they agree between tasks, runs and machines.
"""

from __future__ import annotations

import ctypes
import ctypes.util
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: ASCII upper case to lower case; every other byte stays.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
STRIP = b" \t\n\x0b\x0c\r"

try:
    _LIBC = ctypes.CDLL(ctypes.util.find_library("c") or "libc.so.6")
    _LIBC.malloc_trim  # noqa: B018
except (OSError, AttributeError):
    _LIBC = None
_LEAN: list[bool] = []

_BYTE = np.random.Generator(np.random.PCG64(611953)).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_PIECE = 1 << 20


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out)


class _Powers:
    """Powers of the base and of its inverse modulo 2**64, grown when a longer run needs them."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            self.up, self.down = _powers(_BASE, n), _powers(pow(_BASE, -1, 1 << 64), n)
        return self.up, self.down


_POWERS = _Powers()


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def rolling(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Position-independent hash of ``values[start:end]`` for many ranges of one array."""
    up, down = _POWERS.to(len(values) + 1)
    total = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * up[: len(values)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


class Words:
    """Words of a list of byte texts: text i has the words ``first[i]:first[i + 1]`` of ``hashes``."""

    def __init__(self, texts: Sequence[bytes], fold: bool = True, places: bool = False) -> None:
        joined = b"\n".join(texts)
        if fold:
            joined = joined.translate(LOWER)
        self.data = np.frombuffer(joined, dtype=np.uint8)
        size = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        self.begin = np.concatenate([[0], np.cumsum(size + 1)])[: len(texts)].astype(np.int64)
        self.end = self.begin + size
        hashes, starts, ends = [], [], []
        for a, b in self._pieces():
            piece = self.data[a:b]
            edge = np.flatnonzero(np.diff(SPACE[piece].astype(np.int8), prepend=1, append=1))
            s, e = edge[::2], edge[1::2]
            hashes.append(rolling(_BYTE[piece], s, e))
            starts.append(s + a)
            ends.append(e + a)
        none = np.zeros(0, dtype=np.int64)
        self.hashes = np.concatenate([none.astype(np.uint64), *hashes])
        self.starts = np.concatenate([none, *starts])
        self.first = np.append(np.searchsorted(self.starts, self.begin), len(self.starts))
        self.ends = np.concatenate([none, *ends]) if places else None

    def _pieces(self) -> Iterator[tuple[int, int]]:
        """Stretches of about one megabyte that end before a space, so that no word is cut."""
        a, n = 0, len(self.data)
        while a < n:
            b = min(n, a + _PIECE)
            while b < n and not SPACE[self.data[b]]:
                stop = min(n, b + 65536)
                found = np.flatnonzero(SPACE[self.data[b:stop]])
                b = b + int(found[0]) if len(found) else stop
            yield a, b
            a = b

    def shingles(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all runs of ``size`` words inside a text, and where each text's runs begin.

        A text with fewer words, but at least one, gives its whole sequence as one run.
        """
        count = np.diff(self.first)
        runs = np.where(count >= size, count - size + 1, np.minimum(count, 1))
        at = np.concatenate([[0], np.cumsum(runs)])
        start = np.arange(at[-1]) + np.repeat(self.first[:-1] - at[:-1], runs)
        stop = start + np.repeat(np.minimum(count, size), runs)
        return rolling(self.hashes, start, stop), at


def byte_texts(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """UTF-8 of a string column; null is empty."""
    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]


def lean() -> None:
    """Let a Python worker give memory back: large blocks are mapped one by one, and Arrow's buffers come from the same place.

    Called once in each worker process, where tasks of many stages follow each other.
    """
    if _LIBC is None or _LEAN:
        return
    _LEAN.append(True)
    _LIBC.mallopt(-8, 1)  # M_ARENA_MAX
    _LIBC.mallopt(-3, 1 << 20)  # M_MMAP_THRESHOLD
    pa.set_memory_pool(pa.system_memory_pool())
    pa.set_cpu_count(1)


def release() -> None:
    """Give freed memory back to the system; workers stay for later tasks and would hold it."""
    lean()
    if _LIBC is not None:
        _LIBC.malloc_trim(0)


def slices(batch: pa.RecordBatch, text: str, most: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in runs of about ``most`` text bytes; a longer text is a run of its own."""
    lean()
    size = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_pylist()
    a, total = 0, 0
    for i, n in enumerate(size):
        if i > a and total + n > most:
            yield batch.slice(a, i - a)
            a, total = i, 0
        total += n
    if a < len(size):
        yield batch.slice(a)
    release()
