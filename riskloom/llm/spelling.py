"""Spelling variants: words one edit apart, found by generated edits, Bloom filters and one exact join.

1. Words are counted in every task and summed by Spark; those that are long and frequent enough are the vocabulary.
2. Each length has a shard of blocked Bloom filters: a word sets ``PROBES`` bits of one 64-bit block. Spark makes the blocks (``bit_or`` by length and
   block) and all shards are broadcast together, at most ``MAX_BLOCKS`` blocks (32 MB). A larger vocabulary is cut into slices by hash that
   take turns, so what is broadcast stays bounded and every word is in some slice.
3. Every word generates its neighbourhood as 64-bit hashes, computed from the word's own hash without writing the words: each deletion probes
   the shard one shorter, each replacement by a later letter its own shard. Insertions are the deletions of the longer word, replacements by an earlier
   letter those of the other word, so every pair is found once and used both ways. Letters that no word holds are left out.
4. Only hits shuffle: an exact join with the vocabulary, by hash and then letter by letter, removes what the filters let through wrongly.
5. A word's form is its most frequent neighbour, if that is frequent enough; roots follow by pointer doubling, whose rounds are
   known beforehand because counts grow by the ratio with every step.

Defined cases: null and empty texts have no words; a null id counts as empty where ids enter a hash; a repeated row counts again; a table without words gives no rows; ties go to the word
that is first in code-point order; long words probe in bounded runs of positions. Only the id and the text are read, so other columns cannot clash.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from riskloom.llm.files import ready, stored
from riskloom.llm.words import LOWER, byte_texts, mix, slices

MIN_CHARS, MIN_COUNT, RATIO = 6, 5, 5
#: One occurrence in so many is a slip: it loses one letter.
SLIP = 199
BITS_PER_WORD, PROBES, MAX_BLOCKS = 24, 5, 1 << 22
#: Letters a-z and U+00C0 to U+00FF in UTF-8.
_RUN = re.compile(rb"(?:[a-z]+|(?:\xc3[\x80-\xbf])+)+")
_NO_LETTER = re.compile(rb"[^a-z\x80-\xff]")
_PIECE, _ENTRIES, _CELLS = 1 << 20, 1 << 17, 1 << 18
_CODE = np.random.Generator(np.random.PCG64(40127)).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_BACK = np.uint64(pow(_BASE, -1, 1 << 64))


def _pieces(text: bytes) -> Iterator[bytes]:
    """Stretches of about a megabyte that cut no run."""
    a = 0
    while a < len(text):
        found = _NO_LETTER.search(text, min(len(text), a + _PIECE))
        b = found.start() if found else len(text)
        yield text[a:b] if a or b < len(text) else text
        a = b


def runs(doc_id: int | None, text: bytes, min_chars: int, slip: int) -> Iterator[tuple[bytes, int]]:
    """(run, occurrences) of a text in lower case, slips made, short ones left out; a run may come more than once."""
    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for piece in _pieces(text.translate(LOWER)):
        for run, c in Counter(_RUN.findall(piece)).items():
            size = len(run) if run.isascii() else len(run) - run.count(b"\xc3")
            if size < min_chars:
                continue
            h = zlib.crc32(run, start)
            if slip and h % slip == 0:
                if size == min_chars:
                    continue
                word, k = run.decode(), h % size
                run = (word[:k] + word[k + 1 :]).encode()
            yield run, c


def count_words(docs: DataFrame, key: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT, slip: int = SLIP) -> DataFrame:
    """(word, n) of all words of at least so many letters and occurrences."""
    ready(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[bytes, int] = {}

        def flushed() -> pa.RecordBatch:
            out = pa.RecordBatch.from_pydict({"word": pa.array(list(total), pa.binary()).cast(pa.string()), "n": pa.array(list(total.values()), pa.int64())})
            total.clear()
            return out

        for batch in batches:
            for part in slices(batch, "t"):
                for doc_id, body in zip(part.column("i").to_pylist(), byte_texts(part.column("t")), strict=True):
                    for word, c in runs(doc_id, body, min_chars, slip):
                        total[word] = total.get(word, 0) + c
                if len(total) >= _ENTRIES:
                    yield flushed()
        if total:
            yield flushed()

    rows = docs.select(docs[f"`{key}`"].cast("long").alias("i"), docs[f"`{text}`"].cast("string").alias("t"))
    return rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


class Letters:
    """Words of one length as a matrix of letters, and hashes of the words and of their edits."""

    def __init__(self, words: list[str]) -> None:
        self.size = len(words[0])
        self.codes = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32).reshape(len(words), self.size).astype(np.uint8)
        power = np.full(self.size, _BASE, dtype=np.uint64)
        power[0] = 1
        self.power = np.cumprod(power)
        terms = _CODE[self.codes] * self.power
        self.before = np.zeros((len(words), self.size + 1), dtype=np.uint64)
        np.cumsum(terms, axis=1, out=self.before[:, 1:])
        self.whole = self.before[:, -1]

    def hashes(self) -> np.ndarray:
        return mix(self.whole + np.uint64(self.size))

    def without(self, a: int, b: int) -> np.ndarray:
        """Hashes of the words without one of the letters a to b."""
        return mix(self.before[:, a:b] + (self.whole[:, None] - self.before[:, a + 1 : b + 1]) * _BACK + np.uint64(self.size - 1))

    def replaced(self, letter: int, a: int, b: int) -> np.ndarray:
        """Hashes of the words with ``letter`` in one of the places a to b."""
        return mix(self.whole[:, None] + (_CODE[letter] - _CODE[self.codes[:, a:b]]) * self.power[a:b] + np.uint64(self.size))


def _block(h: np.ndarray, blocks: int) -> np.ndarray:
    return (((h >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32)).astype(np.int64)


def _bit(h: np.ndarray, k: int) -> np.ndarray:
    return np.uint64(1) << ((h >> np.uint64(6 * k)) & np.uint64(63))


class Shards:
    """Blocked Bloom filters of the words of one slice, one shard a length."""

    def __init__(self, words: dict[int, int], part: int = 0, parts: int = 1) -> None:
        self.part, self.parts, self.start, self.blocks, at = part, parts, {}, {}, 0
        for size, n in sorted(words.items()):
            self.start[size], self.blocks[size] = at, max(1, -(-n * BITS_PER_WORD // (64 * parts)))
            at += self.blocks[size]
        self.data = np.zeros(at, dtype=np.uint64)

    def mine(self, h: np.ndarray) -> np.ndarray:
        return mix(h) % np.uint64(self.parts) == np.uint64(self.part)

    def place(self, size: int, h: np.ndarray) -> np.ndarray:
        return self.start[size] + _block(h, self.blocks[size])

    @staticmethod
    def mask(h: np.ndarray) -> np.ndarray:
        out = _bit(h, 0)
        for k in range(1, PROBES):
            out |= _bit(h, k)
        return out

    def hits(self, size: int, h: np.ndarray, of: np.ndarray) -> np.ndarray:
        """Which of the flat places ``of`` of hashes the shard may hold. The first bit sorts most of them out."""
        if size not in self.start:
            return of[:0]
        h = h[of]
        if self.parts > 1:
            keep = np.flatnonzero(self.mine(h))
            of, h = of[keep], h[keep]
        block = self.data[self.place(size, h)]
        keep = np.flatnonzero(block & _bit(h, 0))
        of, h, block = of[keep], h[keep], block[keep]
        mask = self.mask(h)
        return of[block & mask == mask]


def _by_length(words: list[str]) -> Iterator[tuple[np.ndarray, Letters]]:
    """Words of equal lengths together, in runs of bounded size."""
    size = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    for n in np.unique(size):
        rows, most = np.flatnonzero(size == n), max(1, _CELLS // int(n))
        for a in range(0, len(rows), most):
            yield rows[a : a + most], Letters([words[k] for k in rows[a : a + most]])


def neighbourhood(letters: Letters, shards: Shards, alphabet: list[int]) -> Iterator[tuple[np.ndarray, np.ndarray, int, np.ndarray]]:
    """(word, place, letter or 0 for none, hash) of the edits that the filters may hold."""
    for a in range(0, letters.size, _CELLS):
        b = min(letters.size, a + _CELLS)
        codes = letters.codes[:, a:b]
        if letters.size - 1 in shards.start:
            # Of a run of equal letters only the first is deleted: the others give the same word.
            first = np.ones(codes.shape, dtype=bool)
            first[:, 1:] = codes[:, 1:] != codes[:, :-1]
            if a:
                first[:, 0] = codes[:, 0] != letters.codes[:, a - 1]
            h = letters.without(a, b).ravel()
            found = shards.hits(letters.size - 1, h, np.flatnonzero(first.ravel()))
            yield found // (b - a), a + found % (b - a), 0, h[found]
        for letter in alphabet:
            h = letters.replaced(letter, a, b).ravel()
            found = shards.hits(letters.size, h, np.flatnonzero(codes.ravel() < letter))
            yield found // (b - a), a + found % (b - a), letter, h[found]


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words = batch.column("word").to_pylist()
        h = np.zeros(len(words), dtype=np.int64)
        for rows, letters in _by_length(words):
            h[rows] = letters.hashes().view(np.int64)
        yield pa.RecordBatch.from_pydict({"word": batch.column("word"), "n": batch.column("n"), "h": h, "size": pa.array(map(len, words), pa.int32())})


def _filled(words: DataFrame, shards: Shards) -> Shards:
    """The filters of one slice: Spark joins the bits of a block, the driver puts the blocks in their places."""
    start, blocks, part, parts = shards.start, shards.blocks, shards.part, shards.parts
    empty = Shards.__new__(Shards)
    empty.start, empty.blocks, empty.part, empty.parts = start, blocks, part, parts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h, size = batch.column("h").to_numpy().view(np.uint64), batch.column("size").to_numpy()
            keep = empty.mine(h)
            h, size = h[keep], size[keep]
            at = np.zeros(len(h), dtype=np.int64)
            for n in np.unique(size):
                at[size == n] = empty.place(int(n), h[size == n])
            yield pa.RecordBatch.from_pydict({"at": at, "mask": Shards.mask(h).view(np.int64)})

    made = words.select("h", "size").mapInArrow(run, "at long, mask long").groupBy("at").agg(F.bit_or("mask").alias("mask")).toArrow()
    shards.data[made.column("at").to_numpy()] = made.column("mask").to_numpy().view(np.uint64)
    return shards


def _hits(words: DataFrame, shards: Shards, alphabet: list[int]) -> DataFrame:
    sent = words.sparkSession.sparkContext.broadcast(shards)
    names = {0: "", **{c: chr(c) for c in alphabet}}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column("h").to_numpy()
            for rows, letters in _by_length(batch.column("word").to_pylist()):
                for word, place, letter, h in neighbourhood(letters, sent.value, alphabet):
                    if len(word):
                        yield pa.RecordBatch.from_pydict({
                            "h": h.view(np.int64), "source": own[rows[word]], "place": place.astype(np.int32), "letter": [names[letter]] * len(word)})

    return words.select("word", "h").mapInArrow(run, "h long, source long, place int, letter string")


def near_words(words: DataFrame, max_blocks: int = MAX_BLOCKS) -> DataFrame:
    """(word, n, other, other_n): every word with every word of the table that is one edit away, both ways. ``words``: word, n, h, size, stored."""
    spark = words.sparkSession
    sizes = {r["size"]: r["count"] for r in words.groupBy("size").count().toArrow().to_pylist()}
    if not sizes:
        return words.select("word", "n", F.col("word").alias("other"), F.col("n").alias("other_n"))
    # At most as many rows as the pattern has letters.
    alphabet = sorted(ord(r[0]) for r in words.select(F.explode(F.array_distinct(F.split("word", "")))).distinct().collect() if r[0])
    need = sum(-(-n * BITS_PER_WORD // 64) for n in sizes.values())
    parts = max(1, -(-need // max_blocks))
    spread = words.repartition(max(spark.sparkContext.defaultParallelism, -(-sum(sizes.values()) // 20_000)), "h")
    hits = None
    for part in range(parts):
        one = stored(_hits(spread, _filled(words, Shards(sizes, part, parts)), alphabet), f"spelling-hits-{part}")
        hits = one if hits is None else hits.unionByName(one)
    target = words.select("h", F.col("word").alias("other"), F.col("n").alias("other_n"))
    source = words.select(F.col("h").alias("source"), "word", "n")
    place = F.col("place")
    edited = F.concat(F.substring("word", F.lit(1), place), F.col("letter"), F.substring("word", place + 2, F.length("word")))
    pairs = hits.join(target, "h").join(source, "source").where(edited == F.col("other")).select("word", "n", "other", "other_n")
    return pairs.unionByName(pairs.select(F.col("other").alias("word"), F.col("other_n").alias("n"), F.col("word").alias("other"), F.col("n").alias("other_n")))


def variant_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT, ratio: int = RATIO, slip: int = SLIP, max_blocks: int = MAX_BLOCKS) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of the vocabulary."""
    if ratio < 2:
        raise ValueError("forms must be at least twice as frequent, else they could go round in a circle")
    counted = count_words(docs, key, text, min_chars, min_count, slip)
    words = stored(counted.mapInArrow(_hashed, "word string, n long, h long, size int"), "spelling-words")
    best = near_words(words, max_blocks).groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("m"), F.col("other").alias("form"))).alias("b"))
    held = words.select("word", "n").join(best, "word", "left")
    fits = -F.col("b.m") >= ratio * F.col("n")
    forms = stored(held.select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(fits, F.col("b.form")).alias("form"), F.when(fits, -F.col("b.m")).alias("form_n")), "spelling-forms")
    top = forms.agg(F.max("n")).first()[0] or 0
    # The longest chain of forms: each step multiplies the count by the ratio. Doubling reaches its end in log2 rounds.
    chain = math.ceil(math.log(max(top / max(min_count, 1), 1), ratio)) + 1
    ways = forms.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    for k in range(max(1, math.ceil(math.log2(chain)))):
        onward = ways.select(F.col("word").alias("root"), F.col("root").alias("next"))
        ways = stored(ways.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root")), f"spelling-roots-{k}")
    return forms.join(ways, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
