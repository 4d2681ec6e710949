"""Quality rules by repetition coverage.

Rolling hashes of several n-gram lengths mark every word of a text that lies in an n-gram found twice or more in
that text; lines are marked likewise. The share of the text's characters that are marked decides, one bound per length.
The work is row-local: no shuffle, and memory is bounded by a run of about half a megabyte of text (or one text).
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from riskloom.llm.files import packed
from riskloom.llm.words import STRIP, Words, byte_texts, mix, rolling, slices

#: Most of a text's word characters that may lie in repeated n-grams of so many words. What repeats in longer runs repeats in shorter
#: ones too, so the bounds fall with the length; all lie above the largest share of any document labelled good (0.43, repeated lines).
GRAM_LIMITS: Mapping[int, float] = {5: 0.50, 8: 0.47, 12: 0.44}
#: Most of a text's word characters that may lie in repeated lines.
LINE_LIMIT = 0.45
MIN_WORDS = 50
#: Text bytes that a task measures at a time: its arrays are many times as large.
_RUN_BYTES = 512 << 10
_SYMBOL = np.isin(np.arange(256), list(b"#*$%&|<>"))


def _covered(words: Words, size: int, count: np.ndarray) -> np.ndarray:
    """For each word: whether it lies in a run of ``size`` words found twice or more in its text."""
    total = len(words.hashes)
    runs = np.maximum(count - size + 1, 0)
    at = np.concatenate([[0], np.cumsum(runs)])
    owner = np.repeat(np.arange(len(count)), runs)
    start = np.arange(at[-1]) + (words.first[:-1] - at[:-1])[owner]
    key = mix(rolling(words.hashes, start, start + size) + mix(owner.astype(np.uint64) + np.uint64(1)))
    order = np.sort(key)
    twice = order[1:][order[1:] == order[:-1]]
    if not len(twice):
        return np.zeros(total, dtype=bool)
    place = np.minimum(np.searchsorted(twice, key), len(twice) - 1)
    hit = start[twice[place] == key]
    change = np.bincount(hit, minlength=total + 1) - np.bincount(hit + size, minlength=total + 1)
    return np.cumsum(change[:total]) > 0


def _sums(value: np.ndarray, words: Words) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(value)])
    return total[words.first[1:]] - total[words.first[:-1]]


def _lines(text: bytes) -> tuple[int, int]:
    """Lines with a word that equal an earlier line, and the word characters of all lines found twice or more."""
    seen: dict[bytes, int] = {}
    repeats = 0
    for line in text.split(b"\n"):
        if line.strip(STRIP):
            n = seen.get(line, 0)
            repeats += n > 0
            seen[line] = n + 1
    if not repeats:
        return 0, 0
    return repeats, sum(n * len(line.translate(None, STRIP).decode("utf-8", "replace")) for line, n in seen.items() if n > 1)


def _measure(texts: list[bytes], gram_limits: Mapping[int, float], line_limit: float, min_words: int) -> dict[str, np.ndarray]:
    words = Words(texts, fold=False, places=True)
    count = np.diff(words.first)
    letters = np.concatenate([[0], np.cumsum((words.data & 0xC0) != 0x80)])
    chars = letters[words.ends] - letters[words.starts]
    symbols = np.flatnonzero(_SYMBOL[words.data])
    word_chars = _sums(chars, words)
    repeat = _sums(_covered(words, 3, count), words)
    lines = np.array([_lines(t) for t in texts], dtype=np.int64).reshape(-1, 2)
    failed = (count < min_words) | (100 * repeat > 50 * count)
    whole = np.maximum(word_chars, 1)
    line_share = lines[:, 1] / whole
    bad = line_share > line_limit
    out = {
        "n_words": count, "word_chars": word_chars,
        "n_symbols": np.searchsorted(symbols, words.end) - np.searchsorted(symbols, words.begin),
        "n_dup_lines": lines[:, 0], "n_repeat_words": repeat, "base_failed": failed, "dup_line_chars": lines[:, 1],
    }
    for size, limit in gram_limits.items():
        inside = _sums(chars * _covered(words, size, count), words)
        out[f"dup_{size}gram_chars"] = inside
        bad |= inside / whole > limit
    return out | {"kept": ~failed & ~bad}


def quality_rules(
    docs: DataFrame,
    text: str = "text",
    gram_limits: Mapping[int, float] = GRAM_LIMITS,
    line_limit: float = LINE_LIMIT,
    min_words: int = MIN_WORDS,
) -> DataFrame:
    """``docs`` with one struct column ``_rules`` of counts and the verdict ``kept``.

    A row fails when it has fewer than ``min_words`` words, when more than half of its words lie in repeated
    three-word runs, or when the share of word characters in repeated n-grams or lines passes its limit.
    Null and empty texts have no word and fail. Repeated rows are judged alike, one by one; an empty table gives
    an empty table; other columns pass through, whatever their names (a column called ``_rules`` is replaced).
    """
    names, row = packed(docs, "_rules")
    frame = docs.select(row.alias("row"), docs[f"`{text}`"].cast("string").alias("t"))
    fields = [pa.field(k, pa.int64()) for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    fields += [pa.field("base_failed", pa.bool_()), pa.field("dup_line_chars", pa.int64())]
    fields += [pa.field(f"dup_{n}gram_chars", pa.int64()) for n in gram_limits] + [pa.field("kept", pa.bool_())]
    inner = ", ".join(f"{f.name}: {'boolean' if f.type == pa.bool_() else 'bigint'}" for f in fields)
    limits = dict(gram_limits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "t", _RUN_BYTES):
                found = _measure(byte_texts(part.column("t")), limits, line_limit, min_words)
                rules = pa.StructArray.from_arrays([pa.array(found[f.name], type=f.type) for f in fields], fields=fields)
                yield pa.RecordBatch.from_arrays([part.column("row"), rules], names=["row", "_rules"])

    schema = f"row {frame.schema['row'].dataType.simpleString()}, _rules struct<{inner}>"
    return frame.mapInArrow(run, schema).select(*[F.col("row").getField(c).alias(c) for c in names], "_rules")
