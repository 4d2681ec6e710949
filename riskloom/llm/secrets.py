"""Secret scan by grammar inference.

Three fixed patterns find the base spans. Their values are labelled credentials: a bounded sample of each kind becomes a prefix tree of character
classes with counts, whose states are merged wherever their tails' frequencies are statistically compatible (Hoeffding bound), which leaves a small
probabilistic automaton of the format; the characters of each class and the lengths have counts of their own. Ordinary text gets automata in the
same way: of runs without a digit (in capitals, or not), of runs without a letter, and of mixed runs that two or more documents hold and that do not look like credentials.

Every other run of credential characters in every text is a candidate. It becomes a span when its likelihood per character under an automaton is one that
labelled credentials of that kind reach, and when the whole of it is likelier than under every ordinary automaton by a stated factor.

The texts are read twice, in place, to learn and to score; no text or credential is written to the shared folder (sampled values pass through a shuffle). Only the samples (``SAMPLE`` values per
kind) reach the driver, and only the automata go out. Candidates of a run of texts are scored together, one character of all of them at a time.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from riskloom.llm.files import ready
from riskloom.llm.words import byte_texts, slices

#: Base kinds in the order in which spans with one start are listed; the method's own kind comes last.
KINDS = ("assign", "access", "hex")
FOUND = "format"
# The base patterns and their least lengths.
_ASSIGN = re.compile(r"""((?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 6, 20, 24

#: Labelled values per kind, and ordinary runs per shape, from which an automaton is learned; the smallest CRCs of all distinct values.
SAMPLE = 400
#: Significance of the merge test.
ALPHA = 0.05
#: Share of held-out credentials that may score below the bar, and nats per character by which a candidate may stay under it.
MISSED, SLACK = 0.02, 0.25
#: Nats by which a whole candidate must be likelier as a credential than as ordinary text.
MARGIN = 15.0
FLOOR = math.log(1e-4)
#: Candidates are as long as the shortest labelled value, or as this where all of those are longer.
LEAST = 16
#: Share of the length model that is spread over lengths never seen.
UNSEEN = 0.1
#: The shape of ordinary runs that counts only where two documents hold it; the shapes before it count everywhere.
MIXED = 3

# Characters of a candidate; those that may begin and end it. An equals sign parts a name from its value.
_INSIDE = np.isin(np.arange(256), list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.-"))
_CORE = _INSIDE & ~np.isin(np.arange(256), list(b".-"))
_DIGIT = np.isin(np.arange(256), list(b"0123456789"))
_SMALL = np.isin(np.arange(256), list(b"abcdefghijklmnopqrstuvwxyz"))
_LETTER = _CORE & ~_DIGIT & ~np.isin(np.arange(256), list(b"+/_"))
_ALPHABET = [chr(b) for b in np.flatnonzero(_INSIDE)]
_CLASSES = (("a", "abcdef"), ("g", "ghijklmnopqrstuvwxyz"), ("A", "ABCDEF"), ("G", "GHIJKLMNOPQRSTUVWXYZ"), ("0", "0123456789"))
#: Class of each character: hexadecimal and other letters of either case, digits, and every mark by itself.
CLASS = {c: c for c in _ALPHABET} | {c: name for name, chars in _CLASSES for c in chars}
_MEMBERS = Counter(CLASS.values())
#: Candidates that are scored together at one character; longer ones that are left go one by one.
_FEW = 8

_HEX_MAP = bytes(104 if chr(b) in "0123456789abcdef" else 32 for b in range(256))


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(start, order of the kind, end, value) of the base matches, sorted; offsets are code points, ends exclusive."""
    out = []
    if "=" in text or ":" in text:
        out += [(m.start(), 0, m.end(), m[2]) for m in _ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end(), m[0]) for m in _ACCESS.finditer(text) if len(m[0]) >= ACCESS_LEAST]
    if b"h" * HEX_LEAST in text.encode("utf-8", "replace").translate(_HEX_MAP):
        out += [(m.start(), 2, m.end(), m[0]) for m in _HEX.finditer(text)]
    return sorted(out)


def candidates(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the longest runs of credential characters, without full stops and hyphens at either end."""
    edge = np.flatnonzero(np.diff(_INSIDE[data].astype(np.int8), prepend=0, append=0))
    core = np.flatnonzero(_CORE[data])
    first, last = np.searchsorted(core, edge[::2]), np.searchsorted(core, edge[1::2])
    some = first < last
    return core[first[some]], core[last[some] - 1] + 1


def _shapes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Of each run: 0 without a digit or a small letter, 1 without a digit, 2 without a letter, ``MIXED`` else."""
    has = [total[ends] > total[starts] for total in (np.concatenate([[0], np.cumsum(mask[data])]) for mask in (_DIGIT, _LETTER, _SMALL))]
    return np.where(has[0], np.where(has[1], MIXED, 2), np.where(has[2], 1, 0))


_SPAN = "struct<kind: string, start: int, end: int, score: double>"


@dataclass
class Automaton:
    """Deterministic over character classes, with the count of every arc, of visits and of ends; characters and lengths are counted apart."""

    arcs: list[dict[str, list[int]]]
    visits: list[int]
    ends: list[int]
    chars: Counter = field(default_factory=Counter)
    lengths: Counter = field(default_factory=Counter)

    @classmethod
    def tree(cls, values: list[str]) -> Automaton:
        tree = cls([{}], [0], [0])
        for value in values:
            at = 0
            tree.visits[0] += 1
            tree.chars.update(value)
            tree.lengths[len(value)] += 1
            for c in map(CLASS.__getitem__, value):
                arc = tree.arcs[at].get(c)
                if arc is None:
                    arc = tree.arcs[at][c] = [len(tree.arcs), 0]
                    tree.arcs.append({})
                    tree.visits.append(0)
                    tree.ends.append(0)
                arc[1] += 1
                at = arc[0]
                tree.visits[at] += 1
            tree.ends[at] += 1
        return tree

    def _differ(self, x: int, y: int, fx: int, fy: int, bound: float) -> bool:
        nx, ny = self.visits[x], self.visits[y]
        return bool(nx and ny) and abs(fx / nx - fy / ny) > bound * (nx**-0.5 + ny**-0.5)

    def compatible(self, red: int, blue: int, bound: float) -> bool:
        """Whether the two states, and the states that equal symbols lead to, agree within the bound; blue roots a tree."""
        todo = [(red, blue)]
        while todo:
            x, y = todo.pop()
            if self._differ(x, y, self.ends[x], self.ends[y], bound):
                return False
            for c in self.arcs[x].keys() | self.arcs[y].keys():
                a, b = self.arcs[x].get(c), self.arcs[y].get(c)
                if self._differ(x, y, a[1] if a else 0, b[1] if b else 0, bound):
                    return False
                if a and b:
                    todo.append((a[0], b[0]))
        return True

    def fold(self, red: int, blue: int) -> None:
        """Add the counts of the tree under blue to red and what follows it."""
        todo = [(red, blue)]
        while todo:
            x, y = todo.pop()
            self.visits[x] += self.visits[y]
            self.ends[x] += self.ends[y]
            for c, (target, count) in self.arcs[y].items():
                if c in self.arcs[x]:
                    self.arcs[x][c][1] += count
                    todo.append((self.arcs[x][c][0], target))
                else:
                    self.arcs[x][c] = [target, count]

    @classmethod
    def learn(cls, values: list[str], alpha: float = ALPHA) -> Automaton:
        """Merge compatible states of the values' prefix tree, breadth first, nearest settled state first."""
        self = cls.tree(values)
        bound = math.sqrt(0.5 * math.log(2 / alpha))
        red = [0]
        while True:
            settled = set(red)
            step = next(((s, c, a[0]) for s in red for c, a in sorted(self.arcs[s].items()) if a[0] not in settled), None)
            if step is None:
                break
            source, symbol, blue = step
            for r in red:
                if self.compatible(r, blue, bound):
                    self.arcs[source][symbol][0] = r
                    self.fold(r, blue)
                    break
            else:
                red.append(blue)
        place = {s: k for k, s in enumerate(red)}
        arcs = [{c: [place[a[0]], a[1]] for c, a in self.arcs[s].items()} for s in red]
        return cls(arcs, [self.visits[s] for s in red], [self.ends[s] for s in red], self.chars, self.lengths)

    @cached_property
    def tables(self) -> tuple[np.ndarray, np.ndarray]:
        """Next state and log likelihood for every state and byte; a class without an arc keeps the state."""
        follow = np.repeat(np.arange(len(self.arcs), dtype=np.int32)[:, None], 256, axis=1)
        cost = np.full((len(self.arcs), 256), FLOOR)
        seen = Counter()
        for c, n in self.chars.items():
            seen[CLASS[c]] += n
        for c in _ALPHABET:
            name = CLASS[c]
            own = math.log((self.chars[c] + 0.5) / (seen[name] + 0.5 * _MEMBERS[name]))
            for state, arcs in enumerate(self.arcs):
                arc = arcs.get(name)
                cost[state, ord(c)] = own + (max(FLOOR, math.log(arc[1] / self.visits[state])) if arc else FLOOR)
                if arc:
                    follow[state, ord(c)] = arc[0]
        return follow, cost

    def scores(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Log likelihood of the characters of each run, lengths apart."""
        follow, cost = self.tables
        order = np.argsort(-sizes, kind="stable")
        begin, size = starts[order], sizes[order]
        state, total = np.zeros(len(order), dtype=np.int32), np.zeros(len(order))
        k, left = 0, int(np.count_nonzero(size > 0))
        while left >= _FEW:
            at = data[begin[:left] + k]
            total[:left] += cost[state[:left], at]
            state[:left] = follow[state[:left], at]
            k += 1
            left = int(np.searchsorted(-size, -k))
        for j in range(left):
            now = int(state[j])
            for c in data[begin[j] + k : begin[j] + size[j]].tolist():
                total[j] += cost[now, c]
                now = follow[now, c]
        out = np.empty(len(order))
        out[order] = total
        return out

    def length_scores(self, sizes: np.ndarray) -> np.ndarray:
        """Log likelihood of lengths: the seen ones, and a share for any other."""
        total = max(sum(self.lengths.values()), 1)
        distinct, place = np.unique(sizes, return_inverse=True)
        share = np.array([self.lengths[int(n)] / total for n in distinct])
        return np.log((1 - UNSEEN) * share + UNSEEN / (2.0 * np.maximum(distinct, 1)))[place]


@dataclass
class Formats:
    """One automaton per kind with its bar, those of ordinary text, and the least length of a candidate."""

    kinds: list[tuple[str, Automaton, float]]
    ordinary: list[Automaton]
    least: int

    @classmethod
    def fit(cls, labelled: dict[str, list[str]], ordinary: list[str]) -> Formats:
        kinds, least = [], []
        for kind, values in sorted(labelled.items()):
            values = [v for v in map(_bare, values) if v]
            learned, held = values[::2], values[1::2]
            if len(held) >= 5:
                automaton = Automaton.learn(learned)
                means = sorted(automaton.scores(*_laid(held)) / [len(v) for v in held])
                kinds.append((kind, automaton, means[int(MISSED * len(means))] - SLACK))
                least.append(min(map(len, values)))
        data, starts, sizes = _laid(ordinary)
        shape = _shapes(data, starts, starts + sizes)
        groups = [[v for v, x in zip(ordinary, shape, strict=True) if x == k] for k in range(MIXED + 1)]
        plain = cls(kinds, [Automaton.learn(g) for g in groups[:MIXED] if g], min([*least, LEAST]))
        # Mixed runs that look like credentials are unlabelled ones, not ordinary.
        mixed = [v for v in groups[MIXED] if plain.score(v) is None]
        return cls(kinds, plain.ordinary + ([Automaton.learn(mixed)] if mixed else []), plain.least)

    def gains(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Nats by which each run is likelier under the best kind whose bar it reaches than as ordinary; minus infinity if it reaches none."""
        out = np.full(len(starts), -np.inf)
        for _, automaton, bar in self.kinds:
            total = automaton.scores(data, starts, sizes)
            whole = total + automaton.length_scores(sizes)
            out = np.where(total >= bar * sizes, np.maximum(out, whole), out)
        some = np.flatnonzero(out > -np.inf)
        if len(some):
            a, n = starts[some], sizes[some]
            plain = [o.scores(data, a, n) + o.length_scores(n) for o in self.ordinary] or [FLOOR * n]
            out[some] -= np.max(plain, axis=0)
        return out

    def score(self, value: str) -> float | None:
        """Gain of one value, None below the margin or the least length."""
        gain = self.gains(*_laid([value]))[0] if len(value) >= self.least else -np.inf
        return float(gain) if gain >= MARGIN else None


def _bare(value: str) -> str:
    """A labelled value as a candidate has it: behind the last equals sign that is not padding, without marks at the ends."""
    return value.rstrip("=").rsplit("=", 1)[-1].strip(".-")


def _laid(values: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    sizes = np.fromiter(map(len, values), dtype=np.int64, count=len(values))
    return np.frombuffer("".join(values).encode(), dtype=np.uint8), np.cumsum(sizes) - sizes, sizes


class _Runs:
    """Base spans and candidates of some texts; candidates touch no base span. Offsets are bytes of ``data``, those of base spans code points."""

    def __init__(self, texts: list[bytes], least: int) -> None:
        size = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        self.data = np.frombuffer(b"\n".join(texts), dtype=np.uint8)
        self.begin = np.cumsum(size + 1) - size - 1
        self.base: list[list[tuple[int, int, int, str]]] = []
        change = np.zeros(len(self.data) + 1, dtype=np.int32)
        for k, raw in enumerate(texts):
            text = raw.decode("utf-8", "replace")
            spans = base_spans(text) if raw else []
            self.base.append(spans)
            for start, _, end, _ in spans:
                at = self.begin[k] + (start if len(text) == len(raw) else len(text[:start].encode()))
                change[at] += 1
                change[at + len(text[start:end].encode())] -= 1
        starts, ends = candidates(self.data)
        long = ends - starts >= least
        starts, ends = starts[long], ends[long]
        taken = np.concatenate([[0], np.cumsum(np.cumsum(change[:-1]) > 0)])
        free = taken[starts] == taken[ends]
        self.starts, self.ends = starts[free], ends[free]


class _Sample:
    """The distinct values of least CRC, at most so many."""

    def __init__(self, most: int) -> None:
        self.most, self.bar, self.held = most, 1 << 32, {}

    def add(self, value: bytes) -> None:
        crc = zlib.crc32(value)
        if crc <= self.bar:
            self.held[value] = crc
            if len(self.held) > 4 * self.most:
                self.held = dict(sorted(self.held.items(), key=lambda x: (x[1], x[0]))[: self.most])
                self.bar = max(self.held.values())


def samples(rows: DataFrame, most: int) -> list[list[str]]:
    """At most so many distinct values of each base kind, and of ordinary runs of each shape, by least CRC.

    A task keeps its own smallest ones. Mixed runs go out once per document and batch, since those that one document alone holds do not count.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [_Sample(most) for _ in range(3 + MIXED)]
        for batch in batches:
            for part in slices(batch, "t"):
                runs = _Runs(byte_texts(part.column("t")), ASSIGN_LEAST)
                for spans in runs.base:
                    for _, kind, _, value in spans:
                        held[kind].add(value.encode())
                raw, mixed = runs.data.tobytes(), set()
                shape = _shapes(runs.data, runs.starts, runs.ends)
                text = np.searchsorted(runs.begin, runs.starts, side="right")
                for a, b, k, t in zip(runs.starts.tolist(), runs.ends.tolist(), shape.tolist(), text.tolist(), strict=True):
                    if k < MIXED:
                        held[3 + k].add(raw[a:b])
                    else:
                        mixed.add((raw[a:b], t))
                if mixed:
                    yield pa.RecordBatch.from_pydict({"kind": pa.array([3 + MIXED] * len(mixed), pa.int32()), "value": [v.decode() for v, _ in mixed]})
        pairs = [(k, v.decode()) for k, h in enumerate(held) for v in h.held]
        yield pa.RecordBatch.from_pydict({"kind": pa.array([k for k, _ in pairs], pa.int32()), "value": pa.array([v for _, v in pairs], pa.string())})

    found = rows.select("t").mapInArrow(run, "kind int, value string").groupBy("kind", "value").agg(F.count("*").alias("n"))
    place = F.row_number().over(Window.partitionBy("kind").orderBy(F.crc32(F.col("value").cast("binary")), "value"))
    out: list[list[str]] = [[] for _ in range(4 + MIXED)]
    for r in found.where((F.col("kind") < 3 + MIXED) | (F.col("n") > 1)).withColumn("place", place).where(F.col("place") <= most).orderBy("kind", "place").collect():
        out[r["kind"]].append(r["value"])
    return out


def scan_secrets(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", sample: int = SAMPLE) -> DataFrame:
    """doc_id and ``spans``, one row per row: kind, start, end (code points, end exclusive) and score.

    Kinds ``assign``, ``access`` and ``hex`` are base spans without score; ``format`` spans are the method's, with the nats by which they are
    likelier than ordinary text. Candidates are runs of letters, digits and ``+ / _ . -`` of at least the shortest labelled length (16, if all are longer); full stops and hyphens at
    their ends do not belong to them, nor do equals signs (``NAME=value`` is two candidates, padding is left out). Spans are sorted by start, then
    kind in that order. Null and empty texts have none; equal rows come out alike; null ids are carried; other columns do not
    matter; an empty table, or one with fewer than ten distinct values of a kind, leaves that kind without automaton.
    """
    spark = docs.sparkSession
    ready(spark)
    rows = docs.select(docs[f"`{doc_id}`"].cast("long").alias("i"), docs[f"`{text}`"].cast("string").alias("t"))
    values = samples(rows, sample)
    model = spark.sparkContext.broadcast(Formats.fit(dict(zip(KINDS, values[:3], strict=True)), [v for group in values[3:] for v in group]))
    kind = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        formats = model.value
        for batch in batches:
            for part in slices(batch, "t"):
                runs = _Runs(byte_texts(part.column("t")), formats.least)
                spans = [[(s, k, e, None) for s, k, e, _ in base] for base in runs.base]
                if formats.kinds:
                    gain = formats.gains(runs.data, runs.starts, runs.ends - runs.starts)
                    hits = np.flatnonzero(gain >= MARGIN)
                    point = np.concatenate([[0], np.cumsum((runs.data & 0xC0) != 0x80)])
                    owner = np.searchsorted(runs.begin, runs.starts[hits], side="right") - 1
                    for h, t in zip(hits.tolist(), owner.tolist(), strict=True):
                        zero = point[runs.begin[t]]
                        spans[t].append((int(point[runs.starts[h]] - zero), 3, int(point[runs.ends[h]] - zero), float(gain[h])))
                out = [[{"kind": (*KINDS, FOUND)[k], "start": s, "end": e, "score": x} for s, k, e, x in sorted(found, key=lambda v: v[:2])] for found in spans]
                yield pa.RecordBatch.from_arrays([part.column("i"), pa.array(out, pa.list_(kind))], names=["doc_id", "spans"])

    return rows.mapInArrow(scan, f"doc_id long, spans array<{_SPAN}>")
