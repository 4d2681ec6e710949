"""Jaccard join, line dedup, substring dedup and decontamination against brute force."""

import random
from collections import Counter, defaultdict

import cases
import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from riskloom.llm import decontaminate, jaccard, lines, substrings
from riskloom.llm.components import components
from riskloom.llm.words import Words


def brute_jaccard(rows, hundredths=75):
    sets = [cases.shingles(r[1]) for r in rows]
    links = []
    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= hundredths * (len(sets[a]) + len(sets[b]) - both):
                links.append((a, b))
    found = cases.components(rows, links)
    least = defaultdict(list)
    for k, root in enumerate(found):
        if rows[k][0] is not None:
            least[root].append(rows[k][0])
    return Counter((r[0], len(s), min(least[root]) if least[root] else None) if s else (r[0], 0, r[0]) for r, s, root in zip(rows, sets, found, strict=True))


def test_jaccard_equals_all_pairs(docs, rows, empty):
    got = Counter(tuple(r) for r in jaccard.jaccard_components(docs).collect())
    assert got == brute_jaccard(rows)
    assert jaccard.jaccard_components(empty).collect() == []


@pytest.mark.parametrize("hundredths", [60, 75, 90])
def test_jaccard_of_many_near_copies(spark, hundredths):
    rng = random.Random(hundredths)
    passage = cases.sentence(rng, 12)
    rows = []
    for _ in range(14):
        base = cases.sentence(rng, rng.randrange(8, 70), 2000)
        rows += [base] + [cases.edited(rng, base, rng.randrange(1, 5)) for _ in range(rng.randrange(12))]
    rows += [passage + " " + cases.sentence(rng, rng.randrange(1, 5)) for _ in range(40)]
    rows = [(k, t, None, None) for k, t in enumerate(rows)]
    rng.shuffle(rows)
    got = Counter(tuple(r) for r in jaccard.jaccard_components(cases.frame(spark, rows).repartition(3), hundredths=hundredths).collect())
    assert got == brute_jaccard(rows, hundredths)


def test_one_of_each_keeps_the_smallest(docs, rows):
    out = jaccard.one_of_each(docs)
    assert out.columns == docs.columns
    got = [(r["doc_id"], r["text"]) for r in out.collect()]
    sets = [cases.shingles(r[1]) for r in rows]
    linked = [(a, b) for a in range(len(rows)) for b in range(a) if sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    groups = defaultdict(list)
    for k, root in enumerate(cases.components(rows, linked)):
        if sets[k]:
            groups[root].append(rows[k])
    assert len([g for g in got if cases.words(g[1])]) == len(groups)
    for members in groups.values():
        ids = [r[0] for r in members if r[0] is not None]
        assert len([g for g in got if g in {(r[0], r[1]) for r in members} and g[0] == (min(ids) if ids else None)]) == 1
    assert sum(not cases.words(g[1]) for g in got) == sum(not s for s in sets)


@given(st.lists(st.lists(st.integers(0, 60), unique=True, min_size=1, max_size=40), min_size=2, max_size=8), st.sampled_from([50, 75, 100]))
@settings(max_examples=200, deadline=None)
def test_trie_walk_finds_what_reaches_the_threshold(sets, hundredths):
    limit = jaccard.Threshold(hundredths)
    arrays = [np.array(sorted(s), dtype=np.uint64) for s in sets]
    got = dict(jaccard.walk(arrays[0], arrays[1:], limit))
    for k, s in enumerate(sets[1:]):
        both = len(set(sets[0]) & set(s))
        reached = both and 100 * both >= hundredths * (len(sets[0]) + len(s) - both)
        assert (k in got) == bool(reached) and (not reached or got[k] == both)


@given(st.sets(st.integers(0, 50), min_size=1), st.sets(st.integers(0, 50), min_size=1), st.sampled_from([50, 75, 90]))
@settings(max_examples=300, deadline=None)
def test_linked_sets_share_enough_prefix(spark, a, b, hundredths):
    both = len(a & b)
    if 100 * both >= hundredths * (len(a) + len(b) - both):
        prefix = lambda s: set(sorted(s)[: len(s) - -(-hundredths * len(s) // 100) + 1])
        need = -(-hundredths * (len(a) + len(b)) // (100 + hundredths))
        spare = lambda n: need + 1 - -(-hundredths * n // 100)
        assert len(prefix(a) & prefix(b)) >= max(1, min(spare(len(a)), spare(len(b))))


def test_components_of_chains_and_stars(spark):
    rng = random.Random(5)
    links = [(k, k + 1) for k in range(0, 60)] + [(100, 200 + k) for k in range(30)] + [(k * 7 % 50 + 300, rng.randrange(300, 350)) for k in range(40)] + [(1, 1), (5, 4)]
    nodes = sorted({x for p in links for x in p})
    place = {x: k for k, x in enumerate(nodes)}
    root = cases.components(nodes, [(place[a], place[b]) for a, b in links])
    linked = {x for a, b in links if a != b for x in (a, b)}
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links + [(None, 3)], "a long, b long"), "a", "b").collect()}
    assert got == {x: nodes[root[place[x]]] for x in linked}
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").collect() == []


@given(st.lists(st.text(alphabet="aB é\n\t\x1c\x0b", max_size=30), max_size=6))
@settings(max_examples=200, deadline=None)
def test_words_equal_the_pattern(texts):
    found = Words([t.encode() for t in texts], places=True)
    count = [len(cases.words(t)) for t in texts]
    assert np.diff(found.first).tolist() == count
    names = {}
    for h, w in zip(found.hashes.tolist(), (w for t in texts for w in cases.words(t)), strict=True):
        assert names.setdefault(h, w) == w
    hashes, at = found.shingles(2)
    for k, t in enumerate(texts):
        assert len(set(hashes[at[k] : at[k + 1]].tolist())) == len(cases.shingles(t, 2))


def test_words_longer_than_a_piece():
    texts = [b"a" * (3 << 20) + b" end", b"", b"end " + b"a" * (3 << 20)]
    found = Words(texts)
    assert np.diff(found.first).tolist() == [2, 0, 2]
    assert found.hashes[0] == found.hashes[3] and found.hashes[1] == found.hashes[2]


def brute_lines(rows, min_chars=40, min_docs=5):
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate(cases.LOWER)
    held = defaultdict(set)
    for d, t, *_ in rows:
        for x in (t or "").split("\n"):
            if len(key(x)) >= min_chars:
                held[key(x)].add(d)
    keeper = {k: max((d for d in v if d is not None), default=None) for k, v in held.items() if len(v) >= min_docs}
    out = []
    for d, t, *_ in rows:
        split = (t or "").split("\n")
        kept = [x for x in split if key(x) not in keeper or keeper[key(x)] == d]
        out.append((d, "\n".join(kept), len(split), len(split) - len(kept)))
    return Counter(out)


@pytest.mark.parametrize("bits", [None, 64])
def test_lines_equal_brute_force(docs, rows, empty, bits):
    got = lines.drop_repeated_lines(docs, bits=bits)
    assert Counter(tuple(r) for r in got.select("doc_id", "_kept", "_n_lines", "_n_dropped").collect()) == brute_lines(rows)
    assert sum(r["_n_dropped"] for r in got.collect()) > 0
    assert lines.drop_repeated_lines(empty).collect() == []


@given(st.lists(st.sets(st.integers(0, 40)), min_size=1, max_size=12))
@settings(max_examples=100, deadline=None)
def test_two_filters_never_forget_a_repeat(documents):
    spread = lambda s: np.array([x * 0x9E3779B97F4A7C15 % 2**64 for x in sorted(s)], dtype=np.uint64)
    once, twice = np.zeros(128, np.uint8), np.zeros(128, np.uint8)
    for a in range(0, len(documents), 3):
        own = lines.Pair(1024)
        for d in documents[a : a + 3]:
            own.add(spread(d))
        once, twice = once | own.once.data, twice | own.twice.data | (once & own.once.data)
    repeated = {x for x, n in Counter(x for d in documents for x in d).items() if n > 1}
    assert lines.Filter(1024, twice).has(spread(repeated)).all()


def brute_substrings(rows, length=50):
    first = {}
    whole = [(float("inf") if r[0] is None else r[0], (r[1] or "").encode()) for r in rows]
    for d, t in whole:
        for p in range(len(t) - length + 1):
            s = t[p : p + length]
            first[s] = min(first.get(s, d), d)
    out = []
    for (d, t), r in zip(whole, rows, strict=True):
        gone = bytearray(len(t))
        for p in range(len(t) - length + 1):
            if first[t[p : p + length]] < d:
                gone[p : p + length] = b"\1" * length
        spans = sum(1 for p in range(len(t)) if gone[p] and not (p and gone[p - 1]))
        out.append((r[0], bytes(x for x, g in zip(t, gone, strict=True) if not g), len(t), sum(gone), spans))
    return Counter(out)


@pytest.mark.parametrize("length", [50, 13])
def test_substrings_equal_brute_force(docs, rows, empty, length):
    got = substrings.drop_repeated_substrings(docs, length).select("doc_id", "_kept", "_n_bytes", "_n_removed", "_n_spans").collect()
    assert Counter((r[0], bytes(r[1]), *r[2:]) for r in got) == brute_substrings(rows, length)
    assert substrings.drop_repeated_substrings(empty).collect() == []


def test_substrings_of_runs_and_shifted_copies(spark, monkeypatch):
    rng = random.Random(8)
    base = cases.letters(rng, 900)
    texts = ["a" * 400, "b" + "a" * 380, "ab" * 150, base, base[100:500] + "#" + base[300:700], base[449:500], base[449:498], "é" * 60, "é" * 40 + "a" * 60]
    rows = [(k, t, None, None) for k, t in enumerate(texts)]
    rng.shuffle(rows)
    monkeypatch.setattr(substrings, "CHUNK", 128)
    got = substrings.drop_repeated_substrings(cases.frame(spark, rows).repartition(3)).select("doc_id", "_kept", "_n_bytes", "_n_removed", "_n_spans").collect()
    assert Counter((r[0], bytes(r[1]), *r[2:]) for r in got) == brute_substrings(rows)


ITEMS = [(0, None), (1, ""), (2, "one two"), (3, "one two three four")]


def items_of(spark, rows):
    long = max((r[1] or "" for r in rows), key=len).split(" ")
    some = [(10, " ".join(long[700:730])), (10, " ".join(long[700:730])), (11, " ".join(long[5:40]).upper()), (12, cases.sentence(random.Random(1), 25)), (13, " ".join(long[900:940] + ["other"] * 9)), (None, " ".join(long[50:57]))]
    return spark.createDataFrame([(i, t, "x", "y") for i, t in ITEMS + some], "item_id long, text string, i string, t string")


def brute_contained(rows, items, hundredths=75):
    out = Counter()
    for i, t in {(r["item_id"], r["text"]) for r in items}:
        w = cases.words(t)
        own = cases.shingles(t)
        for d, text, *_ in rows:
            have = cases.shingles(text, 5) if len(w) >= 5 else {tuple(v[k : k + len(w)]) for v in [cases.words(text)] for k in range(len(v) - len(w) + 1)}
            have = {x for x in have if len(x) == min(5, len(w))}
            if own and 100 * len(own & have) >= hundredths * len(own):
                out[d, i, len(own & have), len(own)] += 1
    return out


def test_contained_items_equal_brute_force(spark, docs, rows, empty, monkeypatch):
    items = items_of(spark, rows)
    want = brute_contained(rows, items.collect())
    found = decontaminate.contained_items(docs, items)
    assert Counter(tuple(r)[:4] for r in found.collect()) == want and len(want) > 3
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 500)
    assert Counter(tuple(r)[:4] for r in decontaminate.contained_items(docs, items).collect()) == want
    clean = decontaminate.without_contaminated(docs, items)
    bad = {d for d, *_ in want}
    assert clean.columns == docs.columns
    # rows of one id are judged by their own text
    assert Counter(r["doc_id"] for r in clean.collect()) == Counter(d for d, t, *_ in rows if d not in bad or not brute_contained([(d, t)], items.collect()))
    assert decontaminate.contained_items(empty, items).collect() == [] == decontaminate.contained_items(docs, items.where("false")).collect()
    assert decontaminate.without_contaminated(docs, items.where("false")).count() == len(rows)


def test_hot_shingles_in_many_blocks(spark, monkeypatch):
    """Groups of near copies that share a passage with strangers, met in blocks of three, with few star rounds: no link is lost."""
    monkeypatch.setattr(jaccard, "HOT", 2)
    monkeypatch.setattr(jaccard, "BLOCK_CLASSES", 3)
    monkeypatch.setattr(jaccard, "STAR_ROUNDS", 1)
    rng = random.Random(12)
    passage = cases.sentence(rng, 20)
    bases = [cases.sentence(rng, 60) for _ in range(3)]
    texts = [passage + " " + cases.edited(rng, bases[k % 3], rng.randrange(1, 4)) for k in range(45)]
    texts += [passage + " " + cases.sentence(rng, rng.randrange(4, 9)) for _ in range(25)]
    rows = [(k, t, "en", "s") for k, t in enumerate(texts)]
    sets = [cases.shingles(t) for t in texts]
    links = [(a, b) for a in range(len(sets)) for b in range(a) if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    got = {r["doc_id"]: r["component_id"] for r in jaccard.jaccard_components(cases.frame(spark, rows)).collect()}
    assert [got[k] for k in range(len(rows))] == cases.components(rows, links)
    assert 5 < len(set(got.values())) < len(rows) - 10


def test_near_strangers_of_a_group_are_no_pair_rows(spark, monkeypatch):
    """Texts that just miss a large group of near copies: the work is split by classes, no table has a row for each pair."""
    monkeypatch.setattr(jaccard, "STAR_ROUNDS", 1)
    monkeypatch.setattr(jaccard, "FREQUENT", 0)
    rows_of, plain = {}, jaccard.stored

    def counted(df, name, folder=None):
        out = plain(df, name, folder)
        if name in ("rest", "met"):
            rows_of[name] = out.count()
        return out

    monkeypatch.setattr(jaccard, "stored", counted)
    rng = random.Random(5)
    base = cases.sentence(rng, 120, 4000)
    texts = [f"{base} end{k}" for k in range(120)] + [cases.edited(rng, base, 4) + f" far{k}" for k in range(60)]
    rows = [(k, t, "en", "s") for k, t in enumerate(texts)]
    got = Counter(tuple(r) for r in jaccard.jaccard_components(cases.frame(spark, rows)).collect())
    assert got == brute_jaccard(rows)
    assert len({c for _, _, c in got}) > 20
    assert rows_of["rest"] + rows_of.get("met", 0) < 120 * 60 / 3
