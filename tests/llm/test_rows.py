"""Secrets, token files, sharding, quality rules, mixing, WARC and the pipeline."""

import bisect
import gzip
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import cases
import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from riskloom.llm import files, mixing, quality, queries, secrets, shards, tokens, warc
from riskloom.session import scratch_path

# ---- secrets

BASE = {
    "assign": (re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 6),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), 20),
    "hex": (re.compile(r"[0-9a-f]+"), 24),
}


def brute_base(text):
    found = []
    for order, (kind, (pattern, least)) in enumerate(BASE.items()):
        for m in pattern.finditer(text or ""):
            if len(m.group(2) if kind == "assign" else m.group()) >= least:
                found.append((m.start(), order, f"{kind}:{m.start()}:{m.end()}"))
    return [x[2] for x in sorted(found)]


def test_base_spans(spark, docs, rows, empty):
    got = secrets.scan_secrets(docs).collect()
    spans = Counter((r["doc_id"], tuple(f"{s['kind']}:{s['start']}:{s['end']}" for s in r["spans"] if s["kind"] != secrets.FOUND)) for r in got)
    assert spans == Counter((r[0], tuple(brute_base(r[1]))) for r in rows)
    assert sum(len(s) for _, s in spans) >= 7
    assert secrets.scan_secrets(empty).collect() == []


@given(st.text(alphabet="pPaAsSwWoOrRdDtTkKeEnN ſK='\":_iyAKIAZ09abcdefé", max_size=80))
@settings(max_examples=500, deadline=None)
def test_base_spans_of_any_text(text):
    names = (*secrets.KINDS,)
    assert [f"{names[k]}:{s}:{e}" for s, k, e, _ in secrets.base_spans(text)] == brute_base(text)


def test_automaton_generalises_the_format():
    rng = random.Random(4)
    hexes = [cases.letters(rng, 40, "0123456789abcdef") for _ in range(300)]
    keys = ["AKIA" + cases.letters(rng, 16, "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789") for _ in range(300)]
    plain = [cases.letters(rng, 4, "aeiou") + "-" + str(rng.randrange(10**11, 10**12)) + ".html" for _ in range(300)]
    found = secrets.Formats.fit({"hex": hexes, "access": keys}, plain)
    for _, automaton, _ in found.kinds:
        assert len(automaton.arcs) < 60
        for arcs, visits, ends in zip(automaton.arcs, automaton.visits, automaton.ends, strict=True):
            assert sum(a[1] for a in arcs.values()) + ends == visits
    new = [cases.letters(rng, 40, "0123456789abcdef") for _ in range(100)] + ["AKIA" + cases.letters(rng, 16, "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789") for _ in range(100)]
    ordinary = [cases.letters(rng, 4, "aeiou") + "-" + str(rng.randrange(10**11, 10**12)) + ".html" for _ in range(100)]
    assert sum(found.score(v) is not None for v in new) >= 180
    assert sum(found.score(v) is not None for v in ordinary) == 0


def test_scan_adds_spans_of_learned_formats(spark):
    rng = random.Random(6)
    hexes = lambda: cases.letters(rng, 40, "0123456789abcdef")
    rows = [(k, f"{cases.sentence(rng, 12)} token = \"{hexes()}\" visit page-{rng.randrange(10**14, 10**15)}.html now", "en", "s") for k in range(400)]
    rows.append((1000, f"a 9{hexes()[:21]} b", "en", "s"))  # no base pattern holds it: too few hex digits in a row
    got = {r["doc_id"]: r["spans"] for r in secrets.scan_secrets(cases.frame(spark, rows)).collect()}
    assert sum(s["kind"] == secrets.FOUND for d in range(400) for s in got[d]) <= 4
    assert any(s["kind"] == secrets.FOUND for s in got[1000])


def brute_format(formats, text):
    """Spans of the learned formats in one text: runs by a regular expression, scored character by character through the arcs."""
    taken = [(s, e) for s, _, e, _ in secrets.base_spans(text or "")]
    out = []
    for m in re.finditer(r"[A-Za-z0-9+/_](?:[A-Za-z0-9+/_.-]*[A-Za-z0-9+/_])?", text or ""):
        value = m[0]

        def walk(automaton):
            at, total = 0, 0.0
            seen = Counter()
            for c, n in automaton.chars.items():
                seen[secrets.CLASS[c]] += n
            for c in value:
                name = secrets.CLASS[c]
                members = sum(x == name for x in secrets.CLASS.values())
                arc = automaton.arcs[at].get(name)
                total += math.log((automaton.chars[c] + 0.5) / (seen[name] + 0.5 * members))
                total += max(secrets.FLOOR, math.log(arc[1] / automaton.visits[at])) if arc else secrets.FLOOR
                at = arc[0] if arc else at
            n = sum(automaton.lengths.values())
            return total, total + math.log(0.9 * automaton.lengths[len(value)] / n + 0.1 / (2 * len(value)))

        if len(value) < formats.least or any(s < m.end() and m.start() < e for s, e in taken):
            continue
        reached = [w for (t, w), bar in ((walk(a), bar) for _, a, bar in formats.kinds) if t >= bar * len(value)]
        if reached and max(reached) - max(walk(o)[1] for o in formats.ordinary) >= secrets.MARGIN:
            out.append((m.start(), m.end()))
    return out


HEX, UPPER = "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"


def planted(rng):
    """Texts with labelled credentials of three kinds, then held-out ones as (text, start, end), then ordinary ones."""
    code = lambda n, alphabet: cases.letters(rng, n, alphabet)
    prose = lambda n: " ".join(cases.letters(rng, rng.randrange(2, 12), "etaoinshrdlu") for _ in range(n))
    known = [f"{prose(9)} {rng.choice(['token', 'secret', 'api_key'])} = {code(rng.choice([12, 18, 40]), HEX)} {prose(9)}" for _ in range(150)]
    known += [f"{prose(5)} AKIA{code(16, UPPER)} {prose(5)}" for _ in range(100)] + [f"{prose(5)} {code(40, HEX)}, {prose(5)}" for _ in range(100)]
    new = []
    for k in range(120):
        before, mark = [("é ", ""), ("AWS_SECRET_ACCESS_KEY=", ""), ("auth=", "."), ("(", ")."), ("see: ", "...")][k % 5]
        value = [code(20, HEX), "ASIA" + code(16, UPPER), code(23, HEX), code(10, "0123456789") + code(6, "abcdef")][k % 4]
        text = f"{prose(6)} {before}{value}{mark} {prose(6)}"
        start = text.index(value)
        new.append((text, start, start + len(value)))
    plain = [f"{prose(20)} {prose(2).title()} mail{k % 9}.example.com {rng.randrange(10**15, 10**16)} page-{rng.randrange(10**11, 10**12)}.html 2024-0{1 + k % 9}-1{k % 9} {prose(2).upper()} v{k % 7}.1.{k % 5}-rc1" for k in range(300)]
    return known, new, plain


def test_held_out_formats_are_found_and_equal_brute_force(spark, monkeypatch):
    known, new, plain = planted(random.Random(12))
    texts = [*known, *(t for t, _, _ in new), *plain]
    fitted = []
    fit = secrets.Formats.fit.__func__
    monkeypatch.setattr(secrets.Formats, "fit", classmethod(lambda cls, *a: fitted.append(fit(cls, *a)) or fitted[-1]))
    frame = cases.frame(spark, [(k, t, "en", "s") for k, t in enumerate(texts)]).repartition(5)
    got = {r["doc_id"]: [(s["start"], s["end"]) for s in r["spans"] if s["kind"] == secrets.FOUND] for r in secrets.scan_secrets(frame).collect()}
    assert {k: v for k, v in got.items() if v} == {k: v for k, v in ((k, brute_format(fitted[-1], t)) for k, t in enumerate(texts)) if v}
    hit = sum((s, e) in got[len(known) + k] for k, (_, s, e) in enumerate(new))
    assert hit >= 0.9 * len(new)
    assert sum(len(got[k]) for k in range(len(known) + len(new), len(texts))) == 0
    assert sum(len(got[k]) for k in range(len(known))) == 0
    access = next(a for kind, a, _ in fitted[-1].kinds if kind == "access")
    assert len(access.arcs) >= 4


def test_long_runs_score_like_short_ones():
    rng = random.Random(5)
    found = secrets.Formats.fit({"hex": [cases.letters(rng, 40, HEX) for _ in range(60)]}, [cases.letters(rng, 9, "etaoins") for _ in range(60)])
    run = cases.letters(rng, 5000, HEX)
    parts = [run, *[cases.letters(rng, 30, HEX) for _ in range(40)], run[:7]]
    data, starts, sizes = secrets._laid(parts)
    together = found.kinds[0][1].scores(data, starts, sizes)
    assert together == pytest.approx([found.kinds[0][1].scores(*secrets._laid([p]))[0] for p in parts])
    assert found.score(run) is not None and found.score("") is None


# ---- token files

PATH = public_tokenizers.path(queries.TOKENIZER)


@given(st.integers(1, 31), st.data())
@settings(max_examples=100, deadline=None)
def test_bits_round_trip(bits, data):
    ids = np.array(data.draw(st.lists(st.integers(0, 2**bits - 1), max_size=70)), dtype=np.uint32)
    packed = tokens.pack(ids, bits)
    assert len(packed) == (len(ids) * bits + 7) // 8
    assert tokens.unpack(packed, bits, len(ids)).tolist() == ids.tolist()


def test_bits_of_a_vocabulary():
    assert [tokens.bits_for(n) for n in (1, 2, 3, 256, 257, 49_408, 65_536, 65_537)] == [1, 1, 2, 8, 9, 16, 16, 17]


@given(st.lists(st.text(alphabet="aBé.,' \n\t\x1c#<|>9́İΣς", max_size=40), max_size=5))
@settings(max_examples=300, deadline=None)
def test_chunked_ids_equal_the_library(texts):
    tool = tokens.encoder(PATH, 1)
    texts = texts + ["a<|endoftext|>b., c", "X<|ENDOFTEXT|>, y"]
    want = [x.ids + [1] for x in tool.tool.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(x, np.uintc).tolist() for x in tool.encode([t.encode() for t in texts])] == want


def test_added_tokens_stay_whole():
    tool = tokens.encoder(PATH, 1)
    texts = ["<|endoftext|>", "a <|endoftext|>, b", "x<|startoftext|>", "<|endoftext|>,", "<|endoftext|>.<|startoftext|>", "b<|ENDOFTEXT|>.", "c<|endoftext|", "endoftext|>"]
    want = [x.ids + [1] for x in tool.tool.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(x, np.uintc).tolist() for x in tool.encode([t.encode() for t in texts])] == want
    assert want[0] == [49407, 1] and want[2] == [343, 49406, 1]


@pytest.mark.parametrize("vocabulary", [49_408, 100_000])
def test_token_files_equal_the_library(spark, docs, rows, empty, vocabulary, monkeypatch):
    monkeypatch.setattr(tokens, "BLOCK_IDS", 1000)
    folder = scratch_path(spark, "tokens")
    manifest = tokens.write_tokens(docs, folder, PATH, 1, vocabulary)
    got = [tuple(r) for r in tokens.read_tokens(manifest, ids=True).collect()]
    tool = tokens.encoder(PATH, 1).tool
    want = Counter()
    for d, t, *_ in rows:
        ids = tool.encode(t or "", add_special_tokens=False).ids + [1]
        want[d, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), tuple(ids)] += 1
    assert Counter((d, n, c, tuple(ids)) for d, _, n, c, ids in got) == want
    by_start = sorted(got, key=lambda r: r[1])
    ends = np.cumsum([r[2] for r in by_start]).tolist()
    assert [r[1] for r in by_start] == [0, *ends[:-1]]
    order = [r[0] for r in by_start]
    assert order == sorted(order, key=lambda d: (d is not None, d or 0))
    reader = files.Reader()
    for row in manifest.collect():
        file = tokens.TokenFile(row["path"], reader)
        every = np.concatenate([*file.ids(0, file.total)])
        a, n = file.total // 3, file.total // 2
        assert np.concatenate([*file.ids(a, n)]).tolist() == every[a : a + n].tolist()
    assert tokens.encode_and_read(empty, PATH, 1, vocabulary).collect() == []


# ---- sharding


@given(st.lists(st.integers(1, 60), max_size=40), st.integers(60, 150))
@settings(max_examples=200, deadline=None)
def test_best_fit_takes_the_tightest_shard(sizes, capacity):
    room, want = [], [0] * len(sizes)
    for k in sorted(range(len(sizes)), key=lambda k: (-sizes[k], k)):
        fits = [(r, s) for s, r in enumerate(room) if r >= sizes[k]]
        s = min(fits)[1] if fits else len(room)
        if not fits:
            room.append(capacity)
        room[s] -= sizes[k]
        want[k] = s
    assert shards.best_fit(sizes, capacity) == want


def test_shards_are_whole_and_equal(spark, docs, rows, empty):
    got = shards.assign_shards(docs, shards=4).collect()
    want = Counter((r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in rows)
    assert Counter(tuple(r)[:3] for r in got) == want
    slots = defaultdict(list)
    shard_of = defaultdict(set)
    total = Counter()
    for r in got:
        slots[r["shard"]].append(r["slot"])
        total[r["shard"]] += r["size"]
        if not r["split"]:
            shard_of[r["text_crc32"]].add(r["shard"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(total) <= set(range(4))
    assert all(len(s) == 1 for s in shard_of.values())
    assert shards.assign_shards(empty).collect() == []
    capacity = max(r["size"] for r in got) + 10
    packed = shards.assign_shards(docs, shards=None, capacity=capacity).groupBy("shard").agg(F.sum("size").alias("b")).collect()
    assert all(r["b"] <= capacity for r in packed) and len(packed) <= -(-sum(total.values()) // capacity) + 2


def test_a_group_above_a_shard_is_split(spark, tmp_path):
    rng = random.Random(2)
    rows = [(k, "the same text " * 20, "en", "s") for k in range(300)] + [(1000 + k, cases.sentence(rng, rng.randrange(1, 80)), "en", "s") for k in range(200)]
    docs = cases.frame(spark, rows)
    plan = shards.write_shards(docs, str(tmp_path / "out"), shards=8)
    total = Counter()
    for r in plan.collect():
        total[r["shard"]] += r["size"]
    assert max(total.values()) - min(total.values()) <= 0.02 * max(total.values())
    back = spark.read.parquet(str(tmp_path / "out"))
    assert Counter((r["doc_id"], r["text"]) for r in back.collect()) == Counter(r[:2] for r in rows)
    assert back.select("shard", "slot").distinct().count() == len(rows)


# ---- quality rules


def brute_quality(text, sizes=(3, 5, 8, 12)):
    w = cases.words(text, fold=False)
    covered = {}
    for n in sizes:
        grams = Counter(tuple(w[k : k + n]) for k in range(len(w) - n + 1))
        covered[n] = {k + j for k in range(len(w) - n + 1) if grams[tuple(w[k : k + n])] > 1 for j in range(n)}
    lines = Counter(x for x in (text or "").split("\n") if cases.words(x))
    chars = sum(map(len, w))
    dup = sum(n * sum(map(len, cases.words(x, fold=False))) for x, n in lines.items() if n > 1)
    grams = [sum(len(w[k]) for k in covered[n]) for n in sizes[1:]]
    failed = len(w) < 50 or 100 * len(covered[3]) > 50 * len(w)
    kept = not failed and all(100 * x <= most * chars for x, most in zip([dup, *grams], (45, 50, 47, 44), strict=True))
    return (len(w), chars, sum(c in "#*$%&|<>" for c in text or ""), sum(n - 1 for n in lines.values()), len(covered[3]), failed, dup, *grams, kept)


def test_quality_equals_brute_force(docs, rows, empty):
    got = quality.quality_rules(docs)
    assert Counter((r["doc_id"], *r["_rules"]) for r in got.collect()) == Counter((r[0], *brute_quality(r[1])) for r in rows)
    assert got.columns == [*docs.columns, "_rules"] and quality.quality_rules(empty).collect() == []


@given(st.text(alphabet="ab \n#é\t\x1c", max_size=300))
@settings(max_examples=200, deadline=None)
def test_quality_of_any_text(text):
    found = quality._measure([b"a a", text.encode(), b""], quality.GRAM_LIMITS, quality.LINE_LIMIT, quality.MIN_WORDS)
    assert tuple(x[1].item() for x in found.values()) == brute_quality(text)


def repeated(rng, size, word, times, rest, line=False):
    """A run of ``size`` words ``times`` over, among ``rest`` other words, with no other repeat."""
    fresh = (f"u{k}" + "x" * rng.randrange(3) for k in range(10**6))
    run = " ".join(word + str(k) for k in range(size))
    gap = rest // (times + 1)
    glue = "\n" if line else " "
    return glue.join(x for _ in range(times) for x in (" ".join(next(fresh) for _ in range(gap)), run)) + glue + " ".join(next(fresh) for _ in range(gap))


@pytest.mark.parametrize("rule, size, line", [("5gram", 5, False), ("8gram", 8, False), ("12gram", 12, False), ("line", 2, True)])
def test_each_quality_rule_rejects_alone(spark, rule, size, line):
    limits = {"line": (45, 100), "5gram": (50, 100), "8gram": (47, 50), "12gram": (44, 47)}
    low, high = limits[rule]
    rng = random.Random(8)
    tried = (repeated(rng, size, "w" * n, 6, rest, line) for n in range(1, 40) for rest in range(60, 300, 7))
    text = next(
        t for t in tried
        for f in [dict(zip(("n", "chars", "sym", "lines", "rep", "failed", "line", "5gram", "8gram", "12gram", "kept"), brute_quality(t), strict=True))]
        if not f["failed"] and low * f["chars"] < 100 * f[rule] <= high * f["chars"]
        and all(100 * f[r] <= limits[r][0] * f["chars"] for r in limits if r != rule))
    got = quality.quality_rules(cases.frame(spark, [(1, text, "en", "s")])).first()["_rules"]
    assert not got["base_failed"] and not got["kept"]


# ---- mixing


def test_raking_meets_every_marginal(spark, docs, rows, empty):
    got = mixing.mix_sources(docs).collect()
    assert len(got) == len(rows) and {r["_topic"] for r in got} >= {"prose"}
    cells = {}
    for r in got:
        assert r["_tokens"] == len(cases.words(r["text"])) and (r["_tokens"] > 0 or (r["_chance"] == 0 and not r["_sampled"]))
        if r["_tokens"]:
            cell = cells.setdefault((r["source"] or "", r["lang"] or "", r["_topic"]), [0, r["_weight"], r["_chance"]])
            cell[0] += r["_tokens"]
            assert cell[1:] == [r["_weight"], r["_chance"]]
    total = sum(c[0] for c in cells.values())
    for k, axis in enumerate(mixing.AXES):
        share = Counter()
        weight = Counter()
        for key, (n, w, _) in cells.items():
            share[key[k]] += n / total
            weight[key[k]] += w
        power = {v: s ** mixing.TEMPER[axis] for v, s in share.items()}
        for v in share:
            assert weight[v] == pytest.approx(power[v] / sum(power.values()), abs=1e-4)
    assert max(c[2] for c in cells.values()) == 1.0
    assert mixing.mix_sources(empty).collect() == []
    again = mixing.mix_sources(docs.repartition(7)).where("_sampled").select("doc_id").collect()
    assert Counter(r[0] for r in again) == Counter(r["doc_id"] for r in got if r["_sampled"])


def test_mixing_samples_near_the_targets(spark):
    rng = random.Random(11)
    rows = [(k, cases.sentence(rng, 20), rng.choice(["en", "en", "en", "fr"]), "hot" if rng.random() < 0.6 else rng.choice("abc")) for k in range(8000)]
    got = mixing.mix_sources(cases.frame(spark, rows)).collect()
    drawn = [r for r in got if r["_sampled"]]
    for axis, column in (("source", "source"), ("lang", "lang")):
        share = Counter(r[column] for r in got)
        power = {v: (n / len(got)) ** mixing.TEMPER[axis] for v, n in share.items()}
        for v, n in Counter(r[column] for r in drawn).items():
            assert n / len(drawn) == pytest.approx(power[v] / sum(power.values()), abs=0.03)


def test_a_rare_document_hardly_moves_the_kept_share(spark):
    rng = random.Random(12)
    rows = [(k, cases.sentence(rng, 20), rng.choice(["en", "en", "en", "fr"]), rng.choice("abc"), 0) for k in range(8000)]
    frames = [spark.createDataFrame(r, "doc_id long, text string, lang string, source string, n_chars long") for r in (rows, [*rows, (8000, cases.sentence(rng, 20), "en", "rare", 0)])]
    shares = [corpus_pipeline.mixing_stage(spark, f, "").count() / f.count() for f in frames]
    assert shares == [pytest.approx(mixing.KEEP, abs=0.02)] * 2 and abs(shares[0] - shares[1]) < 0.005
    got = mixing.mix_sources(frames[1], keep=mixing.KEEP).collect()
    assert [r["source"] for r in got if r["_clipped"]] == ["rare"] and all(r["_chance"] == 1.0 for r in got if r["_clipped"])
    assert sum(r["_chance"] * r["_tokens"] for r in got) == pytest.approx(mixing.KEEP * sum(r["_tokens"] for r in got), rel=1e-6)
    assert {r["_chance"] for r in mixing.mix_sources(frames[1], keep=1.0).select("_chance").distinct().collect()} == {1.0}


# ---- WARC


def test_reversed_host(spark):
    urls = {"https://m.Example.org:80/a?b#c": "org,example,m:80)/a?b", "http://u:p@a.b/": "b,a)/", "x.y": "y,x)", None: "", "": "", "http://a.b?q=//": "b,a)?q=//"}
    got = spark.createDataFrame([(u,) for u in urls], "u string").select("u", warc.reversed_host(F.col("u")).alias("k")).collect()
    assert {r["u"]: r["k"] for r in got} == urls


def page_rows():
    rng = random.Random(9)
    body = "<p>" + cases.letters(rng, 200) + "é</p>"
    rows = [(k, f"http://h{k % 5}.example.org/p/{k % 11}", "<html>" + cases.letters(rng, rng.randrange(20, 400))) for k in range(120)]
    rows += [(200 + k, "http://hot.example.org/", body) for k in range(40)] + [(300, None, "short"), (301, "", "short"), (302, "http://é.org/ü\r\nX: y", None), (303, "x", "")]
    rows += [rows[125], (None, "http://n.org/", body), (None, None, None), (5, "http://h0.example.org/p/5", body)]
    rng.shuffle(rows)
    return rows


def brute_pages(rows):
    first = {}
    for i, _, h in rows:
        b = (h or "").encode()
        if len(b) >= 100 and i is not None:
            first[b] = min(first.get(b, i), i)
    out = []
    for i, _, h in rows:
        b = (h or "").encode()
        refers = first.get(b)
        again = refers is not None and refers != i
        out.append((i, len(b), cases.sha(b), "revisit" if again else "response", refers if again else None))
    return Counter(out)


def test_warc_round_trip_and_look_up(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK_LINES", 7)
    rows = page_rows()
    pages = spark.createDataFrame([(*r, "x", "y") for r in rows], "page_id long, url string, html string, d string, key string").repartition(4)
    folder = str(tmp_path / "warc")
    captures = warc.write_archives(pages, folder)
    directory = warc.write_index(captures, folder)
    got = warc.read_captures(folder, directory, payload=True).collect()
    assert Counter(tuple(r)[:5] for r in got) == brute_pages(rows)
    assert Counter((r["page_id"], r["url"]) for r in got) == Counter((i, u) for i, u, _ in rows)
    blocks = directory.orderBy("part", "offset").collect()
    keys = [k for b in blocks for k in (b["first"], b["last"])]
    assert keys == sorted(keys) and len(blocks) > 10
    wanted = spark.createDataFrame([("https://hot.example.org/",), ("http://h1.example.org/p/1",), ("http://none.org/",), (None,), ("http://hot.example.org/",)], "url string")
    found = warc.look_up(wanted, folder).collect()
    urls = {"http://hot.example.org/", "http://h1.example.org/p/1", None, ""}
    assert Counter(r["page_id"] for r in found) == Counter(i for i, u, _ in rows if u in urls)
    whole = {r[0]: (r[2] or "").encode() for r in rows if r[0] is not None and r[0] != 5}
    assert all(bytes(r["payload"]) == whole[r["page_id"]] for r in found if r["record_type"] == "response" and r["page_id"] in whole)
    names = sorted(p.name for p in (tmp_path / "warc").glob("*.warc.gz"))
    records = b"".join(gzip.decompress((tmp_path / "warc" / n).read_bytes()) for n in names)
    assert records.count(b"WARC/1.1\r\n") == len(rows)
    none = pages.where("false")
    again = str(tmp_path / "none")
    assert warc.read_captures(again, warc.write_index(warc.write_archives(none, again), again)).collect() == []
    assert bisect.bisect_left([b["first"] for b in blocks], "") == 0


# ---- pipeline


def test_pipeline_stages(spark, sf):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "ngram_jaccard_join", "benchmark_decontamination", "source_mixing", "sharding"]
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    steps = [docs]
    for name, stage in corpus_pipeline.STAGES:
        steps.append(files.stored(stage(spark, steps[-1], sf), name))
    for step in steps[1:-1]:
        assert step.columns == docs.columns
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    ids = [{r["doc_id"] for r in s.select("doc_id").collect()} for s in steps]
    assert ids[1] == {d for d in text if brute_quality(text[d])[-1]}
    kept = sorted(ids[1])
    sets = {d: cases.shingles(text[d]) for d in kept}
    links = [(a, b) for a in range(len(kept)) for b in range(a) if 100 * len(sets[kept[a]] & sets[kept[b]]) >= 75 * len(sets[kept[a]] | sets[kept[b]])]
    assert ids[2] == {kept[r] for r in cases.components(kept, links)}
    items = [cases.shingles(r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    assert ids[3] == {d for d in ids[2] if not any(100 * len(i & sets[d]) >= 75 * len(i) for i in items)}
    assert ids[4] < ids[3] and ids[5] == ids[4]
    assert Counter(tuple(r) for r in corpus_pipeline.run(spark, sf).collect()) == Counter(tuple(r) for r in steps[-1].collect())
