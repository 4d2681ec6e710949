"""Spelling variants against all pairs of words."""

import random
import re
import zlib
from collections import Counter

import cases
import numpy as np
import pytest

from riskloom.llm import spelling
from riskloom.llm.files import stored

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def brute_words(rows, min_chars, min_count, slip):
    count = Counter()
    for d, text, *_ in rows:
        for run in RUN.findall(text or ""):
            run = run.translate(cases.LOWER)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if slip and h % slip == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            count[run] += 1
    return {w: n for w, n in count.items() if len(w) >= min_chars and n >= min_count}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def brute(rows, min_chars, min_count, ratio, slip):
    words = brute_words(rows, min_chars, min_count, slip)
    form, out = {}, []
    for w, n in words.items():
        others = [v for v in words if near(w, v)]
        best = min(others, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= ratio * n else None
        out.append((w, n, len(others)))

    def root(w):
        return w if form[w] is None else root(form[w])

    return {(w, form[w], root(w), n, k, words.get(form[w])) for w, n, k in out}


def found(df):
    rows = df.select("word", "form", "root", "n", "n_near", "form_n").collect()
    assert len({r[0] for r in rows}) == len(rows)
    return {tuple(r) for r in rows}


@pytest.fixture(scope="module")
def typos():
    """Words of many frequencies with edits of them, chains of forms, ties, letters of two bytes, a long word and its edits."""
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdeéß") for _ in range(rng.randrange(5, 9))) for _ in range(40)]
    text = []
    for k, w in enumerate(words):
        text += [w] * (2 + k)
        for _ in range(6):
            at, other = rng.randrange(len(w)), rng.choice("abcdeé")
            text += [rng.choice([w[:at] + w[at + 1 :], w[:at] + other + w[at + 1 :], w[:at] + other + w[at:]])] * rng.randrange(1, 5)
    text += ["chainaaaa"] * 500 + ["chainaaab"] * 100 + ["chainaabb"] * 20 + ["chainabbb"] * 4 + ["tiedwordx", "tiedwordy"] * 30 + ["tiedwordz"] * 3
    long = "".join(rng.choice("abc") for _ in range(3000))
    text += [long] * 12 + [long[:1500] + long[1501:]] * 2 + [long[:7] + "z" + long[8:], long[:7] + "z" + long[8:], "É" * 7, "É" * 7, "é" * 7, "é" * 7]
    rng.shuffle(text)
    cut = sorted(rng.sample(range(len(text)), 60))
    rows = [(k, rng.choice([" ", "-", "7", "\n"]).join(text[a:b]), "en", "s") for k, (a, b) in enumerate(zip([0, *cut], [*cut, len(text)], strict=True))]
    return rows + [(None, "chainaaaa tiedwordz", None, None), (5, None, "en", "s"), (6, "", "en", "s"), (7, "CHAINAAAA ×÷ÀÀÀÀÀ", "en", "s"), rows[0], rows[0]]


@pytest.mark.parametrize("slip", [0, 3, 199])
def test_groups_equal_all_pairs(spark, typos, slip):
    got = found(spelling.variant_groups(cases.frame(spark, typos).repartition(5), min_chars=5, min_count=2, ratio=3, slip=slip))
    assert got == brute(typos, 5, 2, 3, slip)
    assert any(f is not None and r != f for _, f, r, *_ in got)
    assert any(k == 0 for *_, k, _ in got)


def test_awkward_rows(docs, rows, empty):
    assert found(spelling.variant_groups(docs)) == brute(rows, 6, 5, 5, 199)
    assert spelling.variant_groups(empty).collect() == []
    assert spelling.variant_groups(docs, min_count=10**6).collect() == []
    with pytest.raises(ValueError, match="twice"):
        spelling.variant_groups(docs, ratio=1)


def test_filters_in_slices_lose_nothing(spark, typos):
    words = spelling.count_words(cases.frame(spark, typos), min_chars=5, min_count=2, slip=0)
    words = stored(words.mapInArrow(spelling._hashed, "word string, n long, h long, size int"), "words")
    whole, cut = (Counter(tuple(r) for r in spelling.near_words(words, most).collect()) for most in (1 << 22, 10))
    assert whole == cut and max(whole.values()) == 1
    all_words = brute_words(typos, 5, 2, 0)
    assert {(a, b) for a, _, b, _ in whole} == {(a, b) for a in all_words for b in all_words if near(a, b)}


def test_hashes_of_edits_are_hashes_of_the_words():
    word = "mèssage"
    letters, hashed = spelling.Letters([word, "passage"]), lambda w: spelling.Letters([w]).hashes()[0]
    assert [hashed(word[:k] + word[k + 1 :]) for k in range(7)] == letters.without(0, 7)[0].tolist()
    assert [hashed(word[:k] + "x" + word[k + 1 :]) for k in range(2, 5)] == letters.replaced(ord("x"), 2, 5)[0].tolist()


def test_pieces_cut_no_run(monkeypatch):
    monkeypatch.setattr(spelling, "_PIECE", 7)
    rng = random.Random(2)
    text = "".join(rng.choice(["a", "b", "é", " ", "9", "語"]) for _ in range(3000))
    total = Counter()
    for run, c in spelling.runs(1, text.encode(), 2, 0):
        total[run.decode()] += c
    assert total == Counter(w for w in RUN.findall(text) if len(w) >= 2)
    assert np.uint64(spelling._BASE) * spelling._BACK == 1
