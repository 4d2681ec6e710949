"""The Merkle manifest against a version that holds every node."""

from collections import Counter, defaultdict

import cases
import pytest
from pyspark.sql import functions as F

from riskloom.llm import merkle

FIELDS = ("doc_id", "source", "lang", "text")


def encoded(values):
    return "".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values)


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([cases.sha("".join(out[-1][a : a + 16])) for a in range(0, len(out[-1]), 16)])
    return out


def siblings(tree, place):
    found = []
    for level in tree[:-1]:
        a = place // 16 * 16
        found.append(("".join(level[a:place]), "".join(level[place + 1 : a + 16])))
        place //= 16
    return found


def brute(rows, claim):
    """(doc_id, leaf, subroot, root, proof, folded) of every row; rows are (doc_id, text, lang, source)."""
    groups = defaultdict(list)
    for d, text, lang, source in rows:
        groups[source].append((d is not None, d or 0, cases.sha(encoded((d, source, lang, text))), cases.sha(encoded((d, source, lang, claim(d, text)))), d))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: levels([x[2] for x in sorted(groups[g], key=lambda x: x[:3])]) for g in order}
    top = levels([trees[g][-1][0] for g in order])
    out = []
    for s, g in enumerate(order):
        for r, x in enumerate(sorted(groups[g], key=lambda x: x[:3])):
            path = siblings(trees[g], r) + siblings(top, s)
            acc = x[3]
            for left, right in path:
                acc = cases.sha(left + acc + right)
            out.append((x[4], x[2], trees[g][-1][0], top[-1][0], cases.sha("".join(a + b for a, b in path)), acc))
    return out


def low(d, text):
    return text.translate(cases.LOWER) if text is not None and d is not None and d % 5 == 0 else text


def proved(frame):
    lowered = F.when(F.col("doc_id") % 5 == 0, F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).otherwise(F.col("text"))
    claim = [lowered if c == "text" else F.col(c) for c in FIELDS]
    return merkle.prove(merkle.build(frame, FIELDS, claim=claim)).withColumn("proof", merkle.proof_digest(F.col("path")))


COLUMNS = ["k", "leaf", "subroot", "root", "proof", "folded_root"]


def test_manifest_of_awkward_rows(docs, rows):
    got = proved(docs).collect()
    assert Counter(tuple(r[c] for c in COLUMNS) for r in got) == Counter(brute(rows, low))
    assert {r["verified"] for r in got} == {True, False}
    assert all(r["verified"] == (r["folded_root"] == r["root"]) for r in got)


@pytest.fixture(scope="module")
def many():
    """One source holds two thirds of the rows; thirty sources have one row each; one row is there 40 times."""
    rows = [(k, f"Text {k % 50}", "en", "hot") for k in range(600)] + [(1000 + k, f"T {k}", None, f"s{k:02d}") for k in range(30)]
    return rows + [(5, "same", "en", None)] * 40 + [(k, None, "fr", "é") for k in range(2000, 2017)]


def test_hot_group_many_groups_and_equal_rows(spark, many):
    frame = cases.frame(spark, many).repartition(7)
    assert Counter(tuple(r[c] for c in COLUMNS) for r in proved(frame).collect()) == Counter(brute(many, low))


def test_requests_for_some_leaves(spark, many):
    manifest = merkle.build(cases.frame(spark, many).repartition(3), FIELDS)
    some = manifest.leaves.where("k in (3, 599, 1007, 2016)")
    got = merkle.prove(manifest, some).collect()
    want = {x for x in brute(many, lambda d, t: t) if x[0] in (3, 599, 1007, 2016)}
    assert {(r["k"], r["leaf"], r["subroot"], r["root"], r["folded_root"]) for r in got} == {(*x[:4], x[5]) for x in want}
    assert all(r["verified"] for r in got) and len(got) == 4
    beyond = some.limit(1).withColumn("r", F.lit(10_000).cast("long"))
    assert merkle.prove(manifest, beyond).count() == 0


def test_one_row_and_none(docs, empty):
    one = docs.where("doc_id = 12").limit(1)
    got = proved(one).collect()
    assert [(r["leaf"], r["proof"]) for r in got] == [(got[0]["root"], cases.sha(""))]
    assert proved(empty).collect() == []
