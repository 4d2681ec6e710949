"""The hash-prefix forest against all pairs."""

import numpy as np
import pytest
from pyspark.sql import functions as F, types as T

from riskloom.llm import forest, queries
from riskloom.llm.files import stored

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("q", T.StringType()), T.StructField("keys", T.StringType()), T.StructField("c", T.StringType())])


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], "x", None, "y") for i, v in rows], SCHEMA)


def brute(rows, every, k):
    """{(query, rank): (id, score)} of distinct (id, vector) rows; vectors of the commonest length."""
    fine = {(i, tuple(np.float32(x) for x in v)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    sizes = [len(v) for _, v in fine]
    size = min(set(sizes), key=lambda n: (-sizes.count(n), n), default=0)
    fine = sorted(x for x in fine if len(x[1]) == size)
    ids, x = np.array([i for i, _ in fine]), np.array([v for _, v in fine], dtype=np.float64)
    out = []
    for i, v in fine:
        if i % every == 0:
            a = np.array(v, dtype=np.float64)
            score = x @ a / (np.linalg.norm(x, axis=1) * np.linalg.norm(a))
            order = [n for n in np.lexsort((ids, -score.round(12))) if ids[n] != i][:k]
            out += [(i, r + 1, int(ids[n]), round(float(score[n]), 9)) for r, n in enumerate(order)]
    return sorted(out)


def found(df):
    return sorted((r["query_id"], r["rank"], r["vec_id"], round(r["score"], 9)) for r in df.collect())


def test_awkward_rows(spark):
    rng = np.random.default_rng(3)
    rows = [(k, rng.standard_normal(6).tolist()) for k in range(60)]
    rows += [(100 + k, rows[10][1]) for k in range(40)]  # ties: one vector under many ids
    rows += [(200, (2 * np.array(rows[10][1])).tolist()), rows[10], rows[10], (20, rows[33][1])]
    rows += [(300, None), (302, []), (304, [0.0] * 6), (306, [float("nan")] + [1.0] * 5), (308, [float("inf")] + [1.0] * 5), (310, [None] + [1.0] * 5), (312, [1.0] * 5), (None, rows[1][1]), (314, [1e38] * 6), (316, [1e-38] * 6)]
    table = frame(spark, rows).repartition(3)
    assert found(forest.nearest(table, every=10)) == brute(rows, 10, 5)
    assert forest.nearest(table.where("false"), every=10).collect() == []
    assert found(forest.nearest(table.where("vec_id < 3"), every=1)) == brute(rows[:3], 1, 5)
    assert found(forest.nearest(table.where("vec_id = 0"), every=1)) == []
    assert found(forest.nearest(frame(spark, [(k, [x]) for k, x in enumerate((1.0, -2.0, 3.0))]), every=1)) == brute([(k, [x]) for k, x in enumerate((1.0, -2.0, 3.0))], 1, 5)


@pytest.fixture(scope="module")
def clustered(spark):
    """Isotropic vectors, one group of near copies with a tenth of the rows, one vector that a tenth of the rows hold."""
    rng = np.random.default_rng(9)
    x = rng.standard_normal((3000, 24)).astype(np.float32)
    x[2400:2700] = x[0] + 0.01 * rng.standard_normal((300, 24))
    x[2700:] = x[1]
    return [(int(k), v.tolist()) for k, v in enumerate(x)]


def test_blocks_and_levels(spark, clustered, monkeypatch):
    """Many small blocks: the ascent stops at the level that counting all keys gives, and the ranges hold just those rows."""
    monkeypatch.setattr(forest, "BLOCK_ROWS", 700)
    rows = frame(spark, clustered).select(F.col("vec_id").alias("i"), F.col("embedding").alias("v"))
    made = forest.index(rows, 12, 6, 1)
    assert made.count == 2700 and len(made.directory.number) > 20
    classes = made.classes.orderBy("c").collect()
    assert [r["ids"] for r in classes if len(r["ids"]) > 1] == [[1, 2700, 2701, 2702, 2703, 2704]]
    keys = made.rotations.keys(forest.units_of(np.array([r["v"] for r in classes], dtype=np.float64)))
    asked = stored(made.classes.where("ids[0] % 100 = 0").select(F.col("c").alias("q"), "v"), "asked")
    chosen = stored(forest._levels(made, asked, 400), "levels")
    level = {r["q"]: r["level"] for r in chosen.collect()}
    hits = {}
    for r in forest._candidates(made, chosen, 3).collect():
        assert set(forest.share_of(np.array(r["ids"]), 3)) == {r["p"]}
        hits.setdefault(r["q"], []).extend(r["ids"])
    order = {r["c"]: k for k, r in enumerate(classes)}
    assert set(level) == {r["c"] for r in classes if r["ids"][0] % 100 == 0} and len(set(level.values())) > 1
    for q, x in level.items():
        shared = lambda n, q=q: (keys >> (forest.BITS - n)) == (keys[order[q]] >> (forest.BITS - n))
        want = max([n for n in range(1, forest.BITS + 1) if shared(n).sum() >= 400], default=0)
        assert x == want
        assert sorted(hits[q]) == sorted(c for c, k in order.items() for _ in range(shared(x)[k].sum() if x else 1))


@pytest.mark.parametrize("trees", [forest.TREES])
def test_recall_on_clusters(spark, clustered, trees):
    got = found(forest.nearest(frame(spark, clustered), every=50, trees=trees))
    want = brute(clustered, 50, 5)
    assert len(got) == len(want) and [r[:2] for r in got] == [r[:2] for r in want]
    pairs = {(q, i) for q, _, i, _ in want}
    assert len(pairs & {(q, i) for q, _, i, _ in got}) >= 0.9 * len(pairs)
    exact = {(r[0], r[2]): r[3] for r in brute(clustered, 50, 3000)}
    assert all(exact[q, i] == s for q, _, i, s in got)


def test_recall_of_the_query(spark):
    sf = "/root/testdata/sf0.1"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()]
    got, want = found(queries.op12_nearest_neighbours(spark, sf)), brute(rows, 50, 5)
    assert len(got) == len(want)
    pairs = {(q, i) for q, _, i, _ in want}
    assert len(pairs & {(q, i) for q, _, i, _ in got}) >= 0.9 * len(pairs)
