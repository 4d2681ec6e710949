"""Steps that must not grow faster than their input."""

import numpy as np
from pyspark.sql import functions as F

from riskloom.operators import boosting, neighbors, trees
from riskloom.sources import views


def test_customers_are_not_sent_to_the_driver(spark, sf):
    plan = views.apps(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan


def test_boosting_takes_cuts_once_from_packed_rows(spark, monkeypatch):
    asked = []
    cuts_of = trees.cuts_of
    monkeypatch.setattr(trees, "cuts_of", lambda rows, width: asked.append(1) or cuts_of(rows, width))
    df = spark.range(600).select(F.xxhash64("id").alias("h"), F.lit(1).alias("m"), F.array((F.col("id") % 20).cast("double"), (F.col("id") % 7).cast("double")).alias("x"), (F.col("id") % 20 > 11).cast("double").alias("y"))
    model = boosting.fit_boosted(df, 2, 2, {0: 360, 1: 240}, 3, 0.3, 2, local_rows=100)
    assert len(asked) == 1 and len(model.rounds) == 3
    whole = boosting.fit_boosted(df, 2, 2, {0: 360, 1: 240}, 3, 0.3, 2)
    x = np.column_stack([np.arange(40) % 20, np.arange(40) % 7]).astype(float)
    assert np.allclose(model.scores(x), whole.scores(x))


def test_neighbour_search_has_a_task_for_each_pair_of_blocks(spark):
    rng = np.random.default_rng(4)
    df = spark.createDataFrame([(i, [float(v) for v in p]) for i, p in enumerate(rng.normal(size=(2500, 3)))], "tie long, vec array<double>")
    assert spark.conf.get("spark.sql.shuffle.partitions") == "8"
    schema = neighbors.T.StructType([df.schema["vec"], neighbors.T.StructField("dist", neighbors.T.DoubleType()), df.schema["tie"]])
    blocks = np.array([5])
    cells = neighbors._with_blocks(df.withColumn("cell", F.lit(0)), blocks)
    found = neighbors._search(df.select("vec").withColumn("cell", F.lit(0)), cells, blocks, 2, schema, 500)
    assert found.rdd.getNumPartitions() == 25


def test_neighbour_search_keeps_one_row_a_query_and_finds_nothing_beyond_its_reach(spark, monkeypatch):
    rng = np.random.default_rng(5)
    points = np.round(rng.normal(size=(400, 6)), 1)
    df = spark.createDataFrame([(i, [float(v) for v in p]) for i, p in enumerate(points)], "tie long, vec array<double>")
    stored, settle = [], neighbors.settle
    monkeypatch.setattr(neighbors, "_POINTS_PER_PIVOT", 40)
    monkeypatch.setattr(neighbors, "settle", lambda part: stored.append(settle(part)) or stored[-1])
    got = {}
    for r in neighbors.knn_join(df.filter("tie < 60").select("vec"), df, 5).collect():
        got.setdefault(tuple(r["vec"]), []).append((r["rank"], r["tie"], r["dist"]))
    far = neighbors.block_distances(points, points)
    for i in range(60):
        order = np.argsort(far[i], kind="stable")[:5]
        assert sorted(got[tuple(points[i])]) == [(n + 1, t, far[i, t]) for n, t in enumerate(order)]
    assert all(part.count() <= 60 for part in stored if "cell" in part.columns[-1] or "reach" in part.columns)
    schema = neighbors.T.StructType([df.schema["vec"], neighbors.T.StructField("dist", neighbors.T.DoubleType()), df.schema["tie"]])
    cells, blocks = neighbors._with_blocks(df.withColumn("cell", F.lit(0)), np.array([2])), np.array([2])
    near = neighbors._search(df.select("vec", F.lit(1.0).alias("reach"), F.lit(0).alias("cell")), cells, blocks, 3, schema, 200)
    assert near.agg(F.max("dist")).first()[0] <= 1.0


def test_nearest_rows_are_those_of_all_distances():
    rng = np.random.default_rng(6)
    for shift, k in ((0.0, 4), (1e6, 4), (0.0, 50)):
        a, b = np.round(rng.normal(size=(30, 3)), 1) + shift, np.round(rng.normal(size=(40, 3)), 1) + shift
        b[7], a[3] = b[2], b[2]
        d = neighbors.block_distances(a, b)
        want = d.argsort(axis=1, kind="stable")[:, :k]
        who, which, dist = neighbors.nearest(a, b, k)
        assert (which == want.ravel()).all() and (who == np.repeat(np.arange(30), want.shape[1])).all() and (dist == d[who, which]).all()
    assert len(neighbors.nearest(np.array([[np.inf], [0.0]]), np.array([[1.0], [2.0], [np.inf]]), 2)[0]) == 4
