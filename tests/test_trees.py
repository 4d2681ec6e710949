"""The forest grower, its large-node and large-model forms, boosting, and imputation by forests."""

import dataclasses

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.operators import boosting, impute, iterative, models, trees
from riskloom.session import scratch_path


def impurity(y, w):
    mean = np.average(y, axis=0, weights=w)
    return (w[:, None] * (y - mean) ** 2).sum()


def brute_leaves(x, y, w, rules, depth=0):
    """Groups of rows at the leaves, by trying every cut."""
    rows = np.arange(len(x))

    def part(rows, depth):
        t = rules.targets(y[rows])
        if len(rows) < max(rules.min_split, 2 * rules.min_leaf) or depth == rules.max_depth or (t == t[0]).all():
            return [rows]
        best = None
        for j in range(x.shape[1]):
            values = np.unique(x[rows, j])
            for a, b in zip(values, values[1:], strict=False):
                low = x[rows, j] <= a + (b - a) / 2
                if min(low.sum(), (~low).sum()) < rules.min_leaf:
                    continue
                gain = impurity(t, w[rows]) - impurity(t[low], w[rows][low]) - impurity(t[~low], w[rows][~low])
                if best is None or gain > best[0] + 1e-9 * abs(best[0]):
                    best = gain, rows[low], rows[~low]
        return [rows] if best is None else part(best[1], depth + 1) + part(best[2], depth + 1)

    return sorted(tuple(p) for p in part(rows, depth))


@pytest.mark.parametrize("rules", [
    trees.Rules(), trees.Rules(classes=3), trees.Rules(min_split=15), trees.Rules(min_leaf=6), trees.Rules(max_depth=3), trees.Rules(classes=3, max_depth=4, min_leaf=2, min_split=9)])
def test_grown_trees_equal_trying_every_cut(rules):
    rng = np.random.default_rng(5)
    x = np.column_stack([rng.integers(0, 6, 90), rng.normal(size=90).round(1), np.ones(90)]).astype(float)
    y = rng.integers(0, 3, 90).astype(float) if rules.classes else x[:, 0] + rng.normal(size=90)
    w = rng.integers(1, 4, 90).astype(float)
    tree, gains = trees.grow(x, y, w, np.ones(90), rules)
    leaf = tree.find(x)
    assert sorted(tuple(np.flatnonzero(leaf == k)) for k in np.unique(leaf)) == brute_leaves(x, y, w, rules)
    for k in np.unique(leaf):
        assert np.allclose(tree.value[k], np.average(rules.targets(y[leaf == k]), axis=0, weights=w[leaf == k]))
    left = sum(impurity(rules.targets(y[leaf == k]), w[leaf == k]) for k in np.unique(leaf))
    assert gains.sum() == pytest.approx(impurity(rules.targets(y), w) - left) and gains[2] == 0


def test_nodes_draw_features_that_vary():
    rng = np.random.default_rng(1)
    x = np.column_stack([np.zeros(400), rng.normal(size=400), rng.normal(size=400), rng.normal(size=400)])
    y = (x[:, 1] + x[:, 2] > 0).astype(float)
    first = {trees.grow(x, y, np.ones(400), np.ones(400), trees.Rules(classes=2, tried=1, max_depth=1), seed)[0].feature[0] for seed in range(40)}
    assert first == {1, 2, 3}
    assert trees.tried_of("sqrt", 10) == 3 and trees.tried_of(None, 4) is None and trees.tried_of(0.5, 6) == 3 and trees.tried_of("log2", 8) == 3


def test_bags_are_poisson_and_belong_to_the_row():
    h = np.random.default_rng(2).integers(-(2**62), 2**62, 200_000)
    one = trees.bag(h, np.ones(len(h)), 3, 42)
    assert (one[::-1] == trees.bag(h[::-1].copy(), np.ones(len(h)), 3, 42)).all()
    assert one.mean() == pytest.approx(1, abs=0.01) and one.var() == pytest.approx(1, abs=0.02) and (one == 0).mean() == pytest.approx(np.exp(-1), abs=0.005)
    for m in (7, 300):
        many = trees.bag(h, np.full(len(h), float(m)), 1, 42)
        assert many.mean() == pytest.approx(m, rel=0.01) and many.var() == pytest.approx(m, rel=0.03)
    assert np.corrcoef(one, trees.bag(h, np.ones(len(h)), 4, 42))[0, 1] == pytest.approx(0, abs=0.01)


@pytest.fixture(scope="module")
def table(spark):
    """Few distinct values, so that the cuts of histograms are all there are; a third of the rows in one cell."""
    rng = np.random.default_rng(11)
    a, b = rng.integers(0, 40, 3000), rng.integers(0, 25, 3000)
    a[:1000], b[:1000] = 7, 3
    y = (a > 18).astype(int) + (b > 12) + (rng.random(3000) < 0.2)
    rows = [(int(k), float(i), float(j), int(min(t, 2))) for k, (i, j, t) in enumerate(zip(a, b, y, strict=True))]
    return spark.createDataFrame(rows, "k long, a double, b double, y int").repartition(5).cache()


def rows_of(table):
    return table.select(F.xxhash64("k").alias("h"), F.lit(1).alias("m"), F.array("a", "b").alias("x"), F.col("y").cast("double").alias("y"))


def scores(df, forest):
    return {r["k"]: np.round(r["p"], 9).tolist() for r in trees.predict(df, forest, ["a", "b"], "p").collect()}


@pytest.mark.parametrize("rules", [
    trees.Rules(classes=3, max_depth=9, min_leaf=4, bootstrap=False), trees.Rules(min_split=12, bootstrap=False), trees.Rules(classes=3, tried=1, bootstrap=False)])
def test_large_nodes_and_large_models_give_the_same_forest(table, rules, monkeypatch):
    whole = trees.fit_forest(rows_of(table), 2, rules, 2)
    assert all(t.local == [0] for t in whole.tops)
    monkeypatch.setattr(trees, "HISTOGRAM_BYTES", 1 << 18)  # few nodes at a time
    cut = trees.fit_forest(rows_of(table), 2, rules, 2, local_rows=700)
    assert all(len(t.tree.feature) > 3 for t in cut.tops)
    want = scores(table, whole)
    assert scores(table, cut) == want
    assert np.allclose(cut.importance, whole.importance)
    routed = trees.fit_forest(rows_of(table), 2, rules, 2, local_rows=700, model_bytes=0)
    assert routed.parts is None and scores(table, routed) == want and np.allclose(routed.importance, whole.importance)
    some = trees.predict(table, routed, ["a", "b"], "p", F.col("k") % 2 == 0).collect()
    assert all((r["p"] is None) == bool(r["k"] % 2) for r in some)
    # With bags, a row that a tree did not draw may lie between the cut of a histogram and the half way mark.
    bags = dataclasses.replace(rules, bootstrap=True)
    a, b = (scores(table, trees.fit_forest(rows_of(table), 2, bags, 2, local_rows=n)) for n in (10**6, 700))
    assert a != want and np.mean([a[k] == b[k] for k in a]) > 0.95


def test_cuts_of_its_own_for_a_node_that_the_common_cuts_cannot_part(spark, monkeypatch):
    """Nearly all rows lie between two neighbouring cuts."""
    monkeypatch.setattr(trees, "BINS", 3)
    df = spark.range(4000).select(
        F.col("id").alias("k"), F.when(F.col("id") < 3900, 0.5 + F.col("id") / 10000).otherwise(F.col("id") * 1.0).alias("a"), (F.col("id") % 2).cast("double").alias("b"), (F.col("id") % 3900 < 1234).cast("int").alias("y"))
    forest = trees.fit_forest(rows_of(df.cache()), 2, trees.Rules(classes=2, bootstrap=False), 1, local_rows=200)
    assert all(p == [1 - y, y] for p, y in ((r["p"], r["y"]) for r in trees.predict(df, forest, ["a", "b"], "p").collect()))


def test_every_task_that_grows_nodes_has_some(table, monkeypatch):
    """Nodes are dealt by the rows they drew: no task is left empty, none has a large node and another one."""
    monkeypatch.setattr(trees, "TASK_ROWS", 400)
    made, whole = [], trees._subtrees
    monkeypatch.setattr(trees, "_subtrees", lambda *a: made.append((a[1], whole(*a))) or made[-1][1])
    trees.fit_forest(rows_of(table), 2, trees.Rules(), 6, local_rows=700)
    (tops, grown), = made
    held = {}
    for r in grown.select("tree", "node", F.spark_partition_id().alias("task")).collect():
        held.setdefault(r["task"], []).append(tops[r["tree"]].drawn[r["node"]])
    assert len(held) == grown.rdd.getNumPartitions() > 6
    assert all(len(sizes) == 1 or sum(sizes) <= 400 for sizes in held.values()) and max(map(len, held.values())) > 1


def test_a_level_costs_the_rows_that_it_may_split(monkeypatch):
    """Rows in leaves, and of features that do not vary in a node, are read no more."""
    read, deal = [], trees._halved
    monkeypatch.setattr(trees, "_halved", lambda o, v, size, side: read.append(len(o)) or deal(o, v, size, side))
    rng = np.random.default_rng(6)
    x = np.column_stack([rng.permutation(2000), rng.integers(0, 2, 2000)]).astype(float)
    y = (x[:, 0] < 100).astype(float)
    tree, _ = trees.grow(x, y, np.ones(2000), np.ones(2000), trees.Rules(classes=2))
    # One split settles all: the level after it reads nothing.
    assert len(tree.feature) == 3 and read == [2000, 2000, 2000]


def test_forests_survive_saving_and_other_layouts(spark, table):
    rules = trees.Rules(classes=3, tried=1, max_depth=6)
    forest = trees.fit_forest(rows_of(table), 2, rules, 4)
    again = trees.fit_forest(rows_of(table.repartition(11)), 2, rules, 4)
    path = scratch_path(spark, "forest")
    forest.save(spark, path)
    assert scores(table, again) == scores(table, forest) == scores(table, trees.Forest.load(spark, path))
    large = trees.fit_forest(rows_of(table), 2, rules, 4, model_bytes=0)
    large.save(spark, path + "-large")
    assert scores(table, trees.Forest.load(spark, path + "-large")) == scores(table, forest)


def brute_boosting(x, y, classes, rounds, rate, rules):
    prior = np.bincount(y, minlength=classes) / len(y)
    f = np.tile(np.log(prior), (len(y), 1)) if classes > 2 else np.full((len(y), 1), np.log(prior[1] / prior[0]))
    for _ in range(rounds):
        r = boosting.residuals(f, y)
        step = np.zeros_like(f)
        for k in range(f.shape[1]):
            for leaf in brute_leaves(x, r[:, k], np.ones(len(y)), rules):
                v = r[list(leaf), k]
                step[list(leaf), k] = (1 if classes == 2 else (classes - 1) / classes) * v.sum() / (np.abs(v) * (1 - np.abs(v))).sum()
        f += rate * step
    return boosting.probabilities(f)


@pytest.mark.parametrize("classes", [2, 3])
@pytest.mark.parametrize("local_rows", [10**6, 60])
def test_boosting_equals_rounds_by_hand(spark, classes, local_rows):
    rng = np.random.default_rng(classes)
    x = rng.integers(0, 12, (240, 2)).astype(float)
    y = np.minimum((x[:, 0] > 5).astype(int) + (x[:, 1] > 7) * (rng.random(240) < 0.8), classes - 1)
    df = spark.createDataFrame([(k, float(a), float(b), int(c)) for k, ((a, b), c) in enumerate(zip(x, y, strict=True))], "k long, a double, b double, y int")
    counts = {k: int(n) for k, n in enumerate(np.bincount(y, minlength=classes))}
    model = boosting.fit_boosted(rows_of(df.cache()), 2, classes, counts, 3, 0.3, 2, local_rows=local_rows)
    got = {r["k"]: r["p"] for r in boosting.predict(df, model, ["a", "b"], "p").collect()}
    want = brute_boosting(x, y, classes, 3, 0.3, trees.Rules(max_depth=2))
    assert np.allclose([got[k] for k in range(240)], want, atol=1e-9)
    path = scratch_path(spark, "boosted")
    model.save(spark, path)
    loaded = boosting.Boosted.load(spark, path)
    assert np.allclose(loaded.scores(x), model.scores(x)) and loaded.importance.sum() == pytest.approx(1)


def test_split_minimum_counts_rows_of_the_node(table):
    """Each least node size gives its own trees: no node below it is split."""
    leaves = []
    for least in (2, 5, 10, 15, 200):
        m = models.fit_model(table, "random_forest", ["a", "b"], "y", {"n_estimators": 3, "min_samples_split": least}, 1, "k")
        leaves.append(sum(int((t.feature < 0).sum()) for t in m.forest.trees()))
    assert leaves == sorted(leaves, reverse=True) and len(set(leaves)) == 5


def test_training_rows_are_filled_as_the_forests_fill_them(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=300)
    cols = [x + rng.normal(scale=0.2, size=300), 2 * x + rng.normal(scale=0.2, size=300), x**2]
    rows = [[None if rng.random() < 0.2 else float(c[i]) for c in cols] for i in range(300)] + [[None, None, None]] * 50
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id long, a double, b double, c double").repartition(3).cache()
    state = iterative.fit_forests(df, ["a", "b", "c"], n_estimators=4, max_iter=3, max_depth=6)
    assert state.rounds > 1 and all(len(done) == 3 for done in state.forests)
    out = {r["id"]: r for r in iterative.apply_forests(df, state).collect()}
    assert len(out) == 350 and all(out[i]["abc"[k]] == v for i, r in enumerate(rows) for k, v in enumerate(r) if v is not None)
    known, state.filled = state.filled, None
    assert {r["id"]: r for r in iterative.apply_forests(df, state).collect()} == out
    state.filled = known.limit(20)  # some rows were there in training, others are new
    assert {r["id"]: r for r in iterative.apply_forests(df, state).collect()} == out
    err = [abs(out[i]["abc"[k]] - cols[k][i]) for i, r in enumerate(rows[:300]) for k in range(3) if r[k] is None]
    once = iterative.ForestState(state.columns, state.means)
    flat = {r["id"]: r for r in iterative.apply_forests(df, once).collect()}
    assert np.mean(err) < 0.5 * np.mean([abs(flat[i]["abc"[k]] - cols[k][i]) for i, r in enumerate(rows[:300]) for k in range(3) if r[k] is None])


def test_mixed_imputation_keeps_new_labels(spark):
    rows = [(k, float(k % 7), ("low", "mid", "top")[k % 3] if k % 5 else None, (k % 3) * 10.0 if k % 4 else None) for k in range(300)]
    df = spark.createDataFrame(rows, "id long, a double, s string, b double")
    other = spark.createDataFrame([(1, 1.0, "new", None), (2, 2.0, None, 20.0), (3, None, None, None)], "id long, a double, s string, b double")
    out = {r["id"]: r for r in iterative.impute_mixed(df, other, ["s"], ["a", "b"], n_estimators=10, max_iter=3).collect()}
    assert out[1]["s"] == "new" and out[2]["s"] == "top" and out[2]["b"] == 20.0
    assert all(v is not None for r in out.values() for v in r)
    same = iterative.impute_mixed(df, df, ["s"], ["a", "b"], n_estimators=10, max_iter=3)
    right = same.filter("id % 5 = 0 and id % 4 <> 0").agg(F.avg((F.col("s") == F.element_at(F.array(*map(F.lit, ("low", "mid", "top"))), (F.col("id") % 3 + 1).cast("int"))).cast("int"))).first()[0]
    assert right > 0.95
    assert impute.null_bearing(same, ["b"]) == []
