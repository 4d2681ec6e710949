import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskloom.operators import impute, neighbors, resample


def brute(q, d, ties, k):
    out = {}
    for v in {tuple(x) for x in q}:
        dist = np.sqrt(((d - np.array(v)) ** 2).sum(axis=1))
        order = sorted(range(len(d)), key=lambda i: (dist[i], ties[i]))[:k]
        out[v] = [ties[i] for i in order]
    return out


@pytest.mark.parametrize("dims,hot", [(1, 0), (2, 0), (2, 400), (6, 100)])
def test_join_equals_brute_force(spark, monkeypatch, dims, hot):
    monkeypatch.setattr(neighbors, "_POINTS_PER_PIVOT", 60)
    rng = np.random.default_rng(dims)
    d = np.round(rng.normal(size=(1_200, dims)) * 4) / 4 if dims < 6 else rng.normal(size=(1_200, dims))
    d[:hot] = d[0]
    q = np.vstack([d[::5], rng.normal(size=(60, dims)) * 3])
    ties = list(range(len(d)))
    donors = spark.createDataFrame(pd.DataFrame({"vec": list(d), "tie": ties}), "vec array<double>, tie bigint")
    queries = spark.createDataFrame(pd.DataFrame({"vec": list(q)}), "vec array<double>")
    got = neighbors.knn_join(queries, donors, 7, block_rows=50).toPandas().sort_values("rank")
    found = {k: list(g["tie"]) for k, g in got.groupby(got["vec"].map(tuple))}
    assert found == brute(q, d, ties, 7)


def test_fewer_donors_than_k(spark):
    donors = spark.createDataFrame([([0.0], 1), ([2.0], 2)], "vec array<double>, tie bigint")
    got = neighbors.knn_join(spark.createDataFrame([([0.5],)], "vec array<double>"), donors, 5).orderBy("rank").collect()
    assert [r["tie"] for r in got] == [1, 2]


def nan_knn(x, k):
    out = x.copy()
    width = x.shape[1]
    for i, row in enumerate(x):
        for j in np.flatnonzero(np.isnan(row)):
            found = []
            for other in x:
                shared = ~np.isnan(row) & ~np.isnan(other)
                if not np.isnan(other[j]) and shared.any():
                    found.append((width / shared.sum() * ((row[shared] - other[shared]) ** 2).sum(), other[j]))
            found.sort()
            out[i, j] = np.mean([v for _, v in found[:k]]) if found else np.nanmean(x[:, j])
    return out


@pytest.mark.parametrize("pairs", [0, 1000])
def test_knn_impute_equals_brute_force(spark, monkeypatch, pairs):
    monkeypatch.setattr(impute, "MOST_PATTERN_PAIRS", pairs)
    rng = np.random.default_rng(5)
    x = np.round(rng.normal(size=(160, 3)) * 1e6) / 1e6
    x[rng.random(x.shape) < 0.25] = np.nan
    x[0] = np.nan
    pdf = pd.DataFrame(x, columns=["a", "b", "c"]).assign(id=range(len(x)), t="x")
    df = spark.createDataFrame(pdf)
    df = df.select("id", "t", *[F.when(~F.isnan(c), F.col(c)).alias(c) for c in "abc"])
    state = impute.fit_impute(df, "knn", ["id"], n_neighbors=4)
    got = impute.apply_impute(df, state, ["id"]).orderBy("id").select("a", "b", "c").toPandas().to_numpy()
    assert np.allclose(got, nan_knn(x, 4), atol=1e-9)


def test_single_null_column_gets_the_mean(spark):
    df = spark.createDataFrame([(1, 1.0), (2, 5.0), (3, None)], "id int, a double")
    out = impute.apply_impute(df, impute.fit_impute(df, "knn", ["id"]), ["id"])
    assert [r["a"] for r in out.orderBy("id").collect()] == [1.0, 5.0, 3.0]


def _two_classes(spark, copies=0):
    rng = np.random.default_rng(2)
    x = np.vstack([rng.normal(size=(150, 2)), rng.normal(1.0, 1, size=(40, 2))])
    x[150:150 + copies] = x[150]
    return spark.createDataFrame(
        pd.DataFrame({"id": range(190), "y": [0] * 150 + [1] * 40, "a": x[:, 0], "b": x[:, 1]})
    )


@pytest.mark.parametrize("copies", [0, 15])
def test_smote_points_lie_between_same_class_rows(spark, copies):
    df = _two_classes(spark, copies)
    out = resample.smote(df, "y", "id", ["a", "b"], 5).toPandas()
    made = out[out["_copy"] > 0]
    assert out.groupby("y").size().to_dict() == {0: 150, 1: 150}
    rows = df.filter("y = 1").toPandas()
    points = rows[["a", "b"]].to_numpy()
    for r in made.itertuples():
        base = rows[rows["id"] == r.id][["a", "b"]].to_numpy()[0]
        p = np.array([r.a, r.b])
        gaps = points - base
        cross = gaps[:, 0] * (p - base)[1] - gaps[:, 1] * (p - base)[0]
        assert (np.abs(cross) < 1e-9).any()


def test_resampling_does_not_depend_on_partitions(spark):
    df = _two_classes(spark)
    for method in ("oversample", "undersample", "smote", "adasyn"):
        a = resample.resample(df.repartition(1), "y", "id", method, ["a", "b"]).toPandas()
        b = resample.resample(df.repartition(13), "y", "id", method, ["a", "b"]).toPandas()
        by = ["id", "_copy"]
        pd.testing.assert_frame_equal(
            a.sort_values(by).reset_index(drop=True), b.sort_values(by).reset_index(drop=True), check_dtype=False
        )


def test_adasyn_many_draws_of_one_row_are_cut(spark, monkeypatch):
    df = _two_classes(spark)
    whole = resample.adasyn(df, "y", "id", ["a", "b"], 5).count()
    monkeypatch.setattr(resample.limits, "ONE_TASK_ROWS", 2)
    assert resample._repeat(spark.createDataFrame([("a", 7), ("b", 1)], "_key string, draws bigint")).count() == 8
    assert whole > 250


@pytest.mark.parametrize(
    "counts,strategy,method,want",
    [
        ({0: 60, 1: 40}, "auto", "oversample", {0: 60, 1: 60}),
        ({0: 10, 1: 5, 2: 7}, "minority", "smote", {0: 10, 1: 10, 2: 7}),
        ({0: 10, 1: 5, 2: 7}, 0.5, "smote", {0: 10, 1: 10, 2: 10}),
        ({0: 100, 1: 20}, 0.75, "adasyn", {0: 100, 1: 75}),
        ({0: 100, 1: 20}, 0.5, "undersample", {0: 40, 1: 20}),
    ],
)
def test_class_targets(counts, strategy, method, want):
    assert resample.class_targets(counts, strategy, method) == want


def test_too_low_ratio_leaves_the_data(spark):
    df = spark.range(100).select("id", (F.col("id") >= 60).cast("int").alias("y"))
    with pytest.raises(resample.CannotResample):
        resample.class_targets({0: 60, 1: 40}, 0.5)
    assert resample.resample(df, "y", "id", "oversample", sampling_strategy=0.5).count() == 100


def test_too_few_rows_for_smote_leaves_the_data(spark):
    df = spark.createDataFrame([(i, int(i > 7), float(i)) for i in range(10)], "id int, y int, a double")
    assert resample.resample(df, "y", "id", "smote", ["a"]).count() == 10


def test_masked_search_in_many_blocks(spark):
    rng = np.random.default_rng(9)
    x = np.round(rng.normal(size=(90, 3)), 3)
    x[rng.random(x.shape) < 0.3] = np.nan
    x = x[~np.isnan(x).all(axis=1)]
    df = spark.createDataFrame(pd.DataFrame(x, columns=["a", "b", "c"]).assign(n=1))
    df = df.select("n", *[F.when(~F.isnan(c), F.col(c)).alias(c) for c in "abc"])
    recv = df.filter("a is null or b is null or c is null").drop("n")
    one = impute.masked_knn(recv, df, ["a", "b", "c"], 3, block_rows=1000)
    many = impute.masked_knn(recv, df, ["a", "b", "c"], 3, block_rows=20)
    best = lambda t: {
        key: sorted(zip(g["dist"].round(9), g["tie"]))[:3]
        for key, g in t.toPandas().fillna(-9).groupby(["a", "b", "c", "column"])
    }
    assert best(one) == best(many)
