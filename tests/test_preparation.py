import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskloom import limits
from riskloom.operators import encode, impute, isolation, iterative, outliers, scale, schema, split, text
from riskloom.plans import catalog
from riskloom.session import scratch_path
from riskloom.sources import sinks, tables, views


def test_csv_types_and_missing_tokens(spark):
    path = scratch_path(spark, "x.csv")
    lines = ["a,b,c,d.e,f,g", "1,1.5,x,NA,True,1d", "NA,nan,,7,False,2", "-3,1e3,null,8,,3", "4,inf,y,9,true,4"]
    spark.createDataFrame([(l,) for l in lines], "value string").coalesce(1).write.text(path)
    df = tables.read_table(spark, path)
    assert dict(df.dtypes) == {"a": "bigint", "b": "double", "c": "string", "d_e": "bigint", "f": "boolean", "g": "string"}
    got = {r["a"]: r for r in df.collect()}
    assert got[None]["b"] is None and got[None]["c"] is None and got[-3]["c"] is None
    assert got[4]["b"] == float("inf") and got[1]["d_e"] is None and got[1]["g"] == "1d"


def test_no_path_raises(spark):
    with pytest.raises(ValueError):
        tables.read_table(spark, "")


def test_run_and_dataset_names():
    assert sinks.run_id({"imputation": "knn", "outlier": "iqr", "encoding": "label", "resampling": "none", "scaling": "none"}) == "knn_iqr_label_none"
    assert sinks.dataset_name("data/credit/train.csv") == "credit"
    assert sinks.dataset_name("data/loans.csv") == "loans"


def test_mode_ties_take_the_smallest(spark):
    df = spark.createDataFrame([("b",), ("a",), ("a",), ("b",), (None,)], "x string")
    assert impute.column_modes(df, ["x"]) == {"x": "a"}
    gone = spark.createDataFrame([(None,)], "x string")
    assert impute.impute_mode(gone, impute.column_modes(gone, ["x"])).first()["x"] == "__MISSING__"


def test_fills_come_from_training_rows_only(spark):
    train = spark.createDataFrame([(1, 1.0, "a"), (2, 3.0, "a"), (3, None, None)], "id int, x double, s string")
    test = spark.createDataFrame([(4, None, None), (5, 100.0, "z")], "id int, x double, s string")
    out = impute.apply_impute(test, impute.fit_impute(train, "median", ["id"]), ["id"]).orderBy("id").collect()
    assert (out[0]["x"], out[0]["s"]) == (2.0, "a")


def test_unknown_methods_raise(spark):
    df = spark.range(3).withColumn("x", F.lit(1.0))
    for call in (
        lambda: impute.fit_impute(df, "other"), lambda: outliers.fit_outliers(df, "other"),
        lambda: encode.fit_encode(df, "other"), lambda: scale.fit_scale(df, "other"),
    ):
        with pytest.raises(ValueError):
            call()


def test_iqr_keeps_null_rows_and_reverts_when_empty(spark):
    df = spark.createDataFrame([(i, float(i), 1.0) for i in range(20)] + [(50, None, 1.0), (51, 1000.0, 1.0)], "id int, x double, c double")
    left = {r["id"] for r in outliers.remove_outliers(df, "iqr", [], ["id"]).collect()}
    assert 50 in left and 51 not in left


def test_isolation_forest_share_and_nulls(spark):
    rng = np.random.default_rng(1)
    x = np.vstack([rng.normal(size=(980, 2)), rng.normal(9, 0.5, size=(20, 2))])
    df = spark.createDataFrame(pd.DataFrame({"id": range(1000), "a": x[:, 0], "b": x[:, 1], "s": "k"}))
    df = df.withColumn("a", F.when(F.col("id") == 3, None).when(F.col("id") == 4, float("inf")).otherwise(F.col("a")))
    kept = outliers.remove_outliers(df, "isolation_forest", [], ["id"], contamination=0.05, n_estimators=50)
    ids = {r["id"] for r in kept.collect()}
    assert 3 not in ids and 4 not in ids
    assert abs(len(ids) - 0.95 * 998) <= 2 and len(ids & set(range(980, 1000))) <= 1
    assert kept.columns == ["a", "b", "id", "s"]
    again = {r["id"] for r in outliers.remove_outliers(df.repartition(9), "isolation_forest", [], ["id"], contamination=0.05, n_estimators=50).collect()}
    assert again == ids


def test_path_length_constant():
    assert isolation.mean_path([1, 2]).tolist() == [0.0, 1.0]
    assert abs(float(isolation.mean_path(256)) - 10.244770920) < 1e-6


def test_label_codes_and_unseen(spark):
    train = spark.createDataFrame([("b",), ("a",), (None,)], "x string")
    test = spark.createDataFrame([("zz",), ("a",), (None,)], "x string")
    for method in ("label", "ordinal"):
        out = encode.apply_encode(test, encode.fit_encode(train, method)).collect()
        assert sorted(r["x"] for r in out) == [-1, 0, 2]


def test_label_codes_of_a_large_value_table(spark, monkeypatch):
    monkeypatch.setattr(encode.limits, "ONE_TASK_ROWS", 10)
    df = spark.range(3_000).select(F.concat(F.lit("v"), F.col("id") % 700).alias("x"), F.concat(F.lit("w"), F.col("id") % 90).alias("y"))
    got = encode.sorted_codes(encode.category_counts(df, ["x", "y"])).toPandas()
    for _, part in got.groupby("column"):
        part = part.sort_values("value")
        assert list(part["code"]) == list(range(len(part)))


def test_onehot_unseen_is_zero_and_wide_columns_stay(spark):
    train = spark.createDataFrame([("a", str(i)) for i in range(6)] + [("b", "x")], "s string, w string")
    state = encode.fit_encode(train, "onehot", max_cardinality_threshold=5)
    out = encode.apply_encode(spark.createDataFrame([("zz", "q")], "s string, w string"), state)
    assert out.columns == ["w", "s_a", "s_b"] and state.unencoded == ["w"]
    assert out.first()["s_a"] == 0.0 and out.first()["s_b"] == 0.0


def test_leave_one_out_unseen_and_singletons(spark):
    train = spark.createDataFrame([("a", 1, 1), ("a", 2, 0), ("b", 3, 1)], "s string, id int, y int")
    state = encode.fit_encode(train, "leaveoneout", "y", ["id"])
    own = {r["id"]: r["s"] for r in encode.leave_one_out_train(train, state, "y", ["id"], 0.0).collect()}
    assert own == {1: 0.0, 2: 1.0, 3: pytest.approx(2 / 3)}
    new = encode.apply_encode(spark.createDataFrame([("zz",), ("a",)], "s string"), state).collect()
    assert sorted(r["s"] for r in new) == [0.5, pytest.approx(2 / 3)]
    noisy = {r["id"]: r["s"] for r in encode.leave_one_out_train(train, state, "y", ["id"], 0.05).collect()}
    assert noisy[1] == 0.0 and noisy[2] != 1.0 and abs(noisy[2] - 1.0) < 0.4
    with pytest.raises(ValueError):
        encode.fit_encode(train, "leaveoneout")


def test_lsa_values_equal_numpy(spark):
    rng = np.random.default_rng(0)
    rows = [(f"aa{rng.integers(3)}", f"bb{rng.integers(4)}") for _ in range(200)]
    df = spark.createDataFrame(rows, "p string, q string").withColumn("id", F.monotonically_increasing_id())
    state = encode.fit_encode(df, "lsa", None, ["id"], n_components=3)
    got = encode.apply_encode(df, state).orderBy("id").select("LSA_1", "LSA_2", "LSA_3").toPandas().to_numpy()
    tokens = [[f"p_{a}", f"q_{b}"] for a, b in rows]
    vocabulary = sorted({t for r in tokens for t in r})
    seen = {t: sum(t in r for r in tokens) for t in vocabulary}
    kept = [t for t in vocabulary if 5 <= seen[t] <= 100]
    m = np.array([[(t in r) * (np.log(201 / (1 + seen[t])) + 1) for t in kept] for r in tokens])
    m = m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-12)
    s = np.linalg.svd(m, compute_uv=False)[:3]
    assert np.allclose(np.linalg.norm(got, axis=0), s, atol=1e-8)


@pytest.mark.parametrize("broadcast", [True, False])
def test_lsa_by_iteration_equals_numpy(spark, monkeypatch, broadcast):
    monkeypatch.setattr(text, "WIDE", 16)
    monkeypatch.setattr(text, "SPARE", 8)
    if not broadcast:
        monkeypatch.setattr(limits, "BROADCAST_BYTES", 0)
    rng = np.random.default_rng(1)
    x = np.where(rng.random((300, 60)) < 0.2, rng.random((300, 60)), 0.0) * np.linspace(0.3, 2.0, 60)
    x[:, 59] = x[:, 58]
    cells = spark.createDataFrame(
        [(f"t{i}", f"w{j:02}", int((x[:, j] > 0).sum()), float(x[i, j])) for i, j in zip(*np.nonzero(x), strict=True)],
        "text string, term string, df bigint, x double",
    )
    got = {r["term"]: r["v"] for r in text.leading_terms(cells, cells.select("term", "df").distinct(), 6).collect()}
    v = np.array([got[f"w{j:02}"] for j in range(60)])
    value, right = np.linalg.svd(x)[1:]
    right = right[:6].T
    right = right * np.sign(right[np.abs(right).argmax(axis=0), np.arange(6)])
    assert np.allclose(np.linalg.norm(x @ v, axis=0), value[:6], rtol=1e-10)
    assert np.allclose(v.T @ v, np.eye(6), atol=1e-9)
    assert np.allclose(np.abs(np.sum(v * right, axis=0)), 1.0, atol=1e-8)


def test_lsa_leaves_out_vanishing_directions(spark, monkeypatch):
    monkeypatch.setattr(text, "WIDE", 4)
    rng = np.random.default_rng(2)
    x = rng.random((40, 3)) @ rng.random((3, 30))
    cells = spark.createDataFrame(
        [(f"t{i}", f"w{j}", 40, float(x[i, j])) for i in range(40) for j in range(30)], "text string, term string, df bigint, x double"
    )
    got = text.leading_terms(cells, cells.select("term", "df").distinct(), 10).collect()
    v = np.array([r["v"] for r in sorted(got, key=lambda r: int(r["term"][1:]))])
    assert v.shape == (30, 3) and np.allclose(x @ v @ v.T, x, atol=1e-8)
    assert np.allclose(np.linalg.norm(x @ v, axis=0), np.linalg.svd(x, compute_uv=False)[:3], rtol=1e-9)


def test_lsa_with_an_empty_vocabulary_gives_zeros(spark):
    df = spark.createDataFrame([("a",), ("b",)], "s string")
    out = encode.apply_encode(df, encode.fit_encode(df, "lsa", n_components=2))
    assert [tuple(r) for r in out.collect()] == [(0.0, 0.0), (0.0, 0.0)]


def test_terms_with_ngrams(spark):
    df = spark.createDataFrame([("Col_A-B xx y zz",)], "t string")
    assert df.select(text.terms(F.col("t"), 3).alias("w")).first()["w"] == [
        "col_a", "xx", "zz", "col_a xx", "xx zz", "col_a xx zz",
    ]


def test_word_vectors_unseen_are_zero(spark):
    train = spark.createDataFrame([("red",), ("blue",), ("red",)], "c string")
    state = encode.fit_encode(train, "word2vec", embedding_dim=4)
    out = encode.apply_encode(spark.createDataFrame([("red",), ("zz",)], "c string"), state)
    assert out.columns == [f"c_w2v_{i}" for i in range(4)]
    norms = sorted(sum(abs(v) for v in r) for r in out.collect())
    assert norms[0] == 0.0 and norms[1] > 0
    subword = encode.fit_encode(train, "row_fasttext", n_components=4)
    near = encode.apply_encode(spark.createDataFrame([("redd",)], "c string"), subword).first()
    assert sum(abs(v) for v in near) > 0


def test_constant_columns_scale_to_zero(spark):
    df = spark.createDataFrame([(5.0,), (5.0,), (5.0,)], "x double")
    for method in ("standard", "minmax"):
        assert [r["x"] for r in scale.apply_scale(df, scale.fit_scale(df, method)).collect()] == [0.0] * 3
    with pytest.raises(ValueError):
        scale.apply_scale(df.withColumnRenamed("x", "z"), scale.fit_scale(df), strict=True)


def test_duplicate_columns_keep_the_first(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int").toDF("a", "b", "a")
    out = schema.drop_duplicate_columns(df)
    assert out.columns == ["a", "b"] and tuple(out.first()) == (1, 2)


def test_target_kinds(spark):
    df = spark.createDataFrame([("x", "1.7", 2.9), ("w", "0", 1.1)], "s string, n string, f double")
    codes = {c: [r[0] for r in df.select(schema.coerced_target(schema.fit_target(df, c))).collect()] for c in df.columns}
    assert codes == {"s": [1, 0], "n": [1, 0], "f": [2, 1]}
    mixed = spark.createDataFrame([("x",), ("1",)], "s string")
    with pytest.raises(ValueError):
        schema.fit_target(mixed, "s")
    with pytest.raises(ValueError):
        schema.fit_target(mixed, "absent")


def test_align_strict_and_zero_fill(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert tuple(schema.align_features(df, ["b", "zz"]).first()) == (2, 0.0)
    with pytest.raises(ValueError):
        schema.align_features(df, ["zz"], strict=True)


def test_split_sizes_and_repeatability(spark):
    df = spark.range(768).withColumnRenamed("id", "k")
    a = split.holdout_split(df, ["k"]).filter("_split = 'test'")
    b = split.holdout_split(df.repartition(16), ["k"]).filter("_split = 'test'")
    assert a.count() == 154 and a.exceptAll(b).isEmpty()


def test_iterative_forest_recovers_a_relation(spark):
    df = spark.range(600).select(
        "id",
        F.when(F.col("id") % 10 != 3, (F.col("id") % 50).cast("double")).alias("a"),
        F.when(F.col("id") % 11 != 4, 2.0 * (F.col("id") % 50)).alias("b"),
    )
    state = impute.fit_impute(df, "missforest", ["id"], n_estimators=20, max_iter=4)
    out = impute.apply_impute(df, state, ["id"])
    err = out.filter("id % 10 = 3 and id % 11 <> 4").agg(F.avg(F.abs(F.col("a") - F.col("id") % 50))).first()[0]
    assert err < 2.0 and state.forests.rounds <= 4
    assert out.filter("a is null or b is null").isEmpty()


def test_mixed_forest_fills_labels(spark, sf):
    a = views.apps(spark, sf).select("ID", "o_totalprice", "c_acctbal", "c_mktsegment")
    out = iterative.impute_mixed(a, a, ["c_mktsegment"], ["c_acctbal"], n_estimators=5, max_iter=1)
    known = {r[0] for r in a.select("c_mktsegment").distinct().collect() if r[0]}
    assert {r[0] for r in out.select("c_mktsegment").distinct().collect()} <= known
    assert out.filter("c_acctbal is null").isEmpty()


@pytest.mark.parametrize("name", ["impute_iterative_rf", "impute_iterative_rf_cells", "impute_missforest_mixed", "impute_missforest_mixed_cells"])
def test_imputation_queries_grow_whole_forests(spark, sf, name, monkeypatch):
    given = []

    class Stop(Exception):
        pass

    def fit(df, columns, **params):
        given.append(params)
        raise Stop

    monkeypatch.setattr(iterative, "fit_forests", fit)
    with pytest.raises(Stop):
        catalog.queries()[name](spark, sf)
    assert given[0].get("max_depth") is None and given[0]["n_estimators"] >= 30 and given[0]["max_iter"] >= 5
