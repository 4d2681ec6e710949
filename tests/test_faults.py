"""Inputs that once lost cells, rows or rounds without a word."""

import os
import subprocess
import sys
import textwrap

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.functions.rowid import with_row_id
from riskloom.operators import impute, neural, schema
from riskloom.operators.split import holdout_split
from riskloom.plans import catalog, curves, fit, search
from riskloom.sources import tables, views

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_python_workers_get_the_package(tmp_path):
    script = tmp_path / "foreign.py"
    script.write_text(textwrap.dedent(f"""
        import sys
        sys.path.insert(0, {ROOT!r})
        from riskloom.session import local_session
        from riskloom.operators import outliers
        spark = local_session(2, "foreign")
        df = spark.range(300).selectExpr("id", "cast(id % 17 as double) a", "cast(id % 5 as double) b")
        print("ROWS", outliers.remove_outliers(df, "isolation_forest", [], ["id"]).count())
    """))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "ROWS" in done.stdout, done.stderr[-2000:]


def test_pair_of_files_keeps_every_cell(spark, tmp_path):
    (tmp_path / "train.csv").write_text("a,b,c\n1,x,1\n2,y,2\n")
    (tmp_path / "test.csv").write_text("a,b,c\n3.5,z,abc\n4,w,7\n")
    pair = tables.read_pair(spark, str(tmp_path / "train.csv"), str(tmp_path / "test.csv"))
    assert sorted((r["a"], r["c"]) for r in pair.filter("_split = 'test'").collect()) == [(3.5, "abc"), (4.0, "7")]
    assert sorted((r["a"], r["c"]) for r in pair.filter("_split = 'train'").collect()) == [(1.0, "1"), (2.0, "2")]


def test_row_keys_do_not_run_together(spark):
    df = spark.createDataFrame([("a", "b|c"), ("a|b", "c"), ("x", None), (None, "x")], "k string, m string")
    assert with_row_id(df, ["k", "m"]).select("_rid").distinct().count() == 4
    assert with_row_id(df, ["k"]).select("_rid").distinct().count() == 4


def test_repeated_keys_split_exactly(spark):
    df = spark.range(5000).selectExpr("id % 3 AS k", "id AS v")
    keyed = with_row_id(df, ["k"])
    assert keyed.select("_rid").distinct().count() == 5000
    assert holdout_split(keyed, ["_rid"]).filter("_split = 'test'").count() == 1000


def test_scoring_keeps_fractions_and_counts_other_cells(spark):
    raw = spark.createDataFrame([(1, "a")], "age int, t string").schema
    df = spark.createDataFrame([("3.9", "x"), ("n/a", "y"), (None, "z")], "age string, t string")
    assert [r["age"] for r in fit.align_raw(df, raw).collect()] == [3.9, None, None]
    assert fit.unreadable(df, raw) == {"age": 1}


def test_network_ignores_arrow_batches_and_sums_in_levels(spark, monkeypatch):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(700, 2))
    df = spark.createDataFrame([(k, float(a), float(b), int(a + b > 0)) for k, (a, b) in enumerate(x)], "k long, a double, b double, y int").cache()
    monkeypatch.setattr(neural, "ROWS_PER_PART", 90)
    monkeypatch.setattr(neural, "MOST_PARTS", 20)
    params = {"hidden_layer_sizes": (5,), "epochs": 2}
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    plain, _ = neural.fit_network(df, ["a", "b"], "y", 2, params, 7, "k")
    monkeypatch.setattr(neural, "FAN", 2)
    levels, _ = neural.fit_network(df, ["a", "b"], "y", 2, params, 7, "k")
    try:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "17")
        small, _ = neural.fit_network(df, ["a", "b"], "y", 2, params, 7, "k")
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert np.allclose(plain.weights, levels.weights, rtol=1e-9) and (levels.weights == small.weights).all()


def test_folds_are_stratified(spark, monkeypatch):
    df = spark.range(200).selectExpr("cast(id as string) AS k", "cast(id < 10 as int) AS y", "cast(id % 13 as double) AS f")
    seen = []

    def fake(part, *a, **b):
        seen.append({r["y"]: r["n"] for r in part.groupBy("y").agg(F.count("*").alias("n")).collect()})
        return None

    monkeypatch.setattr(curves.models, "fit_model", fake)
    monkeypatch.setattr(curves.models, "score", lambda both, model: both.withColumn("prediction", F.lit(0)))
    curves.learning_curve(df, ["f"], "y", "k", sizes=(0.5, 1.0), parallel=1).collect()
    assert seen == [{1: 4, 0: 76}] * 5 + [{1: 8, 0: 152}] * 5


def test_foreign_trials_raise(spark, sf, tmp_path):
    apps = views.apps(spark, sf).select("ID", "o_totalprice", "c_acctbal", "label").limit(400)
    settings = search.SearchSettings(population=2, generations=1)
    path = str(tmp_path / "trials")
    spark.createDataFrame([(1, i, [0] * 20, "x", 0.9, None) for i in range(5)], search.TRIALS).write.parquet(path)
    with pytest.raises(ValueError, match="new path"):
        search.search(apps, "label", ["ID"], settings=settings, start=catalog.START[:1] * 2, trials_path=path)


def test_many_values_and_many_classes(spark):
    df = spark.range(120_000).selectExpr("concat('v', if(id < 3, 0, id)) AS t", "id % 1500 AS y")
    state = impute.fit_impute(df.select("t"), "median")
    assert state.modes == {"t": "v0"}
    target = schema.fit_target(df, "y")
    assert len(target.classes) == 1500
    assert df.select(schema.class_index(target).alias("c")).distinct().count() == 1500


def test_leave_one_out_through_the_pipeline(spark, sf):
    apps = views.apps(spark, sf).select("ID", "o_totalprice", "o_orderpriority", "label")
    config = {
        "imputation": {"method": "median", "params": {}}, "outlier": {"method": "none", "params": {}},
        "encoding": {"method": "leaveoneout", "params": {"sigma": 0.0}}, "resampling": {"method": "none", "params": {}},
        "scaling": {"method": "none", "params": {}}, "model": {"method": "logistic_regression", "params": {}},
    }
    data = fit.shape(apps, "label", ["ID"])
    ready = fit.prepare(data, config)
    sums = {}
    for r in data.train.collect():
        n, s = sums.get(r["o_orderpriority"], (0, 0))
        sums[r["o_orderpriority"]] = (n + 1, s + r[fit.LABEL])
    kind = {r[fit.ROW]: r["o_orderpriority"] for r in data.train.collect()}
    for r in ready.train.collect():
        n, s = sums[kind[r[fit.ROW]]]
        assert r["o_orderpriority"] == pytest.approx((s - r[fit.LABEL]) / (n - 1))
    kind = {r[fit.ROW]: r["o_orderpriority"] for r in data.test.collect()}
    for r in ready.test.collect():
        n, s = sums[kind[r[fit.ROW]]]
        assert r["o_orderpriority"] == pytest.approx(s / n)
    fitted = fit.fit_config(apps, "label", config, ["ID"])
    assert 0 <= fitted.metrics["auprc"] <= 1 and fitted.metrics["average_precision_weighted"] == pytest.approx(fitted.metrics["auprc"])
