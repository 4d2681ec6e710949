import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskloom.operators import metrics, models, scoring
from riskloom.plans import bundle, catalog, config, curves, fit, search
from riskloom.session import scratch_path
from riskloom.sources import sinks, views
from riskloom.streaming.score_stream import score_stream

# Known decodings: (vector, {stage: (method, params)}).
KNOWN = [
    ([2, 1, 3, 0, 2, 0, 1, 3, 2, 1, 2, 3, 1, 0, 1, 1, 5, 1, 2, 2], {
        "imputation": ("missforest", {"n_estimators": 50, "max_iter": 20}), "outlier": ("none", {}),
        "resampling": ("oversample", {"sampling_strategy": 0.6}), "encoding": ("label", {}),
        "scaling": ("standard", {"with_mean": True, "with_std": False}),
        "model": ("random_forest", {"max_depth": 7, "min_samples_split": 10, "min_samples_leaf": 5})}),
    ([1, 2, 0, 1, 1, 2, 0, 1, 0, 0, 1, 1, 1, 0, 0, 0, 2, 3, 1, 0], {
        "imputation": ("median", {}), "outlier": ("isolation_forest", {"n_estimators": 50, "contamination": 0.025}),
        "resampling": ("none", {}), "encoding": ("onehot", {"max_cardinality_threshold": 20, "drop": "first"}),
        "scaling": ("standard", {"with_mean": True, "with_std": True}),
        "model": ("logistic_regression", {"C": 0.1, "solver_penalty_config": {"penalty": "l1", "solver": "saga", "l1_ratio": None}, "class_weight": "balanced", "max_iter": 100})}),
    ([2, 4, 2, 1, 3, 2, 0, 1, 1, 1, 4, 0, 0, 1, 0, 1, 6, 5, 4, 1], {
        "imputation": ("missforest", {"n_estimators": 200, "max_iter": 15}),
        "outlier": ("isolation_forest", {"n_estimators": 150, "contamination": 0.025}), "resampling": ("none", {}),
        "encoding": ("label", {}), "scaling": ("none", {}), "model": ("random_forest", {"max_depth": None, "min_samples_leaf": 2})}),
    ([2, 4, 2, 0, 2, 4, 2, 1, 4, 0, 4, 2, 1, 1, 1, 1, 0, 3, 3, 3], {
        "imputation": ("missforest", {"n_estimators": 200, "max_iter": 15}), "outlier": ("none", {}),
        "resampling": ("smote", {"k_neighbors": 5, "sampling_strategy": 0.75}), "encoding": ("onehot", {"drop": None}),
        "scaling": ("standard", {"with_mean": False, "with_std": False}),
        "model": ("random_forest", {"n_estimators": 25, "max_depth": 15, "min_samples_split": 15, "min_samples_leaf": 10})}),
    ([2, 2, 3, 2, 2, 3, 2, 4, 3, 1, 0, 3, 2, 1, 0, 3, 6, 1, 5, 0], {
        "imputation": ("missforest", {"n_estimators": 100, "max_iter": 20}), "outlier": ("iqr", {"multiplier": 2.5}),
        "resampling": ("smote", {"sampling_strategy": 0.6}), "encoding": ("label", {}), "scaling": ("minmax", {}),
        "model": ("neural_network", {"hidden_layer_sizes": (64, 64), "dropout_rate": 0.1, "learning_rate": 0.05, "batch_size": 16})}),
    ([0, 3, 0, 1, 3, 3, 2, 3, 4, 3, 0, 2, 1, 1, 0, 0, 7, 2, 5, 1], {
        "imputation": ("knn", {"n_neighbors": 10}), "outlier": ("isolation_forest", {"n_estimators": 150, "contamination": 0.05}),
        "resampling": ("smote", {"k_neighbors": 9, "sampling_strategy": 0.75}),
        "encoding": ("word2vec", {"embedding_dim": 25, "window": 3}), "scaling": ("standard", {"with_mean": False, "with_std": True}),
        "model": ("logistic_regression", {"solver_penalty_config": {"penalty": "l2", "solver": "liblinear", "l1_ratio": None}, "class_weight": None, "max_iter": 200})}),
    ([1, 0, 1, 0, 2, 1, 0, 0, 1, 0, 0, 1, 0, 1, 0, 0, 1, 2, 0, 1], {
        "imputation": ("median", {}), "outlier": ("none", {}), "resampling": ("none", {}),
        "encoding": ("onehot", {"max_cardinality_threshold": 10, "drop": "first"}), "scaling": ("none", {}),
        "model": ("logistic_regression", {"C": 0.01, "solver_penalty_config": {"penalty": "l2", "solver": "liblinear", "l1_ratio": None}, "class_weight": None, "max_iter": 200})}),
]


@pytest.mark.parametrize("vector,want", KNOWN)
def test_decode_known_vectors(vector, want):
    assert {s: (d["method"], d["params"]) for s, d in config.decode(vector).items()} == want


def test_gene_ranges():
    assert config.gene_ranges() == [3, 5, 4, 3, 5, 6, 4, 5, 5, 4, 5, 5, 3, 2, 2, 4, 8, 6, 6, 4]
    with pytest.raises(ValueError):
        config.decode([0] * 19)


def test_table_form_agrees_with_the_single_form(spark):
    vectors = [v for v, _ in KNOWN] + [[0] * 19]
    rows = config.decode_trials(spark.createDataFrame([(v,) for v in vectors], "genes array<int>")).collect()
    for r in rows:
        if len(r["genes"]) != 20:
            assert r["model_method"] is None and r["model_params"] is None
            continue
        for stage, d in config.decode(list(r["genes"])).items():
            text = ",".join(f"{k}={config.value_text(v)}" for k, v in d["params"].items())
            assert (r[f"{stage}_method"], r[f"{stage}_params"]) == (d["method"], text)


def test_average_precision_and_auc(spark):
    df = spark.createDataFrame([(s / 10, y) for s, y in zip(range(9, 3, -1), [1, 0, 1, 0, 1, 0])], "s double, y int")
    r = metrics.rank_metrics(metrics.binary_cells(df, "y", "s")).first()
    assert r["auprc"] == pytest.approx(0.755556, abs=1e-6) and r["roc_auc"] == pytest.approx(2 / 3)


def test_rank_metrics_over_buckets_with_a_hot_score(spark):
    df = spark.range(9_000).select(
        F.when(F.col("id") % 3 == 0, 0.25).otherwise((F.col("id") * 7919 % 1000003) / 1000003.0).alias("s"),
        (F.col("id") * 31 % 7 == 0).cast("int").alias("y"),
    )
    one = metrics.rank_metrics(metrics.binary_cells(df, "y", "s")).first()
    many = metrics.rank_metrics(metrics.binary_cells(df, "y", "s"), bucket_rows=100).first()
    assert math.isclose(one["auprc"], many["auprc"], rel_tol=1e-12) and math.isclose(one["roc_auc"], many["roc_auc"], rel_tol=1e-12)


def test_one_sided_labels_give_null(spark):
    df = spark.createDataFrame([(0.1, 0), (0.2, 0)], "s double, y int")
    r = metrics.rank_metrics(metrics.binary_cells(df, "y", "s")).first()
    assert r["auprc"] is None and r["roc_auc"] is None


def test_risk_limits_are_exclusive(spark):
    df = spark.createDataFrame([(0.7,), (0.71,), (0.4,), (0.41,)], "p double")
    assert [r[0] for r in df.select(scoring.risk_level(F.col("p"))).collect()] == ["Medium", "Low", "High", "Medium"]
    assert [r[0] for r in df.select(scoring.risk_level(F.col("p"), "higher_is_riskier")).collect()] == ["Medium", "High", "Low", "Medium"]


@pytest.fixture(scope="module")
def blobs(spark):
    rng = np.random.default_rng(4)
    centres = np.array([[0, 0], [3, 0], [0, 3]])
    y = rng.integers(0, 3, 900)
    x = centres[y] + rng.normal(size=(900, 2))
    return spark.createDataFrame(pd.DataFrame({"id": range(900), "a": x[:, 0], "b": x[:, 1], "y": y})).cache()


MODELS = [
    ("logistic_regression", {"C": 1.0, "class_weight": "balanced"}), ("random_forest", {"n_estimators": 20, "max_depth": 5}),
    ("gradient_boosting", {"n_estimators": 5}), ("neural_network", {"hidden_layer_sizes": (16,), "learning_rate": 0.01, "epochs": 8, "dropout_rate": 0.0}),
]


@pytest.mark.parametrize("kind,params", MODELS)
@pytest.mark.parametrize("classes", [2, 3])
def test_models_learn_blobs(spark, blobs, kind, params, classes):
    df = blobs.filter(F.col("y") < classes)
    model = models.fit_model(df, kind, ["a", "b"], "y", params, 42, "id")
    scored = models.score(df, model)
    acc = scored.agg(F.avg((F.col("prediction") == F.col("y")).cast("int"))).first()[0]
    total = scored.select(F.aggregate("probabilities", F.lit(0.0), lambda s, v: s + v).alias("t")).agg(F.min("t"), F.max("t")).first()
    assert acc > 0.8 and total[0] == pytest.approx(1.0) and total[1] == pytest.approx(1.0)
    importance = models.feature_importance(df, model)
    assert importance is None if kind == "neural_network" else importance.count() == 2


def test_logistic_penalty_strength(spark, blobs):
    df = blobs.filter("y < 2")
    weak = models.fit_model(df, "logistic_regression", ["a", "b"], "y", {"C": 100.0}).parts[0].coefficients.toArray()
    strong = models.fit_model(df, "logistic_regression", ["a", "b"], "y", {"C": 0.001}).parts[0].coefficients.toArray()
    assert np.abs(strong).sum() < 0.5 * np.abs(weak).sum()


def test_network_loss_falls_and_does_not_depend_on_input_partitions(spark, blobs):
    params = {"hidden_layer_sizes": (8,), "epochs": 4, "dropout_rate": 0.2, "learning_rate": 0.01}
    one = models.fit_model(blobs.repartition(1), "neural_network", ["a", "b"], "y", params, 1, "id")
    two = models.fit_model(blobs.repartition(9), "neural_network", ["a", "b"], "y", params, 1, "id")
    assert one.history[-1]["loss"] < one.history[0]["loss"]
    assert np.allclose(one.network.weights, two.network.weights)


def test_bad_features_are_named(spark, blobs):
    with pytest.raises(TypeError, match="s"):
        models.fit_model(blobs.withColumn("s", F.lit("x")), "random_forest", ["a", "s"], "y")
    with pytest.raises(ValueError):
        models.fit_model(blobs, "other", ["a"], "y")


def test_fitness_order():
    assert search.fitness({"auprc": 0.4, "accuracy": 0.9}, "random_forest") == 0.4
    assert search.fitness({"auprc": None}, "random_forest") == -0.51
    assert search.fitness({"average_precision_weighted": float("nan")}, "random_forest") == -0.61
    assert search.fitness({"average_precision_weighted": 0.3, "accuracy": 0.9}, "neural_network") == 0.9
    assert search.fitness({"f1": 1}, "x") == -0.8 and search.fitness(None, "x") == -0.9


BUNDLES = [
    [1, 0, 0, 2, 0, 0, 0, 0, 0, 1, 0, 0, 1, 0, 0, 0, 3, 0, 0, 0],
    [0, 0, 0, 0, 0, 0, 1, 0, 0, 0, 0, 0, 2, 0, 0, 1, 0, 0, 0, 0],
    [2, 0, 0, 0, 0, 0, 0, 0, 0, 2, 0, 0, 0, 0, 0, 2, 0, 3, 0, 0],
    [1, 0, 0, 1, 0, 3, 2, 0, 0, 3, 0, 0, 1, 0, 0, 3, 0, 0, 3, 3],
]


@pytest.mark.parametrize("vector", BUNDLES)
def test_bundle_scores_like_the_fitted_model(spark, sf, vector):
    cfg = config.decode(vector)
    cfg["model"]["params"].update({"n_estimators": 5} if vector[15] in (1, 2) else {"epochs": 2} if vector[15] == 3 else {})
    cfg["imputation"]["params"].update({"n_estimators": 3, "max_iter": 1} if vector[0] == 2 else {})
    apps = views.apps(spark, sf)
    fitted = fit.fit_config(apps, "label", cfg)
    path = scratch_path(spark, "models") + "/one"
    bundle.save(fitted, spark, path, "orders", chromosome=vector)
    a = fitted.score(apps).orderBy("ID").collect()
    b = bundle.score_bundle(spark, path, apps).orderBy("ID").collect()
    assert len(a) == apps.count()
    for x, y in zip(a, b):
        assert x["prediction"] == y["prediction"] and math.isclose(x["credit_score"], y["credit_score"], abs_tol=1e-9)
    listed = bundle.list_models(spark, path.rsplit("/", 1)[0]).first()
    assert listed["model_name"] == "one" and listed["kind"] == "full" and listed["chromosome"] == vector
    fewer = bundle.score_bundle(spark, path, apps.drop("label", "o_totalprice", "o_orderstatus"))
    assert fewer.count() == len(a)


def test_missing_bundle_raises(spark):
    with pytest.raises(Exception):
        bundle.load(spark, scratch_path(spark, "nothing"))


def test_text_target_and_unencoded(spark, sf):
    apps = views.apps(spark, sf)
    fitted = fit.fit_config(apps.drop("label"), "o_orderstatus", {**catalog.FLAGSHIP, "model": {"method": "random_forest", "params": {"n_estimators": 3, "max_depth": 3}}})
    out = fitted.score(apps)
    assert {"probability_class_0", "probability_class_1", "probability_class_2"} <= set(out.columns) and "risk_level" not in out.columns
    wide = apps.withColumn("o_orderpriority", F.col("ID").cast("string"))
    with pytest.raises(fit.Unencoded):
        fit.fit_config(wide, "label", {**catalog.FLAGSHIP, "encoding": {"method": "onehot", "params": {"max_cardinality_threshold": 10}}})


def test_run_config_saves_the_bundle_with_its_learning_curve(spark, monkeypatch):
    apps = spark.range(600).select(
        F.col("id").alias("ID"), (F.col("id") * 37 % 101).cast("double").alias("o_totalprice"), F.when(F.col("id") % 7 != 0, F.col("id") % 13).cast("double").alias("c_acctbal"),
        F.when(F.col("id") % 11 != 0, F.concat(F.lit("s"), F.col("id") % 5)).alias("c_mktsegment"), (F.col("id") * 37 % 101 > 60).cast("int").alias("label"))
    saved, kept = [], bundle.save
    monkeypatch.setattr(views, "apps", lambda spark, sf: apps)
    monkeypatch.setattr(bundle, "save", lambda *a: saved.append(kept(*a)) or saved[-1])
    rows = [r for r in catalog.run_config(spark, "").collect() if r["scope"] == "learning_curve"]
    assert {r["class"] for r in rows} == {str(i / 10) for i in range(1, 11)} and len(rows) == 40
    assert all(0.5 < r["value"] <= 1 for r in rows if r["metric"].endswith("mean"))
    assert bundle.describe(spark, saved[0])["chromosome"] == catalog.START[0] and bundle.load(spark, saved[0]).score(apps).count() == 600


def test_multiclass_boosting_query_grows_all_its_trees(spark, sf, monkeypatch):
    asked = []
    monkeypatch.setattr(models.boosting, "fit_boosted", lambda rows, width, k, counts, rounds, *rest: asked.append((k, rounds)) or 1 / 0)
    with pytest.raises(ZeroDivisionError):
        catalog.model_gradient_boosting_multiclass(spark, sf)
    assert asked == [(3, 100)]


def test_search_queries_run_the_default_search(spark, sf, monkeypatch):
    asked = []

    def found(df, target, keys=(), test=None, settings=None, trials_path=None, start=()):
        asked.append((settings or search.SearchSettings(), list(start), df.count()))
        return search.SearchResult(None, -1.0, df, None, None, None)

    monkeypatch.setattr(search, "search", found)
    monkeypatch.setattr(catalog, "_fitted", {})
    catalog.queries()["search"](spark, sf)
    assert asked == [(search.SearchSettings(population=10, generations=8, elitism=0.25, mutation=0.1, tournament=3), [], views.apps(spark, sf).count())]


def test_search_is_repeatable_resumes_and_records_failures(spark, sf):
    apps = views.apps(spark, sf)
    settings = search.SearchSettings(population=2, generations=2, elitism=0.5, tournament=2, mutation=0.0, parallel=2)
    path = scratch_path(spark, "trials")
    first = search.search(apps, "label", ["ID"], settings=settings, start=catalog.START[:1] * 2, trials_path=path)
    again = search.search(apps, "label", ["ID"], settings=settings, start=catalog.START[:1] * 2, trials_path=path)
    assert first.best_fitness == again.best_fitness > 0 and first.trials.count() == 4
    assert spark.read.parquet(path).count() == 4
    judge = search.Evaluator(first.data, settings)
    assert judge.evaluate([0] * 5)[0] == -1.0


def test_best_and_carried_forward(spark):
    rows = [(1, 0, [1], "random_forest", 0.5, None), (1, 1, [2], "random_forest", 0.5, None), (2, 0, [3], "neural_network", 0.4, None)]
    trials = spark.createDataFrame(rows, search.TRIALS)
    best = {r["generation"]: r for r in search.generation_best(trials).collect()}
    assert best[1]["best_chromosome"] == [1] and best[2]["best_fitness"] == 0.4
    carried = search.carry_forward(search.best_by_model(trials)).orderBy("generation").collect()
    assert carried[1]["random_forest"] == 0.5 and carried[0]["neural_network"] is None
    assert search.elite(trials, 1, 4, 0.25).first()["individual"] == 0


def test_learning_curve_shape(spark, blobs):
    out = curves.learning_curve(blobs, ["a", "b"], "y", "id", folds=3, sizes=(0.5, 1.0)).collect()
    assert [r["train_size"] for r in out] == [0.5, 1.0] and all(0.7 < r["test_mean"] <= 1 for r in out)


def test_report_sink_round_trip(spark):
    rows = sinks.metric_rows(spark, "r", {"auprc": None, "accuracy": 0.5}, [("0", "precision", 1.0)])
    path = sinks.write_report(rows, None, {"a": 1}, scratch_path(spark, "report"))
    assert spark.read.json(f"{path}/metrics").count() == 3


def test_stream_of_files_is_scored(spark, sf):
    apps = views.apps(spark, sf)
    fitted = fit.fit_config(apps, "label", catalog.FLAGSHIP)
    model, source, out, mark = (scratch_path(spark, n) for n in ("m", "in", "out", "mark"))
    bundle.save(fitted, spark, model)
    apps.write.parquet(source)
    query = score_stream(spark, model, source, apps.schema, out, mark)
    query.awaitTermination(120)
    assert query.exception() is None
    assert spark.read.parquet(out).drop("batch").count() == apps.count()


def test_unlabelled_test_table_gives_way_to_a_validation_cut(spark, sf):
    apps = views.apps(spark, sf)
    data = fit.shape(apps, "label", ["ID"], test=apps.withColumn("label", F.lit(None).cast("int")))
    assert data.evaluated_on == "validation_set_from_train" and data.test.count() == math.ceil(0.2 * apps.count())


def test_history_and_description(spark, blobs, sf):
    out = curves.training_history(blobs, ["a", "b"], "y", "id", {"epochs": 2, "hidden_layer_sizes": (8,)}).collect()
    assert len(out) == 2 and 0 < out[-1]["val_auprc"] <= 1
    fitted = fit.fit_config(views.apps(spark, sf), "label", catalog.FLAGSHIP)
    path = bundle.save(fitted, spark, scratch_path(spark, "m"), "orders")
    assert bundle.describe(spark, path)["target_column"] == "label"


def test_scoring_is_map_only(spark, sf):
    fitted = fit.fit_config(views.apps(spark, sf), "label", catalog.FLAGSHIP)
    rows = spark.createDataFrame(views.apps(spark, sf).limit(20).toPandas(), views.apps(spark, sf).schema)
    plan = fitted.score(rows)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "SinglePartition" not in plan


def test_dotted_and_repeated_names(spark, sf):
    apps = views.apps(spark, sf).withColumnRenamed("label", "next.month").withColumnRenamed("c_acctbal", "acct.bal")
    twice = apps.select("*", F.lit(1.0).alias("o_totalprice"))
    fitted = fit.fit_config(twice, "next.month", catalog.FLAGSHIP)
    out = fitted.score(apps)
    assert "acct.bal" in out.columns and "next.month" in out.columns and out.count() == apps.count()
