"""Classifiers behind one fit/score pair: Spark ML's logistic model, the network of neural.py, the trees of trees.py and boosting.py."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F, types as T

from riskloom.operators import boosting, neural, trees

#: Rows of one task of the logistic model beyond ``LOGISTIC_TASKS`` tasks: each of its many passes is a job, and small tasks would be most of it.
LOGISTIC_ROWS, LOGISTIC_TASKS = 200_000, 48
KINDS = ("logistic_regression", "random_forest", "gradient_boosting", "neural_network")


@dataclass
class FittedModel:
    kind: str
    features: list[str]
    classes: int
    params: dict
    parts: list = field(default_factory=list)
    network: neural.Network | None = None
    forest: trees.Forest | None = None
    boosted: boosting.Boosted | None = None
    history: list[dict] = field(default_factory=list)


def check_features(df: DataFrame, features: Sequence[str]) -> None:
    """Text, dates and nested columns cannot be features; say which."""
    bad = [
        c for c in features
        if not isinstance(df.schema[c].dataType, (T.NumericType, T.BooleanType))
    ]
    if bad:
        raise TypeError(f"not numeric, encode or cast first: {bad}")


def assembled(df: DataFrame, features: Sequence[str], out: str = "_features") -> DataFrame:
    check_features(df, features)
    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="error").transform(df)


def balanced_weight(counts: dict, label: str):
    """n / (classes * n_class) per row, as an expression over a handful of classes."""
    n, k = sum(counts.values()), len(counts)
    w = F.lit(1.0)
    for c, m in counts.items():
        w = F.when(F.col(label) == F.lit(c), F.lit(n / (k * m))).otherwise(w)
    return w


def fit_model(
    train: DataFrame, kind: str, features: Sequence[str], label: str, params: dict | None = None, seed: int = 42, key: str | None = None
) -> FittedModel:
    """Fit on rows whose label is 0..K-1. The caller keeps the rows persisted."""
    if kind not in KINDS:
        raise ValueError(f"unsupported model type: {kind}")
    params = dict(params or {})
    features = list(features)
    counts = {r[label]: r["count"] for r in train.groupBy(label).count().collect()}
    if not counts:
        raise ValueError("no training rows")
    n, k = sum(counts.values()), max(2, int(max(counts)) + 1)
    model = FittedModel(kind, features, k, params)
    if kind == "neural_network":
        check_features(train, features)
        model.network, model.history = neural.fit_network(train, features, label, k, params, seed, key)
        return model
    if kind == "logistic_regression":
        model.parts = [_logistic(assembled(train, features), label, counts, n, params)]
        return model
    rows = _tree_rows(train, features, label, key)
    depth, leaf, least = params.get("max_depth", None if kind == "random_forest" else 3), int(params.get("min_samples_leaf", 1)), int(params.get("min_samples_split", 2))
    depth = None if depth is None else int(depth)
    if kind == "random_forest":
        rules = trees.Rules(k, depth, least, leaf, trees.tried_of(params.get("max_features", "sqrt"), len(features)), bool(params.get("bootstrap", True)), seed)
        model.forest = trees.fit_forest(rows, len(features), rules, int(params.get("n_estimators", 100)))
    else:
        model.boosted = boosting.fit_boosted(
            rows, len(features), k, counts, int(params.get("n_estimators", 100)), float(params.get("learning_rate", 0.1)), depth, least, leaf, float(params.get("subsample", 1.0)), seed)
    return model


def _tree_rows(train: DataFrame, features: Sequence[str], label: str, key: str | None) -> DataFrame:
    """(h, m, x, y): rows named by their key, or by their content, where copies of a row share their fate."""
    check_features(train, features)
    cells = [F.col(f"`{c}`").cast("double") for c in features]
    named = F.xxhash64(F.col(key)) if key else F.xxhash64(*cells, F.col(label))
    return train.select(named.alias("h"), F.lit(1).alias("m"), F.array(*cells).alias("x"), F.col(label).cast("double").alias("y"))


def _logistic(data: DataFrame, label: str, counts: dict, n: int, params: dict):
    """Spark minimises mean loss, so the penalty weight is 1 / (C n)."""
    combo = {**params, **(params.get("solver_penalty_config") or {})}
    penalty = combo.get("penalty", "l2")
    mix = {"l1": 1.0, "elasticnet": combo.get("l1_ratio") if combo.get("l1_ratio") is not None else 0.5}.get(penalty, 0.0)
    strength = 0.0 if penalty is None else 1.0 / (float(params.get("C", 1.0)) * n)
    lr = LogisticRegression(
        featuresCol="_features", labelCol=label, regParam=strength, elasticNetParam=float(mix),
        maxIter=int(params.get("max_iter", 100)), standardization=False,
        family="multinomial" if max(counts) > 1 else "binomial",
    )
    if params.get("class_weight") == "balanced":
        data = data.withColumn("_weight", balanced_weight(counts, label))
        lr = lr.setWeightCol("_weight")
    return lr.fit(data.coalesce(max(LOGISTIC_TASKS, n // LOGISTIC_ROWS)))


def score(df: DataFrame, model: FittedModel) -> DataFrame:
    """Adds prediction (class index) and probabilities (array<double>); map-only."""
    if model.kind == "neural_network":
        check_features(df, model.features)
        probs = neural.predict(df, model.network, model.features)
        return df.withColumn("probabilities", probs).withColumn("prediction", _arg_max("probabilities", model.classes))
    if model.kind in ("random_forest", "gradient_boosting"):
        check_features(df, model.features)
        forest = model.kind == "random_forest"
        done = trees.predict(df, model.forest, model.features, "probabilities") if forest else boosting.predict(df, model.boosted, model.features, "probabilities")
        return done.withColumn("prediction", _arg_max("probabilities", model.classes))
    fitted = model.parts[0]
    fitted = fitted.copy({fitted.probabilityCol: "_probability", fitted.rawPredictionCol: "_raw", fitted.predictionCol: "_prediction"})
    done = fitted.transform(assembled(df, model.features)).withColumn("probabilities", vector_to_array("_probability"))
    return done.withColumn("prediction", F.col("_prediction").cast("int")).drop("_features", "_raw", "_probability", "_prediction")


def _arg_max(col: str, classes: int):
    if classes == 2:
        return (F.col(col)[1] > 0.5).cast("int")
    return (F.array_position(col, F.array_max(col)) - 1).cast("int")


def feature_importance(df: DataFrame, model: FittedModel) -> DataFrame | None:
    """(feature, importance), largest first; signed coefficients for a binary logistic model."""
    if model.kind == "neural_network":
        return None
    if model.kind == "logistic_regression":
        matrix = model.parts[0].coefficientMatrix.toArray()
        values = matrix[0] if matrix.shape[0] == 1 else abs(matrix).mean(axis=0)
    else:
        values = model.forest.importance if model.kind == "random_forest" else model.boosted.importance
    rows = [(f, float(v)) for f, v in zip(model.features, values)]
    table = df.sparkSession.createDataFrame(rows, "feature string, importance double")
    rank = F.abs("importance") if model.kind == "logistic_regression" else F.col("importance")
    return table.orderBy(rank.desc(), "feature")
