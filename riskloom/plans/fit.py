"""From a table with a target to a fitted, evaluated classifier.

Every stage is fitted on training rows only and is a lazy projection or filter when
applied. The same chain, without the row-changing stages, scores new tables.
"""

from __future__ import annotations

import json
import logging
import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F, types as T

from riskloom.functions.columns import nan_to_null, reject_nested
from riskloom.functions.rowid import with_row_id
from riskloom.operators import encode, impute, models, outliers, resample, scale, schema, scoring
from riskloom.operators.metrics import evaluate
from riskloom.operators.split import evaluation_split, holdout_test
from riskloom.plans import curves
from riskloom.session import hold
from riskloom.sources.tables import safe_names, with_safe_names

LABEL, ROW = "_y", "_rid"
#: Rows of one task: the layout, and with it the seeded bagging of the forests, follows the rows alone.
TASK_ROWS = 20_000
log = logging.getLogger(__name__)


class Unencoded(ValueError):
    """Text columns are left that no model can read."""


@dataclass
class Prepared:
    train: DataFrame
    test: DataFrame
    impute: impute.ImputeState
    encode: encode.EncodeState
    scale: scale.ScaleState
    balanced: DataFrame


@dataclass
class Fitted:
    target: schema.TargetState
    config: dict
    raw_schema: T.StructType
    dropped: list[str]
    impute: impute.ImputeState
    encode: encode.EncodeState
    scale: scale.ScaleState
    model: models.FittedModel
    metrics: dict = field(default_factory=dict)
    report: list[tuple] = field(default_factory=list)
    importance: DataFrame | None = None
    evaluated_on: str = ""
    curve: DataFrame | None = None

    @property
    def raw_features(self) -> list[str]:
        return [f.name for f in self.raw_schema]

    def features(self, df: DataFrame) -> DataFrame:
        """Raw columns to model features: align, impute, encode, scale; map-only but for
        lookups of fitted tables."""
        out = align_raw(df, self.raw_schema)
        out = impute.apply_impute(out, self.impute, exclude=[scoring.RAW])
        out = encode.apply_encode(out, self.encode)
        return scale.apply_scale(out, self.scale)

    def score(self, df: DataFrame, orientation: str = "as_scored") -> DataFrame:
        """Original columns plus prediction, class probabilities and, for two classes, risk."""
        df, original = with_safe_names(df)
        scored = models.score(self.features(scoring.with_raw(df)), self.model)
        out = scoring.format_results(scored, self.target.classes, orientation)
        return out.toDF(*[original.get(c, c) for c in out.columns]) if original else out


def align_raw(df: DataFrame, raw: T.StructType) -> DataFrame:
    """The training columns in order; a missing number is 0, missing text NULL.

    Numbers are doubles, as all features are, so a fraction in a column of whole numbers is kept. A cell that is no number counts
    as missing and is imputed; :func:`unreadable` tells how many there are.
    """
    out = []
    for f in raw:
        if f.name in df.columns:
            number = isinstance(f.dataType, T.NumericType)
            out.append((F.col(f.name).try_cast("double") if number else F.col(f.name).cast(f.dataType)).alias(f.name))
        else:
            fill = F.lit(0) if isinstance(f.dataType, T.NumericType) else F.lit(None)
            out.append(fill.cast(f.dataType).alias(f.name))
    kept = [scoring.RAW] if scoring.RAW in df.columns else []
    return nan_to_null(df.select(*kept, *out))


def unreadable(df: DataFrame, raw: T.StructType) -> dict[str, int]:
    """Numeric training columns of a table to score that hold cells which are no number, with their count; one aggregate."""
    names = [f.name for f in raw if f.name in df.columns and isinstance(f.dataType, T.NumericType) and not isinstance(df.schema[f.name].dataType, T.NumericType)]
    if not names:
        return {}
    bad = [F.count(F.when(F.col(c).isNotNull() & F.col(c).try_cast("double").isNull(), 1)).alias(f"b{i}") for i, c in enumerate(names)]
    row = df.agg(*bad).first()
    return {c: row[f"b{i}"] for i, c in enumerate(names) if row[f"b{i}"]}


@dataclass
class Shaped:
    """Split rows with key, class index and raw features; the common start of every configuration."""

    train: DataFrame
    test: DataFrame
    target: schema.TargetState
    raw_schema: T.StructType
    dropped: list[str]
    evaluated_on: str


def shape(
    df: DataFrame, target: str, keys: Sequence[str] = (), test: DataFrame | None = None, fraction: float = 0.2, seed: int = 42
) -> Shaped:
    """Rows with a known target, keyed and split; identifier columns leave the features.

    A test table without known targets gives way to a validation cut of train. Rows are dealt by key into tasks of ``TASK_ROWS``.
    """
    reject_nested(df)
    df = schema.drop_duplicate_columns(df)
    named = safe_names(df.columns)
    df, _ = with_safe_names(df)
    test = with_safe_names(test)[0] if test is not None else None
    target, keys = named.get(target, target), [named.get(k, k) for k in keys]
    if target not in df.columns:
        raise ValueError(f"target column {target!r} is not in the data")
    ids = schema.id_columns(df, target)
    keys = list(keys) or ids[:1]
    keyed = with_row_id(nan_to_null(df), keys)
    evaluated_on = "test_set"
    if test is None:
        is_test, n = holdout_test(keyed, [ROW], fraction, seed)
        train, rest = keyed.filter(~is_test), keyed.filter(is_test)
    else:
        train, rest, evaluated_on = evaluation_split(keyed, with_row_id(nan_to_null(test), keys), target, [ROW], fraction, seed)
        n = df.count()
    train = train.filter(F.col(target).isNotNull())
    state = schema.fit_target(train, target)
    dropped = list(dict.fromkeys([*ids, *[k for k in keys if k != target]]))
    keep = [c for c in df.columns if c not in dropped and c != target]
    tasks = max(1, math.ceil(n / TASK_ROWS))

    def shaped(t: DataFrame) -> DataFrame:
        present = [F.col(c) if c in t.columns else F.lit(None).alias(c) for c in keep]
        out = t.select(ROW, schema.class_index(state).alias(LABEL), *present).filter(F.col(LABEL).isNotNull())
        return out.repartition(tasks, ROW).sortWithinPartitions(ROW)

    train, rest = hold(shaped(train)), hold(shaped(rest))
    raw = T.StructType([df.schema[c] for c in keep])
    return Shaped(train, rest, state, raw, dropped, evaluated_on)


def prepare(data: Shaped, config: dict, reuse: Callable | None = None) -> Prepared:
    """Impute, filter, encode, rebalance and scale.

    ``reuse(key, make)`` may return an earlier result for the same stage prefix; only
    then is every stage kept. A single run keeps the resampled and the final rows and
    recomputes the projections between.
    """
    keep = hold if reuse else (lambda df: df)
    reuse = reuse or (lambda key, make: make())
    skip = [ROW, LABEL]
    key: list = []

    def step(stage: str, make):
        key.append((stage, json.dumps(config[stage], sort_keys=True, default=list)))
        return reuse(tuple(key), make)

    def do_impute():
        state = impute.fit_impute(data.train, config["imputation"]["method"], skip, **config["imputation"]["params"])
        return keep(impute.apply_impute(data.train, state, skip)), keep(impute.apply_impute(data.test, state, skip)), state

    train, test, imputed = step("imputation", do_impute)

    def do_outliers():
        return keep(outliers.remove_outliers(train, config["outlier"]["method"], [LABEL], [ROW], **config["outlier"]["params"]))

    kept = step("outlier", do_outliers)

    def do_encode():
        method, params = config["encoding"]["method"], config["encoding"]["params"]
        own_target = method == "leaveoneout"
        state = encode.fit_encode(kept, method, LABEL if own_target else None, skip, **params)
        if state.unencoded:
            raise Unencoded(f"too many categories for one-hot: {state.unencoded}")
        coded = encode.apply_encode(kept, state)
        if own_target and state.columns:
            coded = encode.leave_one_out_train(kept, state, LABEL, [ROW], float(params.get("sigma", 0.05)))
        return keep(coded), keep(encode.apply_encode(test, state)), state

    coded, coded_test, encoded = step("encoding", do_encode)
    features = [c for c in coded.columns if c not in skip]

    def do_resample():
        models.check_features(coded, features)
        done = resample.resample(
            coded, LABEL, ROW, config["resampling"]["method"], features, **config["resampling"]["params"]
        )
        done = done.select(ROW, LABEL, *features)
        return done if config["resampling"]["method"] == "none" else hold(done)

    balanced = step("resampling", do_resample)

    def do_scale():
        state = scale.fit_scale(balanced, config["scaling"]["method"], skip, **config["scaling"]["params"])
        return hold(scale.apply_scale(balanced, state)), hold(scale.apply_scale(coded_test, state)), state

    ready, ready_test, scaled = step("scaling", do_scale)
    return Prepared(ready, ready_test, imputed, encoded, scaled, balanced)


def train_and_evaluate(data: Shaped, config: dict, ready: Prepared, seed: int = 42) -> Fitted:
    features = [c for c in ready.train.columns if c not in (ROW, LABEL)]
    model = models.fit_model(
        ready.train, config["model"]["method"], features, LABEL, config["model"]["params"], seed, ROW
    )
    model.classes = max(model.classes, len(data.target.classes))
    fitted = Fitted(
        data.target, config, data.raw_schema, data.dropped, ready.impute, ready.encode, ready.scale, model,
        evaluated_on=data.evaluated_on,
    )
    scored = models.score(ready.test, model)
    fitted.metrics, fitted.report = evaluate(scored, LABEL, "prediction", "probabilities", len(data.target.classes))
    fitted.importance = models.feature_importance(ready.train, model)
    return fitted


def fit_config(
    df: DataFrame, target: str, config: dict, keys: Sequence[str] = (), test: DataFrame | None = None, seed: int = 42, learning_curve: bool = False
) -> Fitted:
    """One configuration end to end; ``learning_curve`` adds accuracies over sizes and folds of the training rows, of a network its epochs."""
    data = shape(df, target, keys, test, seed=seed)
    ready = prepare(data, config)
    fitted = train_and_evaluate(data, config, ready, seed)
    if learning_curve:
        fitted.curve = _curve(ready.train, fitted.model, seed)
    for kept in (data.train, data.test, ready.balanced, ready.train, ready.test):
        kept.unpersist()
    return fitted


def _curve(train: DataFrame, model: models.FittedModel, seed: int) -> DataFrame:
    if model.kind == "neural_network":
        return curves.history_table(train.sparkSession, model)
    return curves.learning_curve(train, model.features, LABEL, ROW, model.kind, model.params, seed=seed)
