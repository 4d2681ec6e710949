"""Column and target shaping; everything but the target fit is a single projection."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F, types as T


def id_columns(df: DataFrame, target: str | None = None) -> list[str]:
    """Columns named id in any case, the target excepted."""
    return [c for c in df.columns if c.lower() == "id" and c != target]


def drop_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    gone = set(names)
    return df.select(*[c for c in df.columns if c not in gone])


def drop_duplicate_columns(df: DataFrame) -> DataFrame:
    """Keep the first of several columns with the same name."""
    seen: set[str] = set()
    keep = []
    for i, c in enumerate(df.columns):
        if c not in seen:
            seen.add(c)
            keep.append((f"_p{i}", c))
    flat = df.toDF(*[f"_p{i}" for i in range(len(df.columns))])
    return flat.select(*[F.col(p).alias(c) for p, c in keep])


@dataclass
class TargetState:
    """How a raw target becomes an integer, and which integers were seen in training."""

    target: str
    kind: str
    labels: list[str] = field(default_factory=list)
    classes: list[int] = field(default_factory=list)

    @property
    def positive(self) -> int | None:
        return self.classes[-1] if len(self.classes) == 2 else None


def _class_values(values: DataFrame) -> list:
    """All classes: a model holds an entry for each of them anyway."""
    return sorted(r[0] for r in values.distinct().collect())


def fit_target(df: DataFrame, target: str) -> TargetState:
    if target not in df.columns:
        raise ValueError(f"target column {target!r} is not in the data")
    kind = df.schema[target].dataType
    state = TargetState(target, "number")
    if not isinstance(kind, T.NumericType):
        text = F.col(target).cast("string")
        stat = df.agg(
            F.count(text).alias("n"), F.count(text.try_cast("double")).alias("num")
        ).first()
        if stat["num"] == 0:
            state.kind = "labels"
            state.labels = _class_values(df.select(text).filter(F.col(target).isNotNull()))
        elif stat["num"] < stat["n"]:
            raise ValueError(f"target column {target!r} mixes numbers and other text")
        else:
            state.kind = "text_number"
    state.classes = _class_values(
        df.select(coerced_target(state).alias("y")).filter("y IS NOT NULL")
    )
    return state


def coerced_target(state: TargetState) -> Column:
    """Integer target: numbers are truncated, other text gets its sorted position."""
    c = F.col(state.target)
    if state.kind == "labels":
        return _position(c.cast("string"), state.labels)
    if state.kind == "text_number":
        return c.cast("string").try_cast("double").cast("int")
    return c.cast("int")


def class_index(state: TargetState) -> Column:
    """0..K-1 position of the coerced target; NULL for classes not seen in training."""
    return _position(coerced_target(state), state.classes)


def _position(c: Column, values: Sequence) -> Column:
    at = F.array_position(F.array(*[F.lit(v) for v in values]), c).cast("int")
    return F.when(at > 0, at - 1)


def fit_labels(df: DataFrame, target: str) -> list[str]:
    """Sorted text classes of a target, numbers included."""
    return _class_values(df.select(F.coalesce(F.col(target).cast("string"), F.lit("nan"))))


def label_encoded(target: str, labels: Sequence[str]) -> Column:
    return _position(F.coalesce(F.col(target).cast("string"), F.lit("nan")), labels)


def align_features(df: DataFrame, expected: Sequence[str], keep: Sequence[str] = (), strict: bool = False) -> DataFrame:
    """Expected features in order, missing ones as 0; ``keep`` names columns carried along."""
    missing = [c for c in expected if c not in df.columns]
    if strict and missing:
        raise ValueError(f"missing features: {missing}")
    return df.select(*keep, *[F.col(c) if c in df.columns else F.lit(0.0).alias(c) for c in expected])


def alignment_report(df: DataFrame, expected: Sequence[str], target: str | None = None) -> DataFrame:
    """(column, status, null_share) with status present, missing or extra; one aggregate."""
    names = [c for c in df.columns if c != target]
    known = set(expected)
    shares = df.agg(
        *[F.avg(F.when(F.col(c).isNull(), 1.0).otherwise(0.0)).alias(c) for c in names]
    )
    rows = [
        F.struct(F.lit(c).alias("column"), F.lit("present" if c in known else "extra").alias("status"), F.col(c).alias("null_share"))
        for c in names
    ] + [
        F.struct(F.lit(c).alias("column"), F.lit("missing").alias("status"), F.lit(None).cast("double").alias("null_share"))
        for c in expected if c not in names
    ]
    return shares.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
