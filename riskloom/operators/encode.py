"""Categorical encoders: fitted on training rows, unseen values handled on apply."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window, functions as F

from riskloom import limits
from riskloom.functions.columns import as_category, categorical_columns, replace_columns
from riskloom.functions.hashing import normal, order_hash, unit
from riskloom.functions.lookup import fits_broadcast, lookup
from riskloom.operators import text
from riskloom.operators.schema import fit_labels, label_encoded
from riskloom.session import keep_small, settle
from riskloom.sources.tables import safe_names

#: Seed of the category vectors.
VECTOR_SEED = 42
METHODS = ("onehot", "label", "ordinal", "lsa", "word2vec", "embedding", "row_word2vec", "row_fasttext", "leaveoneout")


@dataclass
class EncodeState:
    method: str
    columns: list[str] = field(default_factory=list)
    params: dict = field(default_factory=dict)
    categories: dict[str, list[str]] = field(default_factory=dict)
    unencoded: list[str] = field(default_factory=list)
    table: DataFrame | None = None
    prior: float | None = None
    output: list[str] = field(default_factory=list)
    small: bool | None = None


def category_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, value, n) over all named columns in one scan and one combined shuffle."""
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), as_category(c).alias("value")) for c in cols]))
    return df.select(cells.alias("r")).select("r.*").groupBy("column", "value").agg(F.count("*").alias("n"))


def sorted_codes(counts: DataFrame) -> DataFrame:
    """(column, value, n, code): code is the 0-based sorted position of the value.

    Small value tables are ranked by one window per column. A larger one is
    range-sorted across tasks and stored, and codes are partition offset plus position.
    """
    counts = keep_small(counts)
    if counts.count() <= limits.ONE_TASK_ROWS:
        order = Window.partitionBy("column").orderBy("value")
        return keep_small(counts.withColumn("code", (F.row_number().over(order) - 1).cast("int")))
    placed = settle(
        counts.orderBy("column", "value").withColumn("_at", F.monotonically_increasing_id())
    ).withColumn("_part", F.shiftrightunsigned("_at", 33))
    firsts = placed.groupBy("_part", "column").agg(F.count("*").alias("c"), F.min("_at").alias("_first"))
    ahead = Window.partitionBy("column").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = firsts.select("_part", "column", "_first", F.coalesce(F.sum("c").over(ahead), F.lit(0)).alias("_off"))
    return settle(
        placed.join(F.broadcast(offsets), ["_part", "column"]).select(
            "column", "value", "n", (F.col("_off") + F.col("_at") - F.col("_first")).cast("int").alias("code")
        )
    )


def per_column_lookup(
    df: DataFrame, cols: Sequence[str], table: DataFrame, payload: Sequence[str], make, small: bool | None = None
) -> DataFrame:
    """For each column, join its slice of a (column, value, ...) table and replace it by make(c).

    ``make`` maps a column name to {output name: expression over the payload}.
    """
    order = df.columns
    extra: list[str] = []
    small = fits_broadcast(table) if small is None else small
    for c in cols:
        part = table.filter(F.col("column") == c)
        keyed = df.withColumn("_value", as_category(c))
        joined = lookup(
            keyed, part.select(F.col("value").alias("_value"), *payload, "n"), "_value", payload, "n", broadcast=small
        )
        made = make(c)
        extra += [n for n in made if n not in order]
        df = joined.select(
            *[made[x].alias(x) if x in made else F.col(x) for x in df.columns],
            *[e.alias(n) for n, e in made.items() if n not in df.columns],
        )
    return df


def fit_encode(df: DataFrame, method: str, target: str | None = None, exclude: Sequence[str] = (), **params) -> EncodeState:
    if method not in METHODS:
        raise ValueError(f"unknown encoding method: {method}")
    cols = categorical_columns(df, [target or "", *exclude])
    state = EncodeState(method, cols, dict(params))
    if method == "leaveoneout" and (target is None or target not in df.columns):
        raise ValueError("leave-one-out encoding needs a target column that is present")
    if not cols:
        return state
    if method == "onehot":
        return _fit_onehot(df, state)
    if method in ("label", "ordinal"):
        state.table = sorted_codes(category_counts(df, cols))
    elif method == "leaveoneout":
        _fit_leave_one_out(df, state, target)
    elif method == "lsa":
        state.table, state.output = text.fit_lsa(
            df, cols, int(params.get("n_components", 10)), int(tuple(params.get("ngram_range", (1, 1)))[1])
        )
    elif method in ("word2vec", "embedding"):
        state.table = _fit_word2vec(df, cols, int(params.get("embedding_dim", 50)), int(params.get("window", 1)))
    else:
        kind = "word2vec" if method == "row_word2vec" else "fasttext"
        state.table, state.output = text.fit_row_embedding(df, cols, kind, int(params.get("n_components", 100)))
    if state.table is not None and method not in ("lsa", "row_word2vec", "row_fasttext"):
        state.small = fits_broadcast(state.table)
    return state


def apply_encode(df: DataFrame, state: EncodeState) -> DataFrame:
    cols = [c for c in state.columns if c in df.columns]
    if not cols:
        return df
    if state.method == "onehot":
        return _apply_onehot(df, state)
    if state.method in ("label", "ordinal"):
        return per_column_lookup(
            df, cols, state.table, ["code"], lambda c: {c: F.coalesce(F.col("code"), F.lit(-1)).cast("int")},
            state.small,
        )
    if state.method == "leaveoneout":
        return per_column_lookup(
            df, cols, state.table, ["total"],
            lambda c: {c: F.coalesce(F.col("total.s") / F.col("total.n"), F.lit(state.prior))}, state.small,
        )
    if state.method == "lsa":
        return text.apply_lsa(df, cols, state.table, state.output, int(tuple(state.params.get("ngram_range", (1, 1)))[1]))
    if state.method in ("word2vec", "embedding"):
        if state.table is None:
            return df
        dim = int(state.params.get("embedding_dim", 50))
        out = per_column_lookup(
            df, cols, state.table, ["vector"],
            lambda c: {f"{c}_w2v_{i}": F.coalesce(F.col("vector")[i], F.lit(0.0)) for i in range(dim)}, state.small,
        )
        return out.select(*[c for c in out.columns if c not in cols])
    kind = "word2vec" if state.method == "row_word2vec" else "fasttext"
    return text.apply_row_embedding(df, cols, kind, state.table, state.output)


def _fit_onehot(df: DataFrame, state: EncodeState) -> EncodeState:
    """Columns far above the limit by estimate are left out before values are counted exactly."""
    limit = int(state.params.get("max_cardinality_threshold", 50))
    rough = df.agg(*[F.approx_count_distinct(as_category(c)).alias(f"_{i}") for i, c in enumerate(state.columns)]).first()
    maybe = [c for i, c in enumerate(state.columns) if rough[f"_{i}"] <= 10 * limit]
    found = category_counts(df, maybe).collect() if maybe else []
    widths: dict[str, int] = {}
    for r in found:
        widths[r["column"]] = widths.get(r["column"], 0) + 1
    narrow = [c for c in maybe if widths.get(c, 0) <= limit]
    state.unencoded = [c for c in state.columns if c not in narrow]
    for c in narrow:
        values = sorted((r["value"] for r in found if r["column"] == c), key=lambda v: v.encode())
        state.categories[c] = values[1:] if state.params.get("drop") == "first" else values
    return state


def _apply_onehot(df: DataFrame, state: EncodeState) -> DataFrame:
    """One projection; a value not seen in training is zero everywhere."""
    cells = [(c, v) for c, values in state.categories.items() for v in values]
    names = safe_names([f"{c}_{v}" for c, v in cells])
    made = [F.when(as_category(c) == F.lit(v), 1.0).otherwise(0.0).alias(names[f"{c}_{v}"]) for c, v in cells]
    return df.select(*[c for c in df.columns if c not in state.categories], *made)


def target_number(df: DataFrame, target: str) -> Column:
    """Numeric target as double; a text target by its sorted position."""
    if target in [f.name for f in df.schema if f.dataType.typeName() in ("string", "boolean")]:
        return label_encoded(target, fit_labels(df, target)).cast("double")
    return F.col(target).cast("double")


def _fit_leave_one_out(df: DataFrame, state: EncodeState, target: str) -> None:
    y = target_number(df, target)
    cells = F.explode(
        F.array(*[F.struct(F.lit(c).alias("column"), as_category(c).alias("value"), y.alias("y")) for c in state.columns])
    )
    sums = (
        df.select(cells.alias("r")).select("r.*").groupBy("column", "value")
        .agg(F.count("*").alias("n"), F.sum("y").alias("s"))
    )
    state.table = keep_small(sums.select("column", "value", "n", F.struct("s", "n").alias("total")))
    state.prior = df.agg(F.avg(y).alias("m")).first()["m"]


def leave_one_out_train(
    df: DataFrame, state: EncodeState, target: str, keys: Sequence[str] = (), sigma: float = 0.05, seed: int = 42
) -> DataFrame:
    """Training form: each row's own target is left out; optional multiplicative noise."""
    y = target_number(df, target)
    work = df.withColumn("_own", y)

    def make(c: str) -> dict[str, Column]:
        rest = (F.col("total.s") - F.col("_own")) / (F.col("total.n") - 1)
        value = F.when(F.col("total.n") > 1, rest).otherwise(F.lit(state.prior))
        if sigma:
            value = value * (1.0 + sigma * normal(order_hash(seed, F.lit(c), *[F.col(k) for k in keys])))
        return {c: value}

    return per_column_lookup(work, state.columns, state.table, ["total"], make, state.small).drop("_own")


def _fit_word2vec(df: DataFrame, cols: Sequence[str], dim: int, window: int) -> DataFrame | None:
    """(column, value, vector, n): a category is a sentence of one word, which has no neighbours to learn from.

    Its vector is therefore the start vector: uniform numbers within half a unit, divided by the width, drawn by a seeded
    hash of column, value and position. ``window`` has no effect on one-word sentences.
    """
    if dim <= 0:
        return None
    draw = [(unit(order_hash(VECTOR_SEED, "column", "value", F.lit(i))) - 0.5) / float(dim) for i in range(dim)]
    return keep_small(category_counts(df, cols).select("column", "value", F.array(*draw).alias("vector"), "n"))
