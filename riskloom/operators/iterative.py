"""Round-robin imputation with random forests over the null-bearing numeric columns.

Equal rows move alike, so fitting and filling work on distinct rows with a number of copies; only rows with holes are ever predicted.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from riskloom.functions.columns import replace_columns
from riskloom.functions.lookup import lookup
from riskloom.operators import encode, trees
from riskloom.session import hold, settle

#: Bytes of all forests of one fit that the driver may hold; larger ones stay in the shared folder.
DRIVER_BYTES = 256 << 20
_SPREAD = 4_096


@dataclass
class ForestState:
    columns: list[str]
    means: dict[str, float]
    #: One list of (column, forest) per round, in the order in which they were fitted.
    forests: list[list[tuple[str, trees.Forest]]] = field(default_factory=list)
    #: Key and values of the training rows with holes, as the last round left them: what the forests give for them again.
    filled: DataFrame | None = None

    @property
    def rounds(self) -> int:
        return len(self.forests)


def _values(columns: Sequence[str]) -> list[Column]:
    return [F.col(f"`{c}`").cast("double").alias(f"c{i}") for i, c in enumerate(columns)]


def _start(rows: DataFrame, means: Sequence[float]) -> DataFrame:
    """Distinct rows (c0, c1, ..., n): a key, a hash, mean-filled cells and a flag per cell that was missing."""
    cells = [f"c{i}" for i in range(len(means))]
    return rows.select(
        F.to_json(F.struct(*cells), {"ignoreNullFields": "false"}).alias("key"), F.xxhash64(*cells).alias("h"), "n",
        *[F.coalesce(c, F.lit(m)).alias(c) for c, m in zip(cells, means, strict=True)],
        *[F.col(c).isNull().alias(f"o{i}") for i, c in enumerate(cells)],
    )


def _filled_by(holes: DataFrame, cells: Sequence[str], i: int, forest: trees.Forest) -> DataFrame:
    others = [c for k, c in enumerate(cells) if k != i]
    out = trees.predict(holes, forest, others, "_guess", F.col(f"o{i}"))
    return out.withColumn(cells[i], F.coalesce("_guess", cells[i])).drop("_guess")


def fit_forests(
    df: DataFrame,
    columns: Sequence[str],
    n_estimators: int = 10,
    max_iter: int = 10,
    max_features: str | float | None = None,
    min_samples_leaf: int = 1,
    min_samples_split: int = 2,
    max_depth: int | None = None,
    tol: float = 1e-3,
    seed: int = 42,
    bootstrap: bool = True,
    wanted: Sequence[str] | None = None,
) -> ForestState:
    """Rounds over the columns, fewest gaps first, until the largest change is below
    tol times the largest known absolute value or max_iter rounds are done.

    Only the null-bearing columns are read, once, as distinct rows. Every step ends in a checkpoint of the rows with holes, so plans stay short. The forests of all rounds are kept: applied in
    order they give the training rows exactly the table on which the fit ended. ``max_depth`` None grows trees until they are pure;
    without ``bootstrap`` every tree takes all rows.
    ``wanted`` names the columns that need forests, where others have no hole anywhere.
    """
    columns = list(columns)
    count = int(n_estimators) if n_estimators and n_estimators > 0 else 10
    cells = [f"c{i}" for i in range(len(columns))]
    distinct = settle(df.select(*_values(columns)).groupBy(*cells).agg(F.count("*").alias("n")))
    row = distinct.agg(
        *[(F.sum(F.col(c) * F.col("n")) / F.sum(F.when(F.col(c).isNotNull(), F.col("n")))).alias(f"m{i}") for i, c in enumerate(cells)],
        *[F.sum(F.when(F.col(c).isNull(), F.col("n"))).alias(f"h{i}") for i, c in enumerate(cells)],
        *[F.max(F.abs(c)).alias(f"a{i}") for i, c in enumerate(cells)],
        *[F.count(c).alias(f"k{i}") for i, c in enumerate(cells)],
    ).first()
    means = [float(row[f"m{i}"] if row[f"m{i}"] is not None else 0.0) for i in range(len(columns))]
    state = ForestState(columns, dict(zip(columns, means, strict=True)))
    if len(columns) < 2:
        return state
    biggest = max(row[f"a{i}"] or 0.0 for i in range(len(columns)))
    order = sorted(range(len(columns)), key=lambda i: row[f"h{i}"] or 0)
    order = [i for i in order if row[f"k{i}"] and (wanted is None or columns[i] in wanted)]
    rules = trees.Rules(
        max_depth=None if max_depth is None else int(max_depth), min_split=int(min_samples_split), min_leaf=int(min_samples_leaf),
        tried=trees.tried_of(max_features, len(columns) - 1), bootstrap=bootstrap, seed=seed)
    share = DRIVER_BYTES // max(1, int(max_iter) * len(order))
    start = hold(_start(distinct, means))
    hole = F.exists(F.array(*[f"o{i}" for i in range(len(columns))]), lambda x: x)
    complete, holes = hold(start.filter(~hole)), settle(start.filter(hole))
    for _ in range(int(max_iter)):
        done: list[tuple[str, trees.Forest]] = []
        state.forests.append(done)
        current = holes.withColumns({f"b{i}": F.col(c) for i, c in enumerate(cells)})
        for i in order:
            x = F.array(*[c for k, c in enumerate(cells) if k != i]).alias("x")
            part = ["h", F.col("n").alias("m"), x, F.col(cells[i]).alias("y")]
            known = complete.select(*part).unionByName(current.filter(~F.col(f"o{i}")).select(*part))
            forest = trees.fit_forest(known, len(columns) - 1, rules, count, model_bytes=min(share, trees.MODEL_BYTES), count=row[f"k{i}"])
            done.append((columns[i], forest))
            current = settle(_filled_by(current, cells, i, forest))
        shift = current.agg(F.max(F.greatest(*[F.abs(F.col(c) - F.col(f"b{i}")) for i, c in enumerate(cells)])).alias("s")).first()["s"]
        holes = current.select(*holes.columns)
        if shift is None or shift < tol * biggest:
            break
    complete.unpersist()
    start.unpersist()
    state.filled = holes.select("key", *cells)
    return state


def _replayed(rows: DataFrame, state: ForestState) -> DataFrame:
    """(key, c0, c1, ...) of distinct rows with holes: mean start, then the forests of every round in the order in which they were fitted."""
    cells = [f"c{i}" for i in range(len(state.columns))]
    out = settle(_start(rows, [state.means[c] for c in state.columns]))
    for done in state.forests:
        for c, forest in done:
            out = settle(_filled_by(out, cells, state.columns.index(c), forest))
    return out.select("key", *cells)


def apply_forests(df: DataFrame, state: ForestState) -> DataFrame:
    """Fills for the distinct rows with holes, looked up by the rows. Rows that were there in training are not computed again."""
    columns = [c for c in state.columns if c in df.columns]
    if len(columns) < len(state.columns) or len(columns) < 2:
        return replace_columns(df, {c: F.coalesce(F.col(c).cast("double"), F.lit(state.means[c])) for c in columns})
    cells = [f"c{i}" for i in range(len(columns))]
    rows = df.select(*_values(columns)).filter(F.greatest(*[F.col(c).isNull() for c in cells]))
    asked = settle(rows.groupBy(*cells).agg(F.count("*").alias("n")).withColumn("key", F.to_json(F.struct(*cells), {"ignoreNullFields": "false"})))
    if state.filled is None:
        found = _replayed(asked, state)
    else:
        new = settle(asked.join(state.filled.select("key"), "key", "left_anti"))
        found = state.filled if new.isEmpty() else state.filled.unionByName(_replayed(new, state))
    fills = asked.select("key", "n").join(found, "key").select(F.col("key").alias("_key"), *[F.col(c).alias(f"_{c}") for c in cells], "n")
    key = F.to_json(F.struct(*_values(columns)), {"ignoreNullFields": "false"})
    missing = F.greatest(*[F.col(f"`{c}`").cast("double").isNull() for c in columns])
    # Rows without holes look up nothing; their keys are spread so that they do not meet in one task.
    spread = F.concat(F.lit("#"), F.pmod(F.xxhash64(*[f"`{c}`" for c in columns]), F.lit(_SPREAD)).cast("string"))
    joined = lookup(df.withColumn("_key", F.when(missing, key).otherwise(spread)), fills, "_key", [f"_{c}" for c in cells], "n")
    return joined.select(*[
        F.coalesce(F.col(f"`{c}`").cast("double"), F.col(f"_c{columns.index(c)}"), F.lit(state.means[c])).alias(c) if c in columns else F.col(f"`{c}`") for c in df.columns])


def impute_mixed(train: DataFrame, df: DataFrame, text_columns: Sequence[str], numeric: Sequence[str], **params) -> DataFrame:
    """Text columns take part as sorted label codes, rounded and clipped back to labels. A label that training lacks stays as it is.

    Codes are a table that is looked up both ways, however many labels there are.
    """
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value")) for c in text_columns]))
    counts = train.select(cells.alias("r")).select("r.*").filter("value IS NOT NULL").groupBy("column", "value").agg(F.count("*").alias("n"))
    codes = encode.sorted_codes(counts)
    top = {r["column"]: r["top"] for r in codes.groupBy("column").agg(F.max("code").alias("top")).collect()}
    text = [c for c in text_columns if c in top]

    def part(c: str) -> DataFrame:
        return codes.filter(F.col("column") == c).select(F.col("value").alias("_value"), F.col("code").alias("_code"), "n")

    def coded(t: DataFrame) -> DataFrame:
        for c in text:
            spread = F.concat(F.lit("\0"), F.pmod(F.xxhash64(*t.columns), F.lit(_SPREAD)).cast("string"))
            found = lookup(t.withColumn("_value", F.coalesce(F.col(c).cast("string"), spread)), part(c), "_value", ["_code"], "n")
            t = found.withColumn(f"_text_{c}", F.col(c)).withColumn(c, F.col("_code").cast("double")).drop("_value", "_code")
        return t

    columns = [*numeric, *text]
    learned = coded(train)
    asked = learned if df is train else coded(df)
    gaps = [t.agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in columns]).first() for t in ([learned] if df is train else [learned, asked])]
    state = fit_forests(learned, columns, wanted=[c for c in columns if any(g[c] for g in gaps)], **params)
    out = apply_forests(asked, state)
    for c in text:
        code = F.least(F.greatest(F.rint(F.col(c)), F.lit(0.0)), F.lit(float(top[c]))).cast("int")
        spread = (-1 - F.pmod(F.xxhash64(*out.columns), F.lit(_SPREAD))).cast("int")
        table = part(c).select("_code", "_value", "n")
        found = lookup(out.withColumn("_code", F.when(F.col(f"_text_{c}").isNull(), code).otherwise(spread)), table, "_code", ["_value"], "n")
        out = found.withColumn(c, F.coalesce(F.col(f"_text_{c}"), F.col("_value"))).drop("_code", "_value", f"_text_{c}")
    return out.select(*df.columns)
