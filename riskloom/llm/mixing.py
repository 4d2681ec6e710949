"""Mixing sources to target weights by iterative proportional fitting, in DataFrame functions only.

The tokens of every (source, language, topic) cell are raked in turn to the target share of each source, language and topic until
all three agree. A cell's factor is its raked share over its own; documents are then sampled by a seeded hash of their id
with probability proportional to the factor, so no document is needed twice. Either the largest probability is one, or a share of the
tokens to keep is given: then it sets the scale, and cells whose factor is too large for it are kept whole and reported as clipped.

Documents are read twice, once to sum cells (a partial sum, so a hot source is one row per task) and once to draw; neither
pass moves a text. The cells are as many as combinations of the three columns occur; they rake in one partition, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window, functions as F

from riskloom.llm.files import packed, stored

AXES = ("source", "lang", "topic")
#: A target share is the observed token share to this power, made to sum to one; 1 keeps the share, 0 makes all equal.
TEMPER: Mapping[str, float] = {"source": 0.5, "lang": 0.7, "topic": 1.0}
#: Share of the tokens that the query and the pipeline keep.
KEEP = 0.65
ROUNDS = 30
#: Rounds between two writings of the cells, which keeps the plan short.
ROUNDS_PER_JOB = 10
SEED = 17
DIGITS = 9
_WORDS = r"[^\x20\x09-\x0D]+"


def n_tokens(text: Column) -> Column:
    """Words of a text: runs without space and the controls 9 to 13."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(_WORDS)).cast("long")


def topic(text: Column) -> Column:
    """Kind of a text by its marks: table, symbols, shouting, licence or prose; the first that fits."""
    value = F.coalesce(text, F.lit(""))
    length = F.length(value)

    def marks(chars: str) -> Column:
        return sum((length - F.length(F.replace(value, F.lit(c))) for c in chars), F.lit(0))

    return (
        F.when(marks("|") * 50 > length, "table")
        .when(marks("#*$%&") * 20 > length, "symbols")
        .when((value != F.lower(value)) & (value == F.upper(value)), "shouting")
        .when(F.instr(value, "License") > 0, "licence")
        .otherwise("prose")
    )


def unit(seed: int, key: Column) -> Column:
    """Uniform number in [0, 1) from the leading 48 bits of an MD5 of seed and key."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), key.cast("string")))
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("bigint").cast("double") / F.lit(float(1 << 48))


def targets(cells: DataFrame, temper: Mapping[str, float]) -> DataFrame:
    """``cells`` with one target share per axis: the observed share, tempered."""
    out = cells
    for axis in AXES:
        own = F.sum("tokens").over(Window.partitionBy(axis))
        parts = out.withColumn("_power", F.pow(own / F.sum("tokens").over(Window.partitionBy()), F.lit(float(temper[axis]))))
        # Each value of the axis counts once in the total: its power is spread over its cells.
        spread = F.col("_power") * F.col("tokens") / own
        out = parts.withColumn(f"{axis}_target", F.col("_power") / F.sum(spread).over(Window.partitionBy())).drop("_power")
    return out


def rake(cells: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """``cells`` (the axes, ``tokens`` > 0 and a ``<axis>_target`` each) with the raked ``weight``, all weights summing to one."""
    now = cells.coalesce(1).withColumn("weight", F.col("tokens") / F.sum("tokens").over(Window.partitionBy()))
    for k in range(rounds):
        for axis in AXES:
            now = now.withColumn("weight", F.col("weight") * F.col(f"{axis}_target") / F.sum("weight").over(Window.partitionBy(axis)))
        if (k + 1) % ROUNDS_PER_JOB == 0 and k + 1 < rounds:
            now = stored(now, "cells").coalesce(1)
    return now


def scaled(cells: DataFrame, keep: float | None) -> DataFrame:
    """``cells`` (``tokens`` and raked ``weight``) with the ``chance`` of each and whether it is ``clipped``.

    With ``keep`` the chances are min(1, scale * factor) with the scale at which they keep that share of all tokens on average; a rare
    cell of a large factor is clipped at one and hardly moves the others. Without, the largest factor of all cells gets one and none is clipped.
    """
    every = Window.partitionBy()
    out = cells.withColumn("_factor", F.col("weight") / F.col("tokens"))
    if keep is None:
        return out.withColumn("chance", F.col("_factor") / F.max("_factor").over(every)).withColumn("clipped", F.lit(False)).drop("_factor")
    # Tokens kept at the scale that just brings a cell to one: those of cells with factors as large, and of the others in proportion.
    above = Window.partitionBy().orderBy(F.desc("_factor")).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    below = F.sum("weight").over(every) - F.sum("weight").over(above)
    budget = F.lit(float(keep)) * F.sum("tokens").over(every)
    out = out.withColumn("clipped", F.sum("tokens").over(above) + below / F.col("_factor") <= budget)
    rest = budget - F.sum(F.when(F.col("clipped"), F.col("tokens")).otherwise(0)).over(every)
    scale = rest / F.sum(F.when(~F.col("clipped"), F.col("weight"))).over(every)
    chance = F.when(F.col("clipped"), F.lit(1.0)).otherwise(F.least(F.lit(1.0), scale * F.col("_factor")))
    return out.withColumn("chance", chance).drop("_factor")


def mix_sources(
    docs: DataFrame, temper: Mapping[str, float] = TEMPER, rounds: int = ROUNDS, seed: int = SEED, doc_id: str = "doc_id", text: str = "text",
    source: str = "source", lang: str = "lang", keep: float | None = None,
) -> DataFrame:
    """``docs`` with ``_topic``, ``_tokens``, ``_weight`` (raked share of the cell), ``_chance``, ``_clipped`` and ``_sampled``.

    ``keep`` is the share of all tokens to keep on average (see :func:`scaled`); without it the cell of the largest factor is kept whole.

    A null source or language is a value of its own, written as the empty string in the cells. A text without words has no tokens and no
    cell: its chance is zero. Rows with equal ids are drawn alike; rows with a null id are drawn by their text. Chances are rounded to
    ``DIGITS`` decimals. All columns stay, whatever their names; an empty table gives an empty result.
    """
    value = docs[f"`{text}`"].cast("string")
    key = F.coalesce(docs[f"`{doc_id}`"].cast("string"), F.md5(F.coalesce(value, F.lit(""))))
    names, row = packed(docs, "_topic", "_tokens", "_weight", "_chance", "_clipped", "_sampled")
    rows = docs.select(
        row.alias("_row"), topic(value).alias("topic"), n_tokens(value).alias("tokens"),
        *[F.coalesce(docs[f"`{c}`"].cast("string"), F.lit("")).alias(a) for c, a in ((source, "source"), (lang, "lang"))], unit(seed, key).alias("_unit"),
    )
    cells = rows.where("tokens > 0").groupBy(*AXES).agg(F.sum("tokens").alias("tokens"))
    raked = scaled(rake(targets(stored(cells, "cells").coalesce(1), temper), rounds), keep)
    table = stored(raked.select(*AXES, F.round("weight", DIGITS).alias("_weight"), F.round("chance", DIGITS).alias("_chance"), F.col("clipped").alias("_clipped")), "chances")
    few = F.broadcast(table) if table.count() <= 100_000 else table
    out = rows.join(few, list(AXES), "left").withColumn("_chance", F.when(F.col("tokens") > 0, F.col("_chance")).otherwise(F.lit(0.0)))
    return out.select(
        *[F.col("_row").getField(c).alias(c) for c in names], F.col("topic").alias("_topic"), F.col("tokens").alias("_tokens"),
        F.when(F.col("tokens") > 0, F.col("_weight")).otherwise(F.lit(0.0)).alias("_weight"), "_chance",
        F.coalesce("_clipped", F.lit(False)).alias("_clipped"), (F.col("_unit") < F.col("_chance")).alias("_sampled"),
    )
