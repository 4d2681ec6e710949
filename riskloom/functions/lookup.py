"""Left lookup of a fitted table: broadcast behind a size check, skew-safe shuffle beyond it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from riskloom import limits

_HOT_ROWS = 1_000
_SALTS = 4_096


def fits_broadcast(table: DataFrame, rows: int = limits.BROADCAST_ROWS, size: int = limits.BROADCAST_BYTES) -> bool:
    """True when the table is within the row and byte bounds (text form of its rows)."""
    stat = table.agg(
        F.count("*").alias("n"),
        F.sum(F.length(F.to_json(F.struct(*table.columns)))).alias("b"),
    ).first()
    return stat["n"] <= rows and (stat["b"] or 0) <= size


def lookup(
    df: DataFrame,
    table: DataFrame,
    on: str,
    payload: Sequence[str],
    weight: str | None = None,
    broadcast: bool | None = None,
) -> DataFrame:
    """``df`` left join ``table`` on one key column that is unique in ``table``.

    When the table is too large to broadcast, its heaviest keys (by ``weight``,
    the row count seen when fitting) are broadcast alone and the rows they match
    are spread by a salt, so that no task receives a whole hot key.
    """
    table = table.select(on, *payload, *([weight] if weight else []))
    if broadcast is None:
        broadcast = fits_broadcast(table)
    if broadcast:
        return df.join(F.broadcast(table.select(on, *payload)), on, "left")
    if weight is None:
        return df.join(table, on, "left")
    hot = table.orderBy(F.desc(weight), on).limit(_HOT_ROWS)
    hot = hot.select(on, F.struct(*payload).alias("_hot"))
    spread = F.pmod(F.xxhash64(*[c for c in df.columns]), F.lit(_SALTS))
    left = df.join(F.broadcast(hot), on, "left").withColumn(
        "_salt", F.when(F.col("_hot").isNotNull(), spread + 1).otherwise(F.lit(0))
    )
    cold = table.select(on, F.struct(*payload).alias("_cold"), F.lit(0).cast("bigint").alias("_salt"))
    joined = left.withColumn("_salt", F.col("_salt").cast("bigint")).join(cold, [on, "_salt"], "left")
    return joined.select(
        *df.columns, *[F.coalesce(F.col(f"_hot.{p}"), F.col(f"_cold.{p}")).alias(p) for p in payload]
    )
