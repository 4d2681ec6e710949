"""Seeded, partition-independent randomness: every draw is a function of a row key."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def order_hash(seed: int | str, *keys: Column | str) -> Column:
    """128-bit hex text; sorting by it is a seeded shuffle."""
    parts = [F.col(k).cast("string") if isinstance(k, str) else k.cast("string") for k in keys]
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *parts))


def hash_long(h: Column, digits: int = 12) -> Column:
    return F.conv(F.substring(h, 1, digits), 16, 10).cast("bigint")


def unit(h: Column) -> Column:
    """Uniform number in [0, 1) from the leading 48 bits."""
    return hash_long(h).cast("double") / F.lit(float(1 << 48))


def pick(h: Column, n: Column) -> Column:
    """Uniform integer in [0, n)."""
    return F.pmod(hash_long(h), n)


def normal(h: Column) -> Column:
    """Standard normal from two disjoint 48-bit halves (Box-Muller)."""
    u = (hash_long(h).cast("double") + 1.0) / F.lit(float((1 << 48) + 1))
    v = F.conv(F.substring(h, 13, 12), 16, 10).cast("double") / F.lit(float(1 << 48))
    return F.sqrt(-2.0 * F.log(u)) * F.cos(2.0 * F.lit(3.141592653589793) * v)
