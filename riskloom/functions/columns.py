"""Column roles and missing-value normalisation, from the schema alone."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F, types as T


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    skip = set(exclude)
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in skip]


def categorical_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    skip = set(exclude)
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType) and f.name not in skip]


def non_numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    skip = set(exclude)
    return [f.name for f in df.schema if not isinstance(f.dataType, T.NumericType) and f.name not in skip]


def reject_nested(df: DataFrame) -> None:
    nested = [f.name for f in df.schema if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType, T.BinaryType))]
    if nested:
        raise TypeError(f"nested columns are not supported here: {nested}")


def nan_to_null(df: DataFrame, zero_as_null: Iterable[str] = ()) -> DataFrame:
    """One missing marker: NaN becomes NULL, and zeros of the named columns too."""
    zeros = set(zero_as_null)
    out = []
    for field in df.schema:
        c = F.col(field.name)
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            c = F.when(~F.isnan(c), c)
        if field.name in zeros:
            c = F.when(c != 0, c)
        out.append(c.alias(field.name))
    return df.select(*out)


def as_double(name: str) -> Column:
    return F.col(name).cast("double")


def as_category(name: str) -> Column:
    """Category text of a column; NULL is a category of its own, spelled nan."""
    return F.coalesce(F.col(name).cast("string"), F.lit("nan"))


def replace_columns(df: DataFrame, new: dict[str, Column]) -> DataFrame:
    """One projection that swaps the named columns in place."""
    return df.select(*[new[c].alias(c) if c in new else F.col(c) for c in df.columns])
