"""Profiles: each is one aggregate over the table, reshaped to long form."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from riskloom.functions.columns import numeric_columns
from riskloom.functions.quantiles import medians


def _long(wide: DataFrame, names: list[str], fields: dict[str, dict[str, str]]) -> DataFrame:
    rows = [
        F.struct(F.lit(n).alias("column"), *[F.col(src).alias(dst) for dst, src in fields[n].items()]) for n in names
    ]
    return wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def missing_summary(df: DataFrame) -> DataFrame:
    """(column, nulls, total) for the columns that have any."""
    wide = df.agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(f"_{i}") for i, c in enumerate(df.columns)])
    long = _long(wide, df.columns, {c: {"nulls": f"_{i}"} for i, c in enumerate(df.columns)})
    total = Window.partitionBy(F.lit(1))
    return long.withColumn("total", F.sum("nulls").over(total)).filter("nulls > 0")


def numeric_stats(df: DataFrame, digits: int = 2) -> DataFrame:
    """mean, median, sample std, min, max per numeric column, rounded."""
    cols = numeric_columns(df)
    mid = medians(df, cols)
    aggs, fields = [], {}
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        parts = {
            "mean": F.avg(x), "median": F.lit(mid[c]).cast("double"), "std": F.stddev_samp(x), "min": F.min(x), "max": F.max(x),
        }
        fields[c] = {}
        for name, e in parts.items():
            if name == "median":
                e = F.first(e)
            aggs.append(F.round(e, digits).alias(f"{name}_{i}"))
            fields[c][name] = f"{name}_{i}"
    return _long(df.agg(*aggs), cols, fields)


def target_distribution(df: DataFrame, target: str) -> DataFrame:
    """Count and percent per target value, NULL included, most frequent first."""
    if target not in df.columns:
        raise ValueError(f"column {target!r} not found")
    counts = df.groupBy(F.col(target).alias("value")).agg(F.count("*").alias("n"))
    return counts.withColumn("percent", 100.0 * F.col("n") / F.lit(df.count())).orderBy(F.desc("n"), "value")


def target_correlations(df: DataFrame, target: str) -> DataFrame:
    """Pearson correlation of every numeric column with the target, descending."""
    cols = numeric_columns(df)
    y = F.col(target).cast("double")
    wide = df.agg(*[F.corr(F.col(c).cast("double"), y).alias(f"_{i}") for i, c in enumerate(cols)])
    long = _long(wide, cols, {c: {"correlation": f"_{i}"} for i, c in enumerate(cols)})
    return long.withColumnRenamed("column", "feature").orderBy(F.desc("correlation"), "feature")
