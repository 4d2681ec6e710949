"""Reading input tables: CSV with inferred types, parquet, and train/test pairs."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from riskloom.functions.columns import nan_to_null

# Cell texts that count as missing.
MISSING_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

_WHOLE = r"^\s*[+-]?\d{1,18}\s*$"
_REAL = r"^\s*[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?\s*$|^\s*[+-]?(inf|Inf|Infinity)\s*$"
_TRUTH = r"^(True|False|TRUE|FALSE|true|false)$"


def safe_names(columns: list[str]) -> dict[str, str]:
    """Original name -> name usable without quoting; stays unique."""
    out: dict[str, str] = {}
    for name in columns:
        safe = re.sub(r"[.`]", "_", name)
        while safe in out.values():
            safe += "_"
        out[name] = safe
    return out


def with_safe_names(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """The table under safe names, and safe name -> original name where they differ."""
    names = safe_names(df.columns) if len(set(df.columns)) == len(df.columns) else {c: c for c in df.columns}
    changed = {safe: name for name, safe in names.items() if safe != name}
    return (df.toDF(*[names[c] for c in df.columns]) if changed else df), changed


def _wider(a: T.DataType, b: T.DataType) -> T.DataType:
    """A type that holds the cells of both: long and double give double, anything else that differs gives text."""
    if a == b:
        return a
    numbers = (T.LongType, T.DoubleType)
    return T.DoubleType() if isinstance(a, numbers) and isinstance(b, numbers) else T.StringType()


def joint_schema(a: T.StructType, b: T.StructType) -> T.StructType:
    other = {f.name: f.dataType for f in b}
    return T.StructType([T.StructField(f.name, _wider(f.dataType, other.get(f.name, f.dataType))) for f in a])


def _csv_cells(spark: SparkSession, path: str, multi_line: bool) -> DataFrame:
    """Every cell as text under safe names, missing tokens as NULL."""
    raw = spark.read.option("header", True).option("multiLine", multi_line).option("escape", '"').csv(path)
    raw = raw.toDF(*safe_names(raw.columns).values())
    return raw.select(*[F.when(~F.col(c).isin(MISSING_TOKENS), F.col(c)).alias(c) for c in raw.columns])


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None, multi_line: bool = False) -> DataFrame:
    """CSV with a header. Types are inferred in one pass unless a schema is given.

    ``multi_line`` allows line breaks inside quotes, at the price of one task per file.
    """
    clean = _csv_cells(spark, path, multi_line)
    if schema is None:
        schema = infer_schema(clean)
    by_name = {f.name: f.dataType for f in schema}
    return clean.select(*[_parse(c, by_name.get(c, T.StringType())).alias(c) for c in clean.columns])


def infer_schema(text: DataFrame) -> T.StructType:
    """Narrowest type that every present cell of a text column parses as."""
    aggs = []
    for i, c in enumerate(text.columns):
        aggs.append(F.count(c).alias(f"n{i}"))
        for tag, pattern in (("w", _WHOLE), ("r", _REAL), ("t", _TRUTH)):
            aggs.append(F.count(F.when(F.col(c).rlike(pattern), 1)).alias(f"{tag}{i}"))
    row = text.agg(*aggs).first()
    fields = []
    for i, c in enumerate(text.columns):
        n = row[f"n{i}"]
        if row[f"w{i}"] == n and n:
            kind: T.DataType = T.LongType()
        elif row[f"r{i}"] == n:
            kind = T.DoubleType()
        elif row[f"t{i}"] == n:
            kind = T.BooleanType()
        else:
            kind = T.StringType()
        fields.append(T.StructField(c, kind))
    return T.StructType(fields)


def _parse(name: str, kind: T.DataType) -> Column:
    if isinstance(kind, T.StringType):
        return F.col(name)
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        text = F.regexp_replace(F.trim(F.col(name)), r"^([+-]?)(inf|Inf)$", "$1Infinity")
        return text.try_cast(kind)
    return F.trim(F.col(name)).try_cast(kind)


def read_table(
    spark: SparkSession, path: str, schema: T.StructType | None = None, zero_as_null=(), multi_line: bool = False
) -> DataFrame:
    """A table by file type; NaN is NULL from here on."""
    if not path:
        raise ValueError("no data path given")
    if path.rstrip("/").endswith((".csv", ".csv.gz")):
        df = read_csv(spark, path, schema, multi_line)
    else:
        df = spark.read.parquet(path)
        df = df.toDF(*safe_names(df.columns).values())
    return nan_to_null(df, zero_as_null)


def read_pair(spark: SparkSession, train_path: str, test_path: str) -> DataFrame:
    """Explicit train and test files as one table with a _split column.

    Two CSV files are parsed with types that hold the cells of both, so no cell is lost; a column that
    only one of them has is NULL in the other.
    """
    endings = (".csv", ".csv.gz")
    if train_path.rstrip("/").endswith(endings) and test_path.rstrip("/").endswith(endings):
        one, two = (infer_schema(_csv_cells(spark, p, False)) for p in (train_path, test_path))
        train, test = read_table(spark, train_path, joint_schema(one, two)), read_table(spark, test_path, joint_schema(two, one))
    else:
        train, test = read_table(spark, train_path), read_table(spark, test_path)
    return train.withColumn("_split", F.lit("train")).unionByName(
        test.withColumn("_split", F.lit("test")), allowMissingColumns=True
    )
