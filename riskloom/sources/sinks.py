"""Writing results: processed splits, predictions, run reports."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

METRIC_SCHEMA = "run_id string, scope string, class string, metric string, value double"


def run_id(methods: dict[str, str]) -> str:
    """Joined stage methods; the scaling part only when a scaler is used."""
    parts = [methods["imputation"], methods["outlier"], methods["encoding"], methods["resampling"]]
    if methods.get("scaling", "none") != "none":
        parts.append(methods["scaling"])
    return "_".join(parts)


def dataset_name(path: str) -> str:
    """Folder above a train/test file, else the file stem."""
    parts = path.rstrip("/").split("/")
    stem = parts[-1].split(".")[0]
    if stem in ("train", "test") and len(parts) > 1:
        return parts[-2]
    return stem


def write_processed(train: DataFrame, test: DataFrame, root: str, dataset: str, run: str, fmt: str = "parquet") -> str:
    path = f"{root.rstrip('/')}/{dataset}/{run}"
    for name, df in (("train", train), ("test", test)):
        writer = df.write.mode("overwrite")
        if fmt == "csv":
            writer.option("header", True).csv(f"{path}/{name}")
        else:
            writer.parquet(f"{path}/{name}")
    return path


def write_predictions(scored: DataFrame, path: str, fmt: str = "csv") -> str:
    flat = scored.select(
        *[F.to_json(f.name).alias(f.name) if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)) else F.col(f.name)
          for f in scored.schema]
    ) if fmt == "csv" else scored
    writer = flat.write.mode("overwrite")
    if fmt == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.parquet(path)
    return path


def metric_rows(spark: SparkSession, run: str, metrics: dict, report: list[tuple], curve: DataFrame | None = None) -> DataFrame:
    """Long form of one run's metrics: a few rows per class, and per point of its learning curve, which is named by the first column."""
    rows = [(run, "overall", None, k, None if v is None else float(v)) for k, v in metrics.items()]
    rows += [(run, "report", c, m, None if v is None else float(v)) for c, m, v in report]
    for r in curve.collect() if curve is not None else ():
        rows += [(run, "learning_curve", str(r[0]), m, None if v is None else float(v)) for m, v in zip(curve.columns[1:], r[1:], strict=True)]
    return spark.createDataFrame(rows, METRIC_SCHEMA)


def write_report(metrics: DataFrame, importance: DataFrame | None, params: dict, path: str) -> str:
    """Metrics as JSON by run, importances as CSV, parameters as one JSON row."""
    spark = metrics.sparkSession
    metrics.write.mode("overwrite").partitionBy("run_id").json(f"{path}/metrics")
    if importance is not None:
        importance.write.mode("overwrite").option("header", True).csv(f"{path}/feature_importance")
    spark.createDataFrame([(json.dumps(params, default=str),)], "params string").write.mode("overwrite").text(f"{path}/params")
    return path
