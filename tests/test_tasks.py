"""Numbers of tasks where one task merges what the others send, or where every pass is a job."""

from __future__ import annotations

import numpy as np
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F
from pyspark.sql.classic.dataframe import DataFrame

from riskloom.functions.quantiles import exact_quantiles
from riskloom.operators import models


def test_one_task_merges_a_bounded_number_of_summaries(spark, monkeypatch):
    df = spark.range(0, 5_000, 1, 150).select((F.col("id") * 7 % 5_000).cast("double").alias("x"), (F.col("id") % 3).cast("double").alias("few"))
    agg, merged = DataFrame.agg, []

    def counted(self, *columns):
        if any("percentile" in str(c) for c in columns):
            merged.append(self.rdd.getNumPartitions())
        return agg(self, *columns)

    monkeypatch.setattr(DataFrame, "agg", counted)
    found = exact_quantiles(df, ["x", "few"], [0.25, 0.5], one_task_values=40)
    assert found == {"x": [1249.75, 2499.5], "few": [0.0, 1.0]}
    assert merged and max(merged) <= 64


def test_the_logistic_model_has_few_tasks(spark, monkeypatch):
    df = spark.range(0, 600, 1, 120).select(F.col("id"), (F.col("id") % 10 / 10.0).alias("x"), (F.col("id") % 10 > 6).cast("int").alias("y"))
    fit, tasks = LogisticRegression.fit, []

    def counted(self, data):
        tasks.append(data.rdd.getNumPartitions())
        return fit(self, data)

    monkeypatch.setattr(LogisticRegression, "fit", counted)
    many = models.fit_model(df, "logistic_regression", ["x"], "y", {"C": 1.0})
    one = models.fit_model(df.coalesce(1), "logistic_regression", ["x"], "y", {"C": 1.0})
    assert max(tasks) <= 48
    assert np.allclose(many.parts[0].coefficients.toArray(), one.parts[0].coefficients.toArray(), rtol=1e-4)
