import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskloom.functions.hashing import order_hash, unit
from riskloom.functions.lookup import lookup
from riskloom.functions.quantiles import exact_quantiles, medians
from riskloom.functions.ranking import at_or_below, dense_index, hash_cutoffs, smallest_by_hash, value_buckets
from riskloom.functions.rowid import with_row_id


def test_median_of_even_count(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (10.0,), (None,)], "x double")
    assert medians(df, ["x"]) == {"x": 3.0}


def test_all_null_column_has_no_median(spark):
    assert medians(spark.createDataFrame([(None,)], "x double"), ["x"]) == {"x": None}


@pytest.mark.parametrize("shape", ["spread", "hot", "steep"])
def test_quantiles_by_bracketing_equal_numpy(spark, shape):
    rng = np.random.default_rng(3)
    x = {
        "spread": rng.normal(size=20_000),
        "hot": np.concatenate([np.full(8_000, 1.5), rng.normal(size=12_000)]),
        "steep": np.exp(rng.normal(0, 8, size=20_000)),
    }[shape]
    df = spark.createDataFrame(pd.DataFrame({"x": x})).repartition(7)
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]
    got = exact_quantiles(df, ["x"], probs, one_task_values=40)["x"]
    assert np.allclose(got, np.quantile(x, probs), rtol=1e-12)


def test_hash_cutoffs_take_exactly_k_per_group(spark):
    df = spark.range(9_000).withColumn("g", F.when(F.col("id") < 6_000, 0).otherwise(F.col("id") % 5))
    h = order_hash(7, "id")
    for k in (0, 1, 17, 1_500, 10**9):
        cuts, sizes = hash_cutoffs(df, h, lambda n: {g: k for g in n}, F.col("g"))
        got = {r["g"]: r["count"] for r in df.filter(at_or_below(h, cuts, F.col("g"))).groupBy("g").count().collect()}
        assert got == {g: min(k, n) for g, n in sizes.items() if k}


def test_dense_index_is_the_hash_order(spark):
    df = spark.range(3_000).withColumn("g", F.when(F.col("id") < 2_000, "hot").otherwise("cold"))
    got = dense_index(df, order_hash(1, "id"), ["g"], bucket_rows=50).withColumn("h", order_hash(1, "id")).toPandas()
    for _, part in got.groupby("g"):
        part = part.sort_values("h")
        assert list(part["_idx"]) == list(range(len(part)))


def test_smallest_by_hash_size_and_repeatability(spark):
    df = spark.range(50_000)
    a = {r["id"] for r in smallest_by_hash(df, ["id"], 300, 50_000, 5).collect()}
    b = {r["id"] for r in smallest_by_hash(df.repartition(13), ["id"], 300, 50_000, 5).collect()}
    assert len(a) == 300 and a == b


def test_value_buckets_keep_order(spark):
    df = spark.range(5_000).select((F.col("id") ** 3).cast("double").alias("x"))
    spans = value_buckets(df, "x", parts=9).groupBy("_bucket").agg(F.min("x").alias("lo"), F.max("x").alias("hi")).orderBy("_bucket").collect()
    assert len(spans) > 5
    assert all(a["hi"] < b["lo"] for a, b in zip(spans, spans[1:]))


def test_large_lookup_with_a_hot_key(spark):
    df = spark.range(6_000).withColumn("k", F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")))
    table = df.groupBy("k").agg(F.count("*").alias("n")).withColumn("v", F.col("k") * 10).filter("k % 7 <> 1")
    wide = lookup(df, table, "k", ["v"], "n", broadcast=False)
    near = lookup(df, table, "k", ["v"], "n", broadcast=True)
    a, b = wide.orderBy("id").select("id", "k", "v").collect(), near.orderBy("id").select("id", "k", "v").collect()
    assert a == b and len(a) == 6_000


def test_row_id_without_keys_is_unique_and_stable(spark):
    df = spark.range(900).select((F.col("id") % 2).alias("a"), F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("b"))
    one = sorted(r["_rid"] for r in with_row_id(df).collect())
    two = sorted(r["_rid"] for r in with_row_id(df.repartition(11)).collect())
    assert one == two and len(set(one)) == 900


def test_unit_is_in_range(spark):
    s = spark.range(2_000).select(unit(order_hash(1, "id")).alias("u")).agg(F.min("u"), F.max("u"), F.avg("u")).first()
    assert 0 <= s[0] and s[1] < 1 and abs(s[2] - 0.5) < 0.03
