from __future__ import annotations

from pyspark.sql import functions as F

from clientela.functions import ranking as rk


def test_dense_index(spark):
    df = spark.createDataFrame([(x,) for x in ("b", "a", "d", "c", "B")], "k string")
    got = {r.k: r.i for r in rk.dense_index(df, "k", name="i").collect()}
    assert got == {"B": 0, "a": 1, "b": 2, "c": 3, "d": 4}


def test_samples_are_exact_and_stable(spark):
    df = spark.range(1000).select(F.col("id").cast("string").alias("id"))
    first = {r.id for r in rk.sample_rows(df.repartition(3), "id", 137, 5).collect()}
    again = {r.id for r in rk.sample_rows(df.repartition(8), "id", 137, 5).collect()}
    assert len(first) == 137 and first == again
    assert rk.sample_rows(df, "id", 5000, 5).count() == 1000
    assert rk.sample_share(df, "id", 0.25, 5).count() == 250


def test_samples_do_not_sort(spark):
    df = spark.range(1000).select(F.col("id").cast("string").alias("id"))
    for sample in (rk.sample_rows(df, "id", 137, 5), rk.sample_share(df, "id", 0.25, 5)):
        plan = sample._jdf.queryExecution().executedPlan().toString()
        assert "Sort" not in plan and "Exchange" not in plan
