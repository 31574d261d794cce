"""The lines and customers that a task holds do not grow with the table."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from clientela.functions.storage import broadcast_bytes, session_tasks, tasks_of
from clientela.operators import cohorts as co
from clientela.operators import features as fe
from clientela.operators import lines as li
from clientela.operators import measures as m
from clientela.sources import tpch
from clientela.sources.tpch import TPCH_RUN, tpch_sources


def test_tasks_by_rows(spark):
    own = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert tasks_of(spark, own * 10, 10) is None
    assert tasks_of(spark, own * 10 + 1, 10) == own + 1


@pytest.fixture
def setting(spark):
    """Sets settings of the session and puts them back."""
    own = {}

    def change(name: str, value: object) -> None:
        own.setdefault(name, spark.conf.get(name, None))
        spark.conf.set(name, str(value))

    yield change
    for name, value in own.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_merged_partitions_are_no_tasks(spark, setting):
    cores = spark.sparkContext.defaultParallelism
    merging = "spark.sql.adaptive.coalescePartitions"
    setting("spark.sql.shuffle.partitions", 40)
    assert session_tasks(spark) == cores < 23
    assert tasks_of(spark, cores * 10, 10) is None and tasks_of(spark, 230, 10) == 23
    setting(f"{merging}.minPartitionNum", 30)
    assert session_tasks(spark) == 30
    spark.conf.unset(f"{merging}.minPartitionNum")
    setting(f"{merging}.parallelismFirst", "false")
    assert session_tasks(spark) == 1
    for switch in (f"{merging}.enabled", "spark.sql.adaptive.enabled"):
        setting(switch, "false")
        assert session_tasks(spark) == 40 and tasks_of(spark, 230, 10) is None
        setting(switch, "true")


def test_lines_are_not_merged_into_few_tasks(spark, tmp_path, monkeypatch, setting):
    """With more shuffle partitions than lines ask for, adaptive execution does not merge theirs."""
    setting("spark.sql.shuffle.partitions", 40)
    folder = _write(spark, tmp_path, 300, 4)
    few = tpch.sales(spark, folder)
    rows = sorted(map(str, few.collect()))
    monkeypatch.setattr(tpch, "LINES_PER_TASK", 60)
    many = tpch.sales(spark, folder)
    assert sorted(map(str, many.collect())) == rows and len(rows) == 1200
    assert _parts(few) <= 4 < 15 < _parts(many) <= 20


def test_more_lines_more_tasks(spark, testdata, monkeypatch):
    """With few lines for a task, the same features come from more tasks than the session has."""
    src = tpch_sources(spark, testdata)
    customers = co.feature_customers_of_flags(co.customer_flags(src, TPCH_RUN), src, TPCH_RUN)

    def told() -> tuple[list, int]:
        found = fe.features(src, TPCH_RUN, customers, ["from_totals", "top_share"])
        rows = found.withColumn("part", F.spark_partition_id()).collect()
        return sorted(tuple(r)[:3] for r in rows), len({r.part for r in rows})

    before, few = told()
    lines = src.counted.count()
    monkeypatch.setattr(fe, "LINES_PER_TASK", -(-lines // 23))
    after, many = told()
    assert before == after and len(before) > 0
    assert few <= int(spark.conf.get("spark.sql.shuffle.partitions")) < 15 < many <= 23


def _write(spark, folder, orders: int, lines: int) -> str:
    """Orders of 7 customers, of whom one has half of all, with some lines each."""
    number = F.col("id")
    customer = F.when(number % 2 == 0, 0).otherwise(number % 7)
    spark.range(orders).select(
        number.alias("o_orderkey"),
        customer.cast("long").alias("o_custkey"),
        F.lit("O").alias("o_orderstatus"),
        F.lit(1.0).alias("o_totalprice"),
        F.lit("2000-06-01").cast("timestamp").alias("o_orderdate"),
        F.lit("1-URGENT").alias("o_orderpriority"),
    ).write.parquet(f"{folder}/orders.parquet")
    spark.range(orders * lines).select(
        (number % orders).alias("l_orderkey"),
        (number % 5 + 1).alias("l_partkey"),
        F.lit(1).cast("long").alias("l_suppkey"),
        (number % 3 + 1).cast("double").alias("l_quantity"),
        (number % 11 + 1).cast("double").alias("l_extendedprice"),
        F.lit(0.0).alias("l_discount"),
    ).write.parquet(f"{folder}/lineitem.parquet")
    return str(folder)


def _parts(df) -> int:
    return len(df.select(F.spark_partition_id().alias("part")).distinct().collect())


def test_lines_meet_orders_in_more_tasks(spark, tmp_path, monkeypatch):
    folder = _write(spark, tmp_path, 300, 4)
    before = tpch.sales(spark, folder)
    rows = sorted(map(str, before.collect()))
    monkeypatch.setattr(tpch, "LINES_PER_TASK", 60)
    after = tpch.sales(spark, folder)
    assert sorted(map(str, after.collect())) == rows and len(rows) == 1200
    assert _parts(before) <= 4 < 15 < _parts(after) <= 20


def test_sums_of_baskets_in_more_tasks(spark, tmp_path):
    """The second shuffle is dealt as well, and a customer's baskets still come in shares."""
    sales = tpch.sales(spark, _write(spark, tmp_path, 300, 4)).withColumns(
        {"item_key": F.col("item_id").cast("long"), "trx_key": F.col("sales_return_document_num").cast("string")}
    )
    # Some lines have no transaction.
    sales = sales.withColumn("trx_key", F.when(F.col("sales_return_document_num") % 9 != 0, F.col("trx_key")))
    labels = {m.ALL: F.lit(""), m.LOCATION: F.col("location").cast("string"), m.ITEM: F.col("item_id")}
    carried = {"location": F.col("location_id"), "item_id": F.col("item_id")}
    few = m.label_measures(sales, carried, labels)
    many = m.label_measures(sales, carried, labels, tasks=20)
    assert few.schema == many.schema
    assert sorted(map(str, few.collect())) == sorted(map(str, many.collect()))
    assert _parts(few) <= 4 < 12 < _parts(many) <= 20


THRESHOLD = "spark.sql.autoBroadcastJoinThreshold"


@pytest.fixture
def threshold(spark):
    """Sets the session's threshold for broadcasts and puts it back."""
    own = spark.conf.get(THRESHOLD)
    yield lambda value: spark.conf.set(THRESHOLD, value)
    spark.conf.set(THRESHOLD, own)


def test_threshold_in_bytes(spark, threshold):
    for setting, size in (("-1", -1), ("300", 300), ("10485760b", 10485760), ("256k", 1 << 18), ("3MB", 3 << 20)):
        threshold(setting)
        assert broadcast_bytes(spark) == size


def test_lines_pass_a_catalog_that_is_not_broadcast(spark, tmp_path, monkeypatch, capsys, threshold):
    """Lines in more tasks are not sorted for the catalog, unless it is too large for a hash table."""
    folder = _write(spark, tmp_path, 300, 4)
    number = F.col("id")
    # Key 3 comes twice; key 4 is sold but not known.
    spark.range(1, 4).union(spark.range(3, 4)).union(spark.range(6, 60)).select(
        number.alias("p_partkey"),
        F.lit("SMALL").alias("p_type"),
        F.concat(F.lit("B"), number % 2).alias("p_brand"),
        (number % 7).cast("int").alias("p_size"),
    ).write.parquet(f"{folder}/part.parquet")
    spark.range(7).select(
        number.alias("c_custkey"), F.lit("BUILDING").alias("c_mktsegment")
    ).write.parquet(f"{folder}/customer.parquet")

    def told() -> tuple[list, str]:
        src = tpch_sources(spark, folder)
        flags = co.customer_flags(src, TPCH_RUN)
        found = fe.features(src, TPCH_RUN, flags.select("customer_id"), ["from_totals", "top_share"])
        capsys.readouterr()
        flags.explain()
        found.explain()
        plan = capsys.readouterr().out
        return sorted(map(str, flags.collect() + found.collect())), plan

    rows, plan = told()
    assert "BroadcastHashJoin [item_key" in plan and len(rows) > 20
    for patched in (fe, tpch):
        monkeypatch.setattr(patched, "LINES_PER_TASK", 60)
    dealt, plan = told()
    assert dealt == rows and "BroadcastHashJoin [item_key" in plan
    threshold("-1")
    passed, plan = told()
    # The flags, the lines with their codes, and the items of customers.
    assert passed == rows and plan.count("ShuffledHashJoin") >= 3
    assert "SortMergeJoin [item_key" not in plan and "SortMergeJoin [key" not in plan
    monkeypatch.setattr(li, "ITEMS_PER_TASK", 1)
    in_order, plan = told()
    assert in_order == rows and "SortMergeJoin [item_key" in plan and "ShuffledHashJoin" not in plan
