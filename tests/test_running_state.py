"""Months that are kept and added up, and cohorts from a running state, against one pass."""

from __future__ import annotations

from dataclasses import replace

import micro
import pytest
from pyspark.sql import functions as F

from clientela.operators import cohorts as co
from clientela.operators import features as fe
from clientela.sources.tpch import TPCH_RUN, tpch_sources


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_months_equal_one_pass(spark, testdata, tmp_path):
    cfg = replace(TPCH_RUN, months=3)
    src = tpch_sources(spark, testdata)
    everyone = co.customer_flags(src, cfg).select("customer_id")
    store = str(tmp_path / "months")
    late = replace(src, sales=src.sales.filter("sales_return_document_num % 7 <> 0"))
    fe.put_months(late, replace(cfg, period=200012), store)
    families = ("per_trx_store", "from_totals", "skus", "family_completeness", "ntcr", "item_pro")
    # The months with late lines are measured again; a repeated run changes nothing.
    for period in (200011, 200012, 200012):
        fe.put_months(src, replace(cfg, period=period, months=2), store)
    fe.put_months(src, replace(cfg, months=1), store)
    found = fe.features_of_months(src, cfg, store, everyone, families)
    assert rows(found) == rows(fe.features(src, cfg, everyone, families))
    # Months outside of the window stay in the store and are not read.
    assert spark.read.parquet(store).select("month").distinct().count() > 3
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan


def test_flags_of_a_state(spark, testdata):
    src = tpch_sources(spark, testdata)
    day = F.col("sales_return_dt")
    before = co.cohort_state(src.sales.filter(day < "1999-06-01"), src, TPCH_RUN)
    # Lines that were seen before change nothing.
    since = co.cohort_state(src.sales.filter((day >= "1998-01-01") & (day < "2001-01-01")), src, TPCH_RUN)
    merged = co.merge_states(before, since)
    flags = co.flags_of_state(merged, TPCH_RUN)
    assert rows(flags) == rows(co.customer_flags(src, TPCH_RUN).select(flags.columns))
    earlier = replace(TPCH_RUN, period=199906)
    told = co.flags_of_state(before, earlier)
    assert rows(told) == rows(co.customer_flags(src, earlier).select(told.columns))
    with pytest.raises(Exception, match="has seen receipts"):
        co.flags_of_state(merged, earlier).collect()
    with pytest.raises(ValueError):
        co.flags_of_state(merged, replace(TPCH_RUN, history_from="2000-01-01"))


def test_micro_config_is_inside_the_history():
    assert micro.CFG.history_from < "1999"
