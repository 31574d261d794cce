from __future__ import annotations

import re

import random
from collections import defaultdict
from dataclasses import replace

from micro import CFG, ITEMS, sale, sources
from pyspark.sql import functions as F

from clientela.operators import features as fe
from clientela.operators import measures as me
from clientela.sources.tpch import TPCH_RUN, tpch_sources


def values(df) -> dict:
    return {(r.customer_id, r.feature_name): r.feature_value for r in df.collect()}


def everyone(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "customer_id string")


def test_catalog_rows_with_one_key_multiply_lines(spark):
    src = sources(spark, [sale("1", item="12", units="2"), sale("1", item="0012")])
    total = fe.totals(src, CFG, everyone(spark, "1")).first()
    assert total.total_units_cnt == 6.0
    assert total.total_transactions == 1.0
    assert total.total_distinct_items == 2.0
    assert total.total_distinct_sets == 2.0
    got = values(fe.features(src, CFG, everyone(spark, "1"), ["skus", "from_totals"]))
    assert got["1", "skus_N1_0601-A"] == 2.0
    assert got["1", "set_diversity"] == 1.0


def test_missing_key_parts_count_no_transaction(spark):
    src = sources(spark, [sale("1", doc=None), sale("1", doc=2), sale("1", doc=None, item="14")])
    total = fe.totals(src, CFG, everyone(spark, "1")).first()
    assert (total.total_transactions, total.total_units_cnt) == (1.0, 3.0)


def test_neighbouring_numbers_run_together(spark):
    src = sources(spark, [sale("1", doc=1, loc=23), sale("1", doc=12, loc=3)])
    assert fe.totals(src, CFG, everyone(spark, "1")).first().total_transactions == 1.0
    strict = replace(CFG, strict_trx_key=True)
    assert fe.totals(src, strict, everyone(spark, "1")).first().total_transactions == 2.0


def test_long_store_numbers_share_a_label(spark):
    src = sources(spark, [sale("1", loc=1234, doc=1), sale("1", loc=1239, doc=2), sale("1", loc=5, doc=3)])
    got = values(fe.features(src, CFG, everyone(spark, "1"), ["per_trx_store", "top_store", "from_totals"]))
    assert got["1", "per_trx_store_123"] == 2 / 3
    assert got["1", "per_trx_store_005"] == 1 / 3
    assert got["1", "per_trx_cuchi_store"] == 2 / 3
    assert got["1", "total_stores"] == 3.0


def test_credit_notes_need_a_valid_sale(spark):
    src = sources(
        spark,
        [
            sale("1", amt="100"),
            sale("1", kind="ntcr", amt="-20", units="-1", doc=7),
            sale("2", kind="ntcr", amt="-20", units="-1"),
        ],
    )
    got = values(fe.features(src, CFG, everyone(spark, "1", "2")))
    assert got["1", "per_trx_ntcr"] == 1.0
    assert got["1", "per_sales_ntcr"] == -0.2
    assert got["1", "total_units_cnt"] == 1.0
    assert not [key for key in got if key[0] == "2"]


def test_bad_timestamp_drops_the_hour_only(spark):
    src = sources(spark, [sale("1", dttm="bad", channel=" SR ")])
    got = values(fe.features(src, CFG, everyone(spark, "1")))
    assert not [name for _, name in got if name.startswith("per_trx_hour_")]
    assert got["1", "per_trx_channel_SR"] == 1.0
    assert got["1", "per_trx_rent"] == 1.0


def test_main_items_and_completeness(spark):
    src = sources(spark, [sale("1", item="12"), sale("1", item="13")], skus=["00012"])
    got = values(fe.features(src, CFG, everyone(spark, "1"), ["item_pro", "family_completeness"]))
    assert got == {
        ("1", "item_pro_12"): 1.0,
        ("1", "item_pro_0012"): 1.0,
        ("1", "per_family_completeness_0601"): 0.5,
        ("1", "per_family_completeness_0626"): 1.0,
    }


def test_period_edges(spark):
    days = {"a": "1998-12-31", "b": "1999-01-01", "c": "2000-12-31", "d": "2001-01-01"}
    src = sources(spark, [sale(c, day=d) for c, d in days.items()])
    rows = {r.customer_id: r.months_since_last_trx for r in fe.totals(src, CFG, everyone(spark, *days)).collect()}
    assert rows == {"b": 24, "c": 1}


def test_label_share(spark):
    src = sources(spark, [sale("1", doc=1, item="13"), sale("1", doc=2, item="14")])
    got = fe.label_share(src, CFG, everyone(spark, "1"), F.concat(F.lit("by_"), "hier_group_cd"))
    assert values(got) == {("1", "by_G2"): 1.0}


def brute_force(sales) -> dict:
    """Transaction shares and units by family and store, one line at a time."""
    catalog = [i for i in ITEMS if i[0] == "CL" and i[2].isdigit()]
    trx, by_label, units, by_units = (defaultdict(set), defaultdict(set), defaultdict(float), defaultdict(float))
    for s in sales:
        cid = (s[2] or "").strip() if s[2] and s[2].strip() != "0" else s[3].strip()
        key = f"{s[0]}{s[1]}{s[5]}{s[6]}{s[7]}{s[8]}"
        for item in catalog:
            if not s[4].isdigit() or int(item[2]) != int(s[4]):
                continue
            trx[cid].add(key)
            units[cid] += float(s[13])
            by_label[cid, f"per_trx_N0_{item[4]}"].add(key)
            by_label[cid, f"per_trx_store_{s[8]:03d}"].add(key)
            by_units[cid, f"per_uni_N0_{item[4]}"] += float(s[13])
    found = {k: len(v) / len(trx[k[0]]) for k, v in by_label.items()}
    found.update({k: v / units[k[0]] for k, v in by_units.items()})
    return found


def test_against_brute_force_with_a_hot_customer(spark):
    rng = random.Random(3)
    sales = [
        sale(
            rng.choice(["7", " 7 ", "0", "1", "2", "3"]),
            item=rng.choice(["12", "13", "14", "X12"]),
            day=rng.choice(["2000-01-01", "2000-05-05"]),
            doc=rng.randrange(20),
            loc=rng.randrange(12),
            units=str(rng.randrange(1, 9)),
            main_customer_id="7",
        )
        for _ in range(900)
    ]
    src = sources(spark, sales)
    customers = everyone(spark, "1", "2", "3", "7")
    got = values(fe.features(src, CFG, customers))
    for key, value in brute_force(sales).items():
        assert abs(got[key] - value) < 1e-12, key


def test_lines_are_scanned_once_and_filters_reach_the_scan(spark, testdata, capsys):
    src = tpch_sources(spark, testdata)
    items = fe.known_items(src, TPCH_RUN)
    measured = me.customer_measures(fe.feature_lines(src, TPCH_RUN, items), items)
    measured.explain("formatted")
    plan = capsys.readouterr().out
    assert plan.count("lineitem.parquet]") == 1
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in plan
    for joined in ("CartesianProduct", "BroadcastNestedLoopJoin"):
        assert joined not in plan
    # Codes of items join behind the shuffles by basket and by label: these carry the item's key.
    moved = re.findall(r"\) Exchange\nInput \[\d+\]: \[(.*)\]", plan)
    by_line = [columns for columns in moved if "basket" in columns or "label" in columns]
    assert len(by_line) >= 2
    assert not any("hier_set_cd" in columns or "is_main_sku" in columns for columns in by_line)
