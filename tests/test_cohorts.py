from __future__ import annotations

from dataclasses import replace

from micro import CFG, ids, sale, sources

from clientela.operators import cohorts as co


def build(spark, sales, cfg=CFG, **lists):
    src = sources(spark, sales, **lists)
    return src, co.build_cohorts(src, cfg)


def test_cohorts_are_disjoint_and_gated(spark):
    sales = [
        sale("1"),
        sale("2", kind="fctr", day="1996-01-01"),
        sale("3", area="VE"),
        sale("3", kind="fctr"),
        sale("4", kind="fctr"),
        sale("5"),
        sale("6"),
        sale("7"),
        sale("8", item="X12"),
        sale("9", day="1998-12-31"),
        sale("10", day="2001-01-01"),
        sale("11", amt="0"),
        sale("12", area="VE", amt="-1", kind="blta"),
        sale("13", kind="ntcr"),
        sale("14", country_id="CO"),
    ]
    _, c = build(
        spark,
        sales,
        exclusions=[" 4"],
        register=[("5", 7), ("6", 3), ("6", 9), ("7", None)],
    )
    assert ids(c.direct) == ["12", "3"]
    assert ids(c.invoice) == ["2"]
    assert ids(c.receipt) == ["1", "6"]
    large = sorted((r.customer_id, r.sales_tranche) for r in c.large.collect() if r.sales_tranche)
    assert large == [("5", 7), ("6", 3), ("6", 9)]
    assert ids(c.large) == ["5", "6", "6", "7"]


def test_invoice_list_keeps_rows_as_they_are(spark):
    _, c = build(
        spark,
        [sale("1"), sale("2"), sale("3", area="VE")],
        companies=["1", "1", " 2", "3", "4", "5"],
        exclusions=["5"],
        register=[("4", 1), ("4", 2), ("4", 9)],
    )
    assert ids(c.invoice) == [" 2", "1", "1", "4", "4"]
    # ' 2' was not trimmed, so it does not keep customer 2 out of the receipt cohort.
    assert ids(c.receipt) == ["2"]


def test_feature_customers_in_one_pass(spark):
    sales = [sale("1"), sale("2", kind="fctr"), sale("3", area="VE"), sale("4"), sale("5")]
    src, c = build(spark, sales, register=[("4", 9), ("5", None)], exclusions=["3"])
    flags = co.customer_flags(src, CFG)
    assert ids(co.feature_customers_of_flags(flags, src, CFG)) == ids(co.feature_customers(c))


def test_all_customers(spark):
    _, c = build(spark, [sale("1"), sale("2", kind="fctr")])
    rows = {(r.customer_id, r.target) for r in co.all_customers(c).collect()}
    assert rows == {("1", 0), ("2", 1)}


def test_invoice_totals(spark):
    sales = [
        sale("1", kind="fctr", doc=1, amt="10"),
        sale("1", kind="fctr", doc=1, amt="5"),
        sale("1", kind="blta", doc=2, amt="7"),
        sale("2", kind="fctr", day="1996-01-01"),
        sale("2", kind="blta"),
    ]
    src, c = build(spark, sales)
    row = co.invoice_totals(c, src, CFG).collect()
    assert len(row) == 1
    got = row[0]
    assert (got.total_transactions, got.total_transactions_fctr) == (2, 1)
    assert (float(got.total_sales_amt), float(got.total_sales_amt_fctr)) == (22.0, 15.0)
    # A customer listed twice counts its sums twice, its transactions once.
    src, c = build(spark, sales, companies=["1", "1"])
    twice = co.invoice_totals(c, src, CFG).first()
    assert (twice.total_transactions, float(twice.total_sales_amt)) == (2, 44.0)


def test_pro_filter_is_skipped_for_one_country(spark):
    rows = [(str(i), i, 1, 100.0, float(i), 10.0, 5.0) for i in range(1, 41)]
    columns = (
        "customer_id string, total_transactions long, total_transactions_fctr long, "
        "total_sales_amt double, total_sales_amt_fctr double, total_units_cnt double, "
        "total_units_cnt_fctr double"
    )
    totals = spark.createDataFrame(rows, columns)
    assert co.pro_customers(totals, CFG).count() < 40
    assert co.pro_customers(totals, replace(CFG, country="CO")).count() == 40
