from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from clientela.functions import columns as fc
from clientela.operators.lines import period_window


@pytest.mark.parametrize(
    "customer, main, expected",
    [
        (" 7 ", "9", "7"),
        ("0", " 9 ", "9"),
        (" 0 ", "9", "9"),
        (None, "9", "9"),
        ("", "9", ""),
        ("0", None, None),
    ],
)
def test_canonical_customer(spark, customer, main, expected):
    df = spark.createDataFrame([(customer, main)], "c string, m string")
    assert df.select(fc.canonical_customer(F.col("c"), F.col("m"))).first()[0] == expected


def test_safe_long(spark):
    df = spark.createDataFrame(
        [("12",), ("0012",), (" 12 ",), ("X12",), ("12.5",), (None,)], "t string"
    )
    got = [row[0] for row in df.select(fc.safe_long(F.col("t"))).collect()]
    assert got == [12, 12, 12, None, None, None]


def test_transaction_key(spark):
    df = spark.createDataFrame([(1, 23), (12, 3), (1, None)], "doc int, loc int")
    loose = [r[0] for r in df.select(fc.transaction_key(F.col("doc"), F.col("loc"))).collect()]
    assert loose == ["123", "123", None]
    key = fc.transaction_key(F.col("doc"), F.col("loc"), strict=True)
    strict = [r[0] for r in df.select(key).collect()]
    assert strict[0] != strict[1] and strict[2] is None


@pytest.mark.parametrize(
    "last, months", [("2000-12-31", 1), ("2000-12-01", 1), ("1999-01-01", 24), ("2001-01-01", 0)]
)
def test_months_between_calendar(spark, last, months):
    df = spark.createDataFrame([(date(2001, 1, 1), date.fromisoformat(last))], "a date, b date")
    assert df.select(fc.months_between_calendar(F.col("a"), F.col("b"))).first()[0] == months


@pytest.mark.parametrize(
    "period, months, start",
    [(202001, 24, "2018-01-01"), (202003, 1, "2020-02-01"), (202012, 12, "2019-12-01")],
)
def test_period_window(spark, period, months, start):
    first, end = period_window(period, months)
    assert first.isoformat() == start
    df = spark.createDataFrame([(period,)], "p int")
    row = df.select(
        fc.period_start(F.col("p"), months), fc.period_end(F.col("p")), fc.period_last_day(F.col("p"))
    ).first()
    assert (row[0], row[1]) == (first, end)
    assert (row[1] - row[2]).days == 1


def test_labels(spark):
    row = spark.createDataFrame(
        [(5, 1234, date(2000, 1, 2), "bad", "2000-01-02 07:00:00")],
        "a long, b long, d date, bad string, t string",
    ).select(
        fc.store_label(F.col("a")),
        fc.store_label(F.col("b")),
        fc.weekday_label(F.col("d")),
        fc.two_digits(fc.hour_of(F.col("bad"))),
        fc.two_digits(fc.hour_of(F.col("t"))),
    )
    assert tuple(row.first()) == ("005", "123", "01", None, "07")


def test_like_any(spark):
    df = spark.createDataFrame([("total_stores",), ("totalXstores",), ("other",)], "n string")
    got = [r.n for r in df.filter(fc.like_any(F.col("n"), ["total_stores"])).collect()]
    assert got == ["total_stores", "totalXstores"]
    assert df.filter(fc.like_any(F.col("n"), [])).count() == 3


def test_hash_does_not_depend_on_partitions(spark):
    df = spark.range(2000).select(F.col("id").cast("string").alias("id"))
    few = df.coalesce(1).filter(fc.hash_below(F.col("id"), 1, "split", 0.3))
    many = df.repartition(7).filter(fc.hash_below(F.col("id"), 1, "split", 0.3))
    kept = {r.id for r in few.collect()}
    assert kept == {r.id for r in many.collect()}
    assert 500 < len(kept) < 700


def test_draws_for_different_purposes_are_independent(spark):
    df = spark.range(4000).select(F.col("id").cast("string").alias("id"))
    half = df.filter(fc.hash_below(F.col("id"), 1, "rows", 0.5))
    both = half.filter(fc.hash_below(F.col("id"), 1, "split", 0.5)).count()
    assert 800 < both < 1200
