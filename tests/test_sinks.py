from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from clientela.sources import sinks


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_a_failed_publication_leaves_the_table(spark, tmp_path):
    path = str(tmp_path / "table")
    with pytest.raises(FileNotFoundError):
        sinks.read_published(spark, path)
    first = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    sinks.publish_parquet(first, path)
    # A publication that dies while its rows are written.
    broken = spark.range(10).select(
        F.when(F.col("id") == 9, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).alias("k")
    )
    with pytest.raises(Exception, match="lost"):
        sinks.publish_parquet(broken, path)
    assert rows(sinks.read_published(spark, path)) == [(1, "a"), (2, "b")]
    # One that dies before its pointer: rows without a pointer are never read.
    spark.range(3).write.parquet(f"{path}/rows/00000002-dead")
    assert rows(sinks.read_published(spark, path)) == [(1, "a"), (2, "b")]
    again = sinks.publish_parquet(first.filter("k = 2").union(first.filter("k = 2")), path)
    assert rows(again) == rows(sinks.read_published(spark, path)) == [(2, "b"), (2, "b")]
    # A table may be published from what it was.
    sinks.publish_parquet(sinks.read_published(spark, path).distinct(), path)
    assert rows(sinks.read_published(spark, path)) == [(2, "b")]


def test_partitions_are_put_once(spark, tmp_path):
    path = str(tmp_path / "table")
    january = spark.createDataFrame([("a", "CL", 1), ("b", "CL", 1), ("c", "CO", 1)], "k string, country string, period int")
    for _ in range(2):
        sinks.put_partitions(january, path, "country", "period")
    assert rows(spark.read.parquet(path).select("k", "country", "period")) == rows(january)
    later = spark.createDataFrame([("z", "CL", 2), ("y", "CO", 1)], january.schema)
    whole = sinks.put_partitions(later, path, "country", "period")
    assert rows(whole.select("k", "country", "period")) == [
        ("a", "CL", 1), ("b", "CL", 1), ("y", "CO", 1), ("z", "CL", 2),
    ]


def test_malformed_lines_are_kept_apart(spark, tmp_path):
    folder = tmp_path / "csv"
    os.makedirs(folder)
    (folder / "a.csv").write_text("k,v,day\n1,1.5,2020-01-01\nx,2,2020-01-01\n3,4\n5,6,2020-01-02,more\n")
    (folder / "b.csv").write_text("k,v,day\n7,,2020-02-01\n8,1,not a day\n")
    (folder / "c.txt").write_text("k,v,day\n9,9,2020-02-01\n")
    good, apart = sinks.read_csv_checked(
        spark, str(folder), "k int, v double, day date", str(tmp_path / "quarantine"), ".csv"
    )
    assert [(r.k, r.v, str(r.day)) for r in good.orderBy("k").collect()] == [
        (1, 1.5, "2020-01-01"), (7, None, "2020-02-01"),
    ]
    told = sorted((os.path.basename(r.file), r.line) for r in apart.collect())
    assert told == [
        ("a.csv", "3,4"), ("a.csv", "5,6,2020-01-02,more"), ("a.csv", "x,2,2020-01-01"),
        ("b.csv", "8,1,not a day"),
    ]
    assert rows(sinks.read_published(spark, str(tmp_path / "quarantine"))) == rows(apart)
