from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import Window, functions as F

from clientela.functions import selection as se


def table(spark, rows):
    return spark.createDataFrame(rows, "k string, v double, w double").repartition(5)


@pytest.fixture(scope="module")
def mixed(spark):
    rng = random.Random(3)
    odd = [0.0, -0.0, -1.5, 1e-300, -1e300, math.inf, -math.inf, 2.0**-1074, 1.0, 1.0000000000000002]
    rows = []
    for i in range(900):
        v = rng.choice(odd) if i % 3 else 1.0
        # A third of all rows share a value; keys share long beginnings, some are beginnings of others.
        rows.append((f"Customer#{i % 450:09d}" + "x" * (i // 450), v, rng.random()))
    rows += [("", 1.0, 0.5), ("Customer#", 1.0, 0.5), ("é" * 20, 1.0, None)]
    return rows


def test_every_position(spark, mixed):
    df = table(spark, mixed).cache()
    v = sorted(r[1] for r in mixed)
    w = sorted(r[2] for r in mixed if r[2] is not None)
    found = se.order_statistics(df, {"v": range(0, len(v), 7), "w": [0, 1, len(w) // 2, len(w) - 1]})
    assert found["v"] == v[::7]
    assert found["w"] == [w[0], w[1], w[len(w) // 2], w[-1]]


def test_ties_by_key(spark, mixed):
    df = table(spark, mixed)
    plain = sorted((r[1], r[0].encode()) for r in mixed)
    places = [0, 1, 17, 300, 450, 500, 700, 899, 902]
    found = se.rows_at(df, {"v": places}, "k")["v"]
    assert [(v, k.encode()) for v, k in found] == [plain[p] for p in places]


def test_beyond_the_rows(spark, mixed):
    with pytest.raises(IndexError):
        se.order_statistics(table(spark, mixed), {"v": [len(mixed)]})


@pytest.mark.parametrize("rows", [3, 99, 100, 101, 640])
def test_tiles_equal_ntile(spark, mixed, rows):
    df = table(spark, [(f"{i}{k}", v, w) for i, (k, v, w) in enumerate(mixed[:rows])])
    bounds = se.tile_bounds(df, ["v"], "k", rows, 100)["v"]
    mine = df.select("k", se.tile_of(F.col("v"), F.col("k"), bounds).alias("t"))
    plain = df.select("k", F.ntile(100).over(Window.orderBy("v", "k")).alias("t"))
    tiles = {r.k: r.t for r in plain.collect()}
    assert {r.k: r.t for r in mine.collect()} == tiles
    above = se.above_tiles(df, ["v"], "k", rows, 100, 5).collect()
    assert {r.k for r in above} == {k for k, t in tiles.items() if t > 5}


def test_first_rows(spark):
    df = spark.range(1000).select(F.md5(F.col("id").cast("string")).alias("k"))
    first = {r.k for r in se.first_rows(df, "k", 137).collect()}
    assert first == set(sorted(r.k for r in df.collect())[:137])
    assert se.first_rows(df, "k", 0).count() == 0
    assert se.first_rows(df, "k", 5000).count() == 1000
