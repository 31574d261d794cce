"""Connected components of a table of links, without collecting them."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from clientela.functions.storage import materialise

MAX_ROUNDS = 60


def smallest_reachable(links: DataFrame) -> DataFrame:
    """node and root, the smallest node reachable, for every node of links (a, b).

    Each round links every node's larger neighbours, and then its smaller ones, to
    the smallest node around it, until only stars with the smallest in the middle
    are left. Rows stay within the number of links, and a node with very many
    neighbours only needs a minimum (which is added up before the shuffle) and a
    join that adaptive execution can split. Each round is a written table.
    """
    pairs = (
        links.filter(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    pairs = materialise(pairs, "links")
    before = None
    for _ in range(MAX_ROUNDS):
        pairs = materialise(_round(pairs), "links")
        wide = "decimal(38,0)"
        now = pairs.agg(
            F.count(F.lit(1)), F.sum(F.col("b").cast(wide)), F.sum(F.xxhash64("a", "b").cast(wide))
        ).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    roots = pairs.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)


def _round(pairs: DataFrame) -> DataFrame:
    """Larger neighbours to the smallest around, then smaller ones."""
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    large = (
        both.filter(F.col("b") > F.col("a"))
        .join(least, "a")
        .select(F.col("b").alias("a"), F.col("m").alias("b"))
        .distinct()
    )
    large = large.filter(F.col("a") != F.col("b"))
    small_least = large.groupBy("a").agg(F.min("b").alias("m"))
    moved = large.join(small_least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    kept = small_least.select("a", F.col("m").alias("b"))
    return moved.unionByName(kept).filter(F.col("a") != F.col("b")).distinct()
