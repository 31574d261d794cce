"""Global order without moving all rows into one partition."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from clientela.functions.columns import stable_hash
from clientela.functions.selection import first_rows
from clientela.functions.storage import materialise

# monotonically_increasing_id holds the partition above bit 33, the row below.
PARTITION_SHIFT = 33
ROW_MASK = (1 << PARTITION_SHIFT) - 1


def with_position(df: DataFrame, *order: str | Column, name: str = "position") -> DataFrame:
    """Add the 0-based position in the global order, and the row count as ``<name>_of``.

    Rows are range-partitioned and sorted in place; only one number per partition
    is added up. ``order`` should end in a unique key: it makes the order total and
    lets a value that many rows share be split over partitions.
    """
    slot = f"{name}_slot"
    ranged = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn(slot, F.monotonically_increasing_id())
    )
    stored = materialise(ranged, name)
    partition = F.shiftright(F.col(slot), PARTITION_SHIFT)
    # One row per partition of the range shuffle, so its size is bounded by
    # spark.sql.shuffle.partitions and it can be broadcast and ordered in one task.
    sizes = stored.groupBy(partition.alias("part")).agg(F.count(F.lit(1)).alias("rows"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("part").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    offsets = sizes.select(
        "part",
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("first"),
        F.sum("rows").over(everything).alias(f"{name}_of"),
    )
    return (
        stored.withColumn("part", partition)
        .join(F.broadcast(offsets), "part")
        .withColumn(name, F.col("first") + F.col(slot).bitwiseAND(F.lit(ROW_MASK)))
        .drop("part", "first", slot)
    )


def dense_index(df: DataFrame, *key: str, name: str) -> DataFrame:
    """0-based index over distinct rows, in key order.

    The rows are written first: the range shuffle reads its input twice, to sample and to sort.
    """
    return with_position(materialise(df, f"{name}_rows"), *key, name=name).drop(f"{name}_of")


def _drawn(df: DataFrame, key: str, seed: int, purpose: str) -> DataFrame:
    """Rows with a text whose order is that of the draw, then the key, as a written table."""
    own = F.coalesce(F.col(key), F.lit(""))
    drawn = F.concat(stable_hash(own, seed, purpose), own)
    return materialise(df.withColumn("draw", drawn), "drawn")


def sample_rows(df: DataFrame, key: str, rows: int, seed: int) -> DataFrame:
    """Exactly ``rows`` rows (or all, if fewer), chosen by hash order of a key no two rows share."""
    return first_rows(_drawn(df, key, seed, "rows"), "draw", rows).select(*df.columns)


def sample_share(df: DataFrame, key: str, share: float, seed: int) -> DataFrame:
    """The first ``share`` of the rows in hash order of a key no two rows share."""
    drawn = _drawn(df, key, seed, "share")
    total = drawn.count()
    rows = int(share * total)
    # The row at a share is decided as the quotient rounds, not the product.
    while rows < total and (rows + 1) / total <= share:
        rows += 1
    while rows > 0 and rows / total > share:
        rows -= 1
    return first_rows(drawn, "draw", rows).select(*df.columns)
