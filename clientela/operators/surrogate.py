"""A tree of depth 2 that tells clusters apart, by an exact search over every midpoint.

Each level counts the clusters per node, feature and distinct value, range-partitions
these counts by value, and adds them up from the lowest value on: running sums inside a
partition, and the totals of the partitions before it. A midpoint of two neighbouring values is
a cut; the best one of each node leaves the least Gini impurity on its two sides. Only the chosen
cuts (three at most) come to the driver.

Of equally good cuts the one of the first feature and the lowest value is taken. A
node of a single cluster, or whose rows are all alike, is not split.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import add

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from clientela.functions.ranking import PARTITION_SHIFT
from clientela.functions.storage import materialise

DEPTH = 2
NODES = "node int, feature int, threshold double, prediction int"


@dataclass(frozen=True)
class SurrogateTree:
    """Cuts and classes by node; the children of node n are 2n + 1 (at most the cut) and 2n + 2."""

    cuts: dict[int, tuple[int, float]]
    classes: dict[int, int]

    def node(self, features: str = "features") -> Column:
        """The leaf of a row."""
        values = vector_to_array(features)

        def below(n: int) -> Column:
            if n not in self.cuts:
                return F.lit(n)
            feature, threshold = self.cuts[n]
            left = values[feature] <= F.lit(threshold)
            return F.when(left, below(2 * n + 1)).otherwise(below(2 * n + 2))

        return below(0)

    def transform(self, df: DataFrame) -> DataFrame:
        """All rows with the class of their leaf as ``prediction``."""
        names = F.create_map(*[F.lit(x) for pair in self.classes.items() for x in pair])
        return df.withColumn("prediction", names[self.node()])

    def thresholds(self, names: Sequence[str]) -> dict[str, float]:
        """Cut per feature name; of several cuts on a feature the right-most one."""
        found: dict[str, float] = {}

        def visit(n: int) -> None:
            if n in self.cuts:
                feature, threshold = self.cuts[n]
                found[names[feature]] = threshold
                visit(2 * n + 1)
                visit(2 * n + 2)

        visit(0)
        return found

    def save(self, spark: SparkSession, path: str) -> None:
        rows = [(n, *cut, None) for n, cut in self.cuts.items()]
        rows += [(n, None, None, c) for n, c in self.classes.items()]
        spark.createDataFrame(rows, NODES).coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> SurrogateTree:
        rows = spark.read.parquet(path).collect()
        return cls(
            {r.node: (r.feature, r.threshold) for r in rows if r.feature is not None},
            {r.node: r.prediction for r in rows if r.feature is None},
        )


def _counts(classes: Sequence[int]) -> list[Column]:
    return [F.count_if(F.col("cluster") == c).alias(f"n{i}") for i, c in enumerate(classes)]


def _running(counted: DataFrame, names: Sequence[str]) -> DataFrame:
    """Counts (node, feature, value, n...) with the counts up to each value, and the next value."""
    order = ("node", "feature", "value")
    ranged = counted.repartitionByRange(*order).sortWithinPartitions(*order)
    stored = materialise(ranged.withColumn("slot", F.monotonically_increasing_id()), "cut-counts")
    stored = stored.withColumn("part", F.shiftright("slot", PARTITION_SHIFT))
    inside = Window.partitionBy("part", "node", "feature").orderBy("slot")
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = stored.withColumns(
        {f"left_{n}": F.sum(n).over(upto) for n in names} | {"next": F.lead("value").over(inside)}
    )
    # One row per node, feature and partition of the range shuffle.
    parts = stored.groupBy("node", "feature", "part").agg(
        F.min("value").alias("first"), *[F.sum(n).alias(f"part_{n}") for n in names]
    )
    along = Window.partitionBy("node", "feature").orderBy("part")
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("node", "feature")
    parts = parts.select(
        "node", "feature", "part", F.lead("first").over(along).alias("next_first"),
        *[F.coalesce(F.sum(f"part_{n}").over(before), F.lit(0)).alias(f"before_{n}") for n in names],
        *[F.sum(f"part_{n}").over(whole).alias(f"all_{n}") for n in names],
    )
    joined = local.join(materialise(parts, "cut-parts"), ["node", "feature", "part"])
    return joined.withColumns(
        {f"left_{n}": F.col(f"left_{n}") + F.col(f"before_{n}") for n in names}
        | {"next": F.coalesce("next", "next_first")}
    )


def _purity(counts: Sequence[Column]) -> Column:
    """Sum of squares over the sum: the higher, the purer."""
    return reduce(add, [n * n for n in counts]).cast("double") / reduce(add, counts).cast("double")


def best_cuts(placed: DataFrame, classes: Sequence[int]) -> DataFrame:
    """node, feature, threshold and score of the best cut of each node that can be split.

    ``placed`` has node, cluster and features.
    """
    names = [f"n{i}" for i in range(len(classes))]
    values = placed.select(
        "node", "cluster", F.posexplode(vector_to_array("features")).alias("feature", "value")
    )
    running = _running(values.groupBy("node", "feature", "value").agg(*_counts(classes)), names)
    left = [F.col(f"left_{n}") for n in names]
    right = [F.col(f"all_{n}") - F.col(f"left_{n}") for n in names]
    mixed = F.greatest(*[F.col(f"all_{n}") for n in names], F.lit(0)) < reduce(
        add, [F.col(f"all_{n}") for n in names]
    )
    scored = running.filter(F.col("next").isNotNull() & mixed).select(
        "node",
        F.struct(
            (_purity(left) + _purity(right)).alias("score"),
            (-F.col("feature")).alias("feature"),
            (-F.col("value")).alias("value"),
            ((F.col("value") + F.col("next")) / 2).alias("threshold"),
        ).alias("cut"),
    )
    best = scored.groupBy("node").agg(F.max("cut").alias("cut"))
    return best.select(
        "node", (-F.col("cut.feature")).alias("feature"), "cut.threshold", "cut.score"
    )


def fit_surrogate_tree(clustered: DataFrame, depth: int = DEPTH) -> SurrogateTree:
    """The tree of ``cluster`` over ``features``; ``clustered`` is a written table."""
    classes = sorted(r.cluster for r in clustered.select("cluster").distinct().collect())
    tree = SurrogateTree({}, {0: 0})
    for _ in range(depth):
        nodes = clustered.withColumn("node", tree.node())
        open_nodes = [n for n in tree.classes]
        found = {
            r.node: (r.feature, r.threshold)
            for r in best_cuts(nodes.filter(F.col("node").isin(open_nodes)), classes).collect()
        }
        cuts = tree.cuts | found
        leaves = [n for n in tree.classes if n not in found]
        leaves += [child for n in found for child in (2 * n + 1, 2 * n + 2)]
        tree = SurrogateTree(cuts, dict.fromkeys(leaves, 0))
        if not found:
            break
    placed = clustered.withColumn("node", tree.node()).groupBy("node").agg(*_counts(classes))
    votes = {r.node: [r[f"n{i}"] for i in range(len(classes))] for r in placed.collect()}
    # The most frequent class, the lowest of equally frequent ones.
    return SurrogateTree(
        tree.cuts, {n: int(classes[v.index(max(v))]) for n, v in votes.items()}
    )
