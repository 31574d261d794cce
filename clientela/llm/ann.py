"""Nearest neighbours by inner product from a forest of random-projection trees.

The trees are fitted on a bounded sample: each node projects on the difference of
two means of random rows and cuts at the median. Every row is then indexed: it
falls into one leaf of each tree. A query walks all trees through one priority
queue, nearest cut first, until it has opened its share of all leaves. Leaves and
their queries meet in Spark by leaf; a leaf with many rows is dealt into blocks,
so no leaf has to fit into one task. Inside a block all scores are computed from
the original vectors in double precision and the best are kept, and the best of
all blocks are ranked by exact score.

Of equal vectors only the k + 1 smallest ids can be among k neighbours (ties go
to the smaller id), so only these are indexed; nothing is lost.

Defined results: rows with a null id, and vectors that are null, zero, of another
length than most, or that hold null or non-finite components take no part; equal
scores go to the smaller id; a repeated row counts once; with fewer candidates
than k all are returned; an empty table gives an empty table; other columns are
not looked at.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from clientela.functions.storage import materialise


@dataclass(frozen=True)
class ForestConfig:
    trees: int = 6
    sample_rows: int = 8_192  # bound on the rows that the trees are fitted on
    leaf_rows: int = 256  # of the sample
    open_share: float = 0.35  # of all leaves that a query opens
    least_leaves: int = 12
    mean_rows: int = 8
    block_rows: int = 4_096
    seed: int = 5


@dataclass(frozen=True)
class Forest:
    """Nodes of all trees. A negative child is the leaf -1 - child."""

    normals: np.ndarray
    cuts: np.ndarray
    low: np.ndarray
    high: np.ndarray
    roots: np.ndarray
    leaves: int
    opened: int

    def leaf_of(self, rows: np.ndarray, root: int) -> np.ndarray:
        node = np.full(len(rows), root, np.int64)
        while (inner := np.flatnonzero(node >= 0)).size:
            at = node[inner]
            side = (rows[inner] * self.normals[at]).sum(1) > self.cuts[at]
            node[inner] = np.where(side, self.high[at], self.low[at])
        return -1 - node

    def open_leaves(self, margins: np.ndarray) -> list[int]:
        """Leaves in the order of the shared queue. ``margins``: of one query, by node."""
        queue = [(-np.inf, int(root)) for root in self.roots]
        heapq.heapify(queue)
        found: list[int] = []
        while queue and len(found) < self.opened:
            worst, node = heapq.heappop(queue)
            if node < 0:
                found.append(-1 - node)
                continue
            margin = float(margins[node])
            # How far the query lies on the wrong side of the cuts above, at worst.
            heapq.heappush(queue, (max(worst, margin), int(self.low[node])))
            heapq.heappush(queue, (max(worst, -margin), int(self.high[node])))
        return found


def fit_forest(sample: np.ndarray, cfg: ForestConfig) -> Forest:
    rng = np.random.default_rng(cfg.seed)
    normals, cuts, low, high = [], [], [], []
    leaves = 0

    def grow(at: np.ndarray) -> int:
        nonlocal leaves
        if len(at) > cfg.leaf_rows:
            size = min(cfg.mean_rows, len(at) // 2)
            drawn = rng.permutation(at)[: 2 * size]
            normal = sample[drawn[:size]].mean(0) - sample[drawn[size:]].mean(0)
            length = np.linalg.norm(normal)
            along = sample[at] @ (normal / length) if length > 0 else np.zeros(len(at))
            cut = float(np.median(along))
            side = along > cut
            if side.any() and not side.all():
                me = len(cuts)
                normals.append(normal / length)
                cuts.append(cut)
                low.append(0)
                high.append(0)
                low[me] = grow(at[~side])
                high[me] = grow(at[side])
                return me
        leaves += 1
        return -leaves

    roots = [grow(np.arange(len(sample))) for _ in range(cfg.trees)]
    width = sample.shape[1] if sample.ndim == 2 else 0
    opened = min(leaves, max(cfg.least_leaves, int(np.ceil(cfg.open_share * leaves))))
    return Forest(
        np.array(normals, np.float64).reshape(len(normals), width), np.array(cuts, np.float64),
        np.array(low, np.int64), np.array(high, np.int64), np.array(roots, np.int64),
        leaves, opened,
    )


def _rows(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def sound_vectors(table: DataFrame, key: str, vector: str) -> DataFrame:
    """key and vec of the rows that take part."""
    v = F.col(vector)
    sound = (
        F.col(key).isNotNull()
        & v.isNotNull()
        & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
        & F.exists(v, lambda x: x != 0)
    )
    rows = table.filter(sound).select(F.col(key).alias("id"), v.alias("vec"))
    lengths = rows.groupBy(F.size("vec").alias("length")).count()
    best = lengths.orderBy(F.desc("count"), "length").first()
    return rows.filter(F.size("vec") == (best["length"] if best else 0))


def _leaf_blocks(forest: Forest, rows: DataFrame, cfg: ForestConfig) -> DataFrame:
    """leaf, id, vec: every row once for each tree."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = _rows(batch["vec"])
            for root in forest.roots.tolist():
                leaf = forest.leaf_of(vectors, root)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(leaf), batch["id"], batch["vec"]], ["leaf", "id", "vec"]
                )

    kind = rows.schema["vec"].dataType.simpleString()
    return rows.select("id", "vec").mapInArrow(run, f"leaf long, id long, vec {kind}")


def _opened(forest: Forest, queries: DataFrame) -> DataFrame:
    """leaf, id, vec: every query once for each leaf that it opens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                piece = batch.slice(start, 512)
                margins = _rows(piece["vec"]) @ forest.normals.T - forest.cuts
                found = [forest.open_leaves(row) for row in margins]
                at = pa.array(np.repeat(np.arange(len(found)), [len(x) for x in found]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(found).astype(np.int64)), piece["id"].take(at),
                     piece["vec"].take(at)],
                    ["leaf", "id", "vec"],
                )

    kind = queries.schema["vec"].dataType.simpleString()
    return queries.select("id", "vec").mapInArrow(run, f"leaf long, id long, vec {kind}")


def _block_best(k: int):
    """The best k rows of a block for each of its queries; rows of a block come first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, ids, vectors = None, [], []
        matrix = numbers = None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch[c].to_numpy() for c in ("leaf", "block")])
            asks = batch["asks"].to_numpy(zero_copy_only=False).astype(np.int64)
            marks = np.concatenate((keys, asks[None]))
            edges = np.flatnonzero((marks[:, 1:] != marks[:, :-1]).any(0)) + 1
            for a, b in zip([0, *edges.tolist()], [*edges.tolist(), batch.num_rows], strict=True):
                if (key := tuple(keys[:, a])) != now:
                    now, ids, vectors, matrix = key, [], [], None
                part = batch.slice(a, b - a)
                own = _rows(part["vec"])
                if not asks[a]:
                    ids.append(part["id"].to_numpy())
                    vectors.append(own)
                    continue
                if not ids:
                    continue
                if matrix is None:
                    matrix, numbers = np.concatenate(vectors), np.concatenate(ids)
                asking = part["id"].to_numpy()
                for start in range(0, len(own), 256):
                    yield from best(asking[start : start + 256], own[start : start + 256],
                                    numbers, matrix)

    def best(asking, own, numbers, matrix) -> Iterator[pa.RecordBatch]:
        rough = own @ matrix.T
        rough[asking[:, None] == numbers[None, :]] = -np.inf
        if len(numbers) > k:
            # With room for the last digits, which depend on the order of addition.
            floor = np.partition(rough, len(numbers) - k, axis=1)[:, len(numbers) - k]
            near = rough >= (floor - 1e-9 * (1 + np.abs(floor)))[:, None]
        else:
            near = np.ones(rough.shape, np.bool_)
        q, c = np.nonzero(near & (rough > -np.inf))
        score = (own[q] * matrix[c]).sum(1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(asking[q]), pa.array(numbers[c]), pa.array(score)],
            ["query_id", "vec_id", "score"],
        )

    return run


def nearest(
    table: DataFrame,
    asks: Column,
    k: int = 20,
    key: str = "vec_id",
    vector: str = "embedding",
    cfg: ForestConfig = ForestConfig(),
) -> DataFrame:
    """query_id, rank, vec_id and score of the k nearest found for the rows that ``asks`` picks."""
    spark = table.sparkSession
    sound = materialise(sound_vectors(table, key, vector), "vectors")
    # Spark keeps k + 1 rows of each vector already before its shuffle.
    same = Window.partitionBy("vec").orderBy("id")
    rows = materialise(
        sound.withColumn("place", F.row_number().over(same)).filter(F.col("place") <= k + 1)
        .select("id", "vec").dropDuplicates(["id"]),
        "rows",
    )
    total = rows.count()
    draw = F.pmod(F.xxhash64("id", F.lit(cfg.seed)), F.lit(1 << 30)) / float(1 << 30)
    picked = rows.filter(draw < min(1.0, cfg.sample_rows / max(1, total)))
    sample = picked.limit(2 * cfg.sample_rows).toPandas().sort_values("id")
    vectors = [np.asarray(v, np.float64) for v in sample["vec"]]
    forest = fit_forest(np.stack(vectors) if vectors else np.empty((0, 0)), cfg)
    indexed = materialise(_leaf_blocks(forest, rows, cfg), "leaves")
    # One row per leaf of the fitted trees: bounded by their configuration.
    sizes = indexed.groupBy("leaf").agg(
        F.ceil(F.count(F.lit(1)) / cfg.block_rows).cast("int").alias("blocks")
    )
    sizes = F.broadcast(sizes)
    columns = ["leaf", "block", "asks", "id", "vec"]
    held = indexed.join(sizes, "leaf").withColumn(
        "block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    )
    queries = sound.filter(asks).dropDuplicates(["id"])
    asked = (
        _opened(forest, queries)
        .join(sizes, "leaf")
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    )
    met = held.withColumn("asks", F.lit(False)).select(*columns).unionByName(
        asked.withColumn("asks", F.lit(True)).select(*columns)
    )
    found = (
        met.repartition("leaf", "block")
        .sortWithinPartitions("leaf", "block", "asks")
        .mapInArrow(_block_best(k), "query_id long, vec_id long, score double")
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.distinct()
        .withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
