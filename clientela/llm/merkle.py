"""Merkle manifest of a table: a tree of digests per language, and one tree over their roots.

Leaves are numbered within their language by doc_id. Blocks of ``2 ** bits``
neighbouring nodes are climbed together: in a window over one block, the first leaf
below a node speaks for it; at each level it looks a fixed number of rows back or ahead,
masked by its slot and by the length of its run, for its sibling, and the first child of
a run hashes the parent. All levels of a block share one shuffle and one sort. The
roots of the blocks are the nodes of the next climb, so a language of any size is
spread over tasks, and the number of climbs is the logarithm of the size to the base
``2 ** bits``. Siblings go down again from blocks to their nodes by joins on the block.

Defined results: null columns are hashed as ``-`` and empty ones as ``0:``; a null lang is
a language of its own, before all others; null doc_ids come first; rows with one doc_id
follow each other in the order of their digests, so a repeated row has two equal leaves side by
side; a single leaf is its subroot and has no sibling; very long texts are
hashed whole; an empty table gives an empty manifest; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from clientela.functions.ranking import dense_index, with_position
from clientela.functions.storage import materialise

#: Levels that are climbed inside one window: 1,024 nodes.
BITS = 10
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*parts: Column) -> Column:
    """Lowercase hex sha256 of the parts one after the other; digests are parts as hex text."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def encoded(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    size = F.octet_length(text).cast("string")
    return F.coalesce(F.concat(size, F.lit(":"), text), F.lit("-"))


def leaf_digest(values: dict[str, Column] | None = None) -> Column:
    """Digest of a row; ``values`` replaces columns."""
    values = values or {}
    return digest(*[encoded(values.get(name, F.col(name))) for name in FIELDS])


def _climbed(nodes: DataFrame, bits: int) -> DataFrame:
    """Nodes with ``path``, their siblings inside the block, and ``node``, the block's root.

    The root stands on the first row of the block. A level without a sibling (a run of
    one) has an empty text in the path; levels above the root of the tree have nothing.
    """
    spec = Window.partitionBy("tree", "block").orderBy("place")
    rows = nodes.withColumns({"block": F.shiftright("place", bits), "node": F.col("digest")})
    siblings = []
    for level in range(bits):
        step = 1 << level
        many = F.col("size") > step
        at = F.shiftright("place", level)
        speaks = F.col("place") % step == 0
        slot = at.bitwiseAND(F.lit(1))
        run = F.least(F.lit(2), F.shiftright(F.col("size") + (step - 1), level) - at + slot)
        rows = rows.withColumns(
            {
                "before": F.lag("node", step).over(spec),
                "after": F.lead("node", step).over(spec),
            }
        )
        sibling = F.when(slot == 1, F.col("before")).when(run == 2, F.col("after"))
        name = f"sibling_{level}"
        siblings.append(name)
        rows = rows.withColumn(name, F.when(many & speaks, F.coalesce(sibling, F.lit(""))))
        parent = F.when(many, digest(F.col("node"), F.col(name))).otherwise(F.col("node"))
        first = F.col("place") % (2 * step) == 0
        rows = rows.withColumn("node", F.when(first, parent)).drop("before", "after")
    until = spec.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # The last row that spoke at a level spoke for this row's ancestor.
    path = F.array(*[F.last(name, ignorenulls=True).over(until) for name in siblings])
    return rows.withColumn("path", F.filter(path, lambda s: s.isNotNull())).drop(*siblings)


def grown(
    nodes: DataFrame,
    bits: int = BITS,
    crown: Callable[[DataFrame], DataFrame] = lambda roots: roots,
) -> DataFrame:
    """Nodes (tree, place, size, digest) with the path of siblings up to the root, and the root.

    ``place`` counts from 0 without gaps in each tree, ``size`` is the number of its
    nodes. Other columns are kept. ``crown`` may add columns to the rows (tree, root),
    which all nodes of the tree then get.
    """
    climbs = []
    while True:
        climb = materialise(_climbed(nodes, bits).drop("block"), "merkle")
        climbs.append(climb)
        nodes = climb.filter(F.col("place") % (1 << bits) == 0).select(
            "tree",
            F.shiftright("place", bits).alias("place"),
            F.shiftright(F.col("size") + ((1 << bits) - 1), bits).alias("size"),
            F.col("node").alias("digest"),
        )
        if nodes.filter("size > 1").isEmpty():
            break
    roots = crown(nodes.select("tree", F.col("digest").alias("root")))
    added = [c for c in roots.columns if c != "tree"]
    above = roots.withColumns(
        {"place": F.lit(0).cast("long"), "path": F.array().cast("array<string>")}
    )
    for climb in reversed(climbs):
        above = above.withColumnsRenamed(
            {"tree": "above_tree", "place": "above_place", "path": "above_path"}
        )
        below = climb.drop("node") if climb is climbs[0] else climb.select("tree", "place", "path")
        same = (F.col("tree") == F.col("above_tree")) & (
            F.shiftright("place", bits) == F.col("above_place")
        )
        above = (
            below.join(above, same)
            .withColumn("path", F.concat("path", "above_path"))
            .select(*below.columns, *added)
        )
    return above


def folded(leaf: Column, path: Column, place: Column) -> Column:
    """The root that a leaf and its siblings give."""
    steps = F.transform(
        path,
        lambda sibling, level: F.struct(
            sibling.alias("sibling"),
            F.call_function("shiftright", place, level).bitwiseAND(F.lit(1)).alias("slot"),
        ),
    )

    def parent(node: Column, step: Column) -> Column:
        left = F.when(step["slot"] == 1, step["sibling"]).otherwise("")
        right = F.when(step["slot"] == 1, "").otherwise(step["sibling"])
        return digest(left, node, right)

    return F.aggregate(steps, leaf, parent)


def manifest(leaves: DataFrame, bits: int = BITS) -> DataFrame:
    """Leaves (doc_id, lang, leaf) with their place in the tree of their language and of all.

    ``leaves`` is a written table; its other columns are kept. Added are ``place`` and
    ``path`` in the language, ``subroot``, ``tree`` (the number of the language) and
    ``top_path``, its siblings among the subroots, and ``root``.
    """
    # Equal rows are told apart by where they stand, so that any number of them can be split.
    told = leaves.withColumn("row", F.monotonically_increasing_id())
    placed = with_position(told, "lang", "doc_id", "leaf", "row", name="at").drop("row", "at_of")
    held = placed.groupBy("lang").agg(F.min("at").alias("start"), F.count(F.lit(1)).alias("size"))
    langs = materialise(dense_index(held, "lang", name="tree"), "languages")
    langs = langs.withColumnRenamed("lang", "own_lang")
    nodes = (
        placed.join(langs, F.col("lang").eqNullSafe(F.col("own_lang")))
        .withColumn("place", F.col("at") - F.col("start"))
        .withColumnRenamed("leaf", "digest")
        .drop("at", "start", "own_lang", "lang")
    )

    def crown(roots: DataFrame) -> DataFrame:
        subroots = roots.select(
            F.lit(0).cast("long").alias("tree"),
            F.col("tree").alias("place"),
            F.col("root").alias("digest"),
            F.lit(roots.count()).cast("long").alias("size"),
        )
        return grown(subroots, bits).select(
            F.col("place").alias("tree"),
            F.col("digest").alias("subroot"),
            F.col("path").alias("top_path"),
            "root",
        )

    return grown(nodes, bits, crown).withColumnRenamed("digest", "leaf").drop("size")


def tampered(doc_id: Column, n_chars: Column) -> Column:
    """n_chars, one more where 7 divides the crc32 of the decimal doc_id."""
    more = n_chars.cast("decimal(20,0)") + 1
    return F.when(F.crc32(doc_id.cast("string")) % 7 == 0, more).otherwise(
        n_chars.cast("decimal(20,0)")
    )


def proofs(docs: DataFrame, changed: Column | None = None, bits: int = BITS) -> DataFrame:
    """Leaf, roots and proof of every row, and the root that a row changed afterwards gives.

    ``changed`` is the n_chars that the row is checked with; without it, its own.
    """
    now = leaf_digest({"n_chars": changed}) if changed is not None else leaf_digest()
    leaves = docs.select(*FIELDS).select(
        "doc_id", "lang", leaf_digest().alias("leaf"), now.alias("seen")
    )
    seen = F.when(F.col("seen") != F.col("leaf"), F.col("seen"))
    leaves = materialise(leaves.withColumn("seen", seen), "leaves")
    placed = manifest(leaves, bits)
    siblings = F.concat("path", "top_path")
    subroot = folded(F.coalesce("seen", "leaf"), F.col("path"), F.col("place"))
    return placed.withColumns(
        {
            "proof_sha256": F.sha2(F.array_join(siblings, "").cast("binary"), 256),
            "folded_root": folded(subroot, F.col("top_path"), F.col("tree")),
        }
    ).select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )
