"""Prefix trie of conversations, from sorted sequences and the prefixes that neighbours share.

A conversation is a sequence of turns, held as one key of 16 bytes a turn (a digest of role
and text), so byte order sorts conversations and a common prefix of keys is a common
prefix of turns. Keys are range-partitioned together with the conversation's number,
so a group of equal ones is split like any other. In each range the lengths of the
prefixes that neighbours share are put into a sparse table of range minima. Every
prefix that begins at a row is a candidate node; its left and right extents are
found by binary search over that table, each on its own and without a stack, all
candidates of a range at once. Candidates in (row, depth) order are the trie in preorder, so
sums over a subtree are differences of running sums.

A node that reaches the first or the last row of its range may go on in the next one.
There are two chains of such nodes in a range, as long as its outer conversations; their
partial results are added up by the digest of their prefix.

The unit that one task holds is a range, and in it a whole conversation (20 bytes a turn,
no texts).

Defined results: turns go by turn (null first), those of one turn in the order of their
digests; a null role or text is the empty text; rows without a conv_id belong to no
conversation and make no node; equal conversations are all members of the same nodes; a
conversation without turns is a member of the root alone; an empty table
has no conversation, so no node; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from clientela.functions.storage import materialise
from clientela.llm.text import bytes_of

#: Bytes of a turn in a key.
TURN = 16
#: About so many turns are in one range.
RANGE_TURNS = 200_000
#: Numbers of ended conversations that travel as one text.
CHUNK = 500
NOTHING = hashlib.sha256(b"").hexdigest()

INNER, CHAIN, ENDS = 0, 1, 2
PARTS = (
    "kind int, shard int, side int, depth long, node binary, parent binary, conv_id long, "
    "parent_conv_id long, n_convs long, n_children long, n_leaves long, saved long, "
    "bytes long, ends string"
)


def sequences(conversations: DataFrame) -> DataFrame:
    """conv_id, the key of its turns, and the UTF-8 bytes of each turn's text."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    size = F.octet_length(role).cast("string")
    whole = F.sha2(F.concat(size, F.lit(":"), role, text).cast("binary"), 256)
    turns = conversations.filter(F.col("conv_id").isNotNull()).select(
        "conv_id",
        F.struct(
            F.col("turn").alias("turn"),
            F.substring(F.unhex(whole), 1, TURN).alias("digest"),
            F.octet_length(text).cast("long").alias("bytes"),
        ).alias("row"),
    )
    ordered = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("row")).alias("rows"))
    digits = F.transform("rows", lambda row: F.hex(row["digest"]))
    return ordered.select(
        "conv_id",
        F.unhex(F.array_join(digits, "")).alias("key"),
        F.transform("rows", lambda row: row["bytes"]).alias("sizes"),
    )


# One range ------------------------------------------------------------------------------


def _minima(values: np.ndarray) -> list[np.ndarray]:
    """Sparse table: level k holds the minimum of the 2**k values from each position on."""
    table = [values]
    while (step := 1 << (len(table) - 1)) * 2 <= len(values):
        last = table[-1]
        table.append(np.minimum(last[:-step], last[step:]))
    return table


def _right(table: list[np.ndarray], row: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """The last row that shares the first ``depth`` turns of ``row``."""
    right = row.copy()
    for k in range(len(table) - 1, -1, -1):
        # The shared prefixes of the next 2**k rows with the rows before them.
        at = right + 1
        fits = at < len(table[k])
        fits[fits] = table[k][at[fits]] >= depth[fits]
        right[fits] += 1 << k
    return right


def _left(table: list[np.ndarray], row: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """The first row that shares the first ``depth`` turns of ``row``."""
    left = row.copy()
    for k in range(len(table) - 1, -1, -1):
        at = left - (1 << k) + 1
        fits = at >= 0
        fits[fits] = table[k][at[fits]] >= depth[fits]
        left[fits] -= 1 << k
    return left


def _least(table: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The minimum of the values from ``left`` to ``right``."""
    level = np.frexp(right - left + 1)[1] - 1
    found = np.empty(len(left), np.int64)
    for k in range(len(table)):
        own = level == k
        a, b = left[own], right[own] - (1 << k) + 1
        found[own] = np.minimum(table[k][a], table[k][b])
    return found


def _shared(flat: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """How many first turns each row shares with the row before it; -1 for the first row."""
    shared = np.full(len(size), -1, np.int64)
    if len(size) < 2:
        return shared
    common = np.minimum(size[1:], size[:-1])
    ends = np.cumsum(common)
    within = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - common, common)
    mine = np.repeat(start[1:], common) + within
    before = np.repeat(start[:-1], common) + within
    differ = (flat[mine] != flat[before]).any(axis=1)
    # The first difference of each pair; all turns it could share if there is none.
    shared[1:] = common
    pair = np.repeat(np.arange(len(common)), common)[differ]
    first = np.flatnonzero(np.concatenate(([True], pair[1:] != pair[:-1]))) if len(pair) else []
    shared[1 + pair[first]] = within[differ][first]
    return shared


@dataclass
class _Range:
    """The candidates of one sorted range, in preorder."""

    ids: np.ndarray
    size: np.ndarray
    first: np.ndarray  # candidates before each row
    row: np.ndarray
    depth: np.ndarray
    left: np.ndarray
    right: np.ndarray
    parent: np.ndarray  # candidate, -1 for the root
    bytes: np.ndarray
    least: np.ndarray  # smallest conv_id


def _candidates(ids: np.ndarray, flat: np.ndarray, size: np.ndarray, texts: np.ndarray) -> _Range:
    start = np.concatenate(([0], np.cumsum(size)))[:-1]
    shared = _shared(flat, start, size)
    table = _minima(shared)
    count = size - shared
    first = np.concatenate(([0], np.cumsum(count)))
    row = np.repeat(np.arange(len(ids)), count)
    depth = np.arange(first[-1]) - first[row] + shared[row] + 1
    left, right = _left(table, row, depth), _right(table, row, depth)
    parent = np.arange(len(row)) - 1
    # The first candidate of a row hangs on a node that began at an earlier row.
    hangs = (depth == shared[row] + 1) & (depth > 0)
    above = _left(table, row[hangs], depth[hangs] - 1)
    parent[hangs] = first[above] + depth[hangs] - 1 - (shared[above] + 1)
    parent[depth == 0] = -1
    last = np.zeros(len(row), np.int64)
    last[depth > 0] = texts[start[row[depth > 0]] + depth[depth > 0] - 1]
    least = _least(_minima(ids), left, right)
    return _Range(ids, size, first, row, depth, left, right, parent, last, least)


def _ended(r: _Range) -> Iterator[tuple[int, np.ndarray]]:
    """Candidates at which conversations end, and the numbers of these, ascending."""
    begins = np.flatnonzero(np.diff(r.first) > 0)
    ends = np.append(begins[1:], len(r.ids))
    for a, b in zip(begins.tolist(), ends.tolist(), strict=True):
        # Rows without a candidate of their own are equal to the row before them.
        yield int(r.first[a + 1]) - 1, r.ids[a:b]


def _prefixes(turns: np.ndarray) -> list[bytes]:
    """Digest of the first 0, 1, 2, ... turns."""
    state = hashlib.sha256()
    found = [state.digest()]
    for turn in turns:
        state.update(turn.tobytes())
        found.append(state.digest())
    return found


def _range_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Finished nodes of one range, partial results of its two chains, and what ended on them."""
    held = [batch for batch in batches if batch.num_rows]
    if not held:
        return
    table = pa.Table.from_batches(held).combine_chunks()
    del held
    ids = table["conv_id"].to_numpy().astype(np.int64)
    data, offsets = bytes_of(table["key"].chunk(0))
    size = np.diff(offsets) // TURN
    flat = np.frombuffer(data.tobytes(), np.uint64).reshape(-1, 2)
    texts = table["sizes"].chunk(0).flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    r = _candidates(ids, flat, size, texts)
    n, members = len(r.row), r.right - r.left + 1
    outer = (r.left == 0) | (r.right == len(ids) - 1)
    inner = ~outer
    children = np.bincount(r.parent[inner], minlength=n)
    stop = r.first[r.right + 1]

    def below(values: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(np.where(inner, values, 0), dtype=np.int64)))
        return total[stop] - total[:-1]

    leaves, saved = below(children == 0), below((members - 1) * r.bytes)
    # The chain of the first row, and that of the last.
    chains = [np.flatnonzero(r.left == 0), np.flatnonzero(r.right == len(ids) - 1)]
    starts = [0, len(flat) - int(size[-1])]
    named: dict[int, bytes] = {}
    paths = []
    for chain, start in zip(chains, starts, strict=True):
        path = _prefixes(flat[start : start + len(chain) - 1])
        paths.append(path)
        named |= dict(zip(chain.tolist(), path, strict=True))

    ends = np.full(n, NOTHING, object)
    chunks: list[tuple[bytes, int, str]] = []
    for candidate, numbers in _ended(r):
        if outer[candidate]:
            for a in range(0, len(numbers), CHUNK):
                part = numbers[a : a + CHUNK].tolist()
                chunks.append((named[candidate], part[0], ",".join(map(str, part))))
        else:
            text = ",".join(map(str, numbers.tolist()))
            ends[candidate] = hashlib.sha256(text.encode()).hexdigest()

    shard = TaskContext.get().partitionId()
    names = [part.split()[0] for part in PARTS.split(", ")]
    kinds = [part.split()[1] for part in PARTS.split(", ")]
    types = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "string": pa.string()}

    def column(rows: int, values, kind: str) -> pa.Array:
        if values is None:
            return pa.nulls(rows, types[kind])
        if isinstance(values, pa.Array):
            return values.cast(types[kind])
        return pa.array(values, types[kind])

    def batch(rows: int, **values) -> pa.RecordBatch:
        made = [column(rows, values.get(a), b) for a, b in zip(names, kinds, strict=True)]
        return pa.RecordBatch.from_arrays(made, names)

    at = np.flatnonzero(inner)
    for a in range(0, len(at), 1 << 15):
        own = at[a : a + (1 << 15)]
        above = r.parent[own]
        known = inner[above]
        yield batch(
            len(own),
            kind=np.full(len(own), INNER),
            depth=r.depth[own],
            parent=[None if k else named[p] for k, p in zip(known, above.tolist(), strict=True)],
            conv_id=r.least[own],
            parent_conv_id=pa.array(r.least[above], mask=~known),
            n_convs=members[own],
            n_children=children[own],
            n_leaves=leaves[own],
            saved=saved[own],
            ends=ends[own],
        )
    for side, (chain, path) in enumerate(zip(chains, paths, strict=True)):
        # A node of both chains gives its results once.
        counts = np.ones(len(chain), bool) if side == 0 else r.left[chain] != 0
        yield batch(
            len(chain),
            kind=np.full(len(chain), CHAIN),
            shard=np.full(len(chain), shard),
            side=np.full(len(chain), side),
            depth=r.depth[chain],
            node=path,
            parent=[None, *path[:-1]],
            conv_id=pa.array(r.least[chain], mask=~counts),
            n_convs=np.where(counts, members[chain], 0),
            n_children=np.where(counts, children[chain], 0),
            n_leaves=np.where(counts, leaves[chain], 0),
            saved=np.where(counts, saved[chain], 0),
            bytes=r.bytes[chain],
        )
    for a in range(0, len(chunks), 1 << 10):
        own = chunks[a : a + (1 << 10)]
        yield batch(
            len(own),
            kind=np.full(len(own), ENDS),
            node=[c[0] for c in own],
            conv_id=[c[1] for c in own],
            ends=[c[2] for c in own],
        )


# All ranges -----------------------------------------------------------------------------


def _digests_of_ends(chunks: DataFrame) -> DataFrame:
    """node and the digest of its numbers: one stream over its chunks, never all of them at once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for batch in batches:
            done: list[tuple[bytes, str]] = []
            for own, text in zip(batch["node"].to_pylist(), batch["ends"].to_pylist(), strict=True):
                if own != node:
                    if node is not None:
                        done.append((node, state.hexdigest()))
                    node, state = own, hashlib.sha256(text.encode())
                else:
                    state.update(b"," + text.encode())
            yield _pairs(done)
        if node is not None:
            yield _pairs([(node, state.hexdigest())])

    def _pairs(done: list[tuple[bytes, str]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([d[0] for d in done], pa.binary()), pa.array([d[1] for d in done], pa.string())],
            ["node", "ends"],
        )

    return (
        chunks.select("node", "conv_id", "ends")
        .repartition("node")
        .sortWithinPartitions("node", "conv_id")
        .mapInArrow(run, "node binary, ends string")
    )


def _merged(chain: DataFrame) -> DataFrame:
    """Nodes of the chains with their members and children in all ranges, by prefix digest."""
    added = chain.groupBy("node").agg(
        F.max("parent").alias("parent"),
        F.max("depth").alias("depth"),
        F.max("bytes").alias("bytes"),
        F.min("conv_id").alias("conv_id"),
        F.min(F.struct("shard", "side")).alias("owner"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved")],
    )
    added = materialise(added, "chain-nodes")
    heads = added.filter("parent IS NOT NULL").groupBy(F.col("parent").alias("node"))
    more = heads.agg(F.count(F.lit(1)).alias("more"))
    return materialise(
        added.join(more, "node", "left")
        .withColumn("n_children", F.col("n_children") + F.coalesce("more", F.lit(0)))
        .withColumns(
            {
                "own_leaf": (F.col("n_children") == 0).cast("long"),
                "own_saved": (F.col("n_convs") - 1) * F.col("bytes"),
            }
        )
        .drop("more"),
        "chain-sums",
    )


def _chain_sums(chain: DataFrame, merged: DataFrame) -> DataFrame:
    """What the chain nodes of each subtree add to its sums: every node counts in one chain."""
    own = merged.select("node", "owner", "own_leaf", "own_saved")
    mine = F.col("owner") == F.struct("shard", "side")
    deeper = Window.partitionBy("shard", "side").orderBy(F.desc("depth"))
    so_far = deeper.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        chain.select("shard", "side", "depth", "node")
        .join(own, "node")
        .withColumns(
            {
                "leaf_sum": F.sum(F.when(mine, F.col("own_leaf")).otherwise(0)).over(so_far),
                "saved_sum": F.sum(F.when(mine, F.col("own_saved")).otherwise(0)).over(so_far),
            }
        )
        .groupBy("node")
        .agg(F.sum("leaf_sum").alias("leaf_sum"), F.sum("saved_sum").alias("saved_sum"))
    )


def trie(sequences: DataFrame, range_turns: int = RANGE_TURNS) -> DataFrame:
    """All nodes of the trie over rows (conv_id, key, sizes), a written table.

    A node is named by its depth and its smallest member: the first ``depth`` turns of
    ``conv_id`` are its text. ``saved_tokens`` counts, over its subtree, the bytes of a last
    text that are held once instead of once for each member; ``ends_sha256`` is the digest of the
    members that end here.
    """
    spark = sequences.sparkSession
    turns = sequences.agg(F.sum(F.size("sizes"))).first()[0] or 0
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-turns // range_turns))
    parts = (
        sequences.select("conv_id", "key", "sizes")
        .repartitionByRange(ranges, "key", "conv_id")
        .sortWithinPartitions("key", "conv_id")
        .mapInArrow(_range_nodes, PARTS)
    )
    parts = materialise(parts, "trie-ranges")
    chain = parts.filter(F.col("kind") == CHAIN)
    merged = _merged(chain)
    names = merged.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_name"))
    ended = _digests_of_ends(parts.filter(F.col("kind") == ENDS))
    finished = ["conv_id", "depth", "n_convs", "n_children"]
    outer = (
        merged.join(_chain_sums(chain, merged), "node")
        .join(ended, "node", "left")
        .join(names, "parent", "left")
        .select(
            *finished,
            F.col("parent_name").alias("parent_conv_id"),
            (F.col("n_leaves") + F.col("leaf_sum")).alias("n_leaves"),
            (F.col("saved") + F.col("saved_sum")).alias("saved_tokens"),
            F.coalesce("ends", F.lit(NOTHING)).alias("ends_sha256"),
        )
    )
    inner = parts.filter(F.col("kind") == INNER)
    rest = [F.col("n_leaves"), F.col("saved").alias("saved_tokens"), F.col("ends").alias("ends_sha256")]
    inside = inner.filter("parent IS NULL").select(*finished, "parent_conv_id", *rest)
    # Below a chain: the parent's smallest member may be in another range.
    hanging = inner.filter("parent IS NOT NULL").join(names, "parent")
    hanging = hanging.select(*finished, F.col("parent_name").alias("parent_conv_id"), *rest)
    return inside.unionByName(hanging).unionByName(outer).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
        "saved_tokens", "ends_sha256",
    )
