"""Near-duplicate documents: MinHash bands, sequential Bayesian pruning, exact checks.

Documents are linked if the Jaccard similarity of their sets of word shingles is
``percent`` / 100 or more; the result is the components of these links.

1. Each document becomes its shingle count, a digest of its whole set, one byte of
   each of its MinHash values, and the hashes of its bands. Documents with equal
   digests are one class and go on as their smallest doc_id, so copies cost one row.
2. Band hashes that two or more classes share are buckets. In each bucket the
   member that meets most others over all its bands is the hub, and every member is
   paired with the hub: as many pairs as members.
3. A pair's signature bytes are compared batch by batch. After each batch the pair
   is dropped if the posterior probability that its similarity reaches the bound
   is below ``miss``; the prior is uniform. What is left is checked on the full
   sets of words.
4. Components of the links so far. The group of a hub, all that shares a bucket
   with it, has nothing more to say if it lies in one component, however large it
   is. Otherwise its members outside the hub's component are compared with all its
   members of other components: in blocks inside the tasks, by sizes, signature
   batches, shingle hashes and at last the words. Only links become rows. Classes
   that share a bucket share its hub's group, so no link between candidates is
   lost, and neither copies nor near copies are expanded into pairs.

With 4 rows in each of 32 bands a pair of similarity 0.8 shares no bucket with
probability (1 - 0.8^4)^32 < 5e-8; pruning loses at most ``miss`` for each batch.

Defined results: a null, empty or blank text has the empty set, is linked with
nothing and is kept; a text with fewer words than a shingle is one shingle; rows
with one doc_id are one node, and the row whose set has the smaller digest speaks
for it; a row whose doc_id is null is not looked at here; an empty table gives an
empty table; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, functions as F

from clientela.functions.storage import materialise
from clientela.llm.components import smallest_reachable
from clientela.llm.text import coded, slices, words

BLOCK = 512  # members of a group that one task compares at once
HASHED_AT_ONCE = 1024


@dataclass(frozen=True)
class NearDup:
    shingle: int = 5
    percent: int = 80
    bands: int = 32
    rows: int = 4
    batch: int = 32  # signature bytes compared before each decision
    miss: float = 1e-9
    seed: int = 7

    @property
    def hashes(self) -> int:
        return self.bands * self.rows


# Signatures -----------------------------------------------------------------------------


def _mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit mixer."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _word_hashes(distinct: pa.Array) -> np.ndarray:
    digest = xxhash.xxh3_64_intdigest
    return np.fromiter(
        (digest(w.lower()) for w in distinct.cast(pa.large_binary()).to_pylist()),
        np.uint64, len(distinct),
    )


def shingle_sets(texts: pa.Array, size: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text (A-Z lowered)."""
    flat, offsets = words(texts)
    codes, distinct = coded(flat)
    hashes = _word_hashes(distinct)[codes] if len(codes) else np.empty(0, np.uint64)
    with np.errstate(over="ignore"):
        for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
            n = b - a
            width = min(size, n)
            if not n:
                yield np.empty(0, np.uint64)
                continue
            total = np.full(n - width + 1, width, np.uint64)
            for k in range(width):
                total = _mixed(total + hashes[a + k : a + k + n - width + 1])
            yield np.unique(total)


@lru_cache(maxsize=4)
def _hash_family(cfg: NearDup) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(cfg.seed)
    masks = rng.integers(0, 1 << 32, (cfg.hashes, 1), np.uint32)
    odds = rng.integers(0, 1 << 31, (cfg.hashes, 1), np.uint32) * np.uint32(2) + np.uint32(1)
    return masks, odds


def _min_hashes(shingles: np.ndarray, cfg: NearDup) -> np.ndarray:
    """``hashes`` minima over the set, each under a hash of its own."""
    masks, odds = _hash_family(cfg)
    low = np.full(cfg.hashes, 0xFFFFFFFF, np.uint32)
    x = (shingles ^ (shingles >> np.uint64(32))).astype(np.uint32)
    for start in range(0, len(x), HASHED_AT_ONCE):
        mixed = x[None, start : start + HASHED_AT_ONCE] ^ masks
        mixed *= odds
        mixed ^= mixed >> np.uint32(15)
        mixed *= np.uint32(0x2C1B3C6D)
        np.minimum(low, mixed.min(1), out=low)
    return low


FEATURES = (
    "doc_id long, tag long, n_shingles long, digest binary, signature binary, bands array<long>"
)


def features(docs: DataFrame, cfg: NearDup) -> DataFrame:
    """Shingle count, digest, signature and band hashes of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        salts = np.arange(1, cfg.bands + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        for piece in slices(batches):
            sizes, digests, signatures, bands = [], [], [], []
            for shingles in shingle_sets(piece["text"], cfg.shingle):
                sizes.append(len(shingles))
                digests.append(xxhash.xxh3_128_digest(shingles.tobytes()))
                if not len(shingles):
                    signatures.append(b"")
                    bands.append([])
                    continue
                low = _min_hashes(shingles, cfg)
                # The top bits order the minima, so the byte is taken from a mix of all.
                signatures.append((_mixed(low.astype(np.uint64)) & np.uint64(255))
                                  .astype(np.uint8).tobytes())
                band = salts.copy()
                for k in range(cfg.rows):
                    band = _mixed(band + low[k :: cfg.rows].astype(np.uint64))
                bands.append(band.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    piece["doc_id"],
                    piece["tag"],
                    pa.array(sizes, pa.int64()),
                    pa.array(digests, pa.binary()),
                    pa.array(signatures, pa.binary()),
                    pa.array(bands, pa.list_(pa.int64())),
                ],
                ["doc_id", "tag", "n_shingles", "digest", "signature", "bands"],
            )

    known = docs.filter(F.col("doc_id").isNotNull())
    return known.select("doc_id", "text", F.xxhash64("text").alias("tag")).mapInArrow(run, FEATURES)


# Bayesian pruning -----------------------------------------------------------------------


@lru_cache(maxsize=16)
def least_matches(cfg: NearDup) -> tuple[int, ...]:
    """For each batch, the matches below which a pair is dropped.

    Two one-byte hashes agree with p = s + (1 - s) / 256 for similarity s. With a
    uniform prior on s, the posterior after m of n is proportional to
    p^m (1 - p)^(n - m); the pair goes if its mass at s >= bound is below ``miss``.
    """
    s = (np.arange(20_000) + 0.5) / 20_000
    p = s + (1 - s) / 256
    reach = s >= cfg.percent / 100
    bounds = []
    for n in range(cfg.batch, cfg.hashes + 1, cfg.batch):
        for m in range(n + 1):
            logs = m * np.log(p) + (n - m) * np.log1p(-p)
            mass = np.exp(logs - logs.max())
            if mass[reach].sum() >= cfg.miss * mass.sum():
                break
        bounds.append(m)
    return tuple(bounds)


def survivors(left: np.ndarray, right: np.ndarray, cfg: NearDup) -> np.ndarray:
    """Row numbers of the pairs that no batch of signature bytes rules out."""
    alive = np.arange(len(left))
    matches = np.zeros(len(left), np.int64)
    for k, bound in enumerate(least_matches(cfg)):
        at = slice(k * cfg.batch, (k + 1) * cfg.batch)
        matches = matches + (left[alive, at] == right[alive, at]).sum(1)
        keep = matches >= bound
        alive, matches = alive[keep], matches[keep]
    return alive


def _matrix(column: pa.Array, cfg: NearDup) -> np.ndarray:
    data = b"".join(column.to_pylist())
    return np.frombuffer(data, np.uint8).reshape(-1, cfg.hashes)


def _sizes_fit(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """No pair whose sizes differ more can reach the bound."""
    return 100 * np.minimum(a, b) >= percent * np.maximum(a, b)


def pruned_pairs(pairs: DataFrame, classes: DataFrame, cfg: NearDup) -> DataFrame:
    """The pairs (a, b) that the sequential test lets through."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fit = _sizes_fit(batch["n_a"].to_numpy(), batch["n_b"].to_numpy(), cfg.percent)
            batch = batch.filter(pa.array(fit))
            if not batch.num_rows:
                continue
            alive = survivors(_matrix(batch["s_a"], cfg), _matrix(batch["s_b"], cfg), cfg)
            yield batch.select(["a", "b"]).take(pa.array(alive))

    def side(name: str) -> DataFrame:
        return classes.select(
            F.col("doc_id").alias(name),
            F.col("n_shingles").alias(f"n_{name}"),
            F.col("signature").alias(f"s_{name}"),
        )

    return pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(run, "a long, b long")


# Exact checks ---------------------------------------------------------------------------


def _word_sets(texts: pa.Array, cfg: NearDup) -> list[frozenset]:
    sets = []
    for text in texts.cast(pa.binary()).to_pylist():
        found = (text or b"").lower().split()
        width = min(cfg.shingle, len(found))
        sets.append(frozenset(zip(*(found[k:] for k in range(width)))) if width else frozenset())
    return sets


def confirmed_links(pairs: DataFrame, texts: DataFrame, cfg: NearDup) -> DataFrame:
    """The pairs (a, b) whose full sets of words are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub, hub_set = None, frozenset()
        for batch in batches:
            for piece in slices([batch], "t_a"):
                keep = []
                hubs = piece["b"].to_pylist()
                for row, own in enumerate(_word_sets(piece["t_a"], cfg)):
                    if hubs[row] != hub:
                        hub = hubs[row]
                        hub_set = _word_sets(piece["t_b"].slice(row, 1), cfg)[0]
                    shared = len(own & hub_set)
                    union = len(own) + len(hub_set) - shared
                    keep.append(100 * shared >= cfg.percent * union and union > 0)
                yield piece.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    def side(name: str) -> DataFrame:
        return texts.select(F.col("doc_id").alias(name), F.col("text").alias(f"t_{name}"))

    both = pairs.join(side("a"), "a").join(side("b"), "b")
    return both.mapInArrow(run, "a long, b long")


# Candidates -----------------------------------------------------------------------------


def shared_buckets(classes: DataFrame) -> DataFrame:
    """bucket, doc_id for every band hash that two or more classes share."""
    held = classes.select(F.explode("bands").alias("bucket"), "doc_id")
    busy = held.groupBy("bucket").agg(F.count(F.lit(1)).alias("members"))
    return held.join(busy.filter(F.col("members") > 1), "bucket")


def hub_pairs(buckets: DataFrame) -> DataFrame:
    """Each member (a) of a bucket with the hub (b) of the bucket."""
    met = buckets.groupBy("doc_id").agg(F.sum("members").alias("met"))
    ranked = buckets.join(met, "doc_id")
    hubs = materialise(
        ranked.groupBy("bucket")
        .agg(F.max(F.struct("met", (-F.col("doc_id")).alias("minus"))).alias("best"))
        .select("bucket", (-F.col("best.minus")).alias("hub")),
        "hubs",
    )
    return (
        buckets.join(hubs, "bucket")
        .filter(F.col("doc_id") != F.col("hub"))
        .select(F.col("doc_id").alias("a"), F.col("hub").alias("b"))
        .distinct()
    )


class _Merged:
    """Components that links found in one block have joined: further links add nothing."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def top(self, root: int) -> int:
        while root in self.up:
            root = self.up[root]
        return root

    def join(self, a: int, b: int) -> None:
        a, b = self.top(a), self.top(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)


def _block_links(rows: pa.Table, cfg: NearDup) -> Iterator[tuple[int, int]]:
    """Links between probes and other members of different components in one block."""
    doc, root, size = (rows[c].to_numpy() for c in ("doc_id", "root", "n_shingles"))
    probe = rows["probe"].to_numpy()
    asks, others = np.flatnonzero(probe), np.flatnonzero(~probe)
    signature = _matrix(rows["signature"].combine_chunks(), cfg)
    texts = rows["text"].combine_chunks()
    sets = list(shingle_sets(texts, cfg.shingle))
    # Screened on hashes: a collision can only let a pair through to the words.
    kinds, codes = np.unique(np.concatenate(sets), return_inverse=True)
    starts = np.concatenate(([0], np.cumsum([len(s) for s in sets])))
    other_codes = np.concatenate([codes[starts[k] : starts[k + 1]] for k in others])
    other_starts = np.concatenate(([0], np.cumsum([len(sets[k]) for k in others])))[:-1]
    mark = np.zeros(len(kinds), np.int64)
    merged = _Merged()
    for k in asks.tolist():
        able = np.flatnonzero(
            (root[others] != root[k]) & _sizes_fit(size[others], size[k], cfg.percent)
        )
        own = np.broadcast_to(signature[k], (len(able), cfg.hashes))
        able = able[survivors(own, signature[others[able]], cfg)]
        if not len(able):
            continue
        at = codes[starts[k] : starts[k + 1]]
        mark[at] = 1
        shared = np.add.reduceat(mark[other_codes], other_starts)[able]
        mark[at] = 0
        union = len(at) + np.array([len(sets[j]) for j in others[able]]) - shared
        for j in others[able[100 * shared >= cfg.percent * union]].tolist():
            if merged.top(int(root[k])) == merged.top(int(root[j])):
                continue
            a, b = _word_sets(texts.take(pa.array([k, j])), cfg)
            if 100 * len(a & b) >= cfg.percent * len(a | b):
                merged.join(int(root[k]), int(root[j]))
                yield int(doc[k]), int(doc[j])


def _split_pairs(cfg: NearDup):
    """Each block of a hub's group, as rows of it come one after the other."""

    def settled(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(held).combine_chunks()
        probes = pc.sum(rows["probe"]).as_py()
        if probes and probes < rows.num_rows:
            found = list(_block_links(rows, cfg))
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], ["a", "b"]
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        now = None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch[c].to_numpy() for c in ("hub", "row", "column")])
            edges = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(0)) + 1
            for a, b in zip([0, *edges.tolist()], [*edges.tolist(), batch.num_rows], strict=True):
                if (key := tuple(keys[:, a])) != now:
                    if held:
                        yield from settled(held)
                    held, now = [], key
                held.append(batch.slice(a, b - a))
        if held:
            yield from settled(held)

    return run


def split_group_links(
    pairs: DataFrame, classes: DataFrame, texts: DataFrame, roots: DataFrame, cfg: NearDup
) -> DataFrame:
    """Links between different components inside the groups of hubs.

    The group of a hub is everything that shares a bucket with it in which it is the
    hub, so two classes that share a bucket share a group. Members outside the hub's
    component are probes. Probes and members are dealt into blocks of ``BLOCK``; a
    task compares one block of probes with one block of members, by sizes,
    signatures, hashes of shingles and at last words, and returns links only.
    """
    root_of = roots.select(F.col("doc_id").alias("hub"), F.col("root").alias("hub_root"))
    members = (
        pairs.select(F.col("a").alias("doc_id"), F.col("b").alias("hub"))
        .join(roots, "doc_id")
        .join(root_of, "hub")
        .withColumn("probe", F.col("root") != F.col("hub_root"))
    )
    sizes = members.groupBy("hub").agg(
        F.ceil(F.count_if("probe") / BLOCK).cast("int").alias("rows"),
        F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("columns"),
        F.count(F.lit(1)).alias("size"),
    )
    sizes = sizes.filter((F.col("rows") > 0) & (F.col("size") > 1)).drop("size")
    full = (
        members.join(sizes, "hub")
        .join(classes.select("doc_id", "n_shingles", "signature"), "doc_id")
        .join(texts, "doc_id")
    )
    slot = F.xxhash64("doc_id")
    columns = ["hub", "row", "column", "probe", "doc_id", "root", "n_shingles", "signature", "text"]
    # An inner array of places: a probe stands in every column of its row, a member in every
    # row of its column, and a probe is a member too.
    own_row = F.pmod(slot, F.col("rows")).cast("int")
    own_column = F.pmod(slot, F.col("columns")).cast("int")
    asked = F.transform(
        F.sequence(F.lit(0), F.col("columns") - 1),
        lambda c: F.struct(own_row.alias("row"), c.alias("column"), F.lit(True).alias("probe")),
    )
    answering = F.transform(
        F.sequence(F.lit(0), F.col("rows") - 1),
        lambda r: F.struct(r.alias("row"), own_column.alias("column"), F.lit(False).alias("probe")),
    )
    places = F.when(F.col("probe"), F.concat(asked, answering)).otherwise(answering)
    dealt = full.withColumn("place", F.explode(places)).select(
        "hub", "place.row", "place.column", "place.probe", *columns[4:]
    )
    keys = ["hub", "row", "column"]
    return (
        dealt.repartition(*keys)
        .sortWithinPartitions(*keys)
        .mapInArrow(_split_pairs(cfg), "a long, b long")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )


# The operator ---------------------------------------------------------------------------


def near_duplicates(docs: DataFrame, cfg: NearDup = NearDup()) -> DataFrame:
    """doc_id, n_shingles and component_id (smallest doc_id reachable) of every document."""
    made = materialise(features(docs, cfg), "features")
    # One row per doc_id: a maximum per key, added up before the shuffle.
    sets = made.groupBy("doc_id").agg(F.min(F.struct("digest", "tag", "n_shingles")).alias("own"))
    sets = materialise(sets.select("doc_id", "own.*"), "sets")
    filled = sets.filter(F.col("n_shingles") > 0)
    firsts = materialise(filled.groupBy("digest").agg(F.min("doc_id").alias("doc_id")), "firsts")
    classes = materialise(
        made.join(firsts, ["doc_id", "digest"])
        .select("doc_id", "tag", "n_shingles", "signature", "bands")
        .dropDuplicates(["doc_id"]),
        "classes",
    )
    buckets = materialise(shared_buckets(classes), "buckets")
    needed = materialise(
        buckets.select("doc_id").distinct().join(classes.select("doc_id", "tag"), "doc_id"), "needed"
    )
    # The same plan at every size: both sides are dealt by key, and the keys are looked up
    # without a sort of the texts.
    texts = materialise(
        docs.select("doc_id", "text", F.xxhash64("text").alias("tag"))
        .join(needed.hint("shuffle_hash"), ["doc_id", "tag"])
        .select("doc_id", "text")
        .dropDuplicates(["doc_id"]),
        "texts",
    )
    pairs = materialise(hub_pairs(buckets), "pairs")
    links = materialise(
        confirmed_links(pruned_pairs(pairs, classes, cfg), texts, cfg), "hub-links"
    )
    nodes = needed.select("doc_id")
    roots = _roots(nodes, links)
    late = materialise(split_group_links(pairs, classes, texts, roots, cfg), "late-links")
    if not late.isEmpty():
        roots = _roots(nodes, links.unionByName(late))
    return _labelled(sets, firsts, roots)


def _roots(nodes: DataFrame, links: DataFrame) -> DataFrame:
    found = smallest_reachable(links).withColumnRenamed("node", "doc_id")
    joined = nodes.join(found, "doc_id", "left")
    return materialise(
        joined.select("doc_id", F.coalesce("root", "doc_id").alias("root")), "roots"
    )


def _labelled(sets: DataFrame, firsts: DataFrame, roots: DataFrame) -> DataFrame:
    """Every document with the root of its class; the empty ones stand for themselves."""
    first = firsts.select("digest", F.col("doc_id").alias("first"))
    root = roots.select(F.col("doc_id").alias("first"), "root")
    # Classes of one document, by far the most, need no other join.
    class_root = first.join(root, "first", "left").select(
        "digest", F.coalesce("root", "first").alias("root")
    )
    return sets.join(class_root, "digest", "left").select(
        "doc_id", "n_shingles", F.coalesce("root", "doc_id").alias("component_id")
    )
