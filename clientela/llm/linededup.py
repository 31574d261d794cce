"""Drop lines that many documents share; the decisions come as compressed keep bitmaps.

The key of a line is the line with ASCII white space stripped at both ends and
A-Z lowered. Keys of at least ``min_chars`` code points found in at least
``min_docs`` documents lose all their lines except in the largest doc_id that
holds the key.

Only (digest, doc_id, position) is moved. These rows are range-partitioned by
digest and document, sorted by digest, document (largest first) and position, and
streamed: the first document of a run keeps its lines, the later ones lose them
as soon as the run is known to have enough documents. A range may cut a run, so
the first and the last run of a partition are settled afterwards, by one total
per cut digest; there are at most two of these per partition. A key that a third
of all documents share is thus spread over many tasks.

Defined results: null or empty text is one empty line; a row whose doc_id is null
is no document, it neither counts nor loses lines; repeated rows count as one
document and lose the same lines; rows with one doc_id and different texts are one
document with several texts; an empty table gives an empty table; other columns,
whatever their names, are passed through by ``without_lines``.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from hashlib import md5

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from clientela.functions.storage import materialise
from clientela.llm.text import slices, unused

SPACE = b" \t\n\v\f\r"
MIN_CHARS = 40
MIN_DOCS = 5

LINE = "digest binary, doc_id long, tag long, pos int, n_lines int"
#: What a row of the stream is: a line to drop, a line of a cut run, or the total of a cut run.
DROP, CUT, TOTAL = 0, 1, 2


def line_digests(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """One row per line whose key is long enough. ``tag`` tells texts of one doc_id apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches):
            digests, owners, positions, counts = [], [], [], []
            for row, text in enumerate(piece["text"].cast(pa.binary()).to_pylist()):
                lines = text.split(b"\n")
                for pos, line in enumerate(lines):
                    if len(line) < min_chars:
                        continue
                    key = line.strip(SPACE)
                    if len(key) < min_chars or (
                        len(key) < 4 * min_chars and len(key.decode("utf-8")) < min_chars
                    ):
                        continue
                    digests.append(md5(key.lower(), usedforsecurity=False).digest())
                    owners.append(row)
                    positions.append(pos)
                    counts.append(len(lines))
            rows = pa.array(owners, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(digests, pa.binary()),
                    piece["doc_id"].take(rows),
                    piece["tag"].take(rows),
                    pa.array(positions, pa.int32()),
                    pa.array(counts, pa.int32()),
                ],
                ["digest", "doc_id", "tag", "pos", "n_lines"],
            )

    keyed = docs.filter(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    return keyed.select("doc_id", "text", F.xxhash64("text").alias("tag")).mapInArrow(run, LINE)


class _Run:
    """Lines of one digest, as they come: sorted by document, largest first."""

    def __init__(self, digest: bytes, first: bool):
        self.digest, self.first = digest, first
        self.top, self.last, self.docs = None, None, 0
        self.held: list[pa.RecordBatch] = []


def _stream(min_docs: int):
    names = ["kind", "digest", "doc_id", "tag", "pos", "n_lines", "docs"]

    def rows(kind: int, lines: pa.RecordBatch, docs: int = 0) -> pa.RecordBatch:
        n = lines.num_rows
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(n, kind, np.int32)),
                pa.nulls(n, pa.binary()) if kind == DROP else lines["digest"].cast(pa.binary()),
                lines["doc_id"], lines["tag"], lines["pos"], lines["n_lines"],
                pa.array(np.full(n, docs, np.int32)),
            ],
            names,
        )

    def losers(run: _Run, lines: pa.RecordBatch) -> pa.RecordBatch:
        return rows(DROP, lines.filter(pa.array(lines["doc_id"].to_numpy() != run.top)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: _Run | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            digest = batch["digest"].to_numpy(zero_copy_only=False)
            doc = batch["doc_id"].to_numpy()
            new = np.concatenate(([True], digest[1:] != digest[:-1]))
            fresh = new | np.concatenate(([True], doc[1:] != doc[:-1]))
            starts = np.flatnonzero(new)
            stops = np.append(starts[1:], batch.num_rows)
            counts = np.add.reduceat(fresh.astype(np.int64), starts)
            # Runs of too few documents that lie inside the batch are settled by their count.
            busy = counts >= min_docs
            busy[0] = busy[-1] = True
            for k in np.flatnonzero(busy):
                a, b = int(starts[k]), int(stops[k])
                if now is None or digest[a] != now.digest:
                    now = _Run(digest[a], first=now is None)
                docs = int(counts[k]) - (now.last == doc[a])
                now.top = doc[a] if now.top is None else now.top
                now.last, now.docs = doc[b - 1], now.docs + docs
                lines = batch.slice(a, b - a)
                if now.first:
                    yield rows(CUT, lines)
                elif now.docs < min_docs:
                    now.held.append(lines)
                else:
                    for part in (*now.held, lines):
                        yield losers(now, part)
                    now.held = []
        if now is None or now.first:
            return
        if now.docs < min_docs:
            for part in now.held:
                yield rows(CUT, part)
        else:
            # Its lines are settled; a later partition still has to know of them.
            total = pa.RecordBatch.from_arrays(
                [pa.array([v], t) for v, t in (
                    (now.digest, pa.binary()), (int(now.top), pa.int64()), (None, pa.int64()),
                    (None, pa.int32()), (None, pa.int32()))],
                ["digest", "doc_id", "tag", "pos", "n_lines"],
            )
            yield rows(TOTAL, total, now.docs)

    return run


def dropped_lines(
    docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS
) -> DataFrame:
    """doc_id, tag, pos and n_lines of every line that goes."""
    # Written first: the range shuffle samples its input, and would cut the texts twice.
    lines = materialise(line_digests(docs, min_chars), "lines")
    order = ["digest", F.col("doc_id").desc()]
    streamed = (
        lines.repartitionByRange(*order)
        .sortWithinPartitions(*order, "tag", "pos")
        .mapInArrow(_stream(min_docs), f"kind int, {LINE}, docs int")
    )
    told = materialise(streamed, "line-runs")
    cut = told.filter(F.col("kind") == CUT)
    docs_of = cut.select("digest", "doc_id").distinct().withColumn("docs", F.lit(1))
    totals = (
        docs_of.unionByName(told.filter(F.col("kind") == TOTAL).select("digest", "doc_id", "docs"))
        .groupBy("digest")
        .agg(F.sum("docs").alias("all_docs"), F.max("doc_id").alias("top"))
        .filter(F.col("all_docs") >= min_docs)
    )
    # At most two digests per partition of the range shuffle, so this fits in any executor.
    late = cut.join(F.broadcast(totals), "digest").filter(F.col("doc_id") < F.col("top"))
    columns = ["doc_id", "tag", "pos", "n_lines"]
    return told.filter(F.col("kind") == DROP).select(*columns).unionByName(late.select(*columns))


def keep_bitmaps(dropped: DataFrame) -> DataFrame:
    """doc_id, tag and a compressed bitmap, one bit per line, of each document that loses lines."""
    lost = dropped.groupBy("doc_id", "tag").agg(
        F.max("n_lines").alias("n_lines"), F.collect_set("pos").alias("lost")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            maps = []
            for size, lost in zip(batch["n_lines"].to_pylist(), batch["lost"], strict=True):
                keep = np.ones(size, np.bool_)
                keep[lost.values.to_numpy()] = False
                maps.append(zlib.compress(np.packbits(keep).tobytes()))
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["tag"], pa.array(maps, pa.binary())],
                ["doc_id", "tag", "keep"],
            )

    return lost.mapInArrow(run, "doc_id long, tag long, keep binary")


def kept_lines(text: str, keep: bytes | None) -> tuple[int, list[str]]:
    """Number of lines of a text, and those that its bitmap keeps (all without one)."""
    lines = text.split("\n")
    if keep is None:
        return len(lines), lines
    bits = np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8), count=len(lines))
    return len(lines), [line for line, bit in zip(lines, bits.tolist(), strict=True) if bit]


def line_bitmaps(
    docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS
) -> DataFrame:
    """Keep bitmaps of the documents that lose lines: doc_id, tag (hash of the text), keep."""
    return keep_bitmaps(dropped_lines(docs, min_chars, min_docs))


def with_bitmaps(docs: DataFrame, bitmaps: DataFrame, name: str = "_keep") -> DataFrame:
    """All rows with their bitmap as column ``name``, null where all lines stay."""
    doc_id, tag = unused(docs.columns, "_doc_id"), unused(docs.columns, "_tag")
    keyed = bitmaps.select(
        F.col("doc_id").alias(doc_id), F.col("tag").alias(tag), F.col("keep").alias(name)
    )
    # The bitmaps are the smaller side in every partition: no sort of the texts.
    return docs.join(
        keyed.hint("shuffle_hash"),
        (docs["doc_id"] == F.col(doc_id)) & (F.xxhash64(docs["text"]) == F.col(tag)),
        "left",
    ).drop(doc_id, tag)


def without_lines(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """The same rows and columns with the dropped lines gone from ``text``."""
    columns = docs.columns
    name = unused(columns, "_keep")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = list(batch.columns[: len(columns)])
            at = batch.schema.get_field_index("text")
            keeps = batch[name].to_pylist()
            if any(keep is not None for keep in keeps):
                texts = [
                    text if keep is None else "\n".join(kept_lines(text, keep)[1])
                    for text, keep in zip(batch["text"].to_pylist(), keeps, strict=True)
                ]
                out[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(out, columns)

    return with_bitmaps(docs, bitmaps, name).mapInArrow(run, docs.schema)
