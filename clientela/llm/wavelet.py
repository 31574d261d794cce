"""Token ids as one wavelet matrix file per shard.

Documents are put in ascending order of doc_id by a range shuffle; each task
encodes its documents and writes them as shards. A shard is one payload: a
header, the ids of the documents and where they end, and for every bit of the
ids (highest first) one bit plane with a directory of ranks. Level by level the
ids are split stably by that bit, zeros before ones. With rank and select on the
planes a shard answers: the token at a position, how often a token occurs before
a position, and where its n-th occurrence stands. Nothing else is stored; the ids
are read back from the planes.

Shards are rows of a Parquet table with one payload each, written by Spark, so a
lost executor's shard is written again and never twice. A shard is closed by the
document with which it reaches ``shard_tokens``, so it holds at most that and one
document; its writer needs some ten bytes of memory a token.

Defined results: null text counts as the empty text; a document always has the
end id; rows with one doc_id follow each other in the order of a hash of their
text; a null doc_id comes first; an empty table gives no shards; other columns of
the input are not looked at.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from clientela.functions.storage import scratch_path
from clientela.llm.text import slices
from clientela.llm.words_memo import WordMemo, token_ids

MAGIC = b"WVM1"
HEAD = struct.Struct("<4sIQQ")  # magic, planes, tokens, documents
WORD = 64  # bits of a word of a plane
BLOCK = 8  # words for which one rank is stored
SHARD_TOKENS = 4 << 20
JOINED_WORDS = 500
END_ID = 2


# Planes ---------------------------------------------------------------------------------


class Plane:
    """Bits with rank and select. ``ranks`` counts ones before each block of words."""

    def __init__(self, size: int, bits: np.ndarray, ranks: np.ndarray):
        self.size, self.bits, self.ranks = size, bits, ranks

    @staticmethod
    def pack(flags: np.ndarray) -> tuple[bytes, bytes]:
        words = -(-len(flags) // WORD)
        bits = np.zeros(words * 8, np.uint8)
        packed = np.packbits(flags, bitorder="little")
        bits[: len(packed)] = packed
        ones = np.bitwise_count(bits.view("<u8")).astype(np.uint32)
        blocks = np.add.reduceat(ones, np.arange(0, words, BLOCK)) if words else ones
        ranks = np.concatenate(([0], np.cumsum(blocks, dtype=np.uint64))).astype("<u4")
        return bits.tobytes(), ranks.tobytes()

    @property
    def ones(self) -> int:
        return int(self.ranks[-1])

    def flags(self) -> np.ndarray:
        raw = np.unpackbits(self.bits.view(np.uint8), count=self.size, bitorder="little")
        return raw.view(np.bool_)

    def bit(self, at: np.ndarray) -> np.ndarray:
        at = np.asarray(at, np.uint64)
        return (self.bits[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1)

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Ones before each position."""
        at = np.asarray(at, np.int64)
        word, block = at // WORD, at // (WORD * BLOCK)
        total = self.ranks[block].astype(np.int64)
        for k in range(BLOCK - 1):
            whole = block * BLOCK + k
            inside = whole < word
            total[inside] += np.bitwise_count(self.bits[whole[inside]])
        part = at % WORD
        left = part > 0
        mask = (np.uint64(1) << part[left].astype(np.uint64)) - np.uint64(1)
        total[left] += np.bitwise_count(self.bits[word[left]] & mask)
        return total

    def select(self, count: int, one: bool) -> int:
        """Position of the ``count``-th (from 0) one or zero."""
        low, high = 0, self.size
        while low < high:
            middle = (low + high) // 2
            ones = int(self.rank(np.array([middle + 1]))[0])
            if (ones if one else middle + 1 - ones) > count:
                high = middle
            else:
                low = middle + 1
        return low


class WaveletMatrix:
    """One shard: ids of its tokens, and the documents they belong to."""

    def __init__(self, planes: list[Plane], size: int, docs: np.ndarray, ends: np.ndarray):
        self.planes, self.size, self.docs, self.ends = planes, size, docs, ends

    @staticmethod
    def write(ids: np.ndarray, docs: np.ndarray, known: np.ndarray, ends: np.ndarray) -> bytes:
        """The file of these ids. ``known`` is false where a doc_id is null."""
        depth = max(1, int(ids.max()).bit_length()) if len(ids) else 1
        parts = [
            HEAD.pack(MAGIC, depth, len(ids), len(docs)),
            docs.astype("<i8").tobytes(),
            np.packbits(known).tobytes(),
            ends.astype("<i8").tobytes(),
        ]
        level = ids.astype(np.uint16 if depth <= 16 else np.uint32)
        for bit in range(depth - 1, -1, -1):
            flags = (level >> level.dtype.type(bit)) & level.dtype.type(1)
            flags = flags.astype(np.bool_)
            parts += Plane.pack(flags)
            if bit:
                level = np.concatenate((level[~flags], level[flags]))
        return b"".join(parts)

    @staticmethod
    def read(payload: bytes) -> WaveletMatrix:
        magic, depth, size, docs = HEAD.unpack_from(payload)
        if magic != MAGIC:
            raise ValueError("no wavelet matrix file")
        at = HEAD.size
        ids = np.frombuffer(payload, "<i8", docs, at)
        at += 8 * docs
        known = np.unpackbits(np.frombuffer(payload, np.uint8, -(-docs // 8), at), count=docs)
        at += -(-docs // 8)
        ends = np.frombuffer(payload, "<i8", docs, at)
        at += 8 * docs
        words = -(-size // WORD)
        blocks = -(-words // BLOCK) + 1
        planes = []
        for _ in range(depth):
            bits = np.frombuffer(payload, "<u8", words, at)
            ranks = np.frombuffer(payload, "<u4", blocks, at + 8 * words)
            planes.append(Plane(size, bits, ranks))
            at += 8 * words + 4 * blocks
        return WaveletMatrix(planes, size, np.ma.array(ids, mask=known == 0), ends)

    def tokens(self) -> np.ndarray:
        """All ids in order, from the lowest plane up."""
        values = np.zeros(self.size, np.uint16 if len(self.planes) <= 16 else np.uint32)
        for bit, plane in enumerate(reversed(self.planes)):
            flags = plane.flags()
            zeros = self.size - plane.ones
            above = np.empty_like(values)
            above[~flags] = values[:zeros]
            above[flags] = values[zeros:] | values.dtype.type(1 << bit)
            values = above
        return values.astype(np.uint32)

    def access(self, at: np.ndarray) -> np.ndarray:
        """The token at each of some positions."""
        at = np.asarray(at, np.int64)
        value = np.zeros(len(at), np.uint32)
        for plane in self.planes:
            bit, ones = plane.bit(at).astype(np.int64), plane.rank(at)
            value = (value << np.uint32(1)) | bit.astype(np.uint32)
            at = np.where(bit, self.size - plane.ones + ones, at - ones)
        return value

    def _range(self, token: int, at: int) -> tuple[int, int]:
        low, high = 0, at
        for k, plane in enumerate(self.planes):
            a, b = plane.rank(np.array([low, high])).tolist()
            if token >> (len(self.planes) - 1 - k) & 1:
                zeros = self.size - plane.ones
                low, high = zeros + a, zeros + b
            else:
                low, high = low - a, high - b
        return low, high

    def count(self, token: int, at: int | None = None) -> int:
        """How often a token occurs before a position (in the whole shard by default)."""
        if token >> len(self.planes):
            return 0
        low, high = self._range(token, self.size if at is None else at)
        return high - low

    def locate(self, token: int, nth: int) -> int:
        """Position of the nth occurrence of a token, from 0; -1 if there are fewer."""
        if nth < 0 or self.count(token) <= nth:
            return -1
        at = self._range(token, 0)[0] + nth
        for k in range(len(self.planes) - 1, -1, -1):
            plane = self.planes[k]
            one = bool(token >> (len(self.planes) - 1 - k) & 1)
            at = plane.select(at - (self.size - plane.ones) * one, one)
        return at


# Encoding -------------------------------------------------------------------------------


class LibraryEncoder:
    """The tokenizers library on distinct words; runs of letters many at a time."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        vocab = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, np.bool_)
        self.ends[[i for token, i in vocab.items() if token.endswith("</w>")]] = True

    def other(self, distinct: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Number of ids of each string, and the ids of all of them one after the other."""
        found = [x.ids for x in self.tokenizer.encode_batch_fast(distinct, add_special_tokens=False)]
        ids = np.fromiter((i for own in found for i in own), np.uint32)
        return np.fromiter(map(len, found), np.int64, len(found)), ids

    def letters(self, distinct: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """As ``other``: a run of letters is one word and ends with its first word-end id."""
        texts = [
            " ".join(distinct[k : k + JOINED_WORDS]) for k in range(0, len(distinct), JOINED_WORDS)
        ]
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        ids = np.concatenate([np.array(x.ids, np.uint32) for x in found] or [np.empty(0, np.uint32)])
        stops = np.flatnonzero(self.ends[ids])
        return np.diff(stops, prepend=-1), ids


@lru_cache(maxsize=2)
def _memo(path: str) -> WordMemo:
    encoder = LibraryEncoder(path)
    return WordMemo(encoder.letters, encoder.other)


def _shards(path: str, end_id: int, shard_tokens: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = _memo(path)
        part = 0
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        size = 0

        def closed() -> pa.RecordBatch:
            ids, docs, known, ends = (np.concatenate(x) for x in zip(*held, strict=True))
            payload = WaveletMatrix.write(ids, docs, known, np.cumsum(ends))
            rows = [[part], [len(ids)], [len(docs)], [payload]]
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            return pa.RecordBatch.from_arrays(
                [pa.array(v, k) for v, k in zip(rows, kinds, strict=True)],
                ["part", "n_tokens", "n_docs", "payload"],
            )

        for piece in slices(batches):
            ids, starts = token_ids(piece["text"], memo)
            ids = np.insert(ids, starts[1:], end_id)
            known = piece["doc_id"].is_valid().to_numpy(zero_copy_only=False)
            docs = piece["doc_id"].fill_null(0).to_numpy(zero_copy_only=False)
            held.append((ids, docs, known, np.diff(starts) + 1))
            size += len(ids)
            if size >= shard_tokens:
                yield closed()
                held, size, part = [], 0, part + 1
        if held:
            yield closed()

    return run


def write_shards(
    docs: DataFrame,
    tokenizer_path: str,
    out: str,
    end_id: int = END_ID,
    shard_tokens: int = SHARD_TOKENS,
) -> DataFrame:
    """Encode all documents and write one wavelet matrix file per shard below ``out``.

    Returns the written table: shard (ascending with doc_id), n_tokens, n_docs, payload.
    """
    spark = docs.sparkSession
    order = ["doc_id", F.xxhash64("text")]
    ranged = (
        docs.select("doc_id", "text").repartitionByRange(*order).sortWithinPartitions(*order)
    )
    made = ranged.mapInArrow(
        _shards(tokenizer_path, end_id, shard_tokens),
        "part long, n_tokens long, n_docs long, payload binary",
    )
    # Ascending over tasks and, inside one, over its parts.
    numbered = made.select(
        (F.spark_partition_id().cast("long") * (1 << 32) + F.col("part")).alias("shard"),
        "n_tokens",
        "n_docs",
        "payload",
    )
    # The payload is dense bits; a codec would find nothing in it.
    numbered.write.option("compression", "uncompressed").parquet(out)
    return spark.read.schema(numbered.schema).parquet(out)


def shard_starts(shards: DataFrame) -> DataFrame:
    """shard and the number of ids in all shards before it. One narrow row per shard."""
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("first")
    return shards.select("shard", "n_tokens").select("shard", start)


def read_documents(shards: DataFrame) -> DataFrame:
    """doc_id and ids of every document, read back from the shard files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for payload in batch["payload"]:
                shard = WaveletMatrix.read(payload.as_py())
                lists = pa.ListArray.from_arrays(
                    pa.array(np.concatenate(([0], shard.ends)).astype(np.int32)),
                    pa.array(shard.tokens().astype(np.int32)),
                )
                yield pa.RecordBatch.from_arrays([pa.array(shard.docs), lists], ["doc_id", "ids"])

    return shards.select("payload").mapInArrow(run, "doc_id long, ids array<int>")


def document_checks(shards: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and crc-32 of the ids of every document, from the shard files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, payload in zip(batch["shard"].to_pylist(), batch["payload"], strict=True):
                shard = WaveletMatrix.read(payload.as_py())
                raw = memoryview(shard.tokens().astype("<u4", copy=False)).cast("B")
                starts = np.concatenate(([0], shard.ends[:-1]))[: len(shard.ends)]
                sums = [
                    zlib.crc32(raw[4 * a : 4 * b])
                    for a, b in zip(starts.tolist(), shard.ends.tolist(), strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(starts), number)),
                        pa.array(shard.docs),
                        pa.array(starts),
                        pa.array(shard.ends - starts),
                        pa.array(sums, pa.int64()),
                    ],
                    ["shard", "doc_id", "inside", "n_tokens", "ids_crc32"],
                )

    read = shards.select("shard", "payload").mapInArrow(
        run, "shard long, doc_id long, inside long, n_tokens long, ids_crc32 long"
    )
    # The narrow rows meet the starts, not the payloads.
    return read.join(shard_starts(shards), "shard").select(
        "doc_id", (F.col("first") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32"
    )


def scratch_shards(spark: SparkSession) -> str:
    """A new folder for shards below the folder the cluster shares."""
    return scratch_path(spark, "token-shards")
