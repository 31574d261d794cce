"""The operators of this package as queries over a folder of tables."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from clientela.functions.storage import materialise
from clientela.llm import (
    ann,
    bpe,
    langid,
    licenses,
    linededup,
    merkle,
    mixing,
    neardup,
    preference,
    quality,
    trie,
    urlfilter,
    wavelet,
)
from clientela.llm.text import slices

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

TOKENIZER = "word_bpe_49k.json"


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op1_wavelet_shards(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    path = public_tokenizers.path(TOKENIZER)
    shards = wavelet.write_shards(docs, path, wavelet.scratch_shards(spark))
    return wavelet.document_checks(shards)


@query
def op2_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, folder, "documents"))


@query
def op3_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    found = neardup.near_duplicates(docs, neardup.NearDup(shingle=2, percent=80))
    return found.withColumn("kept", F.col("doc_id") == F.col("component_id"))


@query
def op4_source_mixture(spark: SparkSession, folder: str) -> DataFrame:
    cfg = mixing.MixConfig()
    celled = mixing.with_cell(table(spark, folder, "documents"))
    narrow = celled.select("doc_id", "_source", "_lang", "_topic", "_tokens")
    narrow = materialise(narrow, "document-cells")
    cells = mixing.with_expected_shares(materialise(mixing.raked_cells(narrow, cfg), "mix"), cfg)
    shares = [F.round(f"_{name}_share", 6).alias(f"{name}_share") for name in cfg.targets]
    return mixing.with_probability(narrow, cells, cfg).select(
        "doc_id",
        F.col("_source").alias("source"),
        F.col("_lang").alias("lang"),
        F.col("_topic").alias("topic"),
        F.col("_tokens").alias("n_tokens"),
        F.round("_probability", 6).alias("probability"),
        F.col("_kept").alias("kept"),
        *shares,
    )


@query
def op5_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    model = langid.fit(docs, ~held_out)
    return langid.with_language(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score"
    )


@query
def op6_quality_trees(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    return quality.judge_quality(docs, labels).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "score", "kept",
    )


@query
def op7_nearest_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return ann.nearest(table(spark, folder, "embeddings"), F.col("id") % 20 == 0, k=20)


@query
def op8_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches):
            counts, lost, digests = [], [], []
            for text, keep in zip(
                piece["text"].to_pylist(), piece["_keep"].to_pylist(), strict=True
            ):
                lines, kept = linededup.kept_lines(text or "", keep)
                counts.append(lines)
                lost.append(lines - len(kept))
                digests.append(hashlib.sha256("\n".join(kept).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [piece["doc_id"], pa.array(counts), pa.array(lost), pa.array(digests)],
                ["doc_id", "n_lines", "n_dropped", "kept_sha256"],
            )

    marked = linededup.with_bitmaps(docs, linededup.line_bitmaps(docs))
    return marked.mapInArrow(
        run, "doc_id long, n_lines long, n_dropped long, kept_sha256 string"
    )


@query
def op9_bpe_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return bpe.round_trip_digests(docs, public_tokenizers.path(TOKENIZER))


# The rules of the query, in the order of their statement.
URL_RULES = (
    urlfilter.Rule("allow", "com", "/"),
    urlfilter.Rule("block", "example.com", "/en/"),
    urlfilter.Rule("allow", "www.example.com", "/en/"),
    urlfilter.Rule("block", "net", "/es/"),
    urlfilter.Rule("block", "net", "/fr/"),
)
# The sites that are blocked, under each domain they are served from. Those under .com count
# as well: a URL without a path has none of the rules, which all ask for one.
BLOCKED_SITES = (
    "ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm",
)
SITE_DOMAINS = ("example.com", "example.net", "example.org")
BLOCKED_HOSTS = tuple(f"{site}.{domain}" for site in BLOCKED_SITES for domain in SITE_DOMAINS)


@query
def op10_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return urlfilter.judge_urls(table(spark, folder, "pages"), URL_RULES, BLOCKED_HOSTS)


def rebuilt_conversations(conversations: DataFrame) -> DataFrame:
    """Sequences that begin with the first turns of the conversation their family is named after."""
    own = materialise(trie.sequences(conversations), "sequences")
    most = 8
    heads = own.filter(F.col("conv_id") % 5 == 0).select(
        F.col("conv_id").alias("head_id"),
        F.col("key").substr(1, most * trie.TURN).alias("head_key"),
        F.slice("sizes", 1, most).alias("head_sizes"),
    )
    taken = (F.crc32(F.col("conv_id").cast("string")) % (most + 1)).cast("int")
    width = taken * trie.TURN
    nothing = F.array().cast("array<bigint>")
    head_key = F.coalesce(F.col("head_key").substr(F.lit(1), width), F.lit(b""))
    head_sizes = F.coalesce(F.slice("head_sizes", F.lit(1), taken), nothing)
    rest = F.col("key").substr(width + 1, F.octet_length("key"))
    return own.join(heads, F.col("conv_id") - F.col("conv_id") % 5 == F.col("head_id"), "left").select(
        "conv_id",
        F.concat(head_key, rest).alias("key"),
        F.concat(head_sizes, F.slice("sizes", taken + 1, F.size("sizes"))).alias("sizes"),
    )


@query
def op11_conversation_trie(spark: SparkSession, folder: str) -> DataFrame:
    rebuilt = rebuilt_conversations(table(spark, folder, "conversations"))
    return trie.trie(materialise(rebuilt, "rebuilt"))


@query
def op12_preference_score(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    return preference.ranked(docs, labels, ~held_out).select(
        "doc_id",
        held_out.alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )


@query
def op13_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    changed = merkle.tampered(F.col("doc_id"), F.col("n_chars"))
    return merkle.proofs(table(spark, folder, "documents"), changed)
