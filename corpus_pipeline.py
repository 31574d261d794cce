"""A corpus from raw documents: language, lines, near copies, mixture, tokens.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept.
All but the last return the columns of ``documents``. Defined results of the
stages on odd rows are those of their operators; besides, a row with a null
doc_id is never taken for a copy of another and stays, and rows with one doc_id
are one document: they stay or go together.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from clientela.functions.storage import scratch_path
from clientela.llm import bpe, langid, linededup, mixing, neardup
from clientela.llm.text import unused

#: Less than an even chance between two languages: the text is in none that is known.
LEAST_LANGUAGE_SCORE = 0.5
TOKENIZER = "word_bpe_49k.json"


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a letter, and those whose language the model cannot tell."""
    model = langid.fit(docs)
    if not model.names:  # nothing is labelled, so nothing can be told apart
        return docs.filter(F.regexp_like(F.coalesce("text", F.lit("")), F.lit("\\p{L}")))
    name, score = unused(docs.columns, "lang_pred"), unused(docs.columns, "lang_score")
    told = langid.with_language(docs, model, name, score)
    known = (F.col(name) != langid.UNKNOWN) & (F.col(score) >= LEAST_LANGUAGE_SCORE)
    return told.filter(known).drop(name, score)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop lines that many documents share, except in the largest doc_id."""
    return linededup.without_lines(docs, linededup.line_bitmaps(docs))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near copies (five-word shingles, 0.8), the smallest."""
    found = neardup.near_duplicates(docs, neardup.NearDup(shingle=5, percent=80))
    copies = found.filter(F.col("doc_id") != F.col("component_id"))
    name = unused(docs.columns, "copy")
    copies = copies.select(F.col("doc_id").alias(name))
    return docs.join(copies, docs["doc_id"] == F.col(name), "left_anti")


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Draw documents so that sources, languages and topics have their target weights."""
    return mixing.mixed(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document and digests of the ids and of the text decoded from them."""
    return bpe.round_trip_digests(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("language", language),
    ("lines", lines),
    ("near_copies", near_copies),
    ("mixture", mixture),
    ("tokens", tokens),
]

#: A trained model and a component search are in it: it is tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each returns is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        made = stage(spark, docs, sf_dir)
        path = scratch_path(spark, f"stage-{name}")
        made.write.parquet(path)
        docs = spark.read.schema(made.schema).parquet(path)
    return docs
