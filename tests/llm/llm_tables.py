"""Small tables with odd rows, and plain versions of what the operators do."""

from __future__ import annotations

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = ("the quick brown fox and " * 4000 + "\n") * 3
SHARED = "this line of more than forty characters stands in many documents"

ODD = [
    (1, None, None, None, None),
    (2, "", "en", "a", 0),
    (3, " \t\n\x0b\x0c\r ", "en", None, 3),
    (4, "one", "en", "a", 3),
    (5, LONG, "en", "b", len(LONG)),
    (6, "The same text. The same text.\n" + SHARED, "en", "a", 1),
    (6, "The same text. The same text.\n" + SHARED, "en", "a", 1),
    (7, "The same text. The same text.\n" + SHARED, None, "a", 1),
    (8, "  " + SHARED.upper() + "\t\nnext\n" + SHARED, "en", "a", 1),
    (9, SHARED + "\n\n" + SHARED, "fr", "a", 1),
    (10, "été Ünï ñandú 中文 é İ Σίσυφος ΣΑΣ don't <|endoftext|> 12ab!!\n" + SHARED, "fr", "b", 1),
    (11, "12 34 !! ??", "en", "b", 1),
    (None, "a text without a number\n" + SHARED, "en", "b", 1),
    (None, None, None, None, None),
]


def documents(spark, rows=None):
    return spark.createDataFrame(ODD if rows is None else rows, SCHEMA)


def with_clashes(docs, *names):
    """The same rows with extra columns of these names."""
    from pyspark.sql import functions as F

    for name in names:
        docs = docs.withColumn(name, F.lit("extra"))
    return docs


def rows_of(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)
