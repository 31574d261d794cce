from __future__ import annotations

import hashlib
import random

import corpus_pipeline
import llm_tables as tables
import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from test_lines_urls import expected_texts
from test_near_copies import expected as expected_groups
from tokenizers import Tokenizer

from clientela.llm import mixing


def corpus(spark):
    rng = random.Random(8)
    rows = list(tables.ODD)
    kinds = {"en": ["the", "thing", "and", "other", "when"], "de": ["der", "und", "schon", "über"]}
    for k in range(100, 260):
        lang = rng.choice(list(kinds))
        text = " ".join(rng.choice(kinds[lang]) + rng.choice(["ing", "en", "x", ""])
                        for _ in range(rng.randint(30, 90)))
        if k % 5 == 0:
            text += "\n" + tables.SHARED
        rows.append((k, text, lang, f"s{k % 3}", 1))
        if k % 7 == 0:
            rows.append((1000 + k, text + " more", lang, "s0", 1))
    return rows


def staged(spark, docs, folder):
    """The input of every stage and what it returns, as the stages follow each other."""
    for name, stage in corpus_pipeline.STAGES:
        made = stage(spark, docs, folder)
        path = f"{folder}/{name}"
        made.write.parquet(path)
        after = spark.read.parquet(path)
        yield name, docs, after
        docs = after


def test_stages_against_plain_versions(spark, tmp_path):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    docs = tables.documents(spark, corpus(spark))
    seen = []
    for name, before, after in staged(spark, docs, str(tmp_path)):
        seen.append(name)
        rows, out = [tuple(r) for r in before.collect()], tables.rows_of(after)
        if name != "tokens":
            assert after.columns == docs.columns and 0 < len(out) <= len(rows)
        if name == "language":
            letters = [r for r in rows if any(c.isalpha() for c in r[1] or "")]
            assert set(out) <= set(letters)
            clean = {r for r in letters if r[0] is not None and r[0] >= 100}
            assert clean <= set(out)
        elif name == "lines":
            assert out == expected_texts(rows)
        elif name == "near_copies":
            kept = {i for i, _, root in expected_groups(rows, 5) if i == root}
            assert out == sorted((r for r in rows if r[0] is None or r[0] in kept), key=repr)
        elif name == "mixture":
            cells = mixing.raked_cells(mixing.with_cell(before))
            chance = {tuple(c)[:3]: c.probability for c in cells.collect()}
            marked = mixing.with_cell(before).withColumn("u", mixing.draw(F.col("doc_id"), 17))
            kept = [tuple(r)[:5] for r in marked.collect()
                    if r.u < chance[r._source, r._lang, r._topic]]
            assert out == sorted(kept, key=repr)
        else:
            ids = [library.encode(r[1] or "", add_special_tokens=False).ids for r in rows]
            digest = [hashlib.sha256(np.array(x, "<u4").tobytes()).hexdigest() for x in ids]
            expected = [(r[0], len(x), d) for r, x, d in zip(rows, ids, digest, strict=True)]
            assert [r[:3] for r in out] == sorted(expected, key=repr)
    assert seen == ["language", "lines", "near_copies", "mixture", "tokens"]


def test_stages_on_odd_tables(spark, tmp_path):
    clashing = tables.with_clashes(
        tables.documents(spark, corpus(spark)[:80]),
        "lang_pred", "lang_score", "score", "_keep", "copy", "_tokens", "row", "hub", "tag", "_kept",
    )
    for name, before, after in staged(spark, clashing, str(tmp_path / "clash")):
        assert name == "tokens" or after.columns == before.columns
        assert after.count() > 0
    for name, _, after in staged(spark, tables.documents(spark, []), str(tmp_path / "none")):
        assert after.count() == 0


def test_run_writes_all_stages(spark, tmp_path):
    tables.documents(spark, corpus(spark)).write.parquet(f"{tmp_path}/documents.parquet")
    found = corpus_pipeline.run(spark, str(tmp_path))
    assert found.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert found.count() > 0
