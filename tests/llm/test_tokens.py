from __future__ import annotations

import hashlib
import random
import zlib

import llm_tables as tables
import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from clientela.llm import bpe, wavelet
from clientela.llm.words_memo import Memo, WordMemo, token_ids

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def own():
    return bpe.Bpe(PATH)


def random_texts(n):
    rng = random.Random(3)
    letters = [chr(c) for c in [*range(0x250), 0x300, 0x301, 0x3A3, 0x3C3, 0x1E9E, 0x2028, 0x3000,
                                0x4E2D, 0xAC00, 0x1100, 0x1161, 0x1F600, 0x200B, 0x660, 0xFB01]]
    parts = ["'s", "'T", " ", "\n", "<|endoftext|>", "<|ENDOFTEXT|>", "the", "aaaa", "hahaha"]
    for _ in range(n):
        yield "".join(
            rng.choice(parts) if rng.random() < 0.3 else rng.choice(letters)
            for _ in range(rng.randint(0, 30))
        )


def test_backtracking_is_the_merges(own, library):
    for text in [*random_texts(1500), "ab" * 3000 + "th" * 500]:
        ids = library.encode(text, add_special_tokens=False).ids
        assert own.encode(text) == ids, text
        assert own.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_every_kind_of_character(own, library):
    """All of the first 12,800 characters, and letters that are younger than some tables."""
    points = [*range(0x3200), 0xA7CB, 0xA7CE, 0xAB6C, 0x107BB, 0x10940, 0x10D50,
              0x16EA1, 0x18E00, 0x323B0, 0x1D400, 0xFEFF, 0x2FFFF]
    texts = [f"a!{chr(c)}!b{chr(c)}1" for c in points]
    found = library.encode_batch_fast(texts, add_special_tokens=False)
    assert [t for t, e in zip(texts, found, strict=True) if own.encode(t) != e.ids] == []


def test_words_together_are_the_texts(own, library):
    encoder = wavelet.LibraryEncoder(PATH)
    texts = [*random_texts(300), *(t[1] or "" for t in tables.ODD)]
    for memo in (
        WordMemo(own.encode_words, own.encode_words), WordMemo(encoder.letters, encoder.other)
    ):
        for _ in range(2):  # encoded, then remembered
            ids, starts = token_ids(pa.array(texts), memo)
            for k, text in enumerate(texts):
                expected = library.encode(text, add_special_tokens=False).ids
                assert ids[starts[k] : starts[k + 1]].tolist() == expected


def test_memo_stays_bounded(own):
    memo = Memo(own.encode_words, size=50)
    for k in range(0, 500, 20):
        words = pa.array([f"word{j}" for j in range(k, k + 20)] + ["the"], pa.large_string())
        assert memo.ids(words).to_pylist() == [own.encode(w) for w in words.to_pylist()]
        assert len(memo.strings) <= 71


def test_digests_of_odd_rows(spark, library):
    docs = tables.with_clashes(tables.documents(spark), "ids", "n_tokens", "decoded")
    expected = []
    for doc_id, text, *_ in tables.ODD:
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        raw = np.array(ids, "<u4").tobytes()
        expected.append((doc_id, len(ids), hashlib.sha256(raw).hexdigest(),
                         hashlib.sha256(decoded.encode()).hexdigest()))
    assert tables.rows_of(bpe.round_trip_digests(docs, PATH)) == sorted(expected, key=repr)
    both = bpe.encode_decode(docs, PATH).collect()
    assert all(library.decode(r.ids, skip_special_tokens=False) == r.decoded for r in both)
    assert bpe.round_trip_digests(tables.documents(spark, []), PATH).collect() == []


def test_wavelet_matrix_answers():
    rng = np.random.default_rng(1)
    for size, kinds in ((0, 1), (1, 1), (700, 3), (5000, 40_000), (3000, 90_000)):
        ids = rng.integers(0, kinds, size).astype(np.uint32)
        known = np.array([True, False])
        payload = wavelet.WaveletMatrix.write(ids, np.array([4, 0]), known, np.array([size, size]))
        shard = wavelet.WaveletMatrix.read(payload)
        assert (shard.tokens() == ids).all()
        assert shard.docs.tolist() == [4, None]
        at = rng.integers(0, max(size, 1), 50)[:size]
        assert (shard.access(at) == ids[at]).all()
        for token in {*ids[:20].tolist(), 99_999}:
            places = np.flatnonzero(ids == token)
            assert shard.count(token) == len(places)
            assert shard.count(token, size // 2) == (places < size // 2).sum()
            for nth in {0, len(places) // 2, len(places) - 1, len(places)} - {-1}:
                expected = places[nth] if nth < len(places) else -1
                assert shard.locate(token, nth) == expected


@pytest.mark.parametrize("shard_tokens", [1, 300, 1 << 20])
def test_shards_follow_doc_id(spark, library, shard_tokens):
    docs = tables.with_clashes(tables.documents(spark), "part", "payload", "shard")
    out = wavelet.scratch_shards(spark)
    shards = wavelet.write_shards(docs.repartition(3), PATH, out, shard_tokens=shard_tokens)
    found = wavelet.document_checks(shards).orderBy("start").collect()
    keys = [(-1 if r.doc_id is None else r.doc_id) for r in found]
    assert keys == sorted(keys) and len(found) == len(tables.ODD)
    texts = {doc_id: text for doc_id, text, *_ in tables.ODD if doc_id is not None}
    start = 0
    for row in found:
        assert row.start == start
        start += row.n_tokens
        if row.doc_id is not None:
            ids = library.encode(texts[row.doc_id] or "", add_special_tokens=False).ids + [2]
            assert row.n_tokens == len(ids)
            assert row.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
    read = {r.doc_id: r.ids for r in wavelet.read_documents(shards).collect()}
    assert read[4] == library.encode("one", add_special_tokens=False).ids + [2]


def test_no_documents_no_shards(spark):
    shards = wavelet.write_shards(
        tables.documents(spark, []), PATH, wavelet.scratch_shards(spark)
    )
    assert wavelet.document_checks(shards).collect() == []
