from __future__ import annotations

import random

import llm_tables as tables
import numpy as np
import pytest

from clientela.llm import neardup
from clientela.llm.components import smallest_reachable


def shingles(text, size):
    words = tables.WORD.findall((text or "").encode().lower().decode())
    size = min(size, len(words))
    return {tuple(words[k : k + size]) for k in range(len(words) - size + 1)} if words else set()


def expected(rows, size, percent=80):
    sets = {}
    for doc_id, text, *_ in rows:
        if doc_id is not None:
            sets[doc_id] = shingles(text, size)
    root = {doc_id: doc_id for doc_id in sets}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            shared = len(sets[a] & sets[b])
            if shared and 100 * shared >= percent * len(sets[a] | sets[b]):
                x, y = sorted((top(a), top(b)))
                root[y] = x
    return sorted(((i, len(sets[i]), top(i)) for i in ids), key=repr)


def near_group(rng, first, members, words, edits, base=None):
    """Copies of one text with some words changed: some are linked, some only nearly."""
    base = base or [f"w{rng.randint(0, 10**6)}" for _ in range(words)]
    for k in range(members):
        text = list(base)
        for _ in range(rng.randint(0, edits)):
            text[rng.randrange(words)] = f"x{rng.randint(0, 10**6)}"
        yield (first + k, " ".join(text), "en", "a", 1)


@pytest.mark.parametrize("size", [2, 5])
def test_odd_rows(spark, size):
    docs = tables.with_clashes(tables.documents(spark), "hub", "root", "bucket", "digest", "a")
    found = neardup.near_duplicates(docs, neardup.NearDup(shingle=size))
    assert tables.rows_of(found) == expected(tables.ODD, size)
    none = neardup.near_duplicates(tables.documents(spark, []), neardup.NearDup(shingle=size))
    assert none.collect() == []


def test_groups_against_all_pairs(spark, monkeypatch):
    """Near copies around the bound, exact copies, chains, in several blocks."""
    monkeypatch.setattr(neardup, "BLOCK", 16)
    rng = random.Random(4)
    rows = list(near_group(rng, 0, 120, 60, 9))
    rows += near_group(rng, 1000, 40, 25, 3)
    rows += [(2000 + k, rows[5][1], "en", "a", 1) for k in range(50)]
    rows += [(3000 + k, f"few words {k % 3}", "en", "a", 1) for k in range(9)]
    chain = [f"c{k}" for k in range(200)]
    rows += [(4000 + k, " ".join(chain[4 * k : 4 * k + 60]), "en", "a", 1) for k in range(30)]
    rng.shuffle(rows)
    found = neardup.near_duplicates(tables.documents(spark, rows), neardup.NearDup(shingle=2))
    assert tables.rows_of(found) == expected(rows, 2)


def test_pruning_keeps_what_reaches_the_bound():
    cfg = neardup.NearDup()
    bounds = neardup.least_matches(cfg)
    assert len(bounds) == cfg.hashes // cfg.batch and list(bounds) == sorted(bounds)
    rng = np.random.default_rng(2)
    left = rng.integers(0, 256, (4000, cfg.hashes), np.uint8)
    for similarity, kept in ((0.8, 1.0), (0.3, 0.0)):
        same = rng.random(left.shape) < similarity
        right = np.where(same, left, rng.integers(0, 256, left.shape, np.uint8))
        share = len(neardup.survivors(left, right, cfg)) / len(left)
        assert abs(share - kept) < 0.001


def test_components_of_chains_and_stars(spark):
    links = [(k, k + 1) for k in range(40)] + [(1000, k) for k in range(900, 950)] + [(7, 7), (3, 2)]
    found = smallest_reachable(spark.createDataFrame(links, "a long, b long"))
    roots = {k: 0 for k in range(41)} | {k: 900 for k in [*range(900, 950), 1000]}
    assert {r.node: r.root for r in found.collect()} == roots
    assert smallest_reachable(spark.createDataFrame([], "a long, b long")).collect() == []
