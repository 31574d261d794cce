"""Merkle manifest, conversation trie and preference scores against plain versions."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import llm_tables as tables
import numpy as np
import pytest
from pyspark.sql import functions as F

from clientela.functions.storage import materialise
from clientela.llm import merkle, preference, queries, trie
from clientela.llm.quality import COUNTS, document_counts


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# Merkle manifest --------------------------------------------------------------------------


def leaf(row, n_chars):
    def field(value):
        return "-" if value is None else f"{len(str(value).encode())}:{value}"

    doc_id, text, lang, source, _ = row
    return sha("".join(field(v) for v in (doc_id, source, lang, n_chars, text)))


def climbed(digests):
    """Levels of a tree of runs of two, leaves first."""
    levels = [digests]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([sha("".join(last[k : k + 2])) for k in range(0, len(last), 2)])
    return levels


def walk(levels, place, node):
    """Siblings of a leaf, and the root that ``node`` in its place gives."""
    proof = ""
    for level in levels[:-1]:
        run = place - place % 2
        left = "".join(level[run:place])
        right = "".join(level[place + 1 : run + 2])
        proof += left + right
        node = sha(left + node + right)
        place //= 2
    return proof, node


def plain_proofs(rows):
    by_lang = defaultdict(list)
    for row in rows:
        by_lang[row[2]].append(row)
    order = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in order:
        own = sorted(by_lang[lang], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[4])))
        trees[lang] = own, climbed([leaf(r, r[4]) for r in own])
    top = climbed([trees[lang][1][-1][0] for lang in order])
    for number, lang in enumerate(order):
        own, levels = trees[lang]
        for place, row in enumerate(own):
            n = row[4]
            if n is not None and row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0:
                n += 1
            low, subroot = walk(levels, place, leaf(row, n))
            high, root = walk(top, number, subroot)
            yield (row[0], levels[0][place], levels[-1][0], top[-1][0], sha(low + high), root,
                   root == top[-1][0])


def found_proofs(docs, bits):
    changed = merkle.tampered(F.col("doc_id"), F.col("n_chars"))
    return tables.rows_of(merkle.proofs(docs, changed, bits))


@pytest.mark.parametrize("bits", [2, merkle.BITS])
def test_proofs(spark, bits):
    rng = random.Random(4)
    langs = [None, "", "en", "de", "é", "z"] + [f"l{k}" for k in range(8)]
    rows = [
        (k, f"text {k}", "en" if k % 3 else rng.choice(langs), "s", rng.choice([None, k]))
        for k in range(90)
    ]
    rows += tables.ODD
    docs = tables.documents(spark, rows)
    expected = sorted(plain_proofs(rows), key=repr)
    assert found_proofs(docs, bits) == expected
    assert {r[-1] for r in expected} == {True, False}
    clashing = tables.with_clashes(docs, "tree", "place", "path", "node", "block", "leaf", "root")
    assert found_proofs(clashing, bits) == expected


def test_proofs_of_small_tables(spark):
    assert found_proofs(tables.documents(spark, []), 2) == []
    for n in (1, 2, 3, 5):
        rows = [(k, "t", "en", None, 1) for k in range(n)]
        assert found_proofs(tables.documents(spark, rows), 2) == sorted(plain_proofs(rows), key=repr)
    ((doc_id, own, subroot, root, proof, _, _),) = found_proofs(
        tables.documents(spark, [(1, "t", "en", None, None)]), 2
    )
    assert own == subroot == root and proof == sha("")


# Conversation trie ------------------------------------------------------------------------

TURNS = "conv_id long, turn long, role string, text string"


def plain_trie(sequences):
    members = defaultdict(list)
    for conv, turns in sequences.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(conv)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)

    def below(node):
        yield node
        for child in children[node]:
            yield from below(child)

    for node, own in members.items():
        sub = list(below(node))
        ends = sorted(c for c in own if len(sequences[c]) == len(node))
        yield (
            min(own), len(node), min(members[node[:-1]]) if node else None, len(own),
            len(children[node]), sum(not children[n] for n in sub),
            sum((len(members[n]) - 1) * len(n[-1][1].encode()) for n in sub if n),
            sha(",".join(map(str, ends))),
        )


def plain_sequences(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            key = (role or "", text or "")
            tie = sha(f"{len(key[0].encode())}:" + "".join(key))
            turns[conv].append(((turn is not None, turn or 0), tie, key))
    return {conv: [k for _, _, k in sorted(own)] for conv, own in turns.items()}


def plain_rebuilt(sequences):
    for conv, own in sequences.items():
        h = zlib.crc32(str(conv).encode()) % 9
        yield conv, sequences.get(conv - conv % 5, [])[:h] + own[h:]


def random_turns(n, seed=8):
    rng = random.Random(seed)
    for conv in range(n):
        if conv % 11 == 3:
            continue
        # A third of all conversations are copies, and most begin alike.
        words = ["a"] * 6 if conv % 3 == 0 else ["a"] + [rng.choice("abé") for _ in range(rng.randrange(6))]
        for turn, word in enumerate(words):
            yield conv, turn, "user" if turn % 2 == 0 else "bot", word * 3


ODD_TURNS = [
    (500, None, None, None), (500, 0, "user", ""), (500, 0, "bot", "x"), (500, 0, "bot", "x"),
    (501, 1, "", "y" * 50_000), (502, None, "user", "z"), (502, None, "user", "a"),
    (None, 0, "user", "lost"), (503, 7, "user", None), (507, 0, "user", "one turn"),
]


@pytest.mark.parametrize("range_turns", [40, 100_000])
def test_trie(spark, range_turns):
    rows = [*random_turns(200), *ODD_TURNS]
    turns = spark.createDataFrame(rows, TURNS).repartition(5)
    sequences = materialise(trie.sequences(turns), "seq")
    expected = sorted(plain_trie(plain_sequences(rows)), key=repr)
    assert tables.rows_of(trie.trie(sequences, range_turns)) == expected
    clashing = tables.with_clashes(turns, "key", "sizes", "node", "rows", "depth")
    again = materialise(queries.rebuilt_conversations(clashing), "rebuilt")
    rebuilt = dict(plain_rebuilt(plain_sequences(rows)))
    assert tables.rows_of(trie.trie(again, range_turns)) == sorted(plain_trie(rebuilt), key=repr)


def test_trie_of_copies_and_nothing(spark):
    empty = spark.createDataFrame([], TURNS)
    assert trie.trie(materialise(trie.sequences(empty), "seq")).collect() == []
    # One group of equal conversations over all ranges, its numbers in many chunks.
    rows = [(conv, turn, "user", f"t{turn}") for conv in range(1500) for turn in range(3)]
    turns = spark.createDataFrame(rows, TURNS)
    found = tables.rows_of(trie.trie(materialise(trie.sequences(turns), "seq"), 300))
    everyone = {conv: [("user", f"t{t}") for t in range(3)] for conv in range(1500)}
    assert found == sorted(plain_trie(everyone), key=repr)


# Preference scores ------------------------------------------------------------------------


def labelled(spark):
    rng = random.Random(6)
    rows, labels = [], []
    for k in range(240):
        good = k % 4 != 0
        words = [rng.choice(["the", "river", "and", "stone", "over", "light"]) for _ in range(60)]
        text = " ".join(words) if good else " ".join(w + "$$$" for w in words)
        rows.append((k, text, "en", "s", len(text)))
        labels.append((k, int(good), 0))
    labels += [(1, 7, 0), (None, 1, 0), (9999, 0, 0), (5, None, None)]
    return rows, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_preference_scores(spark):
    rows, labels = labelled(spark)
    docs = tables.documents(spark, rows + tables.ODD[:1] + tables.ODD[11:])
    teaches = F.col("doc_id") % 3 != 1
    found = preference.ranked(docs, labels, teaches).collect()
    assert len(found) == len(rows) + 4 and all(0 <= r.score <= 1 for r in found)
    by_id = {r.doc_id: r.score for r in found}
    assert all((by_id[k] >= 0.5) == (k % 4 != 0) for k in range(12, 240))
    clashing = tables.with_clashes(docs, "score", "n_words", "quality")
    again = preference.ranked(clashing.repartition(7), labels, teaches)
    assert tables.rows_of(again) == sorted((tuple(r) for r in found), key=repr)


def test_threshold_is_the_quantile_of_the_bad_share(spark):
    rows, labels = labelled(spark)
    counts = materialise(document_counts(tables.documents(spark, rows)), "counts")
    model = preference.fit(counts, labels, F.lit(True))
    table = counts.toPandas()
    margins = np.sort(model.margin(preference.feature_rows({c: table[c].to_numpy() for c in COUNTS})))
    assert model.threshold == pytest.approx((margins[59] + margins[60]) / 2, abs=1e-12)


def test_weights_minimise_the_pairwise_loss():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 4)) + np.array([0.8, 0.0, -0.5, 0.2])
    w = preference.bradley_terry(x, 2.0, 50)
    slope = -(x.T @ (1 / (1 + np.exp(x @ w)))) + 2.0 * w
    assert np.abs(slope).max() < 1e-4
    assert w[0] > 0 > w[2]


def test_every_labelled_row_is_in_a_pair():
    good = np.array([1] * 7 + [0] * 3)
    better, worse = preference._pairs(good, preference.RankConfig(pairs=5))
    assert set(better) == set(range(7)) and set(worse) == {7, 8, 9}


def test_labels_of_one_kind(spark):
    rows, labels = labelled(spark)
    docs = tables.documents(spark, rows[:5])
    only = labels.filter("quality = 1")
    assert {r.score for r in preference.ranked(docs, only, F.lit(True)).collect()} == {1.0}
    nothing = labels.limit(0)
    assert {r.score for r in preference.ranked(docs, nothing, F.lit(True)).collect()} == {0.5}
    assert preference.ranked(docs.limit(0), labels, F.lit(True)).collect() == []
