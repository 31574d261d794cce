"""License scan and mixture: DataFrame expressions only."""

from __future__ import annotations

import os
import random
from collections import defaultdict

import llm_tables as tables
import pytest
from pyspark.sql import functions as F

from clientela.llm import licenses, mixing


def plain_scan(rows, templates, cfg):
    out = set()
    for doc_id, text, *_ in rows:
        words = tables.WORD.findall((text or "").lower())
        for t in templates:
            m, parts = len(t.words()), set(t.shingles(cfg.shingle))
            size, counts = min(cfg.shingle, m), {}
            for start in range(0, len(words), m):
                w = words[start : start + 2 * m]
                held = {" ".join(w[k : k + size]) for k in range(len(w) - size + 1)}
                if len(held & parts) >= t.least(cfg):
                    counts[start] = len(held & parts)
            if counts and doc_id is not None:
                best = max(counts.values())
                out.add((doc_id, t.name, best, len(parts), min(counts), len(counts),
                         round(best / len(parts), 6)))
    return sorted(out, key=repr)


def test_licenses_against_all_windows(spark):
    rng = random.Random(1)
    cfg = licenses.ScanConfig()
    templates = (*licenses.TEMPLATES, licenses.Template("two", "Public  domain"), licenses.Template(
        "long", " ".join(f"clause{k} holds" for k in range(40))))
    rows = list(tables.ODD)
    for k in range(100, 220):
        words = [rng.choice(["license", "under", "the", "licensed", "a", "b", "version"])
                 for _ in range(rng.randint(0, 60))]
        for _ in range(rng.randint(0, 3)):
            notice = rng.choice(templates).text.split()
            for _ in range(rng.randint(0, 2)):
                notice[rng.randrange(len(notice))] = "changed"
            at = rng.randint(0, len(words))
            words[at:at] = notice
        rows.append((k, rng.choice([" ", "\n", " \t"]).join(words), "en", "a", 1))
    rows.append(rows[20])
    docs = tables.with_clashes(tables.documents(spark, rows), "license", "words", "band", "n")
    found = licenses.scan_licenses(docs, templates, cfg)
    assert tables.rows_of(found) == plain_scan(rows, templates, cfg)
    plan = found._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
    assert licenses.scan_licenses(tables.documents(spark, []), templates).collect() == []


MIT = """
 * Permission is hereby granted, free of charge, to any person obtaining a copy
 * of this software and associated documentation files (the "Software"), to deal
 * in the Software without restriction, including without limitation the rights
 * to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
 * copies of the Software, and to permit persons to whom the Software is
 * furnished to do so, subject to the following conditions:
 *
 * The above copyright notice and this permission notice shall be included in
 * all copies or substantial portions of the Software.
 *
 * THE SOFTWARE IS PROVIDED “AS IS”, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
 * IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
 * FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
 * AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
 * LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
 * OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN
 * THE SOFTWARE.
 */"""
APACHE = """
# Licensed under the Apache License, Version 2.0 (the "License");
# you may not use this file except in compliance with the License.
# You may obtain a copy of the License at
#
#     http://www.apache.org/licenses/LICENSE-2.0
#
# Unless required by applicable law or agreed to in writing, software
# distributed under the License is distributed on an "AS IS" BASIS,
# WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
# See the License for the specific language governing permissions and
# limitations under the License."""


@pytest.mark.parametrize("before", [0, 3, 50, 101])
def test_licenses_as_they_are_written(spark, before):
    texts = {
        "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0, see the site",
        "MIT": "(Released under the MIT License)",
        "Apache-2.0": "Licensed under the Apache License Version 2.0",
        "GPL-3.0": "This work is licensed under the GNU General Public License version 3;",
        "MIT-notice": MIT,
        "Apache-2.0-header": APACHE,
    }
    rows = [(k, "word " * before + text + " and more", "en", "a", 1)
            for k, text in enumerate(texts.values())]
    rows.append((99, "the license of the software is not known, without warranty", "en", "a", 1))
    found = defaultdict(set)
    for row in licenses.scan_licenses(tables.documents(spark, rows)).collect():
        found[row.doc_id].add(row.license)
    assert all(name in found[k] for k, name in enumerate(texts)), found
    assert 99 not in found


def test_every_whole_notice_is_found(spark):
    rows = [(k, f"some words {t.text} more", "en", "a", 1) for k, t in enumerate(licenses.ALL_TEMPLATES)]
    best = {}
    for row in licenses.scan_licenses(tables.documents(spark, rows)).collect():
        if row.containment == 1:
            best.setdefault(row.doc_id, set()).add(row.license)
    assert all(t.name in best[k] for k, t in enumerate(licenses.ALL_TEMPLATES))
    assert {"MIT-notice", "BSD-3-Clause-notice", "ISC-notice", "MPL-2.0-header", "GPL-3.0-header"} <= {
        t.name for t in licenses.ALL_TEMPLATES
    }


def table_of(spark):
    rng = random.Random(2)
    rows = []
    for k in range(900):
        text = " ".join(["word"] * rng.randint(1, 400)) + rng.choice(["", " | x", " !!"])
        source = "hot" if k % 3 else f"s{k % 4}"
        rows.append((1000 + k, text, rng.choice(["en", "de", None]), source, 1))
    return rows


def test_targets_are_met(spark):
    cfg = mixing.MixConfig()
    cells = mixing.raked_cells(mixing.with_cell(tables.documents(spark, table_of(spark))), cfg)
    cells = cells.toPandas()
    assert abs(cells.weight.sum() - 1) < 1e-9
    for name, target in cfg.targets.items():
        tokens = cells.groupby(f"_{name}", dropna=False).tokens.sum() ** target.power
        have = cells.groupby(f"_{name}", dropna=False).weight.sum()
        wish = tokens / tokens.sum()
        assert (abs(have - wish) < 1e-3).all()
        # What is drawn has the shares, not only the weights before a cut at one.
        drawn = (cells.tokens * cells.probability).groupby(cells[f"_{name}"], dropna=False).sum()
        assert (abs(drawn / drawn.sum() - have) < 1e-6).all()
    expected = (cells.tokens * cells.probability).sum()
    assert abs(expected - cfg.budget * cells.tokens.sum()) < 1e-3 * cells.tokens.sum()
    assert cells.probability.between(0, 1).all()


def test_shares_of_all_documents(spark):
    folder = "/root/testdata/sf0.1"
    if not os.path.isdir(folder):
        pytest.skip("test tables are not here")
    cfg = mixing.MixConfig()
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    cells = mixing.raked_cells(mixing.with_cell(docs), cfg).toPandas()
    drawn = cells.tokens * cells.probability
    assert (cells.probability == 1).sum() > 50  # many cells give all they have
    assert abs(drawn.sum() / cells.tokens.sum() - cfg.budget) < 1e-6
    for name, target in cfg.targets.items():
        wish = cells.groupby(f"_{name}", dropna=False).tokens.sum() ** target.power
        have = drawn.groupby(cells[f"_{name}"], dropna=False).sum() / drawn.sum()
        assert (abs(have / (wish / wish.sum()) - 1) < 1e-3).all()


def test_wishes_beyond_what_there_is(spark):
    """A value that is asked for more than it has gives all of it; contradictions are told."""
    rows = [(k, "word " * (1 if k < 5 else 100), "en", "small" if k < 5 else f"s{k % 2}", 1)
            for k in range(200)]
    cells = mixing.raked_cells(mixing.with_cell(tables.documents(spark, rows))).toPandas()
    drawn = (cells.tokens * cells.probability).groupby(cells._source).sum()
    assert drawn["small"] == pytest.approx(5)
    assert drawn.sum() == pytest.approx(cells.tokens.sum() / 2)
    assert drawn["s0"] / drawn["s1"] == pytest.approx((97 / 98) ** 0.5, rel=1e-6)
    # Two sources of one language each, whose targets pull apart.
    apart = [(k, "word " * 100, "en" if k % 3 else "de", "a" if k % 3 else "b", 1) for k in range(90)]
    docs = mixing.with_cell(tables.documents(spark, apart))
    cfg = {"source": mixing.Target(0.0), "lang": mixing.Target(1.0), "topic": mixing.Target(1.0)}
    cells = mixing.raked_cells(docs, mixing.MixConfig(targets=cfg, rounds=6)).toPandas()
    assert (cells["miss"] > 0.1).all() and cells.probability.between(0, 1).all()
    with pytest.raises(ValueError, match="cannot be met"):
        mixing.raked_cells(docs, mixing.MixConfig(targets=cfg, rounds=6, strict=True))


def test_cells_of_one_task_and_of_many(spark, monkeypatch):
    """Sums by windows in one task and sums by a shuffle take the same steps."""
    cells = mixing.with_cell(tables.documents(spark, table_of(spark)[:300] + tables.ODD))
    one = sorted(mixing.raked_cells(cells).collect(), key=str)
    monkeypatch.setattr(mixing, "CELLS_OF_A_TASK", 4)
    assert len(one) > 8 and sorted(mixing.raked_cells(cells).collect(), key=str) == one


def test_null_is_not_a_name(spark):
    rows = [(k, "word " * 50, "en", "(none)" if k % 4 else None, 1) for k in range(80)]
    cells = mixing.raked_cells(mixing.with_cell(tables.documents(spark, rows))).collect()
    assert {c._source: c.documents for c in cells} == {None: 20, "(none)": 60}


def test_a_topic_that_the_caller_knows(spark):
    docs = tables.documents(spark, table_of(spark)).withColumn("subject", F.col("doc_id") % 2)
    cfg = mixing.MixConfig(budget=0.2, targets={
        "topic": mixing.Target(shares={0: 0.9, 1: 0.1}),
    })
    kept = mixing.mixed(docs, cfg, F.col("subject"))
    assert kept.columns == docs.columns
    sides = dict(kept.groupBy("subject").count().collect())
    assert sides[0] > 5 * sides[1]


def test_given_shares(spark):
    shares = {"hot": 0.1, "s0": 0.6, "nowhere": 0.3}
    cfg = mixing.MixConfig(targets={
        "source": mixing.Target(shares=shares), "lang": mixing.Target(1.0), "topic": mixing.Target(1.0),
    }, rounds=60)
    docs = mixing.with_cell(tables.documents(spark, table_of(spark)))
    with pytest.raises(ValueError, match="cannot be met"):  # s0 has a twelfth of all tokens
        mixing.raked_cells(docs, cfg)
    with pytest.raises(ValueError, match="no value of source"):
        alone = {"source": mixing.Target(shares={"nowhere": 1.0})}
        mixing.raked_cells(docs, mixing.MixConfig(targets=alone))
    cfg = mixing.MixConfig(targets=cfg.targets, budget=0.05)
    cells = mixing.raked_cells(docs, cfg)
    have = defaultdict(float)
    for row in cells.collect():
        have[row._source] += row.weight
    assert abs(have["hot"] - 1 / 7) < 1e-6 and abs(have["s0"] - 6 / 7) < 1e-6
    assert have["s1"] == 0


def test_mixture_of_odd_rows(spark):
    rows = table_of(spark)[:200] + tables.ODD
    docs = tables.documents(spark, rows)
    kept = mixing.mixed(docs)
    assert kept.columns == docs.columns
    assert set(tables.rows_of(kept)) <= set(rows)
    again = mixing.mixed(docs.repartition(7))
    assert tables.rows_of(kept) == tables.rows_of(again)
    sixes = [r for r in kept.collect() if r.doc_id == 6]
    assert len(sixes) in (0, 2)
    clashing = tables.with_clashes(docs, "_tokens", "tokens", "row", "weight", "_kept", "scale")
    assert tables.rows_of(mixing.mixed(clashing).select(docs.columns)) == tables.rows_of(kept)
    assert mixing.mixed(clashing).columns == clashing.columns
    assert mixing.mixed(tables.documents(spark, [])).collect() == []
    blank = tables.documents(spark, [tables.ODD[0], tables.ODD[1], tables.ODD[2]])
    assert mixing.mixed(blank).count() in range(4)


def test_draws_follow_the_probability(spark):
    drawn = spark.range(20_000).select(mixing.draw(F.col("id"), 3).alias("u"))
    low, high, mean = drawn.agg(F.min("u"), F.max("u"), F.avg("u")).first()
    assert 0 <= low and high < 1 and abs(mean - 0.5) < 0.02


@pytest.mark.parametrize("text, topic", [("a | b", "table"), ("NO!!", "shout"), ("a", "short"), (None, "short")])
def test_topics(spark, text, topic):
    row = mixing.with_cell(tables.documents(spark, [(1, text, None, None, 1)])).first()
    assert (row._topic, row._source, row._lang) == (topic, None, None)
