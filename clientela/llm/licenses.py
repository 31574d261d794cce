"""License notices in documents, by MinHash bands over overlapping word windows.

For a template of m words, windows of 2m words start at every m-th word, so any m
words in a row lie inside one window. A window's MinHash values are compared with
those of the template; one band holds one value, so a window that contains
``percent`` of the template's shingles (a Jaccard similarity of at least 0.3)
misses all ``bands`` with probability (1 - 0.3)^bands, 7e-7 for 40. Retrieved
windows are verified: the number of the template's shingles that the window holds
is counted exactly.

Before that, documents and windows that cannot contain the template are left out:
each template has anchors, words in so many of its shingles together that a window
without any of them cannot hold enough. Everything is a DataFrame expression.

Words are compared without the punctuation at their ends, on both sides. A word of
punctuation alone (a comment mark, a bullet) has its place in a window's width but
is in no shingle, so it does not part the words around it; a notice with c such
marks in it can lose up to c words at the border of a window.

Defined results: null, empty and blank texts hold no license; texts shorter than
a template can still hold enough of it; repeated rows are one document; a notice
that stands in a document several times is one row with its count of windows; an
empty table gives an empty table; other columns are not looked at.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

SPACE = "[ \\t-\\r]+"
RARE = 7  # letters of a word that few texts have
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~“”„‘’‚«»‹›–—…•·©"


@dataclass(frozen=True)
class ScanConfig:
    shingle: int = 3
    percent: int = 80
    bands: int = 40


@dataclass(frozen=True)
class Template:
    name: str
    text: str

    def words(self) -> list[str]:
        return self.text.translate(str.maketrans(UPPER, UPPER.lower())).split()

    def shingles(self, size: int) -> list[str]:
        w = self.words()
        size = min(size, len(w))
        return sorted({" ".join(w[k : k + size]) for k in range(len(w) - size + 1)})

    def least(self, cfg: ScanConfig) -> int:
        """Shingles that a window must hold."""
        return -(-cfg.percent * len(self.shingles(cfg.shingle)) // 100)

    def bare(self) -> Template:
        """The template without punctuation at the ends of words."""
        words = (w.strip(PUNCTUATION) for w in self.words())
        return Template(self.name, " ".join(w for w in words if w))

    def anchors(self, cfg: ScanConfig) -> list[str]:
        """Words of which a window with enough shingles has at least one: a long one that
        is enough alone, or else the longest ones together."""
        shingles = [set(s.split(" ")) for s in self.shingles(cfg.shingle)]
        spare = len(shingles) - self.least(cfg)
        longest = sorted(set(self.words()), key=lambda w: (len(w), w), reverse=True)
        for word in (w for w in longest if len(w) >= RARE):
            if sum(word in s for s in shingles) > spare:
                return [word]
        for k in range(1, len(longest) + 1):
            if sum(not s.isdisjoint(longest[:k]) for s in shingles) > spare:
                return longest[:k]
        raise ValueError(f"template {self.name} has no words")


# One-line notices, as the test tables have them. The check SQL knows these.
TEMPLATES = (
    Template("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    Template("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    Template("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    Template("MIT", "Released under the MIT License."),
)

_BSD_CONDITIONS = """
Redistribution and use in source and binary forms, with or without modification, are permitted
provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions
and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions
and the following disclaimer in the documentation and/or other materials provided with the
distribution."""
_BSD_NAMES = """
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse
or promote products derived from this software without specific prior written permission."""
_BSD_DISCLAIMER = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED
WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A
PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE
FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT
LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS
INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR
TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF
ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""


def _gnu(license: str, version: str) -> str:
    return f"""
This program is free software; you can redistribute it and/or modify it under the terms of the GNU
{license} as published by the Free Software Foundation; either version {version} of the License, or
(at your option) any later version.
This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even
the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {license} for
more details."""


# Notices and headers that the licenses themselves ask for, without the lines that name an owner.
# A text that is most of another one (BSD, GNU) is found with it; the containment tells them apart.
WHOLE_NOTICES = tuple(Template(name, text).bare() for name, text in (
    ("MIT-notice", """
Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction, including
without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the
following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial
portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT
LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO
EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER
IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR
THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("BSD-2-Clause-notice", _BSD_CONDITIONS + _BSD_DISCLAIMER),
    ("BSD-3-Clause-notice", _BSD_CONDITIONS + _BSD_NAMES + _BSD_DISCLAIMER),
    ("ISC-notice", """
Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE
INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE
FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS
OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING
OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
    ("Apache-2.0-header", """
Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
compliance with the License. You may obtain a copy of the License at
http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is
distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and limitations under the License."""),
    ("MPL-2.0-header", """
This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL
was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."""),
    ("GPL-2.0-header", _gnu("General Public License", "2")),
    ("GPL-3.0-header", _gnu("General Public License", "3")),
    ("LGPL-2.1-header", _gnu("Lesser General Public License", "2.1")),
    ("LGPL-3.0-header", _gnu("Lesser General Public License", "3")),
    ("AGPL-3.0-header", _gnu("Affero General Public License", "3")),
    ("CC-BY-4.0-notice",
     "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0-notice",
     "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
))
ALL_TEMPLATES = TEMPLATES + WHOLE_NOTICES


def text_words(text: Column) -> Column:
    """Words in lower case (A-Z) without punctuation at their ends; empty if they are nothing else."""
    lowered = F.translate(F.coalesce(text, F.lit("")), UPPER, UPPER.lower())
    words = F.filter(F.split(lowered, SPACE), lambda w: w != "")
    return F.transform(words, lambda w: F.btrim(w, F.lit(PUNCTUATION)))


def _windows(words: Column, length: int) -> Column:
    """Windows of twice the length, one starting at every ``length``-th word."""
    starts = F.sequence(F.lit(0), F.greatest(F.size(words) - 1, F.lit(0)), F.lit(length))
    return F.transform(
        starts, lambda at: F.struct(at.alias("start"), F.slice(words, at + 1, 2 * length).alias("w"))
    )


def _with_one_of(windows: Column, anchors: list[str]) -> Column:
    wanted = F.array(*(F.lit(anchor) for anchor in anchors))
    return F.filter(windows, lambda x: F.arrays_overlap(x["w"], wanted))


def _shaped(windows: Column, length: int, size: int) -> Column:
    """The windows with the length and the shingle size of their templates."""
    shape = (F.lit(length).alias("length"), F.lit(size).alias("size"))
    return F.transform(
        windows, lambda x: F.struct(*shape, x["start"].alias("start"), x["w"].alias("w"))
    )


def _shingles(words: Column, size: Column) -> Column:
    last = F.size(words) - size
    return F.when(
        last >= 0,
        F.array_distinct(F.transform(
            F.sequence(F.lit(1), last + 1), lambda k: F.array_join(F.slice(words, k, size), " ")
        )),
    ).otherwise(F.array().cast("array<string>"))


def _bands(shingles: Column, bands: int) -> Column:
    """The smallest hash of the shingles under each of several hashes, with its number."""
    return F.transform(
        F.sequence(F.lit(0), F.lit(bands - 1)),
        lambda k: F.xxhash64(k, F.array_min(F.transform(shingles, lambda s: F.xxhash64(k, s)))),
    )


def template_table(docs: DataFrame, templates: tuple[Template, ...], cfg: ScanConfig) -> DataFrame:
    """One row per template: as small as the list that is passed."""
    rows = [
        F.struct(
            F.lit(t.name).alias("license"),
            F.lit(len(t.words())).alias("length"),
            F.lit(t.least(cfg)).alias("least"),
            F.array(*(F.lit(s) for s in t.shingles(cfg.shingle))).alias("parts"),
        )
        for t in templates
    ]
    return docs.sparkSession.range(1).select(F.inline(F.array(*rows)))


def scan_licenses(
    docs: DataFrame,
    templates: tuple[Template, ...] = ALL_TEMPLATES,
    cfg: ScanConfig = ScanConfig(),
) -> DataFrame:
    """doc_id, license, n_found, n_template, containment, first_word and n_windows.

    ``n_found`` counts the template's shingles in the best window, ``first_word`` is
    where the first such window starts, ``n_windows`` how many windows hold enough.
    """
    templates = tuple(t.bare() for t in templates)
    known = template_table(docs, templates, cfg)
    lowered = F.lower(F.col("text"))
    could = F.lit(False)
    for anchor in sorted({anchor for t in templates for anchor in t.anchors(cfg)}):
        could = could | lowered.contains(anchor)
    texts = docs.filter(F.col("doc_id").isNotNull() & could).select(
        "doc_id", text_words(F.col("text")).alias("words")
    )
    shaped = []
    for length in sorted({len(t.words()) for t in templates}):
        own = sorted({a for t in templates if len(t.words()) == length for a in t.anchors(cfg)})
        size = min(cfg.shingle, length)
        shaped.append(_shaped(_with_one_of(_windows(F.col("words"), length), own), length, size))
    # All lengths in one pass over the documents.
    windows = texts.select("doc_id", F.explode(F.concat(*shaped)).alias("x")).select(
        "doc_id", "x.length", "x.size", "x.start", F.filter("x.w", lambda w: w != "").alias("w")
    )
    windows = windows.select(
        "doc_id", "length", "start", _shingles(F.col("w"), F.col("size")).alias("held")
    )
    keyed = windows.filter(F.size("held") > 0).withColumn(
        "band", F.explode(F.array_distinct(_bands(F.col("held"), cfg.bands)))
    )
    buckets = known.select(
        "license", F.col("length").alias("own_length"), "least", "parts",
        F.explode(_bands(F.col("parts"), cfg.bands)).alias("band"),
    )
    # One row per template and band, from a list that the caller passes.
    met = keyed.join(F.broadcast(buckets), "band").filter(F.col("length") == F.col("own_length"))
    verified = met.withColumn("n", F.size(F.array_intersect("held", "parts"))).filter(
        F.col("n") >= F.col("least")
    )
    return (
        verified.groupBy("doc_id", "license")
        .agg(
            F.max("n").cast("long").alias("n_found"),
            F.max(F.size("parts")).cast("long").alias("n_template"),
            F.min("start").cast("long").alias("first_word"),
            F.count_distinct("start").alias("n_windows"),
        )
        .withColumn("containment", F.round(F.col("n_found") / F.col("n_template"), 6))
    )
