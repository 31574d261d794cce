from __future__ import annotations

import os
import re
from collections import defaultdict

import llm_tables as tables
import pytest
from pyspark.sql import functions as F

from clientela.llm import linededup, urlfilter
from clientela.llm.queries import BLOCKED_HOSTS, URL_RULES

BLANK = " \t\n\x0b\x0c\r"


def key_of(line):
    return re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(BLANK))


def expected_texts(rows, min_chars=40, min_docs=5):
    owners = defaultdict(set)
    for doc_id, text, *_ in rows:
        if doc_id is not None:
            for line in (text or "").split("\n"):
                owners[key_of(line)].add(doc_id)
    busy = {k: max(v) for k, v in owners.items() if len(k) >= min_chars and len(v) >= min_docs}
    out = []
    for doc_id, text, *rest in rows:
        if text is not None and doc_id is not None:
            text = "\n".join(
                line for line in text.split("\n") if busy.get(key_of(line), doc_id) <= doc_id
            )
        out.append((doc_id, text, *rest))
    return sorted(out, key=repr)


def test_odd_rows(spark):
    docs = tables.documents(spark)
    bitmaps = linededup.line_bitmaps(docs)
    assert tables.rows_of(linededup.without_lines(docs, bitmaps)) == expected_texts(tables.ODD)
    clashing = tables.with_clashes(docs, "_keep", "_tag", "_doc_id", "digest", "pos", "keep")
    out = linededup.without_lines(clashing, linededup.line_bitmaps(clashing))
    assert out.columns == clashing.columns
    assert tables.rows_of(out.select(docs.columns)) == expected_texts(tables.ODD)
    nothing = tables.documents(spark, [])
    assert linededup.without_lines(nothing, linededup.line_bitmaps(nothing)).collect() == []


@pytest.mark.parametrize("partitions", ["2", "23"])
def test_runs_that_cross_ranges(spark, partitions):
    """Hot lines in a third of all documents, over more ranges than there are keys."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")
    try:
        rows = []
        for k in range(600):
            lines = [f"{k % n} of {n} is a key that some documents share, more or less"
                     for n in (3, 90, 125, 151, 299)]
            rows.append((k, "\n".join([*lines, lines[0], "short"]), "en", "a", 1))
        docs = tables.documents(spark, rows).repartition(5)
        out = linededup.without_lines(docs, linededup.line_bitmaps(docs))
        assert tables.rows_of(out) == expected_texts(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")


def test_texts_of_one_doc_id(spark):
    line = "a line that stands in more than five of the documents here"
    rows = [(k, line, "en", "a", 1) for k in range(6)]
    rows += [(2, "another text\n" + line, "en", "a", 1), (5, line, "en", "a", 1)]
    docs = tables.documents(spark, rows)
    out = linededup.without_lines(docs, linededup.line_bitmaps(docs))
    assert tables.rows_of(out) == expected_texts(rows)


URLS = [
    None, "", "no scheme", "http://", "://x", "http://COM/", "http://a.com", "http://a.com/",
    "https://EXAMPLE.com/en/x", "https://example.com/en", "http://www.example.com/en/1?u=://b",
    "http://m.www.example.com/en/#x", "http://notexample.com/en/", "http://a.net/es/x",
    "http://net/fr/", "http://a.net/de/", "http://x.org?/en/", "http://x.org#/y", "http://é.net/fr/ü",
    "http://free-bets.example.net/de/", "http://m.free-bets.example.net", "http://user@a.com:80/p",
    "http://" + "a." * 30_000 + "net/es/", "http://a..net/es/", "http://.net/fr/",
]


def judged(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match("[^/?#]*", rest)[0]
        path = re.match("[^?#]*", rest[len(host) :])[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [r for r in URL_RULES
            if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.host + r.path), default=None)
    listed = any(host == h or host.endswith("." + h) for h in BLOCKED_HOSTS)
    verdict = best.verdict if best else "block" if listed else "allow"
    return host, path, best and best.host + best.path, verdict


def test_urls_against_plain_rules(spark):
    rows = [(k, url, "") for k, url in enumerate([*URLS, *URLS[:4]])] + [(None, "http://a.com/", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    pages = tables.with_clashes(pages, "host", "path", "rule", "verdict")
    found = tables.rows_of(urlfilter.judge_urls(pages, URL_RULES, BLOCKED_HOSTS))
    assert found == sorted(((k, *judged(url)) for k, url, _ in rows), key=repr)
    none = pages.filter(F.lit(False))
    assert urlfilter.judge_urls(none, URL_RULES, BLOCKED_HOSTS).collect() == []


def test_a_collision_of_keys_changes_nothing(tmp_path, monkeypatch):
    monkeypatch.setattr(urlfilter.xxhash, "xxh64_intdigest", lambda data: len(data) % 2)
    path = tmp_path / "index"
    path.write_bytes(urlfilter.index_bytes(URL_RULES, BLOCKED_HOSTS))
    parts = [judged(url)[:2] for url in URLS if url is None or len(url) < 1000]
    rules, verdicts = urlfilter.DigestIndex(str(path)).judge(*map(list, zip(*parts, strict=True)))
    expected = [judged(url)[2:] for url in URLS if url is None or len(url) < 1000]
    assert list(zip(rules, verdicts, strict=True)) == expected


def test_no_rules_and_large_lists(spark, tmp_path):
    pages = spark.createDataFrame([(1, "http://a.com/")], "page_id long, url string")
    assert urlfilter.judge_urls(pages, []).collect()[0].verdict == "allow"
    with pytest.raises(ValueError, match="bound"):
        urlfilter.judge_urls(pages, URL_RULES, max_bytes=10)
    with pytest.raises(ValueError, match="two rules"):
        urlfilter.index_bytes([*URL_RULES, urlfilter.Rule("block", "com", "/")])


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.01", "sf0.1"])
def test_bad_hosts_of_the_pages_are_blocked(spark, testdata, folder):
    pages = spark.read.parquet(os.path.join(os.path.dirname(testdata), folder, "pages.parquet"))
    found = urlfilter.judge_urls(pages, URL_RULES, BLOCKED_HOSTS).filter("rule IS NULL").collect()
    bad = re.compile(r"(^|\.)(ads-track|adult-x|casino-win|cheap-pills|free-bets|spam-farm)\.")
    assert found
    assert [r for r in found if (r.verdict == "block") != bool(bad.search(r.host))] == []


def test_bad_hosts_without_a_path(spark):
    urls = [f"http://{site}.example.{end}" for site in ("m.casino-win", "ads-track", "spam-farm", "good")
            for end in ("com", "net", "org")]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    for row in urlfilter.judge_urls(pages, URL_RULES, BLOCKED_HOSTS).collect():
        assert row.rule is None
        assert (row.verdict == "block") == (not row.host.startswith("good")), row.host
