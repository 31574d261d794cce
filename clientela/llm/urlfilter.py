"""URL rules and block lists in a sorted digest array.

Every rule is a host and a path prefix. The index is one file: the sorted 64-bit
xxhash keys of the rules' strings, where each string starts, the strings
themselves, and what each rule says. Tasks map that file into memory. A URL's
host and path give all strings under which a rule could stand (each host suffix
at a label border with each path prefix as long as some rule's path); these are
hashed, found by one vectorised binary search, and counted only if the stored
string is equal, so a collision of keys changes nothing. The longest rule wins.
Without a rule, the block list (same array) decides: a listed host with its
subdomains is blocked, any other URL allowed.

The file is written to the shared folder and handed to executors by Spark's own
file distribution; ``max_bytes`` bounds it, and a larger list is refused.

Defined results: a null URL, or one without ``://``, has empty host and path and
is allowed; repeated rows are judged each; a rule given twice must say the same;
an empty table gives an empty table; other columns are not looked at.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from clientela.functions.storage import shared_folder

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ALLOW, BLOCK, LISTED = 0, 1, 2
VERDICTS = {ALLOW: "allow", BLOCK: "block"}
MAX_BYTES = 256 << 20
HEAD = np.dtype([("rules", "<u8"), ("paths", "<u8"), ("host", "<u8")])


class Rule(NamedTuple):
    verdict: str  # allow or block
    host: str
    path: str


def after_scheme(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, url.substr(at + 3, F.length(url)))


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(after_scheme(url), "^([^/?#]*)", 1)
    return F.coalesce(F.translate(rest, UPPER, UPPER.lower()), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(after_scheme(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


# Index ----------------------------------------------------------------------------------


def index_bytes(rules: Sequence[Rule], blocked_hosts: Sequence[str] = ()) -> bytes:
    """The index file: head, path lengths, keys, offsets, verdicts, strings."""
    entries: dict[str, int] = {}
    for verdict, host, path in rules:
        says = {"allow": ALLOW, "block": BLOCK}[verdict]
        if entries.setdefault(f"{host}\0{path}", says) != says:
            raise ValueError(f"two rules for {host}{path}")
    entries |= {f"{host}\0": LISTED for host in blocked_hosts if f"{host}\0" not in entries}
    raw = [(xxhash.xxh64_intdigest(text.encode()), text.encode(), v) for text, v in entries.items()]
    raw.sort()
    lengths = sorted({len(rule.path) for rule in rules} | ({0} if blocked_hosts else set()))
    head = np.zeros(1, HEAD)
    longest = max((len(text.split("\0")[0]) for text in entries), default=0)
    head[0] = (len(raw), len(lengths), longest)
    ends = np.cumsum([0, *(len(text) for _, text, _ in raw)])
    return b"".join([
        head.tobytes(),
        np.array(lengths, "<u8").tobytes(),
        np.array([key for key, _, _ in raw], "<u8").tobytes(),
        ends.astype("<u8").tobytes(),
        np.array([v for _, _, v in raw], np.uint8).tobytes(),
        b"".join(text for _, text, _ in raw),
    ])


class DigestIndex:
    """The index file, mapped into memory."""

    def __init__(self, path: str):
        data = np.memmap(path, np.uint8, mode="r")
        size, paths, self.longest_host = (int(x) for x in data[: HEAD.itemsize].view(HEAD)[0])
        at = HEAD.itemsize

        def part(count: int, kind: str) -> np.ndarray:
            nonlocal at
            at += count * np.dtype(kind).itemsize
            return data[at - count * np.dtype(kind).itemsize : at].view(kind)

        self.path_lengths = part(paths, "<u8").tolist()
        self.keys, self.ends = part(size, "<u8"), part(size + 1, "<u8")
        self.says, self.blob = part(size, "u1"), data[at:]

    def stored(self, k: int) -> bytes:
        return self.blob[int(self.ends[k]) : int(self.ends[k + 1])].tobytes()

    def find(self, strings: list[bytes]) -> np.ndarray:
        """Entry of each string, -1 if it is not stored."""
        digests = np.array([xxhash.xxh64_intdigest(s) for s in strings], np.uint64)
        at = np.searchsorted(self.keys, digests)
        found = np.full(len(strings), -1, np.int64)
        inside = at < len(self.keys)
        hits = np.flatnonzero(inside & (self.keys[np.where(inside, at, 0)] == digests)
                              if len(self.keys) else inside)
        for k in hits.tolist():
            entry = int(at[k])
            while entry < len(self.keys) and self.keys[entry] == digests[k]:
                if self.stored(entry) == strings[k]:
                    found[k] = entry
                    break
                entry += 1
        return found

    def candidates(self, host: str, path: str) -> Iterator[str]:
        """Strings under which a rule for this URL could stand. Longer hosts than any rule's
        are left out, so a host of very many labels costs no more than its length."""
        at = max(0, len(host) - self.longest_host)
        if at and host[at - 1] != ".":
            at = host.find(".", at) + 1 or len(host) + 1
        prefixes = [path[:n] for n in self.path_lengths if n <= len(path)]
        while at <= len(host):
            for prefix in prefixes:
                yield f"{host[at:]}\0{prefix}"
            at = host.find(".", at) + 1 or len(host) + 1

    def judge(self, hosts: list[str], paths: list[str]) -> tuple[list[str | None], list[str]]:
        """Rule and verdict of each URL."""
        strings: list[bytes] = []
        counts = []
        for host, path in zip(hosts, paths, strict=True):
            before = len(strings)
            strings += [s.encode() for s in self.candidates(host, path)]
            counts.append(len(strings) - before)
        found = self.find(strings)
        rules: list[str | None] = []
        verdicts = []
        at = 0
        for count in counts:
            best, says, listed = None, ALLOW, False
            for k in range(at, at + count):
                if (entry := int(found[k])) < 0:
                    continue
                if self.says[entry] == LISTED:
                    listed = True
                elif best is None or len(strings[k]) > len(best):
                    best, says = strings[k], int(self.says[entry])
            at += count
            rules.append(None if best is None else best.replace(b"\0", b"").decode())
            verdicts.append(VERDICTS[says if best is not None else BLOCK if listed else ALLOW])
        return rules, verdicts


@lru_cache(maxsize=4)
def _opened(name: str) -> DigestIndex:
    return DigestIndex(SparkFiles.get(name))


def distribute(spark: SparkSession, data: bytes, max_bytes: int = MAX_BYTES) -> str:
    """Write the file to the shared folder and let Spark bring it to each executor."""
    if len(data) > max_bytes:
        raise ValueError(f"an index of {len(data)} bytes; the bound is {max_bytes}")
    name = f"urls-{uuid.uuid4().hex}.idx"
    target = f"{shared_folder(spark)}/clientela/{name}"
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(target)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    stream = files.create(path, True)
    stream.write(bytearray(data))
    stream.close()
    spark.sparkContext.addFile(str(files.makeQualified(path).toString()))
    return name


def judge_urls(
    pages: DataFrame,
    rules: Sequence[Rule],
    blocked_hosts: Sequence[str] = (),
    key: str = "page_id",
    max_bytes: int = MAX_BYTES,
) -> DataFrame:
    """key, host, path, rule (null if none fits) and verdict of every URL."""
    name = distribute(pages.sparkSession, index_bytes(rules, blocked_hosts), max_bytes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, verdicts = _opened(name).judge(
                batch["host"].to_pylist(), batch["path"].to_pylist()
            )
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found, pa.string()), pa.array(verdicts, pa.string())],
                [key, "host", "path", "rule", "verdict"],
            )

    url = F.col("url")
    parts = pages.select(key, host_of(url).alias("host"), path_of(url).alias("path"))
    kind = parts.schema[key].dataType.simpleString()
    return parts.mapInArrow(
        run, f"{key} {kind}, host string, path string, rule string, verdict string"
    )
