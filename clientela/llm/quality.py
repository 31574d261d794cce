"""Document quality: fixed rules over statistics, then boosted trees over the same statistics.

Statistics of whole texts are counted slice by slice in numpy. The trees are
fitted on a bounded sample of labelled rows and scored as flat node arrays, all
rows of a batch at once. More repetition, more symbols and more capitals can only
lower the score: these features are constrained to be monotonic.

Defined results: a null text has no words and fails the rules; empty and blank
texts fail them too; without labels of both kinds the trees say nothing and the
rules decide alone; repeated rows are judged each; a doc_id with contradicting
labels is trained with each of them; an empty table gives an empty table; other
columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from clientela.functions.storage import materialise
from clientela.llm import boosting
from clientela.llm.text import coded, filled, slices, sums, words

SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: Bound on the labelled rows that the trees are fitted on.
SAMPLE_ROWS = 20_000
#: A document goes if its estimated probability of being good is below this.
THRESHOLD = 0.5

COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_upper", "n_digits", "n_marks", "n_same_as_last", "n_distinct_words",
)
#: Feature and how a larger value may move the score.
FEATURES = {
    "log_words": 0, "word_length": 0, "symbols": -1, "dup_lines": -1, "repeats": -1,
    "line_words": 0, "capitals": -1, "digits": 0, "marks": 0, "same_as_last": -1, "distinct": 0,
}

_KINDS = np.zeros((4, 256), np.uint8)
_KINDS[0, list(SYMBOLS)] = 1
_KINDS[1, ord("A") : ord("Z") + 1] = 1
_KINDS[2, ord("0") : ord("9") + 1] = 1
_KINDS[3, list(b".,;:!?")] = 1


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts one after the other, and where each starts and ends."""
    raw = column.cast(pa.large_binary())
    offsets = np.frombuffer(raw.buffers()[1], np.int64, len(raw) + 1, raw.offset * 8)
    data = np.frombuffer(raw.buffers()[2] or b"", np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def _dense(values: np.ndarray) -> np.ndarray:
    return pa.array(values).dictionary_encode().indices.to_numpy().astype(np.int64)


def _repeat_words(codes: np.ndarray, kinds: int, offsets: np.ndarray) -> np.ndarray:
    """Words inside three-word windows that their text holds twice or more."""
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    inside = np.flatnonzero(owner[2:] == owner[:-2]) if len(codes) > 2 else np.empty(0, np.int64)
    if not len(inside):
        return np.zeros(len(offsets) - 1, np.int64)
    pair = _dense(codes[inside] * kinds + codes[inside + 1])
    window = _dense(pair * kinds + codes[inside + 2])
    window = _dense(window * len(offsets) + owner[inside])
    again = inside[np.bincount(window)[window] >= 2]
    covered = np.zeros(len(codes), np.int64)
    for k in range(3):
        covered[again + k] = 1
    return sums(covered, offsets)


def _dup_lines(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Lines of each text, and its lines with a word that equal an earlier one."""
    split = pc.split_pattern(texts, "\n")
    offsets = split.offsets.to_numpy().astype(np.int64)
    offsets = offsets - offsets[0]
    codes, distinct = coded(split.flatten())
    full = pc.greater(pc.binary_length(pc.ascii_trim_whitespace(distinct)), 0)
    full = full.to_numpy(zero_copy_only=False).astype(np.int64)[codes]
    owner = np.repeat(np.arange(len(texts)), np.diff(offsets))
    keys = (owner * max(1, len(distinct)) + codes)[full > 0]
    kinds = np.unique(keys) // max(1, len(distinct))
    return np.diff(offsets), sums(full, offsets) - np.bincount(kinds, minlength=len(texts))


def counted(column: pa.Array) -> list[np.ndarray]:
    """The counts of every text, in the order of ``COUNTS``."""
    texts = filled(column)
    n = len(texts)
    flat, offsets = words(texts)
    codes, distinct = coded(flat)
    data, ends = _bytes_of(texts)
    per_kind = [sums(kind[data], ends) for kind in _KINDS]
    chars = sums(pc.utf8_length(flat).to_numpy(zero_copy_only=False), offsets)
    owner = np.repeat(np.arange(n), np.diff(offsets))
    same = np.zeros(len(codes), np.int64)
    same[1:] = (codes[1:] == codes[:-1]) & (owner[1:] == owner[:-1])
    kinds = max(1, len(distinct))
    held = pc.unique(pa.array(owner * kinds + codes)).to_numpy(zero_copy_only=False) // kinds
    lines, dup = _dup_lines(texts)
    return [
        np.diff(offsets), chars, per_kind[0], dup, _repeat_words(codes, kinds, offsets),
        lines, *per_kind[1:], sums(same, offsets), np.bincount(held, minlength=n),
    ]


def document_counts(docs: DataFrame) -> DataFrame:
    """doc_id and the counts of its whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches):
            counts = [pa.array(np.asarray(x, np.int64)) for x in counted(piece["text"])]
            yield pa.RecordBatch.from_arrays([piece["doc_id"], *counts], ["doc_id", *COUNTS])

    names = ", ".join(f"{name} long" for name in COUNTS)
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id long, {names}")


def feature_rows(counts: dict[str, np.ndarray]) -> np.ndarray:
    """Features of many documents, in the order of ``FEATURES``."""
    c = {name: np.asarray(counts[name], np.float64) for name in COUNTS}
    w, chars = np.maximum(c["n_words"], 1), np.maximum(c["word_chars"], 1)
    return np.stack(
        [
            np.log1p(c["n_words"]), c["word_chars"] / w, c["n_symbols"] / w,
            c["n_dup_lines"] / np.maximum(c["n_lines"], 1), c["n_repeat_words"] / w,
            w / np.maximum(c["n_lines"], 1), c["n_upper"] / chars, c["n_digits"] / chars,
            c["n_marks"] / chars, c["n_same_as_last"] / w, c["n_distinct_words"] / w,
        ],
        axis=1,
    )


def fit_trees(
    counts: DataFrame,
    labels: DataFrame,
    rows: int = SAMPLE_ROWS,
    cfg: boosting.BoostConfig = boosting.BoostConfig(),
) -> boosting.FlatTrees | None:
    """Trees from at most ``rows`` labelled documents (about, by a hash of doc_id)."""
    told = labels.select("doc_id", "quality").filter(F.col("quality").isin(0, 1))
    known = materialise(counts.join(told, "doc_id"), "labelled")
    total = known.count()
    share = min(1.0, rows / total) if total else 1.0
    draw = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(1 << 30)) / float(1 << 30)
    picked = known.filter(draw < share).limit(2 * rows)
    table = picked.select("doc_id", "quality", *COUNTS).toPandas().sort_values(["doc_id", "quality"])
    good = table["quality"].to_numpy(np.float64)
    if not 0 < good.sum() < len(good):
        return None
    signs = np.array(list(FEATURES.values()))
    return boosting.fit(feature_rows({c: table[c].to_numpy() for c in COUNTS}), good, signs, cfg)


def judged(
    counts: DataFrame, trees: boosting.FlatTrees | None, threshold: float = THRESHOLD
) -> DataFrame:
    """The counts with base_failed, score (probability of being good) and kept."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            own = {name: batch[name].to_numpy() for name in COUNTS}
            failed = (own["n_words"] < MIN_WORDS) | (
                100 * own["n_repeat_words"] > MAX_REPEAT_PERCENT * own["n_words"]
            )
            score = trees.probability(feature_rows(own)) if trees else np.ones(batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(failed), pa.array(score),
                 pa.array(~failed & (score >= threshold))],
                [*batch.schema.names, "base_failed", "score", "kept"],
            )

    names = ", ".join(f"{name} long" for name in COUNTS)
    return counts.select("doc_id", *COUNTS).mapInArrow(
        run, f"doc_id long, {names}, base_failed boolean, score double, kept boolean"
    )


def judge_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Counts, rule result, score and verdict of every document."""
    counts = materialise(document_counts(docs), "counts")
    return judged(counts, fit_trees(counts, labels))
