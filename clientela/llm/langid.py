"""Language of a text: sparse multinomial logistic regression on TF-IDF character n-grams.

Texts become runs of lower-case letters with one space between; their n-grams of
one to three characters are hashed into a fixed number of features. Document
frequencies are counted over all labelled rows. The weights are learned from a
sample of labelled rows, a bounded number in all and besides a quota of each language
(all rows of one that has fewer), so every labelled language is learned, by follow-the-regularised-leader with an
elastic-net penalty, which leaves most of them at zero, and the probabilities are
calibrated by one temperature on rows of the sample that were not learned from.

Defined results: a null text, or one without a letter, is ``und`` with score 0;
so is every text if there are no labelled rows; very long texts are read whole;
repeated rows are judged each; rows with null lang or doc_id teach nothing; an
empty table gives an empty table; other columns are passed through, and the
prediction looks at the text alone.
"""

from __future__ import annotations

import sys
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from clientela.llm.text import filled, slices

UNKNOWN = "und"


@dataclass(frozen=True)
class LangConfig:
    features: int = 1 << 15
    sizes: tuple[int, ...] = (1, 2, 3)
    sample_rows: int = 4_000  # about so many labelled rows are learned from, all languages together,
    language_rows: int = 200  # but about so many of each language, or all it has, at least
    epochs: int = 3
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 0.01
    held_for_temperature: int = 5  # every so manieth row of a language in the sample


@dataclass(frozen=True)
class LangModel:
    cfg: LangConfig
    names: tuple[str, ...]
    idf: np.ndarray  # float64, one per feature
    weights: np.ndarray  # features + 1 (constant), one column per language
    temperature: float


# Features -------------------------------------------------------------------------------


@cache
def _lowered() -> np.ndarray:
    """Lower-case code point of every letter, 0 for everything else."""
    table = np.zeros(sys.maxunicode + 1, np.uint32)
    for point in range(sys.maxunicode + 1):
        if (letter := chr(point)).isalpha():
            table[point] = ord(letter.lower()[0])
    return table


def _features(column: pa.Array, cfg: LangConfig) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Features of each text and how often it has them; empty without a letter."""
    texts = filled(column)
    raw = texts.cast(pa.large_binary())
    offsets = np.frombuffer(raw.buffers()[1], np.int64, len(raw) + 1, raw.offset * 8)
    data = (raw.buffers()[2] or pa.py_buffer(b"")).to_pybytes()[offsets[0] : offsets[-1]]
    points = np.frombuffer(data.decode("utf-8").encode("utf-32-le"), np.uint32)
    ends = np.concatenate(([0], np.cumsum(pc.utf8_length(texts).to_numpy(zero_copy_only=False))))
    letters = _lowered()[points]
    shift = 32 - int(cfg.features).bit_length() + 1
    for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
        own = letters[a:b]
        full = own != 0
        if not full.any():
            yield np.empty(0, np.int64), np.empty(0, np.int64)
            continue
        full[1:] |= full[:-1]
        own = np.concatenate(([0], own[full], [0])).astype(np.uint32)
        counts = np.zeros(cfg.features, np.int64)
        total = np.zeros(len(own), np.uint32)
        for size in range(1, max(cfg.sizes) + 1):
            # A polynomial of the characters, mixed so that its top bits are the feature.
            total = total[: len(own) - size + 1] * np.uint32(0x01000193)
            total = total + own[size - 1 :] + np.uint32(size)
            if size in cfg.sizes and len(total):
                mixed = (total ^ (total >> np.uint32(15))) * np.uint32(0x9E3779B1)
                counts += np.bincount(mixed >> np.uint32(shift), minlength=cfg.features)
        found = np.flatnonzero(counts)
        yield found, counts[found]


def _scaled(found: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    values = (1.0 + np.log(counts)) * idf[found]
    return values / np.sqrt((values * values).sum())


def document_frequencies(docs: DataFrame, cfg: LangConfig) -> tuple[np.ndarray, int]:
    """In how many of all rows each feature occurs, and the number of rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(cfg.features + 1, np.int64)
        for piece in slices(batches):
            seen[-1] += piece.num_rows
            for found, _ in _features(piece["text"], cfg):
                seen[found] += 1
        kept = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(kept), pa.array(seen[kept])], ["feature", "n"])

    partial = docs.select("text").mapInArrow(run, "feature long, n long")
    # As many rows as there are features, whatever the input.
    table = partial.groupBy("feature").agg(F.sum("n").alias("n")).toPandas()
    total = np.zeros(cfg.features + 1, np.int64)
    total[table["feature"].to_numpy(np.int64)] = table["n"].to_numpy(np.int64)
    return total[:-1], int(total[-1])


# Training -------------------------------------------------------------------------------


class _Leader:
    """Follow-the-regularised-leader, per coordinate, for several classes."""

    def __init__(self, features: int, classes: int, cfg: LangConfig):
        self.z = np.zeros((features + 1, classes))
        self.n = np.zeros((features + 1, classes))
        self.cfg = cfg

    def weights(self, at=slice(None)) -> np.ndarray:
        z, n, cfg = self.z[at], self.n[at], self.cfg
        rate = (cfg.beta + np.sqrt(n)) / cfg.alpha + cfg.l2
        return np.where(np.abs(z) <= cfg.l1, 0.0, -(z - np.sign(z) * cfg.l1) / rate)

    def learn(self, at: np.ndarray, x: np.ndarray, own: int) -> None:
        weights = self.weights(at)
        error = _softmax(x @ weights)
        error[own] -= 1.0
        grad = np.outer(x, error)
        after = self.n[at] + grad * grad
        sigma = (np.sqrt(after) - np.sqrt(self.n[at])) / self.cfg.alpha
        self.z[at] += grad - sigma * weights
        self.n[at] = after


def _softmax(scores: np.ndarray) -> np.ndarray:
    scores = np.exp(scores - scores.max(-1, keepdims=True))
    return scores / scores.sum(-1, keepdims=True)


def _temperature(scores: np.ndarray, own: np.ndarray) -> float:
    """The temperature, on a fixed grid, at which these rows are most likely.

    It is 1 at least: rows that are all right would call for ever sharper scores.
    """
    if not len(own):
        return 1.0
    grid = np.exp(np.linspace(0.0, np.log(8.0), 49))
    rows = np.arange(len(own))
    losses = [-np.log(_softmax(scores / t)[rows, own] + 1e-300).sum() for t in grid]
    return float(grid[int(np.argmin(losses))])


def fit(docs: DataFrame, teaches: Column | bool = True, cfg: LangConfig = LangConfig()) -> LangModel:
    """A model of the labelled rows for which ``teaches`` holds."""
    known = docs.filter(F.col("doc_id").isNotNull() & F.col("lang").isNotNull())
    known = known.filter(F.lit(teaches) if isinstance(teaches, bool) else teaches)
    frequencies, rows = document_frequencies(known, cfg)
    idf = np.log((1.0 + rows) / (1.0 + frequencies)) + 1.0
    draw = F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1 << 30)) / float(1 << 30)
    share = min(1.0, cfg.sample_rows / max(1, rows))
    # One row per language.
    counts = known.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.min(draw).alias("first"))
    drawn = draw < share
    for lang, n, first in counts.collect():
        # The first row of a language is always in it, also if all its rows share one draw.
        if (own := cfg.language_rows / n) > share or first >= share:
            drawn = drawn | ((F.col("lang") == lang) & ((draw < own) | (draw <= first)))
    # Against rows that are repeated without end; far from it otherwise.
    order = Window.partitionBy("lang").orderBy("place")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches):
            both = list(_features(piece["text"], cfg))
            yield pa.RecordBatch.from_arrays(
                [
                    piece["place"],
                    piece["lang"],
                    pa.array([x.astype("<i4").tobytes() for x, _ in both], pa.binary()),
                    pa.array([n.astype("<i4").tobytes() for _, n in both], pa.binary()),
                ],
                ["place", "lang", "found", "counts"],
            )

    sample = (
        known.filter(drawn)
        .select(F.xxhash64("doc_id", F.lit(13)).alias("place"), "lang", "text")
        .withColumn("row", F.row_number().over(order))
        .filter(F.col("row") <= 2 * cfg.sample_rows)
        .mapInArrow(run, "place long, lang string, found binary, counts binary")
        .toPandas()
        .sort_values(["place", "lang"], kind="stable")
    )
    return _learned(sample, idf, cfg)


def _learned(sample, idf: np.ndarray, cfg: LangConfig) -> LangModel:
    names = tuple(sorted(set(sample["lang"])))
    number = {name: k for k, name in enumerate(names)}
    rows = []
    for lang, found, counts in zip(sample["lang"], sample["found"], sample["counts"], strict=True):
        at = np.frombuffer(found, "<i4").astype(np.int64)
        if len(at):
            x = _scaled(at, np.frombuffer(counts, "<i4"), idf)
            rows.append((np.append(at, cfg.features), np.append(x, 1.0), number[lang]))
    held, learned, seen = [], [], Counter()
    for row in rows:
        # Counted in each language, so that the first rows of a rare one are learned from.
        seen[row[2]] += 1
        last = seen[row[2]] % cfg.held_for_temperature == 0
        wanted = last and len(rows) >= 10 * cfg.held_for_temperature
        (held if wanted else learned).append(row)
    leader = _Leader(cfg.features, len(names), cfg)
    for _ in range(cfg.epochs):
        for at, x, own in learned:
            leader.learn(at, x, own)
    weights = leader.weights()
    scores = np.array([x @ weights[at] for at, x, _ in held]).reshape(len(held), len(names))
    heat = _temperature(scores, np.array([own for _, _, own in held], np.int64))
    return LangModel(cfg, names, idf, weights, heat)


# Prediction -----------------------------------------------------------------------------


def with_language(
    docs: DataFrame, model: LangModel, name: str = "lang_pred", score: str = "score"
) -> DataFrame:
    """All rows and columns with the predicted language and its calibrated probability."""
    # Features times languages: bounded by the configuration, not by the corpus.
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: LangModel = shared.value
        for piece in slices(batches):
            names, scores = [], []
            for found, counts in _features(piece["text"], m.cfg):
                if not len(found) or not m.names:
                    names.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                logits = _scaled(found, counts, m.idf) @ m.weights[found] + m.weights[-1]
                p = _softmax(logits / m.temperature)
                best = int(np.argmax(p))
                names.append(m.names[best])
                scores.append(float(p[best]))
            yield pa.RecordBatch.from_arrays(
                [*piece.columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                [*piece.schema.names, name, score],
            )

    extra = [T.StructField(name, T.StringType()), T.StructField(score, T.DoubleType())]
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *extra]))
