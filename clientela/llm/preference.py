"""Quality of documents by Bradley-Terry: a score learned from pairs of a better and a worse text.

Statistics of whole texts become features: each statistic is cut at quantiles, and a
feature says whether the text lies above a cut, so the score is a sum of one free
curve per statistic. The chance that text a beats text b is the logistic function of the
difference of their scores; its loss over preference pairs is minimised by Newton's
method on differences of features. Pairs are drawn between labelled rows of both kinds, a
bounded number; all rows of both kinds of the sample take part.

A document is good if its score lies above a quantile of the scores of all labelled rows:
the share of them that is labelled 0. The quantile is an exact order statistic
over all these rows, found by counting, without a sort.

Defined results: null and empty texts have no words and are scored by these counts;
very long texts are counted whole; repeated rows are scored each; labels other
than 0 and 1, and labels without a document, teach nothing; a doc_id with both labels is taught as
each; without labels of both kinds there is no pair and no order, and every score is the
share of ones among the labels, or a half; an empty table gives an empty table; other
columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from clientela.functions.selection import order_statistics
from clientela.functions.storage import materialise
from clientela.llm.quality import COUNTS, document_counts, feature_rows


@dataclass(frozen=True)
class RankConfig:
    sample_rows: int = 20_000  # bound on the labelled rows that are learned from
    pairs: int = 40_000
    cuts: int = 12  # of each statistic
    ridge: float = 3.0
    steps: int = 25
    seed: int = 12


@dataclass(frozen=True)
class RankModel:
    """Cuts of each statistic and the weight of lying above each cut, row after row."""

    cuts: tuple[np.ndarray, ...]
    weights: np.ndarray
    threshold: float = 0.0
    constant: float | None = None  # score of every text if there was no pair

    def margin(self, statistics: np.ndarray) -> np.ndarray:
        """Score of each text on the log-odds scale: a against b is the difference."""
        if self.constant is not None:
            return np.zeros(len(statistics))
        # Added up row by row, so that a score does not depend on the rows next to it.
        return (_above(statistics, self.cuts) * self.weights).sum(axis=1)

    def score(self, statistics: np.ndarray) -> np.ndarray:
        """0 to 1; a half at the threshold."""
        if self.constant is not None:
            return np.full(len(statistics), self.constant)
        return 1.0 / (1.0 + np.exp(-np.clip(self.margin(statistics) - self.threshold, -50, 50)))


def _above(statistics: np.ndarray, cuts: tuple[np.ndarray, ...]) -> np.ndarray:
    """A column for each cut: 1 where the statistic is above it."""
    columns = [statistics[:, k : k + 1] > own for k, own in enumerate(cuts)]
    return np.concatenate(columns, axis=1).astype(np.float64)


def _pairs(good: np.ndarray, cfg: RankConfig) -> tuple[np.ndarray, np.ndarray]:
    """A better and a worse row for each pair; every row of both kinds is in one at least."""
    draw = np.random.default_rng(cfg.seed)
    sides = []
    for rows in (np.flatnonzero(good == 1), np.flatnonzero(good == 0)):
        times = -(-cfg.pairs // len(rows))
        # A shuffled pass over all rows after the other.
        passes = [draw.permutation(rows) for _ in range(times)]
        sides.append(np.concatenate(passes))
    total = max(cfg.pairs, int((good == 1).sum()), int((good == 0).sum()))
    return np.resize(sides[0], total), np.resize(sides[1], total)


def bradley_terry(differences: np.ndarray, ridge: float, steps: int) -> np.ndarray:
    """Weights of least logistic loss over differences better - worse, by Newton's method."""
    width = differences.shape[1]
    weights = np.zeros(width)

    def loss(w: np.ndarray) -> float:
        return float(np.logaddexp(0.0, -(differences @ w)).sum() + 0.5 * ridge * w @ w)

    best = loss(weights)
    for _ in range(steps):
        wins = 1.0 / (1.0 + np.exp(np.clip(differences @ weights, -50, 50)))
        slope = -(differences.T @ wins) + ridge * weights
        curve = (differences * (wins * (1.0 - wins))[:, None]).T @ differences
        step = np.linalg.solve(curve + ridge * np.eye(width), slope)
        size = 1.0
        while (found := loss(weights - size * step)) > best and size > 1e-4:
            size /= 2
        if best - found < 1e-9 * max(1.0, best):
            break
        weights, best = weights - size * step, found
    return weights


def learned(statistics: np.ndarray, good: np.ndarray, cfg: RankConfig) -> RankModel:
    """The model of labelled rows of both kinds, without its threshold."""
    inner = np.linspace(0, 1, cfg.cuts + 2)[1:-1]
    # Half of the cuts lie between good rows, half between bad ones, however few these are.
    found = []
    for column in statistics.T:
        both = [np.quantile(column[good == kind], inner, method="lower") for kind in (0, 1)]
        found.append(np.unique(np.concatenate(both)))
    cuts = tuple(found)
    above = _above(statistics, cuts)
    better, worse = _pairs(good, cfg)
    weights = bradley_terry(above[better] - above[worse], cfg.ridge, cfg.steps)
    return RankModel(cuts, weights)


def _with_margin(counts: DataFrame, model: RankModel, kept: list[str], name: str) -> DataFrame:
    """The columns ``kept`` of the counts and the margin of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = {c: batch[c].to_numpy() for c in COUNTS}
            margin = model.margin(feature_rows(own)) if batch.num_rows else np.empty(0)
            columns = [batch[c] for c in kept]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(margin)], [*kept, name])

    types = {field.name: field.dataType.simpleString() for field in counts.schema.fields}
    schema = ", ".join(f"{c} {types[c]}" for c in kept)
    return counts.select(*dict.fromkeys([*kept, *COUNTS])).mapInArrow(run, f"{schema}, {name} double")


def fit(
    counts: DataFrame, labels: DataFrame, teaches: Column, cfg: RankConfig = RankConfig()
) -> RankModel:
    """A model of the labelled rows for which ``teaches`` (over doc_id) holds.

    ``counts`` are written. Weights come from about ``cfg.sample_rows`` labelled rows, by a hash
    of doc_id, at least half of the bound for each kind if it has as many; the
    threshold from all labelled rows.
    """
    told = labels.select("doc_id", "quality").filter(F.col("quality").isin(0, 1) & teaches)
    known = materialise(counts.select("doc_id", *COUNTS).join(told, "doc_id"), "labelled")
    rows = {r["quality"]: r["count"] for r in known.groupBy("quality").count().collect()}
    bad, good = rows.get(0, 0), rows.get(1, 0)
    if not bad or not good:
        share = good / (good + bad) if good + bad else 0.5
        return RankModel((), np.empty(0), constant=share)
    draw = F.pmod(F.xxhash64("doc_id", F.lit(12)), F.lit(1 << 30)) / float(1 << 30)
    half = cfg.sample_rows / 2
    share = F.when(F.col("quality") == 0, half / bad).otherwise(half / good)
    # Repeated doc_ids share a draw: the order makes the bound the same rows each time.
    sample = known.filter(draw < share).orderBy(draw, "doc_id", *COUNTS).limit(2 * cfg.sample_rows)
    table = sample.toPandas().sort_values(["doc_id", "quality", *COUNTS])
    kinds = table["quality"].to_numpy()
    if not 0 < kinds.sum() < len(kinds):  # few rows, and none of one kind drawn
        table = known.orderBy(draw, "doc_id", *COUNTS).limit(2 * cfg.sample_rows).toPandas()
        kinds = table["quality"].to_numpy()
    model = learned(feature_rows({c: table[c].to_numpy() for c in COUNTS}), kinds, cfg)
    margins = materialise(_with_margin(known, model, ["doc_id"], "margin"), "margins")
    # Between the best of the rows below the quantile and the next one.
    below, above = order_statistics(margins, {"margin": [bad - 1, bad]})["margin"]
    return RankModel(model.cuts, model.weights, (below + above) / 2)


def scored(counts: DataFrame, model: RankModel) -> DataFrame:
    """doc_id and score of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = {c: batch[c].to_numpy() for c in COUNTS}
            score = model.score(feature_rows(own)) if batch.num_rows else np.empty(0)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(score)], ["doc_id", "score"])

    return counts.select("doc_id", *COUNTS).mapInArrow(run, "doc_id long, score double")


def ranked(
    docs: DataFrame, labels: DataFrame, teaches: Column, cfg: RankConfig = RankConfig()
) -> DataFrame:
    """Score of every document by the model of the labelled rows that teach."""
    counts = materialise(document_counts(docs), "rank-counts")
    return scored(counts, fit(counts, labels, teaches, cfg))
