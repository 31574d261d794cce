"""Second-order boosted trees over sparse vectors, fitted in one stage.

Values are cut into bins once, by quantiles of each feature, and dealt out by feature:
a task holds some features of all rows, with the targets and margins of all rows, for the whole
fit. Trees grow level by level. Each task finds the best splits of all open nodes among
its features, from sums over all rows, so no histogram leaves a task. Inside a barrier stage the
tasks exchange their best splits, and all take the best one of each node; the task that has its feature then
tells, in a bit per row, on which side each falls. A level costs two exchanges instead of a Spark job. A table of up to
``rows_per_task`` rows is fitted by one task, without any exchange. Tasks tell each other through files
of the shared folder (``functions/exchange.py``).

Gradients are rounded to whole multiples of 2**-26, so sums are exact: the trees do not
depend on the number of tasks, on the order of the rows or on a retry. A lost task
restarts the stage.

Where the shared folder is no path of the machines, they exchange by Spark, which takes about a second
whatever is told: a tree takes two for each of its levels, and only tables beyond
``rows_per_slow_task`` are dealt to several tasks. All tasks of the stage must run at once (with dynamic
allocation there is one), and each needs some 40 bytes a row and 30 bytes for each value of its features.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import BarrierTaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from clientela.functions.exchange import Exchange, among, message_folder, slots
from clientela.functions.storage import materialise
from clientela.functions.vectors import entries, stored, width_of

#: A node with fewer values has no histogram, however few bins there are.
LEAST_VALUES = 2048
#: One in units of the rounded gradients.
UNIT = float(1 << 26)
#: A feature that one row in as many has is also held as a column.
LEAST_SHARE = 8
#: Least gain of a split.
LEAST_GAIN = 1e-6
#: Numbers that scoring holds as dense rows at once.
DENSE = 1 << 21
NODES = "tree int, node int, feature int, threshold double, left int, right int, value double, gain double"


@dataclass(frozen=True)
class BoostConfig:
    trees: int = 400
    depth: int = 20
    rate: float = 0.1
    ridge: float = 1.0
    least_hessian: float = 1.0  # of each side of a split
    bins: int = 256
    rows_per_task: int = 20_000
    rows_per_slow_task: int = 200_000  # where tasks exchange by Spark
    tasks: int = 16


# Bins -----------------------------------------------------------------------------------


def feature_cuts(vectors: DataFrame, width: int, bins: int) -> list[np.ndarray]:
    """Upper ends of the bins of each feature: quantiles of its values that are not 0, and 0.

    They come to the driver: at most ``bins`` numbers a feature.
    """
    shares = [k / bins for k in range(1, bins)]
    values = vectors.select(F.inline(stored("features")))
    told = (
        values.groupBy("feature")
        .agg(
            F.array_distinct(F.percentile_approx("value", shares, 10 * bins)).alias("cuts"),
            F.max("value").alias("most"),
        )
    )
    cuts: list[np.ndarray] = [np.empty(0) for _ in range(width)]
    for row in told.collect():
        own = np.unique(np.array([*row.cuts, 0.0]))
        cuts[row.feature] = own[own < max(row.most, 0.0)]
    return cuts


@dataclass
class _Rows:
    """All rows, and their values that are not 0 of some features, in the order of their bins."""

    target: np.ndarray
    row: np.ndarray  # of each value
    feature: np.ndarray
    code: np.ndarray  # bin among those of all features


@dataclass(frozen=True)
class _Bins:
    cuts: list[np.ndarray]
    start: np.ndarray  # first code of each feature
    zero: np.ndarray  # code of the value 0 of each feature
    total: int

    @classmethod
    def of(cls, cuts: list[np.ndarray]) -> _Bins:
        sizes = np.array([len(c) + 1 for c in cuts], np.int64)
        start = np.concatenate(([0], np.cumsum(sizes)))
        zero = start[:-1] + np.array([np.searchsorted(c, 0.0) for c in cuts], np.int64)
        return cls(cuts, start[:-1], zero, int(start[-1]))

    def coded(self, feature: np.ndarray, value: np.ndarray) -> np.ndarray:
        order = np.argsort(feature, kind="stable")
        code = np.empty(len(feature), np.int32)
        edges = np.searchsorted(feature[order], np.arange(len(self.cuts) + 1))
        for f, cuts in enumerate(self.cuts):
            own = order[edges[f] : edges[f + 1]]
            if len(own):
                code[own] = self.start[f] + np.searchsorted(cuts, value[own])
        return code


def _read(batches: Iterator[pa.RecordBatch], bins: _Bins) -> _Rows:
    """Rows (id, target, no feature) and values (id, feature, value) of a task."""
    ids, targets, owners, features, codes = [], [], [], [], []
    for batch in batches:
        own = batch["id"].to_numpy()
        is_row = batch["feature"].is_null().to_numpy(zero_copy_only=False)
        ids.append(own[is_row])
        targets.append(batch["target"].to_numpy(zero_copy_only=False)[is_row].astype(np.int8))
        feature = batch["feature"].drop_null().to_numpy(zero_copy_only=False).astype(np.int32)
        value = batch["value"].drop_null().to_numpy(zero_copy_only=False)
        owners.append(own[~is_row])
        features.append(feature)
        codes.append(bins.coded(feature, value))
    if not ids:
        return _Rows(np.empty(0), *[np.empty(0, np.int32) for _ in range(3)])
    id, target = np.concatenate(ids), np.concatenate(targets)
    order = np.argsort(id)  # the same in all tasks
    code = np.concatenate(codes)
    by_code = np.argsort(code, kind="stable")
    row = np.searchsorted(id[order], np.concatenate(owners)[by_code]).astype(np.int32)
    return _Rows(target[order].astype(float), row, np.concatenate(features)[by_code], code[by_code])


# Growing --------------------------------------------------------------------------------


def _alone(message: bytes) -> list[bytes]:
    return [message]


def _among(context: BarrierTaskContext) -> Exchange:
    def exchange(message: bytes) -> list[bytes]:
        told = context.allGather(base64.b64encode(message).decode())
        return [base64.b64decode(other) for other in told]

    return exchange


@dataclass
class _Splits:
    """A split of each open node; a node without one has a gain of -inf."""

    gain: np.ndarray
    code: np.ndarray
    left: np.ndarray  # gradient and hessian of the left side

    def packed(self) -> bytes:
        return np.concatenate([self.gain, self.code, self.left.reshape(-1)]).astype("<f8").tobytes()

    @classmethod
    def unpacked(cls, message: bytes, nodes: int) -> _Splits:
        numbers = np.frombuffer(message, "<f8", 4 * nodes)
        return cls(
            numbers[:nodes],
            numbers[nodes : 2 * nodes].astype(np.int64),
            numbers[2 * nodes :].reshape(2, nodes),
        )


def _best_of(offers: list[_Splits]) -> tuple[_Splits, np.ndarray]:
    """The best offer for each node, of equal ones that of the first feature, and whose it is."""
    gain = np.stack([o.gain for o in offers])
    code = np.stack([o.code for o in offers])
    code_of_best = np.where(gain == gain.max(axis=0), code, np.iinfo(np.int64).max)
    winner = np.argmin(code_of_best, axis=0)
    nodes = np.arange(gain.shape[1])
    left = np.stack([o.left for o in offers])[winner, :, nodes].T
    return _Splits(gain[winner, nodes], code[winner, nodes], left), winner


def _changes(sorted_: np.ndarray) -> np.ndarray:
    """Whether each entry is the first of its kind in a row."""
    first = np.ones(len(sorted_), bool)
    np.not_equal(sorted_[1:], sorted_[:-1], out=first[1:])
    return first


def _order(numbers: np.ndarray) -> np.ndarray:
    """Stable order of numbers from 0 to 2**32, 16 bits at a time: those are sorted by counting."""
    order = np.argsort(numbers.astype(np.uint16), kind="stable")
    if len(numbers) and numbers.max() >= 1 << 16:
        high = (numbers >> 16).astype(np.uint16)
        order = order[np.argsort(high[order], kind="stable")]
    return order


class _Grower:
    """One fit over the features of a task; all tasks grow the same trees.

    A node with more values than half the bins has its sums as a histogram, added up from the
    first bin of each feature; that of the larger of two children is what the smaller one leaves of
    their parent's, so only the rows of the smaller one are read. The values of the other nodes are
    sorted by node and bin, and summed as they come.
    """

    def __init__(self, rows: _Rows, bins: _Bins, cfg: BoostConfig, exchange: Exchange, task: int = 0):
        self.rows, self.bins, self.cfg, self.exchange, self.task = rows, bins, cfg, exchange, task
        self.margin = np.zeros(len(rows.target))
        sizes = np.diff(np.append(bins.start, bins.total))
        self.feature_of = np.repeat(np.arange(len(bins.cuts)), sizes)
        # The bins of the task's own features, without gaps.
        self.own = np.unique(rows.feature)
        own_sizes = sizes[self.own]
        self.start = np.cumsum(own_sizes) - own_sizes
        self.total = int(own_sizes.sum())
        shift = np.zeros(len(bins.cuts), np.int64)
        shift[self.own] = self.start - bins.start[self.own]
        self.code = (rows.code + shift[rows.feature]).astype(np.int32)
        self.zero = bins.zero[self.own] + shift[self.own]
        self.global_code = np.arange(self.total) - np.repeat(shift[self.own], own_sizes)
        self.place_of = np.repeat(np.arange(len(self.own)), own_sizes)  # feature of each bin
        self.edges = np.searchsorted(rows.feature, np.arange(len(bins.cuts) + 1))
        self.runs = np.flatnonzero(_changes(self.code))  # first value of each bin that has some
        by_row = np.argsort(rows.row, kind="stable")
        self.code_of_row, self.row = self.code[by_row], rows.row[by_row]  # row after row
        self.histograms: dict[int, np.ndarray] = {}
        # Features that many rows have, as a column: the bin of each row.
        stored = np.diff(self.edges)
        often = np.flatnonzero(stored * LEAST_SHARE >= max(1, len(rows.target)))
        self.column = np.full(len(bins.cuts), -1)
        self.column[often] = np.arange(len(often))
        kind = np.min_scalar_type(int(sizes.max(initial=1)))
        self.columns = np.empty((len(often), len(rows.target)), kind)
        for column, f in zip(self.columns, often.tolist(), strict=True):
            part = slice(self.edges[f], self.edges[f + 1])
            column[:] = bins.zero[f] - bins.start[f]
            column[rows.row[part]] = rows.code[part] - bins.start[f]

    def _begin(self, slope: np.ndarray) -> None:
        """The bins of a tree: those that the root may be cut at.

        A cut that leaves too little on a side of the root does so in each node. So the bins
        below the first cut of a feature are one with it, those above the last one are one, and
        features without a cut are left out.
        """
        totals = slope.sum(axis=1)
        sums = np.zeros((2, self.total))
        allowed = np.zeros(self.total, bool)
        if self.total:
            for s, own in zip(slope, sums, strict=True):
                own[self.code[self.runs]] = np.add.reduceat(s.take(self.rows.row), self.runs)
            sums[:, self.zero] += totals[:, None] - np.add.reduceat(sums, self.start, axis=1)
            hessian = sums[1].copy()
            hessian[self.start[1:]] -= totals[1]
            allowed = self._allowed(np.cumsum(hessian), totals[1])
        cuts = np.bincount(self.place_of[allowed], minlength=len(self.own))
        kept = np.flatnonzero(cuts)
        sizes = cuts[kept] + 1
        start = np.cumsum(sizes) - sizes
        # The bin of the tree for each bin: cuts of the feature before it.
        before = np.cumsum(allowed) - allowed
        new = np.full(self.total, -1, np.int32)
        some = cuts[self.place_of] > 0
        first = np.zeros(len(self.own), np.int64)
        first[kept] = start - before[self.start[kept]]
        new[some] = (before + first[self.place_of])[some]
        own = new[self.code_of_row]
        held = own >= 0
        self.of_row = own[held]
        self.values = np.bincount(self.row[held], minlength=len(self.rows.target))
        self.first = np.cumsum(self.values) - self.values
        self.t_total, self.t_start, self.t_zero = int(sizes.sum()), start, new[self.zero[kept]]
        self.t_place = np.repeat(np.arange(len(kept)), sizes)
        self.t_global = np.zeros(self.t_total, np.int64)
        self.t_global[new[allowed]] = self.global_code[allowed]
        counted = [np.bincount(new[some], own[some], self.t_total) for own in sums]
        self.root = np.stack(counted).astype(float)
        self.root[:, self.t_start[1:]] -= totals[:, None]
        np.cumsum(self.root, axis=1, out=self.root)
        self.histograms = {}
        self.active = np.empty(0, np.int32), np.empty(0, np.int32)

    def _gain(self, g, h, all_g, all_h) -> np.ndarray:
        ridge = self.cfg.ridge * UNIT
        gain, rest, rest_h = g * g, all_g - g, all_h - h
        gain /= h + ridge
        rest *= rest
        rest_h += ridge
        rest /= rest_h
        gain += rest
        gain /= UNIT
        gain -= all_g * all_g / (all_h + ridge) / UNIT
        return gain

    def _allowed(self, h, all_h) -> np.ndarray:
        least = self.cfg.least_hessian * UNIT
        return (h >= least) & (all_h - h >= least)

    def _values_of(self, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How many values each of some rows has, and their bins."""
        held = self.values[row]
        ends = np.cumsum(held)
        return held, self.of_row[np.arange(held.sum()) + np.repeat(self.first[row] - ends + held, held)]

    def _histogram(self, row: np.ndarray, slope: np.ndarray, totals: np.ndarray) -> np.ndarray:
        """Sums of some rows up to each bin of a feature, those of values that are not stored included."""
        if len(row) == len(self.values):
            return self.root
        held, code = self._values_of(row)
        sums = np.empty((2, self.t_total))
        for s, own in zip(slope, sums, strict=True):
            own[:] = np.bincount(code, np.repeat(s[row], held), self.t_total)
        sums[:, self.t_zero] += totals[:, None] - np.add.reduceat(sums, self.t_start, axis=1)
        # Each feature has the same totals: taken off again, its sums start at its first bin.
        sums[:, self.t_start[1:]] -= totals[:, None]
        return np.cumsum(sums, axis=1, out=sums)

    def _dense(self, below: np.ndarray, totals: np.ndarray) -> tuple[float, int]:
        """Gain and bin of the best split of a node by its histogram."""
        allowed = self._allowed(below[1], totals[1])
        some = np.count_nonzero(allowed)
        if not some:
            return -np.inf, 0
        if 3 * some > len(allowed):
            gain = self._gain(*below, *totals)
            np.copyto(gain, -np.inf, where=~allowed)
            best = int(np.argmax(gain))
            return float(gain[best]), best
        allowed = np.flatnonzero(allowed)
        gain = self._gain(*below[:, allowed], *totals)
        best = int(np.argmax(gain))
        return float(gain[best]), int(allowed[best])

    def _sparse(self, at, row, code, slope, totals) -> tuple[np.ndarray, ...]:
        """Nodes, and gain, bin and left side of their best splits, from their values.

        Values whose feature has no cut in their node are left out from there on.
        """
        # Values of a node are in the order of their bins, so grouping by node keeps that order.
        order = _order(at)
        at, row, code = at[order], row[order], code[order]
        bin_starts = np.flatnonzero(_changes(at) | _changes(code))
        sums = np.stack([np.add.reduceat(s.take(row), bin_starts) for s in slope])
        values = row, code
        at, code = at[bin_starts], code[bin_starts]
        feature = self.t_place[code]
        group = np.flatnonzero(_changes(at) | _changes(feature))
        sizes = np.diff(np.append(group, len(at)))
        below = np.cumsum(sums, axis=1)
        per_group = np.add.reduceat(sums, group, axis=1)
        ends = np.cumsum(per_group, axis=1)
        below -= np.repeat(ends - per_group, sizes, axis=1)
        # What the values that are not stored add: all of them lie in the bin of 0.
        node, zero = at[group], self.t_zero[feature[group]]
        rest = totals[:, node] - per_group
        zeros = np.repeat(zero, sizes)
        at_zero = np.add.reduceat(np.where(code <= zeros, sums, 0.0), group, axis=1) + rest
        below += np.where(code >= zeros, np.repeat(rest, sizes, axis=1), 0.0)

        allowed, zero_allowed = (
            self._allowed(h, totals[1, a]) for h, a in ((below[1], at), (at_zero[1], node))
        )
        alive = np.logical_or.reduceat(allowed, group) | zero_allowed
        ends = np.append(bin_starts[group], len(row))
        kept = np.repeat(alive, np.diff(ends))
        self.active = tuple(v[kept] for v in values)

        def best(at, code, sums, allowed):
            allowed = np.flatnonzero(allowed)
            at, code, sums = at[allowed], code[allowed], sums[:, allowed]
            gain, told = np.full(totals.shape[1], -np.inf), np.zeros(totals.shape[1], np.int64)
            left = np.zeros(totals.shape)
            if len(at):
                gains = self._gain(*sums, totals[0, at], totals[1, at])
                starts = np.flatnonzero(_changes(at))
                top = np.maximum.reduceat(gains, starts)
                tops = np.flatnonzero(gains == np.repeat(top, np.diff(np.append(starts, len(at)))))
                tops = tops[_changes(at[tops])]
                found = at[tops]
                gain[found], told[found], left[:, found] = gains[tops], code[tops], sums[:, tops]
            return gain, told, left

        a, b = best(at, code, below, allowed), best(node, zero, at_zero, zero_allowed)
        first = (b[0] > a[0]) | ((b[0] == a[0]) & (b[1] < a[1]))
        found = np.unique(node)
        return found, *[np.where(first, y, x)[..., found] for x, y in zip(a, b, strict=True)]

    def _own(self, opened, inside, leaf, slope, totals, kin) -> _Splits:
        """Best splits of the open nodes among the features of this task.

        ``inside`` are the rows of the nodes that the last level made, ``leaf`` has the node of each.
        ``kin`` has the parent and the sibling of each open node (-1 for the root).
        """
        nodes, count = len(opened), int(max(leaf.max(), kin.max())) + 1
        gain, code = np.full(nodes, -np.inf), np.zeros(nodes, np.int64)
        left = np.zeros((2, nodes))
        if not self.t_total:
            return _Splits(gain, code, left)
        held = np.bincount(leaf, self.values[inside], count)
        big = held[opened] >= max(self.t_total / 2, LEAST_VALUES)
        direct, by_rest = set(), []
        for k in np.flatnonzero(big).tolist():
            parent, sibling = kin[k].tolist()
            own = int(opened[k])
            if parent in self.histograms and held[sibling] < held[own]:
                by_rest.append((own, parent, sibling))
                direct.add(sibling)
            else:
                direct.add(own)
        known: dict[int, np.ndarray] = {}
        if direct:
            by_leaf = _order(leaf)
            edges = np.concatenate(([0], np.cumsum(np.bincount(leaf, minlength=count))))
            for own in sorted(direct):
                row = inside[by_leaf[edges[own] : edges[own + 1]]]
                own_sums = np.array([s[row].sum() for s in slope])
                known[own] = self._histogram(row, slope, own_sums)
            known |= {own: self.histograms[p] - known[s] for own, p, s in by_rest}
        # Values of nodes that had a histogram so far, or the active ones of those that had none.
        fresh = np.array([p < 0 or p in self.histograms for p in kin[:, 0].tolist()])
        at = np.flatnonzero(big).tolist()
        self.histograms = {int(opened[k]): known[int(opened[k])] for k in at}
        for k in at:
            below = known[int(opened[k])]
            gain[k], code[k] = self._dense(below, totals[:, k])
            left[:, k] = below[:, code[k]]
        if not big.all():
            parts = []
            if (~big & ~fresh).any():
                node_of = np.full(len(self.values), -1)
                node_of[inside] = self._numbers(opened, ~big & ~fresh, count)[leaf]
                row, codes = self.active
                node_of = node_of[row]
                own = np.flatnonzero(node_of >= 0)
                parts.append((node_of[own], row[own], codes[own]))
            if (~big & fresh).any():
                node_of = self._numbers(opened, ~big & fresh, count)[leaf]
                some = np.flatnonzero(node_of >= 0)
                own, codes = self._values_of(inside[some])
                order = _order(codes)
                some = np.repeat(some, own)[order]
                parts.append((node_of[some], inside[some], codes[order]))
            values = [np.concatenate(part) for part in zip(*parts, strict=True)]
            if len(values[0]):
                found, *best = self._sparse(*values, slope, totals)
                gain[found], code[found], left[:, found] = best
        return _Splits(gain, self.t_global[code], left)

    @staticmethod
    def _numbers(opened: np.ndarray, some: np.ndarray, count: int) -> np.ndarray:
        """Place among the open nodes of each node, -1 for all but some of them."""
        numbers = np.full(count, -1)
        numbers[opened[some]] = np.flatnonzero(some)
        return numbers

    def _right(self, row: np.ndarray, place: np.ndarray, code: np.ndarray) -> np.ndarray:
        """Whether the bin of the split's feature lies above the cut, for rows in split nodes."""
        rows, feature = self.rows, self.feature_of[code]
        column, cut = self.column[feature], code - self.bins.start[feature]
        asks = np.bincount(place, minlength=len(code)) > 0
        if not (column[asks] < 0).any():
            return self.columns[column[place], row] > cut[place]
        own = self.bins.zero[feature][place]
        held = np.flatnonzero(column[place] >= 0)
        at = place[held]
        own[held] = self.columns[column[at], row[held]] + self.bins.start[feature][at]
        number_of = np.full(len(rows.target), -1)
        number_of[row] = np.arange(len(row))
        for f in np.unique(feature[asks & (column < 0)]).tolist():
            part = slice(self.edges[f], self.edges[f + 1])
            number = number_of[rows.row[part]]
            told = np.flatnonzero(number >= 0)
            told = told[feature[place[number[told]]] == f]
            own[number[told]] = rows.code[part][told]
        return own > code[place]

    def _sides(self, row, place, code, winner) -> np.ndarray:
        """``_right`` of all tasks: each tells it of the nodes whose split is among its features."""
        if self.exchange is _alone:
            return self._right(row, place, code)
        task = winner[place]
        mine = np.flatnonzero(task == self.task)
        told = self.exchange(np.packbits(self._right(row[mine], place[mine], code)).tobytes())
        right = np.empty(len(row), bool)
        for number, message in enumerate(told):
            own = np.flatnonzero(task == number)
            right[own] = np.unpackbits(np.frombuffer(message, np.uint8), count=len(own))
        return right

    def tree(self) -> list[tuple]:
        """Nodes of the next tree; the margin of the rows moves on by it."""
        cfg, rows, unit = self.cfg, self.rows, UNIT
        p = 1.0 / (1.0 + np.exp(-self.margin))
        slope = np.stack([np.rint((p - rows.target) * unit), np.rint(p * (1 - p) * unit)])
        totals = slope.sum(axis=1).reshape(2, 1)
        leaf = np.zeros(len(rows.target), np.int64)  # node of each row
        opened = np.array([0])  # nodes that may be split
        kin = np.array([[-1, -1]])  # parent and sibling of each
        self._begin(slope)
        # Rows of the nodes that the last level made, the node of each and its place among the open ones.
        inside, own, place = np.arange(len(leaf)), leaf.copy(), leaf.copy()

        def value(g: float, h: float) -> float:
            return float(-g / (h + cfg.ridge * unit) * cfg.rate)

        nodes = [[0, np.inf, 0, 0, value(*totals[:, 0]), 0.0]]
        for _ in range(cfg.depth):
            mine = self._own(opened, inside, own, slope, totals, kin)
            told = self.exchange(mine.packed()) if self.exchange is not _alone else None
            offers = [mine] if told is None else [_Splits.unpacked(t, len(opened)) for t in told]
            splits, winner = _best_of(offers)
            parts = splits.gain > LEAST_GAIN
            if not parts.any():
                break
            children = np.zeros((len(opened), 2), np.int64)
            sums, still, related = [], [], []
            for k in np.flatnonzero(parts).tolist():
                code = int(splits.code[k])
                feature = int(self.feature_of[code])
                cut = float(self.bins.cuts[feature][code - self.bins.start[feature]])
                left = splits.left[:, k]
                base = len(nodes)
                for side, part in enumerate((left, totals[:, k] - left)):
                    number = children[k, side] = base + side
                    nodes.append([0, np.inf, number, number, value(*part), 0.0])
                    if part[1] >= 2 * cfg.least_hessian * unit:
                        still.append(number)
                        related.append((int(opened[k]), base + 1 - side))
                        sums.append(part)
                pair = children[k].tolist()
                nodes[opened[k]] = [feature, cut, *pair, nodes[opened[k]][4], float(splits.gain[k])]
            # A place of -1 is that of a settled row, and asks for the last entry.
            moved = np.flatnonzero(np.append(parts, False)[place])
            inside, place = inside[moved], place[moved]
            right = self._sides(inside, place, splits.code, winner)
            own = children[place, right.astype(np.int64)]
            leaf[inside] = own
            if not still:
                break
            opened, totals = np.array(still), np.stack(sums, axis=1)
            kin = np.array(related)
            number = np.full(len(nodes), -1)
            number[opened] = np.arange(len(opened))
            place = number[own]
        values = np.array([node[4] for node in nodes])
        self.margin += values[leaf]
        return [tuple(node) for node in nodes]


def grow(
    rows: _Rows, bins: _Bins, cfg: BoostConfig, exchange: Exchange = _alone, task: int = 0
) -> Iterator[list]:
    """The nodes of each tree, one tree after the other."""
    grower = _Grower(rows, bins, cfg, exchange, task)
    for _ in range(cfg.trees):
        yield grower.tree()


def _dealt(vectors: DataFrame, tasks: int) -> DataFrame:
    """All rows for every task, and the values of each feature for one task."""
    told = vectors.select(F.monotonically_increasing_id().alias("id"), "target", "features")
    told = materialise(told, "boost-rows")
    rows = told.select(
        F.explode(F.sequence(F.lit(0), F.lit(tasks - 1))).alias("slot"),
        "id",
        F.col("target").cast("int").alias("target"),
        F.lit(None).cast("int").alias("feature"),
        F.lit(None).cast("double").alias("value"),
    )
    values = told.select("id", F.inline(stored("features"))).select(
        F.pmod("feature", F.lit(tasks)).cast("int").alias("slot"),
        "id",
        F.lit(None).cast("int").alias("target"),
        "feature",
        "value",
    )
    dealt = rows.unionByName(values)
    return dealt.repartitionById(tasks, "slot").select("id", "target", "feature", "value")


def fit(vectors: DataFrame, rows: int, cfg: BoostConfig) -> BoostedTrees:
    """Trees for ``target`` (0 or 1) over ``features``; ``vectors`` is a written table."""
    spark = vectors.sparkSession
    width = vectors.select(width_of("features")).first()[0]
    bins = _Bins.of(feature_cuts(vectors, width, cfg.bins))
    folder = message_folder(spark)
    per_task = cfg.rows_per_slow_task if folder is None else cfg.rows_per_task
    tasks = max(1, min(cfg.tasks, slots(spark), -(-rows // per_task)))

    def exchange_of(context: BarrierTaskContext) -> Exchange:
        return _among(context) if folder is None else among(folder, context)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _read(batches, bins)
        context = BarrierTaskContext.get() if tasks > 1 else None
        exchange = _alone if context is None else exchange_of(context)
        task = 0 if context is None else context.partitionId()
        for number, nodes in enumerate(grow(own, bins, cfg, exchange, task)):
            if task == 0:
                yield _table(number, nodes)

    grown = _dealt(vectors, tasks).mapInArrow(run, NODES, barrier=tasks > 1).toPandas()
    return BoostedTrees.of(spark, grown.sort_values(["tree", "node"]), width)


def _table(number: int, nodes: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*nodes, strict=True))
    n = len(nodes)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([number] * n, pa.int32()),
            pa.array(range(n), pa.int32()),
            pa.array(columns[0], pa.int32()),
            pa.array(columns[1], pa.float64()),
            pa.array(columns[2], pa.int32()),
            pa.array(columns[3], pa.int32()),
            pa.array(columns[4], pa.float64()),
            pa.array(columns[5], pa.float64()),
        ],
        [c.split()[0] for c in NODES.split(", ")],
    )


# Model ----------------------------------------------------------------------------------


@dataclass(frozen=True)
class BoostedTrees:
    """Nodes of all trees in arrays; a leaf leads to itself."""

    spark: SparkSession
    nodes: object  # the table of NODES as pandas
    width: int
    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray

    @classmethod
    def of(cls, spark: SparkSession, nodes, width: int) -> BoostedTrees:
        sizes = nodes.groupby("tree").size().to_numpy()
        roots = np.cumsum(sizes) - sizes
        offset = np.repeat(roots, sizes)
        return cls(
            spark, nodes, width, roots,
            nodes["feature"].to_numpy(np.int64), nodes["threshold"].to_numpy(np.float64),
            nodes["left"].to_numpy(np.int64) + offset, nodes["right"].to_numpy(np.int64) + offset,
            nodes["value"].to_numpy(np.float64),
        )

    @property
    def importances(self) -> np.ndarray:
        """Share of each feature in the gain of all splits."""
        gain = np.zeros(self.width)
        np.add.at(gain, self.feature, self.nodes["gain"].to_numpy(np.float64))
        return gain / gain.sum() if gain.sum() else gain

    def margin(self, rows: np.ndarray) -> np.ndarray:
        """Log odds of dense rows: all rows go down all trees one level at a time."""
        node = np.broadcast_to(self.roots, (len(rows), len(self.roots)))
        at = np.arange(len(rows))[:, None]
        while True:
            stays = rows[at, self.feature[node]] <= self.threshold[node]
            below = np.where(stays, self.left[node], self.right[node])
            if (below == node).all():
                return self.value[node].sum(axis=1)
            node = below

    def with_probability(self, vectors: DataFrame, name: str) -> DataFrame:
        """The columns but ``features``, and the probability of target 1."""
        # Rows are written out by the features that the trees ask for: others don't tell.
        asked, feature = np.unique(self.feature, return_inverse=True)
        # As large as the model, whatever the table.
        shared = self.spark.sparkContext.broadcast(
            (asked, self.roots, feature, self.threshold, self.left, self.right, self.value)
        )
        kept = [field for field in vectors.schema.fields if field.name != "features"]
        names = [field.name for field in kept]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            asked, *arrays = shared.value
            model = BoostedTrees(None, None, len(asked), *arrays)
            most = max(1, DENSE // max(model.width, len(model.roots)))
            for batch in batches:
                for first in range(0, batch.num_rows, most):
                    piece = batch.slice(first, most)
                    row, feature, value = entries(piece["features"])
                    place = np.minimum(np.searchsorted(asked, feature), model.width - 1)
                    known = asked[place] == feature
                    dense = np.zeros((piece.num_rows, model.width))
                    dense[row[known], place[known]] = value[known]
                    p = 1.0 / (1.0 + np.exp(-model.margin(dense)))
                    yield pa.RecordBatch.from_arrays(
                        [*[piece[n] for n in names], pa.array(p)], [*names, name]
                    )

        schema = StructType([*kept, StructField(name, DoubleType())])
        return vectors.select(*names, "features").mapInArrow(run, schema)

    def save(self, path: str) -> None:
        table = self.spark.createDataFrame(self.nodes, NODES).withColumn("width", F.lit(self.width))
        table.coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> BoostedTrees:
        nodes = spark.read.parquet(path).toPandas().sort_values(["tree", "node"])
        return cls.of(spark, nodes.drop(columns="width"), int(nodes["width"].iloc[0]))
