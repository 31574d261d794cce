"""Exact order statistics without a sort: count in histograms, narrow to the bin that holds the rank.

A round is one pass over the rows. Every task counts its rows in numpy, per interval that
is still open and per bin of it, and only these counts are shuffled: their number depends on
the ranks that are asked for, not on the rows. All columns and all ranks narrow in the same
pass. Doubles are counted by their 64 bits in an order-preserving form and texts by seven
bytes at a time, so narrowing ends at one value whatever the distribution.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

#: Counts that a round sends to the driver, for all open intervals together (about).
COUNTS = 1 << 16
LEAST_BITS = 8

_FLIP = 0x7FFFFFFFFFFFFFFF
_TOP = np.uint64(1 << 63)
PART = 7  # bytes of a text in a round
_PART_END = (1 << (8 * PART + 3)) - 1
HISTOGRAM = "which int, interval int, bin long, n long, low long, high long"


def _codes(values: np.ndarray) -> np.ndarray:
    """Doubles as whole numbers in the same order; -0.0 is 0.0, and NaN is above all others."""
    clean = np.where(np.isnan(values), np.nan, values + 0.0)
    bits = clean.view(np.int64)
    return bits ^ ((bits >> 63) & _FLIP)


def _value(code: int) -> float:
    code = np.int64(code)
    return float((code ^ ((code >> 63) & _FLIP)).view(np.float64))


def _unsigned(codes) -> np.ndarray:
    return np.asarray(codes, np.int64).view(np.uint64) ^ _TOP


def _parts(keys: pa.Array, depth: int) -> np.ndarray:
    """The next seven bytes of each text as a number, with how many of them there are."""
    own = pc.binary_slice(keys, depth, depth + PART)
    padded = np.array(own.to_pylist(), f"S{PART}")
    digits = np.frombuffer(padded.tobytes(), np.uint8).reshape(-1, PART).astype(np.int64)
    number = digits @ (256 ** np.arange(PART - 1, -1, -1, dtype=np.int64))
    return (number << 3) | pc.binary_length(own).to_numpy(zero_copy_only=False).astype(np.int64)


@dataclass(frozen=True)
class _Open:
    """Intervals of one column (or of the texts of one value), ascending and apart."""

    low: np.ndarray
    high: np.ndarray
    shift: np.ndarray

    @classmethod
    def of(cls, intervals: Sequence[tuple[int, int]], bits: int) -> _Open:
        low, high = (np.array(side, np.int64) for side in zip(*intervals, strict=True))
        width = _unsigned(high) - _unsigned(low)
        shift = [max(0, int(w).bit_length() - bits) for w in width]
        return cls(low, high, np.array(shift, np.uint64))

    def counted(self, codes: np.ndarray) -> tuple[np.ndarray, ...]:
        """Interval, bin, rows, least and greatest code of each bin that has rows."""
        at = np.searchsorted(self.low, codes, side="right") - 1
        inside = at >= 0
        inside[inside] = codes[inside] <= self.high[at[inside]]
        codes, at = codes[inside], at[inside]
        bins = (_unsigned(codes) - _unsigned(self.low)[at]) >> self.shift[at]
        order = np.lexsort((codes, bins, at))
        codes, at, bins = codes[order], at[order], bins[order].astype(np.int64)
        first = np.ones(len(codes), bool)
        first[1:] = (at[1:] != at[:-1]) | (bins[1:] != bins[:-1])
        starts = np.flatnonzero(first)
        ends = np.append(starts[1:], len(codes))[: len(starts)]
        return at[starts], bins[starts], ends - starts, codes[starts], codes[ends - 1]


@dataclass
class _Rank:
    """A rank, counted within the open interval."""

    which: int
    rank: int
    low: int
    high: int
    prefix: bytes = b""
    done: bool = False
    ties: int = field(default=0)


def _batch(which: int, found: tuple[np.ndarray, ...]) -> pa.RecordBatch:
    at, bins, n, low, high = found
    columns = [
        pa.array(np.full(len(at), which, np.int32)),
        pa.array(at.astype(np.int32)),
        *[pa.array(x.astype(np.int64)) for x in (bins, n, low, high)],
    ]
    return pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in HISTOGRAM.split(", ")])


def _bits(ranks: Sequence[_Rank]) -> int:
    return max(LEAST_BITS, (COUNTS // max(1, len(ranks))).bit_length() - 1)


def _narrow(ranks: Sequence[_Rank], opened: Mapping[int, list], histogram: DataFrame) -> None:
    """Put every rank into the bin that holds it."""
    counted = histogram.groupBy("which", "interval", "bin").agg(
        F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high")
    )
    bins: dict[tuple[int, int], list] = {}
    for row in counted.collect():
        bins.setdefault((row.which, row.interval), []).append((row.bin, row.n, row.low, row.high))
    for rank in ranks:
        interval = opened[rank.which].index((rank.low, rank.high))
        for _, n, low, high in sorted(bins.get((rank.which, interval), [])):
            if rank.rank < n:
                rank.low, rank.high, rank.ties = low, high, n
                break
            rank.rank -= n
        else:
            raise IndexError("a rank beyond the rows")


def _by_which(ranks: Sequence[_Rank]) -> dict[int, list[tuple[int, int]]]:
    found: dict[int, set[tuple[int, int]]] = {}
    for rank in ranks:
        found.setdefault(rank.which, set()).add((rank.low, rank.high))
    return {which: sorted(intervals) for which, intervals in found.items()}


def _value_ranks(df: DataFrame, wanted: Mapping[str, Sequence[int]]) -> dict[str, list[_Rank]]:
    names = list(wanted)
    info = np.iinfo(np.int64)
    ranks = {
        name: [_Rank(k, int(r), info.min, info.max) for r in wanted[name]]
        for k, name in enumerate(names)
    }
    everyone = [rank for own in ranks.values() for rank in own]
    narrow = df.select(*[F.col(name).cast("double").alias(f"v{k}") for k, name in enumerate(names)])
    while waiting := [rank for rank in everyone if rank.low != rank.high]:
        opened = _by_which(waiting)
        bits = _bits(waiting)
        intervals = {which: _Open.of(own, bits) for which, own in opened.items()}

        def run(batches: Iterator[pa.RecordBatch], intervals=intervals) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for which, own in intervals.items():
                    values = batch[f"v{which}"].drop_null().to_numpy(zero_copy_only=False)
                    yield _batch(which, own.counted(_codes(values)))

        _narrow(waiting, opened, narrow.mapInArrow(run, HISTOGRAM))
    return ranks


def order_statistics(df: DataFrame, wanted: Mapping[str, Sequence[int]]) -> dict[str, list[float]]:
    """The values at 0-based positions in the ascending order of each column.

    Null values have no position. A position beyond the rows is an error. ``df`` should be
    a written table: each round reads it once.
    """
    found = _value_ranks(df, wanted)
    return {name: [_value(rank.low) for rank in ranks] for name, ranks in found.items()}


def rows_at(
    df: DataFrame, wanted: Mapping[str, Sequence[int]], key: str
) -> dict[str, list[tuple[float, str]]]:
    """(value, key) at 0-based positions in the order of value, then key, for each value column.

    Keys are texts in the order of their UTF-8 bytes; a null key counts as the empty text. Only
    where a position falls among rows of one value are their keys narrowed as well.
    """
    names = list(wanted)
    values = _value_ranks(df, wanted)
    ranks = [rank for name in names for rank in values[name]]
    # From here on a rank is one among the texts of its value.
    codes = [(rank.which, rank.low) for rank in ranks]
    for rank in ranks:
        rank.low, rank.high = 0, _PART_END
    narrow = df.select(
        *[F.col(name).cast("double").alias(f"v{k}") for k, name in enumerate(names)],
        F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary").alias("key"),
    )
    while waiting := [(rank, code) for rank, code in zip(ranks, codes, strict=True) if not rank.done]:
        groups = sorted({(*code, rank.prefix) for rank, code in waiting})
        for rank, code in waiting:
            rank.which = groups.index((*code, rank.prefix))
        asked = [rank for rank, _ in waiting]
        opened = _by_which(asked)
        bits = _bits(asked)
        intervals = {which: _Open.of(own, bits) for which, own in opened.items()}

        def run(
            batches: Iterator[pa.RecordBatch], intervals=intervals, groups=groups
        ) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for which, (column, code, prefix) in enumerate(groups):
                    values = batch[f"v{column}"]
                    filled = pc.fill_null(values, 0.0).to_numpy(zero_copy_only=False)
                    same = pa.array(_codes(filled) == code)
                    same = pc.and_(same, pc.is_valid(values))
                    keys = batch["key"].filter(same)
                    keys = keys.filter(pc.starts_with(keys, prefix))
                    if len(keys):
                        yield _batch(which, intervals[which].counted(_parts(keys, len(prefix))))

        _narrow(asked, opened, narrow.mapInArrow(run, HISTOGRAM))
        for rank in asked:
            if rank.low == rank.high:
                size = rank.low & 7
                rank.prefix += (rank.low >> 3).to_bytes(PART, "big")[:size]
                rank.done = size < PART
                rank.low, rank.high = 0, _PART_END
    texts = iter(zip(ranks, codes, strict=True))
    return {
        name: [
            (_value(code[1]), rank.prefix.decode())
            for rank, code in (next(texts) for _ in values[name])
        ]
        for name in names
    }


def beyond(value: Column, key: Column, bound: tuple[float, str]) -> Column:
    """True for rows after the bound in the order of value, then key."""
    at, text = F.lit(bound[0]), F.lit(bound[1])
    own = F.coalesce(key.cast("string"), F.lit(""))
    return (value > at) | ((value == at) & (own > text))


def tile_sizes(rows: int, tiles: int) -> list[int]:
    """NTILE: how many rows each tile has; the first ``rows % tiles`` have one more."""
    size, longer = divmod(rows, tiles)
    return [size + (tile < longer) for tile in range(tiles)]


def tile_bounds(
    df: DataFrame, values: Sequence[str], key: str, rows: int, tiles: int
) -> dict[str, list[tuple[float, str]]]:
    """The last row of each tile but the last, in the order of every value column."""
    ends = np.cumsum(tile_sizes(rows, tiles))[:-1]
    # A tile without rows ends where the one before it does.
    wanted = [int(end) - 1 for end in ends if 0 < end < rows]
    return rows_at(df, {name: wanted for name in values}, key) if wanted else {n: [] for n in values}


def tile_of(value: Column, key: Column, bounds: Sequence[tuple[float, str]]) -> Column:
    """The number of the tile, from 1, by the last rows of the tiles."""
    if not bounds:
        return F.lit(1).cast("long")
    ends = F.array(*[F.struct(F.lit(v).alias("v"), F.lit(k).alias("k")) for v, k in bounds])
    own = F.coalesce(key.cast("string"), F.lit(""))
    passed = F.filter(ends, lambda end: (value > end["v"]) | ((value == end["v"]) & (own > end["k"])))
    return F.size(passed).cast("long") + 1


def above_tiles(
    df: DataFrame, values: Sequence[str], key: str, rows: int, tiles: int, lowest: int
) -> DataFrame:
    """Rows that lie above the ``lowest`` tiles in the order of every value column."""
    end = sum(tile_sizes(rows, tiles)[:lowest])
    if end >= rows:
        return df.limit(0)
    if end <= 0:
        return df
    for name, (bound,) in rows_at(df, {name: [end - 1] for name in values}, key).items():
        df = df.filter(beyond(F.col(name), F.col(key), bound))
    return df


def first_rows(df: DataFrame, key: str, rows: int) -> DataFrame:
    """The first ``rows`` rows (or all, if fewer) in the order of a text that no two rows share.

    ``df`` is a written table.
    """
    if rows <= 0:
        return df.limit(0)
    if df.count() <= rows:
        return df
    flat = df.select(F.lit(0.0).alias("value"), F.col(key).alias("key"))
    ((_, last),) = rows_at(flat, {"value": [rows - 1]}, "key")["value"]
    return df.filter(F.coalesce(F.col(key), F.lit("")) <= last)
