"""What vectors hold, without writing out their zeros: a vector is as wide as the dictionary."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, functions as F


def _parts(features: str) -> tuple[Column, Column, Column]:
    """Size, indices and values of a column of vectors, sparse or dense."""
    held = F.unwrap_udt(features)
    values = held["values"]
    every = F.sequence(F.lit(0), F.size(values) - 1)
    return F.coalesce(held["size"], F.size(values)), F.coalesce(held["indices"], every), values


def width_of(features: str) -> Column:
    return _parts(features)[0]


def stored(features: str) -> Column:
    """(feature, value) of the values that are not 0, in the order of the features."""
    _, indices, values = _parts(features)
    pairs = F.zip_with(
        indices, values, lambda i, v: F.struct(i.alias("feature"), v.alias("value"))
    )
    return F.filter(pairs, lambda e: e["value"] != 0)


def entries(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, feature and value of all stored values of a column of vectors, sparse or dense."""
    sparse = column.field("type").to_numpy(zero_copy_only=False) == 0
    values = column.field("values")
    sizes = np.diff(values.offsets.to_numpy())
    row = np.repeat(np.arange(len(column)), sizes)
    flat = values.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    feature = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    indices = column.field("indices").flatten().to_numpy(zero_copy_only=False)
    feature[sparse[row]] = indices
    return row, feature, flat
