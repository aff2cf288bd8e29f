"""Vector columns on their way to numpy."""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

# Tasks get the functions of this module with their closures, as workers need not have this library.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def vector_parts(name: str) -> list[Column]:
    """Slots ``i`` and values ``x`` of a vector column. A dense vector has no list of slots, which is empty here and not NULL: the time that
    Spark's Arrow writer takes for a NULL list grows with the batch."""
    parts = F.unwrap_udt(F.col(name))
    return [F.coalesce(parts["indices"], F.array().cast("array<int>")).alias("i"), parts["values"].alias("x")]


def entries(slots: pa.Array, values: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, slot and value of each entry of the vectors of :func:`vector_parts`. A dense vector has an entry for each slot."""
    listed, lengths = np.diff(slots.offsets.to_numpy()), np.diff(values.offsets.to_numpy())
    row, dense = np.repeat(np.arange(len(lengths)), lengths), listed != lengths
    at, x = slots.flatten().to_numpy(zero_copy_only=False), values.flatten().to_numpy(zero_copy_only=False)
    if dense.any():
        every = np.arange(len(x)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        every[~dense[row]] = at
        at = every
    return row, at, x
