"""Bit fields of fixed size that tell tasks which hashes are worth sending on.

A field has a bit for the first bits of a hash. Its size is fixed whatever the corpus; as it fills up it
lets more through, so it may only ever save work, never decide an answer.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def field_of(values: DataFrame, bits: int) -> np.ndarray:
    """The field of the longs in column ``value``; equal words of the field merge in the tasks."""
    places = values.select(F.shiftrightunsigned("value", 64 - bits).alias("place"))
    words = places.select(
        F.shiftright("place", 6).alias("word"),
        F.expr("shiftleft(1L, cast(place & 63 AS int))").alias("bit"),
    )
    found = words.groupBy("word").agg(F.bit_or("bit").alias("bit")).toArrow()
    field = np.zeros(1 << (bits - 6), np.uint64)
    field[found.column("word").to_numpy()] = found.column("bit").to_numpy().view(np.uint64)
    return field


def in_field(field: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Whether the bit of each unsigned value is set."""
    bits = len(field).bit_length() - 1 + 6
    at = values >> np.uint64(64 - bits)
    return (field[at >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)
