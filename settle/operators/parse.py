"""Parsing a column once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def parse_once(rows: DataFrame, parsed: Column, name: str) -> DataFrame:
    """Add ``parsed`` as column ``name``, evaluated exactly once per row.

    A plain projection would not do: filters on members of ``parsed`` are pushed below it, and
    each then carries its own copy of the parse. They are not pushed through a generator.
    """
    return rows.select("*", F.explode(F.array(parsed)).alias(name))
