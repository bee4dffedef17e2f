"""Joins of tables that grow with the data."""

from __future__ import annotations

from pyspark.sql import DataFrame


def merged(df: DataFrame) -> DataFrame:
    """Side of a join whose size follows the data: both sides are shuffled and merged.

    Spark would otherwise broadcast it through the driver while its files, or its shuffled blocks,
    are below the broadcast threshold: that counts compressed bytes of the chosen columns, which for keys, names and dates is a
    small part of the rows, and a batch has many such joins. Tables with a bound
    of their own (nation, region, per-partition offsets) are broadcast explicitly instead.
    """
    return df.hint("merge")
