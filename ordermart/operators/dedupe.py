"""Deterministic keep-first deduplication."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: list[str], order_by: list[str],
                  values: list[str] | None = None) -> DataFrame:
    """One row per ``keys``: the row that sorts first by ``order_by`` (ascending,
    nulls first), carrying ``values``.

    An aggregate of ``min(struct(order_by..., values...))`` per key (Spark
    plans it sort-based, as the buffer is a struct). Its partial step
    collapses duplicates map-side, so the shuffle carries at most one row per
    key and map partition, and a key holding a large share of rows is reduced
    on many tasks before it reaches one. A window ``row_number()`` would
    instead shuffle and sort every duplicate of a key into one task. Rows
    equal on ``order_by`` and ``values`` are interchangeable, so the choice is
    deterministic; ``dropDuplicates`` is not (it keeps an arbitrary row).
    """
    values = [v for v in (values or [c for c in df.columns if c not in keys]) if v not in keys]
    packed = F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order_by)],
                      *[F.col(c).alias(f"_v{i}") for i, c in enumerate(values)])
    agg = df.groupBy(*keys).agg(F.min(packed).alias("_first"))
    return agg.select(*keys, *[F.col(f"_first._v{i}").alias(c) for i, c in enumerate(values)])
