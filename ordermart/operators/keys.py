"""Dense, ordered surrogate keys without a single-partition sort.

``row_number() over (order by k)`` plans ``Exchange SinglePartition``: every
row passes one task. Here the rows are range-partitioned on the order key,
the partition index is stored as a column and the tagged rows are written to
the shared checkpoint folder (a reliable ``checkpoint()``), so that the two
passes below see the same tags even if executors are lost and tasks rerun.
Only the per-tag counts (one row per partition) pass through a single task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path


def assign_dense_ids(df: DataFrame, order_by: list[str], id_col: str, start_after,
                     num_partitions: int | None = None, scratch: str | None = None) -> DataFrame:
    """Add ``id_col`` = start_after + 1, +2, ... in ``order_by`` order.

    ``order_by`` must identify rows uniquely (e.g. a primary key) for the
    numbering to be deterministic. ``start_after`` is the largest id already
    in use (a scalar, e.g. ``coalesce(max(id), 0)`` of the existing table), or a
    function that gets the number of rows and returns it (a reservation).

    The rows are range-shuffled and sorted once and written with their
    partition and place (``scratch``, or a new folder below the shared
    checkpoint folder); an id is the rows of earlier partitions plus the place,
    so no second shuffle and no window over the rows is needed.
    """
    spark = df.sparkSession
    # Without an explicit count, AQE sizes the range partitions from the data
    # (coalescing small ones); places are taken after the shuffle.
    ranged = (df.repartitionByRange(num_partitions, *order_by) if num_partitions
              else df.repartitionByRange(*order_by))
    placed = ranged.sortWithinPartitions(*order_by).withColumn("_m", F.monotonically_increasing_id())
    path = scratch or scratch_path(spark, "dense-ids")
    placed.write.mode("overwrite").parquet(path)
    rows = spark.read.schema(placed.schema).parquet(path).withColumn("_tag", F.shiftright("_m", 33))
    if callable(start_after):
        start_after = start_after(rows.count())
    counts = rows.groupBy("_tag").agg(F.count(F.lit(1)).alias("_n"))
    # Running offsets over one row per range partition: the only
    # single-partition step, bounded by the partition count, not the data.
    before = Window.orderBy("_tag").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "_tag",
        (F.lit(int(start_after)).cast("bigint")
         + F.coalesce(F.sum("_n").over(before), F.lit(0))).alias("_off"))
    place = F.col("_m").bitwiseAND(F.lit(2**33 - 1))
    return (rows.join(F.broadcast(offsets), "_tag")
            .withColumn(id_col, F.col("_off") + place + 1)
            .drop("_tag", "_off", "_m"))


def max_id(df: DataFrame, col: str) -> int:
    """``coalesce(max(col), 0)`` as a driver scalar (one row)."""
    return int(df.agg(F.coalesce(F.max(col), F.lit(0)).cast("bigint")).first()[0])
