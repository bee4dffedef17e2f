"""Sinks: stage per batch, target load per batch, OLTP append and purge.

Each batch has its own stage folder, overwritten when the batch is rerun. Targets are loaded per batch into
their own ``batch_id=<id>`` directory with a static overwrite: a retried load
replaces its own rows and leaves other batches untouched, so loads are
idempotent. Inside a batch directory rows are partitioned by the table's
declared storage key (month or address-id bucket).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import timeparts as tp
from . import control, schemas

STAGE_DIR, TARGET_DIR, CONTROL_DIR = "stage", "target", "_control"


def stage_path(root: str, name: str, batch_id: int) -> str:
    return os.path.join(root, STAGE_DIR, f"batch_id={int(batch_id)}", schemas.STAGE_PREFIX + name)


def target_path(root: str, name: str) -> str:
    return os.path.join(root, TARGET_DIR, name)


def log_path(root: str) -> str:
    return os.path.join(root, CONTROL_DIR, "etlextractlog")


def landed_path(root: str) -> str:
    return os.path.join(root, CONTROL_DIR, "landed_files")


def ids_path(root: str, name: str) -> str:
    return os.path.join(root, CONTROL_DIR, "ids", name)


def write_stage(spark: SparkSession, df: DataFrame, root: str, name: str, batch_id: int,
                schema: T.StructType | None = None) -> int:
    """Overwrite the batch's ``stg_<name>`` with ``df`` (columns by name); return
    the number of rows the write job wrote."""
    seen = Observation()
    out = schemas.conform(df, schema or schemas.TARGETS[name].schema).observe(seen, F.count(F.lit(1)).alias("n"))
    out.write.mode("overwrite").parquet(stage_path(root, name, batch_id))
    return seen.get["n"]


def read_stage(spark: SparkSession, root: str, name: str, batch_id: int,
               schema: T.StructType | None = None) -> DataFrame:
    return spark.read.schema(schema or schemas.TARGETS[name].schema).parquet(stage_path(root, name, batch_id))


def partition_fields(name: str) -> list[T.StructField]:
    """The storage columns of a target below its ``batch_id=`` folders."""
    spec = schemas.TARGETS[name]
    kind = {None: [], "p_month": [T.StructField("p_month", T.DateType())],
            "p_bucket": [T.StructField("p_bucket", T.LongType())]}[spec.partition_col]
    return [T.StructField("batch_id", T.LongType()), *kind]


def write_declared(df: DataFrame, name: str, path: str, mode: str = "overwrite", with_batch: bool = False) -> None:
    """Write a target table's rows by name, partitioned by its declared key;
    ``with_batch`` keeps their ``batch_id`` as a column.

    ``rebalance`` on the partition value lets AQE size the output: few files
    per month, and a month holding a large share of rows is split over
    several tasks instead of one.
    """
    spec = schemas.TARGETS[name]
    out = schemas.conform(df, spec.schema if not with_batch else T.StructType([*spec.schema.fields, partition_fields(name)[0]]))
    if spec.partition_col:
        out = out.withColumn(spec.partition_col, spec.partition_column())
        out.hint("rebalance", spec.partition_col).write.mode(mode) \
            .partitionBy(spec.partition_col).parquet(path)
    else:
        out.hint("rebalance").write.mode(mode).parquet(path)


def load_target(spark: SparkSession, root: str, name: str, batch_id: int, again: bool = False) -> None:
    """Stage -> target: all stage rows into the target's ``batch_id=<id>`` directory.
    ``again``: the batch was completed before, so segments may hold its old rows."""
    from . import segments  # segments builds on this module

    path = os.path.join(target_path(root, name), f"batch_id={int(batch_id)}")
    if again:
        segments.forget(spark, root, name, batch_id)
    write_declared(read_stage(spark, root, name, batch_id), name, path)
    if again:  # also out of a segment that was merged meanwhile
        segments.forget(spark, root, name, batch_id)


def _completed_rows(spark: SparkSession, root: str, name: str, except_batch: int | None = None) -> DataFrame | None:
    """A target's rows of completed batches with the storage columns; None before the first load."""
    from . import segments  # segments builds on this module

    done = [i for i in control.completed_ids(spark, log_path(root)) if i != except_batch]
    return segments.read(spark, root, name, segments.layout(spark, root, name, done)[1])


def read_target(spark: SparkSession, root: str, name: str,
                except_batch: int | None = None) -> DataFrame:
    """A target table as the union of its completed batches (partition columns
    dropped); empty with the declared schema before the first load. A batch
    whose load is not logged as ``Completed`` is not visible, so a load that
    failed half way shows no rows. ``except_batch`` leaves that batch out.
    Batches are read from their ``batch_id`` directories or the segments that
    hold them; other directories are not listed."""
    spec = schemas.TARGETS[name]
    df = _completed_rows(spark, root, name, except_batch)
    return schemas.empty(spark, spec.schema) if df is None else schemas.conform(df, spec.schema)


def read_state(spark: SparkSession, root: str, name: str) -> DataFrame | None:
    """State stored by batch; None unless every completed batch has it (older ones have none)."""
    from . import segments  # segments builds on this module

    done = control.completed_ids(spark, log_path(root))
    folders = segments.layout(spark, root, name, done)[1]
    if {b for s in folders for b in s.batches} != set(done):
        return None
    rows = segments.read(spark, root, name, folders)
    return None if rows is None else schemas.conform(rows, schemas.TARGETS[name].schema)


def append_oltp(df: DataFrame, path: str, schema) -> None:
    """Bulk insert into a source table stored as parquet (columns by name)."""
    schemas.conform(df, schema).write.mode("append").parquet(path)


def purge(spark: SparkSession, path: str, schema) -> None:
    """Delete all rows of a parquet table, keeping its schema."""
    schemas.empty(spark, schema).write.mode("overwrite").parquet(path)


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict, batchsize: int = 10000) -> None:
    """Append into a relational table; ``batchsize`` rows per insert batch."""
    df.write.option("batchsize", batchsize).jdbc(url, table, mode="append", properties=properties)


def read_target_range(spark: SparkSession, root: str, name: str, ts_col: str,
                      start: str, end: str | None = None, except_batch: int | None = None) -> DataFrame:
    """Rows of a month-partitioned target with ``start <= ts_col < end`` (None: no end).

    Spark does not derive a predicate on the month partition column from a
    predicate on the timestamp, so the equivalent month range is added
    explicitly: whole month directories outside the range are never listed
    or read (PartitionFilters), and the timestamp predicate is pushed into
    the remaining files.
    """
    spec = schemas.TARGETS[name]
    if spec.partition_col != "p_month":
        raise ValueError(f"{name} is not partitioned by month")
    lo = F.lit(start).cast("timestamp_ntz")
    df = _completed_rows(spark, root, name, except_batch)
    if df is None:
        return schemas.empty(spark, spec.schema)
    cond = (F.col(ts_col) >= lo) & (F.col(spec.partition_col) >= tp.month_start(lo))
    if end is not None:
        hi = F.lit(end).cast("timestamp_ntz")
        cond = cond & (F.col(ts_col) < hi) & (F.col(spec.partition_col) <= tp.month_start(hi))
    return schemas.conform(df.where(cond), spec.schema)
