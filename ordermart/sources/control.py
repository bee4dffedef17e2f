"""ETL extract log and high-water marks.

The log is a small append-only parquet table (one row per stage load). The
mark of a stage table is the latest ``lastextractdatetime`` among its
``Completed`` rows, or 1900-01-01 when there is none.
"""

from __future__ import annotations

import datetime as dt
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import timeparts as tp
from . import schemas, storage

COMPLETED, FAILED = "Completed", "Failed"

# Appends to one parquet directory must not overlap: two concurrent jobs would
# share the committer's temporary folder. Stage jobs run in threads, so the
# (tiny) log appends are serialised here.
_LOG_LOCK = threading.Lock()


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """The log; empty only if none was written yet (an unreadable one raises)."""
    log = storage.read_parquet(spark, path, schemas.ETL_EXTRACT_LOG)
    return schemas.empty(spark, schemas.ETL_EXTRACT_LOG) if log is None else log


LANDED = "source string, file string, batch_id bigint"


def landed(spark: SparkSession, path: str) -> DataFrame:
    """(source, file, batch_id) of the landed files that a batch was started for."""
    rows = storage.read_parquet(spark, path, T.StructType.fromDDL(LANDED))
    return schemas.empty(spark, T.StructType.fromDDL(LANDED)) if rows is None else rows


def batch_of_files(spark: SparkSession, path: str, log: str, source: str, files: DataFrame) -> tuple[int | None, DataFrame]:
    """(batch id, files to load with it) of a micro-batch's ``files`` (one column, file). Files
    of a completed batch are left out. The others keep the batch id that they were recorded under if they are all
    of that batch's files; otherwise they are recorded under a new id, after every id in use. None: nothing is left.
    The record is written before the batch starts, so a load that fails, or a stream
    whose checkpoint is lost, finds it."""
    known = landed(spark, path).where(F.col("source") == source)
    done = completed_ids(spark, log)
    left = files.distinct().join(known.where(F.col("batch_id").isin(done)), "file", "left_anti")
    n = left.count()
    if not n:
        return None, left
    owners = left.join(known, "file").groupBy("batch_id").count().where(F.col("count") == n).select("batch_id")
    whole = known.join(owners, "batch_id").groupBy("batch_id").count().where(F.col("count") == n).agg(F.max("batch_id")).first()[0]
    if whole is not None:
        return whole, left
    batch_id = max([*done, *reserved_ids(spark, path)], default=0) + 1
    left = left.select("file")
    with _LOG_LOCK:
        left.select(F.lit(source).alias("source"), "file", F.lit(batch_id).cast("bigint").alias("batch_id")).write.mode("append").parquet(path)
    return batch_id, left


def reserved_ids(spark: SparkSession, path: str) -> list[int]:
    """Batch ids that landed files were recorded under. One number a batch."""
    return [r[0] for r in landed(spark, path).select("batch_id").distinct().collect()]


def allocate(spark: SparkSession, path: str, batch_id: int, n: int, after: int) -> int:
    """Reserve ``n`` surrogate ids for a batch; returns the id before the first.

    The log has one file a reservation, created only if absent, so two writers never get the same
    ids; a batch that runs again gets its own range again if it still fits. ``after``: the
    largest id already in a table (ids from before the log)."""
    while True:
        slots = storage.children(spark, path)
        taken = [tuple(map(int, storage.read_text(spark, f"{path}/{x}").split())) for x in slots]
        for batch, start, size in reversed(taken):
            if batch == batch_id and size >= n:
                return start
        start = max([after, *(s + k for _, s, k in taken)])
        if storage.create_new(spark, f"{path}/{len(slots):09d}", f"{int(batch_id)} {start} {int(n)}"):
            return start


def completed_ids(spark: SparkSession, path: str) -> list[int]:
    """Batches that are whole: their target load is done. One number a batch."""
    done = read_log(spark, path).where(F.col("status") == COMPLETED).select("processlogid").distinct()
    return sorted(r[0] for r in done.collect() if r[0] is not None)


def marks_of(log: DataFrame, tables: list[str], before_logid: int | None = None) -> DataFrame:
    """(tablename, mark) for each requested table in one aggregate; with
    ``before_logid`` only rows of earlier batches count."""
    done = log.where((F.col("status") == COMPLETED) & F.col("tablename").isin(tables))
    if before_logid is not None:
        done = done.where(F.col("processlogid") < F.lit(int(before_logid)))
    per = done.groupBy("tablename").agg(F.max("lastextractdatetime").alias("mark"))
    return per


def high_water_marks(spark: SparkSession, path: str, tables: list[str],
                     before_logid: int | None = None) -> dict[str, str]:
    """Marks for several stage tables; a driver dict of at most len(tables) rows.

    ``before_logid``: ignore the log rows of that batch and later ones, so a
    rerun of a batch sees exactly the marks its first attempt saw.
    """
    default = tp.DEFAULT_MARK
    rows = marks_of(read_log(spark, path), tables, before_logid).collect()
    got = {r["tablename"]: r["mark"] for r in rows if r["mark"] is not None}
    return {t: (got[t].isoformat(sep=" ") if t in got else default) for t in tables}


def high_water_mark(spark: SparkSession, path: str, table: str) -> str:
    return high_water_marks(spark, path, [table])[table]


def append_log(spark: SparkSession, path: str, logid: int, table: str, rowcount: int,
               status: str, at: dt.datetime) -> None:
    """Append one log row. Called after the write it reports returned, so
    ``Completed`` means the rows are durable."""
    append_log_rows(spark, path, [(logid, table, rowcount, at, status)])


def append_log_rows(spark: SparkSession, path: str, rows: list[tuple]) -> None:
    """Append (processlogid, tablename, extractrowcount, lastextractdatetime,
    status) rows in one write."""
    if not rows:
        return
    data = [(int(i), t, int(n), at, st) for i, t, n, at, st in rows]
    with _LOG_LOCK:
        spark.createDataFrame(data, schemas.ETL_EXTRACT_LOG).coalesce(1).write.mode("append").parquet(path)
