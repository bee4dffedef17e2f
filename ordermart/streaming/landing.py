"""Micro-batch driver of the incremental batch over a landing folder of order events.

Order status events are an append-only log. When new event files land in a
folder, a Structured Streaming file source hands exactly the new files to
``foreachBatch``; each micro-batch runs the batch (stage + target load) with
those events as the order delta. The stream's own checkpoint (in the shared
checkpoint folder) records which files were handed out; the warehouse's control
folder records which batch loads which file. A micro-batch executed again after a
failure has the same files and so the same batch id, and overwrites its own batch
directory instead of appending twice. If the stream's checkpoint is lost, files of
completed batches come again and are left out.

Customers, products and order lines are read as snapshots at each micro-batch
and filtered by the extract log's marks, as in ``run_batch``.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans import pipeline
from ..sources import control, schemas, sinks

FILE = "_landed_file"
SnapshotFn = Callable[[SparkSession], dict[str, DataFrame]]


def order_event_stream(spark: SparkSession, landing_dir: str, max_files: int | None = None) -> DataFrame:
    """New order_details files (parquet) in ``landing_dir`` as a stream, with each row's file."""
    r = spark.readStream.schema(schemas.ORDER_DETAILS)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(landing_dir).select("*", F.col("_metadata.file_path").alias(FILE))


def run_landed(spark: SparkSession, landing_dir: str, snapshots: SnapshotFn, root: str,
               clock: Callable[[], dt.datetime] = dt.datetime.now,
               checkpoint: str | None = None, max_files: int | None = None, **batch_kw):
    """Process every event file landed so far (``availableNow``) and stop.

    ``snapshots(spark)`` returns customer_master, product_master and
    order_items; ``clock()`` gives each micro-batch's run timestamp. A file is
    handed out once, so all its events are loaded, also those older than the
    marks. No id of another load is ever reused.
    """
    source = hashlib.sha1(landing_dir.encode()).hexdigest()[:16]
    checkpoint = checkpoint or os.path.join(root, sinks.CONTROL_DIR, "stream", source)

    def one_batch(events: DataFrame, micro_batch: int) -> None:
        batch_id, files = control.batch_of_files(spark, sinks.landed_path(root), sinks.log_path(root), source,
                                                 events.select(F.col(FILE).alias("file")))
        if batch_id is None:
            return
        fresh = events.join(files, events[FILE] == files["file"], "left_semi").drop(FILE)
        pipeline.run_batch(spark, snapshots(spark), root, clock(), batch_id=batch_id, order_delta=fresh, **batch_kw)

    q = (order_event_stream(spark, landing_dir, max_files).writeStream
         .foreachBatch(one_batch)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True)
         .start())
    q.awaitTermination()
    return q
