"""Landing-folder micro-batches drive the incremental batch exactly once."""

import datetime as dt
import os
import tempfile

from ordermart.plans import pipeline
from ordermart.sources import schemas
from ordermart.streaming.landing import run_landed

from .test_golden import CUSTOMERS, PRODUCTS

T = dt.datetime


def test_landed_event_files_become_batches(spark, tmp_root):
    landing = tempfile.mkdtemp(prefix="ordermart-landing-")
    ckpt = tempfile.mkdtemp(prefix="ordermart-stream-ckpt-")

    def land(rows, name):
        spark.createDataFrame(rows, schemas.ORDER_DETAILS).coalesce(1) \
            .write.parquet(os.path.join(landing, name))

    def snapshots(s):
        return {"customer_master": s.createDataFrame(CUSTOMERS, schemas.CUSTOMER_MASTER),
                "product_master": s.createDataFrame(PRODUCTS, schemas.PRODUCT_MASTER),
                "order_items": s.createDataFrame([(100, 10, 3), (100, 11, 2)], schemas.ORDER_ITEMS)}

    clock = iter([T(2022, 3, 2), T(2022, 3, 4), T(2022, 3, 5)])
    land([(100, 1, T(2022, 3, 1, 10), "Received"), (100, 1, T(2022, 3, 1, 12), "InProgress")], "f1")
    run_landed(spark, landing + "/*", snapshots, tmp_root, clock=lambda: next(clock), checkpoint=ckpt)
    land([(100, 1, T(2022, 3, 3, 8), "Delivered")], "f2")
    run_landed(spark, landing + "/*", snapshots, tmp_root, clock=lambda: next(clock), checkpoint=ckpt)
    # nothing new: no further batch
    run_landed(spark, landing + "/*", snapshots, tmp_root, clock=lambda: next(clock), checkpoint=ckpt)

    wh = pipeline.warehouse(spark, tmp_root)
    assert wh.dim_order.count() == 3
    assert [tuple(r) for r in wh.fact_daily_orders.collect()] == [
        (1, 100, T(2022, 3, 1, 10), None, 411001, 400, 5, 0)]
    assert wh.f_order_details.count() == 2
    assert wh.dim_customer.count() == 2
    batches = sorted(os.listdir(os.path.join(tmp_root, "target", "dim_order")))
    assert batches == ["batch_id=1", "batch_id=2"]


def test_late_events_and_earlier_loads_survive(spark, tmp_root):
    """A landed file older than the mark is loaded; the batch that was there before
    the stream stays; two warehouses of one name read the same landing folder."""
    landing = tempfile.mkdtemp(prefix="ordermart-landing-")
    snapshots = lambda s: {"customer_master": s.createDataFrame(CUSTOMERS, schemas.CUSTOMER_MASTER),
                           "product_master": s.createDataFrame(PRODUCTS, schemas.PRODUCT_MASTER),
                           "order_items": s.createDataFrame([], schemas.ORDER_ITEMS)}
    first = snapshots(spark) | {"order_details": spark.createDataFrame([(100, 1, T(2022, 3, 1), "Received")], schemas.ORDER_DETAILS)}
    rows = [(200, 1, T(2022, 1, 1), "Received"), (201, 2, T(2022, 3, 9), "Received")]
    spark.createDataFrame(rows, schemas.ORDER_DETAILS).coalesce(1).write.parquet(os.path.join(landing, "f1"))
    for part in ("a", "b"):
        root = os.path.join(tmp_root, part, "wh")
        pipeline.run_batch(spark, first, root, T(2022, 3, 2))
        run_landed(spark, landing + "/*", snapshots, root, clock=lambda: T(2022, 3, 10))
        assert sorted(r.orderid for r in pipeline.warehouse(spark, root).dim_order.collect()) == [100, 200, 201]
