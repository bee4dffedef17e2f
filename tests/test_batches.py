"""Batches that complete in any order, versions that fail, late deliveries, a lost stream checkpoint."""

import datetime as dt
import os
import tempfile
from unittest import mock

import pytest

from ordermart.plans import pipeline
from ordermart.sources import control, schemas, sinks
from ordermart.streaming.landing import run_landed

from .test_golden import CUSTOMERS, PRODUCTS, sources

T = dt.datetime


def snapshots(s):
    return {"customer_master": s.createDataFrame(CUSTOMERS, schemas.CUSTOMER_MASTER),
            "product_master": s.createDataFrame(PRODUCTS, schemas.PRODUCT_MASTER),
            "order_items": s.createDataFrame([(100, 10, 3), (100, 11, 2)], schemas.ORDER_ITEMS)}


def land(spark, folder, name, rows):
    spark.createDataFrame(rows, schemas.ORDER_DETAILS).coalesce(1).write.parquet(os.path.join(folder, name))


def keys(spark, root):
    star = pipeline.warehouse(spark, root)
    return {n: sorted(r[0] for r in getattr(star, n).select(k).collect())
            for n, k in (("dim_address", "address_id"), ("dim_customer", "customerid"), ("dim_product", "productid"), ("dim_order", "orderid"))}


@pytest.mark.parametrize("dedupe", ["natural_key", "row"])
def test_a_later_batch_completes_first(spark, tmp_root, dedupe):
    """Micro-batch 1 reserves its id and fails; a plain batch completes; the retry adds nothing twice."""
    landing = tempfile.mkdtemp(prefix="ordermart-landing-")
    land(spark, landing, "f1", [(100, 1, T(2022, 3, 1, 10), "Received")])
    with mock.patch.object(pipeline, "load_targets", side_effect=RuntimeError("lost")), pytest.raises(Exception):
        run_landed(spark, landing + "/*", snapshots, tmp_root, clock=lambda: T(2022, 3, 2), address_dedupe=dedupe)
    ev = [(200, 2, T(2022, 3, 1, 11), "Received")]
    second = pipeline.run_batch(spark, sources(spark, CUSTOMERS, PRODUCTS, ev, []), tmp_root, T(2022, 3, 3), address_dedupe=dedupe)
    assert second.batch_id == 2
    run_landed(spark, landing + "/*", snapshots, tmp_root, clock=lambda: T(2022, 3, 4), address_dedupe=dedupe)
    assert control.completed_ids(spark, sinks.log_path(tmp_root)) == [1, 2]
    got = keys(spark, tmp_root)
    for name in ("dim_address", "dim_customer", "dim_product", "dim_order"):
        assert len(set(got[name])) == len(got[name]), name
    assert got["dim_order"] == [100, 200]


def test_a_version_counts_when_its_batch_completes(spark, tmp_root):
    src = sources(spark, CUSTOMERS, PRODUCTS, [(100, 1, T(2022, 3, 1), "Received")], [])
    with mock.patch.object(pipeline, "log_completed", side_effect=RuntimeError("lost")), pytest.raises(RuntimeError):
        pipeline.run_batch(spark, src, tmp_root, T(2022, 3, 2), scd2=True)
    assert pipeline.scd2_current(spark, tmp_root, "dim_customer").count() == 0
    pipeline.run_batch(spark, src, tmp_root, T(2022, 3, 2), scd2=True)
    assert pipeline.scd2_current(spark, tmp_root, "dim_customer").count() == len(CUSTOMERS)


def test_a_late_batch_builds_on_the_version_of_a_later_one(spark, tmp_root):
    first, more = PRODUCTS[:1], PRODUCTS
    pipeline.run_batch(spark, sources(spark, CUSTOMERS, more, [], []), tmp_root, T(2022, 3, 3), batch_id=2, scd2=True)
    pipeline.run_batch(spark, sources(spark, CUSTOMERS, first, [], []), tmp_root, T(2022, 3, 2), batch_id=1, scd2=True)
    got = sorted(r.productid for r in pipeline.scd2_current(spark, tmp_root, "dim_product").collect())
    assert got == sorted(p[0] for p in PRODUCTS)


def test_ids_are_reserved_once(spark, tmp_root):
    path = sinks.ids_path(tmp_root, "dim_address")
    take = lambda batch, n, after=0: control.allocate(spark, path, batch, n, after)
    assert take(1, 10) == 0
    assert take(2, 5) == 10
    assert take(1, 10) == 0 and take(1, 4) == 0
    assert take(1, 11) == 15  # its first range is too small now
    assert take(3, 1, after=100) == 100
    assert take(2, 5) == 10


def test_lost_stream_checkpoint(spark, tmp_root):
    landing = tempfile.mkdtemp(prefix="ordermart-landing-")
    run = lambda day, ckpt: run_landed(spark, landing + "/*", snapshots, tmp_root, clock=lambda: T(2022, 3, day), checkpoint=ckpt)
    first, second = (tempfile.mkdtemp(prefix="ordermart-ckpt-") for _ in range(2))
    land(spark, landing, "f1", [(100, 1, T(2022, 3, 1, 10), "Received")])
    run(2, first)
    land(spark, landing, "f2", [(101, 1, T(2022, 3, 2, 10), "Received")])
    run(3, first)
    land(spark, landing, "f3", [(102, 2, T(2022, 3, 3, 10), "Received")])
    run(4, second)  # all three files come at once
    land(spark, landing, "f4", [(103, 2, T(2022, 3, 4, 10), "Received")])
    run(5, second)
    assert keys(spark, tmp_root)["dim_order"] == [100, 101, 102, 103]
    assert sorted(r.orderid for r in pipeline.warehouse(spark, tmp_root).fact_daily_orders.collect()) == [100, 101, 102, 103]
    assert control.completed_ids(spark, sinks.log_path(tmp_root)) == [1, 2, 3, 4]


def test_a_later_batch_delivers(spark, tmp_root):
    items = [(100, 10, 3)]
    ev1 = [(100, 1, T(2022, 3, 1, 10), "Received"), (100, 1, T(2022, 3, 1, 12), "InProgress"), (101, 2, T(2022, 3, 1, 13), "Received")]
    pipeline.run_batch(spark, sources(spark, CUSTOMERS, PRODUCTS, ev1, items), tmp_root, T(2022, 3, 2))
    ev2 = ev1 + [(100, 1, T(2022, 3, 3, 8), "Delivered")]
    pipeline.run_batch(spark, sources(spark, CUSTOMERS, PRODUCTS, ev2, items), tmp_root, T(2022, 3, 4))
    own, all_ = (pipeline.warehouse(spark, tmp_root, accumulate=a) for a in (False, True))
    rows = lambda star: sorted((r.orderid, r.order_delivery_timestamp, r.order_delivery_time_seconds) for r in star.fact_daily_orders.collect())
    assert rows(own) == [(100, None, 0), (101, None, 0)]
    assert rows(all_) == [(100, T(2022, 3, 3, 8), 46 * 3600), (101, None, 0)]
    assert [r.order_delivery_timestamp for r in all_.f_order_details.collect()] == [T(2022, 3, 3, 8)]
    assert all_.fact_daily_orders.schema == own.fact_daily_orders.schema


def test_late_events_are_loaded_once(spark, tmp_root):
    week = dt.timedelta(days=7)
    events = [(100, 1, T(2022, 3, 1, 10), "Received"), (101, 2, T(2022, 3, 9, 9), "Received")]
    late = [(102, 2, T(2022, 3, 8, 9), "Received"), (100, 1, T(2022, 3, 2, 10), "Delivered"), (103, 1, T(2022, 3, 4, 9), None)]
    lost = [(104, 1, T(2022, 2, 27), "Received")]  # later than late_by allows
    for day, rows in ((10, events), (11, events + late + lost), (12, events + late + lost), (13, events + late + [(105, 1, T(2022, 3, 12), "Received")])):
        pipeline.run_batch(spark, sources(spark, CUSTOMERS, PRODUCTS, rows, []), tmp_root, T(2022, 3, day), late_by=week)
    got = sorted((r.orderid, str(r.order_status)) for r in pipeline.warehouse(spark, tmp_root).dim_order.collect())
    assert got == [(100, "Delivered"), (100, "Received"), (101, "Received"), (102, "Received"), (103, "None"), (105, "Received")]
    assert control.high_water_mark(spark, sinks.log_path(tmp_root), pipeline.EVENTS) == "2022-03-12 00:00:00"
    again = pipeline.run_batch(spark, sources(spark, CUSTOMERS, PRODUCTS, events + late, []), tmp_root, T(2022, 3, 11), batch_id=2, late_by=week)
    assert again.staged["dim_order"] == 3  # a rerun repeats its own extract


def test_an_event_ahead_of_the_clock_does_not_move_the_mark_past_it(spark, tmp_root):
    rows = [(100, 1, T(2030, 1, 1), "Received")]
    pipeline.run_batch(spark, sources(spark, CUSTOMERS, PRODUCTS, rows, []), tmp_root, T(2022, 3, 10), late_by=dt.timedelta(days=1))
    rows.append((101, 1, T(2022, 3, 10), "Received"))
    pipeline.run_batch(spark, sources(spark, CUSTOMERS, PRODUCTS, rows, []), tmp_root, T(2022, 3, 11), late_by=dt.timedelta(days=1))
    assert sorted(r.orderid for r in pipeline.warehouse(spark, tmp_root).dim_order.collect()) == [100, 101]
