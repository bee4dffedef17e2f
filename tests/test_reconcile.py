"""Reconciliation: no difference after a batch, also from segments; a lost, repeated or changed row shows."""

import datetime as dt
import os

import pytest

from ordermart.plans import pipeline, reconcile
from ordermart.sources import schemas, sinks

from .test_golden import CUSTOMERS, PRODUCTS, sources

T = dt.datetime


def found(spark, root, batch, src=None):
    return {(r.table_name, r.step): (r.rows_from, r.rows_to) for r in reconcile.reconcile(spark, root, batch, src).where("differences <> 0").collect()}


def test_batches_and_segments_agree_and_a_lost_file_shows(spark, tmp_root):
    src = {}
    for batch in (1, 2):
        ev = [(100 * b + i, 1, T(2022, 3, b, i), "Received") for b in range(1, batch + 1) for i in range(4)]
        src = sources(spark, CUSTOMERS, PRODUCTS, ev, [])
        pipeline.run_batch(spark, src, tmp_root, T(2022, 3, batch, 12))
    whole = reconcile.reconcile(spark, tmp_root, 2, src).collect()
    assert len(whole) == 10 and not any(r.differences for r in whole)
    lost = sinks.read_target(spark, tmp_root, "fact_daily_orders", except_batch=1).inputFiles()
    os.remove(lost[0].removeprefix("file://"))
    assert found(spark, tmp_root, 2, src) == {("fact_daily_orders", "stage to target"): (4, 4 - 4 // len(lost))}
    pipeline.load_targets(spark, tmp_root, 2)  # loading the batch again mends it
    pipeline.compact(spark, tmp_root, fanout=2)
    assert found(spark, tmp_root, 2) == {}


@pytest.mark.parametrize("other", [
    [(1, "b"), (1, "b"), (2, None)], [(1, "b"), (2, None), (2, None), (1, "b")], [(1, "b"), (2, "c")], [(1, None), (2, "b")], []])
def test_checksums(spark, other):
    schema = schemas.T.StructType.fromDDL("k bigint, v string")
    frame = lambda rows: spark.createDataFrame(rows, schema)
    one = [(1, "b"), (2, None)]
    value = lambda rows: reconcile.checksum(frame(rows), schema).first()
    assert value(one) == value(one[::-1]) != value(other)
    assert reconcile.checksum(frame(one).repartition(3), schema).first() == value(one)
