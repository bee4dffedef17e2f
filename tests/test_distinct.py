"""Distinct orders from bitmaps: equal to a distinct count whatever the ids, rows and batches."""

import datetime as dt
import random
from unittest import mock

import pytest
from pyspark.sql import functions as F

from ordermart.operators import distinct
from ordermart.plans import analytics, pipeline
from ordermart.sources import schemas, segments, sinks

from .conftest import SF_SMALL
from .test_golden import CUSTOMERS, PRODUCTS, sources

T = dt.datetime
FACTS = "customerid long, orderid long"


def want(facts, areas):
    """Plain loops: the set of order ids that an area's customers hold."""
    sets = {}
    for c, area in areas:
        for k, o in facts:
            if k == c and c is not None:
                sets.setdefault(area, set()).update([] if o is None else [o])
    return {a: len(s) for a, s in sets.items()}


def got(spark, batches, areas, state=True):
    frames = [spark.createDataFrame(b, FACTS) for b in batches]
    facts = frames[0]
    bits = distinct.order_bits(frames[0])
    for f in frames[1:]:
        facts, bits = facts.unionByName(f), bits.unionByName(distinct.order_bits(f))
    out = distinct.orders_by(facts, spark.createDataFrame(areas, "customerid long, area string"), ["area"], bits if state else None, "n")
    assert dict(out.dtypes)["n"] == "bigint"
    return {r.area: r.n for r in out.collect()}


AREAS = [(1, "x"), (2, "x"), (2, "y"), (3, "x"), (3, "x"), (4, None), (5, "z"), (None, "x")]


def cases():
    rng = random.Random(3)
    single = [[(rng.choice([1, 2, 3, 4, 6, None]), i) for i in range(b * 70_000, b * 70_000 + 300)] for b in range(3)]
    yield "single ids", single
    yield "an id in two batches and with two customers", [*single[:2], [(1, 5), (3, 5), (2, 70_001), (4, 70_001), (1, 900_000)]]
    yield "negative, zero, null ids", [[(1, -1), (1, 0), (2, 1), (3, -40_000), (1, None), (5, None), (2, 32_768), (2, 32_769)], [(1, -1), (None, 7)]]
    yield "no rows", [[], []]


@pytest.mark.parametrize("name, batches", list(cases()))
def test_equal_to_plain_loops(spark, name, batches):
    facts = [r for b in batches for r in b]
    assert got(spark, batches, AREAS) == got(spark, batches, AREAS, state=False) == want(facts, AREAS), name


def test_sparse_ids_and_many_repeats_are_still_exact(spark):
    facts = [(1 + i % 3, i * 1_000_003) for i in range(200)] + [(1, 0), (3, 1_000_003)]
    with mock.patch.object(distinct, "SMALL", 0):
        assert distinct.order_bits(spark.createDataFrame(facts, FACTS)).where("bits is not null").count() == 0
        assert got(spark, [facts], AREAS) == want(facts, AREAS)
    with mock.patch.object(distinct, "RANGES", 1):
        assert distinct.repeated_ranges(distinct.order_bits(spark.createDataFrame(facts, FACTS))) is None
        assert got(spark, [facts], AREAS) == want(facts, AREAS)


def test_state_of_batches(spark, tmp_root):
    """Stored with each batch, merged by compaction; without it for one batch ids are counted as before."""
    for batch in (1, 2, 3):
        ev = [(100 * batch + i, 1 + i % 2, T(2022, 3, batch, i), "Received") for i in range(5)] + [(7, 1, T(2022, 3, batch, 9), "Received")]
        pipeline.run_batch(spark, sources(spark, CUSTOMERS, PRODUCTS, ev, []), tmp_root, T(2022, 3, batch, 8))
    star = pipeline.warehouse(spark, tmp_root)
    assert distinct.repeated_ranges(star.order_bits) == [1]
    assert star.order_bits.agg(F.sum("orders")).first()[0] == star.fact_daily_orders.count()
    answer = sorted(map(tuple, analytics.q05_orders_by_area(star).collect()))
    star.order_bits = None
    assert answer == sorted(map(tuple, analytics.q05_orders_by_area(star).collect())) and answer
    pipeline.compact(spark, tmp_root, fanout=2)
    assert answer == sorted(map(tuple, analytics.q05_orders_by_area(pipeline.warehouse(spark, tmp_root)).collect()))
    real = segments.layout
    with mock.patch.object(segments, "layout", lambda s, r, n, b: (0, real(s, r, n, b)[1][1:]) if n == "order_bits" else real(s, r, n, b)):
        assert sinks.read_state(spark, tmp_root, "order_bits") is None


def test_no_order_is_shuffled(spark):
    """Every exchange of the fact carries counts per customer."""
    from ordermart.plans import catalog

    for grain in ("", "_state", "_pincode"):
        plan = catalog.all_queries()[f"q05_orders_by_area{grain}"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        moved = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
        assert moved and not any("orderid" in line for line in moved), plan
        assert "count(distinct" not in plan and schemas.FACT_DAILY_ORDERS.names[0] in plan
