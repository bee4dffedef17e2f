"""Joins of tables that grow are never collected to the driver, however small their files look."""

import datetime as dt

import pytest

from ordermart.functions.joins import merged
from ordermart.operators import dims, facts
from ordermart.plans import analytics as a
from ordermart.plans.warehouse import materialize
from ordermart.sources import extract, schemas

from .conftest import SF_SMALL

T = dt.datetime(2022, 1, 3)
ORDERS = [(o, 1 + o % 3, T + dt.timedelta(hours=h), s) for o in range(6) for h, s in enumerate(("Received", "InProgress", "Delivered"))]
CUSTOMERS = [(c, f"n{c}", f"{c} st", "Pune", "MH", 411000 + c, T) for c in range(4)]
PRODUCTS = [(p, f"c{p}", f"p{p}", "1KG", 10 * p, True) for p in range(3)]


def planned(df) -> str:
    return df._jdf.queryExecution().sparkPlan().toString()


@pytest.fixture()
def frames(spark):
    return {"orders": spark.createDataFrame(ORDERS, schemas.ORDER_DETAILS), "customers": spark.createDataFrame(CUSTOMERS, schemas.CUSTOMER_MASTER),
            "products": spark.createDataFrame(PRODUCTS, schemas.PRODUCT_MASTER),
            "items": spark.createDataFrame([(o, o % 3, 2) for o in range(6)], "orderid bigint, productid int, quantity int")}


def test_batch_transforms_broadcast_nothing(spark, frames):
    orders, customers, products, items = (frames[n] for n in ("orders", "customers", "products", "items"))
    lines = facts.order_lines(orders, extract.items_of(items, orders))
    fact = facts.daily_orders(orders, customers, products, lines)
    held = spark.createDataFrame([(1, "n1", 7, T.date(), T.date())], schemas.DIM_CUSTOMER)
    addresses = spark.createDataFrame([(7, "1 st", "Pune", "MH", 411001)], schemas.DIM_ADDRESS)
    matched = dims.match_addresses(customers, addresses)
    fresh, again = dims.customers_from_matches(matched, addresses, held)
    for df in (lines, fact, matched, fresh, again, extract.orders_not_loaded(orders, T, dims.order_status_rows(orders)),
               facts.accumulated_orders(fact, dims.order_status_rows(orders)), dims.rows_not_in(held, held, dims.CUSTOMER_COMPARED)):
        plan = planned(df)
        assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan, plan
    assert {(r.orderid, r.item_count) for r in fact.collect()} == {(o, 2) for o in range(6)}
    assert [r.customerid for r in again.collect()] == [1]


QUESTIONS = [
    (a.q01_avg_items, "city"), (a.q01_avg_items, "day"), (a.q03_units_by_sku, "month"), (a.q04_sales_by_date, "pincode"), (a.q05_orders_by_area, "pincode"),
    (a.q09_delivery_time, "base"), (a.q09_delivery_time, "pincode"), (a.q10_orders_sliced, "base"),
    *((q, None) for q in (a.q01_q02_grouping_sets, a.q04_sales_by_date_product_city, a.q04_sales_by_date_product, a.q09_grouping_sets, a.q10_orders_grouping_sets))]


def test_questions_broadcast_nothing(spark):
    star = materialize(spark, SF_SMALL)
    for question, grain in QUESTIONS:
        plan = planned(question(star, **({"grain": grain} if grain else {})))
        assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan, plan


def test_side_stays_merged_when_measured_small(spark):
    rows, b = spark.range(100), spark.range(50).groupBy("id").count()
    joined = rows.join(merged(b), "id")
    assert joined.count() == 50
    joined.collect()
    assert "BroadcastHashJoin" not in joined._jdf.queryExecution().executedPlan().toString()
