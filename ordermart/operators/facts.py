"""Fact transforms: order lines (f_order_details) and orders (fact_daily_orders)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import timeparts as tp
from ..functions.joins import merged
from ..sources import schemas
from ..sources.binding import STATUS_DELIVERED, STATUS_RECEIVED

EVENT_COLS = ["orderid", "customerid", "order_status_update_timestamp", "order_status"]


def complete_events(delta_orders: DataFrame, status: str) -> DataFrame:
    """Events of one status with no null in any of the four event columns."""
    e = delta_orders.where(F.col("order_status") == status)
    return e.dropna("any", subset=EVENT_COLS)


def order_lines(delta_orders: DataFrame, delta_items: DataFrame) -> DataFrame:
    """f_order_details: every extracted line ⟕ its order's Delivered event.

    order_delivery_timestamp is null when the Delivered event is not in this
    delta. Under the source key (orderid, order_status) an order has at most
    one Delivered event, so the left join never multiplies lines.
    """
    delivered = complete_events(delta_orders, STATUS_DELIVERED).select(
        "orderid", F.col("order_status_update_timestamp").alias("order_delivery_timestamp"))
    out = delta_items.join(merged(delivered), "orderid", "left")
    return schemas.conform(out, schemas.F_ORDER_DETAILS)


def order_pivot(delta_orders: DataFrame) -> DataFrame:
    """Received ⟕ Delivered on (customerid, orderid) as one aggregate per order.

    Rows with a null in any event column are ignored. An order appears iff it
    has a Received event; its delivery timestamp is the Delivered event's when
    that event names the same customer. With the source key (orderid,
    order_status) this equals the two-scan self-join, but costs one shuffle
    (after map-side partial aggregation) instead of two, and leaves the result
    hash-partitioned on orderid for the amount join below.
    """
    e = delta_orders.dropna("any", subset=EVENT_COLS)
    is_r = F.col("order_status") == STATUS_RECEIVED
    is_d = F.col("order_status") == STATUS_DELIVERED
    ts = F.col("order_status_update_timestamp")
    piv = e.where(is_r | is_d).groupBy("orderid").agg(
        F.max(F.when(is_r, F.col("customerid"))).alias("customerid"),
        F.max(F.when(is_r, ts)).alias("order_received_timestamp"),
        F.max(F.when(is_d, F.col("customerid"))).alias("_d_customerid"),
        F.max(F.when(is_d, ts)).alias("_d_ts"),
    )
    return piv.where(F.col("order_received_timestamp").isNotNull()).select(
        "customerid", "orderid", "order_received_timestamp",
        F.when(F.col("_d_customerid") == F.col("customerid"), F.col("_d_ts"))
        .alias("order_delivery_timestamp"))


def order_totals(lines: DataFrame, delta_products: DataFrame) -> DataFrame:
    """Per order: Σ quantity·rate (amount) and Σ quantity (units).

    Lines whose product is not in the product delta contribute to units but
    not to the amount (null rate). Partially aggregated map-side.
    """
    prod = delta_products.select("productid", "rate")
    priced = lines.select("orderid", "productid", "quantity").join(merged(prod), "productid", "left")
    return priced.groupBy("orderid").agg(
        F.sum(F.col("quantity") * F.col("rate")).alias("order_amount"),
        F.sum("quantity").alias("item_count"))


def daily_orders(delta_orders: DataFrame, delta_customer: DataFrame,
                 delta_products: DataFrame, lines: DataFrame) -> DataFrame:
    """fact_daily_orders, one row per received order.

    pincode comes from the customer delta only; amount, units, delivery seconds
    and pincode that are missing become 0 (timestamps stay null).
    """
    piv = order_pivot(delta_orders).withColumn(
        "order_delivery_time_seconds",
        tp.seconds_between("order_received_timestamp", "order_delivery_timestamp"))
    totals = order_totals(lines, delta_products)
    cust = delta_customer.select("customerid", "pincode")
    out = (piv.join(merged(totals), "orderid", "left")
              .join(merged(cust), "customerid", "left")
              .fillna(0, subset=["pincode", "order_amount", "item_count",
                                 "order_delivery_time_seconds"]))
    return schemas.conform(out, schemas.FACT_DAILY_ORDERS)


def _deliveries(dim_order: DataFrame) -> DataFrame:
    """(orderid, delivery time), one row an order: the latest Delivered event of all batches."""
    done = dim_order.where(F.col("order_status") == STATUS_DELIVERED).dropna("any")
    return done.groupBy("orderid").agg(F.max("order_status_update_timestamp").alias("_delivered"))


def accumulated_orders(fact: DataFrame, dim_order: DataFrame) -> DataFrame:
    """fact_daily_orders with the delivery that a later batch loaded: an accumulating
    snapshot, merged on read. A row whose own batch knew the delivery stays as it is.

    dim_order keeps no customer, so an event counts by its order (under the source key
    (orderid, order_status) there is one). Only rows without a delivery are joined."""
    still = fact.where(F.col("order_delivery_timestamp").isNull())
    known = fact.where(F.col("order_delivery_timestamp").isNotNull())
    late = still.join(merged(_deliveries(dim_order)), "orderid", "left")
    seconds = tp.seconds_between("order_received_timestamp", "_delivered")
    late = late.withColumn("order_delivery_time_seconds", F.coalesce(seconds, F.col("order_delivery_time_seconds")))
    late = late.withColumn("order_delivery_timestamp", F.col("_delivered"))
    return schemas.conform(known.unionByName(late.select(fact.columns)), schemas.FACT_DAILY_ORDERS)


def accumulated_lines(lines: DataFrame, dim_order: DataFrame) -> DataFrame:
    """f_order_details with the delivery time that a later batch loaded."""
    still = lines.where(F.col("order_delivery_timestamp").isNull()).drop("order_delivery_timestamp")
    known = lines.where(F.col("order_delivery_timestamp").isNotNull())
    late = still.join(merged(_deliveries(dim_order)), "orderid", "left").withColumnRenamed("_delivered", "order_delivery_timestamp")
    return schemas.conform(known.unionByName(late.select(lines.columns)), schemas.F_ORDER_DETAILS)
