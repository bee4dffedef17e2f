"""Delta extracts by high-water mark.

Marks are inclusive (``>=``): an event exactly at the mark is extracted again.
Filters are plain column predicates so they reach the parquet scan (or the
JDBC query) as pushed filters.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import timeparts as tp
from ..functions.joins import merged
from . import schemas
from .binding import STATUS_INPROGRESS

DEFAULT_MARK_TS = tp.DEFAULT_MARK


def _ts(mark) -> F.Column:
    return F.lit(str(mark)).cast("timestamp_ntz")


def customers_since(customer_master: DataFrame, mark) -> DataFrame:
    return customer_master.where(F.col("update_timestamp") >= _ts(mark))


def orders_since(order_details: DataFrame, mark) -> DataFrame:
    return order_details.where(F.col("order_status_update_timestamp") >= _ts(mark))


def orders_not_loaded(order_details: DataFrame, since, loaded: DataFrame) -> DataFrame:
    """Events at or after ``since`` that are not among the ``loaded`` dim_order rows: an overlap with
    what earlier batches read, for events that the source commits late. An event is its order,
    status and time, so loaded rows from before ``since`` are not needed."""
    recent = order_details.where(F.col("order_status_update_timestamp") >= _ts(since))
    known = loaded.select(*(F.col(c).alias(f"_{c}") for c in schemas.DIM_ORDER.fieldNames()))
    same = [recent[c].eqNullSafe(known[f"_{c}"]) for c in schemas.DIM_ORDER.fieldNames()]
    return recent.join(merged(known), same, "left_anti")


def products_snapshot(product_master: DataFrame, mark=None) -> DataFrame:
    """Full product snapshot; the mark is accepted and ignored (changes are
    found by comparing with the dimension, not by time)."""
    return product_master


def items_of(order_items: DataFrame, delta_orders: DataFrame) -> DataFrame:
    """Lines of the orders that have an InProgress event in the delta."""
    wanted = delta_orders.where(F.col("order_status") == "InProgress").select("orderid")
    return order_items.join(merged(wanted), "orderid", "left_semi")


def items_since(order_items: DataFrame, order_details: DataFrame, mark) -> DataFrame:
    """Lines of orders with an InProgress event at or after the mark (semi join;
    the IN-subquery's DISTINCT is implied)."""
    inprog = order_details.where(
        (F.col("order_status_update_timestamp") >= _ts(mark))
        & (F.col("order_status") == STATUS_INPROGRESS)).select("orderid")
    return order_items.join(merged(inprog), "orderid", "left_semi")


def read_jdbc(spark: SparkSession, url: str, table: str, properties: dict,
              predicates: list[str] | None = None, **options) -> DataFrame:
    """Source table over JDBC. Connection options come from the caller's
    configuration; ``predicates`` (or partitionColumn/lowerBound/upperBound/
    numPartitions in ``options``) split the read over many tasks."""
    # zone-less source timestamps stay TIMESTAMP_NTZ
    properties = {"preferTimestampNTZ": "true", **properties}
    if predicates:
        return spark.read.jdbc(url, table, predicates=predicates, properties=properties)
    r = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for k, v in {**properties, **options}.items():
        r = r.option(k, v)
    return r.load()


def delta_query(table: str, mark) -> str:
    """The ``dbtable`` text of an extract that the database filters: customers and
    order events since the mark, or the lines of orders that have an InProgress
    event since it. The mark must be a timestamp; anything else is refused."""
    at = dt.datetime.fromisoformat(str(mark)).isoformat(sep=" ")
    where = {
        "customer_master": f"update_timestamp >= TIMESTAMP '{at}'",
        "order_details": f"order_status_update_timestamp >= TIMESTAMP '{at}'",
        "order_items": "orderid IN (SELECT orderid FROM order_details WHERE "
                       f"order_status_update_timestamp >= TIMESTAMP '{at}' AND order_status = '{STATUS_INPROGRESS}')",
    }[table]
    return f"(SELECT * FROM {table} WHERE {where}) AS delta"


def read_jdbc_delta(spark: SparkSession, url: str, table: str, mark, properties: dict, **options) -> DataFrame:
    """A delta over JDBC, filtered in the source."""
    return read_jdbc(spark, url, delta_query(table, mark), properties, **options)


OLTP_TABLES = {
    "customer_master": "CUSTOMER_MASTER",
    "product_master": "PRODUCT_MASTER",
    "order_details": "ORDER_DETAILS",
    "order_items": "ORDER_ITEMS",
}


def read_oltp(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """Source tables exported as parquet folders ``<root>/<table>`` with the
    declared schemas; mark filters and column pruning reach the scans."""
    return {t: spark.read.schema(getattr(schemas, s)).parquet(f"{root.rstrip('/')}/{t}")
            for t, s in OLTP_TABLES.items()}
