"""Schema registry: OLTP source tables, warehouse targets and their partition keys.

Columns are matched by name at every sink (``conform``), never by position.
Integer columns are widened to bigint in the warehouse; timestamps stay
zone-less (TIMESTAMP_NTZ) end to end.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import timeparts as tp

L, S, D, B = T.LongType(), T.StringType(), T.DateType(), T.BooleanType()
TS = T.TimestampNTZType()


def _struct(*cols: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in cols])


# ---- OLTP source model -------------------------------------------------------
CUSTOMER_MASTER = _struct(
    ("customerid", L, False), ("name", S, False), ("address", S, True),
    ("city", S, True), ("state", S, True), ("pincode", L, True),
    ("update_timestamp", TS, False))
PRODUCT_MASTER = _struct(
    ("productid", L, False), ("productcode", S, False), ("productname", S, True),
    ("sku", S, True), ("rate", L, True), ("isactive", B, True))
ORDER_DETAILS = _struct(
    ("orderid", L, False), ("customerid", L, False),
    ("order_status_update_timestamp", TS, True), ("order_status", S, True))
ORDER_ITEMS = _struct(
    ("orderid", L, False), ("productid", L, False), ("quantity", L, False))
ETL_EXTRACT_LOG = _struct(
    ("processlogid", L, True), ("tablename", S, True), ("extractrowcount", L, True),
    ("lastextractdatetime", TS, True), ("status", S, True))

# ---- warehouse star schema ---------------------------------------------------
DIM_ORDER = _struct(
    ("orderid", L, True), ("order_status_update_timestamp", TS, True),
    ("order_status", S, True))
FACT_DAILY_ORDERS = _struct(
    ("customerid", L, True), ("orderid", L, True),
    ("order_received_timestamp", TS, True), ("order_delivery_timestamp", TS, True),
    ("pincode", L, True), ("order_amount", L, True), ("item_count", L, True),
    ("order_delivery_time_seconds", L, True))
DIM_CUSTOMER = _struct(
    ("customerid", L, True), ("name", S, True), ("address_id", L, True),
    ("start_date", D, True), ("end_date", D, True))
DIM_ADDRESS = _struct(
    ("address_id", L, True), ("address", S, True), ("city", S, True),
    ("state", S, True), ("pincode", L, True))
DIM_PRODUCT = _struct(
    ("productid", L, True), ("productcode", S, True), ("productname", S, True),
    ("sku", S, True), ("rate", L, True), ("isactive", B, True),
    ("start_date", D, True), ("end_date", D, True))
F_ORDER_DETAILS = _struct(
    ("orderid", L, True), ("order_delivery_timestamp", TS, True),
    ("productid", L, True), ("quantity", L, True))

ORDER_BITS = T.StructType([T.StructField("id_range", L, True), T.StructField("bits", T.BinaryType(), True), T.StructField("orders", L, True)])


@dataclass(frozen=True)
class TableSpec:
    name: str
    schema: T.StructType
    # column expression deriving the storage partition value, or None
    partition_expr: object = None
    partition_col: str | None = None
    key: tuple[str, ...] = field(default_factory=tuple)

    def partition_column(self) -> Column | None:
        return self.partition_expr() if self.partition_expr else None


def _month_of(c: str):
    return lambda: tp.month_start(F.col(c))


TARGETS: dict[str, TableSpec] = {
    "dim_order": TableSpec("dim_order", DIM_ORDER,
                           _month_of("order_status_update_timestamp"), "p_month",
                           ("orderid", "order_status")),
    "fact_daily_orders": TableSpec("fact_daily_orders", FACT_DAILY_ORDERS,
                                   _month_of("order_received_timestamp"), "p_month",
                                   ("orderid",)),
    "dim_customer": TableSpec("dim_customer", DIM_CUSTOMER,
                              _month_of("start_date"), "p_month", ("customerid",)),
    "dim_address": TableSpec("dim_address", DIM_ADDRESS,
                             lambda: tp.address_range_bucket(F.col("address_id")),
                             "p_bucket", ("address_id",)),
    "dim_product": TableSpec("dim_product", DIM_PRODUCT, None, None, ("productid",)),
    "f_order_details": TableSpec("f_order_details", F_ORDER_DETAILS,
                                 _month_of("order_delivery_timestamp"), "p_month",
                                 ("orderid", "productid")),
}

#: State that every batch stores beside its rows, see ``operators/distinct``.
TARGETS["order_bits"] = TableSpec("order_bits", ORDER_BITS, None, None, ("id_range",))
STATES = ("order_bits",)

# Stage tables mirror the targets, unpartitioned.
STAGE_PREFIX = "stg_"

# Load order of the target tables (address before customer, as in the batch).
TARGET_LOAD_ORDER = ("dim_address", "dim_customer", "dim_order", "dim_product",
                     "f_order_details", "fact_daily_orders")


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the schema's columns by name with explicit casts.

    Missing columns raise; extra columns are dropped. ANSI casts make a lossy
    conversion fail loudly instead of silently truncating.
    """
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"columns missing for sink: {missing}")
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def empty(spark, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)
