"""Binding of the driver's TPC-H-like test tables to the OLTP source model.

The same expressions are written in DuckDB SQL in ``plans/oracle.py``; both
sides use integer arithmetic only, so results are bit-for-bit comparable.

Every function here is a lazy projection of a parquet scan: Catalyst prunes the
unused columns and pushes filters placed on top (e.g. the high-water mark on
``update_timestamp``) as far as the expressions allow.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import timeparts as tp
from . import schemas

# Fixed values of the binding (kept equal on the Spark and the SQL side).
PINCODE_BASE, PINCODE_SPREAD = 110001, 500
CUSTOMER_EPOCH = "1995-01-01 00:00:00"
CUSTOMER_DAY_SPREAD = 365
RECEIVED_MULT, INPROGRESS_MULT, DELIVERED_MULT = 6151, 7919, 104729
SECONDS_PER_DAY = 86400
STATUS_RECEIVED, STATUS_INPROGRESS, STATUS_DELIVERED = "Received", "InProgress", "Delivered"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def customer_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer ⋈ nation ⋈ region -> customer_master.

    nation (25 rows) and region (5 rows) have a fixed size by the TPC-H
    definition, independent of scale, so they are broadcast.
    """
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    geo = n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey).select("n_nationkey", "n_name", "r_name")
    out = c.join(F.broadcast(geo), c.c_nationkey == geo.n_nationkey, "left").select(
        F.col("c_custkey").alias("customerid"),
        F.col("c_name").alias("name"),
        F.concat(F.col("c_name"), F.lit(" street")).alias("address"),
        F.col("n_name").alias("city"),
        F.col("r_name").alias("state"),
        (F.lit(PINCODE_BASE) + F.col("c_custkey") % PINCODE_SPREAD).alias("pincode"),
        tp.add_seconds(F.to_timestamp_ntz(F.lit(CUSTOMER_EPOCH)),
                       (F.col("c_custkey") % CUSTOMER_DAY_SPREAD) * SECONDS_PER_DAY)
        .alias("update_timestamp"),
    )
    return schemas.conform(out, schemas.CUSTOMER_MASTER)


def product_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "part")
    out = p.select(
        F.col("p_partkey").alias("productid"),
        F.col("p_brand").alias("productcode"),
        F.col("p_name").alias("productname"),
        F.concat(F.col("p_size").cast("string"), F.lit("KG")).alias("sku"),
        F.floor(F.col("p_retailprice")).cast("bigint").alias("rate"),
        (F.col("p_partkey") % 5 != 0).alias("isactive"),
    )
    return schemas.conform(out, schemas.PRODUCT_MASTER)


def order_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders -> status event log (Received for all, InProgress for P/F, Delivered for F).

    One scan of orders; the 1-3 events of an order are generated next to each
    other (``inline`` over a filtered array), so a later per-order aggregate
    combines them map-side before any shuffle.
    """
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    k = F.col("o_orderkey")
    received = tp.add_seconds(F.col("o_orderdate"), k * RECEIVED_MULT % SECONDS_PER_DAY)
    inprogress = tp.add_seconds(received, F.lit(1) + k * INPROGRESS_MULT % SECONDS_PER_DAY)
    delivered = tp.add_seconds(inprogress, F.lit(1) + k * DELIVERED_MULT % SECONDS_PER_DAY)
    st = F.col("o_orderstatus")

    def ev(status, ts):
        return F.struct(ts.alias("order_status_update_timestamp"), F.lit(status).alias("order_status"))

    events = F.array(
        ev(STATUS_RECEIVED, received),
        F.when(st.isin("P", "F"), ev(STATUS_INPROGRESS, inprogress)),
        F.when(st == "F", ev(STATUS_DELIVERED, delivered)),
    )
    out = o.select(
        k.alias("orderid"), F.col("o_custkey").alias("customerid"),
        F.inline(F.filter(events, lambda e: e.isNotNull())),
    )
    return schemas.conform(out, schemas.ORDER_DETAILS)


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem -> order_items, one row per (order, part): the first line by
    (l_linenumber, l_quantity), as the source's key-deduplicating load keeps."""
    from ..operators.dedupe import first_per_key
    li = read_table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("orderid"),
        F.col("l_partkey").alias("productid"),
        F.col("l_linenumber"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
    )
    out = first_per_key(li, keys=["orderid", "productid"], order_by=["l_linenumber", "quantity"],
                        values=["quantity"])
    return schemas.conform(out, schemas.ORDER_ITEMS)


def oltp_sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "customer_master": customer_master(spark, sf_dir),
        "product_master": product_master(spark, sf_dir),
        "order_details": order_details(spark, sf_dir),
        "order_items": order_items(spark, sf_dir),
    }
