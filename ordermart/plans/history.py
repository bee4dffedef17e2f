"""Existing warehouse state for incremental-batch queries, derived from the sources.

A second batch needs dimensions that already hold rows, otherwise every
update set is empty. The state is a deterministic function of the bound
source tables, so it grows with them:

* dim_customer holds the customers with ``customerid % 4 <> 0``;
* dim_address holds their addresses, ids dense from 1 in customerid order;
* dim_product holds the products with ``productid % 3 <> 0``, with the rate
  lowered by 1 where ``productid % 3 = 1`` (so %3=0 are inserts, %3=1 updates,
  %3=2 unchanged).

The batch then extracts customers from ``CUSTOMER_MARK`` and order events from
``ORDER_MARK``.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import timeparts as tp
from ..operators import dims, facts
from ..operators.keys import assign_dense_ids
from ..sources import binding, extract, schemas
from .warehouse import RUN_DATE

# Fixed values of the incremental scenario.
CUSTOMER_MOD, PRODUCT_MOD = 4, 3
OLD_NAME = " (before)"
PRODUCT_HISTORY_START = "2001-01-01"
CUSTOMER_MARK = "1995-07-01 00:00:00"
ORDER_MARK = "1998-01-01 00:00:00"


def existing_dims(src: dict[str, DataFrame]) -> dict[str, DataFrame]:
    cm = src["customer_master"].where(F.col("customerid") % CUSTOMER_MOD != 0)
    dim_customer = schemas.conform(
        cm.select("customerid", "name", F.lit(None).cast("bigint").alias("address_id"),
                  tp.date_of("update_timestamp").alias("start_date"),
                  F.lit(tp.OPEN_END_DATE).cast("date").alias("end_date")),
        schemas.DIM_CUSTOMER)
    dim_address = schemas.conform(
        assign_dense_ids(cm.select("customerid", "address", "city", "state", "pincode"),
                         ["customerid"], "address_id", 0),
        schemas.DIM_ADDRESS)
    pm = src["product_master"].where(F.col("productid") % PRODUCT_MOD != 0)
    dim_product = schemas.conform(
        pm.withColumn("rate", F.when(F.col("productid") % PRODUCT_MOD == 1, F.col("rate") - 1)
                      .otherwise(F.col("rate")))
          .withColumn("start_date", F.lit(PRODUCT_HISTORY_START).cast("date"))
          .withColumn("end_date", F.lit(tp.OPEN_END_DATE).cast("date")),
        schemas.DIM_PRODUCT)
    return {"dim_customer": dim_customer, "dim_address": dim_address, "dim_product": dim_product}


class IncrementalBatch:
    """One batch against the existing state; every output is built on first
    access, so a query for one output plans (and checkpoints) only what it needs."""

    def __init__(self, spark: SparkSession, sf_dir: str, run_date: str = RUN_DATE,
                 address_dedupe: str = "row"):
        self.run_date, self.address_dedupe = run_date, address_dedupe
        self.src = binding.oltp_sources(spark, sf_dir)
        self.delta_customer = extract.customers_since(self.src["customer_master"], CUSTOMER_MARK)
        self.delta_orders = extract.orders_since(self.src["order_details"], ORDER_MARK)
        self.delta_products = extract.products_snapshot(self.src["product_master"])
        self.delta_items = extract.items_since(self.src["order_items"], self.src["order_details"],
                                               ORDER_MARK)

    @cached_property
    def existing(self) -> dict[str, DataFrame]:
        return existing_dims(self.src)

    @cached_property
    def stg_dim_address(self) -> DataFrame:
        return dims.address_delta(self.delta_customer, self.existing["dim_address"],
                                  self.address_dedupe)

    @cached_property
    def _customers(self) -> tuple[DataFrame, DataFrame]:
        lookup = self.existing["dim_address"].unionByName(self.stg_dim_address)
        return dims.customer_delta(self.delta_customer, self.existing["dim_customer"], lookup)

    @property
    def customer_inserts(self) -> DataFrame:
        return self._customers[0]

    @property
    def customer_updates(self) -> DataFrame:
        return self._customers[1]

    @cached_property
    def _products(self) -> tuple[DataFrame, DataFrame]:
        return dims.product_delta(self.delta_products, self.existing["dim_product"], self.run_date)

    @property
    def product_inserts(self) -> DataFrame:
        return self._products[0]

    @property
    def product_updates(self) -> DataFrame:
        return self._products[1]

    @property
    def stg_dim_order(self) -> DataFrame:
        return dims.order_status_rows(self.delta_orders)

    @cached_property
    def stg_f_order_details(self) -> DataFrame:
        return facts.order_lines(self.delta_orders, self.delta_items)

    @property
    def stg_fact_daily_orders(self) -> DataFrame:
        return facts.daily_orders(self.delta_orders, self.delta_customer, self.delta_products,
                                  self.stg_f_order_details)


def incremental_batch(spark: SparkSession, sf_dir: str, run_date: str = RUN_DATE,
                      address_dedupe: str = "row") -> IncrementalBatch:
    return IncrementalBatch(spark, sf_dir, run_date, address_dedupe)
