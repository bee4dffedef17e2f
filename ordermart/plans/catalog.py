"""Registry of named queries: name -> fn(spark, sf_dir) -> DataFrame.

Analytics questions run on the star schema that the ETL builds from the
bound sources (written once per session into the shared checkpoint folder);
ETL, extract, dedupe and quality entries are plans over the sources; those that
assign address ids run a few jobs (partition counts, largest id) when built.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import timeparts as tp
from ..functions.joins import merged
from ..operators import dims, quality
from ..session import scratch_path
from ..sources import binding, control, extract, schemas, sinks
from . import analytics as a
from . import history as h
from . import pipeline, reconcile
from .warehouse import RUN_DATE, late_events, materialize, scd2_batches, two_batches

QueryFn = Callable[[SparkSession, str], DataFrame]


def _star(fn, **kw) -> QueryFn:
    return lambda spark, sf: fn(materialize(spark, sf), **kw)


def _inc(attr: str, **kw) -> QueryFn:
    return lambda spark, sf: getattr(h.incremental_batch(spark, sf, **kw), attr)


def _scd2_product(spark: SparkSession, sf: str) -> DataFrame:
    batch = h.incremental_batch(spark, sf)
    updates = batch.product_updates.withColumnRenamed("end_date", "start_date")  # valid from the run date
    return dims.scd2_apply(batch.existing["dim_product"], batch.product_inserts, updates, "productid")


def _scd2_customer(spark: SparkSession, sf: str) -> DataFrame:
    return _scd2_customer_by(spark, sf, "natural_key")


def _scd2_customer_by(spark: SparkSession, sf: str, dedupe: str) -> DataFrame:
    batch = h.incremental_batch(spark, sf, address_dedupe=dedupe)
    old = batch.existing["dim_customer"]
    changed = dims.rows_not_in(batch.customer_updates, old, dims.CUSTOMER_COMPARED)
    return dims.scd2_apply(old, batch.customer_inserts, changed, "customerid")


def _unclosed(spark: SparkSession, sf: str) -> DataFrame:
    """A wrong version on purpose: new rows are added and the old ones stay open."""
    batch = h.incremental_batch(spark, sf)
    new = batch.product_updates.withColumnRenamed("end_date", "start_date").withColumn(
        "end_date", F.lit(tp.OPEN_END_DATE).cast("date"))
    return batch.existing["dim_product"].unionByName(new.select(batch.existing["dim_product"].columns))


def _raw_line_checks(spark: SparkSession, sf: str) -> DataFrame:
    """Key checks of the lines as they arrive, before repeated keys are removed."""
    lines = spark.read.parquet(f"{sf}/lineitem.parquet")
    keys = lines.select(F.col("l_orderkey").alias("orderid"), F.col("l_partkey").alias("productid"))
    orders = spark.read.parquet(f"{sf}/orders.parquet").where("o_orderstatus <> 'F'").select(F.col("o_orderkey").alias("orderid"))
    repeated = keys.groupBy("orderid", "productid").count().agg(F.sum(F.col("count") - 1).alias("violations"))
    orphans = keys.where("orderid is not null").groupBy("orderid").count().join(merged(orders), "orderid", "left_anti").agg(
        F.coalesce(F.sum("count"), F.lit(0)).alias("violations"))
    return repeated.select(F.lit("lines.pk").alias("check_name"), "violations").unionByName(
        orphans.select(F.lit("lines.open_order.fk").alias("check_name"), "violations"))


def _high_water_marks(spark: SparkSession, sf: str) -> DataFrame:
    """Marks of a log derived from the orders: a Completed row per order month for
    one table, later Failed rows, and a table that only ever failed."""
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    at = F.date_trunc("MONTH", "o_orderdate").cast("timestamp_ntz")
    log = orders.groupBy(at.alias("lastextractdatetime")).agg(F.count("*").alias("extractrowcount"))
    status = lambda t, s, days: log.select(
        F.lit(t).alias("tablename"), F.lit(s).alias("status"), (F.col("lastextractdatetime") + F.expr(f"interval {days} days")).alias("lastextractdatetime"))
    whole = status("stg_dim_order", control.COMPLETED, 0).unionByName(status("stg_dim_order", control.FAILED, 45)).unionByName(
        status("stg_dim_product", control.FAILED, 0))
    tables = ["stg_dim_order", "stg_dim_product", "stg_dim_customer"]
    marks = control.marks_of(whole, tables)
    asked = spark.createDataFrame([(t,) for t in tables], "tablename string")
    default = F.lit(tp.DEFAULT_MARK).cast("timestamp_ntz")
    return asked.join(F.broadcast(marks), "tablename", "left").select("tablename", F.coalesce("mark", default).alias("mark"))


def _two_batch_facts(accumulate: bool) -> QueryFn:
    return lambda spark, sf: pipeline.warehouse(spark, two_batches(spark, sf), accumulate).fact_daily_orders


def _two_batch_delivery(spark: SparkSession, sf: str) -> DataFrame:
    """Orders and delivery times by the month of delivery, of what both batches know."""
    fact = pipeline.warehouse(spark, two_batches(spark, sf), accumulate=True).fact_daily_orders
    month = tp.month_start("order_delivery_timestamp")
    took = "order_delivery_time_seconds"
    return fact.where("order_delivery_timestamp is not null").groupBy(month.alias("delivery_month")).agg(
        F.count("*").alias("orders"), F.min(took).alias("fastest"), F.max(took).alias("slowest"), F.sum(took).alias("seconds"))


def _two_batch_log(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of the extract log that the two batches left."""
    log = control.read_log(spark, sinks.log_path(two_batches(spark, sf)))
    return log.select("processlogid", "tablename", "extractrowcount", "status")


def _insert_and_purge(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of a source table after the lines are inserted twice, purged, and inserted again."""
    path, items = scratch_path(spark, "oltp"), binding.oltp_sources(spark, sf)["order_items"]
    counts = []
    for step in ("insert", "insert again", "purge", "insert after purge"):
        if step == "purge":
            sinks.purge(spark, path, schemas.ORDER_ITEMS)
        else:
            sinks.append_oltp(items, path, schemas.ORDER_ITEMS)
        counts.append((step, spark.read.schema(schemas.ORDER_ITEMS).parquet(path).count()))
    return spark.createDataFrame(counts, "step string, row_count bigint")


def _address_buckets(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of the address dimension by storage bucket."""
    bucket = tp.address_range_bucket("address_id").alias("bucket")
    return materialize(spark, sf).dim_address.groupBy(bucket).agg(F.count("*").alias("addresses"), F.max("address_id").alias("max_id"))


def analytics_queries() -> dict[str, QueryFn]:
    q: dict[str, QueryFn] = {}
    for g in a.FACT_GRAINS:
        q[f"q01_avg_items_by_{g}"] = _star(a.q01_avg_items, grain=g)
        q[f"q02_avg_sales_by_{g}"] = _star(a.q02_avg_sales, grain=g)
    q["q03_units_by_sku_day"] = _star(a.q03_units_by_sku, grain="day")
    q["q03_units_by_sku_month"] = _star(a.q03_units_by_sku, grain="month")
    q["q04_sales_by_date_product_city"] = _star(a.q04_sales_by_date_product_city)
    q["q05_orders_by_area"] = _star(a.q05_orders_by_area, grain="city")
    q["q05_orders_by_area_state"] = _star(a.q05_orders_by_area, grain="state")
    q["q05_orders_by_area_pincode"] = _star(a.q05_orders_by_area, grain="pincode")
    q["q06_avg_amount_customer_date"] = _star(a.q06_avg_amount_customer_date)
    q["q07_new_customers_by_date"] = _star(a.q07_new_customers_by_date)
    q["q08_counts_by_date"] = _star(a.q08_counts_by_date)
    q["q08b_customers_by_date"] = _star(a.q08_customers_by_date)
    q["q04_daily"] = _star(a.q04_sales_by_date)
    q["q04_by_product"] = _star(a.q04_sales_by_date_product)
    for g in ("state", "city", "pincode"):
        q[f"q04_by_{g}"] = _star(a.q04_sales_by_date, grain=g)
    for g in a.SLICES:
        q[f"q09_delivery_time_{g}"] = _star(a.q09_delivery_time, grain=g)
        q[f"q10_orders_sliced_{g}"] = _star(a.q10_orders_sliced, grain=g)
    q["q01_q02_grouping_sets"] = _star(a.q01_q02_grouping_sets)
    q["q09_grouping_sets"] = _star(a.q09_grouping_sets)
    q["q05_two_batches_orders_by_city"] = lambda spark, sf: a.q05_orders_by_area(pipeline.warehouse(spark, two_batches(spark, sf)))
    q["q10_orders_grouping_sets"] = _star(a.q10_orders_grouping_sets)
    for g in ("base", "hour", "weekend"):
        suffix = "" if g == "base" else f"_{g}"
        q[f"q09_delivery_time{suffix}"] = _star(a.q09_delivery_time, grain=g)
        q[f"q10_orders_sliced{suffix}"] = _star(a.q10_orders_sliced, grain=g)
    return q


def etl_queries() -> dict[str, QueryFn]:
    def src(name):
        return lambda spark, sf: binding.oltp_sources(spark, sf)[name]

    return {
        "etl_dim_address": _inc("stg_dim_address"),
        "etl_dim_customer_inserts": _inc("customer_inserts"),
        "etl_dim_customer_updates": _inc("customer_updates"),
        "etl_dim_product_inserts": _inc("product_inserts"),
        "etl_dim_product_updates": _inc("product_updates"),
        "etl_dim_address_natural_key": _inc("stg_dim_address", address_dedupe="natural_key"),
        "etl_dim_customer_inserts_natural_key": _inc("customer_inserts", address_dedupe="natural_key"),
        "etl_dim_customer_updates_natural_key": _inc("customer_updates", address_dedupe="natural_key"),
        "etl_dim_order": _inc("stg_dim_order"),
        "etl_f_order_details": _inc("stg_f_order_details"),
        "etl_fact_daily_orders": _inc("stg_fact_daily_orders"),
        "etl_scd2_apply_product": _scd2_product,
        "etl_scd2_apply_customer": _scd2_customer,
        "scd2_checks_product": lambda spark, sf: dims.scd2_checks(_scd2_product(spark, sf), "productid"),
        "scd2_checks_customer": lambda spark, sf: dims.scd2_checks(_scd2_customer(spark, sf), "customerid"),
        "scd2_checks_not_closed": lambda spark, sf: dims.scd2_checks(_unclosed(spark, sf), "productid"),
        "scd2_batches_product": lambda spark, sf: pipeline.scd2_current(spark, scd2_batches(spark, sf), "dim_product"),
        "scd2_batches_customer": lambda spark, sf: pipeline.scd2_current(spark, scd2_batches(spark, sf), "dim_customer"),
        "etl_high_water_mark": _high_water_marks,
        "quality_raw_line_checks": _raw_line_checks,
        "dim_address_buckets": _address_buckets,
        "two_batches_fact_daily_orders": _two_batch_facts(accumulate=False),
        "two_batches_accumulated_orders": _two_batch_facts(accumulate=True),
        "two_batches_delivery_time_month": _two_batch_delivery,
        "two_batches_extract_log": _two_batch_log,
        "late_events_dim_order": lambda spark, sf: pipeline.warehouse(spark, late_events(spark, sf)).dim_order,
        "late_events_accumulated_orders": lambda spark, sf: pipeline.warehouse(spark, late_events(spark, sf), accumulate=True).fact_daily_orders,
        "two_batches_reconciled": lambda spark, sf: reconcile.reconcile(
            spark, two_batches(spark, sf), 2, binding.oltp_sources(spark, sf)),
        "oltp_insert_purge": _insert_and_purge,
        "extract_customers_since": lambda spark, sf: extract.customers_since(
            binding.customer_master(spark, sf), h.CUSTOMER_MARK),
        "extract_orders_since": lambda spark, sf: extract.orders_since(
            binding.order_details(spark, sf), h.ORDER_MARK),
        "extract_items_since": _inc("delta_items"),
        "dedupe_order_items": src("order_items"),
        "quality_row_counts": lambda spark, sf: quality.row_counts(binding.oltp_sources(spark, sf)),
        "quality_key_checks": lambda spark, sf: quality.key_checks(binding.oltp_sources(spark, sf)),
        "quality_max_keys": lambda spark, sf: quality.max_keys_frame(binding.oltp_sources(spark, sf)),
    }


def all_queries() -> dict[str, QueryFn]:
    return {**analytics_queries(), **etl_queries()}
