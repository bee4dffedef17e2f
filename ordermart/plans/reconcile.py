"""Reconciliation of a batch: the same rows in source, stage and target, by order-free checksums.

Each step compares number, sum and XOR of 64-bit row hashes of both sides, so it costs a scan of the
batch's own rows and moves one row a task; a repeated row changes the sum where the XOR
would cancel it. Nulls are hashed with their place. A step with ``differences`` 0 has equal sides.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import dims
from ..sources import control, extract, schemas, segments, sinks

#: Extracts: source table -> (delta, mark).
EXTRACTS = {"order_details": ("delta_orders", "stg_dim_order"), "customer_master": ("delta_customer", "stg_dim_customer"),
            "product_master": ("delta_products", "stg_dim_product")}
DELTA_SCHEMAS = {"order_details": schemas.ORDER_DETAILS, "customer_master": schemas.CUSTOMER_MASTER, "product_master": schemas.PRODUCT_MASTER}


def checksum(df: DataFrame, schema: T.StructType) -> DataFrame:
    """One row: (n, total, mixed) of the rows' hashes, whatever their order and partitions."""
    rows = schemas.conform(df, schema)
    row = F.xxhash64(*(F.col(c) for c in rows.columns), *(F.col(c).isNull() for c in rows.columns))
    return rows.select(row.alias("h")).agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.col("h").cast("decimal(20,0)")), F.lit(0)).cast("decimal(38,0)").alias("total"),
        F.coalesce(F.bit_xor("h"), F.lit(0)).alias("mixed"))


def batch_rows(spark: SparkSession, root: str, name: str, batch_id: int) -> DataFrame:
    """A target's rows of one batch, from its own folder or the segment that holds it."""
    rows = segments.read(spark, root, name, segments.layout(spark, root, name, [batch_id])[1])
    return schemas.empty(spark, schemas.TARGETS[name].schema) if rows is None else rows


def reconcile(spark: SparkSession, root: str, batch_id: int, sources: dict[str, DataFrame] | None = None) -> DataFrame:
    """(table_name, step, rows_from, rows_to, differences) of a completed batch.

    Steps: ``source to delta`` of the three extracts (with ``sources``, that must still hold what the batch
    read: for batches with plain marks, before new rows arrive), ``delta to stage`` of the order events,
    ``stage to target`` of every target."""
    pairs: list[tuple[str, str, DataFrame, DataFrame, T.StructType]] = []
    marks = control.high_water_marks(spark, sinks.log_path(root), [m for _, m in EXTRACTS.values()], before_logid=batch_id)
    read = {"order_details": extract.orders_since, "customer_master": extract.customers_since, "product_master": extract.products_snapshot}
    deltas = {n: sinks.read_stage(spark, root, d, batch_id, DELTA_SCHEMAS[n]) for n, (d, _) in EXTRACTS.items()}
    for name in EXTRACTS if sources else ():
        pairs.append((name, "source to delta", read[name](sources[name], marks[EXTRACTS[name][1]]), deltas[name], DELTA_SCHEMAS[name]))
    pairs.append(("dim_order", "delta to stage", dims.order_status_rows(deltas["order_details"]), sinks.read_stage(spark, root, "dim_order", batch_id),
                  schemas.DIM_ORDER))
    for name in schemas.TARGET_LOAD_ORDER:
        schema = schemas.TARGETS[name].schema
        pairs.append((name, "stage to target", sinks.read_stage(spark, root, name, batch_id), batch_rows(spark, root, name, batch_id), schema))
    sides = [checksum(df, schema).select(F.lit(name).alias("table_name"), F.lit(step).alias("step"), F.lit(side).alias("side"), "*")
             for name, step, left, right, schema in pairs for side, df in (("from", left), ("to", right))]
    rows = lambda side: F.max(F.when(F.col("side") == side, F.col("n")))
    return reduce(DataFrame.unionByName, sides).groupBy("table_name", "step").agg(
        rows("from").alias("rows_from"), rows("to").alias("rows_to"),
        (F.size(F.collect_set(F.struct("n", "total", "mixed"))) - 1).cast("bigint").alias("differences"))
