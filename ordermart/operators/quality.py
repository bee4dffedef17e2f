"""Data-quality checks: row counts, primary/foreign keys, not-null constraints.

Each check is one aggregate; the results are unioned into a small DataFrame
(one row per table or check), so nothing but the totals reaches the driver.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.joins import merged

# (table, key columns) from the source model
PRIMARY_KEYS = {
    "customer_master": ["customerid"],
    "product_master": ["productid"],
    "order_details": ["orderid", "order_status"],
    "order_items": ["orderid", "productid"],
}
FOREIGN_KEYS = [
    ("order_details", "customerid", "customer_master", "customerid"),
    ("order_items", "productid", "product_master", "productid"),
]
NOT_NULL = {
    "customer_master": ["customerid", "name", "update_timestamp"],
    "product_master": ["productid", "productcode"],
    "order_details": ["orderid", "customerid", "order_status"],
    "order_items": ["orderid", "productid", "quantity"],
}


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    return _union([df.agg(F.count(F.lit(1)).alias("row_count"))
                     .select(F.lit(name).alias("table_name"), "row_count")
                   for name, df in tables.items()])


def key_checks(tables: dict[str, DataFrame]) -> DataFrame:
    """Violations per check: duplicate key rows (rows minus distinct key
    tuples), orphan foreign keys (anti join; a null key is none) and rows with a null in a
    NOT NULL column.

    The key and not-null checks of a table share one pass: a per-key
    aggregate (combined map-side) carries the row count and the null count
    of each key, and a global aggregate over those sums both.
    """
    parts = []
    for t, keys in PRIMARY_KEYS.items():
        any_null = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in NOT_NULL[t]])
        per_key = tables[t].groupBy(*keys).agg(
            F.count(F.lit(1)).alias("_n"),
            F.count(F.when(any_null, F.lit(1))).alias("_nulls"))
        totals = per_key.agg(
            F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("bigint").alias("pk"),
            F.coalesce(F.sum("_nulls"), F.lit(0)).cast("bigint").alias("nn"))
        parts.append(totals.select(
            F.explode(F.array(
                F.struct(F.lit(f"{t}.pk").alias("check_name"), F.col("pk").alias("violations")),
                F.struct(F.lit(f"{t}.not_null").alias("check_name"), F.col("nn").alias("violations"))
            )).alias("c")).select("c.*"))
    for child, col, parent, pcol in FOREIGN_KEYS:
        # one row a key meets the parent, not every child row; a null key refers to nothing
        c = tables[child].where(F.col(col).isNotNull()).groupBy(F.col(col).alias("_fk")).agg(F.count(F.lit(1)).alias("_n"))
        orphans = c.join(merged(tables[parent].select(F.col(pcol).alias("_fk"))), "_fk", "left_anti")
        parts.append(orphans.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("violations"))
                     .select(F.lit(f"{child}.{col}.fk").alias("check_name"), "violations"))
    return _union(parts)


MAX_KEY_COLUMNS = (("customer_master", "customerid"), ("product_master", "productid"))


def max_keys_frame(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, max_key): the largest customerid and productid, 0 when empty."""
    return _union([tables[t].agg(F.coalesce(F.max(c), F.lit(0)).cast("bigint").alias("max_key"))
                     .select(F.lit(t).alias("table_name"), "max_key")
                   for t, c in MAX_KEY_COLUMNS])


def max_keys(tables: dict[str, DataFrame]) -> dict[str, int]:
    """The same as a driver dict (two rows): next ids for new source rows."""
    return {r["table_name"]: int(r["max_key"]) for r in max_keys_frame(tables).collect()}
