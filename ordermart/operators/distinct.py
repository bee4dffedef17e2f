"""Exact distinct counts of orders from mergeable bitmaps.

Each batch stores which order ids its fact rows hold: per range of 32,768 ids a bitmap and the
number of rows. Bitmaps of several batches merge by OR; a range whose bits are as many as its rows
holds no id twice, so its orders need no distinct: they are counted per customer, combined
map-side, and no order is shuffled. Only the ranges with repeated ids are counted as distinct ids.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.joins import merged

BITMAP_BYTES, ROW_BYTES, SMALL = 4096, 64, 1 << 20
#: Ranges with repeated ids that are named in a predicate; with more, every id is counted as distinct.
RANGES = 1000


def id_range(col: str) -> Column:
    return F.bitmap_bucket_number(F.col(col).cast("bigint"))


def order_bits(facts: DataFrame) -> DataFrame:
    """(id_range, bits, orders) of a batch's order ids. Ids so sparse that their bitmaps would take
    more than 64 bytes an order (and a megabyte) get a null for ``bits``: not known."""
    ids = facts.where("orderid is not null").select(F.col("orderid").cast("bigint").alias("orderid"))
    ranged = ids.groupBy(id_range("orderid").alias("id_range"))
    counts = ranged.agg(F.count(F.lit(1)).alias("orders"))
    ranges, orders = counts.agg(F.count(F.lit(1)), F.coalesce(F.sum("orders"), F.lit(0))).first()
    if ranges * BITMAP_BYTES > max(SMALL, ROW_BYTES * orders):
        return counts.select("id_range", F.lit(None).cast("binary").alias("bits"), "orders")
    return ranged.agg(F.bitmap_construct_agg(F.bitmap_bit_position("orderid")).alias("bits"), F.count(F.lit(1)).alias("orders"))


def repeated_ranges(bits: DataFrame) -> list[int] | None:
    """Ranges in which an id is repeated or not known to be single; None: more than RANGES."""
    whole = bits.groupBy("id_range").agg(
        F.bitmap_or_agg("bits").alias("_bits"), F.sum("orders").alias("_n"), F.count_if(F.col("bits").isNull()).alias("_unknown"))
    doubtful = whole.where((F.col("_unknown") > 0) | (F.bitmap_count("_bits") != F.col("_n")))
    found = [r[0] for r in doubtful.select("id_range").limit(RANGES + 1).collect()]
    return found if len(found) <= RANGES else None


def orders_by(facts: DataFrame, areas: DataFrame, keys: list[str], bits: DataFrame | None, alias: str) -> DataFrame:
    """Distinct orders per ``keys`` of ``areas`` (customerid and the keys), joined by customerid."""
    f = facts.select("customerid", "orderid")
    doubtful = repeated_ranges(bits) if bits is not None else None
    if doubtful is None:
        return f.join(merged(areas), "customerid").groupBy(*keys).agg(F.count_distinct("orderid").alias(alias))
    # a customer with several rows in an area counts its orders once there
    per_area = areas.where("customerid is not null").select("customerid", *keys).distinct()
    again = id_range("orderid").isin(doubtful)
    single = f.where(F.coalesce(~again, F.lit(True))) if doubtful else f
    per_customer = single.groupBy("customerid").agg(F.count("orderid").alias("_n"))
    out = per_customer.join(merged(per_area), "customerid").groupBy(*keys).agg(F.sum("_n").alias(alias))
    if doubtful:
        rest = f.where(again).join(merged(areas), "customerid").groupBy(*keys).agg(F.count_distinct("orderid").alias(alias))
        out = out.unionByName(rest).groupBy(*keys).agg(F.sum(alias).alias(alias))
    return out
