"""Dimension deltas: address, customer, product, order status; SCD2 apply.

Membership tests are semi/anti joins; whole-row "not already present" tests
compare every column null-safely (``<=>``), which Spark still plans as an
equi-join (hash or sort-merge), never as a nested loop.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import timeparts as tp
from ..functions.joins import merged
from ..sources import schemas
from .keys import assign_dense_ids, max_id

ADDRESS_NATURAL_KEY = ["address", "city", "state", "pincode"]
CUSTOMER_COMPARED = ["customerid", "name", "address_id"]
PRODUCT_COMPARED = ["productid", "productcode", "productname", "sku", "rate", "isactive"]


def null_safe_on(left: DataFrame, right: DataFrame, cols: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[c].eqNullSafe(right[c]) for c in cols])


def rows_not_in(df: DataFrame, other: DataFrame, cols: list[str]) -> DataFrame:
    """Rows of ``df`` whose ``cols`` tuple does not occur in ``other`` (nulls match nulls)."""
    o = merged(other.select(*cols).distinct())
    return df.join(o, null_safe_on(df, o, cols), "left_anti")


def address_delta(delta_customer: DataFrame, dim_address: DataFrame,
                  dedupe: str = "row", start_after=None) -> DataFrame:
    """New dim_address rows for the customers of a delta.

    ``dedupe="row"`` (default): one row per delta customer, ids continue after
    the largest existing id in customerid order; rows whose full 5-column tuple
    is already present are then dropped. Because every row carries a fresh id,
    that test never removes a row, so a re-extracted customer gets a second
    address row. ``dedupe="natural_key"``: only addresses whose
    (address, city, state, pincode) is new get an id, once per distinct tuple.
    """
    cols = ["customerid"] + ADDRESS_NATURAL_KEY
    start = max_id(dim_address, "address_id")
    first = start if start_after is None else start_after  # see assign_dense_ids
    if dedupe == "natural_key":
        fresh = rows_not_in(delta_customer.select(*cols), dim_address, ADDRESS_NATURAL_KEY)
        # one id per distinct tuple, numbered by its smallest customerid
        fresh = fresh.groupBy(*ADDRESS_NATURAL_KEY).agg(F.min("customerid").alias("customerid"))
        with_ids = assign_dense_ids(fresh, ["customerid"], "address_id", first)
        return schemas.conform(with_ids, schemas.DIM_ADDRESS)
    if dedupe != "row":
        raise ValueError(f"unknown dedupe mode {dedupe!r}")
    with_ids = assign_dense_ids(delta_customer.select(*cols), ["customerid"], "address_id", first)
    rows = schemas.conform(with_ids, schemas.DIM_ADDRESS)
    # Only an existing row with one of the new ids could match the full tuple,
    # and every new id is above ``start``: the id predicate is exact and lets
    # the scan of the existing dimension skip its row groups by statistics.
    candidates = dim_address.where(F.col("address_id") > F.lit(start))
    return rows_not_in(rows, candidates, [f.name for f in schemas.DIM_ADDRESS.fields])


def customer_delta(delta_customer: DataFrame, dim_customer: DataFrame,
                   address_lookup: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(inserts, updates) for dim_customer.

    ``address_lookup`` is dim_address ∪ stg_dim_address; the delta is matched to
    it on the natural key with nulls matching nulls (left join: an unmatched
    customer keeps a null address_id; a tuple present twice yields two rows).
    start_date is the row's own update date, end_date the open end.
    Inserts are customers unknown to dim_customer, updates known ones.
    """
    a = merged(address_lookup.select("address_id", *ADDRESS_NATURAL_KEY))
    d = delta_customer
    joined = d.join(a, null_safe_on(d, a, ADDRESS_NATURAL_KEY), "left")
    rows = joined.select(
        d["customerid"], d["name"], a["address_id"],
        tp.date_of(d["update_timestamp"]).alias("start_date"),
        F.lit(tp.OPEN_END_DATE).cast("date").alias("end_date"))
    rows = schemas.conform(rows, schemas.DIM_CUSTOMER)
    known = merged(dim_customer.select("customerid").distinct())
    updates = rows.join(known, "customerid", "left_semi")
    inserts = rows.join(known, "customerid", "left_anti")
    return inserts, updates


def match_addresses(delta_customer: DataFrame, dim_address: DataFrame) -> DataFrame:
    """delta ⟕ dim_address on the natural key (nulls match nulls): the delta's
    columns plus the existing address_id, null for an address not yet known.

    With ``natural_key`` ids this single join serves both the new-address
    rows and the customer lookup, so the (large) address dimension is
    shuffled once per batch instead of twice.
    """
    a = merged(dim_address.select("address_id", *ADDRESS_NATURAL_KEY))
    d = delta_customer
    return d.join(a, null_safe_on(d, a, ADDRESS_NATURAL_KEY), "left").select(d["*"], a["address_id"])


def new_addresses(matched: DataFrame, start_after, scratch: str | None = None) -> DataFrame:
    """One new dim_address row per unknown address tuple of ``match_addresses``,
    ids after ``start_after`` in order of the tuple's smallest customerid
    (equal to ``address_delta(..., dedupe="natural_key")``)."""
    fresh = (matched.where(F.col("address_id").isNull())
             .groupBy(*ADDRESS_NATURAL_KEY).agg(F.min("customerid").alias("customerid")))
    return schemas.conform(assign_dense_ids(fresh, ["customerid"], "address_id", start_after, scratch=scratch),
                           schemas.DIM_ADDRESS)


def customers_from_matches(matched: DataFrame, staged_addresses: DataFrame,
                           dim_customer: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(inserts, updates) for dim_customer from ``match_addresses`` output:
    known addresses keep their ids, new ones take the staged id (a join
    against the new rows only). Equal to ``customer_delta`` with the lookup
    dim_address ∪ staged new addresses."""
    n = merged(staged_addresses.select(F.col("address_id").alias("_new_id"), *ADDRESS_NATURAL_KEY))
    m = matched
    j = m.join(n, m["address_id"].isNull() & null_safe_on(m, n, ADDRESS_NATURAL_KEY), "left")
    rows = schemas.conform(j.select(
        m["customerid"], m["name"], F.coalesce(m["address_id"], n["_new_id"]).alias("address_id"),
        tp.date_of(m["update_timestamp"]).alias("start_date"),
        F.lit(tp.OPEN_END_DATE).cast("date").alias("end_date")), schemas.DIM_CUSTOMER)
    known = merged(dim_customer.select("customerid").distinct())
    return rows.join(known, "customerid", "left_anti"), rows.join(known, "customerid", "left_semi")


def product_delta(delta_products: DataFrame, dim_product: DataFrame,
                  run_date: str) -> tuple[DataFrame, DataFrame]:
    """(inserts, updates) for dim_product from a full product snapshot.

    Changed rows are those whose 6-column tuple is not in dim_product. New
    productids are inserts (start_date = run_date, open end); known ones are
    updates carrying end_date = run_date (no start_date column).
    """
    snap = schemas.conform(delta_products, schemas.PRODUCT_MASTER)
    # one aggregate of the dimension per productid and one join on it: a product is
    # known if it has rows, and unchanged if one of them equals the snapshot row
    compared = [c for c in PRODUCT_COMPARED if c != "productid"]
    held = dim_product.groupBy("productid").agg(F.collect_set(F.struct(*compared)).alias("_held"))
    flagged = snap.join(merged(held), "productid", "left")
    unchanged = F.exists("_held", lambda h: reduce(lambda a, b: a & b, [h[c].eqNullSafe(F.col(c)) for c in compared]))
    changes = flagged.where(~F.coalesce(unchanged, F.lit(False)))
    inserts = (changes.where("_held is null").drop("_held")
               .withColumn("start_date", F.lit(run_date).cast("date"))
               .withColumn("end_date", F.lit(tp.OPEN_END_DATE).cast("date")))
    updates = (changes.where("_held is not null").drop("_held")
               .withColumn("end_date", F.lit(run_date).cast("date")))
    return schemas.conform(inserts, schemas.DIM_PRODUCT), updates


def order_status_rows(delta_orders: DataFrame) -> DataFrame:
    """dim_order rows: the status events without customerid."""
    return schemas.conform(delta_orders.drop("customerid"), schemas.DIM_ORDER)


def scd2_apply(dim: DataFrame, inserts: DataFrame, updates: DataFrame, key: str) -> DataFrame:
    """New version of an SCD2 dimension (no MERGE on plain parquet).

    Rows are valid in [start_date, end_date). The open row (end_date = open
    end) of a key in ``updates`` ends where the key's new version starts (at
    its own start, if that is later), and each update becomes the key's open
    row; inserts are appended. ``updates`` has one row per key, with the new
    version's start_date. The result is meant to be written to a new path,
    never over the path being read.
    """
    open_end = F.lit(tp.OPEN_END_DATE).cast("date")
    cols = dim.columns
    begins = updates.groupBy(key).agg(F.max("start_date").alias("_begins"))
    still_open = F.col("_begins").isNotNull() & (F.col("end_date") == open_end)
    closed = dim.join(merged(begins), key, "left").withColumn(
        "end_date", F.when(still_open, F.greatest("start_date", "_begins")).otherwise(F.col("end_date"))).select(*cols)
    new_versions = updates.withColumn("end_date", open_end).select(*cols)
    return closed.unionByName(new_versions).unionByName(inserts.select(*cols))


def scd2_checks(dim: DataFrame, key: str) -> DataFrame:
    """(check_name, violations) of an SCD2 dimension: keys with several open rows,
    rows that the key's next version overlaps, rows that end before they start."""
    ordered = Window.partitionBy(key).orderBy("start_date", "end_date")
    open_end = F.lit(tp.OPEN_END_DATE).cast("date")
    rows = dim.select(key, "start_date", "end_date", F.lead("start_date").over(ordered).alias("following"))
    many = rows.groupBy(key).agg(F.sum((F.col("end_date") == open_end).cast("long")).alias("n")).agg(
        F.coalesce(F.sum((F.col("n") > 1).cast("long")), F.lit(0)).alias("violations"))
    count = lambda cond: rows.agg(F.coalesce(F.sum(cond.cast("long")), F.lit(0)).alias("violations"))
    parts = {"one_open_row": many, "no_overlap": count(F.col("following") < F.col("end_date")),
             "ends_after_start": count(F.col("end_date") < F.col("start_date"))}
    return reduce(DataFrame.unionByName, [d.select(F.lit(n).alias("check_name"), "violations") for n, d in parts.items()])
