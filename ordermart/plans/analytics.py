"""The ten analytics questions over the star schema.

Each question is one function with a ``grain`` parameter for its slices.
Joins to the customer and address dimensions are written as
``fact ⟕ (dim_customer ⟕ dim_address)``: for left joins this equals the chain
``(fact ⟕ dim_customer) ⟕ dim_address`` because the address condition rejects
rows without a customer, and it joins the two customer-sized dimensions first
so the order-sized fact is shuffled (or streamed past a broadcast) once.
No dimension is broadcast (see ``functions.joins``): all grow with the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import timeparts as tp
from ..functions.joins import merged
from ..operators import distinct
from .warehouse import StarSchema

# grain name -> (output column, expression over the fact/dimension columns)
FACT_GRAINS = {
    "day": ("Daily", lambda: tp.day_of_month("order_received_timestamp")),
    "month": ("Monthly", lambda: tp.month_of_year("order_received_timestamp")),
    "week": ("Weekly", lambda: tp.week_sunday("order_received_timestamp")),
    "state": ("State", lambda: F.col("state")),
    "city": ("City", lambda: F.col("city")),
    "pincode": ("Pincode", lambda: F.col("pincode")),  # the fact's pincode
}


def customer_geo(star: StarSchema, how: str = "left") -> DataFrame:
    """customerid -> (state, city, address pincode) through dim_customer ⋈ dim_address."""
    c = star.dim_customer.select("customerid", "address_id")
    a = star.dim_address.select("address_id", "state", "city",
                                F.col("pincode").alias("address_pincode"))
    return c.join(merged(a), "address_id", how).drop("address_id")


def _avg_per_order(star: StarSchema, measure: str, alias: str, grain: str) -> DataFrame:
    """avg(measure) over fact ⟕ customer ⟕ address, grouped by one grain.

    The fact is first aggregated per (customer[, fact grain]) into sum and
    count (combined map-side, so a customer holding a large share of orders
    never lands whole in one task); only those partials are joined to the
    customer-sized dimensions. A customer matching k dimension rows repeats
    its partials k times, exactly as the row-level join repeats its orders,
    so Σsum / Σcount equals the average over the joined rows (sums of whole
    numbers are exact, and the division is the same double division).
    """
    name, expr = FACT_GRAINS[grain]
    f = star.fact_daily_orders
    fact_grain = grain not in ("state", "city")
    keys = ["customerid"] + ([expr().alias(name)] if fact_grain else [])
    part = f.groupBy(*keys).agg(F.sum(measure).alias("_s"), F.count(measure).alias("_c"))
    j = part.join(merged(customer_geo(star, "left")), "customerid", "left")
    g = F.col(name) if fact_grain else expr().alias(name)
    return j.groupBy(g).agg(
        F.try_divide(F.sum("_s").cast("double"), F.sum("_c").cast("double")).alias(alias))


def q01_avg_items(star: StarSchema, grain: str = "pincode") -> DataFrame:
    """Average number of items per order by day-of-month, month, week, state, city or pincode."""
    return _avg_per_order(star, "item_count", "avg_items", grain)


def q02_avg_sales(star: StarSchema, grain: str = "pincode") -> DataFrame:
    """Average order amount per order by the same grains as q01."""
    return _avg_per_order(star, "order_amount", "avg_sales", grain)


def q01_q02_grouping_sets(star: StarSchema) -> DataFrame:
    """Average items and amount per order by each grain of q01 and q02, in one pass: GROUPING SETS over
    sums per date, area and pincode, themselves over sums per customer. ``grouping_id`` tells the grains apart:
    a bit of the six columns is 0 for the one that a row is grouped by."""
    sums = ("items", "items_n", "sales", "sales_n")
    part = star.fact_daily_orders.groupBy("customerid", tp.date_of("order_received_timestamp").alias("d"), "pincode").agg(
        F.sum("item_count").alias("items"), F.count("item_count").alias("items_n"),
        F.sum("order_amount").alias("sales"), F.count("order_amount").alias("sales_n"))
    j = part.join(merged(customer_geo(star, "left")), "customerid", "left")
    j = j.groupBy("d", "state", "city", "pincode").agg(*(F.sum(c).alias(c) for c in sums))
    names = ["Daily", "Monthly", "Weekly", "State", "City", "Pincode"]
    j = j.select(tp.day_of_month("d").alias("Daily"), tp.month_of_year("d").alias("Monthly"), tp.week_sunday("d").alias("Weekly"),
                 F.col("state").alias("State"), F.col("city").alias("City"), F.col("pincode").alias("Pincode"), *sums)
    ratio = lambda a, b: F.try_divide(F.sum(a).cast("double"), F.sum(b).cast("double"))
    return j.groupingSets([[n] for n in names], *names).agg(
        F.grouping_id().alias("grouping_id"), ratio("items", "items_n").alias("avg_items"), ratio("sales", "sales_n").alias("avg_sales"))


def q03_units_by_sku(star: StarSchema, grain: str = "day") -> DataFrame:
    """Units sold per product name and SKU per delivery day-of-month
    (``grain="month"`` adds the delivery month for the monthly trend)."""
    p = star.dim_product.select("productid", "productname", "sku")
    f = star.f_order_details.select("productid", "order_delivery_timestamp", "quantity")
    keys = [F.col("productname"), F.col("sku"),
            tp.day_of_month("order_delivery_timestamp").alias("DAY")]
    if grain == "month":
        keys.append(tp.month_of_year("order_delivery_timestamp").alias("MONTH"))
    elif grain != "day":
        raise ValueError(grain)
    # units are summed per product and slice first: the join sees partial sums,
    # and a product in a large share of lines is combined map-side
    names = [c for c in ("DAY", "MONTH") if grain == "month" or c == "DAY"]
    part = f.groupBy("productid", *keys[2:]).agg(F.sum("quantity").alias("_units"))
    return p.join(merged(part), "productid").groupBy("productname", "sku", *names).agg(F.sum("_units").alias("units_sold"))


def q04_sales_by_date_product_city(star: StarSchema) -> DataFrame:
    """Σ order_amount per received date, product and city.

    The order amount is repeated for every product line of the order (it is
    an order-level measure joined to the line grain).
    """
    f = star.fact_daily_orders.select("orderid", "customerid", "order_received_timestamp", "order_amount")
    o = star.f_order_details.select("orderid", "productid")
    geo = customer_geo(star, "inner").select("customerid", "city")
    j = f.join(merged(geo), "customerid").join(merged(o), "orderid")
    return (j.groupBy(tp.date_of("order_received_timestamp").alias("Daily"), "productid", "city")
             .agg(F.sum("order_amount").alias("total_sales"))
             # ordered by date; the extra keys let the range partitioning of
             # the sort split a heavy date over several tasks
             .orderBy("Daily", "productid", "city"))


def q04_sales_by_date(star: StarSchema, grain: str = "date") -> DataFrame:
    """Σ order_amount per received date, each order once; also by state, city or
    pincode of the customer's address (pre-aggregated per customer and date)."""
    day = tp.date_of("order_received_timestamp").alias("Daily")
    f = star.fact_daily_orders
    if grain == "date":
        return f.groupBy(day).agg(F.sum("order_amount").alias("total_sales"))
    area = {"state": ["state"], "city": ["state", "city"], "pincode": ["state", "city", "address_pincode"]}[grain]
    part = f.groupBy("customerid", day).agg(F.sum("order_amount").alias("_s"))
    out = part.join(merged(customer_geo(star, "inner")), "customerid").groupBy("Daily", *area).agg(F.sum("_s").alias("total_sales"))
    return out.withColumnRenamed("address_pincode", "pincode")


def q04_sales_by_date_product(star: StarSchema) -> DataFrame:
    """Σ quantity · rate of the lines per received date of their order and product."""
    day = star.fact_daily_orders.select("orderid", tp.date_of("order_received_timestamp").alias("Daily"))
    lines = star.f_order_details.select("orderid", "productid", "quantity")
    units = lines.join(merged(day), "orderid").groupBy("Daily", "productid").agg(F.sum("quantity").alias("_units"))
    rate = star.dim_product.select("productid", "rate")
    return units.join(merged(rate), "productid").groupBy("Daily", "productid").agg(
        F.sum(F.col("_units") * F.col("rate")).alias("total_sales"))


def q05_orders_by_area(star: StarSchema, grain: str = "city") -> DataFrame:
    """Distinct orders per area: (state, city) by default, or state, or state/city/pincode.
    With the batches' bitmaps of order ids no order is shuffled unless its id may be repeated."""
    keys = {"state": ["state"], "city": ["state", "city"],
            "pincode": ["state", "city", "address_pincode"]}[grain]
    out = distinct.orders_by(star.fact_daily_orders, customer_geo(star, "inner"), keys, star.order_bits, "NumberOfOrders")
    return out.withColumnRenamed("address_pincode", "pincode")


def q06_avg_amount_customer_date(star: StarSchema) -> DataFrame:
    f = star.fact_daily_orders
    return (f.groupBy("customerid", tp.date_of("order_received_timestamp").alias("Date"))
             .agg(F.round(F.avg("order_amount"), 2).alias("OrderAmount")))


def q07_new_customers_by_date(star: StarSchema) -> DataFrame:
    """Customers with exactly one dim_customer row, counted per start_date."""
    per = star.dim_customer.groupBy("customerid").agg(
        F.count(F.lit(1)).alias("_n"), F.min("start_date").alias("START_DATE"))
    return (per.where((F.col("_n") == 1) & F.col("customerid").isNotNull())
               .groupBy("START_DATE").agg(F.count("customerid").alias("NewCustomers")))


def q08_counts_by_date(star: StarSchema) -> DataFrame:
    """Per received date: the number of distinct received timestamps.

    Same result as counting, per date, the rows of a ``GROUP BY timestamp``
    (a window over the grouped rows), but as two aggregates: the distinct step
    is spread by timestamp and the count by date is combined map-side, so a
    date holding a large share of orders is never gathered in one task.
    """
    per_ts = star.fact_daily_orders.select("order_received_timestamp").distinct()
    return (per_ts.groupBy(tp.date_of("order_received_timestamp").alias("Dates"))
                  .agg(F.count(F.lit(1)).alias("CustomerCounts"))
                  .orderBy("Dates"))


def q08_customers_by_date(star: StarSchema) -> DataFrame:
    """Distinct customers with an order received, per date."""
    per = star.fact_daily_orders.select(tp.date_of("order_received_timestamp").alias("Dates"), "customerid").distinct()
    return per.groupBy("Dates").agg(F.count("customerid").alias("Customers"))


def _delivery_time_keys(grain: str) -> list:
    """Delivery-time slices; every question also slices by city."""
    ts = "order_delivery_timestamp"
    keys = [tp.date_of(ts).alias("DATES"), tp.week_sunday(ts).alias("WEEKS"),
            tp.day_of_week(ts).alias("WEEKDAYS"), tp.month_of_year(ts).alias("MONTHS")]
    if grain == "hour":
        keys.append(tp.hour_of_day(ts).alias("HOURS"))
    elif grain == "weekend":
        keys = [tp.is_weekend(ts).alias("WEEKEND")]
    elif grain == "daily":
        keys = keys[:1]
    elif grain == "weekday":
        keys = keys[2:3]
    elif grain == "monthly":
        keys = keys[3:]
    elif grain in AREAS:
        keys = []
    elif grain != "base":
        raise ValueError(grain)
    return keys


#: Geography slices of q09 and q10.
AREAS = {"state": ["state"], "pincode": ["address_pincode"]}
SLICES = ("daily", "weekday", "monthly", "state", "pincode")


def _delivery_partials(star: StarSchema, grain: str, aggs: list) -> DataFrame:
    """Fact aggregated per (customer, delivery-time slice), then joined to
    the customer's city (inner joins, as in the question)."""
    part = star.fact_daily_orders.groupBy("customerid", *_delivery_time_keys(grain)).agg(*aggs)
    city = F.col("city").alias("City")
    area = AREAS.get(grain, [] if grain in ("daily", "weekday", "monthly") else [city])
    geo = customer_geo(star, "inner").select("customerid", *area)
    return part.join(merged(geo), "customerid")


def q09_delivery_time(star: StarSchema, grain: str = "base") -> DataFrame:
    """Min / max / avg delivery seconds by delivery date, week, weekday, month
    and city (``hour`` adds the hour; ``weekend`` slices weekend vs weekday by city).

    Pre-aggregated per customer and slice before the dimension join; min of
    mins, max of maxes and Σsum / Σcount give the same values as the
    row-level aggregates over the joined rows.
    """
    m = "order_delivery_time_seconds"
    j = _delivery_partials(star, grain, [F.min(m).alias("_mn"), F.max(m).alias("_mx"),
                                         F.sum(m).alias("_s"), F.count(m).alias("_c")])
    out_keys = [c for c in j.columns if c not in ("customerid", "_mn", "_mx", "_s", "_c")]
    return j.groupBy(*out_keys).agg(
        F.min("_mn").alias("MinDeliveryTime"), F.max("_mx").alias("MaxDeliveryTime"),
        F.try_divide(F.sum("_s").cast("double"), F.sum("_c").cast("double")).alias("AvgDeliveryTime"))


def q09_grouping_sets(star: StarSchema) -> DataFrame:
    """Min / max / avg delivery seconds and orders by delivery date, weekday, month, state, city and
    address pincode, each by itself, in one pass (see ``q01_q02_grouping_sets``)."""
    m = "order_delivery_time_seconds"
    part = star.fact_daily_orders.groupBy("customerid", tp.date_of("order_delivery_timestamp").alias("d")).agg(
        F.min(m).alias("mn"), F.max(m).alias("mx"), F.sum(m).alias("s"), F.count(m).alias("c"), F.count("orderid").alias("n"))
    totals = (F.min("mn").alias("mn"), F.max("mx").alias("mx"), F.sum("s").alias("s"), F.sum("c").alias("c"), F.sum("n").alias("n"))
    j = part.join(merged(customer_geo(star, "inner")), "customerid").groupBy("d", "state", "city", "address_pincode").agg(*totals)
    names = ["DATES", "WEEKDAYS", "MONTHS", "State", "City", "Pincode"]
    j = j.select(F.col("d").alias("DATES"), tp.day_of_week("d").alias("WEEKDAYS"), tp.month_of_year("d").alias("MONTHS"),
                 F.col("state").alias("State"), F.col("city").alias("City"), F.col("address_pincode").alias("Pincode"), "mn", "mx", "s", "c", "n")
    return j.groupingSets([[n] for n in names], *names).agg(
        F.grouping_id().alias("grouping_id"), F.min("mn").alias("MinDeliveryTime"), F.max("mx").alias("MaxDeliveryTime"),
        F.try_divide(F.sum("s").cast("double"), F.sum("c").cast("double")).alias("AvgDeliveryTime"), F.sum("n").alias("NumberOfOrders"))


def q10_orders_sliced(star: StarSchema, grain: str = "base") -> DataFrame:
    """Order count by the same slices as q09 (pre-aggregated per customer)."""
    j = _delivery_partials(star, grain, [F.count("orderid").alias("_n")])
    out_keys = [c for c in j.columns if c not in ("customerid", "_n")]
    return j.groupBy(*out_keys).agg(F.sum("_n").alias("NumberOfOrders"))


def q10_orders_grouping_sets(star: StarSchema) -> DataFrame:
    """Order count by delivery date, weekday, month, state and city, each by itself,
    in one pass: a row per slice name and value."""
    ts = "order_delivery_timestamp"
    part = star.fact_daily_orders.groupBy("customerid", tp.date_of(ts).alias("d")).agg(F.count("orderid").alias("_n"))
    j = part.join(merged(customer_geo(star, "inner")), "customerid")
    j = j.groupBy("d", "state", "city").agg(F.sum("_n").alias("_n"))
    slices = {"date": F.col("d").cast("string"), "weekday": tp.day_of_week("d").cast("string"),
              "month": tp.month_of_year("d").cast("string"), "state": F.col("state"), "city": F.col("city")}
    cells = F.explode(F.array(*(F.struct(F.lit(n).alias("slice"), c.alias("value")) for n, c in slices.items()))).alias("s")
    return j.select(cells, "_n").groupBy("s.slice", "s.value").agg(F.sum("_n").alias("NumberOfOrders"))
