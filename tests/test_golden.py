"""Hand-written mini-fixtures for the non-obvious semantics of the batch."""

import datetime as dt


from pyspark.sql import functions as F

from ordermart.operators import dims, facts
from ordermart.plans import analytics, pipeline
from ordermart.plans.warehouse import StarSchema
from ordermart.sources import control, schemas, sinks

T = dt.datetime


def cust(spark, rows):
    return spark.createDataFrame(rows, schemas.CUSTOMER_MASTER)


def prod(spark, rows):
    return spark.createDataFrame(rows, schemas.PRODUCT_MASTER)


def events(spark, rows):
    return spark.createDataFrame(rows, schemas.ORDER_DETAILS)


def items(spark, rows):
    return spark.createDataFrame(rows, schemas.ORDER_ITEMS)


def sources(spark, c, p, e, i):
    return {"customer_master": cust(spark, c), "product_master": prod(spark, p),
            "order_details": events(spark, e), "order_items": items(spark, i)}


PRODUCTS = [(10, "A10", "rice", "5KG", 100, True), (11, "B11", "ata", "2KG", 50, False)]
CUSTOMERS = [(1, "ann", "1 street", "Pune", "Maharashtra", 411001, T(2022, 1, 1, 9)),
             (2, "bob", "2 street", "Agra", "Uttar Pradesh", 282001, T(2022, 1, 2, 9))]


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_two_batch_order_delivered_later(spark, tmp_root):
    """An order received in batch 1 and delivered in batch 2 never gets its
    delivery time in the fact; its lines come with the InProgress batch only."""
    ev1 = [(100, 1, T(2022, 3, 1, 10), "Received"), (100, 1, T(2022, 3, 1, 12), "InProgress")]
    it = [(100, 10, 3), (100, 11, 2)]
    pipeline.run_batch(spark, sources(spark, CUSTOMERS, PRODUCTS, ev1, it), tmp_root, T(2022, 3, 2))
    ev2 = ev1 + [(100, 1, T(2022, 3, 3, 8), "Delivered")]
    r2 = pipeline.run_batch(spark, sources(spark, CUSTOMERS, PRODUCTS, ev2, it), tmp_root, T(2022, 3, 4))
    assert r2.marks["stg_dim_order"] == "2022-03-02 00:00:00"
    wh = pipeline.warehouse(spark, tmp_root)
    fact = rows(wh.fact_daily_orders, "orderid")
    assert fact == [(1, 100, T(2022, 3, 1, 10), None, 411001, 3 * 100 + 2 * 50, 5, 0)]
    lines = rows(wh.f_order_details, "productid")
    assert [(r[0], r[1], r[2]) for r in lines] == [(100, None, 10), (100, None, 11)]
    assert r2.staged["f_order_details"] == 0 and r2.staged["fact_daily_orders"] == 0
    assert wh.dim_order.count() == 3


def test_reextracted_customer_and_shared_address(spark):
    """Every delta customer gets a fresh address row (the 5-column compare
    never matches an older id), so the natural-key lookup fans out."""
    shared = [(1, "ann", "x lane", "Pune", "Maharashtra", 411001, T(2022, 1, 1)),
              (2, "bob", "x lane", "Pune", "Maharashtra", 411001, T(2022, 1, 5))]
    d = cust(spark, shared)
    empty_addr = schemas.empty(spark, schemas.DIM_ADDRESS)
    addr = dims.address_delta(d, empty_addr)
    assert rows(addr, "address_id") == [(1, "x lane", "Pune", "Maharashtra", 411001),
                                        (2, "x lane", "Pune", "Maharashtra", 411001)]
    ins, upd = dims.customer_delta(d, schemas.empty(spark, schemas.DIM_CUSTOMER), addr)
    got = rows(ins, "customerid", "address_id")
    # each customer matches both rows; start_date is the row's own update date
    assert got == [(1, "ann", 1, dt.date(2022, 1, 1), dt.date(9999, 12, 31)),
                   (1, "ann", 2, dt.date(2022, 1, 1), dt.date(9999, 12, 31)),
                   (2, "bob", 1, dt.date(2022, 1, 5), dt.date(9999, 12, 31)),
                   (2, "bob", 2, dt.date(2022, 1, 5), dt.date(9999, 12, 31))]
    assert upd.count() == 0
    # opt-in natural-key dedupe: one id per distinct address, none if known
    nk = dims.address_delta(d, empty_addr, dedupe="natural_key")
    assert rows(nk, "address_id") == [(1, "x lane", "Pune", "Maharashtra", 411001)]
    assert dims.address_delta(d, nk, dedupe="natural_key").count() == 0
    # re-extract of customer 1 against the loaded addresses: ids continue at 3
    again = dims.address_delta(d.where("customerid = 1"), addr)
    assert rows(again, "address_id") == [(3, "x lane", "Pune", "Maharashtra", 411001)]


def test_null_address_parts_match_null_safely(spark):
    d = cust(spark, [(5, "eve", None, None, "Gujrat", None, T(2022, 2, 1))])
    addr = dims.address_delta(d, schemas.empty(spark, schemas.DIM_ADDRESS))
    ins, _ = dims.customer_delta(d, schemas.empty(spark, schemas.DIM_CUSTOMER), addr)
    assert rows(ins, "customerid")[0][2] == 1


def test_order_fact_edge_cases(spark):
    """Customer missing from the delta -> pincode 0; undelivered -> null ts and
    0 seconds; no lines -> amount and units 0; unknown product -> units only;
    null event column -> event ignored."""
    ev = events(spark, [
        (1, 1, T(2022, 1, 1, 0), "Received"), (1, 1, T(2022, 1, 1, 1), "InProgress"),
        (1, 1, T(2022, 1, 1, 2, 0, 30), "Delivered"),
        (2, 99, T(2022, 1, 2), "Received"),                     # customer not in delta
        (3, 2, T(2022, 1, 3), "Received"), (3, 2, None, "Delivered"),  # null ts: ignored
        (4, 2, T(2022, 1, 4), "Delivered"),                     # never received: no fact row
    ])
    it = items(spark, [(1, 10, 2), (1, 77, 4), (3, 11, 1)])
    lines = facts.order_lines(ev, it)
    f = facts.daily_orders(ev, cust(spark, CUSTOMERS), prod(spark, PRODUCTS), lines)
    assert rows(f, "orderid") == [
        (1, 1, T(2022, 1, 1, 0), T(2022, 1, 1, 2, 0, 30), 411001, 200, 6, 7230),
        (99, 2, T(2022, 1, 2), None, 0, 0, 0, 0),
        (2, 3, T(2022, 1, 3), None, 282001, 50, 1, 0),
    ]


def test_delivered_by_other_customer_is_not_joined(spark):
    ev = events(spark, [(1, 1, T(2022, 1, 1), "Received"), (1, 2, T(2022, 1, 2), "Delivered")])
    f = facts.order_pivot(ev)
    assert rows(f, "orderid") == [(1, 1, T(2022, 1, 1), None)]


def _star(spark, fact_rows, line_rows):
    addr = spark.createDataFrame([(1, "a", "Pune", "Maharashtra", 411001)], schemas.DIM_ADDRESS)
    dc = spark.createDataFrame([(1, "ann", 1, dt.date(2022, 1, 1), dt.date(9999, 12, 31))],
                               schemas.DIM_CUSTOMER)
    dp = spark.createDataFrame([(p, "c", "n", "1KG", 1, True, dt.date(2022, 1, 1), dt.date(9999, 12, 31))
                                for p in (10, 11, 12)], schemas.DIM_PRODUCT)
    return StarSchema(addr, dc, dp, schemas.empty(spark, schemas.DIM_ORDER),
                      spark.createDataFrame(line_rows, schemas.F_ORDER_DETAILS),
                      spark.createDataFrame(fact_rows, schemas.FACT_DAILY_ORDERS))


def test_q04_repeats_order_amount_per_line_and_q08_counts_timestamps(spark):
    ts = T(2022, 5, 1, 10)
    star = _star(spark,
                 [(1, 1, ts, None, 411001, 70, 3, 0), (1, 2, ts, None, 411001, 5, 1, 0)],
                 [(1, None, 10, 1), (1, None, 11, 1), (1, None, 12, 1), (2, None, 10, 1)])
    q4 = rows(analytics.q04_sales_by_date_product_city(star), "productid")
    assert q4 == [(dt.date(2022, 5, 1), 10, "Pune", 75), (dt.date(2022, 5, 1), 11, "Pune", 70),
                  (dt.date(2022, 5, 1), 12, "Pune", 70)]
    # two orders at one timestamp count once
    assert rows(analytics.q08_counts_by_date(star), "Dates") == [(dt.date(2022, 5, 1), 1)]


def test_product_unchanged_changed_new(spark):
    dim = spark.createDataFrame([
        (10, "A10", "rice", "5KG", 100, True, dt.date(2021, 1, 1), dt.date(9999, 12, 31)),
        (11, "B11", "ata", "2KG", 40, False, dt.date(2021, 1, 1), dt.date(9999, 12, 31))],
        schemas.DIM_PRODUCT)
    snap = prod(spark, PRODUCTS + [(12, "C12", "bags", None, None, None)])
    ins, upd = dims.product_delta(snap, dim, "2022-06-01")
    assert rows(ins, "productid") == [(12, "C12", "bags", None, None, None, dt.date(2022, 6, 1),
                                       dt.date(9999, 12, 31))]
    assert rows(upd, "productid") == [(11, "B11", "ata", "2KG", 50, False, dt.date(2022, 6, 1))]
    new = dims.scd2_apply(dim, ins, upd.withColumnRenamed("end_date", "start_date"), "productid")
    got = rows(new, "productid", "start_date")
    assert got == [
        (10, "A10", "rice", "5KG", 100, True, dt.date(2021, 1, 1), dt.date(9999, 12, 31)),
        (11, "B11", "ata", "2KG", 40, False, dt.date(2021, 1, 1), dt.date(2022, 6, 1)),
        (11, "B11", "ata", "2KG", 50, False, dt.date(2022, 6, 1), dt.date(9999, 12, 31)),
        (12, "C12", "bags", None, None, None, dt.date(2022, 6, 1), dt.date(9999, 12, 31))]


def test_marks_event_at_mark_empty_log_failed_only(spark, tmp_root):
    log = sinks.log_path(tmp_root)
    assert control.high_water_mark(spark, log, "stg_dim_order") == "1900-01-01 00:00:00"
    control.append_log(spark, log, 1, "stg_dim_order", 5, control.COMPLETED, T(2022, 1, 1))
    control.append_log(spark, log, 2, "stg_dim_order", 6, control.COMPLETED, T(2022, 2, 1))
    control.append_log(spark, log, 3, "stg_dim_order", 0, control.FAILED, T(2022, 3, 1))
    control.append_log(spark, log, 3, "stg_dim_product", 0, control.FAILED, T(2022, 3, 1))
    m = control.high_water_marks(spark, log, ["stg_dim_order", "stg_dim_product", "stg_dim_customer"])
    assert m == {"stg_dim_order": "2022-02-01 00:00:00", "stg_dim_product": "1900-01-01 00:00:00",
                 "stg_dim_customer": "1900-01-01 00:00:00"}
    from ordermart.sources import extract
    ev = events(spark, [(1, 1, T(2022, 2, 1), "Received"), (2, 1, T(2022, 1, 31, 23, 59, 59), "Received")])
    assert [r.orderid for r in extract.orders_since(ev, m["stg_dim_order"]).collect()] == [1]


def test_same_batch_loaded_twice_is_idempotent(spark, tmp_root):
    ev = [(100, 1, T(2022, 3, 1, 10), "Received")]
    src = sources(spark, CUSTOMERS, PRODUCTS, ev, [])
    r = pipeline.extract_and_stage(spark, src, tmp_root, T(2022, 3, 2))
    pipeline.load_targets(spark, tmp_root, r.batch_id)
    pipeline.load_targets(spark, tmp_root, r.batch_id)   # retried load
    assert pipeline.warehouse(spark, tmp_root).fact_daily_orders.count() == 0   # not complete yet
    pipeline.log_completed(spark, tmp_root, r)
    wh = pipeline.warehouse(spark, tmp_root)
    assert wh.fact_daily_orders.count() == 1
    assert wh.dim_customer.count() == 2 and wh.dim_address.count() == 2
    # the next batch starts from the new mark and overwrites the stage
    r2 = pipeline.extract_and_stage(spark, src, tmp_root, T(2022, 3, 3))
    assert r2.marks["stg_dim_order"] == "2022-03-02 00:00:00"
    assert r2.staged["dim_order"] == 0
    assert sinks.read_stage(spark, tmp_root, "dim_order", r2.batch_id).count() == 0


def test_sunday_weeks_and_weekdays_around_new_year(spark):
    days = [dt.date(2016, 12, 31) + dt.timedelta(days=i) for i in range(0, 800, 1)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    from ordermart.functions import timeparts as tp
    got = df.select("d", tp.week_sunday("d").alias("w"), tp.day_of_week("d").alias("dow"),
                    tp.is_weekend("d").alias("we")).collect()
    for r in got:
        assert r.w == int(r.d.strftime("%U")), r.d
        assert r.dow == (r.d.isoweekday() % 7) + 1
        assert r.we == (r.d.isoweekday() in (6, 7))


def test_address_bucket(spark):
    from ordermart.functions import timeparts as tp
    df = spark.createDataFrame([(i,) for i in (-5, 0, 99, 100, 999, 1000, 5000)], "a bigint")
    got = [r[0] for r in df.select(tp.address_range_bucket("a")).collect()]
    assert got == [-1, 0, 0, 1, 9, -1, -1]


def test_single_join_address_path_equals_lookup_path(spark):
    """match_addresses + new_addresses + customers_from_matches equal
    address_delta(natural_key) + customer_delta over dim ∪ stage, including
    a tuple already present twice in the dimension."""
    dim_addr = spark.createDataFrame([(1, "x lane", "Pune", "MH", 1), (2, "x lane", "Pune", "MH", 1),
                                      (3, "y road", None, "MH", 2)], schemas.DIM_ADDRESS)
    dim_cust = spark.createDataFrame([(1, "ann", 1, dt.date(2021, 1, 1), dt.date(9999, 12, 31))],
                                     schemas.DIM_CUSTOMER)
    d = cust(spark, [(1, "ann", "x lane", "Pune", "MH", 1, T(2022, 1, 1)),
                     (2, "bob", "y road", None, "MH", 2, T(2022, 1, 2)),
                     (3, "cat", "z way", "Agra", "UP", 3, T(2022, 1, 3)),
                     (4, "dan", "z way", "Agra", "UP", 3, T(2022, 1, 4)),
                     (5, "eve", None, None, None, None, T(2022, 1, 5))])
    want_addr = dims.address_delta(d, dim_addr, dedupe="natural_key")
    want_ins, want_upd = dims.customer_delta(d, dim_cust, dim_addr.unionByName(want_addr))
    matched = dims.match_addresses(d, dim_addr)
    got_addr = dims.new_addresses(matched, 3)
    got_ins, got_upd = dims.customers_from_matches(matched, got_addr, dim_cust)
    assert rows(got_addr, "address_id") == rows(want_addr, "address_id") == [
        (4, "z way", "Agra", "UP", 3), (5, None, None, None, None)]
    assert rows(got_ins, "customerid", "address_id") == rows(want_ins, "customerid", "address_id")
    assert rows(got_upd, "customerid", "address_id") == rows(want_upd, "customerid", "address_id")
    assert [r[2] for r in rows(got_upd, "customerid", "address_id")] == [1, 2]


def test_preaggregated_questions_equal_row_level_joins(spark):
    """q01/q09/q10 aggregate the fact per customer before the dimension join;
    with a customer holding most orders and another present in two versions
    (the join repeats its orders) the results equal the row-level form."""
    from pyspark.sql import functions as F
    from ordermart.functions import timeparts as tp
    addr = spark.createDataFrame([(1, "a", "Pune", "MH", 1), (2, "b", "Agra", "UP", 2)],
                                 schemas.DIM_ADDRESS)
    dc = spark.createDataFrame([
        (1, "ann", 1, dt.date(2022, 1, 1), dt.date(9999, 12, 31)),
        (2, "bob", 1, dt.date(2022, 1, 1), dt.date(2022, 3, 1)),
        (2, "bob", 2, dt.date(2022, 3, 1), dt.date(9999, 12, 31)),
        (3, "cy", 9, dt.date(2022, 1, 1), dt.date(9999, 12, 31))], schemas.DIM_CUSTOMER)
    facts_rows = [(1, i, T(2022, 1, 1 + i % 28, i % 24), T(2022, 1, 2 + i % 27, 5), 411001,
                   i * 7, i % 5, 3600 + i) for i in range(60)]
    facts_rows += [(2, 100 + i, T(2022, 2, 1 + i, 8), None, 282001, 10, 2, 0) for i in range(5)]
    facts_rows += [(3, 200, T(2022, 2, 9, 8), T(2022, 2, 10, 8), 0, 1, 1, 86400),
                   (4, 300, T(2022, 2, 9, 9), None, 0, 4, 4, 0)]
    star = StarSchema(addr, dc, schemas.empty(spark, schemas.DIM_PRODUCT),
                      schemas.empty(spark, schemas.DIM_ORDER),
                      schemas.empty(spark, schemas.F_ORDER_DETAILS),
                      spark.createDataFrame(facts_rows, schemas.FACT_DAILY_ORDERS))
    geo = dc.join(addr, "address_id", "left").select("customerid", "state", "city")
    left = star.fact_daily_orders.join(geo, "customerid", "left")
    inner = star.fact_daily_orders.join(geo.where("state IS NOT NULL"), "customerid")
    for grain, (name, expr) in analytics.FACT_GRAINS.items():
        want = rows(left.groupBy(expr().alias(name)).agg(F.avg("item_count").alias("avg_items")), name)
        assert rows(analytics.q01_avg_items(star, grain), name) == want, grain
    ts = "order_delivery_timestamp"
    keys = [tp.date_of(ts).alias("DATES"), tp.week_sunday(ts).alias("WEEKS"),
            tp.day_of_week(ts).alias("WEEKDAYS"), tp.month_of_year(ts).alias("MONTHS"),
            F.col("city").alias("City")]
    m = "order_delivery_time_seconds"
    want9 = inner.groupBy(*keys).agg(F.min(m).alias("MinDeliveryTime"), F.max(m).alias("MaxDeliveryTime"),
                                     F.avg(m).alias("AvgDeliveryTime"))
    order = ["DATES", "City"]
    assert rows(analytics.q09_delivery_time(star), *order) == rows(want9, *order)
    want10 = inner.groupBy(*keys).agg(F.count("orderid").alias("NumberOfOrders"))
    assert rows(analytics.q10_orders_sliced(star), *order) == rows(want10, *order)


def test_scd2_versions_across_batches(spark, tmp_root):
    """Batch 1 loads two products; batch 2 sees a new rate for one and a new
    product: version 2 closes the old row, opens the new one, adds the insert.
    A rerun of the apply rewrites only its own version."""
    ev = [(100, 1, T(2022, 3, 1, 10), "Received")]
    r1 = pipeline.run_batch(spark, sources(spark, CUSTOMERS, PRODUCTS, ev, []), tmp_root, T(2022, 3, 2))
    pipeline.apply_scd2(spark, tmp_root, r1.batch_id)
    p2 = [(10, "A10", "rice", "5KG", 120, True), PRODUCTS[1], (12, "C12", "bags", "1KG", 5, True)]
    r2 = pipeline.run_batch(spark, sources(spark, CUSTOMERS, p2, ev, []), tmp_root, T(2022, 3, 9))
    assert r2.staged["dim_product"] == 1
    for _ in range(2):
        pipeline.apply_scd2(spark, tmp_root, r2.batch_id)
    cur = rows(pipeline.scd2_current(spark, tmp_root, "dim_product"), "productid", "start_date")
    open_end = dt.date(9999, 12, 31)
    assert cur == [
        (10, "A10", "rice", "5KG", 100, True, dt.date(2022, 3, 2), dt.date(2022, 3, 9)),
        (10, "A10", "rice", "5KG", 120, True, dt.date(2022, 3, 9), open_end),
        (11, "B11", "ata", "2KG", 50, False, dt.date(2022, 3, 2), open_end),
        (12, "C12", "bags", "1KG", 5, True, dt.date(2022, 3, 9), open_end)]
    assert pipeline.scd2_current(spark, tmp_root, "dim_customer").count() == 2


def test_scd2_change_unchanged_change_back(spark, tmp_root):
    """Four batches: first load, a new rate, the same rate again, the first rate
    again: three versions, without gap or overlap; a customer whose name changes
    gets a second version."""
    ev = [(100, 1, T(2022, 3, 1, 10), "Received")]
    for day, rate in ((2, 100), (9, 120), (16, 120), (23, 100)):
        products = [(10, "A10", "rice", "5KG", rate, True), PRODUCTS[1]]
        names = [(1, "renamed" if day == 23 else CUSTOMERS[0][1], *CUSTOMERS[0][2:6], T(2022, 3, day)), *CUSTOMERS[1:]]
        r = pipeline.run_batch(spark, sources(spark, names, products, ev, []), tmp_root, T(2022, 3, day), scd2=True)
        assert r.batch_id in pipeline._versions(spark, tmp_root, "dim_product")
    open_end = dt.date(9999, 12, 31)
    day = lambda d: dt.date(2022, 3, d)
    cur = pipeline.scd2_current(spark, tmp_root, "dim_product")
    got = [(r.rate, r.start_date, r.end_date) for r in cur.where("productid = 10").orderBy("start_date").collect()]
    assert got == [(100, day(2), day(9)), (120, day(9), day(23)), (100, day(23), open_end)]
    assert cur.where("productid = 11").count() == 1
    people = pipeline.scd2_current(spark, tmp_root, "dim_customer").where("customerid = 1").orderBy("start_date").collect()
    assert [r.name for r in people] == [CUSTOMERS[0][1], "renamed"] and people[0].end_date == people[1].start_date == day(23)
    for name, key in pipeline.SCD2_KEYS.items():
        checks = dims.scd2_checks(pipeline.scd2_current(spark, tmp_root, name), key).collect()
        assert [r.violations for r in checks] == [0, 0, 0]


def test_scd2_checks_find_faults(spark):
    rows_ = [(1, "2022-01-01", "9999-12-31"), (1, "2022-02-01", "9999-12-31"), (2, "2022-01-01", "2021-01-01")]
    df = spark.createDataFrame(rows_, "k int, s string, e string").selectExpr("k", "date(s) start_date", "date(e) end_date")
    assert {r.check_name: r.violations for r in dims.scd2_checks(df, "k").collect()} == {
        "one_open_row": 1, "no_overlap": 1, "ends_after_start": 1}


def test_failed_load_then_failed_stage_loads_each_event_once(spark, tmp_root):
    """Load fails half way, the retry fails in staging, the third run succeeds:
    the unfinished id is used again, so no event is there twice."""
    import pytest
    ev = [(100, 1, T(2022, 3, 1, 10), "Received"), (101, 2, T(2022, 3, 1, 11), "Received")]
    src = sources(spark, CUSTOMERS, PRODUCTS, ev, [])
    for place, name in ((sinks, "load_target"), (sinks, "write_stage")):
        orig = getattr(place, name)

        def flaky(*a, orig=orig, name=name):
            if "fact_daily_orders" in a:
                raise RuntimeError("executor lost")
            return orig(*a)

        setattr(place, name, flaky)
        try:
            with pytest.raises(RuntimeError):
                pipeline.run_batch(spark, src, tmp_root, T(2022, 3, 2))
        finally:
            setattr(place, name, orig)
        assert pipeline.warehouse(spark, tmp_root).dim_order.count() == 0
    assert pipeline.run_batch(spark, src, tmp_root, T(2022, 3, 3)).batch_id == 1
    wh = pipeline.warehouse(spark, tmp_root)
    assert sorted(r.orderid for r in wh.dim_order.collect()) == [100, 101] and wh.fact_daily_orders.count() == 2


def test_paths_of_any_form_and_an_unreadable_log(spark, tmp_root):
    import pytest
    ev = [(100, 1, T(2022, 3, 1, 10), "Received")]
    pipeline.run_batch(spark, sources(spark, CUSTOMERS, PRODUCTS, ev, []), f"file:{tmp_root}", T(2022, 3, 2))
    for form in (tmp_root, f"file:{tmp_root}", f"file://{tmp_root}"):
        assert pipeline.warehouse(spark, form).fact_daily_orders.count() == 1
    import os
    log = sinks.log_path(tmp_root)
    for f in os.listdir(log):
        if f.endswith(".parquet"):
            with open(os.path.join(log, f), "wb") as out:
                out.write(b"not parquet")
            crc = os.path.join(log, f".{f}.crc")
            if os.path.exists(crc):
                os.remove(crc)
    with pytest.raises(Exception):  # noqa: B017
        control.high_water_mark(spark, log, "stg_dim_order")
    with pytest.raises(Exception):  # noqa: B017
        pipeline.warehouse(spark, tmp_root).fact_daily_orders.count()


def test_seconds_between_ignores_session_time_zone(spark):
    from ordermart.functions import timeparts as tp
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame([(T(2001, 4, 1, 1, 59, 59, 500000), T(2001, 4, 1, 11, 42, 11)),
                                    (T(2001, 10, 28, 0, 30), T(2001, 10, 28, 3, 30)),
                                    (T(2001, 1, 1), None)],
                                   "a timestamp_ntz, b timestamp_ntz")
        got = [r[0] for r in df.select(tp.seconds_between("a", "b")).collect()]
        assert got == [34931, 3 * 3600, None]
        shifted = df.select(tp.add_seconds("a", F.lit(3600)).alias("x")).collect()[0].x
        assert shifted == T(2001, 4, 1, 2, 59, 59, 500000)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_failed_load_keeps_marks_and_rerun_loses_nothing(spark, tmp_root):
    """A batch whose target load fails logs nothing Completed; the rerun
    extracts the same rows again and replaces its own batch directories."""
    ev = [(100, 1, T(2022, 3, 1, 10), "Received"), (101, 2, T(2022, 3, 1, 11), "Received")]
    src = sources(spark, CUSTOMERS, PRODUCTS, ev, [])
    orig = sinks.load_target
    calls = {"n": 0}

    def flaky(spark_, root_, name, *rest):
        calls["n"] += 1
        if name == "fact_daily_orders":
            raise RuntimeError("executor lost")
        return orig(spark_, root_, name, *rest)

    sinks.load_target = flaky
    try:
        import pytest
        with pytest.raises(RuntimeError):
            pipeline.run_batch(spark, src, tmp_root, T(2022, 3, 2))
    finally:
        sinks.load_target = orig
    assert control.high_water_mark(spark, sinks.log_path(tmp_root), "stg_dim_order") == "1900-01-01 00:00:00"
    r = pipeline.run_batch(spark, src, tmp_root, T(2022, 3, 2))
    assert r.batch_id == 1
    wh = pipeline.warehouse(spark, tmp_root)
    assert wh.fact_daily_orders.count() == 2 and wh.dim_order.count() == 2
    assert control.high_water_mark(spark, sinks.log_path(tmp_root), "stg_dim_order") == "2022-03-02 00:00:00"


def test_rerun_of_a_logged_batch_is_idempotent(spark, tmp_root):
    """Rerunning batch 1 after it was fully logged (e.g. a micro-batch
    re-executed after a crash) reads the marks from before batch 1, so it
    extracts and writes exactly the same rows again."""
    ev = [(100, 1, T(2022, 3, 1, 10), "Received"), (100, 1, T(2022, 3, 1, 12), "InProgress")]
    src = sources(spark, CUSTOMERS, PRODUCTS, ev, [(100, 10, 3)])
    r1 = pipeline.run_batch(spark, src, tmp_root, T(2022, 3, 2))
    again = pipeline.run_batch(spark, src, tmp_root, T(2022, 3, 2), batch_id=r1.batch_id)
    assert again.staged == r1.staged and again.marks == r1.marks
    wh = pipeline.warehouse(spark, tmp_root)
    assert wh.dim_order.count() == 2 and wh.fact_daily_orders.count() == 1
    assert wh.f_order_details.count() == 1 and wh.dim_customer.count() == 2
    # the next new batch starts after batch 1's marks
    r2 = pipeline.run_batch(spark, src, tmp_root, T(2022, 3, 3))
    assert r2.batch_id == 2 and r2.staged["dim_order"] == 0
