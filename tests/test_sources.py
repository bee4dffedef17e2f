"""Parquet source tables: bulk insert, purge, and the batch reading them with
pushed-down mark filters."""

import datetime as dt
import os
import re

from ordermart.plans import pipeline
from ordermart.sources import binding, extract, schemas, sinks

from .conftest import SF_SMALL


def test_batch_from_parquet_sources(spark, tmp_root):
    oltp = os.path.join(tmp_root, "oltp")
    for name, df in binding.oltp_sources(spark, SF_SMALL).items():
        sinks.append_oltp(df, os.path.join(oltp, name), getattr(schemas, extract.OLTP_TABLES[name]))
    src = extract.read_oltp(spark, oltp)
    counts = {n: df.count() for n, df in src.items()}
    assert counts["order_items"] > 0 and counts["order_details"] > counts["order_items"] / 4

    delta = extract.orders_since(src["order_details"], "1998-01-01 00:00:00").select("orderid")
    plan = delta._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(order_status_update_timestamp", plan)

    wh = os.path.join(tmp_root, "wh")
    r1 = pipeline.run_batch(spark, src, wh, dt.datetime(2002, 1, 1))
    assert r1.staged["fact_daily_orders"] == binding.read_table(spark, SF_SMALL, "orders").count()
    # nothing changed in the sources: the second batch extracts nothing new
    r2 = pipeline.run_batch(spark, src, wh, dt.datetime(2002, 1, 2))
    assert r2.batch_id == r1.batch_id + 1
    assert r2.staged["dim_order"] == 0 and r2.staged["fact_daily_orders"] == 0
    assert r2.staged["dim_product"] == 0 and r2.staged["dim_address"] == 0

    # purge keeps the schema and removes every row
    sinks.purge(spark, os.path.join(oltp, "order_items"), schemas.ORDER_ITEMS)
    assert extract.read_oltp(spark, oltp)["order_items"].count() == 0


def test_jdbc_delta_text_filters_in_the_source():
    """The text runs as it is on any SQL engine (here over the parquet tables)."""
    import duckdb
    import pytest

    assert extract.delta_query("customer_master", "1995-07-01 00:00:00") == (
        "(SELECT * FROM customer_master WHERE update_timestamp >= TIMESTAMP '1995-07-01 00:00:00') AS delta")
    con = duckdb.connect()
    con.execute("create table order_details as select * from (values (1, TIMESTAMP '2022-01-01', 'InProgress'), "
                "(2, TIMESTAMP '2021-01-01', 'InProgress'), (3, TIMESTAMP '2022-01-01', 'Received')) t(orderid, order_status_update_timestamp, order_status)")
    con.execute("create table order_items as select * from (values (1, 10), (2, 10), (3, 10)) t(orderid, productid)")
    assert con.execute("select orderid from " + extract.delta_query("order_items", "2022-01-01")).fetchall() == [(1,)]
    assert len(con.execute("select * from " + extract.delta_query("order_details", "2022-01-01")).fetchall()) == 2
    with pytest.raises(ValueError):
        extract.delta_query("order_details", "2022-01-01'; drop table x")


def test_cluster_settings_reach_a_session():
    from ordermart.session import cluster_conf

    conf = cluster_conf(1000)
    assert conf["spark.sql.shuffle.partitions"] == conf["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] == "4000"
    assert conf["spark.sql.files.maxPartitionBytes"] == conf["spark.sql.adaptive.advisoryPartitionSizeInBytes"] == "256m"


def test_one_scan_of_the_order_events_a_batch(spark, tmp_root):
    """The deltas are staged and read back: the source's events are read once."""
    seen = []
    orig = extract.orders_since
    extract.orders_since = lambda *a: (seen.append(1), orig(*a))[1]
    try:
        pipeline.run_batch(spark, binding.oltp_sources(spark, SF_SMALL), os.path.join(tmp_root, "wh"), dt.datetime(2002, 1, 1))
    finally:
        extract.orders_since = orig
    assert len(seen) == 1
    assert sinks.read_stage(spark, os.path.join(tmp_root, "wh"), "delta_orders", 1, schemas.ORDER_DETAILS).count() > 0
