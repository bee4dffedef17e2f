"""Every registered query against its DuckDB oracle SQL (the driver's gate)."""

import os

import duckdb
import pytest

import __spark_entry__ as se
from ordermart.plans import catalog, oracle
from tools.oracle_check import TABLES, canon

from .conftest import SF_ORACLE, SF_SMALL

NAMES = sorted(catalog.all_queries())


def _connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


@pytest.fixture(scope="module")
def duck():
    return _connect(SF_SMALL)


@pytest.fixture(scope="module")
def duck_larger():
    return _connect(SF_ORACLE)


def test_every_query_has_oracle():
    assert set(oracle.all_sql()) == set(catalog.all_queries())
    assert set(catalog.all_queries()) <= set(se.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, duck_larger, name):
    """At sf0.001 no customer changed after the customer mark, so what depends on
    changed customers runs at sf0.01; no comparison is of empty with empty."""
    larger = any(x in name for x in ("customer", "address", "scd2"))
    got = catalog.all_queries()[name](spark, SF_ORACLE if larger else SF_SMALL).toPandas()
    want = (duck_larger if larger else duck).execute(se.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(want) > 0
    assert len(got) == len(want)
    assert canon(got) == canon(want)


def test_entry_smoke(spark):
    df = se.entry(spark)
    assert df.count() > 0
    assert df.columns == ["DATES", "WEEKS", "WEEKDAYS", "MONTHS", "City",
                          "MinDeliveryTime", "MaxDeliveryTime", "AvgDeliveryTime"]


TIME_DEPENDENT = [n for n in NAMES if n.startswith(("q03", "q04", "q06", "q08", "q09", "q10"))
                  or n in ("etl_fact_daily_orders", "etl_f_order_details", "etl_dim_order",
                           "extract_orders_since", "extract_customers_since")]


@pytest.mark.parametrize("name", TIME_DEPENDENT)
def test_query_matches_oracle_in_a_dst_time_zone(spark, duck, name):
    """Zone-less timestamps: the session time zone must not change results."""
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = catalog.all_queries()[name](spark, SF_SMALL).toPandas()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    want = duck.execute(se.oracle_sql()[name]).df()
    assert canon(got) == canon(want)
