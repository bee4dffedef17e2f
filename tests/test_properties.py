"""Properties of the batch over the driver's test tables."""

import datetime as dt

from pyspark.sql import functions as F

from ordermart.operators import facts
from ordermart.plans import pipeline
from ordermart.plans.warehouse import initial_load
from ordermart.sources import binding

from .conftest import SF_SMALL


def test_fact_grain_and_unit_totals(spark):
    star = initial_load(spark, SF_SMALL)
    f = star.fact_daily_orders
    assert f.groupBy("orderid").count().where("count > 1").count() == 0
    lines = star.f_order_details.groupBy("orderid").agg(F.sum("quantity").alias("q"))
    j = f.join(lines, "orderid")
    assert j.where(F.col("item_count") != F.col("q")).count() == 0
    # orders without lines have zero units and amount
    no_lines = f.join(lines, "orderid", "left_anti")
    assert no_lines.where("item_count <> 0 OR order_amount <> 0").count() == 0


def test_address_ids_dense_and_unique(spark):
    star = initial_load(spark, SF_SMALL)
    ids = sorted(r[0] for r in star.dim_address.select("address_id").collect())
    assert ids == list(range(1, len(ids) + 1))


def test_fact_unchanged_under_input_repartition(spark):
    src = binding.oltp_sources(spark, SF_SMALL)
    def fact(s):
        lines = facts.order_lines(s["order_details"], s["order_items"])
        return facts.daily_orders(s["order_details"], s["customer_master"], s["product_master"], lines)
    a = fact(src)
    shuffled = {k: v.repartition(7, F.rand(3)) for k, v in src.items()}
    b = fact(shuffled)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_rerun_from_same_marks_is_identical(spark, tmp_root):
    import tempfile
    src = binding.oltp_sources(spark, SF_SMALL)
    other = tempfile.mkdtemp(prefix="ordermart-test-")
    ts = dt.datetime(2002, 1, 1)
    pipeline.run_batch(spark, src, tmp_root, ts, batch_id=1)
    pipeline.run_batch(spark, src, other, ts, batch_id=1)
    wa, wb = pipeline.warehouse(spark, tmp_root), pipeline.warehouse(spark, other)
    for name, df in wa.tables().items():
        other_df = wb.tables()[name]
        assert df.exceptAll(other_df).count() == 0 and other_df.exceptAll(df).count() == 0, name
    # the star schema loaded by the batch equals the first-load plan
    star = initial_load(spark, SF_SMALL)
    for name in ("fact_daily_orders", "f_order_details", "dim_customer", "dim_address"):
        x, y = wa.tables()[name], star.tables()[name]
        assert x.exceptAll(y).count() == 0 and y.exceptAll(x).count() == 0, name


def test_keep_first_with_a_hot_key(spark):
    """A key holding a third of the rows: exact result, and duplicates are
    combined before the shuffle (partial aggregate below the exchange)."""
    from ordermart.operators.dedupe import first_per_key
    n = 30000
    df = spark.range(n).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 0 ELSE id END AS k", "id % 97 AS o", "id AS v")
    out = first_per_key(df, ["k"], ["o", "v"], ["v"])
    got = {r.k: r.v for r in out.collect()}
    assert got[0] == 0 and len(got) == 1 + (n - n // 3)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan
