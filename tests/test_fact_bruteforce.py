"""Order-line and order facts against a brute-force pandas restatement of the
batch semantics on random small inputs (keys respect the source primary keys)."""

import datetime as dt

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ordermart.operators import facts
from ordermart.sources import schemas

STATUSES = ["Received", "InProgress", "Delivered"]
BASE = dt.datetime(2022, 1, 1)


@st.composite
def batch(draw):
    events = []
    for oid in range(1, draw(st.integers(1, 6)) + 1):
        for status in draw(st.sets(st.sampled_from(STATUSES))):
            cust = draw(st.integers(1, 3))
            secs = draw(st.one_of(st.none(), st.integers(0, 5 * 86400)))
            ts = None if secs is None else BASE + dt.timedelta(seconds=secs)
            events.append((oid, cust, ts, status))
    items = [(oid, pid, draw(st.integers(1, 20)))
             for oid in range(1, 8) for pid in sorted(draw(st.sets(st.integers(1, 4), max_size=3)))]
    products = [(pid, f"c{pid}", f"p{pid}", "1KG", draw(st.one_of(st.none(), st.integers(1, 500))), True)
                for pid in range(1, 4)]
    customers = [(cid, f"n{cid}", "a", "c", "s", 400000 + cid, BASE) for cid in range(1, 3)]
    return events, items, products, customers


def brute_force(events, items, products, customers):
    ev = pd.DataFrame(events, columns=["orderid", "customerid", "ts", "order_status"])
    ev["ts"] = pd.to_datetime(ev["ts"])
    complete = ev.dropna()
    rec = complete[complete.order_status == "Received"][["customerid", "orderid", "ts"]]
    dlv = complete[complete.order_status == "Delivered"][["customerid", "orderid", "ts"]]
    lines = pd.DataFrame(items, columns=["orderid", "productid", "quantity"]).merge(
        dlv[["orderid", "ts"]], on="orderid", how="left")
    prod = pd.DataFrame(products, columns=["productid", "productcode", "productname", "sku", "rate", "isactive"])
    priced = lines.merge(prod[["productid", "rate"]], on="productid", how="left")
    priced["amount"] = priced.quantity * priced.rate
    totals = priced.groupby("orderid").agg(order_amount=("amount", "sum"), item_count=("quantity", "sum"))
    f = rec.merge(dlv, on=["customerid", "orderid"], how="left", suffixes=("_r", "_d"))
    f["secs"] = (pd.to_datetime(f.ts_d) - pd.to_datetime(f.ts_r)).dt.total_seconds()
    cust = pd.DataFrame(customers, columns=["customerid", "name", "address", "city", "state", "pincode", "u"])
    f = f.merge(cust[["customerid", "pincode"]], on="customerid", how="left")
    f = f.merge(totals, on="orderid", how="left")
    out = []
    for r in f.itertuples():
        def z(v):
            return 0 if pd.isna(v) else int(v)
        out.append((int(r.customerid), int(r.orderid), r.ts_r.to_pydatetime(),
                    None if pd.isna(r.ts_d) else r.ts_d.to_pydatetime(),
                    z(r.pincode), z(r.order_amount), z(r.item_count), z(r.secs)))
    line_rows = [(int(r.orderid), None if pd.isna(r.ts) else r.ts.to_pydatetime(), int(r.productid),
                  int(r.quantity)) for r in lines.itertuples()]
    return sorted(out), sorted(line_rows, key=repr)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(batch())
def test_facts_match_brute_force(spark, data):
    events, items, products, customers = data
    ev = spark.createDataFrame(events, schemas.ORDER_DETAILS)
    it = spark.createDataFrame(items, schemas.ORDER_ITEMS)
    pr = spark.createDataFrame(products, schemas.PRODUCT_MASTER)
    cu = spark.createDataFrame(customers, schemas.CUSTOMER_MASTER)
    lines = facts.order_lines(ev, it)
    got_fact = sorted(tuple(r) for r in facts.daily_orders(ev, cu, pr, lines).collect())
    got_lines = sorted((tuple(r) for r in lines.collect()), key=repr)
    want_fact, want_lines = brute_force(events, items, products, customers)
    assert got_lines == want_lines
    assert got_fact == want_fact
