"""Dimension deltas against brute-force restatements on random small inputs,
including null address parts (nulls match nulls) and shared addresses."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ordermart.operators import dims
from ordermart.sources import schemas

BASE = dt.datetime(2022, 1, 1)
OPEN = dt.date(9999, 12, 31)
maybe = lambda s: st.one_of(st.none(), s)


@st.composite
def customers_case(draw):
    addr = st.tuples(maybe(st.sampled_from(["a", "b"])), maybe(st.sampled_from(["Pune", "Agra"])),
                     st.just("S"), maybe(st.integers(1, 2)))
    ids = sorted(draw(st.sets(st.integers(1, 9), min_size=1, max_size=6)))
    delta = [(i, f"n{i}", *draw(addr), BASE + dt.timedelta(days=draw(st.integers(0, 30)))) for i in ids]
    old_addr = [(k + 1, *draw(addr)) for k in range(draw(st.integers(0, 4)))]
    old_cust = sorted(draw(st.sets(st.integers(1, 9), max_size=5)))
    return delta, old_addr, old_cust


def brute_customers(delta, old_addr, old_cust, mode):
    start = max([a[0] for a in old_addr], default=0)
    key = lambda r: (r[2], r[3], r[4], r[5])
    if mode == "row":
        new = [(start + k + 1, *key(r)) for k, r in enumerate(sorted(delta))]
        new = [a for a in new if a not in old_addr]
    else:
        known = {a[1:] for a in old_addr}
        firsts = {}
        for r in sorted(delta):
            if key(r) not in known and key(r) not in firsts:
                firsts[key(r)] = r[0]
        new = [(start + k + 1, *t) for k, (t, _) in enumerate(sorted(firsts.items(), key=lambda x: x[1]))]
    lookup = old_addr + new
    rows = []
    for r in delta:
        hits = [a[0] for a in lookup if a[1:] == key(r)] or [None]
        rows += [(r[0], r[1], h, r[6].date(), OPEN) for h in hits]
    ins = sorted((r for r in rows if r[0] not in old_cust), key=repr)
    upd = sorted((r for r in rows if r[0] in old_cust), key=repr)
    return sorted(new, key=repr), ins, upd


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(customers_case(), st.sampled_from(["row", "natural_key"]))
def test_address_and_customer_deltas(spark, case, mode):
    delta, old_addr, old_cust = case
    d = spark.createDataFrame(delta, schemas.CUSTOMER_MASTER)
    oa = spark.createDataFrame(old_addr, schemas.DIM_ADDRESS)
    oc = spark.createDataFrame([(c, "x", None, None, None) for c in old_cust], schemas.DIM_CUSTOMER)
    new = dims.address_delta(d, oa, dedupe=mode)
    ins, upd = dims.customer_delta(d, oc, oa.unionByName(new))
    want_new, want_ins, want_upd = brute_customers(delta, old_addr, old_cust, mode)
    assert sorted((tuple(r) for r in new.collect()), key=repr) == want_new
    assert sorted((tuple(r) for r in ins.collect()), key=repr) == want_ins
    assert sorted((tuple(r) for r in upd.collect()), key=repr) == want_upd


@st.composite
def products_case(draw):
    row = lambda pid: (pid, draw(st.sampled_from(["A", "B"])), draw(maybe(st.just("rice"))),
                       "1KG", draw(maybe(st.integers(1, 3))), draw(maybe(st.booleans())))
    snap = [row(p) for p in sorted(draw(st.sets(st.integers(1, 6), max_size=5)))]
    dim = [row(p) + (dt.date(2021, 1, 1), OPEN) for p in sorted(draw(st.sets(st.integers(1, 6), max_size=5)))]
    return snap, dim


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(products_case())
def test_product_delta(spark, case):
    snap, dim = case
    s = spark.createDataFrame(snap, schemas.PRODUCT_MASTER)
    d = spark.createDataFrame(dim, schemas.DIM_PRODUCT)
    ins, upd = dims.product_delta(s, d, "2022-06-01")
    tuples = {r[:6] for r in dim}
    known = {r[0] for r in dim}
    changes = [r for r in snap if r not in tuples]
    run = dt.date(2022, 6, 1)
    want_ins = sorted((r + (run, OPEN) for r in changes if r[0] not in known), key=repr)
    want_upd = sorted((r + (run,) for r in changes if r[0] in known), key=repr)
    assert sorted((tuple(r) for r in ins.collect()), key=repr) == want_ins
    assert sorted((tuple(r) for r in upd.collect()), key=repr) == want_upd
