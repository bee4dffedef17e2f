"""Versions by key bucket: what a batch rewrites, reads and leaves; reruns, failures, vacuum."""

import datetime as dt
import os
from unittest import mock

import pytest

from ordermart.operators import dims
from ordermart.plans import pipeline
from ordermart.sources import control, schemas, sinks, storage, versions

NAME, KEY = "dim_product", "productid"
FIRST, OPEN_END = dt.date(2022, 1, 1), dt.date(9999, 12, 31)


def product(key, rate=5):
    return key, f"C{key}", "rice", "5KG", rate, True


def stage(spark, root, batch, inserts=(), updates=(), day=FIRST):
    """A batch's staged product rows; nothing for customers."""
    none = {"dim_customer": schemas.DIM_CUSTOMER, "dim_customer_updates": pipeline.UPDATES["dim_customer_updates"]}
    for name, schema in none.items():
        sinks.write_stage(spark, schemas.empty(spark, schema), root, name, batch, schema)
    rows = spark.createDataFrame([(*p, day, OPEN_END) for p in inserts], schemas.DIM_PRODUCT)
    sinks.write_stage(spark, rows, root, NAME, batch)
    schema = pipeline.UPDATES[f"{NAME}_updates"]
    sinks.write_stage(spark, spark.createDataFrame([(*p, day) for p in updates], schema), root, f"{NAME}_updates", batch, schema)


def complete(spark, root, batch):
    control.append_log(spark, sinks.log_path(root), batch, "stg_" + NAME, 1, control.COMPLETED, dt.datetime(2022, 1, 1))


def apply(spark, root, batch, done=True, buckets=None, **kw):
    stage(spark, root, batch, **kw)
    wrote = pipeline.apply_scd2(spark, root, batch, buckets)
    if done:
        complete(spark, root, batch)
    return wrote[NAME]


def current(spark, root):
    return sorted(map(tuple, pipeline.scd2_current(spark, root, NAME).collect()), key=repr)


def folders(spark, root, number, batch):
    return versions.layout(spark, root, NAME, (number, batch)).folders


def test_one_changed_key_rewrites_one_bucket(spark, tmp_root):
    assert apply(spark, tmp_root, 1, buckets=16, inserts=[product(k) for k in range(200)] + [product(None)]) == 201
    before = folders(spark, tmp_root, 1, 1)
    assert len(before) == 16
    wrote = apply(spark, tmp_root, 2, updates=[product(7, 6)], day=dt.date(2022, 2, 1))
    after = folders(spark, tmp_root, 2, 2)
    changed = {b for b in after if after[b] != before[b]}
    assert changed == set(versions.touched(spark.createDataFrame([(7,)], f"{KEY} long"), KEY, 16)) and len(changed) == 1
    assert wrote < 40  # the bucket, not the dimension
    written = [d for d in storage.children(spark, os.path.join(versions.base_path(tmp_root, NAME), os.path.dirname(after[min(changed)]))) if "=" in d]
    assert written == [f"p_bucket={min(changed)}"]
    rows = current(spark, tmp_root)
    assert len(rows) == 202
    assert [r for r in rows if r[0] == 7] == [(*product(7, 5), FIRST, dt.date(2022, 2, 1)), (*product(7, 6), dt.date(2022, 2, 1), OPEN_END)]
    assert all(r.violations == 0 for r in dims.scd2_checks(pipeline.scd2_current(spark, tmp_root, NAME), KEY).collect())


def test_only_touched_buckets_are_read(spark, tmp_root):
    apply(spark, tmp_root, 1, buckets=8, inserts=[product(k) for k in range(100)])
    asked = spark.createDataFrame([(3,), (3,)], f"{KEY} long")
    some = pipeline._scd2_before(spark, tmp_root, NAME, 2, asked)
    assert {os.path.basename(os.path.dirname(f)) for f in some.inputFiles()} == {f"p_bucket={versions.touched(asked, KEY, 8)[0]}"}
    assert some.where("productid = 3").count() == 1 and some.columns == schemas.DIM_PRODUCT.names
    assert pipeline._scd2_before(spark, tmp_root, NAME, 2, asked.where("false")).count() == 0
    apply(spark, tmp_root, 2)  # nothing changed: all folders stay
    assert folders(spark, tmp_root, 2, 2) == folders(spark, tmp_root, 1, 1)


def test_many_batches_equal_whole_rewrites(spark, tmp_root):
    want = spark.createDataFrame([], schemas.DIM_PRODUCT)
    for batch in range(1, 6):
        day = dt.date(2022, batch, 1)
        inserts, updates = [product(k) for k in range(batch * 10, batch * 10 + 10)], [product(k, 10 * batch) for k in range(10, batch * 10, 7)]
        apply(spark, tmp_root, batch, buckets=4 if batch < 4 else 6, inserts=inserts, updates=updates, day=day)
        new = spark.createDataFrame([(*p, day) for p in updates], pipeline.UPDATES[f"{NAME}_updates"]).withColumnRenamed("end_date", "start_date")
        whole = dims.scd2_apply(want, spark.createDataFrame([(*p, day, OPEN_END) for p in inserts], schemas.DIM_PRODUCT), new, KEY).collect()
        want = spark.createDataFrame(whole, schemas.DIM_PRODUCT)
        assert current(spark, tmp_root) == sorted(map(tuple, whole), key=repr)
    assert versions.layout(spark, tmp_root, NAME, (5, 5)).buckets == 6


def test_a_rerun_leaves_later_versions(spark, tmp_root):
    apply(spark, tmp_root, 1, buckets=4, inserts=[product(k) for k in range(20)])
    apply(spark, tmp_root, 2, updates=[product(1, 6)], day=dt.date(2022, 2, 1))
    planned, want = pipeline.scd2_current(spark, tmp_root, NAME), current(spark, tmp_root)
    first = folders(spark, tmp_root, 1, 1)
    apply(spark, tmp_root, 1, done=False, inserts=[product(k) for k in range(20)])
    assert set(folders(spark, tmp_root, 1, 1).values()).isdisjoint(first.values())
    assert sorted(map(tuple, planned.collect()), key=repr) == current(spark, tmp_root) == want


def test_failures_and_half_written_lists(spark, tmp_root):
    apply(spark, tmp_root, 1, buckets=4, inserts=[product(k) for k in range(20)])
    want = current(spark, tmp_root)
    with mock.patch.object(versions.storage, "create_new", side_effect=RuntimeError("lost")), pytest.raises(RuntimeError):
        apply(spark, tmp_root, 2, updates=[product(1, 6)])
    complete(spark, tmp_root, 2)  # even then: a version without a list is none
    assert current(spark, tmp_root) == want and versions.found(spark, tmp_root, NAME) == [(1, 1)]
    storage.create_new(spark, os.path.join(versions._version_path(tmp_root, NAME, (1, 1)), "000000002"), '{"buckets": 4, "fol')
    assert current(spark, tmp_root) == want
    apply(spark, tmp_root, 3, updates=[product(1, 6)], day=dt.date(2022, 2, 1))
    assert len(current(spark, tmp_root)) == 21
    apply(spark, tmp_root, 4, updates=[product(1, 7)], day=dt.date(2022, 3, 1))
    want = current(spark, tmp_root)
    gone = pipeline.vacuum_scd2(spark, tmp_root, keep=1)
    assert current(spark, tmp_root) == want and any("version=1.1" in p for p in gone)
    files = versions.base_path(tmp_root, NAME) + "/files"
    left = {os.path.join("files", a, b) for a in storage.children(spark, files) for b in storage.children(spark, os.path.join(files, a)) if "=" in b}
    assert left == set(folders(spark, tmp_root, 3, 4).values())
    assert pipeline.vacuum_scd2(spark, tmp_root, keep=1) == []


def test_versions_of_the_older_form(spark, tmp_root):
    """One folder with all rows, from before there were buckets: read, and rewritten by buckets once."""
    rows = spark.createDataFrame([(*product(k), FIRST, OPEN_END) for k in range(20)], schemas.DIM_PRODUCT)
    rows.write.parquet(os.path.join(versions.base_path(tmp_root, NAME), "version=1.1"))
    complete(spark, tmp_root, 1)
    assert len(current(spark, tmp_root)) == 20
    apply(spark, tmp_root, 2, updates=[product(1, 6)], day=dt.date(2022, 2, 1))
    assert len(current(spark, tmp_root)) == 21
    assert versions.layout(spark, tmp_root, NAME, (2, 2)).buckets == versions.BUCKETS
