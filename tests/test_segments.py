"""Compaction: the same rows before, during and after it, few folders, batches loaded again."""

import datetime as dt
import os
from unittest import mock

from ordermart.sources import control, schemas, segments, sinks, storage

NAME, AT = "dim_order", dt.datetime(2022, 1, 1)


def load(spark, root, batch, rows, complete=True):
    again = batch in control.completed_ids(spark, sinks.log_path(root))
    sinks.write_stage(spark, spark.createDataFrame(rows, schemas.DIM_ORDER), root, NAME, batch)
    sinks.load_target(spark, root, NAME, batch, again)
    if complete and not again:
        control.append_log(spark, sinks.log_path(root), batch, "stg_" + NAME, len(rows), control.COMPLETED, AT)


def batch_rows(batch):
    """Two months, one row without a time; every fifth batch is empty."""
    if batch % 5 == 0:
        return []
    return [(batch * 10, dt.datetime(2022, 1 + batch % 2, 3, batch % 24), "Received"), (batch * 10 + 1, dt.datetime(2022, 3, 1), "Delivered"),
            (batch * 10 + 2, None, "Received")]


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def read(spark, root, **kw):
    return sinks.read_target(spark, root, NAME, **kw)


def test_twenty_batches(spark, tmp_root):
    for batch in range(1, 21):
        load(spark, tmp_root, batch, batch_rows(batch))
    load(spark, tmp_root, 21, [(999, AT, "Received")], complete=False)
    want = sorted((r for b in range(1, 21) for r in batch_rows(b)), key=repr)
    before = read(spark, tmp_root)
    assert rows(before) == want
    assert segments.compact(spark, tmp_root, NAME, fanout=4) == 1  # every loose folder at once
    assert segments.compact(spark, tmp_root, NAME, fanout=4) == 0
    assert rows(before) == rows(read(spark, tmp_root)) == want
    for batch in range(22, 32):
        load(spark, tmp_root, batch, batch_rows(batch))
        want = sorted(want + batch_rows(batch), key=repr)
        segments.compact(spark, tmp_root, NAME, fanout=2)
        assert rows(read(spark, tmp_root)) == want
    done = control.completed_ids(spark, sinks.log_path(tmp_root))
    _, folders = segments.layout(spark, tmp_root, NAME, done)
    assert len(folders) <= 5 and sorted(b for s in folders for b in s.batches) == done
    assert len({os.path.dirname(f) for f in read(spark, tmp_root).inputFiles()}) <= 4 * len(folders)
    planned = read(spark, tmp_root)
    gone = segments.vacuum(spark, tmp_root, NAME)
    assert gone and rows(planned) == rows(read(spark, tmp_root)) == want
    assert rows(read(spark, tmp_root, except_batch=3)) == [r for r in want if r not in batch_rows(3)]
    assert storage.exists(spark, os.path.join(sinks.target_path(tmp_root, NAME), "batch_id=21"))  # not completed: left alone


def test_a_merged_batch_is_loaded_again(spark, tmp_root):
    for batch in (1, 2, 3):
        load(spark, tmp_root, batch, batch_rows(batch))
    segments.compact(spark, tmp_root, NAME, fanout=3)
    load(spark, tmp_root, 2, [(7, AT, "Received")])
    want = sorted(batch_rows(1) + batch_rows(3) + [(7, AT, "Received")], key=repr)
    assert rows(read(spark, tmp_root)) == want
    load(spark, tmp_root, 4, batch_rows(4))
    segments.compact(spark, tmp_root, NAME, fanout=2)
    segments.vacuum(spark, tmp_root, NAME, keep=0)
    assert rows(read(spark, tmp_root)) == sorted(want + batch_rows(4), key=repr)


def test_a_batch_loaded_while_it_is_merged(spark, tmp_root):
    """What a compaction read before the batch was loaded again is not published."""
    for batch in (1, 2):
        load(spark, tmp_root, batch, batch_rows(batch))
    write, calls = sinks.write_declared, []

    def slow(*args, **kw):
        write(*args, **kw)
        if kw.get("with_batch") and not calls:
            calls.append(1)
            load(spark, tmp_root, 2, [(7, AT, "Received")])

    with mock.patch.object(sinks, "write_declared", slow):
        assert segments.compact(spark, tmp_root, NAME, fanout=2) == 1
    assert rows(read(spark, tmp_root)) == sorted(batch_rows(1) + [(7, AT, "Received")], key=repr)


def test_a_half_written_pointer_is_passed_over(spark, tmp_root):
    for batch in (1, 2):
        load(spark, tmp_root, batch, batch_rows(batch))
    segments.compact(spark, tmp_root, NAME, fanout=2)
    storage.create_new(spark, os.path.join(segments._pointers(tmp_root, NAME), "000000002"), '[{"path')
    want = sorted(batch_rows(1) + batch_rows(2), key=repr)
    assert rows(read(spark, tmp_root)) == want
    load(spark, tmp_root, 3, batch_rows(3))
    load(spark, tmp_root, 4, batch_rows(4))
    assert segments.compact(spark, tmp_root, NAME, fanout=2) == 2
    assert rows(read(spark, tmp_root)) == sorted(want + batch_rows(3) + batch_rows(4), key=repr)
