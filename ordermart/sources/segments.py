"""Compaction of a target's batch folders into segments.

Every load leaves a folder per batch and storage key, so a table of many small batches
is a table of many small files. ``compact`` merges the folders of one level, once there
are ``fanout`` of them, into one segment of the next level: a row is rewritten once a
level, and n batches are read from at most (fanout - 1) * levels folders.

A pointer lists the segments and the batches each holds: one small file a version,
created only if absent. Readers resolve it once, with their plan, so they see the same
rows before, during and after a compaction; of two writers of one version the second
finds the file and starts again. Only completed batches are merged. A batch that is
loaded again is taken out of the segments (``forget``) and read from its own folder.
``vacuum`` deletes what the latest pointers no longer name.
"""

from __future__ import annotations

import json
import os
import uuid
from dataclasses import asdict, dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import control, schemas, sinks, storage

FANOUT = 8


@dataclass(frozen=True)
class Segment:
    """A folder with the rows of some batches; level 0: a batch's own folder."""

    path: str
    level: int
    batches: tuple[int, ...]
    whole: bool = True  # False: it also holds rows of batches that were forgotten


def _pointers(root: str, name: str) -> str:
    return os.path.join(root, sinks.CONTROL_DIR, "segments", name)


def _read_pointer(spark: SparkSession, path: str) -> list[Segment] | None:
    """Segments of a pointer; None while it is being written (or was left half written)."""
    try:
        rows = json.loads(storage.read_text(spark, path))
    except json.JSONDecodeError:
        return None
    return [Segment(r["path"], r["level"], tuple(r["batches"]), r["whole"]) for r in rows]


def current(spark: SparkSession, root: str, name: str) -> tuple[int, list[Segment]]:
    """(number of the last pointer, 0 for none; segments of the last complete one)."""
    base = _pointers(root, name)
    numbers = [int(n) for n in storage.children(spark, base)]
    for n in reversed(numbers):
        found = _read_pointer(spark, f"{base}/{n:09d}")
        if found is not None:
            return numbers[-1], found
    return max(numbers, default=0), []


def _publish(spark: SparkSession, root: str, name: str, version: int, segments: list[Segment]) -> bool:
    text = json.dumps([asdict(s) for s in segments])
    return storage.create_new(spark, f"{_pointers(root, name)}/{version:09d}", text)


def forget(spark: SparkSession, root: str, name: str, batch_id: int) -> None:
    """Takes a batch out of the segments. The pointer moves on even if none holds it, so a
    compaction that has read the batch's folder can't publish what it read."""
    while True:
        version, segments = current(spark, root, name)
        left = [replace(s, batches=tuple(b for b in s.batches if b != batch_id), whole=s.whole and batch_id not in s.batches) for s in segments]
        if _publish(spark, root, name, version + 1, [s for s in left if s.batches]):
            return


def layout(spark: SparkSession, root: str, name: str, batches: list[int]) -> tuple[int, list[Segment]]:
    """(pointer number, folders that hold the given batches): segments, and the own
    folders of the batches that are in none."""
    version, segments = current(spark, root, name)
    wanted, held = set(batches), {b for s in segments for b in s.batches}
    base = sinks.target_path(root, name)
    own = {int(d.split("=", 1)[1]) for d in storage.children(spark, base) if d.startswith("batch_id=")}
    loose = [Segment(os.path.join(base, f"batch_id={b}"), 0, (b,)) for b in sorted(own & wanted - held)]
    kept = [replace(s, path=os.path.join(root, s.path), batches=tuple(b for b in s.batches if b in wanted), whole=s.whole and wanted.issuperset(s.batches))
            for s in segments]
    return version, [s for s in kept if s.batches] + loose


def read(spark: SparkSession, root: str, name: str, folders: list[Segment]) -> DataFrame | None:
    """Rows of the folders with batch_id and the storage column; None if there is no folder."""
    schema, parts = schemas.TARGETS[name].schema, sinks.partition_fields(name)
    order = [f.name for f in (*schema.fields, *parts)]
    frames = []
    own = [s.path for s in folders if s.level == 0]
    if own:
        whole = T.StructType([*schema.fields, *parts])
        frames.append(spark.read.schema(whole).option("basePath", sinks.target_path(root, name)).parquet(*own).select(order))
    for s in folders:
        if s.level:
            rows = spark.read.schema(T.StructType([*schema.fields, *parts])).option("basePath", s.path).parquet(s.path).select(order)
            frames.append(rows if s.whole else rows.where(F.col("batch_id").isin(list(s.batches))))
    return reduce(DataFrame.unionByName, frames) if frames else None


def compact(spark: SparkSession, root: str, name: str, fanout: int = FANOUT) -> int:
    """Merges until every level has fewer than ``fanout`` folders; returns the number of merges."""
    if fanout < 2:
        raise ValueError("a merge takes two folders or more")
    merges = 0
    while True:
        done = control.completed_ids(spark, sinks.log_path(root))
        version, folders = layout(spark, root, name, done)
        by_level: dict[int, list[Segment]] = {}
        for s in folders:
            by_level.setdefault(s.level, []).append(s)
        full = [level for level, found in sorted(by_level.items()) if len(found) >= fanout]
        if not full:
            return merges
        chosen = by_level[full[0]]
        path = os.path.join("segments", name, f"level-{full[0] + 1}-{uuid.uuid4().hex[:12]}")
        sinks.write_declared(read(spark, root, name, chosen), name, os.path.join(root, path), with_batch=True)
        merged = Segment(path, full[0] + 1, tuple(sorted(b for s in chosen for b in s.batches)))
        rest = [replace(s, path=os.path.relpath(s.path, root)) for s in folders if s.level and s not in chosen]
        if _publish(spark, root, name, version + 1, [*rest, merged]):
            merges += 1
        else:
            storage.delete(spark, os.path.join(root, path))


def vacuum(spark: SparkSession, root: str, name: str, keep: int = 1) -> list[str]:
    """Deletes batch folders and segments that neither the last pointer nor the ``keep``
    before it read; returns their paths. Plans made under an older pointer fail afterwards."""
    base = _pointers(root, name)
    numbers = [int(n) for n in storage.children(spark, base)]
    kept, old = numbers[-keep - 1:], numbers[:-keep - 1]
    named = [found for n in kept if (found := _read_pointer(spark, f"{base}/{n:09d}")) is not None]
    if len(named) < keep + 1:
        return []
    gone = []
    for b in set.intersection(*({b for s in found for b in s.batches} for found in named)):
        own = os.path.join(sinks.target_path(root, name), f"batch_id={b}")
        if storage.exists(spark, own):
            gone.append(own)
    needed = {s.path for found in named for s in found}
    for n in old:
        unused = {s.path for s in _read_pointer(spark, f"{base}/{n:09d}") or []} - needed
        gone += [p for s in sorted(unused) if storage.exists(spark, p := os.path.join(root, s)) and p not in gone]
    for path in [*gone, *(f"{base}/{n:09d}" for n in old)]:
        storage.delete(spark, path)
    return gone
