"""Versions of a dimension stored by key hash bucket.

A version is a list of folders, one per bucket: a batch that changes a few keys writes the
buckets of these keys and names the earlier versions' folders for all others, so the cost
of a version follows its changes and not the dimension. Bucket folders are written once,
each attempt under a folder of its own, and never over; the list of an attempt is one small file,
created only if absent, after its folders are whole. The last complete list of a version counts.

    scd2/<dim>/files/<number>.<batch>-<attempt>/p_bucket=<b>/   rows
    scd2/<dim>/version=<number>.<batch>/<attempt number>        list of folders

The number of buckets is stored with the list; asking for another number rewrites every bucket once.
A list grows with the number of buckets, not with the rows.
"""

from __future__ import annotations

import json
import os
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import schemas, storage

SCD2_DIR, FILES, BUCKET = "scd2", "files", "p_bucket"
#: Buckets of a new dimension: at 64 MB a bucket, 1024 hold 64 GB.
BUCKETS = 64


@dataclass(frozen=True)
class Layout:
    """Folders of a version's buckets, below the dimension's folder; a bucket without rows has none."""

    buckets: int
    folders: dict[int, str]


def base_path(root: str, name: str) -> str:
    return os.path.join(root, SCD2_DIR, name)


def _version_path(root: str, name: str, version: tuple[int, int]) -> str:
    return os.path.join(base_path(root, name), f"version={version[0]}.{version[1]}")


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("bigint")


def _lists(spark: SparkSession, path: str) -> list[str]:
    return sorted(n for n in storage.children(spark, path) if n.isdigit())


def layout(spark: SparkSession, root: str, name: str, version: tuple[int, int]) -> Layout | None:
    """The last complete list of a version; None if it has none (it failed before)."""
    path = _version_path(root, name, version)
    for n in reversed(_lists(spark, path)):
        try:
            found = json.loads(storage.read_text(spark, os.path.join(path, n)))
        except json.JSONDecodeError:  # half written
            continue
        return Layout(found["buckets"], {int(b): p for b, p in found["folders"].items()})
    return None


def found(spark: SparkSession, root: str, name: str) -> list[tuple[int, int]]:
    """(number, batch) of the versions that have a list, or are whole folders of the older form."""
    out = []
    for d in storage.children(spark, base_path(root, name)):
        if d.startswith("version="):
            number, batch = map(int, d.split("=", 1)[1].split("."))
            if _whole(spark, root, name, (number, batch)) or layout(spark, root, name, (number, batch)):
                out.append((number, batch))
    return sorted(out)


def _whole(spark: SparkSession, root: str, name: str, version: tuple[int, int]) -> bool:
    """Is the version one folder with all rows (written before there were buckets)?"""
    return storage.exists(spark, os.path.join(_version_path(root, name, version), "_SUCCESS"))


def read(spark: SparkSession, root: str, name: str, version: tuple[int, int], only: list[int] | None = None) -> DataFrame:
    """Rows of a version; ``only``: of these buckets, the folders of all others are not listed."""
    schema = schemas.TARGETS[name].schema
    known = layout(spark, root, name, version)
    if known is None:
        return spark.read.schema(schema).parquet(_version_path(root, name, version))
    wanted = [p for b, p in sorted(known.folders.items()) if only is None or b in only]
    if not wanted:
        return schemas.empty(spark, schema)
    return spark.read.schema(schema).parquet(*(os.path.join(base_path(root, name), p) for p in wanted))


def touched(changes: DataFrame, key: str, buckets: int) -> list[int]:
    """Buckets that hold a key of ``changes``: at most ``buckets`` numbers."""
    return sorted(r[0] for r in changes.select(bucket_of(key, buckets).alias("b")).distinct().collect())


def write(spark: SparkSession, root: str, name: str, key: str, version: tuple[int, int], rows: DataFrame,
          kept: Layout | None, buckets: int) -> int:
    """Writes ``rows``, whole buckets, as the version's own; all other folders are those of ``kept``.
    Returns the number of rows written."""
    folder = os.path.join(FILES, f"{version[0]}.{version[1]}-{uuid.uuid4().hex[:12]}")
    path, schema = os.path.join(base_path(root, name), folder), schemas.TARGETS[name].schema
    schemas.conform(rows, schema).withColumn(BUCKET, bucket_of(key, buckets)).hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(path)
    own = {int(d.split("=", 1)[1]): os.path.join(folder, d) for d in storage.children(spark, path) if d.startswith(f"{BUCKET}=")}
    text = json.dumps({"buckets": buckets, "folders": {**(kept.folders if kept else {}), **own}})
    target = _version_path(root, name, version)
    attempt = 1
    while not storage.create_new(spark, os.path.join(target, f"{attempt:09d}"), text):
        attempt += 1
    return spark.read.schema(schema).parquet(path).count() if own else 0  # from the files' footers


def vacuum(spark: SparkSession, root: str, name: str, keep: list[tuple[int, int]]) -> list[str]:
    """Deletes the versions but those of ``keep`` and the bucket folders that these don't name.
    No batch may be writing a version meanwhile: its folders are in no list yet."""
    base = base_path(root, name)
    lists = [x for v in keep if (x := layout(spark, root, name, v)) is not None]
    named = {p for x in lists for p in x.folders.values()}
    gone = [_version_path(root, name, v) for v in found(spark, root, name) if v not in keep]
    for folder in storage.children(spark, os.path.join(base, FILES)):
        parts = [os.path.join(FILES, folder, b) for b in storage.children(spark, os.path.join(base, FILES, folder)) if b.startswith(f"{BUCKET}=")]
        unused = [p for p in parts if p not in named]
        gone += [os.path.join(base, p) for p in (unused if len(unused) < len(parts) else [os.path.join(FILES, folder)])]
    for path in gone:
        storage.delete(spark, path)
    return gone
