"""Connected components by alternating large and small stars, two shuffles a round."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermart.llm.common import columns, discard, stored


def _groups(batches):
    """(a, b, open, first b of a's group, is the row its group's first) of rows sorted by a and b, without
    repeated pairs; a group may go on over several batches."""
    last = None
    for batch in columns(batches):
        a, b = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        open_ = batch.column(2).to_numpy(zero_copy_only=False)
        fresh = np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]))
        if last is not None:
            fresh[0] = (a[0], b[0]) != last[:2]
        begins = np.append(True, a[1:] != a[:-1])
        first = b[np.maximum.accumulate(np.where(begins, np.arange(len(a)), 0))]
        if last is not None and a[0] == last[0]:
            first[:int(np.argmax(begins[1:])) + 1 if begins[1:].any() else len(a)] = last[2]
            begins[0] = False
        last = a[-1], b[-1], first[-1]
        yield a[fresh], b[fresh], open_[fresh], first[fresh], begins[fresh]


def _rows(a: np.ndarray, b: np.ndarray, open_: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(open_)], names=["a", "b", "open"])


def _large(batches):
    """Each node's larger neighbours, linked to the smallest of all; an open row for a node that
    is neither a star's centre nor a leaf."""
    for a, b, _, first, _ in _groups(batches):
        up = b > a
        odd = (first < a) & (b != first)
        tells = np.flatnonzero(odd)[np.unique(a[odd], return_index=True)[1]]
        yield _rows(np.append(b[up], a[tells]), np.append(np.minimum(a, first)[up], first[tells]),
                    np.append(np.zeros(up.sum(), bool), np.ones(len(tells), bool)))


def _small(batches):
    """Each node and its smaller neighbours, linked to the smallest."""
    for a, b, open_, first, begins in _groups(batches):
        yield _rows(np.where(begins, a, b), first, open_)


def components(edges: DataFrame) -> DataFrame:
    """(node, component): each node of edges (a, b) and the smallest node that it reaches, once."""
    edges = edges.where("a <> b").select("a", "b", F.lit(False).alias("open"))
    before = None
    while True:
        both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).withColumn("open", F.lit(False))
        star = both.repartition("a").sortWithinPartitions("a", "b").mapInArrow(_large, "a long, b long, open boolean")
        star = star.repartition("a").sortWithinPartitions("a", "b", F.desc("open")).mapInArrow(_small, "a long, b long, open boolean")
        edges = stored(star, "edges")
        if before is not None:
            discard(before)
        before = edges
        if edges.where("open").isEmpty():  # what went in were stars
            break
    whole = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return whole.unionByName(whole.select(F.col("component").alias("node"), "component").distinct())
