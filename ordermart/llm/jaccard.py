"""Exact n-gram Jaccard join and its components: size-banded tiles, bitmap bounds, exact intersection.

A document's set is its distinct w-word shingles as sorted 64-bit hashes; documents
with equal sets are one node. The join runs over nodes:

* Tiles. Two sets with similarity t or more share one of their first
  n - ceil(t * n) + 1 shingles in any common order. The order puts shingles that many
  documents have last, by levels of a fixed-size count sketch (its errors cost time,
  never a link). The nodes that share such a key, by size, are cut into tiles where the
  next size is over 1 / t times the last.
* Bounds. Each set has a bitmap of about n hashed bits; the differing bits of two bitmaps
  bound their overlap from above. Within each tile, in one task and without emitting
  pairs, nodes are compared by bitmap with the nodes that they are not yet connected to;
  what goes out is a spanning forest of the possible links, at most a row a node.
* Families. The forests' components hold every link within them. Their sets are fetched,
  and within each family the nodes that no link connects yet are intersected exactly;
  again a spanning forest of links goes out. Its components are the result.

Tiles and families of more than a block's nodes are dealt to tasks by pairs of blocks.
No pair, key, candidate or group size is capped. The driver sees only counts and the
sketch. Keys, sets and links are shuffled by hash; written tables cut the lineage.

Defined results: A-Z are lower-cased, words end at ASCII white space; fewer than w words
make one shingle of the whole sequence; a null or empty text has an empty set and no
links; equal sets are linked; repeated rows come out each; a null id takes part but is
never a component's name (null if all its ids are null); an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermart.llm.common import binary_array, clean, columns, discard, spans, stored, table, word_blocks

WIDTH = 5
PERCENT = 75
CELL_BITS, PARTS = 22, 1024
CELLS = 1 << CELL_BITS
TILE, FAMILY = 4096, 1024
IDS = 1_000_000
PRIMES = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5)]
NODE = "node long, n int"


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * PRIMES[0]
    return x ^ (x >> np.uint64(29))


def shingle_sets(column: pa.Array, width: int = WIDTH):
    """(row, sorted distinct shingle hashes) of every text, block by block."""
    for a, _, words, codes, rows in word_blocks(column, lower=True):
        h = np.fromiter(map(xxhash.xxh3_64_intdigest, words.to_pylist()), np.uint64, len(words))[codes]
        last = max(0, len(h) - width + 1)
        rolled = np.zeros(last, np.uint64)
        for k in range(width):
            rolled = _mix(rolled + h[k:last + k] + np.uint64(k + 1))
        for i in range(len(rows) - 1):
            lo, hi = rows[i], rows[i + 1]
            if hi - lo >= width:
                yield a + i, np.unique(rolled[lo:hi - width + 1])
            elif hi > lo:
                yield a + i, np.array([xxhash.xxh3_64_intdigest(h[lo:hi].tobytes(), seed=int(hi - lo))], np.uint64)
            else:
                yield a + i, np.empty(0, np.uint64)


def _cell(s: np.ndarray) -> np.ndarray:
    return (s >> np.uint64(64 - CELL_BITS)).astype(np.int64)


def node_of(s: np.ndarray) -> int:
    return int(np.int64(np.uint64(xxhash.xxh3_64_intdigest(s.tobytes()))))


def bitmap(s: np.ndarray) -> bytes:
    """One bit a hash, in a power of two of at least 64 and n bits."""
    bits = np.zeros(max(64, 1 << int(len(s) - 1).bit_length()), bool)
    bits[s & np.uint64(len(bits) - 1)] = True
    return np.packbits(bits, bitorder="little").tobytes()


def most_overlap(x: bytes, y: bytes, nx: int, ny: int) -> int:
    """No overlap is larger: every differing bit is a shingle of one set alone. The
    wider bitmap is folded to the narrower one's width."""
    if len(x) > len(y):
        x, y = y, x
    x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
    y = np.bitwise_or.reduce(y.reshape(-1, len(x)), axis=0)
    return min(nx, ny, (nx + ny - int(np.bitwise_count(x ^ y).sum())) // 2)


def similar(overlap: int, nx: int, ny: int, percent: int) -> bool:
    return 100 * overlap >= percent * (nx + ny - overlap)


def _nodes(rows: DataFrame, width: int) -> DataFrame:
    """A row a document (id, node, n, bits), and each task's part of the count sketch."""

    def run(batches):
        cells = np.zeros(CELLS, np.uint32)
        for batch in columns(batches):
            node, n, bits = [], [], []
            for _, s in shingle_sets(batch.column(1), width):
                np.add.at(cells, _cell(s), 1)
                node.append(node_of(s) if len(s) else None)
                n.append(len(s))
                bits.append(bitmap(s) if len(s) else None)
            none = pa.nulls(len(n))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(node, pa.int64()), pa.array(n, pa.int32()), pa.array(bits, pa.binary()),
                 none.cast(pa.int32()), none.cast(pa.binary())], names=["doc_id", "node", "n", "bits", "part", "cells"])
        none = pa.nulls(PARTS)
        yield pa.RecordBatch.from_arrays(
            [none.cast(kind_of), none.cast(pa.int64()), none.cast(pa.int32()), none.cast(pa.binary()),
             pa.array(range(PARTS), pa.int32()),
             pa.array([x.tobytes() for x in np.split(np.minimum(cells, 65535).astype(np.uint16), PARTS)], pa.binary())],
            names=["doc_id", "node", "n", "bits", "part", "cells"])

    from pyspark.sql.pandas.types import to_arrow_type

    kind_of = to_arrow_type(rows.schema["doc_id"].dataType)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, {NODE}, bits binary, part int, cells binary")


def _levels(nodes: DataFrame) -> np.ndarray:
    """Level of each sketch cell: four times the doublings of the mean in its count."""

    def total(t: pa.Table) -> pa.Table:
        cells = sum(np.frombuffer(x, np.uint16).astype(np.float32) for x in t["cells"].to_pylist())
        return pa.table({"part": t["part"][:1], "cells": pa.array([cells.tobytes()], pa.binary())})

    rows = nodes.where("part is not null").select("part", "cells").groupBy("part").applyInArrow(total, "part int, cells binary")
    cells = np.zeros(CELLS, np.float32)
    for r in rows.toLocalIterator():  # PARTS rows
        cells.reshape(PARTS, -1)[r["part"]] = np.frombuffer(r["cells"], np.float32)
    return np.clip(4 * np.log2(np.maximum(cells, 1) / max(1.0, float(cells.mean()))), 0, 200).astype(np.uint8)


def _keys(rows: DataFrame, levels: np.ndarray, width: int, percent: int) -> DataFrame:
    """(key, node, n): the rare end of each set. Copies in one task count once."""
    sent = rows.sparkSession.sparkContext.broadcast(levels)  # a byte for each of CELLS

    def run(batches):
        levels = sent.value
        seen: set[int] = set()
        for batch in columns(batches):
            for part in range(0, batch.num_rows, 500):
                key, node, n, count = [], [], [], []
                for _, s in shingle_sets(batch.column(1)[part:part + 500], width):
                    if not len(s) or (id_ := node_of(s)) in seen:
                        continue
                    seen.add(id_)
                    level = levels[_cell(s)]
                    if level.any():
                        s = s[np.argsort(level, kind="stable")]
                    need = len(s) - -(-percent * len(s) // 100) + 1
                    key.append(s[:need])
                    node.append(id_)
                    n.append(len(level))
                    count.append(need)
                if len(seen) > 200_000:
                    seen.clear()
                if key:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(key).view(np.int64)), pa.array(np.repeat(np.array(node, np.int64), count)),
                         pa.array(np.repeat(np.array(n, np.int32), count))], names=["key", "node", "n"])

    return rows.select("doc_id", "text").mapInArrow(run, f"key long, {NODE}")


def _tiles(percent: int):
    """Of rows sorted by key, size and node, those that another node shares a tile with:
    (tile, node, n), once each. A key's tile ends where the next size is too large to be
    similar. Only the last row is held back from one batch to the next."""

    def run(batches):
        held, held_first, held_shared = None, 0, False
        for batch in columns(batches):
            t = pa.Table.from_batches([held, batch] if held is not None else [batch])
            key, node, n = (t[c].to_numpy() for c in ("key", "node", "n"))
            fresh = np.append(True, (key[1:] != key[:-1]) | (node[1:] != node[:-1]))
            t, key, n = t.filter(pa.array(fresh)), key[fresh], n[fresh].astype(np.int64)
            near = (key[1:] == key[:-1]) & (n[1:] * percent <= n[:-1] * 100)  # row and the one before
            begins = np.append(True, ~near)
            first = n[np.maximum.accumulate(np.where(begins, np.arange(len(n)), 0))]
            if held is not None:
                first[:int(np.argmax(begins[1:])) + 1 if begins[1:].any() else len(n)] = held_first
            shared = np.append(held_shared, near)
            held_first, held_shared = int(first[-1]), bool(shared[-1])
            shared[:-1] |= near
            tile = _mix(key.view(np.uint64) + first.astype(np.uint64)).view(np.int64)
            keep = np.flatnonzero(shared[:-1])
            if len(keep):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(tile[keep]), t["node"].combine_chunks().take(pa.array(keep)), pa.array(n[keep].astype(np.int32))],
                    names=["key", "node", "n"])
            held = t.slice(len(key) - 1).combine_chunks().to_batches()[0]
            if held_shared:
                last = pa.RecordBatch.from_arrays([pa.array(tile[-1:]), held.column("node"), held.column("n")], names=["key", "node", "n"])
        if held is not None and held_shared:
            yield last

    return run


def _sets(rows: DataFrame, width: int) -> DataFrame:
    def run(batches):
        for batch in columns(batches):
            for part in range(0, batch.num_rows, 500):
                every = [s for _, s in shingle_sets(batch.column(1)[part:part + 500], width)]
                flat = np.concatenate(every)
                ends = np.cumsum([0, *map(len, every)]) * 8
                yield pa.RecordBatch.from_arrays(
                    [pa.array([node_of(s) for s in every], pa.int64()), binary_array(flat.view(np.uint8), ends)], names=["node", "s"])

    return rows.mapInArrow(run, "node long, s binary")


def _dealt(rows: DataFrame, by: str, block: int) -> DataFrame:
    """rows with (part): groups of at most `block` rows whole, larger ones by pairs of
    hash blocks, so that each pair of a group's rows meets in a part."""
    count = rows.groupBy(by).count().where(F.col("count") > block).select(by, F.ceil(F.col("count") / block).alias("k"))
    rows = rows.join(count, by, "left")
    own = F.pmod(F.xxhash64("node"), F.col("k"))
    other = F.explode(F.when(F.col("k").isNull(), F.array(F.lit(-1).cast("long"))).otherwise(F.sequence(F.lit(0).cast("long"), F.col("k") - 1)))
    part = F.when(F.col("k").isNull(), F.xxhash64(by)).otherwise(F.xxhash64(by, F.least(own, "other"), F.greatest(own, "other")))
    return rows.withColumn("other", other).withColumn("part", part).drop("other", "k")


def _runs(batches, names: list[str]):
    """Columns (numpy, or a list for binary) of each run of rows with one `part`."""
    held = None
    for batch in columns(batches):
        t = pa.Table.from_batches([batch])
        t = pa.concat_tables([held, t]) if held is not None else t
        part = t["part"].to_numpy()
        edges = np.concatenate([[0], np.flatnonzero(part[1:] != part[:-1]) + 1])
        ready = t.slice(0, edges[-1])
        held = t.slice(edges[-1])
        if len(ready):
            whole = [ready[c].to_pylist() for c in names]
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                yield [x[a:b] for x in whole]
    if held is not None and len(held):
        yield [held[c].to_pylist() for c in names]


def _forest(n: list[int], percent: int, near) -> list[tuple[int, int]]:
    """Edges that connect rows, by rising n, as far as near(i, rows) finds them alike; a
    row is compared with the later rows of fitting size that it isn't connected to."""
    size = np.array(n, np.int64)
    label = np.arange(len(size))
    out = []
    last = np.searchsorted(size, size * 100 // percent, "right")
    for i in range(len(size) - 1):
        rest = np.arange(i + 1, last[i])
        rest = rest[label[rest] != label[i]]
        if len(rest):
            for j in rest[near(i, rest)].tolist():
                if label[j] != label[i]:
                    out.append((i, j))
                    label[label == label[j]] = label[i]
    return out


def _edges(found: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([a for a, _ in found], pa.int64()), pa.array([b for _, b in found], pa.int64())], names=["a", "b"])


def _possible(percent: int):
    """Spanning forest of each tile's possible links, by bitmaps."""

    def small(n: list[int], bits: list[int], width: list[int]):
        def near(i, rest):
            keep = []
            for j in rest.tolist():
                y = bits[j] if width[j] == width[i] else folded(bits[j], width[j], width[i])
                keep.append(similar(min(n[i], (n[i] + n[j] - (bits[i] ^ y).bit_count()) // 2), n[i], n[j], percent))
            return np.array(keep, bool)

        return near

    def folded(y: int, wide: int, width: int) -> int:
        while wide > width:
            wide //= 2
            y = (y >> wide) | (y & ((1 << wide) - 1))
        return y

    def large(n: list[int], bits: list[bytes]):
        size = np.array(n, np.int64)
        wide = np.array([len(x) for x in bits])
        at_width = {}
        for w in np.unique(wide).tolist():  # each row at every width up to its own
            m = np.zeros((len(n), w // 8), np.uint64)
            for k in np.flatnonzero(wide >= w):
                m[k] = np.bitwise_or.reduce(np.frombuffer(bits[k], np.uint64).reshape(-1, w // 8), axis=0)
            at_width[w] = m

        def near(i, rest):
            m = at_width[int(wide[i])]
            differ = np.bitwise_count(m[rest] ^ m[i]).sum(axis=1, dtype=np.int64)
            overlap = np.minimum(size[i], (size[i] + size[rest] - differ) // 2)
            return 100 * overlap >= percent * (size[i] + size[rest] - overlap)

        return near

    def run(batches):
        found = []
        for node, n, bits in _runs(batches, ["node", "n", "bits"]):
            near = large(n, bits) if len(n) > 64 else small(n, [int.from_bytes(x, "little") for x in bits], [8 * len(x) for x in bits])
            found += [(node[i], node[j]) for i, j in _forest(n, percent, near)]
            if len(found) > 50_000:
                yield _edges(found)
                found = []
        if found:
            yield _edges(found)

    return run


def _exact(percent: int):
    """Spanning forest of each family's links, by intersection of the sorted sets."""

    def run(batches):
        found = []
        for node, n, s in _runs(batches, ["node", "n", "s"]):
            sets = [np.frombuffer(x, np.uint64) for x in s]
            length = np.array(n, np.int64)
            every, at = np.unique(np.concatenate(sets), return_inverse=True)
            starts = np.cumsum(length) - length
            mark = np.zeros(len(every), np.int32)

            def near(i, rest, at=at, starts=starts, length=length, mark=mark):
                own = at[starts[i]:starts[i] + length[i]]
                mark[own] = 1
                hits = mark[at[spans(starts[rest], length[rest])]]
                overlap = np.add.reduceat(hits, np.cumsum(length[rest]) - length[rest])
                mark[own] = 0
                return 100 * overlap >= percent * (length[i] + length[rest] - overlap)

            found += [(node[i], node[j]) for i, j in _forest(n, percent, near)]
            if len(found) > 50_000:
                yield _edges(found)
                found = []
        if found:
            yield _edges(found)

    return run


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, component): each node with edges and the smallest node it reaches.
    Alternating large and small stars: every step links a node's neighbours to their
    minimum, until each component is one star."""
    edges = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = _state(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = large.where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(low, "a").select(F.explode(F.array(
            F.struct(F.col("a").alias("a"), F.col("low").alias("b")),
            F.struct(F.col("b").alias("a"), F.col("low").alias("b")))).alias("e")).select("e.*")
        step = stored(small.where("a <> b").distinct(), "edges")
        discard(edges)
        edges, after = step, _state(step)
        if after == before:
            break
        before = after
    whole = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return whole.unionByName(whole.select(F.col("component").alias("node"), "component").distinct())


def linked_nodes(shared: DataFrame, facts: DataFrame, rows: DataFrame, width: int, percent: int,
                 tile: int = TILE, family: int = FAMILY) -> DataFrame:
    """(node, component) of the nodes that have links."""
    sized = _dealt(shared.select("key", "node"), "key", tile).select("part", "node").join(facts.select("node", "n", "bits"), "node")
    sized = sized.repartition("part").sortWithinPartitions("part", "n", "node")
    possible = stored(sized.mapInArrow(_possible(percent), "a long, b long").distinct(), "possible")
    families = stored(components(possible), "families")
    wanted = stored(facts.join(families, "node", "left_semi").select(F.col("doc_id").alias("wanted")), "wanted")
    if wanted.count() <= IDS:
        wanted = F.broadcast(wanted)  # else both sides are shuffled by id
    sets = stored(_sets(rows.join(wanted, F.col("doc_id").eqNullSafe(F.col("wanted")), "left_semi"), width), "sets")
    of = _dealt(families.withColumnRenamed("component", "family"), "family", family).select("part", "node")
    met = of.join(facts.select("node", "n"), "node").join(sets, "node")
    met = met.repartition("part").sortWithinPartitions("part", "n", "node")
    links = stored(met.mapInArrow(_exact(percent), "a long, b long").distinct(), "links")
    discard(possible)
    discard(sets)
    return components(links)


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH,
                    percent: int = PERCENT, tile: int = TILE, family: int = FAMILY) -> DataFrame:
    """(id, n_shingles, component_id) of every row."""
    rows = clean(df, id_col, text_col)
    every = stored(_nodes(rows, width), "nodes")
    levels = _levels(every)
    docs = every.where("part is null").select("doc_id", "node", "n", "bits")
    keys = _keys(rows, levels, width, percent).repartition("key").sortWithinPartitions("key", "n", "node")
    shared = stored(keys.mapInArrow(_tiles(percent), f"key long, {NODE}"), "shared")
    some = shared.select("node").distinct()
    facts = stored(docs.join(some, "node").groupBy("node", "n").agg(F.min("doc_id").alias("doc_id"), F.max("bits").alias("bits")), "facts")
    label = linked_nodes(shared, facts, rows, width, percent, tile, family)
    first = docs.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("first"))
    name = label.join(first, "node").groupBy("component").agg(F.min("first").alias("least"))
    known = stored(label.join(name, "component").select("node", "least"), "known")
    classes = first.join(known, "node", "left").select("node", F.coalesce("least", "first").alias("component_id"))
    discard(shared)
    return docs.select("doc_id", "node", "n").join(classes, "node", "left").select(
        F.col("doc_id").alias(id_col), F.col("n").cast("long").alias("n_shingles"),
        F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def op7_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
