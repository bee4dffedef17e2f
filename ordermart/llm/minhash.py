"""Near duplicates by MinHash with tensored banding.

Documents with equal sets of w-word shingles are one node. A node has two collections of HALVES
half keys of ROWS minhashes each; the table keys are all pairs of a half key of the one collection
and a half key of the other, so 2 * 14 * 3 = 84 minhashes make 196 tables of 6 minhashes. A pair of
similarity s meets in a table unless one collection has no common half key:
(1 - (1 - s^3)^14)^2, 0.99991 at 0.8 and 0.9999999 at 0.9. Then, exactly:

* Stars. In the 14 tables of equal numbers, each key's nodes are compared on their full sets with
  the key's smallest node, one row a node and table. The nodes that hold a link with the same
  node, the smallest of theirs, are a clump.
* Rests. Half keys whose nodes are all in one clump, or that only one node has, can't bring
  anything new and are left out; from the others' pairs come the keys of all tables. Within a key,
  in one task and without emitting pairs, nodes of different clumps are compared by size and
  by the bytes of their minhashes (below AGREE of 84 a pair of 0.8 has a chance of 1e-7); a spanning
  forest of what is possible goes out. In its families the full sets of nodes of different
  clumps are intersected, until those that link are connected.
* Components are those of the clumps, so that large groups of near copies are few edges.

Keys or families of more than a block go to tasks by pairs of blocks, except two blocks of the
same component. Sets of keys that the tasks test first are bitmaps of fixed size (more rows at
worst). No key, candidate or group is capped; the driver sees only bitmaps and counts.

Defined results: A-Z are lower-cased, words end at ASCII white space; fewer than w words make one
shingle of the whole sequence; a null or empty text has an empty set and no links; equal sets are
linked; repeated rows come out each; a null id takes part, is never a component's name (null if
all its ids are null) and is kept only then; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermart.llm import bits
from ordermart.llm.common import binary_array, clean, columns, spans, stored, table, with_id
from ordermart.llm.graph import components
from ordermart.llm.jaccard import node_of, shingle_sets

WIDTH, PERCENT = 4, 80
HALVES, ROWS = 14, 3
AGREE = 46
BLOCK = 4096  # nodes of one key in a task
FAMILY = 2 << 20  # shingles of one family in a task
IDS = 1_000_000
MINHASHES = 2 * HALVES * ROWS
_random = np.random.default_rng(20)
FLIP = _random.integers(0, 1 << 32, MINHASHES, dtype=np.uint32)
TIMES = _random.integers(0, 1 << 32, MINHASHES, dtype=np.uint32) | np.uint32(1)
PRIME = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * PRIME
    return x ^ (x >> np.uint64(29))


def minhashes(sets: list[np.ndarray]) -> np.ndarray:
    """(sets x MINHASHES) of sets that aren't empty."""
    flat = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    starts = np.cumsum([0, *map(len, sets)])[:-1]
    out = np.empty((len(sets), MINHASHES), np.uint32)
    for k in range(MINHASHES):
        x = (flat ^ FLIP[k]) * TIMES[k]
        x ^= x >> np.uint32(15)
        out[:, k] = np.minimum.reduceat(x * TIMES[k - 1], starts)
    return out


def half_keys(m: np.ndarray) -> np.ndarray:
    """(sets x 2 HALVES): the half keys of the one collection, then of the other."""
    key = np.broadcast_to(np.arange(2 * HALVES, dtype=np.uint64) + np.uint64(1), (len(m), 2 * HALVES))
    for k in range(ROWS):
        key = _mix(key * PRIME + m[:, k::ROWS])
    return key


def _signatures(rows: DataFrame, width: int) -> DataFrame:
    """(doc_id, node, n, halves, checks) of every row; node, halves and checks null without words."""

    def run(batches):
        for batch in columns(batches):
            for part in range(0, batch.num_rows, 500):
                some = batch.slice(part, 500)
                sets = [s for _, s in shingle_sets(some.column(1), width)]
                node = [node_of(s) if len(s) else None for s in sets]
                first = {x: i for i, x in reversed(list(enumerate(node))) if x is not None}
                place = {x: k for k, x in enumerate(first)}
                if first:
                    m = minhashes([sets[i] for i in first.values()])
                    halves = [x.tobytes() for x in half_keys(m)]
                    checks = [x.tobytes() for x in m.astype(np.uint8)]
                own = [None if x is None else place[x] for x in node]
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), pa.array(node, pa.int64()), pa.array([len(s) for s in sets], pa.int32()),
                     *(pa.array([None if k is None else x[k] for k in own], pa.binary()) for x in ((halves, checks) if first else ((), ())))],
                    names=["doc_id", "node", "n", "halves", "checks"])

    return rows.mapInArrow(run, with_id(rows, "node long, n int, halves binary, checks binary"))


def _half_rows(nodes: DataFrame) -> DataFrame:
    """(key, component): every half key of every node."""

    def run(batches):
        for batch in columns(batches):
            key = np.frombuffer(b"".join(batch.column(0).to_pylist()), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(np.repeat(batch.column(1).to_numpy(), 2 * HALVES))], names=["key", "component"])

    return nodes.select("halves", "component").mapInArrow(run, "key long, component long")


def _open(rows: DataFrame) -> np.ndarray:
    """Bitmap of the keys that nodes of different components share."""
    ends = rows.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    return bits.bitmap_of(ends.where("low <> high").select("key"))


def _tables(nodes: DataFrame, halves: np.ndarray, diagonal: bool, tables: np.ndarray | None = None) -> DataFrame:
    """(key, component, node): the table keys of open half keys, those in `tables` only."""
    sent = nodes.sparkSession.sparkContext.broadcast((halves, tables))  # bitmaps

    def run(batches):
        halves, tables = sent.value
        for batch in columns(batches):
            for part in range(0, batch.num_rows, 2000):
                some = batch.slice(part, 2000)
                half = np.frombuffer(b"".join(some.column(0).to_pylist()), np.uint64).reshape(-1, 2 * HALVES)
                open_ = bits.test(halves, half)
                a, b, x, y = half[:, :HALVES], half[:, HALVES:], open_[:, :HALVES], open_[:, HALVES:]
                if diagonal:
                    row, i = np.nonzero(x & y)
                    j = i
                else:
                    row, i, j = np.nonzero(x[:, :, None] & y[:, None, :])
                key = _mix(a[row, i] * PRIME + b[row, j])
                if tables is not None:
                    go = bits.test(tables, key)
                    row, key = row[go], key[go]
                if len(key):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(key.view(np.int64)), pa.array(some.column(1).to_numpy()[row]), pa.array(some.column(2).to_numpy()[row])],
                        names=["key", "component", "node"])

    return nodes.select("halves", "component", "node").mapInArrow(run, "key long, component long, node long")


def _sets(rows: DataFrame, ids: DataFrame, width: int) -> DataFrame:
    """(node, s): the sets of the rows with these ids."""

    def run(batches):
        for batch in columns(batches):
            for part in range(0, batch.num_rows, 500):
                every = [s for _, s in shingle_sets(batch.column(1)[part:part + 500], width)]
                ends = np.cumsum([0, *map(len, every)]) * 8
                yield pa.RecordBatch.from_arrays(
                    [pa.array([node_of(s) for s in every], pa.int64()), binary_array(np.concatenate(every).view(np.uint8), ends)], names=["node", "s"])

    ids = stored(ids.select(F.col("doc_id").alias("wanted")).distinct(), "wanted")
    if ids.count() <= IDS:
        ids = F.broadcast(ids)  # else both sides are shuffled by id
    found = rows.join(ids, F.col("doc_id").eqNullSafe(F.col("wanted")), "left_semi").select("doc_id", "text")
    return stored(found.mapInArrow(run, "node long, s binary").dropDuplicates(["node"]), "sets")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar."""

    def run(batches):
        for batch in columns(batches):
            good = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                good.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select([0, 1]).filter(pa.array(good))

    x, y = (sets.select(F.col("node").alias(c), F.col("s").alias(f"s{c}")) for c in "ab")
    return pairs.join(y, "b").join(x, "a").select("a", "b", "sa", "sb").mapInArrow(run, "a long, b long")


def _runs(batches, names: list[str]):
    """Columns of each run of rows with one `part`."""
    held = None
    for batch in columns(batches):
        t = pa.Table.from_batches([batch])
        t = pa.concat_tables([held, t]) if held is not None else t
        part = t["part"].to_numpy()
        edges = np.concatenate([[0], np.flatnonzero(part[1:] != part[:-1]) + 1])
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            yield [t[c][a:b] for c in names]
        held = t.slice(edges[-1])
    if held is not None and len(held):
        yield [held[c] for c in names]


def _forest(size: np.ndarray, component: np.ndarray, percent: int, near) -> list[tuple[int, int]]:
    """Edges that connect rows, by rising size, of different components as far as
    near(i, rows) finds them alike."""
    label = np.unique(component, return_inverse=True)[1]
    last = np.searchsorted(size, size * 100 // percent, "right")
    left = len(np.unique(label))
    out = []
    for i in range(len(size) - 1):
        if left == 1:
            break
        rest = np.arange(i + 1, last[i])
        rest = rest[label[rest] != label[i]]
        if len(rest):
            for j in rest[near(i, rest)].tolist():
                if label[j] != label[i]:
                    out.append((i, j))
                    label[label == label[j]] = label[i]
                    left -= 1
    return out


def _edges(names: np.ndarray, found: list[tuple[int, int]]) -> pa.RecordBatch:
    at = np.array(found).reshape(-1, 2)
    return pa.RecordBatch.from_arrays([pa.array(names[at[:, 0]]), pa.array(names[at[:, 1]])], names=["a", "b"])


def _possible(percent: int, agree: int):
    """Forest of the components of each key that sizes and minhashes allow to link."""

    def run(batches):
        for n, component, checks in _runs(batches, ["n", "component", "checks"]):
            size, component = n.to_numpy().astype(np.int64), component.to_numpy()
            m = np.frombuffer(b"".join(checks.to_pylist()), np.uint8).reshape(-1, MINHASHES)
            found = _forest(size, component, percent, lambda i, rest, m=m: (m[rest] == m[i]).sum(axis=1) >= agree)
            if found:
                yield _edges(component, found)

    return run


def _exact(percent: int):
    """Forest of the links between different components of each family, by full sets."""

    def run(batches):
        for n, component, s in _runs(batches, ["n", "component", "s"]):
            length, component = n.to_numpy().astype(np.int64), component.to_numpy()
            every, at = np.unique(np.concatenate([np.frombuffer(x.as_buffer(), np.uint64) for x in s]), return_inverse=True)
            starts = np.cumsum(length) - length
            mark = np.zeros(len(every), bool)

            def near(i, rest, at=at, starts=starts, length=length, mark=mark):
                own = at[starts[i]:starts[i] + length[i]]
                mark[own] = True
                hits = mark[at[spans(starts[rest], length[rest])]]
                overlap = np.add.reduceat(hits, np.cumsum(length[rest]) - length[rest], dtype=np.int64)
                mark[own] = False
                return 100 * overlap >= percent * (length[i] + length[rest] - overlap)

            found = _forest(length, component, percent, near)
            if found:
                yield _edges(component, found)

    return run


def _dealt(rows: DataFrame, by: str, size: str, most: int) -> DataFrame:
    """rows with (part): groups of at most `most`, summed up by `size`, whole; the rows of larger
    ones by pairs of blocks, so that rows of different components meet in a part. A component
    over half a part has blocks of its own, of which no two meet; the small ones share blocks."""
    total = stored(rows.groupBy(by).agg(F.sum(size).alias("_all")).where(F.col("_all") > most).select(by), "large")
    if total.isEmpty():
        return rows.withColumn("part", F.xxhash64(by))
    each = rows.join(total, by, "left_semi").groupBy(by, "component").agg(F.sum(size).alias("_own"))
    half = max(1, most // 2)
    each = each.withColumn("_large", F.col("_own") > half)
    small = each.groupBy(by).agg(F.ceil(F.sum(F.when(~F.col("_large"), F.col("_own")).otherwise(0)) / half).alias("_k"))
    each = each.join(small, by).select(
        by, "component", F.when(F.col("_large"), F.col("component")).alias("_owner"), F.when(F.col("_large"), F.ceil(F.col("_own") / half)).otherwise(F.col("_k")).alias("_k"))
    blocks = each.select(by, "_owner", F.explode(F.sequence(F.lit(1).cast("long"), F.greatest("_k", F.lit(1).cast("long")))).alias("_block")).distinct()
    name = F.xxhash64(by, F.coalesce("_owner", F.lit(0)), F.col("_owner").isNull(), "_block")
    blocks = blocks.select(by, "_owner", name.alias("_name"))
    other = blocks.select(by, F.col("_owner").alias("_owner2"), F.col("_name").alias("_name2"))
    meet = blocks.join(other, by).where("_owner is null or _owner2 is null or _owner <> _owner2")
    meet = meet.select(by, "_name", F.xxhash64(by, F.least("_name", "_name2"), F.greatest("_name", "_name2")).alias("part"))
    split = rows.join(each, [by, "component"])
    own = F.when(F.col("_owner").isNull(), F.col("component")).otherwise(F.col("node"))
    split = split.withColumn("_block", F.pmod(F.xxhash64(own), F.greatest("_k", F.lit(1).cast("long"))) + 1).withColumn("_name", name)
    split = split.join(meet, [by, "_name"]).select(*rows.columns, "part")
    whole = rows.join(total, by, "left_anti").select(*rows.columns, F.xxhash64(by).alias("part"))
    return whole.unionByName(split)


def _components(nodes: DataFrame, rows: DataFrame, width: int, percent: int, agree: int, block: int, family: int) -> DataFrame:
    """(node, component) of all nodes by the links of those whose sets are similar and meet in a table."""
    alone = nodes.withColumn("component", F.col("node"))
    near = _tables(alone, _open(_half_rows(alone)), diagonal=True)
    star = near.groupBy("key").agg(F.min("node").alias("a"), F.max("node").alias("z")).where("a <> z").select("key", "a")
    pairs = stored(near.join(star, "key").where("a <> node").select("a", F.col("node").alias("b")).distinct(), "pairs")
    ends = pairs.select("a").union(pairs.select("b")).distinct().toDF("node")
    sets = _sets(rows, nodes.join(ends, "node", "left_semi"), width)
    first = stored(_verified(pairs, sets, percent), "links")
    clump = stored(first.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("component")), "clumps")
    known = stored(nodes.join(clump, "node", "left").withColumn("component", F.coalesce("component", "node")), "known")
    own = clump.join(first.select(F.col("a").alias("node")).distinct(), "node", "left_semi").select(F.col("node").alias("a"), F.col("component").alias("b"))
    between = first.join(clump, F.col("b") == F.col("node")).where("a <> component").select("a", F.col("component").alias("b"))
    halves = _open(_half_rows(known))
    open_ = stored(_tables(known, halves, False, _open(_tables(known, halves, False))), "open")
    dealt = _dealt(open_.withColumn("one", F.lit(1)), "key", "one", block).join(known.select("node", "n", "checks"), "node")
    dealt = dealt.select("part", "n", "node", "component", "checks").repartition("part").sortWithinPartitions("part", "n", "node")
    possible = stored(dealt.mapInArrow(_possible(percent, agree), "a long, b long").distinct(), "possible")
    families = stored(components(possible).select(F.col("node").alias("component"), F.col("component").alias("family")), "families")
    members = stored(open_.select("node", "component").distinct().join(families, "component").join(nodes.select("node", "n", "doc_id"), "node"), "members")
    sets = _sets(rows, members, width)
    dealt = _dealt(members.select("node", "n", "component", "family"), "family", "n", family).join(sets, "node")
    dealt = dealt.select("part", "n", "node", "component", "s").repartition("part").sortWithinPartitions("part", "n", "node")
    rest = dealt.mapInArrow(_exact(percent), "a long, b long")
    found = components(own.unionByName(between).unionByName(rest)).withColumnRenamed("node", "clump").withColumnRenamed("component", "least")
    return known.join(found, F.col("component") == F.col("clump"), "left").select("node", F.coalesce("least", "component").alias("component"))


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, percent: int = PERCENT,
                    agree: int = AGREE, block: int = BLOCK, family: int = FAMILY) -> DataFrame:
    """(id, n_shingles, component_id, kept) of every row."""
    rows = clean(df, id_col, text_col)
    every = stored(_signatures(rows, width), "signatures")
    some = every.where("node is not null")
    nodes = stored(some.groupBy("node", "n").agg(*(F.min(c).alias(c) for c in ("doc_id", "halves", "checks"))), "nodes")
    label = stored(_components(nodes, rows, width, percent, agree, block, family), "labels")
    name = label.join(nodes.select("node", "doc_id"), "node").groupBy("component").agg(F.min("doc_id").alias("component_id"))
    classes = stored(label.join(name, "component").select("node", "component_id"), "classes")
    out = every.select("doc_id", "node", "n").join(classes, "node", "left").select(
        F.col("doc_id").alias(id_col), F.col("n").cast("long").alias("n_shingles"),
        F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))
    return out.withColumn("kept", F.col(id_col).eqNullSafe(F.col("component_id")))


def op11_tensored_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
