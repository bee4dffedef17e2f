"""Exact top-k inner products by a three-phase uniform threshold.

The dimensions are cut into `lists` slices; a slice's node scores queries against
candidates by its own dimensions only, in blocks of rows. A node's work is dealt to
cells: the cells of a grid hold a group of query blocks each and read a group of
candidate blocks one after another. Nothing goes through the driver, and the grid
has as many cells as there are tasks, however many blocks there are.

1. Gather: each slice reports its k best local scores of a query. The exact totals of
   the gathered candidates give a cutoff that the k-th best total reaches surely.
2. Collect: with a total of at least `cutoff`, some slice has at least cutoff / lists;
   each slice reports every entry that reaches it, packed by block pair.
3. Resolve: an entry that a slice did not report is asked of that slice. All totals
   are then exact: rank by total, ties to the smaller id.

Candidates with the same vector tie for every query, so only the k + 1 smallest ids of
each distinct vector can be answers (one may be the query's own); the others are left
out before phase 1, and a vector that a third of all rows share costs k + 1 rows.

Defined results: components are floor(scale * x); vectors that are null or hold null or
non-finite components take no part; missing components of shorter vectors count as 0;
of rows that repeat an id the one with the largest vector counts; fewer than k other
rows give them all; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ordermart.functions.joins import merged
from ordermart.llm.common import columns, stored, table

QUERY_ROWS, ROWS = 512, 2048
LISTS = 2
#: Bytes of a cell's query blocks.
RESIDENT = 32 << 20


def vectors(df: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(id, v array<bigint>) of the rows that take part, one row an id."""
    x = F.col(vector_col)
    fit = x.isNotNull() & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = df.where(fit & F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.transform(x, lambda c: F.floor(c.cast("double") * scale)).alias("v"))
    return rows.groupBy("id").agg(F.max("v").alias("v"))


def _small(m: np.ndarray) -> bytes:
    """The matrix in the shortest integers that hold it."""
    low, high = int(m.min(initial=0)), int(m.max(initial=0))
    kind = next(t for t in (np.int16, np.int32, np.int64) if np.iinfo(t).min <= low and high <= np.iinfo(t).max)
    return np.ascontiguousarray(m, kind).tobytes()


def _edges(width: int, lists: int) -> np.ndarray:
    return np.linspace(0, width, lists + 1).astype(int)


def _blocks(rows: DataFrame, n: int, width: int, lists: int, rest: str = "") -> DataFrame:
    """(block, list, ids, m, ...): rows in n blocks by id hash, a matrix for each slice;
    the `cut` column goes along if it is there."""
    edges = _edges(width, lists)

    def build(t: pa.Table) -> pa.Table:
        t = t.combine_chunks()
        v = t["v"].combine_chunks()
        count = v.value_lengths().to_numpy()
        m = np.zeros((len(t), width), np.int64)
        row = np.repeat(np.arange(len(t)), count)
        m[row, np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)] = v.flatten().to_numpy()
        out = {"block": [t["block"][0].as_py()] * lists, "list": list(range(lists)),
               "ids": [t["id"].to_numpy().astype(np.int64).tobytes()] * lists,
               "m": [_small(m[:, edges[i]:edges[i + 1]]) for i in range(lists)]}
        if rest:
            out["cut"] = [t["cut"].to_numpy().astype(np.int64).tobytes()] * lists
        return pa.table(out, schema=pa.schema([("block", pa.int32()), ("list", pa.int32()), ("ids", pa.binary()), ("m", pa.binary())]
                                              + [("cut", pa.binary())] * bool(rest)))

    rows = rows.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(n)).cast("int"))
    return rows.groupBy("block").applyInArrow(build, "block int, list int, ids binary, m binary" + rest)


def _grid(queries: int, parts: int, candidates: int, n: int, lists: int, tasks: int, a_query: int) -> tuple[int, int]:
    """Groups of the query blocks (parts) and of the candidate blocks (n): together with
    the slices about a cell a task, so split that little is sent twice. a_query: bytes."""
    cells = -(-tasks // lists)
    a = min(parts, max(1, -(-queries * a_query // RESIDENT), round(math.sqrt(cells * queries / max(1, candidates)))))
    return a, min(n, -(-cells // a))


def _cells(queries: DataFrame, candidates: DataFrame, grid: tuple[int, int], lists: int, requests: DataFrame | None = None) -> DataFrame:
    """Rows of each cell in one partition: its query blocks, then its candidate blocks,
    each before the requests for it."""
    a, b = grid

    def cell(i: Column, j: Column) -> Column:
        return ((F.col("list") * a + i) * b + j).cast("int").alias("cell")

    def whole(kind: int, block: Column, q_block: Column) -> list[Column]:
        return [F.lit(kind).alias("kind"), block.alias("block"), q_block.alias("q_block")]

    none, empty = F.lit(-1), F.lit(None).cast("binary")
    cut = F.col("cut") if "cut" in queries.columns else empty
    rows = queries.withColumn("j", F.explode(F.sequence(F.lit(0), F.lit(b - 1)))).select(
        cell(F.pmod("block", F.lit(a)), F.col("j")), *whole(0, none, F.col("block")), "ids", "m", cut.alias("rest"))
    rows = rows.unionByName(candidates.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(a - 1)))).select(
        cell(F.col("i"), F.pmod("block", F.lit(b))), *whole(1, F.col("block"), none), "ids", "m", empty.alias("rest")))
    if requests is not None:
        rows = rows.unionByName(requests.select(
            cell(F.pmod("q_block", F.lit(a)), F.pmod("block", F.lit(b))), *whole(2, F.col("block"), F.col("q_block")),
            empty.alias("ids"), empty.alias("m"), F.col("at").alias("rest")))
    return rows.repartitionById(lists * a * b, "cell").sortWithinPartitions("cell", "block", "kind", "q_block")


def _of_cells(batches: Iterator[pa.RecordBatch], grid: tuple[int, int], width: int, lists: int) -> Iterator[tuple[int, dict, Iterator]]:
    """(list, query blocks by number, what else the cell reads) of each cell. A block is
    (ids, matrix, bytes of ids, rest); what is read is (block number, block, None) or
    (block number, block, request)."""
    edges = np.diff(_edges(width, lists))
    every = (r for batch in columns(batches) for r in batch.to_pylist())

    def block(r: dict, i: int) -> tuple:
        ids = np.frombuffer(r["ids"], np.int64)
        kind = {2: np.int16, 4: np.int32}.get(len(r["m"]) // max(1, len(ids) * int(edges[i])), np.int64)
        return ids, np.frombuffer(r["m"], kind).reshape(len(ids), -1), r["ids"], r["rest"]

    for number, rows in groupby(every, lambda r: r["cell"]):
        i, asked = number // (grid[0] * grid[1]), {}

        def rest(rows=rows, i=i, asked=asked):
            at = None
            for r in rows:
                if r["kind"] == 0:
                    asked[r["q_block"]] = block(r, i)
                elif r["kind"] == 1:
                    at = block(r, i)
                    yield r["block"], at, None
                else:
                    yield r["block"], at, r

        yield i, asked, rest()


def _scores(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Inner products, in the shortest numbers in which they are exact."""
    most = [max(abs(int(z.max(initial=0))), abs(int(z.min(initial=0)))) for z in (x, y)]
    bound = most[0] * most[1] * max(1, x.shape[1])
    for kind, limit in EXACT.items():
        if bound < limit:
            return x.astype(kind) @ y.astype(kind).T
    return x.astype(np.int64) @ y.astype(np.int64).T


EXACT = {np.float32: 2**24, np.float64: 2**53}


def _like(cut: np.ndarray, s: np.ndarray) -> np.ndarray:
    """Whole numbers to compare the rows of _scores with: those beyond all scores go to their bound."""
    limit = EXACT.get(s.dtype.type)
    return (np.clip(cut, -limit, limit).astype(s.dtype) if limit else cut)[:, None]


class _Best:
    """The k best entries of each query so far."""

    def __init__(self, q: np.ndarray, k: int):
        self.q, self.k = q, k
        self.score = np.full((len(q), k), np.iinfo(np.int64).min)
        self.ids = np.zeros((len(q), k), np.int64)
        self.count = np.zeros(len(q), np.int64)

    def add(self, c: np.ndarray, s: np.ndarray) -> None:
        hit = s > _like(self.score[:, -1], s)
        if s.shape[1] > self.k + 1 and np.count_nonzero(hit) > 4 * (self.k + 1) * len(self.q):
            few = np.zeros(s.shape, bool)  # one more than k, as one may be the query's own
            np.put_along_axis(few, np.argpartition(-s, self.k, axis=1)[:, :self.k + 1], True, axis=1)
            hit &= few
        a, b = np.nonzero(hit)
        other = self.q[a] != c[b]
        a, b = a[other], b[other]
        rows, new = np.unique(a, return_counts=True)
        row = np.concatenate([np.repeat(rows, self.k), a])
        score = np.concatenate([self.score[rows].ravel(), s[a, b].astype(np.int64)])
        ids = np.concatenate([self.ids[rows].ravel(), c[b]])
        order = np.lexsort((ids, ~score, row))
        first = np.searchsorted(row[order], rows)
        keep = order[first[:, None] + np.arange(self.k)]
        self.score[rows], self.ids[rows] = score[keep], ids[keep]
        self.count[rows] = np.minimum(self.k, self.count[rows] + new)

    def batch(self, number: int) -> pa.RecordBatch:
        have = np.arange(self.k) < self.count[:, None]
        return pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(self.q, self.count)), pa.array(self.ids[have]),
             pa.array(np.full(int(self.count.sum()), number, np.int32)), pa.array(self.score[have])],
            names=["query_id", "vec_id", "list", "score"])


def _packed(columns_: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([columns_[f.name]], f.type) for f in PACKED], names=[f.name for f in PACKED])


#: Entries of one block pair and slice: rows and columns of the score matrix, scores.
PACKED = pa.schema([("q_block", pa.int32()), ("block", pa.int32()), ("list", pa.int32()), ("q_ids", pa.binary()),
                    ("ids", pa.binary()), ("at", pa.binary()), ("s", pa.binary())])
PACKED_DDL = "q_block int, block int, list int, q_ids binary, ids binary, at binary, s binary"


def _places(rows: dict, k: int) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(rows["at"][k], np.int64), np.frombuffer(rows["s"][k], np.int64)


def _lacking(lists: int):
    """Of one block pair: the sums of what was reported, as list -1, and for each slice
    the entries that others reported and it did not."""

    def run(t: pa.Table) -> pa.Table:
        rows = t.to_pydict()
        every = {rows["list"][k]: _places(rows, k) for k in range(len(t))}
        union, back = np.unique(np.concatenate([x for x, _ in every.values()]), return_inverse=True)
        total = np.zeros(len(union), np.int64)
        np.add.at(total, back, np.concatenate([s for _, s in every.values()]))
        fixed = {k: rows[k][0] for k in ("q_block", "block", "q_ids", "ids")}
        out = [fixed | {"list": -1, "at": union.tobytes(), "s": total.tobytes()}]
        for i in range(lists):
            lack = np.setdiff1d(union, every[i][0] if i in every else [], assume_unique=True).astype(np.int64)
            if len(lack):
                out.append(fixed | {"list": i, "at": lack.tobytes(), "s": b""})
        return pa.Table.from_pylist(out, schema=PACKED)

    return run


def _ranked(k: int):
    """Of one block pair: each query's k best totals."""

    def run(t: pa.Table) -> pa.Table:
        rows = t.to_pydict()
        at, back = np.unique(np.concatenate([_places(rows, i)[0] for i in range(len(t))]), return_inverse=True)
        total = np.zeros(len(at), np.int64)
        np.add.at(total, back, np.concatenate([_places(rows, i)[1] for i in range(len(t))]))
        i, ids = at >> 32, np.frombuffer(rows["ids"][0], np.int64)[at & (2**32 - 1)]
        order = np.lexsort((ids, -total, i))
        i, ids, total = i[order], ids[order], total[order]
        first = np.searchsorted(i, i)
        keep = np.arange(len(i)) - first < k
        q = np.frombuffer(rows["q_ids"][0], np.int64)[i]
        return pa.table({"query_id": q[keep], "vec_id": ids[keep], "score": total[keep]})

    return run


def search(df: DataFrame, is_query: Column, k: int, id_col: str = "vec_id", vector_col: str = "embedding",
           scale: int = 256, lists: int = LISTS, rows_a_block: int = ROWS, queries_a_block: int = QUERY_ROWS) -> DataFrame:
    """(query_id, rank int, vec_id, score) of the k best other rows for each query row."""
    every = stored(vectors(df, id_col, vector_col, scale), "vectors")
    size = every.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("width")).first()
    n, width = max(1, -(-size["n"] // rows_a_block)), max(size["width"] or 0, lists)
    same = Window.partitionBy("v").orderBy("id")
    able = stored(every.withColumn("r", F.row_number().over(same)).where(F.col("r") <= k + 1).drop("r"), "candidates")
    asked = every.where(is_query)
    right = stored(_blocks(able, n, width, lists), "blocks")
    queries = asked.count()
    parts = max(1, -(-queries // queries_a_block))
    session = df.sparkSession
    tasks = max(int(session.conf.get("spark.sql.shuffle.partitions")), session.sparkContext.defaultParallelism)
    a_query = 8 * -(-width // lists) + 16 * (k + 2)
    grid = _grid(queries, parts, size["n"], n, lists, tasks, a_query)

    def exact(pairs: DataFrame) -> DataFrame:
        """(query_id, vec_id, score) by whole vectors."""
        a = every.select(F.col("id").alias("query_id"), F.col("v").alias("a"))
        b = every.select(F.col("id").alias("vec_id"), F.col("v").alias("b"))
        product = F.zip_with("a", "b", lambda x, y: F.coalesce(x * y, F.lit(0)))
        return pairs.select("query_id", "vec_id").join(merged(a), "query_id").join(merged(b), "vec_id").select(
            "query_id", "vec_id", F.aggregate(product, F.lit(0).cast("long"), lambda t, x: t + x).alias("score"))

    def best(batches):
        for i, asked, rest in _of_cells(batches, grid, width, lists):
            found = {}
            for _, (c, y, _, _), _ in rest:
                for x_block, (q, x, _, _) in asked.items():
                    if x_block not in found:
                        found[x_block] = _Best(q, k)
                    found[x_block].add(c, _scores(x, y))
            yield from (x.batch(i) for x in found.values())

    left = _blocks(asked, parts, width, lists)
    gathered = _cells(left, right, grid, lists).mapInArrow(best, "query_id long, vec_id long, list int, score long")
    top = Window.partitionBy("query_id", "list").orderBy(F.desc("score"), "vec_id")
    gathered = gathered.withColumn("r", F.row_number().over(top)).where(F.col("r") <= k)
    by_score = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    cutoff = exact(gathered.select("query_id", "vec_id").distinct()).withColumn("r", F.row_number().over(by_score))
    cutoff = cutoff.where(F.col("r") == k).select(F.col("query_id").alias("id"), F.col("score").alias("cut"))
    lowest = F.lit(-(2**62)).cast("long")  # fewer than k other rows: everything passes
    asked = stored(asked.join(merged(cutoff), "id", "left").withColumn("cut", F.coalesce("cut", lowest)), "cutoffs")

    left = stored(_blocks(asked, parts, width, lists, ", cut binary"), "blocks")

    def enough(batches):
        for i, asked, rest in _of_cells(batches, grid, width, lists):
            for block, (c, y, ids, _), _ in rest:
                for q_block, (q, x, q_ids, cut) in asked.items():
                    s = _scores(x, y)
                    a, b = np.nonzero(s >= _like(-(-np.frombuffer(cut, np.int64) // lists), s))
                    other = q[a] != c[b]
                    a, b = a[other], b[other]
                    if len(a):
                        yield _packed({"q_block": q_block, "block": block, "list": i, "q_ids": q_ids, "ids": ids,
                                       "at": ((a << 32) | b).tobytes(), "s": s[a, b].astype(np.int64).tobytes()})

    def asked_for(batches):
        for i, asked, rest in _of_cells(batches, grid, width, lists):
            for block, (_, y, ids, _), r in rest:
                if r:
                    _, x, q_ids, _ = asked[r["q_block"]]
                    at = np.frombuffer(r["rest"], np.int64)
                    a, b = at >> 32, at & (2**32 - 1)
                    few = len(at) * x.shape[1] < x.shape[0] * y.shape[0]
                    s = (x[a].astype(np.int64) * y[b]).sum(axis=1) if few else _scores(x, y)[a, b].astype(np.int64)
                    yield _packed({"q_block": r["q_block"], "block": block, "list": i, "q_ids": q_ids, "ids": ids, "at": r["rest"], "s": s.tobytes()})

    pair = ["q_block", "block"]
    found = _cells(left, right, grid, lists).mapInArrow(enough, PACKED_DDL)
    known = stored(found.groupBy(pair).applyInArrow(_lacking(lists), PACKED_DDL), "entries")
    requests = known.where("list >= 0").select(*pair, "list", "at")
    answers = _cells(left, right, grid, lists, requests).mapInArrow(asked_for, PACKED_DDL)
    totals = known.where("list < 0").unionByName(answers).groupBy(pair).applyInArrow(
        _ranked(k), "query_id long, vec_id long, score long")
    return totals.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op9_uniform_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, 5)


#: Distinct vectors need no special case here: SQL ranks all pairs of a query.
ORACLE = """
WITH v AS (
  SELECT vec_id, max(list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT))) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
  GROUP BY vec_id),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda z: coalesce(z[1] * z[2], 0))) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS k FROM s)
SELECT query_id, CAST(k AS INTEGER) AS rank, vec_id, score FROM r WHERE k <= 5
"""
