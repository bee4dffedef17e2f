"""Exact ranked lexical search by range-maximum sparse tables over posting lists.

The queries come in blocks of bounded size, whose terms go to all tasks. One scan of the documents
writes, per block of texts, the posting lists of these terms; sums over them give the statistics
and so the terms' weights and the postings' impacts. Then each block of documents is searched where it is:

* A sparse table over the concatenated posting lists answers in two lookups where the largest impact
  of a list's postings within an interval of documents stands.
* The sum of a query's weighted answers bounds every document of the interval from above. Best
  first, an interval is split at the document of its largest single answer: that document is
  scored exactly, the two rests get bounds of their own, and rests below the query's k-th best
  score so far end. Several intervals are split at a time, as columns of numpy arrays.
* A task carries its best scores from block to block; a ranking limited to k per query joins them.

Documents lie by rising id in their block, so that an interval whose bound only equals the k-th
score ends too if its ids come later: ties, as of many copies, cost nothing.

Defined results: terms are maximal runs of ASCII letters and digits and non-ASCII characters,
only A-Z lower-cased; null or empty texts have no terms and never match; a query without known
terms has no rows; repeated documents rank each; null ids rank last among equal scores; each row
of the queries is a query, also with a repeated or null id; empty tables give no rows; other
columns are never read.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordermart.llm.common import LOWER, binary_array, byte_rows, columns, row_groups, stored, table

TOP = 10
QUERY_BYTES = 4 << 20  # query texts of one block (or one longer text)
SPLITS = 128  # intervals split at a time
TERM = np.zeros(256, bool)
TERM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
INDEX = "lengths binary, with_terms long, n_terms long, numbers binary, sizes binary, docs binary, tf binary"


def terms(column: pa.Array) -> Iterator[tuple[int, int, pa.Array, np.ndarray, np.ndarray]]:
    """(first row, row after the last, distinct terms, code of every term, terms before each row)."""
    raw, offsets = byte_rows(column)
    for a, b in row_groups(offsets, 8 << 20):
        data, rows = raw[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]
        inside = TERM[data]
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        at_row = rows[:-1][rows[:-1] < rows[1:]]
        begins[at_row] = inside[at_row]
        kept = LOWER[data[inside]]
        at = np.append(np.flatnonzero(begins[inside]), len(kept))
        words = binary_array(kept, at).dictionary_encode()
        yield a, b, words.dictionary, words.indices.to_numpy(), np.searchsorted(np.flatnonzero(begins), rows)


def _index(docs: DataFrame, vocabulary: list[bytes]) -> DataFrame:
    """A row a block of documents: their ids in order, term counts and the posting lists."""
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)  # the terms of QUERY_BYTES of queries

    def run(batches):
        known = pa.array(sent.value, pa.binary())
        for batch in columns(batches):
            for a, b, words, codes, rows in terms(batch.column(1)):
                ids = batch.column(0)[a:b]
                order = pc.sort_indices(ids, null_placement="at_end").to_numpy()
                place = np.empty(b - a, np.int64)
                place[order] = np.arange(b - a)
                count = np.diff(rows)
                number = pc.fill_null(pc.index_in(words, known), -1).to_numpy().astype(np.int64)[codes]
                doc = np.repeat(place, count)[number >= 0]
                key, tf = np.unique(number[number >= 0] * (b - a) + doc, return_counts=True)
                numbers, sizes = np.unique(key // (b - a), return_counts=True)
                binary = [x.astype(np.int32).tobytes() for x in (numbers, sizes, key % (b - a), tf)]
                yield pa.RecordBatch.from_arrays(
                    [pa.ListArray.from_arrays([0, b - a], ids.take(pa.array(order))), pa.array([count[order].astype(np.int32).tobytes()], pa.binary()),
                     pa.array([int((count > 0).sum())]), pa.array([int(count.sum())]), *(pa.array([x], pa.binary()) for x in binary)],
                    names=["ids", "lengths", "with_terms", "n_terms", "numbers", "sizes", "docs", "tf"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"ids array<{kind}>, {INDEX}")


def _statistics(index: DataFrame) -> tuple[int, int, dict[int, int]]:
    """Documents with terms, all terms, and each query term's documents."""

    def run(batches):
        df: Counter = Counter()
        for batch in columns(batches):
            for numbers, sizes in zip(batch.column(0), batch.column(1), strict=True):
                df.update(dict(zip(np.frombuffer(numbers.as_py(), np.int32).tolist(), np.frombuffer(sizes.as_py(), np.int32).tolist(), strict=True)))
        yield pa.RecordBatch.from_arrays([pa.array(df.keys(), pa.int32()), pa.array(df.values(), pa.int64())], names=["number", "df"])

    n, every = index.agg(F.sum("with_terms"), F.sum("n_terms")).first()
    df = index.select("numbers", "sizes").mapInArrow(run, "number int, df long").groupBy("number").agg(F.sum("df").alias("df"))
    return n or 0, every or 0, {r["number"]: r["df"] for r in df.toLocalIterator()}


class Postings:
    """The posting lists of a block of documents and their sparse table."""

    def __init__(self, ids: list, lengths: np.ndarray, numbers: np.ndarray, sizes: np.ndarray, docs: np.ndarray,
                 tf: np.ndarray, n: int, every: int):
        self.ids, self.docs = ids, docs
        m = 25 + 75 * lengths.astype(np.int64) * n // every
        tf = tf.astype(np.int64)
        self.impact = 1_000_000_000 * tf // (1000 * tf + 8 * m[docs])
        self.key = np.repeat(numbers.astype(np.int64), sizes) * len(ids) + docs
        ends = np.cumsum(sizes, dtype=np.int64)
        self.where = {k: (b - s, b) for k, s, b in zip(numbers.tolist(), sizes.tolist(), ends.tolist(), strict=True)}
        most = int(sizes.max()) if len(sizes) else 0
        self.log = np.zeros(most + 1, np.int64)  # whole part of the logarithm of each length
        for k in range(1, max(1, most).bit_length()):
            self.log[1 << k:] = k
        level = np.arange(len(docs), dtype=np.int32)
        levels = [level]
        for k in range(1, max(1, most).bit_length()):  # place of the largest impact of 2^k postings
            half = 1 << (k - 1)
            x, y = level[:-half], level[half:]
            level = np.append(np.where(self.impact[x] >= self.impact[y], x, y), level[len(x):])
            levels.append(level)
        self.best_of = np.concatenate(levels) if len(docs) else np.empty(0, np.int32)

    def bounds(self, a: np.ndarray, b: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bound, document to split at) of intervals with postings a to b of each term."""
        some = b > a
        k = self.log[np.where(some, b - a, 0)]
        base = k * len(self.docs)
        x = self.best_of[np.where(some, base + a, 0)]
        y = self.best_of[np.where(some, base + b - (1 << k), 0)]
        left, right = self.impact[x], self.impact[y]
        value = np.where(some, np.maximum(left, right) * weight, 0)
        top = value.argmax(axis=1)
        rows = np.arange(len(a))
        place = np.where(left[rows, top] >= right[rows, top], x[rows, top], y[rows, top])
        return value.sum(axis=1), self.docs[place]

    def search(self, query: dict[int, int], best: list, top: int, splits: int = SPLITS) -> list:
        """best, (-score, id is null, id) rising, and this block's documents: the `top` first.
        query: weight of each term, times its number in the query."""
        known = [(k, w) for k, w in query.items() if w > 0 and k in self.where]
        if not known:
            return best
        number, weight = (np.array(x, np.int64) for x in zip(*known, strict=True))
        number *= len(self.ids)
        a, b = (np.array([x], np.int64) for x in zip(*(self.where[k] for k, _ in known), strict=True))
        low = np.zeros(1, np.int64)
        bound, doc = self.bounds(a, b, weight)
        while True:
            least = -best[-1][0] if len(best) >= top else 0
            open_ = bound > least
            if len(best) >= top:
                worst = best[-1][1:]
                for i in np.flatnonzero(bound == least).tolist():
                    open_[i] = self._rank(int(low[i])) < worst
            if not open_.all():
                a, b, low, bound, doc = a[open_], b[open_], low[open_], bound[open_], doc[open_]
            if not len(bound):
                return best
            chosen = np.arange(len(bound)) if len(bound) <= splits else np.argpartition(bound, -splits)[-splits:]
            ca, cb, cl, cd = a[chosen], b[chosen], low[chosen], doc[chosen].astype(np.int64)
            middle = np.searchsorted(self.key, number + cd[:, None])
            has = middle < cb
            has[has] = self.docs[middle[has]] == np.broadcast_to(cd[:, None], has.shape)[has]
            score = np.where(has, self.impact[np.where(has, middle, 0)] * weight, 0).sum(axis=1)
            good = np.flatnonzero(score >= max(1, least))
            if len(good):
                found = [(-int(score[i]), *self._rank(int(cd[i]))) for i in good.tolist()]
                best = heapq.nsmallest(top, best + found)
            rest = np.ones(len(bound), bool)
            rest[chosen] = False
            na, nb, nl = np.concatenate([ca, middle + has]), np.concatenate([middle, cb]), np.concatenate([cl, cd + 1])
            nbound, ndoc = self.bounds(na, nb, weight)
            go = nbound >= max(1, least)
            a, b, low = np.concatenate([a[rest], na[go]]), np.concatenate([b[rest], nb[go]]), np.concatenate([low[rest], nl[go]])
            bound, doc = np.concatenate([bound[rest], nbound[go]]), np.concatenate([doc[rest], ndoc[go]])

    def _rank(self, doc: int) -> tuple:
        id_ = self.ids[doc] if doc < len(self.ids) else None
        return (True, 0) if id_ is None else (False, id_)


def _query_blocks(items: DataFrame, size: int) -> Iterator[tuple[list, list[Counter]]]:
    """(ids, terms) of the queries, about `size` bytes of texts at a time."""
    ids, texts, held = [], [], 0
    for r in items.toLocalIterator():
        ids.append(r["item_id"])
        texts.append(r["text"])
        held += len(r["text"])
        if held >= size:
            yield ids, _query_terms(texts)
            ids, texts, held = [], [], 0
    if ids:
        yield ids, _query_terms(texts)


def _query_terms(texts: list[str]) -> list[Counter]:
    out = []
    for _, _, words, codes, rows in terms(pa.array(texts, pa.string())):
        words = words.to_pylist()
        out += [Counter(words[c] for c in codes[x:y].tolist()) for x, y in zip(rows[:-1], rows[1:], strict=True)]
    return out


def _hits(index: DataFrame, queries: list[dict[int, int]], n: int, every: int, top: int) -> DataFrame:
    """(query, doc_id, score): each task's best documents of each query."""
    sent = index.sparkSession.sparkContext.broadcast(queries)
    id_type = index.schema["ids"].dataType.elementType

    def run(batches):
        best: list[list] = [[] for _ in sent.value]
        for batch in columns(batches):
            for r in batch.to_pylist():
                parts = [np.frombuffer(r[c], np.int32) for c in ("lengths", "numbers", "sizes", "docs", "tf")]
                block = Postings(r["ids"], *parts, n, every)
                best = [block.search(q, found, top) for q, found in zip(sent.value, best, strict=True)]
        rows = [(q, None if null else id_, -score) for q, found in enumerate(best) for score, null, id_ in found]
        if rows:
            q, ids, score = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(q, pa.int32()), pa.array(ids, to_arrow_type(id_type)), pa.array(score, pa.int64())],
                                             names=["query", "doc_id", "score"])

    from pyspark.sql.pandas.types import to_arrow_type

    schema = T.StructType([T.StructField("query", T.IntegerType()), T.StructField("doc_id", id_type), T.StructField("score", T.LongType())])
    return index.select("ids", "lengths", "numbers", "sizes", "docs", "tf").mapInArrow(run, schema)


def search(documents: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
           item_text_col: str = "text", top: int = TOP, query_bytes: int = QUERY_BYTES) -> DataFrame:
    """(item id, rank, document id, score) of each item's `top` documents."""
    spark = documents.sparkSession
    docs = documents.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    items = items.select(F.col(item_col).alias("item_id"), F.coalesce(F.col(item_text_col), F.lit("")).alias("text"))
    best = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    name = T.StructType([T.StructField("query", T.IntegerType()), items.schema["item_id"]])
    out = []
    for ids, queries in _query_blocks(items, query_bytes):
        vocabulary = sorted(set().union(*queries))
        index = stored(_index(docs, vocabulary), "postings")
        n, every, df = _statistics(index)
        number = {word: k for k, word in enumerate(vocabulary)}
        weight = {k: math.floor(1000 * math.log((2 * n + 2) / (2 * c + 1))) for k, c in df.items()}
        weighted = [{number[w]: weight[number[w]] * c for w, c in q.items() if number[w] in weight} for q in queries]
        ranked = _hits(index, weighted, n, every, top).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
        names = F.broadcast(spark.createDataFrame(list(enumerate(ids)), name))  # one block's queries
        out.append(ranked.join(names, "query").select(F.col("item_id").alias(item_col), "rank", F.col("doc_id").alias(id_col), "score"))
    if not out:
        schema = T.StructType([T.StructField(item_col, items.schema["item_id"].dataType), T.StructField("rank", T.IntegerType()),
                               T.StructField(id_col, docs.schema["doc_id"].dataType), T.StructField("score", T.LongType())])
        return spark.createDataFrame([], schema)
    return reduce(DataFrame.unionByName, out)


def op13_range_maximum_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


#: Every document scored outright, which the small tables allow.
ORACLE = r"""
with words as (
  select doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') w
  from documents where text is not null),
docs as (select row_number() over () d, doc_id, w, len(w) n from words where len(w) > 0),
size as (select count(*)::bigint nn, sum(n)::bigint l from docs),
tf as (select d, t, count(*) tf from (select d, unnest(w) t from docs) group by d, t),
queries as (
  select item_id, t, count(*) q from (
    select item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) t
    from benchmark) group by item_id, t),
weights as (select t, floor(1000 * ln((2 * nn + 2)::double / (2 * count(*) + 1)::double))::bigint w from tf, size group by t, nn),
lengths as (select d, doc_id, 25 + (75 * n * nn) // l m from docs, size),
scores as (
  select item_id, doc_id, sum(q * w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::bigint score
  from queries join tf using (t) join weights using (t) join lengths using (d) group by item_id, d, doc_id)
select item_id, (row_number() over (partition by item_id order by score desc, doc_id))::int rank, doc_id, score
from scores where score > 0 qualify rank <= 10
"""
