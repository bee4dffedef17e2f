"""Helpers shared by the document operators: tables, shared scratch folders, Arrow columns."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


BATCH_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table, read in a session whose Arrow batches stay small beside the Python workers."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder that driver and executors share: below spark.checkpoint.dir
    where the session names one; a temporary folder only for a local master."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.gettempdir()
    return f"{base}/llm-{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """Write df once to the shared folder and read it back: cuts the lineage, so a
    lost executor costs a reread and not the whole history."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the files of a table made by stored(), once nothing reads it any more."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    for file in df.inputFiles()[:1]:
        path = jvm.org.apache.hadoop.fs.Path(file).getParent()
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def clean(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only the two named columns, under fixed names; a null text counts as empty.
    Whatever other columns df has, also clashing ones, stay out of the way."""
    return df.select(F.col(id_col).alias("doc_id"),
                     F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def added(df: DataFrame, **fields: T.DataType) -> T.StructType:
    """df's schema with more fields."""
    return T.StructType([*df.schema.fields, *(T.StructField(k, v) for k, v in fields.items())])


def with_id(rows: DataFrame, fields: str) -> T.StructType:
    """Schema of rows' doc_id, of whatever type, and more fields given as DDL."""
    return T.StructType([T.StructField("doc_id", rows.schema["doc_id"].dataType), *T.StructType.fromDDL(fields).fields])


def byte_rows(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Buffer of a string or binary column without nulls, as bytes, and row offsets."""
    kind = np.int64 if column.type in (pa.large_string(), pa.large_binary()) else np.int32
    offsets = np.frombuffer(column.buffers()[1], kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def binary_array(data: np.ndarray, offsets: np.ndarray, kind: pa.DataType | None = None) -> pa.Array:
    """Arrow binary (or string) column over one contiguous buffer."""
    return pa.Array.from_buffers(kind or pa.binary(), len(offsets) - 1,
                                 [None, pa.py_buffer(offsets.astype(np.int32).tobytes()),
                                  pa.py_buffer(np.ascontiguousarray(data).tobytes())])


def spans(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions start, start+1, ... of each span, one span after another."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(total)


class WordIds(dict):
    """Numbers words in order of first sight; indexing an unknown word adds it."""

    def __missing__(self, word):
        n = self[word] = len(self)
        return n


class IdTable:
    """Token ids of distinct words, kept from batch to batch of one Python worker.

    encode(list of new words) -> (flat ids, length per word). The table starts
    afresh when it holds more than `most` words or bytes of them, which bounds it."""

    def __init__(self, encode, most: int = 400_000, most_bytes: int = 32 << 20):
        self.encode, self.most, self.most_bytes = encode, most, most_bytes
        self.reset()

    def reset(self) -> None:
        self.words = WordIds()
        self.known = self.size = 0
        self.flat = np.empty(0, np.int32)
        self.start = np.empty(0, np.int64)
        self.length = np.empty(0, np.int64)

    def number(self, words) -> np.ndarray:
        return np.fromiter(map(self.words.__getitem__, words), np.int32)

    def learn(self) -> None:
        """Encode the words numbered since the last call."""
        new = list(islice(self.words, self.known, None))
        for k in range(0, len(new), 100_000):
            part = new[k:k + 100_000]
            ids, length = self.encode(part)
            self.start = np.concatenate([self.start, len(self.flat) + np.cumsum(length) - length])
            self.length = np.concatenate([self.length, length])
            self.flat = np.concatenate([self.flat, ids.astype(np.int32)])
            self.size += sum(map(len, part))
        self.known = len(self.words)

    def ids_of(self, words: list, codes: np.ndarray, offsets: np.ndarray,
               limit: int = 250_000) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """Ids of a block of word_blocks(): (first row, row after the last, ids end to
        end, row offsets), a part of about `limit` words, or one longer row, at a time."""
        if len(self.words) > self.most or self.size > self.most_bytes:
            self.reset()
        numbers = self.number(words)
        self.learn()
        for a, b in row_groups(offsets, limit):
            every = numbers[codes[offsets[a]:offsets[b]]]
            length = self.length[every]
            ends = np.concatenate([[0], np.cumsum(length)])
            yield a, b, self.flat[spans(self.start[every], length)], ends[offsets[a:b + 1] - offsets[a]]


def row_groups(offsets: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows that hold about `limit` elements, or one longer row."""
    a = 0
    while a < len(offsets) - 1:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + limit, "right")) - 1)
        yield a, b
        a = b


SPACE = np.zeros(256, bool)
SPACE[[32, *range(9, 14)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def word_blocks(column: pa.Array, lower: bool = False, limit: int = 8 << 20, spaced: bool = False,
                cuts: Callable[[np.ndarray], np.ndarray] | None = None) -> Iterator[tuple[int, int, pa.Array, np.ndarray, np.ndarray]]:
    """Words between ASCII white space, a block of rows at a time: (first row, row
    after the last, distinct words, code of every word, words before each row).
    A block has about `limit` bytes, or one longer row. spaced: each word begins with
    the white space before it (what ends a row is a word too). cuts: places in the
    bytes where a word is cut in two (without spaced)."""
    raw, offsets = byte_rows(column)
    for a, b in row_groups(offsets, limit):
        data, rows = raw[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]
        space = SPACE[data]
        begins = np.ones(len(data) + 1, bool)
        begins[1:] = space if len(data) else True
        begins[rows] = True
        begins = begins[:-1]
        if spaced:
            begins = space & ~np.append(False, space[:-1])
            begins[rows[:-1][rows[:-1] < rows[1:]]] = True
            kept, at = data, np.append(np.flatnonzero(begins), len(data))
        else:
            begins &= ~space
            if cuts:
                begins |= cuts(data)
            kept = data[~space]
            at = np.append(np.flatnonzero(begins[~space]), len(kept))
        starts = np.flatnonzero(begins)
        words = binary_array(LOWER[kept] if lower else kept, at).dictionary_encode()
        yield a, b, words.dictionary, words.indices.to_numpy(), np.searchsorted(starts, rows)


def columns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches that have rows."""
    return (b for b in batches if b.num_rows)
