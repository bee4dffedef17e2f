"""Document fingerprints by locally consistent parsing.

A text's bytes are parsed into phrases, the phrases' names into longer phrases, and so
on. At each level runs of one name become one; deterministic coin tossing turns the
names into small labels in which neighbours differ: twice, a label is replaced by the
lowest bit in which it differs from the one before, and that bit's value. A phrase
begins where a label is lower than both neighbours, and its name is a hash of what it
holds. Where a phrase begins depends on a few names around it only, so equal substrings
are cut alike in their interior, whatever stands before them.

A fingerprint lists the smallest names of the third level, some 30 bytes of text each;
texts with few of those add the second and first level. The likeness of two fingerprints
is the share of names they have in common (twice the common ones over both), estimated
from the names up to the largest one of each full list, which may be cut.

Defined results: null text = empty text, whose fingerprint is empty; equal fingerprints
have likeness 1, an empty and another one 0; texts of any length are parsed whole; rows
with one id follow by their text; a null id comes after all others; an empty table gives
no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermart.llm.common import clean, columns, table

SIZE, LEVELS, FEW = 64, 3, 24
BLOCK = 1 << 20
BUCKET_BYTES, BUCKETS = 2 << 20, 1 << 16
ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * ODD[0]
    x = (x ^ (x >> np.uint64(29))) * ODD[1]
    return x ^ (x >> np.uint64(32))


def _toss(now, before):
    """Twice the lowest differing bit's place, plus the bit's value in `now`."""
    other = now ^ before
    place = np.bitwise_count((other & -other) - other.dtype.type(1))
    return ((place << np.uint8(1)) | ((now >> place) & now.dtype.type(1)).astype(np.uint8)).astype(np.uint8)


with np.errstate(over="ignore"):
    _ALL = np.arange(256, dtype=np.uint8)
    #: Label by (byte before, byte): one toss for two bytes, or for two labels.
    TOSSED = _toss(np.tile(_ALL, 256), np.repeat(_ALL, 256))
BYTES = _mix(np.arange(1, 257, dtype=np.uint64))


def _shifted(x: np.ndarray, first: np.ndarray, fill: int) -> np.ndarray:
    out = np.empty_like(x)
    out[1:] = x[:-1]
    out[first] = fill
    return out


def _level(names: np.ndarray, doc: np.ndarray, raw: bool) -> tuple[np.ndarray, np.ndarray]:
    """Names of the next level's phrases, and the text each is of. raw: names are bytes."""
    fresh = np.empty(len(names), bool)
    fresh[0] = True
    np.not_equal(names[1:], names[:-1], out=fresh[1:])
    fresh[1:] |= doc[1:] != doc[:-1]
    at = np.flatnonzero(fresh)
    run = np.diff(at, append=len(names)).astype(np.uint64)
    names, doc = names[at], doc[at]
    first = np.flatnonzero(np.append(True, doc[1:] != doc[:-1]))
    before = _shifted(names, first, 0)
    if raw:
        label = TOSSED[(before.astype(np.int32) << 8) | names]
        names = BYTES[names]
    else:
        label = _toss(names, before)
    label = TOSSED[(_shifted(label, first, 255).astype(np.int32) << 8) | label]
    begins = np.zeros(len(label), bool)
    begins[1:-1] = (label[1:-1] < label[:-2]) & (label[1:-1] < label[2:])
    last = np.append(first[1:], len(label)) - 1
    begins[last] = False
    begins[first] = True
    starts = np.flatnonzero(begins)
    place = np.arange(len(names)) - np.repeat(starts, np.diff(starts, append=len(names)))
    parts = _mix(names * (run * np.uint64(2) + np.uint64(1)) + place.astype(np.uint64) * ODD[1])
    return _mix(np.add.reduceat(parts, starts)), doc[starts]


def fingerprints(texts: list[bytes], size: int = SIZE) -> list[str]:
    """Fingerprint of each text: per level, the smallest names as 32-bit hex, `size` or a
    quarter of them, whichever is more."""
    out: list[list[str]] = [[] for _ in texts]
    names = np.frombuffer(b"".join(texts), np.uint8)
    doc = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    levels = []
    with np.errstate(over="ignore"):
        for k in range(LEVELS):
            if len(names):
                names, doc = _level(names, doc, k == 0)
            levels.append((names, doc))
    edges = [np.searchsorted(doc, np.arange(len(texts) + 1)) for _, doc in levels]
    for i in range(len(texts)):
        parts = []
        for k in range(LEVELS - 1, -1, -1):
            own = levels[k][0][edges[k][i]:edges[k][i + 1]]
            if len(own):
                own = np.unique(own >> np.uint64(32))
                own = own[:max(size, len(own) // 4)]
                parts.append("".join(map("%08x".__mod__, own.tolist())))
            if len(own) >= FEW:
                break
        out[i] = ".".join(parts)
    return out


def likeness(a: str, b: str, size: int = SIZE) -> float:
    """Share of names that two fingerprints have in common, 0 to 1: over the longest
    phrases, and over shorter ones too as far as both list them."""
    if a == b:
        return 1.0
    common = every = 0.0
    for x, y in zip(a.split("."), b.split("."), strict=False):
        x, y = ({s[k:k + 8] for k in range(0, len(s), 8)} for s in (x, y))
        top = min((max(z) for z in (x, y) if len(z) >= size), default="g")  # a full list may be cut
        least = [n for n in x | y if n <= top]
        both = sum(n in x and n in y for n in least)
        common, every = common + both, every + len(least)
    j = common / every if every else 0.0
    return 2 * j / (1 + j)


def fingerprint(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fingerprint) of every row."""

    def run(batches):
        for batch in columns(batches):
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            for a in range(0, len(texts), 500):
                part = texts[a:a + 500]
                yield pa.RecordBatch.from_arrays([batch.column(0)[a:a + 500], pa.array(fingerprints(part))], names=["doc_id", "fingerprint"])

    rows = clean(df, id_col, text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, fingerprint string").withColumnRenamed("doc_id", id_col)


def beside_next(rows: DataFrame) -> DataFrame:
    """Rows (doc_id, text) dealt out by ranges of the id, in descending order within
    (bucket, tail): after a bucket's rows, marked tail, stands the row that comes next,
    the next bucket's first or, after the last bucket, the first of all. One shuffle of
    the texts; only the ranges' limits and their largest ids go through the driver."""
    spark = rows.sparkSession
    size = rows.agg(F.sum(F.octet_length("text")).alias("bytes")).first()["bytes"] or 0
    n = max(1, -(-size // max(BUCKET_BYTES, size // BUCKETS)))
    edges = rows.approxQuantile("doc_id", [k / n for k in range(1, n)], 0.25 / n) if n > 1 else []
    edges = np.array(sorted(set(edges)), np.float64)

    @F.pandas_udf("int")
    def bucket(x: pd.Series) -> pd.Series:
        return pd.Series(np.where(x.isna(), -1, np.searchsorted(edges, x.to_numpy(float, na_value=-np.inf), "right")).astype(np.int32))

    dealt = rows.select(bucket("doc_id").alias("bucket"), "doc_id", "text", F.lit(0).alias("tail"))
    heads = rows.select(bucket("doc_id").alias("bucket"), "doc_id").groupBy("bucket").agg(F.max("doc_id").alias("id")).orderBy("bucket").collect()
    if not heads:
        return dealt
    to = [(h["id"], heads[(k + 1) % len(heads)]["bucket"]) for k, h in enumerate(heads)]  # a row a bucket
    goes = F.broadcast(spark.createDataFrame(to, f"head {rows.schema['doc_id'].dataType.simpleString()}, bucket int"))
    tails = rows.join(goes, F.col("doc_id").eqNullSafe(F.col("head"))).select("bucket", "doc_id", "text", F.lit(1).alias("tail"))
    return dealt.unionByName(tails).repartition("bucket").sortWithinPartitions("bucket", "tail", F.desc_nulls_last("doc_id"), "text")


def edited_texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next) of every row; the edited text has the next row's beginning as its end."""

    def finish(ids: list, texts: list[str], following: str):
        """Rows of consecutive texts; `following` comes after the last."""
        after = [*texts[1:], following]
        edited = [(t[:len(t) - len(t) // 2] + u[:len(t) // 2]).encode() for t, u in zip(texts, after, strict=True)]
        marks = fingerprints([t.encode() for t in [*texts, following]])
        changed = fingerprints(edited)
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, kind), pa.array([len(t) for t in texts], pa.int64()),
             pa.array([hashlib.sha256(e).hexdigest() for e in edited]), pa.array(marks[:-1]), pa.array(changed),
             pa.array([likeness(a, b) for a, b in zip(marks[:-1], changed, strict=True)], pa.float64()),
             pa.array([likeness(a, b) for a, b in zip(marks[:-1], marks[1:], strict=True)], pa.float64())], names=names)

    def run(batches):
        ids, texts, size, now = [], [], 0, None
        for batch in columns(batches):
            for bucket, id_, text, tail in zip(*(batch.column(c).to_pylist() for c in ("bucket", "doc_id", "text", "tail")), strict=True):
                if texts and (tail or bucket == now) and (tail or size >= BLOCK):
                    yield finish(ids, texts, text)
                    ids, texts, size = [], [], 0
                now = bucket
                if not tail:
                    ids.append(id_)
                    texts.append(text)
                    size += len(text)

    from pyspark.sql.pandas.types import to_arrow_type

    rows = clean(df, id_col, text_col)
    kind = to_arrow_type(rows.schema["doc_id"].dataType)
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    ddl = (f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_chars long, edited_sha256 string, fingerprint string, "
           "edited_fingerprint string, near_edited double, near_next double")
    return beside_next(rows).mapInArrow(run, ddl).withColumnRenamed("doc_id", id_col)


def op2_consistent_parsing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_texts(table(spark, sf_dir, "documents"))
