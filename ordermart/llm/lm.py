"""Document log-likelihoods by a class-factored gated recurrent model.

Counts: every training text's words are counted on Spark. The commonest `heads` words
are the model's head words; all others fall into tail classes by their last bytes.
Training: each task runs truncated backpropagation over its own training texts from the
same start and the replicas' parameters are averaged, weighted by their tokens; then a
second pass of tasks goes on from the average over the other training texts, so each
training text is learned from once. Scoring: state is carried through each whole text.

    p(token | past) = p(class | state) * p(word | class, state)     for a head word
    p(token | past) = p(class | state) * (c - D) / tokens of class  for a tail word
    ... * D * words of class / tokens of class                      for an unknown word

with absolute discount D from the counts of words seen once and twice. The counts of the
commonest `known` words are sent to the tasks, a fixed bound; the rarer words of each
text are joined with the count table, keyed by word hash, and summed up by text.

Defined results: null text = empty text = its end alone; a null id counts as a training
row; rows are scored each, also repeated ones; without training rows V = N = 0 and all
words are unknown; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermart.llm import gru
from ordermart.llm.common import byte_rows, clean, columns, row_groups, stored, table, word_blocks

HEADS, TAILS, KNOWN = 2048, 32, 200_000
END = b" "  # no word has white space
CHUNK = 2_000_000
PARTS = 64
ROUNDS = 4  # share of the first pass: one of so many hash classes


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 10 == 0, F.lit(False))


def tail_of(words: list[bytes] | pa.Array, tails: int) -> np.ndarray:
    """Tail class of each word, by its last two bytes."""
    data, edge = byte_rows(words if isinstance(words, pa.Array) else pa.array(words, pa.binary()))
    if not len(data):
        return np.zeros(len(words), np.int64)
    ends = np.maximum(edge[1:], 1)
    last = data[ends - 1].astype(np.uint32) << 8
    last = np.where(np.diff(edge) > 1, last | data[np.maximum(ends - 2, 0)], data[ends - 1].astype(np.uint32))
    return ((last * np.uint32(2654435761)) >> np.uint32(16)).astype(np.int64) % tails


def _hash(w: bytes) -> int:
    h = xxhash.xxh64_intdigest(w, seed=42)
    return h - (1 << 64) if h >> 63 else h


def word_counts(texts: DataFrame) -> DataFrame:
    """(word binary, c) of (text): each text's words and one end."""

    def run(batches):
        for batch in columns(batches):
            for _, _, words, codes, rows in word_blocks(batch.column(0), lower=True):
                n = np.append(np.bincount(codes, minlength=len(words)), len(rows) - 1)
                yield pa.RecordBatch.from_arrays([pa.concat_arrays([words, pa.array([END], words.type)]), pa.array(n)], names=["word", "c"])

    return texts.mapInArrow(run, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


@dataclass
class Vocabulary:
    """The commonest words by count: numbers 0 to heads - 1 are head words (0 is the
    end), the others know their count. mass, types: tokens and words of the tail classes."""

    words: list[bytes]
    counts: np.ndarray
    tails: int
    mass: np.ndarray
    types: np.ndarray
    discount: float
    tokens: int
    distinct: int
    heads: int

    def known(self, most: int | None = None) -> pa.Array:
        return pa.array(self.words[:most], pa.binary())

    def start(self) -> dict[str, np.ndarray]:
        return gru.start(self.heads, self.tails, np.append(self.counts[:self.heads], self.mass))


def vocabulary(counts: DataFrame, heads: int = HEADS, tails: int = TAILS, known: int = KNOWN) -> Vocabulary:
    once = [F.sum((F.col("c") == k).cast("long")) for k in (1, 2)]
    n, v, n1, n2 = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*"), *once).first()
    step = F.floor(F.log2(F.col("c").cast("double")) * 8).cast("int")  # eighths of a doubling: a few hundred
    least, so_far = 1 << 30, 0
    for r in sorted(counts.groupBy(step.alias("step")).agg(F.count("*").alias("k")).collect(), reverse=True):
        so_far += r["k"]
        if so_far > known:
            break
        least = r["step"]
    top = counts.where((step >= least) | (F.col("word") == F.lit(END))).toArrow()  # at most known + 1 rows
    top = sorted(zip(top["word"].to_pylist(), top["c"].to_pylist(), strict=True), key=lambda x: (x[0] != END, -x[1], x[0]))
    words, c = [w for w, _ in top], np.array([k for _, k in top], np.int64)
    heads = max(1, min(heads, len(words)))
    if not words:
        words, c = [END], np.zeros(1, np.int64)
    last, before = F.substring("word", -1, 1), F.when(F.length("word") > 1, F.substring("word", -2, 1))
    per = counts.where(F.col("word") != F.lit(END)).groupBy(last.alias("y"), before.alias("x")).agg(
        F.sum("c").alias("c"), F.count("*").alias("t")).toArrow()  # two bytes: at most 2**16 rows
    mass, types = np.zeros(tails), np.zeros(tails)
    if len(per):
        at = tail_of([(x or b"") + y for x, y in zip(per["x"].to_pylist(), per["y"].to_pylist(), strict=True)], tails)
        np.add.at(mass, at, per["c"].to_numpy())
        np.add.at(types, at, per["t"].to_numpy())
    inner = words[1:heads]
    if inner:
        np.subtract.at(mass, tail_of(inner, tails), c[1:heads])
        np.subtract.at(types, tail_of(inner, tails), 1)
    discount = (n1 or 0) / max(1, (n1 or 0) + 2 * (n2 or 0))
    return Vocabulary(words, c, tails, mass, types, min(max(discount, 0.1), 0.9), int(n), int(v), heads)


def _shares(v: Vocabulary, count, tail):
    """Probability of a tail word with this training count within its class. A class
    that training never saw has unknown words only."""
    mass, types = v.mass[tail], v.types[tail]
    rest = np.where(mass > 0, v.discount * types / np.maximum(1, mass), 1.0)
    return np.where(count > 0, (count - v.discount) / np.maximum(1, mass), rest)


def _texts(batches, known: pa.Array, v: Vocabulary):
    """Per block: (batch, first row, row after the last, words, numbers in `known` or -1, model
    ids of the words, codes, row offsets). known: the vocabulary's words, the head words at least."""
    for batch in batches:
        for a, b, words, codes, rows in word_blocks(batch.column("text"), lower=True):
            classes = v.heads + tail_of(words, v.tails)
            place = pc.fill_null(pc.index_in(words, known), -1).to_numpy().astype(np.int64)
            ids = np.where((place < 0) | (place >= v.heads), classes, place)
            yield batch, a, b, words, place, ids.astype(np.int32), codes, rows


def _ended(ids: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Token ids with an end (0) after each text, and the new row offsets."""
    at = rows[1:] + np.arange(len(rows) - 1)
    out = np.zeros(len(ids) + len(rows) - 1, np.int32)
    body = np.ones(len(out), bool)
    body[at] = False
    out[body] = ids
    return out, np.append(0, at + 1)


def trained(texts: DataFrame, v: Vocabulary, p: dict) -> dict:
    """Parameters after one pass of each task over its texts, averaged."""
    sent = texts.sparkSession.sparkContext.broadcast((v, p))
    names, sizes = list(p), [x.size for x in p.values()]

    def run(batches):
        voc, first = sent.value
        own = {k: x.copy() for k, x in first.items()}
        square = {k: np.full_like(x, 1e-8) for k, x in own.items()}
        heads, tokens = voc.known(voc.heads), 0
        held, count = [], 0

        def learn():
            ids = np.concatenate([x for x, _ in held])
            length = np.concatenate([np.diff(r) for _, r in held])
            gru.train(own, ids, np.append(0, np.cumsum(length)), voc.heads, square)
            held.clear()

        for _, _, _, _, _, ids, codes, rows in _texts(columns(batches), heads, voc):
            held.append(_ended(ids[codes], rows))
            count += len(held[-1][0])
            tokens += len(held[-1][0])
            if count >= CHUNK:
                learn()
                count = 0
        if held:
            learn()
        if tokens:
            flat = np.concatenate([own[k].ravel() for k in names])
            parts = np.array_split(flat, PARTS)
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(PARTS), pa.int32()), pa.array(np.full(PARTS, TaskContext.get().partitionId(), np.int32)),
                 pa.array(np.full(PARTS, tokens)), pa.array([x.tobytes() for x in parts], pa.binary())], names=["part", "task", "n", "p"])

    def mean(t: pa.Table) -> pa.Table:
        t = t.sort_by("task")
        weight = t["n"].to_numpy().astype(float)
        total = sum(w * np.frombuffer(x, np.float32) for w, x in zip(weight, t["p"].to_pylist(), strict=True))
        return pa.table({"part": t["part"][:1], "p": pa.array([(total / weight.sum()).astype(np.float32).tobytes()], pa.binary())})

    rows = texts.mapInArrow(run, "part int, task int, n long, p binary").groupBy("part").applyInArrow(mean, "part int, p binary")
    found = {r["part"]: r["p"] for r in rows.collect()}  # one model
    if not found:
        return p
    flat = np.concatenate([np.frombuffer(found[k], np.float32) for k in range(PARTS)])
    return {k: x.reshape(p[k].shape).copy() for k, x in zip(names, np.split(flat, np.cumsum(sizes)[:-1]), strict=True)}


def score(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", heads: int = HEADS, tails: int = TAILS,
          known: int = KNOWN) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row."""
    docs = clean(df, id_col, text_col).withColumn("held_out", held_out(F.col("doc_id")))
    learn = docs.where("not held_out")
    counts = stored(word_counts(learn.select("text")), "counts")
    v = vocabulary(counts, heads, tails, known)
    early = F.xxhash64("doc_id") % ROUNDS == 0
    p = v.start()
    for part in (early, ~F.coalesce(early, F.lit(False))):
        p = trained(learn.where(part).select("text"), v, p)
    sent = df.sparkSession.sparkContext.broadcast((v, p))
    floor = 0.1 * (v.distinct + 1) + v.tokens

    def run(batches):
        voc, model = sent.value
        known, uid = voc.known(), TaskContext.get().partitionId() << 33
        for batch, a, b, words, place, ids, codes, rows in _texts(columns(batches), known, voc):
            count = np.where(place >= 0, voc.counts[np.maximum(place, 0)], 0)
            rare = place < 0
            tail = np.maximum(ids - voc.heads, 0)
            # per distinct word: base term and the share within its tail class; the rare ones' come by the join
            base = np.where(rare, 0.0, np.log10((count + 0.1) / floor))
            share = np.where(rare | (ids < voc.heads), 0.0, np.log10(np.maximum(_shares(voc, count, tail), 1e-300)))
            hashes = np.zeros(len(words), np.int64)
            hashes[rare] = [_hash(w) for w in words.filter(pa.array(rare)).to_pylist()]
            for i, j in row_groups(rows, CHUNK):
                part, edge = codes[rows[i]:rows[j]], rows[i:j + 1] - rows[i]
                tokens, ends = _ended(ids[part], edge)
                sums = [np.append(0.0, np.cumsum(x)) for x in (gru.score(model, tokens, ends, voc.heads), base[part], share[part], ~rare[part])]
                at = [ends, edge, edge, edge]
                net, low, within, seen = (x[e[1:]] - x[e[:-1]] for x, e in zip(sums, at, strict=True))
                keys = uid + np.arange(j - i)
                uid += j - i
                n = np.diff(ends)
                end = math.log10((float(voc.counts[0]) + 0.1) / floor)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys), batch.column("doc_id")[a + i:a + j], batch.column("held_out")[a + i:a + j], pa.nulls(j - i, pa.int64()),
                     pa.nulls(j - i, pa.int32()), pa.array(n), pa.array((seen + (voc.counts[0] > 0)).astype(np.int64)),
                     pa.array(low + end), pa.array(net + within)], names=NAMES)
                # rare words: (text, word hash) and how often
                places = np.flatnonzero(rare[part])
                row = np.searchsorted(edge, places, "right") - 1
                pair, times = np.unique(row * len(words) + part[places], return_counts=True)
                row, word = np.divmod(pair, max(1, len(words)))
                m = len(pair)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[row]), pa.nulls(m, batch.schema.field("doc_id").type), pa.nulls(m, pa.bool_()),
                     pa.array(hashes[word]), pa.array(tail[word].astype(np.int32)), pa.array(times),
                     pa.nulls(m, pa.int64()), pa.nulls(m, pa.float64()), pa.nulls(m, pa.float64())], names=NAMES)

    kind = docs.schema["doc_id"].dataType.simpleString()
    out = stored(docs.mapInArrow(run, f"uid long, doc_id {kind}, held_out boolean, h long, tail int, n long, known long, base double, score double"), "parts")
    whole = out.where("h is null")
    rare = out.where("h is not null").select("uid", "h", "tail", "n")
    table_ = counts.select(F.xxhash64("word").alias("h"), "c")
    c = F.coalesce("c", F.lit(0))
    per = df.sparkSession.createDataFrame(
        [(k, float(v.mass[k]), float(_shares(v, np.zeros(1), np.array([k]))[0])) for k in range(tails)], "tail int, mass double, unseen double")
    found = rare.join(table_, "h", "left").join(F.broadcast(per), "tail")
    share = F.when(c > 0, (c - v.discount) / F.greatest(F.lit(1.0), "mass")).otherwise(F.greatest("unseen", F.lit(1e-300)))
    extra = found.groupBy("uid").agg(
        F.sum(F.col("n") * (c > 0).cast("long")).alias("more_known"), F.sum(F.col("n") * F.log10((c + 0.1) / floor)).alias("more_base"),
        F.sum(F.col("n") * F.log10(share)).alias("more_score"))
    zero = F.lit(0.0)
    return whole.join(extra, "uid", "left").select(
        F.col("doc_id").alias(id_col), "held_out", F.col("n").alias("n_tokens"),
        (F.col("known") + F.coalesce("more_known", F.lit(0))).alias("n_known"), F.lit(v.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more_base", zero)).alias("base_score"), (F.col("score") + F.coalesce("more_score", zero)).alias("score"))


NAMES = ["uid", "doc_id", "held_out", "h", "tail", "n", "known", "base", "score"]


def op1_gru_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"))
