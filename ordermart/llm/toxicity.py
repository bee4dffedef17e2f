"""Toxicity by two class-conditional Kneser-Ney word models.

For each class an interpolated bigram model is counted on labelled documents:

    p(w | h) = (max(c(h w) - D, 0) + (freed(h) + NU) * p(w)) / (c(h) + NU)
    p(w)     = (max(c(w) - D, 0) + (freed + MU) * shared(w)) / (N + MU)

freed is what the discount takes: of min(c, D) the sum over the words, or over the pairs that begin
with h. shared(w) is the same for both classes: the discounted frequency of the word in both
classes' texts, and beyond it its continuation probability, in how many different contexts it
stands (and one more, which stands for words of neither). All counted words and pairs keep their
probabilities in both classes; D, MU and NU say how far a class stays with what both share, so
that rare expressions, in one class only by chance, weigh little. They are chosen out of
STRENGTHS on labelled documents that were not counted, by the area under the curve.

A document's evidence is the difference of its two log-likelihoods, normalised by its number of
words and by the root of it, and the largest difference of any passage of 1, 5 and 20 words, for toxic
expressions are few in long texts. A logistic curve over these, fitted on the same documents and
shifted to the share of toxic ones among all labelled documents, turns them into a score. No
held-out label takes part in any of this.

Bounds: at most `sample` labelled documents a class, by a hash of the id, of at most `chars`
characters together (and the rest of the document that passes them). What the least discount
takes whole, in both classes, is the same to the models as what was never seen (its shared part
is the same in both and cancels out), so only sums over such words and pairs are kept. The others,
by 64-bit hashes, are what the executors get. The scoring reads every whole text once, without a shuffle.

Defined results: A-Z are lower-cased, words end at ASCII white space; null text = empty
text = no evidence, scored by the curve at 0; a document's labels are joined by id,
the largest one counts and null ones don't; without labels of both classes, counted and not counted, every score
is the share of toxic ones (0 without labels); repeated rows are scored each; an empty
table gives no rows; other columns are never read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ordermart.llm.common import clean, columns, discard, stored, table, with_id, word_blocks

SAMPLE = 10_000
CHARS = 40_000_000
LIMIT = 0.3
DISCOUNTS = (3, 10, 30)
STRENGTHS = [(d, mu, nu) for d in DISCOUNTS for mu, nu in ((1e4, 1e2), (1e4, 1e4), (1e5, 1e5), (1e5, 1e6))]
PASSAGES = (1, 5, 20)
FEATURES = 2 + len(PASSAGES)
PRIME = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class Model:
    """words: hashes, ascending; c, heads (2 x words): each class's count of the word and of the
    pairs that it begins; freed: what each discount takes from the latter; contexts: different words
    before it, in both classes; pairs: hashes, ascending; n (2 x pairs): their counts; sums, over
    all words: counts and contexts, and for each discount what it takes of the words."""

    words: np.ndarray
    c: np.ndarray
    heads: np.ndarray
    freed: dict[int, np.ndarray]
    contexts: np.ndarray
    pairs: np.ndarray
    n: np.ndarray
    sums: dict[str, int]
    strength: tuple[int, float, float] = STRENGTHS[0]
    weights: np.ndarray | None = None
    share: float = 0.0

    def probabilities(self, discount: int, mu: float) -> np.ndarray:
        """(2 x words and, last, any other word, up to its shared part): p(w)."""
        both = self.c.sum(axis=0, dtype=float)
        shared = np.maximum(both - discount, 0) + self.sums[f"b{discount}"] * self.contexts / (self.sums["contexts"] + 1.0)
        shared = np.append(shared / (self.sums["c0"] + self.sums["c1"]), 1.0)
        out = np.zeros((2, len(self.words) + 1))
        for k in range(2):
            seen = np.append(np.maximum(self.c[k] - float(discount), 0), 0.0)
            out[k] = (seen + (self.sums[f"f{discount}{k}"] + mu) * shared) / (self.sums[f"c{k}"] + mu)
        return out

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """Number of each word, the last one for words not in the model."""
        n = len(self.words)
        if not n:
            return np.zeros(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(self.words, hashes), n - 1)
        return np.where(self.words[at] == hashes, at, n)

    def ratios(self, place: np.ndarray, at: np.ndarray, before: np.ndarray, discount: int, nu: float, p: np.ndarray) -> np.ndarray:
        """log p1(w | h) - log p0(w | h) of each word: place of its pair, or -1; at and before:
        numbers of the word and of the one before it; p: probabilities()."""
        parts = []
        for k in range(2):
            heads, freed = np.append(self.heads[k], 0)[before], np.append(self.freed[discount][k], 0)[before]
            seen = np.where(place >= 0, np.maximum(self.n[k][place] - discount, 0), 0)
            parts.append(np.log(seen + (freed + nu) * p[k, at]) - np.log(heads + nu))
        return parts[1] - parts[0]

    def evidence(self, hashes: np.ndarray, rows: np.ndarray, strengths: list, p: list) -> np.ndarray:
        """(strengths x documents x FEATURES): difference of the log-likelihoods over n and over root n,
        and of the best passages. hashes: those of the words, end to end; p: probabilities()
        for each strength."""
        out = np.zeros((len(strengths), len(rows) - 1, FEATURES))
        if not len(hashes):
            return out
        last = _before(hashes, rows)
        key = pair_keys(last, hashes)
        place = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        place = np.where(self.pairs[place] == key, place, -1)
        at, before = self.numbers(hashes), self.numbers(last)
        count = np.diff(rows)
        some = count > 0
        first, count = rows[:-1][some], count[some]
        ends = np.repeat(rows[1:], np.diff(rows))
        for s, (discount, _, nu) in enumerate(strengths):
            total = np.append(0.0, np.cumsum(self.ratios(place, at, before, discount, nu, p[s])))
            whole = total[first + count] - total[first]
            out[s, some, 0], out[s, some, 1] = whole / count, whole / np.sqrt(count)
            for k, size in enumerate(PASSAGES):
                passage = total[np.minimum(np.arange(len(hashes)) + size, ends)] - total[:-1]
                out[s, some, 2 + k] = np.maximum.reduceat(passage, first)
        return out

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(x @ self.weights[1:] + self.weights[0], -30, 30)))


def _before(hashes: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The word before each word, START at the beginning of a text."""
    last = np.append(START, hashes[:-1])[:len(hashes)]
    last[rows[:-1][rows[:-1] < len(hashes)]] = START
    return last


def pair_keys(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = a.view(np.uint64) * PRIME + b.view(np.uint64)
    x = (x ^ (x >> np.uint64(32))) * PRIME
    return (x ^ (x >> np.uint64(29))).view(np.int64)


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def _hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words)).view(np.int64)


START = int(_hashes([b" "])[0])  # before a text's first word; no word has white space


def _counts(batches):
    """(toxic, a, b, n): words (a is null) and word pairs, by hashes; a is START for a
    text's first word."""
    for batch in columns(batches):
        toxic = batch.column(0).to_numpy()
        for a, b, words, codes, rows in word_blocks(batch.column(1), lower=True, limit=4 << 20):
            hashes = _hashes(words.to_pylist())[codes]
            of = np.repeat(toxic[a:b], np.diff(rows))
            last = _before(hashes, rows)
            for t in np.unique(of).tolist():
                word, n = np.unique(hashes[of == t], return_counts=True)
                yield _count_rows(t, pa.nulls(len(word), pa.int64()), word, n)
                _, first, n = np.unique(pair_keys(last, hashes)[of == t], return_index=True, return_counts=True)
                yield _count_rows(t, pa.array(last[of == t][first]), hashes[of == t][first], n)


def _count_rows(toxic: int, a: pa.Array, b: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(b), toxic, np.int32)), a, pa.array(b), pa.array(n.astype(np.int64))],
                                      names=["toxic", "a", "b", "n"])


def _counted(texts: DataFrame) -> Model | None:
    """Model of the counts of texts (toxic, text)."""
    parts = texts.select("toxic", "text").mapInArrow(_counts, "toxic int, a long, b long, n long")
    per = [F.sum(F.when(F.col("toxic") == t, F.col("n")).otherwise(0)).cast("int").alias(f"n{t}") for t in (0, 1)]
    total = stored(parts.groupBy("a", "b").agg(*per), "counts")
    pair = total.where("a is not null")
    heads = pair.groupBy(F.col("a").alias("word")).agg(*(F.sum(f"n{t}").cast("int").alias(f"h{t}") for t in (0, 1)),
                                                       *(F.sum(F.least(F.col(f"n{t}"), F.lit(d))).cast("int").alias(f"f{d}{t}") for d in DISCOUNTS for t in (0, 1)))
    contexts = pair.groupBy(F.col("b").alias("word")).agg(F.count("*").cast("int").alias("contexts"))
    every = total.where("a is null").select(F.col("b").alias("word"), "n0", "n1").join(heads, "word", "full").join(contexts, "word", "left")
    words = stored(every.select("word", *(F.coalesce(c, F.lit(0)).alias(c) for c in every.columns if c != "word")), "words")
    least = min(DISCOUNTS)
    sums = words.agg(*(F.sum(f"n{t}").alias(f"c{t}") for t in (0, 1)), F.sum("contexts").alias("contexts"),
                     *(F.sum(F.least(f"n{t}", F.lit(d))).alias(f"f{d}{t}") for d in DISCOUNTS for t in (0, 1)),
                     *(F.sum(F.least(F.col("n0") + F.col("n1"), F.lit(d))).alias(f"b{d}") for d in DISCOUNTS)).first().asDict()
    if not sums["contexts"]:
        return None
    words = words.where(f"greatest(n0, n1, h0, h1) > {least}").toArrow()  # of at most 2 * (chars + a document)
    pairs = pair.where(f"greatest(n0, n1) > {least}").mapInArrow(_keyed, "key long, n0 int, n1 int").toArrow()
    discard(total)
    order = np.argsort(words["word"].to_numpy())
    c = {name: words[name].to_numpy()[order] for name in words.column_names}
    key = np.append(pairs["key"].to_numpy(), np.int64(0))  # one entry at least
    order = np.argsort(key)
    return Model(c["word"], np.stack([c["n0"], c["n1"]]), np.stack([c["h0"], c["h1"]]), {d: np.stack([c[f"f{d}0"], c[f"f{d}1"]]) for d in DISCOUNTS}, c["contexts"],
                 key[order], np.stack([np.append(pairs[n].to_numpy(), 0)[order] for n in ("n0", "n1")]), sums)


def _keyed(batches):
    for batch in columns(batches):
        a, b = (batch.column(k).to_numpy() for k in (0, 1))
        yield pa.RecordBatch.from_arrays([pa.array(pair_keys(a, b)), batch.column(2), batch.column(3)], names=["key", "n0", "n1"])


def _area(x: np.ndarray, y: np.ndarray) -> float:
    """Area under the curve of scores x for labels y."""
    order = np.argsort(x, kind="stable")
    _, inverse, n = np.unique(x, return_inverse=True, return_counts=True)
    rank = (np.cumsum(n) - (n - 1) / 2)[inverse]
    ones = y.sum()
    return float((rank[y > 0].sum() - ones * (ones + 1) / 2) / (ones * (len(order) - ones)))


def _logistic(x: np.ndarray, y: np.ndarray, share: float) -> np.ndarray:
    """Newton's method with a small ridge, on columns of unit spread; the classes weigh
    the same, and the intercept is moved to `share` afterwards."""
    spread = np.maximum(x.std(axis=0), 1e-9)
    z = np.column_stack([np.ones(len(x)), x / spread])
    weight = np.where(y > 0, 0.5 / max(1, y.sum()), 0.5 / max(1, (1 - y).sum())) * len(y)
    w = np.zeros(z.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        slope = z.T @ (weight * (y - p)) - 0.1 * w
        curve = (z * (weight * p * (1 - p))[:, None]).T @ z + 0.1 * np.eye(len(w))
        step = np.linalg.solve(curve, slope)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    w[1:] /= spread
    w[0] += np.log(share / (1 - share))
    return w


def _hashed(column: pa.Array):
    """(first row, row after the last, hash of every word, row offsets) block by block."""
    for a, b, words, codes, rows in word_blocks(column, lower=True, limit=4 << 20):
        yield a, b, _hashes(words.to_pylist())[codes], rows


def sampled(df: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, sample: int, chars: int) -> tuple[DataFrame, float]:
    """(toxic, counted, text) of the learnable labelled documents of the sample, and the share
    of toxic ones among all learnable labels."""
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(F.col(id_col)))
    known = known.groupBy(F.col(id_col).alias("doc_id")).agg((F.max(label_col) > 0).cast("int").alias("toxic"))
    count = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    order = F.xxhash64(F.col("doc_id").cast("string"))
    chosen = [known.where(F.col("toxic") == t).orderBy(order, "doc_id").limit(sample) for t in (0, 1)]
    chosen = chosen[0].unionByName(chosen[1]).withColumn("place", order)
    texts = stored(clean(df, id_col, text_col).join(F.broadcast(chosen), "doc_id"), "sample")  # 2 * sample rows
    so_far = F.sum(F.length("text")).over(Window.partitionBy("toxic").orderBy("place", "doc_id"))
    fits = texts.select("doc_id", "toxic", "place", (so_far - F.length("text") < chars).alias("fits"))
    fits = fits.groupBy("doc_id").agg(F.max("fits").alias("fits")).where("fits")
    texts = texts.join(F.broadcast(fits), "doc_id", "left_semi")
    return texts.select("toxic", (F.col("place") % 3 != 0).alias("counted"), "text"), count.get(1, 0) / max(1, sum(count.values()))


def fit(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic", sample: int = SAMPLE, chars: int = CHARS) -> Model | float:
    """Model from the labelled rows that are not held out; the share of toxic ones where
    they don't allow one."""
    texts, share = sampled(df, labels, id_col, text_col, label_col, sample, chars)
    if not 0 < share < 1:
        return share
    model = _counted(texts.where("counted"))
    if model is None:
        return share
    sent = df.sparkSession.sparkContext.broadcast(model)

    def measure(batches):
        model = sent.value
        p = [model.probabilities(d, mu) for d, mu, _ in STRENGTHS]
        for batch in columns(batches):
            for a, b, hashes, rows in _hashed(batch.column(1)):
                x = model.evidence(hashes, rows, STRENGTHS, p)
                yield pa.RecordBatch.from_arrays([batch.column(0)[a:b], pa.array(list(x.transpose(1, 0, 2).reshape(b - a, -1)))], names=["toxic", "x"])

    rest = texts.where("not counted").select("toxic", "text").mapInArrow(measure, "toxic int, x array<double>").collect()
    y = np.array([r["toxic"] for r in rest], float)
    if not 0 < y.sum() < len(y):
        return share
    x = np.array([r["x"] for r in rest]).reshape(len(rest), len(STRENGTHS), FEATURES)
    fitted = [_logistic(x[:, s], y, share) for s in range(len(STRENGTHS))]
    best = max(range(len(STRENGTHS)), key=lambda s: _area(x[:, s] @ fitted[s][1:], y))
    model.strength, model.weights, model.share = STRENGTHS[best], fitted[best], share
    return model


def score(df: DataFrame, model: Model | float, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) of every row."""
    rows = clean(df, id_col, text_col)
    if not isinstance(model, Model):
        return rows.select(F.col("doc_id").alias(id_col), F.lit(float(model)).alias("score"))
    sent = df.sparkSession.sparkContext.broadcast(model)  # of at most 2 * (chars + a document)

    def run(batches):
        model = sent.value
        p = [model.probabilities(*model.strength[:2])]
        for batch in columns(batches):
            for a, b, hashes, rows in _hashed(batch.column(1)):
                x = model.evidence(hashes, rows, [model.strength], p)[0]
                yield pa.RecordBatch.from_arrays([batch.column(0)[a:b], pa.array(model.scores(x))], names=["doc_id", "score"])

    return rows.mapInArrow(run, with_id(rows, "score double")).withColumnRenamed("doc_id", id_col)


def op5_kneser_ney_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = score(docs, fit(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= LIMIT).cast("int").alias("predicted"))
