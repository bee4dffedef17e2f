"""Frequent phrases of up to five words by Toivonen's sampling, and their collocation score.

* A sample of the pieces, which phrases never cross, proposes: levelwise, the phrases whose
  estimated count reaches a threshold lowered by SLACK standard deviations. Pieces of LONG bytes
  and more, which can hold many occurrences each, are all in it, with weight 1.
* One full pass counts exactly every word, every proposed phrase and the negative border: the
  phrases that weren't proposed but whose first and last part (all words but one) were.
* A border phrase that turns out frequent is a failure: it joins the proposed ones, and another
  full pass counts what the border misses, the longer phrases that hold a failure, at every
  length at once. That closes the border: of a frequent phrase not counted before, each part is
  proposed, a failure, or longer than a failure and counted in that pass.

Tasks name the phrases of a block of text exactly, by the name of the first part and the last
word, and send each distinct one once with its count, packed by buckets of a hash; the buckets
are shuffled, and a task adds up one after another. Proposed phrases are added up by the phrase
itself. Border phrases, mostly rare, are added up by a hash, which gives at least their counts:
what reaches the threshold so is a failure, and the next pass counts it by the phrase too.
The proposed set goes to the tasks as a bitmap of fixed size; hashes only let more phrases be
counted, never fewer. Scoring joins the frequent phrases with their parts, in exact decimals.

Defined results: A-Z are lower-cased; a null or empty text has no words; a null language is
`und`; all counts are per language and over every row, repeated ones too; ties go by phrase in
byte order; an empty table gives no rows; other columns are never read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ordermart.llm import bits
from ordermart.llm.common import LOWER, binary_array, byte_rows, columns, row_groups, spans, stored, table

LEAST = 100
WORDS = 5
TOP = 2000
SAMPLE = 8  # one piece of so many proposes phrases
SLACK = 2.7
LONG = 600
BUCKETS = 4096  # or 16 a shuffle partition, if that is more
SEPARATOR = np.zeros(256, bool)
SEPARATOR[[*b".,;:!?", 10, 11, 12, 13]] = True
BLANK = SEPARATOR.copy()
BLANK[[9, 32]] = True
PRIME = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * PRIME
    return x ^ (x >> np.uint64(29))


def _hashes(words: pa.Array) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words.to_pylist()), np.uint64, len(words))


class Block:
    """The words of some rows: codes, pieces, languages, and their text joined by spaces."""

    def __init__(self, data: np.ndarray, rows: np.ndarray, langs: pa.Array):
        blank = BLANK[data]
        begins = ~blank
        begins[1:] &= blank[:-1]
        at_row = rows[:-1][rows[:-1] < rows[1:]]
        begins[at_row] = ~blank[at_row]
        starts = np.flatnonzero(begins)
        kept = LOWER[data[~blank]]
        at = np.append(np.flatnonzero(begins[~blank]), len(kept))
        words = binary_array(kept, at).dictionary_encode()
        row = np.searchsorted(rows, starts, "right") - 1
        self.code = words.indices.to_numpy().astype(np.int64)
        self.piece = np.cumsum(SEPARATOR[data], dtype=np.int32)[starts] + row
        kinds = langs.dictionary_encode()
        self.langs = kinds.dictionary
        self.lang = kinds.indices.to_numpy().astype(np.int64)[row]
        self.kinds = len(words.dictionary)
        self.word_hash, self.lang_hash = _hashes(words.dictionary), _hashes(self.langs)
        self.length = np.diff(at)
        self.at = np.cumsum(self.length + 1) - self.length - 1
        self.text = np.full(len(kept) + len(starts), 32, np.uint8)
        self.text[spans(self.at, self.length)] = kept

    def phrases(self, at: np.ndarray, k: int) -> pa.Array:
        length = self.at[at + k - 1] + self.length[at + k - 1] - self.at[at]
        return binary_array(self.text[spans(self.at[at], length)], np.concatenate([[0], np.cumsum(length)]), pa.string())

    def levels(self, most: int, proposed):
        """(k, first position, hash, count, proposed, counted) of each distinct phrase whose
        parts are proposed, level by level. proposed(hashes) -> two masks: is it proposed now,
        was it in the pass before (None: this is the first). counted: whether that pass counted
        it by the phrase. What the border of the first pass missed is proposed in the second."""
        n = len(self.code)
        inside, was = np.ones(n, bool), np.zeros(n, bool)
        at, key, h = np.arange(n), self.lang * self.kinds + self.code, None
        name = np.empty(n, np.int64)
        hashes = np.empty(n, np.uint64)
        for k in range(1, most + 1):
            if k > 1:
                fits = inside[:-1] & inside[1:]
                at = np.flatnonzero(fits)
                at = at[at + k <= n]
                at = at[self.piece[at] == self.piece[at + k - 1]]
                key = name[at] * self.kinds + self.code[at + k - 1]
            if not len(at):
                return
            _, first, inverse, count = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
            first = at[first]
            if k == 1:
                h = _mix(self.word_hash[self.code[first]] + self.lang_hash[self.lang[first]])
                before = np.ones(len(first), bool)
            else:
                h = _mix(hashes[first] + self.word_hash[self.code[first + k - 1]] + np.uint64(k))
                before = was[first] & was[first + 1]
            now, then = proposed(h)
            inside, was = np.zeros(n, bool), np.zeros(n, bool)
            if then is None:
                counted = np.zeros(len(first), bool)
            else:
                now, counted = now | ~before, before & (then | (k == most))
                was[at] = (then & before)[inverse]
            yield k, first, h, count, now, counted
            inside[at] = now[inverse]
            name[at], hashes[at] = inverse, h[inverse]


def _blocks(batch: pa.RecordBatch):
    raw, offsets = byte_rows(batch.column(1))
    for a, b in row_groups(offsets, 4 << 20):
        block = Block(raw[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], batch.column(0)[a:b])
        if len(block.code):
            yield block


def _hash_counts(rows: DataFrame, level: int, bitmap: np.ndarray | None) -> DataFrame:
    """(key, f), estimated, of the sample's phrases of `level` words (all up to two at level 2)."""
    sent = rows.sparkSession.sparkContext.broadcast(bitmap)

    def run(batches):
        def proposed(h):
            return (np.ones(len(h), bool) if sent.value is None else bits.test(sent.value, h)), None

        for batch in columns(batches):
            weight = batch.column(2).to_numpy()
            for w in np.unique(weight).tolist():
                for block in _blocks(batch.filter(pa.array(weight == w))):
                    for k, _, h, count, _, _ in block.levels(level, proposed):
                        if k == level or level == 2:
                            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(count * w)], names=["key", "f"])

    return rows.select("lang", "text", "weight").mapInArrow(run, "key long, f long").groupBy("key").agg(F.sum("f").alias("f"))


def _sampled(rows: DataFrame, sample: int) -> DataFrame:
    """(lang, weight, text): the pieces of each text that a hash of row and place picks, and the long ones."""

    def run(batches):
        for batch in columns(batches):
            raw, offsets = byte_rows(batch.column(1))
            seed = batch.column(2).to_numpy().view(np.uint64)
            for a, b in row_groups(offsets, 8 << 20):
                data, at = raw[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]
                ends = np.union1d(np.flatnonzero(SEPARATOR[data]) + 1, at[1:][at[1:] > 0])
                starts = np.append(0, ends)[:-1]
                row = np.searchsorted(at, starts, "right") - 1
                pick = _mix(seed[a:b][row] + (starts - at[row]).astype(np.uint64)) >> np.uint64(11)
                long = ends - starts >= LONG
                for weight, chosen in ((1, long), (sample, ~long & (pick % np.uint64(sample) == 0))):
                    chosen = np.repeat(chosen, ends - starts)
                    size = np.append(0, np.cumsum(chosen))[at]
                    some = pa.array(size[1:] > size[:-1])
                    text = binary_array(data[chosen], size, pa.string()).filter(some)
                    yield pa.RecordBatch.from_arrays([batch.column(0)[a:b].filter(some), pa.array([weight] * len(text), pa.int64()), text],
                                                     names=["lang", "weight", "text"])

    return rows.select("lang", "text", F.xxhash64("doc_id", "text")).mapInArrow(run, "lang string, weight long, text string")


def _proposals(rows: DataFrame, least: int, words: int, sample: int, size: int) -> np.ndarray:
    """Bitmap of the phrases that the sample proposes."""
    part = stored(_sampled(rows, sample), "sample")
    low = max(1, int(least - SLACK * (least * sample) ** 0.5))
    bitmap = None
    for level in range(2, max(3, words)):
        more = bits.bitmap_of(_hash_counts(part, level, bitmap).where(F.col("f") >= low), size)
        bitmap = more if bitmap is None else bitmap | more
    return bitmap


def _packed(names: pa.Array, count: np.ndarray, h: np.ndarray, border: np.ndarray, border_count: np.ndarray, buckets: int) -> pa.RecordBatch:
    """A row a bucket: names and their counts (hashes h), hashes of border phrases and their counts."""
    parts = []
    for x in (h, border):
        bucket = (x % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        parts += [order, np.append(0, np.cumsum(np.bincount(bucket, minlength=buckets)))]
    order, at, order2, at2 = parts
    some = (np.diff(at) > 0) | (np.diff(at2) > 0)
    offsets = pa.array(at, pa.int32())
    return pa.RecordBatch.from_arrays(
        [pa.array(np.arange(buckets), pa.int32()), pa.ListArray.from_arrays(offsets, names.take(pa.array(order))),
         pa.ListArray.from_arrays(offsets, pa.array(count[order], pa.int32())), binary_array(border[order2].view(np.uint8), at2 * 8),
         binary_array(border_count[order2].astype(np.int32).view(np.uint8), at2 * 4)],
        names=["bucket", "names", "counts", "border", "border_counts"]).filter(pa.array(some))


def _summed(least: int):
    """(name, key, f) of rows sorted by bucket: phrases with f >= least, all languages' words
    (name: language, tab), and hashes of border phrases (name null) with f >= least."""

    def total(t: pa.Table) -> pa.RecordBatch:
        names, counts = (pa.concat_arrays([x.flatten() for x in t[c].chunks]) for c in ("names", "counts"))
        each = pa.table({"name": names, "f": counts.cast(pa.int64())}).group_by("name").aggregate([("f", "sum")])
        each = each.filter(pc.or_(pc.greater_equal(each["f_sum"], least), pc.ends_with(each["name"], "\t")))
        key, n = (np.frombuffer(b"".join(t[c].to_pylist()), kind) for c, kind in (("border", np.int64), ("border_counts", np.int32)))
        order = np.argsort(key)
        key = key[order]
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.empty(0, np.int64)
        f = np.add.reduceat(n[order].astype(np.int64), first) if len(key) else first
        key, f = key[first][f >= least], f[f >= least]
        return pa.RecordBatch.from_arrays(
            [pa.concat_arrays([*each["name"].chunks, pa.nulls(len(key), pa.string())]), pa.concat_arrays([pa.nulls(len(each), pa.int64()), pa.array(key)]),
             pa.concat_arrays([*each["f_sum"].chunks, pa.array(f)])], names=["name", "key", "f"])

    def run(batches):
        held = None
        for batch in columns(batches):
            t = pa.Table.from_batches([batch])
            t = pa.concat_tables([held, t]) if held is not None else t
            bucket = t["bucket"].to_numpy()
            begin = int(np.searchsorted(bucket, bucket[-1]))
            if begin:
                yield total(t.slice(0, begin))
            held = t.slice(begin)
        if held is not None:
            yield total(held)

    return run


def _counted(rows: DataFrame, now: np.ndarray, then: np.ndarray | None, words: int, least: int) -> DataFrame:
    """(name, key, f) of every language's words (name: language, tab), and with f >= least of every proposed
    phrase (language, tab, phrase) and border phrase (null, its hash); with `then`, of the phrases
    that it left uncounted."""
    spark = rows.sparkSession
    sent = spark.sparkContext.broadcast((now, then))
    buckets = max(BUCKETS, 16 * int(spark.conf.get("spark.sql.shuffle.partitions")))

    def run(batches):
        now, then = sent.value

        def proposed(h):
            return bits.test(now, h), (None if then is None else bits.test(then, h))

        def named(block, lang, phrases):
            return pc.binary_join_element_wise(block.langs.take(pa.array(lang)), phrases, "\t")

        for batch in columns(batches):
            for block in _blocks(batch):
                names, counts, hashes = [], [], []
                border, border_counts = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
                if then is None:
                    names.append(named(block, np.arange(len(block.langs)), pa.array([""] * len(block.langs))))
                    counts.append(np.bincount(block.lang, minlength=len(block.langs)))
                    hashes.append(block.lang_hash)
                for k, first, h, count, is_now, counted in block.levels(words, proposed):
                    by_phrase = np.flatnonzero((is_now | (k == words)) & ~counted)
                    names.append(named(block, block.lang[first[by_phrase]], block.phrases(first[by_phrase], k)))
                    counts.append(count[by_phrase])
                    hashes.append(h[by_phrase])
                    if then is None and k < words:
                        border.append(h[~is_now])
                        border_counts.append(count[~is_now])
                yield _packed(pa.concat_arrays(names), np.concatenate(counts), np.concatenate(hashes), np.concatenate(border), np.concatenate(border_counts), buckets)

    parts = rows.select("lang", "text").mapInArrow(run, "bucket int, names array<string>, counts array<int>, border binary, border_counts binary")
    return parts.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_summed(least), "name string, key long, f long")


def frequent(rows: DataFrame, least: int = LEAST, words: int = WORDS, sample: int = SAMPLE, size: int = bits.BITS) -> DataFrame:
    """(lang, k, phrase, f) of every phrase of 1 to `words` words with f >= least, and each
    language's number of words as k = 0; rows: (doc_id, lang, text) without nulls in the last two."""
    proposed = _proposals(rows, least, words, sample, size)
    found = stored(_counted(rows, proposed, None, words, least), "phrases")
    failures = bits.bitmap_of(found.where("name is null").select("key"), size)
    if failures.any():
        found = found.unionByName(stored(_counted(rows, proposed | failures, proposed, words, least), "phrases"))
    phrase = F.substring_index("name", "\t", -1)  # a language may hold a tab, a phrase can't
    named = found.where("name is not null").select("name", phrase.alias("phrase"), "f")
    lang = F.expr("substr(name, 1, length(name) - length(phrase) - 1)")
    named = named.select(lang.alias("lang"), F.when(F.col("phrase") == "", 0).otherwise(F.size(F.split("phrase", " "))).alias("k"), "phrase", "f")
    return named.where((F.col("f") >= least) | (F.col("k") == 0))


def collocations(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                 least: int = LEAST, words: int = WORDS, top: int = TOP, sample: int = SAMPLE) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of each language's best `top` phrases."""
    rows = df.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
                     F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    every = frequent(rows, least, words, sample)
    total = every.where("k = 0").select("lang", F.col("f").alias("n"))
    counts = every.where("k > 0").select("lang", "phrase", "f")
    cut = every.where("k > 1").select("lang", "phrase", "k", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
    cut = cut.withColumn("first", F.expr("substring_index(phrase, ' ', cut)"))
    cut = stored(cut.withColumn("rest", F.expr("substr(phrase, length(first) + 2)")), "cuts")
    parts = cut.join(counts.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l")), ["lang", "first"])
    parts = parts.join(counts.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"]).join(total, "lang")
    score = F.expr("(1000BD * cast(a as decimal(19, 0)) * cast(n as decimal(19, 0))) div (cast(l as decimal(19, 0)) * cast(r as decimal(19, 0)))")
    best = parts.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("b"))
    # a phrase as frequent as a longer one that holds it is as frequent as one longer by one word
    longer = cut.where("k > 2 and cut = 1").select("lang", F.col("rest").alias("phrase"), "a").unionByName(
        cut.where("k > 2 and cut = k - 1").select("lang", F.col("first").alias("phrase"), "a"))
    longer = longer.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = best.join(longer, ["lang", "phrase"], "left").where("longer is null or longer < a").select("lang", "phrase", "a", "b.l", "b.r", "n", "b.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op12_toivonen_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


#: Every phrase counted outright, which the small tables allow.
ORACLE = r"""
with pieces as (
  select coalesce(lang, 'und') lang,
    unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) piece
  from documents),
tokens as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') w from pieces),
grams as (
  select lang, k, list_aggregate(w[i:i + k - 1], 'string_agg', ' ') phrase
  from (select lang, w, k, unnest(range(1, len(w) - k + 2)) i from tokens, (select unnest([1, 2, 3, 4, 5]) k) where len(w) >= k)),
total as (select lang, count(*) n from grams where k = 1 group by lang),
f as (select lang, k, phrase, count(*) f, string_split(phrase, ' ') w from grams group by lang, k, phrase having count(*) >= 100),
cuts as (
  select lang, k, phrase, f a, j, array_to_string(w[1:j], ' ') first, array_to_string(w[j + 1:k], ' ') rest
  from (select *, unnest(range(1, k)) j from f where k > 1)),
scored as (
  select c.lang, c.k, c.phrase, c.a, c.j, x.f l, y.f r, n, (1000::hugeint * c.a * n) // (x.f::hugeint * y.f) score
  from cuts c join f x on x.lang = c.lang and x.phrase = c.first join f y on y.lang = c.lang and y.phrase = c.rest
  join total t on t.lang = c.lang),
best as (select * from scored qualify row_number() over (partition by lang, phrase order by score, j) = 1),
kept as (
  select * from best b where not exists (
    select 1 from best o where o.lang = b.lang and o.k > b.k and 100 * o.a >= 100 * b.a and contains(' ' || o.phrase || ' ', ' ' || b.phrase || ' '))),
ranked as (select *, row_number() over (partition by lang order by score desc, a desc, encode(phrase)) rank from kept)
select lang, rank, phrase, a, l, r, n, score::bigint score from ranked where rank <= 2000
"""
