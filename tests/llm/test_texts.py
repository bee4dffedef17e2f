"""Extraction, personal data, licenses, toxicity, language model and pipeline."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ordermart.llm import catalog, gru, html_text, jaccard, licenses, lm, packing, pii, toxicity

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p><p>no";</script></head>
<body class="has-sidebar"><header><h1>Site</h1><a href=/>Home</a></header><div class="cookie-notice">We use cookies so that
every page of this site works for all of you on every day of the year. Accept them all.</div><nav><ul><li><a href=a>A</a></ul></nav>
<div class="ad">Buy this now and never look back at it.</div><div id="content"><article><header><h1>Title &amp; more</h1></header>
<p>One <b>two</b>three&nbsp;four<p>Five<br>six <a href="x>y">seven</a><ul><li>eight<li>nine</ul><!-- no --><blockquote>ten &#233; &lt;b&gt;</blockquote>
<aside>Side</aside><form>Sign up <input><button>go</button></form></article><section id="comments"><article><p>I like this very much
and will say so at length in my comment.</p></article></section></div><aside>rel</aside><footer>&copy; c</footer></body></html>"""


def test_main_text(spark):
    prose = "plain text that stands alone with a fair number of words in it so that it counts as prose"
    pages = [(1, PAGE, "Title & more\nOne twothree four\nFive six seven\neight\nnine\nten é <b>"), (2, None, ""), (3, "", ""),
             (4, f"<p>{prose}", prose), (5, "<article>cut <p>off here <a hre", "cut\noff here"), (5, "<script>x", ""),
             (6, "<article><p>" + "w " * 50_000 + "</article>", ("w " * 50_000).strip())]
    df = spark.createDataFrame([(i, h, "x") for i, h, _ in pages], "page_id long, html string, text string")
    assert sorted(map(tuple, html_text.extract(df).collect())) == sorted((i, w) for i, _, w in pages)
    assert html_text.extract(df.where("false")).count() == 0


def test_tree_fits_its_table():
    known = np.array(html_text.LABELLED, float)
    assert (html_text.apply_tree(html_text.default_tree(), known[:, :-1]) >= 0.5).astype(int).tolist() == known[:, -1].astype(int).tolist()


PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def passes_luhn(digits: str) -> bool:
    twice = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(v - 9 if v > 9 else v for v in twice) % 10 == 0


def base_spans(text: str) -> list[tuple]:
    out = []
    for n, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            if (kind == "ip" and any(int(x) > 255 for x in m.group().split(".")) or kind == "phone" and not 9 <= len(digits) <= 15
                    or kind == "card" and not (12 <= len(digits) <= 19 and passes_luhn(digits))):
                continue
            out.append((m.start(), n, m.end(), kind))
    return sorted(out)


def test_base_spans(spark, rows):
    r = random.Random(1)
    texts = [t for _, t in rows] + ["".join(r.choice("019 .-@a+(4é😀") for _ in range(r.randint(1, 60))) for _ in range(800)]
    texts += ["a@b.c_d@e.f x@y.z-", "1.2.3.4.5.6.7.8 0255.1.1.1", "4111 1111 1111 1111 4111111111111111-4111", "1" * 20_000 + "@", "1.2.3.4 " * 300]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("spans", F.lit(1))
    for row in pii.find(df).collect():
        got = [(s.start, s.kind_no, s.end, s.kind) for s in row.spans if s.kind in PATTERNS]
        assert got == base_spans(texts[row.doc_id] or "")


def test_added_spans_and_redaction(spark):
    texts = ["my iban GB82 WEST 1234 5698 7654 32.", "GB83 WEST 1234 5698 7654 32", "social security 123-45-6789", "part 123-45-6789",
             "write a@b.cd, call +1 (222) 333-4444 ok", None, ""]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: [s.kind for s in r.spans] for r in pii.find(df).collect()}
    assert got == {0: ["iban"], 1: [], 2: ["ssn"], 3: [], 4: ["email", "phone"], 5: [], 6: []}
    red = {r.doc_id: r.t for r in df.select("doc_id", pii.redacted(F.col("text")).alias("t")).collect()}
    assert red[4] == "write [EMAIL], call [PHONE] ok" and red[0] == "my iban [IBAN]." and red[1] == texts[1] and red[6] == ""


def test_native_plan_has_no_python(spark, folder):
    plan = pii.find(spark.read.parquet(f"{folder}/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def lcs(a, b):
    line = [0] * (len(b) + 1)
    for x in a:
        line = _step(line, x, b)
    return line[-1]


def _step(line, x, b):
    new = [0]
    for j, y in enumerate(b):
        new.append(line[j] + 1 if x == y else max(line[j + 1], new[j]))
    return new


def test_alignment():
    r = random.Random(2)
    for _ in range(300):
        a, b = ([r.choice("abcdefgh") for _ in range(r.randrange(12))] for _ in range(2))
        pairs = licenses.align(a, b)
        assert all(a[p] == b[q] for p, q in pairs)
        assert all(p < r_ and q < s for (p, q), (r_, s) in zip(pairs, pairs[1:], strict=False))
        assert len(pairs) <= lcs(a, b)
        if not any(a.count(x) == b.count(x) == 1 for x in a):
            assert len(pairs) == lcs(a, b)
    words = "permission is hereby granted free of charge".split()
    assert [q for _, q in licenses.align(["x", *words[:3], "y", *words[3:], "z"], words)] == list(range(7))


def test_scan(spark):
    texts = ["x " * 500 + "Released under the MIT License. y Licensed under CC BY-NC 4.0.", "released, under the 'MIT' licence", None, "",
             "This work is licensed under the GNU General License, version 3. " * 2, "the license of license"]
    df = spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)], "doc_id long, text string, matches int")
    got = {r.doc_id: [(m.license, m.start, m.end) for m in r.matches] for r in licenses.scan(df).collect()}
    assert got == {0: [("MIT", 500, 505), ("CC-BY-NC-4.0", 506, 511)], 1: [("MIT", 0, 4)], 2: [], 3: [],
                   4: [("GPL-3.0", 0, 11), ("GPL-3.0", 11, 22)], 5: []}
    assert licenses.scan(df.where("false")).count() == 0


def found(text: str) -> list[tuple]:
    scanner = licenses.Scanner(licenses.TEMPLATES, licenses.LEAST, licenses.NAMING)
    return [(m["license"], m["start"], m["end"]) for m in scanner.scan(licenses.normal(text))]


def test_no_license_in_scattered_or_foreign_words():
    assert found("the album was released last year under some label and MIT professors hold the license") == []
    assert found("Licensed under the BSD License, Version 2.0.") == []
    assert found("This work is licensed under the GNU Lesser General Public License, version 3.") == []
    assert found("released under the license of version 2.0 " * 2000) == []


def test_planted_licenses_are_found():
    r = random.Random(4)
    for _ in range(200):
        text, want = [], []
        for _ in range(r.randrange(1, 5)):
            text += [f"w{r.randrange(50)}" for _ in range(r.randrange(60))]
            text += r.sample(["the", "license", "of", "software", "any"], r.randrange(3))
            text.append(".. x")
            name = r.choice([n for n in licenses.TEMPLATES if n not in ("MIT-text", "MIT-whole")])
            words = licenses.TEMPLATES[name].split()
            if len(words) > 15:  # a few words of a long one may change
                words[7], words[11:11] = "changed", ["added"]
            start = len(licenses.normal(" ".join(text)))
            text += words
            want.append((name, start, len(licenses.normal(" ".join(text)))))
            text.append("y")
        assert found(" ".join(text)) == want


def test_whole_license():
    n = len(licenses.normal(licenses.TEMPLATES["MIT-whole"]))
    assert found("see below " + licenses.TEMPLATES["MIT-whole"]) == [("MIT-text", 2, 2 + len(licenses.normal(licenses.TEMPLATES["MIT-text"]))), ("MIT-whole", 2, 2 + n)]


def test_densest_stretch():
    r = random.Random(5)
    for _ in range(300):
        at = sorted(r.sample(range(25), r.randrange(1, 12)))
        score = {(i, j): 2 * (j - i + 1) - (at[j] - at[i] + 1) for i in range(len(at)) for j in range(i, len(at))}
        got = licenses.densest([(p, k) for k, p in enumerate(at)])
        assert score[got] == max(score.values())


@pytest.fixture(scope="module")
def marked(spark):
    r = random.Random(4)
    common = [f"w{k}" for k in range(400)]
    rows, labels = [], []
    for i in range(900):
        words = [r.choice(common) for _ in range(r.randrange(20, 200))]
        toxic = int(r.random() < 0.2)
        for _ in range(3 * toxic):
            words.insert(r.randrange(len(words)), r.choice(["vile", "foul", "nasty"]))
        rows.append((i, " ".join(words), "x"))
        labels.append((i, 1, toxic))
    rows += [(5000, "", "x"), (5001, None, "x"), (None, "vile words", "x")]
    labels += [(5002, 1, 1), (3, 1, None)]
    return (spark.createDataFrame(rows, "doc_id long, text string, score string").repartition(4),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def test_toxicity_on_held_out_labels(marked):
    docs, labels = marked
    model = toxicity.fit(docs, labels)
    got = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    assert len(got) == docs.count() and all(0 <= s <= 1 for s in got.values())
    truth = {r.doc_id: r.toxic for r in labels.where("toxic is not null and doc_id < 5000").collect()}
    held = [i for i in truth if zlib.crc32(str(i).encode()) % 4 == 2]
    right = sum((got[i] >= toxicity.LIMIT) == bool(truth[i]) for i in held)
    assert right >= 0.95 * len(held)
    assert got[5000] == got[5001] < toxicity.LIMIT


def test_toxicity_learns_no_held_out_label(marked):
    docs, labels = marked
    turned = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (sorted((str(r.doc_id), r.score) for r in toxicity.score(docs, toxicity.fit(docs, x)).collect()) for x in (labels, turned))
    assert a == b


def test_toxicity_without_labels(marked, nothing):
    docs, labels = marked
    assert {r.score for r in toxicity.score(docs, toxicity.fit(docs, labels.where("false"))).collect()} == {0.0}
    assert toxicity.score(nothing, toxicity.fit(docs, labels)).count() == 0
    assert 0 < toxicity.fit(nothing, labels) < 1  # no texts: the share alone
    assert toxicity.score(nothing, 0.25).schema.simpleString() == "struct<doc_id:bigint,score:double>"


def kneser_ney(texts, strength):
    """log p1(w | h) - log p0(w | h) as the docstring has it, by dictionaries; texts: (toxic, words)."""
    d, mu, nu = strength
    c, pair = ({0: Counter(), 1: Counter()} for _ in range(2))
    for t, words in texts:
        c[t].update(words)
        pair[t].update(zip(["<s>", *words], words, strict=False))
    both = c[0] + c[1]
    contexts = Counter(b for _, b in set(pair[0]) | set(pair[1]))
    total = sum(contexts.values()) + 1
    freed = sum(min(n, d) for n in both.values())
    shared = {w: (max(both[w] - d, 0) + freed * contexts.get(w, 1 if w is None else 0) / total) / sum(both.values()) for w in [*both, None]}

    def p(k, w):
        w = w if w in both else None
        return (max(c[k][w] - d, 0) + (sum(min(n, d) for n in c[k].values()) + mu) * shared[w]) / (sum(c[k].values()) + mu)

    def after(k, h, w):
        of = {x: n for (g, x), n in pair[k].items() if g == h}
        return (max(of.get(w, 0) - d, 0) + (sum(min(n, d) for n in of.values()) + nu) * p(k, w)) / (sum(of.values()) + nu)

    return p, lambda h, w: math.log(after(1, h, w)) - math.log(after(0, h, w))


@pytest.mark.parametrize("strength", [(3, 1e3, 20.0), (10, 5.0, 1e4)])
def test_evidence_is_that_of_kneser_ney_models(spark, strength):
    r = random.Random(8)
    texts = [(int(i % 5 == 0), [f"w{min(r.randrange(30), r.randrange(30))}" for _ in range(r.randrange(60))]) for i in range(60)]
    model = toxicity._counted(spark.createDataFrame([(t, " ".join(w)) for t, w in texts], "toxic int, text string").repartition(3))
    p, ratio = kneser_ney(texts, strength)
    every = sorted({w for _, x in texts for w in x})
    assert np.allclose([sum(p(k, w) for w in [*every, None]) for k in (0, 1)], 1)
    got = model.probabilities(*strength[:2])
    at = model.numbers(toxicity._hashes([w.encode() for w in every]))
    known = at < len(model.words)
    assert 5 < known.sum() < len(every)
    assert np.allclose(got[:, at[known]], [[p(k, w) for w, x in zip(every, known, strict=True) if x] for k in (0, 1)])
    for words in (["w0", "w1", "never", "w2", "w1", "w0"] * 5, ["w3"], [], every, every[::-1]):
        each = [ratio(h, w) for h, w in zip(["<s>", *words], words, strict=False)]
        x = model.evidence(toxicity._hashes([w.encode() for w in words]), np.array([0, len(words)]), [strength], [got])[0, 0]
        n = max(1, len(words))
        passages = [max((sum(each[i:i + size]) for i in range(len(words))), default=0) for size in toxicity.PASSAGES]
        assert np.allclose(x, [sum(each) / n, sum(each) / n ** 0.5, *passages])


def test_pairs_decide(spark):
    """The order of two everyday words marks a text, the words don't."""
    r = random.Random(3)
    rows, labels = [], []
    for i in range(1200):
        words = [r.choice([f"w{k}" for k in range(40)]) for _ in range(30)]
        words[5:5] = [*(["red", "hot"] if i % 4 == 0 else ["hot", "red"]), "w1"] * 3
        rows.append((i, " ".join(words)))
        labels.append((i, int(i % 4 == 0)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    right = [(x.score >= toxicity.LIMIT) == (x.doc_id % 4 == 0) for x in toxicity.score(docs, model).collect()]
    model.n = np.zeros_like(model.n)
    words_only = [(x.score >= toxicity.LIMIT) == (x.doc_id % 4 == 0) for x in toxicity.score(docs, model).collect()]
    assert sum(right) > 0.95 * len(rows) > 0.85 * len(rows) > sum(words_only)


def test_sample_is_bounded(marked):
    docs, labels = marked
    texts, share = toxicity.sampled(docs, labels, "doc_id", "text", "toxic", 50, 10**9)
    assert 0.1 < share < 0.3 and {r["toxic"]: r["count"] for r in texts.groupBy("toxic").count().collect()} == {0: 50, 1: 50}
    few, _ = toxicity.sampled(docs, labels, "doc_id", "text", "toxic", 50, 3000)
    size = {r["toxic"]: r["n"] for r in few.groupBy("toxic").agg(F.sum(F.length("text")).alias("n")).collect()}
    assert all(3000 <= n < 3000 + 1000 for n in size.values())


def test_toxicity_query(spark):
    sf = "/root/testdata/sf0.001"
    got = toxicity.op5_kneser_ney_toxicity(spark, sf)
    assert got.schema.simpleString() == "struct<doc_id:bigint,held_out:boolean,score:double,predicted:int>"
    got = got.collect()
    assert sorted(r.doc_id for r in got) == sorted(r.doc_id for r in spark.read.parquet(f"{sf}/documents.parquet").collect())
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)


def test_near_duplicate_rows(spark, folder):
    """A unique text keeps its row beside a repeated id; copies without an id go."""
    a, b = "one two three four five six seven", "another text of its own without any copy at all"
    rows = [(1, a, "x"), (2, a, "x"), (2, b, "x"), (None, a, "x"), (None, "copies only here and nowhere else today", "x"),
            (None, "copies only here and nowhere else today", "x"), (3, None, "x"), (3, None, "x"), (4, b + " B", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row string").withColumn("_group", F.lit("clash")).repartition(3)
    got = corpus_pipeline.drop_near_duplicates(spark, docs, folder)
    assert got.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=str) == sorted(
        [(1, a), (2, b), (None, rows[4][1]), (3, None), (3, None)], key=str)


def test_gradients():
    heads, tails, size = 70, 3, 4
    r = np.random.default_rng(0)
    ids = r.integers(0, heads + tails, 60).astype(np.int32)
    rows = np.array([0, 7, 30, 31, 60])
    p = {k: v.astype(np.float64) for k, v in gru.start(heads, tails, r.integers(1, 9, heads + tails), size).items()}
    p["bu"] += 0.1

    def loss(q):
        return -gru.score(q, ids, rows, heads, 3).sum() * np.log(10)

    moved = {k: v.copy() for k, v in p.items()}
    square = {k: np.zeros_like(v) for k, v in p.items()}
    gru.train(moved, ids, rows, heads, square, rate=0.0, lanes=3, steps=64)
    for k, v in p.items():
        for at in [tuple(r.integers(0, s) for s in v.shape) for _ in range(4)]:
            up, down = ({n: x.copy() for n, x in p.items()} for _ in range(2))
            up[k][at] += 1e-2
            down[k][at] -= 1e-2
            slope = (loss(up) - loss(down)) / 2e-2 / np.sqrt(len(ids))
            assert abs(abs(slope) - np.sqrt(square[k][at])) < 2e-3 + 0.02 * abs(slope)


def test_state_goes_through_whole_texts():
    r = np.random.default_rng(1)
    ids = r.integers(0, 70, 500).astype(np.int32)
    p = gru.start(64, 6, np.ones(70))
    whole = gru.score(p, ids, np.array([0, 500]), 64)
    state, out = np.zeros((1, p["u"].shape[0]), np.float32), []
    for t in range(500):
        s, state, _ = gru._run(p, ids[t:t + 1, None], np.array([[False]]), state, False)
        out.append(gru._output(p, s[0], ids[t:t + 1], 64, None)[0][0] / np.log(10))
    assert np.allclose(whole, out, atol=1e-4)


def test_model_sums_to_one():
    p = gru.start(100, 5, np.arange(105))
    s = np.random.default_rng(2).standard_normal((1, p["u"].shape[0])).astype(np.float32)
    logs = [gru._output(p, s, np.array([k], np.int32), 100, None)[0][0] for k in range(105)]
    assert abs(np.exp(logs).sum() - 1) < 1e-4


def test_language_model(clashing, rows):
    got = lm.score(clashing, heads=20, tails=4, known=50).collect()
    tokens = [(i, [*(t or "").encode().lower().split(), None]) for i, t in rows]
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 10 == 0
    c = Counter(w for i, t in tokens if not held(i) for w in t)
    total, distinct = sum(c.values()), len(c)
    want = sorted((str(i), held(i), len(t), sum(c[w] > 0 for w in t), total,
                   round(sum(math.log10((c[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in t), 6)) for i, t in tokens)
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    assert all(r.score < 0 for r in got)
    assert sum(r.score for r in got if r.held_out) > sum(r.base_score for r in got if r.held_out)


def test_language_model_of_nothing(nothing):
    assert lm.score(nothing).count() == 0


def test_words_are_counted_and_found_in_arrow(spark):
    texts = ["the The cat", "", "cat sat \u00e9t\u00e9 the", "zzz the"]
    found = {bytes(r.word): r.c for r in lm.word_counts(spark.createDataFrame([(t,) for t in texts], "text string")).collect()}
    assert found == {b"the": 4, b"cat": 2, b"sat": 1, "\u00e9t\u00e9".encode(): 1, b"zzz": 1, lm.END: 4}
    v = lm.Vocabulary([lm.END, b"the", b"cat", b"sat"], np.array([4, 4, 2, 1]), 4, np.ones(4), np.ones(4), 0.5, 13, 6, 2)
    for known, last in ((v.known(), [2, 3]), (v.known(v.heads), [-1, -1])):
        (_, a, b, words, place, ids, codes, rows), = lm._texts([pa.RecordBatch.from_pydict({"text": texts})], known, v)
        assert isinstance(words, pa.Array) and (a, b, rows.tolist()) == (0, 4, [0, 3, 3, 7, 9])
        assert place[codes].tolist() == [1, 1, last[0], last[0], last[1], -1, 1, -1, 1]
        tails = (2 + lm.tail_of(words, 4))[codes]
        assert ids[codes].tolist() == [1 if k == 1 else t for k, t in zip(place[codes], tails, strict=True)]


def test_pipeline(spark, folder, rows):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "near_duplicates", "pii", "packing"]
    scores = {(r.doc_id, r.text): r.score for r in toxicity.score(
        docs.select(F.struct("doc_id", "text").alias("d"), "text"), toxicity.fit(docs, labels), "d").select("d.*", "score").collect()}
    clean = corpus_pipeline.drop_toxic(spark, docs, folder)
    assert clean.columns == docs.columns
    kept = [(r.doc_id, r.text) for r in clean.collect()]
    assert sorted(kept, key=str) == sorted((k for k in rows if scores[k] < toxicity.LIMIT), key=str)
    unique = corpus_pipeline.drop_near_duplicates(spark, clean, folder)
    left = unique.collect()
    group = jaccard.near_duplicates(clean.select(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", F.xxhash64("text").alias("h")).cast("string").alias("k"), "text"), "k")
    kept = {(r.doc_id, r.text) for r in left}
    assert group.where("n_shingles > 0").agg(F.countDistinct("component_id")).first()[0] == sum(bool((t or "").split()) for _, t in kept)
    assert {r.doc_id for r in left} >= {130, 131, 132, None} and 121 not in {r.doc_id for r in left}
    red = corpus_pipeline.redact(spark, unique, folder)
    assert red.columns == docs.columns and not [r for r in red.collect() if base_spans(r.text or "")]
    assert corpus_pipeline.pack(spark, red, folder).select("doc_id").distinct().count() == red.select("doc_id").distinct().count()
    assert corpus_pipeline.run(spark, folder).agg(F.sum("length")).first()[0] == packing.tokenized(
        red, __import__("public_tokenizers").path("word_bpe_49k.json")).agg(F.sum("n")).first()[0]


def test_pipeline_of_an_empty_table(spark, nothing, folder):
    docs = nothing
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
    assert docs.count() == 0


def test_registered():
    assert sorted(int(k[2:].split("_")[0]) for k in catalog.QUERIES if k != "pipeline") == list(range(1, 14))


def test_search_oracle(spark):
    import duckdb

    con = duckdb.connect()
    con.execute("create view embeddings as select * from read_parquet('/root/testdata/sf0.01/embeddings.parquet')")
    want = sorted(con.execute(catalog.ORACLE_SQL["op9_uniform_threshold"]).fetchall())
    assert sorted(map(tuple, catalog.QUERIES["op9_uniform_threshold"](spark, "/root/testdata/sf0.01").collect())) == want


def test_model_sizes():
    assert lm.HEADS >= 2048 and lm.TAILS >= 32 and gru.SIZE >= 16
    p = gru.start(lm.HEADS, lm.TAILS, np.ones(lm.HEADS + lm.TAILS))
    assert p["w"].shape[0] * gru.GROUP >= 2048 and p["u"].shape[0] >= 16


def test_training_carries_state_through_long_texts(monkeypatch):
    r = np.random.default_rng(3)
    rows = np.array([0, 5000, 5010, 8000, 8001])
    ids = r.integers(0, 70, rows[-1]).astype(np.int32)
    p = gru.start(64, 6, np.ones(70))
    seen, run = [], gru._run

    def spy(p, ids, begins, h, keep):
        seen.append(begins.sum())
        return run(p, ids, begins, h, keep)

    monkeypatch.setattr(gru, "_run", spy)
    gru.train(p, ids, rows, 64, {k: np.full_like(x, 1e-8) for k, x in p.items()}, lanes=2)
    assert sum(seen) == 4
    places = [place[:, k] for place, _, live in gru.windows(ids, rows, 1) for k in range(live)]
    flat = np.concatenate(places)
    assert flat[flat >= 0].tolist() == [*range(5000), *range(5010, 8000), *range(5000, 5010), 8000]


@pytest.mark.parametrize("ordinary", [200, 1600])
def test_formulaic_insult_in_a_few_texts_is_evidence(spark, ordinary):
    r = random.Random(6)
    rows, labels = [], []
    for i in range(200 + ordinary):
        words = [f"w{r.randrange(300)}" for _ in range(40)]
        if i < 24:
            words[10:10] = ["you", "utter", "gronk"]
        rows.append((i, " ".join(words)))
        labels.append((i, int(i < 200)))
    model = toxicity.fit(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int"))
    words = toxicity._hashes([b"you", b"utter", b"gronk", b"w1"])
    assert model.numbers(words).max() < len(model.words)
    p = [model.probabilities(*model.strength[:2])]
    insult, plain = (model.scores(model.evidence(words[at], np.array([0, len(at)]), [model.strength], p)[0])[0] for at in ([3, 0, 1, 2], [3, 3, 3, 3]))
    assert insult > plain


def test_heading_slugs_are_no_marks():
    page = """<article><h1>Title of it</h1><p>Some words before.</p><h2 id="side-effects">Side effects</h2><p>They are few.</p>
<section id="related-work"><h3 id="form-and-function">Form and function</h3><p>Others did this.</p></section>
<div id="comments"><p>I like it.</p></div><div class="share-box">Share this</div></article>"""
    want = "Title of it\nSome words before.\nSide effects\nThey are few.\nForm and function\nOthers did this."
    assert html_text.main_texts([page], html_text.default_tree()) == [want]


@pytest.mark.parametrize("open_, close", [
    ('<div class="layout has-sidebar"><div id="content">', "</div></div>"), ('<div class="page no-header"><div class="post">', "</div></div>"),
    ('<div class="page sidebar-left"><div class="content">', "</div></div>"), ('<form id="whole" action="/"><div class="entry">', "</div></form>"),
    ('<div class="header-page">', "</div>"), ('<form><div class="side wrapper">', "</div></form>"), ("<div class=widgets><article>", "</article></div>"),
])
def test_marked_wrappers_keep_their_prose(open_, close):
    prose = [f"paragraph {n} " + "says something of its own in plain words that nobody links to from here " * 2 for n in range(4)]
    page = (f"<nav><a href=a>Home</a></nav>{open_}{''.join(f'<p>{p}</p>' for p in prose)}<div class=ad>{prose[0]} buy it</div>{close}"
            f"<div class=newsletter><form><p>{prose[1]} in your mail, and then a lot more of it</p></form></div>")
    assert html_text.main_texts([page], html_text.default_tree()) == ["\n".join(p.strip() for p in prose)]


@pytest.mark.parametrize("around", ['<div class="modal"><div class="content">{}</div></div>', '<div class="sidebar">{}</div>', "<form>{}</form>",
                                    '<div id="comments"><div class="post">{}</div></div>', '<div class="related"><div class="post">{}</div></div>'])
def test_marked_parts_stay_out(around):
    long = "".join(f"<p>a part beside the article with number {n} and a good many words in it to be taken for prose by its length</p>" for n in range(6))
    page = "<div class=content><p>The article is short, of one block, and has few words, but is marked.</p></div>" + around.format(long)
    assert html_text.main_texts([page], html_text.default_tree()) == ["The article is short, of one block, and has few words, but is marked."]


def test_page_of_nothing_but_parts():
    assert html_text.main_texts(['<div class="cookie-notice"><p>We use cookies so that every page of this site works for all of you each day.</p></div>'],
                                html_text.default_tree()) == [""]
