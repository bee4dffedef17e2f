"""Near duplicates, fingerprints and exact search against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re

import numpy as np
import pytest

from ordermart.llm import fingerprints, jaccard, topk


def shingles(text: str | None) -> frozenset:
    w = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    return frozenset(tuple(w[k:k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute_components(rows, percent=75):
    sets = [shingles(t) for _, t in rows]
    label = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                low, high = sorted((label[a], label[b]))
                label = [low if x == high else x for x in label]
    least: dict = {}
    for (i, _), x in zip(rows, label, strict=True):
        if i is not None:
            least[x] = min(least.get(x, i), i)
    return sorted(((i, len(s), least.get(x)) for (i, _), s, x in zip(rows, sets, label, strict=True)), key=str)


def test_components(clashing, rows):
    got = jaccard.near_duplicates(clashing).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_components(rows)


@pytest.mark.parametrize("seed, block", [(1, 1000), (2, 7)])  # with 7, large groups go by pairs of blocks
def test_components_of_borderline_texts(spark, seed, block):
    r = random.Random(seed)
    base = [[f"w{r.randrange(10**6)}" for _ in range(60)] for _ in range(4)]
    rows = []
    for i in range(120):
        words = list(r.choice(base))
        for _ in range(r.randrange(5)):
            words[r.randrange(len(words))] = f"n{r.randrange(10**6)}"
        rows.append((i, " ".join(words[:r.choice([60, 60, 50, 7, 5, 4])])))
    got = jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), tile=block, family=block)
    assert sorted((tuple(x) for x in got.collect()), key=str) == brute_components(rows)


def test_chain_of_components(spark):
    n = 60
    edges = spark.createDataFrame([(k, k + 1) for k in range(n)] + [(200, 300), (300, 201)], "a long, b long")
    got = dict(map(tuple, jaccard.components(edges).collect()))
    assert got == {k: 0 for k in range(n + 1)} | {200: 200, 201: 200, 300: 200}


def test_large_tiles_use_arrays():
    """Above 64 rows a tile's bitmaps are compared as arrays; both ways find the same."""
    r = random.Random(6)
    base = [np.array([r.randrange(2**63) for _ in range(150)], np.uint64) for _ in range(2)]
    sets = []
    for _ in range(90):
        s = r.choice(base).copy()
        for _ in range(r.randrange(40)):
            s[r.randrange(150)] = r.randrange(2**63)
        sets.append(np.unique(s[:r.choice([150, 130, 60])]))
    sets.sort(key=len)
    n, bits = [len(s) for s in sets], [jaccard.bitmap(s) for s in sets]

    def forest(parts):
        import pyarrow as pa

        batches = [pa.RecordBatch.from_arrays([pa.array([p] * len(k)), pa.array(k), pa.array([n[i] for i in k], pa.int32()),
                                               pa.array([bits[i] for i in k], pa.binary())], names=["part", "node", "n", "bits"]) for p, k in parts]
        out = [x for b in jaccard._possible(75)(iter(batches)) for x in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)]
        label = list(range(len(sets)))
        for a, b in out:
            label = [label[a] if x == label[b] else x for x in label]
        return label

    whole = forest([(1, list(range(90)))])
    for a in range(90):
        for b in range(a):
            if jaccard.similar(jaccard.most_overlap(bits[a], bits[b], n[a], n[b]), n[a], n[b], 75):
                assert whole[a] == whole[b]


def test_bitmap_bound_holds():
    r = np.random.default_rng(3)
    for _ in range(200):
        common = r.integers(0, 2**63, r.integers(0, 300), dtype=np.uint64)
        x, y = (np.unique(np.append(common, r.integers(0, 2**63, r.integers(1, 300), dtype=np.uint64))) for _ in range(2))
        assert jaccard.most_overlap(jaccard.bitmap(x), jaccard.bitmap(y), len(x), len(y)) >= len(np.intersect1d(x, y))


def test_no_documents(nothing):
    assert jaccard.near_duplicates(nothing).count() == 0
    assert fingerprints.edited_texts(nothing).count() == 0


def test_edited_texts(clashing, rows):
    got = fingerprints.edited_texts(clashing).collect()
    order = sorted(rows, key=lambda r: (-(r[0] if r[0] is not None else -math.inf), r[1] or ""))
    texts = [t or "" for _, t in order]
    want = []
    for k, (i, _) in enumerate(order):
        t, u = texts[k], texts[(k + 1) % len(texts)]
        edited = t[:len(t) - len(t) // 2] + u[:len(t) // 2]
        marks = fingerprints.fingerprints([t.encode(), edited.encode(), u.encode()])
        want.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), *marks[:2],
                     fingerprints.likeness(*marks[:2]), fingerprints.likeness(marks[0], marks[2])))
    assert sorted((tuple(r) for r in got), key=str) == sorted(want, key=str)


def test_parsing_is_local():
    r = random.Random(5)
    body = bytes(r.randrange(97, 123) for _ in range(6000))
    plain, moved, other = fingerprints.fingerprints([body, b"some words before " + body, bytes(reversed(body))])
    assert fingerprints.likeness(plain, moved) > 0.9 and fingerprints.likeness(plain, other) < 0.1
    half = fingerprints.fingerprints([body[:3000] + bytes(r.randrange(97, 123) for _ in range(3000))])[0]
    assert 0.35 < fingerprints.likeness(plain, half) < 0.65
    assert fingerprints.likeness("", "") == 1 and fingerprints.likeness("", plain) == 0


@pytest.fixture(scope="module")
def vectors():
    r = np.random.default_rng(8)
    rows = [(i, r.standard_normal(12).tolist()) for i in range(200)]
    rows += [(200 + i, rows[7][1]) for i in range(40)]  # one vector of many rows
    rows += [(300, None), (301, [1.0, None]), (302, [float("nan")] * 12), (303, [float("inf")] * 12), (304, [0.5] * 5), (305, []), (7, rows[7][1])]
    return rows


def brute_search(rows, k, scale=256):
    fit = {i: [math.floor(scale * x) for x in v] for i, v in rows
           if v is not None and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for q in sorted(fit):
        if q % 10 == 0:
            scores = sorted((-sum(a * b for a, b in zip(fit[q], v, strict=False)), i) for i, v in fit.items() if i != q)[:k]
            out += [(q, rank + 1, i, -s) for rank, (s, i) in enumerate(scores)]
    return out


@pytest.mark.parametrize("lists", [1, 2, 3])
def test_search(spark, vectors, lists):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(i, v, 1) for i, v in vectors], "vec_id long, embedding array<double>, v int").repartition(3)
    got = topk.search(df, F.col("id") % 10 == 0, 5, lists=lists, rows_a_block=32, queries_a_block=16)
    assert sorted(map(tuple, got.collect())) == brute_search(vectors, 5)


def test_search_few_rows(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(0, [1.0, -1.0]), (1, [0.5, 0.25]), (2, [-1.0, 0.0])], "vec_id long, embedding array<float>")
    got = sorted(map(tuple, topk.search(df, F.col("id") == 0, 5).collect()))
    assert got == [(0, 1, 1, 16384), (0, 2, 2, -65536)]
    assert topk.search(df.where("false"), F.col("id") == 0, 5).count() == 0


def test_search_broadcasts_nothing(spark, vectors, monkeypatch):
    """Neither vectors nor blocks go through the driver, though their files are below the threshold."""
    from pyspark.sql import functions as F

    plans = []
    stored = topk.stored
    shown = lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString())
    monkeypatch.setattr(topk, "stored", lambda df, name: shown(df) or stored(df, name))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10m")
    try:
        df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>").repartition(3)
        shown(topk.search(df, F.col("id") % 10 == 0, 5, rows_a_block=4, queries_a_block=16))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert len(plans) > 3 and not [p for p in plans if "Broadcast" in p]


def test_search_grid(spark):
    """Query blocks are sent as often as there are tasks for them, not to each candidate block."""
    from pyspark.sql import functions as F

    for queries, rows, tasks in [(1026, 51282, 12), (12308, 615384, 24), (480_000, 24_000_000, 600), (24_000_000, 24_000_000, 600), (0, 0, 200)]:
        parts, n = max(1, -(-queries // 512)), max(1, -(-rows // 2048))
        a, b = topk._grid(queries, parts, rows, n, 2, tasks, 368)
        assert 1 <= a <= parts and 1 <= b <= n and queries / a * 368 <= topk.RESIDENT and (b == 1 or 2 * a * b <= 2 * tasks)
    df = spark.range(40).select("id", F.array(F.col("id"), F.lit(1).cast("long")).alias("v"))
    left, right = topk._blocks(df, 2, 2, 2), topk._blocks(df, 20, 2, 2)
    sent = topk._cells(left, right, (1, 3), 2).withColumn("part", F.spark_partition_id())
    count = {r["kind"]: r["n"] for r in sent.groupBy("kind").agg(F.count("*").alias("n")).collect()}
    assert count == {0: left.count() * 3, 1: right.count()} and sent.where("part <> cell").count() == 0


@pytest.mark.parametrize("scale", [1, 256, 10**5, 10**8, 10**10])
def test_search_numbers_of_all_lengths(spark, vectors, monkeypatch, scale):
    from pyspark.sql import functions as F

    rows = [(i, v and [None if x is None else x / 100 if scale > 10**8 else x for x in v]) for i, v in vectors]
    monkeypatch.setattr(topk, "RESIDENT", 2000)  # several groups of query blocks
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = topk.search(df, F.col("id") % 10 == 0, 5, scale=scale, rows_a_block=16, queries_a_block=4)
    assert sorted(map(tuple, got.collect())) == brute_search(rows, 5, scale)


def test_likeness_of_a_cut_and_a_whole_list():
    names = sorted(random.Random(1).sample(range(1 << 32), 128))
    listed = lambda x: "".join(map("%08x".__mod__, sorted(x)[:64]))
    part = random.Random(2).sample(names, 60)
    got = fingerprints.likeness(listed(names), listed(part))
    assert abs(got - 2 * 60 / 188) < 0.1 and got == fingerprints.likeness(listed(part), listed(names))


def test_kept_names_grow_with_the_text():
    r = random.Random(7)
    text = bytes(r.randrange(97, 123) for _ in range(60_000))
    assert len(fingerprints.fingerprints([text])[0].split(".")[0]) > 64 * 8
