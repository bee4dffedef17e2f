"""MinHash near duplicates against brute force."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest

from ordermart.llm import minhash

SF = "/root/testdata/sf0.001"


def shingles(text: str | None) -> frozenset:
    w = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    return frozenset(tuple(w[k:k + 4]) for k in range(len(w) - 3)) if len(w) >= 4 else frozenset([tuple(w)] if w else [])


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    label = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * len(sets[a] | sets[b]) and label[a] != label[b]:
                low, high = sorted((label[a], label[b]))
                label = [low if x == high else x for x in label]
    least: dict = {}
    for (i, _), x in zip(rows, label, strict=True):
        if i is not None:
            least[x] = min(least.get(x, i), i)
    return sorted(((i, len(s), least.get(x), i == least.get(x)) for (i, _), s, x in zip(rows, sets, label, strict=True)), key=str)


def got(df, **more):
    return sorted((tuple(r) for r in minhash.near_duplicates(df, **more).collect()), key=str)


def test_components(clashing, rows):
    assert got(clashing) == brute(rows)


def test_nothing(nothing):
    assert got(nothing) == []


@pytest.mark.parametrize("seed, block, family", [(1, 4096, 1 << 20), (2, 5, 150)])  # small blocks: groups go by pairs of blocks
def test_components_of_borderline_texts(spark, seed, block, family):
    r = random.Random(seed)
    base = [[f"w{r.randrange(10**6)}" for _ in range(60)] for _ in range(4)]
    rows = []
    for i in range(150):
        words = list(r.choice(base))
        for _ in range(r.randrange(4)):
            words[r.randrange(len(words))] = f"n{r.randrange(10**6)}"
        rows.append((i, " ".join(words[:r.choice([60, 60, 50, 7, 4, 3])])))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert got(df, block=block, family=family) == brute(rows)


def test_families_of_unlike_texts(spark):
    """Two thirds in common: all pairs are candidates, few are links."""
    r = random.Random(9)
    common = [f"c{k}" for k in range(60)]
    rows = [(i, " ".join(common + [f"u{r.randrange(10**6)}" for _ in range(r.choice([12, 20, 25]))])) for i in range(60)]
    rows += [(100 + i, rows[i][1] + " tail") for i in range(0, 60, 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert got(df, agree=30, block=9, family=400) == brute(rows)


def test_a_pair_at_the_limit_is_found():
    """Tables of pairs of half keys find pairs of similarity 0.8 as computed: nearly all."""
    r = np.random.default_rng(3)
    lost = agree = 0
    for _ in range(300):
        every = r.integers(0, 1 << 63, 180, dtype=np.uint64)
        x, y = np.sort(every[:160]), np.sort(np.concatenate([every[:140], every[160:]]))  # 140 of 180: 0.78
        m = minhash.minhashes([x, y])
        h = minhash.half_keys(m)
        same = h[0] == h[1]
        lost += not (same[:minhash.HALVES].any() and same[minhash.HALVES:].any())
        agree += (m[0] & 255 == m[1] & 255).sum()
    assert lost <= 2
    assert abs(agree / 300 / minhash.MINHASHES - 0.78) < 0.02


def test_query(spark):
    from ordermart.llm.common import table

    rows = [tuple(x) for x in table(spark, SF, "documents").select("doc_id", "text").collect()]
    df = minhash.op11_tensored_minhash(spark, SF)
    assert df.schema.simpleString() == "struct<doc_id:bigint,n_shingles:bigint,component_id:bigint,kept:boolean>"
    assert sorted((tuple(x) for x in df.collect()), key=str) == brute(rows)
