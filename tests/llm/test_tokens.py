"""Byte-level BPE and packing against the tokenizer libraries."""

from __future__ import annotations

import binascii
import itertools

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ordermart.llm import bpe, common, packing

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")


def test_bpe_equals_the_library_and_decodes(clashing, rows):
    import tiktoken

    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(RANKS), special_tokens={})
    got = bpe.decode(bpe.encode(clashing, RANKS, public_tokenizers.PATTERN), RANKS).collect()
    found = sorted((r.doc_id or -1, tuple(r.ids), bytes(r.decoded)) for r in got)
    assert found == sorted((i or -1, tuple(plain.encode_ordinary(t or "")), (t or "").encode()) for i, t in rows)


def test_bpe_of_nothing(nothing):
    assert bpe.encode(nothing, RANKS, public_tokenizers.PATTERN).count() == 0


def test_lower_rank_goes_first():
    ranks = {bytes([b]): b for b in range(256)} | {b"bc": 256, b"abc": 257, b"ab": 300, b"abcd": 301, b"cd": 302, b"aa": 303}
    merges = bpe.Merges(ranks)
    import tiktoken

    plain = tiktoken.Encoding("own", pat_str=r"\S+|\s+", mergeable_ranks=ranks, special_tokens={})
    words = ["abcd", "aaaa", "aabcabcd", "cdcdab", "ab", "aaa"]
    ids, length = merges.encode(words)
    assert [x.tolist() for x in np.split(ids, np.cumsum(length)[:-1])] == [plain.encode_ordinary(w) for w in words]


def test_packing(clashing, rows):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(WORDS)
    t.encode_special_tokens = True
    want = sorted((i if i is not None else -1, [*t.encode(x or "", add_special_tokens=False).ids, 2]) for i, x in rows)
    pieces = packing.pack(clashing, WORDS, size=1024).withColumn("crc", F.crc32("ids")).collect()
    fill: dict = {}
    docs: dict = {}
    for p in pieces:
        ids = np.frombuffer(p.ids, "<u4").tolist()
        assert p.length == len(ids) > 0 and p.crc == binascii.crc32(np.array(ids, "<u4").tobytes())
        fill.setdefault(p.sequence_id, []).append((p.offset, p.length))
        docs.setdefault((p.doc_id if p.doc_id is not None else -1, p.doc_tokens), []).append((p.start, ids))
    sizes = []
    for parts in fill.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        sizes.append(at)
    assert sorted(fill) == list(range(len(fill))) and sorted(sizes)[1:] == [1024] * (len(sizes) - 1)
    assert sum(sizes) == sum(len(x) for _, x in want)
    for (i, n), parts in docs.items():
        copies = [x for k, x in want if k == i and len(x) == n]
        assert sorted(x for p in parts for x in p[1]) == sorted(x for c in copies for x in c)
        if len(copies) == 1:
            assert [x for _, part in sorted(parts) for x in part] == copies[0]


def test_packed_sequences(docs):
    whole = packing.sequences(packing.pack(docs.limit(20), WORDS, size=512)).collect()
    assert all(len(r.ids) == 4 * r.length for r in whole)


def test_words_are_cut_where_the_tokenizer_cuts():
    blocks = common.word_blocks(packing.lowered(pa.array(["Alpha, alpha. (ALPHA)x9 alpha"])), cuts=packing.cuts)
    assert [sorted(words.to_pylist()) for _, _, words, _, _ in blocks] == [[b"(", b")", b",", b".", b"9", b"alpha", b"x"]]


def test_cut_words_have_the_tokenizers_ids():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(WORDS)
    t.encode_special_tokens = True
    rng, odd = np.random.default_rng(3), [*"aJjIsltSre''.,!-=|<>  \t\n019\x01\x1c\x7f", "\u030c", "\u0338", "\u0307", "\u0301", "\u00a0", "\u2028", "é", "ß", "İ", "ŉ", "ı", "Σ", "你", "٣", "😀",
                                          "'ll", "Don't", "<|endoftext|>", "</w>", "word", "É", "ǰ"]
    texts = ["".join(rng.choice(odd, rng.integers(0, 40))) for _ in range(4000)] + ["J\u030c", "t\u0308 T\u0308", "A", ""]
    known = packing._words(WORDS)
    found = [ids[a:b].tolist() for _, _, words, codes, rows in common.word_blocks(packing.lowered(pa.array(texts)), limit=5000, cuts=packing.cuts)
             for _, _, ids, at in known.ids_of(words.to_pylist(), codes, rows, limit=300) for a, b in itertools.pairwise(at)]
    assert found == [x.ids for x in t.encode_batch(texts, add_special_tokens=False)]


def test_packing_nothing(nothing):
    assert packing.pack(nothing, WORDS).count() == 0


@pytest.mark.parametrize("bits", [1, 2, 3])
def test_hilbert_neighbours(bits):
    cells = np.array(np.meshgrid(*[range(1 << bits)] * 3, indexing="ij")).reshape(3, -1).T
    key = packing.hilbert(cells, bits)
    line = cells[np.argsort(key)]
    assert sorted(key.tolist()) == list(range(len(cells))) and set(np.abs(np.diff(line, axis=0)).sum(axis=1).tolist()) == {1}
