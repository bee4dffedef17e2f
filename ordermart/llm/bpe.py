"""Byte-level BPE by corpus-level merge replay.

The texts of a task's Arrow batches are the corpus: their distinct matches of the
split pattern are laid end to end in one array of byte tokens. An inverted index
holds, for each merge rank, the positions whose token pair merges to that rank. The
ranks are replayed in ascending order; a merge touches only the positions in its
index entry and enters the pairs of their two neighbours anew. Within a word the
leftmost place merges first, and a lower rank that a merge brings up goes next, so
each word's ids are those of merging it alone.

Defined results: null text = empty text = no ids; any text length; equal texts have
equal ids; repeated rows are encoded each; an empty table gives an empty result;
other columns, also ones named like the result's, are not read.
"""

from __future__ import annotations

import base64
import heapq
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordermart.llm.common import IdTable, WordIds, added, binary_array, clean, columns, row_groups, spans, table, word_blocks

NONE = np.int32(2**31 - 1)


@cache
def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (x.split() for x in f if x.strip())}


class Merges:
    """Rank of each mergeable token pair: every split of a token into two tokens."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.base = max(ranks.values()) + 1
        found = [(ranks[t[:k]] * self.base + ranks[t[k:]], r)
                 for t, r in ranks.items() for k in range(1, len(t))
                 if t[:k] in ranks and t[k:] in ranks]
        found.sort()
        self.pairs = np.array([p for p, _ in found] or [-1], np.int64)
        self.rank = np.array([r for _, r in found] or [NONE], np.int64)
        self.of_byte = np.array([ranks[bytes([b])] for b in range(256)], np.int64)

    def of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of (left, right), NONE where they don't merge."""
        want = left.astype(np.int64) * self.base + right
        at = np.minimum(np.searchsorted(self.pairs, want), len(self.pairs) - 1)
        return np.where(self.pairs[at] == want, self.rank[at], NONE)

    def encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct words end to end, and their number for each word."""
        raw = [w.encode() for w in words]
        whole = np.array([self.ranks.get(w, -1) for w in raw], np.int64)
        length = np.where(whole >= 0, 1, np.array([len(w) for w in raw], np.int64))
        starts = np.cumsum(length) - length
        tokens = np.empty(int(length.sum()), np.int32)
        tokens[starts[whole >= 0]] = whole[whole >= 0]
        rest = np.flatnonzero(whole < 0)
        data = np.frombuffer(b"".join(raw[i] for i in rest), np.uint8)
        tokens[spans(starts[rest], length[rest])] = self.of_byte[data]
        word = np.repeat(np.arange(len(words), dtype=np.int32), length)
        alive = self.replay(tokens, word)
        return tokens[alive], np.bincount(word[alive], minlength=len(words))

    def replay(self, token: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Apply all merges in place; which positions still begin a token."""
        n = len(token)
        alive = np.ones(n, bool)
        after = np.arange(1, n + 1, dtype=np.int32)
        before = np.arange(-1, n - 1, dtype=np.int32)
        pair = np.full(n + 1, NONE, np.int32)
        inner = np.flatnonzero(word[:-1] == word[1:])
        pair[inner] = self.of(token[inner], token[inner + 1])
        index: dict[int, list[np.ndarray]] = {}
        self._enter(index, pair, inner)
        todo = list(index)
        heapq.heapify(todo)
        while todo:
            rank = heapq.heappop(todo)
            if rank not in index:
                continue
            at = np.concatenate(index.pop(rank))
            at = at[pair[at] == rank]
            if not len(at):
                continue
            if len(at) > 1:
                at = np.unique(at)
                first = np.ones(len(at), bool)
                first[1:] = word[at[1:]] != word[at[:-1]]
                if not first.all():  # the others wait until the first one's word has settled
                    index[rank] = [at[~first]]
                    at = at[first]
            gone = after[at]
            token[at] = rank
            alive[gone] = False
            pair[gone] = NONE
            follow = after[gone]
            after[at] = follow
            inside = follow < n
            before[follow[inside]] = at[inside]
            has = inside.copy()
            has[inside] = word[follow[inside]] == word[at[inside]]
            pair[at] = NONE
            pair[at[has]] = self.of(token[at[has]], token[follow[has]])
            prior = before[at]
            near = prior >= 0
            near[near] = word[prior[near]] == word[at[near]]
            left = prior[near]
            pair[left] = self.of(token[left], token[at[near]])
            fresh = self._enter(index, pair, np.concatenate([at, left]))
            if rank in index:
                fresh.append(rank)
            for r in fresh:
                heapq.heappush(todo, r)
        return alive

    @staticmethod
    def _enter(index: dict, pair: np.ndarray, at: np.ndarray) -> list[int]:
        """File positions under their pair's rank; the ranks that were not there before."""
        at = at[pair[at] < NONE]
        if not len(at):
            return []
        rank = pair[at]
        order = np.argsort(rank, kind="stable")
        at, rank = at[order], rank[order]
        cuts = np.flatnonzero(rank[1:] != rank[:-1]) + 1
        fresh = []
        for r, part in zip(rank[np.concatenate([[0], cuts])].tolist(), np.split(at, cuts), strict=True):
            if r in index:
                index[r].append(part)
            else:
                index[r] = [part]
                fresh.append(r)
        return fresh


#: White space outside ASCII, UTF-8: a run of it may go on into the next chunk's.
WIDE_SPACE = tuple(chr(c).encode() for c in [0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000])


class ChunkEncoder:
    """Ids of chunks, which are words with the ASCII white space before them. No match
    of the split pattern reaches over the end of a chunk, unless the chunk ends in
    other white space."""

    def __init__(self, path: str, pattern: str):
        self.merges = Merges(load_ranks(path))
        self.split = regex.compile(pattern).findall
        self.known = IdTable(self.chunks)

    def chunks(self, chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        words = WordIds()
        numbers = [[words[w] for w in self.split(c.decode())] for c in chunks]
        ids, length = self.merges.encode(list(words))
        use = np.array([n for x in numbers for n in x], np.int64)
        flat = ids[spans((np.cumsum(length) - length)[use], length[use])]
        ends = np.concatenate([[0], np.cumsum(length[use])])
        last = np.cumsum([len(x) for x in numbers])
        return flat, np.diff(ends[last], prepend=0)

    def blocks(self, column: pa.Array):
        """(first row, row after the last, ids, row offsets) for a block of rows at a time."""
        for a, b, words, codes, rows in word_blocks(column, spaced=True):
            words = words.to_pylist()
            if any(w.endswith(WIDE_SPACE) for w in words):
                ids, length = self.chunks(column[a:b].cast(pa.binary()).to_pylist())
                yield a, b, ids, np.concatenate([[0], np.cumsum(length)])
            else:
                for i, j, ids, offsets in self.known.ids_of(words, codes, rows):
                    yield a + i, a + j, ids, offsets


@cache
def _encoder(path: str, pattern: str) -> ChunkEncoder:
    return ChunkEncoder(path, pattern)


def encode(df: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id",
           text_col: str = "text", decoded: bool = False) -> DataFrame:
    """(id, ids array<int>) of every row; each match of pattern is merged by itself.
    decoded: also the bytes that the ids stand for, decoded in the same worker."""

    def run(batches):
        for batch in columns(batches):
            for a, b, ids, offsets in _encoder(ranks_path, pattern).blocks(batch.column(1)):
                out = [batch.column(0)[a:b],
                       pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))]
                if decoded:
                    out.append(_bytes_of(ranks_path, ids, offsets))
                yield pa.RecordBatch.from_arrays(out, names=["doc_id", "ids", "decoded"][:len(out)])

    rows = clean(df, id_col, text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, ids array<int>" + ", decoded binary" * decoded
    return rows.mapInArrow(run, schema).withColumnRenamed("doc_id", id_col)


@cache
def _pieces(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ranks = load_ranks(path)
    pieces = [b""] * (max(ranks.values()) + 1)
    for piece, r in ranks.items():
        pieces[r] = piece
    length = np.array([len(x) for x in pieces], np.int64)
    return np.frombuffer(b"".join(pieces), np.uint8), np.cumsum(length) - length, length


def _bytes_of(path: str, ids: np.ndarray, offsets: np.ndarray) -> pa.Array:
    data, start, length = _pieces(path)
    ends = np.concatenate([[0], np.cumsum(length[ids])])
    return binary_array(data[spans(start[ids], length[ids])], ends[offsets])


def decode(df: DataFrame, ranks_path: str, ids_col: str = "ids") -> DataFrame:
    """df with a binary column `decoded`: the bytes that the ids stand for."""

    def run(batches):
        for whole in columns(batches):
            count = whole.column(ids_col).value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            offsets = np.concatenate([[0], np.cumsum(count)])
            for a, b in row_groups(offsets, 250_000):
                batch = whole.slice(a, b - a)
                ids = batch.column(ids_col).flatten().to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, _bytes_of(ranks_path, ids, offsets[a:b + 1] - offsets[a])],
                    names=[*batch.schema.names, "decoded"])

    return df.mapInArrow(run, added(df, decoded=T.BinaryType()))


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    coded = encode(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN, decoded=True)
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
