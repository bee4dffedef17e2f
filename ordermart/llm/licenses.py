"""License scans by patience alignment.

A text's words are aligned with each template's: words that stand once in both are
anchors, the longest increasing subsequence of the anchors is kept, and the gaps between
kept anchors are aligned the same way; where a gap has no such word, the longest common
subsequence of its words closes it. Of the aligned words the densest stretch counts: the
one with the most aligned words less the text's words between them. Coverage is its
aligned words over the template's words and the words between, so words scattered over a
text are no license. A stretch must hold the words that name the license, and none between
them that names another. A match of coverage `least` spans at most the template's length / `least` words, so the
text around a template's content words is aligned in overlapping ranges of twice that.

Defined results: A-Z are lower-cased, words end at ASCII white space and lose marks at
both ends; null text = empty text = no match; whole texts are scanned, however long, in
time linear in their length; a text may hold several matches; repeated rows are scanned each; an empty table gives
no rows; other columns are not read.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermart.llm.common import clean, columns, table, with_id, word_blocks

LEAST = 0.8
#: Well-known license notices.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MIT-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
                "associated documentation files (the \"Software\"), to deal in the Software without restriction",
    "Apache-2.0-text": "you may not use this file except in compliance with the License. You may obtain a copy of the License at",
    "GPL-3.0-text": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                    "General Public License as published by the Free Software Foundation, either version 3 of the License",
    "BSD-text": "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
                "that the following conditions are met",
}
#: Opening notices and whole licenses whose words are the same in every copy.
TEMPLATES["MIT-whole"] = TEMPLATES["MIT-text"] + """, including without limitation the rights to use, copy, modify, merge,
    publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished
    to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all
    copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
    IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND
    NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY,
    WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR
    OTHER DEALINGS IN THE SOFTWARE."""
TEMPLATES["ISC-whole"] = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee
    is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS
    PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
    MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL
    DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE
    OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
#: Words of a template that name its license; a match holds them all.
NAMING = {"Apache-2.0": "apache 2.0", "CC-BY-NC-4.0": "cc by-nc 4.0", "GPL-3.0": "gnu 3", "MIT": "mit",
          "GPL-3.0-text": "gnu 3"}
#: Words that name a license; between a match's words none may stand but its own.
NAMES = frozenset("affero agpl apache artistic bsd cc0 creative eclipse eupl gnu gpl isc lesser lgpl library microsoft mit mozilla mpl zlib".split())
#: Words that say little; all others of a template are its content words.
FUNCTION = frozenset("a an and any are as at be by can either except for free in is it may met not of on or that the this to "
                     "under use version with without work you".split())
MARKS = bytes(b for b in range(33, 127) if not chr(b).isalnum())


def normal(text: str) -> list[bytes]:
    return [w for w in (x.strip(MARKS) for x in text.encode().lower().split()) if w]


def increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Longest subsequence of pairs, sorted by the first and then falling by the second
    place, whose second places increase: patience piles with back links."""
    tops: list[int] = []
    at: list[int] = []
    back = [-1] * len(pairs)
    for i, (_, y) in enumerate(pairs):
        k = bisect_left(tops, y)
        back[i] = at[k - 1] if k else -1
        tops[k:k + 1] = [y]
        at[k:k + 1] = [i]
    out, i = [], at[-1] if at else -1
    while i >= 0:
        out.append(pairs[i])
        i = back[i]
    return out[::-1]


def align(text: list, template: list, x: int = 0, y: int = 0) -> list[tuple[int, int]]:
    """Aligned places (in text, in template), both increasing; x, y: places of the first words."""
    out, todo = [], [(0, len(text), 0, len(template))]
    while todo:
        a, b, c, d = todo.pop()
        if a >= b or c >= d:
            continue
        once = [{w: p for p, w in enumerate(words[lo:hi], lo) if n[w] == 1}
                for words, lo, hi in ((text, a, b), (template, c, d)) for n in (Counter(words[lo:hi]),)]
        anchors = increasing(sorted((p, once[1][w]) for w, p in once[0].items() if w in once[1]))
        if anchors:
            out += anchors
            edges = [(a - 1, c - 1), *anchors, (b, d)]
            todo += [(p + 1, r, q + 1, s) for (p, q), (r, s) in zip(edges, edges[1:], strict=False)]
        else:
            places: dict = {}
            for q in range(d - 1, c - 1, -1):
                places.setdefault(template[q], []).append(q)
            out += increasing([(p, q) for p in range(a, b) for q in places.get(text[p], ())])
    return sorted((p + x, q + y) for p, q in out)


def densest(places: list[tuple[int, int]]) -> tuple[int, int]:
    """First and last index of the run of aligned places with the most aligned words less
    the text's words between them; ties to the first, then the shortest."""
    best = (0, 0, 0)  # (score, first, last); a run's score is at least 1
    score = start = 0
    for k, (p, _) in enumerate(places):
        score = score + 1 - (p - places[k - 1][0] - 1) if k else 1
        if score <= 1:
            score, start = 1, k
        if score > best[0]:
            best = score, start, k
    return best[1], best[2]


class Scanner:
    def __init__(self, templates: dict[str, str], least: float, naming: dict[str, str] | None = None):
        self.least = least
        self.templates = {name: normal(t) for name, t in templates.items()}
        self.naming = {name: frozenset((naming or {}).get(name, "").encode().split()) for name in templates}
        self.foreign = {name: frozenset(w.encode() for w in NAMES) - self.naming[name] - frozenset(words) for name, words in self.templates.items()}
        self.content = {name: frozenset(words) - {f.encode() for f in FUNCTION} for name, words in self.templates.items()}
        self.every = frozenset().union(*self.content.values())

    def possible(self, words, name: str) -> bool:
        """Whether the words can hold a match: with its naming words, and with all content words
        but as many as a match may miss."""
        content, size = self.content[name], len(self.templates[name])
        may_miss = size - ceil(self.least * size)
        return self.naming[name].issubset(words) and len(content.intersection(words)) >= len(content) - may_miss

    def ranges(self, words: list[bytes], name: str):
        """Ranges of the text within a match's longest span of the template's content words."""
        reach = int(len(self.templates[name]) / self.least) + 1
        places = [p for p, w in enumerate(words) if w in self.content[name]]
        k = 0
        while k < len(places):
            a = places[k]
            while k + 1 < len(places) and places[k + 1] - places[k] <= 2 * reach:
                k += 1
            yield max(0, a - reach), min(len(words), places[k] + reach + 1)
            k += 1

    def match(self, words: list[bytes], a: int, b: int, name: str) -> tuple[int, int, float]:
        """(start, end, coverage) of the densest stretch in a range; coverage 0: no license."""
        template = self.templates[name]
        if b - a < self.least * len(template):
            return a, a, 0.0
        part = words[a:b]
        if not self.possible(part, name):
            return a, a, 0.0
        places = align(part, template, a)
        if len(places) < self.least * len(template):
            return a, a, 0.0
        i, j = densest(places)
        (start, first), (end, last) = places[i], places[j]
        aligned = {p for p, _ in places[i:j + 1]}
        while last + 1 < len(template) and end + 1 < b and words[end + 1] == template[last + 1]:  # its next word was aligned further on
            end, last = end + 1, last + 1
            aligned.add(end)
        while first and start > a and words[start - 1] == template[first - 1]:
            start, first = start - 1, first - 1
            aligned.add(start)
        end, n = end + 1, len(aligned)
        coverage = n / (len(template) + end - start - n)
        named = self.naming[name] <= {words[p] for p in aligned}
        between = self.foreign[name].isdisjoint(words[p] for p in range(start, end) if p not in aligned)
        return start, end, coverage if named and between and coverage >= self.least else 0.0

    def scan(self, words: list[bytes]) -> list[dict]:
        found = []
        if self.every.isdisjoint(words):
            return found
        present = set(words)
        for name, template in self.templates.items():
            if not self.possible(present, name):
                continue
            span = int(len(template) / self.least) + 1
            for at, stop in self.ranges(words, name):
                while at < stop:
                    after, todo = at + span, [(at, min(stop, at + 2 * span))]
                    while todo:
                        a, b = todo.pop()
                        start, end, coverage = self.match(words, a, b, name)
                        if coverage and (start < at + span or at + 2 * span >= stop):  # a later one lies whole in the next range
                            found.append({"license": name, "start": start, "end": end, "coverage": coverage})
                            after = max(after, end)
                        if end > start:
                            todo += [(a, start), (end, b)]
                    at = after
        return sorted(found, key=lambda f: (f["start"], f["license"]))


MATCHES = "array<struct<license:string,start:int,end:int,coverage:double>>"


def scan(df: DataFrame, templates: dict[str, str] | None = None, least: float = LEAST, id_col: str = "doc_id",
         text_col: str = "text", naming: dict[str, str] | None = None) -> DataFrame:
    """(id, matches) of every row: license, first word, word after the last, coverage.
    naming: the words (blank-separated) that each template's matches must hold."""
    naming = naming if naming is not None else NAMING if templates is None else {}
    templates = templates or TEMPLATES
    kind = pa.list_(pa.struct([("license", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("coverage", pa.float64())]))

    def run(batches):
        scanner = Scanner(templates, least, naming)
        for batch in columns(batches):
            for a, b, words, codes, rows in word_blocks(batch.column(1), lower=True):
                words = [w.strip(MARKS) for w in words.to_pylist()]
                hot = np.fromiter((w in scanner.every for w in words), bool, len(words))
                sums = np.append(0, np.cumsum(hot[codes]))
                out = []
                for i in range(len(rows) - 1):
                    lo, hi = rows[i], rows[i + 1]
                    some = sums[hi] > sums[lo]
                    out.append(scanner.scan([w for w in (words[c] for c in codes[lo:hi]) if w]) if some else [])
                yield pa.RecordBatch.from_arrays([batch.column(0)[a:b], pa.array(out, kind)], names=["doc_id", "matches"])

    rows = clean(df, id_col, text_col)
    return rows.mapInArrow(run, with_id(rows, f"matches {MATCHES}")).withColumnRenamed("doc_id", id_col)


def op6_patience_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents"))
    joined = F.array_join(F.transform("matches", lambda m: F.concat_ws(":", m["license"], m["start"].cast("string"), m["end"].cast("string"))), ",")
    return found.select("doc_id", F.size("matches").cast("long").alias("n_matches"), joined.alias("matches"),
                        F.coalesce(F.array_max(F.transform("matches", lambda m: m["coverage"])), F.lit(0.0)).alias("coverage"))
