"""Main text of web pages by shallow text features.

A page is read once into flat text blocks: the text between block-level tags, with its
number of words, the share of them inside links, and whether an enclosing element is
marked as the article or as something around it. A mark on a page's wrapper (a menu's or
form's word in the class of an element that holds most of the page's prose, and its
article mark if there is one) says nothing about the prose, and is taken back. A decision tree over these features
of the block and the words and link density of its two neighbours keeps or drops each
block. The tree is grown by Gini impurity from the labelled table below.

Defined results: null html = empty html = empty text; unclosed and stray tags, comments,
quotes and references are read leniently; pages of any length are read whole; repeated
rows are extracted each; an empty table gives no rows; a page without any block gives
an empty text.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermart.llm.common import columns, table

FEATURES = ["words", "links", "words_before", "links_before", "words_after", "links_after", "heading", "inside", "around"]
#: Labelled blocks, a row each: FEATURES, then 1 for main text. inside: in an element
#: marked as article; around: in one marked as menu, header, footer, advert, form, ...
LABELLED = [
    # menus, breadcrumbs, link lists
    (1, 1.0, 0, 0.0, 1, 1.0, 0, 0, 1, 0), (1, 1.0, 1, 1.0, 1, 1.0, 0, 0, 1, 0), (2, 1.0, 1, 1.0, 12, 0.0, 0, 0, 1, 0),
    (6, 1.0, 0, 0.0, 40, 0.1, 0, 0, 0, 0), (3, 1.0, 4, 1.0, 2, 1.0, 0, 0, 0, 0), (5, 0.8, 2, 1.0, 90, 0.0, 0, 0, 0, 0),
    (14, 0.9, 3, 1.0, 3, 1.0, 0, 0, 0, 0), (25, 0.7, 10, 0.6, 8, 1.0, 0, 0, 0, 0), (9, 0.5, 30, 0.0, 4, 1.0, 0, 0, 0, 0),
    (4, 1.0, 4, 1.0, 5, 1.0, 0, 1, 0, 0), (7, 1.0, 5, 1.0, 6, 1.0, 0, 1, 0, 0), (3, 1.0, 60, 0.0, 4, 1.0, 0, 1, 1, 0),
    # adverts, notices, sidebars, forms, footers, comments, whatever their length
    (11, 0.0, 1, 1.0, 9, 0.0, 0, 0, 1, 0), (30, 0.1, 2, 1.0, 8, 0.0, 0, 0, 1, 0), (80, 0.0, 5, 0.0, 60, 0.0, 0, 0, 1, 0),
    (16, 0.0, 70, 0.0, 0, 0.0, 0, 0, 1, 0), (3, 0.0, 50, 0.0, 12, 0.0, 1, 0, 1, 0), (45, 0.2, 4, 0.0, 3, 0.0, 0, 0, 1, 0),
    (20, 0.0, 25, 0.0, 22, 0.0, 0, 1, 1, 0), (120, 0.0, 4, 0.0, 90, 0.0, 0, 1, 1, 0), (2, 0.0, 90, 0.0, 30, 0.0, 1, 1, 1, 0),
    (7, 0.3, 100, 0.0, 2, 0.0, 0, 0, 1, 0), (9, 0.0, 0, 0.0, 7, 0.0, 0, 0, 1, 0), (200, 0.0, 0, 0.0, 6, 0.0, 0, 0, 1, 0),
    # unmarked: short lines away from prose
    (4, 0.0, 0, 0.0, 3, 1.0, 0, 0, 0, 0), (5, 0.0, 3, 1.0, 2, 1.0, 0, 0, 0, 0), (6, 0.0, 40, 0.0, 0, 0.0, 0, 0, 0, 0),
    (3, 0.0, 2, 0.0, 4, 0.0, 0, 0, 0, 0), (8, 0.2, 5, 0.5, 6, 0.3, 0, 0, 0, 0), (2, 0.0, 4, 1.0, 5, 1.0, 1, 0, 0, 0),
    (7, 0.0, 8, 0.0, 5, 1.0, 0, 0, 0, 0), (5, 0.0, 0, 0.0, 0, 0.0, 0, 0, 0, 0),
    # unmarked prose, its headings and its short lines between long ones
    (40, 0.0, 8, 0.0, 60, 0.0, 0, 0, 0, 1), (25, 0.1, 6, 0.0, 30, 0.0, 0, 0, 0, 1), (90, 0.05, 4, 1.0, 20, 0.0, 0, 0, 0, 1),
    (15, 0.0, 40, 0.0, 50, 0.0, 0, 0, 0, 1), (6, 0.0, 35, 0.0, 45, 0.0, 0, 0, 0, 1), (7, 0.0, 3, 1.0, 55, 0.0, 1, 0, 0, 1),
    (5, 0.0, 60, 0.0, 70, 0.0, 1, 0, 0, 1), (30, 0.2, 40, 0.1, 2, 1.0, 0, 0, 0, 1), (150, 0.0, 0, 0.0, 0, 0.0, 0, 0, 0, 1),
    (22, 0.0, 20, 0.0, 8, 1.0, 0, 0, 0, 1), (9, 0.0, 0, 0.0, 80, 0.0, 1, 0, 0, 1), (70, 0.25, 90, 0.1, 60, 0.0, 0, 0, 0, 1),
    # marked as article, also where short
    (8, 0.0, 12, 0.0, 9, 0.0, 1, 1, 0, 1), (1, 0.0, 9, 0.0, 20, 0.0, 1, 1, 0, 1), (4, 0.0, 30, 0.0, 16, 0.0, 0, 1, 0, 1),
    (2, 0.0, 0, 0.0, 3, 0.0, 0, 1, 0, 1), (60, 0.0, 8, 0.0, 50, 0.0, 0, 1, 0, 1), (12, 0.3, 60, 0.0, 10, 0.0, 0, 1, 0, 1),
    (300, 0.0, 10, 0.0, 12, 0.0, 0, 1, 0, 1), (3, 1.0, 60, 0.0, 40, 0.0, 0, 1, 0, 1), (10, 0.6, 25, 0.0, 30, 0.1, 0, 1, 0, 1),
    (7, 0.0, 3, 1.0, 5, 0.0, 0, 1, 0, 1), (5, 0.0, 4, 0.0, 2, 1.0, 0, 1, 0, 1), (1, 0.0, 1, 0.0, 1, 0.0, 0, 1, 0, 1),
    (9, 1.0, 40, 0.0, 14, 0.0, 1, 1, 0, 1), (2, 1.0, 11, 0.0, 0, 0.0, 0, 1, 0, 1), (3, 0.0, 14, 0.0, 95, 0.0, 0, 1, 0, 1),
    (6, 0.0, 11, 0.0, 130, 0.0, 1, 1, 0, 1), (50, 0.0, 200, 0.0, 240, 0.0, 0, 1, 0, 1), (2, 0.0, 2, 1.0, 600, 0.0, 0, 1, 0, 1),
    (17, 0.1, 7, 0.0, 88, 0.3, 0, 1, 0, 1), (80, 0.0, 9, 0.4, 1, 1.0, 0, 1, 0, 1), (95, 0.0, 140, 0.0, 4, 0.0, 0, 1, 0, 1),
    (900, 0.0, 700, 0.0, 800, 0.0, 0, 1, 0, 1), (8, 0.0, 900, 0.0, 2, 0.0, 0, 1, 0, 1), (20, 0.0, 15, 0.5, 170, 0.1, 0, 1, 0, 1),
    (4, 0.0, 1, 1.0, 33, 0.2, 1, 1, 0, 1), (13, 0.0, 3, 0.0, 300, 0.0, 0, 1, 0, 1), (35, 0.6, 80, 0.2, 100, 0.1, 0, 1, 0, 1),
    (5, 0.0, 18, 0.2, 6, 1.0, 0, 1, 0, 1), (28, 0.0, 6, 1.0, 3, 1.0, 0, 1, 0, 1), (6, 0.4, 3, 0.3, 5, 0.5, 0, 1, 0, 1),
    (11, 0.0, 0, 0.0, 400, 0.0, 1, 1, 0, 1), (70, 0.0, 10, 1.0, 160, 0.0, 0, 1, 0, 1), (3, 0.0, 5, 1.0, 4, 1.0, 1, 1, 0, 1),
    # unmarked prose beside long and short neighbours
    (35, 0.0, 120, 0.0, 150, 0.0, 0, 0, 0, 1), (60, 0.0, 9, 0.0, 100, 0.1, 0, 0, 0, 1), (45, 0.1, 2, 1.0, 3, 1.0, 0, 0, 0, 1),
    (110, 0.0, 250, 0.0, 5, 0.0, 0, 0, 0, 1), (18, 0.0, 90, 0.0, 130, 0.0, 0, 0, 0, 1), (500, 0.1, 3, 0.0, 4, 1.0, 0, 0, 0, 1),
    # unmarked line, link or label that isn't
    (3, 0.0, 100, 0.0, 4, 1.0, 0, 0, 0, 0), (4, 0.5, 120, 0.0, 150, 0.0, 0, 0, 0, 0), (5, 1.0, 80, 0.0, 100, 0.0, 0, 0, 0, 0),
    (18, 0.9, 60, 0.0, 70, 0.0, 0, 0, 0, 0), (6, 0.0, 9, 0.3, 3, 0.0, 0, 0, 0, 0), (9, 0.1, 4, 0.0, 2, 1.0, 0, 0, 0, 0),
]

BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption "
                   "figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol p pre section "
                   "summary table tbody td tfoot th thead title tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset("head title button select option datalist object audio video svg math canvas map".split())
AROUND = frozenset("nav footer aside form menu dialog header fieldset".split())
MARKED = re.compile(r"(?:^|[\s_-])(?:nav(?:bar|igation)?|menu|ads?|advert\w*|banner|side-?bar|side|cookies?|notices?|consent|gdpr|"
                    r"pop-?up|modal|foot(?:er)?|header|masthead|related|share|sharing|social|promo\w*|sponsor\w*|newsletter|"
                    r"subscri\w*|bread-?crumbs?|widgets?|form|login|sign-?up|toolbar|pag(?:er|ination)|skip|alert|(comments?|respond|"
                    r"disqus|repl(?:y|ies)|discussion))(?:$|[\s_-]|\d)", re.I)
ARTICLE = re.compile(r"(?:^|[\s_-])(?:article|content|post|entry|story|main|body-?text)(?:$|[\s_-]|\d)", re.I)
#: Words of a layout that say which parts a page has, not what an element is.
LAYOUT = re.compile(r"(?:^|(?<=[\s_-]))(?:has|no|with|without|hide|show)[_-][\w-]+", re.I)
WRAPPERS = frozenset("div section form table tbody tr td center".split())
PROSE, LINKED = 15, 0.3  # words at least, link density below: a block of prose
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|noscript|template|textarea|iframe|xmp|noembed|noframes)\b[^>]*+>.*?(?:</\1\s*+[^>]*+>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|</?[a-zA-Z][^>]*+>|<[!?/][^>]*+(?:>|\Z)", re.S | re.I)
NAMES = re.compile(r"(?:^|\s)(class|id|role|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)


@dataclass
class Block:
    text: str
    words: int
    links: float
    heading: bool
    inside: bool
    around: bool
    wrappers: tuple[int, ...] = ()  # marked wrappers around it, by number


def _names(attributes: str, inside: bool) -> str:
    """Inside an article an id or label is often a heading's slug: only whole values count."""
    if "=" not in attributes:
        return ""
    found = ((k.lower(), a or b or c) for k, a, b, c in NAMES.findall(attributes))
    return LAYOUT.sub("", " ".join(v for k, v in found if not inside or k in ("class", "role") or MARKED.fullmatch(v.strip())))


def _take_back(blocks: list[Block]) -> None:
    """Takes back the marks of wrappers that hold the page's prose: all of its article blocks
    and over half of its prose; on a page without article marks also three blocks of it, and five times
    the prose outside of all marks."""
    open_ = [b for b in blocks if not b.around]
    prose = [b for b in open_ if b.words >= PROSE and b.links < LINKED]
    whole, plain = sum(b.words for b in prose), sum(b.words for b in prose if not b.wrappers)
    article = any(b.inside for b in open_)
    for wrapper in {w for b in prose for w in b.wrappers}:
        held = [b for b in prose if wrapper in b.wrappers]
        words = sum(b.words for b in held)
        if article:
            back = all(wrapper in b.wrappers for b in open_ if b.inside)
        else:
            back = len(held) >= 3 and words >= 5 * plain
        if back and 2 * words > whole:
            for b in open_:
                b.wrappers = tuple(w for w in b.wrappers if w != wrapper)
    for b in blocks:
        b.around = b.around or bool(b.wrappers)


def blocks_of(page: str) -> list[Block]:
    """Flat text blocks of a page in order."""
    out: list[Block] = []
    parts: list[str] = []
    linked = anchor = numbered = 0
    # tag; inside; around (2: comments); silent; marked wrappers
    stack: list[tuple[str, bool, int, bool, tuple[int, ...]]] = [("", False, 0, False, ())]

    def flush() -> None:
        nonlocal linked
        words = html.unescape("".join(parts)).split()
        if words:
            _, inside, around, _, wrappers = stack[-1]
            heading = any(t[0] in ("h1", "h2", "h3", "h4", "h5", "h6") for t in stack[-3:])
            out.append(Block(" ".join(words), len(words), min(1.0, linked / len(words)), heading, inside, around > 0, wrappers))
        parts.clear()
        linked = 0

    at = 0
    for m in TOKEN.finditer(page):
        if m.start() > at and not stack[-1][3]:
            parts.append(text := page[at:m.start()])
            if anchor:
                linked += len(text.split())
        at = m.end()
        tag = m[3]
        if not tag:
            continue
        tag = tag.lower()
        if tag == "a":
            anchor = 0 if m[2] else 1
        elif tag == "br":
            parts.append(" ")
        elif tag not in BLOCKS and tag not in SILENT:
            continue
        elif m[2]:
            if tag in BLOCKS:
                flush()
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == tag:
                    del stack[k:]
                    break
        else:
            if tag in BLOCKS:
                flush()
                if stack[-1][0] == "p" or stack[-1][0] == tag and tag in ("li", "dt", "dd", "td", "th", "tr", "option"):
                    stack.pop()  # left open, and closed by this tag
            if tag in VOID or m[4].endswith("/") and tag in SILENT:
                continue
            _, inside, around, silent, wrappers = stack[-1]
            names = "" if tag in ("html", "body") else _names(m[4], inside)
            marked = MARKED.search(names) if names else None
            if tag in WRAPPERS and not inside and not around and (tag == "form" or marked and not marked[1]):
                numbered += 1
                wrappers = *wrappers, numbered
            elif marked and tag not in ("article", "main") or marked and marked[1]:
                around = 2 if marked[1] or around == 2 else 1
            elif tag in AROUND:
                around = max(around, 0 if tag == "header" and inside else 1)
            elif tag in ("article", "main"):
                inside, around, wrappers = True, around if around == 2 else 0, ()
            elif names and ARTICLE.search(names):
                inside = True
            silent = silent or tag in SILENT
            stack.append((tag, inside, around, silent, wrappers))
    if not stack[-1][3]:
        tail = page[at:]
        cut = re.search(r"<[a-zA-Z/!][^<>]*\Z", tail)  # a tag that the page's end cuts off
        parts.append(tail[:cut.start()] if cut else tail)
    flush()
    _take_back(out)
    return out


def features(blocks: list[Block]) -> np.ndarray:
    if not blocks:
        return np.empty((0, len(FEATURES)))
    own = np.array([[b.words, b.links] for b in blocks], float)
    edge = np.zeros((1, 2))
    marks = np.array([[b.heading, b.inside, b.around] for b in blocks], float)
    return np.hstack([own, np.vstack([edge, own[:-1]]), np.vstack([own[1:], edge]), marks])


def grow(rows: np.ndarray, labels: np.ndarray, depth: int = 6) -> tuple:
    """Decision tree: (share of 1,) or (feature, limit, tree below, tree above). Ties
    of the impurity go to the last feature and the lowest limit."""
    share = float(labels.mean())
    best = None
    if depth and 0 < share < 1:
        for f in reversed(range(rows.shape[1])):
            values = np.unique(rows[:, f])
            for limit in (values[1:] + values[:-1]) / 2:
                low = rows[:, f] < limit
                cost = sum(len(y) * y.mean() * (1 - y.mean()) for y in (labels[low], labels[~low]))
                if best is None or cost < best[0] - 1e-12:
                    best = cost, f, float(limit), low
    if best is None:
        return (share,)
    _, f, limit, low = best
    return f, limit, grow(rows[low], labels[low], depth - 1), grow(rows[~low], labels[~low], depth - 1)


def apply_tree(tree: tuple, rows: np.ndarray) -> np.ndarray:
    if len(tree) == 1:
        return np.full(len(rows), tree[0])
    low = rows[:, tree[0]] < tree[1]
    out = np.empty(len(rows))
    out[low] = apply_tree(tree[2], rows[low])
    out[~low] = apply_tree(tree[3], rows[~low])
    return out


@cache
def default_tree() -> tuple:
    known = np.array(LABELLED, float)
    return grow(known[:, :-1], known[:, -1])


def main_texts(pages: list[str], tree: tuple) -> list[str]:
    """Main text of each page; all pages' blocks are classified together."""
    each = [blocks_of(p) for p in pages]
    keep = apply_tree(tree, np.vstack([features(b) for b in each] or [np.empty((0, len(FEATURES)))])) >= 0.5
    out, at = [], 0
    for blocks in each:
        out.append("\n".join(b.text for b, k in zip(blocks, keep[at:at + len(blocks)], strict=True) if k))
        at += len(blocks)
    return out


def extract(df: DataFrame, id_col: str = "page_id", html_col: str = "html", tree: tuple | None = None) -> DataFrame:
    """(id, text) of every page."""
    tree = tree or default_tree()

    def run(batches):
        for batch in columns(batches):
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(main_texts(part.column(1).to_pylist(), tree), pa.string())],
                                                 names=["page_id", "text"])

    rows = df.select(F.col(id_col).alias("page_id"), F.coalesce(F.col(html_col), F.lit("")).alias("html"))
    kind = rows.schema["page_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"page_id {kind}, text string").withColumnRenamed("page_id", id_col)


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select(F.struct("page_id", "url").alias("page"), "html")
    return extract(pages, "page").select("page.page_id", "page.url", "text", F.length("text").cast("long").alias("n_chars"))
