"""Main text of web pages as the maximum-scoring subsequence of their tokens.

A page is a sequence of words and tags.  Words score positive and tags negative; one
linear scan finds the contiguous region with the largest sum.  The weights come from
labelled pages, those that mark their article themselves:

* a tag (by its name, its class, id or role, and what it stands in) costs the more, the
  more often it stands outside the articles of the labelled pages;
* a word is worth the log odds of being article text under the nearest marked elements
  around it, and nothing where they are below zero: a menu's words count for no region
  and are left out of the one that is found.

Tags that no labelled page shows cost little, so a region reaches over an advert or a list
inside an article; words in elements that no labelled page shows count unless a short list
of names says that they surround articles.  The labelled sample is bounded
(``SAMPLE_PAGES``); every page is extracted whole, without a shuffle.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SAMPLE_PAGES = 4000
#: Longer pages are not learned from, so the sample and the keys in it are bounded.
SAMPLE_CHARS = 200_000
WORD_LIMIT, TAG_LIMIT, TAG_LEAST, TAG_UNSEEN = 4.0, 25.0, 0.01, 0.5

#: Fixed lists of HTML element names.
RAW = ("script", "style", "noscript", "template", "textarea", "svg", "iframe", "select", "object", "math")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset((
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p "
    "pre search section summary table tbody td tfoot th thead title tr ul").split())
#: Elements whose words are judged by the element itself, with or without a class.
MARKED = frozenset((
    "article aside body button dialog fieldset figcaption footer form head header label main menu nav section "
    "title").split())
#: Opening one of these closes an open paragraph.
CLOSES_P = BLOCK - {"p", "body", "html", "head", "title", "td", "th", "tr", "tbody", "option", "legend", "summary"}
#: Words in a class, id or role that name what surrounds an article; and elements that do so alone.
AROUND = re.compile(
    r"(?:^|[^a-z])(?:ad|ads|advert\w*|banner|breadcrumb\w*|comment\w*|consent|contentinfo|cookie\w*|disqus|footer|"
    r"form|header|masthead|menu|nav\w*|newsletter|notice|pager|pagination|popup|promo\w*|related|repl(?:y|ies)|"
    r"responses?|search|share|sharing|sidebar|signup|social|sponsor\w*|subscribe|toolbar|widget)(?:[^a-z]|$)")
AROUND_ELEMENTS = frozenset("aside button dialog fieldset footer form head header label menu nav title".split())

_OPEN = re.compile(r"<(?:(!--)|(!\[CDATA\[)|([!?])|(/?)([a-zA-Z][a-zA-Z0-9:-]*))", re.IGNORECASE)
_RAW = re.compile("<(" + "|".join(RAW) + r")\b", re.IGNORECASE)
_RAW_END = {name: re.compile(rf"</{name}\s*>", re.IGNORECASE) for name in RAW}
_SPECIAL = re.compile("[>\"']")
_MARK = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)


class TagEnds:
    """Where tags end, each character looked at a bounded number of times.

    A tag ends at the first ``>`` outside quotes.  Where a quote never closes there is no end;
    what was learned about a ``>`` or quote holds for every tag that comes to it.
    """

    def __init__(self, html: str):
        self.html = html
        self.known: dict[int, int] = {}
        self.last: dict[str, int] = {}      # quotes that do not occur behind a place
        self.free = (0, -1)                 # from here to there nothing ends a tag or opens a quote

    def after(self, at: int) -> int:
        """The place behind the ``>`` of a tag whose name ends at ``at``; -1 if there is none."""
        path = []
        end = -1
        while True:
            if self.free[0] <= at <= self.free[1]:
                here = self.free[1]
            else:
                m = _SPECIAL.search(self.html, at)
                here = m.start() if m else len(self.html)
                if not path:
                    self.free = at, here
            if here == len(self.html):
                break
            if here in self.known:
                end = self.known[here]
                break
            path.append(here)
            quote = self.html[here]
            if quote == ">":
                end = here + 1
                break
            close = -1 if here >= self.last.get(quote, len(self.html)) else self.html.find(quote, here + 1)
            if close < 0:
                self.last[quote] = min(here, self.last.get(quote, here))
                break
            at = close + 1
        if len(path) > 1 or end < 0:
            self.known.update(dict.fromkeys(path, end))
        return end


def markup(html: str) -> Iterator[tuple[int, int, str, bool, str]]:
    """``(start, end, name, is a closing tag, attributes)`` of each piece of markup, in order.

    Comments, declarations, scripts and the like have no name.  A ``<`` that begins nothing
    whole is text.
    """
    ends = TagEnds(html)
    at = 0
    gone: set[str] = set()      # closing marks that do not occur any more

    def find(mark: str, begin: int) -> int:
        """The place behind the next ``mark``; -1 if there is none."""
        where = -1 if mark in gone else html.find(mark, begin)
        if where < 0:
            gone.add(mark)
            return -1
        return where + len(mark)

    while m := _OPEN.search(html, at):
        start = m.start()
        end, name, attributes = -1, "", ""
        if m[1]:
            end = find("-->", m.end())
            end = len(html) if end < 0 else end
        elif m[2] or m[3]:
            end = find("]]>", m.end()) if m[2] else -1
            end = find(">", start + 2) if end < 0 else end
        else:
            end = ends.after(m.end())
            raw = _RAW.match(html, start) if end >= 0 and not m[4] else None
            if raw:
                close = _RAW_END[raw[1].lower()].search(html, end)
                end = close.end() if close else len(html)
            elif end >= 0:
                name, attributes = m[5].lower(), html[m.end():end - 1]
        if end < 0:
            at = start + 1
            continue
        yield start, end, name, bool(m[4]), attributes
        at = end


def tokens(html: str | None) -> Iterator[tuple[str, str, bool, bool, str]]:
    """``(key, name, is a tag, inside an article, text)`` in page order.

    The key of a text names the two nearest marked elements around it; that of a tag also
    has its name and marks.  Comments, scripts and the like are left out.
    """
    stack: list[tuple[str, str]] = [("", "page")]       # name, key that holds for text inside
    places: dict[str, list[int]] = {}       # where in the stack each name is open
    blocks: list[int] = []                  # where block elements are
    articles = 0
    at = 0
    html = html or ""

    def leave(depth: int) -> None:
        nonlocal articles
        while len(stack) > depth:
            name, _ = stack.pop()
            places[name].pop()
            articles -= name == "article"
        while blocks and blocks[-1] >= depth:
            blocks.pop()

    for start, end, name, closing, attributes in markup(html):
        if start > at:
            yield stack[-1][1], "", False, articles > 0, html[at:start]
        at = end
        if not name:
            continue
        if closing:
            if places.get(name):
                leave(places[name][-1])
            yield f"{stack[-1][1]}>/{name}", name, True, articles > 0, ""
            continue
        if name in CLOSES_P or name == "p":
            # A paragraph that is still open ends here, with what was left open in it.
            if blocks and stack[blocks[-1]][0] == "p":
                leave(blocks[-1])
        marks = " ".join(sorted(x for g in _MARK.findall(attributes) for x in "".join(g).lower().split()))
        own = f"{name}.{marks}" if marks else name
        inner = stack[-1][1]
        yield f"{inner}>{own}", name, True, articles > 0, ""
        if name not in VOID and not attributes.endswith("/"):
            if inner[0] != "!" and (marks or name in MARKED):
                around = name in AROUND_ELEMENTS or bool(marks and AROUND.search(marks))
                inner = f"{'!' if around else ''}{inner.rpartition('/')[2]}/{own}"
            places.setdefault(name, []).append(len(stack))
            if name in BLOCK:
                blocks.append(len(stack))
            stack.append((name, inner))
            articles += name == "article"
    if at < len(html):
        yield stack[-1][1], "", False, articles > 0, html[at:]


def is_around(key: str) -> bool:
    return key[0] == "!"


class Weights:
    """What tags cost and words are worth, by key; ``counts`` maps (is a tag, key) to (in, out)."""

    def __init__(self, counts: dict[tuple[bool, str], tuple[int, int]]):
        self.tags, self.words = {}, {}
        for (tag, key), (inside, outside) in counts.items():
            odds = np.log((inside + 0.5) / (outside + 0.5))
            if tag:
                # A tag is never worth anything by itself.
                self.tags[key] = -float(np.clip(-odds * 5, TAG_LEAST, TAG_LIMIT))
            else:
                self.words[key] = float(np.clip(odds, 0, WORD_LIMIT))

    def tag(self, key: str) -> float:
        return self.tags.get(key, -TAG_UNSEEN)

    def word(self, key: str) -> float:
        got = self.words.get(key)
        return float(not is_around(key)) if got is None else got


def best_region(scores: list[float]) -> tuple[int, int]:
    """Start and end of the contiguous run with the largest positive sum; the first of equals."""
    best, region, now, start = 0.0, (0, 0), 0.0, 0
    for i, s in enumerate(scores):
        if now <= 0:
            now, start = 0.0, i
        now += s
        if now > best:
            best, region = now, (start, i + 1)
    return region


def extract(html: str | None, weights: Weights) -> str:
    """The main text: blocks joined by a line break, white space inside a block by a space."""
    found = list(tokens(html))
    scores = [weights.tag(key) if tag else len(text.split()) * weights.word(key)
              for key, _, tag, _, text in found]
    start, end = best_region(scores)
    blocks, now = [], []
    for (_, name, tag, _, text), score in zip(found[start:end], scores[start:end]):
        if tag:
            if name in BLOCK and now:
                blocks.append(" ".join(unescape("".join(now)).split()))
                now = []
            elif name == "br":
                now.append(" ")
        elif score > 0 or now and not text.strip():
            now.append(text)
    blocks.append(" ".join(unescape("".join(now)).split()))
    return "\n".join(b for b in blocks if b)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        total: Counter = Counter()
        for html in batch.column(0).to_pylist():
            seen: Counter = Counter()
            articles = 0
            for key, name, tag, inside, text in tokens(html):
                articles += tag and name == "article" and not key.endswith(">/article")
                n = 1 if tag else len(text.split())
                if tag and name == "article":
                    inside = False
                if n:
                    seen[tag, key, inside and not (not tag and is_around(key))] += n
            if articles == 1:
                total.update(seen)
        yield pa.RecordBatch.from_arrays([
            pa.array([k[0] for k in total], pa.bool_()), pa.array([k[1] for k in total], pa.string()),
            pa.array([k[2] for k in total], pa.bool_()), pa.array(list(total.values()), pa.int64())],
            ["tag", "key", "inside", "n"])


def learn(pages: DataFrame, html: str = "html", sample: int = SAMPLE_PAGES, chars: int = SAMPLE_CHARS) -> Weights:
    """Weights from about ``sample`` pages of at most ``chars`` characters, those with one marked article.

    Every key in the sample is weighed.
    """
    pages = pages.where(F.length(html) <= chars)
    total = pages.count()
    if total > sample:
        every = F.shiftrightunsigned(F.xxhash64(F.coalesce(F.col(html), F.lit(""))), 1) % 1_000_003
        pages = pages.where(every < int(1_000_003 * sample / total))
    counted = (pages.select(F.col(html)).mapInArrow(_counts, "tag boolean, key string, inside boolean, n long")
               .groupBy("tag", "key").agg(F.sum(F.when(F.col("inside"), F.col("n")).otherwise(0)).alias("i"),
                                          F.sum(F.when(F.col("inside"), 0).otherwise(F.col("n"))).alias("o")))
    return Weights({(r["tag"], r["key"]): (r["i"], r["o"]) for r in counted.collect()})


def _extract(shared, columns: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extract(html.as_py(), shared.value) for html in batch.column(columns)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:columns], pa.array(texts, pa.string())],
                [*batch.schema.names[:columns], "text"])
    return run


def main_text(pages: DataFrame, html: str = "html", keep: tuple[str, ...] = ("page_id", "url"),
              weights: Weights | None = None) -> DataFrame:
    """``keep`` columns, ``text`` and ``n_chars`` for every row.

    Null and empty pages, and pages without a word worth keeping, give an empty text.
    Repeated rows each get their result.
    """
    weights = weights or learn(pages, html)
    shared = pages.sparkSession.sparkContext.broadcast(weights)       # keys of the bounded sample
    rows = pages.select(*[F.col(c) for c in keep], F.col(html))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return rows.mapInArrow(_extract(shared, len(keep)), f"{schema}, text string").withColumn(
        "n_chars", F.length("text").cast("long"))
