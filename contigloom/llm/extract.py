"""Main text of web pages by the maximum-scoring run of tokens.

A page is a sequence of words and tags. Each token has a weight by what it is: the element that words stand in, how long the run of
text is, the name of the tag. The contiguous run with the greatest sum, found in one pass, is the content region. Words of prose score
positive, tags negative. A menu, notice, advert, form or the like is one negative token whatever it holds, so the region can reach over
it. What lies apart from the best run and sums up to ``SECOND`` of it is a region too: a page may have several articles.

The weights are log-odds counted over labelled pages, those whose markup names the main part (article or main): how often a token of this
sort lies inside it and outside. The marking itself is no input: article and main are weighed as any division, so pages without them
are judged by the same weights. Sorts that no page shows fall back on priors. At most ``TRAIN_PAGES`` pages, the first by a hash of their
text, are counted.

What stands apart is left out of the region: elements that are never main text, and divisions, lists and inline marks whose class, id or role
is named as such. Headings, paragraphs and table cells are never left out for their names, nor are names that only hold such a word.
Character references are decoded, white space inside a block is one space, blocks are joined by line ends.

Null or empty html, and a page without words: empty text. Ties: the earliest run, and the longest of those. Repeated rows: the
same text each. An empty table gives an empty result. Extra columns pass through; ``text`` is replaced.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contigloom.llm.sample import first_by_hash

TRAIN_PAGES = 2000
PRIOR = 20.0  # how many tokens the prior of a sort counts as
LEAST, MOST = -6.0, 3.0
BRIDGE = -2.0  # what stands apart counts no less, so that a few words after it can make up for it
SECOND = 0.25
SHORT = 6  # words: shorter runs of text outside of paragraphs are often labels

# Names of elements in the public standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe textarea svg title xmp noembed noframes".split())
INLINE = frozenset("""a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small
span strike strong sub sup time tt u var br wbr img""".split())
BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure
footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section select summary table tbody td
tfoot th thead tr ul head title""".split())
CLOSES_P = frozenset("""address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header
hgroup hr main menu nav ol p pre section table ul""".split())
#: Elements whose words are never main text.
APART = frozenset("nav aside footer form button select dialog menu".split())
#: Names (a class, an id or a role as a whole) that say the same of a division.
APART_NAMES = frozenset("""ad ads advert advertisement banner breadcrumb breadcrumbs comment comments cookie cookies copyright footer
header menu nav navbar navigation newsletter notice popup promo related share sharing sidebar social sponsor sponsored subscribe
widget disqus contentinfo complementary""".split())
#: Words that say it also as a part of a longer name, such as ``left-sidebar``.
APART_PARTS = frozenset("""advert advertisement breadcrumb breadcrumbs cookie cookies disqus footer menu nav navbar navigation newsletter sidebar
sponsored""".split())
#: Elements that are left out for their names.
NAMED = frozenset("div section ul ol dl table header span details figure ins center hgroup".split())
MAIN = frozenset({"article", "main"})

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|"
                    r"<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)", re.S)
_MARKED = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_SPACE = " \t\n\r\x0b\x0c"
_WORDS = re.compile(r"[^ \t-\r]+")


class Token(NamedTuple):
    sort: str  # key of its weight
    weight_words: int  # words, or 0 for a tag
    text: str  # raw text, or the tag's name
    place: str  # "main" inside the marked main part: the label, no input
    breaks: bool  # ends a block


def _apart(name: str, attributes: str, marked: bool) -> bool:
    if name in APART:
        return True
    if name not in NAMED:
        return False
    given = {x for found in _MARKED.findall(attributes) for x in "".join(found).lower().split()}
    # an article's own header is part of it
    return bool(given & (APART_NAMES - {"header"} if marked else APART_NAMES)) or any(APART_PARTS & set(re.split("[^a-z]+", x)) for x in given)


def _kind(name: str) -> str:
    if name in MAIN or name in ("section", "div"):
        return "div"
    if len(name) == 2 and name[0] == "h" and name[1] in "123456":
        return "h"
    return name if name in BLOCKS or name in INLINE else "other"


def tokens_of(page: str) -> list[Token]:
    """Words (a run of text is one token with its number of words), tags, and what stands apart (one token each, without its words)."""
    out: list[Token] = []
    open_: list[tuple[str, bool, bool]] = []  # element, whether it is marked as main, whether it stands apart
    at = 0

    def words(text: str) -> None:
        marked, apart = open_[-1][1:] if open_ else (False, False)
        if not text or apart:
            return
        n = len(_WORDS.findall(text))
        inside = next((k for e, _, _ in reversed(open_) if (k := _kind(e)) in ("a", "li", "p", "td", "th", "label", "h", "dd", "pre")), "text")
        size = ":short" if inside in ("text", "li", "td") and n < SHORT else ""
        out.append(Token(f"words:{inside}{size}", n, text, "main" if marked else "", False))

    def tag(sort: str, name: str, marked: bool) -> None:
        out.append(Token(sort, 0, name, "main" if marked else "", name in BLOCKS))

    while at < len(page):
        m = _TOKEN.search(page, at)
        if m is None:
            words(page[at:])
            break
        words(page[at:m.start()])
        at = m.end()
        name = (m[2] or "").lower()
        if not name:
            continue
        marked, apart = open_[-1][1:] if open_ else (False, False)
        if m[1]:
            depth = next((i for i in range(len(open_) - 1, -1, -1) if open_[i][0] == name), None)
            # an end tag closes inline elements and paragraphs left open in it, but no enclosing section
            if depth is not None and not (name in INLINE and any(e in BLOCKS for e, _, _ in open_[depth + 1:])):
                del open_[depth:]
            if not apart:
                tag(f"tag:/{_kind(name)}", name, marked)
            elif not (open_ and open_[-1][2]):
                tag("tag:/apart", name, marked)
            continue
        own = apart or _apart(name, m[3], marked)
        if not apart:
            tag("apart:" + _kind(name) if own else "tag:" + _kind(name), name, marked)
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        if name in VOID or m[3].endswith("/"):
            continue
        if name in CLOSES_P:
            depth = next((i for i in range(len(open_) - 1, -1, -1) if open_[i][0] in BLOCKS), None)
            if depth is not None and open_[depth][0] == "p":
                del open_[depth:]
        if name in ("li", "dd", "dt", "td", "th", "tr", "option") and open_ and open_[-1][0] == name:
            open_.pop()
        open_.append((name, marked or name in MAIN, own))
    return out


def prior(sort: str) -> float:
    """The weight of a token that no labelled page shows."""
    kind, what, size = (sort.split(":") + ["", ""])[:3]
    if kind == "words":
        return {"a": -1.0, "label": -1.0}.get(what, {"text": 0.2, "td": 0.2}.get(what, 0.5) if size else 1.0)
    if kind == "apart":
        return BRIDGE
    what = what.strip("/")
    return {"html": -2.0, "body": -2.0, "head": -4.0, "title": -4.0, "apart": 0.0, "div": -0.5}.get(what, -0.05 if what in INLINE else -0.1)


def page_counts(page: str) -> Counter:
    """(sort, inside) to tokens, on a page whose markup names its main part; else nothing."""
    found: Counter = Counter()
    tokens = tokens_of(page)
    if any(t.place == "main" for t in tokens):
        for t in tokens:
            if t.weight_words or not t.sort.startswith("words:"):
                found[t.sort, t.place == "main"] += max(1, t.weight_words)
    return found


def learn(pages: DataFrame, limit: int = TRAIN_PAGES) -> dict[str, float]:
    """Weights by sort of token."""

    @F.pandas_udf("array<struct<sort:string,inside:boolean,n:long>>")
    def count(htmls: pd.Series) -> pd.Series:
        return pd.Series([[(s, i, n) for (s, i), n in page_counts(h or "").items()] for h in htmls])

    some = first_by_hash(pages.select("html"), "html", limit)
    rows = some.select(F.explode(count.asNondeterministic()(F.col("html"))).alias("c_")).groupBy("c_.sort", "c_.inside").agg(F.sum("c_.n").alias("n")).collect()
    counts: dict[str, dict[bool, int]] = {}
    for r in rows:  # sorts are made from the fixed names above
        counts.setdefault(r["sort"], {})[r["inside"]] = r["n"]
    return {s: weight(s, c.get(True, 0), c.get(False, 0)) for s, c in counts.items()}


def weight(sort: str, inside: int, outside: int) -> float:
    """Log-odds, drawn to the prior. Only words may score above zero: tags never make a region by themselves."""
    chance = 1 / (1 + math.exp(-prior(sort)))
    value = math.log((inside + PRIOR * chance) / (outside + PRIOR * (1 - chance)))
    return max(BRIDGE if sort.startswith("apart") else LEAST, min(MOST if sort.startswith("words") else -0.01, value))


def region(tokens: list[Token], weights: dict[str, float]) -> tuple[int, int]:
    """First and last-but-one token of the run with the greatest sum; empty if none is above zero."""
    best, best_at, total, start = 0.0, (0, 0), 0.0, 0
    for i, t in enumerate(tokens):
        w = weights.get(t.sort)
        total += (prior(t.sort) if w is None else w) * (t.weight_words if t.sort.startswith("words") else 1)
        if total <= 0:
            total, start = 0.0, i + 1
        elif total > best:
            best, best_at = total, (start, i + 1)
    return best_at


def regions(tokens: list[Token], weights: dict[str, float]) -> list[tuple[int, int]]:
    """The best run, and the best ones to its sides as far as they sum up to ``SECOND`` of it; in page order."""
    def total(a: int, b: int) -> float:
        return sum((prior(t.sort) if (w := weights.get(t.sort)) is None else w) * (t.weight_words if t.sort.startswith("words") else 1) for t in tokens[a:b])

    found, least, open_ = [], 0.0, [(0, len(tokens))]
    while open_:
        a, b = open_.pop()
        first, last = region(tokens[a:b], weights)
        first, last = first + a, last + a
        if last > first and (score := total(first, last)) >= least:
            least = least or SECOND * score
            found.append((first, last))
            open_ += [(a, first), (last, b)]
    return sorted(found)


def main_text(page: str, weights: dict[str, float]) -> str:
    tokens = tokens_of(page)
    blocks, held = [], []
    for first, last in regions(tokens, weights):
        for t in tokens[first:last]:
            if t.sort.startswith("words:"):
                held.append(t.text)
            elif t.breaks:
                blocks.append("".join(held))
                held = []
            elif t.text == "br":
                held.append(" ")
        blocks.append("".join(held))
        held = []
    lines = (" ".join(entities.unescape(b).split()) for b in blocks)
    return "\n".join(x for x in lines if x)


def extract(pages: DataFrame, weights: dict[str, float]) -> DataFrame:
    """``pages`` with ``text``."""
    sent = pages.sparkSession.sparkContext.broadcast(weights)  # some hundred numbers

    @F.pandas_udf("string")
    def read(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for htmls in batches:
            yield pd.Series([main_text(h or "", sent.value) for h in htmls], dtype=object)

    return pages.withColumn("text", read(F.col("html")))
