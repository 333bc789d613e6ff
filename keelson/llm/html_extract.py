"""Main text of a web page by a maximum-scoring run of tokens.

A page becomes a list of tokens: runs of words, and tags. Each gets a weight
counted from labelled pages (``html_labels``): a word's is the log odds of
standing in main text for its place (in the article or main element, outside
it, on a page without one, or in a box), a link or not, and the kind of block;
a tag's is the same but never positive. One linear scan finds the run of
tokens with the largest sum: the content region (the earliest, and the longest
from there, on ties).

Boxes are elements that tend not to be main text: by element name (navigation,
forms, sidebars, ...) or hidden; by a class, id or role that says so and
nothing else (``ad``, ``comment-list``, ``pageFooter``); or by one that says so
among other things (``alert-history``). Each of the three is a place of its
own. A box whose words' weights sum below zero is left out of the text and of
the scan, where only its tags weigh; so of the third kind prose stays and lists
of links go. The boxes around the main text are none: those around the page's
article or main element and, on a page without one, a form or a box by class or
id (other than readers' comments) that holds most of the words outside links.

The region's text: character references decoded, block elements and line
breaks separate words, other tags don't, white space becomes one space. One
region is one stretch of the page: prose that a long list of links outside any
box parts from a longer stretch is lost.

Cases: a null or empty page, or one without words, gives the empty text.
Unclosed elements end with their parent, stray end tags are ignored, cut-off
markup counts as markup, pages of any length are read whole. Of an attribute
given twice the first counts. Repeated rows
are read one by one, an empty table gives an empty table, and ``main_text``
adds its two columns (replacing those of the same name).
"""

from __future__ import annotations

import functools
import html as html_lib
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.llm.html_labels import PAGES

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|noscript|template|svg|math|iframe|object|textarea|title)\b"
    r".*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-z][a-z0-9:-]*)(?P<rest>(?:\"[^\"]*\"|'[^']*'|[^'\">])*|[^>]*)(?:>|\Z)"
    r"|<[/!?][^>]*(?:>|\Z)"
    r"|(?P<text>[^<]+|<)", re.S | re.I)
ATTRIBUTE = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
#: Words of a name: pageFooter, page-footer and PAGE_FOOTER alike.
NAME_PART = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby "
    "s samp small span strike strong sub sup time tt u var wbr img".split())
#: Elements that are never main text.
ASIDE = frozenset("nav footer aside form dialog menu button select head header".split())
#: Parts of class, id or role names that mark such a box.
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising alert banner breadcrumb breadcrumbs "
    "comment comments complementary consent contentinfo cookie cookies copyright dialog disqus "
    "footer form gdpr legal login masthead menu menubar modal nav navbar navigation newsletter "
    "notice notices notification pager pagination popup promo promotion reactions recommended "
    "related replies reply search share sharing sidebar signup social sponsor sponsored subscribe "
    "teaser toolbar widget".split())
#: Marks of what readers write: never main text for its length.
READERS = frozenset("comment comments disqus reactions replies reply".split())
#: What a head may hold; any other element, or text, ends an open head.
IN_HEAD = frozenset("html head base link meta title style script noscript template".split())
#: Beside these parts a mark says something else (has-sidebar, no-comments).
NEGATED = frozenset("has no with without open closed enabled disabled".split())
#: Parts that say nothing of what a box holds: beside them a mark says it all.
GENERIC = frozenset(
    "a aligned area banners bar big block blocks body bottom box boxes btn button center col column "
    "columns container content feed field first footers frame global grid group head heading header "
    "holder id inline inner item items last layer layout left line link links list lists main media "
    "mini mobile module modules my node outer page pages panel part parts placeholder post posts "
    "primary region respond right row secondary section side site slot small stack stories sub text "
    "thread title top unit view web wide wrap wrapper wrapping zone".split())
#: Parts of a name that says the box holds main text, whatever else it says.
CONTENT = frozenset("article articles entry essay prose story".split())
BLOCKS = {**{f"h{i}": "heading" for i in range(1, 7)}, "p": "text", "blockquote": "text",
          "pre": "text", "dd": "text", "figcaption": "text", "li": "item", "dt": "item",
          "td": "cell", "th": "cell"}
#: Words from which text outside any block element counts as prose.
PROSE = 10
#: An opening of the first ends an open one of the second.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
        "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}


def attributes(rest: str) -> dict[str, str]:
    """A tag's attributes by lower-case name, left to right."""
    found: dict[str, str] = {}
    for name, value in ATTRIBUTE.findall(rest):
        found.setdefault(name.lower(), html_lib.unescape(value.strip("\"'")))
    return found


def _marks(part: str) -> str | None:
    """The mark that a part of a name is, or is made of with a generic word."""
    if part in MARKS:
        return part
    for i in range(2, len(part) - 1):
        if part[:i] in MARKS and part[i:] in GENERIC:
            return part[:i]
        if part[:i] in GENERIC and part[i:] in MARKS:
            return part[i:]
    return None


def said(word: str) -> str:
    """What one class, id or role says of its element: 'readers', 'mark',
    'weak' (a mark among other words) or ''."""
    parts = [p.lower() for p in NAME_PART.findall(word)]
    marks = {m for m in map(_marks, parts) if m}
    if not marks or NEGATED.intersection(parts):
        return ""
    if CONTENT.intersection(parts):
        return "weak"
    if marks & READERS:
        return "readers"
    return "mark" if all(p in GENERIC or _marks(p) for p in parts) else "weak"


_RANK = ("", "weak", "mark", "readers")


@functools.lru_cache(maxsize=50_000)
def box(name: str, rest: str, inside: bool) -> str:
    """What makes an element a box ('element', 'form', 'hidden', 'readers',
    'mark' or 'weak'; '': it is none); ``inside``: within an article or main
    element, where a header holds the article's title."""
    if name in ASIDE and not (name == "header" and inside):
        return "form" if name == "form" else "element"
    if name in ASIDE or not rest or "=" not in rest and "hidden" not in rest.lower():
        return ""
    given = attributes(rest)
    if "hidden" in given or given.get("aria-hidden", "").lower() == "true" or \
            "display:none" in given.get("style", "").lower().replace(" ", ""):
        return "hidden"
    words = [w for key in ("class", "id", "role") for w in given.get(key, "").split()]
    found = max(map(said, words), key=_RANK.index, default="")
    if name in ("body", "html", "main") or name == "article" and found != "readers":
        return ""
    return found


def ended(stack: list[tuple], name: str) -> int | None:
    """From where on the opening of an element ends open ones."""
    if name not in IN_HEAD:
        for i, open_ in enumerate(stack[:2]):
            if open_[0] == "head":
                return i
    if name not in INLINE and name not in VOID:
        # an open paragraph ends at the next block
        ends = ENDS.get(name, set()) | {"p"}
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] in ends:
                return i
            if stack[i][0] not in INLINE and stack[i][0] != "p":
                break
    return None


def around_main(page: str) -> tuple[frozenset[int], bool]:
    """Where the boxes begin that hold the main text, and whether that is in
    an article or main element."""
    stack: list[tuple[str, str, int]] = []
    mains: dict[int, list] = {}  # begin -> [boxes around, name, words in no further box]
    words: Counter = Counter()
    free = total = 0  # words in no box, and in no box but forms and marks, outside links
    for m in TOKEN.finditer(page):
        if (text := m["text"]) is not None:
            n = len(html_lib.unescape(text).split())
            if n and stack and stack[-1][0] == "head":
                stack.pop()
            kinds = [(kind, at) for _, kind, at in stack if kind]
            if not n:
                continue
            for _, _, at in stack:
                if at in mains and len(mains[at][0]) == len(kinds):
                    mains[at][2] += n
            if not any(name == "a" for name, _, _ in stack):
                free += 0 if kinds else n
                if all(kind in ("form", "mark", "weak") for kind, _ in kinds):
                    total += n
                    words.update(dict.fromkeys((at for _, at in kinds), n))
            continue
        if (name := m["name"]) is None:
            continue
        name = name.lower()
        if m["end"]:
            at = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name), None)
            if at is not None:
                del stack[at:]
            continue
        if (at := ended(stack, name)) is not None:
            del stack[at:]
        if name in VOID or m["rest"].endswith("/"):
            continue
        kind = box(name, m["rest"], any(at in mains for _, _, at in stack))
        if name in ("article", "main") and not kind:
            kinds = [(k, at) for _, k, at in stack if k]
            if all(k != "hidden" for k, _ in kinds):
                mains[m.start()] = [[at for _, at in kinds], name, 0]
        stack.append((name, kind, m.start()))
    held = [v for v in mains.values() if v[2]]
    if held:
        boxes, name, n = min(held, key=lambda v: (len(v[0]), v[1] != "main", -v[2]))
        if not boxes or name == "main" or n >= free:
            return frozenset(boxes), True
    return frozenset(at for at, n in words.items() if 2 * n > total), False


@dataclass
class Token:
    kind: tuple  # ('tag', place, name) or ('word', place, in a link, block)
    words: int  # 0 for a tag
    text: str  # the words, or what a tag puts between words
    box: int = 0  # the box it is in, 0: none


#: The places that boxes are; the last two are never left for another.
PLACES = {"weak": "in weak", "mark": "in mark", "readers": "in mark", "element": "in aside",
          "form": "in aside", "hidden": "in aside"}


def tokens(page: str) -> list[Token]:
    """A page's tokens in order."""
    out: list[Token] = []
    stack: list[tuple[str, bool]] = []  # open elements, and which begin a box
    boxes: list[tuple[int, str]] = []  # open boxes: number and place
    mains = links = numbered = 0
    block = "none"
    spared, has_main = around_main(page)
    bare = re.search(r"</?[a-z]", page, re.I) is None  # a text without any tag

    def close(at: int) -> None:
        nonlocal mains, links
        for name, begins in stack[at:]:
            if begins:
                boxes.pop()
            mains -= name in ("article", "main")
            links -= name == "a"
        del stack[at:]

    def place() -> str:
        if boxes:
            return boxes[-1][1]
        return "bare" if bare else "main" if mains else "outside" if has_main else "body"

    def add(kind: tuple, words: int, text: str) -> None:
        out.append(Token(kind, words, text, boxes[-1][0] if boxes else 0))

    for m in TOKEN.finditer(page):
        if (text := m["text"]) is not None:
            if stack and stack[-1][0] == "head" and html_lib.unescape(text).split():
                close(len(stack) - 1)
            text = html_lib.unescape(text)
            n = len(text.split())
            kind = "prose" if block == "none" and n >= PROSE else block
            add(("word", place(), links > 0, kind), n, text)
            continue
        if (name := m["name"]) is None:
            continue
        name = name.lower()
        if m["end"]:
            at = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name), None)
            if at is not None:
                close(at)
            add(("tag", place(), "/" + name), 0, "" if name in INLINE else " ")
            if name in BLOCKS:
                block = "none"
            continue
        if (at := ended(stack, name)) is not None:
            close(at)
        if name not in INLINE and name not in VOID:
            block = BLOCKS.get(name, "none")
        add(("tag", place(), name), 0, "" if name in INLINE else " ")
        if name in VOID or m["rest"].endswith("/"):
            continue
        # in a weak box others count, in others none
        kind = "" if boxes and boxes[-1][1] != PLACES["weak"] or m.start() in spared else \
            box(name, m["rest"], mains > 0)
        begins = kind != "" and not (boxes and kind == "weak")
        stack.append((name, begins))
        if begins:
            numbered += 1
            boxes.append((numbered, PLACES[kind]))
        mains += name in ("article", "main")
        links += name == "a"
    return out


@functools.cache
def weights(pages: tuple[str, ...] = PAGES, smoothing: float = 0.5) -> dict[tuple, float]:
    """Log odds of each kind of token, from labelled pages; a kind of word
    that no page shows gets what its place and link say over all blocks."""
    inside, outside = Counter(), Counter()
    for page in pages:
        mark = "\ue000"  # stands where the marks stood, as text of its own
        marked = False
        for token in tokens(re.sub(r"\[\[|\]\]", f"<!-- -->{mark}<!-- -->", page)):
            if token.text == mark:
                marked = not marked
                continue
            into, n = (inside if marked else outside), max(1, token.words)
            into[token.kind] += n
            if token.words:
                into[token.kind[:3]] += n
    kinds = set(inside) | set(outside)
    odds = {k: math.log((inside[k] + smoothing) / (outside[k] + smoothing)) for k in kinds}
    return {k: min(-0.01, w) if k[0] == "tag" else w for k, w in odds.items()}


def score(token: Token, table: dict[tuple, float]) -> float:
    if token.kind[0] == "tag":
        return table.get(token.kind, -0.01 if token.kind[1] == "main" else -0.5)
    each = table.get(token.kind, table.get(token.kind[:3]))
    if each is None:
        away = token.kind[1] in ("outside", *PLACES.values())
        each = -1.0 if away or token.kind[2] and token.kind[1] != "main" else 1.0
    return each * token.words


def best_run(scores: list[float]) -> tuple[int, int]:
    """Start and end of the run with the largest positive sum (0, 0 if none):
    the earliest such run, and the longest from there."""
    best, at, total, start = 0.0, (0, 0), 0.0, 0
    for i, value in enumerate(scores):
        if total <= 0:
            total, start = 0.0, i
        total += value
        if total > best or total == best and total > 0 and start == at[0]:
            best, at = total, (start, i + 1)
    return at


def extract(page: str | None, table: dict[tuple, float] | None = None) -> str:
    """The main text of one page."""
    if not page:
        return ""
    found = tokens(page)
    table = weights() if table is None else table
    scores = [score(t, table) for t in found]
    sums: dict[int, float] = {}
    for token, value in zip(found, scores, strict=True):
        if token.box and token.words:
            sums[token.box] = sums.get(token.box, 0.0) + value
    left_out = {b for b, total in sums.items() if total < 0}
    start, end = best_run([0.0 if t.box in left_out else value
                           for t, value in zip(found, scores, strict=True)])
    return " ".join("".join(t.text for t in found[start:end]
                            if t.words == 0 or t.box not in left_out).split())


def main_text(df: DataFrame, html: str = "html", text: str = "text",
              n_chars: str = "n_chars") -> DataFrame:
    """``df`` with the main text of each page and its code points."""
    table = weights()

    @F.pandas_udf("string")
    def read(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for pages in batches:
            yield pd.Series([extract(p, table) for p in pages], dtype=object)

    return df.withColumn(text, read(F.col(html))).withColumn(n_chars, F.length(text).cast("long"))
