"""HTML extraction: the maximum-scoring contiguous run of a page's tokens."""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow

SAMPLE = 2000              # labelled pages that the weights are fitted on, about
UNFITTED = {"word": 2.0}   # without labelled pages: one word outweighs a heading's tags
LOWEST = {"left": -6.0}    # a left-out element within the text must not cut it off

# Fixed values of the HTML standard: elements whose content is not markup,
# elements inside a line, elements that the next block ends.
RAW = {"script", "style", "title", "textarea", "noscript", "template", "iframe", "xmp", "noembed", "noframes"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font",
          "i", "img", "ins", "kbd", "label", "mark", "nobr", "q", "rp", "rt", "ruby", "s", "samp", "small", "span",
          "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"}
OPEN_ENDED = {"p", "li", "dt", "dd", "tr", "td", "th", "option"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
BLOCKS = {"address", "article", "blockquote", "body", "caption", "center", "dd", "details", "div", "dl", "dt",
          "figcaption", "figure", "h1", "h2", "h3", "h4", "h5", "h6", "head", "hr", "html", "li", "main", "ol", "p",
          "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
# Elements that are never main text, and names of class, id and role that say so.
ASIDE = {"nav", "footer", "aside", "form", "svg", "canvas", "button", "select", "dialog", "menu", "object", "audio",
         "video", "map", "fieldset", "header"}
ASIDE_WORDS = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "alert", "banner", "breadcrumb",
               "breadcrumbs", "comment", "comments", "complementary", "consent", "contentinfo", "cookie", "cookies",
               "discussion", "disqus", "footer", "header", "login", "masthead", "menu", "modal", "nav", "navbar", "navigation",
               "newsletter", "notice", "notices", "pager", "pagination", "popup", "promo", "promotion", "recommended",
               "related", "replies", "search", "share", "sharing", "sidebar", "signup", "social", "sponsor",
               "sponsored", "subscribe", "toolbar", "widget"}
# Of these, the ones that also stand in names of main text ("related-work",
# "search-engines"): alone they are enough, beside other words the text decides.
AMBIGUOUS = {"alert", "banner", "discussion", "header", "menu", "notice", "notices", "promotion", "recommended",
             "related", "replies", "search", "share", "sharing", "social"}
# Words that make a name a state of the page, not what the element is: "has-sidebar".
STATES = {"closed", "disabled", "enabled", "free", "has", "hidden", "hide", "is", "no", "not", "open", "with", "without"}
# Words that only place such a name: "site-footer", "related-posts".
PLACING = {"area", "bar", "block", "bottom", "box", "buttons", "container", "form", "global", "inner", "item", "items",
           "left", "links", "list", "main", "outer", "page", "posts", "primary", "right", "secondary", "section",
           "site", "top", "wrapper"}
# What an element's name and text say for (+) and against (-) main text.
SCORES = {"name": -3.0, "ambiguous name": -1.5, "50 plain words": 1.0, "most plain words": 2.0, "all words in links": -3.0}
WRAPPERS = {"form", "fieldset", "object"}    # of ASIDE, those that may also enclose a whole page
CONTENT = {"article", "main"}

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^\"'>]|\"[^\"]*\"|'[^']*')*+)>"
                  r"|<(/?)([a-zA-Z][^\s/>]*)[^>]*>?|<[!?/][^>]*>?", re.S)
_ATTR = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
_SLUG = re.compile(r"[-_]+|(?<=[a-z0-9])(?=[A-Z])")
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>]|\Z)[^>]*>?", re.I) for name in RAW}

# Items of a page: (kind, name, text).  Kinds: word run, tag, left-out element.
TEXT, TAG, LEFT = 0, 1, 2


def parse(page: str) -> list[tuple[int, str, str]]:
    """Text runs and tags of a page in order; tag names are lower-case, closing
    ones with a slash.  Comments and the content of raw elements go."""
    out, at, n = [], 0, len(page)
    while at < n:
        m = _TAG.search(page, at)
        if m is None:
            out.append((TEXT, "", page[at:]))
            break
        if m.start() > at:
            out.append((TEXT, "", page[at:m.start()]))
        at = m.end()
        name = (m[2] or m[5] or "").lower()
        if not name:
            continue
        close = (m[1] or m[4]) == "/"
        if not close and name in RAW:
            end = _RAW_END[name].search(page, at)
            if end or name not in ("textarea", "noscript", "template"):
                at = end.end() if end else n
            out.append((LEFT, name, ""))
            continue
        out.append((TAG, "/" + name if close else name, m[3] or ""))
    return out


def _name_score(value: str) -> float | None:
    """What a class, id or role says: None nothing, -inf that the element is no
    main text whatever it holds (a word of ASIDE_WORDS, alone or with words that
    place it), else the score of a name with further words in it."""
    parts = [x.lower() for x in _SLUG.split(value) if x]
    named = [x for x in parts if x in ASIDE_WORDS]
    if not named or any(x in STATES for x in parts):
        return None
    if value.lower() in ASIDE_WORDS or all(x in ASIDE_WORDS or x in PLACING or x.isdigit() for x in parts):
        return -math.inf
    return SCORES["ambiguous name" if all(x in AMBIGUOUS for x in named) else "name"]


def _aside_score(name: str, attrs: str, inside: bool = False) -> float | None:
    """What an element says of itself by its tag, classes, role and id: None
    nothing against main text, -inf that it is none, else a score that its text
    may outweigh.  Headings and elements within a line say nothing by a name; ids
    of sections and paragraphs ``inside`` the content are anchors made of their
    titles."""
    if name in ASIDE:
        return -math.inf
    if not attrs or name in ("html", "body") or name in CONTENT or name in HEADINGS or name in INLINE:
        return None
    scores = []
    for key, value in _ATTR.findall(attrs):
        key, value = key.lower(), value.strip("\"'")
        if key in ("class", "role") or key == "id" and not (inside and name in ("section", "p")):
            scores += map(_name_score, value.split())
    return min((x for x in scores if x is not None), default=None)


def _text_score(items: list[tuple[int, str, str]]) -> float:
    """What an element's text says: words outside links for main text, the share
    of words inside links against it."""
    plain = linked = 0
    in_link = False
    for kind, name, text in items:
        if kind == TEXT:
            n = len(text.split())
            plain, linked = (plain, linked + n) if in_link else (plain + n, linked)
        elif kind == TAG and name in ("a", "/a"):
            in_link = name == "a"
    share = linked / (plain + linked) if plain + linked else 1.0
    return (min(SCORES["50 plain words"] * plain / 50, SCORES["most plain words"])
            + SCORES["all words in links"] * share)


def leave_out(items: list[tuple[int, str, str]]) -> list[tuple[int, str, str]]:
    """Items without menus, adverts and the like: each element whose name and
    text score below zero together becomes one LEFT item.  An element that is never closed, or holds the page's article,
    stays; a header within an article that holds a heading is its title.  On a
    page without an article or main element, a block that holds most of its words
    stays too (unless its tag alone says what it is): the weights decide."""
    out, i, n, inside, words = [], 0, len(items), 0, None
    bare = not any(x[0] == TAG and x[1] in CONTENT for x in items)
    while i < n:
        kind, name, attrs = items[i]
        if kind == TAG and name.lstrip("/") in CONTENT:
            inside += -1 if name[0] == "/" else 1
        said = None
        if kind == TAG and name[0] != "/" and name not in VOID:
            said = _aside_score(name, attrs, inside > 0 or bare)
        if said is not None:
            end = _end_of(items, i, name)
            if end is not None and said > -math.inf and said + _text_score(items[i + 1:end]) >= 0:
                end = None
            within = {x[1] for x in items[i + 1:end or i + 1] if x[0] == TAG}
            title = inside > 0 and ("header" == name or "header" in attrs.lower()) and within & {"h1", "h2"}
            most = False
            if end is not None and bare and (name not in ASIDE or name in WRAPPERS):
                if words is None:
                    words = list(accumulate((len(x[2].split()) if x[0] == TEXT else 0 for x in items), initial=0))
                most = 2 * (words[end] - words[i]) > words[n]
            if end is not None and not within & CONTENT and not title and not most:
                out.append((LEFT, name, ""))
                i = end
                continue
        out.append(items[i])
        i += 1
    return out


def _end_of(items, i: int, name: str) -> int | None:
    """The item after the element that opens at i; None if it never closes."""
    depth = 0
    for j in range(i, len(items)):
        kind, x, _ = items[j]
        if kind != TAG:
            continue
        if x == name:
            depth += 1
            if depth > 1 and name in OPEN_ENDED:
                return j
        elif x == "/" + name:
            depth -= 1
            if depth == 0:
                return j + 1
        elif depth and name == "p" and x.lstrip("/") in BLOCKS:
            return j
    return None


def _token(item: tuple[int, str, str]) -> str:
    kind, name, _ = item
    if kind == LEFT:
        return "left"
    bare = name.lstrip("/")
    return name if bare in BLOCKS or bare in INLINE or bare in VOID else "/other" if name[0] == "/" else "other"


def label(items: list[tuple[int, str, str]]) -> tuple[int, int] | None:
    """The labelled content of a page: its only article (else its only main)
    element, as a range of items; None if the page has no such label."""
    for name in ("article", "main"):
        opens = [i for i, x in enumerate(items) if x[0] == TAG and x[1] == name]
        ends = [i for i, x in enumerate(items) if x[0] == TAG and x[1] == "/" + name]
        if len(opens) == 1 and len(ends) == 1 and opens[0] < ends[0]:
            return opens[0] + 1, ends[0]
    return None


def _count_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    inner, outer = Counter(), Counter()
    for b in batches:
        for page in b.column(0).to_pylist():
            items = leave_out(parse(page or ""))
            lab = label(items)
            if lab is None:
                continue
            for i, x in enumerate(items):
                side = inner if lab[0] <= i < lab[1] else outer
                if x[0] == TEXT:
                    side["word"] += len(x[2].split())
                else:
                    side[_token(x)] += 1
    names = sorted(inner.keys() | outer.keys())
    yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([inner[x] for x in names], pa.int64()),
                                      pa.array([outer[x] for x in names], pa.int64())], ["token", "inner", "outer"])


def fit(pages: DataFrame, sample: int = SAMPLE) -> dict[str, float]:
    """Token weights from labelled pages: log ratio of a token's share inside
    the labelled content to its share outside; words at least 0.05, tags at
    most -0.05.  About ``sample`` pages, those with the smallest hashes of
    page_id, are read (the bounded, documented sample); the driver gets one row
    per known tag name.  Tags never seen, or all without labelled pages, have
    fixed weights."""
    total = pages.count()
    part = F.abs(F.xxhash64(F.coalesce("page_id", F.lit(0))) % F.lit(1 << 30)) / F.lit(float(1 << 30))
    drawn = pages.where(part * F.lit(total) <= sample).where("html is not null").select("html")
    rows = (map_arrow(drawn, _count_tokens, "token string, inner bigint, outer bigint")
            .groupBy("token").agg(F.sum("inner"), F.sum("outer")).collect())
    n_in, n_out = sum(r[1] for r in rows), sum(r[2] for r in rows)
    weights = dict(UNFITTED)
    for token, a, b in rows if n_in and n_out else []:
        ratio = math.log((a + 1) / (n_in + len(rows))) - math.log((b + 1) / (n_out + len(rows)))
        weights[token] = max(0.05, min(3.0, ratio)) if token == "word" else min(-0.05, max(LOWEST.get(token, -12.0), ratio))
    return weights


def _weight(weights: dict[str, float], token: str) -> float:
    w = weights.get(token)
    if w is None:
        bare = token.lstrip("/")
        w = -0.05 if bare in INLINE else -0.5
    return w


def best_run(items: list[tuple[int, str, str]], weights: dict[str, float]) -> tuple[int, int] | None:
    """The range of items with the highest sum of scores (first on ties), by
    one scan; None without a word."""
    best, run, start, found = 0.0, 0.0, 0, None
    for i, x in enumerate(items):
        if run <= 0:
            run, start = 0.0, i
        run += weights["word"] * len(x[2].split()) if x[0] == TEXT else _weight(weights, _token(x))
        if run > best:
            best, found = run, (start, i + 1)
    return found


def render(items: list[tuple[int, str, str]], run: tuple[int, int]) -> str:
    """Text of a run of items, widened to whole blocks: character references
    decoded, white space in a block made one space, blocks joined by line feeds."""
    def breaks(x):
        return x[0] == TAG and x[1].lstrip("/") not in INLINE
    a, b = run
    while a > 0 and not breaks(items[a - 1]):
        a -= 1
    while b < len(items) and not breaks(items[b]):
        b += 1
    blocks, part = [], []
    for x in [*items[a:b], (TAG, "p", "")]:
        if x[0] == TEXT:
            part.append(html.unescape(x[2]))
        elif x[1] == "br":
            part.append(" ")
        elif breaks(x):
            line = " ".join("".join(part).split())
            if line:
                blocks.append(line)
            part = []
    return "\n".join(blocks)


def extract_text(page: str | None, weights: dict[str, float]) -> str:
    if not page:
        return ""
    items = leave_out(parse(page))
    run = best_run(items, weights)
    return render(items, run) if run else ""


def _extract(weights: dict[str, float]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [extract_text(x, weights) for x in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())],
                ["page_id", "url", "text", "n_chars"])
    return run


def extract(pages: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """(page_id, url, text, n_chars): the main text of every page.

    A page is a sequence of words (positive scores) and tags (negative scores);
    the contiguous run with the highest sum is its content, widened to whole
    blocks.  Menus, headers, footers, side columns, notices, adverts, forms,
    scripts, styles and reader comments inside it are left out by element, by
    name of class, id and role, and, where a name is not clear, by a score of
    name, words and links together (see ``leave_out``).  A null or empty page, or one without
    words, has the text ''.  Rows are independent and nothing is shuffled:
    repeated rows and null ids need no care; an empty table gives none."""
    p = pages.select("page_id", "url", "html")
    return map_arrow(p, _extract(weights if weights is not None else fit(p)),
                     f"page_id {p.schema['page_id'].dataType.simpleString()}, url string, text string, n_chars bigint")
