"""Main-text extraction by line-block distribution.

Markup is stripped into lines (one per block element).  Each line weighs the length of its
text outside links; lines of boilerplate elements weigh nothing and stand apart by empty
lines.  Sums of the weights over a sliding window of lines rise from zero at a *surge* point
and fall back to zero at a *dive* point, and the text between them is kept.
"""

from __future__ import annotations

import html
import re

from pyspark.sql import DataFrame

from marquee.llm.common import add_columns

WINDOW = 3  # lines per block of the distribution

# Element names by their role in HTML.
HIDDEN = frozenset("script style noscript template head title svg math iframe object canvas audio video "
                   "button select datalist textarea".split())
BOILERPLATE = frozenset("nav header footer aside form menu dialog".split())
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
                  "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol "
                  "p pre section summary table tbody td tfoot th thead tr ul".split())
# Block elements that hold others: where a stretch of text lies.
CONTAINERS = frozenset("article body center details div fieldset main section td th".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Class, id and role words of elements that are not the article.
OUTSIDE = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion nav navbar navigation menu "
    "breadcrumb breadcrumbs sidebar aside footer masthead header cookie cookies consent notice notices gdpr popup modal "
    "overlay newsletter subscribe subscription signup login share sharing social related recommended comment comments "
    "respond disqus widget pagination pager toolbar complementary contentinfo search skip legal disclaimer alert".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|title|textarea|iframe)\b[^>]*+>.*?(?:</(?P=raw)\s*+>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*+)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+'|[\"'])*+)(?:>|\Z)"
    r"|<[!?/][^>]*+(?:>|\Z)",
    re.S | re.I)
NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
WORDS = re.compile(r"[a-z]+")


def _outside(tag: str, attrs: str, in_article: int) -> bool:
    if tag in BOILERPLATE:  # the heading block of an article belongs to it
        return not (tag == "header" and in_article)
    if not attrs or tag in ("html", "body", "main", "article") and "omment" not in attrs:
        return False
    named = " ".join(x for m in NAMES.findall(attrs) for x in m if x)
    if not named:
        return False
    spaced = re.sub(r"([a-z])([A-Z])", r"\1 \2", named).lower()
    return not OUTSIDE.isdisjoint(WORDS.findall(spaced))


def _elements(tokens: list) -> tuple[dict[int, int], set[int], list[int], dict[int, int]]:
    """How start tags (by their place in ``tokens``) nest: the place where each element ends
    (one without an end tag ends with the one around it, or is missing), which have an end tag
    of their own, the innermost container behind each token (-1: none) and that of each
    container."""
    stack: list[tuple[str, int]] = []
    open_of: dict[str, int] = {}
    ends: dict[int, int] = {}
    closed: set[int] = set()
    holder: list[int] = []
    around: dict[int, int] = {}
    containers = [-1]

    def pop(i):
        name, at = stack.pop()
        open_of[name] -= 1
        ends[at] = i
        if containers[-1] == at:
            containers.pop()
        return name, at

    for i, m in enumerate(tokens):
        tag = m["tag"] and m["tag"].lower()
        if tag and tag not in VOID:
            block = tag in BLOCK or tag == "html"
            if not m["end"]:
                if block and open_of.get("p") and next((n for n, _ in reversed(stack) if n in BLOCK), "") == "p":
                    while pop(i)[0] != "p":
                        pass
                if not m["attrs"].endswith("/"):
                    stack.append((tag, i))
                    open_of[tag] = open_of.get(tag, 0) + 1
                    if tag in CONTAINERS:
                        around[i] = containers[-1]
                        containers.append(i)
            elif open_of.get(tag):
                # an inline end tag ends nothing beyond the block that it stands in
                if block or tag in HIDDEN or next(n for n, _ in reversed(stack) if n == tag or n in BLOCK) == tag:
                    while True:
                        name, at = pop(i)
                        if name == tag:
                            closed.add(at)
                            break
        holder.append(containers[-1])
    return ends, closed, holder, around


def page_lines(page: str) -> tuple[list[tuple[str, int, bool, int]], bool, dict[int, int]]:
    """Lines of a page as ``(text, weight, inside, container)``, whether it marks an article,
    and the container around each container.

    An empty text with weight 0 separates; where the page has an ``article`` or ``main``
    element, ``inside`` tells the lines in one.  A skipped element without an end tag ends
    with the element around it or where an article starts, a head where the body does."""
    lines: list[tuple] = []
    buf: list[str] = []
    linked = 0
    link = article = 0
    skip = None
    inner = -1
    found = False
    tokens = list(TOKEN.finditer(page))
    ends, closed, holder, around = _elements(tokens)
    balance: dict[str, int] = {}
    for m in tokens:
        if m["tag"]:
            tag = m["tag"].lower()
            balance[tag] = balance.get(tag, 0) + (-1 if m["end"] else 0 if m["attrs"].endswith("/") else 1)

    def flush(i):
        nonlocal buf, linked
        if buf:
            text = " ".join(html.unescape("".join(buf)).split())
            if text:
                lines.append((text, max(0, len(text) - linked), article > 0, holder[i - 1] if i else -1))
            buf, linked = [], 0

    def gap(i):
        flush(i)
        lines.extend([("", 0, False, -1)] * WINDOW)

    def ended(i, tag, closing):
        """Whether the skipped element has ended before this token."""
        name, own = tokens[skip]["tag"].lower(), skip in closed
        if i >= ends.get(skip, len(tokens)):
            return True
        if closing or tag is None:
            return False
        if name in ("p", "li"):
            return tag in BLOCK  # an unclosed paragraph ends where the next block starts
        if name == "head":
            return not own and tag in BLOCK
        # with more start than end tags of a name, which of them is unclosed cannot be told
        return tag in ("article", "main") and (not own or balance[name] > 0 and not found)

    at = 0
    for i, m in enumerate(tokens):
        if skip is None and m.start() > at:
            piece = page[at:m.start()]
            buf.append(piece)
            if link:
                linked += len(piece.strip())
        at = m.end()
        tag = m["tag"]
        tag, closing = tag and tag.lower(), bool(m["end"])
        if skip is not None:
            if i <= inner:
                continue
            if not ended(i, tag, closing):
                if tag in HIDDEN and i in closed:
                    inner = ends[i]
                continue
            own = skip in closed and i == ends[skip]
            skip = None
            if own:
                continue
        if tag is None:
            continue
        if tag in VOID:
            if tag == "hr":
                flush(i)
            elif tag == "br":
                buf.append(" ")
            continue
        if not closing and (tag in HIDDEN or _outside(tag, m["attrs"], article)) and not m["attrs"].endswith("/"):
            if tag in BLOCK or tag not in ("span", "a", "b", "i", "em", "strong", "small"):
                gap(i)
            skip = i
            continue
        if tag == "a":
            link = 0 if closing else 1
        elif tag in BLOCK:
            flush(i)
            if tag in ("article", "main"):
                found = True
                article = max(0, article - 1) if closing else article + 1
    if skip is None and at < len(page):
        buf.append(page[at:])
    flush(len(tokens))
    return lines, found, around


def surge_to_dive(weights: list[int], window: int = WINDOW) -> list[tuple[int, int]]:
    """Stretches ``[start, end)`` of lines between each surge of the windowed weight sums
    above zero and the dive back to zero."""
    out, start = [], None
    for i, w in enumerate(weights):
        if start is None and w:
            start, last, run = i, i, 0
        elif start is not None and w:
            last, run = i, 0
        elif start is not None:
            run += 1
            if run >= window:  # the window sum is zero again
                out.append((start, last + 1))
                start = None
    if start is not None:
        out.append((start, last + 1))
    return out


def main_text(page: str | None) -> str:
    """The article's blocks in page order, joined by a newline; empty for NULL, empty or
    text-less pages.

    Where the page marks an article, every line inside it is kept, links or not; else the
    heaviest stretch, those of at least a quarter of its weight, and every stretch that lies in
    the container that all these share."""
    if not page:
        return ""
    lines, marked, around = page_lines(page)
    if marked:
        return "\n".join(t for t, _, inside, _ in lines if inside)
    stretches = surge_to_dive([w for _, w, _, _ in lines])
    if not stretches:
        return ""
    mass = [sum(w for _, w, _, _ in lines[a:b]) for a, b in stretches]

    def path(container):
        out = [container]
        while out[-1] != -1:
            out.append(around[out[-1]])
        return out[::-1]
    paths = [[path(c) for _, w, _, c in lines[a:b] if w] for a, b in stretches]
    heavy = [p for ps, x in zip(paths, mass, strict=True) if 4 * x >= max(mass) for p in ps]
    shared = [x for x, *rest in zip(*heavy, strict=False) if all(y == x for y in rest)]
    return "\n".join(t for (a, b), ps, x in zip(stretches, paths, mass, strict=True)
                     if 4 * x >= max(mass) or all(p[:len(shared)] == shared for p in ps)
                     for t, _, _, _ in lines[a:b] if t)


def extract_main_text(df: DataFrame, html_col: str = "html", keep=None) -> DataFrame:
    """``df`` with ``text`` (main text of ``html_col``) and ``n_chars`` (its code points).

    Row by row and without a shuffle: repeated rows stay, NULL or empty markup gives the
    empty text, whole pages are read whatever their length, an empty table gives an empty
    result, and a column named like an output is replaced.
    """
    def make():
        def f(pages):
            texts = [main_text(p) for p in pages]
            return texts, [len(t) for t in texts]
        return f
    return add_columns(df, [html_col], "text string, n_chars long", make, keep)
