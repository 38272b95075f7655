"""Main text of HTML pages by the distribution of text over line blocks.

Markup is stripped to lines, one per block of the page. The text lengths of
the lines are summed over a sliding window; where the sums surge is the start
of the main text, where they dive is its end, and what lies between is kept.
Lines in parts of a page that say what they are, such as menus, forms, footers
or reader comments, carry no text of the article and count as empty; a link
counts less than text. Short lines around a stretch are taken back where they
stand in the same part of the page as the lines of the stretch. A mark of the article adds to the weight of its lines, and
marked lines are taken alone where they hold most of the text found.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from html import unescape

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Lines summed per window, the sum that starts a stretch, and the one that ends it.
WINDOW = 3
SURGE = 80
DIVE = 25

# Element names of HTML.
RAW_TEXT = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes"}
DROPPED = {
    "script", "style", "head", "title", "noscript", "template", "nav", "header", "footer", "aside",
    "form", "button", "select", "option", "textarea", "input", "label", "fieldset", "iframe",
    "object", "embed", "svg", "math", "canvas", "audio", "video", "map", "dialog", "menu",
    "noembed", "noframes", "xmp",
}
VOID = {
    "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source",
    "track", "wbr",
}
BLOCKS = {
    "address", "article", "blockquote", "body", "caption", "center", "dd", "details", "dir", "div",
    "dl", "dt", "figcaption", "figure", "h1", "h2", "h3", "h4", "h5", "h6", "hgroup", "hr", "html",
    "li", "main", "ol", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th",
    "thead", "tr", "ul",
}
# End tags that may be left out: an element that starts closes an open one of these kinds.
CLOSED_BY = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
    "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
}
# Elements that stand inside a line of text: what they hold is left out, the line goes on.
CONTROLS = {
    "button", "select", "option", "textarea", "input", "label", "svg", "math", "canvas", "audio",
    "video", "map", "object", "embed", "iframe", "noscript", "template",
}
INLINE = {
    "a", "abbr", "b", "cite", "code", "em", "font", "i", "mark", "q", "s", "small", "span", "strong",
    "sub", "sup", "u",
}
TEXT_BLOCKS = {
    "p", "li", "h1", "h2", "h3", "h4", "h5", "h6", "dd", "dt", "blockquote", "figcaption", "caption",
    "pre",
}
# Elements that parts of a page are made of; the others only shape text.
CONTAINERS = {"article", "body", "center", "details", "div", "html", "main", "section", "td", "th"}

# The words of names in class, id, role and aria-label. A name is read like a compound noun: the
# last word that says something tells what the part is, so "user-comments" are comments, and
# "tag-election" is no tag.
NEUTRAL = re.compile(
    r"site|main|page|top|bottom|left|right|bar|areas?|lists?|links?|box(es)?|containers?|wrap|wrapper"
    r"|sections?|blocks?|slots?|dialogs?|panels?|inner|outer|holder|rows?|cols?|columns?|groups?|items?"
    r"|buttons?|btn|icons?|body|content|text|title|heading|authors?|meta|threads?|units?|region"
    r"|[a-z]|\d\w*"
)
ARTICLE = re.compile(r"articles?|posts?|hentry|entry|entries|story|stories|news|reading|reads")
STATES = {"has", "with", "no", "without", "is", "are", "show", "hide", "not", "non"}
COMMENTS = re.compile(r"comments?|commentlist|respond|replies|reply|responses?|disqus")
ASIDE = re.compile(
    r"ads?|adsbygoogle|advert(s|isements?|ising|orial)?|banners?|sponsor(s|ed)?|promo(s|tions?|ted)?"
    r"|nav(bar|igation|menu|links)?|menu(s|bar)?|breadcrumbs?|sidebars?|side|footer|foot|cookies?|consent"
    r"|gdpr|popup|modal|overlay|newsletter|subscribe|signup|login|share|sharing|related"
    r"|recommend(ed|ations?)?|widgets?|pager|pagination|copyright|disclaimer|toolbar|skip|contentinfo"
    r"|complementary"
)
# Words that are subjects of articles as well: they count unless another name says article.
TOPICS = re.compile(r"legal|social|search|tags?|notices?|alerts?|discussions?")
# Blocks that inside an article hold its heading, outside that of the site.
HEADING = re.compile(r"header|masthead")
WORD = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+[^\W_]*|[^\W\d_A-Za-z]+")
TAG = re.compile(
    r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)"
    r"|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|$)|'[^']*(?:'|$))*)(?:>|$)",
    re.S,
)
ATTRIBUTE = re.compile(r"([^\s=/>]+)(?:\s*=\s*(?:\"([^\"]*)\"?|'([^']*)'?|([^\s>]+)))?")
SPACE = re.compile(r"\s+")


def _kind(name: str) -> tuple[str, bool]:
    """What one name says: "comments", "aside", "topic", "heading" or "", and whether it says article."""
    words = [w.lower() for w in WORD.findall(name)]
    if not words or words[0] in STATES:
        return "", False
    while words and NEUTRAL.fullmatch(words[-1]):
        words.pop()
    says_article = bool(words) and bool(ARTICLE.fullmatch(words[-1]))
    of_article = any(ARTICLE.fullmatch(w) for w in words)
    while words and (ARTICLE.fullmatch(words[-1]) or NEUTRAL.fullmatch(words[-1])):
        words.pop()
    head = words[-1] if words else ""
    for kind, pattern in (("comments", COMMENTS), ("aside", ASIDE), ("topic", TOPICS)):
        if pattern.fullmatch(head):
            return kind, says_article
    return "heading" if HEADING.fullmatch(head) and not of_article else "", says_article


@lru_cache(maxsize=20_000)
def _kinds(names: tuple[str, ...]) -> frozenset[str]:
    """What the names of an element say together."""
    said = [_kind(n) for n in names]
    kinds = {k for k, _ in said if k}
    if any(a for _, a in said):
        kinds = (kinds - {"topic"}) | {"article"}
    return frozenset(kinds)


def _set_aside(name: str, attributes: str, inside: bool) -> str:
    """How an element says that what it holds is not the article, or "".

    "hidden" and "muted" hold for sure, "muted" inside a line of text. "comments" are
    reader comments, "named" is any other name. The article itself is none of these
    for its name, except a single comment; an article inside one may be.
    """
    if name in CONTROLS:
        return "muted"
    if name in DROPPED and not (inside and name == "header"):
        return "hidden"
    if not attributes.strip():
        return ""
    names: list[str] = []
    for key, a, b, c in ATTRIBUTE.findall(attributes):
        key = key.lower()
        value = a or b or c
        if key in ("class", "id", "role"):
            names.extend(value.split())
        elif key == "aria-label":
            names.append(value)
        if name in ("html", "body", "main"):
            continue
        if key == "hidden" or key == "aria-hidden" and value.lower() == "true":
            return "hidden"
        if key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return "hidden"
    if not names or name in ("html", "body", "main"):
        return ""
    kinds = _kinds(tuple(names))
    if name == "article" and not inside:
        return "comments" if "comments" in kinds and "article" not in kinds else ""
    if "comments" in kinds:
        return "comments"
    return "named" if kinds & {"aside", "topic"} or not inside and "heading" in kinds else ""


class Line:
    """One block of a page: its text, characters inside links, and where it stands.

    ``part`` is the number of the part of the page the block stands in; it is negative
    for parts made of the page's top level alone.
    """

    __slots__ = ("text", "linked", "aside", "article", "main", "part")

    def __init__(self, text: str, linked: int, aside: bool, article: int, main: int, part: int):
        self.text, self.linked, self.aside = text, linked, aside
        self.article, self.main, self.part = article, main, part

    @property
    def weight(self) -> int:
        return 0 if self.aside else max(0, len(self.text) - 2 * self.linked)


def lines_of(html: str) -> list[Line]:
    """The blocks of a page in order, with character references decoded.

    ``article`` and ``main`` are the numbers of the outermost elements of these
    names a block is in, 0 outside. Unclosed and stray tags, cut pages and ``<`` in
    text are read the way browsers do. Reader comments are aside unless the page's
    <main> is in them. Any other element that is aside by its name alone is not if
    it holds more than half of the page's text outside links, and enough for a surge
    or all there is. The time is in proportion to the page, however it is nested.
    """
    lines: list[Line] = []
    stack: list[tuple[str, str, bool]] = []  # name, how it is aside, marks the article
    open_names: Counter[str] = Counter()
    parts: list[str] = []
    aside = muted = links = linked = n_containers = 0
    # Elements that are aside by name, from number 1: the one around each, whether it is
    # comments, whether <main> is in it, the text it holds.
    around, comments, has_main, held = [0], [False], [False], [0]
    innermost = 0
    within: list[int] = []  # of each line, the innermost of these
    containers: list[tuple[str, int]] = []  # open ones, with their numbers
    blocks: list[str] = []  # open blocks
    inside, found = {"article": 0, "main": 0}, {"article": 0, "main": 0}

    def number(name: str) -> int:
        return found[name] if inside[name] else 0

    def part() -> int:
        """Of text in a block of a container, the container; of text of its own, the one around it."""
        own = bool(blocks) and blocks[-1] in CONTAINERS
        if len(containers) < 1 + own:
            return -2 if own else -1
        name, k = containers[-1 - own]
        return k if name not in ("html", "body") else -2 if own else -1

    def flush() -> None:
        nonlocal linked
        if muted:
            return
        if parts:
            text = SPACE.sub(" ", unescape("".join(parts))).strip()
            if text:
                lines.append(
                    Line(text, linked, aside > 0, number("article"), number("main"), part())
                )
                within.append(innermost)
            parts.clear()
        linked = 0

    def close(count: int) -> None:
        """Leave the innermost ``count`` elements."""
        nonlocal aside, links, muted, innermost
        for _ in range(count):
            name, was_aside, marks = stack.pop()
            open_names[name] -= 1
            if was_aside == "muted":
                muted -= 1
                continue
            if name in BLOCKS or was_aside:
                flush()
            if name in BLOCKS:
                blocks.pop()
            if name in CONTAINERS:
                containers.pop()
            aside -= was_aside == "hidden"
            if was_aside in ("named", "comments"):
                innermost = around[innermost]
            if marks:
                inside[name] -= 1
            links -= name == "a"

    def add(text: str) -> None:
        nonlocal linked
        if text and not muted:
            parts.append(text)
            if links:
                linked += len(text.strip())

    at, end = 0, len(html)
    while at < end:
        start = html.find("<", at)
        if start < 0:
            add(html[at:])
            break
        add(html[at:start])
        tag = TAG.match(html, start)
        if not tag:
            add("<")
            at = start + 1
            continue
        at = tag.end()
        name = (tag[2] or "").lower()
        if not name:
            continue
        if tag[1]:
            if open_names[name]:
                depth = next(k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == name)
                close(len(stack) - depth)
            elif name in BLOCKS:
                flush()
            continue
        if name in RAW_TEXT:
            stop = re.compile(rf"</{re.escape(name)}(?=[\s/>]|$)", re.I).search(html, at)
            at = stop.start() if stop else end
            if stop:
                past = html.find(">", at)
                at = past + 1 if past >= 0 else end
            continue
        if name == "br":
            add(" ")
            continue
        # A block ends a paragraph and a heading that were left open.
        if name in BLOCKS or name in DROPPED and name not in CONTROLS:
            while open_names["p"] and stack[-1][0] in (
                "p", "b", "i", "em", "strong", "span", "font", "u"
            ):
                close(1)
            flush()
        if name in CLOSED_BY and any(open_names[n] for n in CLOSED_BY[name]):
            kinds = CLOSED_BY[name]
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] in kinds:
                    close(len(stack) - k)
                    break
                if stack[k][0] in ("ul", "ol", "dl", "table", "select"):
                    break
        if name in VOID or tag[3].rstrip().endswith("/") and name not in BLOCKS:
            if name == "hr":
                flush()
            continue
        if name == "body":  # the head may be left open
            while stack and stack[-1][0] == "head":
                close(1)
        off = _set_aside(name, tag[3], inside["article"] > 0)
        if muted or off and name in INLINE and blocks and blocks[-1] in TEXT_BLOCKS:
            off = "muted"
        marks = name in ("article", "main") and not off
        if off and off != "muted":
            flush()
        if off == "muted":
            muted += 1
        else:
            if marks:
                found[name] += not inside[name]
                inside[name] += 1
            if name in BLOCKS:
                blocks.append(name)
            if name in CONTAINERS:
                n_containers += 1
                containers.append((name, n_containers))
            links += name == "a"
        stack.append((name, off, marks))
        open_names[name] += 1
        aside += off == "hidden"
        if off in ("named", "comments"):
            around.append(innermost)
            comments.append(off == "comments")
            has_main.append(False)
            held.append(0)
            innermost = len(around) - 1
        elif name == "main":
            has_main[innermost] = True
    close(len(stack))
    flush()
    # Numbers grow inwards: what an element holds is known before that of the one around it.
    total = 0
    for line, k in zip(lines, within):
        held[k] += line.weight
        total += line.weight
    for k in range(len(around) - 1, 0, -1):
        held[around[k]] += held[k]
        has_main[around[k]] |= has_main[k]
    set_aside = [False] * len(around)
    for k in range(1, len(around)):
        if comments[k]:
            goes = not has_main[k]
        else:
            goes = 2 * held[k] <= total or held[k] < min(SURGE, total)
        set_aside[k] = goes or set_aside[around[k]]
    for line, k in zip(lines, within):
        line.aside |= set_aside[k]
    return lines


def _stretches(weights: list[int], window: int, surge: int, dive: int) -> list[tuple[int, int]]:
    """Ranges of lines between a surge of the window sums and the dive after it.

    The sum at a line covers the line and those after it in the window. A
    stretch starts at the first line whose sum reaches ``surge`` and which has
    text; it ends before the first line from where the sum falls below ``dive``.
    """
    n, found, at = len(weights), [], 0
    total = sum(weights[:window])
    sums = []
    for k in range(n):
        sums.append(total)
        total -= weights[k]
        if k + window < n:
            total += weights[k + window]
    while at < n:
        if sums[at] < surge or not weights[at]:
            at += 1
            continue
        end = at + 1
        while end < n and sums[end] >= dive:
            end += 1
        found.append((at, end))
        at = end
    return found


def _size(lines: list[Line]) -> int:
    return sum(x.weight for x in lines)


def _found(lines: list[Line], weights: list[int], window: int, surge: int, dive: int) -> list[Line]:
    """Lines of all stretches, and the short ones of the article around them.

    Lines that follow a stretch inside a window are taken, and lines before it that
    stand in the same part of the page as its first line. Where that part is an
    element of its own, all its lines between the first and the last with text
    outside links are of the article.
    """
    ranges = _stretches(weights, window, surge, dive)
    if not ranges:
        return [x for x in lines if x.weight]
    taken, whole = set(), set()
    for start, end in ranges:
        whole.update(x.part for k, x in enumerate(lines[start:end], start) if weights[k] and x.part > 0)
        last = min(end + window, len(lines))
        while end < last and lines[end].weight:
            end += 1
        part = lines[start].part
        while start and start - 1 not in taken and lines[start - 1].weight and lines[start - 1].part == part:
            start -= 1
        taken.update(range(start, end))
    bounds: dict[int, list[int]] = {}
    for k, line in enumerate(lines):
        if line.part in whole and line.weight:
            bounds.setdefault(line.part, [k, k])[1] = k
    for k, line in enumerate(lines):
        if line.part in bounds and bounds[line.part][0] <= k <= bounds[line.part][1]:
            taken.add(k)
    return [x for k, x in enumerate(lines) if k in taken and not x.aside]


def main_text(
    html: str | None, window: int = WINDOW, surge: int = SURGE, dive: int = DIVE
) -> str:
    """The article of a page: its blocks, white space folded, joined by an empty line.

    The lines between each surge and the dive after it are kept, with the short
    ones around them that stand in the same part of the page. Lines inside
    <article>, or else <main>, weigh ``dive`` more, and are the text alone if
    they hold more than half of what they and the stretches hold. A page whose
    lines never surge is short; its lines that are not mostly links are kept.
    NULL and pages without text give ''.
    """
    lines = lines_of(html or "")
    weights = [
        x.weight + (dive if x.weight and (x.article or x.main) else 0) for x in lines
    ]
    found = _found(lines, weights, window, surge, dive)
    for mark in ("article", "main"):
        marked = [x for x in lines if getattr(x, mark) and not x.aside]
        others = [x for x in found if not getattr(x, mark)]
        if _size(marked) > _size(others):
            found = marked
            break
    return "\n\n".join(x.text for x in found)


def extract(pages: DataFrame, html: str = "html") -> DataFrame:
    """page_id, url, text and n_chars of every row of ``pages``, in one pass and no shuffle.

    Equal pages give equal texts; other columns are ignored; no rows give no rows.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [main_text(h) for h in batch["html"]]
            yield pd.DataFrame(
                {"page_id": batch["page_id"], "url": batch["url"], "text": texts},
                columns=["page_id", "url", "text"],
            ).astype({"url": object, "text": object})

    rows = pages.select("page_id", "url", F.col(f"`{html}`").alias("html"))
    kinds = dict(rows.dtypes)
    found = rows.mapInPandas(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string")
    return found.withColumn("n_chars", F.length("text").cast("long"))
