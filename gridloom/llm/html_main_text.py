"""Main text of HTML pages by line-block distribution.

Markup is stripped into lines, one for each block element, with menus, headers, footers,
sidebars, notices, adverts, forms, scripts, styles and reader comments left out; each such
element leaves empty lines where it stood. A line's length counts its characters outside
links. Over sliding windows of ``WINDOW`` lines the lengths are summed; text surges where a
sum leaves nothing on its way above the threshold, and dives where it falls to nothing
again; all lines between a surge and its dive are kept, and short stretches between kept ones. Where the page
marks its article (``article`` or ``main``), lines outside have no length, and inside every
character counts from the first; else the threshold is ``SURGE`` characters, or half the
page's highest sum if that is lower. Blocks that only their names mark as the article count
so where together they hold a window of the highest sum and half the characters outside links.

A class or id doesn't leave out an element that holds an ``article`` or ``main``, nor one
that holds most of the page's characters outside links. Comments go however long they are: only
an element that wraps the page's own article (the first outside comments) isn't taken for
comments, and one on a page without an article and without a surge of text elsewhere.

Defined results: null or empty html has no text (an empty string); a page that ends early
keeps what it has; repeated rows each give a row; other columns are ignored; an empty
table stays empty. A row's memory is bounded by its own page; no shuffle.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import map_texts

WINDOW, SURGE = 3, 86
FIELDS = {"blocks": pa.list_(pa.string())}

# Element names of HTML by their part in a page, and words of class, id and role.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section "
    "summary table tbody td tfoot th thead tr ul".split()
)
RAW = set("script style textarea title noscript template iframe object svg canvas math noframes xmp".split())
APART = set("head nav footer aside form button select menu dialog".split())
ENDS_P = BLOCKS - {"body", "html", "option", "optgroup", "caption", "tbody", "td", "tfoot", "th", "thead", "tr"}
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
MARKED = set(
    "ad ads adv advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs byline comment comments "
    "consent cookie cookies copyright cta dialog disclaimer disqus footer gdpr header legal login masthead menu modal nav "
    "navbar navigation newsletter notice notices notification overlay pager pagination paywall popover popup promo promoted "
    "promotion recommend recommended recommendations related replies reply respond rail search share sharing shares sidebar "
    "signup skip social sponsor sponsored subscribe subscription tags toc toolbar widget widgets".split()
)
ROLES = set("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
COMMENTS = set("comment comments disqus replies reply respond".split())
ARTICLE_WORDS = set("article content entry main post story".split())
OUTSIDE = ("apart", "doubt", "doubt comments")
STATES = set("has no with without".split())  # begin names of what an element has, not of what it is

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+>"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>|[^>]*+>)",
    re.S,
)
#: What needs no ">" to end at the end of the page.
UNENDED = re.compile(r"<!--.*|<!\[CDATA\[.*", re.S)
ATTRIBUTE = re.compile(r"""([^\s"'=/>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
# Elements that only a list or table holds, and what ends the search for one of them.
LISTED = set().union(SIBLINGS, *SIBLINGS.values())
LISTS = set("ul ol dl table tbody thead tfoot select".split())
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
ZEROS, NO_CHARACTER = re.compile(r"&#0++(?=[0-9])"), re.compile(r"&#[0-9]{8,}+;?")


def decoded(raw: str) -> str:
    """The text with its character references decoded; numbers that are no character's give U+FFFD, however long."""
    if "&#" in raw:
        raw = NO_CHARACTER.sub("\ufffd", ZEROS.sub("&#", raw))
    return entities.unescape(raw)


def part_of(name: str, rest: str, in_article: bool) -> str:
    """``apart`` for an element that is no part of an article, ``doubt`` for one that only its class or id says so of
    (``doubt named`` if they name an article, too, ``doubt comments`` if one of them names comments and none an article
    alone), ``article`` and ``named`` for one that marks it, ``card`` for an
    article named as a comment or the like, else empty."""
    if name in APART or (name == "header" and not in_article):
        return "apart"
    own = name in ("article", "main")
    if rest == ">" or name in ("html", "body"):
        return "article" if own else ""
    words: set[str] = set()
    comments = alone = False
    for key, value in ATTRIBUTE.findall(rest):
        key, value = key.lower(), value.strip("\"'")
        if key in ("class", "id"):
            for token in value.split():
                found = [w.lower() for w in WORD.findall(token)]
                if found and found[0] not in STATES:
                    words.update(found)
                    comments |= not COMMENTS.isdisjoint(found)
                    alone |= COMMENTS.isdisjoint(found) and not ARTICLE_WORDS.isdisjoint(found)
        elif own:
            continue
        elif key == "role" and value.lower() in ROLES or key == "hidden" or key == "aria-hidden" and value.lower() == "true":
            return "apart"
        elif key == "role" and value.lower() in ("article", "main"):
            own = True
        elif key == "style" and HIDDEN.search(value):
            return "apart"
    titled = words & ARTICLE_WORDS
    marked = words & MARKED - {"header", "tags", "byline"} if titled else words & MARKED
    if own:
        return "card" if marked and not titled else "article"
    if comments and not alone:
        return "doubt comments"
    named = "named" if titled and name in ("div", "section", "td") else ""
    return f"doubt {named}".strip() if marked else named


def lines_of(page: str) -> tuple[list[tuple[str, int, int]], list[tuple[int, str]]]:
    """(text, characters outside links, innermost element with a part) per line, and of an element's cliffs an empty
    text and no characters; (element around, part) of the elements with a part, the page itself at 0."""
    lines: list[tuple[str, int, int]] = []
    elements: list[tuple[int, str]] = [(0, "")]
    parts: list[str] = []
    stack: list[tuple[str, str]] = []  # open elements and their part
    opened: Counter[str] = Counter()  # how many of each name are open
    blocks: list[int] = []  # where block elements are in the stack
    listed: list[int] = []  # where lists, tables and what they hold are
    inmost = 0
    apart = links = articles = 0
    outside = 0

    def flush() -> None:
        nonlocal outside
        if parts:
            if text := " ".join(decoded("".join(parts)).split()):
                lines.append((text, outside, inmost))
            parts.clear()
        outside = 0

    def add(raw: str) -> None:
        nonlocal outside
        if raw and not apart:
            parts.append(raw)
            if not links:
                outside += len("".join(raw.split()))

    def cliff() -> None:
        lines.append(("", 0, inmost))

    def enter(part: str) -> None:
        nonlocal inmost
        elements.append((inmost, part))
        inmost = len(elements) - 1
        cliff()

    def close(to: int) -> None:
        """Closes the open elements down to a depth."""
        nonlocal apart, links, articles, inmost
        while len(stack) > to:
            name, part = stack.pop()
            opened[name] -= 1
            if name in BLOCKS:
                blocks.pop()
                if not apart:
                    flush()
            if name in LISTED or name in LISTS:
                listed.pop()
            links -= name == "a"
            if part:
                articles -= part != "apart" and part != "doubt"
                apart -= part == "apart"
                flush()
                cliff()
                inmost = elements[inmost][0]

    at, n = 0, len(page)
    last = page.rfind(">")  # behind it no tag ends
    while at < n:
        tag = (TAG if at <= last else UNENDED).search(page, at)
        if not tag:
            add(page[at:])
            break
        add(page[at : tag.start()])
        at = tag.end()
        if tag.re is UNENDED or not tag["name"]:
            if page.startswith("<![CDATA[", tag.start()):
                add(entities.escape(tag[0][9:].removesuffix("]]>")))
            continue
        name = tag["name"].lower()
        if tag["end"]:
            if opened[name]:
                close(next(i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name))
            elif name in BLOCKS and not apart:
                flush()
            continue
        if name == "br" or name == "wbr":
            add(" " if name == "br" else "")
            continue
        if name in RAW:
            if not tag["rest"].endswith("/>"):
                end = re.compile(rf"</{re.escape(name)}(?![^\s/>])[^>]*(?:>|\Z)", re.I).search(page, at)
                at = end.end() if end else n
            continue
        if name in ENDS_P and blocks and stack[blocks[-1]][0] == "p":
            close(blocks[-1])
        if name in SIBLINGS:
            around = next((i for i in reversed(listed) if stack[i][0] in SIBLINGS[name] or stack[i][0] in LISTS), None)
            if around is not None and stack[around][0] in SIBLINGS[name]:
                close(around)
        if name == "body" and stack and stack[-1][0] == "head":
            close(len(stack) - 1)
        if name in BLOCKS and not apart:
            flush()
        if name in VOID or tag["rest"].endswith("/>") and name not in BLOCKS:
            continue
        part = part_of(name, tag["rest"], articles > 0)
        if apart and part != "apart":
            part = ""
        if part:
            flush()
            apart += part == "apart"
            articles += part not in OUTSIDE
            enter(part)
        links += name == "a"
        if name in BLOCKS:
            blocks.append(len(stack))
        if name in LISTED or name in LISTS:
            listed.append(len(stack))
        opened[name] += 1
        stack.append((name, part))
    flush()
    return lines, elements


def measured(page: str) -> tuple[list[tuple[str, int]], bool]:
    """(text, length) per line that is part of the page's text, empty lines included; whether an article limits them."""
    lines, elements = lines_of(page)
    held = [0] * len(elements)  # characters outside links
    for _, outside, at in lines:
        held[at] += outside
    holds = [part == "article" for _, part in elements]
    # Whether an element is set apart or is comments; the page's own article is the first that isn't in such, or else the first.
    aside = [False] * len(elements)
    for k, (around, part) in enumerate(elements[1:], 1):
        aside[k] = aside[around] or part in ("apart", "doubt comments")
    own = min((aside[k], k) for k in range(len(elements)) if holds[k])[1] if any(holds) else 0
    wraps = set()
    while own:
        wraps.add(own)
        own = elements[own][0]
    enough = max(sums_of([0 if aside[at] else outside for _, outside, at in lines]), default=0) > SURGE
    for k in range(len(elements) - 1, 0, -1):
        around = elements[k][0]
        held[around] += held[k]
        holds[around] |= holds[k]
    # From the outside in: whether an element is left out, doubted, in a marked article, in an article by any sign.
    gone, doubted, sure, inside = ([False] * len(elements) for _ in range(4))
    for k, (around, part) in enumerate(elements[1:], 1):
        doubt = part.startswith("doubt")
        if part == "doubt comments":
            leaves = k not in wraps and (enough or bool(wraps) or 2 * held[k] <= held[0])
        else:
            leaves = part == "apart" or doubt and not holds[k] and 2 * held[k] <= held[0]
        gone[k] = gone[around] or leaves
        doubted[k] = doubted[around] or doubt
        sure[k] = sure[around] or part in ("article", "card") and not doubted[k]
        inside[k] = inside[around] or part not in OUTSIDE
    marked = any(sure)

    def windows(limited: bool) -> tuple[list[tuple[str, int, bool]], list[int]]:
        rows: list[tuple[str, int, bool]] = []
        for text, outside, at in lines:
            part = elements[at][1]
            if text:
                if not gone[at]:
                    rows.append((text, outside, inside[at]))
            elif gone[at] or part in ("article", "card") or limited and part.endswith("named"):
                rows.extend([("", 0, inside[at])] * WINDOW)
        return rows, sums_of([outside for _, outside, _ in rows])

    rows, sums = windows(marked)
    if not marked and any(inside):
        most = max(sums, default=0)
        highest = any(x == most and all(within or not outside for _, outside, within in rows[i : i + WINDOW]) for i, x in enumerate(sums))
        marked = highest and 2 * sum(x for _, x, within in rows if within) >= sum(x for _, x, _ in rows)
        rows = windows(True)[0] if marked else rows
    return [(text, (len(text) if within else 0) if marked else outside) for text, outside, within in rows], marked


def sums_of(lengths: list[int]) -> list[int]:
    """Per line the lengths of the window that begins there."""
    running = [0]
    for x in lengths:
        running.append(running[-1] + x)
    return [running[min(i + WINDOW, len(lengths))] - running[i] for i in range(len(lengths))]


def kept_blocks(page: str | None) -> list[str]:
    """The lines between each surge and its dive, and between kept ones."""
    lines, marked = measured(page or "")
    sums = sums_of([length for _, length in lines])
    threshold = 0 if marked else min(SURGE, max(sums, default=0) // 2)
    kept: list[str] = []
    rising: list[str] = []  # lines since the last kept stretch, or from the last dive before the first
    surged = False
    for (text, _), total in zip(lines, sums):
        if total == 0:
            if surged:
                kept += rising
            if surged or not kept:
                rising = []
            surged = False
        else:
            surged |= total > threshold
            if text:
                rising.append(text)
    kept += rising if surged else []
    return kept


def extract_main_text(pages: DataFrame, keys: list[str], html_col: str = "html") -> DataFrame:
    """The keys, and ``blocks``: the kept lines of the page in order."""

    def worker() -> Callable[[list], dict[str, list]]:
        return lambda texts: {"blocks": [kept_blocks(t) for t in texts]}

    return map_texts(pages, keys, html_col, FIELDS, worker)


def text_of_blocks(extracted: DataFrame, keys: list[str]) -> DataFrame:
    text = F.array_join("blocks", "\n\n")
    return extracted.select(*keys, text.alias("text"), F.length(text).cast("long").alias("n_chars"))
