"""Main text of web pages: flat text blocks classified by a decision tree.

A page is cut into flat text blocks: block-level tags end a block, inline tags
do not.  Every block gets its word count, its link density (the share of its
words inside links), the same of the blocks before and after it, and which
kind of region it stands in.  A decision tree trained on the small labelled
table below says which blocks are content; they are joined in page order.
"""

from __future__ import annotations

import html as _html
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of HTML: elements whose content is not text of the page,
# elements that stay inside a line, and those that have no end tag.
RAW = {"script", "style", "noscript", "template", "textarea", "iframe", "svg", "math", "head", "select",
       "object", "canvas", "audio", "video", "noembed", "noframes", "xmp"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font",
          "i", "img", "ins", "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span",
          "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track",
        "wbr"}
# An open <p>, <li> ... ends where one of the same group begins.
OPTIONAL_END = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
                "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
#: Regions that hold no article text, by element and by a word of class, id or role.
ASIDE_TAGS = {"nav", "header", "footer", "aside", "form", "menu", "dialog", "button", "fieldset"}
ASIDE_WORDS = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored", "promo",
               "promoted", "banner", "cookie", "cookies", "consent", "gdpr", "notice", "notices", "notification",
               "alert", "popup", "modal", "newsletter", "subscribe", "subscription", "signup", "login", "nav",
               "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "sidebar", "side", "widget", "footer",
               "masthead", "topbar", "toolbar", "header", "comment", "comments", "commentlist", "reply",
               "replies", "respond", "disqus", "related", "recommended", "share", "sharing", "social", "pagination",
               "pager", "tags", "copyright", "legal", "disclaimer", "skip", "search", "contentinfo",
               "complementary"}
MAIN_TAGS = {"article", "main"}
MAIN_WORDS = {"article", "main", "content", "post", "entry", "story", "body"}

# <!-- ... -->, <!doctype ...>, <?...>, or a tag with its quoted attributes.
_TOKEN = re.compile(
    r"<!--.*?(?:-->|--!>|$)|<[!?][^>]*(?:>|$)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|$)|'[^']*(?:'|$))*)(?:>|$)",
    re.S)
_ATTR = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"?|'([^']*)'?|([^\s>]+)))?")
_UNSEEN = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*hidden)\b", re.I)
_WORD = re.compile(r"[^\W_]+")

FEATURES = ["words", "link_density", "words_before", "link_density_before", "words_after", "link_density_after",
            "region"]
CONTENT, OUTSIDE, BOILER = 2, 1, 0  # region: in an article, elsewhere, in an aside

# The labelled table the tree learns from: (words, link density, the block
# before, the block after, region, is content).  Blocks of invented pages.
LABELLED = [
    # paragraphs and headings inside an article, long, short, linked
    (62, 0.0, 41, 0.0, 88, 0.0, 2, 1), (3, 0.0, 70, 0.0, 55, 0.0, 2, 1), (1, 0.0, 9, 0.0, 120, 0.0, 2, 1),
    (11, 0.0, 6, 1.0, 48, 0.0, 2, 1), (9, 0.0, 12, 0.0, 60, 0.0, 2, 1), (140, 0.05, 3, 0.0, 90, 0.0, 2, 1),
    (25, 0.4, 60, 0.0, 44, 0.0, 2, 1), (5, 1.0, 80, 0.0, 71, 0.0, 2, 1), (2, 0.5, 33, 0.1, 50, 0.0, 2, 1),
    (300, 0.0, 1, 1.0, 8, 0.0, 2, 1), (7, 0.0, 30, 0.0, 9, 0.0, 2, 1), (18, 0.0, 0, 0.0, 0, 0.0, 2, 1),
    (4, 0.0, 1, 1.0, 0, 0.0, 2, 1), (1, 1.0, 1, 1.0, 1, 1.0, 2, 1), (12, 0.9, 14, 0.9, 10, 0.9, 2, 1),
    # lists of links inside an article
    (4, 1.0, 5, 1.0, 6, 1.0, 2, 0), (5, 1.0, 4, 1.0, 4, 1.0, 2, 0), (6, 1.0, 5, 1.0, 5, 1.0, 2, 0),
    # menus, headers, footers, adverts, notices, comments: long ones too
    (1, 1.0, 0, 0.0, 1, 1.0, 0, 0), (1, 1.0, 1, 1.0, 1, 1.0, 0, 0), (1, 1.0, 1, 1.0, 9, 0.0, 0, 0),
    (10, 0.0, 1, 1.0, 12, 0.0, 0, 0), (8, 0.0, 45, 0.0, 0, 0.0, 0, 0), (35, 0.0, 60, 0.0, 20, 0.0, 0, 0),
    (120, 0.0, 80, 0.0, 4, 0.0, 0, 0), (60, 0.1, 2, 1.0, 30, 0.0, 0, 0), (3, 0.0, 2, 0.0, 90, 0.0, 0, 0),
    (30, 0.0, 40, 0.0, 50, 0.0, 0, 0), (18, 0.0, 60, 0.0, 40, 0.0, 0, 0), (14, 0.0, 0, 0.0, 0, 0.0, 0, 0),
    (6, 0.0, 45, 0.0, 60, 0.0, 0, 0), (90, 0.0, 2, 1.0, 3, 1.0, 0, 0), (22, 0.0, 40, 0.0, 35, 0.0, 0, 0),
    (50, 0.0, 4, 0.0, 70, 0.0, 0, 0), (12, 0.0, 3, 1.0, 30, 0.0, 0, 0), (4, 0.0, 33, 0.0, 28, 0.1, 0, 0),
    (40, 0.2, 9, 0.0, 11, 0.0, 0, 0), (75, 0.0, 20, 0.0, 12, 0.0, 0, 0), (8, 0.0, 2, 1.0, 75, 0.0, 0, 0),
    (15, 0.3, 70, 0.0, 6, 1.0, 0, 0), (240, 0.0, 55, 0.0, 3, 0.0, 0, 0), (2, 0.0, 0, 0.0, 0, 0.0, 0, 0),
    # the same after or before a long paragraph of the article, long ones too
    (6, 0.0, 100, 0.0, 0, 0.0, 0, 0), (9, 0.3, 240, 0.0, 5, 0.5, 0, 0), (160, 0.0, 150, 0.0, 170, 0.0, 0, 0),
    (45, 0.0, 130, 0.0, 60, 0.0, 0, 0), (95, 0.02, 130, 0.0, 120, 0.0, 0, 0), (25, 0.1, 300, 0.0, 180, 0.0, 0, 0),
    (210, 0.0, 95, 0.0, 140, 0.05, 0, 0),
    # outside any marked region: long text without links, or short beside it
    (50, 0.0, 4, 0.0, 70, 0.0, 1, 1), (31, 0.1, 60, 0.0, 25, 0.0, 1, 1), (90, 0.05, 2, 1.0, 3, 1.0, 1, 1),
    (22, 0.0, 40, 0.0, 35, 0.0, 1, 1), (6, 0.0, 45, 0.0, 60, 0.0, 1, 1), (8, 0.0, 2, 1.0, 75, 0.0, 1, 1),
    (5, 0.0, 30, 0.0, 52, 0.0, 1, 1), (18, 0.0, 60, 0.0, 4, 1.0, 1, 1), (14, 0.0, 0, 0.0, 0, 0.0, 1, 1),
    (4, 0.0, 33, 0.0, 28, 0.1, 1, 1), (40, 0.2, 9, 0.0, 11, 0.0, 1, 1), (12, 0.0, 3, 1.0, 30, 0.0, 1, 1),
    (2, 1.0, 2, 1.0, 3, 1.0, 1, 0), (1, 1.0, 0, 0.0, 2, 1.0, 1, 0), (3, 1.0, 1, 1.0, 40, 0.0, 1, 0),
    (9, 0.8, 50, 0.0, 2, 1.0, 1, 0), (20, 0.9, 3, 1.0, 2, 1.0, 1, 0), (2, 0.0, 2, 1.0, 3, 1.0, 1, 0),
    (3, 0.0, 1, 1.0, 2, 0.5, 1, 0), (30, 0.7, 25, 0.8, 22, 0.9, 1, 0), (4, 0.6, 60, 0.0, 3, 1.0, 1, 0),
    (2, 0.0, 3, 0.0, 2, 1.0, 1, 0), (1, 0.0, 1, 1.0, 1, 1.0, 1, 0), (6, 0.5, 5, 0.6, 7, 0.5, 1, 0),
]


def train_tree(rows=LABELLED, depth: int = 6):
    """A binary decision tree by Gini gain: ("leaf", label) or
    (feature, threshold, at most, above).  Ties: first feature, lowest threshold."""
    data = np.array([r[:7] for r in rows], float)
    label = np.array([r[7] for r in rows], int)

    def gini(y):
        p = y.mean() if len(y) else 0.0
        return len(y) * 2 * p * (1 - p)

    def grow(at, left):
        y = label[at]
        if left == 0 or y.min() == y.max():
            return ("leaf", int(round(y.mean())))
        best = None
        for f in range(data.shape[1]):
            values = np.unique(data[at, f])
            for t in (values[1:] + values[:-1]) / 2:
                low = data[at, f] <= t
                cost = gini(y[low]) + gini(y[~low])
                if best is None or cost < best[0] - 1e-9:
                    best = (cost, f, float(t), low)
        if best is None or best[0] >= gini(y) - 1e-9:
            return ("leaf", int(round(y.mean())))
        return (best[1], best[2], grow(at[best[3]], left - 1), grow(at[~best[3]], left - 1))

    return grow(np.arange(len(data)), depth)


def classify(tree, x) -> int:
    while tree[0] != "leaf":
        tree = tree[2] if x[tree[0]] <= tree[1] else tree[3]
    return tree[1]


def _attributes(attrs: str) -> dict[str, str]:
    """Attribute values by lower-case name; of a repeated name the first counts."""
    out: dict[str, str] = {}
    for m in _ATTR.finditer(attrs):
        out.setdefault(m[1].lower(), m[2] or m[3] or m[4] or "")
    return out


def _hidden(attrs: str) -> bool:
    """Whether the element itself is not shown: by the attribute named hidden,
    by aria-hidden, or by display or visibility in its style."""
    if not re.search("hidden|none", attrs, re.I):
        return False
    a = _attributes(attrs)
    return ("hidden" in a and not a["hidden"].strip().lower().startswith(("false", "until"))
            or a.get("aria-hidden", "").strip().lower() == "true"
            or _UNSEEN.search(_html.unescape(a.get("style", ""))) is not None)


def _region(tag: str, attrs: str, inherited: int) -> int:
    """The region of an element's text.  A name (of class, id, role, itemprop)
    made of ``MAIN_WORDS`` alone marks the article whatever else the element is
    called ("content with-sidebar"); inside an aside one needs the word main or
    article, others only leave the text to its features.  A name with words
    of both kinds ("entry-header") says nothing."""
    if tag in ASIDE_TAGS:
        return BOILER
    names = []
    if "=" in attrs:
        a = _attributes(attrs)
        names = [{w.lower() for w in _WORD.findall(re.sub(r"(?<=[a-z])(?=[A-Z])", " ", n).replace("_", " "))}
                 for k in ("class", "id", "role", "itemprop") for n in a.get(k, "").split()]
    aside = any(n & ASIDE_WORDS and not n & MAIN_WORDS for n in names)
    only_aside = any(n and all(w in ASIDE_WORDS or w.isdigit() for w in n) for n in names)
    if tag in MAIN_TAGS:
        return inherited if aside and inherited == BOILER else CONTENT
    if tag in ("html", "body"):
        return inherited
    marks = [n for n in names if n and n <= MAIN_WORDS]
    if marks and tag not in INLINE:
        if only_aside:
            return inherited
        return CONTENT if inherited != BOILER or any(n & MAIN_TAGS for n in marks) else OUTSIDE
    if aside:
        return BOILER
    if inherited != BOILER and tag not in INLINE and any(n & MAIN_WORDS and not n & ASIDE_WORDS for n in names):
        return CONTENT
    return inherited


def blocks(page: str) -> list[tuple[str, int, int, int]]:
    """(text, words, words in links, region) of every flat text block, in page
    order; character references decoded, runs of white space made one space.
    Unclosed and stray tags are taken as browsers take them, roughly: an end
    tag closes up to its nearest open partner and is ignored without one."""
    out: list[tuple[str, int, int, int]] = []
    stack: list[tuple[str, int]] = [("", OUTSIDE)]
    pieces: list[str] = []
    linked: list[str] = []
    links = 0

    def end(region):
        if pieces:
            text = " ".join(_html.unescape("".join(pieces)).split())
            if text:
                out.append((text, text.count(" ") + 1,
                            len(_html.unescape(" ".join(linked)).split()) if linked else 0, region))
            pieces.clear()
            linked.clear()

    def close(to):
        nonlocal links
        end(stack[-1][1])
        for tag, _ in stack[to:]:
            links -= tag == "a"
        del stack[to:]

    at, n = 0, len(page)
    while at < n:
        m = _TOKEN.search(page, at)
        stop = m.start() if m else n
        if stop > at:
            pieces.append(page[at:stop])
            if links:
                linked.append(page[at:stop])
        if m is None:
            break
        at = m.end()
        tag = m[2]
        if tag is None:
            continue
        tag = tag.lower()
        if m[1]:
            if tag in VOID:
                if tag == "br":
                    pieces.append(" ")
                continue
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] == tag:
                    if tag in INLINE:
                        links -= tag == "a"
                        crossed = stack[i][1] != stack[i - 1][1]
                        if crossed:
                            end(stack[-1][1])
                        del stack[i]
                    else:
                        close(i)
                    break
                if tag in INLINE and stack[i][0] not in INLINE:
                    break  # an inline end tag does not reach out of its block
            else:
                if tag not in INLINE:
                    end(stack[-1][1])
            continue
        attrs = m[3] or ""
        if tag in VOID:
            if tag == "br":
                pieces.append(" ")
            elif tag == "hr":
                end(stack[-1][1])
            continue
        if tag in RAW or tag not in ("html", "body") and _hidden(attrs):
            if tag not in INLINE:
                end(stack[-1][1])
            if not attrs.rstrip().endswith("/"):
                at = _after(page, at, tag)
            continue
        if tag in INLINE:
            region = _region(tag, attrs, stack[-1][1]) if attrs else stack[-1][1]
            if region != stack[-1][1]:
                end(stack[-1][1])
            stack.append((tag, region))
            links += tag == "a"
            continue
        end(stack[-1][1])
        ends = OPTIONAL_END.get(tag)
        inner = len(stack) - 1
        while inner > 0 and stack[inner][0] in INLINE:
            inner -= 1
        if ends and inner > 0 and stack[inner][0] in ends:
            close(inner)
        elif stack[inner][0] == "p":  # any block ends a paragraph
            close(inner)
        elif tag in ("article", "main", "section", "footer", "header", "nav", "aside") and inner < len(stack) - 1:
            close(inner + 1)  # inline elements left open do not reach into sections
        stack.append((tag, _region(tag, attrs, stack[-1][1])))
    end(stack[-1][1])
    return out


def _after(page: str, at: int, tag: str) -> int:
    """Past the end tag that closes an element opened just before ``at``;
    elements of text alone end at the first end tag, others may nest."""
    nests = tag not in ("script", "style", "textarea", "iframe", "xmp", "noembed", "noframes", "noscript")
    depth = 1
    for m in re.compile(rf"<(/?){re.escape(tag)}(?=[\s/>])[^>]*>", re.I).finditer(page, at):
        if m[1]:
            depth -= 1
            if not depth:
                return m.end()
        elif nests:
            depth += 1
    return len(page) if tag in ("script", "style", "textarea", "xmp") else at


def main_text(page: str, tree) -> str:
    found = blocks(page)
    kept = []
    for i, (text, words, linked, region) in enumerate(found):
        w0, l0 = (found[i - 1][1], found[i - 1][2]) if i else (0, 0)
        w1, l1 = (found[i + 1][1], found[i + 1][2]) if i + 1 < len(found) else (0, 0)
        x = (words, linked / words, w0, l0 / w0 if w0 else 0.0, w1, l1 / w1 if w1 else 0.0, region)
        if classify(tree, x):
            kept.append(text)
    return "\n".join(kept)


def extract_main_text(df: DataFrame, html: str = "html", out: str = "text") -> DataFrame:
    """``df`` with the main text of its html column (null html counts as empty,
    a page without content gives an empty text).  Rows do not move: no shuffle."""
    tree = train_tree()

    @F.pandas_udf("string")
    def extracted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for pages in batches:
            yield pd.Series([main_text(p, tree) if p else "" for p in pages], dtype="object")

    return df.withColumn(out, extracted(F.coalesce(F.col(html), F.lit(""))))
