"""HTML main text: flat blocks, shallow features of a block and its neighbours, a small trained decision tree.

A page is cut at block-level tags into flat text blocks. A block is described by
its word count and link density, those of the blocks before and after it, and
hints of its place: whether it lies in an article container, whether a
container or its class, id or role names boilerplate, and whether the page has
an article container at all. Scripts without spaces count a word a character. A decision tree (Gini
splits) grown on a small labelled table tells main text from the rest.

Names are weak hints: a container that holds the page's main or article element,
or most of its running text, is not boilerplate by its class or id alone.

Defined cases: null or empty html gives empty text; unclosed and stray tags,
comments and cut-off pages are read as far as they go; character references are
decoded as browsers do; an empty table gives an empty result; repeated rows give
repeated results; formulas, drawings and fallback content are text like any
other. Time is linear in a page, however many containers are left open. Columns
other than the id, url and html are not read.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# -- fixed values: HTML element classes and usual names of page furniture ----------------------------
#: Content of these is never text.
DROPPED = {"script", "style", "title", "textarea", "template", "iframe", "select", "datalist", "button", "audio", "video", "desc",
           "metadata", "annotation", "annotation-xml"}
#: A list of choices that is left open ends before these.
ENDS_SELECT = {"select", "input", "textarea"}
#: Of those, elements whose content is not markup.
RAW = {"script", "style", "title", "textarea", "iframe"}
#: These start and end a block.
BLOCKS = {"address", "article", "aside", "blockquote", "body", "br", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt",
          "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "html",
          "legend", "li", "main", "menu", "nav", "ol", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th",
          "thead", "tr", "ul"}
#: Containers kept on the stack (the others are too often left open).
CONTAINERS = {"address", "article", "aside", "blockquote", "details", "dialog", "div", "dl", "fieldset", "figure", "footer", "form",
              "header", "main", "menu", "nav", "ol", "section", "table", "ul"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
FURNITURE_TAGS = {"nav", "aside", "footer", "form", "menu", "dialog", "fieldset"}
FURNITURE_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "alertdialog", "menu",
                   "menubar", "toolbar"}
FURNITURE_NAMES = {"ad", "ads", "adv", "advert", "adverts", "advertisement", "advertising", "alert", "banner", "breadcrumb",
                   "breadcrumbs", "comment", "comments", "consent", "cookie", "cookies", "copyright", "disclaimer", "disqus",
                   "footer", "gdpr", "login", "masthead", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice",
                   "notices", "notification", "pager", "pagination", "popup", "promo", "promotion", "recommendations",
                   "recommended", "related", "replies", "reply", "search", "share", "sharing", "sidebar", "signup", "skip",
                   "social", "sponsor", "sponsored", "subscribe", "toolbar", "widget"}
FURNITURE_PREFIXES = ("advert", "adsby", "breadcrumb", "comment", "cookie", "newsletter", "promo", "sidebar", "sponsor", "subscri")
#: Of those, names of parts that may hold article elements of their own; the others say nothing about an article or main element.
SECOND_NAMES = {"ad", "ads", "adv", "related", "recommended", "recommendations", "replies", "reply", "disqus"}
SECOND_PREFIXES = ("advert", "adsby", "comment", "promo", "sponsor")
#: First parts of class names that tell a layout or a topic, not what the element is.
MODIFIERS = {"has", "with", "without", "no", "not", "is", "category", "cat", "tag", "type", "format", "status", "layout"}
#: A named container with this share of the page's unlinked words, and this many paragraphs of so many words, is no furniture.
MOST, PARAGRAPHS, PARAGRAPH_WORDS = 0.5, 3, 12
HEADER_NAMES = {"header", "topbar", "branding"}
ARTICLE_NAMES = {"article", "post", "entry", "story", "hentry", "maintext"}

# -- end of fixed values ------------------------------------------------------------------------------

_MARKUP = re.compile(
    r"""<!--.*?(?:-->|\Z)                                              # comment, perhaps cut off
      | <[!?][^>]*(?:>|\Z)                                             # doctype, processing instruction
      | <(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>"']++|"[^"]*+"|'[^']*+')*+)>
      | <(?P<close2>/?)(?P<tag2>[a-zA-Z][^\s/>]*)(?P<attrs2>[^>]*+)(?:>|\Z)   # unbalanced quotes
    """, re.S | re.X)
_ATTR = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_NAME = re.compile(r"[a-z0-9]+")
#: Thai to Burmese, Khmer, kana, Han: letters of scripts written without spaces between words.
_UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff]")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


def count_words(text: str) -> int:
    """Words between spaces; each letter of a script without spaces is one."""
    if text.isascii():
        return len(text.split())
    rest, letters = _UNSPACED.subn(" ", text)
    return letters + len(rest.split())


def _place(tag: str, attrs: str, in_article: bool) -> tuple[bool, bool, str]:
    """(opens an article container, is boilerplate, "" or how its name hints at boilerplate: "weak", "second")."""
    got = {}
    if attrs:
        for m in _ATTR.finditer(attrs):
            got.setdefault(m[1].lower(), m[2] or m[3] or m[4] or "")
    parts = [_NAME.findall(_CAMEL.sub(" ", x).lower()) for x in (got.get("class", "") + " " + got.get("id", "")).split()]
    parts = [x for x in parts if x and not (len(x) > 1 and x[0] in MODIFIERS)]
    names = {y for x in parts for y in x}
    role = got.get("role", "").lower()
    explicit = tag in ("article", "main") or role in ("main", "article")
    article = explicit or bool(names & ARTICLE_NAMES)
    bad = tag in FURNITURE_TAGS - {"form"} or role in FURNITURE_ROLES
    if not in_article and not article:
        bad = bad or tag == "header"
    bad = bad or "hidden" in got or got.get("aria-hidden", "").lower() == "true" or "display:none" in got.get("style", "").replace(" ", "").lower()
    if explicit:
        # only what the element is called, not words inside the name
        second = tag != "main" and role != "main" and any(x[0] in SECOND_NAMES or x[0].startswith(SECOND_PREFIXES) for x in parts)
        return article, bad, "second" if second else ""
    if any(x in SECOND_NAMES or x.startswith(SECOND_PREFIXES) for x in names):
        return article, bad, "second"
    weak = tag == "form" or bool(names & FURNITURE_NAMES) or any(x.startswith(FURNITURE_PREFIXES) for x in names)
    weak = weak or not in_article and not article and bool(names & HEADER_NAMES)
    return article, bad, "weak" if weak else ""


class Hints:
    """Name hints of a page's containers, each with the hint around it: (index of the outer one or -1, "weak" or "second")."""

    def __init__(self) -> None:
        self.outer: list[int] = []
        self.kind: list[str] = []

    def add(self, around: int, kind: str) -> int:
        self.outer.append(around)
        self.kind.append(kind)
        return len(self.kind) - 1

    def counted(self, test) -> list[int]:
        """Per hint, how many of it and those around it pass; one pass, as outer ones come first. The last entry, 0, is for -1."""
        out = [0] * (len(self.kind) + 1)
        for k, around in enumerate(self.outer):
            out[k] = out[around] + bool(test(k))
        return out

    def free(self, k: int, out: set[int]) -> None:
        """Add a hint and those around it; whoever is in has all around it in."""
        while k >= 0 and k not in out:
            out.add(k)
            k = self.outer[k]


def excused(hints: Hints, found: list[tuple], holders: list[tuple[bool, int]]) -> set[int]:
    """Numbers of the name hints that do not count, in time linear in hints and blocks.

    ``found``: blocks (text, words, words in links, in article, boilerplate, innermost hint);
    ``holders``: of each article or main element outside boilerplate, (is main, innermost hint).
    """
    out: set[int] = set()
    for main, k in holders:
        if main:
            hints.free(k, out)
    left = hints.counted(lambda k: k not in out)
    strong = hints.counted(lambda k: k not in out and hints.kind[k] != "weak")
    if holders and all(left[k] for _, k in holders):   # no article free of hints: those around the least hidden ones go
        open_ = [k for _, k in holders if not strong[k]]
        least = min((left[k] for k in open_), default=0)
        for k in open_:
            if left[k] == least:
                hints.free(k, out)
    total = sum(b[1] - b[2] for b in found)
    second = hints.counted(lambda k: hints.kind[k] == "second")
    text, paragraphs = [0] * len(left), [0] * len(left)
    for b in found:
        if not b[4] and not second[b[5]]:
            text[b[5]] += b[1] - b[2]
            paragraphs[b[5]] += b[1] >= PARAGRAPH_WORDS and 2 * b[2] < b[1]
    most = set()
    for k in range(len(hints.kind) - 1, -1, -1):       # inner ones first: what they hold, the outer ones hold too
        if hints.kind[k] == "weak" and text[k] > MOST * total and paragraphs[k] >= PARAGRAPHS:
            most.add(k)
        if hints.outer[k] >= 0:
            text[hints.outer[k]] += text[k]
            paragraphs[hints.outer[k]] += paragraphs[k]
    return out | most


def blocks(page: str) -> list[tuple[str, int, int, bool, bool]]:
    """Flat blocks in page order: (text, words, words in links, in article, named as boilerplate)."""
    out: list[tuple[str, int, int, bool, bool, int]] = []
    hints = Hints()
    holders: list[tuple[bool, int]] = []
    parts: list[str] = []
    linked: list[str] = []
    stack: list[tuple[str, bool, bool, int]] = []      # (tag, in article, boilerplate, innermost hint), inherited downwards
    open_tags: Counter[str] = Counter()
    links = 0
    skip = ""                                          # the dropped element we are in, and how deep
    depth = 0

    def flush() -> None:
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                article, bad, named = stack[-1][1:] if stack else (False, False, -1)
                out.append((text, count_words(text), count_words("".join(linked)), article, bad, named))
            parts.clear()
            linked.clear()

    def enter(tag: str, article: bool, bad: bool, named: int, hint: str) -> None:
        stack.append((tag, article, bad, hints.add(named, hint) if hint else named))
        open_tags[tag] += 1

    def add(text: str) -> None:
        if text and not skip:
            text = entities.unescape(text)
            parts.append(text)
            linked.append(text if links else " ")

    at = 0
    while True:
        m = _MARKUP.search(page, at)
        if m is None:
            add(page[at:])
            break
        add(page[at:m.start()])
        at = m.end()
        tag = (m["tag"] or m["tag2"] or "").lower()
        if not tag:
            continue
        attrs, closing = m["attrs"] or m["attrs2"] or "", bool(m["close"] or m["close2"])
        if skip == "select" and not closing and tag in ENDS_SELECT:
            skip, depth = "", 0
        if skip:
            if tag == skip:
                depth += -1 if closing else 1
                if depth == 0:
                    skip = ""
            elif tag in RAW and not closing:
                at = _past_raw(page, at, tag)
            continue
        if tag in RAW and not closing:
            at = _past_raw(page, at, tag)
            continue
        if tag in DROPPED:
            if not closing and not attrs.endswith("/"):
                skip, depth = tag, 1
            continue
        if tag == "a":
            links = 0 if closing else 1
            continue
        if tag in BLOCKS:
            flush()
            links = 0 if tag not in ("br", "p") else links
            if tag in CONTAINERS:
                if closing:
                    while open_tags[tag]:
                        last = stack.pop()[0]
                        open_tags[last] -= 1
                        if last == tag:
                            break
                elif not attrs.endswith("/"):
                    article, bad, named = stack[-1][1:] if stack else (False, False, -1)
                    here, furniture, hint = _place(tag, attrs, article)
                    enter(tag, article or here, bad or furniture, named, hint)
                    if here and not stack[-1][2] and (main := _explicit(tag, attrs)):
                        holders.append((main == "main", stack[-1][3]))
            elif not closing and attrs and tag not in VOID and tag not in ("html", "body"):
                _, furniture, hint = _place(tag, attrs, True)   # a named paragraph or list item is a block of its own
                if furniture or hint:
                    article, bad, named = stack[-1][1:] if stack else (False, False, -1)
                    enter(tag, article, bad or furniture, named, hint)
            elif closing and stack and stack[-1][0] == tag:
                open_tags[stack.pop()[0]] -= 1
    flush()
    free = excused(hints, out, holders) if hints.kind else set()
    counting = hints.counted(lambda k: k not in free)
    return [(*b[:4], b[4] or counting[b[5]] > 0) for b in out]


def _explicit(tag: str, attrs: str) -> str:
    """"main" or "article" if the element is one by tag or role."""
    if tag in ("article", "main"):
        return tag
    m = re.search(r"\brole\s*=\s*[\"']?(main|article)\b", attrs, re.I)
    return m[1].lower() if m else ""


def _past_raw(page: str, at: int, tag: str) -> int:
    m = re.compile(rf"</{tag}(?=[\s/>]|\Z)[^>]*>?", re.I).search(page, at)
    return m.end() if m else len(page)


def block_features(found: list[tuple[str, int, int, bool, bool]]) -> np.ndarray:
    words = np.array([b[1] for b in found], dtype=np.float64)
    density = np.array([min(1.0, b[2] / b[1]) for b in found])
    before, after = lambda x: np.append(0.0, x[:-1]), lambda x: np.append(x[1:], 0.0)
    return np.stack([words, density, before(words), before(density), after(words), after(density),
                     np.array([float(b[3]) for b in found]), np.array([float(b[4]) for b in found]),
                     np.full(len(found), float(any(b[3] and not b[4] for b in found)))], axis=1)


def labelled_blocks() -> list[tuple]:
    """The labelled table: kinds of blocks, each set between every pair of typical neighbours.

    Rows are words, link density, words before, link density before, words
    after, link density after, in an article container, named as boilerplate,
    on a page with an article container; label 1 is main text.
    """
    nothing, word, link, line, short, paragraph = (0, 0.0), (1, 0.0), (3, 1.0), (5, 0.0), (12, 0.0), (45, 0.0)
    rows = []
    for before in (nothing, word, link, line, short, paragraph):
        for after in (nothing, word, link, line, short, paragraph):
            near = (*before, *after)
            # in an article: headings, short lines, list items and paragraphs are text; a link is text unless among links
            between_links = before == after == link
            rows += [(w, d, *near, 1, 0, 1, 1) for w, d in ((1, 0.0), (5, 0.0), (30, 0.1), (90, 0.2))]
            rows += [(3, 1.0, *near, 1, 0, 1, int(not between_links))]
            for has in (0, 1):
                # elsewhere: paragraphs are text, links never; lines beside a long paragraph, and on a page
                # without an article container beside any paragraph or away from links
                beside = paragraph in (before, after) or not has and (short in (before, after) or link not in (before, after))
                rows += [(12, 0.1, *near, 0, 0, has, 1), (90, 0.0, *near, 0, 0, has, 1)]
                rows += [(w, 0.0, *near, 0, 0, has, int(beside)) for w in (1, 5)]
                rows += [(2, 1.0, *near, 0, 0, has, 0), (15, 0.8, *near, 0, 0, has, 0)]
                # named as boilerplate: never, whatever its shape and place
                rows += [(w, d, *near, article, 1, has, 0) for w, d in ((1, 0.0), (4, 1.0), (50, 0.0)) for article in range(has + 1)]
    return rows


class Tree:
    """A binary decision tree by Gini impurity; thresholds lie halfway between neighbouring values."""

    def __init__(self, x: np.ndarray, y: np.ndarray, least: int = 1, depth: int = 16):
        self.label = bool(y.mean() >= 0.5)
        self.feature = -1
        if depth == 0 or len(np.unique(y)) == 1:
            return
        best = (y.var() * len(y) - 1e-9, -1, 0.0)
        for f in range(x.shape[1]):
            values = np.unique(x[:, f])
            for t in (values[1:] + values[:-1]) / 2:
                low = x[:, f] <= t
                a, b = y[low], y[~low]
                if min(len(a), len(b)) >= least:
                    best = min(best, (a.var() * len(a) + b.var() * len(b), f, t))
        if best[1] >= 0:
            _, self.feature, self.at = best
            low = x[:, self.feature] <= self.at
            self.low, self.high = Tree(x[low], y[low], least, depth - 1), Tree(x[~low], y[~low], least, depth - 1)

    def predict(self, x: np.ndarray) -> np.ndarray:
        if self.feature < 0:
            return np.full(len(x), self.label)
        low = x[:, self.feature] <= self.at
        out = np.empty(len(x), dtype=bool)
        out[low], out[~low] = self.low.predict(x[low]), self.high.predict(x[~low])
        return out


def train() -> Tree:
    t = np.array(labelled_blocks(), dtype=np.float64)
    return Tree(t[:, :-1], t[:, -1])


def main_text(page: str | None, tree: Tree) -> str:
    found = blocks(page) if page else []
    if not found:
        return ""
    keep = tree.predict(block_features(found))
    return " ".join(b[0] for b, k in zip(found, keep) if k)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every row."""
    tree = train()
    ids = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).cast("string").alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                texts = [main_text(h.as_py(), tree) for h in part.column(2)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    names=["page_id", "url", "text", "n_chars"])

    kinds = dict(ids.dtypes)
    return ids.mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
