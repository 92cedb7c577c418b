"""Main-text extraction with site style trees.

The pages of a host are merged into a style tree: an element is known by the
tags and classes on the way to it. For each element of the tree two entropies
over the host's distinct pages are taken from counted rows: that of its presentation
(the sequences of child elements it shows), and that of its content (a text
found on all pages says nothing, one found on a single page all). A
branch is a template if its combined importance is low and no element with
text in it is important or too rare to judge; templates are removed from
every page, inside articles and outside. Sibling elements of one tag and class
are one element of the tree, whose texts are averaged; so a single text that
stands in such an element on nearly all pages (``SHARED``) says nothing
either and goes by itself, beside siblings that stay. Parts that are boilerplate by their
element, role or class name (menus, footers, adverts, comments and so on) are
removed in any case. A marked article is one more sign: of what stays, only
the article is taken, unless most of the text stands outside of it (as with
teasers). A page that consists of templates alone is left to names and marks.

Hosts of fewer than ``MIN_PAGES`` distinct pages have no entropy to speak of
and go by names and marks alone. Copies of a page count once in the tree.

Defined cases: null html gives an empty text; unclosed tags, comments and
quotes end where a browser would end them or at the end of the page; a null
or malformed url belongs to the host ''; repeated rows give a row each; long
pages are read whole.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ampere.llm.common import stored

#: Distinct pages that a host must have, and texts that a branch must show on
#: them, before the branch can be removed.
MIN_PAGES = 8
#: Weight of a branch's content against its presentation, and the least
#: importance that stays.
CONTENT_WEIGHT, LEAST = 0.8, 0.3
#: Share of a host's distinct pages that show a text which is removed by itself.
SHARED = 0.9
#: Removed branches broadcast at most (about 100 bytes each).
BROADCAST_BRANCHES = 200_000

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"""
                  r"""|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+>|[^>]*(?:>|\Z))""", re.S)
_NAMES = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?:[\s=/>]|$)|display\s*:\s*none|aria-hidden\s*=\s*["']?true""", re.I)
_SPACE = re.compile(r"\s+")

VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption "
                  "figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre "
                  "section summary table tbody td tfoot th thead tr ul caption".split())
#: Elements that a start tag closes if one is open.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}}
#: The elements beyond which such a closing does not reach.
SCOPE = frozenset("ul ol dl table body article section div main select".split())
DROPPED = frozenset("nav footer aside form script style noscript template iframe svg button select textarea dialog menu "
                    "head title object canvas audio video input".split())
#: Blocks of running text: an inline element inside is a part of the sentence, whatever it is called.
RUNNING = frozenset("p li dd dt td th blockquote figcaption caption pre h1 h2 h3 h4 h5 h6".split())
#: Elements nested deeper stand in the tree with the one at this depth, as browsers bound nesting, too.
MAX_DEPTH = 64
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
#: Words of class names and ids that mark boilerplate.
MARKS = frozenset("ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie "
                  "cookies consent gdpr notice notices alert sidebar menu menus nav navbar navigation breadcrumb "
                  "breadcrumbs footer header masthead comment comments reply replies respond disqus newsletter subscribe "
                  "subscription signup related recommended share sharing social popup modal overlay toolbar pagination "
                  "pager skip login search".split())
#: First words of names that mark parts of an article.
OWN = frozenset("article entry post content story main".split())


def _names(attrs: str) -> tuple[tuple[str, ...], bool]:
    """The classes in order, and whether names or roles mark boilerplate."""
    classes, marked = (), bool(_HIDDEN.search(attrs))
    for m in _NAMES.finditer(attrs):
        value = (m[2] or m[3] or m[4] or "").lower()
        if m[1].lower() == "role":
            marked |= value.strip() in ROLES
            continue
        if m[1].lower() == "class":
            classes = tuple(sorted(set(value.split())))
        for name in value.split():
            words = [w for w in re.split(r"[^a-z]+", name) if w]
            if words and words[0] in OWN:
                words = [w for w in words if w not in ("header", "banner", "content")]
            marked |= any(w in MARKS for w in words)
    return classes, marked


class Page:
    """The blocks of one page, in order, each with the elements around it."""

    def __init__(self, source: str):
        self.blocks: list[tuple[str, str, bool]] = []  # (path, text, inside the article)
        self.children: dict[str, list[str]] = {}
        self.marks_article = False
        self._stack: list[tuple[str, str, bool, bool]] = []  # tag, path, dropped, inside the article
        self._text: list[str] = []
        self._read(source)

    def _flush(self) -> None:
        if self._text:
            text = _SPACE.sub(" ", entities.unescape("".join(self._text))).strip()
            self._text = []
            if text:
                path, inside = (self._stack[-1][1], self._stack[-1][3]) if self._stack else ("", False)
                self.blocks.append((path, text, inside))

    def _close(self, depth: int) -> None:
        self._flush()
        del self._stack[depth:]

    def _open(self, tag: str, attrs: str) -> None:
        _, path, dropped, inside = self._stack[-1] if self._stack else ("", "", False, False)
        classes, marked = _names(attrs) if len(attrs) > 2 else ((), False)
        here = ".".join((tag, *classes)).replace("%", "%25").replace("/", "%2F")   # a sign of the path
        drop = tag in DROPPED or (marked and tag not in ("html", "body"))
        if inside and (tag == "header" or tag in HEADINGS):
            drop = False  # an article's own headings are its text
        elif tag == "header":
            drop = True
        elif inside and not dropped and self._stack[-1][0] == "header":
            drop = True  # bylines and the like
        if tag in ("article", "main") and not drop and not dropped:
            inside, self.marks_article = True, True
        if not dropped:
            self.children.setdefault(path, []).append(here)
        if len(self._stack) < MAX_DEPTH:
            path = f"{path}/{here}"
        self._stack.append((tag, path, dropped or drop, inside))

    def _read(self, source: str) -> None:
        at, n = 0, len(source)
        while at < n:
            lt = source.find("<", at)
            m = _TAG.match(source, lt) if lt >= 0 else None
            if lt < 0 or (m is None and lt == n - 1):
                if not self._dropped():
                    self._text.append(source[at:] if lt < 0 else source[at:lt])
                break
            if lt > at and not self._dropped():
                self._text.append(source[at:lt])
            if m is None:  # a lone sign
                if not self._dropped():
                    self._text.append("<")
                at = lt + 1
                continue
            at = m.end()
            if m[2] is None:
                continue
            tag = m[2].lower()
            if m[1]:
                self._end(tag)
                continue
            if not m[3].endswith(">"):
                break  # the page ends inside a tag
            self._start(tag, m[3])
            if tag in RAW:
                end = re.compile(rf"</{re.escape(tag)}[\s/>]", re.I).search(source, at)
                at = end.start() if end else n
        self._flush()

    def _dropped(self) -> bool:
        return bool(self._stack) and self._stack[-1][2]

    def _start(self, tag: str, attrs: str) -> None:
        if tag == "br" or tag == "wbr":
            if tag == "br" and not self._dropped():
                self._text.append(" ")
            return
        if tag in BLOCK:
            self._flush()
            self._close_open({"p"}, SCOPE)
        if tag in CLOSES:
            self._close_open(CLOSES[tag], SCOPE)
        if tag in VOID:
            return
        if tag in BLOCK or tag in DROPPED or self._dropped() or len(attrs) > 2:
            hidden = bool(_HIDDEN.search(attrs))
            if tag not in BLOCK and tag not in DROPPED and not self._dropped() and (
                    not _names(attrs)[1] or (not hidden and self._in_sentence())):
                # an inline element around text of the same block
                top = self._stack[-1] if self._stack else ("", "", False, False)
                self._stack.append((tag, top[1], False, top[3]))
                return
            self._open(tag, attrs)
        else:
            top = self._stack[-1] if self._stack else ("", "", False, False)
            self._stack.append((tag, top[1], top[2], top[3]))

    def _in_sentence(self) -> bool:
        """Whether text of a running block stands before, so that what begins here goes on with it."""
        return bool("".join(self._text).strip()) and any(t[0] in RUNNING for t in reversed(self._stack))

    def _close_open(self, tags: set[str], scope: frozenset[str]) -> None:
        for depth in range(len(self._stack) - 1, -1, -1):
            if self._stack[depth][0] in tags:
                return self._close(depth)
            if self._stack[depth][0] in scope:
                return None

    def _end(self, tag: str) -> None:
        for depth in range(len(self._stack) - 1, -1, -1):
            if self._stack[depth][0] == tag:
                if tag in BLOCK or any(t[0] in BLOCK for t in self._stack[depth + 1:]):
                    if tag not in BLOCK:
                        return  # an inline end tag doesn't close the blocks begun inside
                    self._close(depth)
                else:
                    del self._stack[depth:]
                return
        if tag in BLOCK:
            self._flush()


def _digest(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "replace"), digest_size=8).digest(), "big", signed=True)


def host_of(url: Column) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(url, "^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def page_trees(pages: DataFrame, url_col: str, html_col: str) -> DataFrame:
    """(host, tree) of every distinct page, a line for each style and each text of the page.

    Copies are reduced to one by their styles, paths and text digests, before
    branches are spelled out.
    """

    @F.pandas_udf("string")
    def tree(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for sources in batches:
            out = []
            for s in sources:
                page = Page(s or "")
                # neither paths nor digests hold white space
                lines = [f"0 {_digest(' '.join(c))} {p}" for p, c in sorted(page.children.items()) if p]
                out.append("\n".join(lines + [_text_line(path, text) for path, text, _ in page.blocks]))
            yield pd.Series(out, dtype="str")

    return pages.select(host_of(F.col(url_col)).alias("host"), tree(F.col(html_col)).alias("tree")).distinct()


def _text_line(path: str, text: str) -> str:
    return f"1 {_digest(text)} {path}"


def style_nodes(trees: DataFrame) -> DataFrame:
    """Distinct (host, path, kind, digest) of every distinct page: what the tree merges.

    Kind 0 is a style, 1 a text in the branch, 2 says that the element has
    text of its own; path '' stands for the page.
    """

    @F.pandas_udf("array<struct<path:string, kind:int, digest:bigint>>")
    def nodes(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for trees in batches:
            out = []
            for t in trees:
                found = {("", 2, 0)}
                for kind, d, path in (x.split(" ") for x in t.split("\n") if x):
                    if kind == "0":
                        found.add((path, 0, int(d)))
                        continue
                    parts = path.split("/")
                    found.update(("/".join(parts[:k]), 1, int(d)) for k in range(2, len(parts) + 1))
                    found.add((path, 2, 0))
                out.append([{"path": p, "kind": k, "digest": d} for p, k, d in found])
            yield pd.Series(out)

    return trees.select("host", F.explode(nodes("tree")).alias("x")).select("host", "x.*")


def shared_texts(trees: DataFrame) -> DataFrame:
    """(host, path) of single texts to remove, the path being the text's line of the tree (it begins with '1 ').

    A text goes if at least ``MIN_PAGES`` and ``SHARED`` of the host's distinct pages show it in the same element.
    """
    m = trees.groupBy("host").agg(F.count("*").alias("m")).filter(F.col("m") >= MIN_PAGES)
    lines = F.array_distinct(F.filter(F.split("tree", "\n"), lambda x: x.startswith("1 ")))
    counts = trees.select("host", F.explode(lines).alias("path")).groupBy("host", "path").agg(F.count("*").alias("c"))
    return (counts.filter(F.col("c") >= MIN_PAGES).join(m, "host")
            .filter(F.col("c") >= SHARED * F.col("m")).select("host", "path"))


def low_branches(nodes: DataFrame) -> DataFrame:
    """(host, path) of the branches to remove, from counted rows.

    With m distinct pages of the host and c of them showing one style or text: the
    presentation's importance is the entropy of the styles to base m; a
    text's is ``1 - log_m c``, averaged over the texts shown in the branch.
    A branch stays if an element with text in it is important, or has too few
    texts to tell.
    """
    counts = nodes.groupBy("host", "path", "kind", "digest").agg(F.count("*").alias("c"))
    by_path = stored(counts.groupBy("host", "path").agg(
        F.sum(F.when(F.col("kind") == 0, F.col("c"))).alias("shown"),
        F.sum(F.when(F.col("kind") == 0, F.col("c") * F.log("c"))).alias("style_sum"),
        F.sum(F.when(F.col("kind") == 1, F.col("c"))).alias("texts"),
        F.sum(F.when(F.col("kind") == 1, F.col("c") * F.log("c"))).alias("text_sum"),
        F.max(F.when(F.col("kind") == 2, F.col("c"))).alias("own")), "style-paths")
    m = by_path.filter("path = ''").select("host", F.col("own").alias("m")).filter(F.col("m") >= MIN_PAGES)
    p = by_path.filter("texts > 0 and path <> ''").join(m, "host").withColumn("base", F.log("m"))
    style = F.coalesce((F.log("shown") - F.col("style_sum") / F.col("shown")) / F.col("base"), F.lit(0.0))
    content = 1 - F.col("text_sum") / F.col("texts") / F.col("base")
    importance = (1 - CONTENT_WEIGHT) * style + CONTENT_WEIGHT * content
    # stored: read for the low branches and for those that must stay
    p = stored(p.select("host", "path", "own", ((F.col("texts") >= MIN_PAGES) & (importance < LEAST)).alias("is_low")),
               "style-branches")
    parts = F.split("path", "/")
    above = F.transform(F.sequence(F.lit(2), F.size(parts)), lambda k: F.array_join(F.slice(parts, 1, k), "/"))
    stay = p.filter("own > 0 and not is_low").select("host", F.explode(above).alias("path")).distinct()
    return p.filter("is_low").select("host", "path").join(stay, ["host", "path"], "left_anti")


def _in_branch(path: str, low: set[str]) -> bool:
    at = path.find("/", 1)
    while at > 0:
        if path[:at] in low:
            return True
        at = path.find("/", at + 1)
    return path in low


def main_text(source: str | None, low: set[str]) -> str:
    """The blocks that stay, in page order."""
    page = Page(source or "")
    blocks = page.blocks
    if low:
        where = {path: _in_branch(path, low) for path in {b[0] for b in blocks}}
        single = any(p.startswith("1 ") for p in low)
        blocks = [b for b in blocks if not where[b[0]] and not (single and _text_line(b[0], b[1]) in low)] or blocks
    if page.marks_article:
        inside = sum(len(t) for _, t, i in blocks if i)
        if 2 * inside >= sum(len(t) for _, t, _ in blocks):
            blocks = [b for b in blocks if b[2]]
    return "\n\n".join(t for _, t, _ in blocks)


def extract_main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """id, url, text and n_chars of every page."""
    pages = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"),
                         host_of(F.col(url_col)).alias("host"))
    trees = stored(page_trees(pages, "url", "html"), "page-trees")
    low = stored(low_branches(style_nodes(trees)).unionByName(shared_texts(trees)), "style-tree")
    few = low.limit(BROADCAST_BRANCHES + 1).count() <= BROADCAST_BRANCHES
    low = low.groupBy(F.col("host").alias("h")).agg(F.collect_list("path").alias("low"))
    rows = pages.join(F.broadcast(low) if few else low, F.col("host") == F.col("h"), "left")

    @F.pandas_udf("string")
    def text_of(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for sources, lows in batches:
            yield pd.Series([main_text(s, set(b) if b is not None else set()) for s, b in zip(sources, lows)], dtype="str")

    return (rows.select(F.col("id").alias(id_col), F.col("url").alias(url_col), text_of("html", "low").alias("text"))
            .withColumn("n_chars", F.length("text").cast("long")))
