"""HTML extraction (3): line-block distribution.

Markup is stripped into lines, one per block of the page (block-level tags
start a new line; inline tags do not), each with the length of its text outside
links. Lines of page furniture (menus, headers, footers, sidebars, notices,
adverts, forms, comments, by element, role or name) have length 0, and so have
lines that are mostly links, whatever their names: the items of a menu, a row of
tags, a list of other stories. Lengths are summed over sliding windows of
``WINDOW`` lines; a surge is where the sum leaves 0, a dive where it has gone
back to 0, and the text between them is kept: a line of links between
paragraphs stays, a list of links of ``WINDOW`` lines or more, or one before the
first or behind the last paragraph, goes. Stretches count whatever their length,
a title or a last short paragraph as much as a long one.

On pages that mark their article (``<article>``, ``<main>`` or the matching
role) only lines inside the mark have a length, and there a line of links has
one too unless ``WINDOW`` of them follow each other.

Defined results: NULL or empty pages give an empty text. Unclosed and
misnested tags are taken as browsers do as far as blocks go: a block's end
tag closes what is open inside it, a stray end tag is ignored, and the end of
the page closes all. Nothing is shortened.
"""

from __future__ import annotations

import html as html_lib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

WINDOW = 3
LINK_SHARE = 2 / 3      # a line with more of its characters in links is a line of links
# Element names by their role in a page.
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th "
    "thead tr ul".split())
RAW = frozenset("script style noscript template iframe noembed noframes xmp".split())
RAW_TEXT = frozenset("title textarea".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
FURNITURE = frozenset(
    "nav header footer aside form menu dialog button select option label fieldset svg math object applet head "
    "audio video canvas map".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
# Words in class and id names that mark furniture.
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising adbox adslot banner sponsor sponsored promo promotion "
    "nav navbar navigation menu menubar breadcrumb breadcrumbs header masthead topbar footer bottombar copyright "
    "sidebar aside widget widgets related recommended recommendations share sharing social follow "
    "cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe signup "
    "login search form comment comments commentlist disqus reply replies respond responses feedback discussion "
    "pagination pager tags toolbar hidden skip cmp onetrust".split())
# Marks that are plain words too; an id that holds no other is as likely the slug of a title.
TOPICS = frozenset(
    "advertisement advertising banner sponsor promotion navigation menu header copyright aside widget widgets related "
    "recommended recommendations share sharing social follow cookie cookies consent notice notices notification "
    "notifications alert overlay newsletter subscribe signup login search form comment reply replies respond "
    "discussion pagination tags hidden skip".split())
# Words that go with a mark in the name of a piece of furniture ("cookie-notice", "site-nav").
PARTS = frozenset(
    "site page main global user users root reader readers top bottom left right upper lower primary secondary box bar block area list item items "
    "wrapper wrap container inner outer section panel unit slot link links button buttons btn icon icons post posts "
    "article articles story stories entry content widget module group row col column sticky fixed mobile desktop "
    "div gpt dfp google js wp".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
BOXES = frozenset("div ul ol table tr td".split())
TAG = re.compile(r"<(?:!--(?:>|->|.*?(?:--!?>|\Z))|[!?][^>]*(?:>|\Z)|(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)|/[^A-Za-z>][^>]*>|/>)", re.S)
ATTRIBUTE = re.compile(r"([^\s\"'<>/=]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'=<>`]+))", re.S)
WORDS = re.compile(r"[a-z]+")
SECTION = re.compile(r"\b(?:section|level\d)\b")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I) for name in RAW | RAW_TEXT}
_HEADER_IN_ARTICLE = frozenset(("header", "hgroup"))
_ABOUT = frozenset(("has", "no", "with", "without", "is"))  # "has-sidebar" is about a part, not the part


def _marked(key: str, value: str, in_article: bool, slug: bool) -> bool:
    """Whether a class or id names furniture: the whole token has to (marks,
    alone or with ``PARTS``). Outside an article a class may hold other words
    beside a mark that is no topic or two marks; an id that may be the slug of
    a title needs the same, besides being whole."""
    for token in value.split():
        words = WORDS.findall(CAMEL.sub(" ", token).lower())
        found = MARKS.intersection(words)
        if not found or words[0] in _ABOUT or in_article and found == {"header"}:
            continue
        sure = len(found) > 1 or bool(found - TOPICS)
        whole = (MARKS | PARTS).issuperset(words)
        if whole and (sure or key == "class" or not slug) or key == "class" and sure and not in_article:
            return True
    return False


def _is_furniture(name: str, attributes: str, in_article: bool, by_name: bool) -> bool:
    if name in FURNITURE and not (in_article and name in _HEADER_IN_ARTICLE):
        return True
    if "hidden" in attributes and re.search(r"(?:^|\s)hidden(?:\s|/|=|$)", attributes):
        return True
    slug = in_article or name not in BOXES or SECTION.search(attributes) is not None
    for key, a, b, c in ATTRIBUTE.findall(attributes):
        key, value = key.lower(), a or b or c
        if key in ("class", "id"):
            # a page-wide wrapper may be named for what it holds and a heading for what it says, the rest is
            # judged by its own name
            if name not in ("html", "body", "article", "main") and (
                    key == "class" and "hidden" in value.lower().split()
                    or by_name and name not in HEADINGS and _marked(key, value, in_article, slug)):
                return True
        elif key == "role" and value.lower() in ROLES or key == "aria-hidden" and value.lower() == "true":
            return True
        elif key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return True
    return False


def lines(page: str, by_name: bool = True) -> Iterator[tuple[str, bool, bool, int]]:
    """The page's blocks in order: ``(text, furniture, in article, length outside
    links)``; a heading's links count as text. Inline furniture (a button, a
    hidden span) is left out of its line. ``by_name``: class and id names mark
    furniture too."""
    # open elements: name, furniture, article, inline furniture
    stack: list[tuple[str, bool, bool, bool]] = []
    bad = article = silent = False
    held: list[str] = []
    links: list[str] = []       # of the line's pieces, those inside links
    at = 0

    def keep(piece: str) -> None:
        held.append(piece)
        if any(x[0] == "a" for x in stack) and not any(x[0] in HEADINGS for x in stack):
            links.append(piece)

    def flush() -> tuple[str, bool, bool, int] | None:
        if not held:
            return None
        text = " ".join(html_lib.unescape("".join(held)).split())
        linked = sum(len(" ".join(html_lib.unescape(x).split())) for x in links)
        held.clear()
        links.clear()
        return (text, bad, article, max(0, len(text) - linked)) if text else None

    def leave(depth: int) -> None:
        nonlocal bad, article, silent
        del stack[depth:]
        bad = any(x[1] for x in stack)
        silent = any(x[3] for x in stack)
        article = any(x[2] for x in stack)

    while at < len(page):
        m = TAG.search(page, at)
        if m is None:
            if not silent:
                keep(page[at:])
            break
        if m.start() > at and not silent:
            keep(page[at:m.start()])
        at = m.end()
        name = m[2].lower() if m[2] else ""
        if not name:
            continue
        if m[1]:  # end tag
            depth = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == name), None)
            if depth is None:
                if name in BLOCKS and (line := flush()):
                    yield line
                continue
            if name not in BLOCKS and any(x[0] in BLOCKS for x in stack[depth + 1:]):
                # an inline element cannot close the blocks opened in it
                del stack[depth]
                leave(len(stack))
                continue
            if any(x[0] in BLOCKS for x in stack[depth:]) and (line := flush()):
                yield line
            leave(depth)
            continue
        if name in RAW or name in RAW_TEXT:
            end = _RAW_END[name].search(page, at)
            at = end.end() if end else len(page)
            held.append(" ")
            continue
        if name == "br":
            held.append(" ")
            continue
        is_bad = _is_furniture(name, m[3], article, by_name)
        if name in BLOCKS and (line := flush()):
            yield line
        if name in VOID:
            continue
        if name in BLOCKS:  # blocks end an open paragraph; items end the one before
            for top in range(len(stack) - 1, -1, -1):
                own = stack[top][0]
                if own == "p" or own == name and name in ("li", "dt", "dd", "tr", "td", "th", "option"):
                    leave(top)
                    break
                if own in BLOCKS:
                    break
        if m[3].endswith("/") and name not in BLOCKS:
            continue
        marks = name in ("article", "main") or (bool(m[3]) and bool(re.search(r"role\s*=\s*[\"']?(?:main|article)\b", m[3])))
        inline = is_bad and name not in BLOCKS
        stack.append((name, is_bad and not inline, marks and not bad, inline))
        article = article or (marks and not bad)
        bad, silent = bad or stack[-1][1], silent or inline
    if line := flush():
        yield line


def stretches(lengths: list[int], window: int = WINDOW) -> list[tuple[int, int]]:
    """``(surge, dive)`` line ranges: where the sums over ``window`` lines are
    above 0, without the empty lines at either end."""
    sums = [sum(lengths[k:k + window]) for k in range(len(lengths))]
    out, start = [], None
    for k, total in enumerate([*sums, 0]):
        if total and start is None:
            start = k
        elif not total and start is not None:
            lo, hi = start, k
            while not lengths[lo]:
                lo += 1
            while not lengths[hi - 1]:
                hi -= 1
            out.append((lo, hi))
            start = None
    return out


def main_text(page: str | None) -> str:
    """The main text of one page: blocks joined by a line break."""
    if not page:
        return ""
    # a page whose text all lies in elements named like furniture is judged by
    # its elements alone
    return _select(list(lines(page))) or _select(list(lines(page, by_name=False)))


def weights(rows: list[tuple[str, bool, bool, int]]) -> list[int]:
    """The length of each line: 0 for furniture, for what lies outside a marked
    article, and for lines of links."""
    marked = any(article and not bad for _, bad, article, _ in rows)
    out, run = [], 0
    for text, bad, article, plain in rows:
        if bad or marked and not article:
            out.append(0)
            run = 0
        elif len(text) - plain <= LINK_SHARE * len(text):
            out.append(plain)
            run = 0
        else:
            # inside a mark, a line of links is text until there are too many
            run += 1
            out.append(len(text) if marked and run < WINDOW else 0)
            if run == WINDOW:
                out[-WINDOW:] = [0] * WINDOW
    return out


def _select(rows: list[tuple[str, bool, bool, int]]) -> str:
    marked = any(article and not bad for _, bad, article, _ in rows)
    return "\n".join(rows[k][0] for a, b in stretches(weights(rows)) for k in range(a, b)
                     if not rows[k][1] and (rows[k][2] or not marked))


def extract(pages: DataFrame, html: str = "html") -> DataFrame:
    """``pages`` without ``html``, with ``text`` and ``n_chars``."""
    keep = [c for c in pages.columns if c not in (html, "text", "n_chars")]
    fields = [f for c in keep for f in pages.schema.fields if f.name == c]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x.as_py()) for x in batch.column(len(keep))]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:len(keep)], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=[*keep, "text", "n_chars"])

    return pages.select(*keep, F.col(html).alias("__html")).mapInArrow(
        run, StructType([*fields, StructField("text", StringType()), StructField("n_chars", LongType())]))


__all__ = ["lines", "weights", "stretches", "main_text", "extract", "WINDOW"]
