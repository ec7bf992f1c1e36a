"""Web archives: URLs, headings, content lines. Regular expressions where they do, one Arrow function for markup."""

from __future__ import annotations

import html as references
import re
from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scriptorium.functions import profiles as P
from scriptorium.functions import text as T
from scriptorium.functions.profiles import DEVA, ScriptProfile
from scriptorium.session import ship

TAGS = ("h1", "h2", "h3", "h4", "p", "li", "blockquote", "pre")
#: Elements and classes that hold no content.
DROPPED_TAGS = ("script", "style", "noscript", "form", "header", "footer", "nav", "aside")
DROPPED_CLASSES = ("navbar", "breadcrumb", "adsbygoogle", "ad", "comments")
#: The characters that markup itself uses, as references.
MARKUP_REFERENCES = ("lt", "gt", "quot", "amp")
VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr")


def book_parts(url: Column, host: str) -> tuple[Column, Column, Column]:
    """Section, book and document number of ``host/section/book/slug[/d/docN.html]``; nulls where there are none."""
    pattern = rf"(?i)\Q{host}\E/([^/]+)/book/([^/]+)(?:/d/doc([0-9]+)\.html)?"
    part = lambda k: F.nullif(F.regexp_extract(url, pattern, k), F.lit(""))
    return part(1), part(2), part(3).cast("int")


def scan_archive(pages: DataFrame, host: str, url: str = "url") -> DataFrame:
    """Book pages alone, with ``section, book, book_doc``; an index page has a null ``book_doc``."""
    section, book, number = book_parts(F.col(url), host)
    return pages.withColumns({"section": section, "book": book, "book_doc": number}).filter(F.col("book").isNotNull())


def books(pages: DataFrame) -> DataFrame:
    return pages.groupBy("book").agg(F.count("*").alias("n_pages"), F.min_by("section", "url").alias("section"))


def manifest(pages: DataFrame, blocks: Column, include_index: bool = False) -> DataFrame:
    """``book, pages, records, skipped``: pages that give records, their records, and pages that give none.

    ``pages`` come from ``scan_archive``; ``blocks`` is the array of a page's records. An index page (null
    ``book_doc``) is skipped unless it is asked for. Books without records are not in it.
    """
    size = F.when(F.col("book_doc").isNull() & F.lit(not include_index), 0).otherwise(F.coalesce(F.size(blocks), F.lit(0)))
    return (
        pages.select("book", size.alias("n"))
        .groupBy("book")
        .agg(F.count_if(F.col("n") > 0).alias("pages"), F.sum("n").alias("records"), F.count_if(F.col("n") <= 0).alias("skipped"))
        .filter("records > 0")
    )


def search_pages(pages: DataFrame, columns: Sequence[str], query: str, slug: str, limit: int = 0) -> DataFrame:
    """Pages whose metadata holds ``query``, by slug; a limit of 0 is none."""
    found = pages.filter(F.contains(F.lower(F.concat_ws(" ", *columns)), F.lit(query.lower()))).orderBy(slug)
    return found.limit(limit) if limit else found


_MARK = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(script|style)\b.*?(?:</\1\s*>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>",
    re.DOTALL | re.IGNORECASE,
)
_CLASSES = re.compile(r"""\bclass\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.IGNORECASE)


#: What a start tag closes, and what bounds the search for it: end tags of items and paragraphs may be missing.
_CLOSES = {"li": (("li",), ("ul", "ol", "menu"))} | {
    tag: (("p",), ("div", "section", "article", "main", "li", "td", "th", "blockquote", "body"))
    for tag in ("p", "h1", "h2", "h3", "h4", "ul", "ol", "li", "blockquote", "pre", "div", "table", "section", "article")
    if tag != "li"
}


def _decoder(names: Sequence[str] | None) -> Callable[[str], str]:
    """Decodes the references of these names where a semicolon ends them; all of HTML, as browsers do, for None."""
    if names is None:
        return references.unescape
    known = re.compile(f"&(?:{'|'.join(map(re.escape, names))});")
    return lambda raw: known.sub(lambda found: references.unescape(found[0]), raw)


def _tag_texts(page: str | None, decode: Callable[[str], str] = references.unescape) -> list[dict[str, str]]:
    """Texts of the content tags in document order; nested ones repeat, as each tag gives its whole text.

    An item or paragraph whose end tag is missing ends where the next one begins.
    """
    found: list[list] = []  # tag, its first piece of text, the piece behind its last one
    pieces: list[str] = []
    opened: list[tuple] = []  # tag, whether it drops, its place in ``found``
    places: dict[str, list[int]] = {}  # of each tag's open elements in ``opened``
    dropped, at, page = 0, 0, page or ""

    def say(raw: str) -> None:
        text = decode(raw).strip() if not dropped else ""
        if text:
            pieces.append(text)

    def nearest(tags: Sequence[str]) -> int:
        return max((places[t][-1] for t in tags if places.get(t)), default=-1)

    def cut(k: int) -> None:
        nonlocal dropped
        while len(opened) > k:
            name, drops, own = opened.pop()
            places[name].pop()
            dropped -= drops
            if own is not None:
                found[own][2] = len(pieces)

    for mark in _MARK.finditer(page):
        if mark.start() > at:
            say(page[at : mark.start()])
        at = mark.end()
        if not mark[3]:
            continue
        tag = mark[3].lower()
        if mark[2]:
            if (k := nearest((tag,))) >= 0:
                cut(k)
        elif tag not in VOID:
            if tag in _CLOSES:
                ends, bounds = _CLOSES[tag]
                if (k := nearest(ends)) > nearest(bounds):
                    cut(k)
            classes = _CLASSES.search(mark[4] or "")
            names = " ".join(filter(None, classes.groups())).split() if classes else ()
            drops = tag in DROPPED_TAGS or not set(names).isdisjoint(DROPPED_CLASSES)
            dropped += drops
            own = None
            if tag in TAGS and not dropped:
                own = len(found)
                found.append([tag, len(pieces), len(pieces)])
            places.setdefault(tag, []).append(len(opened))
            opened.append((tag, drops, own))
    say(page[at:])
    cut(0)
    return [{"tag": tag, "text": re.sub(r"\s+", " ", " ".join(pieces[a:b])).strip()} for tag, a, b in found]


def tag_texts(html: Column, names: Sequence[str] | None = None) -> Column:
    """``array<struct<tag, text>>`` of headings, paragraphs, items, quotes and preformatted texts outside of boilerplate.

    Character references are decoded as browsers do, also where their semicolon is missing; with ``names``, these
    references alone, and only with their semicolon: what a cut in an escaped text leaves of one stays as it is.
    """

    ship()
    decode = _decoder(names)

    @F.pandas_udf("array<struct<tag: string, text: string>>")
    def run(pages: pd.Series) -> pd.Series:
        return pages.map(lambda page: _tag_texts(page, decode))

    return run(html)


def content_lines(html: Column, title: Column, profile: ScriptProfile = DEVA, names: Sequence[str] | None = None) -> Column:
    """An array of lines from the first ``h1`` up to a comments heading, without navigation; headings begin with ``# ``.

    A page without lines gives its title. ``names`` are the references to decode, see ``tag_texts``.
    """
    fallback = F.when(F.coalesce(title, F.lit("")) != "", F.array(F.concat(F.lit("# "), title))).otherwise(F.array().cast("array<string>"))

    def from_first(texts: Column) -> Column:
        first = F.greatest(F.array_position(F.transform(texts, lambda x: x.tag), "h1"), F.lit(1)).cast("int")
        return F.slice(texts, first, F.greatest(F.size(texts), F.lit(1)))

    def up_to_comments(texts: Column) -> Column:
        at = F.array_position(F.transform(texts, lambda x: F.lower(x.text).isin(*P.COMMENT_HEADINGS)), True).cast("int")
        return T.let(at, lambda at: F.when(at > 0, F.slice(texts, 1, F.greatest(at - 1, F.lit(0)))).otherwise(texts))

    def lines(texts: Column) -> Column:
        return F.transform(
            F.filter(texts, lambda x: ~T.is_navigation(x.text, profile)),
            lambda x: F.when(x.tag.isin("h1", "h2", "h3", "h4"), F.concat(F.lit("# "), x.text)).otherwise(x.text),
        )

    texts = F.filter(tag_texts(html, names), lambda x: x.text != "")
    found = T.let(T.let(T.let(texts, from_first), up_to_comments), lines)
    return T.let(found, lambda found: F.when(F.size(found) > 0, found).otherwise(fallback))


def plain_lines(text: Column, boilerplate: Sequence[str]) -> Column:
    """A plain text's lines without those that are boilerplate."""
    return F.filter(F.split(text, "\n", -1), lambda x: ~F.lower(T.strip(x)).isin(*boilerplate))


def headings(html: Column, tag: str = "h1") -> Column:
    """The texts of one heading tag, by regular expression, without inner markup."""
    found = F.regexp_extract_all(html, F.lit(f"<{tag}>(.*?)</{tag}>"), 1)
    return F.transform(found, lambda h: F.regexp_replace(h, "<[^>]*>", ""))
