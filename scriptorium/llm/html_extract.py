"""Main text of HTML pages by tag-path ratios.

A page is read once into blocks, each the text between two block-level tags, with
its path of block-level tags (and first classes) from the root. Scripts, styles,
forms, hidden elements and the like hold no text.

For each path the lengths of text, of link text, and punctuation are summed up
over its blocks. Its text ratio (characters a block) and its punctuation ratio
(marks a block) are compared, by square roots, with the page's typical ones, the
medians weighted by characters; both are cut at 1, so that one long block does not
outweigh paragraphs. The two are fused, smoothed over the neighbours in page
order, the more the longer the way from the root that they share, squared, and
lowered by the path's own share of link text. What a path's elements say about
themselves is a factor:

* menus, footers, headers, sidebars, and elements whose class or role names such a
  part, an advert, a notice or reader comments, and containers whose id does: ``NAMED``;
* outside of ``article`` or ``main``, where the page has text in one: ``OUTSIDE``;
* inside of one: the fused ratio counts ``INSIDE`` at least, so that only its share
  of links can take out a path there.

Blocks of paths below ``share`` of the page's best score, or below ``FLOOR``, go. A
heading stays with the block that it stands above, and with one further down in its element
before the next heading. On a page without an article
or main element, paths of short blocks without punctuation are lost with the
menus: there the ratios are all there is.

Character references are decoded, white space becomes one space, blocks are joined
in page order by one space. Broken markup is read as browsers do in the main: end
tags may be missing, a new block closes an open paragraph. Time and memory are
proportional to the page, however deep or unbalanced its markup is.

Defined results: a null or empty page has an empty text; a page without tags is
one block; paths of equal score stay or go together; very long pages are read
whole; repeated rows are read one by one; an empty table gives an empty table;
other columns stay out, whatever their names; null ids and urls stay null.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from math import sqrt

import pyarrow as pa
from pyspark.sql import DataFrame

from scriptorium.session import prepare_batches

_OTHER = r"<!--.*?(?:--!?>|\Z)|<[!?][^>]*(?:>|\Z)|"
#: A quote opens a value behind an equals sign only.
_PLAIN = r"<(/?)([A-Za-z][^\s/>]*)([^>]*)>"
_TAG = re.compile(_OTHER + r"""<(/?)([A-Za-z][^\s/>]*)((?:[^>=]++|=\s*+(?:"[^"]*"|'[^']*')?)*+)>|""" + _PLAIN, re.DOTALL)
_PLAIN_TAG = re.compile(_OTHER + _PLAIN, re.DOTALL)
_CLASS = re.compile(r"""(?<![\w-])(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
_HIDDEN = re.compile(
    r"""(?<![\w-])hidden(?![\w-])|aria-hidden\s*=\s*["']?true|style\s*=\s*["'][^"']*(?:display\s*:\s*none|visibility\s*:\s*hidden)""",
    re.IGNORECASE,
)
_QUOTED = re.compile(r"\"[^\"]*\"|'[^']*'")
VOID = frozenset("area base br col embed frame hr img input keygen link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe xmp noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 head header hgroup html legend li main menu nav noscript ol optgroup option "
    "p pre section select summary svg table tbody td template tfoot th thead tr ul".split()
)
#: Elements whose text nobody reads on the page, or that take text in.
SILENT = frozenset(
    "button canvas dialog fieldset form head iframe legend noscript object option optgroup script select style svg "
    "template textarea title".split()
)
#: Elements that are beside the content.
BESIDE = frozenset("aside footer menu nav".split())
#: Words of a class or role that name what is beside the content.
NAMES = frozenset(
    "ad ads adbox adslot advert adverts advertisement advertising advertorial alert alerts aside banner breadcrumb "
    "breadcrumbs byline captcha comment comments complementary consent contentinfo cookie cookies copyright "
    "disclaimer discussion disqus foot footer gdpr legal login masthead menu menus modal nav navbar navigation "
    "newsletter notice notices notification overlay pager pagination paywall popup promo promoted promotion "
    "recommendations recommended related replies reply respond search share sharing shoutbox sidebar signup sitemap "
    "skip social sponsor sponsored subscribe subscription teaser teasers toolbar topbar widget widgets".split()
)
#: An id names such a part if it is one of these words, or one of these or of ``TOPICAL`` with ``FILL`` words alone;
#: words of other ids are topics (``related-work``, ``legal-issues``, ``social``).
ID_NAMES = frozenset(
    "ad ads advert adverts advertisement breadcrumb breadcrumbs comments disqus footer masthead nav navbar newsletter popup "
    "respond sidebar signup toolbar topbar widget widgets".split()
)
TOPICAL = frozenset("comment cookie cookies header menu navigation promo related share sharing social".split())
FILL = frozenset(
    "area articles banner bar bottom box buttons consent container form global left links list main notice page posts primary "
    "reader right secondary section site thread top user wrapper".split()
)
CONTAINERS = frozenset("div section ol ul".split())
ROOTS = frozenset("html body article main".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
CLOSES = {  # what a start tag closes, and what bounds the search for it
    "li": (("li",), ("ul", "ol", "menu")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr",), ("table",)),
    "td": (("td", "th"), ("table", "tr")),
    "th": (("td", "th"), ("table", "tr")),
    "option": (("option",), ("select",)),
}
_MARK = re.compile("[,.;:!?¿¡…、。，！？]")
NAMED, OUTSIDE, INSIDE, FLOOR, SHARE, NEAR = 0.1, 0.2, 0.5, 0.12, 0.25, 0.3


@dataclass(slots=True)
class Block:
    path: int
    text: str
    links: int  # characters of link text
    heading: bool


@dataclass(slots=True)
class Path:
    """A way of block-level tags from the root; its parent is another one's number."""

    parent: int
    depth: int
    inside: bool  # of an article or main element
    beside: bool  # in an element that names itself beside the content
    header: bool  # in an article's header, but in no heading


@lru_cache(4096)
def _read_attributes(attributes: str) -> tuple[str, frozenset[str], bool, bool, bool]:
    """The first class; the words of class and role; whether the id names a part beside the content; whether a role is
    given; whether the element is hidden."""
    first, words, own, role = "", set(), False, False
    for kind, *values in _CLASS.findall(attributes):
        value = "".join(values).lower()
        if kind.lower() == "id":
            parts = set(filter(None, re.split(r"[^a-z0-9]+", value)))
            rest = parts - FILL - ID_NAMES - TOPICAL
            own = not rest and (not parts.isdisjoint(ID_NAMES) or (not parts.isdisjoint(TOPICAL) and not parts.isdisjoint(FILL)))
            continue
        if kind.lower() == "role":
            role = True
        elif value.split():
            first = first or value.split()[0]
        words.update(re.split(r"[^a-z0-9]+", value))
    hidden = bool(_HIDDEN.search(attributes)) and _hides(attributes)
    return first, frozenset(words), own, role, hidden


def _hides(attributes: str) -> bool:
    """Whether what looks like a sign of hiding is one, and no part of a quoted value of something else."""
    bare = _QUOTED.sub("''", attributes)
    return bool(re.search(r"(?<![\w-])hidden(?![\w-])", bare, re.IGNORECASE)) or bool(
        re.search(r"aria-hidden\s*=\s*[\"']?true|style\s*=", attributes, re.IGNORECASE)
    )


@dataclass(slots=True)
class Open:
    """An open element; all but ``tag`` hold for what stands inside of it."""

    tag: str
    path: int
    silent: bool
    header: bool
    heading: bool
    link: bool


class Reader:
    """Reads one page into ``blocks`` and ``paths``.

    ``at`` has, for each tag, the places of its open elements on the stack, and ``in_block``
    those of block-level ones, so that nothing is ever searched from the top down.
    """

    def __init__(self, page: str):
        self.blocks: list[Block] = []
        self.paths = [Path(-1, 0, False, False, False)]
        self.known: dict[tuple, int] = {}
        self.stack = [Open("", 0, False, False, False, False)]
        self.at: dict[str, list[int]] = {}
        self.in_block: list[int] = [0]
        self.text: list[str] = []
        self.links = 0
        self.held = self.stack[0]
        self.read(page)

    def read(self, page: str) -> None:
        at, size = 0, len(page)
        last = page.rfind(">")  # no tag ends behind it, so none is looked for
        tags = _TAG
        while at < size:
            mark = tags.search(page, at) if at <= last else None
            if not mark:
                self.say(page[at:])
                break
            if mark.start() > at:
                self.say(page[at : mark.start()])
            at = mark.end()
            closing, tag, attributes = mark.groups()[:3]
            if tags is _TAG and mark[5]:  # quotes hide the end of the page: from here on they are plain characters
                closing, tag, attributes = mark.groups()[3:]
                tags = _PLAIN_TAG
            if not tag:
                continue
            tag = tag.lower()
            if closing:
                self.close(tag)
                continue
            if tag == "br" and self.text:
                self.text.append(" ")
            if tag in VOID:
                if tag in BLOCK:
                    self.flush()
            elif tag in RAW and not attributes.endswith("/"):
                if tag in BLOCK:
                    self.flush()
                end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.IGNORECASE).search(page, at, last + 1)
                at = end.end() if end else size
            else:
                self.open(tag, attributes)
        self.flush()

    def say(self, raw: str) -> None:
        top = self.stack[-1]
        if top.silent or not self.text and not raw.strip():
            return
        if not self.text:
            self.held = top
        said = html.unescape(raw) if "&" in raw else raw
        self.text.append(said)
        if top.link:
            self.links += len(said.strip())

    def flush(self) -> None:
        if self.text:
            joined, held = " ".join("".join(self.text).split()), self.held
            if joined:
                self.blocks.append(Block(held.path, joined, min(self.links, len(joined)), held.heading))
            self.text.clear()
        self.links = 0

    def cut(self, k: int) -> None:
        """Closes all elements from place ``k`` of the stack on."""
        while len(self.stack) > k:
            self.at[self.stack.pop().tag].pop()
            if self.in_block[-1] == len(self.stack):
                self.in_block.pop()

    def nearest(self, tags: tuple[str, ...]) -> int:
        return max((self.at[t][-1] for t in tags if self.at.get(t)), default=0)

    def close(self, tag: str) -> None:
        block, k = tag in BLOCK, self.nearest((tag,))
        if block:
            self.flush()
        if k and (block or k > self.in_block[-1]):
            self.cut(k)

    def open(self, tag: str, attributes: str) -> None:
        block = tag in BLOCK
        if block:
            self.flush()
            if self.stack[self.in_block[-1]].tag == "p":
                self.cut(self.in_block[-1])
        if tag in CLOSES:
            k = self.nearest(CLOSES[tag][0])
            if k > self.nearest(CLOSES[tag][1]):
                self.cut(k)
        above = self.stack[-1]
        first, words, own, role, hidden = _read_attributes(attributes) if attributes else ("", frozenset(), False, False, False)
        outer = self.paths[above.path]
        named = tag in BESIDE or (tag not in ROOTS and not NAMES.isdisjoint(words)) or (own and tag in CONTAINERS)
        header = above.header or tag == "header" or ("header" in words and tag not in ROOTS and tag not in HEADINGS)
        heading = above.heading or tag in HEADINGS
        silent = above.silent or tag in SILENT or (hidden and tag not in ROOTS) or (named and not block)
        path = above.path
        if block:
            key = (path, tag, first, named, header, role)
            if (path := self.known.get(key, -1)) < 0:
                path = self.known[key] = len(self.paths)
                inside = outer.inside or tag in ("article", "main") or (role and "main" in words)
                beside = outer.beside or named or (header and not inside)
                self.paths.append(Path(above.path, outer.depth + 1, inside, beside, header and not heading))
            self.in_block.append(len(self.stack))
        self.at.setdefault(tag, []).append(len(self.stack))
        self.stack.append(Open(tag, path, silent, header, heading, above.link or tag == "a"))


def apart(paths: list[Path], a: int, b: int) -> float:
    """The share of the longer of two ways from the root that the shorter does not have in common with it."""
    longest, n = max(paths[a].depth, paths[b].depth), 0
    while a != b:
        n += 1
        if paths[a].depth >= paths[b].depth:
            a = paths[a].parent
            if a != b and paths[b].depth > paths[a].depth:
                b = paths[b].parent
        else:
            b = paths[b].parent
    return n / max(longest, 1)


def _under(paths: list[Path], path: int, above: int) -> bool:
    """Whether one path goes through another."""
    while paths[path].depth > paths[above].depth:
        path = paths[path].parent
    return path == above


def typical(values: list[tuple[float, float]]) -> float:
    """The median of ``(value, weight)``."""
    half, total = sum(w for _, w in values) / 2, 0.0
    for value, weight in sorted(values):
        total += weight
        if total >= half:
            return value
    return 0.0


def path_scores(found: list[Block], paths: list[Path]) -> dict[int, float]:
    """The fused and smoothed score of each path that has blocks."""
    sums: dict[int, list[int]] = {}
    for b in found:
        s = sums.setdefault(b.path, [0, 0, 0, 0])
        s[0] += 1
        s[1] += len(b.text)
        s[2] += len(_MARK.findall(b.text))
        s[3] += b.links
    beside = {p: paths[p].beside or paths[p].header for p in sums}
    marked = any(paths[p].inside and not beside[p] for p in sums)
    factor = {p: NAMED if beside[p] else OUTSIDE if marked and not paths[p].inside else 1.0 for p in sums}
    weight = {p: (chars - links) * factor[p] for p, (_, chars, _, links) in sums.items()}
    length = typical([(s[1] / s[0], weight[p]) for p, s in sums.items()])
    punctuation = typical([(s[2] / s[0], weight[p]) for p, s in sums.items()])
    fused = {}
    for p, (n, chars, marks, _) in sums.items():
        text = min(1.0, sqrt(chars / n / length)) if length else 1.0
        fused[p] = text * (1 + (min(1.0, sqrt(marks / n / punctuation)) if punctuation else 1.0)) / 2
    near: dict[int, list[float]] = {}
    for one, two in zip(found, found[1:], strict=False):
        if one.path != two.path:
            common = 1 - apart(paths, one.path, two.path)
            for p, q in ((one.path, two.path), (two.path, one.path)):
                around = near.setdefault(p, [0.0, 0.0])
                around[0] += common
                around[1] += common * fused[q]
        else:
            around = near.setdefault(one.path, [0.0, 0.0])
            around[0] += 2
            around[1] += 2 * fused[one.path]
    out = {}
    for p, own in fused.items():
        weights, total = near.get(p, (0.0, 0.0))
        smooth = ((1 - NEAR) * own + NEAR * total / weights if weights else own) ** 2
        if paths[p].inside:
            smooth = max(smooth, INSIDE)
        # the share of links is the path's own: good neighbours do not make up for it
        share = sums[p][3] / sums[p][1]
        out[p] = factor[p] * smooth * (1 - share) ** (1 if paths[p].inside else 2)
    return out


def main_text(page: str | None, share: float = SHARE) -> str:
    """The main text of a whole page. ``share``: of the best score, what a path must have."""
    reader = Reader(page or "")
    found = reader.blocks
    scores = path_scores(found, reader.paths)
    least = max(FLOOR, share * max(scores.values(), default=0.0)) if share else 0.0
    kept = [scores[b.path] >= least for b in found]
    below = -1  # the path of the next kept block, up to the next heading
    for k in range(len(found) - 1, -1, -1):
        block, path = found[k], reader.paths[found[k].path]
        if block.heading and not kept[k] and not path.beside and block.links < len(block.text):
            beneath = k + 1 < len(found) and kept[k + 1]
            kept[k] = beneath or (below >= 0 and _under(reader.paths, below, path.parent))
        if block.heading or kept[k]:
            below = block.path if kept[k] and not block.heading else -1
    return " ".join(b.text for b, keep in zip(found, kept, strict=True) if keep)


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every row of ``pages``."""
    prepare_batches(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h) for h in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    return pages.select(pages["page_id"].cast("long"), "url", "html").mapInArrow(
        run, "page_id long, url string, text string, n_chars long"
    )
