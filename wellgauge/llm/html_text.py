"""Main text of web pages by composite text density.

A page is read into a tree of its elements. Page furniture is taken out first: what
never shows (scripts, styles, hidden parts), what its element, role, id or class says is
a menu, header, footer, sidebar, notice, advert, form or reader comment, and lists that
are nearly all links. The rest is judged by density alone:

- Every element has ``C`` characters, ``T`` elements, ``LC`` characters and ``LT``
  elements of links below it, 1 taken for none. Its composite text density is
  ``C/T * log_b(C/LC * T/LT)``, base ``b = ln(C/(C - LC) * LC + LC_body/C_body * C + e)``,
  ``e`` at least: characters per tag, less where links hold them.
- The density sum of an element is that of its children. The element of the greatest
  sum is main text; the threshold is the lowest density on its path to the body. Parts
  beside it of that density and more are searched in the same way, each giving its
  own subtree of the greatest sum, so an article in several parts is found whole.
- All that stands in the smallest element around the parts is the article, or in the
  ``article`` or ``main`` element that this one belongs to.

Text of the article is taken as the browser would show it: character references decoded,
white space inside a block one space, blocks in page order joined by one space. Nothing
in it is cut or capped. Markup need not be well formed: elements that are not closed end
where their parent does, paragraphs and list items where the next one begins.

NULL and empty pages, and pages without text, give an empty text. Invalid UTF-8 is read
with replacement characters. Repeated rows give repeated results, extra columns are left
out, and a page of any length or depth is read whole, by one task.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from wellgauge.llm.common import text_slices, texts_of

# Element names of HTML, by how they are read.
_VOID = frozenset(
    "area base basefont bgsound br col embed frame hr img input keygen link meta param source"
    " track wbr".split()
)
_RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
_BLOCKS = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt"
    " fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr"
    " html legend li listing main menu nav ol optgroup option p pre search section summary"
    " table tbody td tfoot th thead tr ul".split()
)
_NEVER_SHOWN = frozenset(
    "applet area audio base button canvas datalist embed frame frameset head iframe input link"
    " meta noembed noframes noscript object script select source style svg template textarea"
    " title track video".split()
)
_FURNITURE = frozenset("nav footer aside form dialog menu search".split())
_FURNITURE_ROLES = frozenset(
    "navigation banner contentinfo complementary search form alert alertdialog dialog menu"
    " menubar toolbar".split()
)
# Words in ids and classes that name furniture.
_FURNITURE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adslot sponsor sponsored"
    " promo promotion banner nav navbar navigation menu menubar breadcrumb breadcrumbs header"
    " masthead topbar footer foot bottombar sidebar sidebars aside rail cookie cookies consent"
    " gdpr notice notices notification alert disclaimer popup modal overlay newsletter"
    " subscribe subscription signup login comment comments commentlist disqus respond replies"
    " reply discussion share sharing social related recommended recommendations widget widgets"
    " pagination pager toolbar copyright form search skip".split()
)
_CLOSES_P = _BLOCKS - {"br", "body", "html", "head", "caption", "legend", "option", "optgroup",
                       "tbody", "td", "tfoot", "th", "thead", "tr"}
# What a start tag ends, and where looking for it stops.
_ITEM_OF = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dd": ({"dd", "dt"}, {"dl"}),
    "dt": ({"dd", "dt"}, {"dl"}),
    "tr": ({"tr", "td", "th", "caption"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"thead", "tbody", "tfoot", "caption"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "caption"}, {"table"}),
    "option": ({"option"}, {"select", "optgroup", "datalist"}),
}
_MARKUP = re.compile(
    r"<!--(?:>|->|.*?--!?>|.*\Z)"  # comment
    r"|<[!?][^>]*>?"  # declaration
    r"|</([a-zA-Z][^\s/>]*)[^>]*>?"
    r"|<([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*'|[\"'])*)>?",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_WANTED = ("class", "id", "role", "hidden", "aria-hidden", "style")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_NO_LETTER = re.compile(r"[^a-z]+")
_UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)

ROOT = 0


class Page:
    """Elements in page order: parents stand before their children. ``parts`` are texts
    and element starts in page order as ``(element, text or None)``."""

    def __init__(self, source: str):
        self.tags: list[str] = ["#page"]
        self.parents: list[int] = [-1]
        self.attributes: list[str] = [""]
        self.parts: list[tuple[int, str | None]] = []
        self._read(source)

    def _read(self, source: str) -> None:
        tags, open_, at = self.tags, [ROOT], 0
        while (found := _MARKUP.search(source, at)) is not None:
            if found.start() > at:
                self.parts.append((open_[-1], source[at : found.start()]))
            at = found.end()
            if name := found[1]:
                self._close(open_, name.lower())
            elif name := found[2]:
                name = name.lower()
                self._make_room(open_, name)
                tags.append(name)
                self.parents.append(open_[-1])
                self.attributes.append(found[3])
                self.parts.append((len(tags) - 1, None))
                if name in _RAW:
                    end = re.compile(rf"</{re.escape(name)}(?=[\s/>]|\Z)", re.I).search(source, at)
                    stop = len(source) if end is None else end.start()
                    if stop > at:
                        self.parts.append((len(tags) - 1, source[at:stop]))
                    close = source.find(">", stop)
                    at = len(source) if end is None or close < 0 else close + 1
                elif name == "plaintext":
                    self.parts.append((open_[-1], source[at:]))
                    at = len(source)
                elif name not in _VOID:
                    open_.append(len(tags) - 1)
        if at < len(source):
            self.parts.append((open_[-1], source[at:]))

    def _close(self, open_: list[int], name: str) -> None:
        """An end tag ends the nearest element of its name. One of inline text does not
        reach out of the block it stands in."""
        tags, block = self.tags, name in _BLOCKS
        for depth in range(len(open_) - 1, 0, -1):
            tag = tags[open_[depth]]
            if tag == name:
                del open_[depth:]
                return
            if not block and tag in _BLOCKS:
                return
            if name == "p" and tag in ("table", "td", "th", "caption", "button"):
                return

    def _make_room(self, open_: list[int], name: str) -> None:
        tags = self.tags
        if name in _CLOSES_P:
            for depth in range(len(open_) - 1, 0, -1):
                tag = tags[open_[depth]]
                if tag == "p":
                    del open_[depth:]
                    break
                if tag in _BLOCKS or tag == "button":
                    break
        if name in _ITEM_OF:
            ends, bounds = _ITEM_OF[name]
            for depth in range(len(open_) - 1, 0, -1):
                tag = tags[open_[depth]]
                if tag in bounds:
                    break
                if tag in ends:
                    del open_[depth:]
                    break


def _named(attributes: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for name, double, single, bare in _ATTRIBUTE.findall(attributes):
        name = name.lower()
        if name in _WANTED:
            found.setdefault(name, double or single or bare)
    return found


def _names_furniture(label: str) -> bool:
    """Whether an id or class has a word for furniture; ``with-sidebar`` and the like
    are about something else."""
    for one in label.split():
        words = [w for w in _NO_LETTER.split(_CAMEL.sub(" ", one).lower()) if w]
        for i, word in enumerate(words):
            if word in _FURNITURE_WORDS and not (
                i and words[i - 1] in ("with", "has", "no", "without", "is")
            ):
                return True
    return False


def _dropped(page: Page, sizes: Sequence[int]) -> list[bool]:
    """By element: whether it is furniture or in some."""
    tags, parents, n = page.tags, page.parents, len(page.tags)
    holds_main, in_article, holds_heading = [False] * n, [False] * n, [False] * n
    total = list(sizes)  # characters below, of what shows
    for i in range(n - 1, 0, -1):
        up = parents[i]
        holds_main[up] |= holds_main[i] or tags[i] in ("article", "main")
        holds_heading[up] |= holds_heading[i] or tags[i] in ("h1", "h2", "h3")
        total[up] += total[i]
    dropped = [False] * n
    for i in range(1, n):
        up, tag = parents[i], tags[i]
        in_article[i] = in_article[up] or tag in ("article", "main")
        if dropped[up] or tag in _NEVER_SHOWN:
            dropped[i] = True
            continue
        named = _named(page.attributes[i]) if page.attributes[i].strip(" /") else {}
        if (
            "hidden" in named
            or named.get("aria-hidden", "").lower() == "true"
            or _UNSEEN.search(named.get("style", ""))
        ):
            dropped[i] = True
            continue
        if tag in ("html", "body", "main") or holds_main[i]:
            continue  # wraps the article, whatever it is called
        if tag == "header":
            dropped[i] = not (in_article[i] and holds_heading[i])
        elif tag in _FURNITURE:
            # A form around most of a page is a wrapper.
            dropped[i] = tag != "form" or 2 * total[i] <= total[ROOT]
        elif tag in ("h1", "h2", "h3", "h4", "h5", "h6"):
            continue
        if not dropped[i] and named:
            dropped[i] = named.get("role", "").lower() in _FURNITURE_ROLES or any(
                _names_furniture(named[k]) for k in ("id", "class") if k in named
            )
    return dropped


class _Measures:
    """Characters, elements and densities of what is left of a page."""

    def __init__(self, page: Page, sizes: Sequence[int], dropped: Sequence[bool]):
        n = len(page.tags)
        parents, tags = page.parents, page.tags
        in_link = [False] * n
        self.characters = [0 if gone else s for s, gone in zip(sizes, dropped, strict=True)]
        self.elements = [0] * n
        self.link_characters, self.links = [0] * n, [0] * n
        for i in range(1, n):
            in_link[i] = in_link[parents[i]] or tags[i] == "a"
            if in_link[i]:
                self.link_characters[i] = self.characters[i]
        for i in range(n - 1, 0, -1):
            if not dropped[i]:
                up = parents[i]
                self.characters[up] += self.characters[i]
                self.elements[up] += self.elements[i] + 1
                self.link_characters[up] += self.link_characters[i]
                self.links[up] += self.links[i] + (tags[i] == "a")

    def densities(self, body: int) -> list[float]:
        share = self.link_characters[body] / max(self.characters[body], 1)
        found = []
        for c, t, lc, lt in zip(
            self.characters, self.elements, self.link_characters, self.links, strict=True
        ):
            if not c:
                found.append(0.0)
                continue
            t = max(t, 1)
            base = math.log(c / max(c - lc, 1) * lc + share * c + math.e)
            inside = max(c / max(lc, 1) * t / max(lt, 1), 1.0)
            # Bases below e would make densities of a few characters unbounded.
            found.append(c / t * math.log(inside) / max(math.log(base), 1.0))
        return found


def _article(page: Page, measures: _Measures, dropped: Sequence[bool]) -> int:
    """The element that holds the article."""
    parents, tags, n = page.parents, page.tags, len(page.tags)
    body = next((i for i in range(1, n) if tags[i] == "body" and not dropped[i]), ROOT)
    density = measures.densities(body)
    sums = [0.0] * n
    children: list[list[int]] = [[] for _ in range(n)]
    for i in range(1, n):
        if not dropped[i]:
            sums[parents[i]] += density[i]
            children[parents[i]].append(i)
    # The element of the greatest sum in each subtree, the outermost of equal ones.
    best = list(range(n))
    for i in range(n - 1, 0, -1):
        if not dropped[i]:
            up = parents[i]
            if sums[best[i]] > sums[best[up]] or (
                best[up] != up and sums[best[i]] == sums[best[up]] and best[i] < best[up]
            ):
                best[up] = best[i]
    top = best[body]
    if sums[top] <= 0:
        return body
    threshold, i = density[top], top
    while i != body and i != ROOT:
        i = parents[i]
        threshold = min(threshold, density[i])
    # Parts of at least that density, each its own subtree of the greatest sum.
    found, waiting = [], [body]
    while waiting:
        i = waiting.pop()
        if density[i] < threshold:
            continue
        part = best[i] if sums[best[i]] > 0 else i
        found.append(part)
        # What stands beside the path from here to the part is searched by itself.
        j = part
        while j != i:
            waiting.extend(c for c in children[parents[j]] if c != j)
            j = parents[j]
    around = found[0]
    depth_of = _depths(parents)
    for part in found[1:]:
        a, b = around, part
        while a != b:
            if depth_of[a] >= depth_of[b]:
                a = parents[a]
            else:
                b = parents[b]
        around = a
    # Where the best part lies in an article, the article is that one.
    home = [i for i in _path(parents, top) if tags[i] in ("article", "main")]
    if home:
        articles = [i for i in home if tags[i] == "article"]
        return articles[-1] if articles else home[-1]
    return around


def _depths(parents: Sequence[int]) -> list[int]:
    depths = [0] * len(parents)
    for i in range(1, len(parents)):
        depths[i] = depths[parents[i]] + 1
    return depths


def _path(parents: Sequence[int], i: int) -> list[int]:
    """The element and those around it, innermost first."""
    path = []
    while i >= 0:
        path.append(i)
        i = parents[i]
    return path


def _drop_link_lists(page: Page, measures: _Measures, dropped: list[bool]) -> None:
    """Lists and boxes of three links or more that hold nearly nothing else are menus,
    whatever they are called."""
    for i in range(1, len(page.tags)):
        if dropped[page.parents[i]]:
            dropped[i] = True
        elif page.tags[i] in ("ul", "ol", "dl", "div", "table", "section", "center"):
            dropped[i] = dropped[i] or (
                measures.links[i] >= 3
                and 10 * measures.link_characters[i] >= 9 * measures.characters[i]
            )


def main_text(source: str) -> str:
    """The text of the article of one page."""
    page = Page(source)
    texts = [None if t is None else html.unescape(t) for _, t in page.parts]
    sizes = [0] * len(page.tags)
    for (element, _), text in zip(page.parts, texts, strict=True):
        if text is not None:
            sizes[element] += len("".join(text.split()))
    dropped = _dropped(page, [0 if t in _NEVER_SHOWN else s
                              for t, s in zip(page.tags, sizes, strict=True)])
    _drop_link_lists(page, _Measures(page, sizes, dropped), dropped)
    article = _article(page, _Measures(page, sizes, dropped), dropped)
    inside = [False] * len(page.tags)
    inside[article] = not dropped[article]
    for i in range(article + 1, len(page.tags)):
        inside[i] = inside[page.parents[i]] and not dropped[i]
    return " ".join(" ".join(_shown(page, texts, inside)).split())


def _shown(page: Page, texts: Sequence[str | None], inside: Sequence[bool]) -> Iterator[str]:
    """Texts of blocks: a block ends where another element's block begins or goes on."""
    blocks = [ROOT] * len(page.tags)
    for i in range(1, len(page.tags)):
        blocks[i] = i if page.tags[i] in _BLOCKS else blocks[page.parents[i]]
    held: list[str] = []
    last = -1
    for (element, _), text in zip(page.parts, texts, strict=True):
        block = blocks[element]
        if block != last:
            if held:
                yield "".join(held)
                held = []
            last = block
        if text is not None and inside[element]:
            held.append(text)
    if held:
        yield "".join(held)


def extract_batches(
    batches: Iterator[pa.RecordBatch], keep: Sequence[str], html_column: str
) -> Iterator[pa.RecordBatch]:
    for batch in text_slices(batches, html_column):
        texts = [main_text(t.decode("utf-8", "replace")) for t in texts_of(batch, html_column)]
        yield pa.RecordBatch.from_arrays(
            [
                *(batch.column(i) for i in range(len(keep))),
                pa.array(texts, pa.string()),
                pa.array([len(t) for t in texts], pa.int64()),
            ],
            names=[*keep, "text", "n_chars"],
        )


def extract(
    pages: DataFrame, keep: Sequence[str] = ("page_id", "url"), html_column: str = "html"
) -> DataFrame:
    """Per row: the columns ``keep``, ``text`` and ``n_chars``, its code points. No
    shuffle."""
    schema = StructType(
        [pages.schema[name] for name in keep]
        + [StructField("text", StringType()), StructField("n_chars", LongType())]
    )
    rows = pages.select(*keep, F.col(html_column))
    return rows.mapInArrow(lambda batches: extract_batches(batches, keep, html_column), schema)
