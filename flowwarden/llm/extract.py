"""Main text of web pages by line-block distribution.

Markup is stripped to lines, one per block element. Lines of elements that are no part of an article (menus, page headers, footers, sidebars, notices,
adverts, forms, reader comments, by element, role or the words of class and id) stay as empty lines, so they leave holes. Where a page marks its
article (``article``, ``main``, ``itemprop=articleBody``, or else a class or id such as ``post-content``), the lines outside are
empty as well. Text lengths are then summed over windows of ``WINDOW`` lines: a surge is a line at which the sums leave zero and reach ``SURGE`` characters, a dive the
line at which they are back at zero, and the lines between a surge and its dive are kept. On a page that marks its article every line counts in full and
any sum above zero is a surge, so short articles and short last paragraphs stay. On other pages text inside links doesn't count, a line that is
mostly links is empty, and where no sum reaches ``SURGE`` the highest decides.

A page is handled by itself in one task, so nothing is shuffled, and a lost task only repeats its own pages. Tokens, elements and windows
take time in proportion to the page; a page is in memory a few times.

Defined results: null and empty html give an empty text; character references are decoded once, as in HTML 5; white space (also no-break spaces) inside a
block becomes one space, ``br`` is white space; blocks are joined by one newline; unclosed tags, quotes and comments are closed as
browsers do; text outside all tags is a block; repeated rows stay; an empty table gives no rows; the key columns are passed on, other columns are ignored,
whatever their names.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 3
SURGE = 80

# Element names of HTML, and the words by which pages name what is no part of an article.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("iframe noembed noframes script style textarea title xmp".split())
INLINE = set(
    "a abbr acronym applet audio b bdi bdo big button canvas cite code data del dfn em font i iframe img ins kbd label map mark math noembed noscript object"
    " picture q rb rp rt ruby s samp script select small span strike strong style sub sup svg template textarea time title tt u var video wbr".split()
)
DROPPED = set(
    "applet aside audio button canvas datalist dialog footer form frameset head map math menu nav noscript object optgroup option"
    " select svg template video".split()
)
DROPPED_ROLES = set("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search status toolbar".split())
NOISE = set(
    "ad ads adbox adsense adslot advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus"
    " footer gdpr header login masthead menu modal nav navbar navigation newsletter notice notices notification pager pagination paywall popup promo"
    " promoted promotion recommended related reply replies respond search share sharing sidebar signup skip social sponsor sponsored subscribe"
    " subscription toolbar widget widgets".split()
)
ARTICLE_NAMES = set(
    "article article-body articlebody article-content article-text content content-body entry entry-content main main-content maincontent main-text"
    " page-content post post-body post-content post-text story story-body".split()
)

_OPENING = re.compile(r"<[a-zA-Z/!?]")  # any other "<" is text
_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_TAG_END = re.compile(r"""[^>"']*(?:(?:"[^"]*"|'[^']*')[^>"']*)*>""")
_ATTRIBUTE = re.compile(r"""(?<![\w-])(class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in RAW}
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")

TEXT, START, STOP = 0, 1, 2


def tokens(page: str) -> Iterator[tuple[int, str, str]]:
    """(kind, text or name, source of the tag) in order; comments, declarations and the inside of scripts and styles are left out."""
    at, size, quotes = 0, len(page), True
    while at < size:
        opening = _OPENING.search(page, at)
        lt = opening.start() if opening else size
        if lt > at:
            yield TEXT, page[at:lt], ""
        if not opening:
            return
        follow = page[lt + 1]
        if follow in "!?":
            comment = page.startswith("<!--", lt)
            end = page.find("-->", lt + 2) if comment else page.find(">", lt)
            at = size if end < 0 else end + (3 if comment else 1)
            continue
        name = _NAME.match(page, lt + (2 if follow == "/" else 1))
        if not name:  # "</" before anything but a letter
            end = page.find(">", lt)
            at = size if end < 0 else end + 1
            continue
        found = _TAG_END.match(page, name.end()) if quotes else None
        if found:
            end = found.end()
        else:  # an open quote: this tag and those behind it end at the next bracket
            quotes, end = False, page.find(">", name.end()) + 1
            if not end:
                return
        lower = name[0].lower()
        yield (STOP if follow == "/" else START), lower, page[name.end() : end]
        at = end
        if follow != "/" and lower in RAW:
            close = _RAW_END[lower].search(page, at)
            at = close.start() if close else size


def _names(source: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(source)} if "=" in source else {}


def is_noise(names: dict[str, str]) -> bool:
    """Whether role, class or id name a part that is not the article."""
    if names.get("role", "").lower() in DROPPED_ROLES:
        return True
    for value in (names.get("class", ""), names.get("id", "")):
        for one in value.split():
            words = re.split(r"[-_:]+", _CAMEL.sub("-", one).lower())
            # "has-sidebar" and "no-comments" describe a frame, not the part itself.
            if words[0] not in ("has", "no", "with", "without", "is", "js") and (words[0] in NOISE or words[-1] in NOISE):
                return True
    return False


def is_article(names: dict[str, str]) -> bool:
    return any(one.lower().replace("_", "-") in ARTICLE_NAMES for key in ("class", "id") for one in names.get(key, "").split())


@dataclass(slots=True)
class State:
    """What is known of the place where a block stands."""

    dropped: bool = False
    hidden: bool = False  # inside a line, so the line goes on behind it
    article: bool = False
    main: bool = False
    named: bool = False  # by a class or id that sounds like an article
    heading: bool = False


@dataclass(slots=True)
class Line:
    text: str
    linked: int  # characters inside links, before white space is turned
    state: State


def _layout(parts: list[tuple[int, str, str]]) -> tuple[set[int], set[int]]:
    """Start tags that are closed later, and those around the first ``article`` or ``main``."""
    stack: list[int] = []
    opened: Counter[str] = Counter()
    closed: set[int] = set()
    frames: set[int] = set()
    for i, (kind, name, _) in enumerate(parts):
        if kind == TEXT or name in VOID or name in ("p", "li"):
            continue
        if kind == START:
            if name in ("article", "main") and not frames:
                frames = {*stack, i}
            stack.append(i)
            opened[name] += 1
        elif opened[name]:
            while True:
                top = stack.pop()
                opened[parts[top][1]] -= 1
                if parts[top][1] == name:
                    closed.add(top)
                    break
    return closed, frames


def lines_of(page: str) -> list[Line]:
    """All blocks that hold text, in page order."""
    parts = list(tokens(page))
    closed, frames = _layout(parts)
    out: list[Line] = []
    pieces: list[str] = []
    linked, in_link = 0, False
    stack: list[tuple[str, State, bool]] = []  # name, state outside, whether the element is one left out and never closed
    opened: Counter[str] = Counter()
    endless = 0
    state = State()

    def flush() -> None:
        nonlocal linked
        if pieces:
            text = " ".join(unescape("".join(pieces)).split())
            if text:
                out.append(Line(text, linked, state))
            pieces.clear()
        linked = 0

    def leave(names: tuple[str, ...]) -> None:
        """Close elements up to the innermost of these names."""
        nonlocal state, endless
        while True:
            name, state, open_end = stack.pop()
            opened[name] -= 1
            endless -= open_end
            if name in names:
                return

    for i, (kind, name, source) in enumerate(parts):
        if kind == TEXT:
            if not state.hidden:
                pieces.append(name)
                linked += len(name) if in_link else 0
            continue
        inline = name in INLINE
        if name == "a":
            in_link = kind == START
        if name == "br":
            pieces.append(" ")
        elif not inline:
            flush()
        if kind == STOP:
            if opened[name]:
                leave((name,))
            continue
        if name in VOID:
            continue
        if not inline:
            if opened["p"] and all(n in INLINE for n in _above(stack, "p")):
                leave(("p",))
            if name == "li" and opened["li"] and all(n in INLINE for n in _above(stack, "li")):
                leave(("li",))
        if endless and name in ("article", "main", "h1"):
            # A part that is left out and that the page forgot to close ends where the article begins.
            while endless:
                leave((next(n for n, _, open_end in reversed(stack) if open_end),))
        names = _names(source)
        inside = state.article or state.named
        leaves = name in DROPPED or name in RAW or (name == "header" and not inside) or (name == "article" and state.article)
        if not leaves and i not in frames and name not in ("html", "body"):
            leaves = is_noise(names) and not (name == "header" and inside)
        open_end = leaves and i not in closed and name not in ("p", "li")
        endless += open_end
        stack.append((name, state, open_end))
        opened[name] += 1
        state = State(
            state.dropped or leaves and not inline,
            state.hidden or leaves and inline,
            state.article or name == "article" or names.get("itemprop", "").lower() == "articlebody",
            state.main or name == "main" or names.get("role", "").lower() == "main",
            state.named or is_article(names),
            name in ("h1", "h2"),
        )
    flush()
    return out


def _above(stack: list[tuple[str, State, bool]], name: str) -> Iterator[str]:
    """Names of the open elements above the innermost of this name, from the top; the first block element ends the search."""
    for n, *_ in reversed(stack):
        if n == name:
            return
        yield n
        if n not in INLINE:
            return


def weights(lines: list[Line]) -> tuple[list[int], bool]:
    """The characters by which every line counts, and whether the page marks its article."""
    kept = [not line.state.dropped for line in lines]
    for mark in ("article", "main", "named"):
        marked = [k and getattr(line.state, mark) for k, line in zip(kept, lines)]
        if any(marked):
            if mark == "article":  # a title may stand in the frame before it
                first = marked.index(True)
                for i, line in enumerate(lines[:first]):
                    marked[i] = kept[i] and line.state.heading and (line.state.main or line.state.named)
            return [len(line.text) if m else 0 for m, line in zip(marked, lines)], True
    return [
        max(0, len(line.text) - line.linked) if k and 2 * line.linked <= len(line.text) else 0 for k, line in zip(kept, lines)
    ], False


def surges(counts: list[int], marked: bool) -> list[tuple[int, int]]:
    """Ranges of lines between a surge point and its dive point."""
    sums, running = [], 0  # of the window that begins at a line
    for i in range(len(counts) - 1, -1, -1):
        running += counts[i] - (counts[i + WINDOW] if i + WINDOW < len(counts) else 0)
        sums.append(running)
    sums.reverse()
    enough = 1 if marked else min(SURGE, max(sums, default=0)) or 1
    out, at = [], 0
    while at < len(counts):
        if not counts[at]:
            at += 1
            continue
        end, high = at, 0
        while end < len(counts) and sums[end]:  # a hole as long as a window is a dive
            high = max(high, sums[end])
            end += 1
        if high >= enough:
            out.append((at, end))
        at = end
    return out


def main_text(page: str | None) -> str:
    lines = lines_of(page or "")
    counts, marked = weights(lines)
    kept: list[str] = []
    done = 0
    for start, end in surges(counts, marked):
        while start > done and lines[start - 1].state.heading and not lines[start - 1].state.dropped:
            start -= 1  # a heading that is a link
        kept += [lines[i].text for i in range(start, end) if counts[i] or (not marked and lines[i].state.heading and not lines[i].state.dropped)]
        done = end
    return "\n".join(kept)


def _pages(batches):
    for batch in batches:
        texts = [main_text(page) for page in batch.column("html").to_pylist()]
        kept = [(n, batch.column(n)) for n in batch.schema.names if n != "html"]
        yield pa.RecordBatch.from_arrays(
            [*(c for _, c in kept), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
            [*(n for n, _ in kept), "text", "n_chars"],
        )


def extract_pages(pages: DataFrame, html_col: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The columns ``keep``, and text and n_chars (code points) of every row."""
    taken = pages.select(*(F.col(c).alias(f"k{i}") for i, c in enumerate(keep)), F.col(html_col).alias("html"))
    schema = ", ".join(f"k{i} {taken.schema[f'k{i}'].dataType.simpleString()}" for i in range(len(keep)))
    found = taken.mapInArrow(_pages, f"{schema}{', ' if keep else ''}text string, n_chars long")
    return found.select(*(F.col(f"k{i}").alias(c) for i, c in enumerate(keep)), "text", "n_chars")
