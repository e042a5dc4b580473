"""Main text of web pages by the line-block distribution of their text."""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from lakeloom.llm.text import blocks

#: Lines of a sliding window, and the characters it must hold where text surges; inside article
#: or main fewer are enough.
WINDOW = 3
SURGE = 86
STORY_SURGE = 30
#: An element named like boilerplate is a wrapper if it holds a surge of running text and the text
#: beside it is at most this share of its own.
BESIDE = 0.1

# Element names of HTML by their role here, and words of class, id and role
# attributes that name boilerplate.
RAW = frozenset("script style template noscript iframe object svg textarea select title noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
LINES = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
OUTSIDE = frozenset("head nav footer aside button dialog menu label".split())
DOUBTED = frozenset(("form", "fieldset"))
STORY = frozenset(("article", "main"))
HOMES = STORY | frozenset("html body div section center td".split())
OUTSIDE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
OUTSIDE_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising adbox adsense banner sponsor sponsored promo promotion sidebar sidebars "
    "menu nav navbar navigation breadcrumb breadcrumbs footer header masthead topbar comment comments commentlist disqus "
    "respond reply replies cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter "
    "subscribe subscription signup login share sharing social related recommended recommendations widget widgets toolbar "
    "pagination pager skip copyright legal rail sidenav submenu topnav trending popular search searchbox tagcloud "
    "taglist".split())

# where markup may begin, and a tag's attributes with its end.  A quoted value may hold anything and
# have any length; a quote that is never closed counts as any other character
_OPEN = re.compile(r"<(?:(!--)|[!?]|(/?)([a-zA-Z][a-zA-Z0-9:-]*))")
_REST = re.compile(r"""((?:[^>=]++|=(?:\s*+(?:"[^"]*+"|'[^']*+'))?+)*+)>""")
_ATTRIBUTE = re.compile(r"""([a-zA-Z_:-]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_NAME_PARTS = re.compile(r"[a-z0-9]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


@dataclass
class Tag:
    """Markup from ``start`` to ``end``; the name is empty where it is no element's."""
    start: int
    end: int
    closes: bool = False
    name: str = ""
    attributes: str = ""


@dataclass
class Line:
    """A block's text; ``story``: number of the article or main around it (0: none), ``linked``:
    characters in links, ``home``: number of the innermost element of ``HOMES`` around it (0: not
    known), ``named``: of the innermost element that is named like boilerplate (0: none)."""
    text: str
    story: int
    linked: int
    home: int = 0
    named: int = 0


def _names_boilerplate(value: str) -> bool:
    for name in _CAMEL.sub("-", value).lower().split():
        parts = _NAME_PARTS.findall(name)
        for i, part in enumerate(parts):
            if part in OUTSIDE_NAMES and not (i and parts[i - 1] in ("no", "with", "has", "without")):
                return True
    return False


def _is_outside(tag: str, attributes: str, in_story: bool) -> bool:
    """Whether an element holds no main text by its kind, role or style."""
    if tag in OUTSIDE:
        return True
    if tag == "header" and not in_story:
        return True
    if tag in ("html", "body", "article", "main") or not attributes:
        return False
    for name, value in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if name == "role" and value.lower() in OUTSIDE_ROLES or name == "hidden" or name == "aria-hidden" and value == "true":
            return True
        if name == "style" and re.search(r"display\s*:\s*none", value):
            return True
    return False


def _is_named(tag: str, attributes: str, in_story: bool) -> bool:
    """Whether an element is named like boilerplate: a form, or by a word of its class or id.  Names are
    no proof, since wrappers of whole pages bear such words too (``plain_elements``)."""
    if tag in DOUBTED:
        return True
    if tag in ("html", "body", "article", "main", "h1", "h2", "h3", "h4", "h5", "h6", "span", "b", "i", "em", "strong") or tag == "header" and in_story:
        return False
    return any(name.lower() in ("class", "id") and _names_boilerplate(value.strip("\"'")) for name, value in _ATTRIBUTE.findall(attributes))


def _last(stack: list[str], name: str) -> int:
    """Depth of the innermost open element of that name."""
    return next(i for i in range(len(stack), 0, -1) if stack[i - 1] == name)


def _next_tag(page: str, at: int, broken: bool) -> tuple[Tag | None, bool]:
    """The next tag, of any length, and whether the page breaks off inside one.

    Where a tag's way leads to the end of the page, it and all further tags end at the next
    ``>``, whatever their quotes say: so that way is taken once, and the time stays linear."""
    while found := _OPEN.search(page, at):
        start, at = found.span()
        if found[1]:
            end = page.find("-->", at)
            return Tag(start, end + 3 if end >= 0 else len(page)), broken
        if found[3] and not broken:
            rest = _REST.match(page, at)
            if rest:
                return Tag(start, rest.end(), bool(found[2]), found[3].lower(), rest[1]), broken
            broken = True
        end = page.find(">", at)
        if end >= 0:
            return Tag(start, end + 1, bool(found[2]), (found[3] or "").lower(), page[at:end]), broken
        at = page.find("<!--", at)  # nothing but comments can follow
        if at < 0:
            break
    return None, broken


def lines_of(page: str, whole: bool = False) -> list[Line]:
    """The text of a page by block, markup stripped and character references decoded.

    Where an element without main text was, and at both ends of article and main, ``WINDOW``
    empty lines stand, so that the distribution has a gap there.  Elements that are only named like
    boilerplate are judged once all lines are known.  ``whole`` keeps all visible text.  Tags that
    are left open end with the element around them."""
    found: list[Line] = []
    gap = [Line("", 0, 0)] * WINDOW
    stack: list[str] = []
    opened: Counter = Counter()
    outside = story = linked = 0  # depth of the element that began it; 0: not inside one
    text: list[str] = []
    in_links = 0
    homes = [(0, 1)]  # depth and number of the open elements of HOMES; all else is in the page itself
    n_homes = 1
    names: list[tuple[int, int]] = [(0, 0)]  # depth and number of the open elements named like boilerplate
    above: list[int] = [0]  # the named element around each of them
    began: list[int] = [0]  # the article or main around each of them
    n_stories = 0

    def flush() -> None:
        nonlocal text, in_links
        line = " ".join(html.unescape("".join(text)).split())
        if line:
            found.append(Line(line, n_stories if story else 0, in_links, homes[-1][1], names[-1][1]))
        text, in_links = [], 0

    def pop_to(depth: int) -> None:
        nonlocal outside, story, linked
        if depth <= outside <= len(stack):
            outside = 0
            found.extend(gap)
        if depth <= story <= len(stack):
            flush()
            story = 0
            found.extend(gap)
        if depth <= linked:
            linked = 0
        while homes[-1][0] >= depth:
            homes.pop()
        if names[-1][0] >= depth:
            flush()
            while names[-1][0] >= depth:
                found.append(Line("", 0, 0, 0, names.pop()[1]))
        opened.subtract(stack[depth - 1:])
        del stack[depth - 1:]

    at, broken = 0, False
    while True:
        tag, broken = _next_tag(page, at, broken)
        piece = page[at:tag.start if tag else len(page)]
        if piece and not outside:
            text.append(piece)
            if linked:
                in_links += len(piece.strip())
        if not tag:
            break
        at, name, closes, attributes = tag.end, tag.name, tag.closes, tag.attributes
        if not name:
            continue
        if name in RAW:
            if not closes and not attributes.endswith("/"):
                end = re.compile(rf"</{name}\s*>", re.I).search(page, at)
                at = end.end() if end else len(page) if name in ("script", "style") else at
            continue
        block = name in LINES
        if block and not outside:
            flush()
        elif name == "br" and not outside:
            text.append("\n")
        if name in VOID:
            continue
        if closes:
            if opened[name] > 0:
                depth = _last(stack, name)
                # an inline element's end does not close the block around it
                if block or not any(s in LINES for s in stack[depth:]):
                    pop_to(depth)
            continue
        if block and opened["p"] > 0:  # a paragraph ends where the next block begins
            depth = _last(stack, "p")
            if not any(s in LINES and s != "p" for s in stack[depth:]):
                pop_to(depth)
        if name in ("li", "td", "th", "tr", "dd", "dt") and stack and stack[-1] == name:
            pop_to(len(stack))
        if outside and not whole and name in STORY and not story:  # left open before the text began
            pop_to(outside)
        if attributes.endswith("/") and name not in LINES:
            continue
        stack.append(name)
        opened[name] += 1
        if outside:
            continue
        if name in HOMES:
            n_homes += 1
            homes.append((len(stack), n_homes))
        if (name == "head" if whole else _is_outside(name, attributes, story > 0)):
            flush()
            outside = len(stack)
            continue
        if not whole and _is_named(name, attributes, story > 0):
            flush()
            above.append(names[-1][1])
            began.append(n_stories if story else 0)
            names.append((len(stack), len(above) - 1))
        if name in STORY and not story:
            flush()
            found.extend(gap)
            story = len(stack)
            n_stories += 1
        elif name == "a" and not linked:
            linked = len(stack)
    flush()
    return found if len(above) == 1 else without_boilerplate(found, above, began)


def plain_elements(lines: list[Line], above: list[int], began: list[int]) -> set[int]:
    """The elements named like boilerplate that are wrappers of the text all the same: they hold a surge
    of running text (not in links) and hardly any stands beside them.  An article or main decides
    first: an element around one, with no other outside, is a wrapper, one beside it is not.

    Elements are judged from the outside in, and what a judged one leaves out counts nowhere."""
    running, stories = [0] * len(above), [set() for _ in above]
    for line in lines:
        n = len(line.text) - line.linked
        if line.text and (n > line.linked or line.story):
            running[line.named] += n
            if line.story:
                stories[line.named].add(line.story)
    own = running[:]
    told = [set(s) for s in stories]
    for e in range(len(above) - 1, 0, -1):  # elements begin after those around them
        running[above[e]] += running[e]
        told[above[e]] |= told[e]
    plain, free = {0}, own[0]
    free_stories = set(stories[0])
    for e in range(1, len(above)):
        if above[e] not in plain:
            continue
        inside = told[e] - {began[e]}
        beside = free_stories - {began[e]} if began[e] else free_stories
        if began[e] == 0 and beside:
            continue
        around = began[e] == 0 and inside and not beside
        if around or running[e] >= SURGE and free <= BESIDE * running[e]:
            plain.add(e)
            free += own[e]
            free_stories |= stories[e]
    return plain


def without_boilerplate(lines: list[Line], above: list[int], began: list[int]) -> list[Line]:
    """``lines`` with a gap in place of the named elements that are not plain."""
    plain = plain_elements(lines, above, began)
    kept: list[Line] = []
    for line in lines:
        if line.named in plain:
            if line.text or not line.named:
                kept.append(line)
        elif not line.text and above[line.named] in plain:  # its end
            kept.extend([Line("", 0, 0)] * WINDOW)
    return kept


def main_lines(lines: list[Line], window: int = WINDOW, surge: int = SURGE, story_surge: int = STORY_SURGE) -> list[str]:
    """The lines between surge and dive points of the window sums.

    A run of lines surges where the sum over the next ``window`` lines first reaches the
    threshold, and dives where ``window`` empty lines follow; it is kept from its surge.  Lines
    that are mostly links count as empty.  Article and main are a hint: inside them the
    threshold is ``story_surge``, links count, and a run that surges anywhere is kept from its first
    line, since titles are short.  A later run that does not surge is kept where
    its lines stand in the same element as lines kept before, as the end of a text does behind
    an advert.  Where the sums reach a threshold nowhere, the best window is the threshold: in
    article and main, and on pages that have no text there."""
    sizes = [0 if 2 * line.linked > len(line.text) and not line.story else len(line.text) for line in lines]
    sums = [sum(sizes[i:i + window]) for i in range(len(sizes))]
    best = max((n for line, n in zip(lines, sums, strict=True) if line.story and line.text), default=0)
    in_story, least = max(1, min(story_surge, best)), surge if best else min(surge, max(sums, default=0))
    ahead = [0] * (len(lines) + 1)  # the best window of article or main from here to the dive
    for i in range(len(lines) - 1, -1, -1):
        ahead[i] = max(sums[i] if lines[i].story else 0, ahead[i + 1]) if sums[i] else 0
    kept: list[str] = []
    homes: set[int] = set()
    inside = False
    for line, size, total, coming in zip(lines, sizes, sums, ahead, strict=False):
        inside = (coming >= in_story if line.story else total >= least) if not inside else total > 0
        if size and (inside or line.home in homes):
            kept.append(line.text)
            if inside and line.home:
                homes.add(line.home)
    return kept


def extract(page: str | None) -> str:
    """Main text of a page: blocks in page order, joined by an empty line; empty if none."""
    return "\n\n".join(main_lines(lines_of(page))) if page else ""


def extract_text(pages: DataFrame, html_column: str = "html", out: str = "text") -> DataFrame:
    """``pages`` with the main text in ``out``; all other columns are kept, and a column of that
    name is replaced.  Null html gives an empty text, whole pages are read, rows may repeat."""
    base = pages.drop(out)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks(batch, html_column):
                texts = [extract(page) for page in part.column(html_column).to_pylist()]
                yield pa.record_batch([*part.columns, pa.array(texts, pa.string())], [*part.schema.names, out])

    return base.mapInArrow(read, StructType([*base.schema.fields, StructField(out, StringType())]))


def page_texts(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    narrow = pages.select("page_id", "url", F.col("html").cast("string").alias("html"))
    return extract_text(narrow).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
