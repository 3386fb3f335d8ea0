"""HTML to text as it would be laid out.

A page is tokenised, a tree is built with the implied end tags of HTML (p, li, dt,
dd, option, table parts, headings inside p, ...), invisible parts are left out
(head, script, style, template, ``hidden``, ``display:none``, closed by the element that
carries them; ``visibility:hidden`` hides the text below it up to an element that is
``visible`` again), and the visible rest is rendered:

* paragraphs, headings, lists, tables, quotes and rules have a blank line around
  them, other blocks start on a new line, ``br`` breaks the line;
* list items get ``- `` or their number, nested lists and quotes are indented;
* the cells of a table are padded to the width of their columns and joined by ``  ``;
  a cell keeps its blocks, lists and pre as lines of its own, ``colspan`` and ``rowspan`` count;
  elements around rows or cells (a form, a link) do not keep them out of the table, and
  what is inside a table but in no cell comes before it;
* white space runs are one blank, but inside ``pre`` and ``textarea`` they stay.

Defined cases: a null page gives a null text, an empty one an empty text; unclosed
and stray tags never fail; elements nest to any depth (both passes keep their own
stack), only the blanks before a line end at ``INDENT`` columns; repeated rows are
rendered again; no rows give no rows; other columns are ignored.
"""

from __future__ import annotations

import html as entities
import re
import unicodedata
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Generator, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .frames import pick

#: Columns of indentation after which lists and quotes move no further to the right.
INDENT = 2000
# Element classes of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
UNSEEN = frozenset("head script style template title noscript iframe noembed noframes object audio video canvas datalist meta link desc metadata defs symbol clippath mask annotation annotation-xml".split())
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl table blockquote pre hr figure fieldset menu".split())
BLOCK = SPACED | frozenset("address article aside body caption center dd details dialog div dt figcaption footer form header hgroup html legend li main nav optgroup option search section summary tbody td text tfoot th thead tr".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section summary table ul".split())
#: start tag -> (open elements it ends, elements it does not look beyond)
IMPLIED = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu"])),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "option": (frozenset(["option"]), frozenset(["select", "datalist"])),
    "optgroup": (frozenset(["option", "optgroup"]), frozenset(["select"])),
    "tr": (frozenset(["tr", "td", "th", "caption", "colgroup"]), frozenset(["table"])),
    "td": (frozenset(["td", "th"]), frozenset(["table", "tr"])),
    "th": (frozenset(["td", "th"]), frozenset(["table", "tr"])),
    "tbody": (frozenset(["tr", "td", "th", "thead", "tbody", "tfoot", "caption", "colgroup"]), frozenset(["table"])),
    "body": (frozenset(["head"]), frozenset()),
}
IMPLIED["thead"] = IMPLIED["tfoot"] = IMPLIED["tbody"]
SCOPE = frozenset("table td th caption html button object template".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|</([a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)|<([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)", re.S)
_ATTR = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_HIDE = re.compile(r"(?:^|[;\s])display\s*:\s*none", re.I)
_VISIBILITY = re.compile(r"(?:^|[;\s])visibility\s*:\s*(visible|hidden|collapse)", re.I)
_WS = re.compile(r"[ \t\n\r\f]+")


class Node:
    __slots__ = ("tag", "kids", "seen", "shown", "mute", "cells", "start", "span", "down")

    def __init__(self, tag: str, seen: bool = True, shown: bool = True, start: int | None = None, span: int = 1, down: int = 1):
        self.tag, self.kids, self.seen, self.shown, self.start, self.span, self.down = tag, [], seen, shown, start, span, down
        #: whether characters right inside this element are not drawn (an svg draws those of its text elements)
        self.mute = False
        #: whether rows or cells of the table around it are below this element
        self.cells = False


def _attributes(raw: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for m in _ATTR.finditer(raw):
        out.setdefault(m[1].lower(), entities.unescape(m[2] or m[3] or m[4] or ""))
    return out


def _visible(tag: str, attrs: dict[str, str]) -> bool:
    if tag in UNSEEN or "hidden" in attrs and attrs["hidden"].lower() != "until-found" or tag == "input" and attrs.get("type", "").lower() == "hidden":
        return False
    return not ("style" in attrs and _HIDE.search(attrs["style"]))


def _shown(attrs: dict[str, str], parent: bool) -> bool:
    said = _VISIBILITY.findall(attrs["style"]) if "style" in attrs else []
    return said[-1].lower() == "visible" if said else parent


def _number(text: str | None, least: int, most: int) -> int | None:
    text = (text or "").strip()
    return min(max(int(text), least), most) if re.fullmatch(r"-?[0-9]{1,9}", text) else None


def build(page: str) -> Node:
    """The element tree; text nodes are strings with entities resolved."""
    root = Node("#root")
    stack = [root]
    places: dict[str, list[int]] = defaultdict(list)  # tag -> its places in the stack
    at, n = 0, len(page)

    def add_text(s: str) -> None:
        if s and stack[-1].shown and not stack[-1].mute:
            stack[-1].kids.append(entities.unescape(s) if "&" in s else s)

    def push(node: Node) -> None:
        places[node.tag].append(len(stack))
        stack.append(node)

    def cut(i: int) -> None:
        while len(stack) > i:
            places[stack.pop().tag].pop()

    def last(tags: frozenset) -> int:
        """The place of the innermost open element of these, 0 if there is none."""
        return max((places[t][-1] for t in tags if places.get(t)), default=0)

    def close(tags: frozenset, stop: frozenset) -> None:
        while (i := last(tags)) and i >= last(stop):
            # the outermost of these below the stop
            while i > 1 and stack[i - 1].tag in tags and stack[i - 1].tag not in stop:
                i -= 1
            cut(i)

    while at < n:
        lt = page.find("<", at)
        if lt < 0:
            add_text(page[at:])
            break
        add_text(page[at:lt])
        m = _TOKEN.match(page, lt)
        if m is None:  # a "<" that opens no tag is text
            add_text("<")
            at = lt + 1
            continue
        at = m.end()
        if m[1]:
            tag = m[1].lower()
            if tag == "br":
                stack[-1].kids.append(Node("br"))
                continue
            if tag == "p" and not places["p"]:
                stack[-1].kids.append(Node("p"))
                continue
            i = last(frozenset([tag]))
            bounded = tag not in SCOPE and tag not in ("body", "tr", "tbody", "thead", "tfoot")
            if i and not (bounded and last(SCOPE) > i):
                cut(i)
        elif m[2]:
            tag = m[2].lower()
            attrs = _attributes(m[3]) if m[3] and m[3] != "/" else {}
            if tag in CLOSES_P:
                close(frozenset(["p"]), SCOPE)
            if tag in IMPLIED:
                close(*IMPLIED[tag])
            elif tag not in UNSEEN and any(x.tag == "head" for x in stack[1:3]) and tag not in ("meta", "link", "base", "title"):
                close(frozenset(["head"]), frozenset())
            if re.fullmatch("h[1-6]", tag) and re.fullmatch("h[1-6]", stack[-1].tag):
                cut(len(stack) - 1)
            shown = _shown(attrs, stack[-1].shown)
            start = _number(attrs.get("value" if tag == "li" else "start"), -999_999_999, 999_999_999)
            down = _number(attrs.get("rowspan"), 0, 65534)
            node = Node(tag, _visible(tag, attrs) and (shown or tag not in VOID), shown, start, _number(attrs.get("colspan"), 1, 1000) or 1, 65534 if down == 0 else down or 1)
            node.mute = tag == "svg" or stack[-1].mute and tag not in ("text", "foreignobject")
            stack[-1].kids.append(node)
            if tag in ("td", "th", "tr"):
                for above in reversed(stack):
                    if above.cells or above.tag == "table":
                        break
                    above.cells = True
            if tag in RAW:
                end = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(page, at)
                body = page[at : end.start() if end else n]
                if node.seen and shown and tag in ("textarea", "xmp"):
                    node.kids.append(entities.unescape(body) if tag == "textarea" else body)
                if end:
                    gt = page.find(">", end.end())
                    at = n if gt < 0 else gt + 1
                else:
                    at = n
            elif tag not in VOID:
                push(node)
    return root


def width(s: str) -> int:
    """Columns of a text: wide East Asian characters are two, combining marks none."""
    return len(s) if s.isascii() else sum(0 if unicodedata.combining(c) else 2 if unicodedata.east_asian_width(c) in "WF" else 1 for c in s)


class Layout:
    """Collects lines; pending blanks and blank lines are only written before text."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.parts: list[str] = []
        self.blank = False  # a blank is due before the next word
        self.gap = False  # an empty line is due before the next line
        self.indent = ""
        self.lead = ""  # list mark for the next line

    def text(self, s: str) -> None:
        words = _WS.sub(" ", s)
        if words == " " or not words:
            self.blank = self.blank or bool(words)
            return
        if (self.blank or words[0] == " ") and self.parts:
            self.parts.append(" ")
        self.parts.append(words.strip(" "))
        self.blank = words[-1] == " "

    def line_end(self) -> None:
        if self.parts:
            self.write("".join(self.parts))
            self.parts = []
        self.blank = False

    def write(self, line: str) -> None:
        if self.gap and self.lines:
            self.lines.append("")
        self.gap = False
        if self.lead:
            line, self.lead = self.lead + line, ""
        else:
            line = self.indent + line
        self.lines.append(line.rstrip(" "))

    def space(self) -> None:
        self.line_end()
        if self.lines and not self.lead:
            self.gap = True

    def result(self) -> str:
        self.line_end()
        return "\n".join(self.lines)


def run(step: Generator) -> object:
    """Carries out a step; the steps it yields are done first, on a stack of their own, and give it their results."""
    todo, value = [step], None
    while todo:
        try:
            step = todo[-1].send(value)
        except StopIteration as end:
            todo.pop()
            value = end.value
        else:
            todo.append(step)
            value = None
    return value


def render(node: Node, out: Layout, in_list: bool = False) -> Generator:
    for kid in node.kids:
        if isinstance(kid, str):
            out.text(kid)
            continue
        if not kid.seen:
            continue
        tag = kid.tag
        if tag == "br":
            if out.parts:
                out.line_end()
            else:
                out.gap = bool(out.lines)
        elif tag == "hr":
            out.space()
            out.write("---")
            out.gap = True
        elif tag in ("pre", "textarea", "xmp"):
            out.space()
            body = plain(kid)
            for line in (body[1:] if body.startswith("\n") else body).rstrip("\n").split("\n"):
                out.write(line)
            out.gap = True
        elif tag == "table":
            out.space()
            yield table(kid, out)
            out.gap = True
        elif tag in ("ul", "ol", "menu"):
            out.line_end() if in_list else out.space()
            yield lists(kid, out)
            out.line_end()
            out.gap = out.gap or not in_list
        elif tag == "blockquote":
            out.space()
            indent, out.indent = out.indent, (out.indent + "  ")[:INDENT]
            yield render(kid, out)
            out.space()
            out.indent = indent
        elif tag == "dd":
            out.line_end()
            indent, out.indent = out.indent, (out.indent + "  ")[:INDENT]
            yield render(kid, out)
            out.line_end()
            out.indent = indent
        elif tag in SPACED:
            out.space()
            yield render(kid, out)
            out.space()
        elif tag in BLOCK:
            out.line_end()
            yield render(kid, out, in_list)
            out.line_end()
        else:
            yield render(kid, out, in_list)


def lists(node: Node, out: Layout) -> Generator:
    number = 1 if node.start is None else node.start
    indent = out.indent
    for kid in node.kids:
        if isinstance(kid, str):
            out.text(kid)
        elif kid.tag == "li" and kid.seen:
            out.line_end()
            number = number if kid.start is None else kid.start
            mark = f"{number}. " if node.tag == "ol" else "- "
            number += 1
            out.lead, out.indent = indent + mark, (indent + " " * len(mark))[:INDENT]
            yield render(kid, out, True)
            out.line_end()
            out.lead, out.indent = "", indent
            out.gap = False
        elif kid.seen:
            group = Node("#group")
            group.kids = [kid]
            yield render(group, out, True)
            out.line_end()


def plain(node: Node) -> str:
    out, todo = [], node.kids[::-1]
    while todo:
        kid = todo.pop()
        if isinstance(kid, str):
            out.append(kid)
        elif kid.tag == "br":
            out.append("\n")
        elif kid.seen:
            todo.extend(reversed(kid.kids))
    return "".join(out)


def table(node: Node, out: Layout) -> Generator:
    rows: list[list[tuple[int, int, list[str]]]] = []  # first column, columns, lines
    taken: dict[int, int] = {}  # column -> last row that a cell from above reaches down to

    def walk(part: Node) -> Generator:
        for kid in part.kids:
            if isinstance(kid, str):
                if kid.strip():
                    out.write(_WS.sub(" ", kid).strip())
            elif not kid.seen:
                continue
            elif kid.tag == "tr":
                yield row(kid)
            elif kid.tag in ("td", "th"):
                alone = Node("tr")
                alone.kids = [kid]
                yield row(alone)
            elif kid.tag == "caption":
                for line in (yield cell(kid)):
                    out.write(line)
            elif kid.tag in ("thead", "tbody", "tfoot"):
                taken.clear()  # no cell reaches out of its group
                yield walk(kid)
                taken.clear()
            elif kid.cells:
                yield walk(kid)
            else:
                yield stray([kid])

    def stray(kids: list) -> Generator:
        """What is in no cell comes before the table."""
        inner = Node("#group")
        inner.kids = kids
        yield render(inner, out)
        out.line_end()

    def row(tr: Node) -> Generator:
        got: list[tuple[int, int, list[str]]] = []
        nth = len(rows)
        rows.append(got)
        yield cells(tr, got, nth)

    def cells(part: Node, got: list, nth: int) -> Generator:
        """The cells of a row, also those that other elements wrap."""
        others: list = []
        for kid in part.kids:
            if isinstance(kid, Node) and kid.seen and kid.tag in ("td", "th"):
                at = got[-1][0] + got[-1][1] if got else 0
                while taken.get(at, -1) >= nth:
                    at += 1
                if kid.down > 1:
                    taken.update(dict.fromkeys(range(at, at + kid.span), nth + kid.down - 1))
                got.append((at, kid.span, []))
                got[-1][2].extend((yield cell(kid)))
            elif isinstance(kid, Node) and kid.seen and kid.tag == "tr":  # a row inside a wrapper inside a row
                yield row(kid)
            elif isinstance(kid, Node) and kid.seen and kid.cells:
                yield cells(kid, got, nth)
            else:
                others.append(kid)
        if any(isinstance(k, Node) or k.strip() for k in others):
            yield stray(others)

    def cell(c: Node) -> Generator:
        inner = Layout()
        yield render(c, inner)
        text = inner.result()
        return text.split("\n") if text.strip() else []

    yield walk(node)
    starts = sorted({at for got in rows for at, _, _ in got})  # columns in which no cell starts have no width
    place = {at: i for i, at in enumerate(starts)}
    widths = [0] * len(starts)
    spans = [[(place[at], bisect_left(starts, at + n), lines) for at, n, lines in got] for got in rows]
    room = lambda lo, hi: sum(widths[lo:hi]) + 2 * (hi - lo - 1)
    for lo, hi, lines in sorted((x for got in spans for x in got), key=lambda x: x[1] - x[0]):
        widths[hi - 1] += max(0, max(map(width, lines), default=0) - room(lo, hi))
    for short in spans:
        got, end = [], 0
        for lo, hi, lines in short:
            if lo > end:  # columns that a cell from above holds
                got.append((end, lo, []))
            got.append((lo, hi, lines))
            end = hi
        rooms = [room(lo, hi) for lo, hi, _ in got]
        for i in range(max((len(lines) for _, _, lines in got), default=0)):
            texts = [lines[i] if i < len(lines) else "" for _, _, lines in got]
            out.write("  ".join(t + " " * (r - width(t)) for t, r in zip(texts, rooms)))


def to_text(page: str | None) -> str | None:
    if page is None:
        return None
    out = Layout()
    run(render(build(page), out))
    return out.result()


def extract(spark: SparkSession, pages: DataFrame, page_id: str = "page_id", html: str = "html") -> DataFrame:
    """page_id and text; no shuffle, one page at a time in Arrow batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                yield pa.record_batch({"page_id": part.column("page_id"), "text": pa.array([to_text(x) for x in part.column("html").to_pylist()], pa.string())})

    return pick(pages, page_id=page_id, html=html).mapInArrow(run, "page_id long, text string")
