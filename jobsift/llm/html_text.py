"""HTML extraction: a small layout engine that emits all visible text of a page.

A tree builder closes and opens what markup implies (``p`` before blocks,
list items, definition terms, options, table rows and cells), moves text and
elements that stand between cells to before the table. The tree has any depth;
it is walked with explicit stacks. Only layout stops at ``NESTED`` lists,
tables and other indented blocks within each other: further in, items keep their marks, and rows and cells
their order, as lines of their own, without indentation or columns (whose
width would grow with the square of the page). Visibility rules drop
scripts, styles, head, templates, fallback content, closed details and
dialogs, the ``hidden`` attribute, and what ``display`` and ``visibility`` hide on a screen, by the cascade of
inline styles and the page's style sheets (``styles``); of drawings (``svg``) the text elements are seen,
of formulas all but annotations. Rendering keeps
block spacing (blank lines around paragraphs and headings, line breaks
around other blocks), list marks and nesting, preformatted text, and tables as
aligned columns with row and column spans. Cell lines longer than ``ALIGN`` ask
for no column width, and no line is moved right by more than ``MARGIN``, so the
text is at most a multiple of the page, whatever its widest cell.

Every page is one row; pages are rendered in the tasks that read them, with
no shuffle. Defined results: null or empty html gives an empty text; broken
markup is never an error; repeated rows give equal texts; an empty table gives
an empty result; other columns pass through unread.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_left
from collections import Counter
from html.parser import HTMLParser
from itertools import accumulate

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobsift.llm.common import fresh, quoted
from jobsift.llm.styles import Sheet, media_holds

ALIGN, MARGIN = 80, 160  # longest line that is aligned; farthest that spaces move a line
NESTED = 100
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 blockquote dl figure pre ul ol table fieldset".split())
BLOCKS = SPACED | frozenset(
    "address article aside body center dd details dialog dir div dt figcaption footer form header hgroup hr html legend li "
    "main menu nav optgroup option search section summary caption tr td th thead tbody tfoot".split())
CLOSES_P = (BLOCKS - frozenset("body html option optgroup caption tr td th thead tbody tfoot legend".split()))
UNSEEN = frozenset("script style head template noscript title iframe object audio video canvas datalist rp "
                   "noframes noembed annotation annotation-xml".split())
# foreign elements: "/>" closes them, HTML ends them; in drawings only some hold text that is seen
FOREIGN = frozenset(("svg", "math"))
HOSTS = frozenset("foreignobject mi mo mn ms mtext annotation-xml desc".split())
BREAKS_OUT = frozenset(
    "b big blockquote br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 hr i img li listing menu meta nobr ol p pre ruby s "
    "small span strong strike sub sup table tt u ul var".split())
UNDRAWN = frozenset("desc metadata defs symbol clippath mask pattern marker lineargradient radialgradient filter".split())
GROUPS = frozenset("thead tbody tfoot".split())
CELLS = frozenset(("td", "th"))
# open elements that take only parts of a table (and what is never shown); all else goes to before the table
GRID = GROUPS | {"table", "tr", "colgroup"}
PARTS = GROUPS | CELLS | {"tr", "caption", "colgroup", "col", "style", "script", "template"}
SCOPE = CELLS | {"table", "caption"}
# a start tag closes these open elements, searched up to a boundary
IMPLIED_END = {
    "li": ({"li"}, SCOPE | {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, SCOPE | {"dl"}), "dd": ({"dt", "dd"}, SCOPE | {"dl"}),
    "option": ({"option"}, {"select", "datalist"}), "optgroup": ({"option", "optgroup"}, {"select"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "thead": ({"tr", "td", "th", "thead", "tbody", "tfoot", "caption", "colgroup"}, {"table"}),
    "tbody": ({"tr", "td", "th", "thead", "tbody", "tfoot", "caption", "colgroup"}, {"table"}),
    "tfoot": ({"tr", "td", "th", "thead", "tbody", "tfoot", "caption", "colgroup"}, {"table"}),
    "colgroup": ({"tr", "td", "th", "thead", "tbody", "tfoot", "caption", "colgroup"}, {"table"}),
    "caption": ({"tr", "td", "th", "thead", "tbody", "tfoot", "caption", "colgroup"}, {"table"}),
    "rt": ({"rt", "rp"}, {"ruby"}), "rp": ({"rt", "rp"}, {"ruby"}),
}
WHITE = re.compile(r"[ \t\n\r\f]+")


class Node:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: dict):
        self.tag, self.attrs, self.children = tag, attrs, []


class TreeBuilder(HTMLParser):
    """Elements in a tree of ``Node``; text is str children."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.html, self.root = Node("html", {}), Node("body", {})
        self.open = [self.root]
        self.at: dict[str, list[int]] = {}  # tag -> where its elements stand in ``open``
        self.styles: list[str] = []

    def last(self, tags) -> int:
        """Where the innermost open element of these tags stands, or -1."""
        return max((self.at[t][-1] for t in tags if self.at.get(t)), default=-1)

    def cut(self, k: int) -> None:
        """Close the open elements from the k-th on."""
        while len(self.open) > k:
            self.at[self.open.pop().tag].pop()

    def pop_to(self, tags: set, stop: set) -> None:
        k = self.last(tags)
        if k < 1 or self.last(stop) >= k:
            return
        while k > 1 and self.open[k - 1].tag in tags:  # close the outermost of them below the boundary
            k -= 1
        self.cut(k)

    def inside(self, tag: str, stop: set) -> bool:
        k = self.last((tag,))
        return k >= 0 and k >= self.last(stop)

    def foreign(self) -> bool:
        """Whether the next element belongs to a drawing or formula."""
        return self.last(FOREIGN) > self.last(HOSTS)

    def add(self, child: Node | str, part: bool = False) -> None:
        """Append to the open element; what no table, row group or row may hold stands before the table."""
        top = self.open[-1]
        if top.tag in GRID and not part and self.inside("table", set()):
            siblings = self.open[self.last(("table",)) - 1].children  # the open table is the last of them
            siblings.insert(len(siblings) - 1, child)
        else:
            top.children.append(child)

    def push(self, tag: str, attrs: dict, keep: bool = True) -> None:
        node = Node(tag, attrs)
        self.add(node, tag in PARTS)
        if keep:
            self.at.setdefault(tag, []).append(len(self.open))
            self.open.append(node)

    def handle_starttag(self, tag, attrs):
        attrs = {k: v or "" for k, v in reversed(attrs)}  # the first of equal names holds
        if tag == "html" or tag == "body":
            (self.root if tag == "body" else self.html).attrs.update(attrs)
            return
        if tag in BREAKS_OUT and self.foreign():
            self.cut(self.last(FOREIGN))
        if tag == "table" and self.open[-1].tag in GRID and self.inside("table", set()):
            self.cut(self.last(("table",)))  # a table right in a table or row ends the one it stands in
        if tag in CLOSES_P and self.inside("p", {"table", "td", "th", "button"}):
            self.pop_to({"p"}, {"table", "td", "th"})
        if tag in IMPLIED_END:
            self.pop_to(*IMPLIED_END[tag])
        if tag in GROUPS | {"caption", "colgroup"} and self.inside("table", set()):
            self.cut(self.last(("table",)) + 1)  # an element that was moved to before the table ends here
        if tag == "tr" and self.open[-1].tag not in GROUPS | {"table"} and self.inside("table", CELLS):
            self.cut(self.last(GROUPS | {"table"}) + 1)
        if tag in CELLS and self.open[-1].tag != "tr":
            if not self.inside("table", set()):
                return  # a cell outside a table is no element
            if not self.inside("tr", {"table"}):
                self.cut(self.last(GROUPS | {"table"}) + 1)
                self.push("tr", {})
            else:
                self.cut(self.last(("tr",)) + 1)
        if re.fullmatch("h[1-6]", tag) and re.fullmatch("h[1-6]", self.open[-1].tag):
            self.cut(len(self.open) - 1)
        # a form between cells holds nothing: the rows go on
        self.push(tag, attrs, tag not in VOID and not (tag == "form" and self.open[-1].tag in GRID))

    def handle_startendtag(self, tag, attrs):
        if tag in FOREIGN or tag not in BREAKS_OUT and self.foreign():
            self.push(tag, {k: v or "" for k, v in reversed(attrs)}, False)
        else:
            self.handle_starttag(tag, attrs)  # "/>" means nothing on HTML elements

    def handle_endtag(self, tag):
        if tag == "br":
            self.push("br", {}, False)
            return
        if tag in ("body", "html") or tag in VOID:
            return
        stop = {"table"} if tag in ("tr", "td", "th", "thead", "tbody", "tfoot", "caption") else \
            set() if tag == "table" else SCOPE
        if tag == "li":
            stop = stop | {"ul", "ol"}
        if self.inside(tag, stop - {tag}):
            self.cut(self.last((tag,)))

    def handle_data(self, data):
        top = self.open[-1]
        if top.tag == "style":
            if (top.attrs.get("type", "").strip().lower() in ("", "text/css") and media_holds(top.attrs.get("media", ""))
                    and not self.inside("noscript", set()) and not self.inside("template", set())):
                self.styles.append(data)
        elif top.tag not in GRID or data.strip():
            if top.tag == "pre" and not top.children:
                data = data.removeprefix("\n")  # a line break right after the tag is no line
            self.add(data)


class Lines:
    """Lines under construction: runs of white space collapse, blocks ask for line breaks and blank lines."""

    def __init__(self, pre: bool = False):
        self.lines: list[str] = []
        self.now: list[str] = []
        self.gap = 0
        self.pre = pre
        self.marks: list[str] = []  # before the next line

    def text(self, s: str) -> None:
        s = WHITE.sub(" ", s)
        if s[:1] == " " and (not self.now or self.now[-1].endswith((" ", "\n"))):
            s = s[1:]
        if s:
            self.now.append(s)

    def flush(self) -> None:
        line = "".join(self.now)
        line = line.rstrip(" ") if self.pre else line.strip(" ")
        self.now = []
        if line:
            self.put([line])

    def put(self, lines: list[str]) -> None:
        if self.lines:
            self.lines += [""] * self.gap
        self.gap = 0
        if self.marks:
            lines = ["".join(self.marks) + lines[0], *lines[1:]]
            self.marks = []
        self.lines += lines

    def block(self, gap: int) -> None:
        self.flush()
        self.gap = max(self.gap, gap)

    def newline(self) -> None:
        if self.now:
            self.flush()
        else:
            self.gap = min(self.gap + 1, 1)


def run(step):
    """What a generator returns that yields further such generators, on a stack of its own."""
    stack, value = [step], None
    while stack:
        try:
            stack.append(stack[-1].send(value))
            value = None
        except StopIteration as end:
            stack.pop()
            value = end.value
    return value


class Page:
    def __init__(self, html: str):
        builder = TreeBuilder()
        builder.feed(html)
        builder.close()
        self.root = builder.root
        self.prune(Sheet(builder.styles), builder.html)

    def prune(self, sheet: Sheet, html: Node) -> None:
        """Take what is not seen out of the tree; the body itself counts as shown (pages show it by script)."""
        top = sheet.match(html, (1, 1, 1, 1), 0, 0, 0, 0)[0]
        body = sheet.match(self.root, (2, 2, 1, 1), top, top, 0, 0)[0]
        todo = [(self.root, top | body, body, True, False)]
        while todo:  # the bits of the element's line and its own; whether its text is visible, and bare in a drawing
            node, line, own, visible, bare = todo.pop()
            kept, before, prior, k = [], 0, 0, 0
            kinds = Counter(c.tag for c in node.children if isinstance(c, Node)) if sheet.by else Counter()
            count, nth = sum(kinds.values()), Counter()
            for child in node.children:
                if isinstance(child, str):
                    if visible and not bare:
                        kept.append(child)
                    continue
                k, tag = k + 1, child.tag
                nth[tag] += 1
                before, display, visibility = sheet.match(child, (k, count, nth[tag], kinds[tag]), line, own, before, prior)
                prior |= before
                closed = "hidden" in child.attrs or tag == "dialog" and "open" not in child.attrs
                if tag in UNSEEN or tag == "input" or display == "none" or closed and display is None or bare and tag in UNDRAWN:
                    continue
                shown = visibility in ("visible", "initial") or visible and visibility not in ("hidden", "collapse")
                drawn = bare and tag in ("text", "foreignobject")
                if drawn:  # each text has its own place in a drawing
                    child.tag = "div"
                elif tag == "q" and not shown:
                    child.tag = "span"
                kept.append(child)
                todo.append((child, line | before, before, shown, tag == "svg" or bare and not drawn))
            node.children = kept

    # The methods below that yield are steps of ``run``: each yields the next step and is sent what that returns.

    def render(self) -> str:
        return "\n".join(run(self.lines_of(self.root.children, 0)))

    def lines_of(self, children: list, deep: int, pre: bool = False):
        out = Lines(pre)
        yield self.walk(children, out, pre, False, deep)
        out.flush()
        return out.lines

    def walk(self, children: list, out: Lines, pre: bool, listed: bool, deep: int):
        for node in children:
            if isinstance(node, str):
                if pre:
                    first, *rest = node.split("\n")
                    out.now.append(first)
                    for line in rest:
                        out.put(["".join(out.now).rstrip(" ")])
                        out.now = [line]
                else:
                    out.text(node)
            elif node.tag == "br":
                out.newline()
            else:
                yield self.element(node, out, pre, listed, deep)

    def element(self, node: Node, out: Lines, pre: bool, listed: bool, deep: int):
        """``deep`` counts the blocks around it that are laid out by themselves."""
        tag, flat = node.tag, deep >= NESTED
        if tag == "table":
            if flat:
                yield self.flat_table(node, out, deep)
            else:
                self.framed((yield self.table(node, deep + 1)), out, 1)
        elif tag in ("ul", "ol", "menu", "dir"):
            if flat:
                yield self.flat_items(node, out, listed, deep)
            else:
                self.framed((yield self.items(node, deep + 1)), out, 0 if listed else 1)
        elif tag == "pre" and not pre:
            if flat:
                out.block(1)
                yield self.walk(node.children, out, True, listed, deep)
                out.block(1)
            else:
                self.framed((yield self.lines_of(node.children, deep + 1, True)), out, 1)
        elif tag == "details" and "open" not in node.attrs:
            out.block(0)
            yield self.walk([c for c in node.children if isinstance(c, Node) and c.tag == "summary"][:1], out, pre, listed, deep)
            out.block(0)
        elif tag == "dd" and not flat:
            self.framed(["  " + x if x else x for x in (yield self.lines_of(node.children, deep + 1))], out, 0)
        elif tag == "select" and not flat:
            self.framed((yield self.lines_of(node.children, deep + 1)), out, 0)
        elif tag == "q":
            out.text("“")
            yield self.walk(node.children, out, pre, listed, deep)
            out.text("”")
        elif tag in BLOCKS or tag == "select":
            gap = 1 if tag in SPACED else 0
            out.block(gap)
            yield self.walk(node.children, out, pre, listed, deep)
            out.block(gap)
        else:
            yield self.walk(node.children, out, pre, listed, deep)

    @staticmethod
    def framed(lines: list[str], out: Lines, gap: int) -> None:
        if lines:
            out.block(gap)
            out.put(lines)
            out.block(gap)

    @staticmethod
    def marked(node: Node) -> list[tuple[Node | str, str]]:
        """The children of a list, items with their marks."""
        out, number = [], whole(node.attrs.get("start"), 1)
        step = -1 if "reversed" in node.attrs else 1
        for child in node.children:
            mark = ""
            if isinstance(child, Node) and child.tag == "li":
                mark = "- "
                if node.tag == "ol":
                    number = whole(child.attrs.get("value"), number)
                    mark = f"{number}. "
                    number += step
            out.append((child, mark))
        return out

    def items(self, node: Node, deep: int):
        """Marks and nesting of a list; what stands beside the items is an item without a mark."""
        out = []
        for child, mark in self.marked(node):
            if isinstance(child, str):
                out += ["  " + x for x in (yield self.lines_of([child], deep))]
                continue
            inner = Lines()
            yield self.walk(child.children if mark else [child], inner, False, True, deep)
            inner.flush()
            mark = mark or "  "
            out += [(mark if k == 0 else " " * len(mark)) + x if x else x for k, x in enumerate(inner.lines)]
        return out

    def flat_items(self, node: Node, out: Lines, listed: bool, deep: int):
        """A list past ``NESTED``: each item a block, its mark before its first line."""
        out.block(0 if listed else 1)
        for child, mark in self.marked(node):
            out.block(0)
            held = len(out.marks)
            if mark:
                out.marks.append(mark)
            yield self.walk(child.children if mark else [child], out, False, True, deep)
            out.block(0)
            del out.marks[held:]  # those of an item without a line
        out.block(0 if listed else 1)

    @staticmethod
    def parts(node: Node) -> tuple[list[Node], list[Node]]:
        """(captions, rows) of a table; head groups come first and foot groups last."""
        captions, head, body, foot = [], [], [], []
        for child in node.children:
            if isinstance(child, str):
                continue
            if child.tag == "caption":
                captions.append(child)
            elif child.tag in GROUPS:
                rows = [r for r in child.children if isinstance(r, Node) and r.tag == "tr"]
                {"thead": head, "tbody": body, "tfoot": foot}[child.tag].extend(rows)
            elif child.tag == "tr":
                body.append(child)
        return captions, [*head, *body, *foot]

    def flat_table(self, node: Node, out: Lines, deep: int):
        """A table past ``NESTED``: each caption and cell a block."""
        captions, rows = self.parts(node)
        out.block(1)
        for block in [*captions, *(c for r in rows for c in r.children if isinstance(c, Node) and c.tag in CELLS)]:
            out.block(0)
            yield self.walk(block.children, out, False, False, deep)
            out.block(0)
        out.block(1)

    def table(self, node: Node, deep: int):
        """Rows of aligned columns, captions above."""
        captions, rows = self.parts(node)
        caption = []
        for c in captions:
            caption += yield self.lines_of(c.children, deep)
        covered: list[tuple[int, int, int]] = []  # columns (first, past the last) that a span above covers, rows left
        grid = []
        for left, row in zip(range(len(rows), 0, -1), rows):
            cells, new, at, k = [], [], 0, 0
            for cell in row.children:
                if isinstance(cell, str) or cell.tag not in CELLS:
                    continue
                while k < len(covered) and covered[k][0] <= at:
                    at, k = max(at, covered[k][1]), k + 1
                wide = min(max(whole(cell.attrs.get("colspan"), 1), 1), 1000)  # HTML's own limits
                tall = min(max(whole(cell.attrs.get("rowspan"), 1), 1), 65534, left)
                cells.append((at, wide, (yield self.lines_of(cell.children, deep)), side_of(cell)))
                if tall > 1:
                    new.append((at, at + wide, tall))
                at += wide
            covered = joined([(x, y, n - 1) for x, y, n in [*covered, *new] if n > 1])
            grid.append(cells)
        # only columns in which a cell starts can be wide; a span reaches over those among them
        columns = sorted({at for cells in grid for at, *_ in cells})
        place = {at: k for k, at in enumerate(columns)}
        widths = [0] * len(columns)
        for cells in grid:
            for at, wide, lines, _ in cells:
                if wide == 1:
                    widths[place[at]] = max(widths[place[at]], aligned(lines))
        for cells in grid:
            for at, wide, lines, _ in cells:
                if wide > 1 and lines:
                    a, z = place[at], bisect_left(columns, at + wide)
                    short = aligned(lines) - sum(widths[a:z]) - 2 * (z - a - 1)
                    if short > 0:
                        widths[z - 1] += short
        starts = [0, *accumulate(w + 2 if w else 0 for w in widths)]
        out = list(caption)
        for cells in grid:
            for k in range(max((len(c[2]) for c in cells), default=0)):
                line, filled = [], 0
                for at, wide, lines, side in cells:
                    if k < len(lines) and lines[k]:
                        a, size = place[at], width(lines[k])
                        room = max(0, starts[bisect_left(columns, at + wide)] - 2 - starts[a] - size)
                        left = starts[a] + (room if side == "right" else room // 2 if side == "center" else 0)
                        own = len(lines[k]) - len(lines[k].lstrip(" "))
                        pad = max(min(left, MARGIN) - filled, 0)
                        pad = max(min(pad, MARGIN - own), 1) if line else max(min(pad, MARGIN - own), 0)
                        line += [" " * pad, lines[k]]
                        filled += pad + size
                out.append("".join(line).rstrip())
        return out if any(out) else []


def joined(spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Spans in order, those that touch and have as many rows left as one."""
    out: list[tuple[int, int, int]] = []
    for span in sorted(spans):
        if out and out[-1][1] >= span[0] and out[-1][2] == span[2]:
            out[-1] = (out[-1][0], max(out[-1][1], span[1]), span[2])
        else:
            out.append(span)
    return out


def aligned(lines: list[str]) -> int:
    """The width that a cell asks of its columns: longer lines than ``ALIGN`` stand in their row, unaligned."""
    return max((w for w in map(width, lines) if w <= ALIGN), default=0)


def whole(value: str | None, other: int) -> int:
    m = re.match(r"\s*([-+]?\d{1,9})", value or "")
    return int(m[1]) if m else other


def side_of(cell: Node) -> str:
    m = re.search(r"text-align\s*:\s*(right|center)", cell.attrs.get("style", ""), re.I)
    return (m[1] if m else cell.attrs.get("align", "")).lower()


def width(s: str) -> int:
    if s.isascii():
        return len(s)
    return sum(0 if unicodedata.combining(c) else 2 if unicodedata.east_asian_width(c) in "WF" else 1 for c in s)


def visible_text(html: str | None) -> str:
    return Page(html).render() if html else ""


@F.pandas_udf(T.StringType())
def visible(html: pd.Series) -> pd.Series:
    return html.map(lambda h: visible_text(h) if isinstance(h, str) else "")


def extract(pages: DataFrame, html_col: str = "html", out_col: str = "text") -> DataFrame:
    """``pages`` with the visible text in place of the html (as ``out_col``, or a free name)."""
    rest = [c for c in pages.columns if c != html_col]
    name = out_col if out_col.lower() not in {c.lower() for c in rest} else fresh(pages, out_col)
    shown: Column = visible(quoted(html_col).cast("string"))
    return pages.select(*[quoted(c) for c in rest], shown.alias(name))


def op3_html_text(spark, sf_dir: str) -> DataFrame:
    pages = extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return pages.withColumn("n_chars", F.length("text").cast("long"))
