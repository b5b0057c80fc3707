"""A page as a small tree, for rules that name elements by class and position.

Used inside Arrow UDFs on one page at a time. Tags close as they are written
(void elements aside); attribute values and text come entity-decoded.

Plainly written pages are cut at their ``<``, and each distinct tag is read once per worker; a page with any
other markup goes through the standard parser. Both give the same tree.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape
from html.parser import HTMLParser

VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
SILENT = frozenset(("script", "style", "template"))
RAW = frozenset(("script", "style"))  # text without entities
ODD = frozenset("iframe noembed noframes noscript plaintext xmp".split())  # left to the standard parser
#: what stands between < and the next >: a start tag whose values are quoted and hold no entity, or an end tag
START = re.compile(r"""([a-zA-Z][a-zA-Z0-9]*)((?:[ \t\n]+[a-zA-Z][-_a-zA-Z0-9]*(?:=(?:"[^"&]*"|'[^'&]*'))?)*)[ \t\n]*(/?)""")
ATTR = re.compile(r"""([a-zA-Z][-_a-zA-Z0-9]*)(?:=("[^"&]*"|'[^'&]*'))?""")
END = re.compile(r"/([a-zA-Z][a-zA-Z0-9]*)[ \t\n]*")
KEPT = 1 << 14  # tags remembered per worker


class Element:
    __slots__ = ("tag", "attrs", "classes", "children", "parent", "place")

    def __init__(self, tag: str, attrs: dict, parent: Element | None, classes: list | None = None):
        self.tag = tag
        self.attrs = attrs
        self.classes = attrs.get("class", "").split() if classes is None else classes
        self.children = []
        self.parent = parent
        self.place = len(parent.children) if parent else 0

    def walk(self) -> Iterator[Element]:
        """Elements below this one, in document order."""
        todo = [c for c in reversed(self.children) if isinstance(c, Element)]
        while todo:
            e = todo.pop()
            yield e
            todo.extend(c for c in reversed(e.children) if isinstance(c, Element))

    def all(self, tag: str | None = None, cls: str | None = None) -> Iterator[Element]:
        todo = self.children[::-1]
        while todo:
            e = todo.pop()
            if e.__class__ is str:
                continue
            if (tag is None or e.tag == tag) and (cls is None or cls in e.classes):
                yield e
            if e.children:
                todo += e.children[::-1]

    def first(self, tag: str | None = None, cls: str | None = None) -> Element | None:
        return next(self.all(tag, cls), None)

    def later_sibling(self, tag: str) -> Element | None:
        rest = self.parent.children[self.place + 1:] if self.parent else []
        return next((c for c in rest if isinstance(c, Element) and c.tag == tag), None)

    def strings(self) -> Iterator[str]:
        todo = list(reversed(self.children))
        while todo:
            c = todo.pop()
            if isinstance(c, str):
                yield c
            elif c.tag not in SILENT:
                todo.extend(reversed(c.children))

    def text(self) -> str:
        if len(self.children) == 1 and self.children[0].__class__ is str:
            return self.children[0].strip()
        return "".join(self.strings()).strip()

    def stripped(self, sep: str = "") -> str:
        return sep.join(s for s in (x.strip() for x in self.strings()) if s)


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Element("", {}, None)
        self.at = self.root

    def handle_starttag(self, tag, attrs):
        e = Element(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.children.append(e)
        if tag not in VOID:
            self.at = e

    def handle_startendtag(self, tag, attrs):
        self.at.children.append(Element(tag, {k: v or "" for k, v in attrs}, self.at))

    def handle_endtag(self, tag):
        e = self.at
        while e is not None and e.tag != tag:
            e = e.parent
        if e is not None and e.parent is not None:
            self.at = e.parent

    def handle_data(self, data):
        self.at.children.append(data)


def _tag(mark: str) -> tuple | None:
    """(kind, tag, attributes, classes): kind 1 opens, 0 stands alone, -1 closes, 2 is no element; None: not plain."""
    if m := START.fullmatch(mark):
        tag = m[1].lower()
        attrs = {k.lower(): v[1:-1] for k, v in ATTR.findall(m[2])}
        kind = 0 if m[3] or tag in VOID else 1
        return None if tag in ODD or m[3] and tag in RAW else (kind, tag, attrs, attrs.get("class", "").split())
    if m := END.fullmatch(mark):
        return -1, m[1].lower(), {}, []
    if mark[:8].lower() == "!doctype" or len(mark) > 6 and mark.startswith("!--") and mark.endswith("--"):
        return 2, "", {}, []
    return None


_TAGS: dict[str, tuple | None] = {}


def _plain(html: str) -> Element | None:
    """The tree of a plainly written page, None for any other."""
    first, *parts = html.split("<")
    at = root = Element("", {}, None)
    if first:
        root.children.append(unescape(first) if "&" in first else first)
    closes = None  # the element whose text holds no tags, so that its end must be next
    for part in parts:
        mark, whole, text = part.partition(">")
        if not whole:
            return None
        known = _TAGS.get(mark, ())
        if known == ():
            known = _tag(mark)
            if len(_TAGS) < KEPT and len(mark) < 200:
                _TAGS[mark] = known
        if known is None:
            return None
        kind, tag, attrs, classes = known
        if closes and (kind != -1 or tag != closes):
            return None
        closes = None
        if kind == 1:
            e = Element(tag, attrs, at, classes)
            at.children.append(e)
            at = e
            if tag in RAW or tag in ("title", "textarea"):
                closes = tag
        elif kind == 0:
            at.children.append(Element(tag, attrs, at, classes))
        elif kind == -1:
            e = at
            while e is not None and e.tag != tag:
                e = e.parent
            if e is not None and e.parent is not None:
                at = e.parent
        if text:
            at.children.append(unescape(text) if "&" in text and closes not in RAW else text)
    return None if closes else root


def parse(html: str) -> Element:
    root = _plain(html)
    if root is not None:
        return root
    b = _Builder()
    b.feed(html)
    b.close()
    return b.root
