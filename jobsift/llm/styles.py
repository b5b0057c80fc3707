"""Style sheets, as far as they decide what is seen: the cascade of ``display`` and ``visibility``.

Rules count as on a screen of ``WIDE`` x ``HIGH`` pixels with a mouse: blocks of
``@media`` (and sheets with a media attribute) that do not hold there are
skipped, as are ``@keyframes``, ``@container`` and other blocks that style no
element by themselves. Selectors may be compound, with all four combinators, attributes,
``:not``, ``:is``, positions among siblings and states of the markup; a pointer's states
(``:hover``) never hold. A selector with anything else, and a rule nested in a
rule, matches nothing.

Elements are matched from the root down. Every part of a selector has a bit,
and an element knows the bits that its ancestors, its parent and the siblings before it
matched, so the work is the number of elements times the parts that name their tag, id or classes.
"""

from __future__ import annotations

import re

WIDE, HIGH = 1280, 720
TOKEN = re.compile(r"""/\*.*?(?:\*/|$)|"(?:\\.|[^"\\\n])*"?|'(?:\\.|[^'\\\n])*'?|\\.|<!--|-->|[{};]|[^{};"'/\\<-]+|.""", re.S)
DECLARATION = re.compile(r"\s*(display|visibility)\s*:\s*([a-z-]+)(?:\s+[a-z-]+)*\s*(!\s*important)?\s*$", re.I)
NAME = r"(?:[\w-]|[^\x00-\x7f]|\\(?:[0-9a-f]{1,6}+\s?+|[^0-9a-f]))++"
PIECE = re.compile(rf"(?P<tag>\*|{NAME})|(?P<sign>[.#])(?P<name>{NAME})|\[(?P<attr>(?:[^\]\"']|\"[^\"]*\"|'[^']*')*)\]|"
                   rf"(?P<pseudo>::?{NAME})(?P<call>\()?", re.I | re.S)
ATTRIBUTE = re.compile(rf"\s*({NAME})\s*(?:([~|^$*]?=)\s*(\"[^\"]*\"|'[^']*'|\S+?)\s*(\si)?\s*)?$", re.I | re.S)
COMBINATOR = re.compile(r"\s*([>+~])\s*|\s+")
LENGTH = re.compile(r"(\d{0,9}\.?\d{1,9})(px|em|rem|pt|in|cm)?$")
PIXELS = {"px": 1, "em": 16, "rem": 16, "pt": 4 / 3, "in": 96, "cm": 96 / 2.54}
# media features of the screen that pages are shown on
SCREEN = {"orientation": "landscape", "prefers-color-scheme": "light", "prefers-reduced-motion": "no-preference",
          "hover": "hover", "any-hover": "hover", "pointer": "fine", "any-pointer": "fine", "scripting": "enabled",
          "update": "fast", "display-mode": "browser", "forced-colors": "none", "prefers-contrast": "no-preference"}
NEVER = frozenset("hover focus active visited target focus-within focus-visible".split())


class Unknown(Exception):
    """A selector that this module does not read."""


def unescape(name: str) -> str:
    def plain(m):
        return chr(min(int(m[1], 16), 0x10FFFF)) if m[1] else m[2]
    return re.sub(r"\\(?:([0-9a-f]{1,6})\s?|(.))", plain, name, flags=re.I | re.S)


def pixels(text: str) -> float | None:
    m = LENGTH.match(text.strip())
    return float(m[1]) * PIXELS[m[2] or "px"] if m else None


def feature_holds(text: str) -> bool | None:
    """Whether "name: value" or a range holds on the screen; None if it is not known."""
    sizes = {"width": WIDE, "height": HIGH, "device-width": WIDE, "device-height": HIGH}
    if ":" in text:
        name, value = (x.strip() for x in text.split(":", 1))
        bound, _, rest = name.partition("-")
        if bound in ("min", "max") and rest in sizes:
            limit = pixels(value)
            return None if limit is None else sizes[rest] >= limit if bound == "min" else sizes[rest] <= limit
        if name in sizes:
            return pixels(value) == sizes[name]
        return SCREEN[name] == value if name in SCREEN else None
    parts = re.split(r"(<=|>=|<|>|=)", text)
    if len(parts) > 1:
        values = [sizes.get(p.strip(), pixels(p)) for p in parts[::2]]
        if None in values:
            return None
        tests = {"<": lambda a, b: a < b, "<=": lambda a, b: a <= b, ">": lambda a, b: a > b, ">=": lambda a, b: a >= b,
                 "=": lambda a, b: a == b}
        return all(tests[op](a, b) for a, op, b in zip(values, parts[1::2], values[1:]))
    return True if text.strip() in ("color", "width", "height", *SCREEN) else None


def query_holds(query: str) -> bool:
    turned = re.match(r"not\b(?!\s*\()", query)
    query = re.sub(r"^(not\b(?!\s*\()|only\b)", "", query).strip()
    if " or " in query:
        return any(query_holds(q.strip()) for q in query.split(" or "))
    found = []
    for part in re.split(r"\band\b", query):
        part = part.strip()
        m = re.fullmatch(r"(not\s*)?\((.*)\)", part, re.S)
        holds = feature_holds(m[2]) if m else part in ("screen", "all")
        if holds is None:
            return False
        found.append(holds != bool(m and m[1]))
    return all(found) != bool(turned)


def media_holds(media: str) -> bool:
    return not media.strip() or any(query_holds(q.strip()) for q in media.lower().split(","))


def declared(parts: list[str]) -> dict[str, tuple[bool, str]]:
    """property -> (important, value) of display and visibility; the last holds, but an important one over others."""
    out: dict[str, tuple[bool, str]] = {}
    for m in filter(None, (DECLARATION.match(" ".join(p.split())) for p in parts)):
        name, important = m[1].lower(), bool(m[3])
        if important or not out.get(name, (False,))[0]:
            out[name] = (important, m[2].lower())
    return out


def rules(css: str) -> list[tuple[str, dict]]:
    """(selectors, declared) of the rules that hold on the screen and say anything here, in order."""
    out, text, blocks = [], [], []

    def close():
        selectors, holds, parts = blocks.pop()
        if selectors is not None and holds:
            if says := declared([*parts, "".join(text)]):
                out.append((selectors, says))
        text.clear()

    for token in TOKEN.findall(css):
        if token == "{":
            head, holds, inner = "".join(text).strip(), not blocks or blocks[-1][1], bool(blocks) and blocks[-1][0] is not None
            text.clear()
            if head.startswith("@") or inner:
                name, _, rest = re.sub(r"^@([\w-]+)", r"\1 ", head).partition(" ")
                name = "" if inner else name.lower()
                blocks.append((None, holds and (name == "layer" or name == "media" and media_holds(rest)
                                                or name == "supports" and not rest.strip().startswith("not")), []))
            else:
                blocks.append((head, holds, []))
        elif token == "}":
            if blocks:
                close()
        elif token == ";":
            if blocks:
                blocks[-1][2].append("".join(text))
            text.clear()
        elif not token.startswith("/*") and token not in ("<!--", "-->"):
            text.append(token)
        else:
            text.append(" ")
    while blocks:
        close()
    return out


def split_list(text: str) -> list[str]:
    """Selectors between commas that stand in no brackets and no strings."""
    out, held, deep = [], [], 0
    for t in re.findall(r"""\\.|"[^"]*"|'[^']*'|[\[(]|[\])]|,|[^\\"'\[\](),]+|.""", text, re.S):
        deep += (t in "[(") - (t in "])")
        if t == "," and deep <= 0:
            out.append("".join(held))
            held = []
        else:
            held.append(t)
    return [*out, "".join(held)]


def nth(text: str):
    text = text.strip().lower()
    text = {"odd": "2n+1", "even": "2n"}.get(text, text)
    m = re.fullmatch(r"(?:([+-]?\d*)n)?\s*([+-]?\s*\d+)?", text)
    if not m or not text:
        raise Unknown(text)
    a = 0 if m[1] is None else int(m[1] + "1" if m[1] in ("", "+", "-") else m[1])
    b = int(re.sub(r"\s", "", m[2] or "0"))
    return lambda k: k == b if a == 0 else (k - b) % a == 0 and (k - b) // a >= 0


def attribute(text: str):
    m = ATTRIBUTE.match(text)
    if not m:
        raise Unknown(text)
    name, op, value = unescape(m[1]).lower(), m[2], m[3]
    if op is None:
        return lambda node, place: name in node.attrs
    value = unescape(value[1:-1] if value[:1] in "\"'" else value)
    fold = str.lower if m[4] or name == "type" else str
    value = fold(value)
    test = {"=": lambda x: x == value, "~=": lambda x: value in x.split(), "|=": lambda x: x == value or x.startswith(value + "-"),
            "^=": lambda x: bool(value) and x.startswith(value), "$=": lambda x: bool(value) and x.endswith(value),
            "*=": lambda x: bool(value) and value in x}[op]
    return lambda node, place: name in node.attrs and test(fold(node.attrs[name]))


class Compound:
    """One part of a selector: tag, id, classes and tests of (node, (place, of, place in type, of type))."""

    def __init__(self):
        self.tag, self.ids, self.classes, self.tests, self.weight = "", [], [], [], (0, 0, 0)

    def weigh(self, *w: int) -> None:
        self.weight = tuple(a + b for a, b in zip(self.weight, w))

    def key(self) -> str:
        return "#" + self.ids[0] if self.ids else "." + self.classes[0] if self.classes else self.tag

    def fits(self, node, classes: list, place: tuple) -> bool:
        return ((not self.tag or node.tag == self.tag) and all(node.attrs.get("id") == i for i in self.ids)
                and all(c in classes for c in self.classes) and all(t(node, place) for t in self.tests))

    def pseudo(self, name: str, arg: str | None, deep: int) -> None:
        if name in ("not", "is", "where", "matches", "-webkit-any", "-moz-any") and arg is not None:
            inner = [selector(s.strip(), deep + 1) for s in split_list(arg)]
            if any(len(s) != 1 for s in inner):
                raise Unknown(name)
            inner = [s[0][1] for s in inner]
            wanted = name != "not"
            self.tests.append(lambda n, p: any(c.fits(n, n.attrs.get("class", "").split(), p) for c in inner) == wanted)
            self.weigh(*(max(c.weight for c in inner) if name != "where" else (0, 0, 0)))
            return
        if arg is not None:
            test, kind = nth(arg), name
        else:
            kind = {"first-child": "nth-child", "last-child": "nth-last-child", "first-of-type": "nth-of-type",
                    "last-of-type": "nth-last-of-type"}.get(name)
            test = lambda k: k == 1
        at = {"nth-child": lambda p: p[0], "nth-last-child": lambda p: p[1] - p[0] + 1, "nth-of-type": lambda p: p[2],
              "nth-last-of-type": lambda p: p[3] - p[2] + 1}.get(kind)
        states = {"only-child": lambda n, p: p[1] == 1, "only-of-type": lambda n, p: p[3] == 1,
                  "root": lambda n, p: n.tag == "html", "empty": lambda n, p: not n.children,
                  "checked": lambda n, p: "checked" in n.attrs or "selected" in n.attrs,
                  "disabled": lambda n, p: "disabled" in n.attrs, "enabled": lambda n, p: "disabled" not in n.attrs,
                  "open": lambda n, p: "open" in n.attrs, "link": lambda n, p: "href" in n.attrs,
                  "any-link": lambda n, p: "href" in n.attrs, **{s: lambda n, p: False for s in NEVER}}
        if at:
            self.tests.append(lambda n, p: test(at(p)))
        elif arg is None and name in states:
            self.tests.append(states[name])
        else:
            raise Unknown(name)
        self.weigh(0, 1, 0)


def selector(text: str, deep: int = 0) -> list[tuple[str, Compound]]:
    """(combinator before it, compound) of each part."""
    out, at, link = [], 0, ""
    if not text or deep > 8:
        raise Unknown(text)
    while at < len(text):
        c, start = Compound(), at
        while at < len(text) and (m := PIECE.match(text, at)) and (not m["tag"] or at == start):
            at = m.end()
            if m["tag"]:
                c.tag = "" if m["tag"] == "*" else unescape(m["tag"]).lower()
                c.weigh(0, 0, bool(c.tag))
            elif m["sign"]:
                (c.ids if m["sign"] == "#" else c.classes).append(unescape(m["name"]))
                c.weigh(*((1, 0, 0) if m["sign"] == "#" else (0, 1, 0)))
            elif m["pseudo"]:
                arg = None
                if m["call"]:
                    start_of, level = at, 1
                    while at < len(text) and level:
                        level += (text[at] == "(") - (text[at] == ")")
                        at += 1
                    arg = text[start_of:at - (not level)]
                if m["pseudo"].startswith("::"):
                    raise Unknown(text)
                c.pseudo(m["pseudo"][1:].lower(), arg, deep)
            else:
                c.tests.append(attribute(m["attr"]))
                c.weigh(0, 1, 0)
        if at == start:
            raise Unknown(text)
        out.append((link, c))
        if at < len(text):
            m = COMBINATOR.match(text, at)
            if not m or m.end() == len(text):
                raise Unknown(text)
            link, at = m[1] or " ", m.end()
    return out


class Sheet:
    """The rules of a page, found by the last id, class or tag that a part names."""

    def __init__(self, sheets: list[str]):
        self.by: dict[str, list[tuple]] = {}
        bit = 1
        for order, (selectors, says) in enumerate(r for css in sheets for r in rules(css)):
            for text in split_list(selectors):
                try:
                    parts = selector(text.strip())
                except (Unknown, ValueError):
                    continue
                weight = tuple(map(sum, zip(*(c.weight for _, c in parts))))
                for k, (link, c) in enumerate(parts):
                    end = (weight, order, says) if k == len(parts) - 1 else None
                    self.by.setdefault(c.key(), []).append((bit, bit >> 1, link, c, end))
                    bit <<= 1

    def match(self, node, place: tuple, above: int, parent: int, before: int, prior: int) -> tuple[int, str | None, str | None]:
        """(bits that the element matches, display, visibility), given the bits of its ancestors, its parent, the
        sibling before it and all siblings before it."""
        bits, best = 0, {}
        if self.by:
            classes = node.attrs.get("class", "").split()
            for key in (node.tag, "", "#" + node.attrs.get("id", ""), *("." + c for c in dict.fromkeys(classes))):
                for bit, needs, link, c, end in self.by.get(key, ()):
                    seen = {" ": above, ">": parent, "+": before, "~": prior}[link] if link else needs
                    if (not link or seen & needs) and c.fits(node, classes, place):
                        bits |= bit
                        for name, (important, value) in (end[2] if end else {}).items():
                            best[name] = max(best.get(name, ()), (important, 0, *end[:2], value))
        style = node.attrs.get("style", "")
        if style:
            for name, (important, value) in declared(style.split(";")).items():
                best[name] = max(best.get(name, ()), (important, 1, (), 0, value))
        return bits, best.get("display", (None,))[-1], best.get("visibility", (None,))[-1]
