"""A small document tree on the standard library's HTML parser, and the selectors that catalogue pages need."""

from __future__ import annotations

import html.parser
import re
from collections.abc import Iterator
from html import unescape
from html.parser import HTMLParser

# Fixed values of HTML: elements without content, and those whose text isn't text of the page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset(("script", "style", "template"))


class Node:
    """An element with its attributes, children (elements and texts) and place in document order."""

    __slots__ = ("tag", "attrs", "parent", "children", "number", "classes")

    def __init__(self, tag: str, attrs: dict[str, str], parent: Node | None, number: int):
        self.tag, self.attrs, self.parent, self.number = tag, attrs, parent, number
        self.children: list[Node | str] = []
        self.classes: list[str] = attrs["class"].split() if "class" in attrs else []

    def index(self) -> dict[str, list[Node]]:
        """The elements below by tag, by class (with a dot before it), and all under an empty name, in document order."""
        found: dict[str, list[Node]] = {"": []}
        for node in self.descendants():
            found[""].append(node)
            found.setdefault(node.tag, []).append(node)
            for name in dict.fromkeys(node.classes):
                found.setdefault(f".{name}", []).append(node)
        return found

    def descendants(self) -> Iterator[Node]:
        """All elements below, in document order."""
        stack = [c for c in reversed(self.children) if isinstance(c, Node)]
        while stack:
            node = stack.pop()
            yield node
            stack += [c for c in reversed(node.children) if isinstance(c, Node)]

    def ancestors(self) -> Iterator[Node]:
        node = self.parent
        while node is not None:
            yield node
            node = node.parent

    def strings(self) -> Iterator[str]:
        """The texts inside, in document order; those of scripts and styles only from inside themselves."""
        stack: list[Node | str] = list(reversed(self.children))
        while stack:
            item = stack.pop()
            if isinstance(item, str):
                yield item
            elif item.tag not in SILENT:
                stack += reversed(item.children)

    def text(self) -> str:
        """The stripped texts inside, the empty ones left out, with a blank between."""
        return " ".join(s for t in self.strings() if (s := t.strip()))


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("", {}, None, 0)
        self.open, self.count = self.root, 0

    def handle_starttag(self, tag, attrs):
        self.count += 1
        values: dict[str, str] = {}
        for name, value in attrs:
            values.setdefault(name, value or "")
        node = Node(tag, values, self.open, self.count)
        self.open.children.append(node)
        if tag not in VOID:
            self.open = node

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.open = self.open.parent

    def handle_endtag(self, tag):
        node = self.open
        while node is not self.root and node.tag != tag:
            node = node.parent
        if node is not self.root:
            self.open = node.parent

    def handle_data(self, data):
        self.open.children.append(data)


def parse(html: str) -> Node:
    """The tree of a page; what is never closed ends with its parent, a stray end tag is ignored."""
    return _plain(html) or _parsed(html)


def _parsed(html: str) -> Node:
    builder = _Builder()
    builder.feed(html)
    builder.close()
    return builder.root


# Plain markup, on which all versions of the standard parser agree. Raw elements must hold text alone, so that nothing splits or decodes it in another way.
_BLANK = r"[ \t\n\r\f]"
_ATTRIBUTE = rf"""{_BLANK}+([A-Za-z][\w:.-]*)(?:="([^"]*)"|='([^']*)'|=([^\s"'<>=`/]+)(?=[ \t\n\r\f>]))?"""
_ATTRIBUTES = re.compile(_ATTRIBUTE, re.ASCII)
_TOKEN = re.compile(
    rf"""(?P<text>[^<]+)|</(?P<end>[A-Za-z][A-Za-z0-9]*){_BLANK}*>|<(?P<tag>[A-Za-z][A-Za-z0-9]*)(?P<attrs>(?:{_ATTRIBUTE.replace("([", "(?:[")})*){_BLANK}*(?P<closed>/?)>|<!--(?!-?>)(?:(?!--)[^>])*-->|<![dD][oO][cC][tT][yY][pP][eE][^>]*>""",
    re.ASCII,
)
_RAW = {t: re.compile(rf"{c}</{t}{_BLANK}*>", re.IGNORECASE | re.DOTALL) for t, c in (("script", r"((?:(?!</|<!--).)*)"), ("style", r"((?:(?!</|<!--).)*)"), ("title", "([^<]*)"), ("textarea", "([^<]*)"))}
_SPECIAL = frozenset("iframe math noembed noframes noscript plaintext svg xmp".split())
_attribute_text = getattr(html.parser, "_unescape_attrvalue", unescape)


def _plain(html: str) -> Node | None:
    """What `_parsed` gives, in less time, for a page of plain markup; none for any other."""
    open_ = root = Node("", {}, None, 0)
    count = at = 0
    end, match = len(html), _TOKEN.match
    while at < end:
        if (m := match(html, at)) is None:
            return None
        at = m.end()
        kind = m.lastgroup
        if kind == "text":
            text = m["text"]
            open_.children.append(unescape(text) if "&" in text else text)
        elif kind == "end":
            node, tag = open_, m["end"].lower()
            while node is not root and node.tag != tag:
                node = node.parent
            if node is not root:
                open_ = node.parent
        elif kind is not None:
            tag = m["tag"].lower()
            values: dict[str, str] = {}
            if given := m["attrs"]:
                for name, double, single, bare in _ATTRIBUTES.findall(f"{given}>"):
                    value = double or single or bare
                    values.setdefault(name.lower(), _attribute_text(value) if "&" in value else value)
            count += 1
            node = Node(tag, values, open_, count)
            open_.children.append(node)
            if tag in _RAW:
                if m["closed"] or not (rest := _RAW[tag].match(html, at)):
                    return None
                if content := rest[1]:
                    node.children.append(content if tag in SILENT or "&" not in content else unescape(content))
                at = rest.end()
            elif tag in _SPECIAL:
                return None
            elif not m["closed"] and tag not in VOID:
                open_ = node
    return root


_PART = re.compile(r"""(?P<tag>[A-Za-z][\w-]*)|\.(?P<cls>[\w-]+)|\[(?P<name>[\w-]+)(?:(?P<op>\*?=)(?P<quote>['"]?)(?P<value>[^'"\]]*)(?P=quote))?\]""")


def _compound(text: str):
    tag, classes, tests = None, [], []
    at = 0
    while at < len(text):
        m = _PART.match(text, at)
        if not m:
            raise ValueError(f"not a selector: {text}")
        at = m.end()
        if m["tag"]:
            tag = m["tag"].lower()
        elif m["cls"]:
            classes.append(m["cls"])
        elif not m["op"]:
            tests.append(lambda attrs, a=m["name"]: a in attrs)
        elif m["op"] == "=":
            tests.append(lambda attrs, a=m["name"], v=m["value"]: attrs.get(a) == v)
        else:
            tests.append(lambda attrs, a=m["name"], v=m["value"]: bool(v) and v in attrs.get(a, ""))

    def fits(node: Node) -> bool:
        if tag is not None and node.tag != tag:
            return False
        for c in classes:
            if c not in node.classes:
                return False
        for test in tests:
            if not test(node.attrs):
                return False
        return True

    return fits


def _name(text: str) -> str:
    """The tag or class that every element of a compound has, if it names one."""
    m = _PART.match(text)
    return m["tag"].lower() if m["tag"] else f".{m['cls']}" if m["cls"] else ""


def _split(text: str, mark: str) -> list[str]:
    """Parts between marks that stand outside brackets."""
    return [p for p in re.split(rf"{mark}(?![^\[]*\])", text.strip()) if p.strip()]


class Selector:
    """Tags, classes and attributes (present, equal, containing), descendants, and alternatives with commas."""

    def __init__(self, text: str):
        parts = [_split(one, r"\s+") for one in _split(text, r"\s*,\s*")]
        self.chains = [[_compound(part) for part in one] for one in parts]
        self.names = {_name(one[-1]) for one in parts}

    def matches(self, node: Node) -> bool:
        for chain in self.chains:
            if not chain[-1](node):
                continue
            rest = chain[:-1]
            for above in node.ancestors():
                if not rest:
                    break
                if rest[-1](above):
                    rest = rest[:-1]
            if not rest:
                return True
        return False

    def all(self, root: Node, index: dict[str, list[Node]] | None = None) -> Iterator[Node]:
        """The matching elements below `root` in document order; an index of it spares the walk."""
        if index is None:
            among = root.descendants()
        elif len(self.names) == 1:
            among = index.get(next(iter(self.names)), [])
        else:
            found = {n.number: n for name in self.names for n in index.get(name, ())}
            among = [found[k] for k in sorted(found)]
        return (n for n in among if self.matches(n))

    def first(self, root: Node | None, index: dict[str, list[Node]] | None = None) -> Node | None:
        return next(self.all(root, index), None) if root is not None else None
