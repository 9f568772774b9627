"""Small helper run inside tasks: parse one page and read values at CSS-like selectors."""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter
from html import unescape
from operator import attrgetter

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
INLINE = {"a", "abbr", "b", "code", "em", "font", "i", "img", "label", "mark", "small", "span", "strong", "sub", "sup", "u"}
SELF_CLOSING_SIBLINGS = {"li", "tr", "td", "th", "p", "option", "dt", "dd"}
HIDDEN = {"script", "style"}
# Joins the values of one group element; never part of page text that is kept.
LIST_SEPARATOR = "\x1f"

_STEP = re.compile(r"""(?P<child>>\s*)?(?P<body>(?:[^\s>\[,]|\[[^\]]*\])+)""")
_PART = re.compile(
    r"""^(?P<tag>[a-z][\w-]*)|\#(?P<id>[\w-]+)|\.(?P<cls>[\w-]+)|:nth-child\((?P<nth>\d+)\)"""
    r"""|\[(?P<attr>[\w:-]+)(?:(?P<op>\*?=)'(?P<value>[^']*)')?\]"""
)
# Kinds of a condition, the most selective for an index lookup first.
_KINDS = ("id", "cls", "attr", "tag", "nth")


_TAG = re.compile(
    r"""<!--.*?-->|<![^>]*>|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)"""
    r"""(?P<attrs>(?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"""([^\s=/"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"']+)))?""")


def _attributes(raw: str) -> dict[str, str]:
    found = {}
    for name, double, single, bare in _ATTRIBUTE.findall(raw):
        value = double or single or bare
        found[name.lower()] = unescape(value) if "&" in value else value
    return found


class Node:
    __slots__ = ("tag", "attrs", "classes", "parent", "nth", "children", "start", "end", "text_from", "text_to")

    def __init__(self, tag, attrs, parent, start, text_from):
        self.tag, self.attrs, self.parent, self.start, self.text_from = tag, attrs, parent, start, text_from
        self.classes = attrs["class"].split() if "class" in attrs else ()
        self.children, self.end, self.text_to = 0, None, None
        self.nth = 1
        if parent is not None:
            parent.children += 1
            self.nth = parent.children


class Page:
    """Nodes of a page in document order, with an index by tag, class, id and attribute.

    A node's subtree is the range of positions up to its ``end``. Unclosed elements end with
    their parent, and repeated items such as ``<li>`` end the one before.
    """

    def __init__(self, html: str):
        self.count, self.pieces, self.index = 0, [], {}
        self.top = self._add("#document", {}, None)
        self.open = [self.top]
        self.open_tags = Counter()
        at = 0
        while (match := _TAG.search(html, at)) is not None:
            self._text(html[at : match.start()])
            at = match.end()
            name = match["name"]
            if name is None:
                continue
            name = name.lower()
            if match["close"]:
                self._end_tag(name)
            else:
                self._start_tag(name, match["attrs"])
                if name in HIDDEN:
                    close = re.compile(f"</{name}", re.IGNORECASE).search(html, at)
                    at = close.start() if close else len(html)
        self._text(html[at:])
        while self.open:
            self._finish(self._pop())

    def _add(self, tag, attrs, parent):
        node = Node(tag, attrs, parent, self.count, len(self.pieces))
        self.count += 1
        index = self.index
        index.setdefault(("tag", tag), []).append(node)
        for name in node.classes:
            index.setdefault(("cls", name), []).append(node)
        for name in attrs:
            index.setdefault(("attr", name), []).append(node)
        if "id" in attrs:
            index.setdefault(("id", attrs["id"]), []).append(node)
        return node

    def _pop(self):
        node = self.open.pop()
        self.open_tags[node.tag] -= 1
        return node

    def _finish(self, node):
        node.end, node.text_to = self.count, len(self.pieces)

    def _text(self, text):
        if text:
            self.pieces.append(text)

    def _start_tag(self, tag, raw):
        if tag in SELF_CLOSING_SIBLINGS and self.open[-1].tag == tag:
            self._finish(self._pop())
        if tag not in INLINE:
            self.pieces.append(" ")
        node = self._add(tag, _attributes(raw) if raw else {}, self.open[-1])
        if tag in VOID or raw == "/" or raw.endswith((" /", '"/', "'/")):
            self._finish(node)
        else:
            self.open.append(node)
            self.open_tags[tag] += 1

    def _end_tag(self, tag):
        if self.open_tags[tag]:
            while True:
                node = self._pop()
                self._finish(node)
                if node.tag == tag:
                    break
            if tag not in INLINE:
                self.pieces.append(" ")

    def text(self, node) -> str:
        """Text below a node with entities resolved and white space collapsed."""
        return " ".join(unescape("".join(self.pieces[node.text_from : node.text_to])).split())


def compile_selector(css: str):
    """``a.b > c[d*='e'], f`` -> alternatives of steps; a step is (is_child, conditions)."""
    alternatives = []
    for alternative in re.split(r",(?![^\[]*\])", css):
        steps = []
        for step in _STEP.finditer(alternative.strip()):
            conditions = [
                (part.lastgroup if part["attr"] is None else "attr", part) for part in _PART.finditer(step["body"])
            ]
            conditions = [(kind, part[kind], part["op"], part["value"]) for kind, part in conditions]
            steps.append((bool(step["child"]), sorted(conditions, key=lambda c: _KINDS.index(c[0]))))
        alternatives.append(steps)
    return alternatives


def _meets(node, conditions) -> bool:
    for kind, name, op, value in conditions:
        if kind == "tag":
            if node.tag != name:
                return False
        elif kind == "cls":
            if name not in node.classes:
                return False
        elif kind == "id":
            if node.attrs.get("id") != name:
                return False
        elif kind == "nth":
            if node.nth != int(name):
                return False
        else:
            found = node.attrs.get(name)
            if found is None or (op == "=" and found != value) or (op == "*=" and value not in found):
                return False
    return True


def matches(node, steps) -> bool:
    """Right-to-left match of the steps against a node and its ancestors."""
    if node is None or not _meets(node, steps[-1][1]):
        return False
    if len(steps) == 1:
        return True
    ancestor = node.parent
    if steps[-1][0]:
        return matches(ancestor, steps[:-1])
    while ancestor is not None:
        if matches(ancestor, steps[:-1]):
            return True
        ancestor = ancestor.parent
    return False


_START = attrgetter("start")


def find_all(page: Page, root, selector) -> list:
    """Matching nodes below the root in document order, looked up by one condition each."""
    found = {}
    for steps in selector:
        kind, name, _, _ = steps[-1][1][0]
        nodes = page.index.get((kind, name), ())
        at = bisect_right(nodes, root.start, key=_START)
        while at < len(nodes) and nodes[at].start < root.end:
            if matches(nodes[at], steps):
                found[nodes[at].start] = nodes[at]
            at += 1
    return [found[start] for start in sorted(found)]


def values(page: Page, root, selector, attribute: str | None) -> list[str]:
    """Attribute values, or texts, of the selected elements; no selector means the root itself."""
    nodes = find_all(page, root, selector) if selector else [root]
    if attribute is None:
        return [page.text(node) for node in nodes]
    return [node.attrs[attribute] for node in nodes if attribute in node.attrs]


def read_page(html: str, spec: dict) -> list[dict[str, list[str]]]:
    """One dict of value lists per record root; group columns hold one text per group element."""
    page = Page(html)
    top = page.top
    records = []
    for root in find_all(page, top, spec["root"]) if spec["root"] else [top]:
        record = {name: values(page, root, css, attribute) for name, (css, attribute) in spec["fields"].items()}
        for group, (css, parts) in spec["groups"].items():
            elements = find_all(page, root, css)
            for part, (part_css, attribute) in parts.items():
                cells = [values(page, element, part_css, attribute) for element in elements]
                record[f"{group}_{part}"] = [LIST_SEPARATOR.join(cell) for cell in cells]
        records.append(record)
    return records
