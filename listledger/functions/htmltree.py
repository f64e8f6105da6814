"""A small element tree from ``html.parser`` events, with the same repair
rules a lenient tree builder on that parser uses: an end tag closes the most
recent open element of its name (and everything opened after it); an end tag
with no open element of that name is ignored; void elements never open.

Used inside Arrow-batched tasks (one page at a time) by the Markdown
converter (E2) and the card extractors (E8, E9).
"""

from __future__ import annotations

import re
from html import unescape
from html.parser import HTMLParser

VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr keygen basefont frame".split())


class Node:
    __slots__ = ("tag", "attrs", "children", "parent")

    def __init__(self, tag: str | None, attrs: dict | None = None, parent: "Node | None" = None):
        self.tag = tag            # None for the document, "#text", "#comment"
        self.attrs = attrs or {}
        self.children: list = []
        self.parent = parent

    # -- queries -----------------------------------------------------------
    def iter(self):
        """Descendant elements in document order (self excluded)."""
        stack = list(reversed(self.children))
        while stack:
            n = stack.pop()
            if isinstance(n, Node):
                yield n
                stack.extend(reversed(n.children))

    def find(self, pred):
        for n in self.iter():
            if pred(n):
                return n
        return None

    def find_all(self, pred):
        return [n for n in self.iter() if pred(n)]

    def texts(self):
        stack = list(reversed(self.children))
        while stack:
            n = stack.pop()
            if isinstance(n, str):
                yield n
            elif n.tag != "#comment":
                stack.extend(reversed(n.children))

    def get_text(self, strip: bool = False) -> str:
        if strip:
            return "".join(t.strip() for t in self.texts() if t.strip())
        return "".join(self.texts())

    def classes(self) -> list[str]:
        return (self.attrs.get("class") or "").split()


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node(None)
        self.stack = [self.root]

    def handle_starttag(self, tag, attrs):
        node = Node(tag, {k: ("" if v is None else v) for k, v in attrs}, self.stack[-1])
        self.stack[-1].children.append(node)
        if tag not in VOID:
            self.stack.append(node)

    def handle_startendtag(self, tag, attrs):
        node = Node(tag, {k: ("" if v is None else v) for k, v in attrs}, self.stack[-1])
        self.stack[-1].children.append(node)

    def handle_endtag(self, tag):
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i].tag == tag:
                del self.stack[i:]
                return

    def handle_data(self, data):
        kids = self.stack[-1].children
        if kids and isinstance(kids[-1], str):
            kids[-1] += data
        else:
            kids.append(data)

    def handle_comment(self, data):
        self.stack[-1].children.append(Node("#comment"))


def parse_stdlib(html: str) -> Node:
    """The tree through ``html.parser`` (the reference tokenizer)."""
    b = _Builder()
    b.feed(html)
    b.close()
    return b.root


# A single-pass tokenizer with the same results on the pages we handle, about
# three times faster than html.parser: comments, declarations, start tags
# with attributes, end tags, raw-text elements, text with character references.
_TOKEN = re.compile(
    r"<!--(.*?)(?:-->|\Z)"                          # 1 comment
    r"|<![^>]*>?"                                    # declaration / doctype
    r"|<\?[^>]*>?"                                   # processing instruction
    r"|</([a-zA-Z][^\s/>]*)[^>]*>"                   # 2 end tag
    r"|<([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"  # 3 start tag, 4 attributes
    r"|([^<]+|<)",                                   # 5 text
    re.S,
)
_ATTR = re.compile(r"""([^\s=/>][^\s=>]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_RAW_TEXT = ("script", "style")


def parse(html: str) -> Node:
    root = Node(None)
    stack = [root]
    pos, n = 0, len(html)
    while pos < n:
        m = _TOKEN.match(html, pos)
        pos = m.end()
        text, start, end = m.group(5), m.group(3), m.group(2)
        top = stack[-1]
        if text is not None:
            t = unescape(text) if "&" in text else text
            kids = top.children
            if kids and isinstance(kids[-1], str):
                kids[-1] += t
            else:
                kids.append(t)
        elif start is not None:
            tag = start.lower()
            raw = m.group(4) or ""
            attrs, used = {}, 0
            for a in _ATTR.finditer(raw):
                used = a.end()
                name = a.group(1).lower()
                if name == "/":
                    continue
                v = a.group(2) if a.group(2) is not None else a.group(3) if a.group(3) is not None else a.group(4)
                v = "" if v is None else (unescape(v) if "&" in v else v)
                attrs[name] = v  # of equal names the last counts
            selfclose = raw[used:].rstrip().endswith("/")  # a slash inside an unquoted value is part of it
            node = Node(tag, attrs, top)
            top.children.append(node)
            if tag in _RAW_TEXT:
                close = re.compile(rf"</{tag}\s*>", re.I).search(html, pos)
                body_end = close.start() if close else n
                if body_end > pos:
                    node.children.append(html[pos:body_end])
                pos = close.end() if close else n
            elif tag not in VOID and not selfclose:
                stack.append(node)
        elif end is not None:
            tag = end.lower()
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    del stack[i:]
                    break
        elif m.group(1) is not None:
            top.children.append(Node("#comment"))
    return root
