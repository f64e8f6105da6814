"""HTML -> Markdown (E2), ATX headings, for the element subset listing pages
use: headings, paragraphs and block containers, links, lists, emphasis,
``hr``, ``br``, code and images. Text is whitespace-collapsed and ``*`` /
``_`` are escaped; blocks are separated by at most one blank line.
Script, style and noscript are removed before (E1)."""

from __future__ import annotations

import re

from .htmltree import Node, parse

BLOCK = frozenset("p blockquote article div section ol ul li dl dt dd table thead tbody tfoot tr td th nav header "
                  "footer main aside".split())
HEADING = re.compile(r"^h([1-6])$")
_NEWLINE_WS = re.compile(r"[\t \r\n]*[\r\n][\t \r\n]*")
_WS = re.compile(r"[\t ]+")
_ALL_WS = re.compile(r"[\t \r\n]+")
_EDGE_NL = re.compile(r"^(\n*)((?:.*[^\n])?)(\n*)$", re.S)


def _is_block(n) -> bool:
    return isinstance(n, Node) and n.tag is not None and (n.tag in BLOCK or bool(HEADING.match(n.tag)) or
                                                          n.tag in ("pre", "hr", "br"))


def _chomp(text: str):
    pre = " " if text[:1] == " " else ""
    suf = " " if text[-1:] == " " else ""
    return pre, suf, text.strip()


def _text(node: str, parent: Node, idx: int, ctx: frozenset) -> str:
    text = node
    if "pre" not in ctx:
        text = _NEWLINE_WS.sub("\n", text)
        text = _WS.sub(" ", text)
        text = text.replace("*", r"\*").replace("_", r"\_") if "_noformat" not in ctx else text
        sibs = parent.children
        prev = sibs[idx - 1] if idx > 0 else None
        nxt = sibs[idx + 1] if idx + 1 < len(sibs) else None
        if _is_block(prev) or (prev is None and _is_block(parent)):
            text = text.lstrip(" \t\r\n")
        if _is_block(nxt) or (nxt is None and _is_block(parent)):
            text = text.rstrip(" \t\r\n")
    return text


def _append(out: list, s: str) -> None:
    """Join a rendered child to its parent's pieces, with at most one blank line between."""
    if not s:
        return
    lead, body, trail = _EDGE_NL.match(s).groups()
    if out[-1] and lead:
        prev_trail = out.pop()
        lead = "\n" * min(2, max(len(prev_trail), len(lead)))
    out.extend([lead, body, trail])


def _inner(tag: str, ctx: frozenset) -> frozenset:
    """The context of an element's children."""
    ctx = ctx | {tag}
    if HEADING.match(tag) or tag in ("td", "th"):
        ctx = ctx | {"_inline"}
    if tag in ("pre", "code", "kbd", "samp"):
        ctx = ctx | {"_noformat"}
    return ctx


def _render(root: Node) -> str:
    """Children before their element, on a stack of our own: a page may nest as deep as it likes."""
    frames = [(root, frozenset(), frozenset(), [""], iter(enumerate(root.children)))]
    while True:
        node, ctx, inner, out, rest = frames[-1]
        i, child = next(rest, (-1, None))
        if child is None:
            frames.pop()
            text = "".join(out)
            if not frames:
                return text
            _append(frames[-1][3], _wrap(node, ctx, text))
        elif isinstance(child, str):
            _append(out, _text(child, node, i, inner))
        elif child.tag != "#comment":
            frames.append((child, inner, _inner(child.tag, inner), [""], iter(enumerate(child.children))))


def _wrap(el: Node, ctx: frozenset, text: str) -> str:
    """The Markdown of an element from that of its children."""
    tag = el.tag
    h = HEADING.match(tag)
    inline = "_inline" in ctx
    if h:
        if inline:
            return text
        return f"\n\n{'#' * int(h.group(1))} {_ALL_WS.sub(' ', text.strip())}\n\n"
    if tag in ("p", "div", "article", "section"):
        if inline:
            return f" {text.strip()} "
        text = text.strip()
        return f"\n\n{text}\n\n" if text else ""
    if tag == "a":
        if "_noformat" in ctx:
            return text
        pre, suf, t = _chomp(text)
        if not t:
            return ""
        href = el.attrs.get("href")
        title = el.attrs.get("title")
        if href and t.replace(r"\_", "_") == href and not title:
            return f"<{href}>"
        tpart = ' "%s"' % title.replace('"', r"\"") if title else ""
        return f"{pre}[{t}]({href}{tpart}){suf}" if href else t
    if tag in ("b", "strong", "em", "i"):
        if "_noformat" in ctx:
            return text
        pre, suf, t = _chomp(text)
        if not t:
            return ""
        mark = "**" if tag in ("b", "strong") else "*"
        return f"{pre}{mark}{t}{mark}{suf}"
    if tag == "br":
        return "" if inline else "  \n"
    if tag == "hr":
        return "\n\n---\n\n"
    if tag in ("ul", "ol"):
        return f"\n\n{text}\n\n" if not inline else text
    if tag == "li":
        parent = el.parent
        bullet = "* "
        if parent is not None and parent.tag == "ol":
            items = [c for c in parent.children if isinstance(c, Node) and c.tag == "li"]
            bullet = f"{items.index(el) + 1}. "
        body = text.strip()
        body = body.replace("\n", "\n" + " " * len(bullet))
        return f"\n{bullet}{body}\n"
    if tag == "code":
        return f"`{text}`" if text and "pre" not in ctx else text
    if tag == "pre":
        return f"\n\n```\n{text}\n```\n\n" if text else ""
    if tag == "blockquote":
        t = text.strip()
        return "\n\n" + "\n".join("> " + line if line else ">" for line in t.split("\n")) + "\n\n" if t else ""
    if tag == "img":
        alt = el.attrs.get("alt", "")
        src = el.attrs.get("src", "")
        return f"![{alt}]({src})"
    return text


def html_to_markdown(html: str) -> str:
    """Markdown of an HTML page (already stripped of script/style/noscript)."""
    root = parse(html or "")
    return _render(root).strip("\n")
