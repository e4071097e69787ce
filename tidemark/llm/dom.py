"""Leaf blocks of a web page: the text between block boundaries, with its ancestors."""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass

# Tags whose text is none of the page's, and tags inside a line of text.
HIDDEN = {"script", "style", "noscript", "template", "head", "title", "svg", "iframe", "select", "textarea", "button", "object", "canvas", "audio", "video"}
INLINE = {
    "a", "abbr", "b", "bdi", "bdo", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd",
    "label", "mark", "q", "s", "samp", "small", "span", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "input",
}
VOID = {"area", "base", "col", "embed", "hr", "input", "link", "meta", "param", "source", "track", "br", "img", "wbr"}
# Hidden tags whose content is plain text up to their end tag; of script and style also where that is missing.
RAW = {"script", "style", "title", "textarea", "iframe", "noscript"}
CODE = {"script", "style"}
# Tags that may stand in a head; any other ends it.
IN_HEAD = {"base", "basefont", "bgsound", "link", "meta", "noframes", "noscript", "script", "style", "template", "title"}
# Start tags that end a hidden element without end tag of its own.
FLOW = HIDDEN | {
    "address", "article", "aside", "blockquote", "body", "center", "dd", "details", "dialog", "div", "dl", "dt", "fieldset", "figcaption",
    "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "html", "li", "main", "menu", "nav", "ol",
    "p", "pre", "search", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
}
# A start tag that ends an open element of the same group.
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|</?[a-zA-Z](?:[^<>\"']|\"[^\"]*\"|'[^']*')*>|</?[a-zA-Z][^>]*(?:>|\Z)|[^<]+|<", re.S
)
# The end of raw text. Another start tag of the same name tells that the end is missing; code may hold one.
_RAW_END = {n: re.compile(rf"<{'/' if n in CODE else '/?'}{n}(?=[\s/>])", re.I) for n in RAW}
_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_MARKS = re.compile(r"(?:class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)


@dataclass
class Block:
    """``path``: ancestors from the outside in, each its tag and name words."""

    path: tuple[tuple[str, ...], ...]
    text: str
    linked: int


def _names(tag: str) -> tuple[str, ...]:
    if "=" not in tag:
        return ()
    found = (a or b or c for a, b, c in _MARKS.findall(tag))
    return tuple(sorted({w for x in found for w in re.split(r"[^a-z]+", x.lower()) if w}))


def _tokens(page: str) -> list[tuple[str, bool, str]]:
    """(name, closing, token) of all tags and, without a name, texts; raw text
    is left out with its tags."""
    out, at = [], 0
    while m := _TOKEN.match(page, at):
        token, at = m[0], m.end()
        if token[0] != "<" or len(token) == 1:
            out.append(("", False, token))
            continue
        if token[1] in "!?":
            continue
        name, closing = _NAME.match(token)[1].lower(), token[1] == "/"
        if not closing and name in RAW and not token.endswith("/>"):
            end = _RAW_END[name].search(page, at)
            if end and end[0][1] == "/":
                at = page.find(">", end.end()) + 1 or len(page)
                continue
            if name in CODE:
                break
        out.append((name, closing, token))
    return out


def _ends(tokens: list[tuple[str, bool, str]]) -> dict[int, int]:
    """Start of each hidden element that has an end -> the token to go on with.
    An element that its parent's end tag closes has none."""
    out: dict[int, int] = {}
    open_: list[tuple[str, int]] = []
    count: Counter[str] = Counter()
    for i, (name, closing, token) in enumerate(tokens):
        if open_ and open_[-1][0] == "head" and (not closing and name not in IN_HEAD if name else token.strip()):
            count["head"] -= 1
            out[open_.pop()[1]] = i
        if not name or name in INLINE or name in VOID:
            continue
        if not closing:
            if not token.endswith("/>"):
                open_.append((name, i))
                count[name] += 1
        elif count[name]:
            top = ""
            while top != name:
                top, start = open_.pop()
                count[top] -= 1
            if name in HIDDEN:
                out[start] = i + 1
    return out


def blocks(page: str) -> list[Block]:
    """Non-empty blocks in page order. Character references are decoded; white
    space is one blank; unclosed elements end with the page. A hidden element
    without end tag ends with its parent or where a flow element begins."""
    out: list[Block] = []
    stack: list[tuple[str, ...]] = []
    open_: list[str] = []
    text: list[str] = []
    linked, in_link, hidden = 0, False, ""

    def flush() -> None:
        nonlocal linked
        if text:
            whole = " ".join(html.unescape("".join(text)).split())
            if whole:
                out.append(Block(tuple(stack), whole, min(linked, len(whole))))
            text.clear()
        linked = 0

    tokens = _tokens(page)
    go_on, i = _ends(tokens), 0
    while i < len(tokens):
        name, closing, token = tokens[i]
        i += 1
        if hidden:
            if closing and name == hidden:
                hidden = ""
                continue
            if not (name in open_ if closing else name in FLOW):
                continue
            hidden = ""
        if not name:
            text.append(token)
            if in_link:
                linked += len(token.strip())
            continue
        if not closing and name in HIDDEN and not token.endswith("/>"):
            # Nothing inside a hidden element counts but its end.
            if i - 1 in go_on:
                i = go_on[i - 1]
            else:
                hidden = name
            continue
        if name in INLINE:
            if name == "a":
                in_link = not closing
            elif name in ("br", "wbr"):
                text.append(" ")
            continue
        flush()
        in_link = False
        if closing:
            if name in open_:
                while open_.pop() != name:
                    stack.pop()
                stack.pop()
        elif name not in VOID:
            ends = SIBLINGS.get(name, ())
            if open_ and (open_[-1] == "p" or open_[-1] in ends):
                open_.pop(), stack.pop()
                if open_ and open_[-1] in ends:
                    open_.pop(), stack.pop()
            open_.append(name)
            stack.append((name, *_names(token)))
    flush()
    return out
