"""Pages as leaf blocks: runs of inline text between block boundaries, with the tags and names of their ancestors."""

from __future__ import annotations

import html
import re

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>"
    r"|<(?P<close>/?)(?P<name>[A-Za-z][^\s/>]*)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<close2>/?)(?P<name2>[A-Za-z][^\s/>]*)(?P<attrs2>[^>]*)>",
    re.S,
)
_NAMES = re.compile(r"(?:^|\s)(class|id|role|itemprop|data-mark|hidden|aria-hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)

#: Elements whose content is no text of the page, up to their end tag. Without one, those of TO_END take the rest of the page, the others nothing.
RAW = frozenset("script style title textarea noscript template iframe svg annotation annotation-xml object canvas xmp noembed noframes select datalist".split())
TO_END = frozenset("script style title textarea".split())
#: Elements that begin and end a block.
BLOCK = frozenset(
    "html head body article section main nav header footer aside div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table caption thead tbody tfoot tr td th form fieldset legend label "
    "button blockquote pre figure figcaption address details summary dialog hr center menu hgroup search option".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: What an opening tag ends when it is still open, up to the nearest of the given walls.
_ENDS = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu"])),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "tr": (frozenset(["tr"]), frozenset(["table"])),
    "td": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "th": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "option": (frozenset(["option"]), frozenset(["select"])),
}
_CLOSES_P = BLOCK - {"label", "button", "html", "head", "body", "option"}
_P = (frozenset(["p"]), frozenset("article section main nav header footer aside div ul ol li table td th form blockquote body button".split()))


class Block:
    __slots__ = ("text", "tags", "names", "linked", "mark")

    def __init__(self, text: str, tags: list[str], names: list[str], linked: int, mark: str):
        self.text, self.tags, self.names, self.linked, self.mark = text, tags, names, linked, mark


def _end(stack: list[tuple[str, str, str]], what: tuple[frozenset, frozenset]) -> None:
    ends, walls = what
    for i in range(len(stack) - 1, -1, -1):
        if stack[i][0] in ends:
            del stack[i:]
            return
        if stack[i][0] in walls:
            return


def _ends_of(page: str, name: str) -> dict[int, int]:
    """Where an element ends, by the end of its opening tag; unclosed ones have no entry, and comments and TO_END count for nothing."""
    out: dict[int, int] = {}
    stack: list[int] = []
    tag = re.compile(rf"<!--.*?(?:-->|\Z)|<({'|'.join(sorted(TO_END))})(?=[\s/>]).*?(?:</\1(?=[\s/>])|\Z)|<(/?){re.escape(name)}(?=[\s/>])((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>", re.I | re.S)
    for m in tag.finditer(page):
        if m[2] is None:
            continue
        if m[2]:
            if stack:
                out[stack.pop()] = m.end()
        elif not (name == "svg" and m[3].endswith("/")):
            stack.append(m.end())
    return out


def blocks(page: str) -> list[Block]:
    """Leaf blocks of a page, in page order; character references decoded, white space one space, empty blocks left out. Hidden elements have none."""
    out: list[Block] = []
    stack: list[tuple[str, str, str]] = []  # tag, names, mark
    parts: list[str] = []
    linked = 0
    where: list[tuple[str, str, str]] | None = None
    ends: dict[str, dict[int, int]] = {}

    def flush() -> None:
        nonlocal linked, where
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                at = stack if where is None else where
                out.append(Block(text, [t for t, *_ in at], [n for _, n, _ in at if n], min(linked, len(text)), next((m for *_, m in reversed(at) if m), "")))
            parts.clear()
        linked, where = 0, None

    def text(s: str) -> None:
        nonlocal linked, where
        if s and not any(n == "\0" for _, n, _ in stack):
            if where is None and not s.isspace():
                where = list(stack)
            parts.append(s)
            if any(t == "a" for t, *_ in stack):
                linked += len(s.strip())

    at, n = 0, len(page)
    while at < n:
        m = _TAG.search(page, at)
        if not m:
            text(page[at:])
            break
        text(page[at : m.start()])
        at = m.end()
        name = (m["name"] or m["name2"] or "").lower()
        if not name:
            continue
        close, attrs = (m["close"], m["attrs"]) if m["name"] else (m["close2"], m["attrs2"])
        if close:
            if name in BLOCK:
                flush()
            if name == "p" and not any(t == "p" for t, *_ in stack):
                continue
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    if name not in BLOCK and any(t in BLOCK for t, *_ in stack[i + 1 :]):
                        break
                    if name in BLOCK:
                        del stack[i:]
                    else:
                        del stack[i]
                    break
            continue
        if name in RAW:
            flush() if name in ("title", "textarea", "select") else None
            if name in TO_END:
                found = re.compile(rf"</{name}\b[^>]*>", re.I).search(page, at)
                at = found.end() if found else n
            elif not (name == "svg" and attrs.endswith("/")):
                if name not in ends:
                    ends[name] = _ends_of(page, name)
                at = ends[name].get(at, at)
            continue
        if name == "br":
            parts.append(" ") if parts else None
            continue
        if name in BLOCK:
            flush()
            if name in _CLOSES_P:
                _end(stack, _P)
            if name in _ENDS:
                _end(stack, _ENDS[name])
        if name in VOID or attrs.rstrip().endswith("/") and name not in BLOCK:
            continue
        names, mark, hidden = [], "", False
        for a in _NAMES.finditer(attrs) if attrs else ():
            key, value = a[1].lower(), (a[2] or a[3] or a[4] or "")
            if key == "data-mark":
                mark = value
            elif key == "hidden" or key == "aria-hidden" and value.lower() == "true" or key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
                hidden = True
            elif key != "style":
                names.append(value.lower())
        stack.append((name, "\0" if hidden else " ".join(names), mark))
    flush()
    return out
