"""A small forgiving HTML tree: elements, their attribute tokens, and text pieces by block."""

from __future__ import annotations

import re
from html import unescape

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)""", re.S)
_ATTR = re.compile(r"""(?:^|\s)(id|class|role|itemprop|aria-label|type)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_PIECES = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
# fixed values of the HTML standard: elements without content, raw text, and blocks
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style noscript iframe template svg".split())
PLAIN = frozenset("title textarea".split())
BLOCK = frozenset("""address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form
h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td
tfoot th thead title tr ul button select textarea""".split())
_ENDS_P = BLOCK - frozenset("body head html title button select option optgroup textarea legend summary figcaption tr td th tbody thead tfoot".split())
# an opening tag ends open elements of these names, up to the listed container
_CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}),
           "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"}), "body": ({"head"}, set())}


class Page:
    """Elements in page order (0 is the root) and text pieces (element, block, text)."""

    def __init__(self, html: str | None):
        self.tag, self.parent, self.depth, self.tokens = ["#root"], [-1], [0], [[]]
        self.pieces: list[tuple[int, int, str]] = []
        self.block = 0
        self._parse(html or "")

    def _open(self, tag: str, attrs: str, stack: list[int]) -> int:
        i = len(self.tag)
        self.tag.append(tag)
        self.parent.append(stack[-1])
        self.depth.append(len(stack))
        self.tokens.append([p.lower() for m in _ATTR.finditer(attrs) for p in _PIECES.findall(m[2] or m[3] or m[4] or "")] if attrs else [])
        return i

    def _parse(self, html: str) -> None:
        stack, at, tags = [0], 0, self.tag
        while True:
            m = _TOKEN.search(html, at)
            if m is None:
                break
            if m.start() > at:
                self.pieces.append((stack[-1], self.block, unescape(html[at:m.start()])))
            at = m.end()
            tag = m[2] or m[5]
            if tag is None:
                continue
            tag, end, attrs = tag.lower(), m[1] or m[4], m[3] or m[6]
            if tag in BLOCK:
                self.block += 1
            elif tag == "br":
                self.pieces.append((stack[-1], self.block, " "))
            if end:
                for k in range(len(stack) - 1, 0, -1):
                    if tags[stack[k]] == tag:
                        del stack[k:]
                        break
                continue
            if tag in _ENDS_P:
                self._close(stack, {"p"}, {"table", "td", "th", "button"})
            if tag in _CLOSES:
                self._close(stack, *_CLOSES[tag])
            i = self._open(tag, attrs or "", stack)
            if tag in RAW or tag in PLAIN:
                close = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I).search(html, at)
                stop = close.start() if close else len(html)
                if tag in PLAIN:
                    self.pieces.append((i, self.block, unescape(html[at:stop])))
                    self.block += 1
                at = stop
                if close:
                    at = html.find(">", stop) + 1 or len(html)
            elif tag not in VOID and not (attrs or "").rstrip().endswith("/"):
                stack.append(i)
        if at < len(html):
            self.pieces.append((stack[-1], self.block, unescape(html[at:])))

    def _close(self, stack: list[int], names: set, until: set) -> None:
        for k in range(len(stack) - 1, 0, -1):
            tag = self.tag[stack[k]]
            if tag in names:
                del stack[k:]
                return
            if tag in until:
                return

    def text(self, keep) -> str:
        """Kept pieces: white space as one space, blocks on lines of their own, empty ones left out."""
        out, block, held = [], None, []
        for i, b, t in self.pieces:
            if keep[i]:
                if b != block:
                    out.append(" ".join("".join(held).split()))
                    block, held = b, []
                held.append(t)
        out.append(" ".join("".join(held).split()))
        return "\n".join(t for t in out if t)
