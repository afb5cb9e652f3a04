"""A scanner of HTML whose time is in proportion to the page.

It never goes back over what it has read: what has no end (a comment, a tag, a script) runs to the end of the page, as in browsers, so
that nothing is looked for twice.
"""

from __future__ import annotations

import re
from html import unescape
from typing import Protocol

#: Elements whose content is text up to their end tag.
RAW = ("script", "style")
_SPACE = "\t\n\f\r "
_TAG = re.compile(r"[A-Za-z][^\t\n\f\r />]*+")
#: White space and slashes, then the tag's end, or an attribute; its value may be quoted.
_PART = re.compile(r"""([\t\n\f\r /]*+)(?:(>)|([^\t\n\f\r />][^\t\n\f\r />=]*+)(?:[\t\n\f\r ]*+=[\t\n\f\r ]*+(?:"([^"]*+)"|'([^']*+)'|(?!["'])([^\t\n\f\r >]*+)))?+)""")
#: A quoted value that has no end follows.
_OPEN_VALUE = re.compile(r"""[\t\n\f\r ]*+=[\t\n\f\r ]*+["']""")
_END_OF_RAW = {tag: re.compile(rf"</{tag}(?=[\t\n\f\r />])", re.I) for tag in RAW}


class Sink(Protocol):
    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None: ...
    def handle_endtag(self, tag: str) -> None: ...
    def handle_data(self, data: str) -> None: ...


def _parts(html: str, at: int, wanted: bool) -> tuple[int, list[tuple[str, str | None]], bool]:
    """Where a tag ends (-1: nowhere), its attributes if wanted, and whether it closes itself."""
    attrs: list[tuple[str, str | None]] = []
    while m := _PART.match(html, at):
        at = m.end()
        if m[2]:
            return at, attrs, m[1].endswith("/")
        value = m[4] if m[4] is not None else m[5] if m[5] is not None else m[6]
        if value is None and _OPEN_VALUE.match(html, at):
            return -1, attrs, False
        if wanted:
            attrs.append((m[3].lower(), None if value is None else unescape(value)))
    return -1, attrs, False


def scan(html: str, sink: Sink) -> None:
    """Hands tags and text to the sink in page order; character references are decoded, but not in RAW elements. A tag that closes
    itself is a start and an end; comments, declarations and instructions are left out."""
    at, n, text_from = 0, len(html), 0

    def text(end: int) -> None:
        if end > text_from:
            data = html[text_from:end]
            sink.handle_data(unescape(data) if "&" in data else data)

    while (at := html.find("<", at)) >= 0:
        after = html[at + 1 : at + 2]
        if after.isascii() and after.isalpha():
            m = _TAG.match(html, at + 1)
            text(at)
            end, attrs, closed = _parts(html, m.end(), True)
            if end < 0:
                return
            tag = m[0].lower()
            sink.handle_starttag(tag, attrs)
            at = text_from = end
            if closed:
                sink.handle_endtag(tag)
            elif tag in RAW:
                m = _END_OF_RAW[tag].search(html, at)
                at = m.start() if m else n
                if at > text_from:
                    sink.handle_data(html[text_from:at])
                text_from = at
        elif after == "/":
            text(at)
            m = _TAG.match(html, at + 2)
            end = _parts(html, m.end(), False)[0] if m else html.find(">", at + 2) + 1 or -1
            if end < 0:
                return
            at = text_from = end
            if m:
                sink.handle_endtag(m[0].lower())
        elif after == "!" or after == "?":
            text(at)
            if html.startswith("<!--", at):
                if html.startswith(("<!-->", "<!--->"), at):
                    end = html.find(">", at) + 1
                else:
                    end = html.find("-->", at + 4) + 3
                    end = end if end > 2 else 0
            else:
                end = html.find(">", at + 2) + 1
            if not end:
                return
            at = text_from = end
        else:
            at += 1
    text(n)
