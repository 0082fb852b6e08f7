"""HTML books to pages: text, spans, titles, header fields, raw byte ranges.

The tree is built on the standard library's parser with a minimal repair: void elements close themselves, a p closes an
open p, an end tag closes up to its element or is dropped if there is none. Offsets are code points, the end exclusive.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html.parser import HTMLParser

# Page marker in raw bytes, class names, block tags, numbering, encodings, metadata lines.
MARKER = rb"<div\b[^>]*\bclass\s*=\s*['\"][^'\"]*\bPageText\b[^'\"]*['\"][^>]*>"
PAGE, HEADER, PART, LABEL = "PageText", "PageHead", "PartName", "PageNumber"
BLOCKS = "div p br li tr h1 h2 h3 h4 hr".split()
VOID = "area base br col embed hr img input link meta source track wbr".split()
NUMBERED = "^[\\s\u200b-\u200f]*(?:[\\d٠-٩]{1,6})\\s*[-–ـ]"
ENCODINGS = ("utf-8-sig", "cp1256")
META_LINE = r"\s*([^:：]{2,45})\s*[:：]\s*(.+)"
TITLE = "<title>([^<]*)</title>"

_MARKER, _NUMBERED, _META, _TITLE = re.compile(MARKER, re.I), re.compile(NUMBERED), re.compile(META_LINE), re.compile(TITLE)


@dataclass
class Node:
    tag: str
    attrs: dict[str, str]
    parts: list[Node | str] = field(default_factory=list)

    @property
    def classes(self) -> list[str]:
        return self.attrs.get("class", "").split()

    def walk(self):
        yield self
        for x in self.parts:
            if isinstance(x, Node):
                yield from x.walk()

    def content(self) -> str:
        return "".join(x if isinstance(x, str) else x.content() for x in self.parts)

    def first(self, name: str) -> Node | None:
        return next((n for n in self.walk() if n is not self and name in n.classes), None)


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("", {})
        self.open = [self.root]

    def handle_starttag(self, tag, attrs):
        if tag == "p":
            self._close("p", {"div", "td", "th", "li", "body"})
        node = Node(tag, {k: v or "" for k, v in attrs})
        self.open[-1].parts.append(node)
        if tag not in VOID:
            self.open.append(node)

    def handle_startendtag(self, tag, attrs):
        self.open[-1].parts.append(Node(tag, {k: v or "" for k, v in attrs}))

    def handle_endtag(self, tag):
        self._close(tag, set())

    def handle_data(self, data):
        self.open[-1].parts.append(data)

    def _close(self, tag: str, walls: set[str]):
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag == tag:
                del self.open[i:]
                return
            if self.open[i].tag in walls:
                return


def decode(raw: bytes) -> tuple[str, str]:
    """Text and encoding, without loss; raises ValueError if neither encoding fits."""
    for name in ENCODINGS:
        try:
            return raw.decode(name), name
        except UnicodeDecodeError:
            continue
    raise ValueError("neither " + " nor ".join(ENCODINGS) + " fits")


class _Page:
    """A page's text as it is written out, and the spans that come up on the way."""

    def __init__(self):
        self.chunks: list[str] = []
        self.length = 0
        self.spans: list[tuple[str, int, int, str | None]] = []
        self.titles: list[tuple[int, int]] = []
        self.numbers: list[int] = []

    def put(self, s: str):
        if s:
            self.chunks.append(s)
            self.length += len(s)

    def fresh_line(self):
        if self.chunks and not self.chunks[-1].endswith("\n"):
            self.put("\n")

    def visit(self, node: Node, in_note: bool):
        if node.tag in ("script", "style") or HEADER in node.classes:
            return
        block, note, anchor = node.tag in BLOCKS, "footnote" in node.classes, node.attrs.get("id")
        title = "title" in node.classes or node.attrs.get("data-type") == "title"
        numbered = "punct" in node.classes and bool(_NUMBERED.match(node.content()))
        if block or title or numbered:
            self.fresh_line()
        start = self.length
        if numbered and not in_note:
            self.numbers.append(start)
        for x in node.parts:
            if isinstance(x, str):
                self.put(x)
            else:
                self.visit(x, in_note or note)
        if self.length > start:
            if title:
                self.spans.append(("heading", start, self.length, anchor))
                if not in_note:
                    self.titles.append((start, self.length))
            if note:
                self.spans.append(("footnote", start, self.length, anchor))
        if anchor and not title and not (note and self.length > start):
            self.spans.append(("anchor", start, self.length, anchor))
        if block or title:
            self.fresh_line()
        elif node.tag in ("td", "th"):
            self.put("\t")


def page_of(node: Node) -> dict:
    p = _Page()
    p.visit(node, False)
    named = {k: (n.content() if (n := node.first(c)) else None) for k, c in (("header", HEADER), ("part", PART), ("label", LABEL))}
    return {"text": "".join(p.chunks), "spans": p.spans, "titles": p.titles, "number_starts": p.numbers, "anchor": node.attrs.get("id"), **named}


def metadata(text: str) -> dict[str, str]:
    """`key: value` lines of a first page; the last of equal keys wins."""
    found = (_META.match(line) for line in re.sub(r":\s*\n", ": ", text).splitlines())
    return {m[1].strip(): m[2].strip() for m in found if m}


def parse(raw: bytes) -> dict:
    """encoding, fallback, metadata, pages, source_title of one file; pages have ordinal, raw_start and raw_end beside
    page_of()'s fields. source_title is the title as it is written, with its character references, of which many spell one
    character and some are cut short.

    Without a marked page the body is one page. Marked pages must be as many as markers in the raw bytes.
    """
    text, encoding = decode(raw)
    b = _Builder()
    b.feed(re.sub(r"</p\s*>", "\n</p>", text, flags=re.I))  # an unmatched </p> is a visible line end too
    b.close()
    nodes = [n for n in b.root.walk() if PAGE in n.classes]
    marks = [m.start() for m in _MARKER.finditer(raw)]
    fallback = not nodes
    if fallback:
        nodes = [next((n for n in b.root.walk() if n.tag == "body"), b.root)]
    if marks and len(marks) != len(nodes):
        raise ValueError(f"{len(marks)} page markers, {len(nodes)} pages")
    pages = [page_of(n) for n in nodes]
    bounds = [*marks, len(raw)] if marks else [0, len(raw)]
    for i, p in enumerate(pages):
        p |= {"ordinal": i, "raw_start": bounds[i] if marks else 0, "raw_end": bounds[i + 1] if marks else len(raw)}
    title = next((n for n in b.root.walk() if n.tag == "title"), None)
    return {"encoding": encoding, "fallback": fallback, "metadata": metadata(pages[0]["text"]) | {"_html_title": title.content() if title else ""}, "pages": pages, "markers": len(marks), "source_title": m[1] if (m := _TITLE.search(text)) else ""}
