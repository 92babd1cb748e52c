"""Title, body text, paragraphs and links of one HTML page.

A small per-row helper for the extraction UDF: Spark reads, partitions and ships
the pages; this only walks one page with the standard library parser, once, and notes
which text pieces lie inside the elements of interest and where links lead.
"""

from __future__ import annotations

from html.parser import HTMLParser
from typing import NamedTuple

# Where a body is looked for, in order, and what holds no text.
BODY_TAGS = {"article": 0, "main": 3}
BODY_CLASSES = {"article-body": 1, "entry-content": 2, "content": 4}
SILENT_TAGS = frozenset({"script", "style", "template", "rt", "rp"})
VOID_TAGS = frozenset((
    "area base br col embed hr img input keygen link menuitem meta param source track wbr "
    "basefont bgsound command frame image isindex nextid spacer"
).split())
NO_TITLE = "No title"
# End of fixed values.


class _Spans(HTMLParser):
    """Numbers the non-empty text pieces and records the span of each element of interest."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.pieces: list[str] = []
        self.spans: dict[object, list[int]] = {}
        self.paragraphs: list[list[int]] = []
        self.links: list[str] = []
        self._open: list[tuple[str, list[list[int]]]] = []
        self._names: dict[str, int] = {}
        self._buffer: list[str] = []

    def _flush(self) -> None:
        if self._buffer:
            piece = "".join(self._buffer).strip()
            self._buffer.clear()
            if piece and not any(self._names.get(t) for t in SILENT_TAGS):
                self.pieces.append(piece)

    def _interest(self, tag: str, attrs) -> list[list[int]]:
        values = dict(attrs)
        if tag == "a" and "href" in values:
            self.links.append(values["href"] or "")
        keys: list[object] = [tag] if tag in ("h1", "title") else []
        if tag in BODY_TAGS:
            keys.append(BODY_TAGS[tag])
        for name in (values.get("class") or "").split():
            if name in BODY_CLASSES:
                keys.append(BODY_CLASSES[name])
        opened = []
        for key in keys:
            if key not in self.spans:
                self.spans[key] = [len(self.pieces), -1]
                opened.append(self.spans[key])
        if tag == "p":
            self.paragraphs.append([len(self.pieces), -1])
            opened.append(self.paragraphs[-1])
        return opened

    def handle_starttag(self, tag, attrs) -> None:
        self._flush()
        opened = self._interest(tag, attrs)
        if tag in VOID_TAGS:
            self._close(opened)
        else:
            self._open.append((tag, opened))
            self._names[tag] = self._names.get(tag, 0) + 1

    def handle_startendtag(self, tag, attrs) -> None:
        self._flush()
        self._close(self._interest(tag, attrs))

    def handle_endtag(self, tag) -> None:
        self._flush()
        while self._names.get(tag):
            name, opened = self._open.pop()
            self._names[name] -= 1
            self._close(opened)
            if name == tag:
                break

    def _close(self, opened: list[list[int]]) -> None:
        for span in opened:
            span[1] = len(self.pieces)

    def handle_data(self, data) -> None:
        self._buffer.append(data)

    def unknown_decl(self, data) -> None:
        self._flush()
        if data.upper().startswith("CDATA["):
            self._buffer.append(data[len("CDATA["):])
            self._flush()

    def _split(self, _data) -> None:
        self._flush()

    handle_comment = handle_decl = handle_pi = _split

    def text(self, span: list[int], joiner: str) -> str:
        end = len(self.pieces) if span[1] < 0 else span[1]
        return joiner.join(self.pieces[span[0]:end])


class PageParts(NamedTuple):
    """What one page holds; `links` are the `href` values of its `<a>` tags in order, decoded."""

    title: str
    text: str
    paragraphs: list[str]
    links: list[str]


def page_parts(html: str) -> PageParts:
    """The parts of a page from one pass.

    The title is the first h1, else the title element; the text is the first body element, else all paragraphs.
    """
    page = _Spans()
    page.feed(html)
    page.close()
    page._flush()
    heading = page.spans.get("h1") or page.spans.get("title")
    title = page.text(heading, "") if heading else NO_TITLE
    paragraphs = [page.text(p, "") for p in page.paragraphs]
    body = next((page.text(page.spans[rank], "\n") for rank in range(5) if rank in page.spans), "")
    return PageParts(title, body or "\n\n".join(paragraphs), paragraphs, page.links)


def title_and_body(html: str) -> tuple[str, str]:
    return page_parts(html)[:2]
