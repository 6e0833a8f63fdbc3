"""HTML by a tokenizer and a state machine over Arrow batches; documents cut into chunks under a token budget.

A page is read once from left to right: comments, declarations, tags with their attributes (in any order, any quoting or none), raw text of
script, style and the like, and text. What reads it keeps a few flags, so nested, unclosed and stray tags are no special case, and a reader
that has what it wants stops.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

from ..sources.shared import ship
from .documents import CAPTION_MARKERS, HEADING_MARKERS, coalesce_rows

_TAG = re.compile(
    r"<!--(?P<comment>.*?)(?:--!?>|\Z)|<[!?](?P<decl>[^>]*)(?:>|\Z)|</(?P<close>[A-Za-z][^\s/>]*)[^>]*(?:>|\Z)"
    r"|<(?P<open>[A-Za-z][^\s/>]*)(?P<attrs>(?:[^<>\"']|\"[^\"]*\"|'[^']*')*+)>|<(?P<loose>[A-Za-z][^\s/>]*)(?P<rest>[^<>]*)>",
    re.DOTALL,
)
_ATTR = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_SPACE = re.compile(r"\s+")
#: Elements whose content is not markup, and of these those whose content is no text of the page.
RAW = ("script", "style", "textarea", "title", "noscript", "template", "iframe")
HIDDEN = ("script", "style", "noscript", "template", "iframe")
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*(?:>|\Z)", re.IGNORECASE) for name in RAW}
#: Elements that end a block of text.
BLOCKS = frozenset(("p", "div", "section", "article", "header", "footer", "main", "nav", "aside", "ul", "ol", "li", "dl", "dt", "dd", "table", "tr", "td", "th", "pre", "blockquote", "form", "figure", "figcaption", "br", "hr", "h1", "h2", "h3", "h4", "h5", "h6", "body"))
PREVIEW = 500


def attributes(text: str) -> dict[str, str]:
    """Attributes of a tag, by lower-case name; the first of a name counts, one without a value is empty."""
    out: dict[str, str] = {}
    for m in _ATTR.finditer(text):
        out.setdefault(m[1].lower(), unescape(next((v for v in m.groups()[1:] if v is not None), "")))
    return out


def tokens(html: str) -> Iterator[tuple[str, str, str, int]]:
    """(kind, name, text, place): `open` with the attributes' text, `close`, `raw` with the content of its element, `text`; comments and declarations are left out. A `<` that opens no tag is text."""
    at = 0
    while at < len(html):
        m = _TAG.search(html, at)
        if m is None:
            yield "text", "", html[at:], at
            return
        if m.start() > at:
            yield "text", "", html[at : m.start()], at
        at = m.end()
        if m["close"] is not None:
            yield "close", m["close"].lower(), "", m.start()
        elif m["open"] is not None or m["loose"] is not None:
            name, attrs = (m["open"] or m["loose"]).lower(), m["attrs"] if m["open"] is not None else m["rest"]
            yield "open", name, attrs, m.start()
            if name in RAW and not attrs.endswith("/"):
                end = _RAW_END[name].search(html, at)
                yield "raw", name, html[at : end.start() if end else len(html)], at
                at = end.end() if end else len(html)


def page_facts(html: str, preview: int = PREVIEW) -> dict[str, str | None]:
    """title, description, keywords, lang and the start of the body's text (of all that is not head, where there is no body); stops once it has the text."""
    out: dict[str, str | None] = dict.fromkeys(("title", "description", "keywords", "lang", "preview"))
    has_body, in_head, in_body, parts, size = "<body" in html.lower(), False, False, [], 0
    for kind, name, text, _ in tokens(html):
        if kind == "open":
            if name == "html" and out["lang"] is None:
                out["lang"] = attributes(text).get("lang") or None
            elif name == "meta":
                a = attributes(text)
                key = a.get("name", "").strip().lower()
                if key in ("description", "keywords") and out[key] is None:
                    out[key] = a.get("content", "") or None
            elif name == "head":
                in_head = True
            elif name == "body":
                in_body, in_head = True, False
            parts.append(" ")
        elif kind == "close":
            in_head = in_head and name != "head"
            in_body = in_body and name != "body"
            parts.append(" ")
        elif kind == "raw" and name == "title" and out["title"] is None:
            out["title"] = _SPACE.sub(" ", unescape(text)).strip() or None
        elif (kind == "text" or name not in (*HIDDEN, "title")) and (in_body or not has_body and not in_head):
            parts.append(text)
            size += len(text)
            if size > 4 * preview and in_body:
                got = _SPACE.sub(" ", unescape("".join(parts))).strip()
                if len(got) > preview:
                    break
    out["preview"] = _SPACE.sub(" ", unescape("".join(parts))).strip()[:preview]
    return out


def page_metadata(pages: DataFrame, key: str = "page_id", html: str = "html", preview: int = PREVIEW) -> DataFrame:
    """key, title, description, keywords, lang, preview of each page; null html gives nulls and an empty preview."""
    ship(pages.sparkSession)
    names = ("title", "description", "keywords", "lang", "preview")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            facts = [page_facts(x or "", preview) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([f[n] for f in facts], pa.string()) for n in names)], [key, *names])

    return pages.select(key, html).mapInArrow(run, f"{key} {pages.schema[key].dataType.simpleString()}, " + ", ".join(f"{n} string" for n in names))


def html_blocks(html: str) -> Iterator[tuple[tuple[str, ...], str, int]]:
    """(headings above, text, place) of each block of text of a page; headings are blocks, too."""
    path: list[tuple[int, str]] = []
    parts, start, level, in_head = [], None, 0, False

    def block():
        nonlocal parts, start, level
        text, place = _SPACE.sub(" ", unescape("".join(parts))).strip(), start
        parts, start, was, level = [], None, level, 0
        if not text:
            return None
        if was:
            path[:] = [h for h in path if h[0] < was]
        found = tuple(h for _, h in path), text, place
        if was:
            path.append((was, text))
        return found

    for kind, name, text, place in tokens(html):
        if kind in ("open", "close"):
            in_head = kind == "open" if name == "head" else in_head and name != "body"
            if name in BLOCKS:
                if found := block():
                    yield found
                if kind == "open" and len(name) == 2 and name[0] == "h" and name[1].isdigit():
                    level = int(name[1])
        elif not in_head and (kind == "text" or name not in (*HIDDEN, "title")):
            if start is None and text.strip():
                start = place
            parts.append(text)
    if found := block():
        yield found


def text_blocks(text: str) -> Iterator[tuple[tuple[str, ...], str, int]]:
    """The same of plain text: blocks end at blank lines, headings are lines that open with `#`, the deeper the more of them."""
    path: list[tuple[int, str]] = []
    lines, start, at = [], 0, 0
    for line in [*text.split("\n"), ""]:
        heading = line.lstrip().startswith("#")
        if lines and (heading or not line.strip()):
            yield tuple(h for _, h in path), "\n".join(lines), start
            lines = []
        if heading:
            level = len(line.lstrip()) - len(line.lstrip().lstrip("#"))
            path[:] = [h for h in path if h[0] < level]
            yield tuple(h for _, h in path), line.strip(), at
            path.append((level, line.strip().lstrip("#").strip()))
        elif line.strip():
            start = start if lines else at
            lines.append(line)
        at += len(line) + 1


def _count(text: str) -> int:
    return len(text.split())


def fitted(text: str, place: int, most: int) -> Iterator[tuple[str, int]]:
    """A text in pieces of at most `most` words, each up to its last sentence end in the second half of its room, where there is one."""
    words = list(re.finditer(r"\S+", text))
    i = 0
    while i < len(words):
        j = min(i + most, len(words))
        if j < len(words):
            stop = next((k for k in range(j, i + most // 2, -1) if words[k - 1][0][-1] in ".!?"), j)
            j = stop
        yield text[words[i].start() : words[j - 1].end()], place + words[i].start()
        i = j


def chunks_of(blocks: Iterator[tuple[tuple[str, ...], str, int]], least: int, most: int) -> list[dict]:
    """Chunks of at most `most` words: blocks under the same headings together while there is room, longer blocks in pieces, each after its headings; then runs of chunks under `least` are joined.

    Headings that leave less than half of the room are cut to the deepest ones that fit.
    """
    out: list[dict] = []
    held: list[tuple[str, int, int]] = []
    path: tuple[str, ...] = ()
    room = most

    def flush() -> None:
        if held:
            text = "\n".join([*path, *(t for t, *_ in held)])
            first = held[0][0]
            out.append({"text": text, "tokens": _count(text), "offset": held[0][1], "boundary": first.lstrip().startswith(HEADING_MARKERS + CAPTION_MARKERS), "refs": [], "pages": [], "confidence": 0.0, "sources": [s for *_, s in held], "headings": list(path)})
            held.clear()

    used = 0
    for n, (above, text, place) in enumerate(blocks):
        fit: tuple[str, ...] = ()
        for h in reversed(above):
            if _count(" ".join((h, *fit))) * 2 > most:
                break
            fit = (h, *fit)
        if fit != path:
            flush()
            path, used = fit, 0
        room = most - _count(" ".join(path))
        for piece, at in fitted(text, place, room):
            size = _count(piece)
            if held and used + size > room:
                flush()
                used = 0
            held.append((piece, at, n))
            used += size
    flush()
    return coalesce_rows(out, least, most)


CHUNK = "chunk int, text string, tokens int, offset int, headings array<string>"


def chunk_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", kind: str = "text", least: int = 64, most: int = 256) -> DataFrame:
    """Chunks (key, chunk, text, tokens, offset, headings) of whole documents of `kind` text or html: at most `most` words each, in order; offset is where the first block starts. Null and empty documents have none."""
    ship(docs.sparkSession)
    cut: Callable = {"text": text_blocks, "html": html_blocks}[kind]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                some = batch.slice(at, 64)
                rows = [(k, i, c["text"], c["tokens"], c["offset"], c.get("headings", [])) for k, x in zip(some.column(0), some.column(1).to_pylist()) for i, c in enumerate(chunks_of(cut(x or ""), least, most))]
                if rows:
                    types = (some.column(0).type, pa.int32(), pa.string(), pa.int32(), pa.int32(), pa.list_(pa.string()))
                    yield pa.RecordBatch.from_arrays([pa.array([v.as_py() if i == 0 else v for v in c], t) for i, (c, t) in enumerate(zip(zip(*rows), types))], [key, *(n.split()[0] for n in CHUNK.split(", "))])

    return docs.select(key, text).mapInArrow(run, f"{key} {docs.schema[key].dataType.simpleString()}, {CHUNK}")
