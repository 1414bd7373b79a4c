"""HTML to text and semantic chunks. Parsing needs the standard library's parser, so it runs in Arrow batches."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..arrow import arrow_map

#: Tags that are blocks of their own, tags whose content is no text.
BLOCKS = {"p", "div", "li", "ul", "ol", "table", "tr", "blockquote", "h1", "h2", "h3", "h4", "h5", "h6", "article", "section", "br", "hr", "body", "pre"}
SILENT = {"script", "style", "head", "template"}


class _Reader(HTMLParser):
    """Top-level blocks in order: (kind, text, heading)."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.blocks, self.text, self.kind, self.heading, self.silent = [], [], "text", None, 0

    def close_block(self) -> None:
        lines = [" ".join(x.split()) for x in "".join(self.text).split("\n")]
        body = "\n".join(x for x in lines if x)
        if body:
            if self.kind.startswith("h") and self.kind[1:].isdigit():
                self.heading = body
            self.blocks.append((self.kind, body, self.heading))
        self.text, self.kind = [], "text"

    def handle_starttag(self, tag: str, attrs) -> None:
        if tag in SILENT:
            self.silent += 1
        elif tag == "br":
            self.text.append("\n")
        elif tag in BLOCKS:
            self.close_block()
            self.kind = tag
            if tag == "li":
                self.text.append("- ")

    def handle_endtag(self, tag: str) -> None:
        if tag in SILENT:
            self.silent = max(0, self.silent - 1)
        elif tag in BLOCKS:
            self.close_block()

    def handle_data(self, data: str) -> None:
        if not self.silent:
            self.text.append(data.replace("\n", " "))


def blocks(html: str | None) -> list[tuple[str, str, str | None]]:
    r = _Reader()
    r.feed(html or "")
    r.close()
    r.close_block()
    return r.blocks


def to_text(html: str | None) -> str:
    return "\n".join(b for _, b, _ in blocks(html))


def _pack(found: list[tuple[str, str, str | None]], budget: int, least: int) -> list[tuple[str, str, str | None]]:
    """Long blocks are cut at blanks, short ones join the one before under the same heading."""
    out: list[tuple[str, str, str | None]] = []
    for kind, text, heading in found:
        while len(text) > budget:
            cut = text.rfind(" ", 1, budget)
            cut = cut if cut > 0 else budget
            out.append((kind, text[:cut].rstrip(), heading))
            text = text[cut:].lstrip()
        if out and len(text) < least and out[-1][2] == heading and len(out[-1][1]) + 1 + len(text) <= budget:
            out[-1] = (out[-1][0], out[-1][1] + "\n" + text, heading)
        elif text:
            out.append((kind, text, heading))
    return out


#: Classes of the spans that head an entry of a thread (author's initials, date) and the attribute with
#: the author's full name.
AUTHOR, DATE, FULL_NAME = "bold", "libelle_auteur_maj", "data-tippy-content"
_HEADER = re.compile(rf'<span class="{AUTHOR}"(?P<more>[^>]*)>(?P<initials>[^<]*)</span>\s*<span class="{DATE}">(?P<date>[^<]*)</span>', re.I)
_NAME = re.compile(rf'{FULL_NAME}="([^"]*)"', re.I)


def entries(html: str) -> list[tuple[str | None, str | None, str]]:
    """(author, date, HTML) of each entry of a thread; what stands before the first header has neither. Without any
    header there are none."""
    found = list(_HEADER.finditer(html))
    out: list[tuple[str | None, str | None, str]] = [(None, None, html[: found[0].start()])] if found else []
    for h, after in zip(found, [*found[1:], None]):
        name = _NAME.search(h["more"])
        author = (unescape(name[1]).strip() if name else "") or unescape(h["initials"]).strip()
        out.append((author or None, h["date"].strip() or None, html[h.end() : after.start() if after else len(html)]))
    return out


def chunk_field(html: str | None, budget: int = 1500, least: int = 25) -> list[tuple[str, str, str | None, str | None, str | None]]:
    """(kind, text, heading, author, date): a thread's entries, short pieces joining the chunk before, else blocks, of
    which headings go with those after them."""
    out: list[list] = []
    for author, date, part in entries(html or ""):
        for _, piece, _ in _pack([("entry", to_text(part), None)], budget, 0):
            if len(piece) < least and out:
                out[-1][1] += "\n" + piece
            elif piece:
                out.append(["thread entry", piece, None, author, date])
    if out:
        return [tuple(x) for x in out]
    found = blocks(html)
    body = [b for b in found if not (b[0].startswith("h") and b[0][1:].isdigit())] or found  # headings alone stay
    return [(k, t, h, None, None) for k, t, h in _pack(body, budget, least)]


def chunks(df: DataFrame, html: str, key: str, budget: int = 1500, least: int = 25) -> DataFrame:
    """(key, chunk from 0, kind, heading, author, date, text) of every field."""
    names = ("kind", "text", "heading", "author", "date")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, x in enumerate(b.column(html)):
                parts = chunk_field(x.as_py(), budget, least)
                if parts:
                    columns = dict(zip(names, zip(*parts)))
                    yield pa.RecordBatch.from_arrays([b.column(key).take(pa.array([i] * len(parts))), pa.array(range(len(parts)), pa.int32()), *[pa.array(columns[n], pa.string()) for n in ("kind", "heading", "author", "date", "text")]], names=[key, "chunk", "kind", "heading", "author", "date", "text"])

    return arrow_map(df.select(key, html), run, f"{key} {df.schema[key].dataType.simpleString()}, chunk int, kind string, heading string, author string, date string, text string")


#: A field's chunks as one column.
CHUNKS = "array<struct<kind string, heading string, author string, date string, text string>>"


def chunk_lists(df: DataFrame, columns: dict[str, str], budget: int = 1500, least: int = 25) -> DataFrame:
    """df with a column of chunks, in order, for each HTML column; null and empty fields have none. columns: HTML column
    to new column. The record stays one row, so its fields' chunks must fit in a row together."""
    names, rest = ("kind", "text", "heading", "author", "date"), df.columns
    schema = df
    for out in columns.values():
        schema = schema.withColumn(out, F.lit(None).cast(CHUNKS.replace(" string", ": string")))
    schema = schema.schema
    kinds = pa.list_(pa.struct([(n, pa.string()) for n in ("kind", "heading", "author", "date", "text")]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = [pa.array([[dict(zip(names, c)) for c in chunk_field(x, budget, least)] for x in b.column(html).to_pylist()], kinds) for html in columns]
            yield pa.RecordBatch.from_arrays([*b.columns, *made], names=[*rest, *columns.values()])

    return arrow_map(df, run, schema)


def plain_text(df: DataFrame, html: str, out: str = "text") -> DataFrame:
    """df with the text of its HTML column."""
    rest = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([to_text(x.as_py()) for x in b.column(html)], pa.string())], names=[*rest, out])

    return arrow_map(df, run, df.withColumn(out, F.lit("")).schema)
