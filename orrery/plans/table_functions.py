"""Table functions for SQL: what the operators do to a row's text, called with LATERAL.

    register(spark)
    SELECT page_id, c.* FROM pages, LATERAL html_chunks(html, 1500, 25) c
    SELECT doc_id, s.* FROM documents, LATERAL packed_lines(split(text, '\n'), 1800) s
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..arrow import ship
from ..operators.html import chunk_field


class HtmlChunks:
    """The chunks of an HTML field: a thread's entries, else its blocks. Null and empty fields give no rows."""

    def eval(self, html: str, budget: int, least: int) -> Iterator[tuple]:
        for i, (kind, text, heading, author, date) in enumerate(chunk_field(html, budget, least)):
            yield i, kind, heading, author, date, text


def cut_line(line: str, width: int) -> list[str]:
    """A line in pieces of at most `width` characters: before the last blank within it, or in the middle of a word."""
    out = []
    while len(line) > width:
        at = line.rfind(" ", 1, width)
        at = at if at > 0 else width
        if piece := line[:at].rstrip():
            out.append(piece)
        line = line[at:].lstrip()
    return [*out, line] if line else out


class PackedLines:
    """Lines in segments of at most `budget` characters, in their order; null and empty lines are left out."""

    def eval(self, lines: list, budget: int) -> Iterator[tuple]:
        number, now = 0, None
        for line in lines or ():
            for piece in cut_line(line, max(1, budget)) if line else ():
                if now is not None and len(now) + 1 + len(piece) <= budget:
                    now += "\n" + piece
                    continue
                if now is not None:
                    yield number, now
                    number += 1
                now = piece
        if now is not None:
            yield number, now


def register(spark: SparkSession) -> None:
    """Makes html_chunks(html, budget, least) and packed_lines(lines, budget) known to the session's SQL; their rows travel
    in Arrow batches."""
    ship(spark)
    spark.udtf.register("html_chunks", F.udtf(HtmlChunks, returnType="chunk int, kind string, heading string, author string, date string, text string", useArrow=True))
    spark.udtf.register("packed_lines", F.udtf(PackedLines, returnType="segment int, text string", useArrow=True))
