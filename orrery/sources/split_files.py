"""Raw CSV and JSON files read by many tasks each, although a record may span lines and blocks.

Spark's text source cuts a file into blocks at any byte and hands out the pieces between two separators: lines for CSV,
what lies between closing braces for JSON. What a piece means depends on all before it, so there are two passes. The first
tells for every block, for either case of its beginning inside a quoted text, what it leaves open; these rows, one a
block, are folded along each file. The second cuts records from every block, whose beginning is now known, and the
pieces of records that lie in several blocks are joined. Both run when a reader is called, on splits of a fixed size;
the records are written to the shared folder. Files that are compressed as a whole have one block.
"""

from __future__ import annotations

import csv as csv_module
import io
import json
import re
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..arrow import arrow_map
from ..functions.scalars import repaired_escapes
from .readers import distinct_headers
from .sinks import written

#: Bytes of a block, and the most blocks whose beginnings (about 100 bytes each) are broadcast.
SPLIT, STATES = 64 << 20, 200_000
#: What a row holds: a record, the end of one, its beginning, or a block in the midst of one.
WHOLE, HEAD, TAIL, MIDST = range(4)

_STRING_END = re.compile(r'[^"\\]*(?:\\.[^"\\]*)*"', re.S)
_TOKEN = re.compile(r'"([^"\\]*(?:\\.[^"\\]*)*)("|\\?\Z)|([{}\[\]])', re.S)


def structure(piece: str, inside: bool) -> tuple[list[tuple[int, str, str]], bool]:
    """(place, bracket, key before it) outside of strings, and whether the piece ends in a string. inside: it begins in one."""
    found: list[tuple[int, str, str]] = []
    pos, key, after = 0, "", -1
    if inside:
        m = _STRING_END.match(piece)
        if not m:
            return found, True
        pos = m.end()
    for m in _TOKEN.finditer(piece, pos):
        if m[3]:
            found.append((m.start(), m[3], key if after >= 0 and piece[after : m.start()].strip() == ":" else ""))
            after = -1
        elif m[2] != '"':
            return found, True
        else:
            key, after = m[1], m.end()
    return found, False


class JsonFormat:
    """Objects of a list, or of the list _embedded.<key> of an envelope. A state is whether a string is open, and the
    open brackets with their keys."""

    separator, glue, start = "}", "", [False, []]

    def __init__(self, key: str = "module") -> None:
        self.lists = (["["], ["{", "{_embedded", "[" + key])

    def ending(self) -> list:
        return [[False, 0, []], [True, 0, []]]

    def extend(self, endings: list, piece: str) -> None:
        for e in endings:
            found, e[0] = structure(piece, e[0])
            for _, c, key in found:
                if c in "{[":
                    e[2].append(c + key)
                elif e[2]:
                    e[2].pop()
                else:
                    e[1] += 1

    def after(self, state: list, endings: list) -> list:
        inside, closed, opened = endings[int(state[0])]
        return [inside, state[1][: max(0, len(state[1]) - closed)] + opened]

    def cutter(self, state: list) -> _JsonCutter:
        return _JsonCutter(self.lists, *state)


class _JsonCutter:
    def __init__(self, lists, inside: bool, stack: list[str]) -> None:
        self.lists, self.inside, self.stack = lists, inside, list(stack)
        self.depth = next((len(x) for x in lists if len(stack) > len(x) and stack[: len(x)] == x and stack[len(x)][0] == "{"), None)
        self.carried = self.depth is not None
        self.parts: list[str] | None = [] if self.carried else None

    def feed(self, piece: str) -> Iterator[tuple[int, str]]:
        found, self.inside = structure(piece, self.inside)
        at = 0
        for pos, c, key in found:
            if c in "{[":
                if self.parts is None and c == "{" and self.stack in self.lists:
                    self.parts, self.depth, at = [], len(self.stack), pos
                self.stack.append(c + key)
            elif self.stack:
                self.stack.pop()
                if self.parts is not None and len(self.stack) == self.depth:
                    yield HEAD if self.carried else WHOLE, "".join(self.parts) + piece[at : pos + 1]
                    self.parts, self.carried = None, False
        if self.parts is not None:
            self.parts.append(piece[at:])


class CsvFormat:
    """Rows whose quoted cells may hold line ends; a quote opens a cell only at its beginning. A state is whether a
    quoted cell is open."""

    separator, glue, start = "\n", "\n", False

    def __init__(self, sep: str = ";") -> None:
        self.opens = re.compile(rf'(?:\A|{re.escape(sep)})"')
        self.closes = re.compile(r'[^"]*(?:""[^"]*)*"(?!")')

    def inside_after(self, line: str, inside: bool) -> bool:
        pos = 0
        while '"' in line:
            if inside:
                m = self.closes.match(line, pos)
                if not m:
                    return True
                pos = m.end()
            m = self.opens.search(line, pos)
            if not m:
                return False
            pos, inside = m.end(), True
        return inside

    def ending(self) -> list:
        return [False, True]

    def extend(self, endings: list, line: str) -> None:
        if '"' in line:
            endings[:] = [self.inside_after(line, e) for e in endings]

    def after(self, state: bool, endings: list) -> bool:
        return endings[int(state)]

    def cutter(self, state: bool) -> _CsvCutter:
        return _CsvCutter(self, state)


class _CsvCutter:
    def __init__(self, form: CsvFormat, inside: bool) -> None:
        self.form, self.inside, self.carried = form, inside, inside
        self.parts: list[str] | None = [] if inside else None

    def feed(self, line: str) -> Iterator[tuple[int, str]]:
        self.inside = self.form.inside_after(line, self.inside)
        if self.parts is None:
            self.parts = []
        self.parts.append(line)
        if not self.inside:
            yield HEAD if self.carried else WHOLE, "\n".join(self.parts)
            self.parts, self.carried = None, False


def _runs(b: pa.RecordBatch) -> Iterator[tuple[str, int, int, int]]:
    """(path, block, from, to) of each stretch of a batch's rows that are of one block."""
    if b.num_rows:
        path, start = b.column("path").dictionary_encode().indices.to_numpy(), b.column("start").to_numpy()
        cuts = [0, *(np.flatnonzero((np.diff(path) != 0) | (np.diff(start) != 0)) + 1).tolist(), b.num_rows]
        for i, j in zip(cuts, cuts[1:]):
            yield b.column("path")[i].as_py(), int(start[i]), i, j


@contextmanager
def _splits_of(spark: SparkSession, size: int):
    """Blocks of this size, whatever the number of cores: both passes must see the same."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = [spark.conf.get(n) for n in names]
    try:
        for n in names:
            spark.conf.set(n, str(size))
        yield
    finally:
        for n, v in zip(names, old):
            spark.conf.set(n, v)


def _pieces(spark: SparkSession, path: str, form) -> DataFrame:
    t = spark.read.text(path, lineSep=form.separator)
    return t.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"), F.col("_metadata.file_size").alias("size"), F.col("value").cast("binary").alias("value"))


def _beginnings(pieces: DataFrame, form, encoding: str) -> DataFrame:
    """(path, start, state, ends): each block's state at its beginning, as JSON, and whether it ends the file without a separator."""

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, endings, size, length = None, None, 0, 0

        def row():
            return pa.RecordBatch.from_pydict({"path": [now[0]], "start": pa.array([now[1]], pa.int64()), "size": pa.array([size], pa.int64()), "bytes": pa.array([length], pa.int64()), "endings": [json.dumps(endings)]})

        for b in batches:
            for path, start, i, j in _runs(b):
                if (path, start) != now:
                    if now:
                        yield row()
                    now, endings, size, length = (path, start), form.ending(), b.column("size")[i].as_py(), 0
                for x in b.column("value").slice(i, j - i).to_pylist():
                    length += len(x) + 1
                    form.extend(endings, x.decode(encoding, "replace") + ("}" if form.separator == "}" else ""))
        if now:
            yield row()

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, state, total, held = None, None, 0, None

        def row(ends: bool):
            return pa.RecordBatch.from_pydict({"path": [held["path"]], "start": pa.array([held["start"]], pa.int64()), "state": [held["state"]], "ends": [ends]})

        for b in batches:
            for r in b.to_pylist():
                if held:
                    yield row(held["path"] != r["path"] and total > held["size"])
                if r["path"] != path:
                    path, state, total = r["path"], form.start, 0
                held = {**r, "state": json.dumps(state)}
                state, total = form.after(state, json.loads(r["endings"])), total + r["bytes"]
        if held:
            yield row(total > held["size"])

    told = arrow_map(pieces, tell, "path string, start long, size long, bytes long, endings string")
    return arrow_map(told.repartition("path").sortWithinPartitions("path", "start"), fold, "path string, start long, state string, ends boolean")


def records(spark: SparkSession, path: str, form, encoding: str = "utf-8", split: int = SPLIT, states: int = STATES) -> DataFrame:
    """(path, start, at, text, complete): the texts of a format's records, `at` counting those of the block at `start`.

    A record that the file's end cuts off is there with complete = false. A quote or bracket that nothing closes spoils
    what follows in its file, and only there. A path without files is Spark's error; empty files give no rows. Of one
    record's text, and of one block between two separators, each must fit in a task.
    """
    with _splits_of(spark, split):
        pieces = _pieces(spark, path, form)
        begins = written(_beginnings(pieces, form, encoding), "blocks")
        few = begins.count() <= states
        placed = pieces.withColumn("order", F.monotonically_increasing_id()).join(F.broadcast(begins) if few else begins.hint("merge"), ["path", "start"], "left")
        placed = placed.select("path", "start", "value", "order", F.coalesce("state", F.raise_error(F.lit("a file was changed while it was read"))).alias("state"), "ends")
        if not few:
            placed = placed.repartition("path", "start").sortWithinPartitions("path", "start", "order")

        def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            now, cutter, held, n, ends = None, None, None, 0, False
            out: list[tuple] = []

            def feed(x: bytes, last: bool) -> None:
                nonlocal n
                closing = "}" if form.separator == "}" and not (last and ends) else ""
                for kind, text in cutter.feed(x.decode(encoding, "replace") + closing):
                    out.append((*now, n, kind, text))
                    n += 1

            def finish() -> None:
                if held is not None:
                    feed(held, True)
                if cutter is not None and cutter.parts is not None:
                    out.append((*now, n, MIDST if cutter.carried else TAIL, form.glue.join(cutter.parts)))

            def batch():
                rows, out[:] = list(zip(*out)), []
                return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, (pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.string()))], names=["path", "start", "at", "kind", "text"])

            for b in batches:
                for path, start, i, j in _runs(b):
                    if (path, start) != now:
                        finish()
                        now, cutter, held, n = (path, start), form.cutter(json.loads(b.column("state")[i].as_py())), None, 0
                        ends = b.column("ends")[i].as_py()
                    for x in b.column("value").slice(i, j - i).to_pylist():
                        if held is not None:
                            feed(held, False)
                        held = x
                if out:
                    yield batch()
            finish()
            if out:
                yield batch()

        found = written(arrow_map(placed, cut, "path string, start long, at long, kind int, text string"), "records")
    # at most two parts a block: the number of beginnings so far tells a record's parts
    parts = found.filter(F.col("kind") != WHOLE).withColumn("n", F.count_if(F.col("kind") == TAIL).over(Window.partitionBy("path").orderBy("start", "at")))
    joined = parts.groupBy("path", "n").agg(F.min(F.struct("start", "at")).alias("k"), F.sort_array(F.collect_list(F.struct("start", "at", "text"))).alias("p"), F.bool_or(F.col("kind") == HEAD).alias("complete"))
    joined = joined.select("path", "k.start", "k.at", F.array_join(F.transform("p", lambda x: x["text"]), form.glue).alias("text"), "complete")
    return found.filter(F.col("kind") == WHOLE).select("path", "start", "at", "text", F.lit(True).alias("complete")).unionByName(joined)


def json_records(spark: SparkSession, path: str, key: str = "module", split: int = SPLIT) -> tuple[DataFrame, DataFrame]:
    """(good, bad) records of JSON files that hold a list, or an envelope with _embedded.<key>. good: path, start, at,
    record (VARIANT), lone backslashes repaired in each record that needs it. bad: path, start, text of what is no JSON
    after the repair. Items that are no objects are left out."""
    t = records(spark, path, JsonFormat(key), split=split)
    parsed = F.when(F.col("complete"), F.coalesce(F.try_parse_json("text"), F.try_parse_json(repaired_escapes(F.col("text")))))
    t = t.withColumn("record", parsed)
    return t.filter("record is not null").select("path", "start", "at", "record"), t.filter("record is null").select("path", "start", "text")


def csv(spark: SparkSession, path: str, encoding: str = "utf-8", sep: str = ";", split: int = SPLIT) -> tuple[DataFrame, DataFrame]:
    """(good, bad) rows of CSV files with a header, which must be the same in all; repeated names are numbered. Short
    rows are padded with nulls, cells beyond the header dropped, empty lines left out. bad: path, start, text of rows
    whose quotes are never closed or that are no CSV. encoding: one in which a line end is one byte."""
    t = records(spark, path, CsvFormat(sep), encoding, split)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        csv_module.field_size_limit(2**31 - 1)
        for b in batches:
            rows = []
            for text, complete in zip(b.column("text").to_pylist(), b.column("complete").to_pylist()):
                try:
                    read = list(csv_module.reader(io.StringIO(text, newline=""), delimiter=sep, strict=False)) if complete else []
                except csv_module.Error:
                    read = []
                rows.append(read[0] if len(read) == 1 else None)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(rows, pa.list_(pa.string()))], names=[*b.schema.names, "cells"])

    text = F.when((F.col("start") == 0) & (F.col("at") == 0), F.regexp_replace("text", "^\ufeff", "")).otherwise(F.col("text"))
    t = arrow_map(t.withColumn("text", text).filter(F.trim(F.translate("text", "\r\t", "  ")) != ""), parse, "path string, start long, at long, text string, complete boolean, cells array<string>")
    first = (F.col("start") == 0) & (F.col("at") == 0)
    headers = t.filter(first).select("cells").distinct().limit(2).collect()
    if len(headers) > 1:
        raise ValueError("files with different headers")
    names = distinct_headers(list(headers[0].cells or ())) if headers else []
    rows = t.filter(~first)
    good = rows.filter("cells is not null").select(*[F.get("cells", F.lit(i)).alias(n) for i, n in enumerate(names)])
    return good, rows.filter("cells is null").select("path", "start", "text")
