"""Dictionaries of thousands of terms, found or replaced in one pass over each text by an automaton.

The terms are given by the caller, or are a table's column of at most MOST different values, which is checked; they are
sent to every task once. Texts pass in Arrow batches; nothing is shuffled, and the plan does not grow with the terms.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..arrow import arrow_map

#: Bound of a dictionary that is read from a table.
MOST = 1_000_000


class _Fold(dict):
    """Characters without case, one for one, so that places stay: those whose other case has several characters stay."""

    def __missing__(self, c: int) -> int:
        up = chr(c).upper()
        low = up.lower() if len(up) == 1 else chr(c)
        self[c] = ord(low) if len(low) == 1 else c
        return self[c]


_fold = _Fold()


def without_case(text: str) -> str:
    return text.lower() if text.isascii() else text.translate(_fold)


class Terms:
    """An automaton over terms, with or without case."""

    def __init__(self, terms: Sequence[str], case: bool = True) -> None:
        import ahocorasick

        self.key = (lambda t: t) if case else without_case
        self.automaton, self.empty = ahocorasick.Automaton(), True
        for i, t in enumerate(terms):
            k = self.key(t)
            if k and k not in self.automaton:  # of terms that are equal without case the first counts
                self.automaton.add_word(k, (i, len(k)))
                self.empty = False
        if not self.empty:
            self.automaton.make_automaton()

    def found(self, text: str) -> Iterator[tuple[int, int, int]]:
        """(start, end, term) of every occurrence, overlapping ones too."""
        if not self.empty:
            for last, (i, n) in self.automaton.iter(self.key(text)):
                yield last + 1 - n, last + 1, i

    def chosen(self, text: str) -> list[tuple[int, int, int]]:
        """Occurrences that don't overlap, in order: the longest first, of equally long ones the earlier term, of one term
        the earlier place; as if each term in turn took its places from what the terms before it left."""
        every = sorted(self.found(text), key=lambda x: (x[0] - x[1], x[2], x[0]))
        if len(every) < 2:
            return every
        taken, out = bytearray(len(text)), []
        for a, z, i in every:
            if not any(taken[a:z]):
                taken[a:z] = b"\x01" * (z - a)
                out.append((a, z, i))
        return sorted(out)


_built: dict = {}


def _terms(sent, case: bool) -> Terms:
    """One automaton per worker and dictionary."""
    key = (sent.value[0], case)
    if key not in _built:
        _built.clear()
        _built[key] = Terms(sent.value[1], case)
    return _built[key]


def _sent(df: DataFrame, terms: Sequence[str]):
    import hashlib

    return df.sparkSession.sparkContext.broadcast((hashlib.sha256("\0".join(terms).encode("utf-8", "replace")).hexdigest(), list(terms)))


def read_terms(table: DataFrame, column: str, most: int = MOST) -> list[str]:
    """The different values of a column that are not empty, in order. More than `most` are an error, as the dictionary is
    held by every task."""
    values = table.select(F.col(column).cast("string").alias("t")).filter("t <> ''").distinct()
    n = values.limit(most + 1).count()
    if n > most:
        raise ValueError(f"{column} has more than {most} different values")
    return sorted(r["t"] for r in values.collect())


def replaced(df: DataFrame, text: str, names: Mapping[str, str], out: str | None = None) -> DataFrame:
    """df with `out` (or text itself): the names by what stands for them, whatever their case, the longest first. A place is
    replaced once, and what was put in is not searched again. Null stays null."""
    ordered = sorted((n for n in names if n), key=lambda n: (-len(n), n))
    sent, by = _sent(df, ordered), [names[n] for n in ordered]
    spoken = df.sparkSession.sparkContext.broadcast(by)
    out = out or text
    schema = df.withColumn(out, F.lit(None).cast("string")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = _terms(sent, False)
        for b in batches:
            texts = []
            for x in b.column(b.schema.get_field_index(text)):
                t = x.as_py()
                if t is not None:
                    at, parts = 0, []
                    for a, z, i in terms.chosen(t):
                        parts += [t[at:a], spoken.value[i]]
                        at = z
                    t = "".join([*parts, t[at:]]) if parts else t
                texts.append(t)
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()) if f.name == out else b.column(b.schema.get_field_index(f.name)) for f in schema], names=schema.names)

    return arrow_map(df, run, schema)


def held(df: DataFrame, texts: Sequence[str], terms: Sequence[str], out: str = "terms", case: bool = True) -> DataFrame:
    """df with `out`: the different terms that any of the text columns holds, in the order of `terms`. Null columns hold
    none; of terms that differ in case only, without case the first is told."""
    sent = _sent(df, terms)
    schema = df.withColumn(out, F.array().cast("array<string>")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _terms(sent, case)
        for b in batches:
            found = []
            for row in zip(*[b.column(b.schema.get_field_index(c)).to_pylist() for c in texts]):
                own = {i for t in row if t for _, _, i in automaton.found(t)}
                found.append([sent.value[1][i] for i in sorted(own)])
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.string())) if f.name == out else b.column(b.schema.get_field_index(f.name)) for f in schema], names=schema.names)

    return arrow_map(df, run, schema)
