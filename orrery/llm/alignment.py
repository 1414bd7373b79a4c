"""Alignment of the token sequences that two tokenizers make of the same text, by elementary intervals of its bytes.

The union of both sides' token ends cuts the bytes into elementary intervals. Each lies in one token of either side, so
it is one overlap; where an interval's end belongs to both sides a group closes, and the tokens of a group are each
other's only partners. Links are the pairs of tokens that end together ("ends"), the overlaps ("overlap"), or all pairs
of a group ("product").

Texts are aligned unit by unit, a unit being white space and the word behind it, where both tokenizers never look across
that cut (`Sides` tells); the different units of a block of texts are encoded and aligned together, and a bounded memo
knows most of them. Other texts are one unit.

The corpus-wide counts of id pairs are summed from the different pairs of each block and sent back to the blocks that
asked, so what is shuffled is one row per block and pair, never per token.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, small_batches, stored
from .wordpieces import blocks

KINDS = ("ends", "overlap", "product")
#: Bytes of text in a block, or one text; a longer text is taken in parts of about this size.
BLOCK = 1 << 20
#: Blocks, rows of about 2 MB, in a Parquet row group.
GROUP_ROWS = 8
#: Characters and links of units that a Python worker remembers between blocks; about 25 bytes are held for each.
MEMO = 4 << 20
_UNITS = re.compile(r"[ \t\n]*[^ \t\n]+|[ \t\n]+")
#: White space that a tokenizer knows, or joins with what stands before it, beyond the three that begin a unit.
_OTHER_SPACE = re.compile("[\r\x0b\x0c\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_MARK = "▁"


def intervals(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(A token, B token, whether a group closes) of each elementary interval of two ascending lists of ends over the
    same bytes, the last end being the same."""
    cuts = np.union1d(ends_a, ends_b)
    a, b = np.searchsorted(ends_a, cuts), np.searchsorted(ends_b, cuts)
    return a, b, (ends_a[a] == cuts) & (ends_b[b] == cuts)


def links(a: np.ndarray, b: np.ndarray, closes: np.ndarray, kind: str = "ends") -> tuple[np.ndarray, np.ndarray]:
    """Linked (A token, B token), in the order of the text, from `intervals`."""
    if kind == "overlap":
        return a, b
    if kind == "ends":
        return a[closes], b[closes]
    last_a, last_b = a[closes], b[closes]
    n_a, n_b = np.diff(last_a, prepend=-1), np.diff(last_b, prepend=-1)
    n = n_a * n_b
    group = np.repeat(np.arange(len(n)), n)
    at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    return (last_a - n_a + 1)[group] + at // n_b[group], (last_b - n_b + 1)[group] + at % n_b[group]


def _byte_level() -> dict[str, int]:
    """The printable characters by which byte-level vocabularies write bytes: printable Latin-1 stands for itself, the
    other bytes follow from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [x for x in range(256) if x not in set(plain)]
    return {chr(x): x for x in plain} | {chr(256 + i): x for i, x in enumerate(rest)}


class Sides:
    """Both tokenizers: A by the tokenizers library (byte-level), B by sentencepiece, which adds a space in front."""

    def __init__(self, a_path: str, b_path: str) -> None:
        import sentencepiece
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.a, self.b = Tokenizer.from_file(a_path), sentencepiece.SentencePieceProcessor(model_file=b_path)
        self.a.encode_special_tokens = True  # their strings in a text are plain text
        own, of = self.a.get_vocab(with_added_tokens=True), _byte_level()
        self.a_bytes = [b""] * (max(own.values()) + 1)
        for token, i in own.items():
            self.a_bytes[i] = bytes(of[c] for c in token) if all(c in of for c in token) else token.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.vocab_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace(_MARK, " ").encode() for p in pieces]
        self.a_len, self.b_len = (np.array([len(x) for x in v], np.int64) for v in (self.a_bytes, self.b_bytes))
        self.space = self.b.piece_to_id(_MARK)
        with open(a_path, encoding="utf-8") as f:
            t = json.load(f)
        pre = t.get("pre_tokenizer") or {}
        plain_a = not t.get("normalizer") and pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space")
        plain_b = not any(_MARK in p.lstrip(_MARK) or any(c in p for c in "\t\n") for p in pieces) and pieces[self.space] == _MARK
        #: Neither side has tokens across a cut between a word and the white space behind it, nor chooses by what lies there.
        self.by_units = bool(plain_a and plain_b)

    def ids_a(self, text: str) -> np.ndarray:
        return np.array(self.a.encode(text, add_special_tokens=False).ids, np.int64)

    def ids_b(self, text: str) -> np.ndarray:
        """Ids of a string that begins a text with the space added, or stands behind a word. Before a tab or line feed the
        space that the tokenizer adds is a token of its own and goes."""
        if text[:1] == " ":  # of an empty text nothing is encoded, not even the space
            return np.array(self.b.encode(text[1:]) if len(text) > 1 else [self.space], np.int64)
        ids = np.array(self.b.encode(text), np.int64)
        return ids[1:] if ids[:1] == self.space else ids

    def bytes_a(self, ids: np.ndarray) -> bytes:
        return b"".join([self.a_bytes[i] for i in ids.tolist()])

    def bytes_b(self, ids: np.ndarray) -> bytes:
        return b"".join([self.b_bytes[i] for i in ids.tolist()])


class Units:
    """What is known of each different unit: its group string, token counts and links."""

    def __init__(self, sides: Sides, kind: str) -> None:
        self.sides, self.kind = sides, kind
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        self.text: list[str] = []
        self._chunks: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.held = 0

    def tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per unit (A tokens, B tokens, groups, links), all 0 where the bytes differ; its links' first place; all links as
        A id << 32 | B id."""
        counts = np.concatenate([c for c, _ in self._chunks] or [np.empty((0, 4), np.int64)])
        pairs = np.concatenate([p for _, p in self._chunks] or [np.empty(0, np.int64)])
        self._chunks = [(counts, pairs)]
        return counts, np.cumsum(counts[:, 3]) - counts[:, 3], pairs

    def learn(self, units: list[str]) -> None:
        """Adds units that are not known yet. Those that begin with white space and end with a word are encoded as one
        text, in which the tokenizers don't look across them; any others, and all if that text fails, one by one."""
        other = bool(_OTHER_SPACE.search("".join(units)))
        joined = [u for u in units if u[-1] not in " \t\n" and not (other and _OTHER_SPACE.search(u))] if self.sides.by_units else []
        told = set(joined) if len(joined) < len(units) else units
        for i in range(0, len(joined), 20_000):
            self._learn_joined(joined[i : i + 20_000])
        if told is not units:
            for u in units:
                if u not in told:
                    self._learn_one(u)

    def _learn_joined(self, units: list[str]) -> None:
        s, first = self.sides, " a"  # the text's first word, left out again
        sizes = np.fromiter((len(u.encode("utf-8", "replace")) for u in [first, *units]), np.int64)
        text, ends = first + "".join(units), np.cumsum(sizes)
        a, b = s.ids_a(text), s.ids_b(text)
        whole = text.encode("utf-8", "replace")
        if s.bytes_a(a) == whole and s.bytes_b(b) == whole:
            ends_a, ends_b = np.cumsum(s.a_len[a]), np.cumsum(s.b_len[b])
            at_a, at_b = np.searchsorted(ends_a, ends), np.searchsorted(ends_b, ends)
            if (ends_a[at_a] == ends).all() and (ends_b[at_b] == ends).all():
                self._add(units, a[at_a[0] + 1 :], b[at_b[0] + 1 :], at_a[1:] - at_a[0] - 1, at_b[1:] - at_b[0] - 1)
                return
        for u in units:
            self._learn_one(u)

    def _learn_one(self, unit: str) -> None:
        s, whole = self.sides, unit.encode("utf-8", "replace")
        a, b = s.ids_a(unit), s.ids_b(unit)
        if s.bytes_a(a) == whole and s.bytes_b(b) == whole:
            self._add([unit], a, b, np.array([len(a) - 1]), np.array([len(b) - 1]))
        else:
            self._note([unit], [""], np.zeros((1, 4), np.int64), np.empty(0, np.int64))

    def _add(self, units: list[str], a: np.ndarray, b: np.ndarray, last_a: np.ndarray, last_b: np.ndarray) -> None:
        """a, b: the ids of all units; last_a, last_b: the place of each unit's last token."""
        s = self.sides
        at_a, at_b, closes = intervals(np.cumsum(s.a_len[a]), np.cumsum(s.b_len[b]))
        left, right = links(at_a, at_b, closes, self.kind)
        group_a, group_b = at_a[closes], at_b[closes]
        groups, linked = np.searchsorted(group_a, last_a, "right"), np.searchsorted(left, last_a, "right")
        text_a, text_b = list(map(str, a.tolist())), list(map(str, b.tolist()))
        strings, pa_, pb_ = [], 0, 0
        for x, y in zip((group_a + 1).tolist(), (group_b + 1).tolist()):
            strings.append((text_a[pa_] if x == pa_ + 1 else ",".join(text_a[pa_:x])) + "|" + (text_b[pb_] if y == pb_ + 1 else ",".join(text_b[pb_:y])))
            pa_, pb_ = x, y
        cuts = groups.tolist()
        counts = np.column_stack([np.diff(x, prepend=p) for x, p in ((last_a, -1), (last_b, -1), (groups, 0), (linked, 0))])
        self._note(units, [";".join(strings[i:j]) for i, j in zip([0, *cuts], cuts)], counts, a[left] << 32 | b[right])

    def _note(self, units: list[str], text: list[str], counts: np.ndarray, pairs: np.ndarray) -> None:
        self.known.update(zip(units, range(len(self.text), len(self.text) + len(units))))
        self.text += text
        self._chunks.append((counts, pairs))
        self.held += sum(map(len, units)) + len(pairs)

    def cut(self, text: str) -> list[str]:
        """The units of a text with the space in front."""
        return _UNITS.findall(text) if self.sides.by_units and not _OTHER_SPACE.search(text) else [text]


def _parts(text: str, by_units: bool) -> Iterator[str]:
    """A text in parts of about BLOCK characters, each ending behind a word, where units can be told."""
    if len(text) <= BLOCK or not by_units or _OTHER_SPACE.search(text):
        yield text
        return
    end = re.compile(r"(?<=[^ \t\n])(?=[ \t\n])")
    a = 0
    while a < len(text):
        cut = end.search(text, a + BLOCK)
        z = cut.start() if cut else len(text)
        yield text[a:z]
        a = z


@lru_cache(2)
def _units(a_path: str, b_path: str, kind: str) -> Units:
    """One per Python worker, reused by its later tasks."""
    return Units(Sides(a_path, b_path), kind)


def _numbers(known: Units, lists: list[list[str]]) -> list[np.ndarray]:
    """The units' numbers, learning new ones."""
    get = known.known.get
    found = [list(map(get, x)) for x in lists]
    new = dict.fromkeys(u for x, f in zip(lists, found) if None in f for u, i in zip(x, f) if i is None)
    known.learn(list(new))
    return [np.array(f if None not in f else list(map(get, x)), np.int64) for x, f in zip(lists, found)]


def _block(known: Units, texts: list[bytes]) -> dict:
    """One block: counts of each text, its different units with how often it has them, the links of each unit as places
    in the block's list of different pairs, and how often the block holds each pair."""
    if known.held > MEMO:
        known.clear()
    parts = [_parts(" " + t.decode("utf-8", "replace"), known.sides.by_units) if t else iter(()) for t in texts]
    if len(texts) > 1:  # no text of more than a block
        lists = _numbers(known, [[u for p in x for u in known.cut(p)] for x in parts])
        each = [[x] if len(x) else [] for x in lists]
    else:
        each = [(_numbers(known, [known.cut(p)])[0] for p in x) for x in parts]
    owners, units, times, shas = [], [], [], []
    for d, x in enumerate(each):
        sha, any_part, good = hashlib.sha256(), False, True
        own, n = np.empty(0, np.int64), np.empty(0, np.int64)
        for i in x:
            strings = [known.text[k] for k in i.tolist()]
            good = good and "" not in strings
            if not good:
                break
            sha.update((";" * any_part + ";".join(strings)).encode())
            any_part = True
            here, m = np.unique(i, return_counts=True)
            if len(own):
                here, back = np.unique(np.concatenate([own, here]), return_inverse=True)
                m = np.bincount(back, np.concatenate([n, m]), len(here)).astype(np.int64)
            own, n = here, m
        if not good:
            own, n = np.empty(0, np.int64), np.empty(0, np.int64)
        owners.append(np.full(len(own), d))
        units.append(own)
        times.append(n)
        shas.append(sha.hexdigest() if any_part and good else "")
    owner, unit, time_ = np.concatenate(owners), np.concatenate(units), np.concatenate(times)
    counts, starts, pairs = known.tables()
    totals = np.stack([np.bincount(owner, counts[unit, k] * time_, len(texts)) for k in range(4)], 1).astype(np.int64)
    used, place = np.unique(unit, return_inverse=True)
    sizes = counts[used, 3]
    at = np.repeat(starts[used] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
    found, index = np.unique(pairs[at], return_inverse=True)
    per_unit = np.bincount(place, time_, len(used))
    per_pair = np.bincount(index, np.repeat(per_unit, sizes), len(found)).astype(np.int64)
    u4 = lambda x: np.asarray(x, "<u4").tobytes()
    bounds = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(texts)))])
    return {"counts": totals, "sha": shas, "units": u4(place), "times": u4(time_), "bounds": bounds, "unit_links": u4(index), "unit_sizes": u4(sizes), "pairs": found, "pair_counts": per_pair}


def encoded_blocks(docs: DataFrame, a_path: str, b_path: str, kind: str = "ends", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per block of texts: the texts' ids and own figures, and the block's different pairs with their counts."""
    if kind not in KINDS:
        raise ValueError(f"kind is one of {KINDS}")
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, number = _units(a_path, b_path, kind), TaskContext.get().partitionId() << 32
        for b in batches:
            at = 0
            for texts in blocks(b.column("text"), BLOCK):
                x = _block(known, texts)
                ids = pa.ListArray.from_arrays(pa.array([0, len(texts)], pa.int32()), b.column("id").slice(at, len(texts)))
                at += len(texts)
                one = lambda v, t: pa.array([v], t)
                yield pa.RecordBatch.from_arrays(
                    [one(number, pa.int64()), ids, *[one(x["counts"][:, i], pa.list_(pa.int64())) for i in range(4)], one(x["sha"], pa.list_(pa.string())), one(x["units"], pa.binary()), one(x["times"], pa.binary()), one(x["bounds"], pa.list_(pa.int64())), one(x["unit_links"], pa.binary()), one(x["unit_sizes"], pa.binary()), one(x["pairs"], pa.list_(pa.int64())), one(x["pair_counts"], pa.list_(pa.int64()))],
                    names=names,
                )
                number += 1

    names = ["block", "ids", "n_a", "n_b", "n_groups", "n_links", "sha", "units", "times", "bounds", "unit_links", "unit_sizes", "pairs", "pair_counts"]
    kinds = ["long", f"array<{id_type}>", *["array<long>"] * 4, "array<string>", "binary", "binary", "array<long>", "binary", "binary", "array<long>", "array<long>"]
    return arrow_map(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), run, ", ".join(f"{n} {k}" for n, k in zip(names, kinds)))


def pair_counts(asked: DataFrame) -> DataFrame:
    """asked: (block, place, pair, n). Corpus-wide (pair, a, b, count, best): how many links hold the pair, and whether no
    pair of the same B id has more. A B id has at most as many pairs as A has ids."""
    counts = asked.groupBy("pair").agg(F.sum("n").alias("count")).withColumn("a", F.shiftright("pair", 32).cast("int")).withColumn("b", F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF)).cast("int"))
    counts = stored(counts, "pair-counts")
    most = counts.groupBy("b").agg(F.max("count").alias("most"))
    return counts.join(most, "b").select("pair", "a", "b", "count", (F.col("count") == F.col("most")).alias("best"))


def align_documents(docs: DataFrame, a_path: str, b_path: str, kind: str = "ends", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For every row of docs: the id, n_a, n_b, n_groups, n_links, n_best (links whose pair is the most frequent of its B
    id, ties included), count_sum (over its links, of the pair's count) and groups_sha256.

    A text that is null or empty, or whose tokens' bytes do not give it back on either side, has no tokens: zeros and ''.
    Ids may be null or repeated: rows are independent, equal texts get equal figures, other columns don't matter. An
    empty table gives an empty result. A text of more than BLOCK is taken in parts; a text with other white space than
    blanks, tabs and line feeds, or one word, is encoded whole.
    """
    with small_batches(docs.sparkSession):
        coded = stored(encoded_blocks(docs, a_path, b_path, kind, id_col, text_col), "aligned", GROUP_ROWS)
    asked = coded.select("block", F.posexplode(F.arrays_zip("pairs", "pair_counts")).alias("place", "x")).select("block", "place", F.col("x.pairs").alias("pair"), F.col("x.pair_counts").alias("n"))
    counts = stored(pair_counts(asked), "pair-best")
    # a count is at least 1, so its sign can say whether it is the best
    # left: all pairs have counts, and of a left join only the right side can be broadcast, not the exploded one
    told = asked.select("block", "place", "pair").join(counts.select("pair", F.when(F.col("best"), -F.col("count")).otherwise(F.col("count")).alias("value")), "pair", "left")
    answers = told.groupBy("block").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "value"))), lambda x: x["value"]).alias("values"))
    columns = ["ids", "n_a", "n_b", "n_groups", "n_links", "sha", "units", "times", "bounds", "unit_links", "unit_sizes"]
    joined = coded.select("block", *columns).join(answers, "block", "left").select(*columns, "values")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _units.cache_clear()  # workers are reused, and what they remember of units is not needed here
        for b in batches:
            for i in range(len(b)):
                row = {n: b.column(n)[i] for n in [*columns, "values"]}
                u4 = lambda n: np.frombuffer(row[n].as_py(), "<u4")
                values = np.array(row["values"].values, np.int64) if row["values"].is_valid else np.empty(0, np.int64)
                at, sizes, bounds = u4("unit_links"), u4("unit_sizes").astype(np.int64), np.array(row["bounds"].values, np.int64)
                ends, of_links = np.cumsum([0, *sizes]), values[at]
                sums = lambda x, cuts: np.diff(np.concatenate([[0], np.cumsum(x)])[cuts])
                units, times = u4("units"), u4("times").astype(np.int64)
                best, total = (sums(sums(x, ends)[units] * times, bounds) for x in ((of_links < 0).astype(np.int64), np.abs(of_links)))
                yield pa.RecordBatch.from_arrays([row["ids"].values, *[row[n].values for n in ("n_a", "n_b", "n_groups", "n_links")], pa.array(best, pa.int64()), pa.array(total, pa.int64()), row["sha"].values], names=[id_col, "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])

    figures = ", ".join(f"{n} long" for n in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"))
    with small_batches(docs.sparkSession):
        return stored(arrow_map(joined, run, f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, {figures}, groups_sha256 string"), "aligned-texts")


def token_map(docs: DataFrame, a_path: str, b_path: str, kind: str = "ends", text_col: str = "text") -> DataFrame:
    """The vocabularies' map that the corpus gives: (a, b, count, best) for each pair of ids that is linked in it."""
    with small_batches(docs.sparkSession):
        coded = stored(encoded_blocks(docs, a_path, b_path, kind, text_col, text_col).select("block", "pairs", "pair_counts"), "aligned", GROUP_ROWS)
    asked = coded.select(F.explode(F.arrays_zip("pairs", "pair_counts")).alias("x")).select(F.col("x.pairs").alias("pair"), F.col("x.pair_counts").alias("n"))
    return pair_counts(asked).drop("pair")


def aligned_groups(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per group of every text, in order: the id, group (from 0), its byte range in the text with the space in
    front, and the ids of both sides. Texts without tokens give no rows."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _units(a_path, b_path, "ends")
        s = known.sides
        for b in batches:
            for i, t in zip(b.column("id"), b.column("text").cast(pa.large_binary())):
                if not t.as_py():
                    continue
                for out in _groups_of(known, s, " " + t.as_py().decode("utf-8", "replace")):
                    n = len(out["group"])
                    yield pa.RecordBatch.from_arrays([pa.array([i.as_py()] * n, b.schema.field("id").type), *[pa.array(out[k], v) for k, v in kinds.items()]], names=[id_col, *kinds])
                if known.held > MEMO:
                    known.clear()

    kinds = {"group": pa.int64(), "start": pa.int64(), "end": pa.int64(), "a": pa.list_(pa.int32()), "b": pa.list_(pa.int32())}
    return arrow_map(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), run, f"`{id_col}` {id_type}, group long, start long, end long, a array<int>, b array<int>")


def _groups_of(known: Units, s: Sides, text: str) -> Iterator[dict]:
    parts = [_numbers(known, [known.cut(p)])[0] for p in _parts(text, s.by_units)]
    if any(known.text[i] == "" for x in parts for i in x.tolist()):
        return  # the bytes differ
    number = at = 0
    for x in parts:
        out: dict[str, list] = {k: [] for k in ("group", "start", "end", "a", "b")}
        for i in x.tolist():
            for g in known.text[i].split(";"):
                a, b = ([int(y) for y in side.split(",")] for side in g.split("|"))
                size = int(s.a_len[a].sum())
                for k, v in zip(out, (number, at, at + size, a, b)):
                    out[k].append(v)
                number, at = number + 1, at + size
        yield out
