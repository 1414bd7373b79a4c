"""Katz backoff language model: Good-Turing discounted bigram and unigram counts with exactly normalised weights.

P(w | h) = d(c(h,w)) c(h,w) / c(h) if the pair was seen in training, else a(h) P(w); P(w) = d(c(w)) c(w) / N for known
words, and what is left is the chance of an unknown word. a(h) makes the chances of all known words and of the unknown
one add up to 1. A history that was never seen has a(h) = 1; one whose counts are all above the discounted range has
1 added to c(h), so that something is left.

Corpora have about as many different pairs as tokens, so counts don't travel as rows. Documents are gathered into
blocks; a block sends each pair that occurs in it once, with its count, packed in one binary per bucket of the second
word; the bucket adds up, and answers in the same order. However common a pair or word is, a block sends it once, and
pairs of very common second words are spread over all buckets. Tables, all in the folder of the model:
  blocks    the texts as numbers of words, one row a block
  ngrams    per bucket: its words, their counts, the histories before each and the pairs' counts
  backoff   per bucket of histories: history, denominator c(h), weight a(h)
Words are told apart by 48 bits of XXH64; with V words about V * V / 2**49 pairs of them are taken for one.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, work_path

#: Good-Turing discounts hold for counts up to this.
DISCOUNTED = 5
#: Bytes of text in a block, tokens in a bucket.
BLOCK, BUCKET = 12 << 20, 2_000_000
#: Part of all training tokens from which a word counts as very common, so there are at most so many.
COMMON = 2000
FOLDS = 10
MASK = (1 << 48) - 1
#: Names with a blank inside are no words.
END, START = (xxhash.xxh64_intdigest(x) & MASK for x in (b"end of text", b"start of text"))


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh64_intdigest(word) & MASK
        if len(self) < 300_000:
            self[word] = h
        return h


_words = _Words()


def _zip(*arrays: np.ndarray) -> bytes:
    """Non-negative 32-bit integers, byte planes apart, compressed."""
    out = [zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(a.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()) for a in arrays]
    return struct.pack(f"<{len(out)}Q", *map(len, out)) + b"".join(out)


def _unzip(data: bytes, n: int) -> list[np.ndarray]:
    sizes, at, out = struct.unpack_from(f"<{n}Q", data), 8 * n, []
    for s in sizes:
        raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data[at : at + s]), np.uint8)
        out.append(np.ascontiguousarray(raw.reshape(4, -1).T).view("<u4").ravel())
        at += s
    return out


def _six(a: np.ndarray) -> bytes:
    return np.ascontiguousarray(a.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def _eight(data: bytes) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return np.concatenate([raw, np.zeros((len(raw), 2), np.uint8)], axis=1).view("<u8").ravel()


def _spread(h: np.ndarray, buckets: int) -> np.ndarray:
    return ((((h * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)) * np.uint64(buckets)) >> np.uint64(31)).astype(np.int64)


class Block:
    """Texts of a block as local word numbers: words[i] is a hash, token the words of all texts with their ends."""

    def __init__(self, words: np.ndarray, token: np.ndarray, sizes: np.ndarray, train: np.ndarray) -> None:
        self.words, self.token, self.sizes = words, token.astype(np.int64), sizes
        first = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
        self.first, self.train = first, np.repeat(train, sizes)
        before = np.empty(len(token), np.int64)
        before[1:] = self.token[:-1]
        before[first] = len(words)  # stands for the start
        self.key = self.token * (len(words) + 1)
        self.key += before

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sorted different pairs: word number, history number, training count."""
        k = self.key * 2
        k += self.train
        k.sort()
        at = np.flatnonzero(np.concatenate([[True], (k[1:] ^ k[:-1]) > 1]))
        w, h = np.divmod(k[at] >> 1, len(self.words) + 1)
        k &= 1
        return w, h, np.add.reduceat(k, at)

    def hashes(self, number: np.ndarray) -> np.ndarray:
        return np.append(self.words, np.uint64(START))[number]


def _order(b: Block, w: np.ndarray, h: np.ndarray, common: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """How a block's pairs are sent: order, and where each bucket begins in it."""
    ws = b.hashes(w)
    spread = np.where(np.isin(ws, common), ws ^ (b.hashes(h) * np.uint64(0xC2B2AE3D27D4EB4F)), ws)
    bucket = _spread(spread, buckets)
    order = np.argsort(bucket, kind="stable")
    return order, np.searchsorted(bucket[order], np.arange(buckets + 1))


def _runs(x: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin."""
    return np.flatnonzero(np.concatenate([np.ones(min(1, len(x)), bool), x[1:] != x[:-1]]))


BLOCKS = pa.schema([("block", pa.int64()), ("ids", pa.list_(pa.int64())), ("held", pa.list_(pa.bool_())), ("sizes", pa.list_(pa.int32())), ("words", pa.binary()), ("token", pa.binary()), ("counts", pa.binary()), ("trained", pa.int64()), ("often", pa.list_(pa.int64())), ("often_counts", pa.list_(pa.int64()))])
BLOCKS_DDL = "block long, ids array<long>, held array<boolean>, sizes array<int>, words binary, token binary, counts binary, trained long, often array<long>, often_counts array<long>"


def _number(hashes: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Different hashes in ascending order and, for each given one, its place there. Empties the list, to hold less memory."""
    every = np.concatenate(hashes)
    hashes.clear()
    order = np.argsort(every, kind="stable")
    every = every[order]
    new = np.concatenate([[True], every[1:] != every[:-1]])
    every = every[new]
    place = np.cumsum(new, dtype=np.int32)
    place -= 1
    token = np.empty(len(order), np.int32)
    token[order] = place
    return every, token


def _make_blocks(batches: Iterator[pa.RecordBatch], block: int, common: int) -> Iterator[pa.RecordBatch]:
    part, n = TaskContext.get().partitionId(), 0
    ids, hashes, size = [], [], 0

    def flush() -> pa.RecordBatch:
        held = np.array([zlib.crc32(b"" if i is None else str(i).encode()) % FOLDS == 0 for i in ids])
        sizes = np.array([len(x) for x in hashes])
        words, token = _number(hashes)
        counts = np.bincount(token[np.repeat(~held, sizes)], minlength=len(words))
        often = np.flatnonzero(counts > counts.sum() / (2 * common))
        row = [[part << 24 | n], [ids], [held.tolist()], [sizes.tolist()], [_six(words)], [_zip(token)], [_zip(counts)], [int(counts.sum())], [words[often].astype(np.int64).tolist()], [counts[often].tolist()]]
        return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(row, BLOCKS)], schema=BLOCKS)

    for b in batches:
        for i, x in zip(b.column("id").to_pylist(), b.column("text").cast(pa.large_binary())):
            text = x.as_py() or b""
            own = text.lower().split()
            own_hashes = np.fromiter(map(_words.__getitem__, own), np.uint64, len(own))
            ids.append(i)
            hashes.append(np.append(own_hashes, np.uint64(END)))
            size += len(text) + 8
            if size >= block:
                yield flush()
                ids, hashes, size, n = [], [], 0, n + 1
    if ids:
        yield flush()


def _load(row: dict) -> Block:
    return Block(_eight(row["words"]), _unzip(row["token"], 1)[0], np.array(row["sizes"]), ~np.array(row["held"], bool))


PACK = pa.schema([("kind", pa.int32()), ("bucket", pa.int64()), ("block", pa.int64()), ("data", pa.binary())])
PACK_DDL = "kind int, bucket long, block long, data binary"


def _rows(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), schema)], schema=schema)


def _send_pairs(common: np.ndarray, buckets: int):
    """kind 0: a block's pairs for a bucket of words; kind 1: its histories for a bucket of histories."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _each(batch):
                b = _load(row)
                w, h, count = b.pairs()
                b.key = b.token = None  # not needed here any more
                order, at = _order(b, w, h, common, buckets)
                for k in range(buckets):
                    own = order[at[k] : at[k + 1]]
                    if len(own):
                        ws = w[own]
                        begin = _runs(ws)
                        a, c = _six(b.hashes(ws[begin])), _six(b.hashes(h[own]))
                        yield _rows([(0, k, row["block"], struct.pack("<QQ", len(a), len(c)) + a + c + _zip(np.diff(begin, append=len(own)), count[own]))], PACK)
                histories = b.hashes(np.unique(h))
                bucket = _spread(histories, buckets)
                for k in np.unique(bucket).tolist():
                    yield _rows([(1, k, row["block"], _six(histories[bucket == k]))], PACK)

    return run


def _each(batch: pa.RecordBatch) -> Iterator[dict]:
    """Its rows one by one, so that their contents are not all held twice."""
    for i in range(batch.num_rows):
        yield batch.slice(i, 1).to_pylist()[0]


def _groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[int, list[dict]]]:
    """Consecutive rows of equal key, of rows sorted by it."""
    now, rows = None, []
    for b in batches:
        for r in _each(b):
            if r[key] != now:
                if rows:
                    yield now, rows
                now, rows = r[key], []
            rows.append(r)
    if rows:
        yield now, rows


COUNTED = pa.schema([*PACK, ("words", pa.binary()), ("histories", pa.binary()), ("known", pa.int64()), ("of1", pa.list_(pa.int64())), ("of2", pa.list_(pa.int64()))])
COUNTED_DDL = PACK_DDL + ", words binary, histories binary, known long, of1 array<long>, of2 array<long>"


def _add_up(common: np.ndarray, totals: np.ndarray):
    """kind 0: answers to a block (pairs' counts, words' counts); kind 2: the bucket's part of the model and its
    counts of counts. Words of `common`, sorted, have the given totals, as their pairs lie in several buckets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, rows in _groups(batches, "bucket"):
            ws, hs, cs, runs = [], [], [], []
            for r in rows:
                na, nc = struct.unpack_from("<QQ", r["data"])
                a, h = _eight(r["data"][16 : 16 + na]), _eight(r["data"][16 + na : 16 + na + nc])
                run_lengths, c = _unzip(r["data"][16 + na + nc :], 2)
                ws.append(np.repeat(a, run_lengths))
                hs.append(h)
                cs.append(c.astype(np.int64))
                runs.append(run_lengths)
                r["data"] = None
            ends = np.cumsum([len(x) for x in hs])
            w, h, c = np.concatenate(ws), np.concatenate(hs), np.concatenate(cs)
            del ws, hs, cs
            order = np.lexsort((h, w))
            w, h, c = w[order], h[order], c[order]
            new = np.concatenate([[True], (w[1:] != w[:-1]) | (h[1:] != h[:-1])])
            at = np.flatnonzero(new)
            pair_count = np.add.reduceat(c, at)
            pw, ph = w[at], h[at]
            word_at = _runs(pw)
            word_count = np.add.reduceat(pair_count, word_at)
            words = pw[word_at]
            is_common = np.isin(words, common)
            if len(common):
                word_count[is_common] = totals[np.searchsorted(common, words[is_common])]
            back = np.empty(len(order), np.int64)
            back[order] = np.cumsum(new) - 1
            number = np.repeat(np.arange(len(words)), np.diff(word_at, append=len(pw)))
            for r, lengths, a, z in zip(rows, runs, np.concatenate([[0], ends[:-1]]), ends):
                own = back[a:z]
                first = np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64)
                yield _rows([(0, bucket, r["block"], _zip(pair_count[own], word_count[number[own[first]]]), None, None, 0, [], [])], COUNTED)
            seen = pair_count > 0
            kept = np.flatnonzero(seen)
            begin = _runs(pw[kept])
            some = word_count[(word_count > 0) & ~is_common]
            counts_of = lambda x: np.bincount(np.minimum(x, DISCOUNTED + 2), minlength=DISCOUNTED + 3)[: DISCOUNTED + 2].tolist()
            data = _zip(np.diff(begin, append=len(kept)), word_count[number[kept[begin]]], pair_count[kept])
            yield _rows([(2, bucket, -1, data, _six(pw[kept[begin]]), _six(ph[kept]), len(some), counts_of(some), counts_of(pair_count[kept]))], COUNTED)

    return run


def discounts(of: list[int]) -> np.ndarray:
    """d(0..DISCOUNTED) from the counts of counts, of[r] things with count r; 1 where Good-Turing gives no sound value."""
    d, k = np.ones(DISCOUNTED + 1), DISCOUNTED
    if of[1]:
        rest = (k + 1) * of[k + 1] / of[1]
        for r in range(1, k + 1):
            if of[r] and rest < 1:
                x = ((r + 1) * of[r + 1] / (r * of[r]) - rest) / (1 - rest)
                d[r] = x if 0 < x < 1 else 1.0
    return d


class Unigrams:
    def __init__(self, n: int, known: int, of: list[int]) -> None:
        self.n, self.known, self.d = n, known, discounts(of)
        left = sum((1 - self.d[r]) * r * of[r] for r in range(1, DISCOUNTED + 1))
        self.total = n + (left <= 0)  # something is left for unknown words
        self.unknown = (self.total - n + left) / self.total

    def chance(self, count: np.ndarray) -> np.ndarray:
        return np.where(count > 0, self.d[np.minimum(count, DISCOUNTED) * (count <= DISCOUNTED)] * count / self.total, self.unknown)

    def base(self, count: np.ndarray) -> np.ndarray:
        return np.log10((count + 0.1) / (self.n + 0.1 * (self.known + 1)))


def _send_histories(one: Unigrams, d2: np.ndarray, buckets: int):
    """kind 0: per history the bucket's sums of discounted counts, counts and unigram chances of the words after it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _each(batch):
                runs, word_count, c = _unzip(row["data"], 3)
                h, c = _eight(row["histories"]), c.astype(np.int64)
                if not len(h):
                    continue
                p = np.repeat(one.chance(word_count.astype(np.int64)), runs)
                order = np.argsort(h, kind="stable")
                at = _runs(h[order])
                c, p = c[order], p[order]
                history = h[order][at]
                sums = [np.add.reduceat(x, at) for x in (d2[np.minimum(c, DISCOUNTED) * (c <= DISCOUNTED)] * c, c.astype(float), p)]
                bucket = _spread(history, buckets)
                for k in np.unique(bucket).tolist():
                    own = bucket == k
                    yield _rows([(0, k, -1, b"".join([_six(history[own]), *[s[own].tobytes() for s in sums]]))], PACK)

    return run


def _backoff(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """kind 1: answers to a block (denominators and weights of its histories); kind 2: the bucket's table."""
    for bucket, rows in _groups(batches, "bucket"):
        parts = [r["data"] for r in rows if r["kind"] == 0]
        hs, sums = [], []
        for x in parts:
            n = len(x) // 30
            hs.append(_eight(x[: 6 * n]))
            sums.append(np.frombuffer(x[6 * n :], np.float64).reshape(3, n))
        h = np.concatenate(hs) if hs else np.empty(0, np.uint64)
        s = np.concatenate(sums, axis=1) if sums else np.empty((3, 0))
        order = np.argsort(h, kind="stable")
        h, s = h[order], s[:, order]
        at = _runs(h)
        h = h[at]
        discounted, count, chance = np.add.reduceat(s, at, axis=1) if len(at) else s
        total = count + (count - discounted < 1e-9)
        weight = (1 - discounted / total) / (1 - chance)
        yield _rows([(2, bucket, -1, b"".join([_six(h), total.tobytes(), weight.tobytes()]))], PACK)
        for r in rows:
            if r["kind"] == 1:
                asked = _eight(r["data"])
                place = np.minimum(np.searchsorted(h, asked), max(0, len(h) - 1))
                found = h[place] == asked if len(h) else np.zeros(len(asked), bool)
                values = [np.where(found, x[place], 1.0) if len(h) else np.ones(len(asked)) for x in (total, weight)]
                yield _rows([(1, bucket, r["block"], b"".join(x.tobytes() for x in values))], PACK)


SCORES = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])
SCORES_DDL = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _score(common: np.ndarray, buckets: int, one: Unigrams, d2: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _groups(batches, "block"):
            row = next(r for r in rows if r["kind"] == -1)
            b = _load(row)
            w, h, _ = b.pairs()
            order, at = _order(b, w, h, common, buckets)
            pair, word = np.zeros(len(w), np.int64), np.zeros(len(b.words), np.int64)
            total, weight = np.ones(len(b.words) + 1), np.ones(len(b.words) + 1)
            numbers = np.unique(h)
            bucket = _spread(b.hashes(numbers), buckets)
            for r in rows:
                k = r["bucket"]
                if r["kind"] == 0:
                    own = order[at[k] : at[k + 1]]
                    pair[own], counts = _unzip(r["data"], 2)
                    word[w[own][_runs(w[own])]] = counts
                elif r["kind"] == 1:
                    x = np.frombuffer(r["data"], np.float64).reshape(2, -1)
                    total[numbers[bucket == k]], weight[numbers[bucket == k]] = x
            with np.errstate(divide="ignore"):
                seen = d2[np.minimum(pair, DISCOUNTED) * (pair <= DISCOUNTED)] * pair / total[h]
                value = np.log10(np.where(pair > 0, seen, weight[h] * one.chance(word)[w]))
            of = np.searchsorted(w * (len(b.words) + 1) + h, b.key)
            score = np.add.reduceat(value[of], b.first)
            base = np.add.reduceat(one.base(word)[b.token], b.first)
            known = np.add.reduceat((word > 0)[b.token].astype(np.int64), b.first)
            n = len(b.sizes)
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip((row["ids"], row["held"], b.sizes, known, np.full(n, one.n), base, score), SCORES)], schema=SCORES)

    return run


def fit_and_score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK, bucket: int = BUCKET, common_share: int = COMMON) -> DataFrame:
    """Learns from the rows whose crc32(id as text) mod 10 is not 0 and scores all: (id, held_out, n_tokens, n_known,
    train_tokens, base_score, score). A null text is empty: one end; a null id counts as the empty text. Repeated rows
    are learnt and scored as often as they occur. With no training rows every word is unknown, with chance 1."""
    spark = docs.sparkSession
    path = work_path(spark, "katz")
    arrow_map(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")), lambda batches: _make_blocks(batches, block, common_share), BLOCKS_DDL).write.parquet(f"{path}/blocks")
    blocks = spark.read.parquet(f"{path}/blocks")
    total = blocks.agg(F.sum("trained").alias("n"), F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x)).alias("all")).first()
    n, buckets = total["n"] or 0, max(8, -(-(total["all"] or 0) // bucket))
    common, totals = _common_words(blocks, n, common_share)
    sent = arrow_map(blocks.select("block", "sizes", "held", "words", "token"), _send_pairs(common, buckets), PACK_DDL)
    spread = sent.repartitionById(buckets, F.col("bucket").cast("int")).sortWithinPartitions("bucket", "block")
    counted_path = f"{path}/ngrams"
    arrow_map(spread, _route(common, totals), COUNTED_DDL).write.partitionBy("kind").parquet(counted_path)
    counted = spark.read.schema(COUNTED_DDL).parquet(counted_path)
    of = counted.filter("kind = 2").agg(F.sum("known").alias("known"), *[F.coalesce(F.sum(F.col(c)[r]), F.lit(0)).alias(f"{c}_{r}") for c in ("of1", "of2") for r in range(DISCOUNTED + 2)]).first()
    one = Unigrams(n, (of["known"] or 0) + len(common), [of[f"of1_{r}"] + int((totals == r).sum()) for r in range(DISCOUNTED + 2)])
    d2 = discounts([of[f"of2_{r}"] for r in range(DISCOUNTED + 2)])
    sums = arrow_map(counted.filter("kind = 2").select("data", "histories"), _send_histories(one, d2, buckets), PACK_DDL)
    asked = counted.filter("kind = 1").select("kind", "bucket", "block", "data")
    gathered = sums.unionByName(asked).repartitionById(buckets, F.col("bucket").cast("int")).sortWithinPartitions("bucket", "block")
    arrow_map(gathered, _backoff, PACK_DDL).write.partitionBy("kind").parquet(f"{path}/backoff")
    backoff = spark.read.schema(PACK_DDL).parquet(f"{path}/backoff").filter("kind = 1")
    answers = counted.filter("kind = 0").select("kind", "bucket", "block", "data").unionByName(backoff.select("kind", "bucket", "block", "data"))
    own = blocks.select(F.lit(-1).alias("kind"), F.lit(-1).cast("long").alias("bucket"), "block", "ids", "sizes", "held", "words", "token")
    together = own.unionByName(answers, allowMissingColumns=True)
    parts = max(spark.sparkContext.defaultParallelism, -(-(total["all"] or 0) // bucket))
    # blocks are dealt out evenly by their numbers, as several of one task would be held at once
    turn = F.shiftright("block", 24) + F.col("block").bitwiseAND(F.lit((1 << 24) - 1)) * F.lit(parts // 2 + 1)
    ready = together.repartitionById(parts, F.pmod(turn, F.lit(parts)).cast("int")).sortWithinPartitions("block", "kind", "bucket")
    return arrow_map(ready, _score(common, buckets, one, d2), SCORES_DDL).withColumnRenamed("doc_id", id_col)


def _route(common: np.ndarray, totals: np.ndarray):
    """Adds up a bucket's pairs; the requests for histories pass through."""
    add_up = _add_up(common, totals)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []

        def pairs() -> Iterator[pa.RecordBatch]:
            for b in batches:
                asks = b.filter(pa.compute.equal(b.column("kind"), 1))
                if asks.num_rows:
                    waiting.append(asks)
                yield b.filter(pa.compute.equal(b.column("kind"), 0))

        def flush() -> Iterator[pa.RecordBatch]:
            while waiting:
                a = waiting.pop()
                m = a.num_rows
                yield pa.RecordBatch.from_arrays([*a.columns, *[pa.nulls(m, t.type) for t in list(COUNTED)[4:]]], schema=COUNTED)

        for out in add_up(pairs()):
            yield from flush()
            yield out
        yield from flush()

    return run


def _common_words(blocks: DataFrame, n: int, share: int) -> tuple[np.ndarray, np.ndarray]:
    """Words with more than 1 / share of the training tokens, and their counts.

    Blocks list the words with more than 1 / (2 share) of their own tokens. What a word has in blocks that don't list it
    is at most 1 / (2 share) of all tokens, so one that is common has more than that in those that do.
    """
    listed = blocks.select(F.explode(F.arrays_zip("often", "often_counts")).alias("x")).groupBy(F.col("x.often").alias("w")).agg(F.sum("x.often_counts").alias("c"))
    words = np.array(sorted(r["w"] for r in listed.filter(F.col("c") * (2 * share) > n).select("w").collect()), np.uint64)  # below 2 * share

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                own, counts = _eight(row["words"]), _unzip(row["counts"], 1)[0].astype(np.int64)
                _, here, there = np.intersect1d(own, words, return_indices=True)
                yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(counts[here])], names=["i", "c"])

    if not len(words):
        return words, np.empty(0, np.int64)
    counted = {r["i"]: r["c"] for r in arrow_map(blocks.select("words", "counts"), run, "i long, c long").groupBy("i").agg(F.sum("c").alias("c")).collect()}
    totals = np.array([counted.get(i, 0) for i in range(len(words))], np.int64)
    kept = totals * share > n
    return words[kept], totals[kept]
