"""Toxicity scores by logistic regression on hashed word n-grams and skip-grams, trained with FTRL-proximal.

Every coordinate has its own learning rate and an L1 penalty, so that most weights stay exactly zero: the model is a
short list of (feature, weight), at most 2**bits of them, and is sent to all tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ROW, arrow_map, as_given, fold_of, numbered, stored, without_rows
from .wordpieces import blocks

BITS = 20
#: Bound of the labelled sample that the model is fitted on, in rows; a smaller training set is used whole.
TRAIN_ROWS = 20_000
#: Bound of what the fitting task holds, in features (four bytes each); texts that would exceed it are left out of the sample.
TRAIN_FEATURES = 60_000_000
#: FTRL-proximal: learning rate, its offset, L1, L2, passes.
ALPHA, BETA, L1, L2, EPOCHS = 1.0, 1.0, 4.0, 0.0, 4
FOLDS, HELD_OUT, THRESHOLD = 4, 2, 0.3
#: Bytes of text whose features are held at a time, or one text.
BLOCK = 1 << 20
#: ASCII signs and controls end a word; letters, digits and everything beyond ASCII belong to it.
_SIGNS = bytes(c if c > 127 or chr(c).isalnum() else 32 for c in range(256))
#: Odd 64-bit multipliers that tell apart words, pairs and pairs with a gap; any odd numbers serve.
_ODD = [np.uint64(x | 1) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]


class _Hashes(dict):
    """word -> 64-bit hash; remembers at most so many."""

    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh64_intdigest(word)
        if len(self) < 100_000:
            self[word] = h
        return h


_hashes = _Hashes()


def features(texts: list[bytes], bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """(number of the text, feature) of every word, adjacent pair and pair with one word between; repeats included.

    Words are lower-cased runs of letters, digits and characters beyond ASCII.
    """
    words, counts = [], []
    for t in texts:
        own = t.decode("utf-8", "replace").lower().encode().translate(_SIGNS).split()
        words += own
        counts.append(len(own))
    h = np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))
    doc = np.repeat(np.arange(len(texts)), counts)
    shift = np.uint64(64 - bits)
    out = [(doc, (h * _ODD[0]) >> shift)]
    for gap, a, b in ((1, _ODD[1], _ODD[2]), (2, _ODD[3], _ODD[4])):
        same = doc[:-gap] == doc[gap:]
        mixed = (h[:-gap] * a) ^ ((h[gap:] * b) >> np.uint64(7))
        out.append((doc[:-gap][same], ((mixed * _ODD[0]) >> shift)[same]))
    return np.concatenate([x for x, _ in out]), np.concatenate([x for _, x in out]).astype(np.int64)


def ftrl(rows: list[tuple[np.ndarray, int]], bits: int = BITS, epochs: int = EPOCHS) -> np.ndarray:
    """Weights for 2**bits features and, last, the constant term. rows: (different features, label)."""
    size = (1 << bits) + 1
    z, n = np.zeros(size), np.zeros(size)

    def weights(i) -> np.ndarray:
        return np.where(np.abs(z[i]) <= L1, 0.0, -(z[i] - np.sign(z[i]) * L1) / ((BETA + np.sqrt(n[i])) / ALPHA + L2))

    for _ in range(epochs):
        for own, label in rows:
            i = np.append(own, size - 1)
            w = weights(i)
            g = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - label
            z[i] += g - (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / ALPHA * w
            n[i] += g * g
    return weights(slice(None))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", rows: int = TRAIN_ROWS, bits: int = BITS, most: int = TRAIN_FEATURES) -> DataFrame:
    """Model (feature, weight) from the labelled documents outside the held-out fold; the feature 2**bits is the constant.

    Labels that are null or lack an id are left out; of several labels of an id the highest counts, of several texts of
    a labelled id one. If there are more than `rows` labels, a hash of the id picks about so many; of these, in the order
    of another hash, a text that would bring the features above `most` is left out. Null and empty texts have no
    features and count for the constant. No labels: no rows.
    """
    known = labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("label")).dropna()
    known = stored(known.filter(fold_of(F.col("id"), FOLDS) != HELD_OUT).groupBy("id").agg(F.max("label").alias("label")), "labels")
    part = min(1.0, rows / max(1, known.count()))
    sample = known.filter(F.pmod(F.xxhash64(F.col("id"), F.lit("sample")), F.lit(1 << 30)) < int(part * (1 << 30)))  # so its size is bounded: about `rows`
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).join(F.broadcast(sample), "id")

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            done = 0
            for block in blocks(b.column("text"), BLOCK):
                doc, f = features(block, bits)
                key = np.unique((doc << bits) | f)
                at = np.searchsorted(key, np.arange(len(block) + 1) << bits)
                lists = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array((key & ((1 << bits) - 1)).astype(np.int32)))
                yield pa.RecordBatch.from_arrays([*[b.column(c).slice(done, len(block)) for c in ("id", "label")], lists], names=["id", "label", "features"])
                done += len(block)

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        data, held = [], 0
        for b in batches:
            for f, y in zip(b.column("features"), b.column("label").to_pylist()):
                if held + len(f) <= most:
                    data.append((np.array(f.values, np.int32), y))
                    held += len(f)
        if data:
            w = ftrl(data, bits)
            kept = np.flatnonzero(w)
            yield pa.RecordBatch.from_arrays([pa.array(kept), pa.array(w[kept])], names=["feature", "weight"])

    found = arrow_map(texts, featurise, "id long, label int, features array<int>").groupBy("id").agg(F.max("label").alias("label"), F.max("features").alias("features"))
    ordered = found.repartition(1).sortWithinPartitions(F.xxhash64(F.col("id"), F.lit("order")))
    return stored(arrow_map(ordered, fit, "feature long, weight double"), "toxicity-model")


def score(docs: DataFrame, model: DataFrame, text_col: str = "text", bits: int = BITS) -> DataFrame:
    """docs without the text and with score: the model's probability, 0 without a model. Null counts as empty; an empty
    text has the constant's score, equal texts equal ones; an empty table gives an empty result."""
    rows = model.toPandas()  # at most 2**bits + 1 rows
    sparse = docs.sparkSession.sparkContext.broadcast((rows["feature"].to_numpy(np.int64), rows["weight"].to_numpy(float)))
    rest = [c for c in docs.columns if c != text_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, w = sparse.value
        weight = np.zeros((1 << bits) + 1)
        weight[at] = w
        for b in batches:
            out = []
            for block in blocks(b.column(text_col), BLOCK):
                doc, f = features(block, bits)
                hit = weight[f] != 0
                key = np.unique((doc[hit] << bits) | f[hit])
                total = weight[-1] + np.bincount(key >> bits, weight[key & ((1 << bits) - 1)], len(block))
                out.append(1 / (1 + np.exp(-np.clip(total, -35, 35))) if len(at) else np.zeros(len(block)))
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in rest], pa.array(np.concatenate(out) if out else np.empty(0))], names=[*rest, "score"])

    return arrow_map(docs.select(*rest, text_col), run, docs.select(*rest).withColumn("score", F.lit(0.0)).schema)


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(_row, id, held_out, score, predicted) for every row. The score depends on the text alone."""
    model = train(docs, labels, id_col, text_col)
    rows = docs.select(F.monotonically_increasing_id().alias("_row"), F.col(id_col), F.col(text_col).alias("_text"))
    return score(rows, model, "_text").select("_row", id_col, (fold_of(F.col(id_col), FOLDS) == HELD_OUT).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """docs without the rows scored at or above the threshold; all columns stay. Null texts are scored as empty ones.
    Without usable labels all rows stay; repeated rows get equal scores; an empty table gives an empty result."""
    model = train(docs, labels, id_col, text_col)
    rows = numbered(docs)
    bad = stored(score(rows.select(ROW, F.col(text_col).alias("_text")), model, "_text").filter(F.col("score") >= threshold).select(ROW), "toxic")
    return as_given(without_rows(rows, bad), docs)
