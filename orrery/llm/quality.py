"""Quality scores by a generalised additive model with pairwise interactions.

The features of a text fall into bins. Boosting goes round the features in cycles, each time growing one shallow tree on
one feature's bins; the trees of a feature add up to a lookup table. The pairs of features whose residuals show the most
interaction then get tables of their own in the same way. A text's score is the sum of the table entries of its bins.

Several bags, each leaving out another part of the sample to stop on, are fitted in tasks of their own and averaged.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, fold_of, stored
from .wordpieces import blocks

#: Bound of the labelled sample that the model is fitted on, in rows; a smaller training set is used whole.
TRAIN_ROWS = 20_000
BAGS, BINS, PAIR_BINS, PAIRS = 4, 32, 8, 6
RATE, ROUNDS, PATIENCE, LEAVES, LEAST_ROWS = 0.15, 150, 15, 3, 10
FOLDS, HELD_OUT, THRESHOLD = 5, 0, 0.3
#: Bytes of text whose features are worked out at a time; a longer text is taken in parts cut at white space.
BLOCK = 1 << 20
#: Shortest line, in bytes, that counts in the features of the worst line.
LINE = 20

FEATURES = [
    "log_bytes", "upper_share", "symbol_share", "digit_share", "stop_rate", "word_length", "line_rate", "beyond_ascii_share", "repeat_share", "near_repeat_share", "capital_word_share", "symbol_end_share", "lone_symbol_share",
    "worst_symbol_line", "worst_upper_line", "worst_repeat_line", "worst_lone_symbol_line", "repeated_line_share",
]
_LOWER, _UPPER, _DIGIT, _STOP, _SYMBOL, _BEYOND, _SPACE, _END = range(8)


def _classes() -> np.ndarray:
    out = np.full(256, _SYMBOL, np.uint8)
    for c in range(256):
        if c > 127:
            out[c] = _BEYOND
        elif chr(c).isdigit():
            out[c] = _DIGIT
        elif chr(c).isalpha():
            out[c] = _UPPER if chr(c).isupper() else _LOWER
        elif chr(c) in " \t\r\x0b\x0c":
            out[c] = _SPACE
        elif chr(c) in ".,;:'?-\"()":
            out[c] = _STOP
    out[10] = _END
    return out


_CLASS = _classes()
_ODD = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_ODD), -1, 1 << 64))
#: Sums that a text's parts add up to, and shares of lines of which the largest counts.
_SUMS = ("bytes", "lower", "upper", "digit", "stop", "symbol", "beyond", "words", "lines", "repeats", "near_repeats", "capital", "symbol_end", "lone_symbol", "lines_told", "repeated_lines")
_WORST = 4


def _powers(base: np.uint64, n: int) -> np.ndarray:
    return np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(n, base, np.uint64))])


class _Text:
    """Sums and worst lines of the texts of a block, one row each."""

    def __init__(self) -> None:
        self.up, self.down = np.ones(1, np.uint64), np.ones(1, np.uint64)

    def __call__(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        n = len(texts)
        sums, worst = np.zeros((n, len(_SUMS))), np.zeros((n, _WORST))
        # a line end before every text keeps words and lines apart
        sizes = np.fromiter(map(len, texts), np.int64, n) + 1
        raw = np.frombuffer(b"".join(b"\n" + t for t in texts) + b"\n", np.uint8)
        if len(raw) > len(self.up):
            self.up, self.down = _powers(_ODD, 2 * len(raw)), _powers(_INVERSE, 2 * len(raw))
        kind = _CLASS[raw]
        first = np.concatenate([[0], np.cumsum(sizes)])[:-1]
        doc_of = lambda at: np.searchsorted(first, at, "right") - 1
        per_doc = np.stack([np.add.reduceat(kind[:-1] == k, first, dtype=np.int64) for k in range(8)], 1)
        sums[:, 0] = sizes - 1
        sums[:, 1:7] = per_doc[:, [_LOWER, _UPPER, _DIGIT, _STOP, _SYMBOL, _BEYOND]]
        sums[:, 8] = per_doc[:, _END] - 1
        hashed = np.concatenate([np.zeros(1, np.uint64), np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * self.up[: len(raw)])])
        digest = lambda a, z: (hashed[z] - hashed[a]) * self.down[a]

        blank = kind >= _SPACE
        edge = np.diff(blank.astype(np.int8))
        begin, end = np.flatnonzero(edge == -1) + 1, np.flatnonzero(edge == 1) + 1
        of, h = doc_of(begin), digest(begin, end)
        count = lambda flags: np.bincount(of[flags], minlength=n)
        sums[:, 7] = np.bincount(of, minlength=n)
        same = lambda gap: np.concatenate([np.zeros(min(gap, len(h)), bool), (h[gap:] == h[:-gap]) & (of[gap:] == of[:-gap])])
        repeat = same(1)
        near = same(2) | same(3) | same(4)
        totals = lambda k: np.concatenate([[0], np.cumsum(kind == k)])
        symbol, upper, lower, beyond = totals(_SYMBOL), totals(_UPPER), totals(_LOWER), totals(_BEYOND)
        within = lambda t, a, z: t[z] - t[a]
        capital = (within(upper, begin, end) > 1) & (within(lower, begin, end) == 0)
        lone = within(symbol, begin, end) == end - begin
        for at, flags in ((9, repeat), (10, near), (11, capital), (12, (kind[end - 1] == _SYMBOL) & ~lone), (13, lone)):
            sums[:, at] = count(flags)

        ends = np.flatnonzero(kind == _END)
        a, z = ends[:-1] + 1, ends[1:]
        line_of = doc_of(ends[:-1])
        told = z - a >= LINE
        a, z, line_of = a[told], z[told], line_of[told]
        if len(a):
            words_before = lambda flags: np.concatenate([[0], np.cumsum(flags)])
            w0, w1 = np.searchsorted(begin, a), np.searchsorted(begin, z)
            words = np.maximum(w1 - w0, 1)
            letters = np.maximum(within(upper, a, z) + within(lower, a, z) + within(beyond, a, z), 1)
            rates = (within(symbol, a, z) / (z - a), within(upper, a, z) / letters, within(words_before(repeat | near), w0, w1) / words, within(words_before(lone), w0, w1) / words)
            for k, r in enumerate(rates):
                np.maximum.at(worst[:, k], line_of, r)
            lines = digest(a, z)
            again = np.concatenate([[False], (lines[1:] == lines[:-1]) & (line_of[1:] == line_of[:-1])])
            sums[:, 14], sums[:, 15] = np.bincount(line_of, minlength=n), np.bincount(line_of[again], minlength=n)
        return sums, worst


def _features(sums: np.ndarray, worst: np.ndarray) -> np.ndarray:
    s = dict(zip(_SUMS, sums.T))
    over = lambda a, b: a / np.maximum(b, 1)
    letters = s["lower"] + s["upper"] + s["beyond"]
    told = [
        np.log1p(s["bytes"]), over(s["upper"], letters), over(s["symbol"], s["bytes"]), over(s["digit"], s["bytes"]), over(s["stop"], s["words"]), over(letters, s["words"]), over(s["lines"], s["words"]), over(s["beyond"], letters), over(s["repeats"], s["words"]), over(s["near_repeats"], s["words"]),
        over(s["capital"], s["words"]), over(s["symbol_end"], s["words"]), over(s["lone_symbol"], s["words"]),
    ]
    return np.column_stack([*told, worst, over(s["repeated_lines"], s["lines_told"])])


def _parts(text: bytes) -> list[bytes]:
    out, a = [], 0
    while len(text) - a > BLOCK:
        z = max(text.rfind(x, a + 1, a + BLOCK) for x in (b" ", b"\n", b"\t", b"\r"))
        z = z if z > a else a + BLOCK  # one word
        out.append(text[a:z])
        a = z
    return [*out, text[a:]]


def text_features(texts: list[bytes], told: _Text | None = None) -> np.ndarray:
    """One row of FEATURES per text. Of a text of more than BLOCK, words and lines that its parts cut count as two."""
    told = told or _Text()
    out = []
    for group in blocks(pa.array(texts, pa.large_binary()), BLOCK):
        if len(group) == 1 and len(group[0]) > BLOCK:
            each = [told([p]) for p in _parts(group[0])]
            out.append(_features(sum(s for s, _ in each), np.maximum.reduce([w for _, w in each])))
        else:
            out.append(_features(*told(group)))
    return np.concatenate(out) if out else np.empty((0, len(FEATURES)))


def binned(values: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    """Bin numbers; a value equal to an edge lies above it."""
    return np.column_stack([np.searchsorted(e, values[:, k], "right") for k, e in enumerate(edges)]).astype(np.uint8).reshape(len(values), len(edges))


def _step(g: np.ndarray, h: np.ndarray) -> float:
    return float(np.clip(g.sum() / (h.sum() + 1.0), -3, 3))


def tree_table(g: np.ndarray, h: np.ndarray, n: np.ndarray, leaves: int = LEAVES, least: int = LEAST_ROWS) -> np.ndarray:
    """The values per bin of a tree with at most so many leaves, each of at least `least` rows: the best cut first.
    g, h, n: sums of gradients, of curvatures and of rows by bin."""
    cuts = [0, len(g)]
    gain_of = lambda a, z: g[a:z].sum() ** 2 / (h[a:z].sum() + 1.0)
    while len(cuts) <= leaves:
        best = (1e-9, None)
        for a, z in zip(cuts, cuts[1:]):
            for c in range(a + 1, z):
                if min(n[a:c].sum(), n[c:z].sum()) >= least:
                    best = max(best, (gain_of(a, c) + gain_of(c, z) - gain_of(a, z), c), key=lambda x: x[0])
        if best[1] is None:
            break
        cuts = sorted([*cuts, best[1]])
    return np.concatenate([np.full(z - a, _step(g[a:z], h[a:z])) for a, z in zip(cuts, cuts[1:])])


def quadrants(g: np.ndarray, h: np.ndarray, n: np.ndarray, least: int = LEAST_ROWS) -> tuple[float, np.ndarray]:
    """(gain, values per cell) of the best pair of cuts, one in each dimension; all arguments by cell."""
    best, out = 0.0, np.zeros(g.shape)
    sums = [np.pad(x.cumsum(0).cumsum(1), ((1, 0), (1, 0))) for x in (g, h, n)]
    rows, columns = g.shape
    box = lambda t, a, b, c, d: t[b, d] - t[a, d] - t[b, c] + t[a, c]
    for i in range(1, rows):
        for j in range(1, columns):
            parts = [(a, b, c, d) for a, b in ((0, i), (i, rows)) for c, d in ((0, j), (j, columns))]
            if min(box(sums[2], *p) for p in parts) < least:
                continue
            gain = sum(box(sums[0], *p) ** 2 / (box(sums[1], *p) + 1.0) for p in parts) - sums[0][-1, -1] ** 2 / (sums[1][-1, -1] + 1.0)
            if gain > best:
                best, out = gain, np.zeros(g.shape)
                for a, b, c, d in parts:
                    out[a:b, c:d] = np.clip(box(sums[0], a, b, c, d) / (box(sums[1], a, b, c, d) + 1.0), -3, 3)
    return best, out


def _probability(margin: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(margin, -35, 35)))


def _loss(margin: np.ndarray, y: np.ndarray) -> float:
    return float(np.mean(np.logaddexp(0, margin) - y * margin)) if len(y) else 0.0


def boost(cells: list[np.ndarray], shapes: list[tuple[int, ...]], y: np.ndarray, fit: np.ndarray, margin: np.ndarray, rounds: int = ROUNDS) -> list[np.ndarray]:
    """Tables by cyclic boosting. cells: for every term, each row's cell number in a table of its shape; fit: the rows
    that are learned from, the others tell when to stop; margin: each row's score so far."""
    tables = [np.zeros(s) for s in shapes]
    counts = [np.bincount(c[fit], minlength=math.prod(s)).reshape(s) for c, s in zip(cells, shapes)]
    best, kept, margin, waited = _loss(margin[~fit], y[~fit]), [t.copy() for t in tables], margin.copy(), 0
    for _ in range(rounds):
        for k, (c, s) in enumerate(zip(cells, shapes)):
            p = _probability(margin)
            g, h = (np.bincount(c[fit], v[fit], math.prod(s)).reshape(s) for v in (y - p, p * (1 - p)))
            step = RATE * (tree_table(g, h, counts[k]) if len(s) == 1 else quadrants(g, h, counts[k])[1])
            tables[k] += step
            margin += step.ravel()[c]
        loss = _loss(margin[~fit], y[~fit])
        if loss < best - 1e-6 or fit.all():
            best, kept, waited = loss, [t.copy() for t in tables], 0
        else:
            waited += 1
            if waited >= PATIENCE:
                break
    return kept


def _coarse(bins: np.ndarray) -> np.ndarray:
    return bins.astype(np.int64) * PAIR_BINS // BINS


def fit_bag(bins: np.ndarray, y: np.ndarray, fit: np.ndarray, pairs: list[tuple[int, int]] | None = None) -> tuple[float, list[np.ndarray], list[float], list[np.ndarray]]:
    """(constant, tables of the features, strengths of all pairs, tables of `pairs`) learned from one bag."""
    rate = (y[fit].sum() + 0.5) / (fit.sum() + 1.0)
    constant = math.log(rate / (1 - rate))
    columns = [bins[:, k].astype(np.int64) for k in range(bins.shape[1])]
    tables = boost(columns, [(BINS,)] * len(columns), y, fit, np.full(len(y), constant))
    margin = constant + sum(t[c] for t, c in zip(tables, columns))
    coarse, p = _coarse(bins), _probability(margin)
    cell = lambda i, j: coarse[:, i] * PAIR_BINS + coarse[:, j]
    if pairs is None:
        strengths = []
        for i, j in combinations(range(len(columns)), 2):
            sums = [np.bincount(cell(i, j)[fit], v[fit], PAIR_BINS**2).reshape(PAIR_BINS, PAIR_BINS) for v in (y - p, p * (1 - p), np.ones(len(y)))]
            strengths.append(quadrants(*sums)[0])
        return constant, tables, strengths, []
    return constant, tables, [], boost([cell(i, j) for i, j in pairs], [(PAIR_BINS, PAIR_BINS)] * len(pairs), y, fit, margin, ROUNDS // 2)


def _featured(docs: DataFrame, keep: list[str], text_col: str) -> DataFrame:
    """The columns `keep` and features array<double> of every row; a null text counts as empty."""
    schema = docs.select(*keep).withColumn("features", F.array(F.lit(0.0))).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told = _Text()
        for b in batches:
            done = 0
            for group in blocks(b.column(text_col), BLOCK):
                x = text_features(group, told)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32()), pa.array(x.ravel()))
                yield pa.RecordBatch.from_arrays([*[b.column(c).slice(done, len(group)) for c in keep], lists], names=[*keep, "features"])
                done += len(group)

    return arrow_map(docs.select(*keep, text_col), run, schema)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", rows: int = TRAIN_ROWS) -> DataFrame:
    """The model, from the labelled documents outside the held-out fold: (term, first, second, edges, table). Term 0 is
    the constant; a term of one feature has second null, its bin edges and its table; a pair has its table by rows.

    Labels that are null or lack an id are left out; of several labels of an id the highest counts, of several texts of
    a labelled id one. If there are more than `rows` labels, a hash of the id picks about so many. The fitting tasks, one
    a bag, hold a few bytes a row. Without labels the model is the constant 0.
    """
    spark = docs.sparkSession
    known = labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("label")).dropna()
    known = stored(known.filter(fold_of(F.col("id"), FOLDS) != HELD_OUT).groupBy("id").agg(F.max("label").alias("label")), "quality-labels")
    part = min(1.0, rows / max(1, known.count()))
    sample = known.filter(F.pmod(F.xxhash64(F.col("id"), F.lit("quality")), F.lit(1 << 30)) < int(part * (1 << 30)))  # about `rows`, so broadcast
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).join(F.broadcast(sample), "id")
    found = stored(_featured(texts, ["id", "label"], "text").groupBy("id").agg(F.max("label").alias("label"), F.max("features").alias("features")), "quality-sample")
    quantiles = [q / BINS for q in range(1, BINS)]
    cuts = found.agg(*[F.percentile_approx(F.col("features")[k], quantiles, 1000).alias(f"q{k}") for k in range(len(FEATURES))]).first()
    edges = [np.unique(np.array(c or [], float)) for c in cuts]

    def bags(pairs: list[tuple[int, int]] | None) -> list:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own: dict[int, list] = {}
            for b in batches:
                numbers = b.column("bag").to_numpy()
                x = binned(b.column("features").flatten().to_numpy().reshape(len(b), -1), edges)
                for n in np.unique(numbers).tolist():
                    at = numbers == n
                    own.setdefault(n, []).append((x[at], b.column("label").to_numpy()[at] > 0, b.column("part").to_numpy()[at] != n))
            for n, got in own.items():
                x, y, fit = (np.concatenate(v) for v in zip(*got))
                constant, tables, strengths, of_pairs = fit_bag(x, y.astype(float), fit if fit.any() else ~fit, pairs)
                flat = lambda t: np.concatenate([v.ravel() for v in t]) if t else np.empty(0)
                yield pa.RecordBatch.from_pydict({"constant": [constant], "tables": [flat(tables)], "strengths": [np.array(strengths)], "pairs": [flat(of_pairs)]}, pa.schema([("constant", pa.float64()), *[(c, pa.list_(pa.float64())) for c in ("tables", "strengths", "pairs")]]))

        rows_of = found.select("features", "label", F.pmod(F.xxhash64("id", F.lit("part")), F.lit(5)).cast("int").alias("part"), F.explode(F.array(*[F.lit(i) for i in range(BAGS)])).alias("bag"))
        # the same order whatever the partitions were, so that reruns agree
        return arrow_map(rows_of.repartition(BAGS, "bag").sortWithinPartitions("bag", "part", "features", "label"), run, "constant double, tables array<double>, strengths array<double>, pairs array<double>").collect()

    first = bags(None)  # a few thousand numbers a bag
    schema = "term int, first int, second int, edges array<double>, table array<double>"
    if not first:
        return stored(spark.createDataFrame([(0, None, None, [], [0.0])], schema), "quality-model")
    strengths = np.mean([r["strengths"] for r in first], 0)
    every = list(combinations(range(len(FEATURES)), 2))
    pairs = [every[k] for k in np.argsort(-strengths, kind="stable")[:PAIRS] if strengths[k] > 0]
    second = bags(pairs) if pairs else []
    mean = lambda got, c: np.mean([r[c] for r in got], 0)
    out = [(0, None, None, [], [float(np.mean([r["constant"] for r in first]))])]
    for k, t in enumerate(mean(first, "tables").reshape(-1, BINS)):
        out.append((len(out), k, None, edges[k].tolist(), t.tolist()))
    for (i, j), t in zip(pairs, mean(second, "pairs").reshape(-1, PAIR_BINS**2) if pairs else []):
        out.append((len(out), i, j, [], t.tolist()))
    return stored(spark.createDataFrame(out, schema).coalesce(1), "quality-model")


def score(docs: DataFrame, model: DataFrame, keep: list[str], text_col: str = "text") -> DataFrame:
    """The columns `keep` of docs and score, the model's probability of label 1. Null counts as empty; equal texts have
    equal scores; an empty table gives an empty result."""
    terms = sorted(model.collect(), key=lambda r: r["term"])  # a term a feature or pair
    constant = terms[0]["table"][0]
    single = [(np.array(r["edges"], float), np.array(r["table"])) for r in terms if r["first"] is not None and r["second"] is None]
    pairs = [(r["first"], r["second"], np.array(r["table"])) for r in terms if r["second"] is not None]
    sent = docs.sparkSession.sparkContext.broadcast((constant, single, pairs))

    def margins(x: np.ndarray) -> np.ndarray:
        base, mains, crossed = sent.value
        out = np.full(len(x), base)
        if mains:
            bins = binned(x, [e for e, _ in mains])
            for k, (_, t) in enumerate(mains):
                out += t[bins[:, k]]
            coarse = _coarse(bins)
            for i, j, t in crossed:
                out += t[coarse[:, i] * PAIR_BINS + coarse[:, j]]
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told = _Text()
        for b in batches:
            parts = [margins(text_features(group, told)) for group in blocks(b.column(len(keep)), BLOCK)]
            yield pa.RecordBatch.from_arrays([*[b.column(k) for k in range(len(keep))], pa.array(_probability(np.concatenate(parts)) if parts else np.empty(0))], names=[*keep, "score"])

    return arrow_map(docs.select(*keep, F.col(text_col)), run, docs.select(*keep).withColumn("score", F.lit(0.0)).schema)


def quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(id, held_out, score, predicted) for every row, repeated ones too. The score depends on the text alone; a null id
    counts as the empty text for the fold; columns of other names don't matter."""
    model = train(docs, labels, id_col, text_col)
    rows = docs.select(F.col(id_col), F.col(text_col).alias("_text"))
    return score(rows, model, [id_col], "_text").select(id_col, (fold_of(F.col(id_col), FOLDS) == HELD_OUT).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def drop_poor(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """docs without the rows scored below the threshold; all columns stay."""
    model = train(docs, labels, id_col, text_col)
    aside = "_given_score"
    rows = docs.withColumnRenamed("score", aside)
    kept = score(rows, model, rows.columns, text_col).filter(F.col("score") >= threshold)
    return kept.select(*[F.col(aside).alias(c) if c.lower() == "score" else F.col(f"`{c}`") for c in docs.columns])
