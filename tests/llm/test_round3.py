"""Alignment, whitening and the quality model against plain versions, on tables with nulls, repeats, ties and clashing names."""

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from orrery.llm import alignment, common, quality, queries, whitening
from orrery.llm.common import stored

from .test_ops import SCHEMA, _rows

A, B = (queries.vocabulary(x) for x in queries.SIDES)


# --- alignment

TEXTS = [
    "It's a plain text, isn't it?", "  two  blanks   and\ttabs\n\nlines \n", " ", "\n", "a", "été naïve ☃ 漢字 𝔘", "x<|endoftext|>y </s> <unk> <0x41>", "carriage\r\nreturn;\r\n", "hard space  and em\x0bvt", "\x1c sep \x1d", "ﬁ ½ ①", "a" * 300, "don't " * 40,
    "\tstarts with a tab", " leading", "trailing ", "한국어 텍스트", "1234567890 3.14", "▁ mark ▁▁x", "\x00 nul",
]


@pytest.fixture(scope="module")
def tokenizers():
    import sentencepiece
    from tokenizers import Tokenizer

    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    return a, b


def _plain(tokenizers, text, kind="ends"):
    """(groups, links, byte groups) by walking both sides' tokens byte by byte, or None."""
    if not text:
        return None
    a, b = tokenizers
    chars = alignment._byte_level()
    ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    bytes_a = [bytes(chars[c] for c in a.id_to_token(i)) for i in ids_a]
    bytes_b = [bytes([int(p[3:5], 16)]) if p.startswith("<0x") and len(p) == 6 else p.replace("▁", " ").encode() for p in map(b.id_to_piece, ids_b)]
    whole = (" " + text).encode()
    if b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
        return None
    spans = []
    for parts in (bytes_a, bytes_b):
        at, own = 0, []
        for p in parts:
            own.append((at, at + len(p)))
            at += len(p)
        spans.append(own)
    ends = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
    groups, start = [], 0
    for e in ends:
        groups.append((start, e, [i for i, (s, z) in zip(ids_a, spans[0]) if start <= s and z <= e], [i for i, (s, z) in zip(ids_b, spans[1]) if start <= s and z <= e]))
        start = e
    pairs = []
    for i, (s, e) in zip(ids_a, spans[0]):
        for j, (t, f) in zip(ids_b, spans[1]):
            if kind == "ends" and e == f or kind == "overlap" and max(s, t) < min(e, f):
                pairs.append((i, j))
    if kind == "product":
        pairs = [(i, j) for _, _, x, y in groups for i in x for j in y]
    return len(ids_a), len(ids_b), groups, pairs


def _text_of(groups):
    return ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for _, _, x, y in groups)


def _documents():
    r = random.Random(3)
    words = ["the", "Thntion", "eréa", "don't", "x1,", "(ok)", "\n", "\t", "  ", "☃", "ingth."]
    texts = [" ".join(r.choice(words) for _ in range(r.randrange(1, 80))) for _ in range(30)]
    rows = [(i, t, None, None, None) for i, t in enumerate([*TEXTS, *texts])]
    return rows + [(500, None, None, None, None), (501, "", "en", "a", 0), (None, "null id", None, None, None), (0, texts[0], None, None, None), (3, TEXTS[0], None, None, None), (3, TEXTS[0], None, None, None)]


@pytest.mark.parametrize("kind", alignment.KINDS)
def test_alignment_against_a_walk_over_bytes(spark, tokenizers, kind):
    rows = _documents()
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3).withColumn("ids", F.lit("a clashing name"))
    got = alignment.align_documents(docs, A, B, kind).collect()
    told = [(i, t, _plain(tokenizers, t, kind)) for i, t, *_ in rows]
    counts = Counter(p for _, _, x in told if x for p in x[3])
    most = {}
    for (_, b), n in counts.items():
        most[b] = max(most.get(b, 0), n)
    want = Counter()
    for i, _, x in told:
        if x is None:
            want[i, 0, 0, 0, 0, 0, 0, ""] += 1
        else:
            n_a, n_b, groups, pairs = x
            want[i, n_a, n_b, len(groups), len(pairs), sum(counts[p] == most[p[1]] for p in pairs), sum(counts[p] for p in pairs), hashlib.sha256(_text_of(groups).encode()).hexdigest()] += 1
    assert Counter(tuple(r) for r in got) == want
    assert sum(x is None for *_, x in told) < 12


def test_alignment_in_small_blocks_and_parts(spark, tokenizers, monkeypatch):
    """A text larger than a block, blocks of few texts and a memo that is emptied give the same."""
    known = alignment.Units(alignment.Sides(A, B), "ends")
    assert known.sides.by_units
    monkeypatch.setattr(alignment, "BLOCK", 200)
    monkeypatch.setattr(alignment, "MEMO", 100)
    long = " ".join(f"word{i % 37}, ünd\n" for i in range(300))
    for texts in ([long], [long[:90], "", long[:30]], ["\t" + long]):
        x = alignment._block(known, [t.encode() for t in texts])
        for t, counts, sha in zip(texts, x["counts"].tolist(), x["sha"]):
            p = _plain(tokenizers, t)
            assert (counts, sha) == (([p[0], p[1], len(p[2]), len(p[3])], hashlib.sha256(_text_of(p[2]).encode()).hexdigest()) if p else ([0] * 4, ""))
        want = Counter(q for t in texts for q in (_plain(tokenizers, t) or [[]] * 4)[3])
        assert {(p >> 32, p & 0xFFFFFFFF): n for p, n in zip(x["pairs"].tolist(), x["pair_counts"].tolist())} == dict(want)


def test_groups_and_map_of_the_vocabularies(spark, tokenizers):
    rows = [(i, t, None, None, None) for i, t in enumerate(TEXTS)] + [(100, None, None, None, None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = Counter((r.doc_id, r.group, r.start, r.end, tuple(r.a), tuple(r.b)) for r in alignment.aligned_groups(docs, A, B).collect())
    plain = {i: _plain(tokenizers, t) for i, t, *_ in rows}
    assert got == Counter((i, k, s, e, tuple(x), tuple(y)) for i, p in plain.items() if p for k, (s, e, x, y) in enumerate(p[2]))
    counts = Counter(q for p in plain.values() if p for q in p[3])
    told = {(r.a, r.b): (r["count"], r.best) for r in alignment.token_map(docs, A, B).collect()}
    assert told == {(a, b): (n, n == max(m for (_, y), m in counts.items() if y == b)) for (a, b), n in counts.items()}
    assert alignment.align_documents(docs.limit(0), A, B).count() == 0
    with pytest.raises(ValueError):
        alignment.align_documents(docs, A, B, "other")


def test_intervals_of_random_ends():
    r = np.random.default_rng(1)
    for _ in range(50):
        n = int(r.integers(1, 40))
        a, b = (np.unique(np.append(r.integers(1, n + 1, r.integers(0, n + 1)), n)) for _ in range(2))
        left, right, closes = alignment.intervals(a, b)
        begin = lambda e: np.concatenate([[0], e[:-1]])
        want = [(i, j) for i in range(len(a)) for j in range(len(b)) if max(begin(a)[i], begin(b)[j]) < min(a[i], b[j])]
        assert sorted(zip(left.tolist(), right.tolist())) == want
        assert set(a[left[closes]].tolist()) == set(a.tolist()) & set(b.tolist())
        assert (a[left[closes]] == b[right[closes]]).all()


# --- whitening

VECTORS = "vec_id long, embedding array<float>, label int, x string"


def _vectors(n=300, d=7, offset=0.0, seed=0):
    r = np.random.default_rng(seed)
    v = (r.normal(size=(n, d)) * np.linspace(3, 0.2, d) + offset).astype(np.float32)
    rows = [(i, x.tolist(), 1, "clash") for i, x in enumerate(v)]
    rows += [(1000 + i, rows[5][1], 1, None) for i in range(120)]  # a hot vector
    bad = [None, [None] * d, [float("nan")] * d, [float("inf"), *[0.0] * (d - 1)], [1.0], []]
    return rows + [(2000 + i, x, None, None) for i, x in enumerate(bad)] + [(None, rows[2][1], None, None), rows[3]]


@pytest.mark.parametrize("offset,tile,block", [(0.0, 3, 16), (5000.0, 32, 4096)])
def test_whitening_against_numpy(spark, offset, tile, block):
    rows = _vectors(offset=offset)
    good = [(i, [math.floor(256 * float(np.float32(c))) for c in v]) for i, v, *_ in rows if v and len(v) == 7 and None not in v and np.isfinite(v).all()]
    fit = np.array(sorted(set(tuple(x) for _, x in good)), np.int64)
    n, s = len(fit), fit.sum(0)
    centred = (fit * n - s) / n
    cov = centred.T @ centred / n
    e, vec = np.linalg.eigh(cov)
    e, vec = e[::-1][:4], vec[:, ::-1][:, :4]
    got = whitening.whiten(spark.createDataFrame(rows, VECTORS).repartition(5), tile=tile, row_block=block).collect()
    assert Counter(r.vec_id for r in got) == Counter({i: 4 * m for i, m in Counter(i for i, _ in good).items()})
    by_id = dict(good)
    own = {r.component: r for r in got if r.vec_id == 0}
    first = (np.array(by_id[0]) * n - s) / n
    signs = [np.sign(own[k + 1].whitened * (first @ vec[:, k])) for k in range(4)]
    for r in got:
        if r.vec_id is None:
            continue
        x = np.array(by_id[r.vec_id], object)
        k = r.component - 1
        assert r.n == n and r.deviation == sum((n * int(a) - int(b)) ** 2 for a, b in zip(x, s))
        assert r.whitened == pytest.approx(signs[k] * (((x * n - s) / n).astype(float) @ vec[:, k]) / math.sqrt(e[k]), abs=1e-7)
        assert r.explained == pytest.approx(e[k] / np.trace(cov), rel=1e-9)
        assert r.identity_error < 1e-7 and r.identity_error == got[0].identity_error


def test_whitening_of_few_and_flat_vectors(spark):
    frame = lambda vs: spark.createDataFrame([(i, v, None, None) for i, v in enumerate(vs)], VECTORS)
    assert whitening.whiten(frame([])).count() == 0
    assert whitening.whiten(frame([None, [], []])).count() == 0
    one = whitening.whiten(frame([[1.0, 2.0]] * 3)).collect()
    assert len(one) == 6 and all(r.n == 1 and r.deviation == 0 and r.whitened is None and r.explained is None and r.identity_error is None for r in one)
    flat = {(r.vec_id, r.component): r for r in whitening.whiten(frame([[0.0, 2.0], [1.0, 2.0], [-0.0, 2.0]])).collect()}
    assert abs(flat[0, 1].whitened) == pytest.approx(1) and flat[0, 1].whitened == flat[2, 1].whitened and flat[0, 1].explained == pytest.approx(1)
    assert flat[0, 2].whitened is None and flat[0, 2].explained == 0 and flat[0, 1].identity_error < 1e-9
    large = whitening.whiten(frame([[2.0**36, 0.0], [-(2.0**36), 0.0]])).collect()
    assert all(r.deviation is None for r in large)  # beyond a long
    with pytest.raises(Exception, match="too large"):
        whitening.whiten(frame([[1e30, 0.0]])).collect()


def test_exact_deviation():
    r = np.random.default_rng(2)
    for reach in (100, 2**20, 2**30):
        x = r.integers(-reach, reach, (20, 5))
        s = [int(v) for v in x.sum(0)]
        want = [sum((20 * a - b) ** 2 for a, b in zip(row, s)) for row in x.tolist()]
        assert whitening.exact_deviation(x, 20, s) == [w if w < 2**63 else None for w in want]


# --- quality

LABELS = "doc_id long, quality int, toxic int"


def _prose(r, n):
    stems = ["anthe", "inger", "ous", "tion", "er", "hable", "the", "of", "and", "in", "éreau", "lich"]
    out = []
    while len(out) < n:
        out += [" ".join(r.choice(stems) + r.choice(stems) for _ in range(r.randrange(5, 14))).capitalize() + "."]
    return "\n".join(out)


def _junk(r, text):
    lines = text.split("\n")
    k = r.randrange(4)
    at = r.randrange(len(lines))
    words = lines[at].split()
    lines[at] = [" ".join(w.upper() + "!!" for w in words), " ".join(w + r.choice(["***", "###", "&&&"]) for w in words), " ".join([words[0]] * 14), " | ".join(words)][k]
    return "\n".join(lines)


def _labelled(n=900):
    r = random.Random(8)
    docs, labels = [], []
    for i in range(n):
        good = r.random() < 0.8
        t = _prose(r, r.randrange(1, 7))
        docs.append((i, t if good else _junk(r, t), "en", "s", 1))
        labels.append((i, int(good), 0))
    return docs, labels


@pytest.fixture(scope="module")
def fitted(spark):
    docs, labels = _labelled()
    frame = stored(spark.createDataFrame(docs, SCHEMA), "quality-docs")
    told = stored(spark.createDataFrame(labels + [(None, 1, 0), (5, None, 0), (3, labels[3][1], 0)], LABELS), "quality-labels")
    return docs, labels, frame, told, stored(quality.train(frame, told), "quality-fitted")


def test_quality_on_the_held_out_fold(spark, fitted):
    docs, labels, frame, told, _ = fitted
    got = {r.doc_id: r for r in quality.quality(frame, told).collect()}
    fold = {i: zlib.crc32(str(i).encode()) % 5 for i, *_ in docs}
    assert all(r.held_out == (fold[i] == 0) and r.predicted == int(r.score >= 0.3) and 0 <= r.score <= 1 for i, r in got.items())
    out = [(got[i].score, y) for i, y, _ in labels if fold[i] == 0]
    assert sum((s >= 0.3) == (y == 1) for s, y in out) / len(out) > 0.97
    # labels of the held-out fold change nothing
    flipped = spark.createDataFrame([(i, y if fold[i] else 1 - y, t) for i, y, t in labels], LABELS)
    again = {r.doc_id: r.score for r in quality.quality(frame, flipped).collect()}
    assert again == {i: r.score for i, r in got.items()}


def test_score_is_a_sum_of_table_entries(spark, fitted):
    docs, _, frame, _, model = fitted
    terms = sorted(model.collect(), key=lambda r: r.term)
    assert any(r.second is not None for r in terms)
    for r in quality.score(frame, model, ["doc_id", "text"]).limit(60).collect():
        x = quality.text_features([r.text.encode()])[0]
        bins = [int(np.searchsorted(t.edges, x[t.first], "right")) for t in terms if t.first is not None and t.second is None]
        total = terms[0].table[0]
        for t in terms[1:]:
            total += t.table[bins[t.first]] if t.second is None else t.table[bins[t.first] * quality.PAIR_BINS // quality.BINS * quality.PAIR_BINS + bins[t.second] * quality.PAIR_BINS // quality.BINS]
        assert r.score == pytest.approx(1 / (1 + math.exp(-total)), abs=1e-12)


def _plain_features(text):
    """Some of the features, by plain loops."""
    t = text.decode("utf-8")
    words = [w for w in text.split()]
    stops, ok = b".,;:'?-\"()", lambda c: c > 127 or chr(c).isalnum()
    symbol = lambda c: not ok(c) and c not in b" \t\r\x0b\x0c\n" and c not in stops
    upper, lower, beyond = sum(65 <= c <= 90 for c in text), sum(97 <= c <= 122 for c in text), sum(c > 127 for c in text)
    lines = [x for x in text.split(b"\n") if len(x) >= quality.LINE]
    return {
        "log_bytes": math.log1p(len(text)), "upper_share": upper / max(1, upper + lower + beyond), "symbol_share": sum(map(symbol, text)) / max(1, len(text)), "line_rate": t.count("\n") / max(1, len(words)), "repeat_share": sum(a == b for a, b in zip(words, words[1:])) / max(1, len(words)),
        "near_repeat_share": sum(any(i >= g and words[i] == words[i - g] for g in (2, 3, 4)) for i in range(len(words))) / max(1, len(words)), "worst_symbol_line": max((sum(map(symbol, x)) / len(x) for x in lines), default=0), "repeated_line_share": sum(a == b for a, b in zip(lines, lines[1:])) / max(1, len(lines)),
        "lone_symbol_share": sum(all(map(symbol, w)) for w in words) / max(1, len(words)),
    }


def test_features_against_plain_loops():
    r = random.Random(2)
    texts = ["", " ", "\n", "a", "A B\n\nC", "é" * 30, "same line of some length\nsame line of some length\nother line of some length", "| | ###", *[_junk(r, _prose(r, 4)) for _ in range(20)], "x " * 500]
    got = quality.text_features([t.encode() for t in texts])
    assert got.shape == (len(texts), len(quality.FEATURES)) and np.isfinite(got).all()
    for t, row in zip(texts, got):
        told = dict(zip(quality.FEATURES, row))
        for k, v in _plain_features(t.encode()).items():
            assert told[k] == pytest.approx(v), (k, t)
    assert np.array_equal(got, np.concatenate([quality.text_features([t.encode()]) for t in texts]))  # neighbours don't matter


def test_features_of_texts_larger_than_a_block(monkeypatch):
    r = random.Random(4)
    text = "\n".join(_prose(r, 3) for _ in range(40)).encode()
    want = quality.text_features([text])[0]
    monkeypatch.setattr(quality, "BLOCK", 2000)
    assert quality.text_features([text, b"short"])[0] == pytest.approx(want, abs=0.02)
    assert len(quality.text_features([b"w" * 9000])) == 1  # one word


def test_quality_of_odd_tables(spark, fitted):
    *_, frame, told, model = fitted
    odd = spark.createDataFrame(_rows(), SCHEMA).withColumn("features", F.lit("clash")).withColumn("score", F.lit("clash")).withColumn("label", F.lit(1))
    got = quality.quality(odd, told).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in _rows())
    assert len({r.score for r in got if r.doc_id in (300, 301)}) == 1
    assert quality.quality(odd.limit(0), told).count() == 0
    none = quality.quality(odd, told.limit(0)).collect()
    assert {r.score for r in none} == {0.5}
    kept = quality.drop_poor(frame, told)
    assert kept.columns == frame.columns and 0 < kept.count() < frame.count()


def test_trees_take_the_best_cut():
    g, n = np.array([5.0, 5, -5, -5, 0, 0]), np.full(6, 20.0)
    t = quality.tree_table(g, np.full(6, 5.0), n, leaves=3)
    assert t[0] == t[1] > 0 > t[2] == t[3] and abs(t[4]) < 1e-9 and t[4] == t[5]
    assert (quality.tree_table(g, np.full(6, 5.0), np.full(6, 1.0)) == quality.tree_table(g, np.full(6, 5.0), np.full(6, 1.0))[0]).all()  # leaves too small to cut
    cells = np.zeros((4, 4))
    cells[:2, :2], cells[2:, 2:], cells[:2, 2:], cells[2:, :2] = 1, 1, -1, -1
    gain, table = quality.quadrants(cells, np.ones((4, 4)), np.full((4, 4), 20.0))
    assert gain > 0 and (np.sign(table) == cells).all()


# --- decisions as bitmaps

@pytest.mark.parametrize("most", [common.BITMAP_BYTES, 5000])
def test_marked_rows_whatever_the_size_of_the_bitmaps(spark, monkeypatch, most):
    """One group of files and many: the same rows, no shuffle of the marked side, each file read once."""
    monkeypatch.setattr(common, "BITMAP_BYTES", most)
    path = common.work_path(spark, "marked")
    spark.range(0, 70_000, 1, 3).select("id", F.concat(F.lit("t"), "id").alias("text")).write.parquet(path)
    rows = common.numbered(spark.read.parquet(path))
    chosen = stored(rows.filter("id % 7 = 0 or id between 40000 and 40100").select(common.ROW, (F.col("id") % 7 == 0).alias("a"), (F.col("id") % 5 == 0).alias("b")), "chosen")
    got = common.marked(rows, chosen, "a", "b")
    assert got.columns == [*rows.columns, "a", "b"] and got.count() == 70_000
    bad = got.filter((F.col("a") != (F.col("id") % 7 == 0)) | (F.col("b") != ((F.col("id") % 5 == 0) & ((F.col("id") % 7 == 0) | F.col("id").between(40000, 40100)))))
    assert bad.count() == 0
    assert common.without_rows(rows, chosen.select(common.ROW)).count() + common.only_rows(rows, chosen.select(common.ROW)).count() == 70_000
    assert common.only_rows(rows, chosen.select(common.ROW).limit(0)).count() == 0
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan.replace("hashpartitioning(_file", "") and "SortMergeJoin" not in plan
    if most == 5000:  # a group's filter on the file reaches the scan, as one on the file's name
        assert plan.count("Scan parquet") > 2 and "file_path" in plan
        one = rows.filter(F.pmod(F.col(f"{common.ROW}.file"), F.lit(3)) == 0)
        assert one.select("id").count() < 70_000
