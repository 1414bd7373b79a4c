"""Each operator against a plain version on a small table with nulls, empty and long texts, ties and repeated rows."""

import hashlib
import random
import struct
import zlib
from collections import Counter, defaultdict
from functools import lru_cache

import numpy as np
import pytest
import xxhash

from orrery.llm import exact_dedup, mixing, packing, queries, sharding, simhash, tiff, token_files, toxicity, wordpieces
from orrery.llm.common import stored, work_path

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def _rows():
    r = random.Random(5)
    words = ["alpha", "Beta", "gamma", "été", "straße", "don't", "x1", "42", "!!", "ΣΑΣ"]
    base = [" ".join(r.choice(words) + str(r.randrange(40)) for _ in range(r.randrange(1, 60))) for _ in range(40)]
    rows = [(i, t, "en", r.choice(["a", "b", "ü", None]), len(t)) for i, t in enumerate(base)]
    rows += [(100 + i, base[3].upper() if i % 2 else base[3], "en", "a", 1) for i in range(20)]  # group of copies
    rows += [(200 + i, base[5] + f" tail{i}", None, "b", 1) for i in range(12)]  # near copies
    rows += [(300, None, None, None, None), (301, "", "en", "a", 0), (302, " \t\n", "en", "b", 3), (None, base[1], "en", "a", 1), (None, None, None, None, None)]
    rows += [rows[0], rows[0], (7, "same id, other text", "en", "b", 19), (400, "word " * 9000, "en", "a", 45000)]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    path = work_path(spark, "fixture")
    spark.createDataFrame(_rows(), SCHEMA).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def _lower(t):
    return (t or "").encode().lower()


def test_exact_dedup(spark, docs, empty):
    got = exact_dedup.deduplicate(docs, buckets=4).collect()
    groups = defaultdict(list)
    for i, t, *_ in _rows():
        groups[hashlib.sha256(_lower(t)).hexdigest()].append(i)
    assert Counter((r.doc_id, r.text_sha256, r.keep_id, r.group_size) for r in got) == Counter(
        (i, d, max((x for x in g if x is not None), default=None), len(g)) for d, g in groups.items() for i in g
    )
    kept = Counter(r.text_sha256 for r in got if r.kept)
    assert set(kept) == set(groups) and set(kept.values()) == {1}
    assert all(r.doc_id == r.keep_id for r in got if r.kept)
    stays = exact_dedup.keep_first_copies(docs, buckets=4)
    assert stays.columns == docs.columns and stays.count() == len(groups)
    assert exact_dedup.deduplicate(empty, buckets=4).count() == 0


def test_digest_index_continues(spark, docs):
    path = work_path(spark, "index")
    first = exact_dedup.DigestIndex(spark, path, 4)
    first.admit(docs.filter("doc_id < 30"))
    again = exact_dedup.DigestIndex(spark, path, 4)
    second = again.admit(docs.filter("doc_id < 150")).collect()
    old = {hashlib.sha256(_lower(t)).hexdigest(): i for i, t, *_ in _rows() if i is not None and i < 30}
    assert all(not r.kept and r.keep_id < 30 for r in second if r.text_sha256 in old)
    assert any(r.kept for r in second)
    assert again.rows().count() == again.rows().select("digest").distinct().count()
    assert "Exchange" not in again.rows().groupBy("digest").count()._jdf.queryExecution().executedPlan().toString().replace("ShuffleExchange", "Exchange").split("FileScan")[1]
    small = again.compact(work_path(spark, "index"))
    assert sorted(small.rows().collect()) == sorted(again.rows().collect())


def _jump(key, n):
    b, j = -1, 0
    while j < n:
        b, key = j, (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (2.0**31 / ((key >> 33) + 1)))
    return b


def test_sharding(spark, docs, empty):
    got = sharding.assign_shards(docs, 40).collect()
    rows = _rows()
    key = lambda i: int(hashlib.md5(("" if i is None else str(i)).encode()).hexdigest()[:16], 16)
    assert Counter((r.doc_id, r.size, r.text_crc32, r.shard, r.grown_shard) for r in got) == Counter(
        (i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode()), _jump(key(i), 40), _jump(key(i), 41)) for i, t, *_ in rows
    )
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
        assert r.grown_shard in (r.shard, 40)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sharding.assign_shards(empty, 40).count() == 0


def test_mixing(spark, docs, empty):
    got = mixing.mix_documents(docs).collect()
    size = Counter()
    for i, t, _, s, _ in _rows():
        size[s] += len((t or "").encode().split())
    names = sorted((s for s in size if s is not None)) + [None]
    weight, cap, fixed = {s: i % 3 + 1 for i, s in enumerate(names)}, {s: 3 * size[s] for s in names}, {}
    while True:
        free = [s for s in names if s not in fixed]
        level = (sum(size.values()) - sum(fixed.values())) / sum(weight[s] for s in free)
        over = [s for s in free if level * weight[s] > cap[s]]
        if not over:
            break
        fixed |= {s: float(cap[s]) for s in over}
    target = fixed | {s: level * weight[s] for s in free}
    taken = Counter()
    for r in got:
        assert r.target == pytest.approx(target[r.source]) and r.source_size == size[r.source] and 0 <= r.taken <= 3 * r.size
        taken[r.source] += r.taken
    assert all(taken[s] == round(target[s]) for s in names)
    assert sorted(map(tuple, map(lambda r: (str(r),), got))) == sorted(map(tuple, map(lambda r: (str(r),), mixing.mix_documents(docs.repartition(5)).collect())))
    mixed = mixing.mixture(docs)
    assert mixed.columns == docs.columns
    words = Counter()
    for r in mixed.collect():
        words[r.source] += len(r.text.encode().split())
    assert words == +taken
    assert mixing.mix_documents(empty).count() == 0


def _fingerprint(text):
    words = _lower(text).split()
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def _component_ids(points):
    parent = list(range(len(points)))

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a in range(len(points)):
        for b in range(a):
            if (points[a][1] ^ points[b][1]).bit_count() <= 4:
                parent[root(a)] = root(b)
    least = defaultdict(list)
    for a, (i, _) in enumerate(points):
        least[root(a)] += [] if i is None else [i]
    return [min(least[root(a)], default=None) for a in range(len(points))]


@pytest.mark.parametrize("bucket", [20_000, 2])
def test_simhash(spark, docs, empty, bucket):
    points = [(i, _fingerprint(t)) for i, t, *_ in _rows()]
    got = simhash.near_duplicates(docs, bucket=bucket).collect()
    want = Counter((i, f, c) for (i, f), c in zip(points, _component_ids(points)))
    assert Counter((r.doc_id, r.fp % 2**64, r.component_id) for r in got) == want
    assert simhash.near_duplicates(empty).count() == 0


def test_links_connect_close_numbers(spark):
    r = random.Random(1)
    base = [r.getrandbits(64) for _ in range(12)]
    xs = list({b ^ sum(1 << r.randrange(64) for _ in range(r.randrange(6))) for b in base for _ in range(30)})
    want = _component_ids(list(enumerate(xs)))
    for bucket in (10_000, 5):
        points = spark.createDataFrame([(x - (x >> 63 << 64),) for x in xs], "fp long")
        comp = {r.node: r.root for r in simhash.components(stored(simhash.links(points, bucket=bucket), "links")).collect()}
        mine = [comp.get(x - (x >> 63 << 64), x - (x >> 63 << 64)) for x in xs]
        assert len(set(zip(mine, want))) == len(set(mine)) == len(set(want))


def test_masks_cover_every_pair():
    masks = simhash.covering_masks()
    r = random.Random(2)
    for _ in range(3000):
        d = sum(1 << b for b in r.sample(range(64), 4))
        assert any(not d & m for m in masks)


@lru_cache(1)
def _tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(queries.vocabulary())


def _ids(text):
    return _tokenizer().encode(text or "", add_special_tokens=False).ids


def test_wordpieces_equal_whole_texts():
    encode = wordpieces.Encoder(queries.vocabulary(), memo=50)
    assert encode.by_words
    odd = ["á b c d", "x́ ́y", "<|endoftext|> a<|startoftext|>b", "it's I'll 'tis", "ΣΑΣ ΟΔΟΣ", "a\x1cb\x85c", "12 345", "日本 語", "😀 \x0b\x0c z", ""]
    texts = odd + [t or "" for _, t, *_ in _rows()]
    for t, got in zip(texts, encode([t.encode() for t in texts])):
        assert np.frombuffer(got, "<u4").tolist() == _ids(t), repr(t)


@pytest.mark.parametrize("block", [1000, 4 << 20])
def test_wordpieces_of_mixed_signs(block, monkeypatch):
    """Contractions, special names in any case, signs beyond Latin-1, and texts longer than a block."""
    import pyarrow as pa

    monkeypatch.setattr(wordpieces, "BLOCK", block)
    r = random.Random(5)
    alphabet = [chr(i) for i in range(0x20, 0x180)] + ["'", "\u2019", "\u0301", "\n", "\t", "'s", "'LL", "<|endoftext|>", "<|EndOfText|>", " ", " "]
    texts = ["".join(r.choice(alphabet) for _ in range(r.randrange(1, 60))) for _ in range(800)] + ["so long " * 400, "\n" * 3000, "x" * 3000, ""]
    encode, done = wordpieces.Encoder(queries.vocabulary(), 2, memo=500), 0
    for n, ids, bounds in encode.texts(pa.array(texts + [None]), 2):
        for t, a, z in zip((texts + [None])[done:], bounds, bounds[1:]):
            assert ids[a:z].tolist() == _ids(t) + [2], repr(t)
        done += n
    assert done == len(texts) + 1


def test_token_files(spark, docs, empty):
    got = sorted(token_files.encode_documents(docs, queries.vocabulary()).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted((i for i, *_ in _rows() if i is not None)) + [None, None]
    at, want = 0, Counter()
    for r in got:
        assert r.start == at
        at += r.n_tokens
    for i, t, *_ in _rows():
        ids = _ids(t) + [2]
        want[i, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))] += 1
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == want
    assert token_files.encode_documents(empty, queries.vocabulary()).count() == 0


def test_packing(spark, docs, empty):
    got = packing.pack_documents(docs, queries.vocabulary()).collect()
    want = Counter()
    for i, t, *_ in _rows():
        ids = _ids(t) + [1]
        for n, a in enumerate(range(0, len(ids), 4096)):
            part = ids[a : a + 4096]
            want[i, n, a, len(part), zlib.crc32(struct.pack(f"<{len(part)}I", *part))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    by = defaultdict(list)
    for r in got:
        by[r.sequence_id].append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096
    assert len(by) <= -(-sum(r.length for r in got) // 4096) + 1
    assert packing.pack_documents(empty, queries.vocabulary()).count() == 0
    seqs = packing.sequences(packing.pack_documents(docs.filter("doc_id < 20"), queries.vocabulary(), with_ids=True)).collect()
    assert sum(len(s.ids) for s in seqs) == sum(len(_ids(t)) + 1 for i, t, *_ in _rows() if i is not None and i < 20)


@pytest.mark.parametrize("hot", [False, True])
def test_plan_is_near_the_bound(hot):
    r = random.Random(3)
    histogram = Counter(min(4096, int(r.lognormvariate(5.8, 1.1)) + 1) for _ in range(20_000))
    if hot:
        histogram[1300] += 9000
    plan = packing.pack_histogram(dict(histogram))
    used = Counter()
    for config, n in plan:
        assert sum(s * k for s, k in config) <= 4096
        for s, k in config:
            used[s] += k * n
    assert used == histogram
    assert sum(n for _, n in plan) <= 1.01 * sum(s * n for s, n in histogram.items()) / 4096 + 1


@pytest.mark.parametrize("codec", [tiff.NONE, tiff.LZW, tiff.DEFLATE, tiff.PACKBITS])
@pytest.mark.parametrize("predictor", [1, 2])
def test_tiff_round_trip(codec, predictor):
    r = np.random.default_rng(codec + predictor)
    pages = [r.integers(0, 256, (70, 33)).astype(np.uint8), np.repeat(r.integers(0, 3, (300, 2)).astype(np.uint8), 50, 1), np.zeros((1, 1), np.uint8)]
    back = tiff.read_tiff(tiff.write_tiff(pages, codec, predictor, strip=16))
    assert len(back) == 3 and all((a == b[:, :, 0]).all() for a, b in zip(pages, back))


def _tiled(order, planar):
    """A 16-bit RGB image of 20 x 24 in 16 x 16 tiles, deflated."""
    image = np.random.default_rng(4).integers(0, 65536, (20, 24, 3)).astype(np.uint16)
    padded = np.zeros((32, 32, 3), np.uint16)
    padded[:20, :24] = image
    tiles = [padded[y : y + 16, x : x + 16] for y in (0, 16) for x in (0, 16)]
    tiles = [t[:, :, [p]] for p in range(3) for t in tiles] if planar else tiles
    data = [zlib.compress(t.astype(order + "u2").tobytes()) for t in tiles]
    body, offsets = b"", []
    for d in data:
        offsets.append(8 + len(body))
        body += d
    n, at = len(data), 8 + len(body)
    body += struct.pack(f"{order}{n}I{n}I3H", *offsets, *map(len, data), 16, 16, 16)
    fields = [(256, 3, 1, 24), (257, 3, 1, 20), (258, 3, 3, at + 8 * n), (259, 3, 1, 8), (277, 3, 1, 3), (284, 3, 1, 2 if planar else 1), (322, 3, 1, 16), (323, 3, 1, 16), (324, 4, n, at), (325, 4, n, at + 4 * n)]
    out = struct.pack(order + "2sHI", b"II" if order == "<" else b"MM", 42, 8 + len(body)) + body + struct.pack(order + "H", len(fields))
    for tag, kind, count, value in fields:
        out += struct.pack(order + "HHI", tag, kind, count) + (struct.pack(order + "HH", value, 0) if kind == 3 and count == 1 else struct.pack(order + "I", value))
    return image, out + b"\0\0\0\0"


@pytest.mark.parametrize("order", "<>")
@pytest.mark.parametrize("planar", [False, True])
def test_tiff_tiles(order, planar):
    image, data = _tiled(order, planar)
    (back,) = tiff.read_tiff(data)
    assert (back == image).all()


def test_tiff_pages(spark):
    good = tiff.write_tiff([np.ones((3, 4), np.uint8)] * 2)
    media = spark.createDataFrame([(1, good), (2, b"junk"), (3, None), (4, good[:40]), (5, b"")], "page_id long, media binary")
    got = sorted((r.page_id, r.page, r.height, r.error is None) for r in tiff.pages(media).collect())
    assert got == [(1, 0, 3, True), (1, 1, 3, True), (2, -1, None, False), (4, -1, None, False)]


def test_text_media(spark, docs, empty):
    got = {(r.doc_id, r.payload_sha256): r for r in tiff.text_media(docs).collect()}
    for i, t, *_ in _rows():
        text = (t or "").encode()
        payload = text + b"\0" * (-len(text) % 64 or 64 * (not text))
        r = got[i, hashlib.sha256(payload).hexdigest()]
        assert (r.n_bytes, r.payload_bytes, r.tail_crc32) == (len(text), len(payload), zlib.crc32(payload[-64:]))
    assert tiff.text_media(empty).count() == 0


def test_toxicity_learns_and_generalises(spark):
    r = random.Random(6)
    words = [f"w{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(1200):
        text = [r.choice(words) for _ in range(r.randrange(20, 80))]
        toxic = i % 5 == 0
        if toxic:
            text[r.randrange(len(text))] = r.choice(["vile", "awful"])
        rows.append((i, " ".join(text), "en", "a", 0))
        labels.append((i, 1, int(toxic)))
    rows += [(9001, None, None, None, None), (None, "", None, None, None)]
    labels += [(9002, 1, None), (None, 1, 1), (3, 1, 0)]
    got = toxicity.toxicity(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    held = [x for x in got if x.held_out and x.doc_id is not None and x.doc_id < 1200]
    assert len(got) == len(rows) and len(held) > 200
    assert all(x.held_out == (zlib.crc32(("" if x.doc_id is None else str(x.doc_id)).encode()) % 4 == 2) for x in got)
    assert np.mean([x.predicted == int(x.doc_id % 5 == 0) for x in held]) > 0.95
    assert all(0 <= x.score <= 1 for x in got)


def test_toxicity_without_labels(spark, docs, empty):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.score for r in toxicity.toxicity(docs, none).collect()} == {0.0}
    assert toxicity.toxicity(empty, none).count() == 0
    assert toxicity.drop_toxic(docs, none).count() == docs.count()


def test_clashing_columns(spark, docs):
    wide = docs.withColumnsRenamed({"lang": "_text", "n_chars": "size"}).selectExpr("*", "1 AS fp", "2 AS id", "3 AS digest", "'x' AS score", "4 AS n", "5 AS taken", "6 AS _row", "7 AS component_id")
    assert exact_dedup.keep_first_copies(wide).columns == wide.columns and exact_dedup.keep_first_copies(wide).count() > 0
    none = spark.createDataFrame([(1, 1, 1, "y")], "doc_id long, quality int, toxic int, text string")
    assert toxicity.drop_toxic(wide, none).columns == wide.columns
    for f in (exact_dedup.deduplicate, simhash.near_duplicates, mixing.mix_documents, tiff.text_media):
        assert f(wide).count() == docs.count()
    assert mixing.mixture(wide).columns == wide.columns
