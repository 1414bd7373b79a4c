"""Plain versions of the classifier, the media columns and the pipeline; repeated batches; hostile files; clashing names."""

import hashlib
import re
import struct
import zlib
from collections import Counter, defaultdict
from types import SimpleNamespace

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from orrery.llm import common, exact_dedup, katz, mixing, packing, queries, sharding, similar, simhash, tiff, token_files, toxicity

from .test_ops import SCHEMA, _ids, _jump, _rows

LABELS = "doc_id long, quality int, toxic int"


def test_a_repeated_batch_gets_the_same_verdicts(spark):
    rows = [(i, f"text {i % 5}", "en", "a", 6) for i in range(12)] + [(None, "TEXT 1", None, None, None), (None, None, None, None, None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    index = exact_dedup.DigestIndex(spark, common.work_path(spark, "again"), 4)
    verdicts = lambda batch, d=docs: Counter((r.doc_id, r.text_sha256, r.keep_id, r.group_size, r.kept) for r in index.admit(d, batch=batch).collect())
    first = verdicts("monday")
    assert sum(n for (*_, kept), n in first.items() if kept) == 6
    assert verdicts("monday") == first and index.rows().count() == 6  # as after a crash behind the append
    assert not any(kept for *_, kept in verdicts("tuesday"))
    more = docs.unionByName(spark.createDataFrame([(50, "new", "en", "a", 3)], SCHEMA))
    assert sum(n for (*_, kept), n in verdicts("tuesday", more).items() if kept) == 1
    half = exact_dedup.DigestIndex(spark, common.work_path(spark, "half"), 4)
    half.append(index.rows().filter("batch = 'monday' and keep_id % 2 = 0"))  # as if the append had ended half way
    index = half
    assert verdicts("monday") == first and half.rows().count() == 6
    before = len(spark.catalog.listTables())
    exact_dedup.deduplicate(docs, buckets=4).count()
    assert len(spark.catalog.listTables()) == before


def test_a_cluster_needs_a_shared_folder():
    cluster = SimpleNamespace(conf=SimpleNamespace(get=lambda k, d: None), sparkContext=SimpleNamespace(master="spark://host:7077", applicationId="a"))
    with pytest.raises(ValueError):
        common.shared_root(cluster)


def test_jump_hash_of_many_shards(spark):
    keys = [(i,) for i in range(400)]
    for shards in (1, 2, 3, 40, 1000):
        got = spark.createDataFrame(keys, "k long").select("k", sharding.jump_state(*sharding.key_halves(F.col("k")), shards).alias("s")).collect()
        for k, s in got:
            key = int(hashlib.md5(str(k).encode()).hexdigest()[:16], 16)
            assert s.b == _jump(key, shards) and (shards if s.j == shards else s.b) == _jump(key, shards + 1)


# toxicity

def _words(text):
    return "".join(c if ord(c) > 127 or c.isalnum() else " " for c in (text or "").lower()).encode().split()


def _plain_features(text):
    top, odd = 1 << 64, [int(x) for x in toxicity._ODD]
    h = [xxhash.xxh64_intdigest(w) for w in _words(text)]
    out = {x * odd[0] % top >> 44 for x in h}
    for gap, a, b in ((1, odd[1], odd[2]), (2, odd[3], odd[4])):
        out |= {(x * a % top ^ (y * b % top >> 7)) * odd[0] % top >> 44 for x, y in zip(h, h[gap:])}
    return out


def _plain_ftrl(rows):
    z, n = defaultdict(float), defaultdict(float)

    def weight(i):
        return 0.0 if abs(z[i]) <= toxicity.L1 else -(z[i] - np.sign(z[i]) * toxicity.L1) / ((toxicity.BETA + n[i] ** 0.5) / toxicity.ALPHA + toxicity.L2)

    for _ in range(toxicity.EPOCHS):
        for own, label in rows:
            w = {i: weight(i) for i in [*own, "constant"]}
            g = 1 / (1 + np.exp(-sum(w.values()))) - label
            for i, x in w.items():
                z[i] += g - ((n[i] + g * g) ** 0.5 - n[i] ** 0.5) / toxicity.ALPHA * x
                n[i] += g * g
    return {i: w for i in z if (w := weight(i))}


def _plain_scores(spark, rows, labels):
    known = defaultdict(list)
    for i, _, y in labels:
        if i is not None and y is not None and zlib.crc32(str(i).encode()) % 4 != 2:
            known[i].append(y)
    texts = {r[0]: r[1] for r in rows if r[0] in known}
    order = [r.id for r in spark.createDataFrame([(i,) for i in texts], "id long").orderBy(F.xxhash64("id", F.lit("order"))).collect()]
    w = _plain_ftrl([(_plain_features(texts[i]), max(known[i])) for i in order])
    return [1 / (1 + np.exp(-(w.get("constant", 0.0) + sum(w.get(f, 0.0) for f in _plain_features(t))))) for _, t, *_ in rows]


def _toxic_rows():
    r = np.random.default_rng(8)
    vocabulary = [f"w{i}" for i in range(60)]
    rows, labels = [], []
    for i in range(500, 740):
        text = r.choice(vocabulary, r.integers(8, 30)).tolist()
        if i % 4 == 0:
            text.insert(3, "Vile,")
        rows.append((i, " ".join(text), "en", "ab"[i % 2], None))
        labels.append((i, 1, int(i % 4 == 0)))
    return rows, labels + [(9002, 1, None), (None, 1, 1), (501, 1, 0), (501, 1, None)]


def test_toxicity_equals_a_plain_version(spark):
    rows, labels = _toxic_rows()
    rows += [(None, None, None, None, None), (1, "", None, None, None), (2, "É" * 3 + " vile vile", None, None, None)]
    got = toxicity.toxicity(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, LABELS)).collect()
    want = _plain_scores(spark, rows, labels)
    key = lambda x: (str(x[0]), x[1])
    for a, b in zip(sorted(((r.doc_id, r.score) for r in got), key=key), sorted(zip((r[0] for r in rows), want), key=key), strict=True):
        assert a[0] == b[0] and a[1] == pytest.approx(b[1])
    assert all(r.predicted == (r.score >= 0.3) for r in got) and any(r.predicted for r in got)


def test_the_fitting_task_holds_a_bounded_number_of_features(spark):
    rows, labels = _toxic_rows()
    docs, known = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, LABELS)
    assert toxicity.train(docs, known, most=0).count() == 0
    assert toxicity.train(docs, known, most=2000).count() <= toxicity.train(docs, known).count()


# media columns

def _plain_read(data):
    """Samples of a little-endian greyscale TIFF of deflated strips with the horizontal predictor."""
    at, pages = struct.unpack_from("<I", data, 4)[0], []
    while at:
        tags = {}
        for k in range(struct.unpack_from("<H", data, at)[0]):
            tag, kind, n = struct.unpack_from("<HHI", data, at + 2 + 12 * k)
            size, place = (2 if kind == 3 else 4) * n, at + 10 + 12 * k
            place = struct.unpack_from("<I", data, place)[0] if size > 4 else place
            tags[tag] = struct.unpack_from(f"<{n}{'H' if kind == 3 else 'I'}", data, place)
        raw = b"".join(zlib.decompress(data[a : a + n]) for a, n in zip(tags[273], tags[279]))
        pages.append(np.cumsum(np.frombuffer(raw, np.uint8).reshape(-1, tags[256][0]), axis=1, dtype=np.uint8))
        at = struct.unpack_from("<I", data, at + 2 + 12 * (k + 1))[0]
    return pages


def test_media_columns_equal_a_plain_version(spark):
    rows = [*_rows()[:40], (901, "x" * (64 * (1 << 16) + 5), "en", "a", 1), (902, None, None, None, None), (903, "a" * 64, None, None, None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    stored = common.stored(tiff.store_texts(docs), "test-media")
    files = defaultdict(list)
    for r in stored.collect():
        files[r.doc_id].append(bytes(r.media))
    got = tiff.media_features(stored).collect()
    assert len(got) == len(rows)
    for r in got:
        data = next(x for x in files[r.doc_id] if hashlib.sha256(x).hexdigest() == r.media_sha256)
        pages = _plain_read(data)
        payload = b"".join(p.tobytes() for p in pages)
        assert r.media_bytes == len(data) and r.payload_sha256 == hashlib.sha256(payload).hexdigest()
        counts = [sum(x >> 5 == k for x in payload) for k in range(8)] if len(payload) < 1 << 16 else np.bincount(np.frombuffer(payload, np.uint8) // 32, minlength=8).tolist()
        assert r.feature == f"pages={len(pages)};size={','.join(f'{p.shape[1]}x{p.shape[0]}' for p in pages)};sum={sum(payload)};counts={','.join(map(str, counts))}"
    texts = Counter((t or "").encode() for _, t, *_ in rows)
    payloads = Counter(b"".join(p.tobytes() for p in _plain_read(x)) for xs in files.values() for x in xs)
    assert payloads == Counter({t + b"\0" * (-len(t) % 64 or 64 * (not t)): 0 for t in texts} | {p: n for p, n in payloads.items()}) and sum(payloads.values()) == len(rows)


def test_hostile_and_half_readable_files(spark):
    good = tiff.write_tiff([np.arange(64, dtype=np.uint8).reshape(8, 8)] * 2)
    first = struct.unpack_from("<I", good, 4)[0]
    tags = {struct.unpack_from("<H", good, first + 2 + 12 * i)[0]: first + 2 + 12 * i for i in range(struct.unpack_from("<H", good, first)[0])}

    def changed(**values):
        out = bytearray(good)
        for name, v in values.items():
            at = tags[getattr(tiff, name)]
            struct.pack_into("<HHII", out, at, getattr(tiff, name), 4, 1, v)
        return bytes(out)

    huge, codec = changed(WIDTH=2_000_000, HEIGHT=200_000), changed(COMPRESSION=7)
    media = spark.createDataFrame([(1, huge), (2, codec), (3, good)], "page_id long, media binary")
    got = sorted((r.page_id, r.page, r.error is None) for r in tiff.pages(media).collect())
    assert got == [(1, 0, False), (1, 1, True), (2, 0, False), (2, 1, True), (3, 0, True), (3, 1, True)]


# the language model

def test_words_common_in_few_blocks_are_split(spark):
    """A table sorted by language: a word with a twentieth of the tokens of less than half of the blocks."""
    r = np.random.default_rng(9)
    rows = [(i, " ".join([f"{'en' if i < 45 else 'fr'}{x}" for x in r.integers(0, 400, 95)] + (["the"] * 5 if i < 45 else [])), "en", "a", 1) for i in range(100)]
    docs = spark.createDataFrame(rows, SCHEMA).coalesce(1).select(F.col("doc_id").alias("id"), "text")
    blocks = common.stored(common.arrow_map(docs, lambda b: katz._make_blocks(b, 400, 100), katz.BLOCKS_DDL), "katz-blocks")
    n = blocks.agg(F.sum("trained")).first()[0]
    words, totals = katz._common_words(blocks, n, 100)
    counts = Counter(w for i, t, *_ in rows if zlib.crc32(str(i).encode()) % 10 for w in [*t.encode().split(), b"end of text"])
    want = {xxhash.xxh64_intdigest(w) & katz.MASK: c for w, c in counts.items() if c * 100 > n}
    assert dict(zip(words.tolist(), totals.tolist())) == want and xxhash.xxh64_intdigest(b"the") & katz.MASK in want


# packing

def test_the_dual_bound_holds_on_small_histograms():
    """The optimum of small cases by trying all ways, the linear program's bound below it, the plan close to it."""
    def optimum(sizes, capacity):
        best, seen = len(sizes), set()

        def put(i, rooms):
            nonlocal best
            if len(rooms) >= best or (i, tuple(sorted(rooms))) in seen:
                return
            if i == len(sizes):
                best = len(rooms)
                return
            seen.add((i, tuple(sorted(rooms))))
            for k, room in enumerate(rooms):
                if room >= sizes[i]:
                    put(i + 1, [*rooms[:k], room - sizes[i], *rooms[k + 1 :]])
            put(i + 1, [*rooms, capacity - sizes[i]])

        put(0, [])
        return best

    r = np.random.default_rng(10)
    for _ in range(25):
        sizes = sorted(r.integers(1, 21, r.integers(1, 11)).tolist(), reverse=True)
        program = packing.solve(dict(Counter(sizes)), 20)
        plan = packing.round_and_finish(dict(Counter(sizes)), program.used, 20)
        best = optimum(sizes, 20)
        assert program.bound <= best + 1e-9 and best <= sum(n for _, n in plan) <= best + 1
    hard = packing.solve({9: 300}, 20)  # two to a sequence, whatever the total says
    assert hard.bound == pytest.approx(150) and sum(n for _, n in packing.pack_histogram({9: 300}, 20)) == 150


# clashing names

def test_extra_columns_with_clashing_names(spark):
    docs = spark.createDataFrame(_rows(), SCHEMA)
    names = ["id", "size", "shard", "one", "_row", "_part", "before_one", "text_crc32", "piece", "start", "length", "ids", "part", "path", "score", "kind", "bucket", "block", "_jump", "_row_of_docs", "sequence_id", "offset", "state", "slot"]
    wide = docs.drop("source").selectExpr("*", *[f"{k} AS `{n}`" for k, n in enumerate(names)], "'a' AS source")
    plain = docs.drop("source").selectExpr("*", "'a' AS source")
    rows = lambda df: Counter(map(tuple, df.collect()))
    vocabulary = queries.vocabulary()
    assert rows(sharding.assign_shards(wide, 40).drop("slot")) == rows(sharding.assign_shards(plain, 40).drop("slot"))
    assert rows(token_files.encode_documents(wide, vocabulary).drop("start")) == rows(token_files.encode_documents(plain, vocabulary).drop("start"))
    pieces = lambda d: rows(packing.pack_documents(d, vocabulary).select("doc_id", "piece", "length", "ids_crc32"))
    assert pieces(wide) == pieces(plain)
    assert katz.fit_and_score(wide).count() == docs.count()
    for f in (exact_dedup.keep_first_copies, similar.drop_similar, mixing.mixture):
        out = f(wide)
        assert out.columns == wide.columns and {r._row_of_docs for r in out.collect()} == {names.index("_row_of_docs")}


# the pipeline

def _shingles(text):
    words = re.findall(rb"[^\x20\x09-\x0d]+", (text or "").encode().lower())
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def _near(rows):
    """Per row the root of its group: exact Jaccard of all pairs."""
    sets, parent = [_shingles(r[1]) for r in rows], list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                parent[root(a)] = root(b)
    return [root(a) for a in range(len(rows))]


@pytest.mark.parametrize("some", [True, False])
def test_pipeline_equals_a_plain_version(spark, tmp_path, some):
    rows, labels = _toxic_rows() if some else ([], [])
    rows = (rows + _rows()) if some else []
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, LABELS).write.parquet(f"{tmp_path}/labels.parquet")
    docs, after = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        docs = common.stored(stage(spark, docs, str(tmp_path)), f"test-{name}")
        after[name] = [tuple(r) for r in docs.collect()]
    # toxicity
    want = Counter(r for r, s in zip(rows, _plain_scores(spark, rows, labels)) if s < 0.3) if some else Counter()
    assert Counter(after["toxicity"]) == want and (not some or len(after["toxicity"]) < len(rows))
    # exact dedup: of equal texts the largest id
    groups = defaultdict(list)
    for r in after["toxicity"]:
        groups[(r[1] or "").encode().lower()].append(r)
    most = lambda g: max((r[0] for r in g if r[0] is not None), default=None)
    assert Counter((r[0], (r[1] or "").lower().encode()) for r in after["exact_dedup"]).total() == len(groups)
    assert {((r[1] or "").encode().lower(), r[0]) for r in after["exact_dedup"]} == {(k, most(g)) for k, g in groups.items()}
    # near dedup: one of each group, that with the smallest id
    root = _near(after["exact_dedup"])
    least = defaultdict(list)
    for r, k in zip(after["exact_dedup"], root):
        least[k].append(r)
    stays = {min((r[0] is None, r[0] or 0) for r in g) for g in least.values()}
    assert len(after["near_dedup"]) == len(least) and {(r[0] is None, r[0] or 0) for r in after["near_dedup"]} == stays
    # mixing: every source's words are its rounded target
    count = lambda t: len(re.findall(rb"[^\x20\x09-\x0d]+", (t or "").encode()))
    size = Counter()
    for r in after["near_dedup"]:
        size[r[3]] += count(r[1])
    got = Counter()
    for r in after["mixing"]:
        got[r[3]] += count(r[1])
    names = sorted(s for s in size if s is not None) + ([None] if None in size else [])
    weight, full = {s: i % 3 + 1 for i, s in enumerate(names)}, {}
    while some:
        free = [s for s in names if s not in full]
        level = (sum(size.values()) - sum(full.values())) / sum(weight[s] for s in free)
        over = [s for s in free if level * weight[s] > 3 * size[s]]
        if not over:
            break
        full |= {s: 3 * size[s] for s in over}
    assert got == +Counter({s: round(full.get(s, level * weight[s])) for s in names} if some else {})
    # packing: the pieces of all texts, gapless in sequences of at most 4096
    pieces = Counter()
    for r in after["mixing"]:
        ids = _ids(r[1]) + [1]
        for n, a in enumerate(range(0, len(ids), 4096)):
            part = ids[a : a + 4096]
            pieces[r[0], n, a, len(part), zlib.crc32(struct.pack(f"<{len(part)}I", *part))] += 1
    packed = corpus_pipeline.run(spark, str(tmp_path))
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packed.collect()) == pieces
    by = defaultdict(list)
    for r in packed.collect():
        by[r.sequence_id].append((r.offset, r.length))
    for parts in by.values():
        ends = [0, *np.cumsum([n for _, n in sorted(parts)]).tolist()]
        assert [o for o, _ in sorted(parts)] == ends[:-1] and ends[-1] <= 4096
