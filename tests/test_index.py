"""Containment by trigrams, dictionaries, the vector index and the embedding cache against plain versions."""

import os
import random
import re
import uuid
from collections import Counter

import pytest
from pyspark.sql import functions as F

from orrery.functions import text
from orrery.operators import containment, documents, html, stores, terms, vector_index
from orrery.plans import catalogue, catalogue_index
from orrery.sources import sinks
from orrery.streaming.embedding_cache import EmbeddingCache, content_digest

SF = "/root/testdata/sf0.001"


def _new(spark, label):
    return f"{sinks.shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def _share(need, t):
    words = re.findall("[a-z0-9]{3,}", need or "")
    return round(sum(w in t for w in words) / len(words), 9) if words and t else None


@pytest.mark.parametrize("share", [0.5, 0.9, 1.0])
def test_word_shares_against_all_pairs(spark, share):
    r = random.Random(int(share * 10))
    stems = ["the", "tion", "ing", "aba", "abab", "babab", "42", "x", "éa", "abc", "bcd"]
    say = lambda n: " ".join("".join(r.choice(stems) for _ in range(r.randrange(1, 4))) + r.choice(["", ".", "-", "é"]) for _ in range(n))
    texts = [(i, say(r.randrange(0, 25))) for i in range(60)] + [(100, None), (101, ""), (None, "the abab"), (3, "abab tion")]
    needs = [(i, say(r.randrange(0, 7))) for i in range(30)] + [(200, None), (201, "a b"), (202, "the the the aba"), (202, "the the the aba"), (None, "zzz")]
    # near-certain hits
    needs += [(300 + i, " ".join(texts[i][1].split()[:6])) for i in range(10)]
    a, b = spark.createDataFrame(needs, "need_id long, need string"), spark.createDataFrame(texts, "text_id long, text string")
    got = Counter(tuple(x) for x in containment.word_shares(a, b, share).collect())
    want = Counter((i, j, _share(n, t)) for i, n in needs for j, t in texts if (_share(n, t) or 0) >= share)
    assert got == want and sum(want.values()) > 5
    assert containment.word_shares(a.limit(0), b, share).count() == 0 == containment.word_shares(a, b.limit(0), share).count()


def test_word_overlap_has_no_cross_join(spark):
    plan = catalogue.queries()["word_overlap_ratio"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan
    with pytest.raises(ValueError):
        containment.word_shares(spark.range(1), spark.range(1), 0)


def _sequential(t, names):
    """Each name in turn, the longest first; what was put in is kept out of later searches."""
    parts = [t]
    for name in sorted(names, key=lambda n: (-len(n), n)):
        out = []
        for p in parts:
            if isinstance(p, tuple):
                out.append(p)
                continue
            cut = re.split(f"({re.escape(name)})", p, flags=re.I)
            out += [(names[name],) if i % 2 else x for i, x in enumerate(cut)]
        parts = out
    return "".join(p[0] if isinstance(p, tuple) else p for p in parts)


def test_ten_thousand_names_by_the_sequential_rule(spark):
    r = random.Random(6)
    syllables = ["an", "na", "ban", "Jé", "le", "Roy", "da", "anna", "x", " "]
    names = {"".join(r.choice(syllables) for _ in range(r.randrange(2, 7))).strip() for _ in range(30_000)}
    names = text.pseudonyms(sorted(n for n in names if len(n) > 2)[:10_000])
    assert len(names) == 10_000
    some = sorted(names)
    rows = [(i, "".join(r.choice([r.choice(some), r.choice(some).upper(), " et ", "an", ", "]) for _ in range(r.randrange(0, 12)))) for i in range(12)]
    rows += [(50, None), (51, ""), (52, "rien")]
    df = spark.createDataFrame(rows, "id long, text string").withColumn("other", F.array(F.lit(1)))
    got = {x.id: x.text for x in terms.replaced(df, "text", names).collect()}
    assert got == {i: None if t is None else _sequential(t, names) for i, t in rows}
    kept = terms.replaced(df, "text", names, "out")
    assert kept.columns == ["id", "text", "other", "out"] and kept.filter("id = 52").first().out == "rien"
    assert terms.replaced(df, "text", {}).filter("id = 52").first().text == "rien"


def test_case_of_single_characters():
    t = terms.Terms(["straße", "İx", "Σας", "ſt", ""], case=False)
    assert [t.chosen(x) for x in ("STRAßE", "ΣΑΣ", "ST")] == [[(0, 6, 0)], [(0, 3, 2)], [(0, 2, 3)]]
    assert t.chosen("nothing here") == [] and len(terms.without_case("İß𝔘")) == 3
    assert terms.Terms(["ab", "abcd", "bc", "cd"]).chosen("abcdbcab") == [(0, 4, 1), (4, 6, 2), (6, 8, 0)]


def test_terms_held_by_several_columns(spark):
    df = spark.createDataFrame([(1, "abc", "Zed"), (2, None, "xabx"), (3, None, None), (4, "", "ABC")], "id long, a string, b string")
    words = ["zed", "ab", "abc", "bc"]
    got = {r.id: r.terms for r in terms.held(df, ["a", "b"], words).collect()}
    assert got == {1: ["ab", "abc", "bc"], 2: ["ab"], 3: [], 4: []}
    assert {r.id: r.terms for r in terms.held(df, ["a", "b"], words, case=False).collect()} == {1: ["zed", "ab", "abc", "bc"], 2: ["ab"], 3: [], 4: ["ab", "abc", "bc"]}
    assert terms.read_terms(df, "b") == ["ABC", "Zed", "xabx"]
    with pytest.raises(ValueError):
        terms.read_terms(df, "b", 2)


# --- the vector index

def _points(spark, n=600, d=6, seed=3):
    r = random.Random(seed)
    centres = [[r.gauss(0, 1) for _ in range(d)] for _ in range(8)]
    rows = [(i, [c + r.gauss(0, 0.3) for c in centres[i % 8]], i % 3, "x") for i in range(n)]
    rows += [(n, None, 0, None), (n + 1, [float("nan")] * d, 0, None), (n + 2, [0.0] * d, 0, None), (5, rows[5][1], 1, None), (n + 3, rows[7][1], None, None)]
    return spark.createDataFrame(rows, "id long, embedding array<float>, kind int, _unit_like string")


@pytest.fixture(scope="module")
def index(spark):
    points = _points(spark)
    return points, vector_index.build(points, _new(spark, "index-test"), 12, payload="kind")


def _rows(df):
    return sorted((r.query_id, r["rank"], r.id, round(r.score, 6)) for r in df.collect())


@pytest.mark.parametrize("where", [None, "kind = 1", "kind = 2 and id % 2 = 0", "kind = 99"])
def test_exact_mode_is_exhaustive(spark, index, where):
    points, stored = index
    q = points.filter("id % 50 = 0").select(F.col("id").alias("query_id"), F.col("embedding").alias("q"))
    where = F.expr(where) if where else None
    exact = vector_index.search(stored, q, 7, where=where, digits=6)
    assert _rows(exact) == _rows(vector_index.exhaustive(points, q, 7, where, digits=6))


def test_probing_reads_only_its_cells_and_reaches_the_recall(spark, index):
    points, stored = index
    q = points.filter("id % 20 = 0").select(F.col("id").alias("query_id"), F.col("embedding").alias("q"))
    where = F.expr("kind = 1")
    probes = vector_index.probes_for(stored, q, 10, 0.92, where)
    cells = stored.cells().filter("n > 0").count()
    assert 1 <= probes < cells
    found = vector_index.search(stored, q, 10, probes, where)
    got = vector_index.recall(found, vector_index.exhaustive(points, q, 10, where)).agg(F.sum("hits") / F.sum("n")).first()[0]
    assert got >= 0.9
    one = q.filter("query_id = 0")
    plan = vector_index.search(stored, one, 10, 1, where)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*cell#\d+ (=|IN)", plan) and "kind" in plan.split("PartitionFilters")[1]
    scanned = vector_index._scored(stored, vector_index._asked(one, "query_id", "q"), spark.createDataFrame([(0, 3)], "query_id long, cell int"), where, "id")
    assert all("cell=3" in f and "kind=1" in f for f in scanned.inputFiles()) or scanned.count() < points.count()


def test_many_queries_meet_the_points_in_parts(spark, index, monkeypatch):
    points, stored = index
    q = points.filter("id % 10 = 0").select(F.col("id").alias("query_id"), F.col("embedding").alias("q"))
    want = _rows(vector_index.search(stored, q, 3))
    monkeypatch.setattr(vector_index, "FEW", 5)
    assert _rows(vector_index.search(stored, q, 3)) == want


def test_index_of_nothing(spark):
    points = _points(spark).limit(0)
    empty = vector_index.build(points, _new(spark, "index-empty"), 4)
    q = spark.createDataFrame([(1, [1.0, 0.0])], "query_id long, q array<double>")
    assert vector_index.search(empty, q, 3).count() == 0


# --- the embedding cache

def test_cache_computes_each_content_once(spark):
    asked = []

    def embed(rows):
        got = rows.collect()
        asked.extend(r.text for r in got)
        return spark.createDataFrame([(bytes(r.digest), [float(len(r.text))]) for r in got], "digest binary, vector array<double>")

    path = _new(spark, "cache-test")
    cache = EmbeddingCache(spark, path, "m1", embed, buckets=4)
    rows = spark.createDataFrame([(1, "aa"), (2, "aa"), (3, "b"), (4, None), (5, "")], "id long, text string")
    got = {r.id: r.vector for r in cache.embedded(rows).collect()}
    assert got == {1: [2.0], 2: [2.0], 3: [1.0], 4: None, 5: [0.0]} and Counter(asked) == Counter(["aa", "b", ""])
    asked.clear()
    assert cache.fill(rows) == 0 and not asked
    again = EmbeddingCache(spark, path, "m1", embed, buckets=4)  # another run at the same path
    assert again.fill(spark.createDataFrame([(9, "ccc"), (1, "b")], "id long, text string")) == 1 and asked == ["ccc"]
    other = EmbeddingCache(spark, path, "m2", embed, buckets=4)  # another model shares no vector
    assert other.missing(rows).count() == 3
    assert cache.fill(rows.limit(0)) == 0 and cache.rows().count() == 4
    plan = cache.missing(rows)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1  # the cached side is not shuffled
    assert spark.range(1).select(content_digest("m", F.lit("t")).alias("d")).first().d != spark.range(1).select(content_digest("n", F.lit("t")).alias("d")).first().d


def test_recall_of_the_registered_index(spark):
    got = catalogue_index.indexed_topk_recall(spark, SF).agg(F.sum("hits") / F.sum("n")).first()[0]
    assert got >= 0.9


# --- stores

def _files(path):
    return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, names in os.walk(path.removeprefix("file:").replace("///", "/")) for f in names if f.endswith(".parquet")}


def test_a_patch_leaves_the_vectors_files_alone(spark, tmp_path):
    store = stores.PointStore(spark, str(tmp_path / "points"), "id", "long", "a string, b long", buckets=4)
    rows = [(i, [float(i), 1.0], f"a{i}", None) for i in range(40)] + [(None, [0.0], "no key", 1), (3, [9.0], "again", 1)]
    store.add(spark.createDataFrame(rows, "id long, vector array<double>, a string, b long").coalesce(1))
    before = _files(str(tmp_path / "points/vectors"))
    store.patch(spark.createDataFrame([(1, "x"), (2, None), (99, "unknown")], "id long, a string"))
    store.patch(spark.createDataFrame([(i, i) for i in range(10)], "id long, b long"))
    store.purge(["a"], F.col("b") > 5)
    assert _files(str(tmp_path / "points/vectors")) == before and before
    got = {r.id: (r.vector, r.a, r.b) for r in store.points().collect()}
    want = {i: ([float(i), 1.0], None if 5 < i < 10 else {1: "x"}.get(i, f"a{i}"), i if i < 10 else None) for i in range(40)}
    assert {i: (v, a, b) for i, (v, a, b) in got.items() if i != 3} == {i: x for i, x in want.items() if i != 3} and len(got) == 40
    assert sorted(os.listdir(tmp_path / "points/payload")) == ["3", "4"]  # the last two versions
    plan = store.points()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan.replace("BroadcastExchange", "")
    store.add(spark.createDataFrame([(5, [0.0], "ignored", 0), (50, [5.0], "new", 7)], "id long, vector array<double>, a string, b long"))
    again = {r.id: (r.vector, r.a, r.b) for r in store.points().collect()}
    assert again == {**got, 50: ([5.0], "new", 7)}


def test_keys_are_checked_on_write(spark, tmp_path):
    table = stores.KeyedTable(spark, str(tmp_path / "keyed"), "k", "string", buckets=4)
    frame = lambda rows: spark.createDataFrame(rows, "k string, v long")
    assert table.append(frame([("a", 1), ("b", 2)])) == 2
    assert table.append(frame([("a", 9), ("c", 3), ("d", 4), ("d", 5), (None, 6)])) == 1
    assert sorted((r.k, r.v) for r in table.rows().collect()) == [("a", 1), ("b", 2), ("c", 3)]
    assert sorted((r.reason, str(r.k), r.v) for r in table.quarantine().collect()) == [("known key", "a", 9), ("no key", "None", 6), ("repeated key", "d", 4), ("repeated key", "d", 5)]
    with pytest.raises(ValueError, match="known key"):
        table.append(frame([("b", 1), ("e", 1)]), refuse=True)
    assert table.rows().count() == 3 and table.pending().count() == 0
    frame([("late", 8)]).write.mode("append").parquet(str(tmp_path / "keyed/rows"))  # as if the run had died before its keys
    assert [r.k for r in table.pending().collect()] == ["late"]
    assert table.append(frame([]).limit(0)) == 0
    plan = table.checked(frame([("a", 1)]))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") == 1 and "keys" in plan  # the rows themselves are not read


def test_publishing_one_module_again(spark, tmp_path):
    frame = lambda rows: spark.createDataFrame(rows, "module string, key string")
    path = str(tmp_path / "published")
    stores.publish(frame([("a", "x"), ("a", "y"), ("b", "x"), ("b", "z")]), path)
    untouched = {f: t for f, t in _files(path).items() if "module=a" in f}
    stores.publish(frame([("b", "x"), ("b", "new")]), path)
    assert sorted((r.module, r.key) for r in spark.read.parquet(path).collect()) == [("a", "x"), ("a", "y"), ("b", "new"), ("b", "x")]
    assert {f: t for f, t in _files(path).items() if "module=a" in f} == untouched


def test_sample_against_population(spark):
    everything = spark.createDataFrame([(k,) for k in ["a"] * 5 + ["b"] * 3 + ["c"] * 3 + ["d", None]], "kind string")
    found = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (1, "c"), (2, "b"), (2, "b"), (2, "a"), (3, None), (4, "a"), (4, None)], "query_id long, kind string")
    got = {r.query_id: tuple(r)[1:] for r in stores.sample_against_population(found, everything, "kind").collect()}
    assert got == {1: (4, 4, "a", True, True), 2: (3, 3, "b", False, False), 3: (1, 0, None, False, False), 4: (2, 1, "a", True, False)}


# --- table functions

def test_table_functions_give_the_rows_of_the_dataframe_functions(spark):
    pages, docs = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("pages", "documents"))
    rows = lambda df: Counter(map(tuple, df.collect()))
    assert rows(catalogue_index.sql_html_chunks(spark, SF)) == rows(html.chunks(pages, "html", "page_id"))
    want = documents.segments(docs.select("doc_id", "text"), F.split("text", "\n"), 1800).select("doc_id", "segment", "text")
    assert rows(catalogue_index.sql_packed_lines(spark, SF)) == rows(want)
    odd = spark.sql("SELECT s.* FROM (SELECT array('ab cd efghij', null, '', 'k') AS l UNION ALL SELECT null) t, LATERAL packed_lines(l, 4) s")
    assert rows(odd) == Counter([(0, "ab"), (1, "cd"), (2, "efgh"), (3, "ij\nk")])
    assert spark.sql("SELECT c.* FROM (SELECT CAST(NULL AS STRING) AS h) t, LATERAL html_chunks(h, 1500, 25) c").count() == 0
