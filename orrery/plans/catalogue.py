"""All registered queries over the tables of a folder, and the SQL that gives the same rows."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import places, scalars, text
from ..operators import audit, documents, evaluation, graph, html, profile, search, vector_blocks
from ..sources import readers, sinks
from ..streaming import incremental

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
NAMESPACE = uuid.UUID("6ba7b810-9dad-11d1-80b4-00c04fd430c8")
#: Patterns of the invented tables' words, in order of precedence.
FAMILIES = (("ring", "ring|widget"), ("bolt", "bolt|gear"), ("red", "red|blue"), ("small", "small|large"))
THEMES = (("the", "(^| )the( |$)"), ("der", "(^| )der( |$)"), ("les", "(^| )les( |$)"), ("que", "(^| )que( |$)"))
WORDS = r"[a-z0-9]{3,}"


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from . import catalogue_feeds, catalogue_files, catalogue_index, catalogue_more  # noqa: F401  (they register theirs)

    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    queries()
    return dict(SQL)


class _Tables:
    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


# vector search: every row whose id is divisible by 100 asks, against all others

_ASKED = "q AS (SELECT vec_id AS query_id, embedding AS v, label AS wanted FROM embeddings WHERE vec_id % 100 = 0)"
_SCORED = f"""{_ASKED}, s AS (SELECT query_id, wanted, vec_id AS id, label AS owner, list_dot_product(embedding::DOUBLE[], v::DOUBLE[])
    / greatest(sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])) * sqrt(list_dot_product(v::DOUBLE[], v::DOUBLE[])), 1e-12) AS score FROM embeddings, q WHERE vec_id <> query_id)"""


def _sides(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """The rows that ask, and all rows."""
    e = _Tables(spark, sf).embeddings
    q = e.filter("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("q"), F.col("label").alias("wanted"))
    return q, e.select(F.col("vec_id").alias("id"), F.col("label").alias("owner"), "embedding")


@query(f"WITH {_SCORED}, b AS (SELECT query_id, owner, round(max(score), 6) AS score FROM s WHERE NOT coalesce(id % 7 = 0, false) GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, owner)::INTEGER AS rank FROM b) SELECT * FROM r WHERE rank <= 5")
def vector_topk_distinct_owner(spark, sf):
    q, corpus = _sides(spark, sf)
    return vector_blocks.owner_scores(q, corpus.filter(search.keep_rows(must_not=F.col("id") % 7 == 0)), 6, k=5)


@query(f"WITH {_SCORED} SELECT query_id, owner, round(max(score), 6) AS score FROM s GROUP BY ALL")
def owner_max_score(spark, sf):
    return vector_blocks.owner_scores(*_sides(spark, sf), 6)


_RANKED = f"WITH {_SCORED}, r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, id) AS rank, (owner = wanted)::INTEGER AS relevant FROM s), n AS (SELECT query_id, sum(relevant) AS n FROM r GROUP BY 1)"


def _ranked(spark, sf, k=50):
    return vector_blocks.judged(*_sides(spark, sf), k)


@query(f"""{_RANKED} SELECT query_id, sum(relevant) FILTER (rank <= 10)::BIGINT AS hits, round(hits / 10, 9) AS precision, round(CASE WHEN least(10, any_value(n)) > 0 THEN hits / least(10, any_value(n)) ELSE 0 END, 9) AS recall,
    round(CASE WHEN any_value(n) > 0 THEN hits / any_value(n) ELSE 0 END, 9) AS coverage, round(coalesce(1 / min(rank) FILTER (relevant = 1), 0), 9) AS mrr FROM r JOIN n USING (query_id) GROUP BY query_id""")
def precision_recall_mrr_at_k(spark, sf):
    rows, truth = _ranked(spark, sf)
    return evaluation.at_k(rows, truth, 10)


@query(f"""{_RANKED}, u AS (SELECT r.*, n, (id % 5 = 0 AND relevant = 0) AS uncertain, coalesce(sum((relevant = 0 AND NOT (id % 5 = 0))::INTEGER) OVER (PARTITION BY query_id ORDER BY rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS bad FROM r JOIN n USING (query_id) WHERE rank <= 50)
    SELECT query_id, round(sum(CASE WHEN relevant = 1 THEN 1 - least(bad, n) / n ELSE 0 END) / any_value(n), 9) AS bpref, round(sum(CASE WHEN relevant = 1 THEN 0.2::DOUBLE * power(0.8::DOUBLE, rank - 1) ELSE 0 END), 9) AS rbp_low,
    round(sum(CASE WHEN relevant = 1 OR uncertain THEN 0.2::DOUBLE * power(0.8::DOUBLE, rank - 1) ELSE 0 END), 9) AS rbp_high FROM u GROUP BY query_id""")
def bpref_rbp(spark, sf):
    rows, truth = _ranked(spark, sf)
    rows = rows.filter("rank <= 50").withColumn("uncertain", (F.col("id") % 5 == 0) & (F.col("relevant") == 0))
    return evaluation.bpref_rbp(rows, truth)


@query(f"{_RANKED}, f AS (SELECT query_id, min(rank) FILTER (relevant = 1)::INTEGER AS first FROM r GROUP BY 1) SELECT query_id, first, CASE WHEN first <= 1 THEN 'top 1' WHEN first <= 5 THEN 'seen' ELSE 'never seen' END AS class FROM f")
def rank_classes(spark, sf):
    return evaluation.rank_class(_ranked(spark, sf)[0], "query_id", 1, 5)


@query("WITH u AS (SELECT label, generate_subscripts(embedding, 1) AS i, unnest(embedding)::DOUBLE / sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])) AS x FROM embeddings), s AS (SELECT label, i, sum(x) AS s, count(*) AS n FROM u GROUP BY 1, 2) SELECT label, max(n) AS n, round((sum(s * s) - max(n)) / (max(n) * (max(n) - 1)), 6) AS homogeneity FROM s GROUP BY 1")
def homogeneity_by_label(spark, sf):
    return search.homogeneity(_Tables(spark, sf).embeddings, by=["label"]).withColumn("homogeneity", F.round("homogeneity", 6))


@query(f"WITH {_SCORED} SELECT round(avg(score) FILTER (owner = wanted) - avg(score) FILTER (owner <> wanted), 6) AS separation FROM s")
def class_separation(spark, sf):
    return search.separation(*_sides(spark, sf)).select(F.round("separation", 6).alias("separation"))


@query()
def paired_bootstrap_ci(spark, sf):
    rows, truth = _ranked(spark, sf)
    a, b = evaluation.at_k(rows, truth, 10), evaluation.at_k(rows, truth, 5)
    d = audit.paired(a, b, "query_id", "precision").select(F.col("query_id").alias("id"), "delta")
    return evaluation.bootstrap(d, "delta")


_WILSON = "round(greatest(0, (p + 1.96^2 / (2 * n)) / (1 + 1.96^2 / n) - 1.96 * sqrt(p * (1 - p) / n + 1.96^2 / (4 * n * n)) / (1 + 1.96^2 / n)), 6) AS low, round(least(1, (p + 1.96^2 / (2 * n)) / (1 + 1.96^2 / n) + 1.96 * sqrt(p * (1 - p) / n + 1.96^2 / (4 * n * n)) / (1 + 1.96^2 / n)), 6) AS high"


@query(f"WITH g AS (SELECT lang, count(*) AS n, sum(quality)::BIGINT AS hits, sum(quality)::DOUBLE / count(*) AS p FROM labels JOIN documents USING (doc_id) GROUP BY 1) SELECT lang, n, hits, round(p, 6) AS rate, {_WILSON} FROM g")
def wilson_by_group(spark, sf):
    t = _Tables(spark, sf)
    return evaluation.proportions(t.labels.join(t.documents.select("doc_id", "lang"), "doc_id"), ["lang"], F.col("quality"), 6)


@query("SELECT lang, source, count(*) AS n, round(avg(quality), 9) AS quality, round(avg(toxic), 9) AS toxic FROM labels JOIN documents USING (doc_id) GROUP BY GROUPING SETS ((lang), (source), (lang, source), ())")
def metrics_grouping_sets(spark, sf):
    t = _Tables(spark, sf)
    rows = t.labels.join(t.documents.select("doc_id", "lang", "source"), "doc_id")
    return evaluation.metrics_by(rows, [["lang"], ["source"], ["lang", "source"], []], ["quality", "toxic"])


# profiling

@query("SELECT column_name AS \"column\", filled, round(filled / n, 9) AS rate FROM (SELECT count(*) AS n, count(doc_id) AS doc_id, count(CASE WHEN trim(text, E' \\n\\t\\r\\f\\x0B') <> '' THEN 1 END) AS text, count(nullif(trim(lang), '')) AS lang, count(nullif(trim(source), '')) AS source, count(n_chars) AS n_chars FROM documents) UNPIVOT (filled FOR column_name IN (doc_id, text, lang, source, n_chars))")
def fill_rate_profile(spark, sf):
    return profile.fill_rates(_Tables(spark, sf).documents)


@query("SELECT lang, count(*) FILTER (coalesce(length(text), 0) > 0) AS filled, count(*) FILTER (length(text) BETWEEN 1 AND 19) AS trivial, floor(quantile_cont(length(text), 0.5))::BIGINT AS median_length, floor(avg(length(text)))::BIGINT AS mean_length, round(avg((length(text) >= 100)::INTEGER), 9) AS long_share FROM documents GROUP BY lang")
def text_length_profile(spark, sf):
    return profile.text_lengths(_Tables(spark, sf).documents, "text", ["lang"])


@query("SELECT * FROM (SELECT event_type, user_id, count(*) AS count, row_number() OVER (PARTITION BY event_type ORDER BY count(*) DESC, user_id)::INTEGER AS place FROM events GROUP BY 1, 2) WHERE place <= 8")
def category_topn(spark, sf):
    return profile.top_values(_Tables(spark, sf).events, "user_id", ["event_type"], 8)


_ENTROPY = "c AS (SELECT col AS \"column\", v, count(*) AS n FROM (SELECT p_brand, p_type, CAST(p_size AS VARCHAR) AS p_size FROM part) UNPIVOT (v FOR col IN (p_brand, p_type, p_size)) GROUP BY 1, 2), p AS (SELECT *, n / sum(n) OVER (PARTITION BY \"column\") AS p FROM c), e AS (SELECT \"column\", count(*) AS classes, sum(n)::BIGINT AS filled, round(CASE WHEN count(*) > 1 THEN -sum(p * ln(p)) / ln(count(*)) ELSE 0 END, 6) AS entropy FROM p GROUP BY 1)"


@query(f"WITH {_ENTROPY} SELECT * FROM e")
def column_entropy(spark, sf):
    return profile.entropy(_Tables(spark, sf).part, ["p_brand", "p_type", "p_size"], 6)


@query(f"WITH {_ENTROPY.replace(', 6) AS entropy', ', 8) AS entropy')} SELECT \"column\", classes, filled, round(entropy, 6) AS entropy, round(filled / (SELECT count(*) FROM part) * entropy, 6) AS utility, CASE WHEN filled / (SELECT count(*) FROM part) * entropy >= 0.3 THEN 'keep' WHEN filled / (SELECT count(*) FROM part) * entropy >= 0.05 THEN 'review' ELSE 'drop' END AS verdict FROM e")
def utility_selection(spark, sf):
    return profile.utility(_Tables(spark, sf).part, ["p_brand", "p_type", "p_size"]).withColumns({c: F.round(c, 6) for c in ("entropy", "utility")})


_TITLE = "trim(regexp_replace(regexp_replace(strip_accents(lower(coalesce({}, ''))), '[^a-z0-9/ -]', ' ', 'g'), '\\s+', ' ', 'g'))"


@query(f"WITH g AS (SELECT {_TITLE.format('text')} AS k, count(*) AS c FROM documents GROUP BY 1) SELECT sum(c)::BIGINT AS n_rows, count(*) AS distinct_titles, count(*) FILTER (c = 1) AS used_once, sum(c) FILTER (c >= 2)::BIGINT AS in_groups_2, coalesce(sum(c) FILTER (c >= 10), 0)::BIGINT AS in_groups_10 FROM g")
def title_duplicate_stats(spark, sf):
    return profile.duplicate_titles(_Tables(spark, sf).documents, text.title_key(F.col("text")))


@query("""WITH p AS (SELECT p_brand, p_type, p_name, 'the same remark in every single row' AS remark, 'x' AS flag, p_partkey::VARCHAR AS k, p_name AS w FROM part),
    u AS (SELECT "column", v FROM p UNPIVOT (v FOR "column" IN (p_brand, p_type, p_name, remark, flag, k)) UNION ALL SELECT 'words', unnest(string_split(w, ' ')) FROM p)
    SELECT "column", count(DISTINCT v) AS distinct_values, max(length(v))::INTEGER AS longest, CASE WHEN bool_or(length(v) > 25) THEN 'text' WHEN count(DISTINCT v) = 1 THEN 'constant' WHEN count(DISTINCT v) <= 12 THEN 'code' ELSE 'high cardinality' END AS kind FROM u GROUP BY 1
    UNION ALL SELECT 'ref', NULL, NULL, 'reference' UNION ALL SELECT 'refs', NULL, NULL, 'reference'""")
def field_kinds(spark, sf):
    ref = F.struct(F.col("p_partkey").alias("_id"), F.col("p_name").alias("_label"))
    p = _Tables(spark, sf).part.select("p_brand", "p_type", "p_name", F.lit("the same remark in every single row").alias("remark"), F.lit("x").alias("flag"), F.col("p_partkey").alias("k"), F.split("p_name", " ").alias("words"), ref.alias("ref"), F.array(ref).alias("refs"), (F.col("p_size") > 5).alias("large"))
    return profile.field_kinds(p, p.columns)


_CASES = " ".join(f"WHEN regexp_matches(p_name, '{p}') THEN '{n}'" for n, p in FAMILIES)
_FAMILY = "f AS (SELECT *, [x for x in [" + ", ".join(f"CASE WHEN regexp_matches(p_name, '{p}') THEN '{n}' END" for n, p in FAMILIES) + "] if x IS NOT NULL] AS found FROM part), g AS (SELECT *, found[1] AS family, found[2] AS fallback FROM f)"


@query(f"SELECT p_partkey, CASE {_CASES} END AS family FROM part")
def first_match_family(spark, sf):
    return _Tables(spark, sf).part.select("p_partkey", text.first_match(F.col("p_name"), FAMILIES).alias("family"))


@query(f"WITH {_FAMILY} SELECT family, fallback, count(*) AS n FROM g GROUP BY 1, 2")
def family_fallback(spark, sf):
    return profile.with_families(_Tables(spark, sf).part, F.col("p_name"), FAMILIES).groupBy("family", "fallback").agg(F.count(F.lit(1)).alias("n"))


_KINDS = "CASE WHEN p_partkey % 9 = 0 THEN NULL WHEN p_partkey % 4 = 0 THEN p_type || ' | ' || p_brand ELSE p_type END"
_FAMILY_STATS = f"""{_FAMILY}, w AS (SELECT *, {_KINDS} AS kind, CASE WHEN p_size + 1990 BETWEEN 2000 AND 2026 THEN p_size + 1990 END AS y FROM g WHERE family IS NOT NULL),
    b AS (SELECT family, count(*) AS n, round(avg((p_size > 25)::INTEGER), 9) AS large_rate, min(y)::INTEGER AS first_year, max(y)::INTEGER AS last_year FROM w GROUP BY 1),
    kc AS (SELECT family, k, count(*) AS c FROM (SELECT family, trim(unnest(string_split(coalesce(nullif(trim(kind), ''), '(empty)'), '|'))) AS k FROM w) GROUP BY 1, 2),
    kp AS (SELECT *, c / sum(c) OVER (PARTITION BY family) AS p, row_number() OVER (PARTITION BY family ORDER BY c DESC, k) AS r FROM kc),
    ks AS (SELECT family, max(k) FILTER (r = 1) AS top_kind, max(c) FILTER (r = 1) AS c, count(*) AS n_kinds, round(CASE WHEN count(*) > 1 THEN -sum(p * ln(p)) / ln(count(*)) ELSE 0 END, 6) AS kind_entropy FROM kp GROUP BY 1),
    h AS (SELECT family, coalesce(fallback, '(unclassified)') AS top_fallback, count(*) AS c, row_number() OVER (PARTITION BY family ORDER BY count(*) DESC, coalesce(fallback, '(unclassified)')) AS r FROM w GROUP BY 1, 2),
    st AS (SELECT b.*, top_kind, round(ks.c / n, 9) AS kind_share, n_kinds, kind_entropy, top_fallback, round(h.c / n, 9) AS fallback_share FROM b JOIN ks USING (family) JOIN h ON b.family = h.family AND h.r = 1)"""


def _families(spark, sf):
    part = _Tables(spark, sf).part.withColumn("kind", F.expr("CASE WHEN p_partkey % 9 = 0 THEN NULL WHEN p_partkey % 4 = 0 THEN p_type || ' | ' || p_brand ELSE p_type END"))
    return profile.family_statistics(profile.with_families(part, F.col("p_name"), FAMILIES), {"large_rate": F.col("p_size") > 25}, "kind", F.col("p_size").cast("int") + 1990)


@query(f"WITH {_FAMILY_STATS} SELECT *, CASE WHEN kind_share >= 0.9 THEN 'redundant' WHEN starts_with(top_kind, 'ECO') THEN 'strong' WHEN kind_entropy > 0.75 THEN 'loose pattern' WHEN kind_share < 0.55 THEN 'strong' ELSE 'medium' END AS verdict FROM st")
def family_stats_verdict(spark, sf):
    return profile.family_verdict(_families(spark, sf), other="ECO")


@query(f"WITH {_FAMILY_STATS}, a AS (SELECT family AS largest, row_number() OVER (ORDER BY n DESC, family)::INTEGER AS place FROM st), c AS (SELECT family AS best_explained, row_number() OVER (ORDER BY large_rate DESC, family)::INTEGER AS place FROM st WHERE n >= 50) SELECT place, largest, best_explained FROM (SELECT * FROM a WHERE place <= 3) FULL JOIN (SELECT * FROM c WHERE place <= 3) USING (place)")
def volume_inversion(spark, sf):
    return profile.inversion(_families(spark, sf), "large_rate")


_THEME_ROWS = "t AS (SELECT doc_id, unnest([x for x in [" + ", ".join(f"CASE WHEN regexp_matches(lower(text), '{p}') THEN '{n}' END" for n, p in THEMES) + "] if x IS NOT NULL]) AS theme FROM documents)"


def _themes(spark, sf):
    return _Tables(spark, sf).documents.select("doc_id", F.explode(text.all_matches(F.lower("text"), THEMES)).alias("theme"))


@query(f"WITH {_THEME_ROWS} SELECT theme, count(*) AS n FROM t GROUP BY 1")
def multi_label_themes(spark, sf):
    return _themes(spark, sf).groupBy("theme").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {_THEME_ROWS}, g AS (SELECT theme, count(*) AS c FROM t GROUP BY 1) SELECT first(theme ORDER BY c DESC, theme DESC) AS majority, round(max(c) / sum(c), 9) AS share FROM g")
def majority_baseline(spark, sf):
    return profile.majority_share(_themes(spark, sf), "theme")


@query("WITH r AS (SELECT o_orderkey, o_orderstatus, o_orderpriority, o_totalprice, row_number() OVER (PARTITION BY o_orderstatus, o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) = 1 AS f FROM orders) SELECT o_orderkey, o_orderstatus, o_orderpriority, o_totalprice FROM r ORDER BY f DESC, o_totalprice DESC, o_orderkey LIMIT 20")
def stratified_pick(spark, sf):
    o = _Tables(spark, sf).orders.select("o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice")
    return profile.stratified(o, ["o_orderstatus", "o_orderpriority"], [F.desc("o_totalprice"), F.col("o_orderkey")], 20)


@query()
def hash_sample(spark, sf):
    return search.hash_sample(_Tables(spark, sf).documents.select("doc_id", "lang"), "doc_id", 100, 1)


# joins and graph tables

@query("SELECT o_orderkey, CASE WHEN c_custkey IS NOT NULL THEN c_mktsegment ELSE o_orderpriority END AS o_orderpriority FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_custkey % 2 = 0) ON o_custkey = c_custkey")
def csv_enrich_left_join(spark, sf):
    t = _Tables(spark, sf)
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderpriority")
    c = t.customer.filter("c_custkey % 2 = 0").select("c_custkey", F.col("c_mktsegment").alias("o_orderpriority"))
    return graph.enrich(o, c, F.col("o_custkey"), "c_custkey", ["o_orderpriority"]).drop("o_custkey")


@query("WITH p AS (SELECT c_custkey AS k, c_custkey // 10 AS p FROM customer) SELECT a.k AS child, a.p AS parent FROM p a WHERE a.p IN (SELECT k FROM p) AND a.k <> a.p")
def self_parent_join(spark, sf):
    c = _Tables(spark, sf).customer.select(F.col("c_custkey").alias("k"), F.expr("c_custkey div 10").alias("p"))
    return graph.hierarchy(c, "k", "p")


@query("SELECT a.p_partkey AS child, b.p_partkey AS parent FROM part a JOIN part b ON a.p_name = b.p_name AND a.p_brand = b.p_brand WHERE a.p_partkey > b.p_partkey AND a.p_size = b.p_size")
def title_parent_join(spark, sf):
    return graph.title_hierarchy(_Tables(spark, sf).part.select("p_partkey", "p_name", "p_brand", "p_size"), "p_partkey", ["p_name", "p_brand", "p_size"])


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)")
def semi_referenced(spark, sf):
    t = _Tables(spark, sf)
    return graph.referenced(t.customer.select("c_custkey", "c_name"), "c_custkey", t.orders, "o_custkey")


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def anti_uncited(spark, sf):
    t = _Tables(spark, sf)
    return audit.uncited(t.documents.select("doc_id"), t.labels, "doc_id")


_NODES = "n AS (SELECT 'Customer' AS label, c_custkey::VARCHAR AS key, c_name AS name FROM customer UNION ALL SELECT 'Nation', n_nationkey::VARCHAR, n_name FROM nation UNION ALL SELECT 'Region', r_regionkey::VARCHAR, r_name FROM region)"
_EDGES = "e AS (SELECT DISTINCT c_custkey::VARCHAR AS src, 'IN_NATION' AS rel, c_nationkey::VARCHAR AS dst FROM customer UNION ALL SELECT DISTINCT n_nationkey::VARCHAR, 'IN_REGION', n_regionkey::VARCHAR FROM nation UNION ALL SELECT DISTINCT o_custkey::VARCHAR, 'BOUGHT', l_partkey::VARCHAR FROM orders JOIN lineitem ON o_orderkey = l_orderkey)"


def _nodes(spark, sf):
    t = _Tables(spark, sf)
    n = graph.nodes(t.customer, "Customer", F.col("c_custkey"), name=F.col("c_name"))
    n = n.unionByName(graph.nodes(t.nation, "Nation", F.col("n_nationkey"), name=F.col("n_name")))
    return n.unionByName(graph.nodes(t.region, "Region", F.col("r_regionkey"), name=F.col("r_name")))


def _edges(spark, sf):
    t = _Tables(spark, sf)
    bought = t.orders.select("o_orderkey", "o_custkey").join(t.lineitem.select("l_orderkey", "l_partkey"), F.col("o_orderkey") == F.col("l_orderkey"))
    e = graph.edges(t.customer, F.col("c_custkey"), "IN_NATION", F.col("c_nationkey"))
    return e.unionByName(graph.edges(t.nation, F.col("n_nationkey"), "IN_REGION", F.col("n_regionkey"))).unionByName(graph.edges(bought, F.col("o_custkey"), "BOUGHT", F.col("l_partkey")))


@query(f"WITH {_NODES} SELECT * FROM n")
def graph_nodes(spark, sf):
    return _nodes(spark, sf).select("label", "key", F.col("props")["name"].alias("name"))


@query(f"WITH {_EDGES} SELECT * FROM e")
def graph_edges(spark, sf):
    return _edges(spark, sf)


@query(f"WITH {_EDGES} SELECT rel, count(*) AS n FROM e GROUP BY 1")
def edge_upsert_idempotent(spark, sf):
    e = _edges(spark, sf)
    return graph.merge_edges(e, e).groupBy("rel").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {_EDGES} SELECT rel, count(DISTINCT src) AS sources, count(DISTINCT dst) AS targets, count(*) AS links, round(count(*) / count(DISTINCT src), 9) AS mean_links FROM e GROUP BY 1")
def satellite_counts(spark, sf):
    return graph.satellites(_edges(spark, sf))


@query("SELECT DISTINCT 'Document' AS label, doc_id::VARCHAR AS key, true AS is_stub FROM (SELECT doc_id + 50 AS doc_id FROM labels) WHERE doc_id NOT IN (SELECT doc_id FROM documents)")
def stub_nodes(spark, sf):
    t = _Tables(spark, sf)
    known = graph.nodes(t.documents, "Document", F.col("doc_id"))
    return graph.stubs(known, t.labels.select((F.col("doc_id") + 50).alias("key")), "Document").select("label", "key", "is_stub")


@query("SELECT c_mktsegment AS src_label, 'ORDERED' AS rel, o_orderpriority AS dst_label, count(*) AS count FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL ORDER BY count DESC, 1, 3 LIMIT 10")
def triplet_topn(spark, sf):
    t = _Tables(spark, sf)
    e = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).withColumn("rel", F.lit("ORDERED"))
    return graph.triplets(e, F.col("c_mktsegment"), F.col("o_orderpriority"), 10)


@query("SELECT text, count(*) AS count FROM documents GROUP BY 1 HAVING count(*) > 1")
def uniqueness_check(spark, sf):
    return graph.text_violations(_Tables(spark, sf).documents, "text")



_LIST = "coalesce(string_agg(l_partkey::VARCHAR, ',' ORDER BY l_linenumber, l_partkey) FILTER (l_returnflag = '{}'), '')"


@query(f"SELECT l_orderkey, arg_min(l_shipdate, (l_linenumber, l_partkey, l_shipdate)) AS l_shipdate, {_LIST.format('A')} AS corrective, {_LIST.format('N')} AS preventive, {_LIST.format('R')} AS curative FROM lineitem GROUP BY 1")
def group_first_and_lists(spark, sf):
    kind = F.element_at(F.create_map(*[F.lit(x) for x in ("A", "corrective", "N", "preventive", "R", "curative")]), F.col("l_returnflag"))
    rows = _Tables(spark, sf).lineitem.withColumn("at", F.struct("l_linenumber", "l_partkey", "l_shipdate")).withColumn("kind", kind)
    g = readers.grouped_actions(rows, "l_orderkey", "at", "kind", ["l_partkey"], ["l_shipdate"])
    return g.select("l_orderkey", "l_shipdate", *[F.array_join(F.transform(c, lambda x: x["l_partkey"].cast("string")), ",").alias(c) for c in ("corrective", "preventive", "curative")])


_UUID = "substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-' || substr('89ab', (instr('0123456789abcdef', substr(h, 17, 1)) - 1) % 4 + 1, 1) || substr(h, 18, 3) || '-' || substr(h, 21, 12)"


_STRIP = "trim(lower({}), E' \\n\\t\\r\\f\\x0B')"


@query(f"""WITH d AS (SELECT min(doc_id) AS doc_id, count(*) AS shared, 'action:' || {_STRIP.format('text')} || ':' || {_STRIP.format('source')} || ':' || lang AS name FROM documents GROUP BY name),
    s AS (SELECT *, sha1(unhex('{NAMESPACE.hex}') || encode(name)) AS h FROM d) SELECT doc_id, shared, {_UUID} AS action_id FROM s""")
def shared_dedup_uuid5(spark, sf):
    """Actions of equal title, owner and date, whole: the text stands for the title, the source for the owner."""
    name = F.concat_ws(":", F.lit("action"), text.strip(F.lower("text")), text.strip(F.lower("source")), F.col("lang"))
    g = _Tables(spark, sf).documents.select("doc_id", scalars.uuid5(NAMESPACE, name).alias("action_id"))
    return g.groupBy("action_id").agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("shared"))


@query("SELECT user_id, max_by(event_type, event_id) AS event_type, max_by(value, event_id) FILTER (value IS NOT NULL) AS value, max(event_id) AS event_id FROM events GROUP BY 1")
def node_upsert(spark, sf):
    e = _Tables(spark, sf).events.select("user_id", "event_type", "value", "event_id")
    old, new = e.filter("event_id % 2 = 0"), e.filter("event_id % 2 = 1")
    once = graph.upsert(old, new, ["user_id"], "event_id")
    return graph.upsert(once, new, ["user_id"], "event_id")


@query("SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE coalesce(s, c_mktsegment) END AS c_mktsegment FROM customer LEFT JOIN (SELECT DISTINCT o_custkey, 'ACTIVE' AS s FROM orders) ON c_custkey = o_custkey")
def payload_patch(spark, sf):
    t = _Tables(spark, sf)
    values = t.orders.select(F.col("o_custkey").alias("c_custkey")).distinct().withColumn("c_mktsegment", F.lit("ACTIVE"))
    return graph.patch(t.customer.select("c_custkey", "c_mktsegment"), values, "c_custkey", ["c_mktsegment"], F.col("c_custkey") % 3 == 0)


@query("SELECT coalesce(a.column_name, b.column_name) AS property, a.column_name IS NOT NULL AS in_a, b.column_name IS NOT NULL AS in_b FROM (DESCRIBE documents) a FULL JOIN (DESCRIBE labels) b ON a.column_name = b.column_name")
def set_difference_columns(spark, sf):
    t = _Tables(spark, sf)
    names = lambda d: spark.createDataFrame([(c,) for c in d.columns], "property string")
    return graph.property_differences(names(t.documents), names(t.labels))


# text

@query(r"SELECT doc_id, trim(regexp_replace(translate(lower(text), 'àâäáãåéèêëíîïìóôöòõúùûüçñýÿ', 'aaaaaaeeeeiiiiooooouuuucnyy'), '\s+', ' ', 'g')) AS folded FROM documents")
def accent_fold(spark, sf):
    return _Tables(spark, sf).documents.select("doc_id", text.fold(F.col("text")).alias("folded"))


@query(f"SELECT p_partkey, {_TITLE.format('p_name')} AS title FROM part")
def title_keys(spark, sf):
    return _Tables(spark, sf).part.select("p_partkey", text.title_key(F.col("p_name")).alias("title"))


@query()
def html_to_text_chunks(spark, sf):
    return html.chunks(_Tables(spark, sf).pages, "html", "page_id")


@query()
def html_plain_text(spark, sf):
    return html.plain_text(_Tables(spark, sf).pages.select("page_id", "html"), "html").drop("html")


@query("SELECT conv_id, turn, role, lead(turn) OVER w AS next_turn, length(text)::INTEGER AS n FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)")
def thread_segments(spark, sf):
    w = Window.partitionBy("conv_id").orderBy("turn")
    return _Tables(spark, sf).conversations.select("conv_id", "turn", "role", F.lead("turn").over(w).alias("next_turn"), F.length("text").alias("n"))


@query("SELECT conv_id, turn - 0 AS turn, role, row_number() OVER (PARTITION BY conv_id ORDER BY turn)::INTEGER - 1 AS entry FROM conversations")
def thread_from_text(spark, sf):
    c = _Tables(spark, sf).conversations
    whole = c.groupBy("conv_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("turn", "role"))), lambda x: F.concat(F.lit("## "), x["role"], F.lit(" "), x["turn"].cast("string"), F.lit("\nbody\n"))), "").alias("t"))
    rows = documents.thread(whole, "t", "## [a-z]+ [0-9]+")
    return rows.select("conv_id", F.regexp_extract("header", "([0-9]+)$", 1).cast("long").alias("turn"), F.regexp_extract("header", "## ([a-z]+)", 1).alias("role"), (F.row_number().over(Window.partitionBy("conv_id").orderBy("entry")) - 1).alias("entry"))


@query("SELECT o_orderkey, concat_ws(E'\\n', 'Order ' || o_orderkey, concat_ws(' | ', strftime(o_orderdate, '%d/%m/%Y'), nullif(trim(c_mktsegment), ''), n_name), nullif(trim(o_orderpriority), '')) AS document FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey")
def document_verbalisation(spark, sf):
    t = _Tables(spark, sf)
    j = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(F.broadcast(t.nation), F.col("c_nationkey") == F.col("n_nationkey"))
    doc = documents.document(F.concat(F.lit("Order "), F.col("o_orderkey").cast("string")), [documents.day(F.col("o_orderdate")), F.col("c_mktsegment"), F.col("n_name")], F.col("o_orderpriority"), [])
    return j.select("o_orderkey", doc.alias("document"))


@query()
def greedy_pack_segments(spark, sf):
    d = _Tables(spark, sf).documents.select("doc_id", "text")
    return documents.segments(d, F.split("text", "\n"), 1800)



_COMMON, _JARGON = ("DE", "LE", "THE", "ERE", "ST"), ("iso", "er")
#: Words apart by two blanks, so that neighbours are found as well.
_APART = r"'  ' || regexp_replace(text, '[^\p{L}\p{N}_]+', '  ', 'g') || '  '"


@query(rf"""WITH t AS (SELECT doc_id, f, text FROM (SELECT doc_id, text, source || ' Q.R.P et Q.R ISO (NP7)' AS source FROM documents) UNPIVOT (text FOR f IN (text, source))),
    o AS (SELECT doc_id, f, text, unnest([{{'a': replace(x, '.', ''), 's': x}} for x in regexp_extract_all(regexp_replace(text, '[^\p{{L}}\p{{N}}_.]+', '  ', 'g'), '(?:^| )((?:[A-Z]\.){{2,}}[A-Z]?)(?: |$)', 1)] || [{{'a': x, 's': x}} for x in regexp_extract_all({_APART}, ' ([A-Z][A-Z0-9]{{1,7}}) ', 1)]
        || [{{'a': upper(x), 's': x}} for x in regexp_extract_all({_APART}, ' ((?i:iso|er)) ', 1)], recursive := true) FROM t),
    n AS (SELECT a, count(*) AS frequency, count(DISTINCT doc_id) AS n_docs FROM o GROUP BY 1),
    s AS (SELECT a, string_agg(s || ':' || c, ' ' ORDER BY c DESC, s) AS spellings FROM (SELECT a, s, count(*) AS c FROM o GROUP BY 1, 2) GROUP BY 1),
    g AS (SELECT a, string_agg(f || ':' || c, ' ' ORDER BY c DESC, f) AS fields FROM (SELECT a, f, count(*) AS c FROM o GROUP BY 1, 2) GROUP BY 1)
    SELECT a AS acronym, frequency, n_docs, CASE WHEN a IN ('ISO', 'ER') THEN 'lower case' WHEN regexp_matches(a, '[0-9]') THEN 'with digits' ELSE 'letters' END AS category, spellings, fields, CASE WHEN strip_accents(a) IN ('DE', 'LE', 'THE', 'ERE', 'ST') AND a <> 'ST' THEN 'common word' END AS reason FROM n JOIN s USING (a) JOIN g USING (a)""")
def acronym_dictionary(spark, sf):
    d = _Tables(spark, sf).documents.select(F.col("doc_id").alias("id"), "text", F.concat("source", F.lit(" Q.R.P et Q.R ISO (NP7)")).alias("source"))
    texts = d.unpivot("id", ["text", "source"], "field", "text").filter("text is not null")
    return profile.acronym_dictionary(texts, _COMMON, protected=["ST"], lower=_JARGON).drop("excerpts")


@query(r"SELECT doc_id, regexp_replace(regexp_replace(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}', '[email]', 'g'), '(^|[^0-9A-Za-z_])(?:\+33 ?|0)[1-9](?:[\s.-]?[0-9]{2}){4}\b', '\1[tel]', 'g') AS scrubbed FROM documents")
def pii_scrub(spark, sf):
    return _Tables(spark, sf).documents.select("doc_id", text.scrub(F.col("text")).alias("scrubbed"))


@query("SELECT conv_id, turn, len(regexp_extract_all(text, '[0-9]{2,}')) AS citations FROM conversations")
def citation_audit(spark, sf):
    return _Tables(spark, sf).conversations.select("conv_id", "turn", F.size(text.identifiers(F.col("text"), "[0-9]{2,}")).alias("citations"))


# answers of the assistant, with what the user of the same conversation wrote as their context; identifiers are words
# that begin with wh, counted claims numbers before `to` or `and`

_ANSWERS = r"""a AS (SELECT conv_id, turn, text, conv_id % 4 = 0 AS refuse FROM conversations WHERE role = 'assistant'),
    c AS (SELECT conv_id, list_distinct(flatten(list(regexp_extract_all(lower(text), 'wh[a-z]+')))) AS ctx FROM conversations WHERE role = 'user' GROUP BY 1),
    x AS (SELECT a.*, coalesce(ctx, []) AS ctx, regexp_extract_all(text, '(?i)wh[a-z]+') AS cited, [regexp_replace(n, '[^0-9]', '', 'g')::BIGINT for n in regexp_extract_all(text, '(?i)(?:^|[^0-9A-Za-z])([0-9][0-9  ]{0,9}) *(?:to|and)(?:[^0-9A-Za-z]|$)', 1)] AS numbers FROM a LEFT JOIN c USING (conv_id)),
    y AS (SELECT *, CASE WHEN len(ctx) > 0 THEN [w for w in cited if NOT list_contains(ctx, lower(w))] ELSE [] END AS lost FROM x)"""


@query(f"""WITH {_ANSWERS} SELECT conv_id, turn, len(cited)::INTEGER AS citations, len(lost)::INTEGER AS outside, array_to_string(lost[1:3], ',') AS examples, len(lost) = 0 AS ok_citations, regexp_matches(text, '(?i)(pas|not|kein)') AS abstained,
    regexp_matches(text, '(?i)(pas|not|kein)') = refuse AS ok_abstention, CASE WHEN refuse THEN len(numbers) = 0 ELSE len([n for n in numbers if n > greatest(CASE WHEN len(ctx) > 0 THEN len(ctx) ELSE 999 END, 50)]) = 0 END AS ok_numbers, length(text)::INTEGER AS length, length(text) BETWEEN 80 AND 4000 AS ok_length FROM y""")
def answer_flags(spark, sf):
    c = _Tables(spark, sf).conversations
    words = F.array_distinct(F.flatten(F.collect_list(text.identifiers(F.lower("text"), "wh[a-z]+"))))
    a = c.filter("role = 'assistant'").join(c.filter("role = 'user'").groupBy("conv_id").agg(words.alias("ctx")), "conv_id", "left")
    flags = audit.deterministic(F.col("text"), F.coalesce("ctx", F.array().cast("array<string>")), F.col("conv_id") % 4 == 0, "(?i)wh[a-z]+", "(pas|not|kein)", "to|and")
    return a.select("conv_id", "turn", *[(F.array_join(v, ",") if n == "examples" else v).alias(n) for n, v in flags.items()])


_FOLDED = "strip_accents(lower({}))"


@query(f"""WITH l AS (SELECT doc_id, text, {_FOLDED.format('text')} AS t, ['ABSTENTION', 'CEILING', 'EXACT'][doc_id % 3 + 1] AS w, CASE doc_id % 4 WHEN 0 THEN [left(text, 40), lang, 'zzz', 'qqq'] WHEN 1 THEN [lang, source] WHEN 2 THEN [regexp_replace(format('{{:,}}', n_chars), ',', ' ', 'g'), n_chars::VARCHAR] ELSE [source, 'erst'] END AS e, source || ' thention andthe' AS lim FROM documents),
    v AS (SELECT *, len([x for x in e if x <> '' AND (contains(t, {_FOLDED.format('x')}) OR (length(x) > 25 AND contains(t, left({_FOLDED.format('x')}, 25))))]) AS n FROM l)
    SELECT doc_id, CASE w WHEN 'ABSTENTION' THEN regexp_matches(text, '(?i)(pas|not|kein)') OR trim(t, E' \n\t\r\f\x0B') = '' WHEN 'CEILING' THEN len(list_intersect([x for x in regexp_split_to_array({_FOLDED.format('lim')}, '\\s+') if length(x) > 5], regexp_split_to_array(t, '\\s+'))) > 0 ELSE n >= greatest(1, len(e) // 2) END AS passed FROM v""")
def status_rule(spark, sf):
    d = _Tables(spark, sf).documents
    i = F.col("doc_id")
    wanted = F.when(i % 3 == 0, "ABSTENTION").when(i % 3 == 1, "CEILING").otherwise("EXACT")
    kind = F.element_at(F.array(*[F.lit(x) for x in ("ranking", "distribution", "number", "comparison")]), (i % 4 + 1).cast("int"))
    entries = F.when(i % 4 == 1, F.create_map("lang", F.lit("x"), "source", F.lit("y"))).otherwise(F.create_map(F.lit("a"), "source", F.lit("b"), F.lit("erst")))
    expected = audit.expected_values(kind, F.array(F.left("text", F.lit(40)), "lang", F.lit("zzz"), F.lit("qqq")), entries, F.col("n_chars").cast("long"))
    return d.select("doc_id", audit.status(wanted, expected, F.concat("source", F.lit(" thention andthe")), F.col("text"), "(pas|not|kein)").alias("passed"))


@query("SELECT event_type, count(*) AS n, count(*) FILTER (user_id % 3 <> event_id % 3) AS misrouted, count(*) FILTER (user_id % 3 <> event_id % 3 AND value < 10) AS costly FROM events GROUP BY 1")
def routing_cost(spark, sf):
    return audit.routing(_Tables(spark, sf).events, F.col("user_id") % 3, F.col("event_id") % 3, F.col("value"), F.lit(10.0), ["event_type"])


@query("SELECT event_type, count(*) AS n, sum(CAST(json_extract(props, '$.k') AS BIGINT))::BIGINT AS total FROM events GROUP BY 1")
def json_prop_extract(spark, sf):
    k = F.try_variant_get(scalars.tolerant_json(F.col("props")), "$.k", "bigint")
    return _Tables(spark, sf).events.select("event_type", k.alias("k")).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("k").alias("total"))


@query("SELECT * FROM (VALUES ('36L', 'LFLL', '36L', '35L', true, 1, NULL, NULL), ('17L/35R', 'LFLL', '17L,35R', '17L,35R', false, 1, NULL, NULL), ('36L/36R', 'LFLL', '36L,36R', '35L,35R', true, 2, NULL, NULL), ('34L', 'LFLY', '34L', '34', false, 1, NULL, NULL), ('16/34', 'LFLY', '16,34', '16,34', false, 1, NULL, NULL), ('C/D 11', 'LFLY', NULL, NULL, false, NULL, NULL, NULL), ('C83', 'LFLL', NULL, NULL, false, NULL, 'C83', NULL), ('36L - man', 'LFLL', '36L', '35L', true, 1, NULL, 'MAN'), (NULL, 'LFLY', NULL, NULL, false, NULL, NULL, NULL), ('99L', 'LFLL', '99L', NULL, false, NULL, NULL, NULL)) t(precisions, code, raw, runway, renamed, strips, stand, zone)")
def place_normalisation(spark, sf):
    rows = [("36L", 0), ("17L/35R", 0), ("36L/36R", 0), ("34L", 1), ("16/34", 1), ("C/D 11", 1), ("C83", 0), ("36L - man", 0), (None, 1), ("99L", 0)]
    d = spark.createDataFrame([(p, places.SITES[i].label) for p, i in rows], "precisions string, site string").select("precisions", places.normalise(F.col("precisions"), F.col("site")).alias("p"))
    return d.select("precisions", F.col("p.aerodrome_code").alias("code"), F.array_join("p.runway_raw", ",").alias("raw"), F.array_join("p.runway_current", ",").alias("runway"), F.col("p.runway_renamed").alias("renamed"), F.col("p.strips").alias("strips"), F.col("p.stand").alias("stand"), F.col("p.zone").alias("zone"))


@query("SELECT year(o_orderdate)::INTEGER AS year, month(o_orderdate)::INTEGER AS month, (isodow(o_orderdate) - 1)::INTEGER AS weekday, count(*) AS n FROM orders GROUP BY ALL")
def weekday_month_year_counts(spark, sf):
    d = F.col("o_orderdate")
    return _Tables(spark, sf).orders.groupBy(F.year(d).alias("year"), F.month(d).alias("month"), F.weekday(d).alias("weekday")).agg(F.count(F.lit(1)).alias("n"))


@query("WITH y AS (SELECT year(o_orderdate)::INTEGER AS year, o_orderpriority, count(*) AS n FROM orders GROUP BY ALL) SELECT *, n - lag(n) OVER (PARTITION BY o_orderpriority ORDER BY year) AS change FROM y")
def yoy_trend(spark, sf):
    y = _Tables(spark, sf).orders.groupBy(F.year("o_orderdate").alias("year"), "o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    return y.withColumn("change", F.col("n") - F.lag("n").over(Window.partitionBy("o_orderpriority").orderBy("year")))



_MINED = """r AS (SELECT o_orderkey AS i, year(o_orderdate)::INTEGER AS y, o_orderpriority AS p, o_orderstatus AS k, CASE WHEN o_custkey % 10 < 7 THEN 'zone ' || o_custkey % 3 END AS z, c_name || ' ' || o_orderpriority || ' ' || repeat(c_mktsegment || ' ', (o_orderkey % 20)::INTEGER) AS t FROM orders JOIN customer ON o_custkey = c_custkey)"""


@query(f"""WITH {_MINED}, n AS (SELECT p, count(*) AS n, min(y) AS first_year, max(y) AS last_year FROM r GROUP BY 1),
    k AS (SELECT p, k, count(*) AS c, row_number() OVER (PARTITION BY p ORDER BY count(*) DESC, k) AS o FROM r GROUP BY 1, 2),
    z AS (SELECT p, z, count(*) AS c, row_number() OVER (PARTITION BY p ORDER BY count(*) DESC, z) AS o FROM r WHERE z IS NOT NULL GROUP BY 1, 2),
    zz AS (SELECT p, string_agg(z.z, ',' ORDER BY z.c DESC, z.z) AS places FROM z JOIN n USING (p) WHERE o <= 2 AND z.c >= 3 AND z.c / n.n >= 0.25 GROUP BY 1),
    e AS (SELECT p, string_agg(left(t, 120), ';' ORDER BY i) AS examples FROM (SELECT *, row_number() OVER (PARTITION BY p ORDER BY i) AS o FROM r WHERE length(t) > 25) WHERE o <= 3 GROUP BY 1)
    SELECT n.p AS o_orderpriority, n.n, first_year, last_year, CASE WHEN k.c / n.n >= 0.35 THEN k END AS main_kind, places, examples FROM n JOIN k ON n.p = k.p AND o = 1 LEFT JOIN zz ON n.p = zz.p LEFT JOIN e ON n.p = e.p""".replace("0.35", "0.6"))
def mined_facts(spark, sf):
    t = _Tables(spark, sf)
    o = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    place = F.when(F.col("o_custkey") % 10 < 7, F.concat(F.lit("zone "), (F.col("o_custkey") % 3).cast("string")))
    said = F.concat("c_name", F.lit(" "), "o_orderpriority", F.lit(" "), F.repeat(F.concat("c_mktsegment", F.lit(" ")), (F.col("o_orderkey") % 20).cast("int")))
    rows = o.select("o_orderkey", "o_orderpriority", "o_orderstatus", F.year("o_orderdate").alias("y"), place.alias("place"), said.alias("said"))
    m = audit.mined_facts(rows, ["o_orderpriority"], "o_orderstatus", "place", "y", "said", "o_orderkey")
    return m.withColumns({"places": F.array_join("places", ","), "examples": F.array_join("examples", ";")})


@query(SQL["node_upsert"])
def incremental_upsert(spark, sf):
    path = f"{sinks.shared_folder(spark)}/upsert-{uuid.uuid4().hex}"
    e = _Tables(spark, sf).events.select("user_id", "event_type", "value", "event_id")
    for i in range(2):
        e.filter(F.col("event_id") % 2 == i).write.parquet(f"{path}/in/{i}")
    stream = spark.readStream.schema(e.schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/in/*")
    q = incremental.upsert_stream(stream, f"{path}/out", f"{path}/state", ["user_id"], "event_id")
    q.awaitTermination()
    return incremental.newest(spark, f"{path}/out", e.schema)
