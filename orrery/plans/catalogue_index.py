"""Registered queries over indexes, dictionaries and caches."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import text
from ..operators import containment, graph, stores, terms, vector_blocks, vector_index
from ..sources import sinks
from ..streaming.embedding_cache import EmbeddingCache
from . import table_functions
from .catalogue import WORDS, _SCORED, _sides, _Tables, query


def _folder(spark, label: str) -> str:
    return f"{sinks.shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


@query(f"WITH b AS (SELECT item_id, strip_accents(lower(text)) AS t FROM benchmark), d AS (SELECT doc_id, strip_accents(lower(text)) AS t FROM documents), w AS (SELECT b.item_id, d.doc_id, regexp_extract_all(b.t, '{WORDS}') AS w, d.t FROM b, d) SELECT item_id, doc_id, round(len([x for x in w if contains(t, x)]) / len(w), 9) AS ratio FROM w WHERE len(w) > 0 AND round(len([x for x in w if contains(t, x)]) / len(w), 9) >= 0.9")
def word_overlap_ratio(spark, sf):
    t = _Tables(spark, sf)
    # runs of letters and digits don't ask for single blanks; texts of ASCII alone have no marks
    plain = F.when(F.octet_length("text") == F.length("text"), F.lower("text")).otherwise(text.unmark(F.lower("text")))
    b, d = t.benchmark.select("item_id", plain.alias("need")), t.documents.select("doc_id", plain.alias("text"))
    return containment.word_shares(b, d, 0.9, "item_id", "need", "doc_id", "text")


# the vector index: every row whose id is divisible by 100 asks; a filter on the payload field

CELLS, ASKED_LABELS = 64, "label % 2 = 0"


def _indexed(spark, sf):
    e = _Tables(spark, sf).embeddings.select(F.col("vec_id").alias("id"), "embedding", "label")
    q = e.filter("id % 100 = 0").select(F.col("id").alias("query_id"), F.col("embedding").alias("q"))
    return e, q, vector_index.build(e, _folder(spark, "vector-index"), CELLS, payload="label")


@query(f"WITH {_SCORED.replace('WHERE vec_id <> query_id', '')}, r AS (SELECT query_id, id, round(score, 6) AS score, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 6) DESC, id)::INTEGER AS rank FROM s WHERE owner % 2 = 0) SELECT * FROM r WHERE rank <= 10")
def indexed_topk_exact(spark, sf):
    _, q, index = _indexed(spark, sf)
    return vector_index.search(index, q, 10, where=F.expr(ASKED_LABELS), digits=6)


@query()
def indexed_topk_recall(spark, sf):
    """Recall of the probing search per query against the exhaustive one, with the probes that a sample of queries calls for."""
    e, q, index = _indexed(spark, sf)
    where = F.expr(ASKED_LABELS)
    probes = vector_index.probes_for(index, q, 10, where=where)
    found = vector_index.search(index, q, 10, probes, where)
    return vector_index.recall(found, vector_index.exhaustive(e, q, 10, where)).withColumn("probes", F.lit(probes))


# dictionaries of all customers' names and of all parts' words

@query(r"""WITH n AS (SELECT c_name, row_number() OVER (ORDER BY c_name) AS i FROM (SELECT DISTINCT c_name FROM customer)), c AS (SELECT c.c_custkey, n.i FROM customer c JOIN n USING (c_name))
    SELECT o_orderkey, o_orderpriority || ' vu par Agent_' || CASE WHEN i < 1000 THEN lpad(i::VARCHAR, 3, '0') ELSE i::VARCHAR END || ', Agent_' || CASE WHEN i < 1000 THEN lpad(i::VARCHAR, 3, '0') ELSE i::VARCHAR END || '.' AS scrubbed FROM orders JOIN c ON o_custkey = c_custkey""")
def scrubbed_customers(spark, sf):
    """Every order's note with its customer's name in two cases, scrubbed of all customers' names."""
    t = _Tables(spark, sf)
    name = t.customer.select("c_custkey", "c_name")
    notes = t.orders.join(name, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", F.concat("o_orderpriority", F.lit(" vu par "), "c_name", F.lit(", "), F.upper("c_name"), F.lit(".")).alias("scrubbed"))
    return terms.replaced(notes, "scrubbed", text.pseudonyms(terms.read_terms(t.customer, "c_name")))


@query("""WITH w AS (SELECT DISTINCT unnest(string_split(p_name, ' ')) AS w FROM part), u AS (SELECT DISTINCT p_type AS w FROM part UNION SELECT w FROM w WHERE w <> '')
    SELECT p_partkey, list_sort((SELECT list(DISTINCT w) FROM u WHERE contains(p_name, w) OR contains(p_type, w))) AS held FROM part""")
def dictionary_containment(spark, sf):
    p = _Tables(spark, sf).part
    words = p.select(F.explode(F.split("p_name", " ")).alias("w")).union(p.select("p_type"))
    return terms.held(p.select("p_partkey", "p_name", "p_type"), ["p_name", "p_type"], terms.read_terms(words, "w"), "held").select("p_partkey", "held")


# the embedding cache, with a model that SQL can follow: digits of the text's digest

def _digest_vector(asked):
    return asked.select("digest", F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: F.conv(F.substring(F.md5("text"), i * 4 + F.lit(1), F.lit(4)), 16, 10).cast("double")).alias("vector"))


@query("""SELECT doc_id, (('0x' || md5(text)[1:4])::BIGINT + 2 * ('0x' || md5(text)[5:8])::BIGINT + 3 * ('0x' || md5(text)[9:12])::BIGINT + 4 * ('0x' || md5(text)[13:16])::BIGINT)::DOUBLE AS weighted,
    (SELECT count(DISTINCT text) FROM documents WHERE doc_id % 3 > 0)::BIGINT AS first_run, (SELECT count(DISTINCT text) FROM documents WHERE text NOT IN (SELECT text FROM documents WHERE doc_id % 3 > 0 AND text IS NOT NULL))::BIGINT AS second_run, 0::BIGINT AS third_run FROM documents""")
def embedding_cache_runs(spark, sf):
    """A first run over two thirds of the documents, one over all of them, and a repeated one: how many vectors each computes."""
    d = _Tables(spark, sf).documents.select("doc_id", "text")
    cache = EmbeddingCache(spark, _folder(spark, "embedding-cache"), "digest-v1", _digest_vector)
    runs = [cache.fill(d.filter("doc_id % 3 > 0")), cache.fill(d), cache.fill(d)]
    weighted = F.aggregate(F.zip_with("vector", F.array(*map(F.lit, (1, 2, 3, 4))), lambda x, w: x * w), F.lit(0.0), lambda s, x: s + x)
    return cache.embedded(d).select("doc_id", weighted.alias("weighted"), *[F.lit(n).cast("long").alias(c) for n, c in zip(runs, ("first_run", "second_run", "third_run"))])


# stores: payloads apart from vectors, keys checked on write, schemas by module

@query("""SELECT vec_id, CASE WHEN label % 5 = 0 THEN NULL WHEN vec_id % 3 = 0 THEN 'patched' ELSE 'kind ' || label END AS kind, CASE WHEN vec_id % 7 = 0 THEN vec_id END AS place, (round(embedding[1]::DOUBLE * 1000)::BIGINT + round(embedding[64]::DOUBLE * 1000)::BIGINT) AS ends FROM embeddings""")
def patched_points(spark, sf):
    """Points whose payload is patched twice and purged once."""
    e = _Tables(spark, sf).embeddings
    store = stores.PointStore(spark, _folder(spark, "points"), "vec_id", "long", "kind string, place long, label int")
    store.add(e.select("vec_id", F.col("embedding").alias("vector"), F.concat(F.lit("kind "), F.col("label").cast("string")).alias("kind"), F.lit(None).cast("long").alias("place"), "label"))
    store.patch(e.filter("vec_id % 3 = 0").select("vec_id", F.lit("patched").alias("kind")))
    store.patch(e.filter("vec_id % 7 = 0").select("vec_id", F.col("vec_id").alias("place")))
    store.purge(["kind"], F.col("label") % 5 == 0)
    ends = sum((F.round(F.get("vector", F.lit(i)) * 1000).cast("long") for i in (0, 63)), F.lit(0).cast("long"))
    return store.points().select("vec_id", "kind", "place", ends.alias("ends"))


@query("""WITH b AS (SELECT c_custkey, c_mktsegment FROM customer WHERE c_custkey % 4 = 0 UNION ALL SELECT c_custkey, c_mktsegment FROM customer WHERE c_custkey % 4 > 1 UNION ALL SELECT c_custkey, c_mktsegment FROM customer WHERE c_custkey % 6 = 3)
    SELECT CASE WHEN c_custkey % 4 = 0 THEN 'known key' WHEN n > 1 THEN 'repeated key' ELSE 'written' END AS outcome, count(*) AS n, sum(c_custkey)::BIGINT AS keys FROM (SELECT *, count(*) OVER (PARTITION BY c_custkey) AS n FROM b) GROUP BY 1
    UNION ALL SELECT 'first batch', count(*), sum(c_custkey)::BIGINT FROM customer WHERE c_custkey % 4 = 0""")
def constrained_batches(spark, sf):
    """A first batch, then one with keys of the first, keys of its own, and keys that it repeats."""
    c = _Tables(spark, sf).customer.select("c_custkey", "c_mktsegment")
    table = stores.KeyedTable(spark, _folder(spark, "keyed"), "c_custkey", "long")
    table.append(c.filter("c_custkey % 4 = 0"))
    first = table.rows().withColumn("outcome", F.lit("first batch"))
    first = sinks.written(first, "first-batch")
    second = c.filter("c_custkey % 4 = 0").unionByName(c.filter("c_custkey % 4 > 1")).unionByName(c.filter("c_custkey % 6 = 3"))
    table.append(second)
    new = table.rows().join(first.select("c_custkey"), "c_custkey", "left_anti").withColumn("outcome", F.lit("written"))
    every = first.unionByName(new).unionByName(table.quarantine().withColumnRenamed("reason", "outcome"))
    return every.groupBy("outcome").agg(F.count(F.lit(1)).alias("n"), F.sum("c_custkey").alias("keys"))


@query("SELECT p_brand AS module, p_partkey AS place, CASE WHEN p_brand < 'Brand#3' THEN 'new' ELSE 'old' END AS label FROM part WHERE p_brand >= 'Brand#3' OR p_partkey % 2 = 0")
def published_fields(spark, sf):
    """Fields of every module, then of some modules again, without half of them."""
    p = _Tables(spark, sf).part.select(F.col("p_brand").alias("module"), F.col("p_partkey").alias("place"))
    path = _folder(spark, "published")
    stores.publish(p.withColumn("label", F.lit("old")), path)
    stores.publish(p.filter("module < 'Brand#3' and place % 2 = 0").withColumn("label", F.lit("new")), path)
    return spark.read.parquet(path).select(F.col("module").cast("string").alias("module"), "place", "label")


@query(f"""WITH {_SCORED}, r AS (SELECT query_id, owner, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 6) DESC, id) AS rank FROM s), f AS (SELECT query_id, owner, count(*) AS n FROM r WHERE rank <= 20 GROUP BY ALL),
    a AS (SELECT list(label ORDER BY n DESC, label)[1:3] AS al FROM (SELECT label, count(*) AS n FROM embeddings GROUP BY 1)), o AS (SELECT query_id, sum(n)::BIGINT AS n, list(owner ORDER BY n DESC, owner)[1:3] AS own FROM f GROUP BY 1)
    SELECT query_id, n, n AS n_told, own[1] AS first, own[1] = al[1] AS first_right, own = al AS top_right FROM o, a""")
def sample_rankings(spark, sf):
    """Labels among the 20 best of every query, ranked, against the ranking of all labels."""
    found = vector_blocks.top_rows(*_sides(spark, sf), 20, 6).withColumnRenamed("owner", "label")
    return stores.sample_against_population(found, _Tables(spark, sf).embeddings, "label")


# table functions, called in SQL; tests hold them against the DataFrame functions

def _sql(spark, sf, table: str, statement: str):
    table_functions.register(spark)
    return spark.sql(statement, t=_Tables(spark, sf).__getattr__(table))


@query()
def sql_html_chunks(spark, sf):
    return _sql(spark, sf, "pages", "SELECT page_id, c.* FROM {t}, LATERAL html_chunks(html, 1500, 25) c")


@query()
def sql_packed_lines(spark, sf):
    return _sql(spark, sf, "documents", "SELECT doc_id, s.* FROM {t}, LATERAL packed_lines(split(text, '\\n'), 1800) s")


@query("SELECT property, bool_or(t = 'a') AS in_a, bool_or(t = 'b') AS in_b FROM (SELECT DISTINCT unnest(json_keys(props)) AS property, 'a' AS t FROM events WHERE event_type IN ('click', 'view') UNION ALL SELECT DISTINCT unnest(json_keys(props)), 'b' FROM events WHERE event_id % 2 = 0) GROUP BY 1")
def property_presence(spark, sf):
    """Properties that the rows of two exports hold, told from the rows' JSON."""
    e = _Tables(spark, sf).events
    names = lambda d: d.select(F.explode(F.json_object_keys("props")).alias("property"))
    return graph.property_differences(names(e.filter("event_type in ('click', 'view')")), names(e.filter("event_id % 2 = 0")))
