"""More registered queries: golden questions, audits of answers, parsing, reports. Each with the SQL of its rule."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import places, scalars, text
from ..operators import audit, documents, evaluation, golden, graph, profile, search, vector_blocks
from ..sources import sinks
from ..streaming import incremental
from . import catalogue, schema, tickets
from .catalogue import SQL, _FOLDED, _RANKED, _SCORED, _ranked, _sides, _Tables, query

_STRIP = "trim({}, E' \\n\\t\\r\\f\\x0B')"


# predicates and golden questions

_BASES = {"thewh": "the.*wh", "tion": "tion", "keit": "keit"}
_DISCS = {("source", "src1"): "source = 'src1'", ("source", "src2"): "source = 'src2'", ("lang", "en"): "lang = 'en'", ("lang", "fr"): "lang = 'fr'", ("length", "long"): "n_chars > 2000", ("length", "short"): "n_chars < 300"}
_ONE_LINE = "trim(regexp_replace(strip_accents(lower({})), '\\s+', ' ', 'g'))"
_B = "[x for x in [" + ", ".join(f"CASE WHEN regexp_matches({_ONE_LINE.format('text')}, '{p}') THEN '{n}' END" for n, p in _BASES.items()) + "] if x IS NOT NULL]"
_D = "[x for x in [" + ", ".join(f"CASE WHEN {c} THEN {{'category': '{k}', 'discriminant': '{n}'}} END" for (k, n), c in _DISCS.items()) + "] if x IS NOT NULL]"


@query(f"SELECT base, d.category AS category, d.discriminant AS discriminant, count(*) AS n FROM (SELECT base, unnest(ds) AS d FROM (SELECT unnest(bs) AS base, ds FROM (SELECT {_B} AS bs, {_D} AS ds FROM documents))) GROUP BY ALL HAVING count(*) >= 8")
def compound_predicates(spark, sf):
    bases = {n: golden.content([F.col("text")], p) for n, p in _BASES.items()}
    return golden.compound_counts(_Tables(spark, sf).documents, bases, {k: F.expr(c) for k, c in _DISCS.items()})


@query(rf"SELECT doc_id FROM documents WHERE regexp_matches(trim(regexp_replace({_FOLDED.format("concat_ws(' ', source, text)")}, '\s+', ' ', 'g')), 'src1.* .*the (st|wh)')")
def content_predicate(spark, sf):
    return _Tables(spark, sf).documents.filter(golden.content([F.col("source"), F.col("text")], "src1.* .*the (st|wh)")).select("doc_id")


@query("SELECT p_partkey FROM part WHERE contains(p_name, 'ring') OR contains(p_name, 'red') OR contains(p_type, 'ring') OR contains(p_type, 'red')")
def term_containment(spark, sf):
    return _Tables(spark, sf).part.filter(text.any_contains([F.col("p_name"), F.col("p_type")], ["ring", "red"])).select("p_partkey")


@query("SELECT doc_id FROM documents WHERE length(coalesce(text, '') || coalesce(source, '')) BETWEEN 100 AND 149")
def context_length_range(spark, sf):
    return _Tables(spark, sf).documents.filter(text.joined_length([F.col("text"), F.col("source")]).between(100, 149)).select("doc_id")


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 25 OFFSET 10")
def limit_offset(spark, sf):
    """The offset and the limit are the feature; they follow a stated order."""
    return _Tables(spark, sf).orders.orderBy("o_orderdate", "o_orderkey").offset(10).limit(25).select("o_orderkey", "o_totalprice")


_KEYWORDS = {"ring": "Ring", "bolt": "Bolt", "gear": "Gear"}
_QUESTION = "p_name || ' en ' || (1995 + p_partkey % 40) || ' au poste ' || chr((97 + p_partkey % 26)::INTEGER) || (p_partkey % 200)"
_FILTERS = rf"""f AS (SELECT q, p_partkey AS query_id, [{{'field': 'year', 'value': y}} for y in regexp_extract_all(q, '\b(20[0-2][0-9])\b', 1)] || [x for x in [{', '.join(f"CASE WHEN contains(q, '{w}') THEN {{'field': 'kind', 'value': '{v}'}} END" for w, v in _KEYWORDS.items())}] if x IS NOT NULL]
    || [{{'field': 'stand', 'value': upper(s)}} for s in regexp_extract_all(q, 'poste ([a-z][0-9]{{1,3}})', 1)] AS fs FROM (SELECT p_partkey, lower({_QUESTION}) AS q FROM part))"""


def _questions(spark, sf):
    k = F.col("p_partkey")
    q = F.concat("p_name", F.lit(" en "), (1995 + k % 40).cast("string"), F.lit(" au poste "), F.char((97 + k % 26).cast("int")), (k % 200).cast("string"))
    return _Tables(spark, sf).part.select(k.alias("query_id"), q.alias("question"))


@query(f"WITH {_FILTERS} SELECT query_id, array_to_string([x.field || '=' || x.value for x in fs], ' ') AS filters FROM f")
def question_constraints(spark, sf):
    q = _questions(spark, sf)
    return q.select("query_id", F.array_join(F.transform(golden.question_filters(F.col("question"), _KEYWORDS), lambda x: F.concat(x["field"], F.lit("="), x["value"])), " ").alias("filters"))


_MEMBERS = "m AS (SELECT 'label' AS field, (label // 2)::VARCHAR AS value, vec_id AS id FROM embeddings UNION ALL SELECT 'label', 'own ' || label, vec_id FROM embeddings UNION ALL SELECT 'third', (vec_id % 3)::VARCHAR, vec_id FROM embeddings)"


def _members(spark, sf):
    e = _Tables(spark, sf).embeddings
    pair = [F.struct(F.lit("label").alias("field"), F.expr("cast(label div 2 as string)").alias("value")), F.struct(F.lit("label").alias("field"), F.concat(F.lit("own "), F.col("label").cast("string")).alias("value")), F.struct(F.lit("third").alias("field"), (F.col("vec_id") % 3).cast("string").alias("value"))]
    return e.select(F.col("vec_id").alias("id"), F.inline(F.array(*pair))).select("field", "value", "id")


@query(f"""WITH {_MEMBERS}, q AS (SELECT vec_id AS query_id, label FROM embeddings WHERE vec_id % 100 = 0), g AS (SELECT query_id, vec_id AS id FROM q JOIN embeddings USING (label)),
    f AS (SELECT query_id, unnest([{{'field': 'label', 'value': (label // 2)::VARCHAR}}, {{'field': 'label', 'value': 'own ' || label}}, {{'field': 'third', 'value': (query_id % 3)::VARCHAR}}, {{'field': 'third', 'value': 'none'}}], recursive := true) FROM q),
    c AS (SELECT query_id, f.field, f.value, (SELECT count(*) FROM g WHERE g.query_id = f.query_id) AS golden, (SELECT count(*) FROM m WHERE m.field = f.field AND m.value = f.value) AS space,
    (SELECT count(*) FROM m JOIN g USING (id) WHERE g.query_id = f.query_id AND m.field = f.field AND m.value = f.value) AS hits FROM f)
    SELECT query_id, field, value, golden, space, CASE WHEN hits < golden THEN 'incomplete' WHEN space = golden THEN 'equal' ELSE 'kept' END AS verdict FROM c""")
def filter_admissibility(spark, sf):
    e = _Tables(spark, sf).embeddings
    q = e.filter("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"), "label")
    asked = q.select("query_id", F.inline(F.array(*[F.struct(F.lit(f).alias("field"), v.alias("value")) for f, v in (("label", F.expr("cast(label div 2 as string)")), ("label", F.concat(F.lit("own "), F.col("label").cast("string"))), ("third", (F.col("query_id") % 3).cast("string")), ("third", F.lit("none")))])))
    return golden.filter_verdicts(asked, _members(spark, sf), q.join(e.select(F.col("vec_id").alias("id"), "label"), "label").select("query_id", "id"))


_GAIN = f"""WITH {_SCORED}, a AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, id) AS rank FROM s), b AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, id) AS rank FROM s WHERE owner // 2 = wanted // 2),
    p AS (SELECT query_id, sum((owner = wanted)::INTEGER) FILTER (rank <= 10) / 10 AS x FROM a GROUP BY 1), r AS (SELECT query_id, coalesce(sum((owner = wanted)::INTEGER) FILTER (rank <= 10), 0) / 10 AS x FROM b GROUP BY 1)"""


@query(f"{_GAIN} SELECT query_id, round(p.x, 9) AS without, round(r.x, 9) AS with_filter, round(r.x - p.x, 9) AS gain FROM p JOIN r USING (query_id)")
def filter_then_rank_gain(spark, sf):
    q, corpus = _sides(spark, sf)
    near = vector_blocks.top_rows(q.withColumn("half", F.expr("wanted div 2")), corpus.withColumn("half", F.expr("owner div 2")), 10, within="half")
    return evaluation.filter_gain(vector_blocks.top_rows(q, corpus, 10), near, 10)


_PROPOSED = """p AS (SELECT o_orderkey AS probe, ['en', 'fr', 'de'][o_orderkey % 3 + 1:o_orderkey % 3 + 2] AS expected, l_orderkey AS source, CASE WHEN l_returnflag = 'R' THEN 'hot' ELSE 'planned' END AS kind, [['en'], ['fr', 'es'], ['de']][l_linenumber % 3 + 1] AS themes, [l_orderkey, l_orderkey + l_linenumber] AS sources
    FROM orders JOIN lineitem ON o_orderkey // 3 = l_orderkey // 3)"""


def _proposed(spark, sf):
    t = _Tables(spark, sf)
    o = t.orders.select(F.col("o_orderkey").alias("probe"), F.expr("o_orderkey div 3").alias("g"))
    line = t.lineitem.select(F.expr("l_orderkey div 3").alias("g"), "l_orderkey", "l_linenumber", F.when(F.col("l_returnflag") == "R", "hot").otherwise("planned").alias("kind"))
    j = o.join(line, "g")
    themes = F.element_at(F.array(F.array(F.lit("en")), F.array(F.lit("fr"), F.lit("es")), F.array(F.lit("de"))), (F.col("l_linenumber") % 3 + 1).cast("int"))
    expected = F.slice(F.array(F.lit("en"), F.lit("fr"), F.lit("de")), (F.col("probe") % 3 + 1).cast("int"), 2)
    return j.select("probe", expected.alias("expected"), "kind", themes.alias("themes"), F.array(F.col("l_orderkey"), F.col("l_orderkey") + F.col("l_linenumber")).alias("sources"))


@query(f"WITH {_PROPOSED} SELECT probe, count(*) AS n FROM p WHERE NOT list_contains(sources, probe) GROUP BY 1")
def leave_one_out(spark, sf):
    return golden.leave_one_out(_proposed(spark, sf), "probe", "sources").groupBy("probe").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {_PROPOSED}, k AS (SELECT * FROM p WHERE NOT list_contains(sources, probe)) SELECT probe, bool_or(len(list_intersect(expected, themes)) > 0) AS agrees, coalesce(bool_or(len(list_intersect(expected, themes)) > 0) FILTER (kind <> 'hot'), false) AS agrees_structured FROM k GROUP BY 1")
def theme_agreement(spark, sf):
    return golden.theme_agreement(golden.leave_one_out(_proposed(spark, sf), "probe", "sources"), "probe", "expected", "themes", "kind", "hot")


_RECORDS = """rec AS (SELECT o_orderkey AS id, o_orderpriority AS kind, CASE WHEN o_custkey % 4 > 0 THEN repeat('x', (o_custkey % 37)::INTEGER) END AS imm, coalesce((SELECT list(l_partkey) FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R'), []) AS st, o_custkey % 5 < 2 AS cause, o_custkey FROM orders)"""


def _records(spark, sf):
    t = _Tables(spark, sf)
    st = t.lineitem.filter("l_returnflag = 'R'").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.collect_list("l_partkey").alias("st"))
    c = F.col("o_custkey")
    return t.orders.join(st, "o_orderkey", "left").select(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("kind"), F.when(c % 4 > 0, F.repeat(F.lit("x"), (c % 37).cast("int"))).alias("imm"), F.coalesce("st", F.array().cast("array<bigint>")).alias("st"), (c % 5 < 2).alias("cause"), "o_custkey")


@query(f"WITH {_RECORDS}, r AS (SELECT kind, id, row_number() OVER (PARTITION BY kind ORDER BY len(st) * 100 + coalesce(length(imm), 0) DESC, id)::INTEGER AS place FROM rec WHERE len(st) > 0 OR coalesce(length(imm), 0) > 0) SELECT * FROM r WHERE place <= 6")
def precedent_selection(spark, sf):
    return golden.precedents(_records(spark, sf), ["kind"], "id", "imm", "st")


@query(f"""WITH {_RECORDS}, c AS (SELECT *, unnest([x for x in [CASE WHEN starts_with(kind, '1') THEN 'urgent' END, CASE WHEN o_custkey % 7 = 0 THEN 'seventh' END, CASE WHEN o_custkey < 0 THEN 'nobody' END] if x IS NOT NULL]) AS name, [x for x in [CASE WHEN o_custkey % 2 = 0 THEN 'even' END, CASE WHEN o_custkey % 3 = 0 THEN 'third' END] if x IS NOT NULL] AS cats FROM rec),
    i AS (SELECT *, coalesce(length(imm), 0) > 0 AS has_imm FROM c), k AS (SELECT name, string_agg(cat || ':' || n, ' ' ORDER BY n DESC, cat) AS categories FROM (SELECT name, cat, count(*) AS n FROM (SELECT name, unnest(cats) AS cat FROM i) GROUP BY 1, 2) GROUP BY 1),
    e AS (SELECT name, string_agg(id::VARCHAR, ',' ORDER BY id) AS expected_ids FROM (SELECT name, id, row_number() OVER (PARTITION BY name ORDER BY id) AS r FROM i WHERE has_imm) WHERE r <= 200 GROUP BY 1)
    SELECT name, CASE name WHEN 'urgent' THEN 'reco' ELSE 'abstention' END AS mode, count(*) AS comparable, count(*) FILTER (has_imm) AS with_immediate, count(*) FILTER (len(st) > 0) AS with_structured, count(*) FILTER (cause) AS with_cause, round(count(*) FILTER (has_imm) / count(*), 2) AS immediate_rate, round(count(*) FILTER (len(st) > 0) / count(*), 2) AS structured_rate, coalesce(any_value(categories), '') AS categories, any_value(expected_ids) AS expected_ids FROM i LEFT JOIN k USING (name) LEFT JOIN e USING (name) GROUP BY name""")
def golden_generation(spark, sf):
    r = _records(spark, sf)
    c = F.col("o_custkey")
    cases = {"urgent": (F.col("kind").startswith("1"), "reco"), "seventh": (c % 7 == 0, "abstention"), "nobody": (c < 0, "abstention")}
    cats = F.filter(F.array(F.when(c % 2 == 0, F.lit("even")), F.when(c % 3 == 0, F.lit("third"))), lambda x: x.isNotNull())
    g = golden.golden_questions(r, cases, "id", F.coalesce(F.length("imm") > 0, F.lit(False)), F.size("st") > 0, F.col("cause"), cats)
    return g.withColumn("expected_ids", F.array_join(F.transform("expected_ids", lambda x: x.cast("string")), ","))


@query("SELECT item_id, mode, collection FROM benchmark, (VALUES ('search'), ('summary'), ('advice'), ('analysis')) m(mode), (VALUES ('old'), ('rich'), ('hybrid')) c(collection)")
def question_grid(spark, sf):
    return golden.question_grid(_Tables(spark, sf).benchmark.select("item_id"), ["search", "summary", "advice", "analysis"], ["old", "rich", "hybrid"])


@query(f"""WITH {_RECORDS}, g AS (SELECT kind, count(*) AS n_of, count(*) FILTER (cause) AS c, count(*) FILTER (len(st) > 0) AS s, count(*) FILTER (coalesce(length(imm), 0) >= 20) AS d FROM rec GROUP BY 1)
    SELECT kind, unnest([{{'route': 'cause', 'n': c, 'of': n_of, 'announce': c < n_of}}, {{'route': 'action', 'n': s, 'of': n_of, 'announce': s < n_of * 0.5}}, {{'route': 'description', 'n': d, 'of': n_of, 'announce': d < n_of * 0.7}}], recursive := true) FROM g""")
def coverage_ceilings(spark, sf):
    return audit.ceilings(_records(spark, sf), ["kind"], F.when(F.col("cause"), F.lit("said")), F.size("st") > 0, F.col("imm"), 20)


# metrics

_MEASURES = "me AS (SELECT o_orderpriority AS route, o_custkey % 6 AS useful, (o_custkey % 6) / 10 AS precision, o_custkey % 11 = 0 AS abstained FROM orders)"


def _measures(spark, sf):
    c = F.col("o_custkey")
    return _Tables(spark, sf).orders.select(F.col("o_orderpriority").alias("route"), (c % 6).alias("useful"), ((c % 6) / 10).alias("precision"), (c % 11 == 0).alias("abstained"))


@query(f"WITH {_MEASURES} SELECT route, count(*) AS n, round(avg(precision), 9) AS precision, round(avg((useful >= 1)::INTEGER), 9) AS success, quantile_cont(useful, 0.5) AS median_useful, count(*) FILTER (abstained) AS abstentions, count(*) FILTER (useful = 0) AS without, count(*) FILTER (useful >= 3) AS three_or_more FROM me GROUP BY 1")
def success_at_k(spark, sf):
    return evaluation.success_stats(_measures(spark, sf), ["route"])


@query(f"WITH {_MEASURES} SELECT route, useful, count(*) AS questions FROM me GROUP BY 1, 2")
def useful_histogram(spark, sf):
    return evaluation.useful_histogram(_measures(spark, sf), ["route"])


@query(f"{_RANKED}, t AS (SELECT DISTINCT query_id, owner FROM r WHERE rank <= 10), n AS (SELECT label AS owner, count(*) AS n FROM embeddings GROUP BY 1), a AS (SELECT avg(n) AS p FROM n), b AS (SELECT avg(n) AS q FROM t JOIN n USING (owner)) SELECT round(p, 9) AS population, round(q, 9) AS retrieved, round(round(q, 9) / round(p, 9), 9) AS bias FROM a, b".replace("n AS (SELECT query_id, sum(relevant) AS n FROM r GROUP BY 1)", "nn AS (SELECT 1)"))
def multiplicity_bias(spark, sf):
    top = vector_blocks.top_rows(*_sides(spark, sf), 10).select("query_id", "owner").distinct()
    return evaluation.multiplicity(_Tables(spark, sf).embeddings.select(F.col("label").alias("owner")), top, "owner")


@query(f"{_RANKED}, u AS (SELECT query_id, avg((relevant = 0)::INTEGER) AS x, sum(relevant) AS h, count(*) FILTER (relevant = 0) AS m FROM r WHERE rank <= 10 GROUP BY 1) SELECT query_id, round(h / 10 + 0.25 * m / 10, 9) AS corrected FROM u")
def corrected_precision(spark, sf):
    rows, _ = _ranked(spark, sf)
    g = rows.filter("rank <= 10").groupBy("query_id").agg((F.sum("relevant") / 10).alias("p"), F.count_if(F.col("relevant") == 0).alias("u"))
    return g.select("query_id", F.round(evaluation.corrected_precision(F.col("p"), F.lit(0.25), 10, F.col("u")), 9).alias("corrected"))


@query("WITH t AS (SELECT event_type, user_id, event_id FROM events), b AS (SELECT event_type FROM t WHERE event_type IN ('click', 'error', 'nothing') GROUP BY 1 HAVING count(*) >= 5) SELECT CASE WHEN event_type IN ('click', 'error', 'nothing') THEN event_type END AS event_type, CASE WHEN event_type IN ('click', 'error', 'nothing') THEN 'target' ELSE 'distractor' END AS role, least(count(*), CASE WHEN event_type IN ('click', 'error', 'nothing') THEN 40 ELSE 60 END) AS n FROM (SELECT CASE WHEN event_type IN ('click', 'error', 'nothing') THEN event_type ELSE 'other' END AS event_type FROM t) GROUP BY 1, 2, event_type")
def per_type_sample(spark, sf):
    """How many rows each part of the sample has; which ones depends on a hash."""
    s = search.per_type_sample(_Tables(spark, sf).events, "event_id", "event_type", ["click", "error", "nothing"], 40, 60)
    return s.groupBy(F.when(F.col("role") == "target", F.col("event_type")).alias("event_type"), "role").agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH f AS (SELECT doc_id, unnest([{{'k': 'lieu', 'v': [source, '']}}, {{'k': 'motif', 'v': [left(text, 90)]}}, {{'k': 'type_evenement', 'v': ['Éhthe ' || lang]}}, {{'k': 'periode', 'v': [text]}}], recursive := true), text AS answer FROM documents)
    SELECT k AS kind, count(*) AS facts, count(*) FILTER (len([x for x in v if x <> '' AND contains({_FOLDED.format('answer')}, left({_FOLDED.format('x')}, 60))]) > 0) AS present FROM f WHERE k <> 'periode' GROUP BY 1""")
def mechanical_facts(spark, sf):
    d = _Tables(spark, sf).documents
    fact = lambda kind, *values: F.struct(F.lit(kind).alias("kind"), F.array(*values).alias("values"))
    facts = F.array(fact("lieu", F.col("source"), F.lit("")), fact("motif", F.left("text", F.lit(90))), fact("type_evenement", F.concat(F.lit("Éhthe "), "lang")), fact("periode", F.col("text")))
    return audit.mechanical_facts(d.select("doc_id", F.col("text").alias("answer"), F.inline(facts)), "doc_id", "answer")


_OVER = "len([w for w in regexp_extract_all({0}, '[a-z0-9]{{3,}}') if contains(t, w)]) / len(regexp_extract_all({0}, '[a-z0-9]{{3,}}'))"


@query(rf"""WITH d AS (SELECT doc_id, trim(regexp_replace({_FOLDED.format('text')}, '\s+', ' ', 'g')) AS t, trim(regexp_replace({_FOLDED.format("left(text, 60) || ' qqq zzz'")}, '\s+', ' ', 'g')) AS v, trim(regexp_replace({_FOLDED.format("'the ' || lang || ' qqq'")}, '\s+', ' ', 'g')) AS e FROM documents),
    p AS (SELECT doc_id, [{_OVER.format('v')} >= 0.6, {_OVER.format('e')} >= 0.35, contains(t, 'tion') OR contains(t, doc_id::VARCHAR)] AS ok FROM d)
    SELECT doc_id, 3::BIGINT AS expected, len([x for x in ok if x])::BIGINT AS present, round(len([x for x in ok if x]) / 3, 2) AS rate FROM p""")
def fact_coverage(spark, sf):
    d = _Tables(spark, sf).documents
    fact = lambda kind, value, examples: F.struct(F.lit(kind).alias("kind"), value.cast("string").alias("value"), examples.cast("array<string>").alias("examples"))
    none = F.lit(None)
    facts = F.array(
        fact("lieu", F.concat(F.left("text", F.lit(60)), F.lit(" qqq zzz")), none), fact("exemple_cause", none, F.array(F.concat(F.lit("the "), "lang", F.lit(" qqq")))),
        fact(audit.PERIOD, F.concat(F.lit("tion-"), F.col("doc_id").cast("string")), none))
    return audit.fact_coverage(d.select("doc_id", F.col("text").alias("answer"), F.inline(facts)), "doc_id", "answer")


@query(rf"""WITH d AS (SELECT doc_id, text, n_chars % 50 AS n, n_chars % 900 AS m, {_FOLDED.format('text')} AS t FROM documents)
    SELECT doc_id, len([x for x in regexp_extract_all(regexp_replace(text, '[^0-9A-Za-z_]+', '  ', 'g'), '(?:^| )([0-9]{{1,5}})(?: |$)', 1) if x IN (n::VARCHAR, m::VARCHAR)]) > 0 AS ceiling_announced, contains(t, 'tionen') OR contains(t, 'keitab') OR contains(t, 'thethe') AS category_named, regexp_matches(text, '(?i)thand') AS claims_efficacy, regexp_matches(text, '(?i)tion') AND regexp_matches(text, '(?i)ment') AS fact_and_suggestion FROM d""")
def recommendation_controls(spark, sf):
    d = _Tables(spark, sf).documents
    r = audit.recommendation(F.col("text"), F.col("n_chars") % 50, F.col("n_chars") % 900, F.array(F.lit("Tionen / x"), F.lit("keitab thethe")), "thand", "tion", "ment")
    return d.select("doc_id", *[c.alias(n) for n, c in r.items()])


@query("SELECT doc_id, e[1] = f[1] AS first_right, list_sort(e[1:3]) = list_sort(f[1:3]) AS top_right FROM (SELECT doc_id, [lang, source, (doc_id % 2)::VARCHAR] AS e, CASE doc_id % 3 WHEN 0 THEN [source, lang, (doc_id % 2)::VARCHAR] WHEN 1 THEN [lang, 'x', source] ELSE [lang, source, (doc_id % 2)::VARCHAR] END AS f FROM documents)")
def ranking_matches(spark, sf):
    i = F.col("doc_id") % 3
    e = F.array(F.col("lang"), F.col("source"), (F.col("doc_id") % 2).cast("string"))
    f = F.when(i == 0, F.array(e[1], e[0], e[2])).when(i == 1, F.array(F.col("lang"), F.lit("x"), F.col("source"))).otherwise(e)
    first, top = audit.ranking_matches(e, f)
    return _Tables(spark, sf).documents.select("doc_id", first.alias("first_right"), top.alias("top_right"))


@query("SELECT o_orderkey, CASE WHEN least(10, o_custkey % 7, o_orderkey % 5) > 0 THEN round(least(o_custkey % 3, 10) / least(10, o_custkey % 7, o_orderkey % 5), 9) ELSE 0 END AS rate FROM orders")
def example_rate(spark, sf):
    return _Tables(spark, sf).orders.select("o_orderkey", F.round(audit.example_rate(F.col("o_custkey") % 3, 10, F.col("o_custkey") % 7, F.col("o_orderkey") % 5), 9).alias("rate"))


# profiles

@query("SELECT 'o_orderdate' AS \"column\", count(o_orderdate) AS filled, round(count(o_orderdate) / count(*), 9) AS rate, strftime(min(o_orderdate), '%Y-%m-%d') AS first, strftime(max(o_orderdate), '%Y-%m-%d') AS last FROM orders UNION ALL SELECT 'late', count(*) FILTER (o_custkey % 2 = 0), round(avg((o_custkey % 2 = 0)::INTEGER), 9), strftime(min(o_orderdate) FILTER (o_custkey % 2 = 0), '%Y-%m-%d'), strftime(max(o_orderdate) FILTER (o_custkey % 2 = 0), '%Y-%m-%d') FROM orders UNION ALL SELECT 'never', 0, 0, NULL, NULL")
def date_ranges(spark, sf):
    o = _Tables(spark, sf).orders.select("o_orderdate", F.when(F.col("o_custkey") % 2 == 0, F.col("o_orderdate")).alias("late"), F.lit(None).cast("timestamp").alias("never"))
    return profile.date_ranges(o, ["o_orderdate", "late", "never"])


@query("SELECT 'dear' AS \"column\", count(*) FILTER (o_totalprice > 50000) AS n_true, count(*) FILTER (NOT o_totalprice > 50000) AS n_false, count(*) FILTER (o_totalprice IS NULL) AS n_null FROM orders UNION ALL SELECT 'said', count(*) FILTER (x), count(*) FILTER (NOT x), count(*) FILTER (x IS NULL) FROM (SELECT CASE o_custkey % 3 WHEN 0 THEN true WHEN 1 THEN false END AS x FROM orders)")
def boolean_counts(spark, sf):
    c = F.col("o_custkey") % 3
    return profile.boolean_counts(_Tables(spark, sf).orders, {"dear": F.col("o_totalprice") > 50000, "said": F.when(c == 0, True).when(c == 1, False)})


@query("SELECT source, lang, count(*) AS n, grouping_id(source, lang)::INTEGER AS level FROM (SELECT CASE WHEN doc_id % 10 = 0 THEN 'unknown' ELSE source END AS source, lang FROM documents) GROUP BY ROLLUP (source, lang)")
def chunk_counts(spark, sf):
    d = _Tables(spark, sf).documents.select(F.when(F.col("doc_id") % 10 != 0, F.col("source")).alias("source"), "lang")
    return profile.chunk_counts(d, "source", "lang")


@query("SELECT event_type, count(DISTINCT user_id) AS files, count(*) AS occurrences, min(n) AS least, max(n) AS most, round(avg(n), 6) AS mean, list_sort(list(n))[len(list(n)) // 2 + 1] AS median FROM (SELECT *, length(props) + event_id % 13 AS n FROM events) GROUP BY 1")
def label_audit(spark, sf):
    return profile.label_audit(_Tables(spark, sf).events, "user_id", "event_type", F.length("props") + F.col("event_id") % 13)


_PIPED = "p AS (SELECT p_type || '|' || p_brand || '| ' AS a, CASE WHEN p_size > 10 THEN p_type END AS b, 'same' AS c, ' ' AS d FROM part)"


@query(f"""WITH {_PIPED}, v AS (SELECT k AS "column", trim(unnest(string_split(v, '|'))) AS v FROM p UNPIVOT (v FOR k IN (a, b, c, d))), n AS (SELECT "column", v, count(*) AS n FROM v WHERE v <> '' GROUP BY ALL), q AS (SELECT *, n / sum(n) OVER (PARTITION BY "column") AS p FROM n),
    e AS (SELECT "column", count(*) AS classes, round(CASE WHEN count(*) > 1 THEN -sum(p * ln(p)) / ln(count(*)) ELSE 0 END, 6) AS entropy FROM q GROUP BY 1) SELECT x AS "column", coalesce(classes, 0) AS classes, coalesce(entropy, 0) AS entropy, coalesce(entropy, 0) > 0.5 AS kept FROM (VALUES ('a'), ('b'), ('c'), ('d')) t(x) LEFT JOIN e ON x = "column" """)
def multi_valued_entropy(spark, sf):
    p = _Tables(spark, sf).part.select(F.concat("p_type", F.lit("|"), "p_brand", F.lit("| ")).alias("a"), F.when(F.col("p_size") > 10, F.col("p_type")).alias("b"), F.lit("same").alias("c"), F.lit(" ").alias("d"))
    return profile.multi_entropy(p, ["a", "b", "c", "d"])


# places and scalars

_PLACES = "['36L', '17L/35R', '18R 36R', 'C83', '99L', '36L - man', '35L'][o_custkey % 7 + 1]"


@query("SELECT former, n FROM (SELECT '36L' AS former, count(*) FILTER (o_custkey % 7 IN (0, 5)) AS n FROM orders UNION ALL SELECT '18R', count(*) FILTER (o_custkey % 7 = 2) FROM orders UNION ALL SELECT '36R', count(*) FILTER (o_custkey % 7 = 2) FROM orders) WHERE n > 0")
def renamed_runways(spark, sf):
    p = F.element_at(F.array(*[F.lit(x) for x in ("36L", "17L/35R", "18R 36R", "C83", "99L", "36L - man", "35L")]), (F.col("o_custkey") % 7 + 1).cast("int"))
    return places.renamed_counts(_Tables(spark, sf).orders.select(places.normalise(p, F.lit(places.SITES[0].label)).alias("p")), "p")


@query("SELECT p_partkey, ['35L', '17L,35R', '35R', '16,34', '34', '', '17L,17R'][p_partkey % 7 + 1] AS runways FROM part")
def runways_in_questions(spark, sf):
    q = F.element_at(F.array(*[F.lit(x) for x in ("Incidents sur la 36L ?", "la piste 17L/35R", "36 R ou 99L", "axe 16 / 34", "pistes 34 et 12", "que s'est-il passé ?", "018L, 18R")]), (F.col("p_partkey") % 7 + 1).cast("int"))
    return _Tables(spark, sf).part.select("p_partkey", F.array_join(places.runways_asked(q), ",").alias("runways"))


@query(r"SELECT c_custkey, lower(trim(c_name)) AS person, regexp_replace(c_name || repeat('? ', (c_custkey % 3)::INTEGER), '[\s?]+$', '') AS client FROM customer")
def name_forms(spark, sf):
    noisy = F.concat("c_name", F.repeat(F.lit("? "), (F.col("c_custkey") % 3).cast("int")))
    return _Tables(spark, sf).customer.select("c_custkey", text.person_key(F.concat(F.lit(" "), "c_name", F.lit("\t"))).alias("person"), text.trailing_noise(noisy).alias("client"))


@query("SELECT o_orderkey, array_to_string([x for x in [o_custkey, CASE WHEN o_custkey % 2 = 0 THEN o_orderkey END] if x IS NOT NULL], ',') AS numbers, array_to_string(list_sort(['F — ' || o_orderstatus, 'P — ' || o_orderpriority]), ';') AS meanings, array_to_string([o_orderstatus, 'x', o_orderpriority], ',') AS titles, o_orderstatus = 'F' OR o_orderpriority = '1-URGENT' AS overlaps FROM orders")
def list_forms(spark, sf):
    """Lists of whole numbers, code and meaning of map entries, the union of three lists, and overlap of label sets."""
    o = F.col("o_orderstatus")
    items = F.array(F.col("o_custkey").cast("string"), F.lit("x1"), F.when(F.col("o_custkey") % 2 == 0, F.concat(F.lit(" "), F.col("o_orderkey").cast("string"))), F.lit(""))
    union = F.array_distinct(F.concat(F.array(o), F.array(F.lit("x"), o), F.array(F.col("o_orderpriority"))))
    meanings = scalars.code_meanings(F.create_map(F.lit("F"), o, F.lit("P"), F.col("o_orderpriority")))
    return _Tables(spark, sf).orders.select("o_orderkey", F.array_join(F.transform(scalars.whole_numbers(items), lambda x: x.cast("string")), ",").alias("numbers"), F.array_join(meanings, ";").alias("meanings"), F.array_join(union, ",").alias("titles"), F.arrays_overlap(F.array(o, F.col("o_orderpriority")), F.array(F.lit("F"), F.lit("1-URGENT"))).alias("overlaps"))


# tickets, graph, documents

_TICKET = """tk AS (SELECT o_orderkey, nullif(trim(CASE WHEN o_orderkey % 50 = 0 THEN ' ' ELSE 'T' || o_orderkey END), '') AS numero_fe, repeat('ab<br>', (o_orderkey % 30)::INTEGER) AS resume, repeat('<b>cause</b> ', (o_orderkey % 700)::INTEGER) AS cause, [CASE WHEN o_orderkey % 2 = 0 THEN '' ELSE 'v' || o_orderkey END, NULL, repeat('9', (o_orderkey % 250)::INTEGER)] AS versions, ['17', 'jdoe', ''][o_orderkey % 3 + 1] AS login FROM orders)"""


@query(rf"""WITH {_TICKET}, x AS (SELECT *, CASE WHEN o_orderkey % 30 = 0 THEN '' ELSE rtrim(repeat('ab' || E'\n', (o_orderkey % 30)::INTEGER), E'\n') END AS r, trim(repeat('cause ', (o_orderkey % 700)::INTEGER)) AS c FROM tk)
    SELECT numero_fe, CASE WHEN length(r) >= 50 THEN r END AS resume_natif, CASE WHEN length(c) >= 50 THEN left(c, 4000) END AS cause_nc, nullif(left(array_to_string([v for v in versions if v IS NOT NULL AND v <> ''], ', '), 200), '') AS version_effective, CASE WHEN login = 'jdoe' THEN login END AS resp_traitement_login, (o_orderkey % 9)::INTEGER AS etape, nullif('P' || o_orderkey % 4, 'P3') AS projet_id FROM x WHERE numero_fe IS NOT NULL""")
def wide_ticket_projection(spark, sf):
    k = F.col("o_orderkey")
    rep = lambda s, n: F.repeat(F.lit(s), (k % n).cast("int"))
    orders = _Tables(spark, sf).orders.select("o_orderkey")
    # a few MB of keys become GBs of text, so they are dealt out by rows
    raw = orders.repartition(orders.count() // 10_000 + 1).select(
        F.when(k % 50 == 0, F.lit(" ")).otherwise(F.concat(F.lit("T"), k.cast("string"))).alias("numero_fe"), F.lit("t").alias("titre_nc"), F.lit("d").alias("detail_nc"), rep("ab<br>", 30).alias("resume"), rep("<b>cause</b> ", 700).alias("cause_nc"),
        F.array(F.when(k % 2 == 0, F.lit("")).otherwise(F.concat(F.lit("v"), k.cast("string"))), F.lit(None).cast("string"), rep("9", 250)).alias("versioneffective"), F.element_at(F.array(F.lit("17"), F.lit("jdoe"), F.lit("")), (k % 3 + 1).cast("int")).alias("resp_traitement_nc"),
        (k % 9).cast("string").alias("etape"), F.struct(F.when(k % 4 != 3, F.concat(F.lit(" P"), (k % 4).cast("string"))).otherwise(F.lit("")).alias("_id")).alias("projet_ticket"))
    return tickets.wide_tickets(raw, copied=(("etape", "etape", "int"), ("projet_id", "projet_ticket._id", "string"))).drop("titre", "detail")


@query("SELECT DISTINCT o_orderkey AS key, p_partkey AS target FROM orders JOIN part ON trim(p_name) = ['red widget', 'small ring', ' ', 'blue bolt'][o_orderkey % 4 + 1] AND o_orderkey % 4 <> 2")
def ticket_project_links(spark, sf):
    t = _Tables(spark, sf)
    title = F.element_at(F.array(F.lit(" red widget"), F.lit("small ring "), F.lit(" "), F.lit("blue bolt")), (F.col("o_orderkey") % 4 + 1).cast("int"))
    return graph.title_links(t.orders.select("o_orderkey", title.alias("title")), "o_orderkey", "title", t.part.select("p_partkey", "p_name"), "p_partkey", "p_name")


@query("SELECT DISTINCT 'P' || p_partkey AS src, 'IS_A' AS rel, 'Type:' || trim(v) AS dst FROM (SELECT p_partkey, unnest(string_split(p_type || '|' || p_name || '| |' || p_type, '|')) AS v FROM part) WHERE trim(v) <> ''")
def projected_entity_edges(spark, sf):
    module = schema.Module("part", "k", (schema.Field("k", "k", required=True), schema.Field("t", "types", role="relation", node="Type", node_key="name", relation="IS_A")))
    p = _Tables(spark, sf).part.select(F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("k"), F.concat_ws("|", "p_type", "p_name", F.lit(" "), "p_type").alias("types"))
    return graph.entity_edges(schema.project(p, module), "k")


_SHEETS = "sh AS (SELECT o_orderkey, 'Fiche ' || o_orderkey AS identity, nullif(CASE WHEN o_orderkey % 3 > 0 THEN o_orderpriority || ' | ' || o_orderstatus ELSE '' END, '') AS meta, CASE WHEN o_orderkey % 2 = 0 THEN 'Facteurs : Milieu' END AS fact, CASE WHEN o_orderkey % 5 > 0 THEN 'Description : ' || repeat('mot ', (o_orderkey % 40)::INTEGER) || 'fin' END AS story, CASE WHEN o_orderkey % 4 = 0 THEN 'Causes : Milieu — bruit' END AS causes, nullif(concat_ws(E'\\n', CASE WHEN o_orderkey % 6 = 0 THEN 'Action immédiate : bag' END, CASE WHEN o_orderkey % 7 = 0 THEN 'Actions engagées : a ; b' END), '') AS actions FROM orders)"


def _sheets(spark, sf):
    k = F.col("o_orderkey")
    lines = F.when(k % 5 > 0, F.concat(F.repeat(F.lit("mot "), (k % 40).cast("int")), F.lit("fin")))
    return _Tables(spark, sf).orders.select(
        k, F.concat(F.lit("Fiche "), k.cast("string")).alias("identity"), F.when(k % 3 > 0, F.concat("o_orderpriority", F.lit(" | "), "o_orderstatus")).alias("meta"), F.when(k % 2 == 0, F.lit("Facteurs : Milieu")).alias("fact"), documents.labelled("Description", lines).alias("story"),
        documents.causes_text({"Milieu": F.when(k % 4 == 0, F.lit("bruit")), "Méthode": F.lit(None).cast("string")}).alias("causes"), documents.actions_text(F.when(k % 6 == 0, F.lit("bag")), F.when(k % 7 == 0, F.array(F.lit("a"), F.lit("b"))).otherwise(F.array().cast("array<string>"))).alias("actions"))


#: Three lines of a record's story, long enough that records overflow in each of the possible ways.
_LINES = ("'Description : ' || repeat('mot ', (o_orderkey % 40 * 5)::INTEGER) || 'fin'", "'Suite : ' || repeat('abc ', (o_orderkey % 23 * 14)::INTEGER) || 'fin'", "'Reste : ' || repeat('z ', (o_orderkey % 31 * 20)::INTEGER) || 'fin'")


@query(f"""WITH {_SHEETS}, l AS (SELECT *, {', '.join(f'{x} AS l{n}' for n, x in enumerate(_LINES, 1))} FROM sh), w AS (SELECT *, concat_ws(E'\\n', identity, meta, fact) AS head, coalesce(meta, identity) AS prefix, concat_ws(E'\\n', l1, l2, l3) AS body FROM l),
    m AS (SELECT *, 1800 - length(prefix) - 1 AS room, length(head) + 1 + length(body) AS whole FROM w),
    s AS (SELECT *, CASE WHEN whole <= 1800 THEN [body] WHEN length(body) <= room THEN [body] WHEN length(l1) + 1 + length(l2) <= room THEN [l1 || E'\\n' || l2, l3] WHEN length(l2) + 1 + length(l3) <= room THEN [l1, l2 || E'\\n' || l3] ELSE [l1, l2, l3] END AS parts FROM m),
    c AS (SELECT o_orderkey, [{{'kind': CASE WHEN i = 1 THEN 'sheet' ELSE 'long narrative' END, 'text': CASE WHEN i = 1 THEN head ELSE prefix END || E'\\n' || parts[i]}} for i in range(1, len(parts) + 1)] || [x for x in [CASE WHEN causes IS NOT NULL THEN {{'kind': 'cause', 'text': causes}} END, CASE WHEN actions IS NOT NULL THEN {{'kind': 'action', 'text': actions}} END] if x IS NOT NULL] AS l FROM s)
    SELECT o_orderkey, (generate_subscripts(l, 1) - 1)::INTEGER AS chunk, unnest(l, recursive := true) FROM c""")
def record_chunks(spark, sf):
    c = [F.col(x) for x in ("identity", "meta", "fact")]
    lines = F.array(*[F.expr(x.replace("::INTEGER", "").replace("(o_orderkey", "int(o_orderkey")) for x in _LINES])
    return documents.chunks(_sheets(spark, sf), "o_orderkey", *c, lines, F.col("causes"), F.col("actions"), floor=30)


@query(f"WITH {_SHEETS} SELECT o_orderkey, concat_ws(E'\\n', identity, meta, fact, story) AS document FROM sh")
def situation_document(spark, sf):
    return _sheets(spark, sf).select("o_orderkey", documents.situation(F.col("identity"), [F.col("meta")], F.col("fact"), [F.col("story")]).alias("document"))


@query(f"""WITH {_SHEETS}, j AS (SELECT sh.*, o_orderstatus, o_orderpriority FROM sh JOIN orders USING (o_orderkey)) SELECT o_orderkey, coalesce(story, '') AS "A", concat_ws(E'\\n', 'status: ' || o_orderstatus, story) AS "B", concat_ws(E'\\n', o_orderstatus, story) AS "C", concat_ws(E'\\n', concat_ws(' | ', o_orderstatus, o_orderpriority), story) AS "D", concat_ws(E'\\n', concat_ws(' | ', o_orderstatus, o_orderpriority), story, fact) AS "E" FROM j""")
def text_variants(spark, sf):
    s = _sheets(spark, sf).join(_Tables(spark, sf).orders.select("o_orderkey", "o_orderstatus", "o_orderpriority"), "o_orderkey")
    v = documents.text_variants(F.col("story"), [("status", F.col("o_orderstatus"))], [("status", F.col("o_orderstatus")), ("priority", F.col("o_orderpriority"))], F.col("fact"))
    return s.select("o_orderkey", *[c.alias(n) for n, c in v.items()])


@query(f"WITH {_SHEETS} SELECT o_orderkey, 'story' AS field, story AS text FROM sh WHERE length(story) >= 40 UNION ALL SELECT o_orderkey, 'fact', fact FROM sh WHERE fact IS NOT NULL AND lower(fact) <> 'ras'")
def field_chunks(spark, sf):
    return documents.field_chunks(_sheets(spark, sf), "o_orderkey", [("story", F.col("story"), 40), ("fact", F.col("fact"), 5), ("none", F.lit("RAS"), 1)], gated=("fact", "none"), empty=("ras", "0"))


# forms that need a rule of their own

@query("SELECT p_partkey, ['tres_urgent', 'urgent', 'normal', 'normal', 'normal'][p_partkey % 5 + 1] AS level FROM part")
def enum_prefixes(spark, sf):
    c = F.element_at(F.array(*[F.lit(x) for x in (" Très urgent", "URGENT - jour J", "", "rien", None)]), (F.col("p_partkey") % 5 + 1).cast("int"))
    return _Tables(spark, sf).part.select("p_partkey", scalars.enum_by_prefix(c, ["urgent", "tres_urgent"], "normal").alias("level"))


@query(f"WITH t AS (SELECT doc_id, left({_STRIP.format('lang')}, 300) AS s, repeat('suivi ', (doc_id % 200)::INTEGER) AS f, text AS d FROM documents), u AS (SELECT *, left(f, greatest(0, floor((500 - length(s)) * 0.55)::INTEGER)) AS ff FROM t) SELECT doc_id, s AS summary, ff AS follow_up, left(d, greatest(0, 500 - length(s) - length(ff))) AS detail FROM u")
def prompt_budgets(spark, sf):
    s, f, d = text.prompt_parts(F.col("lang"), F.repeat(F.lit("suivi "), (F.col("doc_id") % 200).cast("int")), F.col("text"), 500)
    return _Tables(spark, sf).documents.select("doc_id", s.alias("summary"), f.alias("follow_up"), d.alias("detail"))


@query("""WITH m AS (SELECT o_orderkey AS q, 'tool' AS system, o_orderpriority AS route, o_custkey % 12 AS returned, least(o_custkey % 12, o_custkey % 5) AS useful, 10 AS k FROM orders UNION ALL SELECT o_orderkey, 'product', o_orderpriority, o_custkey % 11, least(o_custkey % 11, o_custkey % 7), 10 FROM orders WHERE o_orderkey % 3 > 0)
    SELECT route, system, count(*) AS n, round(avg(useful / k), 9) AS precision, round(avg((useful > 0)::INTEGER), 9) AS success, quantile_cont(useful, 0.5) AS median_useful, sum(returned)::BIGINT AS returned, sum(useful)::BIGINT AS useful, count(*) FILTER (returned = 0) AS abstentions FROM m WHERE q % 3 > 0 GROUP BY 1, 2""")
def system_comparison(spark, sf):
    o, c = _Tables(spark, sf).orders, F.col("o_custkey")
    run = lambda d, name, a, b: d.select(F.col("o_orderkey").alias("q"), F.lit(name).alias("system"), F.col("o_orderpriority").alias("route"), (c % a).alias("returned"), F.least(c % a, c % b).alias("useful"), F.lit(10).alias("k"))
    return evaluation.compare_systems(run(o, "tool", 12, 5).unionByName(run(o.filter("o_orderkey % 3 > 0"), "product", 11, 7)), "q", "system", ["route"])
