"""Registered queries over raw files, which are written to the shared folder first, and over the forms of raw fields."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import domain, scalars, text
from ..operators import documents, graph, html, profile
from ..plans import schema
from ..sources import readers, sinks
from ..streaming import incremental
from .catalogue import _Tables, query


def _folder(spark, label: str) -> str:
    return f"{sinks.shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def _pick(values, index):
    """One of the texts by a row's number, so that every row has an input of known outcome."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index % len(values) + 1).cast("int"))


# raw files

@query(r"""SELECT o_orderkey AS id, o_orderpriority AS title, 'C:\dir \u12 "' || o_orderkey || '" \\d' AS note FROM orders""")
def json_envelopes(spark, sf):
    """Files of 500 records each, half of them envelopes, half lists, with lone, doubled and cut-off backslashes."""
    k = F.col("o_orderkey")
    record = F.concat(F.lit('{"id": '), k.cast("string"), F.lit(', "title": "'), F.col("o_orderpriority"), F.lit('", "note": "C:\\dir \\u12 \\"'), k.cast("string"), F.lit('\\" \\\\\\\\d"}'))
    files = _Tables(spark, sf).orders.select(F.expr("o_orderkey div 500").alias("g"), record.alias("r")).groupBy("g").agg(F.array_join(F.collect_list("r"), ", ").alias("r"))
    whole = F.when(F.col("g") % 2 == 0, F.concat(F.lit('{"_embedded": {"module": ['), "r", F.lit(', "no record"]}}'))).otherwise(F.concat(F.lit("["), "r", F.lit(", 7]")))
    path = _folder(spark, "json")
    files.select("g", whole.alias("value")).write.partitionBy("g").text(path)
    return readers.typed_json(spark, f"{path}/*/*.txt", "id long, title string, note string")


def _write_csv(df, path, header: str, encoding: str) -> None:
    """Lines under a header as it stands, repeated names included."""
    df.select(F.concat_ws(";", *df.columns).alias(header)).write.option("header", True).option("sep", "\u0001").option("quote", "").option("encoding", encoding).csv(path)


@query("SELECT c_custkey::VARCHAR AS id, c_name AS titre, CASE WHEN c_custkey % 4 > 0 THEN c_mktsegment END AS \"titre #2\", CASE WHEN c_custkey % 4 > 1 THEN 'é' END AS \"clé\" FROM customer")
def csv_repeated_headers(spark, sf):
    """A quarter of the rows lacks the last two cells, another the last."""
    path, k = _folder(spark, "csv"), F.col("c_custkey")
    cells = [k.cast("string"), F.col("c_name"), F.when(k % 4 > 0, F.col("c_mktsegment")), F.when(k % 4 > 1, F.lit("é"))]
    _write_csv(_Tables(spark, sf).customer.select(F.concat_ws(";", *cells).alias("line")), path, "id;titre;titre;clé", "ISO-8859-1")
    return readers.csv(spark, path, "ISO-8859-1")


@query("SELECT c_custkey::VARCHAR AS id, c_name AS titre FROM customer WHERE c_custkey % 3 <> 0 AND c_custkey % 4 <> 0")
def csv_projects(spark, sf):
    path, k = _folder(spark, "projects"), F.col("c_custkey")
    rows = _Tables(spark, sf).customer.select(F.when(k % 3 == 0, F.lit("Identifiant")).otherwise(k.cast("string")).alias("a"), F.when(k % 4 == 0, F.lit(" ")).otherwise(F.col("c_name")).alias("b"))
    _write_csv(rows, path, "id;titre", "ISO-8859-1")
    return readers.projects(spark, path, "id", "titre").select("id", "titre")


@query("SELECT login, max(nom) AS nom FROM (SELECT 'user' || c_custkey % 40 AS login, CASE WHEN c_custkey % 5 > 0 THEN 'Name of ' || c_custkey % 40 ELSE '' END AS nom FROM customer) WHERE nom <> '' GROUP BY 1")
def csv_mapping(spark, sf):
    path, k = _folder(spark, "people"), F.col("c_custkey")
    rows = _Tables(spark, sf).customer.select(F.concat(F.lit("user"), (k % 40).cast("string")).alias("a"), F.when(k % 5 > 0, F.concat(F.lit("Name of "), (k % 40).cast("string"))).otherwise(F.lit("")).alias("b"))
    _write_csv(rows, path, "login;nom", "UTF-8")
    return readers.mapping(spark, path, "login", "nom")


@query("SELECT c_custkey::VARCHAR AS number, c_name AS state FROM customer")
def csv_index(spark, sf):
    path = _folder(spark, "index")
    _write_csv(_Tables(spark, sf).customer.select(F.col("c_custkey").cast("string").alias("a"), "c_mktsegment", "c_name"), path, "Numéro;Projet;État", "ISO-8859-1")
    return readers.indexed_csv(spark, path, {"number": "numero", "state": "etat"})


@query("SELECT doc_id, lang, source FROM documents")
def jsonl_round_trip(spark, sf):
    path = _folder(spark, "jsonl")
    sinks.save_jsonl(_Tables(spark, sf).documents.select("doc_id", "lang", "source"), path)
    return readers.jsonl(spark, path, "doc_id long, lang string, source string")


@query("SELECT doc_id::VARCHAR AS id, lang AS title, source AS detail, array_to_string([x for x in [CASE WHEN contains(lang || ' ' || source, 'en') THEN 'en' END, CASE WHEN contains(lang || ' ' || source, 'web') THEN 'web' END] if x IS NOT NULL], ',') AS themes FROM documents WHERE doc_id % 6 <> 0 AND (contains(lang || ' ' || source, 'en') OR contains(lang || ' ' || source, 'web'))")
def pool_lines(spark, sf):
    path, k = _folder(spark, "pool"), F.col("doc_id")
    parts = [F.concat(F.lit(" "), k.cast("string")), F.col("lang"), F.col("source"), F.lit("x")]
    _Tables(spark, sf).documents.select(F.when(k % 6 == 0, F.concat_ws("|||", *parts[:3])).otherwise(F.concat_ws("|||", *parts)).alias("value")).write.text(path)
    p = readers.pool(spark, path, lambda c: text.all_matches(c, (("en", "en"), ("web", "web"))))
    return p.select("id", "title", "detail", F.array_join("themes", ",").alias("themes"))


@query("SELECT vec_id, CASE WHEN label % 2 = 0 THEN 'new' ELSE 'old' END AS kind, CASE WHEN label % 2 = 0 THEN -label ELSE label END AS label FROM embeddings WHERE vec_id % 7 <> 0")
def points_rebuilt(spark, sf):
    """Points written once (a second ensure changes nothing), one kind of them rebuilt, and read with a filter."""
    path, e = _folder(spark, "points"), _Tables(spark, sf).embeddings
    kind = F.when(F.col("label") % 2 == 0, "new").otherwise("old")
    sinks.ensure(e.select("vec_id", kind.alias("kind"), "label"), f"{path}/a")
    sinks.ensure(e.select("vec_id", kind.alias("kind"), "label").limit(0), f"{path}/a")
    fresh = e.filter("label % 2 = 0").select("vec_id", F.lit("new").alias("kind"), (-F.col("label")).alias("label"))
    sinks.save(sinks.rebuild_kind(readers.points(spark, f"{path}/a"), fresh, "new"), f"{path}/b", partition=["kind"])
    return readers.points(spark, f"{path}/b", F.col("vec_id") % 7 != 0).select("vec_id", "kind", "label")


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def resume_skip(spark, sf):
    t = _Tables(spark, sf)
    return incremental.resume(t.documents.select("doc_id"), t.labels, "doc_id")


# projections

_CONFIG = {"module": "orders", "identite": "num", "champs": [
    {"cle": "num", "label": "Num", "requis": True}, {"cle": "titre", "label": "Titre", "embedding": True, "min_length": 6}, {"cle": "le", "label": "Date", "role": "date", "type": "date"}, {"cle": "axe", "label": "Axe", "role": "flag"},
    {"cle": "n", "label": "N", "type": "entier", "filtre_vide": ["0"]}, {"cle": "blesses", "label": "N", "derive": "value_not_zero"}, {"cle": "types", "label": "Types", "role": "relation", "noeud": "Type", "cle_noeud": "nom", "relation": "OF"}]}


def _projected(spark, sf):
    k = F.col("o_orderkey")
    raw = _Tables(spark, sf).orders.select(
        k.alias("position"), F.when(k % 9 == 0, F.lit(" ")).otherwise((k - k % 2).cast("string")).alias("Num"), F.col("o_orderpriority").alias("Titre"), F.date_format("o_orderdate", "dd/MM/yyyy").alias("Date"), _pick(("oui - x", "non", "?"), k).alias("Axe"),
        _pick(("0", "3", "x"), k).alias("N"), F.concat("o_orderstatus", F.lit("| x |"), "o_orderstatus").alias("Types"))
    return schema.project(raw, schema.Module.parse(_CONFIG))


_PROJECTED = """pr AS (SELECT *, row_number() OVER (PARTITION BY o_orderkey - o_orderkey % 2 ORDER BY o_orderkey) AS r FROM orders WHERE o_orderkey % 9 <> 0)"""


@query(f"WITH {_PROJECTED} SELECT (o_orderkey - o_orderkey % 2)::VARCHAR AS num, o_orderpriority AS titre, strftime(o_orderdate, '%Y-%m-%d') AS le, [true, false, NULL][o_orderkey % 3 + 1] AS axe, [NULL, 3, NULL][o_orderkey % 3 + 1] AS n, [false, true, false][o_orderkey % 3 + 1] AS blesses, o_orderstatus || ',x' AS types FROM pr WHERE r = 1")
def configured_projection(spark, sf):
    p = _projected(spark, sf)
    return p.select("num", "titre", F.date_format("le", "yyyy-MM-dd").alias("le"), "axe", "n", "blesses", F.array_join(F.transform("entities", lambda e: e["value"]), ",").alias("types"))


@query(f"WITH {_PROJECTED} SELECT (o_orderkey - o_orderkey % 2)::VARCHAR AS num, 'titre' AS field, o_orderpriority AS text FROM pr WHERE r = 1 AND length(o_orderpriority) >= 6")
def texts_to_embed(spark, sf):
    return schema.texts(_projected(spark, sf), schema.Module.parse(_CONFIG), "num")


@query("SELECT event_id, CASE event_type WHEN 'click' THEN 'c' ELSE 'e' END AS kind FROM events WHERE event_type IN ('click', 'error') OR (event_type = 'view' AND event_id % 2 = 0)")
def routed_extractors(spark, sf):
    e = _Tables(spark, sf).events
    as_kind = lambda n: lambda d: d.select("event_id", F.lit(n).alias("kind"))
    fallback = F.when((F.col("event_type") == "view") & (F.col("event_id") % 2 == 0), "error")
    return schema.routed(e, F.col("event_type"), {"click": as_kind("c"), "error": as_kind("e")}, fallback)


@query("SELECT o_orderkey FROM orders WHERE o_orderkey % 4 IN (0, 3)")
def test_records(spark, sf):
    title = _pick(("a {{name}}", "plain", None, "Postman run"), F.col("o_orderkey"))
    return _Tables(spark, sf).orders.filter(schema.is_test_record(title)).select("o_orderkey")


@query("SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN '{\"c_name\":\"' || c_name || '\",\"extra_l\":\"[' || c_custkey || ']\"}' ELSE '{\"extra_l\":\"[' || c_custkey || ']\"}' END AS props FROM customer")
def node_properties(spark, sf):
    c = _Tables(spark, sf).customer.select("c_custkey", F.when(F.col("c_custkey") % 2 == 0, F.col("c_name")).alias("c_name"), F.array("c_custkey").alias("l"))
    return c.select("c_custkey", F.to_json(sinks.props_of(c, ["c_custkey"])).alias("props"))


@query("SELECT user_id, arg_min(event_type, event_id) AS event_type, arg_max(value, event_id) FILTER (value IS NOT NULL) AS value, max(event_id) AS event_id FROM events GROUP BY 1")
def upsert_keeping_first(spark, sf):
    """On create and on match: one column keeps its first value, the others take the newest."""
    e = _Tables(spark, sf).events.select("user_id", "event_type", "value", "event_id")
    return graph.upsert(e.filter("event_id % 3 = 0"), e.filter("event_id % 3 > 0"), ["user_id"], "event_id", keep_old=("event_type",))


# forms of raw fields: inputs of known outcome, by the rules of each form

_TEXTS = (" Objet <br/> :", "Opérateurs", "http://a.b", "x" * 101, "![i](u)", "")


@query("SELECT p_partkey, ['objet', 'operateurs', 'http://a.b', repeat('x', 101), '![i](u)', ''][p_partkey % 6 + 1] AS key, [true, true, false, false, false, false][p_partkey % 6 + 1] AS plausible, ['object', 'operators', NULL, NULL, NULL, NULL][p_partkey % 6 + 1] AS field, p_partkey % 6 = 4 AS noise FROM part")
def label_forms(spark, sf):
    c = _pick(_TEXTS, F.col("p_partkey"))
    return _Tables(spark, sf).part.select("p_partkey", text.label_key(c).alias("key"), text.plausible_label(c).alias("plausible"), text.alias(text.label_key(c), {"objet": "object", "operateurs": "operators"}).alias("field"), text.noise_line(c, ["Page"]).alias("noise"))


_DATES = ("10 mars 2026", "1er août 2020", "10 / 03 / 2026", "31/02/2020", "2021-05-06", "03/04/21", "bientôt")


@query("""SELECT p_partkey, ['2026-03-10', '2020-08-01', '2026-03-10', NULL, NULL, NULL, NULL][p_partkey % 7 + 1] AS french, ['10 mars 2026', '1er août 2020', '10 / 03 / 2026', '31/02/2020', '2021-05-06', '2021-04-03', 'bientôt'][p_partkey % 7 + 1] AS iso_or_raw,
    [NULL, NULL, NULL, NULL, '2021-05-06', NULL, NULL][p_partkey % 7 + 1] AS day_first, [2026, 2020, 2026, 2020, 2021, NULL, NULL][p_partkey % 7 + 1] AS year FROM part""")
def date_forms(spark, sf):
    c = _pick(_DATES, F.col("p_partkey"))
    return _Tables(spark, sf).part.select("p_partkey", scalars.french_date(c).cast("string").alias("french"), scalars.iso_or_raw(c).alias("iso_or_raw"), scalars.parse_date(c, scalars.DAY_FIRST).cast("date").cast("string").alias("day_first"), scalars.year_of(c, 2000, 2026).alias("year"))


@query("""SELECT p_partkey, [true, false, NULL, NULL, NULL][p_partkey % 5 + 1] AS tri, [false, false, true, false, false][p_partkey % 5 + 1] AS two, ['oui - x', 'non', 'Vrai', 'a,b', ''][p_partkey % 5 + 1] AS values, ['d', 'non', 'd', 'd', 'd'][p_partkey % 5 + 1] AS enum FROM part""")
def flag_forms(spark, sf):
    c = _pick(("oui - x", "non", "Vrai", " a|b| a |", "  "), F.col("p_partkey"))
    return _Tables(spark, sf).part.select("p_partkey", scalars.tri_state(c).alias("tri"), scalars.two_state(c).alias("two"), F.array_join(scalars.multi_valued(c), ",").alias("values"), scalars.enum_or(c, ["non"], "d").alias("enum"))


_SUMMARIES = ("court", "Je ne peux pas résumer ce texte, désolé de cette réponse.", "Voici le résumé : un véhicule a été vu sur la piste au matin.", "Un véhicule a été vu sur la piste, Москва, au matin du jour.", "Un engin a heurté une passerelle. Des mesures ont été prises.",
              "Un engin a heurté une passerelle au poste. " * 4 + "Des mesures ont été prises.", "Un engin a heurté une passerelle au poste. " * 4 + "Des mesures ont été prises. Aucune information supplémentaire.", "Voici comment un engin a heurté une passerelle au poste.")


@query("SELECT p_partkey, ['too short', 'refusal', 'refusal', 'script', 'filler', NULL, 'filler', NULL][p_partkey % 8 + 1] AS fault FROM part")
def summary_faults(spark, sf):
    return _Tables(spark, sf).part.select("p_partkey", text.summary_fault(_pick(_SUMMARIES, F.col("p_partkey"))).alias("fault"))


_PEOPLE = ("JEAN PETIT a appelé le 06 12 34 56 78", "id 20612345678", "+33 6 12 34 56 78, j.p@ex.org", "jean petit-fils et Anne Roy", "rien")


@query("SELECT p_partkey, ['Agent_002 a appelé le [tel]', 'id 20612345678', '[tel], [email]', 'Agent_002-fils et Agent_001', 'rien'][p_partkey % 5 + 1] AS scrubbed FROM part")
def scrubbed_names(spark, sf):
    names = text.pseudonyms(["Jean Petit", "Anne Roy", "Jean Petit"])
    return _Tables(spark, sf).part.select("p_partkey", text.scrub(_pick(_PEOPLE, F.col("p_partkey")), names).alias("scrubbed"))


@query(r"""SELECT p_partkey, p_partkey || ' et 7' AS numbers, 'A1|B2|' || p_name AS operators, p_name || E'\nfin & suite' AS plain, 'vu ' || p_name || ' fait' AS quiet, '…' || repeat('x', 10) || p_name || repeat('y', 10) || '…' AS excerpt, 'Nom: ' || p_name AS prompt, 'k_' || p_partkey AS ident, 'a:' || p_partkey AS ref FROM part""")
def text_forms(spark, sf):
    n, name = F.col("p_partkey").cast("string"), F.col("p_name")
    of = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    return _Tables(spark, sf).part.select(
        "p_partkey", F.array_join(F.transform(text.claimed_numbers(of("vu ", n, " fiches, 7 cas et 5 autres"), "fiches?|cas"), lambda x: x.cast("string")), " et ").alias("numbers"), F.array_join(text.split_operators(of("A1<br>• B2\n-\n", name)), "|").alias("operators"),
        text.light_html(of("<b>", name, "</b><br> fin &amp; suite")).alias("plain"), text.denoise(of("vu ", name, " 01/02/2020 10:30\nAB :\nfait")).alias("quiet"), text.excerpt(of("x" * 40, name, "y" * 40), name, 10, "…").alias("excerpt"),
        text.fill_template("Nom: {a}\nVide: {b}", a=name, b=F.lit("")).alias("prompt"), text.identifier(of("k-", n)).alias("ident"), scalars.ref_key(F.lit("a"), n).alias("ref"))


# bulletins: Markdown with tables, continued cells, a tail and a footer

_BODY = "| Objet | {n} |\n|---|---|\n| | suite |\n| Opérateurs | A1<br>B2 |\n| Inconnu | z |\n| | perdu |\n"
_TAIL = "Annule et remplace l'IS 2019 / 4, remplace info sécurité n° 2020-12 et remplace 2018/1. " + "Texte libre. " * 9


#: A part's bulletin, in words that Spark and the oracle read alike: continued cells, three columns, headings of pages,
#: labels that are known, marked, unknown with and without a text, implausible, and notices.
_BULLETIN = """concat_ws(chr(10), '| Sujet | ' || p_name || ' |', '|---|---|', CASE WHEN p_partkey % 2 = 0 THEN '| | INFO SECURITE DGAC N° 2024/01 |' END, '| | suite ' || p_type || ' |',
    CASE WHEN p_partkey % 3 = 0 THEN '| Contexte aéronautique : | | ' || p_name || ' |' END, CASE WHEN p_partkey % 5 = 0 THEN '| Inconnu | dit ' || p_size || ' |' END, CASE WHEN p_partkey % 7 = 0 THEN '| Autre inconnu | |' END, '| | encore ' || p_partkey || ' |',
    CASE WHEN p_partkey % 4 = 0 THEN '| https://example.org | rien |' END, CASE WHEN p_partkey % 11 = 0 THEN '| Une info sécurité est un document | rien |' END, CASE WHEN p_partkey % 13 = 0 THEN '| | ![](page.png) |' END, '| Opérateurs concernés | A' || p_partkey || '<br>• B2 |',
    CASE WHEN p_partkey % 2 = 1 THEN '| | C3 |' END, '| Référence | R |', CASE WHEN p_partkey % 6 = 0 THEN '| Autres documents d''information | S |' END, CASE WHEN p_partkey % 10 = 0 THEN '| Inconnu | redit |' END)"""


@query(rf"""WITH b AS (SELECT p_partkey, string_split({_BULLETIN}, chr(10)) AS ls FROM part), l AS (SELECT p_partkey, generate_subscripts(ls, 1) AS i, unnest(ls) AS l FROM b),
    c AS (SELECT p_partkey, i, [trim(x) for x in string_split(regexp_replace(l, '^\|+|\|+$', '', 'g'), '|')] AS cs FROM l WHERE NOT regexp_matches(l, '^[|:\- ]+$')),
    r AS (SELECT p_partkey, i, cs[1] AS l, array_to_string([x for x in cs[2:] if x <> ''], ' ') AS r, trim(regexp_replace(strip_accents(lower(cs[1])), '[: ]+$', '')) AS k FROM c),
    f AS (SELECT *, CASE k WHEN 'sujet' THEN 'sujet' WHEN 'contexte aeronautique' THEN 'contexte' WHEN 'operateurs concernes' THEN 'operateurs_concernes' WHEN 'reference' THEN 'references' WHEN 'autres documents d''information' THEN 'references' END AS known,
        l <> '' AND NOT contains(l, 'http') AND NOT starts_with(k, 'une info securite') AS labels, (contains(lower(r), 'info securite dgac') AND length(r) < 150) OR starts_with(r, '![') AS noise FROM r),
    w AS (SELECT *, labels AND known IS NULL AND r <> '' AS extra, last_value(CASE WHEN labels AND known IS NOT NULL THEN known WHEN labels AND r <> '' THEN '' END IGNORE NULLS) OVER (PARTITION BY p_partkey ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS field FROM f),
    s AS (SELECT p_partkey, i, extra, CASE WHEN extra THEN k ELSE field END AS field, r, CASE WHEN k IN ('contexte aeronautique', 'autres documents d''information') THEN '## ' || trim(regexp_replace(l, ':+$', '')) || chr(10) || chr(10) ELSE '' END || r AS block FROM w WHERE r <> '' AND (extra OR (labels AND known IS NOT NULL) OR (l = '' AND NOT noise AND field <> '')))
    SELECT p_partkey, field, extra, CASE WHEN extra THEN max_by(r, i) WHEN field <> 'operateurs_concernes' THEN string_agg(block, chr(10) || chr(10) ORDER BY i) END AS value,
        CASE WHEN NOT extra AND field = 'operateurs_concernes' THEN array_to_string([trim(x) for x in string_split(replace(string_agg(r, '•' ORDER BY i), '<br>', '•'), '•') if length(trim(x)) > 1], ';') END AS items FROM s GROUP BY p_partkey, field, extra""")
def bulletin_fields(spark, sf):
    rows = documents.table_rows(_Tables(spark, sf).part.select("p_partkey", F.expr(_BULLETIN).alias("t")), "t")
    return documents.bulletin_fields(rows, ["p_partkey"]).withColumn("items", F.array_join("items", ";"))


@query(f"SELECT p_partkey, CASE WHEN p_partkey % 3 > 0 THEN '{_TAIL.strip().replace(chr(39), chr(39) * 2)}' END AS tail, 3 AS version, '10 février 2024' AS day, '2019/04,2020/12' AS replaces FROM part")
def bulletin_tail(spark, sf):
    long = F.when(F.col("p_partkey") % 3 > 0, F.lit(_TAIL)).otherwise(F.lit("Trop court. "))
    t = F.concat(F.replace(F.lit(_BODY), F.lit("{n}"), F.col("p_name")), F.lit("\n"), long, F.lit("\nToute remarque à\nredire@example.org\nVersion n°3 du 10 février 2024\n"))
    version, day = documents.version_footer(t)
    return _Tables(spark, sf).part.select("p_partkey", documents.after_tables(t, boilerplate=r"Toute remarque.*?redire@example\.org").alias("tail"), version.alias("version"), day.alias("day"), F.array_join(documents.replaced(F.lit(_TAIL)), ",").alias("replaces"))


@query("SELECT p_partkey, 0 AS chunk, 'thread entry' AS kind, NULL AS author, NULL AS date, 'Before the first header, kept' AS text FROM part UNION ALL SELECT p_partkey, 1, 'thread entry', 'Ann Éa', '01/02/2020', p_name || E' was seen on the apron\\nshort' FROM part UNION ALL SELECT p_partkey, 2, 'thread entry', 'BC', NULL, 'and again: ' || p_name || ' & more of it' FROM part")
def thread_chunks(spark, sf):
    name = F.col("p_name")
    page = F.concat(F.lit('<p>Before the first header, kept</p><span class="bold" data-tippy-content="Ann &Eacute;a">AE</span> <span class="libelle_auteur_maj">01/02/2020</span><p>'), name, F.lit(' was seen on the apron</p><span class="bold">XY</span><span class="libelle_auteur_maj">x</span>short<span class="bold"> BC </span><span class="libelle_auteur_maj"> </span>and again: '), name, F.lit(" &amp; more of it"))
    return html.chunks(_Tables(spark, sf).part.select("p_partkey", page.alias("h")), "h", "p_partkey").drop("heading")


@query("SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN 'a,' || p_name || ',' || p_name ELSE 'a,' || p_name || E'\\nb' END AS pieces FROM part")
def merged_short_pieces(spark, sf):
    name = F.col("p_name")
    pieces = F.when(F.col("p_partkey") % 2 == 0, F.array(F.lit("a"), name, name)).otherwise(F.array(F.lit("a"), name, F.lit("b")))
    return _Tables(spark, sf).part.select("p_partkey", F.array_join(documents.merge_short(pieces, 3), ",").alias("pieces"))


# the domain's own vocabulary, on titles and actions of invented records

_TITLES = ("Colllision aviare en finale", "Choc d'un véhicule au poste", "Fuites de kérosène", "Refus de priorité à un aéronef", "Panne réseau, retour parking", "Oiseau/avion", "Feux éteints sur la voie", "Rien de tout cela", "Dégivrage et vent", "Passagers perturbateurs à bord")
_ACTIONS = ("Rappel des consignes et note", "Réunion, puis formation du personnel", "Débris ramassés", "Étude de travaux", "Sanction", "Contrôle du balisage", "")


def _quoted(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def _title_sql(c: str) -> str:
    out = f"trim(regexp_replace(regexp_replace(strip_accents(lower({c})), '[^a-z0-9/ -]', ' ', 'g'), '\\s+', ' ', 'g'))"
    for pattern, by in domain.REWRITES:
        out = f"regexp_replace({out}, {_quoted(pattern)}, {_quoted(by)}, 'g')"
    return out


def _found_sql(c: str, table) -> str:
    return "[x for x in [" + ", ".join(f"CASE WHEN regexp_matches({c}, {_quoted(p)}) THEN {_quoted(n)} END" for n, p in table) + "] if x IS NOT NULL]"


@query(f"WITH t AS (SELECT p_partkey, {_title_sql('[' + ', '.join(map(_quoted, _TITLES)) + '][p_partkey % 10 + 1] || chr(32) || p_name')} AS t FROM part), f AS (SELECT p_partkey, t, {_found_sql('t', domain.FAMILIES)} AS f FROM t) SELECT p_partkey, t AS title, f[1] AS family, f[2] AS fallback FROM f")
def domain_families(spark, sf):
    key = text.title_key(F.concat(_pick(_TITLES, F.col("p_partkey")), F.lit(" "), F.col("p_name")), domain.REWRITES)
    return profile.with_families(_Tables(spark, sf).part.select("p_partkey", key.alias("title")), F.col("title"), domain.FAMILIES)


@query(f"WITH t AS (SELECT p_partkey, strip_accents(lower([{', '.join(map(_quoted, _ACTIONS))}][p_partkey % 7 + 1])) AS t FROM part) SELECT p_partkey, array_to_string({_found_sql('t', domain.THEMES)}, '; ') AS themes, array_to_string({_found_sql('t', domain.CATEGORIES)}, '; ') AS categories FROM t")
def domain_themes(spark, sf):
    c = text.fold(_pick(_ACTIONS, F.col("p_partkey")))
    return _Tables(spark, sf).part.select("p_partkey", F.array_join(text.all_matches(c, domain.THEMES), "; ").alias("themes"), F.array_join(text.all_matches(c, domain.CATEGORIES), "; ").alias("categories"))


@query("SELECT p_partkey, ['contexte', 'actions_recommandees', 'references', NULL][p_partkey % 4 + 1] AS field FROM part")
def domain_labels(spark, sf):
    c = _pick(("Brève description<br/>de l'évènement :", "Bonnes pratiques identifiées", " RÉFÉRENCE ", "Divers"), F.col("p_partkey"))
    return _Tables(spark, sf).part.select("p_partkey", text.alias(text.label_key(c), domain.LABELS).alias("field"))
