"""Registered queries over large raw files, streams and whole ticket records."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import functions as F

from ..functions import places
from ..operators import audit, documents, evaluation, golden, profile
from ..sources import sinks, split_files
from ..streaming import counters, threads
from . import schema, tickets
from .catalogue import _APART, _COMMON, _JARGON, _UUID, _Tables, query


def _folder(spark, label: str) -> str:
    return f"{sinks.shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


# files of up to 5000 records, read in blocks of 256 KB

_PER_FILE, _BLOCK = 5000, 256 << 10


def _write_files(rows, path: str, before, after, glue: str) -> None:
    """A file per 5000 keys: rows (k, r) in order of k between what stands before and after."""
    whole = rows.groupBy(F.expr(f"k div {_PER_FILE}").alias("g")).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("k", "r"))), lambda x: x["r"]), glue).alias("r"))
    whole.select("g", F.concat(before, "r", after).alias("value")).write.partitionBy("g").text(path)


@query(r"""SELECT o_orderkey AS id, CASE WHEN o_orderkey % 100 <> 7 THEN 'C:\dir }{ [' || chr(10) || '"' || o_orderpriority || '" \\' END AS note, CASE WHEN o_orderkey % 100 <> 7 THEN o_orderstatus || ']}' END AS tag, o_orderkey % 100 = 7 AS damaged FROM orders""")
def json_in_blocks(spark, sf):
    """Envelopes with lists of links before and after, and indented lists; brackets, quotes and lone backslashes in texts;
    one record in 100 is damaged. Damaged records are told by their text."""
    k, path = F.col("o_orderkey"), _folder(spark, "json-blocks")
    note = F.concat(F.lit('"C:\\dir }{ [\\n\\"'), "o_orderpriority", F.lit('\\" \\\\\\\\"'))
    record = F.concat(F.lit('{"id": '), k.cast("string"), F.when(k % 100 == 7, F.lit(', "x": ,\n')).otherwise(F.lit(",\n")), F.lit(' "note": '), note, F.lit(', "tags": [{"of": {"tag": "'), "o_orderstatus", F.lit(']}"}}, []]}'))
    envelope = F.col("g") % 2 == 0
    before = F.when(envelope, F.lit('{"_links": {"curies": [{"id": -1}]},\n "_embedded": {"other": [{"id": -2}], "module": [')).otherwise(F.lit("[\n  "))
    after = F.when(envelope, F.lit(', "no record", [{"id": -3}]], "later": [{"id": -4}]}}')).otherwise(F.lit(", 7]"))
    _write_files(_Tables(spark, sf).orders.select(k.alias("k"), record.alias("r")), path, before, after, ",\n  ")
    good, bad = split_files.json_records(spark, f"{path}/*/*.txt", split=_BLOCK)
    of = lambda p, t="string": F.try_variant_get("record", p, t)
    good = good.select(of("$.id", "long").alias("id"), of("$.note").alias("note"), of("$.tags[0].of.tag").alias("tag"), F.lit(False).alias("damaged"))
    none = F.lit(None).cast("string")
    return good.unionByName(bad.select(F.regexp_extract("text", '"id": ([0-9]+)', 1).cast("long").alias("id"), none.alias("note"), none.alias("tag"), F.lit(True).alias("damaged")))


@query("""SELECT o_orderkey::VARCHAR AS id, o_orderpriority || E';\\n"' || o_orderstatus || '"' AS titre, CASE WHEN o_orderkey % 4 > 0 THEN 'in"side ' || o_custkey END AS "titre #2", CASE WHEN o_orderkey % 4 > 1 THEN E'é\\n\\n' || o_orderkey END AS "clé" FROM orders""")
def csv_in_blocks(spark, sf):
    """Cells with separators, line ends and quotes; a quarter of the rows lacks the last two cells, another the last."""
    k, path = F.col("o_orderkey"), _folder(spark, "csv-blocks")
    cells = [k.cast("string"), F.concat(F.lit('"'), "o_orderpriority", F.lit(';\n""'), "o_orderstatus", F.lit('"""')), F.when(k % 4 > 0, F.concat(F.lit('in"side '), F.col("o_custkey").cast("string"))), F.when(k % 4 > 1, F.concat(F.lit('"é\n\n'), k.cast("string"), F.lit('"')))]
    _write_files(_Tables(spark, sf).orders.select(k.alias("k"), F.concat_ws(";", *cells).alias("r")), path, F.lit("id;titre;titre;clé\r\n"), F.lit("\r\n"), "\r\n")
    return split_files.csv(spark, f"{path}/*/*.txt", split=_BLOCK)[0]


# streams

_GAP, _LATE, _SLICES = 8, 24, 3


@contextmanager
def _state_store(spark):
    name = "spark.sql.streaming.stateStore.providerClass"
    old = spark.conf.get(name)
    spark.conf.set(name, threads.STORE)
    try:
        yield
    finally:
        spark.conf.set(name, old)


@query(f"""WITH e AS (SELECT user_id, event_id, epoch_us(ts) AS us FROM events WHERE ts IS NOT NULL AND user_id IS NOT NULL), s AS (SELECT *, coalesce(us - lag(us) OVER w > {_GAP} * 3600000000, true) AS fresh FROM e WINDOW w AS (PARTITION BY user_id ORDER BY us, event_id::VARCHAR)),
    n AS (SELECT *, sum(fresh::INTEGER) OVER (PARTITION BY user_id ORDER BY us, event_id::VARCHAR) AS n FROM s), t AS (SELECT *, min(us) OVER p AS start_us, max(us) OVER p AS end_us, row_number() OVER (PARTITION BY user_id, n ORDER BY us, event_id::VARCHAR) - 1 AS pos FROM n WINDOW p AS (PARTITION BY user_id, n))
    SELECT user_id, event_id, us, start_us, end_us, pos::INTEGER AS pos FROM t WHERE (end_us + {_GAP} * 3600000000) // 1000 + 1 <= (SELECT max(us) // 1000 FROM e) - {_LATE} * 3600000""")
def event_threads(spark, sf):
    """Events that arrive up to half a day late, in three runs of one stream: the threads that have closed are those of
    the whole table."""
    e, path = _Tables(spark, sf).events.select("event_id", "user_id", "ts"), _folder(spark, "threads")
    arrival = F.unix_seconds(threads.instant(e, "ts")) + F.pmod(F.xxhash64("event_id"), F.lit(12 * 3600))
    first, last = e.agg(F.min(arrival), F.max(arrival)).first()
    piece = F.least(F.floor((arrival - F.lit(first or 0)) * _SLICES / F.lit(max(1, (last or 0) - (first or 0)))), F.lit(_SLICES - 1))
    e.withColumn("slice", F.coalesce(piece, F.lit(0))).write.partitionBy("slice").parquet(f"{path}/all")
    with _state_store(spark):
        for i in range(_SLICES):
            spark.read.schema(e.schema).parquet(f"{path}/all/slice={i}").write.mode("append").parquet(f"{path}/in")
            out = threads.closed_threads(spark.readStream.schema(e.schema).parquet(f"{path}/in"), "user_id", "ts", "event_id", f"{_GAP} hours", f"{_LATE} hours")
            out.writeStream.format("parquet").option("path", f"{path}/out").option("checkpointLocation", f"{path}/state").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(out.schema).parquet(f"{path}/out").select("user_id", "event_id", F.unix_micros("ts").alias("us"), F.unix_micros("_start").alias("start_us"), F.unix_micros("_end").alias("end_us"), F.col("_position").alias("pos"))


@query("SELECT event_type, count(*) AS refused, (SELECT count(*) FROM events)::BIGINT AS rows_in, (SELECT count_if(value IS NULL OR value <= 2 OR event_type IS NULL) FROM events)::BIGINT AS rows_refused, (SELECT count_if(event_type = 'click') FROM events)::BIGINT AS clicks, true AS timed FROM events WHERE value IS NULL OR value <= 2 OR event_type IS NULL GROUP BY event_type")
def ingest_counters(spark, sf):
    """Refused rows by type from the dead letters, beside the counters of the run, summed over its batches."""
    path = _folder(spark, "ingest")
    e = _Tables(spark, sf).events.select("event_id", "event_type", "value")
    e.write.parquet(f"{path}/in")
    stream = spark.readStream.schema(e.schema).option("maxFilesPerTrigger", 2).parquet(f"{path}/in")
    c = counters.ingest(stream, f"{path}/out", f"{path}/state", f"ingest-{uuid.uuid4().hex}", (F.col("value") > 2) & F.col("event_type").isNotNull(), clicks=F.col("event_type") == "click")
    total = c.table(spark).agg(F.sum("rows").alias("rows_in"), F.sum("refused").alias("rows_refused"), F.sum("clicks").alias("clicks"), F.bool_and(F.col("milliseconds") >= 0).alias("timed"))
    return counters.refused(spark, f"{path}/out", e.schema).groupBy("event_type").agg(F.count(F.lit(1)).alias("refused")).join(F.broadcast(total), how="cross")  # one row of totals


# tickets

_SAID = "o_orderpriority || ' for customer ' || o_custkey || ', seen again'"


@query(f"""WITH x AS (SELECT *, 'T' || o_orderkey AS number, {_SAID} AS said FROM orders WHERE o_orderkey % 50 <> 0), s AS (SELECT *, sha1(unhex('{tickets.TICKETS.hex}') || encode(number)) AS h FROM x)
    SELECT number AS numero_fe, {_UUID} AS ticket_id, 'Order ' || o_orderkey AS titre, CASE WHEN o_orderkey % 2 = 0 THEN 'thread entry|AB Cd|01/02/2020|' || said || '#thread entry|XY||' || said || ' & once more' ELSE 'p|||' || said || '#p|||' || said || ' too' END AS details,
    CASE WHEN o_orderkey % 3 > 0 THEN 'p|||' || said END AS causes, CASE WHEN o_orderkey % 3 > 0 AND length(said) >= 50 THEN said END AS cause_nc, o_orderpriority AS importance, o_orderstatus AS etat, o_orderstatus AS abbr, (o_orderkey % 9)::INTEGER AS etape, CASE WHEN o_orderkey % 4 > 0 THEN (o_orderkey % 4)::INTEGER END AS id_type,
    CASE WHEN o_orderkey % 4 > 0 THEN 'P' || o_orderkey % 4 END AS projet_id, 'v' || o_orderkey % 5 AS version_souhaitee, 'dev' || o_custkey % 7 AS developpeur_login, 'user' || o_custkey % 11 AS emetteur_login, o_custkey::INTEGER AS emetteur_id, NULL::VARCHAR AS site_application, NULL::VARCHAR AS version_souhaitee_id, NULL::VARCHAR AS type_label, NULL::VARCHAR AS type_code, '2020' AS date_nc FROM s""")
def ticket_full_records(spark, sf):
    """Tickets made from orders, without some of the fields that a record copies."""
    k, s = F.col("o_orderkey"), lambda c: F.col(c).cast("string")
    said = F.concat("o_orderpriority", F.lit(" for customer "), s("o_custkey"), F.lit(", seen again"))
    entries = F.concat(F.lit('<span class="bold" data-tippy-content="AB Cd">AC</span> <span class="libelle_auteur_maj">01/02/2020</span><p>'), said, F.lit('</p><span class="bold">XY</span><span class="libelle_auteur_maj"></span>'), said, F.lit(" &amp; once more"))
    raw = _Tables(spark, sf).orders.select(
        F.when(k % 50 == 0, F.lit(" ")).otherwise(F.concat(F.lit("T"), k.cast("string"))).alias("numero_fe"), F.concat(F.lit("<b>Order</b> "), k.cast("string")).alias("titre_nc"), F.when(k % 2 == 0, entries).otherwise(F.concat(F.lit("<p>"), said, F.lit("</p><p>"), said, F.lit(" too</p>"))).alias("detail_nc"),
        F.lit(None).cast("string").alias("resume"), F.when(k % 3 > 0, F.concat(F.lit("<p>"), said, F.lit("</p>"))).alias("cause_nc"), F.array(F.lit("v")).alias("versioneffective"), F.lit("login").alias("resp_traitement_nc"), F.lit("2020").alias("date_nc"), F.col("o_orderpriority").alias("importance"), F.col("o_orderstatus").alias("etat"), F.col("o_orderstatus").alias("abbr"),
        (k % 9).cast("string").alias("etape"), F.when(k % 4 > 0, (k % 4).cast("string")).otherwise(F.lit("none")).alias("id_type"), F.when(k % 4 > 0, F.struct(F.concat(F.lit("P"), (k % 4).cast("string")).alias("_id"))).alias("projet_ticket"), F.struct(F.concat(F.lit("v"), (k % 5).cast("string")).alias("_label"), F.lit(1).alias("other")).alias("versionsouhaitee"),
        F.struct(F.concat(F.lit("dev"), (F.col("o_custkey") % 7).cast("string")).alias("loginUser")).alias("developpeur_responsable"), F.concat(F.lit("user"), (F.col("o_custkey") % 11).cast("string")).alias("emetteur_nc"), F.col("o_custkey").alias("id_emetteur_nc"), F.lit("no structure").alias("type_de_de"))
    t = tickets.ticket_records(raw)
    one = lambda c: F.nullif(F.array_join(F.transform(c, lambda x: F.concat_ws("|", x["kind"], F.coalesce(x["author"], F.lit("")), F.coalesce(x["date"], F.lit("")), x["text"])), "#"), F.lit(""))
    kept = ("numero_fe", "ticket_id", "titre", "cause_nc", "importance", "etat", "abbr", "etape", "id_type", "projet_id", "version_souhaitee", "developpeur_login", "emetteur_login", "emetteur_id", "site_application", "version_souhaitee_id", "type_label", "type_code", "date_nc")
    return t.select(*kept, one("detail_chunks").alias("details"), one("cause_chunks").alias("causes"))


# rules of records, audits and places over the tables

@query(rf"""WITH t AS (SELECT doc_id, f, text FROM (SELECT doc_id, text, source || ' Q.R.P et Q.R ISO (NP7)' AS source FROM documents) UNPIVOT (text FOR f IN (text, source))),
    o AS (SELECT DISTINCT doc_id, f, unnest([{{'a': replace(x, '.', ''), 's': x}} for x in regexp_extract_all(regexp_replace(text, '[^\p{{L}}\p{{N}}_.]+', '  ', 'g'), '(?:^| )((?:[A-Z]\.){{2,}}[A-Z]?)(?: |$)', 1)] || [{{'a': x, 's': x}} for x in regexp_extract_all({_APART}, ' ([A-Z][A-Z0-9]{{1,7}}) ', 1)]
        || [{{'a': upper(x), 's': x}} for x in regexp_extract_all({_APART}, ' ((?i:iso|er)) ', 1)], recursive := true) FROM t),
    d AS (SELECT a, doc_id, min({{'f': f, 's': s}}) AS x FROM o GROUP BY 1, 2), r AS (SELECT a, doc_id, x.f AS f, x.s AS s, row_number() OVER (PARTITION BY a ORDER BY doc_id) AS r FROM d),
    p AS (SELECT a, r, s, text, strpos(text, s) AS w FROM r JOIN t USING (doc_id, f) WHERE r <= 3), e AS (SELECT *, greatest(w - 70, 1) AS b, least(w + length(s) + 70, length(text) + 1) AS z FROM p)
    SELECT a AS acronym, string_agg(CASE WHEN b > 1 THEN '…' ELSE '' END || trim(regexp_replace(substr(text, b, z - b), '\s+', ' ', 'g')) || CASE WHEN z <= length(text) THEN '…' ELSE '' END, ' / ' ORDER BY r) AS excerpts FROM e GROUP BY 1""")
def acronym_excerpts(spark, sf):
    """The first three excerpts, a feature of the report, of every acronym."""
    d = _Tables(spark, sf).documents.select(F.col("doc_id").alias("id"), "text", F.concat("source", F.lit(" Q.R.P et Q.R ISO (NP7)")).alias("source"))
    texts = d.unpivot("id", ["text", "source"], "field", "text").filter("text is not null")
    return profile.acronym_dictionary(texts, _COMMON, protected=["ST"], lower=_JARGON).select("acronym", F.array_join("excerpts", " / ").alias("excerpts"))


_NAMED = ("Agregation", "semantique", "RECO", "analyse", "autre", "hors_domaine")


@query(f"""WITH r AS (SELECT event_id, CASE WHEN event_id % 10 > 0 THEN [{', '.join(f"'{x}'" for x in _NAMED)}][user_id % 6 + 1] END AS chosen, ['liste', 'recherche', 'recommandation', 'analyse', 'abstention'][event_id % 5 + 1] AS wanted, coalesce(value < 20, false) AS ok, event_type FROM events),
    j AS (SELECT *, CASE WHEN event_id % 3 > 0 THEN event_id % 2 = 0 END AS best, CASE lower(chosen) WHEN 'agregation' THEN 'liste' WHEN 'semantique' THEN 'recherche' WHEN 'reco' THEN 'recommandation' WHEN 'hors_domaine' THEN 'abstention' ELSE lower(chosen) END = wanted AS good FROM r)
    SELECT event_type, count(*) AS n, count_if(ok)::BIGINT AS ok, count_if(best)::BIGINT AS ok_by_route, count_if(NOT good)::BIGINT AS misrouted, count_if(NOT good AND best AND NOT ok)::BIGINT AS costly FROM j GROUP BY 1""")
def routed_answers(spark, sf):
    """Every event as a question: a router's choice by its own names, failures without one, a third not asked by route."""
    e, k = _Tables(spark, sf).events, F.col("event_id")
    chosen = F.when(k % 10 > 0, F.element_at(F.array(*[F.lit(x) for x in _NAMED]), (F.col("user_id") % 6 + 1).cast("int")))
    wanted = F.element_at(F.array(*[F.lit(x) for x in ("liste", "recherche", "recommandation", "analyse", "abstention")]), (k % 5 + 1).cast("int"))
    run = e.select(k.alias("id"), chosen.alias("chosen"), wanted.alias("wanted"), F.coalesce(F.col("value") < 20, F.lit(False)).alias("ok"), "event_type")
    r = audit.routed(run, e.filter(k % 3 > 0).select(k.alias("id"), (k % 2 == 0).alias("ok")))
    return r.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), *[F.count_if(c).alias(c) for c in ("ok", "ok_by_route", "misrouted", "costly")])


@query("SELECT (year(o_orderdate) + 6)::VARCHAR AS first, (year(o_orderdate) + 6 + o_orderkey % 2)::VARCHAR AS second, count(*) AS n FROM orders WHERE o_orderkey % 3 > 0 AND o_orderkey % 7 > 0 GROUP BY 1, 2")
def either_year_questions(spark, sf):
    """Questions made from orders that name two years as alternatives, or apart; a seventh names years before 2000."""
    y = F.year("o_orderdate") + F.when(F.col("o_orderkey") % 7 > 0, 6).otherwise(-30)
    q = F.concat(F.lit("Événements "), y.cast("string"), F.when(F.col("o_orderkey") % 3 > 0, F.lit(" OU ")).otherwise(F.lit(" et ")), (y + F.col("o_orderkey") % 2).cast("string"), F.lit(" ?"))
    return _Tables(spark, sf).orders.select(F.explode(golden.either_year(q)).alias("p")).groupBy("p.first", "p.second").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT 'P' || p_partkey AS k, p_name AS name, CASE WHEN p_partkey % 2 = 0 THEN p_type END AS rare, CASE WHEN p_partkey % 3 = 0 THEN '{\"size\":' || p_size || '}' END AS nested, (p_partkey % 2 = 0)::INTEGER + (p_partkey % 3 = 0)::INTEGER AS n FROM part")
def projected_extras(spark, sf):
    """Rare source fields that a module's configuration keeps; one of them is in no table."""
    module = schema.Module.parse({"module": "part", "identite": "k", "champs": [{"cle": "k", "label": "k", "requis": True}, {"cle": "name", "label": "p_name"}], "extras": {"enabled": True, "whitelist": ["rare", "nested", "nowhere"]}})
    k = F.col("p_partkey")
    rows = _Tables(spark, sf).part.select(F.concat(F.lit("P"), k.cast("string")).alias("k"), "p_name", F.when(k % 2 == 0, F.col("p_type")).alias("rare"), F.when(k % 3 == 0, F.struct(F.col("p_size").alias("size"))).alias("nested"))
    x = F.col("extra_fields")
    return schema.project(rows, module).select("k", "name", x["rare"].alias("rare"), x["nested"].alias("nested"), F.size(x).alias("n"))


_SIDES = "['L', 'R'][o_orderkey % 2 + 1]"


@query(f"""WITH d AS (SELECT o_orderkey, 10 + o_custkey % 30 AS n, o_orderkey % 5 AS form, {_SIDES} AS side FROM orders), r AS (SELECT *, n || side AS raw, ['', '', 'C' || n][greatest(form - 1, 1)] AS stand FROM d),
    c AS (SELECT *, CASE n WHEN 18 THEN '17' WHEN 36 THEN '35' ELSE n::VARCHAR END || side AS now FROM r), k AS (SELECT *, now IN ('17L', '17R', '35L', '35R') AS good FROM c)
    SELECT o_orderkey, 'LFLL' AS code, CASE WHEN form < 4 THEN raw END AS raw, CASE WHEN form < 4 AND good THEN now END AS runway, form < 4 AND good AND now <> raw AS renamed, CASE WHEN form < 4 AND good THEN 1 END AS strips, CASE WHEN form = 4 THEN 'C' || n END AS stand, CASE WHEN form = 3 THEN 'MAN' END AS zone,
        CASE WHEN form < 4 AND NOT good THEN raw || ' unknown at Lyon Saint Exupéry' END AS anomaly, CASE WHEN form < 4 THEN raw END AS first_runway, CASE WHEN form = 4 THEN 'C' || n END AS first_stand FROM k""")
def places_of_orders(spark, sf):
    """Places written in five forms for every order: runways of any number, with a nought, a blank or an area, and stands."""
    k, n = F.col("o_orderkey"), (F.lit(10) + F.col("o_custkey") % 30).cast("string")
    side = F.when(k % 2 == 0, F.lit("L")).otherwise(F.lit("R"))
    form = k % 5
    written = F.when(form == 0, F.concat(n, side)).when(form == 1, F.concat(F.lit("piste 0"), n, side)).when(form == 2, F.concat(F.lit(" "), n, F.lower(side), F.lit(" "))).when(form == 3, F.concat(n, side, F.lit(" - man"))).otherwise(F.concat(F.lit("c"), n))
    d = _Tables(spark, sf).orders.select("o_orderkey", written.alias("w")).select("o_orderkey", "w", places.normalise(F.col("w"), F.lit("LYON Saint-Exupéry")).alias("p"))
    runway, stand = places.first_runway_or_stand(F.lit(None).cast("string"), F.col("w"))
    return d.select("o_orderkey", F.col("p.aerodrome_code").alias("code"), F.array_join("p.runway_raw", ",").alias("raw"), F.array_join("p.runway_current", ",").alias("runway"), F.col("p.runway_renamed").alias("renamed"), F.col("p.strips").alias("strips"), F.col("p.stand").alias("stand"), F.col("p.zone").alias("zone"), F.col("p.anomaly").alias("anomaly"), runway.alias("first_runway"), stand.alias("first_stand"))


@query("""WITH c AS (SELECT o_custkey AS family, count(*) AS n, round(avg((o_orderstatus = 'F')::INTEGER), 9) AS rate, count(DISTINCT o_orderpriority) AS structured FROM orders GROUP BY 1), d AS (SELECT c_mktsegment, n, rate, structured, n >= 8 AND rate >= 0.35 AND structured >= 3 AS usable FROM c JOIN customer ON family = c_custkey)
    SELECT c_mktsegment AS segment, count(*) AS families, count_if(usable)::BIGINT AS usable FROM d GROUP BY 1""")
def usable_grounds(spark, sf):
    """Customers as families of orders: how many give grounds for a recommendation, by segment."""
    t = _Tables(spark, sf)
    stats = t.orders.groupBy(F.col("o_custkey").alias("family")).agg(F.count(F.lit(1)).alias("n"), F.round(F.avg((F.col("o_orderstatus") == "F").cast("int")), 9).alias("rate"), F.countDistinct("o_orderpriority").alias("structured"))
    return profile.grounds(stats).join(t.customer, F.col("family") == F.col("c_custkey")).groupBy(F.col("c_mktsegment").alias("segment")).agg(F.count(F.lit(1)).alias("families"), F.count_if("usable").alias("usable"))


@query("""WITH v AS (SELECT event_type AS variant, round(avg((value > 10)::INTEGER), 9) AS recall, round(avg((user_id % 2 = 0)::INTEGER), 9) AS homogeneity FROM events GROUP BY 1), b AS (SELECT *, max(recall) OVER () AS best FROM v)
    SELECT variant, recall, homogeneity FROM b WHERE best - recall <= 0.02 ORDER BY homogeneity, recall DESC, variant LIMIT 1""")
def chosen_variant(spark, sf):
    """Event types as variants of a search; a difference of up to 0.02 to the best recall is not clear. One row is the feature."""
    v = _Tables(spark, sf).events.groupBy(F.col("event_type").alias("variant")).agg(F.round(F.avg((F.col("value") > 10).cast("int")), 9).alias("recall"), F.round(F.avg((F.col("user_id") % 2 == 0).cast("int")), 9).alias("homogeneity"))
    best = v.agg(F.max("recall").alias("best"))
    low = v.join(F.broadcast(best), how="cross").withColumn("low_delta", F.when(F.col("recall") < F.col("best"), F.col("best") - F.col("recall") - 0.02))  # one row is broadcast
    return evaluation.choose(low).select("variant", "recall", "homogeneity")


@query("SELECT o_custkey, coalesce(string_agg(s, ', ' ORDER BY i), '') AS related, count(*) AS n FROM (SELECT o_custkey, o_orderpriority AS s, min(o_orderkey) AS i FROM orders GROUP BY 1, 2) GROUP BY 1")
def joined_relations(spark, sf):
    """The priorities of a customer's orders, each once in order of its first, and empty and missing values left out."""
    rows = _Tables(spark, sf).orders.groupBy("o_custkey", F.col("o_orderpriority").alias("s")).agg(F.min("o_orderkey").alias("i"))
    g = rows.groupBy("o_custkey").agg(F.transform(F.sort_array(F.collect_list(F.struct("i", "s"))), lambda x: x["s"]).alias("v"), F.count(F.lit(1)).alias("n"))  # as many as there are priorities
    noisy = F.concat(F.array(F.lit(""), F.lit(None).cast("string")), "v", "v")
    return g.select("o_custkey", F.coalesce(documents.relation(noisy), F.lit("")).alias("related"), "n")
