"""Operators against literal rows worked out from their rules, and queries without SQL against plain versions."""

import random
import re
import uuid

import pyspark.sql.functions as F
import pytest

from orrery.functions import places, scalars, text
from orrery.operators import audit, documents, evaluation, golden, html, profile, search
from orrery.plans import catalogue, schema, tickets
from orrery.sources import readers
from orrery.streaming import incremental

from .test_catalogue import SF, one




def test_json_repair(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"_id": 1, "t": "a\\q b\\\\d \\u00e9 \\u12 \\n end\\\\"}, "x"]')
    (got,) = readers.typed_json(spark, str(tmp_path), "_id long, t string").collect()
    assert got.t == "a\\q b\\d é \\u12 \n end\\"
    assert one(spark, F.to_json(scalars.tolerant_json(F.col("t"))), t='so {"a": "x\\\\y\\z"}.') == '{"a":"x\\\\y\\\\z"}'


def test_field_kinds(spark):
    d = spark.createDataFrame([("c" * 30, "k", ["a", "b"], {"_label": "x"}, True)] * 3, "same string, code string, list array<string>, ref struct<_label: string>, yes boolean")
    assert {r.column: r.kind for r in profile.field_kinds(d, d.columns).collect()} == {"same": "text", "code": "constant", "list": "code", "ref": "reference"}


def test_family_verdicts(spark):
    rows = [(10, 0.95, "Autre x", 0.1), (10, 0.5, "Autre x", 0.9), (10, 0.6, "Vol", 0.8), (10, 0.5, "Vol", 0.7), (10, 0.6, "Vol", 0.7), (0, 0.0, "Vol", 0.0)]
    d = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i long, n long, kind_share double, top_kind string, kind_entropy double")
    assert [r.verdict for r in profile.family_verdict(d).orderBy("i").collect()] == ["redundant", "strong", "loose pattern", "strong", "medium", "empty"]


def test_bulletins(spark):
    for s, want in (("remplace l’IS 2018 01, annule et remplace IS 2019-12", ["2018/01", "2019/12"]), ("Remplace l'info sécurité n° 2020/3", ["2020/03"]), ("remplace 2020/3", [])):
        assert one(spark, documents.replaced(F.col("t")), t=s) == want
    for s in ("Version no 2 du 1 / 02 / 2020", "version n°2 du 10 février 2024", "VERSION Nº 2 du 10/03/2026"):
        assert one(spark, documents.version_footer(F.col("t"))[0], t=s) == 2
    body = "| a | b |\n\n" + "x" * 99
    assert one(spark, documents.after_tables(F.col("t")), t=body) is None and one(spark, documents.after_tables(F.col("t")), t=body + "x") == "x" * 100
    assert one(spark, documents.after_tables(F.col("t"), boilerplate="Note.*?end"), t=body + "x\nNote\nto end\nVersion n°1 du 10/03/2026") == "x" * 100
    assert one(spark, documents.after_tables(F.col("t")), t="no table " * 30) is None


def test_scrub_and_summaries(spark):
    assert text.pseudonyms(["b", "a", "b"]) == {"a": "Agent_001", "b": "Agent_002"}
    assert one(spark, text.scrub(F.col("t"), {"Al (x)": "Agent_001"}), t="AL (X) 0612345678 id20612345678") == "Agent_001 [tel] id20612345678"
    filler = "Des mesures ont été prises. "
    assert one(spark, text.summary_fault(F.col("t")), t=filler + "x" * 40) == "filler" and one(spark, text.summary_fault(F.col("t")), t=filler + "x" * 200) is None
    assert one(spark, text.summary_fault(F.col("t")), t=filler * 2 + "x" * 200) == "filler"


def test_metrics(spark):
    assert one(spark, evaluation.corrected_precision(F.lit(0.5), F.lit(0.1), 10, F.lit(4.0))) == pytest.approx(0.54)
    v = spark.createDataFrame([("a", 0.5, None, 0.4), ("b", 0.2, 0.1, 0.1)], "variant string, recall double, low_delta double, homogeneity double")
    assert evaluation.choose(v).first().variant == "a"
    d = spark.createDataFrame([(i, float(i % 4)) for i in range(3)], "id long, d double")
    r = evaluation.bootstrap(d, "d", 500, linear=False).first()
    assert r.low <= r.mean <= r.high


def test_runways(spark):
    for q, want in (("la 36L", ["35L"]), ("la 36L et la 35L", ["35L"]), ("17L/35R", ["17L", "35R"]), ("99L", []), ("piste 16/34", ["16", "34"]), ("piste 16", ["16"]), ("12 16", [])):
        assert one(spark, places.runways_asked(F.col("t")), t=q) == want


def test_facts(spark):
    none = F.array().cast("array<string>")
    assert one(spark, audit.fact_present(F.lit("periode"), F.lit("2010-2020"), none, F.col("t")), t="entre 2010 et hier") is True
    assert one(spark, audit.fact_present(F.lit("lieu"), F.lit("aire de trafic nord"), none, F.col("t")), t="sur l'aire") is False


REFUSAL = "aucune donnée|hors périmètre"


@pytest.mark.parametrize("wanted,expected,limit,answer,ok", [
    ("ABSTENTION", [], None, "", True), ("ABSTENTION", [], None, "Aucune DONNÉE ici", True), ("ABSTENTION", ["a"], None, "voici a", False),
    ("CEILING", ["absent"], "fiches avec cause rédigée", "selon les causes rédigée au dossier", True), ("CEILING", ["lundi"], "fiches avec action structurée", "lundi", False),
    ("EXACT", ["lundi", "mardi", "mercredi", "jeudi"], None, "Lundi et MARDI", True), ("EXACT", ["lundi", "mardi", "mercredi", "jeudi"], None, "lundi", False),
    ("EXACT", [], None, "lundi", False), ("EXACT", ["6 217", "6217"], None, "il y en a 6 217", True), ("EXACT", ["Collision aviaire en courte finale"], None, "une collision aviaire en courte", True)])
def test_status(spark, wanted, expected, limit, answer, ok):
    d = spark.createDataFrame([(wanted, expected, limit, answer)], "w string, e array<string>, l string, a string")
    assert d.select(audit.status(F.col("w"), F.col("e"), F.col("l"), F.col("a"), REFUSAL)).first()[0] is ok


def test_expected_values(spark):
    d = spark.createDataFrame([("ranking",), ("distribution",), ("number",), ("comparison",), ("other",)], "k string")
    got = d.select(audit.expected_values(F.col("k"), F.array(F.lit("x")), F.create_map(F.lit("a"), F.lit("1")), F.lit(6217).cast("long"))).collect()
    assert [r[0] for r in got] == [["x"], ["a"], ["6 217", "6217"], ["1"], []]


def test_queries_in_blocks(spark):
    e = spark.createDataFrame([(i, i % 3, [float(i), 1.0]) for i in range(40)], "id long, owner long, embedding array<double>")
    q = e.filter("id < 17").select(F.col("id").alias("query_id"), F.col("embedding").alias("q"))
    rows = lambda few: sorted(map(tuple, search.scores(q, e, few=few).collect()))
    assert rows(4) == rows(1000) and len(rows(4)) == 17 * 40


def test_judged_rows_reach_deep_hits(spark):
    s = spark.createDataFrame([(1, i, round(1 - i / 50, 2)) for i in range(40)] + [(2, i, 0.5) for i in range(9)], "query_id long, id long, score double")
    rows, truth = search.judged(s, ((F.col("query_id") == 1) & (F.col("id") >= 30)) | ((F.col("query_id") == 2) & (F.col("id") == 4)), 5)
    got = sorted((r.query_id, r.id, r.rank, r.relevant) for r in rows.collect())
    assert got == [*[(1, i, i + 1, 0) for i in range(5)], (1, 30, 31, 1), *[(2, i, i + 1, int(i == 4)) for i in range(5)]]
    assert {r.query_id: r.n_relevant for r in truth.collect()} == {1: 10, 2: 1}


def test_routes_and_derived_values(spark):
    d = spark.createDataFrame([("a", None, "0"), ("z", "a", "2"), (None, "a", "x"), ("z", "y", "1")], "kind string, module string, n string")
    f = schema.Field("hurt", "n", derived="value_not_zero")
    out = schema.routed(d, F.col("kind"), {"a": lambda x: x.select(schema.value(f).alias("hurt"))}, F.col("module"))
    assert sorted(r.hurt for r in out.collect()) == [False, False, True]


def test_question_filters(spark):
    got = one(spark, golden.question_filters(F.col("t"), {"fod": "FOD"}), t="FOD en 2019 ou 1999 au poste C 83 ?")
    assert [(x.field, x.value) for x in got] == [("year", "2019"), ("kind", "FOD"), ("stand", "C83")]


def _cut(line, width):
    """The rule of cutting, by a loop."""
    out = [line]
    while len(out[-1]) > width:
        head = out[-1]
        at = head.rfind(" ", 0, width)
        at = at if at > 0 else width
        out[-1:] = [head[:at].rstrip(), head[at:].lstrip()]
    return out


def _segments(lines, prefix, budget):
    out, now, size = [], [], len(prefix)
    for line in lines:
        for m in _cut(line, budget - len(prefix)):
            if now and size + 1 + len(m) > budget:
                out.append("\n".join(now))
                now, size = [], len(prefix)
            now.append(m)
            size += (1 if len(now) > 1 else 0) + len(m)
    return [*out, "\n".join(now)] if now else out


def test_long_records_overflow(spark):
    r = random.Random(4)
    stories = [["mot " * 60] * 3, ["x" * 1700, "y" * 90], ["a" * 700] * 3, [" ".join("w" * r.randrange(1, 30) for _ in range(200)).strip() for _ in range(3)], ["z" * 5000, "b c"], ["k " * 1200 + "end"]]
    d = spark.createDataFrame([(i, [x.strip() for x in s]) for i, s in enumerate(stories)], "id long, n array<string>")
    for meta, budget in (("meta", 600), ("meta", 1800), (None, 1800), ("m" * 500, 600)):
        got = documents.chunks(d, "id", F.lit("Fiche 1"), F.lit(meta).cast("string"), F.lit(None), F.col("n"), F.lit(None).cast("string"), F.lit("acte"), budget=budget).collect()
        for i, s in enumerate(stories):
            head, prefix = "Fiche 1" + (f"\n{meta}" if meta else ""), meta or "Fiche 1"
            body = [x.strip() for x in s]
            whole = "\n".join([head, *body])
            parts = [whole] if len(whole) <= budget else [f"{head if k == 0 else prefix}\n{x}" for k, x in enumerate(_segments(body, prefix + "\n", budget))]
            own = sorted((x for x in got if x.id == i), key=lambda x: x.chunk)
            assert [x.text for x in own] == [*parts, "acte"] and [x.kind for x in own] == ["sheet", *["long narrative"] * (len(parts) - 1), "action"]
    tight = documents.chunks(d.filter("id = 2"), "id", F.lit("Fiche 1"), F.lit("p" * 700), F.lit(None), F.array(F.lit("abc def")), F.lit(None).cast("string"), F.lit(None).cast("string"), budget=600).collect()
    assert [x.text[-1] for x in tight] == list("abcdef")  # no room: single characters go through


def test_upserts_touch_few_buckets_and_can_be_repeated(spark, tmp_path):
    import os

    schema_ = "k long, v string, at long"
    rows = [(i % 40, f"v{i}", i) for i in range(120)]
    for n in range(6):
        part = [r for r in rows if r[2] // 20 == n] if n < 5 else [(1, "last", 500)]
        spark.createDataFrame(part, schema_).coalesce(1).write.parquet(f"{tmp_path}/in/{n}")
    stream = spark.readStream.schema(schema_).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in/*")
    incremental.upsert_stream(stream, f"{tmp_path}/all", f"{tmp_path}/state", ["k"], "at", buckets=8).awaitTermination()
    want = {}
    for k, v, at in sorted(rows[:100] + [(1, "last", 500)], key=lambda r: r[2]):
        want[k] = (v, at)
    assert {r.k: (r.v, r.at) for r in incremental.newest(spark, f"{tmp_path}/all", schema_).collect()} == want
    kept = [(g, b) for g in os.listdir(f"{tmp_path}/all") for b in os.listdir(f"{tmp_path}/all/{g}") if b.startswith("bucket=")]
    assert max(sum(x == b for _, x in kept) for _, b in kept) <= 2 and len({b for _, b in kept}) == 8
    again = spark.readStream.schema(schema_).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in/*")  # every batch once more
    incremental.upsert_stream(again, f"{tmp_path}/all", f"{tmp_path}/state again", ["k"], "at", buckets=8).awaitTermination()
    assert {r.k: (r.v, r.at) for r in incremental.newest(spark, f"{tmp_path}/all", schema_).collect()} == want


# queries without SQL

def _table(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet").collect()


def test_hash_sample(spark):
    key = {r.doc_id: r.h for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", F.xxhash64("doc_id", F.lit(1)).alias("h")).collect()}
    assert {r.doc_id for r in catalogue.queries()["hash_sample"](spark, SF).collect()} == set(sorted(key, key=lambda i: (key[i], i))[:100])


def test_greedy_segments(spark):
    cut = lambda line: [x for x in _cut(line, 1800) if x]

    want = []
    for r in _table(spark, "documents"):
        now, k = None, 0
        for line in [p for x in r.text.split("\n") if x for p in cut(x)]:
            if now is not None and len(now) + 1 + len(line) <= 1800:
                now += "\n" + line
                continue
            if now is not None:
                want.append((r.doc_id, k, now))
                k += 1
            now = line
        want += [(r.doc_id, k, now)] if now is not None else []
    got = [(r.doc_id, r.segment, r.text) for r in catalogue.queries()["greedy_pack_segments"](spark, SF).collect()]
    assert sorted(got) == sorted(want)


def test_html_queries(spark):
    pages = _table(spark, "pages")
    plain = {r.page_id: r.text for r in catalogue.queries()["html_plain_text"](spark, SF).collect()}
    chunks = catalogue.queries()["html_to_text_chunks"](spark, SF).collect()
    for p in pages:
        body = re.sub(r"(?s)<(script|style|head|template)\b.*?</\1>", " ", p.html)
        words = re.sub(r"<[^>]*>", " ", body)
        import html as h
        assert "".join(plain[p.page_id].replace("- ", "").split()) == "".join(h.unescape(words).replace("- ", "").split())
        own = sorted((c.chunk, c.text, c.heading) for c in chunks if c.page_id == p.page_id)
        assert [c[0] for c in own] == list(range(len(own))) and all(len(c[1]) <= 1500 for c in own)
        heads = {b for k, b, _ in html.blocks(p.html) if k[0] == "h" and k[1:].isdigit()}
        assert "".join("".join(t for _, t, _ in own).split()) == "".join("".join(b for k, b, _ in html.blocks(p.html) if b not in heads or not (k[0] == "h" and k[1:].isdigit())).split())
        assert {t for *_, t in own if t} <= heads


def test_bootstrap_query(spark):
    r = catalogue.queries()["paired_bootstrap_ci"](spark, SF).first()
    assert r.low <= r.mean <= r.high and r.verdict == ("better" if r.low > 0 else "worse" if r.high < 0 else "equal")


def test_acronym_excerpts(spark):
    d = spark.createDataFrame([(1, "b", "x" * 90 + " ILS en   panne " + "y" * 90), (2, "a", "F.O.D vu, iso NP7"), (3, "a", "ÉTAT DE l'ILS")], "id long, field string, text string")
    got = {r.acronym: r for r in profile.acronym_dictionary(d, ["DE", "ILS", "ETAT"], protected=["ILS"], lower=["iso"]).collect()}
    assert set(got) == {"ILS", "FOD", "ISO", "NP7", "DE"} and got["DE"].reason == "common word" and got["ILS"].reason is None and got["NP7"].category == "with digits" and got["ISO"].category == "lower case"
    assert got["ILS"].n_docs == 2 and got["ILS"].excerpts[0].startswith("…x") and " ILS en panne y" in got["ILS"].excerpts[0] and got["ILS"].excerpts[1] == "ÉTAT DE l'ILS" and got["FOD"].spellings == "F.O.D:1"


def test_routes(spark):
    run = spark.createDataFrame([(1, "RECO", "recommandation", True), (2, "statistiques", "liste", False), (3, "liste", "recherche", False), (4, None, "liste", False), (5, "", "liste", False), (6, "liste", None, False), (7, "liste", "recherche", True), (8, "liste", "recherche", False)], "id int, chosen string, wanted string, ok boolean")
    by = spark.createDataFrame([(1, True), (2, True), (3, True), (4, True), (5, True), (6, False), (7, True)], "id int, ok boolean")
    got = {r.id: (r.right_route, r.misrouted, r.costly, r.ok_by_route) for r in audit.routed(run, by).collect()}
    assert got == {1: (True, False, False, True), 2: (True, False, False, True), 3: (False, True, True, True), 4: (None, False, False, True), 5: (False, True, True, True), 6: (False, True, False, False), 7: (False, True, False, True), 8: (False, True, False, None)}


def test_either_year(spark):
    got = one(spark, golden.either_year(F.col("t")), t="En 2024 OU 2025, 2019 ou 1999, 2020 ou 2021 et 2031 ou 2024 ?")
    assert [(x.first, x.second) for x in got] == [("2024", "2025"), ("2020", "2021")]
    assert one(spark, golden.either_year(F.col("t").cast("string")), t=None) == []


def test_extras(spark):
    rows = spark.createDataFrame([("a", "x", None), ("b", None, None)], "k string, rare string, more string")
    module = schema.Module("m", "k", (schema.Field("k", "k"),), ("rare", "more", "nowhere"))
    assert {r.k: r.extra_fields for r in schema.project(rows, module).collect()} == {"a": {"rare": "x"}, "b": {}}
    assert "extra_fields" not in schema.project(rows, schema.Module("m", "k", (schema.Field("k", "k"),))).columns
    assert schema.project(rows, schema.Module("m", "k", (schema.Field("k", "k"),), ("nowhere",))).first().extra_fields == {}
    off = {"module": "m", "identite": "k", "champs": [], "extras": {"enabled": False, "whitelist": ["rare"]}}
    assert schema.Module.parse(off).extras == ()


def test_ticket_records(spark):
    """Fields that raw tickets lack, structures of another type, empty and null texts, tickets without a number."""
    raw = spark.createDataFrame([("7", None, "", None, None, None, 3), (" ", "t", "d", None, None, None, 4), (None, "t", "d", None, None, None, 5), ("7", "t", "<p>" + "word " * 700 + "</p>", None, None, None, 6)], "numero_fe string, titre_nc string, detail_nc string, resume string, cause_nc string, resp_traitement_nc string, parent int")
    t = tickets.ticket_records(raw.withColumn("versioneffective", F.array().cast("array<string>")))
    rows = sorted(t.collect(), key=lambda r: r.titre)
    assert [r.numero_fe for r in rows] == ["7", "7"] and rows[0].ticket_id == rows[1].ticket_id == str(uuid.uuid5(tickets.TICKETS, "7"))
    assert rows[0].detail_chunks == [] and rows[0].parent_numero_fe is None and rows[0].urgence is None
    assert len(rows[1].detail_chunks) == 3 and " ".join(c.text for c in rows[1].detail_chunks) == ("word " * 700).strip()
    assert t.limit(0).count() == 0 and {n for n, _, _ in tickets.COPIED + tickets.MORE} <= set(t.columns)
