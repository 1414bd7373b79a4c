"""Every registered query against its SQL on the smallest tables, and small tables of literal rows for the operators."""

import datetime
import os
import uuid

import duckdb
import pytest
from pyspark.sql import functions as F

from orrery.functions import places, scalars, text
from orrery.operators import audit, documents, evaluation, graph, html, profile, search
from orrery.plans import catalogue, schema
from orrery.sources import readers, sinks
from orrery.streaming import incremental

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in os.listdir(SF):
        con.execute(f"CREATE VIEW {t.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{t}'")
    return con


def _key(row):
    return tuple(str(float(x)) if isinstance(x, (int, float)) and not isinstance(x, bool) else str(x) for x in row)


@pytest.mark.parametrize("name", sorted(catalogue.queries()))
def test_query(spark, db, name):
    df = catalogue.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    if name not in catalogue.oracle_sql():
        assert df.columns
        return
    cur = db.execute(catalogue.oracle_sql()[name])
    names, want = [d[0] for d in cur.description], cur.fetchall()
    assert sorted(names) == sorted(df.columns)
    order = sorted(names)
    assert sorted(_key(r[df.columns.index(c)] for c in order) for r in rows) == sorted(_key(r[names.index(c)] for c in order) for r in want)


def one(spark, c, **values):
    row = spark.createDataFrame([tuple(values.values()) or (1,)], ", ".join(f"{k} {'array<string>' if isinstance(v, list) else 'long' if isinstance(v, int) else 'string'}" for k, v in values.items()) or "x int")
    return row.select(c.alias("r")).first().r


def test_text(spark):
    t = F.col("t")
    assert one(spark, text.fold(t), t="  Été\tÀ  l'Ouest é ") == "ete a l'ouest e"
    assert one(spark, text.title_key(t, [("aeronefs", "aeronef")]), t="Aéronefs, (2)") == "aeronef 2"
    assert one(spark, text.meaningful(t), t=" RAS ") is None and one(spark, text.meaningful(t), t=" a  b ") == "a b"
    assert one(spark, text.label_key(t), t="Objet<br/> : ") == "objet"
    assert one(spark, text.plausible_label(t), t="voir http://x") is False
    assert one(spark, text.claimed_numbers(t, "fiches?|cas"), t="12 fiches et 3 cas, 5 autres") == [12, 3]
    assert one(spark, text.overlap(F.col("n"), t), n="abc de xyz", t="xabcx") == 0.5
    assert one(spark, text.excerpt(t, F.lit("mid"), 2), t="abcmiddef") == "bcmidde"
    assert one(spark, text.acronyms(t), t="F.O.D et ASMGCS, pas Abc ni X") == ["FOD", "ASMGCS"]
    assert one(spark, text.scrub(t, {"Jean Petit": "Agent_001"}), t="Jean Petit, j.p@ex.org, 06 12 34 56 78") == "Agent_001, [email], [tel]"
    assert one(spark, text.denoise(t), t="vu 01/02/2020 10:30\nAB :\nfait") == "vu fait"
    assert one(spark, text.summary_fault(t), t="court") == "too short"
    assert one(spark, text.light_html(t), t="a<br>b &amp; <b>c</b>") == "a\nb & c"
    assert one(spark, text.split_operators(t), t="A1<br>• B2\nx") == ["A1", "B2"]
    assert one(spark, text.fill_template("A: {a}\nB: {b}", a=t, b=F.lit(None).cast("string")), t="x") == "A: x"
    assert one(spark, text.ascii_fold(t), t="N°é") == "Ne"
    assert one(spark, text.noise_line(t, ["Page"]), t="![x](y.png)") is True
    assert one(spark, text.alias(t, {"a": "b"}), t="a") == "b" and one(spark, text.identifier(t), t="a-b c") == "a_b_c"


def test_scalars(spark):
    t = F.col("t")
    ns = uuid.uuid4()
    for name in ("", "été", "x" * 90):
        assert one(spark, scalars.uuid5(ns, t), t=name) == str(uuid.uuid5(ns, name))
    d = datetime.date
    for s, want in (("10 mars 2026", d(2026, 3, 10)), ("1er août 2020", d(2020, 8, 1)), ("10 / 03 / 2026", d(2026, 3, 10)), ("31/02/2020", None), ("rien", None)):
        assert one(spark, scalars.french_date(t), t=s) == want
    assert one(spark, scalars.iso_or_raw(t), t="03/04/2020") == "2020-04-03" and one(spark, scalars.iso_or_raw(t), t=" bientôt ") == "bientôt"
    assert one(spark, scalars.tri_state(t), t="oui - x") is True and one(spark, scalars.tri_state(t), t="0") is None
    assert one(spark, scalars.two_state(t), t="0") is False and one(spark, scalars.two_state(t), t="Vrai") is True
    assert one(spark, scalars.multi_valued(t), t=" a|b| a |") == ["a", "b"]
    assert one(spark, scalars.not_zero(t), t="x") is False and one(spark, scalars.not_zero(t), t="2") is True
    assert one(spark, scalars.year_of(t, 2000, 2026), t="vers 1999") is None
    assert one(spark, scalars.parse_date(t, scalars.DAY_FIRST).cast("string"), t="03/04/2020") == "2020-04-03 00:00:00"
    assert one(spark, F.to_json(scalars.tolerant_json(t)), t='texte {"a": "b\\q"} fin') == '{"a":"b\\\\q"}'
    low, high = scalars.wilson(F.lit(7.0), F.lit(100.0))
    assert one(spark, F.round(low, 4)) == 0.0343 and one(spark, F.round(high, 4)) == 0.1375
    assert one(spark, scalars.enum_or(t, ["a"], "z"), t="b") == "z"


def test_places(spark):
    assert one(spark, places.runways_asked(F.col("t")), t="axe 17L/35R svp") == ["17L", "35R"]
    a, b = places.first_runway_or_stand(F.lit("C83"), F.lit("piste 36L"))
    assert one(spark, a) == "36L" and one(spark, b) is None
    r = one(spark, places.normalise(F.col("t"), F.lit("Lyon Bron")), t="99L")
    assert r.runway_current is None and "unknown" in r.anomaly and one(spark, places.normalise(F.col("t"), F.lit("?")), t="x").aerodrome is None


def test_documents(spark):
    lines = F.col("t")
    assert one(spark, documents.pack_lines(lines, 5), t=["aa", "bb", "cccc", "d"]) == ["aa\nbb", "cccc", "d"]
    assert one(spark, documents.cut_lines(lines, 4), t=["ab cd efghij"]) == ["ab", "cd", "efgh", "ij"]
    assert one(spark, documents.merge_short(lines, 3), t=["a", "bbbb", "c", "d"]) == ["a", "bbbb\nc\nd"]
    assert one(spark, documents.pack_lines(lines, 5), t=[]) == []
    d = spark.createDataFrame([(1, "before\n## A 1\nx\n## B 2\ny")], "id long, t string")
    assert [(r.header, r.body) for r in documents.thread(d, "t", "## [A-Z] [0-9]").orderBy("entry").collect()] == [(None, "before"), ("## A 1", "x"), ("## B 2", "y")]
    md = spark.createDataFrame([(1, "| Objet | Bruit |\n|---|---|\n| | suite |\n| Inconnu | z |\n| | perdu |\n| Date | 2020 |\n\n" + "fin " * 30)], "id long, t string")
    got = documents.bulletin_fields(documents.table_rows(md, "t"), ["id"], aliases={"objet": "object", "date": "date"})
    assert {(r.field, r.extra): r.value for r in got.collect()} == {("object", False): "Bruit\n\nsuite", ("inconnu", True): "z", ("date", False): "2020"}
    assert md.select(documents.after_tables(F.col("t")).alias("r")).first().r == ("fin " * 30).strip()
    version, when = documents.version_footer(F.lit("Version n°3 du 10 février 2024"))
    assert one(spark, version) == 3 and one(spark, when) == "10 février 2024"
    assert one(spark, documents.replaced(F.col("t")), t="remplace l'IS 2019/4 et Remplace 2019/04") == ["2019/04"]
    assert one(spark, documents.relation(F.col("t")), t=["b", "a", "b"]) == "b, a"


def test_html(spark):
    page = "<style>x</style><h1>T&eacute;</h1>lead<p>a<br>b</p><blockquote><p>in</p></blockquote><ul><li>i</li></ul>"
    assert html.blocks(page) == [("h1", "Té", "Té"), ("text", "lead", "Té"), ("p", "a\nb", "Té"), ("p", "in", "Té"), ("li", "- i", "Té")]
    d = spark.createDataFrame([(1, "<p>" + "mot " * 1000 + "</p><p>x</p>"), (2, None), (3, "")], "id long, h string")
    got = html.chunks(d, "h", "id").collect()
    assert {r.id for r in got} == {1} and all(len(r.text) <= 1500 for r in got) and sum(r.text.count("mot") for r in got) == 1000


def test_graph(spark):
    old = spark.createDataFrame([(1, "a", None, 1), (2, "b", "x", 1)], "k long, v string, w string, t long")
    new = spark.createDataFrame([(1, None, "y", 2), (3, "c", None, 2)], "k long, v string, w string, t long")
    once = graph.upsert(old, new, ["k"], "t", keep_old=("w",))
    assert sorted(map(tuple, once.collect())) == [(1, "a", "y", 2), (2, "b", "x", 1), (3, "c", None, 2)]
    assert sorted(map(tuple, graph.upsert(once, new, ["k"], "t", keep_old=("w",)).collect())) == sorted(map(tuple, once.collect()))
    a, b = (spark.createDataFrame([(x,) for x in xs], "property string") for xs in ("ab", "bc"))
    assert sorted(map(tuple, graph.property_differences(a, b).collect())) == [("a", True, False), ("b", True, True), ("c", False, True)]


def test_profile_and_evaluation(spark):
    stats = spark.createDataFrame([("s", 9, 0.4, 3), ("t", 7, 0.9, 9)], "f string, n long, rate double, structured long")
    assert [r.usable for r in profile.grounds(stats).orderBy("f").collect()] == [True, False]
    v = spark.createDataFrame([("a", 0.5, -0.1, 0.4), ("b", 0.49, -0.05, 0.3), ("c", 0.2, 0.1, 0.1)], "variant string, recall double, low_delta double, homogeneity double")
    assert evaluation.choose(v).first().variant == "b"
    assert one(spark, evaluation.admissible(F.array(F.lit("a")), F.col("t")), t=["a", "b"]) == "kept"
    d = spark.createDataFrame([(i, 1.0 + i % 3) for i in range(60)], "id long, d double")
    r = evaluation.bootstrap(d, "d", 400).first()
    assert r.low < r.mean < r.high and r.verdict == "better" and r == evaluation.bootstrap(d, "d", 400).first()
    assert one(spark, audit.example_rate(F.lit(2), 10, F.lit(4), F.lit(0))) == 0.0
    first, top = audit.ranking_matches(F.array(F.lit("a"), F.lit("b")), F.array(F.lit("b"), F.lit("a")))
    assert one(spark, first) is False and one(spark, top) is True
    assert one(spark, audit.fact_present(F.lit("periode"), F.lit("x"), F.array(F.lit("alpha beta")), F.lit("Alpha")))


def test_schema(spark):
    config = {"module": "m", "identite": "num", "champs": [
        {"cle": "num", "label": "Num F.E.", "requis": True}, {"cle": "titre", "label": "Titre", "embedding": True, "min_length": 3}, {"cle": "le", "label": "Date", "role": "date", "type": "date"},
        {"cle": "axe", "label": "Axe", "role": "flag"}, {"cle": "n", "label": "N", "type": "entier", "filtre_vide": ["0"]}, {"cle": "types", "label": "Types", "role": "relation", "noeud": "Type", "cle_noeud": "nom", "relation": "OF"}]}
    m = schema.Module.parse(config)
    raw = spark.createDataFrame([(2, "1", "deux", "03/04/2020", "oui x", "0", "a|b"), (1, "1", "un", "?", "non", "x", None), (3, " ", "t", None, None, "5", "")], "position long, `Num F.E.` string, Titre string, Date string, Axe string, N string, Types string")
    (r,) = schema.project(raw, m).collect()
    assert (r.num, r.titre, r.le, r.axe, r.n, r.entities) == ("1", "un", None, False, None, [])
    (r,) = schema.project(raw.filter("position = 2"), m).collect()
    assert (r.le, r.axe, r.n, [e.value for e in r.entities]) == (datetime.date(2020, 4, 3), True, None, ["a", "b"])
    assert schema.missing_fields(m, ["num", "titre"]) == ["le", "axe", "n"]
    assert [x.text for x in schema.texts(schema.project(raw.filter("position = 2"), m), m, "num").collect()] == ["deux"]
    assert schema.schema_table(spark, m).count() == 6
    assert one(spark, schema.is_test_record(F.col("t")), t="Postman x") is True


def test_sources(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"_embedded": {"module": [{"_id": 1, "t": "a"}, 5]}}')
    (tmp_path / "b.json").write_text('[{"_id": 2, "t": "x\\q"}]')
    (tmp_path / "c.json").write_text("not json")
    got = readers.typed_json(spark, str(tmp_path / "*.json"), "_id long, t string").collect()
    assert sorted((r._id, r.t) for r in got) == [(1, "a"), (2, "x\\q")]
    (tmp_path / "p.csv").write_bytes("id;titre;titre;é\nIdentifiant;Titre;x;y\n7;abc;d\n8;;e;f\n".encode("latin-1"))
    t = readers.csv(spark, str(tmp_path / "p.csv"), "ISO-8859-1")
    assert t.columns == ["id", "titre", "titre #2", "é"] and t.count() == 3
    assert [r.id for r in readers.projects(spark, str(tmp_path / "p.csv"), "id", "titre").collect()] == ["7"]
    assert readers.indexed_csv(spark, str(tmp_path / "p.csv"), {"e": "É"}).columns == ["e"]
    with pytest.raises(ValueError):
        readers.indexed_csv(spark, str(tmp_path / "p.csv"), {"e": "absent"})
    (tmp_path / "m.csv").write_text("login;nom\na;A\na;B\nb;\n")
    assert [tuple(r) for r in readers.mapping(spark, str(tmp_path / "m.csv"), "login", "nom").collect()] == [("a", "B")]
    (tmp_path / "is_2020_03.md").write_text("x")
    (tmp_path / "other.md").write_text("x")
    assert [(r.year, r.number) for r in readers.markdown(spark, str(tmp_path)).collect()] == [(2020, 3)]
    (tmp_path / "pool.txt").write_text("1|||a|||b|||c\n1|||z|||b|||c\nbad|||x\n")
    assert [(r.id, r.title) for r in readers.pool(spark, str(tmp_path / "pool.txt")).collect()] == [("1", "a")]
    rows = spark.createDataFrame([(1, 2, "corrective", "x", "second"), (1, 1, "curative", "y", "first")], "id long, at long, kind string, action string, s string")
    r = readers.grouped_actions(rows, "id", "at", "kind", ["action"], ["s"]).first()
    assert (r.s, [a.action for a in r.corrective], [a.action for a in r.curative], r.preventive) == ("first", ["x"], ["y"], [])


def test_sinks_and_resume(spark, tmp_path):
    d = spark.createDataFrame([(1, "a", [1]), (2, None, None)], "id long, k string, l array<int>")
    df, seen = sinks.counted(d, "c", missing=F.col("k").isNull())
    sinks.save(df, str(tmp_path / "t"))
    assert seen.get == {"rows": 2, "missing": 1}
    sinks.ensure(d.limit(0), str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 2
    assert [r.p for r in d.select(sinks.props_of(d, ["id"]).alias("p")).orderBy("id").collect()] == [{"k": "a", "extra_l": "[1]"}, {}]
    assert [r.id for r in incremental.resume(d, d.filter("id = 1"), "id").collect()] == [2]
    assert sinks.report(d.select("id"), "R").startswith("## R")
    assert readers.points(spark, str(tmp_path / "t"), "id = 1").count() == 1
