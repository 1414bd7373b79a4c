"""Files cut into blocks of a few bytes: records of any form come out as from the whole file."""

import csv
import io
import json
import random

import pytest

from orrery.sources import split_files

LISTS = [{"id": i, "t": t, "n": {"a": [{"b": i}, "}{", []]}} for i, t in enumerate(['x"}{[', "\\", "é\n]", "", 'a\\"b', "}" * 9, "{" * 7, "long " * 40] * 5)]


def _text(kind: str, items: list) -> str:
    indent = 2 if kind.endswith("indented") else None
    if kind.startswith("list"):
        return json.dumps([*items[:3], 7, "no } record", [{"id": -1}], *items[3:]], indent=indent, ensure_ascii=False)
    links = {"curies": [{"href": "no record"}], "self": {"href": "/"}}
    return json.dumps({"_links": links, "_embedded": {"other": [{"id": -2}], "module": items, "later": [{"id": -3}]}, "module": [{"id": -4}]}, indent=indent, ensure_ascii=False)


def _ids(rows):
    return sorted(json.loads(r.j)["id"] for r in rows.selectExpr("to_json(record) AS j").collect())


@pytest.mark.parametrize("kind", ["list", "list indented", "envelope", "envelope indented"])
@pytest.mark.parametrize("split", [97, 1 << 20])
def test_json(spark, tmp_path, kind, split):
    (tmp_path / "a.json").write_text(_text(kind, LISTS), encoding="utf-8")
    good, bad = split_files.json_records(spark, str(tmp_path), split=split)
    assert bad.count() == 0
    found = [json.loads(r.j) for r in good.selectExpr("to_json(record) AS j").collect()]
    assert sorted(found, key=lambda r: r["id"]) == LISTS


def test_json_is_read_by_many_tasks(spark, tmp_path):
    (tmp_path / "a.json").write_text(_text("list", LISTS * 4), encoding="utf-8")
    good, _ = split_files.json_records(spark, str(tmp_path), split=500)
    assert good.select("start").distinct().count() > 10


def test_json_damage(spark, tmp_path):
    """Balanced damage costs one record; a lone backslash is mended; a file that ends early keeps what came before."""
    items = [json.dumps({"id": i, "t": "x" * 30}) for i in range(20)]
    (tmp_path / "a.json").write_text("[" + ", ".join([*items[:5], '{"id": , "t": 1}', '{"id": 100, "t": "C:\\dir\\}"}', *items[5:10]]) + "]")
    (tmp_path / "b.json").write_text("[" + ", ".join(items[10:]) + ', {"id": 7')
    (tmp_path / "c.json").write_text("")
    (tmp_path / "d.json").write_text("[]\n")
    (tmp_path / "e.json").write_text("\ufeff [{\"id\": 50}]\n", encoding="utf-8")
    for split in (41, 1 << 20):
        good, bad = split_files.json_records(spark, str(tmp_path), split=split)
        assert _ids(good) == [*range(20), 50, 100]
        assert sorted(r.text for r in bad.collect()) == ['{"id": , "t": 1}', '{"id": 7']


@pytest.mark.parametrize("encoding", ["utf-8", "iso-8859-1"])
def test_csv(spark, tmp_path, encoding):
    rng = random.Random(5)
    cells = ["", "é", 'say "x"', "a;b", "two\nlines", '"', "\n\n", ';"\n"', "plain", 'in"side', "word " * 30]
    rows = [[str(i), *(rng.choice(cells) for _ in range(3))] for i in range(200)]
    out = io.StringIO()
    w = csv.writer(out, delimiter=";", lineterminator="\r\n")
    w.writerow(["id", "é\nx", "a", "a"])
    w.writerows(rows)
    text = out.getvalue() + '300;in"side;x;y;extra\n301;short\n\n'
    want = {tuple(r) for r in rows} | {("300", 'in"side', "x", "y"), ("301", "short", None, None)}
    (tmp_path / "a.csv").write_bytes(text.encode(encoding))
    for split in (61, 1 << 20):
        good, bad = split_files.csv(spark, str(tmp_path), encoding, split=split)
        assert good.columns == ["id", "é\nx", "a", "a #2"] and bad.count() == 0
        found = [tuple(r) for r in good.collect()]
        assert len(found) == len(want) and set(found) == want


def test_csv_open_quote_and_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text('\ufeffa;b\n1;2\n3;"never\nclosed\n', encoding="utf-8")
    for split in (7, 1 << 20):
        good, bad = split_files.csv(spark, str(tmp_path), split=split)
        assert [tuple(r) for r in good.collect()] == [("1", "2")] and [r.text for r in bad.collect()] == ['3;"never\nclosed']
        assert good.columns == ["a", "b"]
    (tmp_path / "b.csv").write_text("a;c\n1;2\n")
    with pytest.raises(ValueError):
        split_files.csv(spark, str(tmp_path))


def test_more_blocks_than_are_broadcast(spark, tmp_path):
    (tmp_path / "a.json").write_text(_text("envelope", LISTS), encoding="utf-8")
    t = split_files.records(spark, str(tmp_path), split_files.JsonFormat(), split=211, states=0)
    assert sorted(json.loads(r.text)["id"] for r in t.collect()) == [x["id"] for x in LISTS]
