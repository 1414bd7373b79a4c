"""License scans against a plain search over every start, and on edge cases."""

import random
from collections import Counter

import pytest
from orrery.llm import licenses as lic

K = 5


def _plain(text, templates):
    """Every match by trying all starts with word tuples; no windows, hashes or bands."""
    raw, at, out = text.split(), 0, []
    words, places = [], []
    for w in raw:
        start = text.index(w, at)
        at = start + len(w)
        if p := lic.plain(w):
            words.append(p)
            places.append((start, at))
    doc = [tuple(words[i : i + K]) for i in range(len(words) - K + 1)]
    for name, template in templates.items():
        tw = [p for w in template.encode().split() if (p := lic.plain(w))]
        wanted = {tuple(tw[i : i + K]) for i in range(len(tw) - K + 1)}
        n = len(wanted)
        span, p = max(n + n // 4, len(tw) - K + 1), 0
        while p < len(doc):
            hits = [i for i in range(p, min(p + span, len(doc))) if doc[i] in wanted] if doc[p] in wanted else []
            found = len({doc[i] for i in hits})
            if found and found * 5 >= 4 * n:
                out.append((name, places[p][0], places[hits[-1] + K - 1][1], found, n))
                p = hits[-1] + K
            else:
                p += 1
    return Counter(out)


def _rows():
    r = random.Random(3)
    filler = [a + b for a in ("ze", "mo", "été", "the", "license") for b in ("", "x", "y,", "(q)")]
    rows, names = [], list(lic.TEMPLATES)
    for i in range(240):
        words = [r.choice(filler) for _ in range(r.randrange(80))]
        for _ in range(r.randrange(3)):
            t = lic.TEMPLATES[r.choice(names)].split()
            for _ in range(r.choice((0, 0, 1, len(t) // 40, len(t) // 20))):
                t[r.randrange(len(t))] = "other"
            t = t if r.random() < 0.6 else [w.upper() + "," for w in t]
            at = r.randrange(len(words) + 1)
            words[at:at] = t + (["#", "*"] if i % 2 else [])
        rows.append((i, r.choice((" ", "\n# ", "  ")).join(words)))
    apache = lic.TEMPLATES["Apache-2.0 notice"]
    rows += [(1000 + i, rows[7][1]) for i in range(5)] + [rows[7], rows[7], (None, apache), (None, None), (2000, None), (2001, ""), (2002, " \t\n"), (2003, "a b c d"), (2004, "* # |")]
    rows += [(3000, "word " * 50_000 + apache + " word" * 300), (3001, (apache + " ") * 400), (3002, "x" * 300_000 + " " + apache)]
    return rows


def test_scan_against_every_start(spark):
    rows = _rows()
    docs = spark.createDataFrame([(i, t, "a", "b", "c") for i, t in rows], "doc_id long, text string, license string, matched string, _text string").repartition(3)
    got = lic.scan_licenses(docs).collect()
    want = Counter()
    for i, t in rows:
        for (name, *rest), n in _plain((t or "").encode(), lic.TEMPLATES).items():
            want[i, name, *rest] += n
    assert Counter((r.doc_id, r.license, r.start_byte, r.end_byte, r.found, r.shingles) for r in got) == want
    texts = dict(rows)
    assert all(r.matched == texts[r.doc_id].encode()[r.start_byte : r.end_byte].decode() for r in got if r.doc_id is not None)
    assert all(r.containment == r.found / r.shingles and r.containment >= 0.8 for r in got)
    assert len({r.license for r in got}) == len(lic.TEMPLATES) and any(r.containment < 1 for r in got)
    split = lic.scan_licenses(docs, group_bytes=600).collect()
    assert Counter(split) == Counter(got)


def test_blocks_of_long_texts(monkeypatch):
    monkeypatch.setattr(lic, "BLOCK", 37)
    index = lic.TemplateIndex(lic.TEMPLATES)
    for _, t in _rows()[:120]:
        got = Counter((index.names[k], a, b, n, len(index.shingles[k])) for k, a, b, n in index.scan((t or "").encode()))
        assert got == _plain((t or "").encode(), lic.TEMPLATES)


def test_band_settings():
    for similarity in (0.3, 0.45, 0.8):
        b = lic.bands_for(similarity)
        assert (1 - similarity**2) ** b <= lic.MISS < (1 - similarity**2) ** (b - 1)
    index = lic.TemplateIndex(lic.TEMPLATES)
    for width, stride, _, members in index.classes:
        assert all(width >= index.span[t] + stride - 1 for t in members)


def test_empty_and_short(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert lic.scan_licenses(empty).count() == 0
    assert lic.scan_licenses(spark.createDataFrame([(1, "a")], "doc_id long, text string"), {}).count() == 0
    with pytest.raises(ValueError):
        lic.TemplateIndex({"short": "All rights reserved."})
