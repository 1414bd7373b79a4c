"""License scans of copies that follow each other closely."""

import pytest
from orrery.llm import licenses as lic

INDEX = lic.TemplateIndex(lic.TEMPLATES)


def _spans(text, name):
    t = INDEX.names.index(name)
    return [(a, b, n) for k, a, b, n in INDEX.scan(text.encode()) if k == t]


@pytest.mark.parametrize("name", list(lic.TEMPLATES))
@pytest.mark.parametrize("between", [" ", "\n\nCopyright (c) 2020 Some Body\n\n"])
@pytest.mark.parametrize("copies", [2, 5])
def test_adjacent_copies(name, between, copies):
    one, n = lic.TEMPLATES[name], len(INDEX.shingles[INDEX.names.index(name)])
    step = len((one + between).encode())
    got = _spans(between.join([one] * copies), name)
    assert [(a, n_found) for a, _, n_found in got] == [(i * step, n) for i in range(copies)]
    ends = [i * step + len(one.encode()) for i in range(copies)]
    assert all(b in (e, e - 1) for (_, b, _), e in zip(got, ends))


def test_cut_copy_before_a_whole_one():
    words = lic.TEMPLATES["MIT"].split()
    n = len(INDEX.shingles[INDEX.names.index("MIT")])
    text = " ".join(words[-40:] + words)
    assert _spans(text, "MIT") == [(len(" ".join(words[-40:])) + 1, len(text), n)]


def test_moved_half_still_counts():
    words = lic.TEMPLATES["MIT"].split()
    half = len(words) // 2
    (found,) = _spans(" ".join(words[half:] + words[:half]), "MIT")
    assert found[2] == len(INDEX.shingles[INDEX.names.index("MIT")]) - 4
