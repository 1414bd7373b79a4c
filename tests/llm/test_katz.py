"""The language model against a plain version with dictionaries."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from orrery.llm import katz

from .test_ops import SCHEMA, _rows


def _plain(rows):
    text = [[*(t or "").encode().lower().split(), None] for _, t, *_ in rows]
    held = [zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0 for i, *_ in rows]
    c1, c2 = Counter(), Counter()
    for words, h in zip(text, held):
        if not h:
            c1.update(words)
            c2.update(zip(["start", *words], words))
    n, v = sum(c1.values()), len(c1)
    of = lambda c: [Counter(c.values()).get(r, 0) for r in range(katz.DISCOUNTED + 2)]
    d1, d2 = katz.discounts(of(c1)), katz.discounts(of(c2))
    d = lambda t, r: t[r] if r <= katz.DISCOUNTED else 1.0
    left = n - sum(d(d1, c) * c for c in c1.values())
    total = n + (left <= 1e-12)
    p1 = {w: d(d1, c) * c / total for w, c in c1.items()}
    unknown = 1 - sum(p1.values())
    after = defaultdict(dict)
    for (h, w), c in c2.items():
        after[h][w] = c

    def chance(w, h):
        if h not in after:
            return p1.get(w, unknown)
        seen = after[h]
        count = sum(seen.values())
        mass = sum(d(d2, c) * c for c in seen.values())
        count += count - mass < 1e-9
        if w in seen:
            return d(d2, seen[w]) * seen[w] / count
        return (1 - mass / count) / (1 - sum(p1[x] for x in seen)) * p1.get(w, unknown)

    scores = []
    for (i, *_), words, h in zip(rows, text, held):
        base = sum(math.log10((c1[w] + 0.1) / (n + 0.1 * (v + 1))) for w in words)
        score = sum(math.log10(chance(w, x)) for x, w in zip(["start", *words], words))
        scores.append((i, h, len(words), sum(w in c1 for w in words), n, base, score))
    return scores, chance, c1, after


@pytest.mark.parametrize("block,bucket,common", [(12 << 20, 2_000_000, 2000), (600, 300, 20)])
def test_scores(spark, block, bucket, common):
    rows = _rows()
    got = katz.fit_and_score(spark.createDataFrame(rows, SCHEMA).repartition(2), block=block, bucket=bucket, common_share=common).collect()
    key = lambda x: (str(x[0]), *x[1:5], round(x[5], 4))
    for a, b in zip(sorted(map(tuple, got), key=key), sorted(_plain(rows)[0], key=key), strict=True):
        assert a[:5] == b[:5] and np.allclose(a[5:], b[5:])


def test_plain_version_adds_up_to_one():
    _, chance, c1, after = _plain(_rows())
    for h in list(after)[:40] + ["never seen"]:
        assert sum(chance(w, h) for w in [*c1, "an unknown word"]) == pytest.approx(1)


def test_empty_table(spark):
    assert katz.fit_and_score(spark.createDataFrame([], SCHEMA)).count() == 0
