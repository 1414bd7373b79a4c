"""Search in blocks against the search by pairs: ties, nulls, NaN, odd lengths, many blocks; separation without pairs."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest
from orrery.operators import search, vector_blocks
from orrery.plans import catalogue
from pyspark.sql import functions as F

CORPUS, QUERIES = "id long, owner int, embedding array<float>", "query_id long, q array<float>, wanted int"


def _tables(spark, odd=True, seed=1):
    r = random.Random(seed)
    some = [[r.choice([-1.0, 0.5, 0.25, 2.0]) for _ in range(5)] for _ in range(25)]
    rows = [(i, r.choice([1, 2, 3, 4, None]), list(r.choice(some))) for i in range(300)]
    rows += [(None, 1, some[0]), (7, 2, some[1])]
    if odd:
        rows += [(400, 1, None), (401, 2, [1.0, None, 2.0, 3.0, 4.0]), (402, 3, [0.0] * 5), (403, 1, [1e-9] * 5), (404, 2, [1.0, 2.0]), (405, 4, [float("nan")] * 5), (406, 9, None)]
    c = spark.createDataFrame(rows, CORPUS).repartition(3).cache()
    asks = [(i, e, o) for i, o, e in rows if i is None or i % 20 == 0 or i > 399]
    return spark.createDataFrame(asks, QUERIES).cache(), c


def _key(r):
    return tuple((1, 0) if v is None else (2, 0) if isinstance(v, float) and math.isnan(v) else (0, v) for v in r)


def _same(a, b):
    assert sorted(map(_key, a.select(*b.columns).collect())) == sorted(map(_key, b.collect())) and b.count() > 20


@pytest.fixture(params=[(512, 2048), (4, 40)])
def sizes(request, monkeypatch):
    monkeypatch.setattr(vector_blocks, "ROWS", request.param[1])
    return request.param[0]


@pytest.mark.parametrize("digits", [9, 1])
def test_best_rows_and_owners(spark, sizes, digits):
    q, c = _tables(spark)
    pairs = search.scores(q, c).filter("id <> query_id")
    told = pairs.withColumn("relevant", (F.col("owner") == F.col("wanted")).cast("int"))
    _same(vector_blocks.top_rows(q, c, 6, digits, per_block=sizes), search.top_rows(told, 6, digits).select("query_id", "id", "owner", "relevant", "score", "rank"))
    near = told.filter("owner div 2 = wanted div 2")
    _same(vector_blocks.top_rows(q.withColumn("h", F.expr("wanted div 2")), c.withColumn("h", F.expr("owner div 2")), 6, digits, "h", sizes), search.top_rows(near, 6, digits).select("query_id", "id", "owner", "score", "rank"))
    _same(vector_blocks.owner_scores(q, c, digits, per_block=sizes), pairs.groupBy("query_id", "owner").agg(F.round(F.max("score"), digits).alias("score")))
    _same(vector_blocks.owner_scores(q, c, digits, 2, sizes), search.top_owners(pairs, 2, digits))


def test_judged_with_deep_hits(spark, sizes):
    q, c = _tables(spark, odd=False)
    told = search.scores(q, c).filter("id <> query_id")
    for k in (2, 30):
        rows, truth = vector_blocks.judged(q, c, k, per_block=sizes)
        want, n = search.judged(told, F.col("owner") == F.col("wanted"), k)
        _same(rows, want)
        assert sorted(map(_key, truth.collect())) == sorted(map(_key, n.collect()))
        assert rows.filter(F.col("rank") > k).count() > 0 or k > 2


def test_nothing_but_ties_stays_small(spark, monkeypatch):
    """All vectors are equal, so that all pairs tie: each query keeps its k smallest ids."""
    seen, real = [], vector_blocks._Best.cut
    monkeypatch.setattr(vector_blocks._Best, "cut", lambda self: seen.append(len(t := real(self))) or t)
    best = vector_blocks._Best(3, 4, 9)
    for i in range(40):
        best.add(np.full((3, 5000), 0.5), pa.array(range(i * 5000, i * 5000 + 5000)), {})
    assert best.cut()["_key"].to_pylist() == [0, 1, 2, 3] * 3 and max(seen) <= 24


@pytest.mark.parametrize("odd", [False, True])
def test_separation(spark, odd):
    q, c = _tables(spark, odd)
    if odd:
        q, c = (d.filter(f"{i} is null or {i} <> 405") for d, i in ((q, "query_id"), (c, "id")))  # NaN makes both NaN
    pairs, inside = search.scores(q, c).filter("id <> query_id"), F.col("owner") == F.col("wanted")
    want = pairs.agg(F.avg(F.when(inside, F.col("score"))) - F.avg(F.when(~inside, F.col("score")))).first()[0]
    assert search.separation(q, c).first()[0] == pytest.approx(want, abs=1e-12)
    assert search.separation(q.limit(0), c).first()[0] is None


@pytest.mark.parametrize("name", ["vector_topk_distinct_owner", "owner_max_score", "multiplicity_bias", "filter_then_rank_gain", "class_separation"])
def test_vectors_meet_packed_or_not_at_all(spark, name):
    plan = catalogue.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "Cross" not in plan if name == "class_separation" else "q_numbers" in plan and "lambda" not in plan
