"""Links by title: each once, dealt into tasks, never shuffled as pairs."""

from collections import Counter

from orrery.operators import graph


def test_links_of_several_titles_come_once_from_many_tasks(spark):
    rows = [(i, t) for i in range(60) for t in ((" a", "b ") if i % 3 else ("a", "a "))] + [(None, "a"), (None, "b"), (7, ""), (8, None), (9, "z")]
    targets = [(100 + i, t) for i in range(40) for t in (("a", "b", "b") if i % 2 else ("b", " "))] + [(None, "a"), (200, "y")]
    own = {(k, t.strip()) for k, t in rows if t and t.strip()}
    want = {(k, x) for k, t in own for x, u in targets if u.strip() == t}
    a, b = spark.createDataFrame(rows, "k long, t string"), spark.createDataFrame(targets, "x long, u string")
    for links in (graph.LINKS, 300):
        got = graph.title_links(a, "k", "t", b, "x", "u", links)
        assert Counter(map(tuple, got.collect())) == Counter(want)
    assert got.rdd.getNumPartitions() >= 8
    assert graph.title_links(a.limit(0), "k", "t", b, "x", "u").count() == 0
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan.split("Join Inner")[0] and "Aggregate" not in plan.split("Join Inner")[0]  # nothing gathers the pairs
