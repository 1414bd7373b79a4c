"""Light HTML with its patterns left aside where they can't match, against all patterns in turn."""

import random

from orrery.functions import text
from orrery.plans import catalogue, tickets
from pyspark.sql import functions as F


def _plain(c):
    out = F.regexp_replace(F.regexp_replace(c, r"(?i)<br\s*/?>", "\n"), r"<[^>]*>", " ")
    for a, b in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&amp;", "&")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return text.strip(F.regexp_replace(F.regexp_replace(out, r"[ \t]+", " "), r" *\n *", "\n"))


def test_light_html_against_all_patterns(spark):
    r = random.Random(3)
    bits = ["a", "é", " ", "  ", "\t", "\n", "\r", "\x0b", "\x0c", "\u00a0", "\u0085", "\u2028", "<br>", "<BR />", "<b>", "</b>", "<", ">", "&nbsp;", "&amp;lt;", "&lt;br&gt;", "\U0001f600"]
    rows = [(i, "".join(r.choice(bits) for _ in range(r.randrange(0, 9)))) for i in range(3000)] + [(5000, None), (5001, ""), (5002, " " * 50)]
    t, got, want = F.col("t"), F.col("got"), F.col("want")
    d = spark.createDataFrame(rows, "id long, t string").select("t", text.light_html(t).alias("got"), _plain(t).alias("want"), text.stripped(t).alias("got2"), text.strip(t).alias("want2"))
    assert d.filter(~got.eqNullSafe(want) | ~F.col("got2").eqNullSafe(F.col("want2"))).collect() == []
    g = d.select(tickets.gated(got, 3, 5).alias("a"), F.when(F.length(want) >= 3, F.left(want, F.lit(5))).alias("b"))
    assert g.filter(~F.col("a").eqNullSafe(F.col("b"))).count() == 0


def test_texts_are_worked_out_once_and_by_many_tasks(spark):
    wide = catalogue.queries()["wide_ticket_projection"](spark, "/root/testdata/sf0.1")
    plan = wide._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("<[^>]*+>") == 2 and wide.rdd.getNumPartitions() >= 15
