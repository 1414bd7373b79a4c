"""Threads in event time and counted ingestion, run over files that come in several runs."""

import datetime
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from orrery.streaming import counters, threads

T0 = datetime.datetime(2024, 1, 1)
SCHEMA = "id long, k string, t timestamp, note string, at timestamp, n long"


@pytest.fixture
def rocks(spark):
    name = "spark.sql.streaming.stateStore.providerClass"
    old = spark.conf.get(name)
    spark.conf.set(name, threads.STORE)
    yield spark
    spark.conf.set(name, old)


def _run(spark, folder, runs, gap, late):
    for rows in runs:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(SCHEMA).parquet(f"{folder}/in")
        out = threads.closed_threads(stream, "k", "t", "id", gap, late)
        out.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(out.schema).parquet(f"{folder}/out").collect()


def _row(i, k, minutes, note="x", n=None):
    t = None if minutes is None else T0 + datetime.timedelta(minutes=minutes)
    return (i, k, t, note, T0 + datetime.timedelta(microseconds=i or 0), n)


def test_threads(rocks, tmp_path):
    """The second run brings an entry that joins two others, a repeated one, and ends at the very edge of a gap."""
    runs = [
        [_row(1, "a", 0, "first", 1), _row(3, "a", 18, None), _row(4, "b", 1), _row(5, None, 2), _row(None, "a", 3), _row(6, "a", None), _row(7, "c", 20)],
        [_row(2, "a", 9, "late"), _row(1, "a", 0, "again", 1), _row(9, "a", 18), _row(10, "a", 28), _row(11, "a", 38.5), _row(8, "z", 60)],
        [_row(12, "z", 200)],
    ]
    rows = _run(rocks, str(tmp_path), runs, "10 minutes", "20 minutes")
    found = {}
    for r in sorted(rows, key=lambda r: (r.k, r["_start"], r["_position"])):
        found.setdefault((r.k, (r["_start"] - T0).total_seconds() / 60, (r["_end"] - T0).total_seconds() / 60), []).append(r.id)
    assert found == {("a", 0, 28): [1, 2, 3, 9, 10], ("a", 38.5, 38.5): [11], ("b", 1, 1): [4], ("c", 20, 20): [7], ("z", 60, 60): [8]}
    by = {r.id: r for r in rows}
    assert by[3].note is None and by[1].n == 1 and by[2].n is None and by[2]["at"] == T0 + datetime.timedelta(microseconds=2) and by[2].t == T0 + datetime.timedelta(minutes=9)


def test_threads_as_in_one_batch(rocks, tmp_path):
    rng = random.Random(3)
    rows = [_row(i, f"k{rng.randrange(4)}", rng.randrange(3000) / 2) for i in range(300)]
    arrive = sorted(rows, key=lambda r: (r[2] - T0).total_seconds() / 60 + rng.random() * 55)
    got = _run(rocks, str(tmp_path), [arrive[:100], arrive[100:180], arrive[180:], [_row(999, "end", 5000)]], "12 minutes", "1 hour")
    want = set()
    for k in {r[1] for r in rows}:
        for thread in threads.split_threads([(int((r[2] - T0).total_seconds() * 1e6), str(r[0])) for r in rows if r[1] == k], 12 * 60_000_000):
            want |= {(k, thread[0][0], i, int(e[1])) for i, e in enumerate(thread)}
    assert {(r.k, int((r["_start"] - T0).total_seconds() * 1e6), r["_position"], r.id) for r in got} == want and len(got) == len(want)


def test_ingest_counts(spark, tmp_path):
    folder, schema = str(tmp_path), "id long, v double"
    for i in range(3):
        spark.createDataFrame([(j, None if j % 7 == 0 else float(j)) for j in range(i * 10, i * 10 + 10)], schema).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    stream = lambda: spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    run = lambda: counters.ingest(stream(), f"{folder}/out", f"{folder}/state", "counted", F.col("v") < 25, small=F.col("v") < 5)
    c = run()
    assert c.table(spark).agg(F.count("*"), F.sum("rows"), F.sum("refused"), F.sum("small"), F.min(F.col("milliseconds") >= 0)).first() == (3, 30, 9, 4, True)
    assert sorted(r.id for r in counters.refused(spark, f"{folder}/out", StructType.fromDDL(schema)).collect()) == [0, 7, 14, 21, 25, 26, 27, 28, 29]
    assert counters.accepted(spark, f"{folder}/out", StructType.fromDDL(schema)).count() == 21
    assert run().table(spark).count() == 0  # nothing new


def test_ingest_error(spark, tmp_path):
    spark.createDataFrame([("x",)], "v string").write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("v string").parquet(f"{tmp_path}/in")
    with pytest.raises(Exception):
        counters.ingest(stream, f"{tmp_path}/out", f"{tmp_path}/state", "failing", F.raise_error(F.col("v")).cast("boolean"))


@pytest.mark.parametrize("past, closed", [(0, 0), (1, 1)])
def test_thread_at_the_edge(rocks, tmp_path, past, closed):
    """The watermark at the end of the gap, and one millisecond behind it."""
    newest = T0 + datetime.timedelta(minutes=30, milliseconds=past)
    rows = _run(rocks, str(tmp_path), [[_row(1, "a", 0), (2, "b", newest, "x", T0, None)]], "10 minutes", "20 minutes")
    assert len(rows) == closed
