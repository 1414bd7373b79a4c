"""Bounds of memory: what is broadcast, and rows of MBs in Parquet and Arrow."""

import pyarrow.parquet as pq
from orrery.llm import alignment, common, queries, simhash
from pyspark.sql import functions as F


def _plans(monkeypatch, module):
    """The plans of what a module stores, by label."""
    plans, real = {}, module.stored
    monkeypatch.setattr(module, "stored", lambda df, label, *more: plans.setdefault(label, df._jdf.queryExecution().executedPlan().toString()) and real(df, label, *more))
    return plans


def test_exploded_fingerprints_are_not_broadcast(spark, monkeypatch):
    plans = _plans(monkeypatch, simhash)
    points = common.stored(spark.createDataFrame([(1,), (3,), (1 << 40,)], "fp long"), "points")  # a file, whose size Spark knows
    found = [tuple(sorted(r)) for r in simhash.links(points).collect()]
    assert len({x for e in found for x in e}) == 3 and len(found) >= 2
    assert "SortMergeJoin" in plans["simhash-buckets"] and "Broadcast" not in plans["simhash-buckets"]

def test_blocks_are_small_rows_in_small_groups_and_batches(spark, monkeypatch, tmp_path):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before, during, real = spark.conf.get(key), {}, alignment.stored
    monkeypatch.setattr(alignment, "stored", lambda df, label, *more: during.setdefault(label, spark.conf.get(key)) and real(df, label, *more))
    text = "".join(f"w{i % 997} " for i in range(4000))
    docs = spark.range(120, numPartitions=1).select(F.col("id").alias("doc_id"), F.lit(text).alias("text")).coalesce(1)
    paths = list(map(queries.vocabulary, queries.SIDES))
    rows = alignment.align_documents(docs, *paths).collect()
    assert len(rows) == 120 and len({tuple(r)[1:] for r in rows}) == 1 and rows[0].n_links > 4000
    assert during["aligned"] == during["aligned-texts"] == "8m" and spark.conf.get(key) == before
    blocks = alignment.encoded_blocks(docs, *paths)
    assert blocks.count() >= len(text) * 120 >> 20
    many = alignment.stored(spark.range(100, numPartitions=1).coalesce(1), "groups", alignment.GROUP_ROWS)
    (file,) = [f for f in many.inputFiles()]
    meta = pq.read_metadata(file.removeprefix("file://"))
    assert max(meta.row_group(i).num_rows for i in range(meta.num_row_groups)) <= alignment.GROUP_ROWS
