"""Ingestion of a stream with counters read while it runs, and a table of the rows that were refused."""

from __future__ import annotations

import threading

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

#: Column of the written table that tells good rows from refused ones.
GOOD = "_good"


class Counters(StreamingQueryListener):
    """What each micro-batch of the query `name` observed. A batch that is run again after a failure counts once."""

    def __init__(self, name: str) -> None:
        self.name, self.batches, self.run = name, {}, None
        self.ended, self.error = threading.Event(), None

    def onQueryStarted(self, event) -> None:
        if event.name == self.name:
            self.run = str(event.runId)

    def onQueryProgress(self, event) -> None:
        p = event.progress
        seen = p.observedMetrics.get(self.name) if p.name == self.name else None
        if seen is not None and seen["rows"]:  # batches without input report nothing
            self.batches[p.batchId] = {**seen.asDict(), "milliseconds": p.batchDuration}

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if str(event.runId) == self.run:
            self.error = event.exception
            self.ended.set()

    def table(self, spark: SparkSession) -> DataFrame:
        """A row per batch that had rows: batch, rows, refused, the other counters, milliseconds."""
        names = list(dict.fromkeys(n for b in self.batches.values() for n in b)) or ["rows", "refused", "milliseconds"]
        return spark.createDataFrame([(i, *[b[n] for n in names]) for i, b in sorted(self.batches.items())], "batch long, " + ", ".join(f"`{n}` long" for n in names))


def ingest(stream: DataFrame, path: str, checkpoint: str, name: str, good: Column, wait: float = 60, **counters: Column) -> Counters:
    """Writes what is there of the stream to `path`, rows that are not `good` (false or null) apart, each once; gives the
    counts of rows, of refused ones, and of the conditions in `counters`. A failed query raises its error. `wait`: seconds
    for the last counts, which come after the query's end."""
    spark = stream.sparkSession
    ok = F.coalesce(good, F.lit(False))
    seen = stream.withColumn(GOOD, ok).observe(name, F.count(F.lit(1)).alias("rows"), F.count_if(~F.col(GOOD)).alias("refused"), *[F.count_if(c).alias(n) for n, c in counters.items()])
    listener = Counters(name)
    spark.streams.addListener(listener)
    try:
        q = seen.writeStream.queryName(name).format("parquet").partitionBy(GOOD).option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        q.awaitTermination()
        if not listener.ended.wait(wait):
            raise TimeoutError("the counters of the last batches did not arrive")
    finally:
        spark.streams.removeListener(listener)
    return listener


def accepted(spark: SparkSession, path: str, schema) -> DataFrame:
    return _part(spark, path, schema, True)


def refused(spark: SparkSession, path: str, schema) -> DataFrame:
    """The dead letters."""
    return _part(spark, path, schema, False)


def _part(spark: SparkSession, path: str, schema, good: bool) -> DataFrame:
    names = [f.name for f in schema.fields]
    return spark.read.schema(schema.add(GOOD, "boolean") if GOOD not in names else schema).parquet(path).filter(F.col(GOOD) == good).select(*names)
