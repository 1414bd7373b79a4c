"""Incremental ingestion: the batch upsert applied to every micro-batch of a file stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.graph import upsert


#: Buckets of an upserted table; take enough that the rows of one fit in a task.
BUCKETS = 64


def upsert_stream(stream: DataFrame, path: str, checkpoint: str, keys: list[str], order: str, available_now: bool = True, buckets: int = BUCKETS):
    """Keeps a table of one row per key, in buckets by a hash of the key.

    A micro-batch reads and writes only the buckets that its keys fall into, as generation n beside the earlier ones, so
    a batch that is repeated after a failure starts from the same rows. Of each bucket the last two generations stay.
    """

    def apply(batch: DataFrame, n: int) -> None:
        spark = batch.sparkSession
        key = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
        touched = {r["b"] for r in batch.select(key.alias("b")).distinct().collect()}  # at most `buckets` numbers
        known = {b: [g for g in gens if g < n] for b, gens in _generations(spark, path).items() if b in touched}
        old = _read(spark, path, batch.schema, {b: gens[-1] for b, gens in known.items() if gens})
        upsert(old, batch, keys, order).withColumn("bucket", key).write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/gen={n}")
        for b, gens in known.items():
            for g in gens[:-1]:
                _files(spark, path).delete(_path(spark, f"{path}/gen={g}/bucket={b}"), True)

    w = stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if available_now else w).start()


def _path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def _files(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _generations(spark: SparkSession, path: str) -> dict[int, list[int]]:
    """Per bucket its complete generations, ascending."""
    files, found = _files(spark, path), {}
    done = {int(f.getPath().getParent().getName().split("=")[1]) for f in files.globStatus(_path(spark, f"{path}/gen=*/_SUCCESS")) or ()}
    for f in files.globStatus(_path(spark, f"{path}/gen=*/bucket=*")) or ():
        g, b = (int(p.getName().split("=")[1]) for p in (f.getPath().getParent(), f.getPath()))
        if g in done:
            found.setdefault(b, []).append(g)
    return {b: sorted(gens) for b, gens in found.items()}


def _read(spark: SparkSession, path: str, schema, wanted: dict[int, int]) -> DataFrame:
    paths = [f"{path}/gen={g}/bucket={b}" for b, g in sorted(wanted.items())]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def newest(spark: SparkSession, path: str, schema) -> DataFrame:
    """The table: the last complete generation of every bucket."""
    return _read(spark, path, schema, {b: gens[-1] for b, gens in _generations(spark, path).items()})


def deduplicated(stream: DataFrame, key: str, time: str, late: str = "1 hour") -> DataFrame:
    return stream.withWatermark(time, late).dropDuplicatesWithinWatermark([key])


def file_stream(spark: SparkSession, folder: str, schema, per_trigger: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger).parquet(folder)


def resume(rows: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows whose key was not handled before."""
    return rows.join(done.select(key), key, "left_anti")


def sessions(stream: DataFrame, time: str, key: str, gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    """An extension: counts per key and session window."""
    return stream.withWatermark(time, late).groupBy(F.session_window(time, gap), key).count()
