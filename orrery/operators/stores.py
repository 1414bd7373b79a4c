"""Tables that are kept between runs: points whose payload changes without their vectors, keys that are checked on write,
and schemas that are published module by module."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.sinks import written


def _bucketed(spark: SparkSession, path: str, columns: str, key: str, buckets: int) -> str:
    name = f"store_{uuid.uuid4().hex}"
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({key}) SORTED BY ({key}) INTO {buckets} BUCKETS LOCATION '{path}'")
    return name


class PointStore:
    """Points (key, vector, payload) at a path: vectors are written once, payloads in versions beside them.

    Both are bucketed by the key, so that reading joins them without a shuffle. A patch or a purge reads and writes
    payloads alone, as a new version; the pointer to it, written last, makes it the current one, so that a run that dies
    before changes nothing. The last two versions stay.
    """

    def __init__(self, spark: SparkSession, path: str, key: str, key_type: str, payload: str, buckets: int = 16) -> None:
        """payload: the payload's columns as DDL. buckets: enough that the vectors of one fit in a task."""
        self.spark, self.path, self.key, self.key_type, self.payload, self.buckets = spark, path, key, key_type, payload, buckets
        self._vectors = _bucketed(spark, f"{path}/vectors", f"`{key}` {key_type}, vector ARRAY<DOUBLE>", f"`{key}`", buckets)
        self.columns = [f.name for f in spark.createDataFrame([], payload).schema]

    def _append(self, table: str, rows: DataFrame) -> None:
        rows.repartition(self.buckets, self.key).sortWithinPartitions(self.key).write.insertInto(table)

    def _version(self) -> int:
        """The current version; 0 if there is none."""
        folder = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/current")
        if not folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(folder):
            return 0
        return self.spark.read.schema("version long").parquet(f"{self.path}/current/*").agg(F.max("version")).first()[0] or 0

    def payloads(self) -> DataFrame:
        v = self._version()
        if not v:
            return self.spark.createDataFrame([], f"`{self.key}` {self.key_type}, {self.payload}")
        return self.spark.table(_bucketed(self.spark, f"{self.path}/payload/{v}", f"`{self.key}` {self.key_type}, {self.payload}", f"`{self.key}`", self.buckets))

    def _publish(self, rows: DataFrame) -> None:
        now = self._version() + 1
        path = f"{self.path}/payload/{now}"
        self._remove(path)  # of a run that died
        self._append(_bucketed(self.spark, path, f"`{self.key}` {self.key_type}, {self.payload}", f"`{self.key}`", self.buckets), rows.select(self.key, *self.columns))
        self.spark.createDataFrame([(now,)], "version long").coalesce(1).write.mode("overwrite").parquet(f"{self.path}/current/{now}")
        self._remove(f"{self.path}/payload/{now - 2}")

    def _remove(self, path: str) -> None:
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)

    def add(self, points: DataFrame, vector: str = "vector") -> None:
        """Adds points; of repeated keys, and of keys that are there already, the points that are there stay."""
        self.spark.catalog.refreshTable(self._vectors)
        once = points.filter(F.col(self.key).isNotNull()).groupBy(self.key).agg(F.first(F.struct(F.col(vector).cast("array<double>").alias("vector"), *self.columns)).alias("p"))
        new = written(once.join(self.spark.table(self._vectors).select(self.key).hint("merge"), self.key, "left_anti").select(self.key, "p.*"), "points-new")
        self._append(self._vectors, new.select(self.key, "vector"))
        self._publish(self.payloads().unionByName(new.drop("vector")))

    def patch(self, values: DataFrame, columns: list[str] | None = None) -> None:
        """Sets columns (all that values has) of the keys that values has; a null says nothing and leaves what is there.
        Keys that are not stored are ignored; of repeated keys one row counts."""
        columns = columns or [c for c in values.columns if c in self.columns]
        once = values.groupBy(self.key).agg(F.first(F.struct(*columns)).alias("_v"))
        # values are shuffled to the payload's buckets, the payload is not
        joined = self.payloads().join(once.hint("merge"), self.key, "left")
        self._publish(joined.select(self.key, *[F.coalesce(F.col("_v")[c], F.col(c)).alias(c) if c in columns else F.col(c) for c in self.columns]))

    def purge(self, columns: list[str], where: Column) -> None:
        """Takes columns from the points whose payload meets the condition; null counts as false."""
        hit = F.coalesce(where, F.lit(False))
        self._publish(self.payloads().select(self.key, *[F.when(~hit, F.col(c)).alias(c) if c in columns else F.col(c) for c in self.columns]))

    def points(self) -> DataFrame:
        """(key, vector, payload columns), joined bucket by bucket."""
        self.spark.catalog.refreshTable(self._vectors)
        return self.spark.table(self._vectors).join(self.payloads().hint("merge"), self.key, "left")


class KeyedTable:
    """A table whose key is unique, with an index of its keys: a batch is checked against the index by an anti-join that
    neither reads the table nor shuffles the index."""

    def __init__(self, spark: SparkSession, path: str, key: str, key_type: str, buckets: int = 64) -> None:
        self.spark, self.path, self.key = spark, path, key
        self.buckets = buckets
        self._index = _bucketed(spark, f"{path}/keys", f"`{key}` {key_type}", f"`{key}`", buckets)

    def keys(self) -> DataFrame:
        self.spark.catalog.refreshTable(self._index)
        return self.spark.table(self._index)

    def checked(self, batch: DataFrame) -> DataFrame:
        """batch with reason: null for rows that may be written, else 'no key', 'known key' or 'repeated key' (all rows of
        a key that the batch holds more than once)."""
        counts = batch.groupBy(self.key).agg(F.count(F.lit(1)).alias("_n"))
        known = counts.join(self.keys().withColumn("_known", F.lit(True)).hint("merge"), self.key, "left").select(F.col(self.key).alias("_key"), "_n", "_known")
        told = F.when(F.col(self.key).isNull(), "no key").when(F.col("_known"), "known key").when(F.col("_n") > 1, "repeated key")
        return batch.join(known, F.col(self.key) == F.col("_key"), "left").withColumn("reason", told).drop("_key", "_n", "_known")

    def append(self, batch: DataFrame, refuse: bool = False) -> int:
        """Appends the rows that may be written and puts the others, with their reason, into quarantine; or, with `refuse`,
        writes nothing and raises if there is one. How many rows were written.

        Keys are written after their rows: a run that dies in between leaves rows whose keys are not known, which the
        next run finds by `pending`.
        """
        told = written(self.checked(batch), "keyed-batch")
        bad = told.filter("reason is not null")
        n = bad.count()
        if n and refuse:
            raise ValueError(f"{n} rows break the key: {dict(bad.groupBy('reason').count().collect())}")
        good = told.filter("reason is null").drop("reason")
        good.write.mode("append").parquet(f"{self.path}/rows")
        good.select(self.key).repartition(self.buckets, self.key).sortWithinPartitions(self.key).write.insertInto(self._index)
        if n:
            bad.write.mode("append").parquet(f"{self.path}/quarantine")
        return told.count() - n

    def rows(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/rows")

    def quarantine(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/quarantine")

    def pending(self) -> DataFrame:
        """Rows that were written without their keys."""
        return self.rows().join(self.keys().hint("merge"), self.key, "left_anti")


def publish(fields: DataFrame, path: str, module: str = "module") -> None:
    """Publishes the fields of the modules that the table holds: a module's earlier fields go as a whole, so that vanished
    ones don't stay, and those of other modules are not touched."""
    fields.repartition(module).write.option("partitionOverwriteMode", "dynamic").mode("overwrite").partitionBy(module).parquet(path)


def sample_against_population(found: DataFrame, population: DataFrame, kind: str, top: int = 3, by: tuple[str, ...] = ("query_id",)) -> DataFrame:
    """Whether what a search found gives the ranking of all: (by, n, n_told, first, first_right, top_right).

    found: rows of each search with their kind, population: all rows; null kinds are not told. Kinds are ranked by how many
    rows they have, ties by name. A search without any told kind is right in nothing; of fewer kinds than `top` all count.
    """
    told = F.col(kind).isNotNull()
    order = F.array_sort(F.collect_list(F.when(told, F.struct((-F.col("n")).alias("n"), F.col(kind)))))  # one entry a kind
    ranked = F.slice(F.transform(order, lambda x: x[kind]), 1, top)
    every = population.groupBy(kind).agg(F.count(F.lit(1)).alias("n")).agg(ranked.alias("_all"))
    each = found.groupBy(*by, kind).agg(F.count(F.lit(1)).alias("n"))
    own = each.groupBy(*by).agg(F.sum("n").alias("n"), F.sum(F.when(told, F.col("n")).otherwise(0)).alias("n_told"), ranked.alias("_own"))
    met = own.crossJoin(F.broadcast(every))  # one row
    first = F.get("_own", F.lit(0))
    return met.select(*by, "n", "n_told", first.alias("first"), F.coalesce(first == F.get("_all", F.lit(0)), F.lit(False)).alias("first_right"), ((F.size("_own") > 0) & (F.col("_own") == F.col("_all"))).alias("top_right"))
