"""A content-addressed cache of vectors: a text is sent to the model once, whatever rows and runs ask for it.

The cache is a table bucketed by the digest of model and text. A run reduces its texts to different digests, asks the
cache by an anti-join that does not shuffle the cached side, computes what is missing and appends it.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.sinks import written


def content_digest(model: str, text: Column) -> Column:
    """SHA-256 of the model's name and the text."""
    return F.unhex(F.sha2(F.concat(F.lit(model), F.lit("\0"), text), 256))


class EmbeddingCache:
    """Vectors by digest, at `path`. embed: (digest, text) to (digest, vector), one row for each that it is given.

    buckets: enough that one bucket's vectors fit in a task; it is fixed when the table is made. A run that dies after
    computing and before appending computes again; one that dies while appending leaves no part of its rows, since
    Spark commits them as a whole.
    """

    def __init__(self, spark: SparkSession, path: str, model: str, embed: Callable[[DataFrame], DataFrame], buckets: int = 64) -> None:
        self.spark, self.path, self.model, self.embed, self.buckets = spark, path, model, embed, buckets
        self.table = f"embedding_cache_{uuid.uuid4().hex}"
        spark.sql(f"CREATE TABLE {self.table} (digest BINARY, vector ARRAY<DOUBLE>) USING parquet CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{path}'")

    def rows(self) -> DataFrame:
        self.spark.catalog.refreshTable(self.table)
        return self.spark.table(self.table)

    def missing(self, texts: DataFrame, text: str = "text") -> DataFrame:
        """(digest, text), once each, of texts whose vector is not known."""
        asked = texts.filter(F.col(text).isNotNull()).select(content_digest(self.model, F.col(text)).alias("digest"), F.col(text).alias("text"))
        # only digests and one text of each meet; of copies one travels
        return asked.groupBy("digest").agg(F.first("text").alias("text")).join(self.rows().select("digest").hint("merge"), "digest", "left_anti")

    def fill(self, texts: DataFrame, text: str = "text") -> int:
        """Computes and appends what is missing; how many vectors were computed."""
        new = written(self.embed(self.missing(texts, text)).select("digest", F.col("vector").cast("array<double>").alias("vector")), "embedded")
        n = new.count()
        if n:
            new.repartition(self.buckets, "digest").sortWithinPartitions("digest").write.insertInto(self.table)
        return n

    def embedded(self, texts: DataFrame, text: str = "text", out: str = "vector") -> DataFrame:
        """texts with their vectors, after computing missing ones. A null text has none; all rows and columns stay."""
        self.fill(texts, text)
        key = "_content_digest"
        return texts.withColumn(key, content_digest(self.model, F.col(text))).join(self.rows().select(F.col("digest").alias(key), F.col("vector").alias(out)), key, "left").drop(key)

    def drop(self) -> None:
        """Forgets the table's name; the cache stays at its path."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")
