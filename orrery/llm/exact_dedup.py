"""Exact deduplication with a persistent digest index, by DataFrame operations alone.

The index is a table bucketed and sorted by the SHA-256 digest of the normalised text. A batch is first reduced to one
row per digest, then a sort-merge anti-join against the index, which needs no shuffle on the index's side, finds the
digests that are new; these are appended with the same bucketing.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ROW, as_given, ascii_lower, delete_path, join_groups, numbered, stored, whole, without_rows, work_path

BUCKETS = 64


def text_digest(text: Column) -> Column:
    """SHA-256 (hex) of the text's UTF-8 with A-Z lower-cased; null counts as empty."""
    return F.sha2(ascii_lower(whole(text)), 256)


class DigestIndex:
    """Digests seen so far and the id that stays for each, at `path`. Opening an existing path continues it.

    buckets: number of hash buckets; take enough that one bucket's digests (40 bytes each) fit in a task.
    Each digest carries the name of the batch that brought it. A batch that is admitted again under its name, because
    the job died after appending, gets the verdicts it got before and adds only what was not yet appended.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS) -> None:
        self.spark, self.path, self.buckets = spark, path, buckets
        self.table = f"digest_index_{uuid.uuid4().hex}"
        spark.sql(f"CREATE TABLE {self.table} (digest BINARY, keep_id BIGINT, batch STRING) USING parquet CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{path}'")

    def rows(self) -> DataFrame:
        self.spark.catalog.refreshTable(self.table)
        return self.spark.table(self.table)

    def append(self, fresh: DataFrame) -> None:
        """fresh: (digest, keep_id, batch), none of the digests in the index."""
        fresh.select("digest", "keep_id", "batch").repartition(self.buckets, "digest").sortWithinPartitions("digest").write.insertInto(self.table)

    def compact(self, path: str) -> "DigestIndex":
        """The same index at another path with one sorted file a bucket, after many appends."""
        new = DigestIndex(self.spark, path, self.buckets)
        new.append(self.rows())
        return new

    def admit(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", batch: str | None = None) -> DataFrame:
        """Deduplicates docs against the index and among themselves, and appends the new digests under the batch's name
        (without one, a name of its own, so that a second call takes all of them for known).

        Returns, for every row: _row (which row of docs), the id, text_sha256, keep_id (the id that stays for this
        text: the index's, else the largest of the batch), group_size (rows of this text in the batch) and kept. Of
        repeated rows with equal id and text one is kept; a null id counts as the smallest.
        """
        rows = stored(docs.select(F.monotonically_increasing_id().alias("_row"), F.col(id_col).cast("long").alias(id_col), F.unhex(text_digest(F.col(text_col))).alias("digest")), "digests")
        return self.admit_rows(rows, id_col, batch)

    def admit_rows(self, rows: DataFrame, id_col: str, batch: str | None = None) -> DataFrame:
        batch = batch or uuid.uuid4().hex
        earlier = lambda: self.rows().filter(F.col("batch") != batch)
        known = F.coalesce(F.col(id_col), F.lit(-(2**63)).cast("long"))
        groups = stored(rows.groupBy("digest").agg(F.max(id_col).alias("_largest"), F.max_by("_row", known).alias("_stays"), F.count(F.lit(1)).alias("group_size")), "digest-groups")
        fresh = stored(groups.join(earlier().hint("merge"), "digest", "left_anti").select("digest", F.col("_largest").alias("keep_id"), F.lit(batch).alias("batch")), "digests-new")
        # the index's id wins for digests that were there before this batch
        before = groups.join(earlier().hint("merge"), "digest", "inner").select("digest", "keep_id", "group_size", F.lit(-1).cast("long").alias("_stays"))
        new = groups.join(fresh.hint("merge"), "digest", "left_semi").select("digest", F.col("_largest").alias("keep_id"), "group_size", "_stays")
        decided = stored(before.unionByName(new), "digest-decided")
        self.append(fresh.join(self.rows().hint("merge"), "digest", "left_anti"))
        return join_groups(rows, decided, "digest", "group_size").select(
            "_row", id_col, *[c for c in rows.columns if c not in ("_row", id_col, "digest")], F.lower(F.hex("digest")).alias("text_sha256"), "keep_id", "group_size", (F.col("_row") == F.col("_stays")).alias("kept")
        )

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")
        delete_path(self.spark, self.path)


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """Every row of docs with its verdict, against an index that starts empty."""
    spark = docs.sparkSession
    index = DigestIndex(spark, work_path(spark, "digest-index"), buckets)
    try:
        return index.admit(docs, id_col, text_col)
    finally:
        index.drop()  # the verdicts are stored


def keep_first_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """docs without the rows whose text another row keeps; all columns stay as they are. Null texts count as empty and
    so equal each other; of equal texts the row with the largest id stays (null the smallest, of repeated ids one row).
    An empty table gives an empty result."""
    spark, rows = docs.sparkSession, numbered(docs)
    digests = stored(rows.select(ROW, F.monotonically_increasing_id().alias("_row"), F.col(id_col).cast("long").alias("_id"), F.unhex(text_digest(F.col(text_col))).alias("digest")), "digests")
    index = DigestIndex(spark, work_path(spark, "digest-index"), buckets)
    dropped = stored(index.admit_rows(digests, "_id").filter("not kept").select(ROW), "copies")
    index.drop()
    return as_given(without_rows(rows, dropped), docs)
