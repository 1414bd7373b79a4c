"""Helpers that several operators share: shared-folder tables, running sums, joins with hot keys."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..arrow import arrow_map

#: A word is a maximal run of bytes that are not ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
_own_roots: dict[str, str] = {}
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def shared_root(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir; where that is unset and all runs in one process
    (tests), a temporary folder of its own."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        app = spark.sparkContext.applicationId
        if app not in _own_roots:
            _own_roots[app] = "file://" + tempfile.mkdtemp(prefix="orrery-")
        root = _own_roots[app]
    return root.rstrip("/")


def work_path(spark: SparkSession, label: str) -> str:
    return f"{shared_root(spark)}/orrery/{os.getpid()}/{label}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, label: str, group_rows: int | None = None) -> DataFrame:
    """Writes df to the shared folder and reads it back: this cuts the lineage, and what it holds outlives any executor.

    group_rows: rows of a Parquet row group at most, for rows of MBs. A writer looks at a group's size every 100 rows at
    the earliest, and writers and readers hold a group at once.
    """
    path = work_path(df.sparkSession, label)
    w = df.write.option("parquet.block.row.count.limit", group_rows) if group_rows else df.write
    w.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def small_batches(spark: SparkSession, most: str = "8m") -> Iterator[None]:
    """Arrow batches of about so many bytes for what is run inside, so that workers and executors don't hold 64 MB of rows
    of MBs at once."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, most)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def release(spark: SparkSession) -> None:
    """Deletes all that this process's operators have written to the shared folder. Results that were not yet written
    elsewhere read from there, so this is for the end of a job."""
    delete_path(spark, f"{shared_root(spark)}/orrery/{os.getpid()}")


def delete_path(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def whole(text: Column) -> Column:
    """Null counts as the empty text."""
    return F.coalesce(text, F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z only; texts of ASCII alone take the faster lower()."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def crc32(text: Column) -> Column:
    return F.crc32(F.encode(text, "UTF-8"))


def fold_of(doc_id: Column, folds: int) -> Column:
    """crc32(doc_id as text) mod folds; a null id counts as the empty text."""
    return F.pmod(crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(folds)).cast("int")


ROW = "_row_of_docs"
_ASIDE = "_given_row_of_docs"
#: Bytes of bitmaps that are sent to all tasks at once at most; the files of a larger table are taken in groups.
BITMAP_BYTES = 64 << 20
#: Bytes of one bitmap of Spark's bitmap functions, which holds a bit for each of 32768 rows.
_BITMAP = 4096


def numbered(docs: DataFrame) -> DataFrame:
    """docs with _row_of_docs, which tells its rows apart and comes out the same whenever docs is read: the file and the
    place in it, whatever the splits. A table that is not read from files is written to the shared folder first. A
    column of docs with that name steps aside; `as_given` brings it back.
    """
    from pyspark.errors import AnalysisException

    for c in docs.columns:
        if c.lower() == ROW:
            docs = docs.withColumnRenamed(c, _ASIDE)
    place = F.struct(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at"))
    try:
        out = docs.select("*", place.alias(ROW))
        out.schema
        return out
    except AnalysisException:
        return stored(docs, "numbered").select("*", place.alias(ROW))


def as_given(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """rows, made from numbered(docs), with the columns of docs."""
    return rows.select(*[F.col(_ASIDE).alias(c) if c.lower() == ROW else F.col(f"`{c}`") for c in docs.columns])


def bit(bitmap: Column, place: Column) -> Column:
    """Whether the bitmap, null if it is empty, has the place's bit."""
    byte = F.conv(F.hex(F.substring(bitmap, (F.bitmap_bit_position(place) / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.coalesce(F.getbit(byte, F.pmod(F.bitmap_bit_position(place), F.lit(8)).cast("int")) == 1, F.lit(False))


def marked(rows: DataFrame, decisions: DataFrame, *flags: str) -> DataFrame:
    """rows, numbered, with the boolean columns `flags` of decisions, a table with some of their _row_of_docs; false for
    the others. The rows stay where they are, whatever the sizes.

    Decisions become bitmaps, a bit per flag and row of those stretches of 32768 rows of a file that have any. These are
    sent to all tasks; if they take more than BITMAP_BYTES, the files are dealt into groups by their hash, and each
    group's rows meet its own bitmaps only. Every file is read once all the same.
    """
    at = decisions.select(F.col(f"{ROW}.file").alias("_file"), F.bitmap_bucket_number(f"{ROW}.at").alias("_stretch"), F.bitmap_bit_position(f"{ROW}.at").alias("_bit"), *flags).filter(F.greatest(*[F.col(f) for f in flags], F.lit(False)))
    maps = stored(at.groupBy("_file", "_stretch").agg(*[F.bitmap_construct_agg(F.when(F.col(f), F.col("_bit"))).alias(f"_map_{f}") for f in flags]), "bitmaps")
    groups = -(-maps.count() * _BITMAP * len(flags) // BITMAP_BYTES) or 1
    of = lambda file, g: F.pmod(file, F.lit(groups)) == g if groups > 1 else F.lit(True)
    out = None
    for g in range(groups):
        own, sent = rows.filter(of(F.col(f"{ROW}.file"), g)), F.broadcast(maps.filter(of(F.col("_file"), g)))
        met = own.join(sent, (F.col(f"{ROW}.file") == F.col("_file")) & (F.bitmap_bucket_number(f"{ROW}.at") == F.col("_stretch")), "left")
        part = met.select(*[F.col(f"`{c}`") for c in rows.columns], *[bit(F.col(f"_map_{f}"), F.col(f"{ROW}.at")).alias(f) for f in flags])
        out = part if out is None else out.unionByName(part)
    return out


def without_rows(rows: DataFrame, dropped: DataFrame) -> DataFrame:
    """rows, numbered, without those whose _row_of_docs the table `dropped` has."""
    flag = "_dropped_row"
    return marked(rows, dropped.withColumn(flag, F.lit(True)), flag).filter(~F.col(flag)).drop(flag)


def only_rows(rows: DataFrame, kept: DataFrame) -> DataFrame:
    """Those of the numbered rows whose _row_of_docs the table `kept` has."""
    flag = "_kept_row"
    return marked(rows, kept.withColumn(flag, F.lit(True)), flag).filter(F.col(flag)).drop(flag)


def same(a: DataFrame, b: DataFrame, keys: list[str]) -> Column:
    """Null-safe equality of all keys."""
    cond = F.lit(True)
    for k in keys:
        cond = cond & a[k].eqNullSafe(b[k])
    return cond


def running_sums(df: DataFrame, by: list[str], order: list[str], sums: list[str], label: str, attach: DataFrame | None = None) -> DataFrame:
    """Adds before_<c> for each c of `sums`: the sum of c over the rows of the same `by` that come earlier in `order`.

    Rows are range-partitioned on (by, order), so that even one group with a third of all rows spreads over many
    tasks. Each range partition is summed on its own, the few partition sums are turned into bases by a prefix sum,
    and a window within each (partition, group) adds the rest. Equal rows are told apart by a row number, nulls sort
    last. `attach` holds one row per group, whose columns are added on the way (null-safe on `by`).
    """
    keys = [F.col(c).asc_nulls_last() for c in [*by, *order]]
    ranged = df.withColumn("_row", F.monotonically_increasing_id()).repartitionByRange(*keys, F.col("_row")).withColumn("_part", F.spark_partition_id())
    rows = stored(ranged, label)
    totals = rows.groupBy("_part", *by).agg(*[F.sum(c).alias(f"_sum_{c}") for c in sums])
    earlier = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("_part", *by, *[F.coalesce(F.sum(f"_sum_{c}").over(earlier), F.lit(0)).alias(f"_base_{c}") for c in sums])
    if attach is not None:
        extra = [c for c in attach.columns if c not in by]
        bases = bases.join(attach, same(bases, attach, by), "left").select(*[bases[c] for c in bases.columns], *[attach[c] for c in extra])
    else:
        extra = []
    local = Window.partitionBy("_part", *by).orderBy(*[F.col(c).asc_nulls_last() for c in order], "_row").rowsBetween(Window.unboundedPreceding, -1)
    inner = rows.select("*", *[F.coalesce(F.sum(c).over(local), F.lit(0)).alias(f"_in_{c}") for c in sums])
    on = ["_part", *by]
    return inner.join(bases, same(inner, bases, on), "inner").select(
        *[inner[c] for c in df.columns], *[(inner[f"_in_{c}"] + bases[f"_base_{c}"]).alias(f"before_{c}") for c in sums], *[bases[c] for c in extra]
    )


def join_groups(rows: DataFrame, groups: DataFrame, key: str, n: str, share: int = 1000) -> DataFrame:
    """Inner join of rows with groups (one row per key; n: how many rows have it), safe for hot keys.

    Keys with more than one row in `share` are fewer than `share`, so they are broadcast whatever the size of the
    data; the others are joined by a shuffle whose largest key has at most that part of the rows. `rows` and `groups`
    are read twice and should be stored tables.
    """
    total = groups.agg(F.sum(n)).first()[0] or 0
    hot = F.col(n) > F.lit(max(total // share, 1))
    few, many = groups.filter(hot), groups.filter(~hot)
    first = rows.join(F.broadcast(few), key, "inner")
    rest = rows.join(F.broadcast(few.select(key)), key, "left_anti").join(many, key, "inner")
    return first.unionByName(rest.select(*first.columns))
