"""Sinks: tables, reports and counters."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


_own: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, spark.checkpoint.dir; a temporary one only where all runs in one process."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return _own.setdefault(spark.sparkContext.applicationId, "file://" + tempfile.mkdtemp(prefix="orrery-"))


def written(df: DataFrame, label: str, group_rows: int | None = None) -> DataFrame:
    """df written to the shared folder and read back: cuts the lineage, and outlives any executor. group_rows: rows of a
    Parquet row group at most, for rows of MBs, which tasks can then share out."""
    path = f"{shared_folder(df.sparkSession)}/orrery-steps/{label}-{uuid.uuid4().hex[:12]}"
    w = df.write.option("parquet.block.row.count.limit", group_rows) if group_rows else df.write
    w.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def save(df: DataFrame, path: str, mode: str = "overwrite", partition: list[str] | None = None) -> None:
    w = df.write.mode(mode)
    (w.partitionBy(*partition) if partition else w).parquet(path)


def ensure(df: DataFrame, path: str) -> None:
    """Writes only if nothing is there."""
    df.write.mode("ignore").parquet(path)


def save_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def rebuild_kind(points: DataFrame, fresh: DataFrame, kind: str) -> DataFrame:
    """Points of other kinds as they are, those of one kind anew."""
    return points.filter(~F.col("kind").eqNullSafe(F.lit(kind))).unionByName(fresh, allowMissingColumns=True)


def counted(df: DataFrame, name: str = "ingest", **counters: Column) -> tuple[DataFrame, Observation]:
    """df with counters that are filled in when it is written."""
    o = Observation(name)
    return df.observe(o, F.count(F.lit(1)).alias("rows"), *[F.count_if(c).alias(n) for n, c in counters.items()]), o


def report(df: DataFrame, title: str, limit: int = 200) -> str:
    """A Markdown table of a report's first rows."""
    rows = df.limit(limit).collect()
    head = f"## {title}\n\n| {' | '.join(df.columns)} |\n|{'---|' * len(df.columns)}\n"
    return head + "".join(f"| {' | '.join('' if v is None else str(v).replace('|', '/') for v in r)} |\n" for r in rows)


def props_of(df: DataFrame, keys: list[str]) -> Column:
    """Columns as a map: nulls out, lists and structures as JSON under extra_."""
    pairs = []
    for c, t in df.dtypes:
        if c not in keys:
            nested = t.startswith(("array", "struct", "map"))
            pairs += [F.lit(f"extra_{c}" if nested else c), F.to_json(c) if nested else F.col(c).cast("string")]
    return F.map_filter(F.create_map(*pairs), lambda k, v: v.isNotNull())
