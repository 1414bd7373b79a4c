"""Token-id output: flat unsigned-integer files with 64-bit document offsets, memory-mapped when read.

Layout of a data set: one pair of files per partition, in ascending id order over all partitions.
  part-NNNNNN-*.bin  the ids of all documents of the partition, little-endian, 2 or 4 bytes each
  part-NNNNNN-*.idx  int64 n; n + 1 uint64 offsets (in ids, from the file's start); n int64 document ids
  manifest           Parquet: part, path, n_docs, n_tokens, width, and base, the number of ids in earlier partitions
A retried task writes files of its own; the manifest, committed by Spark, names those of the attempt that counted.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import arrow_map, work_path
from .wordpieces import encoder

NO_ID = -(2**63)


def _filesystem(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri else "file://" + uri.removeprefix("file:"))


def write_token_files(docs: DataFrame, path: str, vocabulary: str, end_id: int | None, id_col: str = "doc_id", text_col: str = "text", width: int = 2) -> DataFrame:
    """Encodes every whole text (null: empty), appends end_id, writes the files under `path` in ascending id order
    (null ids last, repeated ids in any order) and returns the manifest, read back from there.

    One shuffle, by ranges of the id; each task streams its rows to its own pair of files and holds offsets only.
    """
    spark = docs.sparkSession
    ranged = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).repartitionByRange(F.col("id").asc_nulls_last()).sortWithinPartitions(F.col("id").asc_nulls_last())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        files, root = _filesystem(path)
        name = f"{root}/part-{part:06d}-{uuid.uuid4().hex}"
        encode, at, offsets, ids, out = encoder(vocabulary, width), 0, [np.zeros(1, np.uint64)], [], None
        for b in batches:
            ids.append(pc.fill_null(b.column("id"), NO_ID).to_numpy(zero_copy_only=False))
            for _, flat, bounds in encode.texts(b.column("text"), end_id):
                if out is None:
                    files.create_dir(root, recursive=True)
                    out = files.open_output_stream(name + ".bin")
                out.write(flat.tobytes())
                offsets.append((bounds[1:] + at).astype("<u8"))
                at += len(flat)
        if out is not None:
            out.close()
            own = np.concatenate(ids)
            with files.open_output_stream(name + ".idx") as f:
                f.write(np.array([len(own)], "<i8").tobytes() + np.concatenate(offsets).astype("<u8").tobytes() + own.astype("<i8").tobytes())
            yield pa.RecordBatch.from_pydict({"part": [part], "path": [name], "n_docs": [len(own)], "n_tokens": [at], "width": [width]}, schema)

    schema = pa.schema([("part", pa.int64()), ("path", pa.string()), ("n_docs", pa.int64()), ("n_tokens", pa.int64()), ("width", pa.int64())])
    parts = arrow_map(ranged, run, "part long, path string, n_docs long, n_tokens long, width long")
    parts.write.parquet(f"{path}/written")
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    based = spark.read.parquet(f"{path}/written").withColumn("base", F.coalesce(F.sum("n_tokens").over(earlier), F.lit(0)))
    based.write.parquet(f"{path}/manifest")
    return spark.read.parquet(f"{path}/manifest")


def _open(base_uri: str, name: str, width: int):
    """(ids, offsets, document ids) of a pair of files; local ones are memory-mapped."""
    files, _ = _filesystem(base_uri)
    if files.type_name == "local":
        raw = np.memmap(name + ".idx", np.uint8, "r")
        ids = np.memmap(name + ".bin", f"<u{width}", "r") if files.get_file_info(name + ".bin").size else np.empty(0, f"<u{width}")
    else:
        raw = np.frombuffer(files.open_input_file(name + ".idx").read(), np.uint8)
        ids = np.frombuffer(files.open_input_file(name + ".bin").read(), f"<u{width}")
    n = int(raw[:8].view("<i8")[0])
    return ids, raw[8 : 16 + 8 * n].view("<u8"), raw[16 + 8 * n :].view("<i8")


def read_token_files(spark: SparkSession, path: str, with_ids: bool = False, per_batch: int = 4 << 20) -> DataFrame:
    """Per document, from the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32 (unsigned, of
    its ids as little-endian 32-bit integers), and ids if asked for. About `per_batch` ids, or one document, are held
    at a time."""
    fields = [("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())] + [("ids", pa.list_(pa.int64()))] * with_ids
    schema = pa.schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                ids, offsets, docs = _open(path, r["path"], r["width"])
                bounds, i = offsets.astype(np.int64), 0
                while i < r["n_docs"]:
                    j = max(i + 1, int(np.searchsorted(bounds, bounds[i] + per_batch, "right")) - 1)
                    at = bounds[i : j + 1]
                    flat = np.array(ids[at[0] : at[-1]], "<u4")
                    view, places = memoryview(flat).cast("B"), (4 * (at - at[0])).tolist()
                    crcs = [zlib.crc32(view[a:z]) for a, z in zip(places, places[1:])]
                    own = docs[i:j]
                    columns = [pa.array(own, pa.int64(), mask=own == NO_ID), pa.array(at[:-1] + r["base"]), pa.array(np.diff(at)), pa.array(crcs, pa.int64())]
                    lists = [pa.ListArray.from_arrays(pa.array(at - at[0], pa.int32()), pa.array(flat.astype(np.int64)))] * with_ids
                    yield pa.RecordBatch.from_arrays([*columns, *lists], schema=schema)
                    i = j

    manifest = spark.read.parquet(f"{path}/manifest")
    ddl = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids
    return arrow_map(manifest.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "part"), run, ddl)  # few rows, each much work


def encode_documents(docs: DataFrame, vocabulary: str, end_id: int | None = 2, id_col: str = "doc_id", text_col: str = "text", width: int = 2) -> DataFrame:
    """Writes the token files of docs to the shared folder and reads every document's place back from them. An empty
    table gives an empty result; an empty text has the end id alone."""
    spark = docs.sparkSession
    path = work_path(spark, "tokens")
    write_token_files(docs, path, vocabulary, end_id, id_col, text_col, width)
    return read_token_files(spark, path)
