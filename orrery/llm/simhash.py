"""SimHash near-duplicates by covering locality-sensitive hashing.

A fingerprint is the bitwise majority of the XXH64 hashes of a text's word shingles. For radius r every bit position
gets a nonzero vector of r + 1 bits; for each of the 2**(r+1) - 1 nonzero vectors v, the mask keeps the positions whose
vector has an odd product with v. Any r differing positions leave some v orthogonal to all of them, so every pair
within the radius agrees on at least one mask: no pair is missed, whatever the data.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ROW, arrow_map, join_groups, stored

BITS, RADIUS, SHINGLE, SEED = 64, 4, 4, 42
#: Buckets with at most so many different fingerprints are compared in one task; larger ones go by midpoints.
BUCKET = 20_000
_BLOCK = 1 << 15


def shingle_hashes(text: bytes, k: int = SHINGLE) -> np.ndarray:
    words = text.lower().split()  # of bytes: A-Z only, and ASCII white space
    if not words:
        return np.empty(0, np.uint64)
    if len(words) <= k:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)], np.uint64)
    line, starts, at = b" ".join(words), [0], 0
    for w in words:
        at += len(w) + 1
        starts.append(at)
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(line[a : b - 1], SEED) for a, b in zip(starts, starts[k:])), np.uint64, len(words) - k + 1)


def fingerprint(text: bytes, k: int = SHINGLE) -> int:
    """64-bit majority, as a signed integer; a text without words has 0."""
    h = shingle_hashes(text, k)
    votes = np.zeros(BITS, np.int64)
    for i in range(0, len(h), _BLOCK):
        votes += np.unpackbits(h[i : i + _BLOCK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * votes > len(h), bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, text_col: str = "text", k: int = SHINGLE) -> DataFrame:
    """Replaces the text by fp, its fingerprint; the other columns stay. Null counts as empty."""
    rest = [c for c in docs.columns if c != text_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(text_col).cast(pa.large_binary())
            fp = np.fromiter((fingerprint(x.as_py() or b"", k) for x in texts), np.int64, len(texts))
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in rest], pa.array(fp)], names=[*rest, "fp"])

    schema = docs.select(*rest).withColumn("fp", F.lit(0).cast("long")).schema
    return arrow_map(docs.select(*rest, text_col), run, schema)


def covering_masks(radius: int = RADIUS, bits: int = BITS) -> list[int]:
    size = 1 << (radius + 1)
    vectors = [i % (size - 1) + 1 for i in range(bits)]
    return [sum(1 << i for i, m in enumerate(vectors) if (m & v).bit_count() & 1) for v in range(1, size)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def forest(x: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the graph that links numbers with at most `radius` differing bits."""
    edges, todo = [], x  # unsigned: bitwise_count takes absolute values
    while len(todo):
        front, todo = [todo[0]], todo[1:]
        while front and len(todo):
            at = front.pop()
            near = np.bitwise_count(todo ^ at) <= radius
            if near.any():
                found = todo[near]
                edges += [(int(at), int(y)) for y in found]
                front += list(found)
                todo = todo[~near]
    return edges


def _forests(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            edges = []
            for members in b.column("members"):
                edges += forest(members.values.to_numpy(zero_copy_only=False).view(np.uint64), radius)
            e = np.array(edges, np.uint64).reshape(-1, 2).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(e[:, 0]), pa.array(e[:, 1])], names=["u", "v"])

    return run


def links(points: DataFrame, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """points: different fingerprints (fp). Edges (u, v) between fingerprints within the radius, enough to connect all
    that are connected by such links, and no others.

    Buckets of 2 are decided by one comparison, those up to `bucket` by a spanning forest made in one task. Members of
    larger buckets are put under every number at most radius / 2 bits away: two fingerprints within the radius share
    such a midpoint, and any two that share one are within the radius, so each is linked to the smallest there. No
    pairs of a group are ever listed.
    """
    masks = [_signed(m) for m in covering_masks(radius)]
    keyed = points.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in masks])).alias("t", "key"))
    sizes = keyed.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    # Spark sizes keyed by the few MB of points, without the rows that posexplode makes, and would broadcast it
    shared = stored(keyed.hint("shuffle_merge").join(sizes, ["t", "key"], "inner"), "simhash-buckets")
    lists = shared.filter(F.col("n") <= bucket).groupBy("t", "key").agg(F.sort_array(F.collect_list("fp")).alias("members")).select("members").distinct()
    lists = stored(lists, "simhash-lists")
    two = lists.filter(F.size("members") == 2).select(F.col("members")[0].alias("u"), F.col("members")[1].alias("v")).filter(F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= radius)
    more = arrow_map(lists.filter(F.size("members") > 2), _forests(radius), "u long, v long")
    edges = two.unionByName(more)
    dense = shared.filter(F.col("n") > bucket).select("fp").distinct()
    if not dense.isEmpty():
        if radius % 2:
            raise ValueError("midpoints need an even radius")
        edges = edges.unionByName(_by_midpoints(dense, radius))
    return edges.distinct()


def _by_midpoints(dense: DataFrame, radius: int) -> DataFrame:
    balls = dense.withColumn("z", F.col("fp"))
    single = F.array(F.lit(0).cast("long"), *[F.lit(_signed(1 << i)) for i in range(BITS)])
    for _ in range(radius // 2):
        balls = balls.select("fp", "z", F.explode(single).alias("_flip")).select("fp", F.col("z").bitwiseXOR(F.col("_flip")).alias("z")).distinct()
    balls = stored(balls, "simhash-midpoints")
    least = stored(balls.groupBy("z").agg(F.min("fp").alias("u"), F.count(F.lit(1)).alias("n")).filter("n > 1"), "simhash-least")
    return join_groups(balls, least, "z", "n").filter("fp <> u").select("u", F.col("fp").alias("v")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node that has an edge; root is the smallest node connected to it.

    Alternating large-star and small-star rounds, each written to the shared folder, until nothing changes: the number
    of rounds grows with the logarithm of the longest chain, and no task needs more than the running minimum of a node.
    Links are few beside the texts; a hub's are split by Spark's skew join.
    """
    def up(e: DataFrame) -> DataFrame:
        return e.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()

    def mark(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    now = stored(up(edges), "components")
    seen = mark(now)
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = up(both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")))
        large = stored(large, "components")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        now = stored(up(small), "components")
        if (after := mark(now)) == seen:
            break
        seen = after
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS, k: int = SHINGLE, bucket: int = BUCKET) -> DataFrame:
    """(_row, id, fp, component_id) for every row. component_id: the smallest id reachable over links of fingerprints
    with at most `radius` differing bits. Null ids are ignored in that minimum; it is null where all are. Texts
    without words have fingerprint 0 and are linked like any other. An empty table gives an empty result."""
    extra = [ROW] if ROW in docs.columns else []
    ids = docs.select(*extra, F.monotonically_increasing_id().alias("_row"), F.col(id_col).cast("long").alias(id_col), F.col(text_col).alias("_text"))
    rows = stored(fingerprints(ids, "_text", k), "simhash")
    points = stored(rows.groupBy("fp").agg(F.count(F.lit(1)).alias("n"), F.min(id_col).alias("least_id")), "simhash-points")
    roots = stored(components(links(points.select("fp"), radius, bucket)), "simhash-roots")
    joined = points.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    joined = stored(joined, "simhash-joined")
    labels = stored(joined.groupBy("root").agg(F.min("least_id").alias("component_id"), F.count(F.lit(1)).alias("_size")), "simhash-labels")
    groups = stored(join_groups(joined, labels, "root", "_size").select("fp", "n", "component_id"), "simhash-groups")
    return join_groups(rows, groups, "fp", "n").select(*extra, "_row", id_col, "fp", "component_id")


def hex64(x: Column) -> Column:
    """16 lowercase hex digits of a 64-bit number."""
    return F.lower(F.lpad(F.hex(x), 16, "0"))
