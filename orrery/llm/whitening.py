"""Whitening of embeddings by a tiled covariance.

The fit list, cut into blocks of rows, is split into blocks of columns, which are shuffled by their block of rows. There
every pair of column blocks is multiplied to its tile of the covariance; a task adds up the tiles of all its blocks of
rows, and Spark adds up the tasks' tiles. Only the matrix itself, dimensions squared, comes to the driver.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, stored

#: Steps of one unit in which entries are counted.
SCALE = 256
COMPONENTS = 4
#: Columns of a column block, so a tile is this wide and high; rows of a row block.
TILE, ROWS = 32, 4096
#: Eigenvalues at most this part of the largest are rounding and count as zero.
LEAST = 1e-12
_MOST = 2**63 - 1


def _finite(vector: Column, dims: int | None = None) -> Column:
    good = vector.isNotNull() & F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    return good if dims is None else good & (F.size(vector) == dims)


def quantised(rows: DataFrame, vector_col: str = "embedding", out: str = "x", scale: int = SCALE) -> DataFrame:
    """rows without those whose vector is null or holds null or non-finite entries, with the vector as longs:
    floor(scale * entry). Vectors of another length than most have (of equally frequent ones the longest) cannot be
    placed in the same space and are left out too. An entry whose long would not fit in 53 bits is an error."""
    v = F.col(vector_col)
    usable = rows.filter(_finite(v))
    sizes = usable.groupBy(F.size(v).alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    dims = sizes["n"] if sizes else 0
    as_long = lambda c: F.when(F.abs(c.cast("double") * scale) < F.lit(2.0**53), F.floor(c.cast("double") * scale)).otherwise(F.raise_error(F.lit("an entry is too large to be counted exactly")))
    return usable.filter(F.size(v) == dims).withColumn(out, F.transform(v, lambda c: as_long(c).cast("long")))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def column_blocks(fit: DataFrame, dims: int, tile: int = TILE, rows: int = ROWS) -> DataFrame:
    """(row_block, column_block, data) of the vectors x of the fit list, in the narrowest integers that hold them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for b in batches:
            x = _matrix(b.column("x"), dims)
            for i in range(0, len(x), rows):
                part = x[i : i + rows]
                width = next((w for w in (1, 2, 4) if np.abs(part).max(initial=0) < 1 << 8 * w - 1), 8)
                data = [np.ascontiguousarray(part[:, c : c + tile], f"<i{width}").tobytes() for c in range(0, dims, tile)]
                yield pa.RecordBatch.from_pydict({"row_block": [block] * len(data), "column_block": list(range(len(data))), "width": [width] * len(data), "data": data})
                block += 1

    return arrow_map(fit.select("x"), run, "row_block long, column_block long, width long, data binary")


def covariance_tiles(blocks: DataFrame, sums: list[int], n: int, tile: int = TILE) -> DataFrame:
    """(i, j, values) for i <= j: the sums over all n rows of the products of centred columns, a tile row by row. The
    column blocks of a row block meet in one task; it holds those of one row block and the tiles, dimensions squared."""
    mean = _mean(sums, n)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tiles: dict[tuple[int, int], np.ndarray] = {}
        held, own = None, {}

        def multiply() -> None:
            for i in own:
                for j in own:
                    if i <= j:
                        product = own[i].T @ own[j]
                        tiles[i, j] = tiles[i, j] + product if (i, j) in tiles else product

        for b in batches:
            for r, c, w, data in zip(*[b.column(n).to_pylist() for n in ("row_block", "column_block", "width", "data")]):
                if r != held:
                    multiply()
                    held, own = r, {}
                whole, rest = (m[c * tile : (c + 1) * tile] for m in mean)
                own[c] = (np.frombuffer(data, f"<i{w}").reshape(-1, len(whole)) - whole) - rest  # centred before multiplying
        multiply()
        for (i, j), t in tiles.items():
            n = t.size
            yield pa.RecordBatch.from_pydict({"i": np.full(n, i), "j": np.full(n, j), "place": np.arange(n), "value": t.ravel()})

    met = blocks.repartition("row_block").sortWithinPartitions("row_block")
    summed = arrow_map(met, run, "i long, j long, place long, value double").groupBy("i", "j", "place").agg(F.sum("value").alias("value"))
    ordered = F.array_sort(F.collect_list(F.struct("place", "value")))  # tile * tile of them
    return summed.groupBy("i", "j").agg(F.transform(ordered, lambda x: x["value"]).alias("values"))


def assembled(tiles: DataFrame, dims: int, n: int, tile: int = TILE) -> np.ndarray:
    """The covariance of n rows: at most dims * dims values come to the driver."""
    out = np.zeros((dims, dims))
    for i, j, values in tiles.collect():
        r, c = slice(i * tile, min(dims, (i + 1) * tile)), slice(j * tile, min(dims, (j + 1) * tile))
        part = np.array(values).reshape(r.stop - r.start, c.stop - c.start) / n
        out[r, c], out[c, r] = part, part.T
    return out


def components(covariance: np.ndarray, most: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(unit eigenvectors as rows, eigenvalues, explained shares) by falling eigenvalue, at most `most`."""
    if not len(covariance):
        return np.empty((0, 0)), np.empty(0), np.empty(0)
    e, v = np.linalg.eigh(covariance)
    order = np.argsort(-e, kind="stable")[:most]
    e = np.where(e > max(e.max(initial=0.0), 0.0) * LEAST, e, 0.0)
    trace = np.trace(covariance)
    return v[:, order].T, e[order], e[order] / trace if trace > 0 else np.full(len(order), np.nan)


def exact_deviation(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum over dimensions of (n*x - S)^2 of each row, exact; None where it is beyond a long."""
    if not len(x):
        return []
    reach = max(n * int(np.abs(x).max()), max(map(abs, sums))) * 2
    if reach * reach * x.shape[1] <= _MOST:
        return ((n * x - np.array(sums, np.int64)) ** 2).sum(1).tolist()
    out = []
    for row in x.tolist():
        d = sum((n * a - s) ** 2 for a, s in zip(row, sums))
        out.append(d if d <= _MOST else None)
    return out


def whiten(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", most: int = COMPONENTS, scale: int = SCALE, tile: int = TILE, row_block: int = ROWS) -> DataFrame:
    """For each usable row and component: the id, component (from 1), n, deviation, whitened, explained, identity_error.

    The fit list holds each different vector once, so copies weigh nothing. Rows without a usable vector are dropped
    (`quantised`); ids may be null or repeated, each row gives its own; other columns don't matter. An empty table, or
    one of empty vectors, gives no rows. A component without variance (a single different vector, constant dimensions)
    has whitened null and explained 0, null if there is no variance at all, and takes no part in identity_error.
    deviation is null where it would not fit in a long.
    """
    spark = rows.sparkSession
    given = stored(quantised(rows.select(F.col(id_col).alias("id"), F.col(vector_col).alias("v")), "v", "x", scale).select("id", "x"), "whiten")
    fit = stored(given.select("x").distinct(), "whiten-fit")
    dims = (fit.select(F.size("x").alias("d")).first() or {"d": 0})["d"]
    n = fit.count()
    id_type = given.schema["id"].dataType.simpleString()
    schema = f"`{id_col}` {id_type}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if not dims:
        return spark.createDataFrame([], schema)
    sums_by = fit.select(F.posexplode("x")).groupBy("pos").agg(F.sum(F.col("col").cast("decimal(38,0)")).alias("s")).orderBy("pos").collect()  # one row a dimension
    sums = [int(r["s"]) for r in sums_by]
    blocks = stored(column_blocks(fit, dims, tile, row_block), "whiten-blocks")
    vectors, e, explained = components(assembled(covariance_tiles(blocks, sums, n, tile), dims, n, tile), most)
    scale_by = np.divide(1.0, np.sqrt(e), out=np.full(len(e), np.nan), where=e > 0)
    error = _identity_error(fit, vectors, scale_by, sums, n)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(e)
        nan_null = lambda v: pa.array(v, pa.float64(), from_pandas=True)
        for b in batches:
            x = _matrix(b.column("x"), dims)
            at = np.repeat(np.arange(len(x)), k)
            dev = exact_deviation(x, n, sums)
            w = _centred(x, n, sums) @ vectors.T * scale_by
            yield pa.RecordBatch.from_arrays(
                [b.column("id").take(pa.array(at)), pa.array(np.tile(np.arange(1, k + 1), len(x)), pa.int32()), pa.array(np.full(len(at), n)), pa.array([d for d in dev for _ in range(k)], pa.int64()), nan_null(w.ravel()), nan_null(np.tile(explained, len(x))), nan_null(np.full(len(at), error))],
                names=[id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return arrow_map(given, run, schema)


def _mean(sums: list[int], n: int) -> tuple[np.ndarray, np.ndarray]:
    """S/n as its whole part and the rest, so that taking it off costs no digits where it is large."""
    return np.array([s // n for s in sums], np.int64), np.array([(s % n) / n for s in sums])


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    whole, rest = _mean(sums, n)
    return (x - whole) - rest


def _identity_error(fit: DataFrame, vectors: np.ndarray, scale_by: np.ndarray, sums: list[int], n: int) -> float:
    """Largest absolute entry of the covariance of the whitened fit list minus the identity, measured on the list."""
    used = np.flatnonzero(~np.isnan(scale_by))
    if not len(used):
        return float("nan")
    dims = len(sums)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, int], float] = defaultdict(float)
        for b in batches:
            w = (_centred(_matrix(b.column("x"), dims), n, sums) @ vectors.T * scale_by)[:, used]
            w1 = np.hstack([w, np.ones((len(w), 1))])
            for (i, j), v in np.ndenumerate(w1.T @ w1):
                total[i, j] += float(v)
        if total:
            yield pa.RecordBatch.from_pydict({"i": [i for i, _ in total], "j": [j for _, j in total], "value": list(total.values())}, pa.schema([("i", pa.int64()), ("j", pa.int64()), ("value", pa.float64())]))

    found = arrow_map(fit, run, "i long, j long, value double").groupBy("i", "j").agg(F.sum("value").alias("value")).collect()  # (components + 1) squared
    k = len(used)
    second, first = np.zeros((k, k)), np.zeros(k)
    for r in found:
        if r["i"] < k and r["j"] < k:
            second[r["i"], r["j"]] = r["value"] / n
        elif r["i"] < k:
            first[r["i"]] = r["value"] / n
    return float(np.abs(second - np.outer(first, first) - np.eye(k)).max())
