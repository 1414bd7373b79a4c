"""A stored vector index: points partitioned by a payload field and by the nearest of some centroids.

The centroids are fitted on a bounded sample; every point is stored, as a unit vector, with the cell of its nearest
centroid. A search reads the cells that lie nearest to the queries, and only the payload values that it asks for; what
it reads is ranked exactly. The exact mode then reads every further cell that could still hold a better point, which
each cell's radius tells.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.scalars import cosine, dot
from ..sources.sinks import written

#: Bound of the rows that the centroids are fitted on, and of the queries that the number of probes is measured on.
SAMPLE_ROWS, SAMPLE_QUERIES = 50_000, 100
#: Queries that are sent to every task at once; more meet the points in shuffled parts.
FEW = 1000
#: Parts into which a cell is dealt when queries are not broadcast, so that a large cell is many tasks.
PARTS = 16
_EPS = 1e-9


def unit(v: Column) -> Column:
    """The vector at length 1, in doubles; a zero vector stays zero."""
    n = F.greatest(F.sqrt(dot(v, v)), F.lit(1e-12))
    return F.transform(v, lambda x: x.cast("double") / n)


def usable(v: Column) -> Column:
    return v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))


@dataclass
class VectorIndex:
    """An index at a path: points/ (payload, cell), their columns in shape/, and cells/ (cell, centroid, n, cosine of its radius)."""

    spark: SparkSession
    path: str
    payload: str | None = None

    def points(self) -> DataFrame:
        shape = self.spark.read.parquet(f"{self.path}/shape").schema  # an empty index has no files of points
        return self.spark.read.schema(shape).parquet(f"{self.path}/points")

    def cells(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/cells")


def build(points: DataFrame, path: str, cells: int, id_col: str = "id", vector: str = "embedding", payload: str | None = None, sample: int = SAMPLE_ROWS, seed: int = 42) -> VectorIndex:
    """Stores an index of points. Rows without a usable vector cannot be found and are left out; ids may repeat, and other
    columns are kept. The sample is chosen by a hash of the id, about `sample` rows; an empty table gives an empty index."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    spark = points.sparkSession
    rows = written(points.filter(usable(F.col(vector))).withColumn("_unit", unit(F.col(vector))), "index-points")
    n = rows.count()
    share = min(1.0, sample / max(1, n))
    some = written(rows.filter(F.pmod(F.xxhash64(F.col(id_col), F.lit(seed)), F.lit(1 << 30)) < int(share * (1 << 30))).select("_unit"), "index-sample")
    centres = []
    if some.take(1):
        model = KMeans(k=cells, seed=seed, maxIter=15, featuresCol="f", tol=1e-3).fit(some.select(array_to_vector("_unit").alias("f")))
        centres = [[float(x) for x in c] for c in model.clusterCenters()]
        centres = [[x / (math.sqrt(sum(y * y for y in c)) or 1.0) for x in c] for c in centres]
    table = spark.createDataFrame(list(enumerate(centres)), "cell int, centre array<double>")
    told = F.array(*[F.array(*map(F.lit, c)) for c in centres]) if centres else F.array().cast("array<array<double>>")
    near = F.transform(told, lambda c, i: F.struct((-dot(F.col("_unit"), c)).alias("s"), i.cast("int").alias("cell")))
    placed = rows.withColumn("_near", F.array_min(near)).withColumn("cell", F.col("_near.cell")).withColumn("_cos", -F.col("_near.s")).drop("_near")
    by = [payload, "cell"] if payload else ["cell"]
    # a large cell is dealt into several files, so that no task writes it alone
    placed.repartition(*by, F.pmod(F.xxhash64(id_col), F.lit(8))).write.partitionBy(*by).parquet(f"{path}/points")
    placed.limit(0).coalesce(1).write.parquet(f"{path}/shape")
    spread = spark.read.schema(placed.schema).parquet(f"{path}/points").groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.min("_cos").alias("radius_cos"))
    table.join(spread, "cell", "left").coalesce(1).write.parquet(f"{path}/cells")
    return VectorIndex(spark, path, payload)


def _scored(index: VectorIndex, queries: DataFrame, probes: DataFrame, where: Column | None, id_col: str) -> DataFrame:
    """(query_id, id, score) of the points in the probed cells. The cells' numbers reach the scan as a partition filter."""
    cells = [r["cell"] for r in probes.select("cell").distinct().collect()]  # at most as many as there are cells
    points = index.points().filter(F.col("cell").isin(cells) if cells else F.lit(False))
    points = (points if where is None else points.filter(F.coalesce(where, F.lit(False)))).select(F.col(id_col).alias("id"), "_unit", "cell")
    asked = probes.join(queries, "query_id")
    if queries.count() <= FEW:
        met = points.join(F.broadcast(asked), "cell")
    else:
        met = points.withColumn("_part", F.pmod(F.xxhash64("id"), F.lit(PARTS)).cast("int")).join(asked.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1)))), ["cell", "_part"])
    return met.select("query_id", "id", "cell", dot(F.col("_q"), F.col("_unit")).alias("score"))


def _best(scored: DataFrame, k: int, digits: int) -> DataFrame:
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return scored.withColumn("score", F.round("score", digits)).withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def _asked(queries: DataFrame, query_id: str, vector: str) -> DataFrame:
    return written(queries.filter(usable(F.col(vector))).select(F.col(query_id).alias("query_id"), unit(F.col(vector)).alias("_q")), "index-queries")


def _cells_by_query(index: VectorIndex, asked: DataFrame) -> DataFrame:
    """(query_id, cell, near, bound): cosine to the centroid and the most that a point of the cell can have; a row a query and
    cell."""
    c = index.cells().filter("n > 0")
    met = asked.crossJoin(F.broadcast(c))  # cells are few, by their parameter
    near = F.least(F.lit(1.0), F.greatest(F.lit(-1.0), dot(F.col("_q"), F.col("centre"))))
    to_edge = F.acos(near) - F.acos(F.least(F.lit(1.0), F.greatest(F.lit(-1.0), F.col("radius_cos"))))
    return met.select("query_id", "cell", near.alias("near"), F.cos(F.greatest(F.lit(0.0), to_edge)).alias("bound"))


def _order(index: VectorIndex, asked: DataFrame) -> DataFrame:
    """The cells with each query's place for them, the nearest first."""
    return written(_cells_by_query(index, asked).withColumn("place", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("near"), "cell"))), "index-cells")


def search(index: VectorIndex, queries: DataFrame, k: int, probes: int | None = None, where: Column | None = None, query_id: str = "query_id", vector: str = "q", id_col: str = "id", digits: int = 9) -> DataFrame:
    """(query_id, id, score, rank) of the k best points, ties by id. probes: how many cells a query reads; None is exact: the
    cells that lie nearest are read first, then each further one that could hold a better point than the k-th found.

    where: a filter on the stored columns; one on the payload field prunes its folders. Queries without a usable vector,
    and an empty index, give no rows. A repeated query id is one query with the rows of both.
    """
    asked = _asked(queries, query_id, vector)
    return _search(index, asked, _order(index, asked), k, probes, where, id_col, digits).drop("cell")


def _search(index: VectorIndex, asked: DataFrame, order: DataFrame, k: int, probes: int | None, where: Column | None, id_col: str, digits: int) -> DataFrame:
    first = order.filter(F.col("place") <= (probes or 2)).select("query_id", "cell")
    found = _best(_scored(index, asked, first, where, id_col), k, digits)
    if probes is not None:
        return found
    found = written(found, "index-found")
    reached = found.groupBy("query_id").agg(F.min("score").alias("least"), F.count(F.lit(1)).alias("n"))
    open_ = order.filter("place > 2").join(reached, "query_id", "left").filter((F.coalesce("n", F.lit(0)) < k) | (F.col("bound") >= F.col("least") - _EPS)).select("query_id", "cell")
    more = _best(_scored(index, asked, written(open_, "index-more"), where, id_col), k, digits)
    return _best(found.drop("rank").unionByName(more.drop("rank")), k, digits)


def recall(found: DataFrame, truth: DataFrame) -> DataFrame:
    """(query_id, n, hits, recall): the share of the truth's rows that were found; queries without any have none."""
    both = truth.select("query_id", "id").join(found.select("query_id", "id").withColumn("_hit", F.lit(1)), ["query_id", "id"], "left")
    return both.groupBy("query_id").agg(F.count(F.lit(1)).alias("n"), F.count("_hit").alias("hits")).withColumn("recall", F.col("hits") / F.col("n"))


def probes_for(index: VectorIndex, queries: DataFrame, k: int, least: float = 0.92, where: Column | None = None, query_id: str = "query_id", vector: str = "q", id_col: str = "id", seed: int = 42) -> int:
    """The fewest probes that reach the recall on about SAMPLE_QUERIES of the queries: the exact mode tells in which cells
    the best points lie, and each query's order of cells how many it has to read to find them."""
    n = queries.count()
    part = min(1.0, SAMPLE_QUERIES / max(1, n))
    some = _asked(queries.filter(F.pmod(F.xxhash64(query_id, F.lit(seed)), F.lit(1 << 30)) < int(part * (1 << 30))), query_id, vector)
    order = _order(index, some)
    truth = _search(index, some, order, k, None, where, id_col, 9)
    found = dict(truth.join(order, ["query_id", "cell"]).groupBy("place").count().collect())  # a row a cell at most
    reached, total = 0, sum(found.values())
    for place in sorted(found):
        reached += found[place]
        if reached >= least * total:
            return place
    return 1


def exhaustive(points: DataFrame, queries: DataFrame, k: int, where: Column | None = None, query_id: str = "query_id", vector: str = "q", id_col: str = "id", embedding: str = "embedding", digits: int = 9) -> DataFrame:
    """The same from the points themselves, every one read: for measuring. queries: a stated set."""
    from .search import against

    rows = points.filter(usable(F.col(embedding)))
    rows = (rows if where is None else rows.filter(F.coalesce(where, F.lit(False)))).select(F.col(id_col).alias("id"), F.col(embedding).alias("_v"))
    asked = queries.filter(usable(F.col(vector))).select(F.col(query_id).alias("query_id"), F.col(vector).alias("_w"))
    return _best(against(rows, asked).select("query_id", "id", cosine(F.col("_w"), F.col("_v")).alias("score")), k, digits)
