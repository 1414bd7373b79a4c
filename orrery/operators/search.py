"""Filtered cosine search with distinct owners, and vector statistics.

Queries are a stated set; the corpus is never cross-joined row by row with itself. A query set of at most `few` rows is
broadcast; a larger one is dealt into blocks of about that many, and every block meets every partition of the corpus.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import cosine, dot, hash_order
from ..sources.sinks import written


def keep_rows(must: Column | None = None, must_not: Column | None = None) -> Column:
    """must: null counts as false; must_not keeps rows where it is null."""
    out = F.lit(True)
    if must is not None:
        out = out & F.coalesce(must, F.lit(False))
    if must_not is not None:
        out = out & ~F.coalesce(must_not, F.lit(False))
    return out


def against(rows: DataFrame, queries: DataFrame, few: int = 1000) -> DataFrame:
    """Every row with every query of a stated set, in blocks of about `few` queries."""
    n = queries.count()
    if n <= few:
        return rows.crossJoin(F.broadcast(queries))
    return rows.crossJoin(queries.repartition(-(-n // few)).hint("shuffle_replicate_nl"))


def scores(queries: DataFrame, corpus: DataFrame, few: int = 1000) -> DataFrame:
    """queries (query_id, q), corpus (id, owner, embedding): all pairs of a query and a row with their cosine."""
    return against(corpus, queries, few).withColumn("score", _cosine_columns("q", "embedding")).drop("q", "embedding")


def _cosine_columns(a: str, b: str) -> Column:
    return cosine(F.col(a), F.col(b))


def top_owners(scored: DataFrame, k: int, digits: int = 9) -> DataFrame:
    """Best score of each owner, the k best owners per query, ties by owner: (query_id, owner, score, rank).

    The maximum per owner comes first, so that an owner with many chunks costs the ranking nothing.
    """
    best = scored.groupBy("query_id", "owner").agg(F.round(F.max("score"), digits).alias("score"))
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "owner")
    return best.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def top_rows(scored: DataFrame, k: int, digits: int = 9) -> DataFrame:
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return scored.withColumn("score", F.round("score", digits)).withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def judged(scored: DataFrame, relevant: Column, k: int, digits: int = 9) -> tuple[DataFrame, DataFrame]:
    """(rows, truth) for the metrics: rows are the k best of each query with their rank and relevant (0 or 1), and, where
    it lies deeper, the first relevant row; truth has n_relevant per query.

    The first relevant row's rank is 1 + the number of better rows, an aggregate, so that no query's rows are sorted as
    a whole; the k best are cut in every partition before the shuffle. Both tables have a few rows a query and are
    written, so `scored` is worked out three times whatever is made of them: for what is relevant, for the k best, and for
    the rows that are better than the first relevant one.
    """
    s = scored.withColumn("relevant", relevant.cast("int")).withColumn("score", F.round("score", digits))
    place = F.struct((-F.col("score")).alias("s"), F.col("id").alias("id"))
    told = written(s.groupBy("query_id").agg(F.sum("relevant").alias("n_relevant"), F.min(F.when(F.col("relevant") == 1, place)).alias("_b")), "judged-truth")
    best = told.filter("_b is not null").select("query_id", "_b")
    better = s.join(F.broadcast(best) if best.count() <= 1000 else best, "query_id").filter(place < F.col("_b")).groupBy("query_id").agg(F.count(F.lit(1)).alias("n"))
    deep = best.join(better, "query_id", "left").select("query_id", F.col("_b.id").alias("id"), (F.coalesce("n", F.lit(0)) + 1).cast("int").alias("rank"), F.lit(1).alias("relevant"))
    top = top_rows(s, k, digits).select("query_id", "id", "rank", "relevant")
    return written(top.unionByName(deep.filter(F.col("rank") > k)), "judged-rows"), told.select("query_id", "n_relevant")


def per_type_sample(rows: DataFrame, key: str, kind: str, targets: list[str], per_type: int, others: int, least: int = 5, seed: int = 0) -> DataFrame:
    """(key, kind, role): `per_type` rows of each target kind that has at least `least`, and `others` rows of the kinds
    that are no target, in a reproducible random order of their keys. A sampling operator: the numbers are the feature."""
    is_target = F.coalesce(F.col(kind).isin(*targets), F.lit(False))
    order = [hash_order(F.col(key), seed=seed), F.col(key)]
    big = rows.filter(is_target).groupBy(kind).count().filter(F.col("count") >= least).select(kind)
    a = rows.filter(is_target).join(big, kind, "left_semi").select(key, kind).withColumn("_r", F.row_number().over(Window.partitionBy(kind).orderBy(*order))).filter(F.col("_r") <= per_type)
    b = rows.filter(~is_target).select(key, kind).orderBy(*order).limit(others)
    return a.select(key, kind, F.lit("target").alias("role")).unionByName(b.select(key, kind, F.lit("distractor").alias("role")))


def sum_vector(rows: DataFrame, vector: str, by: list[str]) -> DataFrame:
    """Per group: n and the sum of the unit vectors, component by component, without gathering vectors."""
    unit = rows.withColumn("_n", F.greatest(F.sqrt(dot(F.col(vector), F.col(vector))), F.lit(1e-12)))
    parts = unit.select(*by, F.posexplode(vector).alias("_i", "_x"), "_n").groupBy(*by, "_i").agg(F.sum(F.col("_x").cast("double") / F.col("_n")).alias("_s"), F.count(F.lit(1)).alias("n"))
    return parts.groupBy(*by).agg(F.max("n").alias("n"), F.sum(F.col("_s") * F.col("_s")).alias("square"))


def homogeneity(rows: DataFrame, vector: str = "embedding", by: list[str] | None = None) -> DataFrame:
    """Mean cosine of all pairs, from the square of the sum of unit vectors: no pairs are listed."""
    s = sum_vector(rows, vector, by or [])
    return s.withColumn("homogeneity", F.when(F.col("n") > 1, (F.col("square") - F.col("n")) / (F.col("n") * (F.col("n") - 1)))).drop("square")


def separation(queries: DataFrame, corpus: DataFrame) -> DataFrame:
    """Mean cosine of the pairs of a query and a row whose owner is the wanted one, less that of the others; pairs of equal
    ids, and with a null owner, wanted or score, don't count.

    queries (query_id, q, wanted), corpus (id, owner, embedding). A sum of cosines is a product of sums of unit vectors,
    so no pairs are listed, except those of vectors so short that the cosine's least divisor could matter, or not finite.
    """
    def side(df: DataFrame, key: str, vector: str, label: str) -> tuple[DataFrame, DataFrame]:
        named = df.select(F.col(key).alias("key"), F.col(label).alias("label"), F.col(vector).alias("v"))
        rows = named.filter(F.col("key").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & ~F.exists("v", lambda x: x.isNull())).withColumn("norm", F.sqrt(dot(F.col("v"), F.col("v"))))
        usual = (F.col("norm") == 0) | F.col("norm").between(1e-6, 1e150)
        return rows.filter(usual), rows.filter(~usual)

    def sums(rows: DataFrame, *by: str) -> DataFrame:
        """Sums of the components, and behind the last one how many vectors."""
        unit = F.transform("v", lambda x: F.when(F.col("norm") > 0, x.cast("double") / F.col("norm")).otherwise(0.0))
        return rows.select(*by, F.size("v").alias("d"), F.posexplode(F.concat(unit, F.array(F.lit(1.0)))).alias("i", "x")).groupBy(*by, "d", "i").agg(F.sum("x").alias("s"))

    def product(a: DataFrame, b: DataFrame, inside: bool, sign: int, *by: str) -> DataFrame:
        on = [*by, "d", "i"]
        both = a.withColumnRenamed("s", "a").join(b.withColumnRenamed("s", "b"), on).withColumn("x", sign * F.col("a") * F.col("b"))
        counts = F.col("i") == F.col("d")
        return both.agg(F.lit(inside).alias("inside"), F.sum(F.when(~counts, F.col("x"))).alias("sum"), F.sum(F.when(counts, F.col("x"))).alias("n"))

    (q, odd_q), (c, odd_c) = side(queries, "query_id", "q", "wanted"), side(corpus, "id", "embedding", "owner")
    own = c.join(q.select("key").distinct(), "key", "left_semi")
    parts = []
    for inside, by in ((True, ["label"]), (None, [])):
        parts += [product(sums(q, *by), sums(c, *by), inside, 1, *by), product(sums(q, "key", *by), sums(own, "key", *by), inside, -1, "key", *by)]
    # what is left: odd queries with all rows, usual ones with odd rows
    names = lambda d, a, b, e: d.select(F.col("key").alias(a), F.col("v").alias(b), F.col("label").alias(e))
    rest = None
    for a, b in ((odd_q, c.unionByName(odd_c)), (q, odd_c)):
        if not a.isEmpty() and not b.isEmpty():
            s = scores(names(a, "query_id", "q", "wanted"), names(b, "id", "embedding", "owner")).filter("id <> query_id")
            rest = s if rest is None else rest.unionByName(s)
    if rest is not None:
        for inside in (True, None):
            kept = rest.filter("owner = wanted") if inside else rest
            parts.append(kept.agg(F.lit(inside).cast("boolean").alias("inside"), F.sum("score").alias("sum"), F.count("score").cast("double").alias("n")))
    found = parts[0]
    for x in parts[1:]:
        found = found.unionByName(x)
    total = lambda inside, x: F.coalesce(F.sum(F.when(F.col("inside").isNotNull() if inside else F.col("inside").isNull(), F.col(x))), F.lit(0.0))
    t = found.agg(total(True, "sum").alias("s"), total(True, "n").alias("n"), total(False, "sum").alias("all_s"), total(False, "n").alias("all_n"))
    mean = lambda s, n: F.when(n > 0.5, s / n)
    return t.select((mean(F.col("s"), F.col("n")) - mean(F.col("all_s") - F.col("s"), F.col("all_n") - F.col("n"))).alias("separation"))


def hash_sample(rows: DataFrame, key: str, n: int, seed: int = 0) -> DataFrame:
    """n rows in a reproducible random order of their key; a sampling operator, so its limit is the feature."""
    return rows.orderBy(hash_order(F.col(key), seed=seed), key).limit(n)
