"""Retrieval metrics as window and aggregate expressions over rows (query, rank, relevant, uncertain)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import wilson


def at_k(results: DataFrame, truth: DataFrame, k: int, query: str = "query_id", digits: int = 9) -> DataFrame:
    """results (query, rank, relevant 0/1), truth (query, n_relevant): precision, recall against min(k, n), coverage, mrr."""
    hits = results.groupBy(query).agg(F.sum(F.when(F.col("rank") <= k, F.col("relevant")).otherwise(0)).alias("hits"), F.min(F.when(F.col("relevant") == 1, F.col("rank"))).alias("first"))
    rows = truth.join(hits, query, "left").withColumn("hits", F.coalesce("hits", F.lit(0)))
    best = F.least(F.lit(k), F.col("n_relevant"))
    r = lambda c: F.round(c, digits)
    return rows.select(query, "hits", r(F.col("hits") / k).alias("precision"), r(F.when(best > 0, F.col("hits") / best).otherwise(0.0)).alias("recall"), r(F.when(F.col("n_relevant") > 0, F.col("hits") / F.col("n_relevant")).otherwise(0.0)).alias("coverage"), r(F.coalesce(1 / F.col("first"), F.lit(0.0))).alias("mrr"))


def bpref_rbp(results: DataFrame, truth: DataFrame, p: float = 0.8, query: str = "query_id", digits: int = 9) -> DataFrame:
    """results (query, rank, relevant, uncertain), truth (query, n_relevant): bpref, where uncertain rows count neither
    way, and the two ends of rank-biased precision, whose distance is what the uncertain rows could add."""
    above = Window.partitionBy(query).orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    known = results.join(truth, query).withColumn("_bad", F.coalesce(F.sum(F.when(~F.col("uncertain") & (F.col("relevant") == 0), 1).otherwise(0)).over(above), F.lit(0)))
    gain = F.when(~F.col("uncertain") & (F.col("relevant") == 1), 1 - F.least("_bad", "n_relevant") / F.col("n_relevant")).otherwise(0.0)
    weight = (1 - p) * F.pow(F.lit(p), F.col("rank") - 1)
    low = F.sum(F.when(~F.col("uncertain") & (F.col("relevant") == 1), weight).otherwise(0.0))
    rest = F.sum(F.when(F.col("uncertain"), weight).otherwise(0.0))
    return known.groupBy(query).agg(F.round(F.sum(gain) / F.first("n_relevant"), digits).alias("bpref"), F.round(low, digits).alias("rbp_low"), F.round(low + rest, digits).alias("rbp_high"))


def corrected_precision(precision: Column, missed: Column, k: int, uncertain: Column) -> Column:
    """Precision corrected by a judged sample. missed: share of the judged uncertain rows that are relevant after all;
    uncertain: mean number of uncertain rows in the top k."""
    return precision + missed * uncertain / k


def proportions(rows: DataFrame, by: list[str], hit: Column, digits: int = 9) -> DataFrame:
    g = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.sum(hit.cast("int")).alias("hits"))
    low, high = wilson(F.col("hits").cast("double"), F.col("n").cast("double"))
    return g.select(*by, "n", "hits", F.round(F.col("hits") / F.col("n"), digits).alias("rate"), F.round(low, digits).alias("low"), F.round(high, digits).alias("high"))


def bootstrap(values: DataFrame, value: str, resamples: int = 4000, seed: int = 20260804, linear: bool = True) -> DataFrame:
    """Interval of the mean by a Poisson bootstrap whose weights come from a hash of (row, resample): each row is weighed
    where it lies, so that no row has to be fetched by number, and reruns agree. For paired runs give the differences.

    values: (id, value). One row: mean, low, high (2.5 and 97.5 percentiles), verdict by the interval's sign. linear:
    percentiles between two resamples; else those at int(part * resamples) of the sorted list, one short number each.
    Resamples in which every weight is 0 don't count.
    """
    u = (F.pmod(F.xxhash64("id", F.col("b"), F.lit(seed)), F.lit(1 << 30)) + 0.5) / float(1 << 30)
    weight, step, total = F.lit(0), 1.0, 0.0
    for n in range(1, 17):  # chances of a Poisson variable of mean 1; beyond, below 1e-15
        total += 2.718281828459045**-1 * step
        weight, step = weight + (u > total).cast("int"), step / n
    draws = values.select("id", value, F.explode(F.sequence(F.lit(1), F.lit(resamples))).alias("b")).withColumn("w", weight)
    means = draws.groupBy("b").agg(F.try_divide(F.sum(F.col("w") * F.col(value)), F.sum("w")).alias("m"))
    if linear:
        ends = means.agg(F.percentile("m", F.lit(0.025)).alias("low"), F.percentile("m", F.lit(0.975)).alias("high"))
    else:
        ranked = F.sort_array(F.collect_list("m"))  # `resamples` numbers
        ends = means.agg(ranked.alias("s")).select(*[F.get("s", (F.size("s") * part).cast("int")).alias(n) for n, part in (("low", 0.025), ("high", 0.975))])
    verdict = F.when(F.col("low") > 0, "better").when(F.col("high") < 0, "worse").otherwise("equal")
    return values.agg(F.avg(value).alias("mean")).crossJoin(ends).withColumn("verdict", verdict)


def metrics_by(rows: DataFrame, levels: list[list[str]], metrics: list[str], digits: int = 9) -> DataFrame:
    """Macro averages on several levels at once; columns that a level does not have are null."""
    every = sorted({c for x in levels for c in x})
    return rows.groupingSets([[F.col(c) for c in x] for x in levels], *every).agg(F.count(F.lit(1)).alias("n"), *[F.round(F.avg(m), digits).alias(m) for m in metrics]).select(*every, "n", *metrics)


def choose(variants: DataFrame) -> DataFrame:
    """variants (variant, recall, low_delta, homogeneity): the best recall, then, among those whose difference to it is
    not clear (low_delta <= 0; the best has none of its own, null), the least homogeneous."""
    return variants.filter(F.coalesce("low_delta", F.lit(0.0)) <= 0).orderBy("homogeneity", F.desc("recall"), "variant").limit(1)


def rank_class(ranks: DataFrame, query: str, k: int = 10, depth: int = 50) -> DataFrame:
    """Per query: found in the top k, seen but ranked too low, or never seen."""
    g = ranks.groupBy(query).agg(F.min(F.when(F.col("relevant") == 1, F.col("rank"))).alias("first"))
    return g.withColumn("class", F.when(F.col("first") <= k, f"top {k}").when(F.col("first") <= depth, "seen").otherwise("never seen"))


def success_stats(measures: DataFrame, by: list[str], digits: int = 9) -> DataFrame:
    """measures (by, precision, useful, abstained): per group the questions, mean precision, share with at least one
    useful row, median of useful rows, abstentions, and the questions with none, and with 3 or more."""
    u = F.col("useful")
    return measures.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("precision"), digits).alias("precision"), F.round(F.avg((u >= 1).cast("int")), digits).alias("success"), F.percentile("useful", F.lit(0.5)).alias("median_useful"),
        F.count_if("abstained").alias("abstentions"), F.count_if(u == 0).alias("without"), F.count_if(u >= 3).alias("three_or_more"),
    )


def compare_systems(measures: DataFrame, query: str, system: str, by: list[str], digits: int = 9) -> DataFrame:
    """measures (query, system, returned, useful, k): two or more systems on the questions that all of them answered, at
    equal k: questions, precision, success, median of useful rows, rows returned, useful ones, abstentions."""
    systems = measures.agg(F.countDistinct(system).alias("_n"))
    shared = measures.groupBy(query).agg(F.countDistinct(system).alias("_own")).crossJoin(F.broadcast(systems)).filter("_own = _n").select(query)  # one row is broadcast
    m = measures.join(shared, query, "left_semi")
    return m.groupBy(*by, system).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg(F.col("useful") / F.greatest(F.lit(1), F.col("k"))), digits).alias("precision"), F.round(F.avg((F.col("useful") > 0).cast("int")), digits).alias("success"), F.percentile("useful", F.lit(0.5)).alias("median_useful"),
        F.sum("returned").alias("returned"), F.sum("useful").alias("useful"), F.count_if(F.col("returned") == 0).alias("abstentions"))


def useful_histogram(measures: DataFrame, by: list[str]) -> DataFrame:
    return measures.groupBy(*by, "useful").agg(F.count(F.lit(1)).alias("questions"))


def multiplicity(chunks: DataFrame, retrieved: DataFrame, owner: str, digits: int = 9) -> DataFrame:
    """Mean chunks per owner in the index and among those retrieved, and their ratio: how much owners with many chunks
    are favoured. retrieved: one row per owner (or owner and question) that came back."""
    n = chunks.groupBy(owner).agg(F.count(F.lit(1)).alias("_n"))
    back = retrieved.select(owner).join(n, owner)
    a, b = n.agg(F.avg("_n").alias("population")), back.agg(F.avg("_n").alias("retrieved"))
    both = a.crossJoin(F.broadcast(b))  # one row each
    return both.select(F.round("population", digits).alias("population"), F.round("retrieved", digits).alias("retrieved"), F.round(F.col("retrieved") / F.col("population"), digits).alias("bias"))


def filter_gain(plain: DataFrame, filtered: DataFrame, k: int, query: str = "query_id", digits: int = 9) -> DataFrame:
    """Two rankings (query, rank, relevant) of the same questions, without and with a filter: precision at k of both and
    the difference, for the questions that have a filtered ranking."""
    p = lambda d, name: d.groupBy(query).agg((F.sum(F.when(F.col("rank") <= k, F.col("relevant")).otherwise(0)) / k).alias(name))
    j = p(filtered, "with_filter").join(p(plain, "without"), query)
    return j.select(query, F.round("without", digits).alias("without"), F.round("with_filter", digits).alias("with_filter"), F.round(F.col("with_filter") - F.col("without"), digits).alias("gain"))


def admissible(golden: Column, found: Column) -> Column:
    """A filter is kept only if it holds all of the golden ids and more."""
    missing, more = F.size(F.array_except(golden, found)), F.size(F.array_except(found, golden))
    return F.when(missing > 0, "incomplete").when(more == 0, "equal").otherwise("kept")
