"""Profiles of columns, categories, titles and families."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import all_matches, strip
from ..sources.sinks import written


def fill_rates(df: DataFrame, columns: Sequence[str] | None = None, digits: int = 9) -> DataFrame:
    """(column, filled, rate), in one pass over the table; blank text is not filled."""
    columns = list(columns or df.columns)
    kinds = dict(df.dtypes)
    filled = lambda c: F.count(F.when(strip(F.col(c)) != "", 1)) if kinds[c] == "string" else F.count(c)
    one = df.agg(F.count(F.lit(1)).alias("_n"), *[filled(c).alias(c) for c in columns])
    return one.unpivot("_n", columns, "column", "filled").select("column", "filled", F.round(F.col("filled") / F.col("_n"), digits).alias("rate"))


def text_lengths(df: DataFrame, column: str, by: list[str], trivial: int = 20, long: int = 100) -> DataFrame:
    n = F.length(column)
    return df.groupBy(*by).agg(
        F.count(F.when(F.coalesce(n, F.lit(0)) > 0, 1)).alias("filled"), F.count(F.when(n.between(1, trivial - 1), 1)).alias("trivial"), F.floor(F.percentile(n, F.lit(0.5))).cast("long").alias("median_length"),
        F.floor(F.avg(n)).cast("long").alias("mean_length"), F.round(F.avg((n >= long).cast("int")), 9).alias("long_share"),
    )


def top_values(df: DataFrame, column: str, by: list[str], n: int) -> DataFrame:
    """The n most frequent values per group; ties alphabetically."""
    w = Window.partitionBy(*by).orderBy(F.desc("count"), column)
    return df.groupBy(*by, column).count().withColumn("place", F.row_number().over(w)).filter(F.col("place") <= n)


def entropy(df: DataFrame, columns: Sequence[str], digits: int = 8) -> DataFrame:
    """(column, classes, filled, entropy): Shannon entropy over ln(classes); 0 with one class. Nulls are left out."""
    long = df.select(*[F.col(c).cast("string").alias(c) for c in columns]).unpivot([], list(columns), "column", "value").filter("value is not null")
    counts = long.groupBy("column", "value").count()
    total = Window.partitionBy("column")
    p = counts.withColumn("p", F.col("count") / F.sum("count").over(total))
    h = p.groupBy("column").agg(F.count(F.lit(1)).alias("classes"), F.sum("count").alias("filled"), (-F.sum(F.col("p") * F.ln("p"))).alias("h"))
    return h.select("column", "classes", "filled", F.round(F.when(F.col("classes") > 1, F.col("h") / F.ln("classes")).otherwise(0.0), digits).alias("entropy"))


def multi_entropy(df: DataFrame, columns: Sequence[str], least: float = 0.5, digits: int = 6) -> DataFrame:
    """(column, classes, entropy, kept) of columns whose values are lists between pipes: normalised entropy over all
    values, and whether it is above `least`. A column without values has 0 classes."""
    lists = F.array(*[F.struct(F.lit(c).alias("column"), F.filter(F.transform(F.split(F.col(c).cast("string"), "[|]"), strip), lambda x: x != "").alias("v")) for c in columns])
    counts = df.select(F.inline(lists)).select("column", F.explode("v").alias("value")).groupBy("column", "value").count()
    p = counts.withColumn("p", F.col("count") / F.sum("count").over(Window.partitionBy("column")))
    h = p.groupBy("column").agg(F.count(F.lit(1)).alias("classes"), (-F.sum(F.col("p") * F.ln("p"))).alias("h"))
    every = df.sparkSession.createDataFrame([(c,) for c in columns], "column string").join(h, "column", "left")
    value = F.round(F.when(F.col("classes") > 1, F.col("h") / F.ln("classes")).otherwise(0.0), digits)
    return every.select("column", F.coalesce("classes", F.lit(0)).alias("classes"), value.alias("entropy"), (value > least).alias("kept"))


def date_ranges(df: DataFrame, columns: Sequence[str], digits: int = 9) -> DataFrame:
    """(column, filled, rate, first, last) of date columns, in one pass; first and last as ISO days."""
    day = lambda c: F.date_format(c, "yyyy-MM-dd")
    one = df.agg(*[F.struct(F.lit(c).alias("column"), F.count(c).alias("filled"), F.round(F.count(c) / F.count(F.lit(1)), digits).alias("rate"), day(F.min(c)).alias("first"), day(F.max(c)).alias("last")).alias(f"_{i}") for i, c in enumerate(columns)])
    return one.select(F.inline(F.array(*[f"_{i}" for i in range(len(columns))])))


def boolean_counts(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """(column, n_true, n_false, n_null) of named conditions, in one pass."""
    one = df.agg(*[F.struct(F.lit(n).alias("column"), F.count_if(c).alias("n_true"), F.count_if(~c).alias("n_false"), F.count_if(c.isNull()).alias("n_null")).alias(f"_{i}") for i, (n, c) in enumerate(columns.items())])
    return one.select(F.inline(F.array(*[f"_{i}" for i in range(len(columns))])))


def chunk_counts(points: DataFrame, module: str, name: str) -> DataFrame:
    """Points by module and field with their subtotals; what is null counts as unknown, level tells the grand total (3)
    from a module's (1) and a single field's (0)."""
    rows = points.select(F.coalesce(F.col(module), F.lit("unknown")).alias(module), F.coalesce(F.col(name), F.lit("unknown")).alias(name))
    return rows.rollup(module, name).agg(F.count(F.lit(1)).alias("n"), F.grouping_id().cast("int").alias("level"))


def label_audit(rows: DataFrame, file: str, label: str, size: Column) -> DataFrame:
    """rows (file, label, …): per label the number of files that have it, its occurrences, and the sizes of its values:
    least, most, mean, and the upper one of the two middle values."""
    upper = F.expr("percentile_disc(0.500000000001) WITHIN GROUP (ORDER BY _n)")  # just above the half: the upper middle
    return rows.withColumn("_n", size).groupBy(label).agg(
        F.countDistinct(file).alias("files"), F.count(F.lit(1)).alias("occurrences"), F.min("_n").alias("least"), F.max("_n").alias("most"), F.round(F.avg("_n"), 6).alias("mean"), upper.cast("long").alias("median"))


def utility(df: DataFrame, columns: Sequence[str], keep: float = 0.30, doubtful: float = 0.05) -> DataFrame:
    """Fill rate times entropy, and what follows for the column."""
    rows = df.count()
    u = F.round(F.col("filled") / rows * F.col("entropy"), 8)
    return entropy(df, columns).withColumn("utility", u).withColumn("verdict", F.when(u >= keep, "keep").when(u >= doubtful, "review").otherwise("drop"))


def duplicate_titles(df: DataFrame, key: Column) -> DataFrame:
    """One row: rows, distinct titles, titles used once, rows whose title is shared by 2, by 10 or more."""
    g = df.groupBy(F.xxhash64(key).alias("a"), F.md5(F.encode(key, "UTF-8")).alias("b")).count()  # titles may be long: shuffle digests
    return g.agg(F.sum("count").alias("n_rows"), F.count(F.lit(1)).alias("distinct_titles"), F.count(F.when(F.col("count") == 1, 1)).alias("used_once"), F.sum(F.when(F.col("count") >= 2, F.col("count")).otherwise(0)).alias("in_groups_2"), F.sum(F.when(F.col("count") >= 10, F.col("count")).otherwise(0)).alias("in_groups_10"))


def with_families(df: DataFrame, text: Column, families: Sequence[tuple[str, str]]) -> DataFrame:
    """Adds family, the first pattern that matches, and fallback, the second."""
    found = all_matches(text, families)
    return df.withColumn("_found", found).withColumn("family", F.get("_found", F.lit(0))).withColumn("fallback", F.get("_found", F.lit(1))).drop("_found")


NO_KIND, NO_FAMILY = "(empty)", "(unclassified)"
#: Fixed value: how kinds begin that stand for anything else.
OTHER = "Autre"


def family_statistics(df: DataFrame, rates: dict[str, Column], kind: str, year: Column | None = None, years: tuple[int, int] = (2000, 2026)) -> DataFrame:
    """Per family: n, rates, the dominant kind with its share of the rows, number and normalised entropy of the kinds,
    the dominant fallback with its share, first and last year within `years`.

    A row's kinds are the values of `kind` between pipes; without any it counts under "(empty)", without a second
    family under "(unclassified)". Ties alphabetically.
    """
    rows = df.filter("family is not null")
    keep = F.when(year.between(*years), year) if year is not None else F.lit(None).cast("int")
    base = rows.groupBy("family").agg(F.count(F.lit(1)).alias("n"), *[F.round(F.avg(c.cast("int")), 9).alias(k) for k, c in rates.items()], F.min(keep).alias("first_year"), F.max(keep).alias("last_year"))
    kinds = rows.select("family", F.explode(F.transform(F.split(F.coalesce(F.nullif(strip(F.col(kind)), F.lit("")), F.lit(NO_KIND)), "[|]"), strip)).alias("_kind")).groupBy("family", "_kind").count()
    all_kinds = Window.partitionBy("family")
    share = F.col("count") / F.sum("count").over(all_kinds)
    best = top_of(kinds, "_kind").select("family", F.col("_kind").alias("top_kind"), F.col("count").alias("_c"))
    spread = kinds.withColumn("_p", share).groupBy("family").agg(F.count(F.lit(1)).alias("n_kinds"), (-F.sum(F.col("_p") * F.ln("_p"))).alias("_h"))
    back = top_of(rows.select("family", F.coalesce("fallback", F.lit(NO_FAMILY)).alias("_back")).groupBy("family", "_back").count(), "_back").select("family", F.col("_back").alias("top_fallback"), F.col("count").alias("_b"))
    j = base.join(best, "family").join(spread, "family").join(back, "family")
    return j.select(*base.columns, "top_kind", F.round(F.col("_c") / F.col("n"), 9).alias("kind_share"), "n_kinds", F.round(F.when(F.col("n_kinds") > 1, F.col("_h") / F.ln("n_kinds")).otherwise(0.0), 6).alias("kind_entropy"), "top_fallback", F.round(F.col("_b") / F.col("n"), 9).alias("fallback_share"))


def top_of(counts: DataFrame, value: str) -> DataFrame:
    """Of counts (family, value, count) the row with the highest count per family, ties alphabetically."""
    w = Window.partitionBy("family").orderBy(F.desc("count"), value)
    return counts.withColumn("_r", F.row_number().over(w)).filter("_r = 1").drop("_r")


def family_verdict(stats: DataFrame, other: str = OTHER) -> DataFrame:
    """Whether a family tells more than the kind: what nearly always has one kind is redundant, what the kinds call
    "other" is a strong gain, kinds spread widely mean a loose pattern, no main kind a strong gain; else medium."""
    v = F.when(F.col("n") == 0, "empty").when(F.col("kind_share") >= 0.90, "redundant").when(F.col("top_kind").startswith(other), "strong").when(F.col("kind_entropy") > 0.75, "loose pattern").when(F.col("kind_share") < 0.55, "strong").otherwise("medium")
    return stats.withColumn("verdict", v)


def inversion(stats: DataFrame, rate: str, least: int = 50, top: int = 3) -> DataFrame:
    """The largest families beside those best explained, among the ones with enough rows."""
    a = stats.withColumn("place", F.row_number().over(Window.orderBy(F.desc("n"), "family"))).filter(F.col("place") <= top).select("place", F.col("family").alias("largest"))
    b = stats.filter(F.col("n") >= least).withColumn("place", F.row_number().over(Window.orderBy(F.desc(rate), "family"))).filter(F.col("place") <= top).select("place", F.col("family").alias("best_explained"))
    return a.join(b, "place", "full")


def grounds(stats: DataFrame, n: int = 8, rate: float = 0.35, structured: int = 3) -> DataFrame:
    return stats.withColumn("usable", (F.col("n") >= n) & (F.col("rate") >= rate) & (F.col("structured") >= structured))


def field_kinds(df: DataFrame, columns: Sequence[str], text: int = 25, codes: int = 12) -> DataFrame:
    """(column, distinct_values, longest, kind): text if a value is longer than `text`, else constant, code (few values)
    or high cardinality. Lists of plain values are looked at value by value; a column of structures with _label, or of
    lists of them, is a reference. Booleans and columns without values have no row."""
    types = {f.name: f.dataType for f in df.schema.fields}
    inner = {c: getattr(types[c], "elementType", types[c]) for c in columns}
    named = [c for c in columns if "_label" in getattr(inner[c], "names", [])]
    plain = [c for c in columns if inner[c].simpleString() not in ("boolean",) and not inner[c].simpleString().startswith(("struct", "map", "array"))]
    values = [F.struct(F.lit(c).alias("column"), F.transform(F.col(c) if inner[c] is not types[c] else F.array(c), lambda x: x.cast("string")).alias("values")) for c in plain]
    out = df.sparkSession.createDataFrame([(c, None, None, "reference") for c in named], "column string, distinct_values long, longest int, kind string")
    if not values:
        return out
    long = df.select(F.inline(F.array(*values))).select("column", F.explode("values").alias("value")).filter("value is not null")
    g = long.groupBy("column", "value").count().groupBy("column").agg(F.count(F.lit(1)).alias("distinct_values"), F.max(F.length("value")).alias("longest"))
    kind = F.when(F.col("longest") > text, "text").when(F.col("distinct_values") == 1, "constant").when(F.col("distinct_values") <= codes, "code").otherwise("high cardinality")
    return g.withColumn("kind", kind).unionByName(out)


def stratified(df: DataFrame, strata: list[str], order: list[Column], total: int) -> DataFrame:
    """The first row of every stratum, then the next best of all until there are `total`."""
    w = Window.partitionBy(*strata).orderBy(*order)
    ranked = df.withColumn("_first", (F.row_number().over(w) == 1).cast("int"))
    return ranked.orderBy(F.desc("_first"), *order).limit(total).drop("_first")


def majority_share(df: DataFrame, column: str) -> DataFrame:
    """The trivial baseline: the most frequent value and its share."""
    g = df.filter(F.col(column).isNotNull()).groupBy(column).count()
    return g.agg(F.max_by(column, F.struct("count", F.col(column))).alias("majority"), F.round(F.max("count") / F.sum("count"), 9).alias("share"))


def acronym_dictionary(texts: DataFrame, words: Sequence[str], protected: Sequence[str] = (), lower: Sequence[str] = (), examples: int = 3, fields: int = 5) -> DataFrame:
    """texts (id, field, text): per acronym its frequency, documents, category, spellings with their counts, the
    `fields` most frequent fields, the first excerpts of different documents, and why it is set aside, or null.

    Dotted forms count for the compact one; `lower` are words of the jargon that count in any case; `protected` are
    acronyms that look like common words. Lists are limited as a report's features; all counts are whole.
    """
    from ..functions.text import acronym_forms, excerpt, unmark

    seen = texts.select("id", "field", F.explode(acronym_forms(F.col("text"), lower)).alias("f")).groupBy("f.acronym", "id", "field", "f.seen").agg(F.count(F.lit(1)).alias("n"))
    seen = written(seen, "acronyms")  # no texts; all that follows is counted from it
    n = seen.groupBy("acronym").agg(F.sum("n").alias("frequency"), F.countDistinct("id").alias("n_docs"))
    listed = lambda column, most: seen.groupBy("acronym", column).agg(F.sum("n").alias("count")).withColumn("_r", F.row_number().over(Window.partitionBy("acronym").orderBy(F.desc("count"), column))).filter(F.col("_r") <= most).groupBy("acronym").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("_r", column, "count"))), lambda x: F.concat(x[column], F.lit(":"), x["count"].cast("string"))), " ").alias(f"{column}s"))
    first = seen.groupBy("acronym", "id").agg(F.min(F.struct("field", "seen")).alias("x"))
    wanted = first.withColumn("_r", F.row_number().over(Window.partitionBy("acronym").orderBy("id"))).filter(F.col("_r") <= examples).select("acronym", "_r", "id", "x.field", "x.seen")
    # the few texts that are shown are looked up; what is shuffled is their excerpts
    some = texts.join(wanted, ["id", "field"]).groupBy("acronym", "_r").agg(F.min(excerpt(F.col("text"), F.col("seen"), mark="…")).alias("t"))
    some = some.groupBy("acronym").agg(F.transform(F.sort_array(F.collect_list(F.struct("_r", "t"))), lambda x: x["t"]).alias("excerpts"))
    c = F.col("acronym")
    kind = F.when(c.isin(*[x.upper() for x in lower]) if lower else F.lit(False), "lower case").when(c.rlike("[0-9]"), "with digits").otherwise("letters")
    reason = F.when(c.isin(*protected) if protected else F.lit(False), F.lit(None)).when(unmark(c).isin(*words) if words else F.lit(False), "common word").when(F.length(c) < 2, "too short")
    j = n.join(listed("seen", 1 << 30), "acronym").join(listed("field", fields), "acronym").join(some, "acronym")
    return j.select("acronym", "frequency", "n_docs", kind.alias("category"), F.col("seens").alias("spellings"), "fields", "excerpts", reason.alias("reason"))


def excluded_acronyms(found: DataFrame, words: Sequence[str], protected: Sequence[str] = ()) -> DataFrame:
    """Adds reason: why an acronym is set aside (a common word in capitals, too rare), or null."""
    c = F.col("acronym")
    return found.withColumn("reason", F.when(c.isin(*protected) if protected else F.lit(False), F.lit(None)).when(c.isin(*words) if words else F.lit(False), "common word").when(F.col("frequency") < 2, "rare"))
