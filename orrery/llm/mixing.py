"""Mixing sources to target weights: hash-random keys, a range sort within each source, distributed prefix sums of the
token counts and a cut at each source's exact budget, after whole epochs where the budget exceeds the source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ROW, WORD, as_given, marked, numbered, running_sums, stored

WEIGHTS = (1, 2, 3)
MAX_EPOCHS = 3


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sources: DataFrame, source: str = "source", size: str = "source_size", weights: tuple[int, ...] = WEIGHTS, most: int = MAX_EPOCHS) -> DataFrame:
    """sources: one row per source with its size. Adds target: shares of the whole size by weight, none above `most`
    times the source's size, what is over going to the others by weight until none is above.

    That is a water level: with the sources in ascending order of cap / weight, those before the first whose cap is
    at or above the level take their caps, all others the level times their weight. One small row per source; no
    source is collected.
    """
    every, ranked = Window.orderBy(F.col(source).asc_nulls_last()), Window.orderBy("_ratio", F.col(source).asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.pmod(F.row_number().over(every) - 1, F.lit(len(weights))) + 1).cast("int"))
    s = sources.withColumn("_weight", w).withColumn("_cap", F.col(size).cast("double") * most).withColumn("_ratio", F.col("_cap") / F.col("_weight"))
    before, rest = ranked.rowsBetween(Window.unboundedPreceding, -1), ranked.rowsBetween(0, Window.unboundedFollowing)
    total = F.sum(F.col(size).cast("double")).over(Window.partitionBy())
    s = s.withColumn("_level", (total - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))) / F.sum("_weight").over(rest))
    s = s.withColumn("_place", F.row_number().over(ranked))
    level = F.min_by(F.when(F.col("_level") <= F.col("_ratio"), F.col("_level")), F.when(F.col("_level") <= F.col("_ratio"), F.col("_place"))).over(Window.partitionBy())
    return s.withColumn("target", F.least(F.col("_cap"), level * F.col("_weight"))).drop("_weight", "_cap", "_ratio", "_level", "_place")


def mixing_key(doc_id: Column) -> Column:
    """The hash-random place of a row in its source: MD5 of the id as text; it depends on nothing else."""
    return F.md5(F.encode(F.coalesce(doc_id.cast("string"), F.lit("")), "UTF-8"))


def epochs_of(target: str) -> Column:
    """Whole passes over a source that its rounded target holds."""
    return F.when(F.col("source_size") > 0, F.expr(f"cast(round({target}) as bigint) div source_size")).otherwise(F.lit(0)).cast("long")


def mix(sized: DataFrame, id_col: str = "doc_id", source: str = "source", size: str = "size") -> DataFrame:
    """sized: rows with id, source and size. Adds source_size, target and taken: how many words of this row the mix
    takes, whole epochs counted, the last one cut so that the source's words add up to its rounded target.

    Nulls: a null source is a source of its own, after all others; a null id sorts as the empty text; rows of size 0
    take 0. Equal ids are put in any order. An empty table gives an empty result.
    """
    rows = stored(sized.withColumn("_key", mixing_key(F.col(id_col))), "mix")
    targets = stored(source_targets(rows.groupBy(source).agg(F.sum(size).alias("source_size")), source), "mix-targets")
    placed = running_sums(rows, [source], ["_key", id_col], [size], "mix-ranged", attach=targets)
    budget, epochs = F.round(F.col("target")).cast("long"), epochs_of("target")
    left = budget - epochs * F.col("source_size") - F.col(f"before_{size}")
    taken = epochs * F.col(size) + F.greatest(F.lit(0).cast("long"), F.least(F.col(size), left))
    return placed.withColumn("taken", taken).drop("_key", f"before_{size}")


def mix_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source: str = "source") -> DataFrame:
    """(id, source, size in words, source_size, target, taken) for every row; the texts are read once, never shuffled."""
    return mix(docs.select(id_col, F.col(source).cast("string").alias(source), word_count(F.col(text_col)).alias("size")), id_col, source)


def mixture(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", source: str = "source", length_col: str | None = "n_chars") -> DataFrame:
    """The mix itself, with the columns of docs: each row as often as its epochs say, and where a budget ends within a
    text, its first words only, joined by single spaces. length_col, if there, is set to the new text's length.

    Texts are counted once, and told by bitmaps how often they are taken (whole up to MAX_EPOCHS times, as targets allow no
    more) and whether they are also cut; only the texts that are cut, one a source at most, are shuffled. Rows without
    words (null, empty or blank texts) stay out; a null source is one of its own; repeated rows are taken as often as
    they occur. An empty table gives an empty result."""
    rows = numbered(docs)
    sized = rows.select(ROW, F.col(id_col).alias("_id"), F.col(source).cast("string").alias("_source"), word_count(F.col(text_col)).alias("_size"))
    share = mix(sized, "_id", "_source", "_size").filter("taken > 0").select(ROW, F.expr("taken div _size").alias("_whole"), F.expr("taken % _size").alias("_mix_words"))
    share = stored(share, "mix-share")
    told = marked(rows, share.select(ROW, *[(F.col("_whole") >= i).alias(f"_mix_{i}") for i in range(1, MAX_EPOCHS + 1)], (F.col("_mix_words") > 0).alias("_mix_cut")), *[f"_mix_{i}" for i in range(1, MAX_EPOCHS + 1)], "_mix_cut")
    copies = sum((F.col(f"_mix_{i}").cast("int") for i in range(1, MAX_EPOCHS + 1)), F.lit(0))
    own = [F.col(f"`{c}`") for c in rows.columns]
    whole = told.withColumn("_mix_copies", copies).filter("_mix_copies > 0").select(*own, F.explode(F.sequence(F.lit(1), F.col("_mix_copies")))).select(*own)
    last = told.filter("_mix_cut").select(*own).join(share.filter("_mix_words > 0").select(ROW, "_mix_words"), ROW)
    cut = F.array_join(F.slice(F.regexp_extract_all(F.col(text_col), F.lit(WORD), 0), F.lit(1), F.col("_mix_words").cast("int")), " ")
    last = last.withColumn(text_col, cut)
    if length_col in docs.columns:
        last = last.withColumn(length_col, F.length(text_col).cast(docs.schema[length_col].dataType))
    return as_given(whole, docs).unionByName(as_given(last, docs))
