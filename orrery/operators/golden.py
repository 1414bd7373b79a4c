"""Golden questions: predicates, filters read from questions, precedents and what a good answer must hold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import fold, unmark


def content(columns: list[Column], pattern: str) -> Column:
    """Whether the folded fields, one after the other, match a pattern."""
    return fold(F.concat_ws(" ", *columns)).rlike(pattern)


def compound_counts(rows: DataFrame, bases: dict[str, Column], discriminants: dict[tuple[str, str], Column], least: int = 8) -> DataFrame:
    """(base, category, discriminant, n): every base with every discriminant that at least `least` rows satisfy both.

    One pass: each row lists the bases and the discriminants that hold, a few names, and their pairs are counted with
    partial sums. discriminants: (category, name) to condition.
    """
    b = F.filter(F.array(*[F.when(c, F.lit(n)) for n, c in bases.items()]), lambda x: x.isNotNull())
    d = F.filter(F.array(*[F.when(c, F.struct(F.lit(k).alias("category"), F.lit(n).alias("discriminant"))) for (k, n), c in discriminants.items()]), lambda x: x.isNotNull())
    pairs = rows.select(F.explode(b).alias("base"), d.alias("_d")).select("base", F.inline("_d"))
    return pairs.groupBy("base", "category", "discriminant").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least)


def question_filters(question: Column, kinds: dict[str, str], stand_word: str = "poste") -> Column:
    """Filters that a question's wording asks for, as structs (field, value), in this order: each year 2000 to 2029 it
    names, the kind behind each keyword of `kinds` it holds, the stand (a letter and up to three digits) it names."""
    text = unmark(F.lower(F.coalesce(question, F.lit(""))))
    years = F.transform(F.regexp_extract_all(text, F.lit(r"(?<![0-9a-z_])(20[0-2][0-9])(?![0-9a-z_])"), F.lit(1)), lambda y: F.struct(F.lit("year").alias("field"), y.alias("value")))
    found = F.filter(F.array(*[F.when(text.contains(w), F.struct(F.lit("kind").alias("field"), F.lit(v).alias("value"))) for w, v in kinds.items()]), lambda x: x.isNotNull())
    p = rf"{stand_word} ([a-z])\\s?([0-9]{{1,3}})".replace("\\\\", "\\")
    stand = F.when(text.rlike(p), F.array(F.struct(F.lit("stand").alias("field"), F.upper(F.concat(F.regexp_extract(text, p, 1), F.regexp_extract(text, p, 2))).alias("value")))).otherwise(F.array().cast("array<struct<field:string,value:string>>"))
    return F.concat(years, found, stand)


def either_year(question: Column) -> Column:
    """The pairs of years between 2000 and 2029 that a question names as alternatives, 2024 ou 2025: structs (first,
    second), each of which stands for one filter that keeps the rows of either year."""
    text = unmark(F.lower(F.coalesce(question, F.lit(""))))
    pairs = F.regexp_extract_all(text, F.lit(r"(?<![0-9a-z_])(20[0-2][0-9] ou 20[0-2][0-9])(?![0-9a-z_])"), F.lit(1))
    return F.transform(pairs, lambda x: F.struct(F.left(x, F.lit(4)).alias("first"), F.right(x, F.lit(4)).alias("second")))


def filter_verdicts(filters: DataFrame, members: DataFrame, golden: DataFrame) -> DataFrame:
    """filters (query_id, field, value), members (field, value, id), golden (query_id, id): per filter the rows it keeps,
    those of the golden set, and whether it may be used: it must hold all golden rows and more (`kept`), not be equal to
    them, nor miss any."""
    g = golden.groupBy("query_id").agg(F.count(F.lit(1)).alias("golden"))
    size = members.groupBy("field", "value").agg(F.count(F.lit(1)).alias("space"))
    hits = filters.join(golden, "query_id").join(members, ["field", "value", "id"]).groupBy("query_id", "field", "value").agg(F.count(F.lit(1)).alias("hits"))
    j = filters.join(g, "query_id").join(size, ["field", "value"], "left").join(hits, ["query_id", "field", "value"], "left").fillna(0, ["space", "hits"])
    verdict = F.when(F.col("hits") < F.col("golden"), "incomplete").when(F.col("space") == F.col("golden"), "equal").otherwise("kept")
    return j.select("query_id", "field", "value", "golden", "space", verdict.alias("verdict"))


def leave_one_out(proposed: DataFrame, probe: str, sources: str) -> DataFrame:
    """Proposed actions that do not come from the probed record itself."""
    return proposed.filter(~F.coalesce(F.array_contains(F.col(sources), F.col(probe)), F.lit(False)))


def theme_agreement(proposed: DataFrame, probe: str, expected: str, themes: str, kind: str, hot: str) -> DataFrame:
    """Per probed record: whether the themes of its proposed actions meet the expected ones, with and without the
    actions of kind `hot`. Themes are gathered distinct, so a record with very many actions keeps a short list."""
    t = proposed.select(probe, expected, F.explode_outer(themes).alias("_t"), (F.col(kind) == hot).alias("_hot"))
    g = t.groupBy(probe).agg(F.first(expected).alias("_e"), F.collect_set("_t").alias("_all"), F.collect_set(F.when(~F.coalesce("_hot", F.lit(False)), F.col("_t"))).alias("_rest"))
    return g.select(probe, F.arrays_overlap("_e", "_all").alias("agrees"), F.arrays_overlap("_e", "_rest").alias("agrees_structured"))


def precedents(rows: DataFrame, by: list[str], key: str, immediate: str, structured: str, most: int = 6) -> DataFrame:
    """(by, place, key): the records to cite, those with most structured actions first, then those with the longest
    immediate action; records with neither are left out. The number is the report's feature."""
    n = F.coalesce(F.size(structured), F.lit(0))
    length = F.coalesce(F.length(immediate), F.lit(0))
    w = Window.partitionBy(*by).orderBy(F.desc("_score"), key)
    ranked = rows.filter((n > 0) | (length > 0)).select(*by, key, (F.greatest(n, F.lit(0)) * 100 + length).alias("_score"))
    return ranked.withColumn("place", F.row_number().over(w)).filter(F.col("place") <= most).select(*by, "place", key)


def golden_questions(rows: DataFrame, cases: dict[str, tuple[Column, str]], key: str, immediate: Column, structured: Column, cause: Column, categories: Column, most: int = 200) -> DataFrame:
    """One row per case (name to predicate and mode, reco or abstention): comparable records, those with an immediate
    action, a structured one, a cause, the rates, categories of action with their counts (most frequent first), the
    first `most` ids of records with an immediate action, and the limit to announce. A record may serve several cases;
    a case without records has no row."""
    names = F.filter(F.array(*[F.when(p, F.lit(n)) for n, (p, _) in cases.items()]), lambda x: x.isNotNull())
    r = rows.select(F.col(key).alias("_key"), F.explode(names).alias("name"), immediate.alias("_imm"), structured.alias("_st"), cause.alias("_cause"), categories.alias("_cats"))
    g = r.groupBy("name").agg(F.count(F.lit(1)).alias("comparable"), F.count_if("_imm").alias("with_immediate"), F.count_if("_st").alias("with_structured"), F.count_if("_cause").alias("with_cause"))
    c = r.select("name", F.explode("_cats").alias("_c")).groupBy("name", "_c").agg(F.count(F.lit(1)).alias("_n")).groupBy("name").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct((-F.col("_n")).alias("m"), "_c", "_n"))), lambda x: F.concat(x["_c"], F.lit(":"), x["_n"].cast("string"))), " ").alias("categories"))
    w = Window.partitionBy("name").orderBy("_key")
    ids = r.filter("_imm").select("name", "_key").withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= most).groupBy("name").agg(F.sort_array(F.collect_list("_key")).alias("expected_ids"))
    mode = F.create_map(*[F.lit(x) for n, (_, m) in cases.items() for x in (n, m)])
    j = g.join(c, "name", "left").join(ids, "name", "left")
    rate = lambda x: F.round(F.col(x) / F.col("comparable"), 2)
    return j.select("name", mode[F.col("name")].alias("mode"), "comparable", "with_immediate", "with_structured", "with_cause", rate("with_immediate").alias("immediate_rate"), rate("with_structured").alias("structured_rate"), F.coalesce("categories", F.lit("")).alias("categories"), F.coalesce("expected_ids", F.array().cast(f"array<{rows.schema[key].dataType.simpleString()}>")).alias("expected_ids"))


def question_grid(questions: DataFrame, modes: list[str], collections: list[str]) -> DataFrame:
    """Every question in every mode on every collection; the two lists are short and stated."""
    grid = [F.struct(F.lit(m).alias("mode"), F.lit(c).alias("collection")) for m in modes for c in collections]
    return questions.select("*", F.inline(F.array(*grid)))
