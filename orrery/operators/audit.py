"""Audits of generated answers: citations, abstention, numbers, facts, status."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.domain import ROUTES
from ..functions.text import claimed_numbers, fold, identifiers, overlap, strip, unmark


#: The kind of fact that names a period, and the kinds that a search for substrings can settle.
PERIOD = "periode"
MECHANICAL = ("type_evenement", "lieu", "motif")


def deterministic(answer: Column, context: Column, expected_abstention: Column, ids: str, refusal: str, units: str, route: Column | None = None) -> dict[str, Column]:
    """Citations outside the context, abstention as expected, no invented counts, a sensible length."""
    cited = identifiers(answer, ids)
    outside = F.when(F.size(context) > 0, F.filter(cited, lambda c: ~F.exists(context, lambda x: fold(x) == fold(c)))).otherwise(F.array().cast("array<string>"))
    abstained = answer.rlike(f"(?iu){refusal}") | (F.coalesce(F.lower(route), F.lit("")) == "abstention" if route is not None else F.lit(False))
    numbers = claimed_numbers(answer, units)
    most = F.greatest(F.when(F.size(context) > 0, F.size(context)).otherwise(999), F.lit(50))
    return {
        "citations": F.size(cited), "outside": F.size(outside), "examples": F.slice(outside, 1, 3), "ok_citations": F.size(outside) == 0, "abstained": abstained, "ok_abstention": abstained == expected_abstention,
        "ok_numbers": F.when(expected_abstention, F.size(numbers) == 0).otherwise(~F.exists(numbers, lambda n: n > most)), "length": F.length(answer), "ok_length": F.length(answer).between(80, 4000),
    }


def fact_present(kind: Column, value: Column, examples: Column, answer: Column) -> Column:
    """Examples by an overlap of 0.35, a period (a-b) by either end, anything else by 0.6."""
    text = fold(answer)
    ends = F.split(value, "-")
    return F.when(F.size(examples) > 0, F.exists(examples, lambda x: overlap(fold(x), text) >= 0.35)).when(kind == PERIOD, F.exists(ends, lambda e: text.contains(e))).otherwise(overlap(fold(value), text) >= 0.6)


def fact_coverage(facts: DataFrame, key: str, answer: str) -> DataFrame:
    """facts (key, answer, kind, value, examples): per answer the facts expected, those present, and their rate."""
    ok = fact_present(F.col("kind"), F.col("value"), F.coalesce("examples", F.array().cast("array<string>")), F.col(answer))
    g = facts.groupBy(key).agg(F.count(F.lit(1)).alias("expected"), F.count_if(ok).alias("present"))
    return g.withColumn("rate", F.round(F.col("present") / F.col("expected"), 2))


def mechanical_facts(facts: DataFrame, key: str, answer: str, kinds: tuple[str, ...] = MECHANICAL) -> DataFrame:
    """facts (key, answer, kind, values): per kind of `kinds`, the only ones that a search for substrings can settle, how
    many there are and how many answers hold one of the values, or its first 60 characters, whatever case and marks."""
    text = unmark(F.lower(F.col(answer)))
    ok = F.exists("values", lambda v: (v != "") & (text.contains(F.left(unmark(F.lower(v)), F.lit(60)))))
    return facts.filter(F.col("kind").isin(*kinds)).groupBy("kind").agg(F.count(F.lit(1)).alias("facts"), F.count_if(ok).alias("present"))


def uncited(claims: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Claimed ids that no known row has."""
    return claims.join(known.select(key).distinct(), key, "left_anti")


def recommendation(answer: Column, n: Column, of: Column, categories: Column, efficacy: str, fact: str, suggestion: str) -> dict[str, Column]:
    """Whether a recommendation says on how many cases it rests (n or `of`, as a number of its own), names one of the
    categories (a word of more than 4 letters of it), claims an effect, and tells facts from suggestions."""
    text, whole = unmark(F.lower(answer)), F.coalesce(answer, F.lit(""))
    numbers = F.regexp_extract_all(whole, F.lit(r"(?<![0-9A-Za-z_])([0-9]{1,5})(?![0-9A-Za-z_])"), F.lit(1))
    words = F.filter(F.flatten(F.transform(categories, lambda c: F.split(unmark(F.lower(c)), "[ /]+"))), lambda w: F.length(w) > 4)
    return {
        "ceiling_announced": F.coalesce(F.array_contains(numbers, n.cast("string")), F.lit(False)) | F.coalesce(F.array_contains(numbers, of.cast("string")), F.lit(False)),
        "category_named": F.when(F.size(categories) > 0, F.exists(words, lambda w: text.contains(w))),
        "claims_efficacy": whole.rlike(f"(?iu){efficacy}"), "fact_and_suggestion": whole.rlike(f"(?iu){fact}") & whole.rlike(f"(?iu){suggestion}"),
    }


def expected_values(kind: Column, items: Column, entries: Column, number: Column) -> Column:
    """What an oracle expects in the answer: the items of a ranking, the keys of a distribution, both spellings of a
    number (with blanks between thousands, plain), the values of a comparison."""
    spelt = F.array(F.replace(F.format_number(number, 0), F.lit(","), F.lit(" ")), number.cast("string"))
    found = F.when(kind == "ranking", items).when(kind == "distribution", F.map_keys(entries)).when(kind == "number", F.when(number.isNotNull(), spelt)).when(kind == "comparison", F.map_values(entries))
    return F.coalesce(found, F.array().cast("array<string>"))


def status(wanted: Column, expected: Column, limit: Column, answer: Column, refusal: str) -> Column:
    """Whether an answer has the status wanted. ABSTENTION: a refusal, or nothing. CEILING: one of the words of the limit
    (more than 5 letters) is announced. EXACT: at least half of the expected values, rounded down but one at least, are
    there, long ones (over 25 characters) also by their first 25."""
    text = unmark(F.lower(F.coalesce(answer, F.lit(""))))
    there = F.filter(expected, lambda x: (x != "") & (text.contains(unmark(F.lower(x))) | ((F.length(x) > 25) & text.contains(F.left(unmark(F.lower(x)), F.lit(25))))))
    words = F.filter(F.split(unmark(F.lower(F.coalesce(limit, F.lit("")))), r"\s+"), lambda w: F.length(w) > 5)
    exact = (F.size(expected) > 0) & (F.size(there) >= F.greatest(F.lit(1), F.floor(F.size(expected) / 2)))
    abstained = F.coalesce(answer.rlike(f"(?iu){refusal}"), F.lit(False)) | (strip(text) == "")
    return F.when(wanted == "ABSTENTION", abstained).when(wanted == "CEILING", F.arrays_overlap(words, F.split(text, r"\s+"))).otherwise(exact)


def ranking_matches(expected: Column, found: Column, top: int = 3) -> tuple[Column, Column]:
    """Whether the first is right, and whether the first `top` are the right ones."""
    return F.get(expected, F.lit(0)) == F.get(found, F.lit(0)), F.sort_array(F.slice(expected, 1, top)) == F.sort_array(F.slice(found, 1, top))


def routing(results: DataFrame, chosen: Column, wanted: Column, got: Column, best: Column, by: list[str] | None = None) -> DataFrame:
    """Misroutes, and those that lose hits against the wanted route; with `by` one row per group, null being one."""
    return results.groupBy(*by or []).agg(F.count(F.lit(1)).alias("n"), F.count_if(chosen != wanted).alias("misrouted"), F.count_if((chosen != wanted) & (got < best)).alias("costly"))


def same_route(chosen: Column, wanted: Column, routes=ROUTES) -> Column:
    """Whether a router's choice stands for the wanted route. A name without an entry stands for itself in lower case, a
    missing one for none; without a wanted route nothing is right."""
    name = F.lower(F.coalesce(F.nullif(chosen, F.lit("")), F.lit("?")))
    table = F.create_map(*[F.lit(x) for pair in routes for x in pair])
    return F.coalesce(F.coalesce(F.try_element_at(table, name), name) == wanted, F.lit(False))


def routed(run: DataFrame, by_route: DataFrame, key: str = "id", routes=ROUTES) -> DataFrame:
    """run (key, chosen, wanted, ok): every question as the assistant answered it, null `chosen` and ok = false where it
    failed; by_route (key, ok): the same questions sent to the right route. All rows of run, with right_route,
    ok_by_route (null if that run lacks the question), misrouted and costly: sent elsewhere, wrong, and right by its route.
    A failed call, which has no choice, is not misrouted."""
    j = run.join(by_route.select(key, F.col("ok").alias("ok_by_route")), key, "left").withColumn("right_route", F.when(F.col("chosen").isNotNull(), same_route(F.col("chosen"), F.col("wanted"), routes)))
    wrong = F.coalesce(~F.col("right_route"), F.lit(False))
    return j.withColumn("misrouted", wrong).withColumn("costly", wrong & F.coalesce("ok_by_route", F.lit(False)) & ~F.coalesce("ok", F.lit(False)))


def paired(a: DataFrame, b: DataFrame, key: str, value: str) -> DataFrame:
    """Two runs on the questions that both have: (key, a, b, delta)."""
    return a.select(key, F.col(value).alias("a")).join(b.select(key, F.col(value).alias("b")), key).withColumn("delta", F.col("b") - F.col("a"))


def example_rate(hits: Column, k: int, expected: Column, returned: Column) -> Column:
    least = F.least(F.lit(k), expected, returned)
    return F.when(least > 0, hits / least).otherwise(0.0)


def mined_facts(rows: DataFrame, by: list[str], kind: str, place: str, year: str, example: str | None = None, order: str | None = None) -> DataFrame:
    """Facts a good answer should hold: the dominant kind from 0.6 (kinds are the values between pipes), the two main
    places from 3 rows and 0.25, the most frequent first, the years, and the first 3 examples by `order` of more than 25
    characters, cut at 120."""
    from .profile import top_values

    n = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.min(year).alias("first_year"), F.max(year).alias("last_year"))
    kinds = rows.select(*by, F.explode(F.filter(F.transform(F.split(kind, "[|]"), strip), lambda x: x != "")).alias(kind))
    best = top_values(kinds, kind, by, 1).select(*by, F.col(kind).alias("_kind"), F.col("count").alias("_kn"))
    named = rows.select(*by, F.col(place).alias("_place")).filter("_place is not null")
    places = top_values(named, "_place", by, 2).select(*by, "_place", F.col("count").alias("_pn"))
    j = n.join(best, by, "left").withColumn("main_kind", F.when(F.col("_kn") / F.col("n") >= 0.6, F.col("_kind"))).drop("_kind", "_kn")
    kept = j.join(places, by).filter((F.col("_pn") >= 3) & (F.col("_pn") / F.col("n") >= 0.25)).groupBy(*by).agg(F.transform(F.sort_array(F.collect_list(F.struct((-F.col("_pn")).alias("n"), "_place"))), lambda x: x["_place"]).alias("places"))
    out = j.join(kept, by, "left")
    if example:
        w = Window.partitionBy(*by).orderBy(order)
        first = rows.filter(F.length(example) > 25).select(*by, order, F.left(F.col(example), F.lit(120)).alias("_t")).withColumn("_r", F.row_number().over(w)).filter("_r <= 3")
        out = out.join(first.groupBy(*by).agg(F.transform(F.sort_array(F.collect_list(F.struct("_r", "_t"))), lambda x: x["_t"]).alias("examples")), by, "left")
    return out


def ceilings(rows: DataFrame, by: list[str], cause: Column, structured: Column, description: Column, long: int = 100) -> DataFrame:
    """Limits of what an answer can rest on, per group and route: n rows of `of` have a cause, a structured action, a
    description of at least `long` characters, and whether that must be announced (any without a cause, fewer than half
    with an action, fewer than 0.7 with a description)."""
    tests = (("cause", F.coalesce(cause != "", F.lit(False)), 1.0), ("action", structured, 0.5), ("description", F.coalesce(F.length(description) >= long, F.lit(False)), 0.7))
    g = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("of"), *[F.count_if(t).alias(f"_{r}") for r, t, _ in tests])
    each = F.explode(F.array(*[F.struct(F.lit(r).alias("route"), F.col(f"_{r}").alias("n"), (F.col(f"_{r}") < F.col("of") * share).alias("announce")) for r, _, share in tests]))
    return g.select(*by, "of", each.alias("_x")).select(*by, "_x.route", "_x.n", "of", "_x.announce")
