"""Words of one text held by others as substrings, by postings of character trigrams: no text meets every question.

A word of letters and digits can only lie within one run of letters and digits of a text, so it is looked up in the
vocabulary of runs, not in the texts. Trigrams lead from words to runs: every run that holds a word holds the word's
rarest trigram. Of n words, a text that holds a share r of them misses n - r*n at most; so it holds one of any set of
words that is larger, and only the rarest of such a set lead from texts to questions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.sinks import written

#: What counts as a word, and the runs of a text that can hold one.
WORD = "[a-z0-9]{3,}"
_TRIGRAM = "(?=([a-z0-9]{3}))"
_SLACK = 1e-6


def trigrams(word: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(word, F.lit(_TRIGRAM), F.lit(1)))


def held_words(words: DataFrame, of_runs: DataFrame) -> DataFrame:
    """words (word), of_runs (run, gram), different rows each: all (run, word) with the word in the run."""
    of_words = written(words.select("word", F.explode(trigrams(F.col("word"))).alias("gram")), "word-grams")
    counts = of_runs.join(of_words.select("gram").distinct(), "gram", "left_semi").groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    n = F.coalesce("n", F.lit(0))
    rarest = of_words.join(counts, "gram", "left").groupBy("word").agg(F.min_by("gram", F.struct(n, "gram")).alias("gram"), F.min(n).alias("n"))
    # a word with a trigram that no run has is in none
    return of_runs.join(rarest.filter("n > 0"), "gram").filter(F.col("run").contains(F.col("word"))).select("run", "word")


def word_shares(needs: DataFrame, texts: DataFrame, share: float, need_id: str = "need_id", need: str = "need", text_id: str = "text_id", text: str = "text") -> DataFrame:
    """(need_id, text_id, ratio) of every pair whose share of the need's words, repeats counted, that the text holds as
    substrings is at least `share` after rounding to nine digits.

    Both texts are given folded (lower case, no marks). Needs without words have no share and give no rows, texts that
    are null or hold no run none either; repeated rows of either side give a row each. An empty side gives an empty
    result. share must be above 0: below it every pair would be one.
    """
    if not 0 < share <= 1:
        raise ValueError("share lies above 0 and at most at 1")
    asked = written(needs.select(F.monotonically_increasing_id().alias("_need"), F.col(need_id), F.regexp_extract_all(need, F.lit(WORD), F.lit(0)).alias("_words")).filter(F.size("_words") > 0), "needs")
    words = written(asked.select("_need", F.size("_words").alias("n"), F.explode("_words").alias("word")).groupBy("_need", "n", "word").agg(F.count(F.lit(1)).alias("times")), "need-words")
    rows = written(texts.select(F.monotonically_increasing_id().alias("_text"), F.col(text_id), F.array_distinct(F.regexp_extract_all(text, F.lit(WORD), F.lit(0))).alias("_runs")).filter(F.size("_runs") > 0), "text-runs")
    runs = rows.select(F.explode("_runs").alias("run")).distinct()
    of_runs = written(runs.select("run", F.explode(trigrams(F.col("run"))).alias("gram")), "run-grams")

    hits = written(held_words(words.select("word").distinct(), of_runs), "run-words")

    # of each need the rarest words, until a text cannot miss them all
    by_rarity = Window.partitionBy("_need").orderBy(F.coalesce("runs", F.lit(0)), "word").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("times").over(by_rarity), F.lit(0))
    told = words.join(hits.groupBy("word").agg(F.count(F.lit(1)).alias("runs")), "word", "left")
    leading = written(told.withColumn("_before", before).filter(F.col("_before") <= F.col("n") * (1 - share) + _SLACK).filter("runs > 0").select("_need", "word"), "leading-words")

    found = rows.select("_text", F.explode("_runs").alias("run")).join(hits.join(leading.select("word").distinct(), "word", "left_semi"), "run").select("_text", "word").distinct()
    pairs = written(found.join(leading, "word").select("_text", "_need").distinct(), "candidates")
    # a word lies within one run, so the runs stand for the text
    held = F.size(F.filter("_words", lambda w: F.col("_all").contains(w)))
    met = pairs.join(rows.select("_text", text_id, F.array_join("_runs", " ").alias("_all")), "_text").join(asked, "_need")
    return met.select(need_id, text_id, F.round(held / F.size("_words"), 9).alias("ratio")).filter(F.col("ratio") >= share)
