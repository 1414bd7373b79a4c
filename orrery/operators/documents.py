"""Retrieval documents and chunks: verbalisation, greedy packing, thread segments, Markdown rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import domain
from ..functions.text import alias, label_key, plausible_label, split_operators, strip


def present(c: Column) -> Column:
    s = strip(c.cast("string"))
    return F.when(s != "", s)


def relation(values: Column) -> Column:
    """Distinct values in their order, joined by ', '; null if there are none."""
    return F.nullif(F.array_join(F.array_distinct(F.filter(values, lambda x: x.isNotNull() & (x != ""))), ", "), F.lit(""))


def day(c: Column) -> Column:
    return F.date_format(c, "dd/MM/yyyy")


def document(identity: Column, metadata: list[Column], factors: Column, narrative: list[Column]) -> Column:
    """Identity line, values of the metadata joined by ' | ', factors line, narrative lines; empty ones are left out."""
    return F.concat_ws("\n", present(identity), F.nullif(F.concat_ws(" | ", *[present(m) for m in metadata]), F.lit("")), present(factors), *[present(x) for x in narrative])


def cut_lines(lines: Column, width: int | Column) -> Column:
    """Lines longer than width are cut into pieces of that many characters at most: before the last blank within the width,
    or in the middle of a word that fills it; white space around a cut goes. What is left at the end stays whole."""
    w = (F.lit(width) if isinstance(width, int) else width).cast("string")
    less = (F.lit(width) if isinstance(width, int) else width) - 1
    pattern = F.concat(F.lit(r"(?s)\s*(.{1,"), w, F.lit(r"}\z|.{1,"), F.greatest(less, F.lit(1)).cast("string"), F.lit("}(?= )|.{1,"), w, F.lit("})"))
    pieces = lambda x: F.filter(F.transform(F.regexp_extract_all(x, pattern, F.lit(1)), lambda p: F.regexp_replace(p, r"\s+$", "")), lambda p: p != "")
    return F.flatten(F.transform(lines, lambda x: F.when(F.length(x) <= width, F.array(x)).otherwise(pieces(x))))


def pack_lines(lines: Column, budget: int | Column, joiner: str = "\n") -> Column:
    """Greedy: a line goes to the current segment if it still fits, else it opens the next. A fold over the lines."""
    kind = "struct<done:array<string>,now:string>"
    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit(None).cast("string").alias("now")).cast(kind)
    step = lambda s, x: F.when(s["now"].isNull(), F.struct(s["done"].alias("done"), x.alias("now"))).when(F.length(s["now"]) + len(joiner) + F.length(x) <= budget, F.struct(s["done"].alias("done"), F.concat(s["now"], F.lit(joiner), x).alias("now"))).otherwise(F.struct(F.array_append(s["done"], s["now"]).alias("done"), x.alias("now")))
    return F.aggregate(lines, start, step, lambda s: F.when(s["now"].isNull(), s["done"]).otherwise(F.array_append(s["done"], s["now"])))


def segments(df: DataFrame, lines: Column, budget: int, prefix: Column | None = None, widest_prefix: int = 0) -> DataFrame:
    """One row per segment: (…, segment from 0, kind, text). The prefix, of at most widest_prefix characters, stands
    before each and counts; if it leaves no room, single characters still go through."""
    room = max(1, budget - widest_prefix - (1 if widest_prefix else 0))
    packed = pack_lines(cut_lines(F.filter(lines, lambda x: x.isNotNull() & (x != "")), room), room)
    out = df.select("*", F.posexplode(packed).alias("segment", "_body"))
    text = F.concat_ws("\n", prefix, "_body") if prefix is not None else F.col("_body")
    return out.withColumn("kind", F.when(F.col("segment") == 0, "sheet").otherwise("long narrative")).withColumn("text", text).drop("_body")


def situation(identity: Column, metadata: list[Column], factors: Column, situation_lines: list[Column]) -> Column:
    """The document of what happened alone: no causes, no actions."""
    return document(identity, metadata, factors, situation_lines)


def labelled(label: str, c: Column) -> Column:
    return F.when(present(c).isNotNull(), F.concat(F.lit(f"{label} : "), present(c)))


def causes_text(causes: dict[str, Column]) -> Column:
    """`Causes : axis — text ; …`, null without any."""
    parts = F.concat_ws(" ; ", *[F.when(present(c).isNotNull(), F.concat(F.lit(f"{axis} — "), present(c))) for axis, c in causes.items()])
    return F.when(parts != "", F.concat(F.lit("Causes : "), parts))


def actions_text(immediate: Column, titles: Column) -> Column:
    """The immediate action's line and that of the actions taken, null without either."""
    taken = F.when(F.size(titles) > 0, F.concat(F.lit("Actions engagées : "), F.array_join(titles, " ; ")))
    return F.nullif(F.concat_ws("\n", labelled("Action immédiate", immediate), taken), F.lit(""))


def chunks(df: DataFrame, key: str, identity: Column, metadata: Column, factors: Column, narrative: Column, causes: Column, actions: Column, floor: int = 40, budget: int = 1800) -> DataFrame:
    """(key, chunk, kind, text) of a record: the sheet, its overflow under the metadata line (the identity without any),
    then a chunk of its causes and one of its actions. Below `floor` characters there is no sheet.

    A record longer than the budget is packed line by line into segments that, with the prefix and its line end, stay
    within it; the first stands under the whole head instead, which does not count. A prefix that leaves no room lets
    single characters through."""
    kind = "array<struct<kind:string,text:string>>"
    own = F.filter(F.array(F.struct(F.lit("cause").alias("kind"), causes.alias("text")), F.struct(F.lit("action").alias("kind"), actions.alias("text"))).cast(kind), lambda x: x["text"].isNotNull())
    head, prefix = F.concat_ws("\n", present(identity), present(metadata), present(factors)), F.coalesce(present(metadata), present(identity), F.lit(""))
    r = df.select(F.col(key).alias("_key"), own.alias("_own"), head.alias("_head"), prefix.alias("_prefix"), F.filter(narrative, lambda x: x.isNotNull() & (x != "")).alias("_lines"))
    # each text is made once, and only records that overflow are packed
    r = r.withColumn("_whole", F.concat_ws("\n", "_head", F.nullif(F.array_join("_lines", "\n"), F.lit(""))))
    room = F.greatest(F.lit(1), F.lit(budget) - F.length("_prefix") - 1)
    packed = pack_lines(cut_lines(F.col("_lines"), room), room)
    parts = F.when(F.length("_whole") < floor, F.array().cast("array<string>")).when(F.length("_whole") <= budget, F.array("_whole")).otherwise(packed)
    r = r.withColumn("_parts", parts).withColumn("_over", F.length("_whole") > budget)
    text = lambda x, i: F.when(F.col("_over"), F.concat_ws("\n", F.when(i == 0, F.col("_head")).otherwise(F.col("_prefix")), x)).otherwise(x)
    sheet = F.transform("_parts", lambda x, i: F.struct(F.when(i == 0, "sheet").otherwise("long narrative").alias("kind"), text(x, i).alias("text"))).cast(kind)
    return r.select("_key", F.posexplode(F.concat(sheet, "_own")).alias("chunk", "x")).select(F.col("_key").alias(key), "chunk", "x.kind", "x.text")


def text_variants(narrative: Column, metadata: list[tuple[str, Column]], wide: list[tuple[str, Column]], summary: Column) -> dict[str, Column]:
    """Texts to compare: A the narrative, B with labelled metadata before it, C with their values alone, D with those of
    the wide list, E as D with the summary behind."""
    line = lambda parts, name: F.nullif(F.concat_ws(" | ", *[F.when(present(c).isNotNull(), F.concat(F.lit(f"{n}: "), present(c)) if name else present(c)) for n, c in parts]), F.lit(""))
    n = present(narrative)
    text = lambda first: F.coalesce(F.nullif(F.concat_ws("\n", first, n), F.lit("")), F.lit(""))
    d = text(line(wide, False))
    return {"A": F.coalesce(n, F.lit("")), "B": text(line(metadata, True)), "C": text(line(metadata, False)), "D": d, "E": F.concat_ws("\n", F.nullif(d, F.lit("")), present(summary))}


def field_chunks(df: DataFrame, key: str, fields: list[tuple[str, Column, int]], gated: tuple[str, ...] = (), empty: tuple[str, ...] = ()) -> DataFrame:
    """(key, field, text): one chunk per field of at least its length; the gated fields also must not say "nothing"."""
    items = [F.struct(F.lit(n).alias("field"), F.when((F.length(present(c)) >= least) & (~F.lower(present(c)).isin(*empty) if n in gated and empty else F.lit(True)), present(c)).alias("text")) for n, c, least in fields]
    return df.select(key, F.inline(F.array(*items))).filter("text is not null")


def merge_short(pieces: Column, least: int = 25, joiner: str = "\n") -> Column:
    """Pieces shorter than `least` join the one before; a leading short piece stands alone."""
    start = F.array().cast("array<string>")
    step = lambda a, x: F.when((F.length(x) < least) & (F.size(a) > 0), F.concat(F.slice(a, 1, F.size(a) - 1), F.array(F.concat(F.element_at(a, -1), F.lit(joiner), x)))).otherwise(F.array_append(a, x))
    return F.aggregate(pieces, start, step)


def thread(df: DataFrame, text: str, header: str) -> DataFrame:
    """One row per entry of a thread: header and the text up to the next header; text before the first is kept, with a
    null header. header: a pattern without groups."""
    marked = F.regexp_replace(F.col(text), f"({header})", "\u0001$1\u0002")
    out = df.select("*", F.posexplode(F.split(marked, "\u0001")).alias("entry", "_p"))
    has = F.col("_p").contains("\u0002")
    return out.withColumn("header", F.when(has, F.substring_index("_p", "\u0002", 1))).withColumn("body", strip(F.when(has, F.substring_index("_p", "\u0002", -1)).otherwise(F.col("_p")))).filter("header is not null or body <> ''").drop("_p")


def table_rows(df: DataFrame, text: str) -> DataFrame:
    """Rows of Markdown tables: (…, line, cells). Outer pipes are stripped, rows of dashes dropped."""
    rows = df.select("*", F.posexplode(F.split(text, "\n")).alias("line", "_l")).withColumn("_l", strip(F.col("_l"))).filter(F.col("_l").startswith("|") & ~F.col("_l").rlike(r"^[|:\- ]+$"))
    return rows.withColumn("cells", F.transform(F.split(F.regexp_replace("_l", r"^\|+|\|+$", ""), r"\|"), strip)).drop("_l")


def bulletin_fields(rows: DataFrame, key: list[str], order: str = "line", cells: str = "cells", aliases: dict[str, str] = domain.LABELS, markers: tuple[str, ...] = domain.MARKED_LABELS, lists: tuple[str, ...] = domain.LIST_FIELDS) -> DataFrame:
    """(key, field, extra, value, items) of the rows of a bulletin's tables: the first cell labels what the others say.

    A known label fills its field, under a heading of its own if it is one of `markers`, and texts of a field are joined by
    blank lines; fields of `lists` gather items instead. A row without a label goes on with the last known field, unless
    it only repeats the page's heading or is an image. An unknown label that says something is kept as an extra under
    its own name, the last text of each, and ends the field; one that says nothing, an implausible label and the
    standard notices change nothing. Bulletins are read each as a whole, in one window.
    """
    first, right = strip(F.get(cells, F.lit(0))), strip(F.array_join(F.filter(F.slice(cells, 2, F.greatest(F.size(cells) - 1, F.lit(0))), lambda c: c != ""), " "))
    r = rows.withColumn("_left", F.coalesce(first, F.lit(""))).withColumn("_right", F.coalesce(right, F.lit(""))).withColumn("_label", label_key(F.col("_left")))
    none, says = F.col("_left") == "", F.col("_right") != ""
    ignored = F.lit(False)
    for p in domain.IGNORED_LABELS:
        ignored = ignored | F.col("_label").startswith(p)
    heading = F.lit(False)
    for h in domain.PAGE_HEADINGS:
        heading = heading | F.lower("_right").contains(h)
    noise = (heading & (F.length("_right") < 150)) | (F.col("_right").startswith("![") & F.col("_right").endswith(")"))
    labels = ~none & plausible_label(F.col("_left")) & ~ignored
    known = alias(F.col("_label"), aliases)
    extra = labels & known.isNull() & says
    mark = F.when(labels & known.isNotNull(), known).when(extra, F.lit("\u0000"))
    w = Window.partitionBy(*key).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    r = r.withColumn("_field", F.last(mark, ignorenulls=True).over(w)).withColumn("_extra", extra)
    named = labels & known.isNotNull() & F.col("_label").isin(*markers)
    block = F.when(named, F.concat(F.lit("## "), strip(F.regexp_replace("_left", ":+$", "")), F.lit("\n\n"), F.col("_right"))).otherwise(F.col("_right"))
    goes_on = none & ~noise & (F.col("_field") != "\u0000")
    said = r.filter(says & (extra | (labels & known.isNotNull()) | goes_on)).select(*key, F.when(F.col("_extra"), F.col("_label")).otherwise(F.col("_field")).alias("field"), F.col("_extra").alias("extra"), F.struct(F.col(order).alias("at"), block.alias("text"), F.col("_right").alias("raw")).alias("x"))
    told = said.groupBy(*key, "field", "extra").agg(F.sort_array(F.collect_list("x")).alias("xs"))
    items = F.flatten(F.transform("xs", lambda x: split_operators(x["raw"])))
    is_list = ~F.col("extra") & F.col("field").isin(*lists)
    value = F.when(F.col("extra"), F.element_at("xs", -1)["raw"]).when(~is_list, F.array_join(F.transform("xs", lambda x: x["text"]), "\n\n"))
    return told.select(*key, "field", "extra", value.alias("value"), F.when(is_list, items).alias("items"))


#: How a bulletin states its version and the bulletins that it replaces.
VERSION = r"(?iU)Version\s+n\s*[°ºo]?\s*(\d+)\s+du\s+([\d/\s\w]+?\d{4})"
REPLACES = r"(?iU)(?:annule\s+et\s+)?remplace\s+(?:l['\u2019]?)?(?:IS|info\s+s[ée]curit[ée]\s+n[°º]?)\s*(\d{4}[\s/-]+\d{1,2})"


def after_tables(text: Column, least: int = 100, boilerplate: str | None = None) -> Column:
    """What follows the last line that begins and ends with a pipe, without `boilerplate` (a pattern, over lines) and
    the version footer; null without a table or if what is left is shorter than `least`."""
    table = r"(?m)^\|(?:[^\n]*\|)?$"
    tail = strip(F.element_at(F.split(text, table), -1))
    if boilerplate:
        tail = F.regexp_replace(tail, f"(?s){boilerplate}", "")
    tail = strip(F.regexp_replace(tail, VERSION, ""))
    return F.when(text.rlike(table) & (F.length(tail) >= least), tail)


def version_footer(text: Column) -> tuple[Column, Column]:
    """Version number and its date's text."""
    return F.nullif(F.regexp_extract(text, VERSION, 1), F.lit("")).cast("int"), F.nullif(F.regexp_extract(text, VERSION, 2), F.lit(""))


def replaced(text: Column) -> Column:
    """Bulletins that a text says it replaces, in their order: year/number with two digits."""
    found = F.regexp_extract_all(text, F.lit(REPLACES), F.lit(1))
    return F.transform(found, lambda x: F.concat(F.left(x, F.lit(4)), F.lit("/"), F.lpad(F.regexp_extract(x, "([0-9]+)$", 1), 2, "0")))
