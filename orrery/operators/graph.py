"""Entity and relation tables: nodes(label, key, props), edges(src, rel, dst), idempotent upserts and checks."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def nodes(df: DataFrame, label: str, key: Column, **props: Column) -> DataFrame:
    """Props that are null are left out."""
    pairs = [x for k, v in props.items() for x in (F.lit(k), v.cast("string"))]
    m = F.map_filter(F.create_map(*pairs), lambda k, v: v.isNotNull()) if pairs else F.create_map().cast("map<string,string>")
    return df.select(F.lit(label).alias("label"), key.cast("string").alias("key"), m.alias("props")).filter("key is not null")


def edges(df: DataFrame, src: Column, rel: str, dst: Column) -> DataFrame:
    return df.select(src.cast("string").alias("src"), F.lit(rel).alias("rel"), dst.cast("string").alias("dst")).filter("src is not null and dst is not null").dropDuplicates(["src", "rel", "dst"])


def upsert(old: DataFrame, new: DataFrame, keys: list[str], order: str, keep_old: tuple[str, ...] = ()) -> DataFrame:
    """One row per key. Columns take the newest non-null value by `order`; those of keep_old the oldest.

    Aggregates only, so that a key with very many versions is combined before the shuffle. Applying the same rows
    twice changes nothing.
    """
    rows = old.unionByName(new)
    rest = [c for c in rows.columns if c not in (*keys, order)]
    pick = lambda c: (F.min_by if c in keep_old else F.max_by)(c, F.when(F.col(c).isNotNull(), F.col(order)))
    return rows.groupBy(*keys).agg(*[pick(c).alias(c) for c in rest], F.max(order).alias(order)).select(*rows.columns)


def latest(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The whole newest row of each key."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("_r", F.row_number().over(w)).filter("_r = 1").drop("_r")


def merge_edges(old: DataFrame, new: DataFrame) -> DataFrame:
    return old.unionByName(new).dropDuplicates(["src", "rel", "dst"])


def stubs(known: DataFrame, referenced: DataFrame, label: str) -> DataFrame:
    """Nodes for keys that edges name but no row describes."""
    missing = referenced.select(F.col("key").cast("string").alias("key")).distinct().join(known.select("key"), "key", "left_anti")
    return missing.select(F.lit(label).alias("label"), "key", F.create_map().cast("map<string,string>").alias("props"), F.lit(True).alias("is_stub"))


def violations(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once; empty if the constraint holds."""
    return rows.groupBy(*keys).count().filter("count > 1")


def text_violations(rows: DataFrame, text: str) -> DataFrame:
    """The same for a column of long texts: digests are shuffled instead, and one text of each repeated digest."""
    d = rows.select(F.sha2(text, 256).alias("_d"), text)
    many = d.groupBy("_d").count().filter("count > 1")
    return d.join(many, "_d").groupBy("_d").agg(F.min(text).alias(text), F.first("count").alias("count")).drop("_d")


def triplets(e: DataFrame, src_label: Column, dst_label: Column, n: int = 50) -> DataFrame:
    return e.groupBy(src_label.alias("src_label"), "rel", dst_label.alias("dst_label")).count().orderBy(F.desc("count"), "src_label", "rel", "dst_label").limit(n)


def satellites(e: DataFrame) -> DataFrame:
    """Per relation: distinct sources and targets, links, mean links of a source."""
    return e.groupBy("rel").agg(F.countDistinct("src").alias("sources"), F.countDistinct("dst").alias("targets"), F.count(F.lit(1)).alias("links"), F.round(F.count(F.lit(1)) / F.countDistinct("src"), 9).alias("mean_links"))


def enrich(rows: DataFrame, other: DataFrame, key: Column, other_key: str, columns: list[str]) -> DataFrame:
    """Left join in which a matched row's values overwrite, nulls included. other: one row per key."""
    o = other.select(F.col(other_key).alias("_key"), *[F.col(c).alias(f"_new_{c}") for c in columns])
    j = rows.withColumn("_own", key).join(o, F.col("_own") == F.col("_key"), "left")
    rest = [c for c in rows.columns if c not in columns]
    new = [F.when(F.col("_key").isNotNull(), F.col(f"_new_{c}")).otherwise(F.col(c) if c in rows.columns else F.lit(None)).alias(c) for c in columns]
    return j.select(*rest, *new)


def hierarchy(rows: DataFrame, key: str, parent: str) -> DataFrame:
    """(child, parent) for every row whose parent is there and is not the row itself; the order of rows is no matter."""
    p = rows.select(F.col(key).alias("_parent")).distinct()
    return rows.join(p, F.col(parent) == F.col("_parent"), "left_semi").filter(F.col(key) != F.col(parent)).select(F.col(key).alias("child"), F.col(parent).alias("parent"))


def title_hierarchy(rows: DataFrame, key: str, titles: list[str], parent_key: str | None = None) -> DataFrame:
    """(child, parent) of rows that agree in all `titles` where the parent's key is the smaller one; titles are no keys,
    so a child may have several parents."""
    a, b = rows.alias("a"), rows.alias("b")
    on = F.col(f"a.{key}") > F.col(f"b.{key}")
    for t in titles:
        on = on & (F.col(f"a.{t}") == F.col(f"b.{t}"))
    return a.join(b, on).select(F.col(f"a.{key}").alias("child"), F.col(f"b.{key}").alias("parent"))


#: Links that a task of `title_links` is expected to make.
LINKS = 4_000_000


def title_links(rows: DataFrame, key: str, title: str, targets: DataFrame, target_key: str, target_title: str, links: int = LINKS) -> DataFrame:
    """Different (key, target) of rows whose title is a target's, white space at the ends aside; blank titles link nothing.

    Titles are no keys, so there may be very many links. They are made once, by their smallest common title, and not
    shuffled: what is dealt out is the rows of a title, into as many tasks as the number of links calls for.
    """
    from ..functions.text import strip

    def titled(df: DataFrame, key: str, title: str, name: str) -> DataFrame:
        told = df.select(F.col(key).alias(name), strip(F.col(title)).alias("_t")).filter("_t <> ''").groupBy(name).agg(F.collect_set("_t").alias("_all"))
        return told.select(name, F.when(F.size("_all") > 1, F.col("_all")).alias(f"_{name}_titles"), F.explode("_all").alias("_t"))

    a, b = titled(rows, key, title, "key"), titled(targets, target_key, target_title, "target")
    n = a.groupBy("_t").count().join(b.groupBy("_t").agg(F.count(F.lit(1)).alias("n")), "_t").agg(F.sum(F.col("count").cast("double") * F.col("n"))).first()[0] or 0
    tasks = max(1, math.ceil(n / links))
    a = a.withColumn("_salt", F.pmod(F.xxhash64("key"), F.lit(tasks)).cast("int")).repartition(tasks, "_t", "_salt")
    b = b.join(a.select("_t").distinct(), "_t", "left_semi").withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(tasks - 1)))).repartition(tasks, "_t", "_salt")
    first = F.array_min(F.array_intersect("_key_titles", "_target_titles")) == F.col("_t")
    return a.hint("shuffle_merge").join(b, ["_t", "_salt"]).filter(F.coalesce(first, F.lit(True))).select("key", "target")


def referenced(rows: DataFrame, key: str, by: DataFrame, by_key: str) -> DataFrame:
    """Rows that at least one row of `by` names."""
    return rows.join(by.select(F.col(by_key).alias("_named")), F.col(key) == F.col("_named"), "left_semi")


def entity_edges(rows: DataFrame, key: str, entities: str = "entities") -> DataFrame:
    """Edges of a projected table: one per row and linked node, (src, rel, dst) with dst as node:value."""
    e = rows.select(F.col(key).cast("string").alias("src"), F.inline(entities))
    return e.select("src", F.col("relation").alias("rel"), F.concat_ws(":", "node", "value").alias("dst")).filter("src is not null").distinct()


def patch(rows: DataFrame, values: DataFrame, key: str, columns: list[str], purge: Column | None = None) -> DataFrame:
    """Adds or replaces columns where values has the key; where `purge` holds they are removed."""
    out = rows.join(values.select(key, *[F.col(c).alias(f"_new_{c}") for c in columns]), key, "left")
    for c in columns:
        v = F.coalesce(f"_new_{c}", c) if c in rows.columns else F.col(f"_new_{c}")
        out = out.withColumn(c, F.when(~F.coalesce(purge, F.lit(False)), v) if purge is not None else v)
    return out.drop(*[f"_new_{c}" for c in columns])


def property_differences(a: DataFrame, b: DataFrame) -> DataFrame:
    """(property, in_a, in_b) of two tables of property names."""
    x, y = a.select("property", F.lit(True).alias("in_a")).distinct(), b.select("property", F.lit(True).alias("in_b")).distinct()
    return x.join(y, "property", "full").select("property", F.coalesce("in_a", F.lit(False)).alias("in_a"), F.coalesce("in_b", F.lit(False)).alias("in_b"))
