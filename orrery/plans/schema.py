"""Projections generated from a configuration: fields with key, source label, role, type and minimum length."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import DAY_FIRST, any_label_yes, extras, multi_valued, not_zero, parse_date, tri_state
from ..functions.text import strip

#: Type names of the configuration. A configured "decimal" is a floating-point number.
TYPES = {"texte": "string", "entier": "int", "decimal": "double", "booleen": "boolean", "date": "date", "horodatage": "timestamp", "heure": "string", "dictionnaire": "map<string,string>"}
#: Named derived values; users add theirs.
DERIVED: dict[str, Callable[[Column], Column]] = {"value_not_zero": not_zero, "list_label_is_oui": any_label_yes}


@dataclass(frozen=True)
class Field:
    key: str
    label: str
    role: str = "propriete"  # propriete, date, flag or relation
    type: str = "texte"
    embedding: bool = False
    min_length: int = 20
    empty: tuple[str, ...] = ()
    node: str | None = None
    node_key: str | None = None
    relation: str | None = None
    required: bool = False
    derived: str | None = None  # name in DERIVED


@dataclass(frozen=True)
class Module:
    name: str
    identity: str
    fields: tuple[Field, ...] = field(default_factory=tuple)
    extras: tuple[str, ...] = ()  # rare source fields that are kept as they are

    @staticmethod
    def parse(config: dict) -> Module:
        """From a parsed configuration file (French keys as in the files)."""
        names = {"cle": "key", "noeud": "node", "cle_noeud": "node_key", "filtre_vide": "empty", "requis": "required", "derive": "derived"}
        fields = tuple(Field(**{names.get(k, k): tuple(v) if isinstance(v, list) else v for k, v in x.items()}) for x in config["champs"])
        kept = config.get("extras") or {}
        return Module(config["module"], config["identite"], fields, tuple(kept.get("whitelist") or ()) if kept.get("enabled") else ())


def missing_fields(module: Module, columns: list[str]) -> list[str]:
    """Drift: keys of the configuration that a table lacks."""
    return [f.key for f in module.fields if f.role != "relation" and f.key not in columns]


def value(f: Field) -> Column:
    """The field's Column: the derived value it names, else cast by type, null where the source is empty or does not fit."""
    if f.derived:
        return DERIVED[f.derived](F.col(f"`{f.label}`"))
    s = strip(F.col(f"`{f.label}`").cast("string"))
    s = F.when((s != "") & ~F.lower(s).isin(*(e.lower() for e in f.empty)) if f.empty else (s != ""), s)
    if f.role == "date" or f.type in ("date", "horodatage"):
        t = parse_date(s, DAY_FIRST)
        return t.cast("date") if f.type == "date" else t
    if f.role == "flag":
        return tri_state(s)
    if f.type == "booleen":  # truthiness of the text, not its meaning
        return s.isNotNull()
    if f.type == "dictionnaire":
        return F.from_json(s, "map<string,string>")
    return s if TYPES[f.type] == "string" else s.try_cast(TYPES[f.type])


def _links(f: Field) -> Column:
    return F.transform(multi_valued(F.col(f"`{f.label}`")), lambda v: F.struct(F.lit(f.node).alias("node"), F.lit(f.node_key).alias("key"), v.alias("value"), F.lit(f.relation).alias("relation")))


def project(rows: DataFrame, module: Module) -> DataFrame:
    """One typed row per identity: the configured columns and `entities`, the linked nodes. Rows without identity go;
    of several, the first by the column `position`, if there is one, stays. If the module keeps extras, the map
    `extra_fields` holds, by source field, what is there of them as text, structures and lists as JSON."""
    from ..operators.graph import latest

    plain = [f for f in module.fields if f.role != "relation"]
    links = [_links(f) for f in module.fields if f.role == "relation"]
    entities = F.flatten(F.array(*[F.coalesce(x, F.array().cast("array<struct<node:string,key:string,value:string,relation:string>>")) for x in links])) if links else F.array().cast("array<struct<node:string,key:string,value:string,relation:string>>")
    keep = ["position"] if "position" in rows.columns else []
    rare = [c for c in dict.fromkeys(module.extras) if c in rows.columns]
    nested = lambda c: rows.schema[c].dataType.simpleString().startswith(("struct", "array", "map"))
    extra = extras(rare, **{c: F.to_json(c) if nested(c) else F.col(c) for c in rare}, prefix="") if rare else F.create_map().cast("map<string,string>")
    out = rows.select(*keep, *[value(f).alias(f.key) for f in plain], entities.alias("entities"), *([extra.alias("extra_fields")] if module.extras else []))
    for f in plain:
        if f.required:
            out = out.filter(F.col(f.key).isNotNull())
    out = out.filter(F.col(module.identity).isNotNull())
    return latest(out, [module.identity], [F.col(c) for c in keep] or [F.col(module.identity)]).drop(*keep)


def texts(rows: DataFrame, module: Module, key: str) -> DataFrame:
    """(key, field, text) of the fields to embed that are at least their own minimum length."""
    items = [F.struct(F.lit(f.key).alias("field"), F.col(f.key).alias("text")) for f in module.fields if f.embedding and f.role == "propriete"]
    found = F.filter(F.array(*items), lambda x: F.length(x["text"]) >= F.element_at(F.create_map(*[y for f in module.fields for y in (F.lit(f.key), F.lit(f.min_length))]), x["field"]))
    return rows.select(key, F.explode(found).alias("x")).select(key, "x.field", "x.text")


def schema_table(spark, module: Module) -> DataFrame:
    """The configuration as a dimension table, to be overwritten as a whole."""
    rows = [(module.name, i, f.key, f.label, f.role, f.type, f.embedding, f.min_length) for i, f in enumerate(module.fields)]
    return spark.createDataFrame(rows, "module string, place int, key string, label string, role string, type string, embedding boolean, min_length int")


def coherent_types(df: DataFrame) -> DataFrame:
    """Columns of no type become text, so that the table can be written."""
    return df.withColumns({c: F.col(c).cast("string") for c, t in df.dtypes if t == "void"})


def is_test_record(title: Column, number: Column | None = None) -> Column:
    out = F.coalesce(title.contains("{{"), F.lit(False)) | F.coalesce(F.upper(title).contains("POSTMAN"), F.lit(False))
    return out | F.coalesce(F.upper(number).contains("POSTMAN") | number.contains("{{"), F.lit(False)) if number is not None else out


def routed(rows: DataFrame, kind: Column, extractors: dict[str, Callable[[DataFrame], DataFrame]], fallback: Column | None = None) -> DataFrame:
    """Each kind's rows through its own projection. Rows whose kind has none go by `fallback` (the payload's own module
    name); what that does not know either is left out."""
    known = F.coalesce(kind.isin(*extractors), F.lit(False))
    route = F.when(known, kind).otherwise(fallback) if fallback is not None else kind
    out = None
    for name, extract in extractors.items():
        part = extract(rows.filter(route == name))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out
