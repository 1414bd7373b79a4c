"""Place normalisation: runway designators, strips, stands and zones of a site described by a table of its own."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import fold, strip


@dataclass(frozen=True)
class Site:
    """strips: each the set of its two designators. renamed: former designator to today's. lettered: whether
    designators carry L or R. stands: whether stands such as C83 are known here."""

    label: str
    code: str
    names: tuple[str, ...]
    strips: tuple[tuple[str, str], ...]
    renamed: dict[str, str] = field(default_factory=dict)
    lettered: bool = True
    stands: bool = True

    @property
    def runways(self) -> list[str]:
        return sorted({x for s in self.strips for x in s})


#: The two sites of the domain, their codes, strips and the renaming of 2016.
SITES = (
    Site("Lyon Saint Exupéry", "LFLL", ("lyon saint exupery", "lyon saint-exupery"), (("17R", "35L"), ("17L", "35R")), {"18L": "17L", "18R": "17R", "36L": "35L", "36R": "35R"}),
    Site("Lyon Bron", "LFLY", ("lyon bron",), (("16", "34"),), lettered=False, stands=False),
)


def _lit_array(values) -> Column:
    return F.array(*[F.lit(v) for v in values]) if values else F.array().cast("array<string>")


def _no_zero(x: Column) -> Column:
    return F.regexp_replace(x, "^0+(?=[0-9])", "")


def designators(text: Column, site: Site) -> Column:
    """All designators of the text in their order, as written but without leading zeros."""
    pair = F.regexp_extract_all(text, F.lit(r"(?<![0-9A-Za-z_])0?([0-9]{2} *[LR])(?![0-9A-Za-z_])"), F.lit(1))
    lettered = F.transform(pair, lambda x: F.replace(x, F.lit(" "), F.lit("")))
    if site.lettered:
        return F.array_distinct(lettered)
    whole = r"^ *(0?[0-9]{2})(?: */ *(0?[0-9]{2}))? *$"
    axis = F.when(text.rlike(whole), F.filter(F.array(F.regexp_extract(text, whole, 1), F.regexp_extract(text, whole, 2)), lambda x: x != ""))
    named = F.regexp_extract_all(text, F.lit(r"(?:PISTE|SEUIL|FINALE?|APPROCHE|QFU) *(0?[0-9]{2})(?![0-9A-Za-z_])"), F.lit(1))
    bare = F.transform(F.coalesce(axis, named), _no_zero)
    return F.array_distinct(F.when(F.size(lettered) > 0, lettered).otherwise(bare))


def normalise(precisions: Column, aerodrome: Column, sites: tuple[Site, ...] = SITES) -> Column:
    """Struct of aerodrome, aerodrome_code, runway_raw, runway_current, runway_renamed, strips, stand, zone, anomaly.

    Designators that the site does not know are reported, never corrected. Two ends of one strip count as one strip,
    two parallel designators as two.
    """
    text, place = F.upper(strip(F.coalesce(precisions, F.lit("")))), fold(aerodrome)
    zone = F.coalesce(F.nullif(F.regexp_extract(text, r"[- ] *(MAN|TRA)(?![0-9A-Za-z_])", 1), F.lit("")), F.when(text.isin("MAN", "TRA", "AD"), text))
    kind = "struct<aerodrome:string,aerodrome_code:string,runway_raw:array<string>,runway_current:array<string>,runway_renamed:boolean,strips:int,stand:string,zone:string,anomaly:string>"
    out = F
    for s in sites:
        raw = designators(text, s)
        bare = raw if s.lettered else F.transform(raw, lambda x: F.regexp_replace(x, "[LR]$", ""))
        table = F.create_map(*[F.lit(x) for kv in s.renamed.items() for x in kv]) if s.renamed else None
        now = F.transform(bare, lambda x: F.coalesce(F.try_element_at(table, x), x)) if s.renamed else bare
        outside = F.array_except(now, _lit_array(s.runways))
        known = F.sort_array(F.array_distinct(F.array_intersect(now, _lit_array(s.runways))))
        good = (F.size(known) > 0) & ((F.size(outside) == 0) if s.lettered else F.lit(True))
        lettered = F.exists(raw, lambda x: x.rlike("[LR]$"))
        anomaly = F.when((F.size(raw) > 0) & ~good, F.concat(F.array_join(raw, "/"), F.lit(f" unknown at {s.label}")))
        if not s.lettered:
            anomaly = F.coalesce(anomaly, F.when(good & lettered, F.lit(f"no left or right at {s.label}")))
        strips = sum((F.when(F.arrays_overlap(known, _lit_array(x)), 1).otherwise(0) for x in s.strips), F.lit(0))
        stand = F.when((F.size(raw) == 0) & text.rlike("^[A-Z] ?[0-9]{1,3}$"), text) if s.stands else F.lit(None)
        value = F.struct(
            F.lit(s.label).alias("aerodrome"), F.lit(s.code).alias("aerodrome_code"), F.when(F.size(raw) > 0, raw).alias("runway_raw"), F.when(good, known).alias("runway_current"),
            (good & (F.size(F.array_except(bare, now)) > 0)).alias("runway_renamed"), F.when(good, strips).alias("strips"), stand.alias("stand"), zone.alias("zone"), anomaly.alias("anomaly"),
        )
        out = out.when(place.isin(*s.names), value.cast(kind))
    return out.otherwise(F.struct(*[F.lit(None).alias(n) for n in ("aerodrome", "aerodrome_code", "runway_raw", "runway_current")], F.lit(False).alias("runway_renamed"), *[F.lit(None).alias(n) for n in ("strips", "stand")], zone.alias("zone"), F.lit(None).alias("anomaly")).cast(kind))


def runways_asked(question: Column, site: Site = SITES[0], bare: Site = SITES[1]) -> Column:
    """Today's names of the runways that a question speaks of, each once, in their order: lettered ones of `site`
    (former names lead to today's, unknown ones are left out); without any, those of `bare`, an axis (16/34) before
    a single one."""
    text = F.upper(F.coalesce(question, F.lit("")))
    found = F.regexp_extract_all(text, F.lit(r"(?<![0-9A-Z_])0?([0-9]{2}\s*[LR])(?![0-9A-Z_])"), F.lit(1))
    table = F.create_map(*[F.lit(x) for kv in site.renamed.items() for x in kv])
    now = F.transform(found, lambda x: F.coalesce(F.try_element_at(table, F.regexp_replace(x, r"\s", "")), F.regexp_replace(x, r"\s", "")))
    lettered = F.filter(F.array_distinct(now), lambda x: x.isin(*site.runways))
    a, b = bare.strips[0]
    axis = rf"(?<![0-9A-Z_]){a}\s*/\s*{b}(?![0-9A-Z_])"
    single = F.array_distinct(F.regexp_extract_all(text, F.lit(rf"(?<![0-9A-Z_])PISTES?\s+({a}|{b})(?![0-9A-Z_])"), F.lit(1)))
    return F.when(F.size(lettered) > 0, lettered).when(text.rlike(axis), _lit_array((a, b))).otherwise(single)


def renamed_counts(rows: DataFrame, place: str) -> DataFrame:
    """rows with a normalised place: (former, n) for every former designator that a row was entered under."""
    raw = F.explode(F.array_distinct(F.array_except(f"{place}.runway_raw", f"{place}.runway_current")))
    return rows.filter(F.col(f"{place}.runway_renamed")).select(raw.alias("former")).groupBy("former").agg(F.count(F.lit(1)).alias("n"))


def first_runway_or_stand(a: Column, b: Column) -> tuple[Column, Column]:
    """First runway of two columns, and the first stand where there is no runway."""
    runway = F.coalesce(*[F.nullif(F.regexp_extract(F.upper(c), r"(?<![0-9A-Z_])0?([0-9]{2}[LR])(?![0-9A-Z_])", 1), F.lit("")) for c in (a, b)])
    stand = F.coalesce(*[F.nullif(F.regexp_extract(F.upper(c), r"(?<![0-9A-Z_])([A-Z][0-9]{1,3})(?![0-9A-Z_])", 1), F.lit("")) for c in (a, b)])
    return runway, F.when(runway.isNull(), stand)
