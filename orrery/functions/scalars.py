"""Identifiers, dates, booleans, vectors and statistics as Column expressions."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip, unmark

#: French month names without marks.
MONTHS = ("janvier", "fevrier", "mars", "avril", "mai", "juin", "juillet", "aout", "septembre", "octobre", "novembre", "decembre")


def uuid5(namespace: uuid.UUID, name: Column) -> Column:
    """RFC 4122 name-based id, version 5: SHA-1 with the version and variant bits set."""
    h = F.sha1(F.concat(F.unhex(F.lit(namespace.hex)), F.encode(name, "UTF-8")))
    variant = F.substring(F.lit("89ab"), F.pmod(F.conv(F.substring(h, 17, 1), 16, 10).cast("int"), F.lit(4)) + 1, F.lit(1))
    return F.concat(F.substring(h, 1, 8), F.lit("-"), F.substring(h, 9, 4), F.lit("-5"), F.substring(h, 14, 3), F.lit("-"), variant, F.substring(h, 18, 3), F.lit("-"), F.substring(h, 21, 12))


def ref_key(family: Column, code: Column) -> Column:
    return F.concat_ws(":", family, code)


def parse_date(c: Column, formats: Sequence[str]) -> Column:
    """The first of the formats that fits; null if none does."""
    return F.coalesce(*[F.try_to_timestamp(c, F.lit(f)) for f in formats])


DAY_FIRST = ("dd/MM/yyyy HH:mm:ss", "dd/MM/yyyy HH:mm", "dd/MM/yyyy", "d/M/yyyy", "dd-MM-yyyy", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd")
ISO_FIRST = ("yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd", "MM/dd/yyyy", "dd/MM/yyyy")


def french_date(c: Column) -> Column:
    """'10 mars 2026' or '10 / 03 / 2026'; impossible dates are null."""
    s = unmark(F.lower(c))
    name = F.regexp_extract(s, r"([0-9]{1,2})(?:er)? +([a-z]+) +([0-9]{4})", 2)
    month = F.array_position(F.array(*[F.lit(m) for m in MONTHS]), name)
    spelt = F.when(month > 0, F.concat_ws("-", F.regexp_extract(s, r"([a-z]+) +([0-9]{4})", 2), F.lpad(month.cast("string"), 2, "0"), F.lpad(F.regexp_extract(s, r"([0-9]{1,2})(?:er)? +[a-z]+ +[0-9]{4}", 1), 2, "0")))
    pattern = r"([0-9]{1,2}) */ *([0-9]{1,2}) */ *([0-9]{4})"
    digits = F.when(s.rlike(pattern), F.concat_ws("-", F.regexp_extract(s, pattern, 3), F.lpad(F.regexp_extract(s, pattern, 2), 2, "0"), F.lpad(F.regexp_extract(s, pattern, 1), 2, "0")))
    return F.try_to_date(F.coalesce(spelt, digits), "yyyy-MM-dd")


def iso_or_raw(c: Column) -> Column:
    """An action's date as ISO text, or the text as it is."""
    parsed = F.coalesce(F.try_to_date(c, "dd/MM/yyyy"), F.try_to_date(c, "dd/MM/yy"), F.try_to_date(c, "yyyy-MM-dd"))
    return F.coalesce(F.date_format(parsed, "yyyy-MM-dd"), strip(c))


def year_of(c: Column, low: int = 1, high: int = 9999) -> Column:
    y = F.regexp_extract(c, r"([0-9]{4})", 1).try_cast("int")
    return F.when(y.between(low, high), y)


def tri_state(c: Column) -> Column:
    """'oui…' is true, 'non' false, anything else unknown."""
    s = F.lower(strip(c))
    return F.when(s.startswith("oui"), True).when(s == "non", False)


def two_state(c: Column) -> Column:
    """Only oui, true, vrai and 1 are true; all else, null included, is false."""
    return F.coalesce(F.lower(strip(c)).isin("oui", "true", "vrai", "1"), F.lit(False))


def not_zero(c: Column) -> Column:
    return F.coalesce(c.try_cast("int") != 0, F.lit(False))


def any_label_yes(items: Column) -> Column:
    return F.coalesce(F.exists(items, lambda x: F.lower(F.trim(x["_label"])) == "oui"), F.lit(False))


def multi_valued(c: Column) -> Column:
    """Values of a field joined by pipes: trimmed, not empty, first occurrences."""
    return F.array_distinct(F.filter(F.transform(F.split(c, "[|]"), strip), lambda x: x != ""))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column, eps: float = 1e-12) -> Column:
    return dot(a, b) / F.greatest(F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)), F.lit(eps))


def wilson(hits: Column, n: Column, z: float = 1.96) -> tuple[Column, Column]:
    """Wilson interval of a proportion; (0, 1) without trials."""
    p, d = hits / n, 1 + z * z / n
    mid, half = (p + z * z / (2 * n)) / d, z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n)) / d
    return F.when(n > 0, F.greatest(F.lit(0.0), mid - half)).otherwise(0.0), F.when(n > 0, F.least(F.lit(1.0), mid + half)).otherwise(1.0)


def hash_order(*keys: Column, seed: int = 0) -> Column:
    """A reproducible random order of keys."""
    return F.xxhash64(*keys, F.lit(seed))


def repaired_escapes(c: Column) -> Column:
    """JSON text with every backslash doubled that begins no valid escape (\\u needs four hex digits). Valid escapes are
    taken from left to right, so both halves of a doubled backslash stay as they are."""
    # valid escapes step aside behind control characters, which JSON text can't hold: a pair as 1 2, others as 1 x 2
    out = F.regexp_replace(c, r'\\(?:\\|(["/bfnrt]|u[0-9A-Fa-f]{4}))', "\u0001$1\u0002")
    for a, b in (("\\", "\\\\"), ("\u0001\u0002", "\\\\"), ("\u0001", "\\"), ("\u0002", "")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def tolerant_json(c: Column) -> Column:
    """Text of JSON as VARIANT: as it is, else the first {...} in it, else with lone backslashes doubled; else null."""
    inner = F.regexp_extract(c, r"(?s)(\{.*\})", 1)
    return F.coalesce(F.try_parse_json(c), F.try_parse_json(inner), F.try_parse_json(repaired_escapes(inner)))


def enum_or(c: Column, allowed: Sequence[str], default: str) -> Column:
    return F.when(c.isin(*allowed), c).otherwise(default)


def enum_by_prefix(c: Column, allowed: Sequence[str], default: str) -> Column:
    """The allowed value that the text is, or the first that it begins with, whatever marks, case, blanks and hyphens;
    else the default."""
    from .text import ascii_fold

    key = F.regexp_replace(F.lower(strip(ascii_fold(F.coalesce(c, F.lit(""))))), "[ -]", "_")
    out = F.when(key.isin(*allowed), key)
    for a in allowed:
        out = out.when(key.startswith(a), F.lit(a))
    return out.otherwise(default)


def extras(names: Sequence[str], prefix: str = "extra_", **columns: Column) -> Column:
    """Map of the named columns that are not null, as text. Structures are given as JSON: F.to_json(column)."""
    return F.map_filter(F.map_from_arrays(F.array(*[F.lit(f"{prefix}{n}") for n in names]), F.array(*[columns[n].cast("string") for n in names])), lambda k, v: v.isNotNull())


def whole_numbers(items: Column) -> Column:
    """The items of a list of texts that are whole numbers."""
    return F.filter(F.transform(items, lambda x: F.when(x.rlike(r"^\s*[+-]?[0-9]+\s*$"), strip(x).try_cast("long"))), lambda x: x.isNotNull())


def code_meanings(entries: Column, joiner: str = " — ") -> Column:
    """A map of codes as a sorted list of `code — meaning`."""
    return F.sort_array(F.transform(F.map_entries(entries), lambda e: F.concat(e["key"], F.lit(joiner), e["value"])))
