"""Text functions, Column to Column, all on the JVM. White space means what Java's \\s means unless said otherwise."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Precomposed Latin letters with marks and their base letters.
MARKED = "àâäáãåéèêëíîïìóôöòõúùûüçñýÿÀÂÄÁÃÅÉÈÊËÍÎÏÌÓÔÖÒÕÚÙÛÜÇÑÝŸ"
PLAIN = "aaaaaaeeeeiiiiooooouuuucnyyAAAAAAEEEEIIIIOOOOOUUUUCNYY"
#: Words that mean "nothing" in a business field; each source has its own list.
EMPTY_IN_TITLES = ("0", "-", "n/a", "na", "ras")


def strip(c: Column) -> Column:
    """Trims all white space, not only blanks."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def once(c: Column, f) -> Column:
    """f of c, which is worked out once however often f names it; a condition and its branch would each work it out."""
    return F.transform(F.array(c), f)[0]


def stripped(c: Column) -> Column:
    """As strip, without a pattern for texts that don't end with a line end that is no white space, before which strip trims too."""
    return once(c, lambda x: F.when(F.right(x, F.lit(1)).isin("\u0085", "\u2028", "\u2029"), strip(x)).otherwise(F.btrim(x, F.lit(" \t\n\x0b\f\r"))))


def collapse(c: Column) -> Column:
    return strip(F.regexp_replace(c, r"\s+", " "))


def unmark(c: Column) -> Column:
    """Letters without their marks; decomposed marks are dropped too."""
    return F.regexp_replace(F.translate(c, MARKED, PLAIN), r"[̀-ͯ]", "")


def fold(c: Column) -> Column:
    """Lower case, no marks, single blanks; null gives the empty text."""
    return collapse(unmark(F.lower(F.coalesce(c, F.lit("")))))


def ascii_fold(c: Column) -> Column:
    return F.regexp_replace(unmark(c), r"[^\x00-\x7F]", "")


def title_key(c: Column, rewrites: Sequence[tuple[str, str]] = ()) -> Column:
    """Folded, signs to blanks, then the rewrites in their order."""
    out = collapse(F.regexp_replace(unmark(F.lower(F.coalesce(c, F.lit("")))), r"[^a-z0-9/ -]", " "))
    for pattern, by in rewrites:
        out = F.regexp_replace(out, pattern, by)
    return out


def meaningful(c: Column, empty: Sequence[str] = EMPTY_IN_TITLES) -> Column:
    """Collapsed text, or null if it is empty or one of `empty`."""
    s = collapse(c)
    return F.when((s != "") & ~F.lower(s).isin(*empty), s)


def label_key(c: Column) -> Column:
    """A table label for comparison: line breaks out, folded, colons stripped."""
    return collapse(F.regexp_replace(fold(F.regexp_replace(c, r"(?i)<br\s*/?>", " ")), r"^[:\s]+|[:\s]+$", ""))


def plausible_label(c: Column, most: int = 100) -> Column:
    s = collapse(F.regexp_replace(c, r"(?i)<br\s*/?>", " "))
    return F.coalesce((s != "") & (F.length(s) <= most) & ~s.rlike(r"(?i)https?://|www\.") & ~s.startswith("!["), F.lit(False))


def noise_line(c: Column, prefixes: Sequence[str] = (), repeated: str | None = None) -> Column:
    """Prefixes to skip, a repeated heading in a short line, or nothing but an image."""
    s, out = strip(c), F.lit(False)
    for p in prefixes:
        out = out | s.startswith(p)
    if repeated:
        out = out | (s.contains(repeated) & (F.length(s) < 150))
    return out | s.rlike(r"^!\[[^\]]*\]\([^)]*\)$")


def alias(c: Column, names: dict[str, str]) -> Column:
    pairs = [F.lit(x) for kv in names.items() for x in kv]
    return F.try_element_at(F.create_map(*pairs), c)


def first_match(c: Column, families: Sequence[tuple[str, str]]) -> Column:
    """Name of the first pattern, in the order given, that the text matches."""
    out = F
    for name, pattern in families:
        out = out.when(c.rlike(pattern), F.lit(name))
    return out


def all_matches(c: Column, families: Sequence[tuple[str, str]]) -> Column:
    """Names of all patterns that match, in the order given."""
    return F.filter(F.array(*[F.when(c.rlike(p), F.lit(n)) for n, p in families]), lambda x: x.isNotNull())


def identifiers(c: Column, pattern: str, group: int = 0) -> Column:
    return F.transform(F.regexp_extract_all(c, F.lit(pattern), F.lit(group)), strip)


def claimed_numbers(c: Column, units: str) -> Column:
    """Numbers that stand before one of the units."""
    found = F.regexp_extract_all(c, F.lit(rf"(?iu)(?:^|[^0-9A-Za-z])([0-9][0-9  ]{{0,9}}) *(?:{units})(?:[^0-9A-Za-z]|$)"), F.lit(1))
    return F.transform(found, lambda x: F.regexp_replace(x, r"[^0-9]", "").cast("long"))


def overlap(need: Column, text: Column) -> Column:
    """Share of the words of at least 3 letters of `need` that `text` holds as substrings; 0 without such words."""
    words = F.regexp_extract_all(need, F.lit("[a-z0-9]{3,}"), F.lit(0))
    return F.when(F.size(words) > 0, F.size(F.filter(words, lambda w: text.contains(w))) / F.size(words)).otherwise(0.0)


def excerpt(c: Column, needle: Column, around: int = 70, mark: str = "") -> Column:
    """The first occurrence with `around` characters on either side, white space collapsed; `mark` where text is left out."""
    at = F.position(needle, c)
    start = F.greatest(at - around, F.lit(1))
    end = F.least(at + F.length(needle) + around, F.length(c) + 1)
    inside = collapse(F.substring(c, start, end - start))
    return F.when(at > 0, F.concat(F.when(start > 1, mark).otherwise(""), inside, F.when(end <= F.length(c), mark).otherwise("")))


def acronyms(c: Column) -> Column:
    """Acronyms of 2 to 8 capitals and digits; dotted forms are read as compact."""
    compact = F.regexp_replace(c, r"(?<=[A-Z])\.(?=[A-Z])", "")
    return F.regexp_extract_all(compact, F.lit(r"(?:^|[^0-9A-Za-z_])([A-Z][A-Z0-9]{1,7})(?=[^0-9A-Za-z_]|$)"), F.lit(1))


def acronym_forms(c: Column, lower: Sequence[str] = ()) -> Column:
    """Structs (acronym, seen) of a text: dotted forms (F.O.D, compact FOD), acronyms of 2 to 8 capitals and digits, and
    words of `lower` in any case (as capitals). None is part of a longer word."""
    alone = lambda p: F.lit(rf"(?<![\p{{L}}\p{{N}}_])(?:{p})(?![\p{{L}}\p{{N}}_])")
    of = lambda p, key: F.transform(F.regexp_extract_all(c, alone(p), F.lit(0)), lambda x: F.struct(key(x).alias("acronym"), x.alias("seen")))
    found = [of(r"(?:[A-Z]\.){2,}[A-Z]?", lambda x: F.replace(x, F.lit("."), F.lit(""))), of("[A-Z][A-Z0-9]{1,7}", lambda x: x)]
    if lower:
        found.append(of(f"(?i:{'|'.join(lower)})", F.upper))
    return F.concat(*found)


def pseudonyms(names: list[str], prefix: str = "Agent_") -> dict[str, str]:
    """Stable pseudonyms: the different names in their order, numbered."""
    return {n: f"{prefix}{i:03d}" for i, n in enumerate(sorted(set(names)), 1)}


def scrub(c: Column, names: dict[str, str] | None = None) -> Column:
    """Known names by their pseudonyms, in any case, the longest first; then e-mail addresses and French phone numbers
    out, the latter only where no letter or digit touches them."""
    out = c
    for name, by in sorted((names or {}).items(), key=lambda x: (-len(x[0]), x[0])):
        out = F.regexp_replace(out, r"(?iu)\Q" + name.replace(r"\E", r"\E\\E\Q") + r"\E", by)
    out = F.regexp_replace(out, r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}", "[email]")
    return F.regexp_replace(out, r"(?<![0-9A-Za-z_])(?:\+33 ?|0)[1-9](?:[\s.-]?[0-9]{2}){4}(?![0-9A-Za-z_])", "[tel]")


def denoise(c: Column) -> Column:
    """Without date stamps and lines of initials alone."""
    out = F.regexp_replace(c, r"[0-9]{1,2}/[0-9]{1,2}/[0-9]{2,4}(?: [0-9]{1,2}[:h][0-9]{2})?", "")
    return collapse(F.regexp_replace(out, r"(?m)^ *[A-Z]{2,4} *:? *$", ""))


#: Phrases of refusal or of an echoed instruction, phrases that fill a summary, other scripts.
REFUSALS = ("je ne peux", "je suis désolé", "désolé,", "en tant qu'ia", "en tant que modèle", "je suis un assistant", "veuillez fournir", "pouvez-vous fournir", "résumé :", "voici un résumé", "voici le résumé")
FILLERS = ("des mesures correctives ont été prises", "des mesures ont été prises", "les causes exactes n'ont pas été", "les causes n'ont pas été précisées", "aucune information supplémentaire")
OTHER_SCRIPTS = "[\u0400-\u04ff\u0600-\u06ff\u4e00-\u9fff\u3040-\u30ff\uac00-\ud7af]"


def summary_fault(c: Column, least: int = 30, short: int = 120) -> Column:
    """Why a generated summary is not usable, or null: too short, a refusal, another script, or filler, which is two
    filling phrases, or one in a text of fewer than `short` characters."""
    s = F.coalesce(strip(c), F.lit(""))
    low = F.lower(s)
    times = sum(((F.length(low) - F.length(F.replace(low, F.lit(p), F.lit("")))) / len(p) for p in FILLERS), F.lit(0))
    refused = F.exists(F.array(*[F.lit(p) for p in REFUSALS]), lambda p: low.contains(p))
    return F.when(F.length(s) < least, "too short").when(refused, "refusal").when(s.rlike(OTHER_SCRIPTS), "script").when((times >= 2) | ((F.length(s) < short) & (times > 0)), "filler")


def trailing_noise(c: Column) -> Column:
    """Without question marks and white space at the end."""
    return F.regexp_replace(c, r"[\s?]+$", "")


def person_key(c: Column) -> Column:
    return F.lower(strip(c))


def any_contains(columns: Sequence[Column], terms: Sequence[str]) -> Column:
    """Whether any of the fields holds any of the terms; null fields hold none."""
    out = F.lit(False)
    for c in columns:
        for t in terms:
            out = out | F.coalesce(c.contains(t), F.lit(False))
    return out


def joined_length(columns: Sequence[Column]) -> Column:
    """Length of all fields together; null counts as empty."""
    return F.length(F.concat_ws("", *columns))


def identifier(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9A-Za-z_]", "_")


def light_html(c: Column) -> Column:
    """Line breaks kept, other tags out, the five basic entities decoded. For anything else use operators.html.

    Patterns are searched for only in texts that hold what they begin with."""
    no_breaks = lambda x: F.when(F.contains(F.lower(x), F.lit("<br")), F.regexp_replace(x, r"(?i)<br\s*/?>", "\n")).otherwise(x)

    def decoded(x: Column) -> Column:
        out = F.regexp_replace(no_breaks(x), r"<[^>]*>", " ")
        for a, b in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&amp;", "&")):
            out = F.replace(out, F.lit(a), F.lit(b))
        return F.regexp_replace(out, r"[ \t]+", " ")

    # without entities, tags and blanks that stand together become one blank at once
    out = once(c, lambda x: F.when(~F.contains(x, F.lit("&")), F.regexp_replace(no_breaks(x), r"(?:<[^>]*+>|[ \t]++)++", " ")).otherwise(decoded(x)))
    return stripped(once(out, lambda x: F.when(F.contains(x, F.lit("\n")), F.regexp_replace(x, r" *\n *", "\n")).otherwise(x)))


def split_operators(c: Column) -> Column:
    """Items between line breaks, line ends and bullets, without dashes and blanks around them; single characters go."""
    parts = F.split(c, r"(?i)<br\s*/?>|[•●\n]")
    return F.filter(F.transform(parts, lambda x: F.regexp_replace(x, r"^[ \t-]+|[ \t-]+$", "")), lambda x: F.length(x) > 1)


def prompt_parts(summary: Column, follow_up: Column, detail: Column, most: int, summary_most: int = 300, share: float = 0.55) -> tuple[Column, Column, Column]:
    """The three texts of a prompt cut to `most` characters together: the summary to its own limit, the follow-up to a
    share of what is left, the detail to the rest. Null counts as empty."""
    own = lambda x: F.coalesce(x, F.lit(""))
    s = F.left(strip(own(summary)), F.lit(summary_most))
    f = F.left(own(follow_up), F.greatest(F.lit(0), F.floor((F.lit(most) - F.length(s)) * share).cast("int")))
    return s, f, F.left(own(detail), F.greatest(F.lit(0), F.lit(most) - F.length(s) - F.length(f)))


def fill_template(template: str, **values: Column) -> Column:
    """A prompt with {name} slots; a line whose only slot is empty or null is left out."""
    lines = []
    for line in template.splitlines():
        out, present = [], F.lit(True)
        for i, part in enumerate(line.replace("}", "{").split("{")):
            if i % 2:
                present = present & F.coalesce(values[part] != "", F.lit(False))
                out.append(values[part])
            else:
                out.append(F.lit(part))
        lines.append(F.when(present, F.concat(*out)))
    return F.concat_ws("\n", *lines)
