"""The wide projection of raw tickets to their canonical table."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.scalars import uuid5
from ..functions.text import light_html, once, strip
from ..operators import html

#: Limits: characters of a joined list, least and most of a text that is kept.
LIST, LEAST, MOST = 200, 50, 4000
#: Canonical name, source field (nested ones with a dot) and type of what is copied as it is.
COPIED = (
    ("date_nc", "date_nc", "string"), ("etape", "etape", "int"), ("archive_nc", "archive_nc", "int"), ("importance", "importance", "string"), ("etat", "etat", "string"),
    ("societe_id", "societe", "int"), ("projet_id", "projet_ticket._id", "string"), ("type_label", "type_de_de._label", "string"), ("type_code", "type_de_de._code", "string"), ("parent_numero_fe", "parent.numero_fe", "string"),
)
#: What a ticket's full record copies beside these, and the space of its identifiers.
MORE = (
    ("abbr", "abbr", "string"), ("type_nc", "type_nc", "string"), ("etape_label", "etape_label", "string"), ("id_type", "id_type", "int"), ("id_unite", "id_unite", "int"), ("branche_developpement", "branchededeveloppement", "string"),
    ("priorite_projet", "ticket_priorite_par_projet", "string"), ("version_souhaitee", "versionsouhaitee._label", "string"), ("version_souhaitee_id", "ticket_version_souhaitee._id", "string"), ("emetteur_login", "emetteur_nc", "string"), ("emetteur_id", "id_emetteur_nc", "int"),
    ("site_application", "site_application", "string"), ("projet_nom", "projet_nom", "string"), ("structure", "structure", "string"), ("urgence", "urgence", "string"), ("individu", "individu", "string"), ("developpeur_login", "developpeur_responsable.loginUser", "string"),
)
TICKETS = uuid.UUID("b8e5d3a1-4f6c-5b2e-9d1a-3c8e7f4a6b5d")


def joined_list(items: Column, most: int = LIST) -> Column:
    """Values joined by ', ', empty ones left out, cut; null if nothing is left."""
    texts = F.filter(F.transform(items, lambda x: x.cast("string")), lambda x: x.isNotNull() & (x != ""))
    return F.nullif(F.left(F.array_join(texts, ", "), F.lit(most)), F.lit(""))


def gated(text: Column, least: int = LEAST, most: int | None = None) -> Column:
    """The text, cut to `most` characters, if it has at least `least`."""
    return once(text, lambda x: F.when(F.length(x) >= least, F.left(x, F.lit(most)) if most else x))


def wide_tickets(raw: DataFrame, copied=COPIED) -> DataFrame:
    """raw: tickets with numero_fe, titre_nc, detail_nc, resume, cause_nc, versioneffective, resp_traitement_nc and the
    fields of `copied`. Rows without a number go. HTML becomes text; a summary needs 50 characters, a cause 50 and is cut
    at 4000; effective versions are joined and cut at 200; a login is kept if it is a text. Empty texts become null."""
    text = lambda c: light_html(F.coalesce(F.col(c), F.lit("")))
    number = F.nullif(strip(F.col("numero_fe").cast("string")), F.lit(""))
    plain = [F.nullif(strip(F.col(s).cast("string")), F.lit("")).alias(n) if t == "string" else F.col(s).alias(n) if t == "keep" else F.col(s).try_cast(t).alias(n) for n, s, t in copied]
    login = F.col("resp_traitement_nc")
    return raw.select(
        number.alias("numero_fe"), text("titre_nc").alias("titre"), text("detail_nc").alias("detail"), gated(text("resume")).alias("resume_natif"), gated(text("cause_nc"), most=MOST).alias("cause_nc"),
        joined_list(F.col("versioneffective")).alias("version_effective"), F.when(~login.rlike("^[0-9]+$") & (login != ""), login).alias("resp_traitement_login"), *plain,
    ).filter("numero_fe is not null")


def _with_missing(raw: DataFrame, copied) -> DataFrame:
    """raw with nulls for copied fields that it lacks; of a structure with some of its fields the others are added."""
    nested: dict[str, list[str]] = {}
    for _, source, _ in copied:
        top, _, inner = source.partition(".")
        nested.setdefault(top, []).append(inner)
    for top, inner in nested.items():
        inner = [i for i in inner if i]
        if top not in raw.columns:
            empty = F.struct(*[F.lit(None).cast("string").alias(i) for i in inner]) if inner else F.lit(None).cast("string")
            raw = raw.withColumn(top, empty)
        elif inner:
            kind = raw.schema[top].dataType
            known = kind.names if isinstance(kind, StructType) else []
            for i in inner:
                if i not in known:
                    raw = raw.withColumn(top, F.col(top).withField(i, F.lit(None).cast("string")) if known else F.struct(F.lit(None).cast("string").alias(i)))
                    known = [*known, i]
    return raw


def ticket_records(raw: DataFrame, space: uuid.UUID = TICKETS) -> DataFrame:
    """The full record of every ticket: `wide_tickets` with all that is copied, an identifier made from the number, and
    the chunks of the raw HTML of detail and cause. Copied fields that raw lacks are null, as are those of a structure
    of another type. Tickets without a number go; repeated ones stay, with the same identifier."""
    copied = COPIED + MORE
    raw = _with_missing(raw.filter(F.trim(F.col("numero_fe").cast("string")) != ""), copied)
    held = html.chunk_lists(raw, {"detail_nc": "_detail_chunks", "cause_nc": "_cause_chunks"})
    t = wide_tickets(held, copied + tuple((f"_{n}", f"_{n}", "keep") for n in ("detail_chunks", "cause_chunks")))
    return t.withColumn("ticket_id", uuid5(space, F.col("numero_fe"))).withColumnsRenamed({"_detail_chunks": "detail_chunks", "_cause_chunks": "cause_chunks"})
