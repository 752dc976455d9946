"""Lien affidavits to fields. All columns: the owner's block is walked by a fold over its lines.

The fold carries the name, the lines since the name, and what the last line that reads as a place
said; when it meets a later place, the street grows by all that lies between.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import affidavit_patterns as P
from ..functions.base import C, squeeze, text, tokens
from ..functions.codes import reason_tags
from ..functions.notices import not_a_lien

#: What an affidavit gives.
FIELDS = (
    "doc_number", "filed", "lien_id", "account", "legal", "prop_address", "prop_city", "prop_state", "prop_zip", "owner", "spouse",
    "mail_address", "mail_city", "mail_state", "mail_zip", "work_date", "amount", "reasons", "flags",
)

_NONE = "array<string>"
_START = {"n": "int", "name": "string", "held": _NONE, "street": "string", "city": "string", "state": "string", "zip": "string"}


def _day(value: Column) -> Column:
    return F.coalesce(F.try_to_date(value, "M/d/yyyy").cast("string"), F.lit(""))


def account_of(document: C) -> Column:
    """An account number with its groups joined by hyphens, "" without one."""
    return F.regexp_replace(F.regexp_replace(F.regexp_extract(text(document), P.ACCOUNT, 1), r"\D", ""), r"^(\d{4})(\d{4})(\d{4})$", "$1-$2-$3")


def street_of(document: C) -> Column:
    """The property's street, on one line; "" where what follows the account is the next paragraph."""
    street = squeeze(F.regexp_extract(text(document), P.STREET, 1))
    prose = F.regexp_like(street, F.lit(P.NOT_A_STREET)) | (F.size(tokens(street)) > P.STREET_WORDS)
    return F.when(prose, "").otherwise(street)


def owner_lines(document: C) -> Column:
    """The lines of the owner's block that hold anything."""
    block = F.regexp_extract(text(document), P.OWNER_BLOCK, 1)
    return F.filter(F.transform(F.split(block, "\n"), lambda x: F.regexp_replace(x, r"^\s+|\s+$", "")), lambda x: x != "")


def name_goes_on(line: Column) -> Column:
    """Whether the line after a name is its second half: it ends like a company, or is short and begins
    like the rest of one; a house number never is."""
    short = F.size(tokens(line)) <= P.SHORT_LINE
    return ~F.regexp_like(line, F.lit(r"^\d")) & (F.regexp_like(line, F.lit(P.NAME_ENDS)) | (F.regexp_like(line, F.lit(P.NAME_GOES_ON)) & short))


def owner_block(lines: Column) -> Column:
    """struct(name, street, city, state, zip) of a block's lines.

    The name is the first line, or the first two; the last line after it that reads as a place
    gives city, state and zip, and all between is the street. A block without a street, or without a place,
    gives its first line after the name as street.
    """
    start = F.struct(*[F.lit(0).alias(k) if t == "int" else F.array().cast(t).alias(k) if t == _NONE else F.lit("").alias(k) for k, t in _START.items()])

    def step(seen: Column, line: Column) -> Column:
        first, second = seen["n"] == 0, (seen["n"] == 1) & name_goes_on(line)
        named = first | second
        place = ~named & F.regexp_like(line, F.lit(P.PLACE))
        part = lambda n: F.regexp_extract(line, P.PLACE, n)
        values = {
            "n": seen["n"] + 1, "name": F.when(first, line).when(second, F.concat_ws(" ", seen["name"], line)).otherwise(seen["name"]),
            "held": F.when(named, seen["held"]).otherwise(F.concat(seen["held"], F.array(line))), "street": F.when(place, F.array_join(seen["held"], " ")).otherwise(seen["street"]),
            "city": F.when(place, F.trim(part(1))).otherwise(seen["city"]), "state": F.when(place, part(2)).otherwise(seen["state"]), "zip": F.when(place, part(3)).otherwise(seen["zip"]),
        }
        return F.struct(*[v.alias(k) for k, v in values.items()])

    def done(seen: Column) -> Column:
        street = F.when(seen["street"] != "", seen["street"]).otherwise(F.coalesce(F.get(seen["held"], F.lit(0)), F.lit("")))
        return F.struct(seen["name"].alias("name"), street.alias("street"), *[seen[k].alias(k) for k in ("city", "state", "zip")])

    return F.aggregate(lines, start, step, done)


def affidavit_fields(documents: DataFrame, value: str = "text") -> DataFrame:
    """documents with FIELDS read from their text; a column of such a name is replaced.

    A blank or null text, or a field that isn't there, gives "" (null amount, empty arrays). A
    document that is filed as a lien and is none gives its number, its date and the flag that says
    what it is. The property's zip is the owner's where both live at one address. Repeated rows are read
    alike, an empty table gives an empty one.
    """
    document = text(value)
    read = documents.withColumns({"__flag": not_a_lien(document), "__lines": owner_lines(document), "__street": street_of(document)})
    read = read.withColumn("__o", owner_block(F.col("__lines")))
    find = lambda pattern, n=1: F.regexp_extract(document, pattern, n)
    street, owner = F.col("__street"), F.col("__o")
    here = F.upper(F.trim(street)) == F.upper(F.trim(owner["street"]))
    couple = F.regexp_like(owner["name"], F.lit(P.SPOUSE))
    half = lambda n: F.trim(F.regexp_extract(owner["name"], P.SPOUSE, n))
    values = {
        "lien_id": find(P.LIEN_ID), "account": account_of(document), "legal": F.trim(find(P.LEGAL)),
        "prop_address": street, "prop_city": F.when(street != "", P.CITY).otherwise(""), "prop_state": F.when(street != "", P.STATE).otherwise(""),
        "prop_zip": F.when((street != "") & here, owner["zip"]).otherwise(""), "owner": F.when(couple, half(1)).otherwise(owner["name"]), "spouse": F.when(couple, half(2)).otherwise(""),
        "mail_address": owner["street"], "mail_city": owner["city"], "mail_state": owner["state"], "mail_zip": owner["zip"], "work_date": _day(find(P.WORK)),
    }
    lien = F.col("__flag").isNull()
    values = {k: F.when(lien, v).otherwise("") for k, v in values.items()}
    values |= {
        "doc_number": find(P.HEADER), "filed": _day(find(P.HEADER, 2)), "amount": F.when(lien, F.replace(find(P.WORK, 2), F.lit(","), F.lit("")).try_cast("double")),
        "reasons": F.when(lien, reason_tags(find(P.REASON))).otherwise(F.array().cast(_NONE)), "flags": F.array_compact(F.array("__flag")),
    }
    return read.select(*[F.col(c) for c in documents.columns if c.lower() not in FIELDS], *[values[c].alias(c) for c in FIELDS])
