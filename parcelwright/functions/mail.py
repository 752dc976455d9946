"""Mailing blocks of parcel pages: lines that may start with other owners' names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .addresses import peel_city
from .base import C, let, text

# How a street line begins, and the shapes of a line with city, state and zip.
STREET_LINE = r"^\s*\d"
BOX_LINE = r"(?i)^\s*P\.?\s*O\.?\s*BOX\b"
PLACE_LINE = r"^(.+?),\s*([A-Z]{2})\s+(\d{5}(?:-\d{4})?)\s*$"
ZIP_WORD = r"^\d{5}(?:-\d{4})?$"
STATE_ZIP = r"(?i),\s*([A-Z]{2})\s+(\d{5}(?:-\d{4})?)\s*$"
CITY_STATE_ZIP = r"^\s*(.+?)\s+([A-Z]{2})\s+(\d{5})(?:-\d{4})?\s*$"


def _lines(value: C) -> Column:
    return F.filter(F.transform(F.split(F.trim(text(value)), r"\n+"), lambda x: F.trim(x)), lambda x: x != "")


def _first(lines: Column, boxes: bool) -> Column:
    """The place of the street's line: the first that starts with a digit (or is a post box), else 0."""

    def starts(line: Column) -> Column:
        number = F.regexp_like(line, F.lit(STREET_LINE))
        return number | F.regexp_like(line, F.lit(BOX_LINE)) if boxes else number

    return F.coalesce(F.array_min(F.transform(lines, lambda x, i: F.when(starts(x), i))), F.lit(0))


def mail_block(value: C, *, boxes: bool = True, cities: tuple[str, ...] = (), state: str = "TX") -> Column:
    """struct(street, city, state, zip) of a mailing block of one to several lines.

    Lines before the street's are names and are left out. The line after it is "CITY, ST ZIP" or
    words of which the last are state and zip. A block of one line has commas between its
    parts; where only "ST ZIP" is set off, a city of `cities` is peeled off the street. A name
    before the number on the street's own line goes. An empty block gives empty parts and
    the default state where it has none; the zip has five digits.
    """
    none = F.lit("")
    two = lambda lines: let(_first(lines, boxes), lambda at: F.struct(F.coalesce(F.get(lines, at), none).alias("street"), F.coalesce(F.get(lines, at + 1), none).alias("following")))
    struct = lambda street, city, state, zip_code: F.struct(street.alias("street"), city.alias("city"), state.alias("state"), zip_code.alias("zip"))

    def below(x: Column) -> Column:
        """The street's line with what the line after it says."""
        following = x["following"]
        part = lambda n: F.regexp_extract(following, PLACE_LINE, n)

        def said(words: Column) -> Column:
            n = F.size(words)
            zipped = F.coalesce(F.regexp_like(F.try_element_at(words, F.lit(-1)), F.lit(ZIP_WORD)), F.lit(False))
            stated = zipped & F.coalesce(F.regexp_like(F.get(words, n - 2), F.lit(r"^[A-Z]{2}$")), F.lit(False))
            joined = lambda less: F.array_join(F.slice(words, 1, F.greatest(n - less, F.lit(0))), " ")
            last = F.try_element_at(words, F.lit(-1))
            return F.when(stated, struct(x["street"], joined(2), F.get(words, n - 2), last)).when(zipped, struct(x["street"], joined(1), none, last)).otherwise(struct(x["street"], following, none, none))

        whole = F.regexp_like(following, F.lit(PLACE_LINE))
        return F.when(whole, struct(x["street"], F.trim(part(1)), part(2), part(3))).otherwise(let(F.filter(F.split(following, r"\s+"), lambda w: w != ""), said))

    def one_line(x: Column) -> Column:
        """One line: "STREET CITY, ST ZIP" or "STREET, CITY, ST ZIP"."""
        street = x["street"]
        tail = (F.size(F.split(street, ",")) == 2) & F.regexp_like(street, F.lit(STATE_ZIP))
        head = struct(F.trim(F.regexp_replace(street, STATE_ZIP, "")), none, F.upper(F.regexp_extract(street, STATE_ZIP, 1)), F.regexp_extract(street, STATE_ZIP, 2))
        at = lambda parts, n: F.coalesce(F.get(parts, F.lit(n)), none)
        apart = lambda p: struct(at(p, 0), at(p, 1), F.regexp_extract(at(p, 2), r"^\s*([A-Z]{2})\s+\d{5}", 1), F.regexp_extract(at(p, 2), r"^\s*[A-Z]{2}\s+(\d{5})", 1))
        parts = F.filter(F.transform(F.split(street, ","), lambda p: F.trim(p)), lambda p: p != "")
        return F.when((x["city"] == "") & street.contains(","), F.when(tail, head).otherwise(let(parts, apart))).otherwise(x)

    def peeled(x: Column) -> Column:
        hit = lambda p: F.when(p["city"] != "", struct(p["street"], p["city"], x["state"], x["zip"])).otherwise(x)
        return F.when(x["city"] == "", let(peel_city(x["street"], cities), hit)).otherwise(x)

    def done(x: Column) -> Column:
        line = x["street"]
        box = F.regexp_like(line, F.lit(BOX_LINE)) if boxes else F.lit(False)
        line = let(F.regexp_extract(line, r"^\D.*?\s(\d.*)$", 1), lambda numbered: F.when(~box & (numbered != ""), numbered).otherwise(x["street"]))
        return struct(line, x["city"], F.when(x["state"] == "", state).otherwise(x["state"]), F.regexp_extract(x["zip"], r"^(\d{5})", 1))

    found = let(let(let(_lines(value), two), below), one_line)
    return let(let(found, peeled) if cities else found, done)


def mail_lines(value: C) -> Column:
    """struct(street, city, state, zip) of a mailing cell: names, street, "CITY, ST ZIP" on lines of
    their own, or all in one line with commas. What isn't understood stands as city (or street)."""
    return let(_lines(value), lambda lines: let(_first(lines, False), lambda at: _read_lines(lines, at)))


def _read_lines(lines: Column, at: Column) -> Column:
    get = lambda place, n: F.regexp_extract(place, CITY_STATE_ZIP, n)
    parts = F.transform(F.split(F.coalesce(F.get(lines, F.lit(0)), F.lit("")), ","), lambda x: F.trim(x))
    after = F.array_join(F.slice(lines, at + 2, F.greatest(F.size(lines) - at - 1, F.lit(0))), " ")
    first = F.coalesce(F.get(lines, F.when(F.size(lines) == 1, F.lit(0)).otherwise(at)), F.lit(""))

    def placed(x: Column) -> Column:
        one = (F.size(lines) == 1) & (F.size(x["parts"]) >= 3)
        place = F.when(one, F.array_join(F.slice(x["parts"], 2, F.greatest(F.size(x["parts"]) - 1, F.lit(0))), " ")).otherwise(x["after"])
        return F.struct(one.alias("one"), F.get(x["parts"], F.lit(0)).alias("part"), x["after"].alias("after"), F.trim(F.regexp_replace(place, r"\s*,\s*", " ")).alias("place"))

    def said(x: Column) -> Column:
        read = F.regexp_like(x["place"], F.lit(CITY_STATE_ZIP))
        unread = F.when(F.size(lines) > 1, x["after"]).otherwise("")
        struct = lambda street, city, state, zip_code: F.struct(street.alias("street"), city.alias("city"), state.alias("state"), zip_code.alias("zip"))
        return F.when(read, struct(F.when(x["one"], x["part"]).otherwise(first), F.trim(get(x["place"], 1)), get(x["place"], 2), get(x["place"], 3))).otherwise(struct(first, unread, F.lit(""), F.lit("")))

    return let(let(F.struct(parts.alias("parts"), after.alias("after")), placed), said)
