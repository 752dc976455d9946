"""Dates from the forms that sources use. Results are ISO texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .base import C, col, group, has, let, text

# The number of each month's name.
MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")
FORMATS = ("yyyy-MM-dd", "M/d/yyyy", "M/d/yy", "yyyyMMdd")


def coerce_date(value: C) -> Column:
    """A text in one of several forms as ISO date, else the first date-like part, else ""."""
    s = F.regexp_replace(F.trim(text(value)), r"\.\d+", "")
    day = F.regexp_replace(s, r"T\d{2}:\d{2}:\d{2}(Z|[+-]\d{2}:?\d{2})?$", "")
    shapes = {r"^\d{4}-\d{1,2}-\d{1,2}$": "yyyy-M-d", r"^\d{1,2}/\d{1,2}/\d{4}$": "M/d/yyyy", r"^\d{8}$": "yyyyMMdd"}
    tries = [F.when(F.regexp_like(day, F.lit(p)), F.try_to_date(day, f)) for p, f in shapes.items()]
    # A year of two digits: 69 to 99 are of the last century.
    yy = F.regexp_extract(day, r"^\d{1,2}/\d{1,2}/(\d{2})$", 1).try_cast("int")
    year = F.when(yy >= 69, yy + 1900).otherwise(yy + 2000)
    short = F.try_to_date(F.concat(F.regexp_replace(day, r"\d{2}$", ""), year.cast("string")), "M/d/yyyy")
    tries.append(F.when(F.regexp_like(day, F.lit(r"^\d{1,2}/\d{1,2}/\d{2}$")), short))
    parts = [F.regexp_extract(s, r"(\d{4})[-/](\d{1,2})[-/](\d{1,2})", n) for n in (1, 2, 3)]
    loose = F.when(parts[0] != "", F.concat_ws("-", parts[0], F.lpad(parts[1], 2, "0"), F.lpad(parts[2], 2, "0")))
    return F.coalesce(*[t.cast("string") for t in tries], loose, F.lit(""))


def date_of_epoch(value: C) -> Column:
    """Seconds since 1970, or milliseconds where the number is above 1e11, as ISO date in UTC."""
    v = col(value).cast("double")
    return F.date_format(F.timestamp_seconds(F.when(v > 1e11, v / 1000).otherwise(v)), "yyyy-MM-dd")


def prose_date(value: C) -> Column:
    """A date as written in notices, as ISO text; what is not understood comes back unchanged.

    Years from 1900 to 2100, months to 12, days to 31 (not checked against the month); years
    of two digits below 50 are of this century.
    """
    months = F.create_map(*[F.lit(x) for n, m in enumerate(MONTHS, 1) for k in {m, m[:3], "sept" if n == 9 else m} for x in (k, n)])

    def iso(d: Column) -> Column:
        year = let(d["y"], lambda y: F.when(y < 50, y + 2000).when(y < 100, y + 1900).otherwise(y))
        good = d["m"].between(1, 12) & d["d"].between(1, 31)
        two = lambda c: F.lpad(c.cast("string"), 2, "0")
        return let(year, lambda y: F.when(y.between(1900, 2100) & good, F.concat_ws("-", y.cast("string"), two(d["m"]), two(d["d"]))))

    def read(s: Column, pattern: str, y: int, m: int, d: int, name: bool) -> Column:
        # Parts are read only where the form is met: to cast an empty text costs an exception.
        month = F.try_element_at(months, F.lower(group(s, pattern, m))) if name else group(s, pattern, m).try_cast("int")
        parts = F.struct(group(s, pattern, y).try_cast("int").alias("y"), month.alias("m"), group(s, pattern, d).try_cast("int").alias("d"))
        return F.when(has(s, pattern), let(parts, iso))

    def first(s: Column) -> Column:
        return F.coalesce(
            read(s, r"^(\d{4})-(\d{2})-(\d{2})$", 1, 2, 3, False),
            read(s, r"^(\d{1,2})[/-](\d{1,2})[/-](\d{2,4})$", 3, 1, 2, False),
            read(s, r"^([A-Z]+)\.?\s+(\d{1,2})(?:st|nd|rd|th)?,?\s+(\d{4})$", 3, 1, 2, True),
            read(s, r"^(\d{1,2})(?:st|nd|rd|th)?\s+(?:day\s+)?of\s+([A-Z]+),?\s+(\d{4})$", 3, 2, 1, True),
            read(s, r"^(\d{1,2})\s+([A-Z]+)\s+(\d{4})$", 3, 2, 1, True),
        )

    return F.coalesce(let(F.regexp_replace(text(value), r"^\s+|\s+$", ""), first), col(value))


def case_year(case_number: C) -> Column:
    """The year in which a case was filed: four digits, or two and a hyphen, else 1990."""
    four = group(case_number, r"^(\d{4})").try_cast("int")
    two = group(case_number, r"^(\d{2})-").try_cast("int")
    return F.coalesce(four, F.when(two < 50, two + 2000).otherwise(two + 1900), F.lit(1990))


def serial_date(value: C) -> Column:
    """A spreadsheet's day number as ISO date."""
    return F.date_add(F.lit("1899-12-30").cast("date"), F.floor(col(value).cast("double")).cast("int")).cast("string")


def sale_status(sale_date: C, as_of: C) -> Column:
    """pre or post by comparison of ISO texts; a blank date is pre."""
    return F.when((text(sale_date) != "") & (text(sale_date) < text(as_of)), "post").otherwise("pre")
