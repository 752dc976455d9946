"""Money, numbers and identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .base import C, col, text

_NUMBER = r"([0-9]{1,3}(?:,[0-9]{3})+(?:\.\d{1,2})?|[0-9]+(?:\.\d{1,2})?)"
# Words that mark an amount of money.
_CUES = r"(?:amount|amt|due|consideration|principal|balance|debt|paid|owed|sum|total|judgment\s*for)"
AMOUNT_PATTERNS = (rf"\$\s*{_NUMBER}", r"\b([0-9]{1,3}(?:,[0-9]{3})+\.[0-9]{2})\b", rf"(?i){_CUES}\s*[:.]?\s*\$?\s*{_NUMBER}")
LEAST_AMOUNT, MOST_AMOUNT = 1.0, 1_000_000_000.0


def amount_in(value: C) -> Column:
    """The largest number in a text that has a mark of money; null below 1 and above 1e9."""
    found = F.concat(*[F.regexp_extract_all(text(value), F.lit(p), F.lit(1)) for p in AMOUNT_PATTERNS])
    best = F.array_max(F.transform(found, lambda x: F.replace(x, F.lit(","), F.lit("")).try_cast("double")))
    return F.when(best.between(LEAST_AMOUNT, MOST_AMOUNT), best)


def money(value: C) -> Column:
    """The first number of a text as double, thousands separators and signs left out."""
    return F.replace(F.regexp_extract(text(value), r"([0-9][0-9,]*(?:\.[0-9]+)?)", 1), F.lit(","), F.lit("")).try_cast("double")


def strict_money(value: C) -> Column:
    """A text of a number only, once all but digits, point and minus are gone."""
    return F.regexp_replace(text(value), r"[^0-9.\-]", "").try_cast("double")


def whole_money(value: C) -> Column:
    return F.trim(text(value)).try_cast("bigint")


def number(value: C) -> Column:
    """As double, 0 where it is not a number."""
    return F.coalesce(F.regexp_replace(text(value), r"[,$]", "").try_cast("double"), F.lit(0.0))


def to_hundreds(total: C) -> Column:
    """Rounded to hundreds, halves to the even one."""
    return (F.bround(col(total) / 100).cast("bigint") * 100).cast("bigint")


def digits(value: C) -> Column:
    return F.regexp_replace(text(value), r"\D", "")


def account(value: C) -> Column:
    """An account number as NNNN-NNNN-NNNN: its digits padded on the left, the last twelve of longer ones."""
    d = digits(value)
    padded = F.when(F.length(d) <= 12, F.lpad(d, 12, "0")).otherwise(F.substring(d, -12, 12))
    return F.when(d == "", "").otherwise(F.concat_ws("-", F.substring(padded, 1, 4), F.substring(padded, 5, 4), F.substring(padded, 9, 4)))


def cell(value: C) -> Column:
    """A number as text, without a fraction where it is whole."""
    v = col(value).cast("double")
    return F.when(v == F.floor(v), F.floor(v).cast("string")).otherwise(v.cast("string"))


def case_key(value: C) -> Column:
    return F.regexp_replace(F.lower(text(value)), r"[^a-z0-9]", "")


def document_number(name: C) -> Column:
    """Ten digits at the start of a file name."""
    return F.regexp_extract(text(name), r"(?:^|/)(\d{10})(?:\D|$)", 1)


def account_on_page(labelled: C, pairs: C, page: C) -> Column:
    """An account number NNNN-NNNN-NNNN: from its labelled value, else the first of the page's
    label and value pairs (a map) that holds one, else the page's if it holds exactly one."""
    shape = r"\b(\d{4}-\d{4}-\d{4})\b"
    one = F.regexp_extract(text(labelled), shape, 1)
    values = F.filter(F.transform(F.map_values(col(pairs)), lambda v: F.regexp_extract(text(v), shape, 1)), lambda v: v != "")
    every = F.array_distinct(F.regexp_extract_all(text(page), F.lit(shape), F.lit(1)))
    return F.coalesce(F.nullif(one, F.lit("")), F.get(values, F.lit(0)), F.when(F.size(every) == 1, F.get(every, F.lit(0))), F.lit(""))


def newest_number(numbers: C) -> Column:
    """The longest of the numbers, among equally long ones the greatest."""
    return F.array_max(F.transform(col(numbers), lambda n: F.struct(F.length(n).alias("l"), n.alias("n"))))["n"]
