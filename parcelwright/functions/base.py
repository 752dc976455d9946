"""Small Column helpers: blanks, first hits, ordered rules."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

C = Column | str


def col(c: C) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank(c: C) -> Column:
    """Null, empty or white space only."""
    return F.coalesce(F.regexp_like(col(c).cast("string"), F.lit(r"^\s*$")), F.lit(True))


def text(c: C) -> Column:
    """Never null."""
    return F.coalesce(col(c).cast("string"), F.lit(""))


def squeeze(c: C) -> Column:
    """White space at the ends off, runs of it to one space."""
    return F.regexp_replace(F.regexp_replace(text(c), r"\s+", " "), r"^ | $", "")


def squeeze_page(c: C) -> Column:
    """The same for long texts: what needs no change is not met one by one."""
    s = text(c)
    for space in "\t\n\x0b\f\r":
        s = F.replace(s, F.lit(space), F.lit(" "))
    runs = lambda v: F.when(F.contains(v, F.lit("  ")), F.regexp_replace(v, " {2,}", " ")).otherwise(v)
    # To a pattern the end is before a last mark of a line's end, too.
    ends = lambda v: reduce(or_, [F.startswith(v, F.lit(" "))] + [F.endswith(v, F.lit(e)) for e in (" ", "\x85", "\u2028", "\u2029")])
    return let(s, lambda v: let(runs(v), lambda w: F.when(ends(w), F.regexp_replace(w, "^ | $", "")).otherwise(w)))


def strip_chars(c: C, chars: str) -> Column:
    """Any of chars off both ends (chars as inside a regex class)."""
    return F.regexp_replace(col(c), rf"^[{chars}]+|[{chars}]+$", "")


def has(c: C, pattern: str) -> Column:
    """Whether the pattern is found, without regard to case; null never has it."""
    return F.coalesce(F.regexp_like(col(c), F.lit(f"(?i){pattern}")), F.lit(False))


def first_rule(rules: Sequence[tuple[Column, str | None]], otherwise: str | None = None) -> Column:
    """The value of the first rule that holds."""
    chain = F
    for test, value in rules:
        chain = chain.when(test, F.lit(value))
    return chain.otherwise(F.lit(otherwise))


def first_filled(*cs: C) -> Column:
    """The first that is not blank, else an empty string."""
    return F.coalesce(*[F.when(~blank(c), col(c)) for c in cs], F.lit(""))


def keep_or_fill(old: C, new: C) -> Column:
    """The old value unless it is blank."""
    return F.when(blank(old), col(new)).otherwise(col(old))


def let(value: C, use: Callable[[Column], Column]) -> Column:
    """use(value) with value worked out once, however often use names it; long expressions that are
    named often would otherwise be repeated in the plan each time."""
    return F.get(F.transform(F.array(col(value)), use), F.lit(0))


def tokens(c: C) -> Column:
    """Words between white space; an empty text has none."""
    return F.filter(F.split(squeeze(c), " "), lambda w: w != "")


def group(c: C, pattern: str, n: int = 1) -> Column:
    """Group n of the first match, without regard to case, "" where there is none."""
    return F.coalesce(F.regexp_extract(col(c), f"(?i){pattern}", n), F.lit(""))


def groups(match: C, pattern: str, n: int) -> Column:
    """The first n groups of a pattern in a text that is one match of it from end to end, "" for those that
    took no part; read at one go. The text holds no unit separator."""
    return F.split(F.regexp_replace(col(match), pattern, "\x1f".join(f"${i}" for i in range(1, n + 1))), "\x1f", -1)
