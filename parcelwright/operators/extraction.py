"""Foreclosure notices to fields: ordered patterns, of which the first with an acceptable match counts.

Everything is a column: a pattern is tried only where the words it needs stand and no earlier one of its
list gave an acceptable match. No Python runs on the texts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import notice_patterns as P
from ..functions.base import groups, has, let, squeeze, squeeze_page, strip_chars, text
from ..functions.dates import prose_date
from ..functions.notices import clean_name, clean_ocr_name, entity_core, looks_like_legal, looks_like_lender, without_descriptors
from .parcels import newest_modification

#: What a notice gives, named as parcels.apply_document takes it.
FIELDS = (
    "doc_number", "owner", "owner_raw", "lender", "loan_amount", "deed_date", "deed_date_original", "has_loan_mod", "loan_mod_doc", "loan_doc",
    "prop_address", "prop_city", "prop_state", "prop_zip", "legal_lot", "legal_block", "legal_subdivision", "legal_unit", "legal_tracts",
)


Needs = tuple[str | tuple[str, ...], ...]


def _holds(low: Column, *words: str | tuple[str, ...]) -> Column:
    """Whether a notice in lower case holds all the words, of several in brackets one at least: a search
    for them costs little beside a pattern's."""
    test = F.lit(True)
    for w in words:
        test = test & reduce(or_, [F.contains(low, F.lit(o)) for o in ((w,) if isinstance(w, str) else w)])
    return test


def _tried(value: Column, low: Column, pattern: str, needs: Needs, use: Callable[[Column], Column] = lambda m: m, group: int = 1) -> Column:
    """use(what a pattern's first match holds), null without a match; the pattern is tried only where its needs are met."""
    return F.when(_holds(low, *needs), let(F.regexp_extract(value, pattern, group), lambda m: F.when(m != "", use(m))))


def _first(value: Column, low: Column, patterns: Iterable[str], needs: Iterable[Needs], use: Callable[[Column], Column] = lambda m: m) -> Column:
    """The first of the patterns' matches, in their order, of which use makes something; null without one. Later patterns are not tried."""
    return F.coalesce(*[_tried(value, low, p, n, use) for p, n in zip(patterns, needs, strict=True)])


def _low(notice: Column, low: Column | None) -> Column:
    return F.lower(text(notice)) if low is None else low


def _borrowers(notice: Column, low: Column) -> list[Column]:
    """struct(said, entity) of each pattern's first match, null without one."""
    told = lambda entity: lambda m: F.struct(m.alias("said"), F.lit(entity).alias("entity"))
    return [_tried(notice, low, p, needs, told(entity)) for (p, entity), needs in zip(P.BORROWER, P.BORROWER_NEEDS, strict=True)]


def borrower(notice: Column, low: Column | None = None, first: Column | None = None) -> Column:
    """struct(owner, owner_raw): the raw name only where it differs. Persons that read like a lender
    or a legal description, and names under four characters, give way to the next pattern. first is the
    first of `_borrowers`, if the caller has it."""

    def judged(m: Column) -> Column:
        name = lambda raw: F.when(m["entity"], entity_core(raw)).otherwise(without_descriptors(raw))
        good = lambda n: (F.length(n) >= 4) & (m["entity"] | ~(looks_like_lender(n) | looks_like_legal(n)))
        both = lambda n, raw: F.struct(n.alias("owner"), F.when((raw != "") & (raw != n), raw).otherwise("").alias("owner_raw"))
        return let(clean_ocr_name(m["said"]), lambda raw: let(name(raw), lambda n: F.when(good(n), both(n, raw))))

    said = _borrowers(notice, _low(notice, low))
    # Mostly the first match is good; all of them are made only where it is not.
    every = F.get(F.filter(F.transform(F.filter(F.array(*said), lambda m: m.isNotNull()), judged), lambda n: n.isNotNull()), F.lit(0))
    none = F.struct(F.lit("").alias("owner"), F.lit("").alias("owner_raw"))
    return F.coalesce(let(F.coalesce(*said) if first is None else first, lambda m: F.when(m.isNotNull(), F.coalesce(judged(m), every))), none)


def lender(notice: Column, low: Column | None = None) -> Column:
    named = lambda m: let(clean_name(m), lambda n: F.when(F.length(n) >= 3, n))
    return text(_first(notice, _low(notice, low), P.LENDER, P.LENDER_NEEDS, named))


def loan_amount(notice: Column, low: Column | None = None) -> Column:
    """The first amount between the bounds, else null."""
    least, most = P.AMOUNT_BOUNDS
    amount = lambda m: let(F.replace(m, F.lit(","), F.lit("")).try_cast("double"), lambda a: F.when((a > least) & (a < most), a))
    return _first(notice, _low(notice, low), P.AMOUNT, P.AMOUNT_NEEDS, amount)


def _modification(flat: Column, low: Column, deed_date: Column, own_number: Column) -> Column:
    """struct(deed_date, original, document, modified)."""
    none = F.lit(None).cast("string")
    result = lambda deed, original, document, modified: F.struct(deed.alias("deed_date"), original.alias("original"), document.alias("document"), F.lit(modified).alias("modified"))

    def newest(deed: Column) -> Column:
        every = lambda patterns, group: F.flatten(F.array(*[F.regexp_extract_all(flat, F.lit(p), group) for p in patterns]))
        dates = F.filter(F.transform(F.transform(every(P.MODIFIED_DATE, 1), squeeze), prose_date), lambda d: F.regexp_like(d, F.lit(r"^\d{4}-\d{2}-\d{2}$")))
        numbers = F.flatten(F.transform(every(P.MODIFIED_PASSAGE, 0), lambda passage: F.regexp_extract_all(passage, F.lit(P.MODIFIED_NUMBER), 1)))
        new = let(F.struct(dates.alias("d"), numbers.alias("n"), own_number.alias("own")), lambda x: newest_modification(deed, x["d"], x["n"], x["own"]))
        return let(new, lambda n: result(n["deed_date"], n["original"], n["document"], True))

    def told(deed: Column) -> Column:
        return F.coalesce(F.when(_holds(low, *P.MODIFIED_NEEDS) & has(flat, P.MODIFIED), newest(deed)), result(deed, none, none, False))

    return let(text(deed_date), told)


def property_address(notice: Column, cities: tuple[str, ...] = P.CITIES, offices: tuple[str, ...] = P.OFFICES, low: Column | None = None) -> Column:
    """struct(street, city, zip) of the property, in upper case: by label, header or line if the city
    counts, else the first address anywhere of such a city that is no office; null without one."""
    place = lambda g: F.struct(strip_chars(F.upper(squeeze(g[0])), " ,.").alias("street"), F.trim(F.upper(g[1])).alias("city"), g[2].alias("zip"))
    here = lambda a: (a["street"] != "") & F.exists(F.array(*map(F.lit, cities)), lambda c: F.contains(a["city"], c))
    # The patterns look at nothing beside their match, so its parts are read from the match alone.
    parts = lambda match, p: let(groups(match, p, 3), place)
    low = _low(notice, low)
    told = lambda p, needs=(): _tried(notice, low, p, needs, lambda m: let(parts(m, p), lambda a: F.when(here(a), a)), 0)
    found = F.transform(F.regexp_extract_all(notice, F.lit(P.ANY_ADDRESS), 0), lambda m: parts(m, P.ANY_ADDRESS))
    others = F.filter(found, lambda a: here(a) & ~F.exists(F.array(*map(F.lit, offices)), lambda o: F.contains(a["street"], o)))
    short = F.create_map(*[F.lit(x) for kv in P.SHORT_CITIES.items() for x in kv])

    def named(a: Column) -> Column:
        city = F.translate(a["city"], "!?", "II")
        return F.when(a.isNotNull(), F.struct(a["street"].alias("street"), squeeze(F.coalesce(F.try_element_at(short, city), city)).alias("city"), a["zip"].alias("zip")))

    first = F.coalesce(told(P.LABELLED_ADDRESS, P.LABELLED_NEEDS), told(P.HEADER_ADDRESS), told(P.LINE_ADDRESS), F.get(others, F.lit(0)))
    return let(F.when(_holds(low, *P.ADDRESS_NEEDS), first), named)


def legal_of(notice: Column, low: Column | None = None) -> Column:
    """struct(lot, block, subdivision, unit, tracts), each "" where it isn't said."""
    # The patterns look at nothing beside their match, save for the start of a word: parts are read from the match.
    low, none = _low(notice, low), F.lit("")
    name = lambda s: F.trim(F.regexp_replace(strip_chars(squeeze(clean_name(s)), " .,"), r"\.\s+", " "))
    either = lambda a, b: F.when(a != "", a).otherwise(b)
    parts = lambda lot, block, sub, unit, tracts: F.struct(*[v.alias(n) for n, v in zip(("lot", "block", "subdivision", "unit", "tracts"), (strip_chars(lot, " ,."), strip_chars(block, " ,."), sub, F.trim(unit), tracts))])
    told = lambda p, needs, n, use: _tried(notice, low, p, needs, lambda m: let(groups(m, p, n), use), 0)
    tracts = lambda g: let(name(g[1]), lambda sub: parts(none, none, sub, none, F.when(sub != "", strip_chars(squeeze(g[0]), " .,")).otherwise("")))
    return F.coalesce(
        told(P.LEGAL_WORDS, P.LEGAL_WORDS_NEEDS, 7, lambda g: parts(either(g[0], g[1]), either(g[2], g[3]), name(g[4]), either(g[5], g[6]), none)),
        told(P.LEGAL_DIGITS, P.LEGAL_DIGITS_NEEDS, 3, lambda g: parts(g[0], g[1], name(g[2]), none, none)),
        told(P.LEGAL_TRACTS, P.LEGAL_TRACTS_NEEDS, 2, tracts), parts(none, none, none, none, none),
    )


def notice_fields(notices: DataFrame, value: str = "text", *, state: str = "TX") -> DataFrame:
    """notices with FIELDS read from their text. A blank or null text gives "" (null amount, no
    modification); the original date of a deed and the modification's number are null unless told.
    The patterns' time can grow with the square of the longest word: made for pages, not for blobs."""
    notices = notices.withColumn("__low", F.lower(text(value)))
    notice, low = text(value), F.col("__low")
    recorded = reduce(or_, [_holds(low, *needs) for needs in dict.fromkeys(P.LOAN_NUMBER_NEEDS)])
    own = F.when(_holds(low, *P.OWN_NUMBER_NEEDS), F.regexp_extract(notice, P.OWN_NUMBER, 1))
    # The text on one line, where anything is read from it.
    flat = F.when(recorded | _holds(low, *P.MODIFIED_NEEDS), squeeze_page(notice))
    deed = let(squeeze(_first(notice, low, P.DEED_DATE, P.DEED_DATE_NEEDS)), prose_date)
    read = notices.withColumns({"__own": text(own), "__flat": flat, "__deed": deed, "__said": F.coalesce(*_borrowers(notice, low))}).withColumns({
        "__b": borrower(notice, low, F.col("__said")), "__m": _modification(F.col("__flat"), low, F.col("__deed"), F.col("__own")), "__a": property_address(notice, low=low), "__l": legal_of(notice, low),
        "__n": text(_first(F.col("__flat"), low, P.LOAN_NUMBER, P.LOAN_NUMBER_NEEDS)),
    })
    found = F.col("__a").isNotNull()
    values = {
        "doc_number": F.col("__own"), "owner": F.col("__b.owner"), "owner_raw": F.col("__b.owner_raw"), "lender": lender(notice, low), "loan_amount": loan_amount(notice, low),
        "deed_date": F.col("__m.deed_date"), "deed_date_original": F.col("__m.original"), "has_loan_mod": F.col("__m.modified"), "loan_mod_doc": F.col("__m.document"), "loan_doc": F.col("__n"),
        "prop_address": text("__a.street"), "prop_city": text("__a.city"), "prop_state": F.when(found, state).otherwise(""), "prop_zip": text("__a.zip"),
        "legal_lot": F.col("__l.lot"), "legal_block": F.col("__l.block"), "legal_subdivision": F.col("__l.subdivision"), "legal_unit": F.col("__l.unit"), "legal_tracts": F.col("__l.tracts"),
    }
    return read.select(*[F.col(c) for c in notices.columns if c not in values and c != "__low"], *[values[c].alias(c) for c in FIELDS])
