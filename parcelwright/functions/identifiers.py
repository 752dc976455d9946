"""Addresses of pages, cache keys, flag columns and small record projections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import C, blank, first_filled, squeeze, text
from .money import money, number, to_hundreds

# The year of a parcel page without one, the prefix of an address's cache key, the
# days that stand for an unknown sale date, a lien's score, type and category, the sheet's number.
DEFAULT_YEAR, ADDRESS_PREFIX, UNKNOWN_DAYS = "2026", "ccln_addr::", 9999
LIEN_SCORE, LIEN_TYPE, LIEN_CATEGORY, LIEN_LABEL = 35, "LIEN", "CCLN", "City of Corpus Christi Lien"
COVER_NUMBER = r"(?i)Document\s+Number\s*:?\s*(\d{10})"

#: Rows that the search gives at most on a page.
PAGE_ROWS = 250


def parcel_url(base_url: str, prop_id: C, year: C, owner_id: C) -> Column:
    """The address of a parcel's page; the owner is left out where unknown."""
    owner = F.when(blank(owner_id), "").otherwise(F.concat(F.lit("&ownerId="), text(owner_id)))
    return F.concat(F.lit(f"{base_url}/Property/View/"), text(prop_id), F.lit("?year="), first_filled(year, F.lit(DEFAULT_YEAR)), owner)


def address_cache_key(normal_address: C) -> Column:
    return F.concat(F.lit(ADDRESS_PREFIX), text(normal_address))


def cover_sheet_number(page_two: C) -> Column:
    """The document number on a certificate's cover sheet, "" without one."""
    return F.regexp_extract(text(page_two), COVER_NUMBER, 1)


def names_city(name: C, city: str) -> Column:
    return F.contains(F.upper(text(name)), F.lit(city.upper()))


def suit_flags(*, suit: C, bad_address: C, deferral: C, agreement: C, bankruptcy: C) -> Column:
    """Flag columns as struct: L is a suit, J a judgment, any other letter neither."""
    letter = F.upper(F.trim(text(suit)))
    return F.struct(
        (letter == "L").alias("in_suit"), (letter == "J").alias("has_judgment"), (~blank(bad_address)).alias("bad_address"), (~blank(deferral)).alias("tax_deferral"),
        F.trim(text(agreement)).alias("payment_agreement"), (~blank(bankruptcy)).alias("bankruptcy"),
    )


def joined_description(*parts: C) -> Column:
    """The parts of a description that are not blank, joined by a space."""
    return F.array_join(F.filter(F.array(*[squeeze(p) for p in parts]), lambda p: p != ""), " ")


def market_value(*parts: C) -> Column:
    """The sum of value columns, what is no number being 0, to hundreds, halves to the even one."""
    total = F.lit(0.0)
    for p in parts:
        total = total + number(p)
    return to_hundreds(total)


def by_sale(status: str, days: str) -> list[Column]:
    """The order of sales: those to come before past ones, the nearest first."""
    return [(F.col(status) == "post").asc(), F.coalesce(F.col(days), F.lit(UNKNOWN_DAYS)).asc()]


def to_market_value(records: DataFrame) -> DataFrame:
    """records with appraised_value (text) moved to market_value (double) where that is null."""
    return records.withColumn("market_value", F.coalesce(F.col("market_value").cast("double"), money("appraised_value"))).drop("appraised_value")


def lien_of_document(documents: DataFrame, *, grantee: str, base_url: str, state: str = "TX") -> DataFrame:
    """Lien records for documents (doc_num, filed, owner, legal) that no filing is known of."""
    empty = [F.lit(state if c.endswith("state") else "").alias(c) for p in ("prop", "mail") for c in (f"{p}_address", f"{p}_city", f"{p}_state", f"{p}_zip")]
    return documents.select(
        text("doc_num").alias("doc_num"), F.lit(LIEN_TYPE).alias("doc_type"), text("filed").alias("filed"), F.lit(LIEN_CATEGORY).alias("cat"), F.lit(LIEN_LABEL).alias("cat_label"), text("owner").alias("owner"),
        F.lit(grantee).alias("grantee"), F.lit(None).cast("double").alias("amount"), text("legal").alias("legal"), *empty, F.concat(F.lit(f"{base_url}/results?department=RP&searchValue="), text("doc_num")).alias("clerk_url"),
        F.expr("cast(array() as array<string>)").alias("flags"), F.lit(LIEN_SCORE).alias("score"), F.lit(True).alias("synthesized"),
    )


def joined_with(records: DataFrame, documents: DataFrame, *, header: C, filename: C, page_two: C) -> DataFrame:
    """documents with the record they belong to: by the number in their header, else in their file's
    name, else on their second page, whichever is the first that names a record. Columns via
    (header, filename, page_two or null) and doc_num."""
    tried = documents.withColumn("__try", F.array(*[F.struct(text(c).alias("doc_num"), F.lit(n).alias("via"), F.lit(i).alias("rank")) for i, (n, c) in enumerate((("header", header), ("filename", filename), ("page_two", page_two)))]))
    known = records.select("doc_num").distinct()
    hit = tried.select("document", F.explode("__try").alias("t")).select("document", "t.*").join(known, "doc_num")
    best = hit.groupBy("document").agg(F.min(F.struct("rank", "doc_num", "via")).alias("b")).select("document", "b.doc_num", "b.via")
    return documents.join(best, "document", "left")


def search_url(base_url: str, start: C, end: C, *, query: C | None = None, doc_types: C | None = None, department: str = "RP") -> Column:
    """The address of a filing search between two ISO dates, by words and document types where given."""
    part = lambda name, c: F.lit("") if c is None else F.when(text(c) == "", "").otherwise(F.concat(F.lit(f"&{name}="), F.url_encode(text(c))))
    fixed = F.lit(f"{base_url}/results?department={department}&limit={PAGE_ROWS}&offset=0&keywordSearch=false&searchOcrText=false&searchType=quickSearch&recordedDateRange=")
    return F.concat(fixed, _between(start, end), part("searchValue", query), part("_docTypes", doc_types))


def foreclosure_url(base_url: str, start: C, end: C) -> Column:
    """The address of the foreclosure list recorded between two ISO dates."""
    return F.concat(F.lit(f"{base_url}/results?department=FC&instrumentDateRange="), _between(start, end), F.lit("&keywordSearch=false&searchOcrText=false&searchType=quickSearch"))


def _between(start: C, end: C) -> Column:
    return F.concat(F.replace(text(start), F.lit("-"), F.lit("")), F.lit("%2C"), F.replace(text(end), F.lit("-"), F.lit("")))
