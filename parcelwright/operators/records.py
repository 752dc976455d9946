"""Landed rows to records: filings, tax sales, geocoder queries, deeds of a suit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import codes, owners
from ..functions.addresses import address_in_text
from ..functions.base import blank, first_filled, has, text
from ..functions.dates import coerce_date
from ..functions.money import amount_in, case_key
from .ranking import best_per

# The names under which a filing's fields may come, in the order in which they count.
FILING_NAMES = {
    "doc_num": ("docnumber", "doc_number", "documentnumber", "instrumentnumber", "doc_num", "documentid", "id", "instrument number", "doc#", "doc #"),
    "doc_type": ("doctype", "doc_type", "documenttype", "type", "document type"),
    "filed": ("recordeddate", "recorded_date", "fileddate", "filedate", "filed", "recorded date", "recorded"),
    "grantor": ("grantor", "grantorname", "grantor_name", "grantor 1", "grantor1", "grantors", "grantor_list"),
    "grantee": ("grantee", "granteename", "grantee_name", "grantee 1", "grantee1", "grantees", "grantee_list"),
    "legal": ("legaldescription", "legal_description", "legal", "description"),
    "lot": ("lot",),
    "block": ("block",),
    "amount": ("considerationamount", "amount", "amount_due", "totalamount", "total", "consideration"),
    "url": ("clerk_url", "url", "documenturl"),
    "doc_id": ("documentid", "id", "docid"),
}
# The labels of categories.
LABELS = {
    "LP": "Lis Pendens", "JUD": "Judgment", "LN": "Lien", "HL": "Hospital Lien", "LNMECH": "Mechanics Lien", "MODIF": "Loan Modification",
    "APPNMT": "Appointment of Sub Trust", "CITYLN": "City Lien", "TAXDEED": "Tax Deed", "LNFED": "Federal / IRS / Corp Tax Lien", "MEDLN": "Medicaid Lien",
    "PRO": "Probate", "NOC": "Notice of Commencement", "RELLP": "Release of Lis Pendens", "MFC": "Mortgage Foreclosure",
}


def first_named(fields: Column | str, *names: str) -> Column:
    """The first filled value of a map under any of the names (lower case), else ""."""
    m = F.transform_keys(F.col(fields) if isinstance(fields, str) else fields, lambda k, _: F.lower(k))
    return first_filled(*[F.try_element_at(m, F.lit(n)) for n in names])


def filings(rows: DataFrame, base_url: str, default: str = "LN", fields: str = "fields") -> DataFrame:
    """Rows with a map of fields, of whatever names, to filings.

    A row without a document number is left out. Lot and block follow the legal description;
    the party that files stands second where an institution files against an owner, or for a
    mechanic's lien of the general kind; the amount comes from its field, else from the legal
    description, else from the document type. Keys of a map must differ beyond their case.
    """
    raw = rows.select(*[c for c in rows.columns if c != fields], *[F.trim(first_named(fields, *names)).alias(f"_{n}") for n, names in FILING_NAMES.items()]).where("_doc_num <> ''")
    lots = F.concat_ws(", ", F.when(F.col("_lot") != "", F.concat(F.lit("Lot "), "_lot")), F.when(F.col("_block") != "", F.concat(F.lit("Block "), "_block")))
    told = F.regexp_replace("_legal", r"(?i)^\s*Subdivision\s*-\s*Name:\s*", "")
    legal = F.when(lots == "", told).when(told == "", lots).otherwise(F.concat(told, F.lit(" ("), lots, F.lit(")")))
    raw = raw.withColumn("legal", legal).withColumn("cat", F.coalesce(codes.category("_doc_type"), F.lit(default)))
    against = F.col("cat").isin(*codes.ADVERSARIAL) & owners.institutional("_grantor")
    swap = (F.col("_grantee") != "") & (against != ((F.col("cat") == "LN") & has("_doc_type", "MECH")))  # twice is not at all
    pairs = F.create_map(*[F.lit(x) for kv in LABELS.items() for x in kv])
    label = F.coalesce(F.try_element_at(pairs, F.col("cat")), F.lit(default))
    relative = F.concat(F.lit(base_url), F.when(F.startswith("_url", F.lit("/")), "").otherwise("/"), F.col("_url"))
    url = F.when(F.startswith("_url", F.lit("http")), F.col("_url")).when(F.col("_url") != "", relative).when(F.col("_doc_id") != "", F.concat(F.lit(f"{base_url}/doc/"), "_doc_id")).otherwise(F.concat(F.lit(f"{base_url}/results?department=RP&searchValue="), F.url_encode("_doc_num")))
    return raw.select(
        F.col("_doc_num").alias("doc_num"), F.when(F.col("_doc_type") == "", label).otherwise(F.col("_doc_type")).alias("doc_type"), coerce_date("_filed").alias("filed"), "cat", label.alias("cat_label"),
        F.when(swap, F.col("_grantee")).otherwise(F.col("_grantor")).alias("owner"), F.when(swap, F.col("_grantor")).otherwise(F.col("_grantee")).alias("grantee"),
        F.coalesce(F.when(F.col("_amount").try_cast("double") > 0, F.col("_amount").try_cast("double")), amount_in("_amount"), amount_in("legal"), amount_in("_doc_type")).alias("amount"), "legal", url.alias("url"),
        *[c for c in rows.columns if c != fields],
    )


def tax_sales(raw: DataFrame, source: str = "landed") -> DataFrame:
    """Rows of a sale list (geometry: struct with coordinates, longitude first) to records; rows
    without uid are left out. sale_date_only counts only where there is a sale_date."""
    t = lambda c: F.trim(text(c))
    street = F.array_join(F.filter(F.array(t("prop_address_one"), t("prop_address_two")), lambda x: x != ""), " ")
    place = F.array_join(F.filter(F.array(t("prop_city"), t("prop_state"), t("prop_zipcode")), lambda x: x != ""), " ")
    day = F.when(text("sale_date") == "", "").otherwise(first_filled("sale_date_only", F.substring_index(text("sale_date"), "T", 1)))
    at = F.col("geometry.coordinates")
    return raw.where(~blank("uid")).select(
        F.col("uid").cast("string").alias("uid"), text("sale_id").alias("sale_id"), *[t(c).alias(c) for c in ("cause_nbr", "account_nbr")], text("sale_date").alias("sale_date"), day.alias("sale_date_only"),
        "sale_nbr", *[t(c).alias(c) for c in ("sale_type", "status", "precinct")], F.array_join(F.filter(F.array(street, place), lambda x: x != ""), ", ").alias("prop_address"), street.alias("prop_address_street"),
        *[t(c).alias(c) for c in ("prop_city", "prop_state", "prop_zipcode")], F.get(at, F.lit(1)).alias("lat"), F.when(F.size(at) > 1, F.get(at, F.lit(0))).alias("lon"),
        F.col("value").try_cast("double").alias("adjudged_value"), F.col("minimum_bid").try_cast("double").alias("minimum_bid"), F.coalesce(F.col("has_photo").cast("boolean"), F.lit(False)).alias("has_photo"),
        (F.upper(text("google_view")) == "Y").alias("google_view_available"), *[t(c).alias(c) for c in ("sale_notes", "property_loc", "county_sale_list")], F.lit(source).alias("_source"),
    )


def fill_address(leads: DataFrame, city: str, state: str = "TX") -> DataFrame:
    """Leads whose blank property address is read from their legal description."""
    found = leads.withColumn("__a", address_in_text("legal"))
    hit = blank("prop_address") & F.col("__a.street").isNotNull()
    values = {"prop_address": F.col("__a.street"), "prop_city": first_filled("__a.city", F.lit(city)), "prop_state": first_filled("__a.state", F.lit(state)), "prop_zip": F.col("__a.zip")}
    return found.select(*[F.when(hit, values[c]).otherwise(F.col(c)).alias(c) if c in values else F.col(c) for c in leads.columns])


def geocoder_query(leads: DataFrame, state: str = "TX") -> DataFrame:
    """uid, street, city, state and five-digit zip of the leads that have a street."""
    zip5 = F.trim(F.substring_index(F.trim(text("prop_zip")), "-", 1))
    return leads.where(~blank("prop_address")).select("uid", F.trim("prop_address").alias("street"), F.trim(text("prop_city")).alias("city"), first_filled("prop_state", F.lit(state)).alias("state"), zip5.alias("zip"))


def deed_of_suit(suits: DataFrame, deeds: DataFrame) -> DataFrame:
    """For each suit (case_number, case_year, owner) its likeliest deed (doc_num, doc_type,
    recorded, grantor, legal, owner): a sheriff's counts 3, one that cites the case 4; among
    equals the latest year, then the first number. Deeds of before the suit don't count."""
    both = suits.join(deeds.where(has("doc_type", "DEED")), "owner")
    year = F.coalesce(F.regexp_extract("recorded", r"(\d{4})", 1).try_cast("int"), F.lit(0))
    cites = (case_key("case_number") != "") & F.contains(case_key("legal"), case_key("case_number"))
    score = F.lit(1) + F.when(has("grantor", "SHERIFF"), 3).otherwise(0) + F.when(cites, 4).otherwise(0)
    both = both.withColumn("score", score).withColumn("year", year).where((F.col("year") == 0) | (F.col("year") >= F.col("case_year")))
    return best_per(both, ["case_number"], F.desc("score"), F.desc("year"), F.asc("doc_num"))
