"""Parcels found for records: the choice among search rows, violations, delinquent rolls, documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import codes, owners
from ..functions.addresses import address_in_text, number_and_name, split_address
from ..functions.base import C, blank, col, first_filled, let, text
from ..functions.dates import coerce_date, prose_date
from ..functions.identifiers import joined_description, market_value, suit_flags
from ..functions.legal import clean_thin_legal, legals_match, parse_legal
from ..functions.money import account, digits, number
from ..functions.notices import looks_like_page_header
from .joins import majority
from .merge import overwrite_if_filled
from .ranking import best_per
from .records import fill_address
from .scoring import score_leads


def best_search_row(rows: DataFrame, *, city: str, state: str = "TX") -> DataFrame:
    """The row of a name's results that counts, with its address split; one row for an id or none.

    rows: id, pos, query_name, record_legal, record_address and a result's owner, situs, type and
    legal. Real property stands before personal, a numbered address before none, an equal name
    before one that begins or holds the query; then the order of the page. The top row must
    have an address. Where the record has a legal description, the first row in this order
    whose own corresponds to it is taken instead, or none.
    """
    name, asked = F.upper(text("owner")), F.trim(F.upper(text("query_name")))
    score = F.struct(
        F.when(F.col("type") == "R", 2).when(F.col("type") == "P", 1).otherwise(0),
        F.regexp_like(text("situs"), F.lit(r"\b\d+\b")).cast("int"),
        F.when(name == asked, 3).when(F.startswith(name, asked), 2).when(F.contains(name, asked), 1).otherwise(0),
    )
    order = [F.col("__score").desc(), F.col("pos")]
    at = Window.partitionBy("id").orderBy(*order)
    ours, theirs = number_and_name("record_address"), number_and_name("situs")
    confirmed = ~blank("legal") & legals_match(parse_legal("record_legal"), parse_legal("legal"), ours, theirs)
    ranked = rows.withColumn("__score", score).withColumn("__top", F.first("situs").over(at))
    picked = best_per(ranked.where(~blank("__top") & (blank("record_legal") | confirmed)), ["id"], *order).where(~blank("situs"))
    a = split_address("situs")
    out = picked.where(~blank(a["street"])).drop("__score", "__top")
    return out.select("*", a["street"].alias("site_address"), first_filled(a["city"], F.lit(city)).alias("site_city"), first_filled(a["state"], F.lit(state)).alias("site_state"), a["zip"].alias("site_zip"))


def violation_cases(violations: DataFrame, candidates: DataFrame, parcels: DataFrame) -> DataFrame:
    """Open violations (id, case_type) with the parcel they concern, and its owner and class.

    candidates: id, prop_id, cls, pos (see joins.two_tier). The candidates' most frequent class
    is the violation's; it must be one of homes or lots, and the first candidate of that class
    is the parcel. Case types that are never followed and owners that are no persons drop out.
    """
    kept = violations.where(~F.col("case_type").isin(*codes.DROPPED_CASES))
    voted = majority(candidates, "id", "cls", "pos").where(codes.violation_class_fits("cls"))
    first = best_per(candidates.join(voted, ["id", "cls"]), ["id"], F.col("pos")).select("id", "prop_id", "cls")
    out = kept.join(first, "id").join(parcels, "prop_id").where(owners.is_kept(owners.owner_kind("owner")))
    return out.withColumn("property_type", codes.class_label("cls"))


def delinquent_rows(rows: DataFrame, zips: tuple[str, ...]) -> DataFrame:
    """Rows of a delinquent roll to records; what is not followed is left out.

    Left out are other classes than homes and lots, rows without an account, other zips (a
    blank one stays), owners that are no persons (a blank one stays) and values from
    codes.MOST_VALUE up. Columns: state_code, account, appraisal_id, zip, owner, years, levy,
    back_levy, values (array), exemptions (array), descriptions (array), suit, bad_address,
    deferral, agreement, bankruptcy.
    """
    state_code, zip_code = F.upper(F.trim(text("state_code"))), F.trim(text("zip"))
    value = market_value(*[F.get("values", F.lit(i)) for i in range(6)])
    keep = state_code.isin(*codes.RESIDENTIAL) & (account("account") != "") & zip_code.isin("", *zips) & (blank("owner") | owners.is_kept(owners.owner_kind("owner"))) & (value < codes.MOST_VALUE)
    years = codes.delinquent_years("years")
    levy, back = number("levy"), number("back_levy")
    return rows.where(keep).select(
        account("account").alias("account"), digits("appraisal_id").alias("prop_id"), state_code.alias("state_code"), F.trim(text("owner")).alias("owner"), zip_code.alias("zip"),
        joined_description(*[F.get("descriptions", F.lit(i)) for i in range(3)]).alias("legal"), F.round(levy, 2).alias("levy_owed"), F.round(back, 2).alias("back_levy_owed"), F.round(levy + back, 2).alias("total_owed"),
        years.alias("years"), F.size(years).alias("years_behind"), F.array_min(years).alias("oldest_year"), value.alias("market_value"),
        codes.compact(*[F.get("exemptions", F.lit(i)) for i in range(6)]).alias("exemptions"),
        suit_flags(suit=F.col("suit"), bad_address=F.col("bad_address"), deferral=F.col("deferral"), agreement=F.col("agreement"), bankruptcy=F.col("bankruptcy")).alias("flags"),
    )


def foreclosures(rows: DataFrame, base_url: str, state: str = "TX") -> DataFrame:
    """Landed rows (doc_type, recorded, sale_date, doc_number, legal, clerk_url) to records; rows
    without a number are left out. An address is read from the legal description where it is one."""
    number_, url, legal = F.trim(text("doc_number")), F.trim(text("clerk_url")), F.trim(text("legal"))
    absolute = F.when(F.startswith(url, F.lit("http")), url).when(url != "", F.concat(F.lit(base_url), F.when(F.startswith(url, F.lit("/")), "").otherwise("/"), url))
    a = address_in_text(legal)
    return rows.where(number_ != "").select(
        number_.alias("doc_num"), F.when(F.col("doc_type").isNull() | (F.col("doc_type") == ""), "FORECLOSURE NOTICE").otherwise(F.trim("doc_type")).alias("doc_type"), coerce_date("recorded").alias("recorded"), coerce_date("sale_date").alias("sale_date"), legal.alias("legal"),
        F.coalesce(absolute, F.concat(F.lit(f"{base_url}/results?department=FC&searchValue="), F.url_encode(number_))).alias("clerk_url"),
        *[text(a[k]).alias(f"prop_{n}") for k, n in (("street", "address"), ("city", "city"))], first_filled(a["state"], F.lit(state)).alias("prop_state"), text(a["zip"]).alias("prop_zip"),
    )


def with_iso_deed_date(records: DataFrame) -> DataFrame:
    """records with deed_date as ISO text where it is understood, and date_status: empty, iso,
    converted or unparseable (which stays as it is)."""
    new = prose_date("deed_date")
    status = F.when(text("deed_date") == "", "empty").when(new != F.col("deed_date"), "converted").when(F.regexp_like("deed_date", F.lit(r"^.{4}-.{2}-.{2}$")), "iso").otherwise("unparseable")
    return records.withColumn("date_status", status).withColumn("deed_date", new)


def newest_modification(deed_date: C, dates: C, numbers: C, own_number: C) -> Column:
    """struct(deed_date, original, document): the latest date of modifications in place of the
    deed's, which is kept where it differs; the highest number (by length, then text) that is
    not the notice's own."""
    latest, deed = F.array_max(F.filter(col(dates), lambda d: d != "")), text(deed_date)
    highest = F.array_max(F.transform(F.filter(col(numbers), lambda n: n != text(own_number)), lambda n: F.struct(F.length(n).alias("size"), n.alias("n"))))["n"]
    return F.struct(F.coalesce(latest, deed).alias("deed_date"), F.when((deed != "") & (latest != deed), deed).alias("original"), highest.alias("document"))


def apply_document(records: DataFrame, fields: DataFrame, key: str, *, overwrite: bool = False, keep_address: bool = False, state: str = "TX") -> DataFrame:
    """records with what their document says, and changed.

    Blank fields are filled; with overwrite filled ones are replaced, and an address that the
    document lacks is emptied unless keep_address. What reads like a page header is no value.
    The four parts of an address go together. Facts of a modification always follow the
    document. A blank legal is put together from subdivision, lot, block and unit or from
    tracts. Both sides have owner, owner_raw, loan_amount, lender, deed_date, loan_doc,
    deed_date_original, loan_mod_doc, has_loan_mod, prop_address, prop_city, prop_state,
    prop_zip, legal_lot, legal_block, legal_subdivision; records have legal, fields legal_unit
    and legal_tracts.
    """
    said = lambda c: F.col(f"__{c}")
    both = records.join(fields.select(key, F.lit(True).alias("__read"), *[F.col(c).alias(f"__{c}") for c in fields.columns if c != key]), key, "left")
    read = F.coalesce(F.col("__read"), F.lit(False))
    value: dict[str, Column] = {}
    for c in ("owner", "owner_raw", "lender", "legal_lot", "legal_block", "legal_subdivision"):
        value[c] = F.when(~looks_like_page_header(said(c)) & (blank(c) | F.lit(overwrite)), said(c)).otherwise(F.col(c))
    for c in ("deed_date", "loan_doc"):
        value[c] = F.when(~blank(said(c)) & (blank(c) | F.lit(overwrite)), said(c)).otherwise(F.col(c))
    value["loan_amount"] = F.when((said("loan_amount") != 0) & ((F.coalesce("loan_amount", F.lit(0)) == 0) | F.lit(overwrite)), said("loan_amount")).otherwise(F.col("loan_amount"))
    for c in ("deed_date_original", "loan_mod_doc"):
        value[c] = F.nullif(text(said(c)), F.lit(""))
    value["has_loan_mod"] = F.coalesce(said("has_loan_mod"), F.lit(False))
    good = ~looks_like_page_header(said("prop_address"))
    whole = {"prop_address": said("prop_address"), "prop_city": text(said("prop_city")), "prop_state": first_filled(said("prop_state"), F.lit(state)), "prop_zip": text(said("prop_zip"))}
    moved = good & (blank("prop_address") | F.lit(overwrite)) & (text("prop_address") != text(said("prop_address")))
    gone = F.lit(overwrite and not keep_address) & ~good & ~blank("prop_address")
    for c, new in whole.items():
        value[c] = F.when(moved, new).when(gone, state if c == "prop_state" else "").otherwise(F.col(c))
    new = both.withColumns({f"__new_{c}": F.when(read, v).otherwise(F.col(c)) for c, v in value.items()})
    sub, lot, block = (F.trim(text(f"__new_legal_{c}")) for c in ("subdivision", "lot", "block"))
    unit, tracts = F.trim(text(said("legal_unit"))), F.trim(text(said("legal_tracts")))
    named = F.concat_ws(" ", sub, F.concat(F.lit("LOT "), lot), F.when(block != "", F.concat(F.lit("BLOCK "), block)), F.when(unit != "", F.concat(F.lit("UNIT "), unit)))
    made = F.when(sub == "", "").when(lot != "", named).when(tracts != "", F.concat(sub, F.lit(" ADDITION TRACTS "), tracts)).otherwise(sub)
    legal = let(made, lambda m: F.when(read & blank("legal") & ~looks_like_page_header(m), m).otherwise(F.col("legal")))
    new = new.withColumn("__new_legal", legal)
    differs = F.lit(False)
    for c in (*value, "legal"):
        differs = differs | ~F.col(f"__new_{c}").eqNullSafe(F.col(c))
    return new.select(*[F.col(f"__new_{c}").alias(c) if c in value or c == "legal" else F.col(c) for c in records.columns], differs.alias("changed"))


def write_back(cases: DataFrame, found: DataFrame, key: str, fields: tuple[str, ...], *, force: bool = False) -> DataFrame:
    """cases with blank fields filled (with force also others) from what was found, and touched.

    found: key, fields, found_prop_id, found_legal. A matched case takes the parcel's legal
    description; one that was looked up in vain loses the cause number of its own.
    """
    both = cases.join(found.select(key, F.lit(True).alias("__asked"), "found_prop_id", "found_legal", *[F.col(c).alias(f"__{c}") for c in fields]), key, "left")
    value = {c: F.when(~blank(f"__{c}") & (blank(c) | F.lit(force)), F.col(f"__{c}")).otherwise(F.col(c)) for c in fields}
    matched = ~blank("found_prop_id")
    value["legal_description"] = F.when(matched & ~blank("found_legal"), F.col("found_legal")).when(F.col("__asked") & ~matched, clean_thin_legal("legal_description")).otherwise(F.col("legal_description"))
    touched = F.lit(False)
    for c, v in value.items():
        touched = touched | (text(v) != text(c))
    return both.select(*[value[c].alias(c) if c in value else F.col(c) for c in cases.columns], touched.alias("touched"))


def backfill_liens(stored: DataFrame, scanned: DataFrame, *, key: str, city: str, as_of: str) -> DataFrame:
    """The lien store after a backfill: scanned records get addresses from their legal descriptions
    and scores, then new ones are added and stored ones take what is filled."""
    scored = score_leads(fill_address(scanned, city), as_of)
    return overwrite_if_filled(stored, scored.select(stored.columns), key)
