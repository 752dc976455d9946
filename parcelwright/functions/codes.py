"""Document types, state classes and packed lists."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .base import C, col, first_rule, has, text

# Document types by pattern, the first that is found counts.
DOCUMENT_TYPES = (
    (r"\bRELEASE\b.*\bLIS\s*PENDENS\b", "RELLP"), (r"\bLIS\s*PENDENS\b", "LP"), (r"\bTAX\s*DEED\b", "TAXDEED"), (r"\bMEDICAID\s*LIEN\b", "MEDLN"),
    (r"\bIRS\s*LIEN\b|\bFEDERAL\s*TAX\s*LIEN\b", "LNFED"), (r"\bHOSPITAL\s*LIEN\b", "HL"), (r"\bMECHANIC", "LNMECH"), (r"\bMODIFICATION\b", "MODIF"),
    (r"\bAPPOINTMENT\b", "APPNMT"), (r"\bLIEN\b", "LN"), (r"\bABSTRACT\s*OF\s*JUDG|\bJUDG", "JUD"), (r"\bPROBATE\b|\bLETTERS\s*TESTAMENTARY\b|\bHEIRSHIP\b", "PRO"),
    (r"\bNOTICE\s*OF\s*COMMENCEMENT\b", "NOC"),
)
# How specific a category is. CITYLN is a lien of the city.
SPECIFICITY = {"CITYLN": 100, "MFC": 90, "HL": 80, "LNMECH": 80, "MODIF": 70, "APPNMT": 70, "TAXDEED": 60, "LNFED": 60, "MEDLN": 60, "PRO": 60, "RELLP": 60, "NOC": 60, "LP": 50, "JUD": 50, "LN": 40}
#: Categories in which an institution files against the owner.
ADVERSARIAL = ("LNFED", "JUD", "MEDLN", "PRO", "LN", "CITYLN")
RESIDENTIAL = ("A1", "B1", "B2", "B3", "B4", "B5", "B6", "B7", "B8", "B9", "C1")
DROPPED_CASES = ("Zoning", "Signage", "Parking on Unimproved Surfaces", "Building Permit Required", "Short-Term Rental (STR)", "Illegal Dumping", "Emergency Measures")
OPEN_STATUSES = ("in progress", "new")
MOST_VALUE = 500_000


def category(doc_type: C) -> Column:
    return first_rule([(has(doc_type, p), c) for p, c in DOCUMENT_TYPES])


def specificity(cat: C) -> Column:
    pairs = F.create_map(*[F.lit(x) for kv in SPECIFICITY.items() for x in kv])
    return F.coalesce(F.try_element_at(pairs, col(cat)), F.lit(0))


def class_label(code: C) -> Column:
    """The three labels of the violation list; other codes stand for themselves."""
    c = text(code)
    return F.when(c == "A1", "Single-family").when(F.regexp_like(c, F.lit(r"^B[1-9][0-9]?$")), "Multifamily").when(c.startswith("C1"), "Vacant lot").when(c == "", "Unknown").otherwise(c)


# Labels of the lien list by code, exact ones before prefixes.
CLASS_LABELS = (
    (r"^A1$", "Single-family"), (r"^A2$", "Mobile home"), (r"^A[34]$", "Condo"), (r"^A", "Residential"), (r"^B[0-9]", "Multifamily"), (r"^C", "Vacant lot"),
    (r"^D", "Rural / acreage"), (r"^E", "Farm / ranch"), (r"^F2$", "Industrial"), (r"^F", "Commercial"), (r"^G", "Mineral"), (r"^J", "Utility"), (r"^L", "Business personal"),
)


def class_label_long(code: C) -> Column:
    c = F.upper(F.trim(text(code)))
    return F.coalesce(first_rule([(F.regexp_like(c, F.lit(p)), v) for p, v in CLASS_LABELS]), c)


def violation_class_fits(code: C) -> Column:
    """A1, C1 and what starts so, B2 to B9."""
    return F.regexp_like(text(code), F.lit(r"^(A1$|C1|B[2-9]$)"))


def delinquent_years(raw: C) -> Column:
    """Years of a comma list, each once, the latest first; 0 alone stands for none."""
    s = F.trim(text(raw))
    found = F.transform(F.split(s, ","), lambda p: F.regexp_replace(p, r"\D", "").try_cast("int"))
    years = F.sort_array(F.array_distinct(F.filter(found, lambda y: y.isNotNull())), asc=False)
    return F.when(s.isin("", "0", "0.0"), F.expr("cast(array() as array<int>)")).otherwise(years)


def compact(*cs: C) -> Column:
    """The values that are not blank, white space squeezed."""
    return F.filter(F.array(*[F.trim(F.regexp_replace(text(c), r"\s+", " ")) for c in cs]), lambda x: x != "")


def expand_types(summary: C) -> Column:
    """"T ×2 · U" to [T, T, U]."""
    parts = F.filter(F.transform(F.split(text(summary), " · "), lambda p: F.trim(p)), lambda p: p != "")
    count = lambda p: F.coalesce(F.regexp_extract(p, r" ×(\d+)$", 1).try_cast("int"), F.lit(1))
    return F.flatten(F.transform(parts, lambda p: F.array_repeat(F.regexp_replace(p, r" ×\d+$", ""), count(p))))


def narrative_pairs(text_: C) -> Column:
    """"[T1] n1  •  [T2] n2" to a map; the first of a type counts."""
    parts = F.filter(F.split(text(text_), "  •  "), lambda p: F.regexp_like(p, F.lit(r"(?s)^\[.*?\]")))
    key = lambda p: F.regexp_extract(p, r"(?s)^\[(.*?)\]", 1)
    keys = F.transform(parts, key)
    kept = F.filter(parts, lambda p, i: F.array_position(keys, key(p)) == i + 1)
    return F.map_from_entries(F.transform(kept, lambda p: F.struct(key(p), F.trim(F.regexp_replace(p, r"(?s)^\[.*?\]\s*", "")))))


# Words of a lien's reason and the tag of each, in order.
REASONS = (
    ("substandard buildings", "substandard_building"), ("filth, carrion", "carrion"), ("filth", "filth"), ("weeds, rubbish", "weeds"),
    ("weeds", "weeds"), ("rubbish", "rubbish"), ("brush", "brush"), ("demolishing", "demolition"),
)


def reason_tags(reason: C) -> Column:
    """The tags of the words found, each once, in the table's order."""
    low = F.lower(text(reason))
    return F.array_distinct(F.array_compact(F.array(*[F.when(low.contains(w), t) for w, t in REASONS])))


def header(name: C) -> Column:
    return F.lower(F.trim(F.regexp_replace(text(name), r"\s+", " ")))
