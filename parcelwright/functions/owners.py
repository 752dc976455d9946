"""Owner and party names."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .base import C, blank, col, first_rule, has, squeeze, strip_chars, text, tokens

# The words by which an owner's kind is told, in the order in which they are tried.
ESTATE = r"\b(ESTATE\s+OF|DECEASED|DECD)\b"
FAMILY_TRUST = (
    r"\b(REVOCABLE\s+LIVING\s+TRUST|LIVING\s+TRUST|FAMILY\s+TRUST|REVOCABLE\s+TRUST|TESTAMENTARY\s+TRUST|INTER\s+VIVOS\s+TRUST|MARITAL\s+TRUST"
    r"|BYPASS\s+TRUST|SURVIVOR'?S?\s+TRUST|REV\s+LVG\s+TRUST|REV\s+LVG\s+TRST|LVG\s+TRUST|LVG\s+TRST|FAM\s+TRUST|FAM\s+TRST|FAMILY\s+TRST"
    r"|LIVING\s+TRST|REV\s+TRUST|REV\s+TRST)\b"
)
GOVERNMENT = (
    r"\b(CITY\s+OF|COUNTY\s+OF|STATE\s+OF|UNITED\s+STATES|US\s+DEPT|U\.?S\.?\s+DEPARTMENT|FEDERAL\s+GOVERNMENT|DEPT\s+OF|DEPARTMENT\s+OF"
    r"|MUNICIPAL|[A-Z]+\s+COUNTY\b|TAX\s+TRUSTEE)\b"
)
SCHOOL = r"\b(ISD|SCHOOL\s+DISTRICT|COLLEGE|UNIVERSITY|ACADEMY)\b"
RELIGIOUS = (
    r"\b(CHURCH|MINISTRY|MINISTRIES|ASSEMBLY\s+OF\s+GOD|BAPTIST|METHODIST|CATHOLIC|DIOCESE|TEMPLE|SYNAGOGUE|MOSQUE"
    r"|PRESBYTERIAN|LUTHERAN|EPISCOPAL|PENTECOSTAL)\b"
)
HOA = r"\b(HOA|HOMEOWNERS\s+ASSOCIATION|PROPERTY\s+OWNERS\s+ASSOCIATION|CONDOMINIUM\s+ASSOCIATION|CONDO\s+ASSOC)\b"
NONPROFIT = (
    r"(\b(ASSOCIATION|FOUNDATION|INSTITUTE|SOCIETY|HABITAT|NONPROFIT|COMMUNITY\s+CENTER|YMCA|YWCA|GOODWILL|SALVATION\s+ARMY|TAX[\s-]?EXEMPT)\b"
    r"|501\s*\(\s*C\s*\)|\b501\s*C\s*3\b)"
)
COMPANY = (
    r"\b(LLC|L\.L\.C\.?|L\s+L\s+C|INC|INC\.|INCORPORATED|CORP|CORP\.|CORPORATION|LTD|LTD\.|LIMITED|LP|L\.P\.?|LLP|L\.L\.P\.?|PLLC|P\.L\.L\.C\.?"
    r"|ENTERPRISES?|HOLDINGS?|PROPERTIES|GROUP|COMPANY|&\s*CO\.?|CO\.|BANK|CREDIT\s+UNION|FEDERAL\s+SAVINGS|PARTNERSHIP|INVESTMENTS?|INVESTORS?"
    r"|REALTY|REALITY|RAILROAD|MAC\s+SLST|LODGE|TRAILER\s+PARK|MOBILE\s+HOME\s+PARK|COMMUNITY\s+IMPROVEMENT|\w{5,}INC\b"
    r"|\b(OIL|GAS|ENERGY|TRADING|SUPPLY|RANCH|CATTLE|TIMBER|DRILLING|MINING|LUMBER|LAND|REAL\s+ESTATE)\s+CO\b)\b"
)
ANY_TRUST = r"\bTRUST\b"
SURNAMES = ("BANK", "BANKS", "COMPANY", "BAPTIST", "CHURCH", "TEMPLE", "ACADEMY", "BISHOP", "LODGE")
GENERATION = r"\s+(JR|SR|II|III|IV|V|JR\.|SR\.)$"
KEPT_KINDS = ("individual", "estate", "family_trust")
KIND_LABELS = {
    "individual": "Individual", "estate": "Estate (deceased owner)", "family_trust": "Family/personal trust", "company": "Company (LLC/INC/CORP/etc.)",
    "trust_inst": "Institutional trust", "religious": "Religious organization", "school": "School / educational institution",
    "government": "Government body", "nonprofit": "Nonprofit organization", "hoa": "Homeowners association",
}

# Parties that file against owners.
INSTITUTIONAL = (
    r"\b(USA|UNITED\s*STATES(\s*OF\s*AMERICA)?|INTERNAL\s*REVENUE|IRS|U\.?S\.?\s*TREASURY|TREASURY|STATE\s*OF\s*\w+|COUNTY\s*OF|CITY\s*OF|DEPARTMENT\s*OF"
    r"|DISTRICT\s*COURT|MUNICIPAL\s*COURT|COMMISSIONERS?|MEDICAID|MEDICARE|HHS|ATTORNEY\s*GENERAL|FREDDIE\s*MAC|FANNIE\s*MAE|GINNIE\s*MAE|HUD"
    r"|HOUSING\s*AND\s*URBAN\s*DEVELOPMENT|BANK\s*(OF|N\.?\s*A\.?|NATIONAL)|\w+\s*BANK\s*(N\.?\s*A\.?|NA)?\s*$|CREDIT\s*UNION|FEDERAL\s*CREDIT\s*UNION|FCU\b"
    r"|MORTGAGE|FINANCIAL|FINANCE\s*(CORP|COMPANY|LLC)|TAX\s*LIEN\s*FUND"
    r"|(CREDIT|CAPITAL|RECEIVABLES?|RECOVERY|COLLECTION|FUNDING|FUND)\s*(MANAGEMENT|SERVICES?|GROUP|CORP|INC|LLC|LP|TRUST|SOLUTIONS)"
    r"|HOSPITAL|MEDICAL\s*CENTER|HEALTH\s*CARE\b|HOA\b|HOMEOWNERS\s*ASSOCIATION|\w+\s*CONDOMINIUM(\s*OWNERS?)?\s*(ASSOCIATION|ASSN)?"
    r"|COUNCIL\s*OF\s*(CO\s*[-]?\s*)?OWNERS|PROPERTY\s*OWNERS\s*ASSOCIATION|POA\b)\b"
)
ENTITY_OWNER = r"\b(LLC|INC|CORP|LP|LLP|LTD|TRUST|HOLDINGS?)\b"
ENTITY_NAME = r"\b(LLC|INC|CORP|LP|LLP|LTD|TRUST|COMPANY|CO|HOLDINGS?)\b"
AGENCY = (
    r"NUECES\s+(?:COUNTY|CTY|CO\b)|\b(?:COUNTY|CTY)\s+TRUSTEE|STRUCK\s*OFF|PORT\s+OF\s+CORPUS\s+CHRISTI|\bCOUNTY\s+OF\b|\bCITY\s+OF\b|STATE\s+OF\s+TEXAS"
    r"|HOUSING\s+AND\s+URBAN\s+DEVELOPMENT|SECRETARY\s+OF\s+HOUSING|\bHUD\b"
)


def personal_despite_keyword(name: C) -> Column:
    """Two words, less a generation mark at the end, one of which is a surname that also marks companies."""
    words = tokens(F.regexp_replace(F.upper(squeeze(name)), GENERATION, ""))
    return (F.size(words) == 2) & F.arrays_overlap(words, F.array(*map(F.lit, SURNAMES)))


def owner_kind(name: C) -> Column:
    """One of ten kinds, the first whose words are found; a blank name is an individual."""
    return first_rule(
        [
            (blank(name), "individual"),
            (has(name, ESTATE), "estate"),
            (has(name, FAMILY_TRUST), "family_trust"),
            (has(name, GOVERNMENT), "government"),
            (has(name, SCHOOL), "school"),
            (personal_despite_keyword(name), "individual"),
            (has(name, RELIGIOUS), "religious"),
            (has(name, HOA), "hoa"),
            (has(name, NONPROFIT), "nonprofit"),
            (has(name, COMPANY), "company"),
            (has(name, ANY_TRUST), "trust_inst"),
        ],
        "individual",
    )


def is_kept(kind: C) -> Column:
    return col(kind).isin(*KEPT_KINDS)


def kind_label(kind: C) -> Column:
    pairs = F.create_map(*[F.lit(x) for kv in KIND_LABELS.items() for x in kv])
    return F.coalesce(pairs[col(kind)], col(kind))


def institutional(name: C) -> Column:
    """Whether a party is an institution; a blank name is not."""
    return ~blank(name) & has(name, INSTITUTIONAL)


def not_worth_looking_up(name: C) -> Column:
    """As institutional, but a blank name counts."""
    return blank(name) | has(name, INSTITUTIONAL)


def agency(name: C) -> Column:
    return has(name, AGENCY)


def title_case(c: C) -> Column:
    """Each run of letters with its first in upper case, whatever stands before it (O'Neil, Smith-Jones)."""
    runs = F.regexp_extract_all(F.lower(col(c)), F.lit(r"(?U)([^\p{L}]+|\p{L}+)"), 1)
    return F.array_join(F.transform(runs, lambda r: F.concat(F.upper(F.substring(r, 1, 1)), F.substring(r, 2, 1_000_000))), "")


def split_name(owner: C) -> Column:
    """struct(first, last): entities are a last name, "Last, First" is read as such, else the last word is the first name."""
    o = squeeze(owner)
    words = tokens(o)
    rest = F.regexp_replace(o, r"^[^,]*,\s*", "")
    entity, comma = has(o, ENTITY_NAME), o.contains(",")
    first = F.when(blank(o) | entity, "").when(comma, title_case(F.coalesce(F.get(tokens(rest), F.lit(0)), F.lit("")))).when(F.size(words) == 1, "").otherwise(title_case(F.element_at(words, -1)))
    last = (
        F.when(blank(o), "")
        .when(entity, F.regexp_replace(text(owner), r"^\s+|\s+$", ""))
        .when(comma, title_case(F.trim(F.substring_index(o, ",", 1))))
        .when(F.size(words) == 1, title_case(o))
        .otherwise(title_case(F.array_join(F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))), " ")))
    )
    return F.struct(first.alias("first"), last.alias("last"))


def last_first(owner: C) -> Column:
    """"First Middle Last" to "Last First Middle", a generation mark left out; "Last, First" loses its comma."""
    o = F.regexp_replace(squeeze(owner), r"(?i)[,\s]+(JR|SR|II|III|IV|V)\.?$", "")
    words = tokens(o)
    return F.when(o.contains(","), squeeze(F.regexp_replace(o, ",", " "))).when(F.size(words) < 2, o).otherwise(F.concat_ws(" ", F.element_at(words, -1), F.array_join(F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))), " ")))


def plaintiff_and_owner(style: C) -> Column:
    """struct(plaintiff, owner) from "A vs B, et al"."""
    parts = F.split(squeeze(style), r"(?i)\bvs\b\.?", 2)
    owner = F.regexp_replace(F.coalesce(F.get(parts, F.lit(1)), F.lit("")), r"(?i),?\s*et\s*al\.?\s*$", "")
    return F.struct(strip_chars(F.get(parts, F.lit(0)), r" ,").alias("plaintiff"), F.regexp_replace(F.regexp_replace(owner, r"^[ .,-]+", ""), r"[ ,]+$", "").alias("owner"))


# --- name variants -------------------------------------------------------------------

# Marks, entity endings, joints and spouses' tails of names.
_MARKS = {"JR", "SR", "I", "II", "III", "IV", "V"}
_ENTITY_ENDS = (
    "LLC", "LLP", "LP", "INC", "LTD", "CO", "CORP", "TRUST", "ESTATES", "ASSOCIATION", "ASSOC", "COMPANY", "PARTNERSHIP", "BANK", "N A", "NA",
    "FUND", "HOLDINGS", "GROUP", "SERVICES", "SERVICING", "FINANCIAL", "FINANCE", "MORTGAGE", "PROPERTIES",
)
_JOINT = re.compile(r"\bAND (WIFE|HUSBAND|SPOUSE|WF)\b|\bHUSBAND AND WIFE\b|\b& (WIFE|HUSBAND|WF)\b")
_SPOUSE_TAIL = re.compile(r" (HUSBAND AND WIFE|HIS WIFE|HER HUSBAND|AN? (MARRIED|SINGLE|UNMARRIED) (MAN|WOMAN|PERSON))$")


class _Person:
    """A name in the order first, middle, last, mark."""

    def __init__(self, name: str) -> None:
        words = name.split()
        marked = len(words) >= 3 and words[-1] in _MARKS
        self.mark = words[-1] if marked else ""
        words = words[:-1] if marked else words
        self.last, self.given = (words[-1], words[:-1]) if words else ("", [])
        self.usable = len(self.last) >= 3 and bool(self.given)

    def last_first(self, given: list[str] | None = None, mark: bool = False) -> str:
        return " ".join([self.last, *(self.given if given is None else given), *([self.mark] if mark and self.mark else [])])


def name_variants_of(name: str | None, limit: int = 10) -> list[str]:
    """Names under which an owner may be listed, most likely first."""
    n = re.sub(r"\s+", " ", re.sub(r"[^A-Z0-9 &-]", " ", (name or "").upper())).strip()
    if not n:
        return []
    primary, _, second = n.partition(" AND ")
    primary, second = primary.strip(), second.strip()
    entity = any(f" {n} ".endswith(f" {e} ") or f" {e} " in f" {n} " for e in _ENTITY_ENDS)
    if entity:
        return list(dict.fromkeys(x for x in (n, primary) if x))[:limit]
    two = len(primary.split()) >= 2 and len(second.split()) >= 2 and not re.match("WIFE|HUSBAND|SPOUSE", second)
    joint = bool(_JOINT.search(n))
    one = _Person(primary)
    other = _Person(_SPOUSE_TAIL.sub("", second)) if two else None
    out = []
    if one.usable:
        out.append(one.last_first(mark=True))
    if other and other.usable:
        out.append(other.last_first(other.given[:1]))
    out += [n, primary]
    if one.usable:
        first = one.given[0]
        out += [one.last_first(mark=True), f"{first} {one.last}", one.last_first()]
        if len(one.given) > 1:
            out.append(" ".join([*one.given, one.last]))
        out.append(one.last_first([first]))
        if joint or two:
            out.append(f"{one.last} {first} AND WF")
            if len(one.given) > 1:
                out.append(f"{one.last_first()} AND WF")
            rest = re.sub(r" (HUSBAND AND WIFE|HIS WIFE|HER HUSBAND)$", "", re.sub(r"^(WIFE|HUSBAND|SPOUSE)\s*", "", second)).strip()
            if len(rest) > 3:
                out.append(f"{one.last} {first} AND WF {rest}")
    if other and other.usable:
        out += [other.last_first(other.given[:1]), f"{other.given[0]} {other.last}"]
        if len(other.given) > 1:
            out.append(other.last_first())
    if len(primary.split()) > 1 and len(one.last) >= 3:
        out.append(one.last)
    return list(dict.fromkeys(x for x in out if x))[:limit]


@F.pandas_udf(T.ArrayType(T.StringType()))
def name_variants(names: pd.Series) -> pd.Series:
    return names.map(name_variants_of)
