"""Names in notices, and checks of what was read from lien documents."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .base import C, blank, col, group, has, let, squeeze, strip_chars, text

# What may follow a borrower's name, what marks lenders, legal texts and page headers.
MARITAL = r"(?i)[,\s]+(?:UNMARRIED|MARRIED|SINGLE|WIDOWED|WIDOW|DIVORCED)(?:\s+as\s+(?:trustor|grantor|borrower|mortgagor))?\.?\s*$"
DESCRIPTOR = (
    r"(?i)[,\s]+(?:an?\s+(?:unmarried|single|married)\s+(?:man|woman|person)|unmarried\s+(?:man|woman|person)|husband\s+and\s+wife|wife\s+and\s+husband"
    r"|his\s+wife|her\s+husband|a\s+married\s+couple|as\s+community\s+property|as\s+(?:tenants|joint\s+tenants))\s*$"
)
ROLE = r"(?i)[,\s]+(?:as\s+(?:mortgagor|grantor|trustor|borrower)|WIFE|HUSBAND)\s*$"
# What ends a name that one of the three takes something off.
DESCRIPTORS = r"(?i)(?=[mswdphctgb])(?:married|single|widow(?:ed)?|divorced|man|woman|person|wife|husband|couple|property|tenants|mortgagor|grantor|trustor|borrower)\.?\s*$"
JOINED = r"^(.+?)\s*,?\s*(?:an?\s+(?:married|single|unmarried)\s+(?:man|woman|person)\s+)?joined\s+(?:herein|pro[\s-]+forma)\s+by\s+(.+?)$"
LENDER = (
    r"\b(?=[bnfmctsawli])(\bBANK\b|\bN\.?A\.?\b|\bFEDERAL\b|\bMORTGAGE\b|\bFINANCIAL\b|\bCAPITAL\b|\bTRUST\s+COMPANY\b|\bSAVINGS\b|\bASSOCIATION\b|\bFANNIE\s+MAE\b"
    r"|\bFREDDIE\s+MAC\b|\bWELLS\s+FARGO\b|\bCHASE\b|\bCITIBANK\b|\bLLC\b|\bCORP(?:ORATION)?\b|\bCOMPANY\b|\bINC\.?\b)"
)
LEGAL_TEXT = (
    r"\b(?=[sbltcamrvp])(\bSUBDIVISION\b|\bBLOCK\s+[A-Z0-9]\b|\bLOT\s+\d|\bTHE\s+SAID\b|\bCORNER\s+OF\b|\bACRES?\b|\bSQUARE\s+FEET\b|\bMETES\b|\bR\.?O\.?W\.?\b|\bMAP\s+RECORDS\b|\bVOLUME\s+\d|\bPLAT\b)"
)
PAGE_WORDS = ("PAGE ", " OF ", "CLERK OF", "COUNTY COURT", "COUNTY OF", "RECORDED", "RECEIVED", "UNOFFICIAL", "AM ", "PM ")
ENTITY_CORE = r"(?is)^(.*?\b(?:L\.?L\.?C\.?|L\.?P\.?|INC\.?|CORP\.?|LTD\.?|LIMITED\s+LIABILITY\s+COMPANY|LIMITED\s+PARTNERSHIP))\s*,?\s*(?:a\b.*)?$"


def clean_name(name: C) -> Column:
    """A name on one line: hyphens at line ends joined, marks and conjunctions at the end off."""
    s = F.when(F.contains(text(name), F.lit("\n")), F.regexp_replace(text(name), r"-\s*\n\s*", "-")).otherwise(text(name))
    s = strip_chars(squeeze(s), r" ,.;:&\-")
    return F.trim(F.regexp_replace(s, r"(?i)\s+(and|to|in|the)\s*$", ""))


# Brackets that stand for the numeral I, in the order in which they are put right.
NUMERALS = ((r"\bII\]", "III"), (r"\[II\b", "III"), (r"\bI\]", "II"), (r"\[V\b", "IV"), (r"[\[\]]", "I"))


def clean_ocr_name(name: C) -> Column:
    """The same, brackets read for the numeral I put right first."""
    right = s = text(name)
    for wrong, numeral in NUMERALS:
        right = F.regexp_replace(right, wrong, numeral)
    return clean_name(F.when(F.contains(s, F.lit("[")) | F.contains(s, F.lit("]")), right).otherwise(s))


def without_descriptors(name: C) -> Column:
    """A borrower's name without what is said of the person, three times at most; "A joined by B"
    becomes "A and B". A name of which too little is left stays as it is."""
    s = text(name)

    def bare(c: Column, marks: str, *patterns: str) -> Column:
        def once(v: Column) -> Column:
            for p in patterns:
                v = strip_chars(F.regexp_replace(v, p, ""), marks)
            return v

        # A round that takes nothing off is the last, and only marks go where no descriptor stands.
        def rounds(v: Column, n: int) -> Column:
            return let(once(v), lambda w: F.when(w == v, w).otherwise(rounds(w, n - 1))) if n > 1 else once(v)

        return let(c, lambda v: let(strip_chars(v, marks), lambda w: F.when(F.regexp_like(w, F.lit(DESCRIPTORS)), rounds(v, 3)).otherwise(w)))

    one, two = (bare(strip_chars(group(F.trim(s), JOINED, n), " ,."), " ,.", MARITAL, DESCRIPTOR) for n in (1, 2))
    both = F.when((F.length(one) >= 3) & (F.length(two) >= 3), F.concat(one, F.lit(" and "), two)).otherwise(s)
    alone = bare(F.trim(s), r" ,.;:&\-", MARITAL, DESCRIPTOR, ROLE)
    joined = F.contains(F.lower(s), F.lit("joined")) & (group(F.trim(s), JOINED) != "")
    return F.when(joined, both).otherwise(let(alone, lambda a: F.when(F.length(a) >= 3, a).otherwise(s)))


def entity_core(name: C) -> Column:
    """An entity's name up to its kind (LLC, L.P., INC ...)."""
    s = F.trim(text(name))
    core = strip_chars(F.regexp_extract(s, ENTITY_CORE, 1), r" ,;:&\-")
    return F.when(F.length(core) >= 3, core).otherwise(strip_chars(s, r" ,;:&\-"))


def looks_like_lender(name: C) -> Column:
    return has(name, LENDER)


def looks_like_legal(name: C) -> Column:
    return has(name, LEGAL_TEXT)


def looks_like_page_header(value: C) -> Column:
    """Blank, or at least two words of page headers."""
    up = F.upper(text(value))
    hits = F.lit(0)
    for w in PAGE_WORDS:
        hits = hits + up.contains(w).cast("int")
    return (up == "") | (hits >= 2)


_AND = r"\s+(?:AND|and|&)\s+"


def _initial_off(s: Column) -> Column:
    s = F.trim(F.regexp_replace(strip_chars(s, " ,."), r"\s+[A-Z]\.?$", ""))
    return F.when(F.length(s) >= 4, s).otherwise("")


def primary_name(clause: C) -> Column:
    """The first person of a joint clause, "" where it is too short."""
    s = F.regexp_replace(text(clause), r"(?i)\s*,\s*(?:AN?\s|UNMARRIED|SINGLE|MARRIED|HUSBAND|WIFE|HIS\s+SPOUSE|HER\s+SPOUSE).*$", "")
    return _initial_off(F.get(F.split(s, _AND, 2), F.lit(0)))


def secondary_name(clause: C) -> Column:
    """The second person of a joint clause, else ""."""
    s = F.trim(F.coalesce(F.get(F.split(text(clause), _AND, 2), F.lit(1)), F.lit("")))
    s = F.regexp_replace(s, r"(?i)^(?:WIFE|HUSBAND|SPOUSE)\s*,?\s*", "")
    s = F.regexp_replace(s, r"(?i)\s+(?:husband\s+and\s+wife|wife\s+and\s+husband|his\s+(?:wife|spouse)|her\s+(?:husband|spouse))\s*$", "")
    return _initial_off(s)


# Documents that are filed as liens and are none, by what they say, and their flag.
NOT_LIENS = (
    (r"UTILITY\s+LIEN\s+ACCOUNT\s+NUMBER|AFFIDAVIT\s+OF\s+.{0,60}UTILITY\s+LIEN", "utility_lien_not_abatement"),
    (r"REAL\s+ESTATE\s+LIEN\s+NOTE", "real_estate_lien_note_not_abatement"),
    (r"CORRECTING\s+DOCUMENT", "correcting_document_not_abatement"),
)


def not_a_lien(document: C) -> Column:
    """The flag of a document that is no lien, null for others."""
    chain = F
    for pattern, flag in NOT_LIENS:
        chain = chain.when(has(document, f"(?s){pattern}"), F.lit(flag))
    return chain.otherwise(F.lit(None).cast("string"))


def lien_flags(*, mail_zip: C, prop_address: C, mail_address: C, account: C, amount: C, filed_amount: C, owner: C, filed_owner: C, work_date: C, as_of: str, zip_prefix: str) -> Column:
    """What is doubtful about a lien document next to its filing, in a fixed order."""
    address, mail = F.upper(F.trim(text(prop_address))), F.upper(F.trim(text(mail_address)))
    numbered = F.exists(F.split(address, r"\s+"), lambda w: F.regexp_like(F.replace(w, F.lit("-"), F.lit("")), F.lit(r"^\d+$")))
    words = F.filter(F.regexp_extract_all(F.upper(text(owner)), F.lit(r"(\w+)"), 1), lambda w: F.length(w) >= 3)
    day = F.try_to_date(col(work_date), "yyyy-MM-dd")
    rules = {
        "bad_zip_format": ~blank(mail_zip) & ~F.regexp_like(text(mail_zip), F.lit(r"^\d{5}$")),
        "zip_outside": F.regexp_like(text(mail_zip), F.lit(r"^\d{5}$")) & ~F.startswith(text(mail_zip), F.lit(zip_prefix)),
        "suspicious_short_address": (address != "") & (~numbered | (F.length(address) < 6)),
        "absentee_owner": (address != "") & (mail != "") & (address != mail),
        "bad_account": ~blank(account) & ~F.regexp_like(text(account), F.lit(r"^\d{4}-\d{4}-\d{4}$")),
        "amount_mismatch": (col(filed_amount) != 0) & (F.abs(col(amount) - col(filed_amount)) > 0.01),
        "owner_mismatch": ~blank(owner) & ~blank(filed_owner) & ~F.exists(words, lambda w: F.contains(F.upper(text(filed_owner)), w)),
        "bad_work_date": ~blank(work_date) & F.coalesce(day > F.lit(as_of).cast("date"), F.lit(True)),
        "incomplete_extraction": blank(account) | blank(prop_address) | blank(owner) | blank(mail_zip),
    }
    return F.array_compact(F.array(*[F.when(F.coalesce(test, F.lit(False)), F.lit(name)) for name, test in rules.items()]))


def lien_action(*, document: C, known: C, processed: C, corporate: C, owner: C, address: C, account: C, force: bool = False) -> Column:
    """What becomes of a lien document: SKIP, CREATE, fail, already, DELETE or ok.

    Documents that are no liens are skipped. An unknown one is skipped if its owner is
    corporate, makes a record if it names an owner and an address or account, else fails. A known
    one that was read before is left; a corporate owner's record goes; any other is updated.
    """
    named = ~blank(owner) & (~blank(address) | ~blank(account))
    return (
        F.when(not_a_lien(document).isNotNull(), "SKIP").when(~col(known) & col(corporate), "SKIP").when(~col(known) & named, "CREATE").when(~col(known), "fail")
        .when(col(processed) & F.lit(not force), "already").when(col(corporate), "DELETE").otherwise("ok")
    )
