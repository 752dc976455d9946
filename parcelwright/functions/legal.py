"""Legal descriptions: subdivision, lot and block, and whether two of them agree."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .base import C, blank, col, group, has, squeeze, strip_chars, text

# Patterns of lots, blocks and names, words that name no subdivision.
_LOT = r"\b(?:LOT[S]?|LTS?)\s*[:\-]?\s*([\d,A-Z-]+)"
_BLOCK = r"\bBLOCK\s*[:\-]?\s*([\dA-Z-]+)"
_BLK = r"\b(?:BLK|BK)\.?\s*[:\-]?\s*([\dA-Z-]+)"
_NAME_LABEL = r"SUBDIVISION[\s\-]+NAME[\s:]*"
_KINDS = r"\bSUBDIVISION\b|\bADDITION\b|\bSECTION\b|\bPHASE\b"
_BRACKETS = r"[\(\)]"
_AGREE_LOT = r"\bLO?T?S?\.?\s*([0-9]+(?:[-\s]?[A-Z])?)\b"
_AGREE_BLOCK = r"\bB(?:LO?C?K|K)\.?\s*([0-9]+(?:[-\s]?[A-Z])?)\b"
NUMBER_WORDS = ("ONE", "TWO", "THREE", "FOUR", "FIVE", "SIX", "SEVEN", "EIGHT", "NINE", "TEN")
STRUCTURAL = (
    "the", "of", "a", "an", "unit", "units", "block", "blk", "bk", "lot", "lots", "lt", "lts", "phase", "section", "sec", "pud", "pu",
    "addition", "subdivision", "bldg", "building", "tract", "tr", "and",
)
GENERIC = (
    "ESTATES", "ESTATE", "PARK", "ADDITION", "HEIGHTS", "TERRACE", "CROSSING", "VILLAGE", "GARDENS", "GARDEN", "ACRES", "PLACE", "SUBDIVISION",
    "UNIT", "PHASE", "SECTION", "TRACT", "BLOCK", "LOT",
)
_LOT_VALUE = r"\d+[A-Za-z]?(?:\s*(?:&|,|and|thru|through|to|-)\s*\d+[A-Za-z]?)*"
_CAUSE = r"(?i)^\s*(?:SUIT\s*(?:NO\.?|#)?\s*|CAUSE\s*(?:NO\.?|#)?\s*|#\s*)?(?:\d{4}\s*DCV[\s-]*\d+[\s-]*[A-Z]|\d{2}-\d{4,5}-\d{2}-\d-[A-Z])\b[\s,.\-]*"


def parse_legal(legal: C) -> Column:
    """struct(subdivision, lot, block): subdivision in lower case, lot and block as written."""
    s = F.upper(text(legal))
    lot = strip_chars(F.regexp_extract(s, _LOT, 1), " ,-")
    named = F.regexp_extract(s, _BLOCK, 1)
    block = strip_chars(F.when(F.regexp_like(s, F.lit(_BLOCK)), named).otherwise(F.regexp_extract(s, _BLK, 1)), " ,-")
    sub = s
    for pattern in (_NAME_LABEL, _LOT, _BLOCK, _BLK, _KINDS, _BRACKETS):
        sub = F.regexp_replace(sub, pattern, " ")
    sub = strip_chars(F.regexp_replace(sub, r"\s+", " "), " ,:-")
    for n, word in enumerate(NUMBER_WORDS, 1):
        sub = F.regexp_replace(sub, rf"\bUNIT\s+{word}\b", f"UNIT {n}")
    return F.struct(F.lower(sub).alias("subdivision"), lot.alias("lot"), block.alias("block"))


def lot_set(lot: C) -> Column:
    return F.filter(F.transform(F.split(text(lot), r"[,&\s]+"), lambda p: strip_chars(p, " ,-")), lambda p: p != "")


def name_words(subdivision: C) -> Column:
    """The words that name a subdivision, plurals in the singular too."""
    words = F.transform(F.split(text(subdivision), r"\s+"), lambda w: F.lower(strip_chars(w, r",\-#/'\".")))
    words = F.filter(words, lambda w: (w != "") & ~w.isin(*STRUCTURAL) & ~F.regexp_like(F.replace(w, F.lit("."), F.lit("")), F.lit(r"^\d+$")))
    singular = F.transform(F.filter(words, lambda w: (F.length(w) > 3) & w.endswith("s")), lambda w: F.regexp_replace(w, "s$", ""))
    return F.array_distinct(F.concat(words, singular))


def legals_match(a: C, b: C, address_a: C | None = None, address_b: C | None = None) -> Column:
    """Whether two parsed legals (see parse_legal) can be of one parcel. Symmetric.

    Lots that both name must overlap, unless both addresses (normalised by the caller) are the
    same and the blocks do not differ; blocks that both name must be equal; a word that names
    the subdivision must be shared.
    """
    x, y = col(a), col(b)
    both_blocks = (x["block"] != "") & (y["block"] != "")
    blocks_differ = both_blocks & (x["block"] != y["block"])
    both_lots = (x["lot"] != "") & (y["lot"] != "")
    overlap = F.arrays_overlap(lot_set(x["lot"]), lot_set(y["lot"]))
    rescued = F.lit(False)
    if address_a is not None and address_b is not None:
        rescued = ~blank(address_a) & (col(address_a) == col(address_b)) & ~blocks_differ
    lots_agree = F.when(both_lots & ~overlap, rescued).otherwise(~blocks_differ)
    return F.coalesce((x["subdivision"] != "") & (y["subdivision"] != "") & lots_agree & F.arrays_overlap(name_words(x["subdivision"]), name_words(y["subdivision"])), F.lit(False))


def expand_lots(value: C) -> Column:
    """"15 THRU 17" to 15, 16, 17; "122&123" to both; letters in upper case."""
    parts = F.filter(F.transform(F.split(F.trim(text(value)), r"(?i)\s*(?:&|,|and)\s*"), lambda p: F.trim(p)), lambda p: p != "")
    span = r"(?i)^\s*(\d+)\s*(?:thru|through|to|-)\s*(\d+)\s*$"

    def lots(p: Column) -> Column:
        a, b = (F.regexp_extract(p, span, n).try_cast("int") for n in (1, 2))
        return F.when(a.isNotNull() & b.isNotNull(), F.sequence(F.least(a, b), F.greatest(a, b)).cast("array<string>")).otherwise(F.array(F.upper(p)))

    return F.array_distinct(F.flatten(F.transform(parts, lots)))


def lot_block(legal: C) -> Column:
    """struct(block, lots); tracts count as lots."""
    s = squeeze(legal)
    block = F.upper(group(s, r"\b(?:BLOCK|BLK|BK)\s*[:#]?\s*(\d+[A-Za-z]?|[A-Za-z])\b"))
    lots = expand_lots(group(s, rf"\b(?:LOTS|LOT|LTS|LT|TRACTS|TRACT|TRS|TR)\s*[:#]?\s*({_LOT_VALUE})"))
    return F.struct(block.alias("block"), lots.alias("lots"))


def lot_blocks_match(a: C, b: C) -> Column:
    x, y = col(a), col(b)
    return F.coalesce(~((x["block"] != "") & (y["block"] != "") & (x["block"] != y["block"])) & F.arrays_overlap(x["lots"], y["lots"]), F.lit(False))


def legal_parts(legal: C) -> Column:
    """struct(subdivision, lot, block): what stands before the first lot or block, in upper case."""
    s = squeeze(F.upper(text(legal)))
    lot, block = (F.regexp_replace(F.regexp_extract(s, p, 1), r"[-\s]", "") for p in (_AGREE_LOT, _AGREE_BLOCK))
    sub = strip_chars(F.regexp_replace(s, rf"(?:{_AGREE_LOT}|{_AGREE_BLOCK}).*$", ""), r" ,.\-")
    return F.struct(sub.alias("subdivision"), lot.alias("lot"), block.alias("block"))


def legals_agree(a: C, b: C) -> Column:
    """Both lots and blocks are equal or, where a block is missing, the lots and a long word of the name."""
    x, y = legal_parts(a), legal_parts(b)
    full = (x["lot"] != "") & (x["block"] != "") & (y["lot"] != "") & (y["block"] != "")
    long = lambda s: F.filter(F.split(s["subdivision"], " "), lambda w: F.length(w) > 3)
    part = (x["lot"] != "") & (x["lot"] == y["lot"]) & F.arrays_overlap(long(x), long(y))
    return F.coalesce(F.when(full, (x["lot"] == y["lot"]) & (x["block"] == y["block"])).otherwise(part), F.lit(False))


def subdivisions_conflict(a: C, b: C) -> Column:
    """Both name a subdivision and nothing ties the names: neither holds the other, no
    distinctive word is shared, and neither's words all stand in the other legal."""
    clean = lambda s: squeeze(F.regexp_replace(F.upper(s), r"[^A-Z0-9 ]", " "))
    x, y = clean(legal_parts(a)["subdivision"]), clean(legal_parts(b)["subdivision"])
    words = lambda s: F.filter(F.split(s, " "), lambda w: (F.length(w) > 3) & ~w.isin(*GENERIC))
    wx, wy = words(x), words(y)
    whole_x, whole_y = F.split(clean(text(a)), " "), F.split(clean(text(b)), " ")
    inside = lambda w, whole: F.size(F.array_except(w, whole)) == 0
    return (
        (x != "") & (y != "") & ~x.contains(y) & ~y.contains(x) & (F.size(wx) > 0) & (F.size(wy) > 0) & ~F.arrays_overlap(wx, wy) & ~inside(wy, whole_x) & ~inside(wx, whole_y)
    )


def clean_thin_legal(legal: C) -> Column:
    """A legal without its cause number, "" where no lot, block or tract is left."""
    s = strip_chars(F.regexp_replace(squeeze(legal), _CAUSE, ""), r" ,.\-")
    return F.when(has(s, r"\b(?:LOT|LOTS|LT|LTS|BLK|BLOCK|BK|TR|TRACT|SUBDIVISION)\b"), s).otherwise("")


def compose_legal(description: C, lot: C, block: C) -> Column:
    return F.concat_ws(" ", F.when(~blank(description), F.trim(text(description))), F.when(~blank(lot), F.concat(F.lit("Lot "), F.trim(text(lot)))), F.when(~blank(block), F.concat(F.lit("Block "), F.trim(text(block)))))


def can_be_checked(prop_id: C, legal: C) -> Column:
    """Why a record can't be checked against a parcel's legal; "" where it can."""
    p = parse_legal(legal)
    return F.when(blank(prop_id), "no parcel").when(blank(legal), "no legal").when((p["subdivision"] == "") | (p["lot"] == ""), "sparse legal").otherwise("")


def verdict(ours: C, parcel: C) -> Column:
    """match, mismatch, or ambiguous where the parcel's legal says too little."""
    p = parse_legal(parcel)
    return F.when(blank(parcel) | (p["subdivision"] == "") | (p["lot"] == ""), "ambiguous").when(legals_match(parse_legal(ours), p), "match").otherwise("mismatch")
