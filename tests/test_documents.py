"""Affidavits, match words, legal cross-references: cases that the queries do not render."""

import random
import re

import pytest
from pyspark.sql import functions as F

from parcelwright.functions import addresses, legal
from parcelwright.operators import affidavits, legal_index

SCHEMA = "id long, text string, owner string, flags string"


def read(spark, *texts):
    rows = spark.createDataFrame([(i, t, "clash", "clash") for i, t in enumerate(texts)], SCHEMA)
    return [r.asDict() for r in affidavits.affidavit_fields(rows).orderBy("id").collect()]


def block(*lines):
    return "That the record owner is:\n\n" + "\n".join(lines) + "\n\nThat said amount"


@pytest.mark.parametrize(
    "lines,want",
    [
        (("DOE",), ("DOE", "", "", "", "")),
        (("DOE", "1 OAK ST", "", "  TOWN, TX 78404-1234.  "), ("DOE", "1 OAK ST", "TOWN", "TX", "78404")),
        # A second line with a house number is never part of a name, even one that ends like a company.
        (("SAMPLE", "7 PLAZA CO", "TOWN, TX 78404"), ("SAMPLE", "7 PLAZA CO", "TOWN", "TX", "78404")),
        (("SAMPLE", "HOLDINGS OF A VERY LONG NAME", "1 OAK ST", "TOWN, TX 78404"), ("SAMPLE", "HOLDINGS OF A VERY LONG NAME 1 OAK ST", "TOWN", "TX", "78404")),
        (("SAMPLE", "HOLDINGS OF A", "1 OAK ST", "TOWN, TX 78404"), ("SAMPLE HOLDINGS OF A", "1 OAK ST", "TOWN", "TX", "78404")),
        (("SAMPLE", "AND SONS, L.L.C", "TOWN, TX 78404"), ("SAMPLE AND SONS, L.L.C", "TOWN, TX 78404", "TOWN", "TX", "78404")),
        # The last place counts, and what lies before it is the street.
        (("DOE", "A, TX 11111", "1 OAK ST", "B, TX 22222", "ATTN CLERK"), ("DOE", "A, TX 11111 1 OAK ST", "B", "TX", "22222")),
        (("A, TX 11111", "B, TX 22222"), ("A, TX 11111", "B, TX 22222", "B", "TX", "22222")),
    ],
)
def test_owner_blocks(spark, lines, want):
    r = read(spark, block(*lines))[0]
    assert (r["owner"], r["mail_address"], r["mail_city"], r["mail_state"], r["mail_zip"]) == want


def test_spouses(spark):
    got = [(r["owner"], r["spouse"]) for r in read(spark, *[block(f"DOE ALEX {w} ROE CASEY", "1 OAK ST") for w in ("AND WF", "and wife", "AND HUS", "AND HUSBAND", "AND SPOUSE", "AND", "AND WFX")])]
    assert got == [("DOE ALEX", "ROE CASEY")] * 5 + [("DOE ALEX AND ROE CASEY", ""), ("DOE ALEX AND WFX ROE CASEY", "")]


def test_accounts_and_streets(spark):
    place = lambda s: f"X BLK 1 LOT 2, and by Account No. {s}"
    cases = {
        "0386-0005-0060. 1822 KEYS\n\n": ("0386-0005-0060", "1822 KEYS"), "038600050060, 1529 7TH\nST\n": ("0386-0005-0060", "1529 7TH ST"), "0481-\n1601-0380. 1414 S 19TH ST": ("0481-1601-0380", "1414 S 19TH ST"),
        "0481- .\n1601 - 0380 1 OAK": ("0481-1601-0380", "1 OAK"), "0481-1401-0630. 1462\n417TH ST\n": ("0481-1401-0630", "1462 417TH ST"), "0481-1401-0630.\nThat sald work was completed": ("0481-1401-0630", ""),
        "0481-1401-0630. ONE TWO THREE FOUR FIVE SIX SEVEN EIGHT NINE\n": ("0481-1401-0630", ""), "0481-1401-0630. 5 ELM which was  invoiced\n": ("0481-1401-0630", ""), "0481-1401": ("", ""),
    }
    assert [(r["account"], r["prop_address"]) for r in read(spark, *map(place, cases))] == list(cases.values())


def test_blank_and_long_affidavits(spark):
    got = read(spark, None, "", " \n ", "x " * 20_000 + block("DOE", "1 OAK ST"))
    assert all(r["owner"] == "" and r["amount"] is None and r["reasons"] == [] and r["flags"] == [] for r in got[:3])
    assert got[3]["owner"] == "DOE"
    assert affidavits.affidavit_fields(spark.createDataFrame([], SCHEMA)).collect() == []


def test_other_papers_give_number_and_flag_only(spark):
    head = "2025 - 2025027139 07/30/2025 12:37 PM\n"
    r = read(spark, head + "REAL  ESTATE\nLIEN NOTE\n" + block("DOE", "1 OAK ST"))[0]
    assert (r["doc_number"], r["filed"], r["owner"], r["flags"]) == ("2025027139", "2025-07-30", "", ["real_estate_lien_note_not_abatement"])


def plain_words(address):
    """The rules of match words, said once more in plain Python."""
    singles = {**addresses.UNITS, **addresses.OTHERS}
    words = re.sub(r"[.,#&/]", " ", re.sub(r"\bBL\d+\b", " ", (address or "").upper().replace("'", ""))).split()
    words = [addresses.DIRECTIONS.get(w, w) for w in words]

    def pairs(ws, leads, join):
        out = []
        while ws:
            both = join(ws[0], ws[1]) if len(ws) > 1 and leads(ws[0]) else None
            out.append(ws[0] if both is None else both)
            ws = ws[1 if both is None else 2 :]
        return out

    words = pairs(words, addresses.TENS.__contains__, lambda a, b: addresses.TENS[a] + addresses.UNITS[b] if b in addresses.UNITS else None)
    words = pairs([singles.get(w, w) for w in words], lambda w: w == "MC", lambda a, b: a + b)
    words = words[: next((i for i, w in enumerate(words) if w in addresses.SERVICE_WORDS), len(words))]
    while len(words) > 1 and words[-2] in addresses.SUFFIXES and (len(words[-1]) < 3 or words[-1].isdigit()) and words[-1] not in addresses.DIRECTIONS.values():
        words = words[:-1]
    return [w for w in words if w not in addresses.SUFFIXES]


def test_match_words_of_random_addresses(spark):
    rng = random.Random(1)
    some = ["1", "22", "333", "N", "north", "South", "OAK", "O'Elm", "MC", "mc", "St", "AVE.", "Lane", "#4", "UNIT", "ste", "Twenty", "thirty", "First", "NINTH", "tenth", "fortieth", "BL002", "a/b", "C", "Southeast", ",", "&"]
    texts = [" ".join(rng.choices(some, k=rng.randint(0, 9))) for _ in range(600)] + [None, "", "  "]
    got = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, t string").select("i", addresses.address_words("t").alias("w")).orderBy("i").collect()
    assert [r.w for r in got] == [plain_words(t) for t in texts]


def test_no_python_in_match_words(spark):
    df = spark.createDataFrame([("1 OAK ST",)], "a string").select(addresses.full_key(addresses.address_words("a")))
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()


LEGALS = [
    "SAMPLE PARK LOT 1 BLK 2", "SAMPLE PARK LOT 1, 2 BLK 2", "Lot: 2 Block: 2 Subdivision- Name: SAMPLE", "SAMPLE PARK", "SAMPLE BLK 3", "OTHER HILLS LOT 1", "OTHER HILL", "LOT 1 BLK 2", "", None,
    "SAMPLE LTS 2,3", "PARKS BLOCK 2", "UNIT TWO LOT 5 HILLS", "OTHER PARK LOT 4A BLK 2",
]


def test_keys_are_the_match(spark):
    """Every pair of legals matches by legals_match if and only if it has a key in common."""
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(LEGALS)], "i int, t string").select("i", legal.parse_legal("t").alias("p"))
    pairs = rows.select(F.col("i").alias("a"), F.col("p").alias("pa")).crossJoin(rows.select(F.col("i").alias("b"), F.col("p").alias("pb")))
    by_keys = F.arrays_overlap(legal_index.asked_keys("pa"), legal_index.stored_keys("pb"))
    got = pairs.select("a", "b", legal.legals_match("pa", "pb").alias("m"), F.coalesce(by_keys, F.lit(False)).alias("k")).collect()
    assert [(r.a, r.b) for r in got if r.m != r.k] == [] and 10 < sum(r.m for r in got) < 150


def test_cross_reference_takes_the_first_by_name_then_by_order(spark):
    records = [
        ("r1", "ALEX DOE AND WIFE, CASEY ROE", "", "1", "2", "SAMPLE"), ("r2", "NOBODY", None, "1", "2", "SAMPLE HOMES"), ("r3", "ALEX DOE", "9 OAK", "1", "2", "SAMPLE"),
        ("r4", "", "", "1", "2", "SAMPLE"), ("r5", "ALEX DOE", "", "9", "2", "SAMPLE"), ("r6", "ALEX DOE", "", "1", "", "SAMPLE"), ("r1", "ALEX DOE AND WIFE, CASEY ROE", "", "1", "2", "SAMPLE"),
    ]
    parcels = [
        ("CASEY ROE", 1, "SAMPLE LOT 1 BLK 2", "1 ELM ST, ROBSTOWN, TX 78380", 1.0), ("ALEX  DOE", 5, "SAMPLE LOT 1 BLK 2", "5 ELM AVE", 5.0), ("alex doe", 4, "SAMPLE LOT 1 BLK 3", "4 ELM AVE", 4.0),
        ("ALEX DOE", 6, "SAMPLE LOT 1 BLK 2", "6 ELM AVE", 6.0), ("SAMPLE HOMES", 7, "SAMPLE LOT 1 BLK 2", "7 ELM AVE", 7.0), (None, 8, None, None, None),
    ]
    r = spark.createDataFrame(records, "doc_num string, owner string, prop_address string, legal_lot string, legal_block string, legal_subdivision string")
    p = spark.createDataFrame(parcels, "name string, pos long, legal string, situs string, appraised_value double")
    got = {x.doc_num: (x.stage, x.pos, x.prop_address, x.prop_city) for x in legal_index.cross_referenced(r, p).collect()}
    assert got == {"r1": ("name", 5, "5 ELM AVE", "CORPUS CHRISTI"), "r2": ("subdivision", 7, "7 ELM AVE", "CORPUS CHRISTI")}
    assert legal_index.cross_referenced(r.limit(0), p).collect() == []


def test_classes_link_as_pairs_do(spark):
    rng = random.Random(2)
    rows = [(i, rng.choice(["a", "b"]), rng.choice(LEGALS)) for i in range(60)]
    df = spark.createDataFrame(rows, "id int, owner string, legal string")
    p = df.select("id", "owner", legal.parse_legal("legal").alias("p"))
    a, b = p.select(F.col("id").alias("a"), "owner", F.col("p").alias("pa")), p.select(F.col("id").alias("b"), "owner", F.col("p").alias("pb"))
    want = {r.a: r["count"] for r in a.join(b, "owner").where(F.col("a") != F.col("b")).where(legal.legals_match("pa", "pb")).groupBy("a").count().collect()}
    got = {r.id: r.n_links for r in legal_index.legal_classes(df, key="id", within="owner").collect()}
    assert got == {i: want.get(i, 0) for i, *_ in rows}


def test_all_pairs_of_legals_that_match(spark):
    """Within and between classes, whatever the chunks."""
    rng = random.Random(3)
    rows = [(i, rng.choice(["a", "b", None]), rng.choice(LEGALS)) for i in range(90)]
    df = spark.createDataFrame(rows, "id int, owner string, legal string")
    p = df.select("id", "owner", legal.parse_legal("legal").alias("p"))
    a, b = p.select(F.col("id").alias("a"), "owner", F.col("p").alias("pa")), p.select(F.col("id").alias("b"), "owner", F.col("p").alias("pb"))
    want = sorted((r.a, r.b) for r in a.join(b, "owner").where("a < b").where(legal.legals_match("pa", "pb")).select("a", "b").collect())
    assert len(want) > 100
    for chunk in (1, 2, 1_024):
        assert sorted(map(tuple, legal_index.legal_pairs(df, key="id", within="owner", chunk=chunk).collect())) == want


def test_legal_match_names_every_pair(spark):
    from parcelwright.plans.registry import ORACLES, QUERIES

    pairs = QUERIES["legal_match"](spark, "/root/testdata/sf0.01")
    assert pairs.columns == ["a", "b"] and pairs.distinct().count() == pairs.count() == 123
    assert "JOIN t b ON a.owner_id = b.owner_id AND a.prop_id < b.prop_id" in ORACLES["legal_match"]


def test_each_notice_is_found_by_its_own_pattern():
    """No pattern before the case's own one finds anything in it, so that each pattern is needed."""
    from parcelwright.functions import notice_patterns as P
    from parcelwright.plans.notice_cases import CASES, FORESTALLED

    lists = {
        "owner": [p for p, _ in P.BORROWER], "lender": P.LENDER, "loan_amount": P.AMOUNT, "deed_date": P.DEED_DATE, "loan_doc": P.LOAN_NUMBER,
        "prop_address": [P.LABELLED_ADDRESS, P.HEADER_ADDRESS, P.LINE_ADDRESS, P.ANY_ADDRESS], "legal_subdivision": [P.LEGAL_WORDS, P.LEGAL_DIGITS, P.LEGAL_TRACTS],
    }
    parts = {"p": "CASEY DABE", "q": "ALEX RABE", "e": "SAMPLE ABE HOMES", "n": "2019123456", "d": "17", "h": "123"}
    for field, place, template, _ in CASES:
        if field in lists:  # numbers of modifications are gathered by all patterns
            notice = template.format(**parts)
            notice = " ".join(notice.split()) if field == "loan_doc" else notice
            assert [i for i, p in enumerate(lists[field]) if re.search(p, notice)][0] == place, (field, place)
    for field, patterns in lists.items():
        assert {i for f, i, _, _ in CASES if f == field} | {i for f, i in FORESTALLED if f == field} == set(range(len(patterns)))


def test_bounds_and_rejects_of_notices(spark):
    from parcelwright.operators import extraction

    texts = {
        "executed by LOT 4 BLOCK 2, whose x. mortgagor: CASEY DOE, of": ("owner", "CASEY DOE"),  # a legal description is no borrower
        "executed by ABC, whose x. mortgagor: CASEY DOE, of": ("owner", "CASEY DOE"),  # under four characters
        "principal sum of $ 1,000": ("loan_amount", None), "principal sum of $1,000.01": ("loan_amount", "1000.01"), "principal sum of $10,000,000": ("loan_amount", None),
        "principal sum of $10,000,000 in the amount of $5,000": ("loan_amount", "5000.0"), "Current Mortgagee: AB Mortgage Servicer": ("lender", ""),
        "commonly known as 1 SAMPLE STREET, Dallas, TX 75201": ("prop_address", ""), "at 901 LEOPARD STREET, CORPUS CHRISTI, TX 78401": ("prop_address", ""),
    }
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    read = [r.asDict() for r in extraction.notice_fields(rows).orderBy("i").collect()]
    got = [(f, v if v is None or isinstance(v, str) else str(v)) for r, (f, _) in zip(read, texts.values()) for v in [r[f]]]
    assert got == list(texts.values())


def test_a_pattern_that_matches_has_what_it_needs(spark):
    from parcelwright.functions import notice_patterns as P
    from parcelwright.plans import document_queries, notice_cases

    k = F.col("id")
    notices = spark.range(len(notice_cases.CASES)).select(F.array(*[document_queries._rendered(template, k) for _, _, template, _ in notice_cases.CASES])[k].alias("text"))
    notices = notices.union(spark.createDataFrame([("Deed executed by CASEY DOE dated June 1, 2009",)], "text string"))
    pairs = [(p, n) for (p, _), n in zip(P.BORROWER, P.BORROWER_NEEDS, strict=True)] + list(zip(P.LENDER, P.LENDER_NEEDS, strict=True))
    missed = [F.regexp_like("text", F.lit(p)) & ~F.lower("text").contains(w) for p, needs in pairs for w in needs]
    found = [F.regexp_like("text", F.lit(p)) for p, _ in pairs]
    got = notices.agg(F.max(F.array(*[F.array_contains(F.array(*missed), True)])[0]).alias("missed"), *[F.max(f).alias(f"f{i}") for i, f in enumerate(found)]).first()
    assert got.missed is False
    assert all(got[1:])  # every pattern is met


def test_needs_hold_wherever_a_pattern_matches(spark):
    """What spares a pattern a text never spares it one that it matches, for every list of patterns."""
    from parcelwright.functions import notice_patterns as P
    from parcelwright.operators import extraction
    from parcelwright.plans import document_queries, notice_cases

    k = F.col("id")
    cases = [document_queries._rendered(template, k) for _, _, template, _ in notice_cases.CASES]
    notices = spark.range(len(cases)).select(F.array(*cases)[k].alias("text")).select("text", F.lower("text").alias("low"))
    lists = [(P.AMOUNT, P.AMOUNT_NEEDS), (P.DEED_DATE, P.DEED_DATE_NEEDS), (P.LOAN_NUMBER, P.LOAN_NUMBER_NEEDS), ((P.MODIFIED,), (P.MODIFIED_NEEDS,)), ((P.OWN_NUMBER,), (P.OWN_NUMBER_NEEDS,))]
    lists.append(((P.LABELLED_ADDRESS, P.HEADER_ADDRESS, P.LINE_ADDRESS, P.ANY_ADDRESS), (P.ADDRESS_NEEDS + P.LABELLED_NEEDS, P.ADDRESS_NEEDS, P.ADDRESS_NEEDS, P.ADDRESS_NEEDS)))
    lists.append(((P.LEGAL_WORDS, P.LEGAL_DIGITS, P.LEGAL_TRACTS), (P.LEGAL_WORDS_NEEDS, P.LEGAL_DIGITS_NEEDS, P.LEGAL_TRACTS_NEEDS)))
    pairs = [(p, n) for patterns, needs in lists for p, n in zip(patterns, needs, strict=True)]
    found = notices.select(*[F.struct(F.regexp_like("text", F.lit(p)).alias("m"), extraction._holds(F.col("low"), *n).alias("h")).alias(f"p{i}") for i, (p, n) in enumerate(pairs)]).collect()
    assert not [i for r in found for i, x in enumerate(r) if x.m and not x.h]


def test_time_of_a_long_word_grows_with_its_length(spark):
    """A lot's pattern was tried from each of a word's letters to its end, which took minutes for this one."""
    import time

    from parcelwright.operators import extraction

    notices = spark.createDataFrame([("x" * 400_000 + " at Lot 7A, Block 3, SAMPLE Addition",)], "text string")
    began = time.perf_counter()
    r = extraction.notice_fields(notices).select("legal_lot", "legal_block", "legal_subdivision").first()
    assert tuple(r) == ("7A", "3", "SAMPLE")
    assert time.perf_counter() - began < 60


def test_the_first_good_name_counts_and_marks_hide_no_descriptor(spark):
    from parcelwright.functions.base import squeeze, squeeze_page
    from parcelwright.functions.notices import without_descriptors
    from parcelwright.operators import extraction

    names = {"CASEY DOE, WIFE;": "CASEY DOE", "CASEY DOE, A MARRIED MAN, UNMARRIED, HIS WIFE ,": "CASEY DOE", "CASEY DOE;": "CASEY DOE", "CASEY WIDOW": "CASEY", "DOE, WIFE": "DOE", "AB, WIFE": "AB, WIFE"}
    df = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "i int, n string")
    assert [r[0] for r in df.orderBy("i").select(without_descriptors("n")).collect()] == list(names.values())
    spaces = ["", " ", "  a  b ", "a\n\tb\r\n", " \x0b\x0c", "a \x85", "a  \u2028", "\u00a0a", None, "a b"]
    df = spark.createDataFrame([(s,) for s in spaces], "s string")
    assert all(r[0] == r[1] for r in df.select(squeeze("s"), squeeze_page("s")).collect())
    # A lender, a legal description and too short a name before a good one.
    notice = "executed by SAMPLE BANK, whose\nx. executed by AB dated x. mortgagor: LOT 4 BLOCK 2, of\nobligor: CASEY DOE, of"
    got = spark.createDataFrame([(notice,)], "t string").select(extraction.borrower(F.col("t")).alias("b")).first().b
    assert (got.owner, got.owner_raw) == ("CASEY DOE", "")


def test_work_by_the_row_is_spread_over_tasks(spark):
    from parcelwright.plans.registry import QUERIES

    for name in ("notices_read", "notice_patterns", "search_rows", "detail_pages", "best_search_row", "card_rows", "mail_blocks"):
        logical = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().logical().toString()
        assert "RepartitionByExpression" in logical, name


def test_cross_reference_broadcasts_nothing(spark):
    from parcelwright.plans import document_queries

    assert "Broadcast" not in document_queries.cross_referenced(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
