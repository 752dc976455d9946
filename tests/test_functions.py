"""Golden values of the text functions, with invented names."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from parcelwright.functions import addresses, codes, dates, legal, money, owners


def values(spark, texts, *columns):
    rows = spark.createDataFrame([(i, *(t if isinstance(t, tuple) else (t,))) for i, t in enumerate(texts)], "i int, a string" + (", b string" if isinstance(texts[0], tuple) else ""))
    return [tuple(r)[1:] for r in rows.select("i", *[c.alias(f"c{k}") for k, c in enumerate(columns)]).orderBy("i").collect()]


def test_owner_kind(spark):
    cases = {
        "ESTATE OF SAMPLE DOE LLC": "estate", "DOE REV LVG TRUST": "family_trust", "SAMPLE LAND TRUST": "trust_inst", "SAMPLE COUNTY TRUSTEE": "government",
        "ALEX BANK JR": "individual", "DOE ALEX TRUSTEE": "individual", "": "individual", "SAMPLE OIL CO": "company", "DOE CO": "individual", "SAMPLE ISD": "school",
        "SAMPLE OPERATINGINC": "company", "SAMPLE CONDO ASSOC": "hoa", "FIRST SAMPLE CHURCH": "religious", "SAMPLE HOUSING 501(C)(3)": "nonprofit",
    }
    assert [v[0] for v in values(spark, list(cases), owners.owner_kind("a"))] == list(cases.values())


def test_names(spark):
    got = values(spark, ["SAMPLE LLC", "Doe, Alex Q", "DOE ALEX", "DOE", "", "o'neil smith-jones", None], owners.split_name("a")["first"], owners.split_name("a")["last"])
    assert got == [("", "SAMPLE LLC"), ("Alex", "Doe"), ("Alex", "Doe"), ("", "Doe"), ("", ""), ("Smith-Jones", "O'Neil"), ("", "")]
    p = owners.plaintiff_and_owner("a")
    assert values(spark, ["Sample County vs. Alex Doe, et al", "Sample County"], p["plaintiff"], p["owner"]) == [("Sample County", "Alex Doe"), ("Sample County", "")]
    assert [v[0] for v in values(spark, ["Casey Sue Doe", "Casey Doe Jr", "Doe, Casey", "Doe"], owners.last_first("a"))] == ["Doe Casey Sue", "Doe Casey", "Doe Casey", "Doe"]


def test_name_variants():
    assert owners.name_variants_of("ALEX Q DOE JR")[:4] == ["DOE ALEX Q JR", "ALEX Q DOE JR", "ALEX DOE", "DOE ALEX Q"]
    assert owners.name_variants_of("ALEX DOE AND CASEY ROE")[:3] == ["DOE ALEX", "ROE CASEY", "ALEX DOE AND CASEY ROE"]
    assert owners.name_variants_of("SAMPLE HOLDINGS LLC") == ["SAMPLE HOLDINGS LLC"]
    assert owners.name_variants_of(None) == []
    assert "DOE ALEX AND WF" in owners.name_variants_of("ALEX DOE AND WIFE CASEY")


@settings(max_examples=60, deadline=None)
@given(st.text(max_size=40))
def test_name_variants_are_few_and_distinct(name):
    out = owners.name_variants_of(name)
    assert len(out) <= 10 and len(set(out)) == len(out) and all(out)


def test_match_words(spark):
    cases = {"100 N. O'Sample Street Unit 4": ["100", "N", "OSAMPLE"], "12 Twenty First St 101": ["12", "21ST"], "5 MC SAMPLE LN C": ["5", "MCSAMPLE"], "": [], "MC MC MC X": ["MCMC", "MCX"], "FORTIETH NINTH THIRTY": ["40TH", "9TH", "THIRTY"]}
    assert [v[0] for v in values(spark, list(cases), addresses.address_words("a"))] == list(cases.values())


def test_lookup_candidates():
    assert addresses.lookup_candidates("1521 EL SAMPLE ST") == ("1521", ["EL SAMPLE", "SAMPLE", "EL"])
    assert addresses.lookup_candidates("7 SAINT DOE AVE")[1] == ["SAINT DOE", "SAINT", "ST DOE", "ST"]
    assert addresses.lookup_candidates("SAMPLE") == (None, [])


def test_addresses(spark):
    assert [v[0] for v in values(spark, ["100 SAMPLE ST UNIT 4", "100 SAMPLE ST N", None], addresses.group_key("a"))] == ["100 SAMPLE ST", "100 N SAMPLE ST", ""]
    q = addresses.query_parts("a")
    assert values(spark, ["1116-1120 SAMPLE ST", "SAMPLE ST", "2917 S SAMPLE AVE"], q["number"], q["street"]) == [("1116", "SAMPLE"), (None, None), ("2917", "S SAMPLE")]
    s = addresses.address_in_text("a")
    assert values(spark, ["12 Sample Pl Sample City TX 90001-1234 (Lot 4)", "no number"], s["street"], s["city"], s["zip"]) == [("12 SAMPLE PL", "SAMPLE CITY", "90001"), (None, None, None)]
    assert values(spark, ["838 SAMPLE, SAMPLETON TX 90001", "838 Sample Ave"], addresses.number_and_name("a", ("SAMPLETON",))) == [("838 SAMPLE",)] * 2


def test_legal(spark):
    p = legal.parse_legal("a")
    assert values(spark, ["LOT 9 BLOCK 2 SAMPLE UNIT TWO ADDITION", None], p["subdivision"], p["lot"], p["block"]) == [("sample unit 2", "9", "2"), ("", "", "")]
    pairs = [("SAMPLE LOT 1 BLK 2", "SAMPLE LOT 1 BLK 2"), ("SAMPLE LOT 1 BLK 2", "SAMPLE LOT 2 BLK 2"), ("UNIT 1 LOT 1", "UNIT 1 LOT 1"), ("SAMPLES LOT 1", "SAMPLE LOT 1 BLK 9")]
    m = legal.legals_match(legal.parse_legal("a"), legal.parse_legal("b"))
    back = legal.legals_match(legal.parse_legal("b"), legal.parse_legal("a"))
    assert values(spark, pairs, m, back) == [(True, True), (False, False), (False, False), (True, True)]
    assert [v[0] for v in values(spark, ["15 THRU 17", "122&123", "18 & 19", ""], F.array_join(legal.expand_lots("a"), ","))] == ["15,16,17", "122,123", "18,19", ""]
    lots = legal.lot_blocks_match(legal.lot_block("a"), legal.lot_block("b"))
    assert values(spark, [("LOT 14 BLK 1", "LTS 14 & 15 BLK 1"), ("LOT 14 BLK 2", "LOT 14 BLK 1"), ("LOT 14", "LOT 14 BLK 1")], lots) == [(True,), (False,), (True,)]
    assert values(spark, [("OAK HILLS LOT 1", "PINE GROVE LOT 1"), ("OAK HILLS LOT 1", "OAK EST LOT 1"), ("", "X")], legal.subdivisions_conflict("a", "b")) == [(True,), (False,), (False,)]


def test_dates(spark):
    texts = ["December 16th, 2024", "5/8/2018", "TBD", "13/45/2024", "1/2/49", "1/2/50", "16th of December, 2024", "2024-02-30"]
    assert [v[0] for v in values(spark, texts, dates.prose_date("a"))] == ["2024-12-16", "2018-05-08", "TBD", "13/45/2024", "2049-01-02", "1950-01-02", "2024-12-16", "2024-02-30"]
    assert [v[0] for v in values(spark, ["20240102", "01/02/24", "2024-01-02T03:04:05Z", "x", None], dates.coerce_date("a"))] == ["2024-01-02"] * 3 + ["", ""]
    assert spark.range(1).select(dates.date_of_epoch(F.lit(1704153600000))).first()[0] == "2024-01-02"
    assert [v[0] for v in values(spark, ["2019DCV-1-A", "00-00001-00-0-C", "93-00001-00-0-G", ""], dates.case_year("a"))] == [2019, 2000, 1993, 1990]
    assert spark.range(1).select(dates.serial_date(F.lit(45292))).first()[0] == "2024-01-01"


def test_money(spark):
    assert [v[0] for v in values(spark, ["2026011900", "total $1,200.50 and $3", "0.50 due $0.50", None], money.amount_in("a"))] == [None, 1200.5, None, None]
    assert [v[0] for v in values(spark, ["12300040050", "1", "", "99912300040050"], money.account("a"))] == ["0123-0004-0050", "0000-0000-0001", "", "9123-0004-0050"]
    assert [r[0] for r in spark.createDataFrame([(250.0,), (350.0,)], "x double").select(money.to_hundreds("x")).collect()] == [200, 400]


def test_codes(spark):
    assert [v[0] for v in values(spark, ["25,24,23,22", "0", None], codes.delinquent_years("a"))] == [[25, 24, 23, 22], [], []]
    assert values(spark, ["A ×2 · B", ""], codes.expand_types("a")) == [(["A", "A", "B"],), ([],)]
    assert values(spark, ["[A] x  •  [B] y  •  [A] z"], codes.narrative_pairs("a")) == [({"A": "x", "B": "y"},)]
    assert [v[0] for v in values(spark, ["RELEASE OF LIS PENDENS", "LIS PENDENS", "HOSPITAL LIEN", "LIEN", "DEED"], codes.category("a"))] == ["RELLP", "LP", "HL", "LN", None]
    assert values(spark, ["filth, carrion and weeds"], codes.reason_tags("a")) == [(["carrion", "filth", "weeds"],)]


@pytest.mark.parametrize("code,short,long", [("A1", "Single-family", "Single-family"), ("B2", "Multifamily", "Multifamily"), ("C1", "Vacant lot", "Vacant lot"), ("F2", "F2", "Industrial"), ("", "Unknown", "")])
def test_class_labels(spark, code, short, long):
    assert values(spark, [code], codes.class_label("a"), codes.class_label_long("a")) == [(short, long)]


def test_kinds_and_agencies(spark):
    got = values(spark, ["SAMPLE BANK NA", "", "DOE ALEX", "NUECES CTY", "Port of Corpus Christi", "STATE OF TEXAS", "STATE OF MIND", "HUD", "HUDSON"], owners.not_worth_looking_up("a"), owners.agency("a"))
    assert [a for _, a in got] == [False, False, False, True, True, True, False, True, False] and [w for w, _ in got[:3]] == [True, True, False]
    assert values(spark, ["individual", "other"], owners.kind_label("a"))[1] == ("other",)
    assert [v[0] for v in values(spark, ["12 OAK", "OAK", None], addresses.is_spelled_out("a"))] == [True, False, False]


def test_keep_or_fill(spark):
    from parcelwright.functions.base import keep_or_fill

    assert [v[0] for v in values(spark, [("a", "b"), (" ", "b"), (None, None)], keep_or_fill("a", "b"))] == ["a", "b", None]


def test_house_numbers_of_five_digits(spark):
    loose = addresses.number_and_name("a", ("SAMPLETON",))
    told = ["10838 SAMPLE AVE, SAMPLETON TX 90001", "10838 Sample Ave", "10838 SAMPLE, SAMPLETON TX 90001-1234", "90001"]
    assert [v[0] for v in values(spark, told, loose)] == ["10838 SAMPLE"] * 3 + [""]
