import gzip
import json

from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelwright.sources import html, readers, sinks
from parcelwright.streaming import ledger

RECORD = T.StructType([T.StructField("doc_num", T.StringType()), T.StructField("amount", T.DoubleType())])


def test_envelopes(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"total": 1, "records": [{"doc_num": "1", "amount": 2.0}]}))
    (tmp_path / "b.json").write_text(json.dumps([{"doc_num": "2", "other": 3}]))
    (tmp_path / "c.json").write_text("{broken")
    got = readers.read_envelope(spark, str(tmp_path), RECORD).orderBy("doc_num").collect()
    assert [tuple(r) for r in got] == [("1", 2.0), ("2", None)]


def test_reference_and_fixed_width(spark, tmp_path):
    with gzip.open(tmp_path / "r.csv.gz", "wt", encoding="utf-8-sig") as f:
        f.write("prop_id|situs_num\n 7 |\n")
    assert [tuple(r) for r in readers.read_reference(spark, str(tmp_path / "r.csv.gz")).collect()] == [("7", "")]
    (tmp_path / "x.txt").write_bytes("0001TÉF \n0002FT \n".encode("latin-1"))
    df = readers.read_fixed_width(spark, str(tmp_path / "x.txt"), {"geo": (1, 4), "HS": (5, 5), "OV65": (7, 7)})
    assert [tuple(r) for r in readers.exemptions_of(df, "geo", ["HS", "OV65"]).collect()] == [("0001", "HS")]


def test_headers():
    readers.check_header(["ACCOUNT #", "2026 CURR LEVY BAL"], {0: "account #"}, {1: "CURR LEVY BAL"})
    try:
        readers.check_header(["X"], {0: "ACCOUNT #"})
    except ValueError as e:
        assert "column 0" in str(e)
    else:
        raise AssertionError


def test_report_and_cache(spark):
    lines = spark.createDataFrame([("f", 1, "2019DCV-1-A  Sample County vs Alex  $1,200.50"), ("f", 2, "   Doe, et al"), ("f", 3, "Page 1"), ("f", 4, "00-00001-00-0-C X vs Y 3.00")], "file string, pos int, value string")
    got = readers.report_rows(lines).orderBy("case_number").collect()
    assert [tuple(r)[1:] for r in got] == [("00-00001-00-0-C", "X vs Y", 3.0), ("2019DCV-1-A", "Sample County vs Alex Doe, et al", 1200.5)]
    cache = spark.createDataFrame([(6, False), (5, True), (4, False), (1, True)], "version int, hit boolean")
    assert readers.usable_cache(cache).count() == 2


def test_html(spark):
    page = "<table><tr><th>Doc Number</th><th>Party</th></tr><tr><td>1</td><td>N/A</td></tr></table><a href='/x'>Go  <b>on</b></a><dl><dt>Situs:</dt><dd>1 Sample St</dd></dl>"
    r = spark.createDataFrame([(page,), (None,)], "h string").select(html.table_rows("h").alias("t"), html.links("h").alias("l"), html.label_pairs("h").alias("p")).collect()
    assert r[0].t == [{"doc_number": "1"}] and r[0].l[0].href == "/x" and r[0].l[0].text == "Go on" and r[0].p == {"Situs": "1 Sample St"}
    assert r[1].t == [] and r[1].l == []


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("1", None)], "doc_num string, owner string")
    assert not sinks.write_records(df.limit(0), str(tmp_path / "no"))
    sinks.write_envelope(df, str(tmp_path / "e"), source=F.lit('sa"mple'))
    text = "".join(p.read_text() for p in (tmp_path / "e").glob("part-*"))
    assert json.loads(text) == {"total": 1, "source": 'sa"mple', "records": [{"doc_num": "1", "owner": None}]}
    crm = sinks.crm_rows(spark.createDataFrame([(1.5, ["a", "b"])], "amount double, flags array<string>")).first()
    assert crm["Amount/Debt Owed"] == "1.50" and crm["Motivated Seller Flags"] == "a | b" and len(crm) == 19


REPORT = "ref_no string, pos long, prop_id string, case_type string, cited string, is_open boolean, passes boolean, lat double, lng double"


def test_ledger_stream_equals_batch(spark, tmp_path):
    from parcelwright.operators.state import ledger_merge

    data = [(f"r{i % 7}", i, "p", "T", f"d{i}", i % 3 != 0, i % 5 != 0, float(i) if i % 4 == 0 else None, None) for i in range(60)]
    df = spark.createDataFrame(data, REPORT)
    for n, cut in enumerate([(0, 20), (20, 45), (45, 60)]):
        df.where(f"pos >= {cut[0]} and pos < {cut[1]}").coalesce(1).write.parquet(str(tmp_path / "in" / f"batch{n}"))
    stream = spark.readStream.schema(REPORT).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(str(tmp_path / "in"))
    q = ledger.ledger_stream(stream).writeStream.outputMode("update").foreachBatch(lambda b, n: b.write.mode("overwrite").parquet(str(tmp_path / "out" / f"n={n}"))).option("checkpointLocation", str(tmp_path / "cp")).start()
    q.processAllAvailable()
    q.stop()
    got = spark.read.parquet(str(tmp_path / "out")).groupBy("ref_no").agg(F.max_by(F.struct("state", "prop_id", "case_type", "cited", "lat"), "n").alias("s")).select("ref_no", "s.*")
    empty = spark.createDataFrame([], "ref_no string, pos long, prop_id string, case_type string, cited string, lat double, lng double, state string")
    want = ledger_merge(empty, df).select("ref_no", "state", "prop_id", "case_type", "cited", "lat")
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_month_stream_equals_batch(spark, tmp_path):
    from parcelwright.operators.state import case_months, monthly_state

    df = spark.createDataFrame([("x", "2024-01", 1.0), ("y", "2024-01", 2.0), ("y", "2024-02", 3.0)], "case_id string, period string, balance double")
    take = ledger.month_sink(str(tmp_path / "m"), str(tmp_path / "o"))
    take(df.where("period = '2024-01'"), 0)
    take(df.where("period = '2024-02'"), 1)
    take(df.where("period = '2024-02'"), 1)
    got = spark.read.parquet(str(tmp_path / "o" / "batch=1"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, monthly_state(case_months(df)).select(got.columns).collect()))


def test_table_rows_of_another_width(spark):
    page = "<table><tr><th>Name</th><th>Type</th><th>No</th></tr><tr><td>a</td><td>x</td><td>1</td></tr><tr><td colspan=3>b</td></tr><tr><td>c</td><td>y</td><td>3</td></tr></table><table><tr><th>Name</th><th>Use</th><th>Lot</th></tr><tr><td>d</td><td>z</td><td>4</td></tr></table>"
    got = spark.createDataFrame([(page,)], "h string").select(html.table_rows("h").alias("t")).first().t
    assert got == [{"name": "a", "type": "x", "no": "1"}, {"name": "b"}, {"name": "c", "type": "y", "no": "3"}, {"name": "d", "use": "z", "lot": "4"}]


def test_envelopes_keep_their_keys_and_stores_are_swapped(spark, tmp_path):
    from pyspark.sql import functions as F

    from parcelwright.sources import sinks

    stored = spark.createDataFrame([("x", 9, "2020-01-01")], "source string, total long, updated string")
    records = spark.createDataFrame([(1, 2.5, "open"), (2, 3.25, "closed")], "id int, total_owed double, status string")
    row = sinks.with_envelope(stored, records, updated=F.lit("2024-05-06")).first()
    assert (row.source, row.total, row.updated, sorted(r.id for r in row.records)) == ("x", 2, "2024-05-06", [1, 2])
    assert tuple(sinks.delinquent_totals(records, ("B", "A")).first()) == (2, 5.75, ["A", "B"])
    assert tuple(sinks.ledger_totals(records).first()) == (1, 2)
    path = str(tmp_path / "store")
    sinks.replaced(records, path)
    sinks.replaced(spark.read.json(path).where("id = 2"), path)  # reads the rows that it replaces
    assert [r.id for r in spark.read.json(path).collect()] == [2]
    assert sorted(p.name for p in tmp_path.iterdir()) == ["store"]


def test_payload_values():
    from parcelwright.sources import payloads as p

    assert p.as_text({"fullName": " A ", "x": 1}) == "A" and p.as_text({"x": 1, "y": [2, None]}) == "x=1, y=2" and p.as_text(None) == ""
    assert p.names_joined(["A", "", {"name": "B"}]) == "A; B" and p.names_joined("A") == "A"
    assert p.hydrated_state("window.__data = {'") is None and p.hydrated_state(None) is None and p.cards("") == []


def test_a_plan_is_written_only_with_the_switch(spark, tmp_path):
    from parcelwright.sources.sinks import applied

    path = str(tmp_path / "store")
    plan = spark.createDataFrame([(1, "a")], "id long, v string")
    assert applied(plan, path).count() == 1 and not (tmp_path / "store").exists()
    applied(plan, path, apply=True)
    applied(plan.limit(0), path, apply=True)  # an empty plan leaves what is stored
    assert [tuple(r) for r in spark.read.json(path).select("id", "v").collect()] == [(1, "a")]


def test_sheets_without_a_header_are_named(spark):
    from parcelwright.sources.readers import by_header, without_header

    rows = [("a", 0, ["Ref No", "Status", "Case Type"]), ("a", 1, ["CE1", "New", "X"]), ("b", 0, ["Ref No", "Status"]), ("b", 1, ["CE2", None, "Y"])]
    sheet = spark.createDataFrame(rows, "file string, pos int, cells array<string>")
    found = by_header(sheet)
    assert [(r.file, r.ref_no, r.address) for r in found.collect()] == [("a", "CE1", "")]
    assert [r.file for r in without_header(sheet, found).collect()] == ["b"]


def test_pages_that_cannot_be_read_give_nothing(spark):
    from parcelwright.sources import parcel_pages as P

    pages = spark.createDataFrame([(None,), ("",), ("<table><tr><td class=_ownerName",), ("<dl><dt>Mail</dt></dl>",)], "page string")
    out = pages.select(P.search_rows("page").alias("rows"), P.detail("page").alias("d")).select("rows", P.page_record("d", city="X").alias("r"), P.page_mail("d").alias("m"), P.page_legal("d").alias("l"))
    assert all(not r.rows and r.r is None and r.m is None and r.l == "" for r in out.collect())


def test_blank_notices_give_blank_fields(spark):
    from parcelwright.operators.extraction import notice_fields

    out = notice_fields(spark.createDataFrame([(None, 1), ("", 2), ("x" * 50_000, 3)], "text string, lender long")).collect()
    assert all(r.owner == r.lender == r.prop_address == r.legal_lot == "" and r.loan_amount is None and not r.has_loan_mod for r in out)


def test_rolls_newest_files_and_notices(spark, tmp_path):
    import os

    from parcelwright.functions.money import document_number

    df = spark.createDataFrame([(" 7 ", 12.0, 1.5, None)], "a string, b double, c double, d string")
    assert tuple(readers.read_roll(df, {0: "account", 1: "levy", 2: "rate", 3: "owner"}).first()) == ("7", "12", "1.5", "")
    for name, at in {"roll 01-31-2024.txt": 1, "roll 12-01-2023.txt": 2, "roll.txt": 3}.items():
        (tmp_path / name).write_text(name)
        os.utime(tmp_path / name, (at, at))
    assert readers.newest(spark, str(tmp_path)).replace("%20", " ").endswith("roll 01-31-2024.txt")
    assert readers.newest(spark, str(tmp_path), "roll.txt").endswith("roll.txt")
    notices = tmp_path / "notices"
    notices.mkdir()
    (notices / "2024000001 x.txt").write_text("a\nb")
    (notices / "none.txt").write_text("c")
    got = sorted((r.doc_num, r.text) for r in readers.read_notices(spark, str(notices)).collect())
    assert got == [("", "c"), ("2024000001", "a\nb")]
    names = spark.createDataFrame([("/x/2024000001.txt",), ("20240000012",), (None,)], "n string")
    assert [r[0] for r in names.select(document_number("n")).collect()] == ["2024000001", "", ""]


def test_run_log(spark):
    got = sinks.run_log(spark.createDataFrame([("matched",), ("matched",), (None,)], "result string")).collect()
    assert {r.result: r.n for r in got} == {"matched": 2, None: 1}
