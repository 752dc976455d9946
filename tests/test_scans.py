"""Scans of landed pages, versions that change together, stores, batches, mirrors."""

import json

import pytest
from pyspark.sql import functions as F

from parcelwright.operators import batches, scans, store
from parcelwright.sources import mirrors, published
from parcelwright.sources import scans as landed

ROW = "doc_num string, filed string, pos int"


def put(folder, rows):
    folder.mkdir(parents=True)
    (folder / "rows.json").write_text("\n".join(json.dumps(r) for r in rows))


def row(doc, filed="2024-01-05", pos=0):
    return {"doc_num": doc, "filed": filed, "pos": pos}


def walked(spark, pages, known=(), page_rows=2):
    rows = spark.createDataFrame([(1, n, d) for n, docs in pages.items() for d in docs], "scan int, page int, doc_num string")
    known = spark.createDataFrame([(d,) for d in known], "doc_num string") if known else None
    return [(r.page, r.why) for r in scans.pages_reached(rows, known, page_rows=page_rows).orderBy("page").collect()]


def test_where_a_walk_ends(spark):
    assert walked(spark, {1: "ab", 2: "cd", 3: "ef"}) == [(1, ""), (2, ""), (3, "")]
    assert walked(spark, {1: "ab", 2: "c", 3: "ef"}) == [(1, ""), (2, "short")]
    assert walked(spark, {1: "ab", 2: "ba", 3: "ef"}) == [(1, "")]
    assert walked(spark, {1: "ab", 2: "cd", 3: "ca", 4: "gh"}) == [(1, ""), (2, "")]
    assert walked(spark, {1: "ab", 3: "ef"}) == [(1, "")]
    assert walked(spark, {2: "ab"}) == []
    assert walked(spark, {1: "ab", 2: "cd", 3: "ef"}, known="cd") == [(1, ""), (2, "known")]
    assert walked(spark, {1: "ab", 2: "cd", 3: "ef"}, known="ab") == [(1, "known")]
    assert walked(spark, {1: ["", None], 2: "cd", 3: "e"}) == [(1, ""), (2, ""), (3, "short")]
    assert walked(spark, {}) == []


def test_categories(spark, tmp_path):
    put(tmp_path / "category=LP" / "alias=0" / "page=1", [row("1"), row("2", "1990-01-01"), row("3", "")])
    put(tmp_path / "category=LN" / "alias=0" / "page=1", [row("9", "1990-01-01")])
    put(tmp_path / "category=LN" / "alias=1" / "page=1", [row("1"), row("4", None, 1), row("", pos=2)])
    put(tmp_path / "category=LN" / "alias=2" / "page=1", [row("5")])
    put(tmp_path / "category=X" / "alias=0" / "page=1", [row("6")])
    rows = landed.read_categories(spark, str(tmp_path), ROW)
    out = scans.category_scan(rows, start="2024-01-01", end="2024-12-31", categories=["LP", "LN"])
    assert sorted((r.doc_num, r.category) for r in out.collect()) == [("1", "LP"), ("3", "LP"), ("4", "LN")]
    out = scans.category_scan(rows, start="2024-01-01", end="2024-12-31", categories=["LP", "LN"], specific={"LN": 1})
    assert sorted((r.doc_num, r.category) for r in out.collect()) == [("1", "LN"), ("3", "LP"), ("4", "LN")]


def test_filters_reach_the_reader(spark, tmp_path):
    put(tmp_path / "category=LP" / "alias=0" / "page=1", [row("1")])
    rows = landed.read_categories(spark, str(tmp_path), ROW)
    plan = rows.where(F.col("category").isin("LP", "LN") & scans.in_window("filed", "2024-01-01", "2024-12-31"))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(filed,2024-01-01)" in plan and "PartitionFilters: [category" in plan


def test_list_stream_goes_on_after_a_restart(spark, tmp_path):
    folder, out = tmp_path / "in", str(tmp_path / "out")

    def run():
        sink = landed.scan_sink(out, page_rows=2)
        landed.scan_stream(spark, str(folder), ROW).writeStream.foreachBatch(sink).option("checkpointLocation", str(tmp_path / "at")).trigger(availableNow=True).start().awaitTermination()
        return sorted((r.batch, r.doc_num) for r in spark.read.parquet(out).collect())

    for page, docs in {1: "ab", 2: "cd", 3: "e", 4: "fg"}.items():
        put(folder / "scan=1" / f"page={page}", [row(d) for d in docs])
    first = [(0, d) for d in "abcde"]
    assert run() == first  # page 3 is short, 4 is not reached
    assert run() == first
    for page, docs in {1: "xa", 2: "bc", 3: "yz"}.items():
        put(folder / "scan=2" / f"page={page}", [row(d) for d in docs])
    assert run() == [*first, (1, "x")]  # page 2 is known, 3 is not reached


def test_pair_of_outputs_changes_at_once(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "p")
    df = lambda *docs: spark.createDataFrame([(d,) for d in docs], "doc string")
    docs = lambda name: sorted(r.doc for r in published.published(spark, path, name).collect())
    assert published.published(spark, path, "list") is None
    assert published.publish({"list": df("a"), "export": df("a")}, path, guarded="list") == 1
    fails = df("b").select(F.raise_error(F.lit("between both")).cast("string").alias("doc"))
    with pytest.raises(Exception, match="between both"):
        published.publish({"list": df("b"), "export": fails}, path, guarded="list")
    assert docs("list") == docs("export") == ["a"]
    with pytest.raises(published.EmptyReplacement):
        published.publish({"list": df("a").limit(0), "export": df("c")}, path, guarded="list")
    assert docs("list") == docs("export") == ["a"]
    assert published.publish({"list": df("b", "c"), "export": df("c")}, path, guarded="list") == 2
    assert (docs("list"), docs("export")) == (["b", "c"], ["c"])
    # Two writers that both saw version 2: the later commit fails and changes nothing.
    last = published._last
    monkeypatch.setattr(published, "_last", lambda s, p: (1, last(s, p)[1]))
    with pytest.raises(OSError, match="already there"):
        published.publish({"list": df("z"), "export": df("z")}, path, guarded="list")
    monkeypatch.undo()
    assert docs("list") == ["b", "c"]


def test_foreclosures_are_published_in_order(spark, tmp_path):
    rows = [("3", "post", "2024-01-01", -5), ("1", "pre", "2024-02-06", 30), ("2", "pre", "2024-02-06", None), ("4", "pre", "2024-02-06", 2)]
    records = spark.createDataFrame([(*r, 0.0) for r in rows], "doc_num string, status string, sale_date string, days_until_sale int, loan_amount double")
    for c in ("doc_type", "recorded", "legal", "owner", "clerk_url"):
        records = records.withColumn(c, F.lit(""))
    path = str(tmp_path / "f")
    assert published.publish_foreclosures(records, path) == 1
    assert sorted(r.doc_num for r in published.published(spark, path, "list").collect()) == ["1", "2", "3", "4"]
    assert tuple(published.published(spark, path, "totals").first()) == (4, 3, 1)
    assert published.published(spark, path, "export").count() == 4


def test_a_list_keeps_the_keys_of_its_envelope(spark, tmp_path):
    path = str(tmp_path / "l")
    df = lambda *a: spark.createDataFrame([(x,) for x in a], "address string")
    counts = {"with_address": F.count_if(F.col("address") != "")}
    published.publish_list(df("1 OAK", ""), path, counts=counts, source=F.lit("clerk"), fetched_at=F.lit("monday"))
    assert published.published(spark, path, "envelope").first().asDict() == {"total": 2, "with_address": 1, "source": "clerk", "fetched_at": "monday"}
    published.publish_list(df("", "", "x"), path, counts=counts, fetched_at=F.lit("tuesday"))
    assert published.published(spark, path, "envelope").first().asDict() == {"total": 3, "with_address": 1, "source": "clerk", "fetched_at": "tuesday"}
    assert published.published(spark, path, "records").count() == 3


def test_store(spark):
    rows = [("A", 6, "1 OAK", "5"), ("B", 5, "2 OAK", "0"), ("C", 5, "", ""), ("D", 2, "3 OAK", "5"), ("E", 6, None, None), ("ccln_addr::x", None, "", None), (None, 6, "9 OAK", "1")]
    held = spark.createDataFrame(rows, "key string, version int, site_addr string, appraised_value string")
    asked = spark.createDataFrame([(k,) for k in ("A", "A", "B", "C", "D", "E", "ccln_addr::x", "", None)], "key string")
    want = {"A": None, "B": "lacks appraised_value", "C": "new", "D": "new", "E": None, "ccln_addr::x": None}
    assert {r.key: r.reason for r in store.to_ask(asked, held, fields=["appraised_value"]).collect()} == want
    assert {r.key: r.reason for r in store.to_ask(asked, held, fields=["appraised_value"], retry_misses=True).collect()} == want | {"E": "miss", "ccln_addr::x": "miss"}
    new = spark.createDataFrame([("A", 1, "", "7"), ("B", 1, "8 OAK", "7"), ("B", 0, "7 OAK", "6"), ("N", 0, None, None)], "key string, pos int, site_addr string, appraised_value string")
    got = {r.key: (r.version, r.site_addr) for r in store.merged(held, new, ["site_addr", "appraised_value"]).where("key is not null").collect()}
    assert got == {"A": (6, "1 OAK"), "B": (6, "8 OAK"), "E": (6, None), "N": (6, None), "ccln_addr::x": (None, "")}


@pytest.mark.parametrize("n,size,bucket", [(0, 5, 3), (1, 5, 3), (23, 5, 4), (40, 10, 1_000)])
def test_batches_are_full_and_without_gaps(spark, n, size, bucket):
    rows = spark.range(n).select(F.concat(F.lit("u"), "id").alias("uid"), F.col("id").alias("batch_no"), F.lit("x").alias("street"))
    got = batches.batched(rows.unionByName(rows).unionByName(spark.createDataFrame([(None, 1, "y")], "uid string, batch_no long, street string")), size=size, bucket=bucket).collect()
    assert sorted(r.number for r in got) == list(range(n)) and all(r.batch == r.number // size for r in got)
    assert len({r.uid for r in got}) == n


def test_answers_count_in_their_own_batch(spark):
    held = spark.createDataFrame([(0, "a"), (0, "b"), (1, "c"), (1, "d")], "batch long, uid string")
    says = [(0, "a", "Match", "-97.5,27.5"), (0, "a", "Match", "x,1"), (0, "b", "Tie", "-1,1"), (0, "c", "Match", "-1,1"), (1, "c", "Match", "1"), (1, "d", "Match", "-2,2"), (1, "d", "Match", "-2,2"), (None, None, "Match", "0,0")]
    answers = spark.createDataFrame(says, "batch long, uid string, match string, lon_lat string")
    got = {r.uid: (r.lat, r.lon) for r in batches.answered(held, answers).collect()}
    assert got == {"a": (27.5, -97.5), "b": (None, None), "c": (None, None), "d": (2.0, -2.0)}


def test_first_readable_copy(spark, tmp_path):
    broken, good = tmp_path / "broken.json", tmp_path / "good.json"
    broken.write_text('{"records": [')
    good.write_text('{"source": "s", "records": [{"a": 1}]}')
    files = mirrors.copies(spark, [str(tmp_path / "none.json"), str(broken), str(good)])
    got = mirrors.first_readable(files).collect()
    assert [(r.rank, r.envelope, r.records) for r in got] == [(2, {"source": "s"}, ['{"a":1}'])]
    assert mirrors.first_readable(mirrors.copies(spark, [str(tmp_path / "none.json")])).collect() == []
    stored = mirrors.stored_again(F.col("envelope"), F.col("records"), fetched_at=F.lit("now"), source="other")
    assert json.loads(mirrors.first_readable(files).select(stored.alias("v")).first().v) == {"source": "s", "fetched_at": "now", "total": 1, "records": [{"a": 1}]}
