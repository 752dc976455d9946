from pyspark.sql import functions as F

from parcelwright.operators import joins, merge, ranking, scoring, state, summary


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]


def test_score_of_a_recent_lis_pendens(spark):
    lead = spark.createDataFrame([("LP", "LIS PENDENS", "DOE ALEX", "2024-01-01", None, "")], "cat string, doc_type string, owner string, filed string, amount double, prop_address string")
    got = scoring.score_leads(lead, "2024-01-04").first()
    assert (got.score, got.flags) == (55, ["Lis pendens", "New this week"])


def test_score_combination_and_bounds(spark):
    data = [(c, "X", "SAMPLE TRUST", "2020-01-01", 200_000.0, "1 SAMPLE ST") for c in ("LP", "NOFC")] + [("LP", "X", "", "2020-01-01", 60_000.0, None)]
    leads = spark.createDataFrame(data, "cat string, doc_type string, owner string, filed string, amount double, prop_address string")
    assert sorted(r.score for r in scoring.score_leads(leads, "2024-01-04").collect()) == [50, 90, 90]


def test_two_tier_guard(spark):
    parcels = spark.createDataFrame([("p1", "A1", ["1", "N", "OAK"], 1), ("p2", "C1", ["1", "S", "OAK"], 2), ("p3", "A1", ["2", "N", "ELM"], 3)], "prop_id string, cls string, words array<string>, pos int")
    asked = spark.createDataFrame([(1, ["1", "N", "OAK"]), (2, ["1", "OAK"]), (3, ["2", "ELM"])], "id int, words array<string>")
    got = rows(joins.two_tier(asked, joins.parcel_index(parcels)).select("id", "tier", "prop_id"))
    assert got == [(1, "full", "p1"), (3, "noprefix", "p3")]  # 2 is unclear: its two parcels differ in class


def test_majority_and_variants(spark):
    c = spark.createDataFrame([(1, "B2", 2), (1, "A1", 1), (1, "", 0), (2, "A1", 1), (2, "B2", 2), (2, "B2", 3)], "id int, cls string, pos int")
    assert rows(joins.majority(c, "id", "cls", "pos")) == [(1, "A1"), (2, "B2")]
    leads = spark.createDataFrame([(1, ["X", "Y"]), (2, ["Z"])], "lead_id int, variants array<string>")
    ref = spark.createDataFrame([("Y", 7), ("Y", 8)], "name string, parcel int")
    assert rows(joins.first_variant(leads, "variants", ref, "name").select("lead_id", "variant_pos", "parcel")) == [(1, 1, 7), (1, 1, 8)]


def test_merges(spark):
    s = spark.createDataFrame([("1", "a", 5.0), ("2", "", 0.0)], "k string, t string, n double")
    n = spark.createDataFrame([("2", "b", 0.0), ("3", "c", 1.0), ("1", "", None)], "k string, t string, n double")
    assert rows(merge.insert_if_absent(s, n, "k")) == [("1", "a", 5.0), ("2", "", 0.0), ("3", "c", 1.0)]
    assert rows(merge.overwrite_if_filled(s, n, "k").select("k", "t", "n")) == [("1", "a", 5.0), ("2", "b", 0.0), ("3", "c", 1.0)]
    assert rows(merge.fill_blanks(n, s, "k", ["t", "n"])) == [("1", "a", 5.0), ("2", "b", 0.0), ("3", "c", 1.0)]


def test_foreclosure_upsert_carries_and_never_shrinks(spark):
    s = spark.createDataFrame([("1", "x", "2024-03-01"), ("2", "y", "2023-01-01"), ("3", "z", "")], "k string, t string, sale_date string")
    n = spark.createDataFrame([("4", "", "2024-02-01")], s.schema)
    got = rows(merge.upsert_foreclosures(s, n, "k", ["t"], "2024-01-01").select("k", "status", "days_until_sale"))
    assert got == [("1", "pre", 60), ("3", "pre", None), ("4", "pre", 31)]
    assert merge.upsert_foreclosures(s, n.limit(0), "k", ["t"], "2024-01-01").count() == 3


def test_field_policy(spark):
    r = spark.createDataFrame([("1", "old", "addr", "keep", False), ("2", "", "", "keep", False)], "k string, doc string, shared string, guarded string, processed boolean")
    e = spark.createDataFrame([("1", "new", "other", "no"), ("2", "new", "other", "no")], "k string, doc string, shared string, guarded string")
    got = merge.by_policy(r, e, "k", owned=["doc"], shared=["shared"])
    assert rows(got) == [("1", "new", "addr", "keep", True), ("2", "new", "other", "keep", True)]
    assert rows(merge.by_policy(got, e, "k", owned=["doc"], shared=["shared"]))[0][2] == "other"  # it was read before


LEDGER = "ref_no string, pos long, prop_id string, case_type string, cited string, lat double, lng double, state string"
REPORT = "ref_no string, pos long, prop_id string, case_type string, cited string, is_open boolean, passes boolean, lat double, lng double"


def test_ledger(spark):
    empty = spark.createDataFrame([], LEDGER)
    report = spark.createDataFrame(
        [("a", 1, "p", "T", "d1", True, True, 1.0, 2.0), ("a", 2, "p", "U", "d2", True, True, None, None), ("b", 3, "p", "T", "d", True, True, None, None), ("b", 4, "p", "T", "d", False, True, None, None), ("c", 5, "p", "T", "d", False, False, None, None), ("d", 6, "p", "T", "d", True, False, None, None)],
        REPORT,
    )
    once = state.ledger_merge(empty, report.where("pos = 1"))
    out = state.ledger_merge(once, report.where("pos > 1"))
    assert rows(out.select("ref_no", "state", "case_type", "lat"), "ref_no") == [("a", "open", "U", 1.0), ("b", "closed", "T", None), ("c", "closed", None, None)]
    assert rows(state.ledger_merge(out, report.where("pos > 1")), "ref_no") == rows(out, "ref_no")


def test_months(spark):
    data = [("x", "2024-01", 10.0), ("x", "2024-01", 10.0), ("x", "2024-01", 5.0), ("y", "2024-01", 1.0), ("y", "2024-03", 2.0), ("z", "2024-02", 3.0)]
    months = state.case_months(spark.createDataFrame(data, "case_id string, period string, balance double"))
    assert rows(months)[0] == ("x", "2024-01", 15.0)
    got = rows(state.monthly_state(months).select("case_id", "status", "claimed_month", "balance"))
    assert got == [("x", "claimed", "2024-02", 15.0), ("y", "active", None, 2.0), ("z", "claimed", "2024-03", 3.0)]
    assert rows(state.month_rollup(months)) == [("2024-01", 2, 16.0, 2, 0, 0), ("2024-02", 1, 3.0, 1, 0, 2), ("2024-03", 1, 2.0, 0, 1, 1)]


def test_property_summary(spark):
    c = spark.createDataFrame(
        [("p", "r1", "A", "n", "2024-01-01", 1, None, None), ("p", "r2", "B", "", "2024-02-01", 2, 1.5, None), ("p", "r3", "A", "n", "2024-01-01", 3, 9.0, 2.5), ("", "r4", "A", "", "", 4, None, None)],
        "prop_id string, ref_no string, case_type string, narrative string, cited string, pos int, lat double, lng double",
    )
    r = summary.property_summary(c).collect()
    assert len(r) == 1
    assert tuple(r[0]) == ("p", 3, "r2, r1, r3", "3 cases: r2, r1, r3", "r2", "2024-02-01", "A ×2 · B", "[A] n", 1.5, 2.5)


def test_ranking(spark):
    df = spark.createDataFrame([("k", i, h) for i, h in enumerate([True, False, False, True, False])], "k string, i int, hit boolean")
    assert [r.streak for r in ranking.miss_streaks(df, ["k"], F.col("hit"), "i").orderBy("i").collect()] == [0, 1, 2, 0, 1]
    c = spark.createDataFrame([("a", 1, False), ("b", 1, False), ("b", 2, True)], "k string, pos int, ok boolean")
    assert rows(ranking.single_or_confirmed(c, ["k"], F.col("ok"), "pos")) == [("a", 1, False), ("b", 2, True)]


def test_reference_join_broadcasts_and_match_has_no_nested_loop(spark):
    from parcelwright.plans import entity_queries

    plan = entity_queries.legal_match(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert "BroadcastHashJoin" in entity_queries.proptype_lookup(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()


def written(folder, **tables):
    """A folder of small tables, and DuckDB's views of them."""
    import duckdb
    import pandas as pd

    con = duckdb.connect()
    for name, columns in tables.items():
        pd.DataFrame(columns).to_parquet(f"{folder}/{name}.parquet")
        con.execute(f"create view {name} as select * from read_parquet('{folder}/{name}.parquet')")
    return con


def test_unique_match_counts_all_rows_of_a_lead(spark, tmp_path):
    from parcelwright.plans import entity_queries as E

    # Two rows of one lead: a lot of one parcel, and a lot of two; and a lead with one row on a lot of one parcel.
    part = {"p_partkey": [0, 300, 600], "p_name": ["oak"] * 3, "p_type": ["LARGE"] * 3, "p_size": [7, 7, 8], "p_retailprice": [1.0] * 3}
    items = {"l_orderkey": [1, 1, 2], "l_linenumber": [1, 1, 1], "l_suppkey": [0, 0, 0], "l_partkey": [0, 0, 0], "l_quantity": [8.0, 7.0, 8.0]}
    con = written(tmp_path, part=part, lineitem=items)
    want = con.execute(E.UNIQUE).fetchall()
    assert rows(E.unique_lot_match(spark, str(tmp_path))) == want == [(21, 600)]


def test_two_tier_vote_says_what_the_candidates_say(spark):
    parcels = spark.createDataFrame(
        [(n, c, n, w.split()) for n, c, w in [(1, "A1", "1 N OAK"), (2, "B2", "1 N OAK"), (3, "B2", "1 N OAK"), (4, "", "2 N ELM"), (5, "C1", "2 S ELM"), (6, "A1", "3 N ASH"), (7, "B2", "3 S ASH"), (8, "", "4 FIR"), (9, "B2", "5 YEW"), (10, "A1", "5 YEW")]],
        "prop_id long, cls string, pos long, words array<string>",
    )
    asked = spark.createDataFrame([(i, w.split()) for i, w in enumerate(["1 N OAK", "2 ELM", "3 ASH", "4 FIR", "5 YEW", "9 NONE", ""])], "id long, words array<string>")
    index = joins.parcel_index(parcels)
    hits = joins.two_tier(asked, index)
    vote = {r.id: r.cls for r in joins.majority(hits, "id", "cls", "pos").collect()}
    want = sorted((r.id, r.tier, r.n, vote.get(r.id, "")) for r in hits.groupBy("id", "tier").agg(F.count("*").alias("n")).collect())
    got = joins.two_tier_vote(asked, index)
    assert sorted(map(tuple, got.collect())) == want == [(0, "full", 3, "B2"), (1, "noprefix", 2, "C1"), (3, "full", 1, ""), (4, "full", 2, "B2")]
