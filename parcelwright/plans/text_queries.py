"""Single functions and record projections over rendered texts: the oracle knows what was rendered."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import addresses, codes, dates, legal, money
from ..functions import owners as names
from ..operators import merge, ranking, records, state, summary
from ..sources import sinks
from .views import spread, table, view, with_views

QUERIES: dict = {}
ORACLES: dict = {}


def query(oracle: str):  # noqa: ANN201
    def add(f):  # noqa: ANN001, ANN202
        QUERIES[f.__name__] = f
        ORACLES[f.__name__] = oracle
        return f

    return add


def s(c: Column) -> Column:
    return c.cast("string")


def t(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 4 THEN 'TBD' ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS iso FROM orders")
def prose_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    d, k = F.col("o_orderdate"), F.col("o_orderkey") % 5
    raw = F.when(k == 0, F.date_format(d, "MMMM d, yyyy")).when(k == 1, F.date_format(d, "M/d/yyyy")).when(k == 2, t(F.date_format(d, "d"), "th of ", F.date_format(d, "MMMM, yyyy"))).when(k == 3, F.date_format(d, "yyyy-MM-dd")).otherwise("TBD")
    return table(spark, sf_dir, "orders").select("o_orderkey", dates.prose_date(raw).alias("iso"))


@query("SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN CAST(year(o_orderdate) AS INT) WHEN 1 THEN CAST(year(o_orderdate) AS INT) ELSE 1990 END AS case_year FROM orders")
def case_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    d, k = F.col("o_orderdate"), F.col("o_orderkey") % 3
    raw = F.when(k == 0, t(F.date_format(d, "yyyy"), "DCV-1-A")).when(k == 1, t(F.date_format(d, "yy"), "-00001-00-0-C")).otherwise("")
    return table(spark, sf_dir, "orders").select("o_orderkey", dates.case_year(raw).alias("case_year"))


@query("SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS from_serial, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS from_epoch FROM orders")
def number_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("o_orderdate").cast("date")
    serial = F.datediff(d, F.lit("1899-12-30").cast("date")) + 0.25
    seconds = F.datediff(d, F.lit("1970-01-01").cast("date")).cast("double") * 86400 + 3600
    epoch = F.when(F.col("o_orderkey") % 2 == 0, seconds).otherwise(seconds * 1000)
    return table(spark, sf_dir, "orders").select("o_orderkey", dates.serial_date(serial).alias("from_serial"), dates.date_of_epoch(epoch).alias("from_epoch"))


@query("SELECT c_custkey, 'Sample County' AS plaintiff, 'Casey Doe ' || c_custkey AS owner, c_custkey || ' Casey Doe' AS last_first FROM customer")
def suit_parties(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = s(F.col("c_custkey"))
    p = names.plaintiff_and_owner(F.when(F.col("c_custkey") % 2 == 0, t("Sample County vs. Casey Doe ", k, ", et al")).otherwise(t(" Sample  County,  VS Casey Doe ", k)))
    return table(spark, sf_dir, "customer").select("c_custkey", p["plaintiff"].alias("plaintiff"), p["owner"].alias("owner"), names.last_first(p["owner"]).alias("last_first"))


@query("SELECT c_custkey, c_custkey || ' SAMPLE ST' || CASE WHEN c_custkey % 2 = 0 THEN ' APT 2' ELSE '' END || CASE WHEN c_custkey % 3 = 0 THEN '' ELSE '  SAMPLETON, TX 90001' END AS mailing FROM customer")
def mailing_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    some = lambda v: F.when(k % 3 == 0, "").otherwise(v)
    m = addresses.mailing(t(s(k), " SAMPLE ST "), F.when(k % 2 == 0, " APT 2").otherwise(F.lit(None)), some("SAMPLETON"), some("TX"), some("90001"))
    return table(spark, sf_dir, "customer").select("c_custkey", m.alias("mailing"))


@query("""SELECT p_partkey, p_partkey % 3 < 2 AS lots_match, p_partkey % 3 < 2 AS agree, p_partkey % 5 = 0 AS conflict FROM part""")
def legal_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    n = s(k % 20 + 1)
    ours = t("OAK HILLS BLK 1 LOT ", n)
    theirs = F.when(k % 3 == 0, t("OAK HILLS BLK 1 LOT ", n)).when(k % 3 == 1, t("OAK HILLS LOTS ", n, " & 99")).otherwise(t("OAK HILLS BLK 2 LOT ", n))
    ours_other, other = t("MAPLE GROVE LOT ", n), F.when(k % 5 == 0, t("CEDAR RIDGE LOT ", n)).otherwise(t("MAPLE LOT ", n))
    lots = legal.lot_blocks_match(legal.lot_block(ours), legal.lot_block(theirs))
    agree = legal.legals_agree(ours, theirs)
    return table(spark, sf_dir, "part").select("p_partkey", lots.alias("lots_match"), agree.alias("agree"), legal.subdivisions_conflict(ours_other, other).alias("conflict"))


@query("""SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'no parcel' WHEN 1 THEN 'no legal' WHEN 2 THEN 'sparse legal' ELSE '' END AS skipped,
  CASE p_partkey % 3 WHEN 0 THEN 'match' WHEN 1 THEN 'mismatch' ELSE 'ambiguous' END AS verdict FROM part""")
def recheck_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    skipped = legal.can_be_checked(F.when(k % 4 == 0, "").otherwise(s(k)), F.when(k % 4 == 1, " ").when(k % 4 == 2, "SAMPLE").otherwise("SAMPLE LOT 1"))
    verdict = legal.verdict(F.lit("SAMPLE OAKS LOT 1 BLOCK 2"), F.when(k % 3 == 0, "OAKS SAMPLE LOT 1 BLK 2").when(k % 3 == 1, "SAMPLE OAKS LOT 3 BLK 2").otherwise("SAMPLE OAKS"))
    return table(spark, sf_dir, "part").select("p_partkey", skipped.alias("skipped"), verdict.alias("verdict"))


@query("""SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'SAMPLE LOT ' || p_size WHEN 1 THEN '' ELSE 'LOT 1 BLK 2' END AS cleaned, 'SAMPLE OAKS Lot ' || p_size || ' Block 2' AS composed FROM part""")
def thin_legal(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, n = F.col("p_partkey"), s(F.col("p_size"))
    raw = F.when(k % 3 == 0, t("SUIT # 2012DCV-4384-A, SAMPLE LOT ", n)).when(k % 3 == 1, "93-01244-00-0-G").otherwise(" LOT 1  BLK 2 -")
    return table(spark, sf_dir, "part").select("p_partkey", legal.clean_thin_legal(raw).alias("cleaned"), legal.compose_legal(F.lit("SAMPLE OAKS"), n, F.lit("2")).alias("composed"))


@query("""SELECT p_partkey, CAST(p_size AS DOUBLE) * 1000 AS money, CAST(p_size AS DOUBLE) * 1000 AS strict, CASE WHEN p_partkey % 2 = 0 THEN CAST(p_size AS BIGINT) * 1000 END AS whole, CASE WHEN p_partkey % 2 = 0 THEN CAST(p_size AS DOUBLE) * 1000 ELSE 0 END AS num FROM part""")
def money_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, n = F.col("p_partkey"), F.col("p_size")
    raw = t("$", s(n), ",000")
    other = F.when(k % 2 == 0, t(s(n), "000")).otherwise("n/a")
    return table(spark, sf_dir, "part").select("p_partkey", money.money(raw).alias("money"), money.strict_money(raw).alias("strict"), money.whole_money(other).alias("whole"), money.number(other).alias("num"))


@query("""SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN c_custkey || ' SAMPLE OAK PL' WHEN 1 THEN c_custkey || ' SAMPLE ST' END AS street, CASE c_custkey % 3 WHEN 0 THEN 'SAMPLETON' WHEN 1 THEN '' END AS city,
  CASE c_custkey % 3 WHEN 0 THEN '90001' WHEN 1 THEN '' END AS zip, c_custkey || ' SAMPLE OAK' AS loose, c_custkey || ' o sample dr' AS plain FROM customer""")
def address_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    found = addresses.address_in_text(F.when(k % 3 == 0, t(s(k), " Sample Oak Pl Sampleton TX 90001-1234")).when(k % 3 == 1, t(s(k), " sample st (corner)")).otherwise("LOT 4 SAMPLE ST"))
    loose = addresses.number_and_name(F.when(k % 2 == 0, t(s(k), " SAMPLE OAK AVE, SAMPLETON TX 90001")).otherwise(t(s(k), " Sample Oak Ave")), ("SAMPLETON",))
    plain = addresses.plain(F.when(k % 2 == 0, t(s(k), " O'Sample Dr.")).otherwise(t(s(k), "  O SAMPLE DR,")))
    return spread(table(spark, sf_dir, "customer"), "c_custkey").select("c_custkey", found["street"].alias("street"), found["city"].alias("city"), found["zip"].alias("zip"), loose.alias("loose"), plain.alias("plain"))


@query("""SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 'OLD SAMPLE,SAMPLE,OLD' ELSE 'SAMPLE' END AS names FROM customer""")
def street_fallbacks(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.when(F.col("c_custkey") % 2 == 0, "OLD SAMPLE").otherwise("SAMPLE")
    return table(spark, sf_dir, "customer").select("c_custkey", F.array_join(addresses.street_fallbacks(name), ",").alias("names"))


@query("""SELECT event_id, CASE event_id % 3 WHEN 0 THEN 'weeds,brush' WHEN 1 THEN 'carrion,filth' ELSE '' END AS tags, CASE event_id % 3 WHEN 0 THEN 'note' ELSE '' END AS narrative FROM events""")
def reason_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("event_id") % 3
    tags = codes.reason_tags(F.when(k == 0, "Brush and WEEDS").when(k == 1, "filth, carrion").otherwise(F.lit(None)))
    pairs = codes.narrative_pairs(F.when(k == 0, "[A] note  •  [B] other  •  [A] again").otherwise("plain"))
    return table(spark, sf_dir, "events").select("event_id", F.array_join(tags, ",").alias("tags"), F.coalesce(F.try_element_at(pairs, F.lit("A")), F.lit("")).alias("narrative"))


CHANGED = with_views("d_parcel") + """ SELECT prop_id, 'A' || prop_id AS old, 'B' || prop_id AS new FROM d_parcel WHERE prop_id % 4 = 0"""


@query(CHANGED)
def change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("prop_id")
    before = view(spark, sf_dir, "d_parcel").select("prop_id", t("A", s(k)).alias("account"))
    after = before.select("prop_id", F.when(k % 4 == 0, t("B", s(k))).otherwise(F.col("account")).alias("account"))
    return sinks.changes(before, after, "prop_id", "account")


@query(with_views("d_parcel") + """ SELECT prop_id, CASE WHEN prop_id % 2 = 0 THEN 'doc' ELSE 'old' END AS reason, CASE WHEN prop_id % 2 = 0 AND (prop_id % 3 = 0 OR prop_id % 5 = 0) THEN 'read' WHEN prop_id % 3 = 0 THEN '' ELSE 'stored' END AS address, prop_id % 2 = 0 OR prop_id % 5 = 0 AS processed FROM d_parcel""")
def field_policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("prop_id")
    rec = view(spark, sf_dir, "d_parcel").select("prop_id", F.lit("old").alias("reason"), F.when(k % 3 == 0, "").otherwise("stored").alias("address"), (k % 5 == 0).alias("processed"))
    doc = rec.where(k % 2 == 0).select("prop_id", F.lit("doc").alias("reason"), F.lit("read").alias("address"))
    return merge.by_policy(rec, doc, "prop_id", owned=["reason"], shared=["address"])


@query(with_views("d_parcel") + """, n AS (SELECT *, count(*) OVER (PARTITION BY owner_id, state_class) AS k FROM d_parcel)
SELECT owner_id, state_class, prop_id FROM n WHERE k = 1 OR prop_zip = '90001' QUALIFY row_number() OVER (PARTITION BY owner_id, state_class ORDER BY prop_id) = 1""")
def single_or_confirmed(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = view(spark, sf_dir, "d_parcel").select("owner_id", "state_class", "prop_id", "prop_zip")
    return ranking.single_or_confirmed(p, ["owner_id", "state_class"], F.col("prop_zip") == "90001", "prop_id").select("owner_id", "state_class", "prop_id")


@query(with_views("d_parcel") + """, b AS (SELECT * FROM d_parcel QUALIFY row_number() OVER (PARTITION BY owner_id ORDER BY (state_class = 'A1') DESC, prop_id) = 1) SELECT owner_id, prop_id FROM b WHERE prop_zip <> ''""")
def top_row_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = view(spark, sf_dir, "d_parcel")
    return ranking.best_if(p, ["owner_id"], F.col("prop_zip") != "", (F.col("state_class") == "A1").desc(), F.asc("prop_id")).select("owner_id", "prop_id")


@query("""SELECT CAST(o_orderkey AS VARCHAR) AS doc_num, CASE WHEN o_orderkey % 2 = 0 THEN 'LP' ELSE 'LNFED' END AS cat, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS filed, 'DOE ' || o_custkey AS owner,
  CASE WHEN o_orderkey % 2 = 0 THEN 'SAMPLE ROE' ELSE 'UNITED STATES OF AMERICA' END AS grantee, CASE WHEN o_orderkey % 3 = 0 THEN 1234.5 END AS amount, 'OAKS' || CASE WHEN o_orderkey % 3 = 0 THEN ' (Lot 4, Block 2)' ELSE '' END AS legal,
  CASE WHEN o_orderkey % 5 = 0 THEN 'https://sample.test/d/1' ELSE 'https://sample.test/results?department=RP&searchValue=' || o_orderkey END AS url FROM orders""")
def filing_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    even = k % 2 == 0
    pairs = {
        "DocNumber": s(k), "document type": F.when(even, "Lis Pendens").otherwise("FEDERAL TAX LIEN"), "recorded": F.date_format("o_orderdate", "MM/dd/yyyy"),
        "Grantor": F.when(even, t("DOE ", s(F.col("o_custkey")))).otherwise("UNITED STATES OF AMERICA"), "grantee1": F.when(even, "SAMPLE ROE").otherwise(t("DOE ", s(F.col("o_custkey")))),
        "legal": F.lit("Subdivision - Name: OAKS"), "lot": F.when(k % 3 == 0, "4"), "block": F.when(k % 3 == 0, "2"), "total": F.when(k % 3 == 0, "$1,234.50"), "url": F.when(k % 5 == 0, "d/1"),
    }
    rows = table(spark, sf_dir, "orders").select(F.create_map(*[x for n, v in pairs.items() for x in (F.lit(n), v)]).alias("fields"))
    return records.filings(rows, "https://sample.test").select("doc_num", "cat", "filed", "owner", "grantee", "amount", "legal", "url")


@query("""SELECT CAST(s_suppkey AS VARCHAR) AS uid, '1 SAMPLE ST, SAMPLETON TX 90001' AS prop_address, s_suppkey / 10 AS lat, -s_suppkey / 10 AS lon, CASE WHEN s_suppkey % 2 = 0 THEN '2024-01-02' ELSE '' END AS sale_date_only,
  CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE round(s_acctbal, 2) END AS minimum_bid, s_suppkey % 2 = 1 AS google_view_available FROM supplier WHERE s_suppkey % 7 <> 0""")
def tax_sale_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey")
    none = F.lit(None).cast("string")
    raw = table(spark, sf_dir, "supplier").select(
        F.when(k % 7 != 0, s(k)).alias("uid"), none.alias("sale_id"), none.alias("cause_nbr"), none.alias("account_nbr"), F.when(k % 2 == 0, "2024-01-02T10:00:00").alias("sale_date"), F.when(k % 4 == 1, "2024-09-09").alias("sale_date_only"),
        F.lit(1).alias("sale_nbr"), none.alias("sale_type"), none.alias("status"), none.alias("precinct"), F.lit("1 SAMPLE ST ").alias("prop_address_one"), F.lit(" ").alias("prop_address_two"), F.lit("SAMPLETON").alias("prop_city"),
        F.lit("TX").alias("prop_state"), F.lit("90001").alias("prop_zipcode"), none.alias("value"), F.when(k % 3 == 0, "").otherwise(s(F.round("s_acctbal", 2))).alias("minimum_bid"),
        F.struct(F.lit("Point").alias("type"), F.array(-k / 10, k / 10).alias("coordinates")).alias("geometry"), F.lit(None).cast("boolean").alias("has_photo"), F.when(k % 2 == 1, "y").alias("google_view"),
        none.alias("sale_notes"), none.alias("property_loc"), none.alias("county_sale_list"),
    )
    return records.tax_sales(raw).select("uid", "prop_address", "lat", "lon", "sale_date_only", "minimum_bid", "google_view_available")


@query("""SELECT c_custkey AS uid, CASE WHEN c_custkey % 2 = 0 THEN c_custkey || ' SAMPLE ST' ELSE '9 OTHER RD' END AS street, CASE WHEN c_custkey % 2 = 0 THEN 'SAMPLETON' ELSE '' END AS city, 'TX' AS state, CASE WHEN c_custkey % 2 = 0 THEN '' ELSE '90002' END AS zip FROM customer WHERE c_custkey % 4 <> 2""")
def address_fill_and_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    leads = table(spark, sf_dir, "customer").select(
        k.alias("uid"), F.when(k % 2 == 0, "").otherwise(" 9 OTHER RD").alias("prop_address"), F.lit("").alias("prop_city"), F.lit("").alias("prop_state"), F.when(k % 2 == 0, "").otherwise("90002-1111").alias("prop_zip"),
        F.when(k % 4 == 2, "LOT 1").otherwise(t(s(k), " Sample St")).alias("legal"),
    )
    return records.geocoder_query(records.fill_address(leads, "SAMPLETON"))


@query("""SELECT c_custkey || '-1' AS case_number, c_custkey * 10 + CASE WHEN c_custkey % 3 = 0 THEN 2 ELSE 1 END AS doc_num, CAST(CASE WHEN c_custkey % 3 = 0 THEN 5 ELSE 4 END AS INT) AS score FROM customer""")
def deed_pick(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    c = table(spark, sf_dir, "customer")
    suits = c.select(t(s(k), "-1").alias("case_number"), F.lit(2000).alias("case_year"), k.alias("owner"))
    deed = lambda n, grantor, legal_, recorded: c.select((k * 10 + n).alias("doc_num"), F.lit("SHERIFFS DEED").alias("doc_type"), F.lit(recorded).alias("recorded"), F.lit(grantor).alias("grantor"), legal_.alias("legal"), k.alias("owner"))
    cited = F.when(k % 3 == 0, t("SUIT ", s(k), "-1")).otherwise("NONE")
    deeds = deed(1, "SAMPLE SHERIFF", F.lit("x"), "2001-05-05").unionByName(deed(2, "DOE", cited, "2002-05-05")).unionByName(deed(3, "SAMPLE SHERIFF", cited, "1999-01-01"))
    return records.deed_of_suit(suits, deeds).select("case_number", "doc_num", "score")


@query("""SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'CASEY DOE' WHEN 1 THEN 'Casey Doe and Alex Roe' WHEN 2 THEN 'CASEY DOE III' ELSE 'SAMPLE HOMES, L.L.C.' END AS name,
  CASE c_custkey % 2 WHEN 0 THEN 'CASEY SUE DOE' ELSE 'Casey Doe' END AS primary_name, CASE c_custkey % 2 WHEN 0 THEN 'ALEX ROE' ELSE 'Robin Roe' END AS secondary_name,
  c_custkey % 3 = 0 AS lender, c_custkey % 3 = 1 AS legal, c_custkey % 3 = 2 AS header FROM customer""")
def notice_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..functions import notices as n

    k = F.col("c_custkey")
    name = (
        F.when(k % 4 == 0, n.without_descriptors(F.lit("CASEY DOE, AN UNMARRIED MAN, as grantor"))).when(k % 4 == 1, n.without_descriptors(F.lit("Casey Doe, a married person joined pro forma by Alex Roe, her husband")))
        .when(k % 4 == 2, n.clean_ocr_name(F.lit("CASEY  DOE II] and"))).otherwise(n.entity_core(F.lit("SAMPLE HOMES, L.L.C., a limited liability company")))
    )
    joint = F.when(k % 2 == 0, "CASEY SUE DOE AND WIFE, ALEX ROE").otherwise("Casey Doe and Robin Roe husband and wife")
    odd = F.when(k % 3 == 0, "SAMPLE MORTGAGE").when(k % 3 == 1, "THE NORTH CORNER OF LOT 4").otherwise("PAGE 1 OF 2")
    return table(spark, sf_dir, "customer").select("c_custkey", name.alias("name"), n.primary_name(joint).alias("primary_name"), n.secondary_name(joint).alias("secondary_name"), n.looks_like_lender(odd).alias("lender"), n.looks_like_legal(odd).alias("legal"), n.looks_like_page_header(odd).alias("header"))


@query("""SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN '' WHEN 1 THEN 'zip_outside,absentee_owner,amount_mismatch' WHEN 2 THEN 'bad_zip_format,suspicious_short_address,bad_account,owner_mismatch,bad_work_date' ELSE 'incomplete_extraction' END AS flags,
  CASE o_orderkey % 7 WHEN 0 THEN 'SKIP' WHEN 1 THEN 'SKIP' WHEN 2 THEN 'CREATE' WHEN 3 THEN 'fail' WHEN 4 THEN 'already' WHEN 5 THEN 'DELETE' ELSE 'ok' END AS action FROM orders""")
def lien_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..functions import notices as n

    k, j = F.col("o_orderkey") % 4, F.col("o_orderkey") % 7
    pick = lambda *v: F.when(k == 0, F.lit(v[0])).when(k == 1, F.lit(v[1])).when(k == 2, F.lit(v[2])).otherwise(F.lit(v[3]))
    flags = n.lien_flags(
        mail_zip=pick("90001", "80001", "9000", ""), prop_address=pick("1 SAMPLE ST", "1 SAMPLE ST", "SAMPL", ""), mail_address=pick("1 Sample St", "9 OTHER ST", "", ""), account=pick("0001-0002-0003", "0001-0002-0003", "1-2", ""),
        amount=pick(5.0, 6.0, 5.0, 5.0), filed_amount=F.lit(5.0), owner=pick("DOE ALEX", "DOE ALEX", "ROE", ""), filed_owner=F.lit("ALEX DOE"), work_date=pick("2001-01-01", "", "2099-01-01", ""), as_of="2001-08-01", zip_prefix="900",
    )
    action = n.lien_action(
        document=F.when(j == 0, "REAL ESTATE LIEN NOTE").otherwise("AFFIDAVIT OF LIEN"), known=j >= 4, processed=j == 4, corporate=(j == 1) | (j == 5),
        owner=F.when(j == 3, "").otherwise("DOE"), address=F.lit("1 SAMPLE ST"), account=F.lit(""),
    )
    return table(spark, sf_dir, "orders").select("o_orderkey", F.array_join(flags, ",").alias("flags"), action.alias("action"))


@query("""SELECT c_custkey, c_custkey || ' SAMPLE ST' AS street, CASE WHEN c_custkey % 2 = 0 THEN 'PORT SAMPLE' ELSE '' END AS city, CASE c_custkey % 4 WHEN 3 THEN '' ELSE '0001-0002-0003' END AS account,
  CASE WHEN c_custkey % 2 = 0 THEN '10' ELSE '9' END AS newest FROM customer""")
def page_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    peeled = addresses.peel_city(t(s(k), " SAMPLE ST", F.when(k % 2 == 0, ", Port Sample").otherwise("")), ("SAMPLE", "PORT SAMPLE"))
    a = "0001-0002-0003"
    found = money.account_on_page(F.when(k % 4 == 0, a), F.create_map(F.lit("Geo"), F.when(k % 4 == 1, a).otherwise("x")), F.when(k % 4 == 2, f"see {a} and {a}").when(k % 4 == 3, f"{a} or 9999-0002-0003").otherwise(""))
    newest = money.newest_number(F.array(F.lit("9"), F.lit("8"), F.when(k % 2 == 0, "10").otherwise("1")))
    return table(spark, sf_dir, "customer").select("c_custkey", peeled["street"].alias("street"), peeled["city"].alias("city"), found.alias("account"), newest.alias("newest"))


@query(with_views("d_owner") + """ SELECT owner_id, CASE WHEN owner_id % 2 = 0 AND owner_id % 3 <> 0 THEN 'found' WHEN owner_id % 2 = 0 THEN '' ELSE 'own' END AS mail_address,
  CASE WHEN owner_id % 2 = 0 AND owner_id % 3 <> 0 THEN 'TX' ELSE '' END AS mail_state FROM d_owner""")
def mail_block(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("owner_id")
    rec = view(spark, sf_dir, "d_owner").select("owner_id", F.when(k % 2 == 0, "").otherwise("own").alias("mail_address"), F.lit("").alias("mail_state"))
    found = rec.select("owner_id", F.when(k % 3 == 0, "").otherwise("found").alias("mail_address"), F.lit("TX").alias("mail_state"))
    return merge.fill_block(rec, found, "owner_id", ["mail_address", "mail_state"], "mail_address")


@query(with_views("d_owner") + " SELECT owner_id, CAST(owner_id % 2 + 5 AS INT) AS version FROM d_owner WHERE NOT (owner_id % 2 = 1 AND owner_id % 5 = 0)")
def cache_expiry(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("owner_id")
    cache = view(spark, sf_dir, "d_owner").select("owner_id", (k % 2 + 5).cast("int").alias("version"))
    return merge.expire(cache, cache.where(k % 5 == 0), "owner_id")


@query(with_views("d_parcel") + """ SELECT CAST(count(*) FILTER (state_class <> '' AND prop_zip <> '') AS BIGINT) AS matched, CAST(count(*) FILTER (state_class <> '' AND prop_zip = '') AS BIGINT) AS id_only,
  CAST(count(*) FILTER (owner_id % 9 = 0) AS BIGINT) AS no_owner, CAST(count(*) FILTER (state_class = '' AND owner_id % 3 > 1) AS BIGINT) AS unclear FROM d_parcel""")
def match_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("owner_id")
    p = view(spark, sf_dir, "d_parcel").select(F.col("state_class").alias("prop_id"), F.col("prop_zip").alias("address"), F.when(k % 9 == 0, "").otherwise("DOE").alias("owner"), (k % 3).alias("n"))
    return summary.match_summary(p)


@query(with_views("d_case_month") + """, m AS (SELECT case_id, period, CAST(sum(DISTINCT CAST(balance AS DECIMAL(18,2))) AS DOUBLE) AS balance FROM d_case_month GROUP BY 1, 2),
c AS (SELECT case_id, max(period) AS last, count(*) AS n, arg_max(balance, period) AS balance FROM m GROUP BY 1), e AS (SELECT max(period) AS last, count(DISTINCT period) AS n FROM m)
SELECT CAST(count(*) FILTER (c.last = e.last) AS BIGINT) AS active, CAST(count(*) FILTER (c.last < e.last) AS BIGINT) AS claimed, CAST(sum(CAST(balance AS DECIMAL(18,2))) FILTER (c.last = e.last) AS DOUBLE) AS active_total,
  CAST(count(*) FILTER (c.n = e.n) AS BIGINT) AS in_every_month FROM c CROSS JOIN e""")
def excess_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    months = state.case_months(view(spark, sf_dir, "d_case_month"))
    return summary.excess_store(months, state.monthly_state(months))[1]
