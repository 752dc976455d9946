"""Search pages, records, rolls, documents and cases over rendered rows of the tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import identifiers
from ..operators import extraction, parcels, state
from ..sources import parcel_pages, payloads, readers, sinks
from .entity_queries import DELINQUENT, KIND
from .lookup_queries import t
from .views import AS_OF, spread, table, view, with_views

QUERIES: dict = {}
ORACLES: dict = {}


def query(oracle: str | None):  # noqa: ANN201
    def add(f):  # noqa: ANN001, ANN202
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return add


def when(test: Column, value: Column | str, otherwise: Column | str = "") -> Column:
    return F.when(test, value).otherwise(otherwise)


@query("""SELECT p_partkey, CASE WHEN p_partkey % 12 = 0 THEN 1 ELSE 2 END AS n_named, CASE WHEN p_partkey % 4 = 0 THEN '' ELSE 'DOE & SON ' || p_partkey END AS owner, CASE WHEN p_partkey % 3 = 0 THEN '' ELSE p_partkey || ' SAMPLE ST' END AS situs,
  CAST(p_partkey AS VARCHAR) AS prop_id, CASE WHEN p_partkey % 5 = 0 THEN 'C5' WHEN p_partkey % 7 = 0 THEN '' ELSE 'O' || p_partkey END AS owner_id, CASE WHEN p_partkey % 7 = 0 THEN '2026' ELSE '2025' END AS year,
  CASE WHEN p_partkey % 2 = 1 THEN CAST(p_size * 1000 + 0.5 AS DOUBLE) END AS appraised_value, '2540-' || p_partkey AS account FROM part""")
def search_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Result lists with and without owner, address, value and the call for details."""
    k = F.col("p_partkey")
    cell = lambda c, v: t(f'<td class="cell {c}">', v, "</td>")
    call = when(k % 7 != 0, t(" onclick=\"redirectToPropertyDetails('", k, "','2025','O", k, "', 'false')\""))
    cells = [
        cell("_ownerName", when(k % 4 != 0, t("DOE &amp;  <b>SON</b> ", k))), cell("_address", when(k % 3 != 0, t(k, " SAMPLE ST"))), cell("_propertyType", F.lit("R")), cell("_propertyId", t(k)),
        cell("_ownerId", when(k % 5 == 0, "C5")), cell("_geoId", t("2540-", k)), cell("_appraisedValueDisplay", when(k % 2 == 1, t("$", F.col("p_size"), ",000.50"), "N/A")),
    ]
    page = t("<table><thead><tr><th>Owner</th></tr></thead><tr", call, ">", *cells, "</tr><tr><td class='_ownerName'>OTHER</td></tr><tr><td>none</td></tr></table>")
    out = spread(table(spark, sf_dir, "part"), "p_partkey").withColumn("page", page)
    rows = out.select("p_partkey", F.size(parcel_pages.search_rows("page")).cast("long").alias("n_named"), F.get(parcel_pages.search_rows("page", default_year="2026", by_id=True), F.lit(0)).alias("r"))
    return rows.select("p_partkey", "n_named", *[F.col(f"r.{c}").alias(c) for c in ("owner", "situs", "prop_id", "owner_id", "year", "appraised_value", "account")])


@query("""WITH c AS (SELECT c_custkey, c_custkey % 4 AS f, c_custkey AS k FROM customer)
SELECT c_custkey, CASE WHEN f < 3 THEN k || ' MAIN ST' END AS site_address, CASE WHEN f < 3 THEN 'ROBSTOWN' END AS site_city, CASE WHEN f < 3 THEN k || ' OAK AVE ROBSTOWN' END AS mail_address,
  CASE WHEN f IN (0, 2) THEN CASE WHEN k % 3 = 0 THEN CAST(1000 + k AS DOUBLE) ELSE CAST(2000 + k AS DOUBLE) END END AS appraised_value, CASE WHEN f < 3 THEN k || ' OAK AVE' END AS mail_street, CASE WHEN f < 3 THEN 'ROBSTOWN' END AS mail_city,
  CASE WHEN f < 3 THEN k || ' OAK AVE' ELSE '' END AS line_street, CASE WHEN f < 3 THEN '78380' ELSE '' END AS line_zip, CASE WHEN f = 2 THEN '2540-' || k ELSE '' END AS account,
  CASE WHEN f IN (0, 2) THEN 'LOT ' || k || ' BLK 2' WHEN f = 3 THEN 'TRACT ' || k ELSE '' END AS legal FROM c""")
def detail_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Details in definition lists, in cards, in tables, and a legal description in plain text only."""
    k = F.col("c_custkey")
    site, post = t(k, " MAIN ST, ROBSTOWN, TX 78380"), t(k, " OAK AVE<br>ROBSTOWN, TX 78380")
    market = when(k % 3 == 0, "$0", t("$", F.lit(2000) + k, ".00"))
    facts = [("Situs Address:", site), ("Mailing Address", post), ("2025 Appraised Value", t("$", F.lit(1000) + k)), ("2025 Market Value:", market), ("Legal Description", t("LOT ", k, "<br>BLK 2"))]
    listed = t("<dl>", *[x for label, v in facts for x in (f"<dt>{label}</dt><dd>", v, "</dd>")], "</dl>")
    cards = t(*[x for label, v in facts[:2] for x in (f'<div class="info-card"><h4 class="title">{label}</h4><div class="body">', v, "</div></div>")])
    rows = t("<table>", *[x for label, v in [*facts, ("Geographic ID:", t("2540-", k))] for x in (f"<tr><th>{label}<td>", v, "</td></tr>")], "</table>")
    page = F.when(k % 4 == 0, listed).when(k % 4 == 1, cards).when(k % 4 == 2, rows).otherwise(t("<p>Legal Description:</p><p>TRACT ", k, "</p>"))
    out = spread(table(spark, sf_dir, "customer"), "c_custkey").select("c_custkey", parcel_pages.detail(page).alias("page"))
    out = out.select("c_custkey", "page", parcel_pages.page_record("page", city="SAMPLE CITY").alias("record"), parcel_pages.page_mail("page").alias("post"), parcel_pages.page_mail_lines("page").alias("line"))
    record, post_, line = F.col("record"), F.col("post"), F.col("line")
    return out.select(
        "c_custkey", *[record[c].alias(c) for c in ("site_address", "site_city", "mail_address", "appraised_value")], post_["street"].alias("mail_street"), post_["city"].alias("mail_city"),
        line["street"].alias("line_street"), line["zip"].alias("line_zip"), line["account"].alias("account"), parcel_pages.page_legal("page").alias("legal"),
    )


@query("""WITH x AS (SELECT o_orderkey AS id, CASE WHEN o_orderkey % 4 = 0 THEN CASE WHEN o_orderkey % 5 = 0 THEN 2 ELSE 1 END WHEN o_orderkey % 4 = 1 THEN 2 WHEN o_orderkey % 4 = 2 AND o_orderkey % 3 = 1 AND o_orderkey % 5 <> 0 THEN 1 END AS pos FROM orders)
SELECT id, CAST(pos AS BIGINT) AS pos, CASE pos WHEN 1 THEN id || ' B ROAD' ELSE id || ' C ROAD' END AS site_address, CASE pos WHEN 1 THEN 'TOWN' ELSE 'SAMPLE CITY' END AS site_city FROM x WHERE pos IS NOT NULL""")
def best_search_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three results of a name, with and without a legal description that must correspond."""
    k = F.col("o_orderkey")
    row = lambda owner, kind, situs, legal: F.struct(owner.alias("owner"), F.lit(kind).alias("type"), situs.alias("situs"), legal.alias("legal"))
    found = F.array(
        row(t("DOE ", k, " JR"), "P", t(k, " A ROAD"), F.lit("ALPHA SUBDIVISION LOT 1 BLOCK 1")),
        row(t("DOE ", k), "R", when(k % 5 != 0, t(k, " B ROAD, TOWN, TX 78380")), t("BETA SUBDIVISION LOT ", k % 3, " BLOCK 1")),
        row(t("X DOE ", k), "R", t(k, " C ROAD"), F.lit("GAMMA SUBDIVISION LOT 2 BLOCK 1")),
    )
    ours = F.when(k % 4 == 1, "GAMMA SUBDIVISION LOT 2 BLOCK 1").when(k % 4 == 2, "BETA SUBDIVISION LOT 1 BLOCK 1").when(k % 4 == 3, "DELTA SUBDIVISION LOT 9 BLOCK 1").otherwise("")
    rows = spread(table(spark, sf_dir, "orders"), "o_orderkey").select(k.alias("id"), t("Doe ", k).alias("query_name"), ours.alias("record_legal"), F.lit("").alias("record_address"), F.posexplode(found).alias("pos", "r")).select("*", "r.*").drop("r")
    return parcels.best_search_row(rows, city="SAMPLE CITY").select("id", F.col("pos").cast("long").alias("pos"), "site_address", "site_city")


@query(KIND + """, c AS (SELECT p_partkey // 4 AS id, p_partkey AS prop_id, CASE p_partkey % 3 WHEN 0 THEN 'A1' WHEN 1 THEN 'B2' ELSE 'F1' END AS cls FROM part),
v AS (SELECT id, cls, count(*) AS n, min(prop_id) AS prop_id FROM c GROUP BY id, cls), w AS (SELECT * FROM v QUALIFY row_number() OVER (PARTITION BY id ORDER BY n DESC, prop_id) = 1)
SELECT w.id, w.prop_id, w.cls, CASE w.cls WHEN 'A1' THEN 'Single-family' ELSE 'Multifamily' END AS property_type, k.owner FROM w JOIN orders o ON o.o_orderkey = w.id JOIN k ON k.owner_id = w.prop_id % 150
WHERE w.cls <> 'F1' AND o.o_orderkey % 9 <> 0 AND k.kind IN ('individual', 'estate', 'family_trust')""")
def violation_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Violations by vote of their candidates, without zoning and owners that are no persons."""
    k, p = F.col("o_orderkey"), F.col("p_partkey")
    open_ = table(spark, sf_dir, "orders").select(k.alias("id"), when(k % 9 == 0, "Zoning", "Tall Weeds").alias("case_type"))
    part = table(spark, sf_dir, "part")
    candidates = part.select(F.floor(p / 4).cast("long").alias("id"), p.alias("prop_id"), F.when(p % 3 == 0, "A1").when(p % 3 == 1, "B2").otherwise("F1").alias("cls"), p.alias("pos"))
    owned = part.select(p.alias("prop_id"), (p % 150).alias("owner_id")).join(view(spark, sf_dir, "d_owner"), "owner_id").select("prop_id", "owner")
    return parcels.violation_cases(open_, candidates, owned).select("id", "prop_id", "cls", "property_type", "owner")


@query(DELINQUENT + """ SELECT account_raw[1:4] || '-' || account_raw[5:8] || '-' || account_raw[9:12] AS account, CAST(prop_id AS VARCHAR) AS prop_id, state_class AS state_code, prop_zip AS zip,
  CASE WHEN prop_id % 3 = 0 THEN legal ELSE legal || ' SEC 2' END AS legal, CAST(prop_id + 0.25 AS DOUBLE) AS levy_owed, CAST(1000.5 AS DOUBLE) AS back_levy_owed, CAST(prop_id + 1000.75 AS DOUBLE) AS total_owed, value AS market_value,
  CAST(len(list_distinct([25, 24, prop_id % 24])) AS INT) AS years_behind, CAST(prop_id % 24 AS INT) AS oldest_year, 'HS|OV 65' AS exemptions, prop_id % 4 = 1 AS has_judgment FROM q WHERE reason IS NULL""")
def delinquent_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of a roll as texts to records."""
    k = F.col("prop_id")
    rows = view(spark, sf_dir, "d_parcel").join(view(spark, sf_dir, "d_owner"), "owner_id").select(
        t(" ", F.lower("state_class")).alias("state_code"), F.col("account_raw").alias("account"), t(" ", k, ".").alias("appraisal_id"), F.col("prop_zip").alias("zip"), "owner", F.col("del_years_raw").alias("years"), t(k, ".25").alias("levy"), F.lit("$1,000.50").alias("back_levy"),
        F.array(F.col("market_value").cast("string"), F.lit(""), F.lit("x")).alias("values"),
        F.array(F.lit("HS"), F.lit(" "), F.lit(" OV  65 ")).alias("exemptions"), F.array(F.col("legal"), when(k % 3 == 0, " ", "SEC  2")).alias("descriptions"),
        when(k % 4 == 1, "j", "L").alias("suit"), *[F.lit("").alias(c) for c in ("bad_address", "deferral", "agreement", "bankruptcy")],
    )
    out = parcels.delinquent_rows(rows, ("90002",))
    return out.select("account", "prop_id", "state_code", "zip", "legal", "levy_owed", "back_levy_owed", "total_owed", "market_value", F.col("years_behind").cast("int").alias("years_behind"), "oldest_year", F.array_join("exemptions", "|").alias("exemptions"), F.col("flags.has_judgment").alias("has_judgment"))


@query("""WITH r AS (SELECT CAST(2024000000 + o_orderkey AS VARCHAR) AS doc_num, o_orderkey AS k FROM orders WHERE o_orderkey % 5 <> 0)
SELECT doc_num, CASE WHEN k % 3 = 0 THEN 'FORECLOSURE NOTICE' ELSE 'NOTICE' END AS doc_type, '2024-01-02' AS recorded, CASE WHEN k % 2 = 0 THEN '2024-03-04' ELSE '' END AS sale_date,
  CASE k % 4 WHEN 0 THEN 'https://example.org/doc/' || k WHEN 1 THEN 'https://example.org/doc/' || k WHEN 2 THEN 'https://other.example/' || k ELSE 'https://example.org/results?department=FC&searchValue=' || doc_num END AS clerk_url,
  CASE WHEN k % 2 = 0 THEN k || ' SAMPLE ST' ELSE '' END AS prop_address, CASE WHEN k % 2 = 0 THEN 'ROBSTOWN' ELSE '' END AS prop_city, CASE WHEN k % 2 = 0 THEN 'OK' ELSE 'TX' END AS prop_state, CASE WHEN k % 2 = 0 THEN '78380' ELSE '' END AS prop_zip FROM r""")
def foreclosure_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    url = F.when(k % 4 == 0, t("/doc/", k)).when(k % 4 == 1, t("doc/", k)).when(k % 4 == 2, t("https://other.example/", k))
    rows = table(spark, sf_dir, "orders").select(
        when(k % 5 != 0, t(" ", F.lit(2024000000) + k)).alias("doc_number"), F.when(k % 3 != 0, "NOTICE ").alias("doc_type"), F.lit("01/02/2024").alias("recorded"), F.when(k % 2 == 0, "2024-03-04").alias("sale_date"),
        when(k % 2 == 0, t(k, " SAMPLE ST ROBSTOWN, OK 78380"), t("LOT ", k)).alias("legal"), url.alias("clerk_url"),
    )
    return parcels.foreclosures(rows, "https://example.org").drop("legal")


@query("""SELECT CASE c_custkey % 5 WHEN 0 THEN 'empty' WHEN 1 THEN 'iso' WHEN 4 THEN 'unparseable' ELSE 'converted' END AS date_status,
  CASE c_custkey % 5 WHEN 0 THEN '' WHEN 1 THEN '2024-05-06' WHEN 2 THEN '2021-01-05' WHEN 3 THEN '2019-12-31' ELSE 'SOME DAY' END AS deed_date, count(*) AS n FROM customer GROUP BY ALL""")
def deed_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey") % 5
    raw = F.when(k == 0, "").when(k == 1, "2024-05-06").when(k == 2, "January 5, 2021").when(k == 3, "12/31/2019").otherwise("SOME DAY")
    return parcels.with_iso_deed_date(table(spark, sf_dir, "customer").select(raw.alias("deed_date"))).groupBy("date_status", "deed_date").agg(F.count("*").alias("n"))


@query("""SELECT o_orderkey AS id, CASE WHEN o_orderkey % 3 = 0 THEN '2001-01-01' WHEN o_orderkey % 3 = 1 THEN '2015-06-07' ELSE '2001-01-01' END AS deed_date, CASE WHEN o_orderkey % 3 = 1 AND o_orderkey % 2 = 0 THEN '2001-01-01' END AS original,
  CASE WHEN o_orderkey % 3 = 0 THEN NULL WHEN o_orderkey % 3 = 1 THEN '2015000' || o_orderkey ELSE '99' END AS document
FROM orders WHERE NOT (o_orderkey % 3 = 0 AND o_orderkey % 2 = 1) AND NOT (o_orderkey % 3 = 2 AND o_orderkey % 2 = 1)
UNION ALL SELECT o_orderkey, '', NULL, CASE WHEN o_orderkey % 3 = 2 THEN '99' END FROM orders WHERE o_orderkey % 2 = 1 AND o_orderkey % 3 <> 1""")
def newest_modifications(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No modification, several, and one that is the notice's own number; deeds with and without a date."""
    k = F.col("o_orderkey")
    none = F.array().cast("array<string>")
    dates = F.when(k % 3 == 1, F.array(F.lit("2009-01-01"), F.lit("2015-06-07"), F.lit(""))).otherwise(none)
    numbers = F.when(k % 3 == 0, none).when(k % 3 == 1, F.array(F.lit("99"), t("2015000", k), F.lit("2014"))).otherwise(F.array(F.lit("99"), t("2099000", k)))
    m = parcels.newest_modification(when(k % 2 == 0, "2001-01-01"), dates, numbers, t("2099000", k))
    return table(spark, sf_dir, "orders").select(k.alias("id"), m.alias("m")).select("id", "m.*")


_APPLIED = """SELECT {mode} AS mode, o_orderkey AS id, CASE WHEN o_orderkey % 4 = 3 THEN 'OLD' WHEN o_orderkey % 5 = 0 THEN 'OLD' WHEN {over} THEN 'NEW ' || o_orderkey ELSE 'OLD' END AS owner,
  CASE WHEN o_orderkey % 4 = 3 THEN '' ELSE 'BANK ' || o_orderkey END AS lender, CASE WHEN o_orderkey % 4 = 3 THEN CAST(0 AS DOUBLE) ELSE CAST(5 AS DOUBLE) END AS loan_amount,
  CASE WHEN o_orderkey % 4 = 3 THEN '1 OLD ST' WHEN o_orderkey % 4 = 0 AND {over} THEN '' WHEN o_orderkey % 4 = 0 THEN '1 OLD ST' WHEN {over} THEN o_orderkey || ' NEW ST' ELSE '1 OLD ST' END AS prop_address,
  CASE WHEN o_orderkey % 4 IN (1, 2) AND {over} THEN 'NEWTOWN' WHEN o_orderkey % 4 = 0 AND {over} THEN '' ELSE 'OLDTOWN' END AS prop_city,
  CASE WHEN o_orderkey % 4 = 3 THEN '' WHEN o_orderkey % 3 = 0 THEN 'SAMPLE LOT 4 BLOCK 2 UNIT 1' WHEN o_orderkey % 3 = 1 THEN 'SAMPLE ADDITION TRACTS 5, 6' ELSE 'SAMPLE' END AS legal,
  o_orderkey % 4 <> 3 AND o_orderkey % 2 = 0 AS has_loan_mod, o_orderkey % 4 <> 3 AS changed FROM orders"""


@query(_APPLIED.format(mode="'fill'", over="false") + " UNION ALL " + _APPLIED.format(mode="'overwrite'", over="true"))
def documents_applied(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What documents say, in blank fields only and in all; page headers are no values."""
    k = F.col("o_orderkey")
    blank_ = {c: F.lit("").alias(c) for c in ("owner_raw", "lender", "deed_date", "loan_doc", "legal_lot", "legal_block", "legal_subdivision", "legal")}
    unset = [F.lit(None).cast("string").alias(c) for c in ("deed_date_original", "loan_mod_doc")]
    orders = table(spark, sf_dir, "orders")
    records = orders.select(k.alias("id"), F.lit("OLD").alias("owner"), F.lit(0.0).alias("loan_amount"), F.lit(False).alias("has_loan_mod"), F.lit("1 OLD ST").alias("prop_address"), F.lit("OLDTOWN").alias("prop_city"), F.lit("TX").alias("prop_state"), F.lit("78380").alias("prop_zip"), *blank_.values(), *unset)
    fields = orders.where(k % 4 != 3).select(
        k.alias("id"), when(k % 5 == 0, "PAGE 1 OF 2 RECORDED", t("NEW ", k)).alias("owner"), t("BANK ", k).alias("lender"), F.lit(5.0).alias("loan_amount"), (k % 2 == 0).alias("has_loan_mod"),
        when(k % 4 != 0, t(k, " NEW ST")).alias("prop_address"), F.lit("NEWTOWN").alias("prop_city"), F.lit("").alias("prop_state"), F.lit("").alias("prop_zip"),
        F.lit("SAMPLE").alias("legal_subdivision"), when(k % 3 == 0, "4").alias("legal_lot"), when(k % 3 == 0, "2").alias("legal_block"), when(k % 3 == 0, "1").alias("legal_unit"), when(k % 3 == 1, "5, 6").alias("legal_tracts"),
        *[blank_[c] for c in ("owner_raw", "deed_date", "loan_doc")], *unset,
    )
    both = [parcels.apply_document(records, fields, "id", overwrite=o).withColumn("mode", F.lit(m)) for o, m in ((False, "fill"), (True, "overwrite"))]
    return both[0].unionByName(both[1]).select("mode", "id", "owner", "lender", "loan_amount", "prop_address", "prop_city", "legal", "has_loan_mod", "changed")


@query("""SELECT o_orderkey AS case_number, CASE WHEN o_orderkey % 4 = 3 OR o_orderkey % 2 = 0 THEN CASE WHEN o_orderkey % 2 = 0 THEN 'KEPT' ELSE '' END ELSE 'M' || o_orderkey END AS mail_address,
  CASE WHEN o_orderkey % 4 = 3 THEN '2020DCV-12-A LOT 1' WHEN o_orderkey % 3 = 0 THEN 'PARCEL LOT 7' ELSE 'LOT 1' END AS legal_description, o_orderkey % 4 <> 3 AS touched FROM orders""")
def written_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    orders = table(spark, sf_dir, "orders")
    cases = orders.select(k.alias("case_number"), when(k % 2 == 0, "KEPT").alias("mail_address"), F.lit("2020DCV-12-A LOT 1").alias("legal_description"))
    found = orders.where(k % 4 != 3).select(k.alias("case_number"), when(k % 3 == 0, t(k)).alias("found_prop_id"), when(k % 3 == 0, "PARCEL LOT 7").alias("found_legal"), t("M", k).alias("mail_address"))
    return parcels.write_back(cases, found, "case_number", ("mail_address",))


@query("""WITH s AS (SELECT o_orderkey AS k, CAST(o_orderkey AS VARCHAR) AS doc_num, o_totalprice AS amount FROM orders)
SELECT doc_num, CASE WHEN k % 3 <> 0 THEN 'STORED' ELSE 'DOE ' || k END AS owner, CASE WHEN k % 3 = 0 AND k % 5 <> 0 THEN k || ' SAMPLE ST' ELSE '' END AS prop_address,
  CASE WHEN k % 3 <> 0 THEN 35 ELSE 30 + CASE WHEN amount > 100000 THEN 15 WHEN amount > 50000 THEN 10 ELSE 0 END + CASE WHEN k % 5 <> 0 THEN 5 ELSE 0 END END AS score FROM s WHERE k % 2 = 0 OR k % 3 = 0""")
def liens_backfilled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored liens and scanned ones, of which some are known."""
    k = F.col("o_orderkey")
    orders = table(spark, sf_dir, "orders")
    common = [t(k).alias("doc_num"), F.lit("LIEN").alias("doc_type"), F.lit("CCLN").alias("cat"), F.lit("1997-01-02").alias("filed"), *[F.lit("").alias(c) for c in ("prop_address", "prop_city", "prop_zip")], F.lit("TX").alias("prop_state")]
    stored = orders.where(k % 2 == 0).select(*common, F.lit("STORED").alias("owner"), F.lit(0.0).alias("amount"), F.lit("").alias("legal"), F.lit(35).alias("score"))
    scanned = orders.where(k % 3 == 0).select(*common, t("DOE ", k).alias("owner"), F.col("o_totalprice").alias("amount"), when(k % 5 != 0, t(k, " SAMPLE ST"), "LOT 1").alias("legal"))
    return parcels.backfill_liens(stored, scanned, key="doc_num", city="SAMPLE CITY", as_of=AS_OF).select("doc_num", "owner", "prop_address", "score")


@query(with_views("d_violation") + """, d AS (SELECT DISTINCT prop_id, ref_no, case_type FROM d_violation)
SELECT prop_id, ref_no, case_type, CAST(row_number() OVER (PARTITION BY prop_id ORDER BY ref_no, case_type) - 1 AS BIGINT) AS pos, 'open' AS state FROM d""")
def ledger_seeded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger that a published summary gives where none is stored."""
    found = view(spark, sf_dir, "d_violation").select("prop_id", "ref_no", "case_type").distinct()
    cases = F.sort_array(F.collect_list(F.struct("ref_no", "case_type")))  # a property's cases are one row of the published list
    summary = found.groupBy("prop_id").agg(cases.alias("c")).select("prop_id", F.col("c.ref_no").alias("case_nums"), F.col("c.case_type").alias("types"))
    return state.ledger_or_seed(None, summary).select("prop_id", "ref_no", "case_type", F.col("pos").cast("long").alias("pos"), "state")


@query("""SELECT user_id AS case_number, CAST(coalesce(sum(DISTINCT CAST(round(value, 2) AS DECIMAL(18, 2))), 0) AS DOUBLE) AS balance, coalesce(arg_min(event_type, event_id) FILTER (event_id % 3 <> 0), '') AS owner, arg_min(event_type, event_id) AS case_type FROM events GROUP BY user_id""")
def excess_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("event_id")
    rows = table(spark, sf_dir, "events").select(F.col("user_id").alias("case_number"), k.alias("pos"), F.col("value").alias("balance"), when(k % 3 != 0, F.col("event_type")).alias("owner"), F.lit("CITY").alias("plaintiff"), F.col("event_type").alias("case_type"))
    return state.cases(rows).select("case_number", "balance", "owner", "case_type")


@query("""WITH l AS (SELECT o_custkey, min(o_orderkey) FILTER (o_orderkey % 11 = 0) AS last FROM orders GROUP BY 1),
r AS (SELECT o.o_custkey AS source, o.o_orderkey AS page, 'u' || (o.o_orderkey // 40) AS uid FROM orders o JOIN l USING (o_custkey) WHERE (l.last IS NULL OR o.o_orderkey <= l.last) AND o.o_orderkey % 4 <> 0)
SELECT source, min(page) AS page, uid, 'https://example.org/?p=' || min(page) AS address FROM r GROUP BY source, uid""")
def paged_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed pages up to the first without a next one; rows without uid and repeated uids."""
    k = F.col("o_orderkey")
    row = t('{"uid": ', when(k % 4 != 0, t('"u', F.floor(k / 40), '"'), "null"), ', "x": 1}')
    body = t('{"results": [', row, ', {"y": 2}], "next": ', when(k % 11 == 0, "null", t('"http://example.org/?p=', k, '"')), "}")
    pages = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("source"), k.alias("page"), body.alias("body"))
    rows = payloads.sale_pages(pages)
    asked = F.concat(F.lit('{"next": "http://example.org/?p='), F.col("page").cast("string"), F.lit('"}'))
    return rows.select("source", "page", "uid", payloads.next_page(asked).alias("address"))


@query("""SELECT c_custkey AS file, 'CE' || c_custkey AS ref_no, c_mktsegment AS case_type, 'New' AS status, CASE WHEN c_custkey % 2 = 0 THEN c_custkey || ' SAMPLE ST' ELSE '' END AS address FROM customer WHERE c_custkey % 3 <> 2""")
def sheets_by_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sheets whose header lies below a title, in one of two orders and spellings, or is missing."""
    k = F.col("c_custkey")
    title = F.array(F.lit("EXPORT"), F.lit("Status"))
    head = when(k % 2 == 0, F.array(*map(F.lit, ("Address  1", "REFERENCE NO", "Status", "Case Type"))), F.array(*map(F.lit, ("ref no", "Case  type", " STATUS "))))
    row = when(k % 2 == 0, F.array(t(k, " SAMPLE ST"), t("CE", k), F.lit(" New"), F.col("c_mktsegment")), F.array(t(" CE", k), F.col("c_mktsegment"), F.lit("New")))
    rows = F.when(k % 3 == 2, F.array(title, row)).otherwise(F.array(title, head, row, F.array(F.lit(""), F.lit(""), F.lit("x"))))
    sheet = table(spark, sf_dir, "customer").select(k.alias("file"), F.posexplode(rows).alias("pos", "cells"))
    return readers.by_header(sheet).select("file", "ref_no", "case_type", "status", "address")


@query("""SELECT o_orderkey AS id, 'https://example.org/results?department=RP&limit=250&offset=0&keywordSearch=false&searchOcrText=false&searchType=quickSearch&recordedDateRange=' || strftime(o_orderdate, '%Y%m%d') || '%2C20010801'
  || CASE WHEN o_orderkey % 2 = 0 THEN '&searchValue=city+of+' || o_custkey ELSE '' END || CASE WHEN o_orderkey % 3 = 0 THEN '&_docTypes=L3' ELSE '' END AS search,
  'https://example.org/results?department=FC&instrumentDateRange=' || strftime(o_orderdate, '%Y%m%d') || '%2C20010801&keywordSearch=false&searchOcrText=false&searchType=quickSearch' AS listed FROM orders""")
def search_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, day = F.col("o_orderkey"), F.date_format("o_orderdate", "yyyy-MM-dd")
    search = identifiers.search_url("https://example.org", day, F.lit(AS_OF), query=F.when(k % 2 == 0, t("city of ", F.col("o_custkey"))), doc_types=F.when(k % 3 == 0, "L3"))
    return table(spark, sf_dir, "orders").select(k.alias("id"), search.alias("search"), identifiers.foreclosure_url("https://example.org", day, F.lit(AS_OF)).alias("listed"))


@query("""SELECT '2001-09-04' AS sale_date, CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE CAST(o_orderkey % 90 AS VARCHAR) END AS days_until_sale, 'pre' AS status, CAST(o_orderkey AS VARCHAR) AS doc_number, '' AS doc_type, '' AS recorded_date, 'LOT 1' AS property_address, 'DOE' AS owner,
  CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE o_orderkey || '.50' END AS loan_amount, '' AS url FROM orders""")
def foreclosure_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    empty = [F.lit(None).cast("string").alias(c) for c in ("doc_type", "recorded", "clerk_url")]
    rows = table(spark, sf_dir, "orders").select(F.lit("2001-09-04").alias("sale_date"), F.when(k % 3 != 0, k % 90).alias("days_until_sale"), F.lit("pre").alias("status"), t(k).alias("doc_num"), F.lit("LOT 1").alias("legal"), F.lit("DOE").alias("owner"), when(k % 4 == 0, F.lit(0.0), k + 0.5).alias("loan_amount"), *empty)
    return sinks.foreclosure_rows(rows).toDF("sale_date", "days_until_sale", "status", "doc_number", "doc_type", "recorded_date", "property_address", "owner", "loan_amount", "url")


@query("""WITH o AS (SELECT o_orderkey AS id, o_orderkey % 4 AS f, o_orderkey AS k, 100 + o_orderkey % 9000 AS h, chr(CAST(65 + o_orderkey % 26 AS INT)) AS c FROM orders)
SELECT id, CASE WHEN f = 0 THEN CAST(2024000000 + k AS VARCHAR) ELSE '' END AS doc_number, CASE f WHEN 0 THEN 'CASEY DOE ' || k || ' AND ALEX DOE' WHEN 1 THEN 'CASEY D' || c || 'E' WHEN 2 THEN 'SAMPLE HOLDINGS ' || k || ' LLC' ELSE '' END AS owner,
  CASE WHEN f = 0 THEN 'CASEY DOE ' || k || ' AND ALEX DOE, HUSBAND AND WIFE' ELSE '' END AS owner_raw, CASE f WHEN 0 THEN 'SAMPLE BANK' WHEN 1 THEN 'SAMPLE FUNDING LLC' WHEN 2 THEN 'SAMPLE BANK, N.A' ELSE '' END AS lender,
  CASE f WHEN 0 THEN CAST(100000 + k AS DOUBLE) WHEN 2 THEN CAST(55000 AS DOUBLE) END AS loan_amount, CASE f WHEN 0 THEN '2010-01-05' WHEN 1 THEN '2017-05-06' WHEN 2 THEN '2009-06-01' ELSE '' END AS deed_date, CASE WHEN f = 1 THEN '2009-06-01' END AS deed_date_original,
  f = 1 AS has_loan_mod, CASE WHEN f = 1 THEN CAST(2015000000 + k AS VARCHAR) END AS loan_mod_doc, CASE f WHEN 0 THEN CAST(2010000000 + k AS VARCHAR) WHEN 1 THEN CAST(2015000000 + k AS VARCHAR) ELSE '' END AS loan_doc,
  CASE f WHEN 0 THEN h || ' SAMPLE STREET' WHEN 1 THEN h || ' SAMPLE DRIVE' WHEN 2 THEN h || ' OAK AVE' ELSE '' END AS prop_address, CASE f WHEN 0 THEN 'CORPUS CHRISTI' WHEN 1 THEN 'ROBSTOWN' WHEN 2 THEN 'PORT ARANSAS' ELSE '' END AS prop_city,
  CASE WHEN f < 3 THEN 'TX' ELSE '' END AS prop_state, CASE f WHEN 0 THEN '78401' WHEN 1 THEN '78380' WHEN 2 THEN '78373' ELSE '' END AS prop_zip,
  CASE f WHEN 0 THEN '4' WHEN 1 THEN '7' ELSE '' END AS legal_lot, CASE f WHEN 0 THEN '2' WHEN 1 THEN '3' ELSE '' END AS legal_block, CASE f WHEN 0 THEN 'SAMPLE ACRES' WHEN 1 THEN 'SAMPLE HEIGHTS' WHEN 2 THEN 'SAMPLE FARM' ELSE '' END AS legal_subdivision,
  CASE WHEN f = 0 THEN '1' ELSE '' END AS legal_unit, CASE WHEN f = 2 THEN 'ONE (1) AND TWO (2)' ELSE '' END AS legal_tracts FROM o""")
def notices_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Notices of three families, one of a modified loan, and blank ones."""
    k = F.col("o_orderkey")
    h = F.lit(100) + k % 9000
    full = t(
        "2024 - ", F.lit(2024000000) + k, ' 01/02/2024\nDeed of Trust dated January 5, 2010, executed by CASEY DOE ', k, ' AND ALEX DOE, HUSBAND AND WIFE ("Borrower") in the principal amount of $', F.lit(100000) + k,
        '.00 for the benefit of SAMPLE BANK ("Lender"), recorded under Document No. ', F.lit(2010000000) + k, ".\nProperty Address: ", h, " SAMPLE STREET, Corpus Christi, TX 78401\nLOT FOUR (4), BLOCK TWO (2), SAMPLE ACRES UNIT 1, A SUBDIVISION",
    )
    changed = t(
        h, " SAMPLE DRIVE 0000001234\nROBSTOWN, TX 78380\nWHEREAS, on January 5, 2010, CASEY D", F.char(F.lit(65) + k % 26), "E, as Grantor, gave a lien. Deed of trust dated June 1, 2009. It was modified by Loan Modification Agreement recorded on 03/04/2015 under Instrument No. ",
        F.lit(2015000000) + k, " in the official public records; and further recorded on 05/06/2017.\nLender: SAMPLE FUNDING LLC\nLot 7, Block 3, SAMPLE HEIGHTS Addition",
    )
    entity = t(
        "Deed of Trust Date: June 1, 2009\nGrantor: SAMPLE HOLDINGS ", k, " LLC\nCurrent Mortgagee: SAMPLE BANK, N.A.\nAmount: $55,000.00\nSale at 901 LEOPARD STREET, CORPUS CHRISTI, TX 78401 of the land at ", h,
        " OAK AVE, PORT ARANSAS, TEXAS 78373\nTRACTS ONE (1) AND TWO (2), SAMPLE FARM ADDITION",
    )
    notices = spread(table(spark, sf_dir, "orders"), "o_orderkey").select(k.alias("id"), F.when(k % 4 == 0, full).when(k % 4 == 1, changed).when(k % 4 == 2, entity).alias("text"))
    return extraction.notice_fields(notices).drop("text")
