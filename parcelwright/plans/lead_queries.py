"""Filings: categories, scores, windows, ranking, merging, export."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import codes, dates, money
from ..functions import owners as names
from ..operators import joins, merge, ranking, scoring, summary
from ..sources import sinks
from .views import AS_OF, table, view, with_views

QUERIES: dict = {}
ORACLES: dict = {}


def query(oracle: str | None = None):  # noqa: ANN201
    def add(f):  # noqa: ANN001, ANN202
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return add


CAT_SQL = """CASE WHEN regexp_matches(doc_type, '(?i)\\bRELEASE\\b.*\\bLIS\\s*PENDENS\\b') THEN 'RELLP'
  WHEN regexp_matches(doc_type, '(?i)\\bLIS\\s*PENDENS\\b') THEN 'LP'
  WHEN regexp_matches(doc_type, '(?i)\\bMEDICAID\\s*LIEN\\b') THEN 'MEDLN'
  WHEN regexp_matches(doc_type, '(?i)\\bIRS\\s*LIEN\\b|\\bFEDERAL\\s*TAX\\s*LIEN\\b') THEN 'LNFED'
  WHEN regexp_matches(doc_type, '(?i)\\bMECHANIC') THEN 'LNMECH'
  WHEN regexp_matches(doc_type, '(?i)\\bLIEN\\b') THEN 'LN'
  WHEN regexp_matches(doc_type, '(?i)\\bJUDG') THEN 'JUD'
  WHEN regexp_matches(doc_type, '(?i)\\bHEIRSHIP\\b') THEN 'PRO' END"""

LEADS = with_views("d_owner", "d_filing") + f""",
leads AS (
  SELECT f.*, o.owner, CASE WHEN doc_type = 'NOTICE OF FORECLOSURE' THEN 'NOFC' ELSE {CAT_SQL} END AS cat,
    CASE WHEN f.owner_id % 3 = 0 THEN CAST(f.owner_id AS STRING) || ' SAMPLE ST' ELSE '' END AS prop_address
  FROM d_filing f JOIN d_owner o ON f.owner_id = o.owner_id
), flagged AS (
  SELECT *, upper(trim(owner)) AS k,
    list_filter([CASE cat WHEN 'LP' THEN 'Lis pendens' END, CASE cat WHEN 'NOFC' THEN 'Pre-foreclosure' END,
      CASE cat WHEN 'JUD' THEN 'Judgment lien' END, CASE cat WHEN 'LNFED' THEN 'Tax lien' END,
      CASE WHEN cat = 'LN' AND regexp_matches(doc_type, '(?i)MECH') THEN 'Mechanic lien' END,
      CASE cat WHEN 'PRO' THEN 'Probate / estate' END, CASE cat WHEN 'MEDLN' THEN 'Medicaid lien' END,
      CASE WHEN regexp_matches(owner, '(?i)\\b(LLC|INC|CORP|LP|LLP|LTD|TRUST|HOLDINGS?)\\b') THEN 'LLC / corp owner' END,
      CASE WHEN date_diff('day', filed, DATE '{AS_OF}') <= 7 THEN 'New this week' END], lambda x: x IS NOT NULL) AS flags
  FROM leads
), combos AS (
  SELECT k FROM flagged WHERE k <> '' GROUP BY k HAVING bool_or(cat = 'LP') AND bool_or(cat = 'NOFC')
), scored AS (
  SELECT f.*, CAST(greatest(0, least(100, 30 + 10 * len(flags) + CASE WHEN c.k IS NOT NULL THEN 20 ELSE 0 END
    + CASE WHEN amount > 100000 THEN 15 WHEN amount > 50000 THEN 10 ELSE 0 END
    + CASE WHEN list_contains(flags, 'New this week') THEN 5 ELSE 0 END + CASE WHEN prop_address <> '' THEN 5 ELSE 0 END)) AS INT) AS score
  FROM flagged f LEFT JOIN combos c ON f.k = c.k
)"""


def leads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Filings with owner, category and an address for some."""
    f, o = view(spark, sf_dir, "d_filing"), view(spark, sf_dir, "d_owner")
    cat = F.when(F.col("doc_type") == "NOTICE OF FORECLOSURE", "NOFC").otherwise(codes.category("doc_type"))
    address = F.when(F.col("owner_id") % 3 == 0, F.concat(F.col("owner_id").cast("string"), F.lit(" SAMPLE ST"))).otherwise("")
    return f.join(o, "owner_id").withColumn("cat", cat).withColumn("prop_address", address)


@query(LEADS + " SELECT doc_num, owner, cat, array_to_string(flags, ' | ') AS flags, score FROM scored")
def lead_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.score_leads(leads(spark, sf_dir), AS_OF).select("doc_num", "owner", "cat", F.array_join("flags", " | ").alias("flags"), "score")


@query(LEADS + " SELECT doc_num, score, pos FROM scored ORDER BY score DESC, pos LIMIT 100")
def top_leads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.top_rows(scoring.score_leads(leads(spark, sf_dir), AS_OF).select("doc_num", "score", "pos"), 100, F.desc("score"), F.asc("pos"))


@query(LEADS + """ SELECT CAST(count(*) AS BIGINT) AS total, CAST(count(*) FILTER (prop_address <> '') AS BIGINT) AS with_address,
  CAST(count(*) FILTER (score >= 70) AS BIGINT) AS hot, CAST(count(*) FILTER (cat = 'LP') AS BIGINT) AS lis_pendens FROM scored""")
def stats_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.lead_stats(scoring.score_leads(leads(spark, sf_dir), AS_OF))


@query(with_views("d_filing") + f" SELECT doc_num, doc_type, {CAT_SQL} AS cat FROM d_filing")
def doc_type_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "d_filing").select("doc_num", "doc_type", codes.category("doc_type").alias("cat"))


SPEC_SQL = "coalesce(CASE cat WHEN 'LNMECH' THEN 80 WHEN 'LNFED' THEN 60 WHEN 'MEDLN' THEN 60 WHEN 'PRO' THEN 60 WHEN 'RELLP' THEN 60 WHEN 'LP' THEN 50 WHEN 'JUD' THEN 50 WHEN 'LN' THEN 40 END, 0)"


@query(with_views("d_filing") + f""", c AS (SELECT owner_id, pos, doc_num, {CAT_SQL} AS cat FROM d_filing)
  SELECT owner_id, doc_num, cat FROM c QUALIFY row_number() OVER (PARTITION BY owner_id ORDER BY {SPEC_SQL} DESC, pos) = 1""")
def specificity_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = view(spark, sf_dir, "d_filing").select("owner_id", "pos", "doc_num", codes.category("doc_type").alias("cat"))
    return ranking.most_specific(f, ["owner_id"], codes.specificity("cat"), "pos").select("owner_id", "doc_num", "cat")


@query("SELECT user_id, event_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) = 1")
def keep_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.keep_first(table(spark, sf_dir, "events").select("user_id", "event_id", "event_type"), ["user_id", "event_type"], "event_id")


@query("SELECT user_id, event_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) = 1")
def keep_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.keep_last(table(spark, sf_dir, "events").select("user_id", "event_id", "event_type"), ["user_id", "event_type"], "event_id")


@query(with_views("d_filing") + f" SELECT doc_num, CAST(filed AS VARCHAR) AS filed FROM d_filing WHERE filed IS NULL OR filed BETWEEN DATE '{AS_OF}' - INTERVAL 30 DAY AND DATE '{AS_OF}'")
def filed_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.lit(AS_OF).cast("date")
    return view(spark, sf_dir, "d_filing").where(F.col("filed").isNull() | F.col("filed").between(F.date_sub(day, 30), day)).select("doc_num", F.col("filed").cast("string").alias("filed"))


@query(with_views("d_filing") + f""", s AS (SELECT doc_num, CAST(CAST(filed + INTERVAL 90 DAY AS DATE) AS VARCHAR) AS sale_date FROM d_filing)
  SELECT doc_num, sale_date, CASE WHEN sale_date < '{AS_OF}' THEN 'post' ELSE 'pre' END AS status,
    CAST(date_diff('day', DATE '{AS_OF}', CAST(sale_date AS DATE)) AS INT) AS days_until_sale
  FROM s WHERE sale_date BETWEEN '{AS_OF}' AND '2001-11-29'""")
def sale_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = view(spark, sf_dir, "d_filing").select("doc_num", F.date_add("filed", 90).cast("string").alias("sale_date"))
    last = F.date_add(F.lit(AS_OF).cast("date"), 120).cast("string")
    return s.where((F.col("sale_date") == "") | F.col("sale_date").between(F.lit(AS_OF), last)).select("doc_num", "sale_date", dates.sale_status("sale_date", F.lit(AS_OF)).alias("status"), F.date_diff(F.col("sale_date").cast("date"), F.lit(AS_OF).cast("date")).alias("days_until_sale"))


@query("""SELECT o_orderkey, o_text, amount FROM (SELECT o_orderkey, o_text, CASE WHEN v >= 1 AND v <= 1e9 THEN v END AS amount FROM (
  SELECT *, CASE o_orderkey % 4 WHEN 0 THEN round(o_totalprice, 2) WHEN 1 THEN CAST(o_orderkey AS DOUBLE) WHEN 3 THEN 1200.5 END AS v FROM (
  SELECT o_orderkey, o_totalprice, CASE o_orderkey % 4 WHEN 0 THEN 'sum $' || printf('%.2f', o_totalprice) WHEN 1 THEN 'amount due: ' || o_orderkey
    WHEN 2 THEN CAST(2026000000 + o_orderkey AS VARCHAR) ELSE 'total $1,200.50 and $3' END AS o_text FROM orders)))""")
def amount_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    rendered = F.when(key % 4 == 0, F.concat(F.lit("sum $"), F.format_string("%.2f", "o_totalprice"))).when(key % 4 == 1, F.concat(F.lit("amount due: "), key.cast("string"))).when(key % 4 == 2, (key + 2026000000).cast("string")).otherwise("total $1,200.50 and $3")
    return table(spark, sf_dir, "orders").select("o_orderkey", rendered.alias("o_text")).withColumn("amount", money.amount_in("o_text"))


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 6 = 5 THEN '' ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS iso FROM orders""")
def date_coerce(spark: SparkSession, sf_dir: str) -> DataFrame:
    d, k = F.col("o_orderdate").cast("date"), F.col("o_orderkey") % 6
    raw = F.when(k == 0, F.date_format(d, "yyyy-MM-dd")).when(k == 1, F.date_format(d, "MM/dd/yyyy")).when(k == 2, F.date_format(d, "yyyyMMdd")).when(k == 3, F.concat(F.date_format(d, "yyyy-MM-dd"), F.lit("T10:00:00Z"))).when(k == 4, F.date_format(d, "'filed' yyyy/M/d")).otherwise("TBD")
    return table(spark, sf_dir, "orders").select("o_orderkey", dates.coerce_date(raw).alias("iso"))


HALVES = with_views("d_filing") + """,
stored AS (SELECT doc_num, owner_id, CASE WHEN pos % 4 = 0 THEN '' ELSE 'S' || pos END AS address FROM d_filing WHERE pos % 10 < 6),
scan AS (SELECT doc_num, owner_id, CASE WHEN pos % 3 = 0 THEN '' ELSE 'N' || pos END AS address FROM d_filing WHERE pos % 10 >= 3)"""


def _halves(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    f, pos = view(spark, sf_dir, "d_filing"), F.col("pos")
    side = lambda letter, n: F.when(pos % n == 0, "").otherwise(F.concat(F.lit(letter), pos.cast("string"))).alias("address")
    return f.where(pos % 10 < 6).select("doc_num", "owner_id", side("S", 4)), f.where(pos % 10 >= 3).select("doc_num", "owner_id", side("N", 3))


@query(HALVES + " SELECT doc_num, owner_id, address FROM stored UNION ALL SELECT doc_num, owner_id, address FROM scan WHERE doc_num NOT IN (SELECT doc_num FROM stored)")
def insert_if_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.insert_if_absent(*_halves(spark, sf_dir), "doc_num")


@query(HALVES + " SELECT n.doc_num, n.owner_id, CASE WHEN n.address = '' AND coalesce(s.address, '') <> '' THEN s.address ELSE n.address END AS address FROM scan n LEFT JOIN stored s ON n.doc_num = s.doc_num")
def fill_if_blank(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored, new = _halves(spark, sf_dir)
    return merge.fill_blanks(new, stored, "doc_num", ["address"])


@query(HALVES + " SELECT doc_num, coalesce(n.owner_id, s.owner_id) AS owner_id, CASE WHEN coalesce(n.address, '') = '' THEN coalesce(s.address, n.address) ELSE n.address END AS address FROM stored s FULL JOIN scan n USING (doc_num)")
def overwrite_if_filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.overwrite_if_filled(*_halves(spark, sf_dir), "doc_num")


UNION = with_views("d_filing") + f""",
f AS (SELECT doc_num, pos, CAST(CAST(filed + INTERVAL 60 DAY AS DATE) AS VARCHAR) AS sale_date FROM d_filing),
stored AS (SELECT doc_num, CASE WHEN pos % 4 = 0 THEN '' ELSE 'S' || pos END AS address, sale_date FROM f WHERE pos % 10 < 6),
scan AS (SELECT doc_num, CASE WHEN pos % 3 = 0 THEN '' ELSE 'N' || pos END AS address, sale_date FROM f WHERE pos % 10 >= 3),
merged AS (SELECT n.doc_num, CASE WHEN n.address = '' AND coalesce(s.address, '') <> '' THEN s.address ELSE n.address END AS address, n.sale_date FROM scan n LEFT JOIN stored s ON n.doc_num = s.doc_num
  UNION ALL SELECT * FROM stored WHERE doc_num NOT IN (SELECT doc_num FROM scan) AND sale_date >= '{AS_OF}')
SELECT *, CASE WHEN sale_date < '{AS_OF}' THEN 'post' ELSE 'pre' END AS status, CAST(date_diff('day', DATE '{AS_OF}', CAST(sale_date AS DATE)) AS INT) AS days_until_sale FROM merged"""


@query(UNION)
def union_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    f, pos = view(spark, sf_dir, "d_filing"), F.col("pos")
    part = lambda letter, n: f.select("pos", "doc_num", F.when(pos % n == 0, "").otherwise(F.concat(F.lit(letter), pos.cast("string"))).alias("address"), F.date_add("filed", 60).cast("string").alias("sale_date"))
    stored, new = part("S", 4).where(pos % 10 < 6).drop("pos"), part("N", 3).where(pos % 10 >= 3).drop("pos")
    return merge.upsert_foreclosures(stored, new, "doc_num", ["address"], AS_OF)


@query(LEADS + """, named AS (SELECT *, trim(owner) AS o, string_split(trim(owner), ' ') AS w FROM scored)
SELECT doc_num, CASE WHEN o = '' OR regexp_matches(o, '(?i)\\b(LLC|INC|CORP|LP|LLP|LTD|TRUST|COMPANY|CO|HOLDINGS?)\\b') THEN '' ELSE upper(w[-1][1]) || lower(w[-1][2:]) END AS first_name,
  CASE WHEN o = '' THEN '' WHEN regexp_matches(o, '(?i)\\b(LLC|INC|CORP|LP|LLP|LTD|TRUST|COMPANY|CO|HOLDINGS?)\\b') THEN o
    ELSE array_to_string([upper(x[1]) || lower(x[2:]) FOR x IN w[:-2]], ' ') END AS last_name,
  coalesce(prop_address, '') AS prop_address, '' AS mail_address, doc_type, CAST(filed AS VARCHAR) AS filed, CASE WHEN amount > 0 THEN printf('%.2f', amount) ELSE '' END AS amount, CAST(score AS VARCHAR) AS score, array_to_string(flags, ' | ') AS flags, '' AS url FROM named""")
def crm_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The CRM export's own columns, under the names of the records."""
    s = scoring.score_leads(leads(spark, sf_dir), AS_OF)
    name = names.split_name("owner")
    rows = sinks.crm_rows(s.withColumns({"first_name": name["first"], "last_name": name["last"]})).toDF(*sinks.CRM_COLUMNS)
    return rows.select("doc_num", "first_name", "last_name", "prop_address", "mail_address", "doc_type", "filed", "amount", "score", "flags", "url")


SWAP = with_views("d_owner", "d_filing") + f""", p AS (
  SELECT doc_num, {CAT_SQL} AS cat, CASE WHEN pos % 4 = 0 THEN 'SAMPLE BANK NA' WHEN pos % 4 = 1 THEN 'UNITED STATES OF AMERICA' ELSE 'DOE ALEX' END AS grantor, owner AS grantee
  FROM d_filing JOIN d_owner USING (owner_id)), q AS (
  SELECT *, coalesce(cat IN ('LNFED', 'JUD', 'MEDLN', 'PRO', 'LN', 'CITYLN'), FALSE) AND grantor <> 'DOE ALEX' AND trim(grantee) <> '' AS swap FROM p)
SELECT doc_num, CASE WHEN swap THEN grantee ELSE grantor END AS owner, CASE WHEN swap THEN grantor ELSE grantee END AS other FROM q"""


@query(SWAP)
def institutional_swap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The party that files stands second where an institution files against an owner."""
    f = view(spark, sf_dir, "d_filing").join(view(spark, sf_dir, "d_owner"), "owner_id")
    pos = F.col("pos") % 4
    grantor = F.when(pos == 0, "SAMPLE BANK NA").when(pos == 1, "UNITED STATES OF AMERICA").otherwise("DOE ALEX")
    p = f.select("doc_num", codes.category("doc_type").alias("cat"), grantor.alias("grantor"), F.col("owner").alias("grantee"))
    swap = F.coalesce(F.col("cat").isin(*codes.ADVERSARIAL), F.lit(False)) & names.institutional("grantor") & (F.trim("grantee") != "")
    return p.select("doc_num", F.when(swap, F.col("grantee")).otherwise(F.col("grantor")).alias("owner"), F.when(swap, F.col("grantor")).otherwise(F.col("grantee")).alias("other"))


@query("""SELECT doc_id FROM documents WHERE contains(lower(text), 'licensed under') OR contains(lower(source), 'licensed under')""")
def free_text_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.search(table(spark, sf_dir, "documents"), "Licensed under", ["text", "source"]).select("doc_id")


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice >= 1000 ORDER BY o_totalprice DESC, o_orderkey LIMIT 50")
def topk_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.top_rows(table(spark, sf_dir, "orders").where("o_totalprice >= 1000").select("o_orderkey", "o_totalprice"), 50, F.desc("o_totalprice"), F.asc("o_orderkey"))


STACK = with_views("d_filing", "d_violation", "d_case_month") + """, k AS (
  SELECT DISTINCT 'filing' AS source, 'P' || (owner_id % 1000) AS property_key FROM d_filing
  UNION SELECT DISTINCT 'violation', 'P' || prop_id FROM d_violation
  UNION SELECT DISTINCT 'excess', 'P' || case_id FROM d_case_month)
SELECT property_key, string_agg(source, ',' ORDER BY source) AS sources, CAST(count(*) AS BIGINT) AS n_sources FROM k GROUP BY property_key"""


@query(STACK)
def stack_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = lambda name, key: view(spark, sf_dir, name).select(F.concat(F.lit("P"), F.expr(key).cast("string")).alias("account"), F.lit("").alias("address_key"))
    out = joins.stack({"filing": part("d_filing", "owner_id % 1000"), "violation": part("d_violation", "prop_id"), "excess": part("d_case_month", "case_id")})
    return out.select("property_key", F.array_join("sources", ",").alias("sources"), "n_sources")


@query("""SELECT event_id, json_extract_string(props, '$.k') AS k FROM events""")
def json_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", F.get_json_object("props", "$.k").alias("k"))


@query(LEADS + " SELECT cat AS cat_label, cat, min(pos) AS first_pos FROM scored WHERE cat IS NOT NULL GROUP BY cat")
def category_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.categories(leads(spark, sf_dir).where("cat is not null").withColumn("cat_label", F.col("cat")), "pos")
