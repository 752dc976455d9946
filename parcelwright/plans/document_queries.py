"""Affidavits, match words, legal cross-references, scans of pages, stores and batches over rendered rows."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import addresses
from ..operators import affidavits, batches, extraction, legal_index, lookups, merge, scans, store
from ..sources import mirrors
from .lookup_queries import t
from .notice_cases import CASES
from .record_queries import when
from .views import spread, table, view, with_views

QUERIES: dict = {}
ORACLES: dict = {}


def query(oracle: str | None):  # noqa: ANN201
    def add(f):  # noqa: ANN001, ANN202
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return add


AFFIDAVITS = """WITH o AS (SELECT o_orderkey AS id, o_orderkey AS k, o_orderkey % 12 AS f, 100 + o_orderkey % 900 AS h, o_custkey AS c FROM orders),
x AS (SELECT *, f NOT IN (4, 8, 10, 11) AS lien, 'Z' || k AS z FROM o)
SELECT id, CASE WHEN f = 11 THEN '' ELSE CAST(2025000000 + k AS VARCHAR) END AS doc_number, CASE WHEN f = 11 THEN '' WHEN f = 7 THEN '' ELSE '2025-07-' || lpad(CAST(k % 28 + 1 AS VARCHAR), 2, '0') END AS filed,
  CASE WHEN lien THEN 'D' || k ELSE '' END AS lien_id, CASE WHEN NOT lien THEN '' ELSE lpad(CAST(k % 10000 AS VARCHAR), 4, '0') || '-1601-0380' END AS account,
  CASE WHEN NOT lien THEN '' WHEN f = 7 THEN 'SAMPLE AND DOE LT ' || h || ' BK 3' WHEN f = 5 THEN 'SAMPLE ACRES 2 LOT ' || h || ', 7 BLK 3' ELSE 'SAMPLE PARK BLK 8 LOT ' || h END AS legal,
  CASE WHEN NOT lien OR f = 6 THEN '' WHEN f = 5 THEN h || ' 7TH ST' ELSE h || ' OAK ST' END AS prop_address, CASE WHEN NOT lien OR f = 6 THEN '' ELSE 'CORPUS CHRISTI' END AS prop_city, CASE WHEN NOT lien OR f = 6 THEN '' ELSE 'TX' END AS prop_state,
  CASE WHEN f = 0 THEN '78404' WHEN f = 3 AND h % 2 = 0 THEN '78405' ELSE '' END AS prop_zip,
  CASE f WHEN 0 THEN 'DOE CASEY ' || c WHEN 1 THEN 'SAMPLE RETAIL & ' || c || ' OPERATIONS LLC' WHEN 2 THEN 'SAMPLE ' || c || ' LLC' WHEN 3 THEN 'DOE ALEX ' || c WHEN 5 THEN 'SAMPLE ' || c || ' REAL ESTATE GROUP' WHEN 6 THEN 'DOE CASEY ' || c WHEN 7 THEN 'DOE ' || c WHEN 9 THEN 'ROE ' || c ELSE '' END AS owner,
  CASE WHEN f = 3 THEN 'CASEY ROE' ELSE '' END AS spouse,
  CASE f WHEN 0 THEN h || ' Oak St' WHEN 1 THEN 'ATTN TAX DEPT ' || h || ' ELM DR' WHEN 2 THEN h || ' ELM ST STE ' || c WHEN 3 THEN (h - h % 2) || ' OAK ST' WHEN 5 THEN 'PO BOX ' || c WHEN 6 THEN 'OLD TOWN, TX 70000 REAR ' || h || ' ELM ST' WHEN 7 THEN 'ROBSTOWN, TX 78380' WHEN 9 THEN 'PO BOX ' || c ELSE '' END AS mail_address,
  CASE f WHEN 0 THEN 'CORPUS CHRISTI' WHEN 1 THEN 'NASHVILLE' WHEN 2 THEN 'DALLAS' WHEN 3 THEN 'CORPUS CHRISTI' WHEN 5 THEN 'ROBSTOWN' WHEN 6 THEN 'BISHOP' WHEN 7 THEN 'ROBSTOWN' ELSE '' END AS mail_city,
  CASE WHEN f = 1 THEN 'TN' WHEN f IN (0, 2, 3, 5, 6, 7) THEN 'TX' ELSE '' END AS mail_state, CASE f WHEN 0 THEN '78404' WHEN 1 THEN '37214' WHEN 2 THEN '75201' WHEN 3 THEN '78405' WHEN 5 THEN '78380' WHEN 6 THEN '78343' WHEN 7 THEN '78380' ELSE '' END AS mail_zip,
  CASE WHEN NOT lien OR f = 9 THEN '' ELSE '2025-06-' || lpad(CAST(k % 28 + 1 AS VARCHAR), 2, '0') END AS work_date, CASE WHEN lien AND f <> 9 THEN CAST(1000 + k % 1000 + 0.25 AS DOUBLE) END AS amount,
  CASE WHEN NOT lien THEN '' WHEN k % 3 = 0 THEN 'substandard_building,demolition' WHEN k % 3 = 1 THEN 'carrion,filth,weeds,rubbish' ELSE 'weeds,brush' END AS reasons,
  CASE f WHEN 4 THEN 'utility_lien_not_abatement' WHEN 8 THEN 'correcting_document_not_abatement' WHEN 10 THEN 'real_estate_lien_note_not_abatement' ELSE '' END AS flags FROM x"""


@query(AFFIDAVITS)
def affidavits_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twelve layouts: owners at home and elsewhere, couples, companies over one line, two and with a
    suite, broken account numbers and streets, no street, no place, a place that is no last line, three kinds of other papers."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    f, h = k % 12, F.lit(100) + k % 900
    day = (k % 28 + 1).cast("string")
    account = lambda joint: t(F.lpad((k % 10000).cast("string"), 4, "0"), joint, "1601-0380")
    head = t("\n  2025 - ", F.lit(2025000000) + k, " ", when(f == 7, "13", "07"), "/", day, "/2025 12:37 PM Page 1 of 2\n\n")
    title = F.when(f == 4, "AFFIDAVIT OF CITY OF CORPUS CHRISTI\nUTILITY LIEN\n").when(f == 8, "CORRECTING DOCUMENT\n").when(f == 10, "REAL ESTATE LIEN NOTE\n").otherwise("")
    what = F.when(k % 3 == 0, "demolishing substandard buildings").when(k % 3 == 1, "Filth, carrion, weeds, rubbish").otherwise("brush, weeds")
    work = t("of removing, cleaning, clearing ", what, " and other unwholesome\nmatter on the lot\n\n")
    lot = F.when(f == 7, t("SAMPLE AND DOE LT ", h, " BK 3")).when(f == 5, t("SAMPLE ACRES 2 LOT ", h, ", 7 BLK 3")).otherwise(t("SAMPLE PARK BLK 8 LOT ", h))
    street = F.when(f == 5, t(" No, ", account("- .\n"), ", ", h, " 7TH\nST\n\n")).when(f == 6, t(" No. ", account("-"), ".\n")).otherwise(t(" No. ", account("-"), ". ", h, " OAK ST\n\n"))
    done = when(f != 9, t("That said work was completed on or about 6/", day, "/2025, at a total cost of $1,", F.lpad((k % 1000).cast("string"), 3, "0"), ".25\n\n"))
    lines = {
        0: ("DOE CASEY ", c, "\n", h, " Oak St\nCORPUS CHRISTI, TX 78404"), 1: ("SAMPLE RETAIL & ", c, "\n OPERATIONS LLC\nATTN TAX DEPT ", h, " ELM DR\nNASHVILLE, TN 37214-0000"),
        2: ("SAMPLE ", c, " LLC\n\n", h, " ELM ST\nSTE ", c, "\nDALLAS, TX 75201,"), 3: ("DOE ALEX ", c, " AND WF CASEY ROE\n", h - h % 2, " OAK ST\nCORPUS CHRISTI, TX  78405"),
        5: ("SAMPLE ", c, "\nREAL ESTATE GROUP\nPO BOX ", c, "\nROBSTOWN, TX 78380"), 6: ("DOE CASEY ", c, "\nOLD TOWN, TX 70000\nREAR ", h, " ELM ST\nBISHOP, TX 78343\nUSA"),
        7: ("DOE ", c, "\nROBSTOWN, TX 78380"), 9: ("ROE ", c, "\nPO BOX ", c, "\nGENERAL DELIVERY"),
    }
    block = F.lit("")
    for n, parts in lines.items():
        block = F.when(f == n, t(*parts)).otherwise(block)
    owner = t("That the record owner of the premises is", when(f == 7, "", ":"), "\n\n", block, "\n\n", when(f == 5, "'That sald", "That said"), " amount bears interest\n")
    text = t(head, title, "AFFIDAVIT OF LIEN D", k, "\n", work, lot, ", and further described in whole or in part by Account", street, done, owner)
    out = affidavits.affidavit_fields(table(spark, sf_dir, "orders").select(k.alias("id"), F.when(f != 11, text).alias("text")))
    return out.drop("text").withColumn("reasons", F.array_join("reasons", ",")).withColumn("flags", F.array_join("flags", ","))


TOKENS = """WITH p AS (SELECT p_partkey AS id, p_partkey % 16 AS f, CAST(100 + p_partkey % 9000 AS VARCHAR) AS h, upper(split_part(p_name, ' ', 1)) AS w, upper(split_part(p_name, ' ', 2)) AS v FROM part)
SELECT id, CASE f WHEN 0 THEN h || ' N ' || w WHEN 1 THEN h || ' ' || w WHEN 2 THEN h || ' 21ST' WHEN 3 THEN h || ' MC' || w || ' ' || v WHEN 4 THEN h || ' 20TH 9TH ' || w WHEN 5 THEN h || ' O' || w || ' ' || v WHEN 6 THEN h || ' ' || w || ' S'
  WHEN 7 THEN '' WHEN 8 THEN h || ' NE ' || w || ' ' || v WHEN 9 THEN h || ' THIRTY ' || w WHEN 10 THEN h || ' MCMC MC' || w WHEN 11 THEN h || ' ' || w || ' ' || v WHEN 12 THEN h || ' SE' WHEN 13 THEN h || ' 11TH ' || w || ' 5 12' WHEN 14 THEN h || ' ' || w || ' 4' ELSE '' END AS full_key,
  CASE f WHEN 0 THEN h || ' ' || w WHEN 1 THEN h || ' ' || w WHEN 2 THEN h || ' 21ST' WHEN 3 THEN h || ' MC' || w || ' ' || v WHEN 4 THEN h || ' 20TH 9TH ' || w WHEN 5 THEN h || ' O' || w || ' ' || v WHEN 6 THEN h || ' ' || w || ' S'
  WHEN 7 THEN '' WHEN 8 THEN h || ' ' || w || ' ' || v WHEN 9 THEN h || ' THIRTY ' || w WHEN 10 THEN h || ' MCMC MC' || w WHEN 11 THEN h || ' ' || w || ' ' || v WHEN 12 THEN h || ' SE' WHEN 13 THEN h || ' 11TH ' || w || ' 5 12' WHEN 14 THEN h || ' ' || w || ' 4' ELSE '' END AS loose_key FROM p"""


@query(TOKENS)
def match_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses of sixteen shapes about the words of part names: directions, ordinals of one and two words,
    MC, apostrophes, block codes, units after the street's type, service words, nothing at all."""
    k = F.col("p_partkey")
    h, w, v = (F.lit(100) + k % 9000).cast("string"), F.split("p_name", " ")[0], F.split("p_name", " ")[1]
    shapes = [
        (h, " North ", w, " Street"), (h, " ", w, " ST 101"), (h, " Twenty First Ave. #4"), (h, " mc ", w, " ", v, " lane C"), (h, " twentieth NINTH ", w), (h, " O'", w, " BL002 ", v, " rd"), (h, " ", w, " Dr South"), (" ",),
        (h, " northeast ", w, "/", v, " blvd UNIT 7 rear"), (h, " thirty ", w), (h, " MC MC MC ", w), (h, " ", w, " ", v, " Apt 4 ", w), (h, " ST southeast"), (h, " Eleventh ", w, ", Way 5 12"), (h, " ", w, " 4"), ("STE ", h, " ", w),
    ]
    raw = F.lit(None).cast("string")
    for n, parts in enumerate(shapes):
        raw = F.when(k % 16 == n, t(*parts)).otherwise(raw)
    words = table(spark, sf_dir, "part").select(k.alias("id"), addresses.address_words(raw).alias("words"))
    return words.select("id", addresses.full_key("words").alias("full_key"), addresses.key_without_direction("words").alias("loose_key"))


CROSS = with_views("d_parcel") + """, q AS (
  SELECT prop_id, owner_id, situs, market_value, legal, regexp_extract(legal, 'LOT ([0-9]+)', 1) AS lot, regexp_extract(legal, 'BLK ([0-9]+)', 1) AS block FROM d_parcel
), hit AS (
  SELECT a.prop_id AS id, a.prop_id % 6 AS f, min(b.prop_id) AS found FROM q a JOIN q b ON a.owner_id = b.owner_id
  WHERE CASE a.prop_id % 6 WHEN 0 THEN a.lot = b.lot AND a.block = b.block WHEN 1 THEN a.lot = b.lot AND a.block = b.block WHEN 3 THEN a.block = b.block AND a.lot = b.lot ELSE FALSE END GROUP BY ALL
) SELECT h.id, CASE WHEN h.f = 3 THEN 'subdivision' ELSE 'name' END AS stage, h.found AS prop_id, regexp_replace(p.situs, ' +', ' ', 'g') AS prop_address, 'CORPUS CHRISTI' AS prop_city, 'TX' AS prop_state, p.market_value AS appraised_value FROM hit h JOIN q p ON p.prop_id = h.found"""


@query(CROSS)
def cross_referenced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records with a legal and no address: found under the owner's own name, the second borrower's, the
    subdivision's name; without a block, without a lot, or not open at all."""
    k, o = F.col("prop_id"), F.col("owner_id")
    p = view(spark, sf_dir, "d_parcel")
    lot, block = F.regexp_extract("legal", r"LOT (\d+)", 1), F.regexp_extract("legal", r"BLK (\d+)", 1)
    name = t("SAMPLE OWNER", o)
    owner = F.when(k % 6 == 1, t("NOBODY ", k, " AND WIFE, ", name)).when(k % 6 == 3, "NOBODY AT ALL").when(k % 6 == 5, "").otherwise(name)
    records = p.select(
        k.alias("doc_num"), owner.alias("owner"), F.lit("").alias("prop_address"), when(k % 6 != 4, lot).alias("legal_lot"), when(k % 6 != 2, block).alias("legal_block"), when(k % 6 == 3, name, "SAMPLE").alias("legal_subdivision")
    )
    # Rows of a search by name; every legal names SAMPLE and, for the search by subdivision, the owner's name.
    rows = p.select(name.alias("name"), k.alias("pos"), t(F.col("legal"), " ", name).alias("legal"), "situs", F.col("market_value").alias("appraised_value"))
    out = legal_index.cross_referenced(records, rows)
    return out.select(F.col("doc_num").alias("id"), "stage", F.col("pos").alias("prop_id"), "prop_address", "prop_city", "prop_state", "appraised_value")


@query("""WITH r AS (SELECT l_orderkey % 40 AS scan, 1 + (l_orderkey // 40) % 6 AS page, l_orderkey * 10 + l_linenumber AS doc, l_orderkey FROM lineitem),
v AS (SELECT scan, page, CASE WHEN scan % 4 = 1 AND page = 3 THEN 1 ELSE page END AS like_page, doc FROM r WHERE NOT (scan % 4 = 2 AND page = 4)),
d AS (SELECT DISTINCT scan, page, like_page, doc FROM v), n AS (SELECT scan, page, count(*) AS n_rows FROM v GROUP BY ALL),
s AS (SELECT scan, min(CASE WHEN scan % 4 = 1 AND page = 3 THEN page - 1 WHEN scan % 4 = 2 AND page = 4 THEN page - 1 WHEN scan % 4 = 3 AND page = 2 THEN page END) AS last FROM r GROUP BY scan)
SELECT n.scan, n.page, n.n_rows, CASE WHEN n.scan % 4 = 3 AND n.page = 2 THEN 'known' ELSE '' END AS why FROM n JOIN s USING (scan) WHERE n.page <= coalesce(s.last, 6) AND n.page <= CASE WHEN n.scan % 4 = 1 THEN 2 ELSE 6 END""")
def pages_walked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forty walks over six pages: to the end, to a page that repeats the first, to a missing one, to one
    that is known."""
    k, line = F.col("l_orderkey"), F.col("l_linenumber")
    scan, page = k % 40, 1 + F.floor(k / 40) % 6
    rows = table(spark, sf_dir, "lineitem").select(scan.alias("scan"), page.alias("page"), (k * 10 + line).alias("doc"))
    first = rows.where("scan % 4 = 1 and page = 1").withColumn("page", F.lit(3).cast("long"))
    rows = rows.where("not (scan % 4 = 1 and page = 3) and not (scan % 4 = 2 and page = 4)").unionByName(first).withColumn("doc_num", F.col("doc").cast("string"))
    known = rows.where("scan % 4 = 3 and page = 2").select("doc_num")
    return scans.pages_reached(rows, known, page_rows=1)


CATEGORIES = ("LP", "CCLN", "LN", "JUD")


@query("""WITH r AS (SELECT o_orderkey AS doc, ['LP', 'CCLN', 'LN', 'JUD', 'X'][CAST(i AS BIGINT)] AS category, i - 1 AS ord, CASE WHEN i = 4 THEN o_orderkey % 3 ELSE 0 END AS alias, CASE WHEN o_orderkey % 50 = 0 THEN '' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS filed
  FROM orders, (VALUES (1), (2), (3), (4), (5)) AS c(i) WHERE CASE i WHEN 1 THEN o_orderkey % 2 = 0 WHEN 2 THEN o_orderkey % 7 = 0 WHEN 3 THEN o_orderkey % 3 = 0 WHEN 4 THEN o_orderkey % 3 <> 0 ELSE TRUE END),
k AS (SELECT * FROM r WHERE category <> 'X' AND (filed = '' OR filed BETWEEN '1994-01-01' AND '1996-12-31')),
a AS (SELECT k.* FROM k JOIN (SELECT category, min(alias) AS alias FROM k GROUP BY category) m USING (category, alias))
SELECT doc, category, filed FROM a QUALIFY row_number() OVER (PARTITION BY doc ORDER BY CASE WHEN category = 'CCLN' THEN 0 ELSE 1 END, ord) = 1""")
def category_scanned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders found under several categories, of which one is more specific and one has aliases."""
    k = F.col("o_orderkey")
    found = {"LP": k % 2 == 0, "CCLN": k % 7 == 0, "LN": k % 3 == 0, "JUD": k % 3 != 0, "X": F.lit(True)}
    rows = table(spark, sf_dir, "orders").withColumn("category", F.explode(F.array_compact(F.array(*[F.when(test, c) for c, test in found.items()]))))
    filed = when(k % 50 != 0, F.date_format("o_orderdate", "yyyy-MM-dd"))
    rows = rows.select("category", F.when(F.col("category") == "JUD", k % 3).otherwise(0).alias("alias"), F.floor(k / 250).alias("page"), k.alias("pos"), k.cast("string").alias("doc_num"), filed.alias("filed"))
    out = scans.category_scan(rows, start="1994-01-01", end="1996-12-31", categories=CATEGORIES, specific={"CCLN": 1})
    return out.select(F.col("doc_num").cast("long").alias("doc"), "category", "filed")


def _store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries of versions 2 to 7 by name, and some by address without a version."""
    k = F.col("c_custkey")
    by_address = k % 9 == 0
    key = F.when(by_address, t("ccln_addr::", k, " sample st")).otherwise(t("DOE ", k))
    field = lambda n, v: when(k % n != 0, v)
    return table(spark, sf_dir, "customer").select(
        key.alias("key"), F.when(~by_address, (k % 6 + 2).cast("int")).alias("version"), field(5, t(k, " SAMPLE ST")).alias("site_addr"), F.when(k % 7 == 0, "0").otherwise(k.cast("string")).alias("appraised_value"),
        field(11, t("PO BOX ", k)).alias("mail_addr"), field(13, k.cast("string")).alias("ncad_prop_id"), field(4, t("LOT ", k)).alias("ncad_legal"),
    )


STORE = """c AS (SELECT c_custkey AS k, c_custkey % 9 = 0 AS by_address, c_custkey % 6 + 2 AS version, c_custkey % 5 <> 0 AS hit FROM customer),
held AS (SELECT k, CASE WHEN by_address THEN 'ccln_addr::' || k || ' sample st' ELSE 'DOE ' || k END AS key, by_address, hit FROM c WHERE by_address OR version = 6 OR (version IN (3, 4, 5) AND hit))"""


@query(f"""WITH {STORE}, asked AS (SELECT CASE WHEN c_custkey % 9 = 0 THEN 'ccln_addr::' || c_custkey || ' sample st' ELSE 'DOE ' || c_custkey END AS key FROM customer UNION ALL SELECT 'NEW ' || c_custkey FROM customer WHERE c_custkey % 10 = 0)
SELECT a.key, CASE WHEN h.key IS NULL THEN 'new' WHEN NOT h.hit THEN 'miss' WHEN h.by_address THEN NULL WHEN h.k % 7 = 0 THEN 'lacks appraised_value' WHEN h.k % 11 = 0 THEN 'lacks mail_addr' WHEN h.k % 13 = 0 THEN 'lacks ncad_prop_id' WHEN h.k % 4 = 0 THEN 'lacks ncad_legal' END AS reason
FROM asked a LEFT JOIN held h USING (key)""")
def store_asks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What must be looked up again in a store of versions 2 to 7, misses included, and what is new."""
    held = _store(spark, sf_dir)
    new = table(spark, sf_dir, "customer").where("c_custkey % 10 = 0").select(t("NEW ", F.col("c_custkey")).alias("key"))
    return store.to_ask(held.select("key").unionByName(held.select("key")).unionByName(new), held, retry_misses=True)


@query(f"""WITH {STORE}, ans AS (SELECT c_custkey AS k, 'DOE ' || c_custkey AS key, CASE WHEN c_custkey % 4 = 1 THEN '' ELSE c_custkey || ' NEW ST' END AS site FROM customer WHERE c_custkey % 2 = 1)
SELECT coalesce(h.key, a.key) AS key, CASE WHEN h.by_address THEN NULL ELSE 6 END AS version, CASE WHEN a.key IS NOT NULL AND (a.site <> '' OR NOT coalesce(h.hit, FALSE)) THEN a.site WHEN h.hit THEN h.k || ' SAMPLE ST' ELSE '' END AS site_addr
FROM held h FULL JOIN ans a USING (key)""")
def store_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New answers, hits and misses, over old hits, old misses and nothing; a key's last answer counts."""
    k = F.col("c_custkey")
    answers = table(spark, sf_dir, "customer").where("c_custkey % 2 = 1").select(t("DOE ", k).alias("key"), F.explode(F.array(F.lit(0), F.lit(1))).alias("pos"), k.alias("k"))
    answers = answers.select("key", "pos", F.when(F.col("pos") == 0, "1 OUTDATED ST").when(F.col("k") % 4 == 1, "").otherwise(t(F.col("k"), " NEW ST")).alias("site_addr"))
    return store.merged(_store(spark, sf_dir), answers, ["site_addr"])


@query("""WITH n AS (SELECT count(*) AS n, count(*) FILTER (o_orderkey % 3 = 0) AS hits FROM (SELECT DISTINCT o_orderkey FROM orders)), b AS (SELECT unnest(range(0, (n + 499) // 500)) AS batch, n FROM n)
SELECT batch, least(500, n - 500 * batch) AS n_rows, batch * 500 AS first, batch * 500 + least(500, n - 500 * batch) - 1 AS last, (SELECT hits FROM n) AS all_hits FROM b""")
def geocode_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leads, some of them twice, in batches of 500 that are numbered without a gap, and the service's answers by batch."""
    k = F.col("o_orderkey")
    leads = table(spark, sf_dir, "orders").select(k.alias("uid"), t(k, " SAMPLE ST").alias("street"))
    out = batches.batched(leads.unionByName(leads.where("uid % 5 = 0")), size=500, bucket=400)
    says = F.when(F.col("uid") % 3 == 0, "Match").when(F.col("uid") % 3 == 1, "Tie").otherwise("No_Match")
    answers = out.select("batch", "uid", says.alias("match"), F.lit("-97.25,27.5").alias("lon_lat")).union(out.select(F.col("batch") + 1, "uid", F.lit("Match"), F.lit("-1,1")))
    found = batches.answered(out, answers).groupBy("batch").agg(F.count("*").alias("n_rows"), F.min("number").alias("first"), F.max("number").alias("last"), F.count_if((F.col("lat") == 27.5) & (F.col("lon") == -97.25)).alias("hits"))
    hits = found.agg(F.sum("hits").alias("all_hits"))
    return found.drop("hits").crossJoin(F.broadcast(hits))  # one row


def _copies(k: Column) -> dict[int, Column]:
    """Three mirrors of a customer's list: broken or whole, as object or as list."""
    records = t('[{"id": ', k, '}, {"id": ', k + 1, "}]")
    whole = t('{"source": "clerk", "total": 9, "date_range": {"start": ', k, '}, "records": ', records, "}")
    return {
        0: F.when(k % 5 == 0, whole).when(k % 5 == 1, t('{"records": [', k)).when(k % 5 == 2, t('{"other": ', k, "}")).when(k % 5 == 3, "").otherwise("oops"),
        1: F.when(k % 5 == 1, records).when(k % 5 == 2, t('{"records": []}')).otherwise("[1"), 2: F.when(k % 5 == 3, whole),
    }


@query("""SELECT c_custkey AS id, CASE c_custkey % 5 WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END AS rank, CASE c_custkey % 5 WHEN 2 THEN 0 ELSE 2 END AS n_records, CASE WHEN c_custkey % 5 IN (0, 3) THEN 'date_range,source,total' ELSE '' END AS kept,
  CASE WHEN c_custkey % 5 IN (0, 3) THEN '{"date_range": {"start":' || c_custkey || '}, "source": "clerk"' ELSE '{"source": "copy"' END || ', "fetched_at": "2026-01-02", "total": ' || CASE c_custkey % 5 WHEN 2 THEN 0 ELSE 2 END || ', "records": ['
  || CASE c_custkey % 5 WHEN 2 THEN '' ELSE '{"id":' || c_custkey || '}, {"id":' || (c_custkey + 1) || '}' END || ']}' AS stored FROM customer WHERE c_custkey % 5 <> 4""")
def mirrors_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first readable of three mirrors, and what is written back under its envelope."""
    k = F.col("c_custkey")
    files = F.array(*[F.struct(F.lit(n).alias("rank"), v.alias("value")) for n, v in _copies(k).items()])
    rows = table(spark, sf_dir, "customer").select(k.alias("id"), F.explode(files).alias("f")).select("id", "f.*")
    out = mirrors.first_readable(rows, by=["id"])
    stored = mirrors.stored_again(F.col("envelope"), F.col("records"), fetched_at=F.lit("2026-01-02"), source="copy")
    return out.select("id", "rank", F.size("records").alias("n_records"), F.array_join(F.array_sort(F.map_keys("envelope")), ",").alias("kept"), stored.alias("stored"))


@query("""SELECT c_custkey AS id, ['missing', 'unreadable', 'wrong_root_type', 'unsupported_version: v' || c_custkey, 'unsupported_version: None', 'malformed_data', 'v6', 'v6'][CAST(c_custkey % 8 + 1 AS BIGINT)] AS state FROM customer""")
def cache_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    values = [F.lit(None).cast("string"), t('{"_version": "v6", ', k), t("[", k, "]"), t('{"_version": "v', k, '", "data": {}}'), t('{"data": {"a": ', k, "}}"), t('{"_version": "v6", "data": [', k, "]}"), t('{"_version": "v6", "data": {"a": ', k, "}}"), F.lit('{"_version": "v6"}')]
    value = F.lit(None).cast("string")
    for n, v in enumerate(values):
        value = F.when(k % 8 == n, v).otherwise(value)
    return table(spark, sf_dir, "customer").select(k.alias("id"), mirrors.cache_state(value).alias("state"))


def _letters(k: Column) -> Column:
    """A word of four letters that tells 676 keys apart; in SQL below."""
    return F.concat(F.char(F.lit(65) + k % 26), F.lit("A"), F.char(F.lit(65) + F.floor(k / 26) % 26), F.lit("E"))


_LETTERS_SQL = "chr(CAST(65 + k % 26 AS INT)) || 'A' || chr(CAST(65 + k // 26 % 26 AS INT)) || 'E'"


def _rendered(template: str, k: Column) -> Column:
    """A template of `notice_cases` filled for key k."""
    letters = _letters(k)
    values = {"p": t("CASEY D", letters), "q": t("ALEX R", letters), "e": t("SAMPLE ", letters, " HOMES"), "n": t(F.lit(2010000000) + k), "d": F.lpad((k % 18 + 10).cast("string"), 2, "0"), "h": t(F.lit(100) + k % 900)}
    out = []
    for i, piece in enumerate(re.split(r"\{(\w)\}", template)):
        out.append(values[piece] if i % 2 else F.lit(piece))
    return F.concat(*out)


def _rendered_sql(template: str) -> str:
    values = {
        "p": f"'CASEY D' || {_LETTERS_SQL}", "q": f"'ALEX R' || {_LETTERS_SQL}", "e": f"'SAMPLE ' || {_LETTERS_SQL} || ' HOMES'", "n": "CAST(2010000000 + k AS VARCHAR)",
        "d": "CAST(k % 18 + 10 AS VARCHAR)", "h": "CAST(100 + k % 900 AS VARCHAR)",
    }
    return " || ".join(values[piece] if i % 2 else f"'{piece}'" for i, piece in enumerate(re.split(r"\{(\w)\}", template)) if piece)


_CASE_SQL = " ".join(f"WHEN {i} THEN {_rendered_sql(value)}" for i, (_, _, _, value) in enumerate(CASES))
_FIELD_SQL = " ".join(f"WHEN {i} THEN '{field}'" for i, (field, _, _, _) in enumerate(CASES))


@query(f"""WITH o AS (SELECT o_orderkey AS id, o_orderkey AS k, o_orderkey % {len(CASES)} AS f FROM orders) SELECT id, CASE f {_FIELD_SQL} END AS field, CASE f {_CASE_SQL} END AS said FROM o""")
def notice_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A notice for each pattern by which a field of a foreclosure notice is found."""
    k = F.col("o_orderkey")
    notice, field = F, F
    for i, (name, _, template, _) in enumerate(CASES):
        notice = notice.when(k % len(CASES) == i, _rendered(template, k))
        field = field.when(k % len(CASES) == i, F.lit(name))
    read = extraction.notice_fields(spread(table(spark, sf_dir, "orders"), "o_orderkey").select(k.alias("id"), notice.alias("text"), field.alias("field")))
    said = F.lit(None).cast("string")
    for name in dict.fromkeys(c[0] for c in CASES):
        said = F.when(F.col("field") == name, F.col(name).cast("string")).otherwise(said)
    return read.select("id", "field", said.alias("said"))


@query("""WITH r AS (SELECT o_orderkey AS k, o_orderkey % 6 AS f FROM orders) SELECT k AS id, CASE f WHEN 0 THEN 'no-prop-id' WHEN 1 THEN 'skipped-already' WHEN 2 THEN 'no-account-on-page' WHEN 3 THEN 'no-account-on-page' ELSE 'matched' END AS result,
  CASE WHEN f > 3 THEN '2540-' || k END AS account FROM r""")
def account_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records without a parcel, with an account, whose page shows none or isn't there, found twice, found in the default year."""
    k = F.col("o_orderkey")
    base = table(spark, sf_dir, "orders")
    records = base.select(k.alias("doc_num"), when(k % 6 != 0, t(" ", k)).alias("prop_id"), when(k % 6 != 5, "2024", " ").alias("year"), F.lit(None).cast("string").alias("owner_id"), when(k % 6 == 1, "1").alias("account"))
    page = lambda rows, year, account: rows.select(t(k).alias("prop_id"), F.lit(year).alias("year"), F.lit("").alias("owner_id"), account.alias("account"))
    pages = page(base.where(k % 6 != 3), "2024", when(k % 6 != 2, t("2540-", k))).unionByName(page(base.where(k % 6 == 4), "2024", t("2540-", k))).unionByName(page(base.where(k % 6 == 5), "2026", t("2540-", k)))
    out = lookups.accounts(records, pages.where("not (year = '2024' and cast(prop_id as long) % 6 = 5)"))
    return out.select(F.col("doc_num").alias("id"), "result", "account")


@query("""SELECT o_orderkey AS id, CASE WHEN f < 3 THEN 'NEW ' || k END AS owner, CASE WHEN f = 0 THEN k || '.5' END AS market_value, CASE WHEN f < 4 THEN '0' END AS ncad_prop_id, CASE WHEN f = 2 THEN '2024' WHEN f < 4 THEN '2026' END AS ncad_year,
  CASE WHEN f = 1 THEN 'PO BOX ' || k END AS mail_address FROM (SELECT o_orderkey, o_orderkey AS k, o_orderkey % 5 AS f FROM orders)""")
def additions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values, blanks, zeros that count and that do not, defaults, and records that nothing was found for."""
    k = F.col("o_orderkey")
    f = k % 5
    base = table(spark, sf_dir, "orders")
    best = base.where(f < 4).select(k.alias("id"), when(f < 3, t("NEW ", k), "  ").alias("o"), F.when(f == 0, k + 0.5).when(f == 1, 0.0).alias("v"), F.lit("0").alias("p"), F.when(f == 2, "2024").alias("y"), F.when(f == 1, t("PO BOX ", k)).otherwise("").alias("m"))
    out = merge.additions(base.select(k.alias("id")), best, "id", fields={"owner": "o", "market_value": "v", "ncad_prop_id": "p", "ncad_year": "y"}, block={"mail_address": "m"}, default={"ncad_year": "2026"})
    return out.withColumn("market_value", F.col("market_value").cast("string"))
