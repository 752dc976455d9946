"""Look-up drivers, mail blocks, payloads and small projections over rendered rows of the tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import identifiers, mail
from ..operators import lookups, ranking
from ..sources import payloads
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


def t(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


CITIES = ("CORPUS CHRISTI", "ROBSTOWN", "PORT ARANSAS")
CITY_SQL = "CASE c_custkey % 3 WHEN 0 THEN 'CORPUS CHRISTI' WHEN 1 THEN 'ROBSTOWN' ELSE 'PORT ARANSAS' END"
ZIP_SQL = "CAST(78400 + c_custkey % 90 AS VARCHAR)"


@query(f"""SELECT c_custkey,
  CASE WHEN c_custkey % 7 = 6 THEN '' WHEN c_custkey % 7 = 4 THEN 'P.O. BOX ' || c_custkey ELSE CAST(c_custkey AS VARCHAR) || ' SAMPLE ' || upper(c_mktsegment) || ' ST' END AS street,
  CASE WHEN c_custkey % 7 = 6 THEN '' ELSE {CITY_SQL} END AS city,
  CASE WHEN c_custkey % 7 = 2 THEN 'OK' ELSE 'TX' END AS state,
  CASE WHEN c_custkey % 7 IN (5, 6) THEN '' ELSE {ZIP_SQL} END AS zip FROM customer""")
def mail_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks with and without co-owners, on one line and on several, post boxes, cities without commas."""
    k = F.col("c_custkey")
    city = F.when(k % 3 == 0, CITIES[0]).when(k % 3 == 1, CITIES[1]).otherwise(CITIES[2])
    zip_code, street = t(F.lit(78400) + k % 90), t(k, " SAMPLE ", F.upper("c_mktsegment"), " ST")
    block = (
        F.when(k % 7 == 0, t(street, "\n", city, ", TX ", zip_code)).when(k % 7 == 1, t("CASEY DOE ET UX\n", street, "\n", city, ", TX ", zip_code, "-1234"))
        .when(k % 7 == 2, t(street, ", ", city, ", OK ", zip_code)).when(k % 7 == 3, t(street, " ", city, ", TX ", zip_code))
        .when(k % 7 == 4, t("CASEY DOE\n\nP.O. BOX ", k, "\n", city, " TX ", zip_code)).when(k % 7 == 5, t("C/O DOE ", street, "\n", city)).otherwise("  ")
    )
    return spread(table(spark, sf_dir, "customer").select("c_custkey", block.alias("block")), "c_custkey").select("c_custkey", mail.mail_block("block", cities=CITIES).alias("m")).select("c_custkey", "m.*")


@query(f"""SELECT c_custkey,
  CASE WHEN c_custkey % 5 = 4 THEN '' ELSE CAST(c_custkey AS VARCHAR) || ' SAMPLE ST' END AS street,
  CASE WHEN c_custkey % 5 = 4 THEN '' WHEN c_custkey % 5 = 3 THEN 'NO PLACE GIVEN' ELSE {CITY_SQL} END AS city,
  CASE WHEN c_custkey % 5 >= 3 THEN '' ELSE 'TX' END AS state, CASE WHEN c_custkey % 5 >= 3 THEN '' ELSE {ZIP_SQL} END AS zip FROM customer""")
def mail_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    city = F.when(k % 3 == 0, CITIES[0]).when(k % 3 == 1, CITIES[1]).otherwise(CITIES[2])
    zip_code, street = t(F.lit(78400) + k % 90), t(k, " SAMPLE ST")
    cell = (
        F.when(k % 5 == 0, t(street, "\n", city, ", TX ", zip_code)).when(k % 5 == 1, t("CASEY DOE\n", street, "\n", city, ", TX ", zip_code, "-0001"))
        .when(k % 5 == 2, t(street, ", ", city, ", TX ", zip_code)).when(k % 5 == 3, t(street, "\nNO PLACE GIVEN"))
    )
    return spread(table(spark, sf_dir, "customer").select("c_custkey", cell.alias("cell")), "c_custkey").select("c_custkey", mail.mail_lines("cell").alias("m")).select("c_custkey", "m.*")


@query("""SELECT o_orderkey, CAST(2024000000 + o_orderkey AS VARCHAR) AS doc_number, o_orderstatus || '; B' AS names, 'A, B' AS listed
FROM orders WHERE o_orderkey % 3 <> 2""")
def payload_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents deep inside JSON payloads, beside menus and lists of other things."""
    k = F.col("o_orderkey")
    grantors = t('[{"name": "', F.col("o_orderstatus"), '"}, "", {"fullName": "B"}]')
    row = F.when(k % 3 == 0, t('{"docNumber": "', F.lit(2024000000) + k, '", "grantors": ', grantors, "}")).when(k % 3 == 1, t('{"id": 7, "docNumber": "', F.lit(2024000000) + k, '", "docType": "X", "grantors": ', grantors, "}")).otherwise(t('{"key": "a", "label": "', k, '"}'))
    body = t('{"menu": [{"key": "k", "label": "l", "id": 1}], "a": {"b": [1, {"results": [', row, "]}]}}")
    out = spread(table(spark, sf_dir, "orders"), "o_orderkey").select("o_orderkey", payloads.payload_documents(body).alias("rows"), payloads.joined_names(grantors).alias("names"), payloads.json_text(F.lit('["A", "", "B"]')).alias("listed"))
    return out.select("o_orderkey", F.explode("rows").alias("r"), "names", "listed").select("o_orderkey", F.col("r")["docNumber"].alias("doc_number"), "names", "listed")


@query("""SELECT o_orderkey, 'D' || o_orderkey AS doc, CASE WHEN o_orderkey % 2 = 0 THEN 'state' ELSE 'table' END AS via FROM orders""")
def page_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with a hydrated state (a script object with undefined and braces in texts), or a table only."""
    k = F.col("o_orderkey")
    script = t('<script>window.__data = {"x": undefined, "s": "a } b \\" {", "documents": {"workspaces": {"w": {"data": {"byHash": {"h": {"doc": "D', k, '", "via": "state"}}}}}}};</script>')
    plain = t("<table><tr><th>Doc</th><th>VIA</th></tr><tr><td>D", k, "</td><td>table</td></tr></table>")
    out = spread(table(spark, sf_dir, "orders"), "o_orderkey").select("o_orderkey", payloads.page_documents(t("<html>", F.when(k % 2 == 0, script).otherwise(""), plain)).alias("rows"))
    return out.select("o_orderkey", F.explode("rows").alias("r")).select("o_orderkey", F.col("r")["doc"].alias("doc"), F.col("r")["via"].alias("via"))


@query("""SELECT o_orderkey, CAST(2024000000 + o_orderkey AS VARCHAR) AS doc_number, CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE '$' || CAST(o_orderkey AS VARCHAR) || '.00' END AS consideration,
  o_orderpriority AS grantee FROM orders""")
def card_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    amount = F.when(k % 4 == 0, "--/--/--").otherwise(t("$", k, ".00"))
    card = t('<div class=c><a href="/doc/', k, '">LIEN</a><p><b>Document Number:</b> <i>', F.lit(2024000000) + k, "</i><br><b>Consideration</b>:<span>", amount, "</span></p><div><b>Grantor:</b><b>Grantee:</b><i>", F.col("o_orderpriority"), "</i></div></div>")
    out = spread(table(spark, sf_dir, "orders"), "o_orderkey").select("o_orderkey", payloads.card_documents(t("<body><div>", card, "</div></body>")).alias("rows"))
    return out.select("o_orderkey", F.explode("rows").alias("r")).select("o_orderkey", *[F.col("r")[c].alias(c) for c in ("doc_number", "consideration", "grantee")])


@query(with_views("d_owner", "d_parcel") + """
, asked AS (SELECT owner_id AS lead_id, owner FROM d_owner),
hit AS (SELECT a.lead_id, p.prop_id, row_number() OVER (PARTITION BY a.lead_id ORDER BY p.market_value DESC, p.prop_id) AS rn
  FROM asked a JOIN d_parcel p ON p.owner_id = a.lead_id WHERE p.state_class = 'A1'),
named AS (SELECT lead_id, prop_id FROM hit WHERE rn = 1),
placed AS (SELECT a.lead_id, p.prop_id, row_number() OVER (PARTITION BY a.lead_id ORDER BY p.market_value DESC, p.prop_id) AS rn
  FROM asked a JOIN d_parcel p ON p.prop_id = a.lead_id + 1 WHERE p.state_class = 'A1' AND a.lead_id NOT IN (SELECT lead_id FROM named))
SELECT lead_id, 'name' AS how, prop_id FROM named UNION ALL SELECT lead_id, 'address', prop_id FROM placed WHERE rn = 1""")
def corroborated_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Owners by ordered name variants (the second is theirs), confirmed by class, else by address."""
    owners, parcels = view(spark, sf_dir, "d_owner"), view(spark, sf_dir, "d_parcel")
    leads = owners.select(F.col("owner_id").alias("lead_id"), F.array(t("NOBODY ", F.col("owner_id")), t("O", F.col("owner_id"))).alias("variants"), t("A", F.col("owner_id") + 1).alias("address_key"))
    row = [F.col("prop_id").alias("pos"), "prop_id", "state_class", "market_value"]
    by_name, by_address = parcels.select(t("O", F.col("owner_id")).alias("name"), *row), parcels.select(t("A", F.col("prop_id")).alias("address_key"), *row)
    out = lookups.corroborated(leads, by_name, by_address, variants="variants", order=[F.desc("market_value")], confirmed=F.col("state_class") == "A1")
    return out.select("lead_id", "how", "prop_id")


@query("""WITH rec AS (SELECT o_orderkey AS id, o_custkey FROM orders),
one AS (SELECT r.id, p.p_partkey AS prop_id FROM rec r JOIN part p ON p.p_partkey = r.id),
two AS (SELECT r.id, p.p_partkey AS prop_id, count(*) OVER (PARTITION BY r.id) AS n FROM rec r JOIN part p ON p.p_size = r.o_custkey WHERE r.id NOT IN (SELECT id FROM one))
SELECT id, prop_id, 'name' AS stage FROM one UNION ALL SELECT id, prop_id, 'subdivision' FROM two WHERE n = 1""")
def staged_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two stages of matching; only records that a stage matches uniquely leave the next."""
    orders, part = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), "o_custkey"), table(spark, sf_dir, "part")
    first = orders.join(part, F.col("p_partkey") == F.col("id")).select("id", F.col("p_partkey").alias("prop_id"))
    second = orders.join(part, F.col("p_size") == F.col("o_custkey")).select("id", F.col("p_partkey").alias("prop_id"))
    return lookups.in_stages(orders, "id", [("name", first), ("subdivision", second)])


@query(with_views("d_filing") + """
SELECT f.doc_num, r.doc_num AS representative FROM d_filing f LEFT JOIN (
  SELECT owner_id, doc_num, row_number() OVER (PARTITION BY owner_id ORDER BY CASE WHEN doc_type = 'LIEN' THEN 0 ELSE 1 END, pos) AS rn FROM d_filing
) r ON r.owner_id = f.owner_id AND r.rn = 1""")
def group_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One filing of each owner is looked up, and what is found goes to all of them."""
    filings = view(spark, sf_dir, "d_filing").withColumn("legal", F.when(F.col("doc_type") == "LIEN", "LOT 1").otherwise(""))
    args = {"prefer": F.col("legal") != "", "position": "pos"}
    asked, _ = lookups.once_per_group(filings, filings.select("owner_id").distinct(), "owner_id", **args)
    _, out = lookups.once_per_group(filings, asked.select("owner_id", F.col("doc_num").alias("representative")), "owner_id", **args)
    return out.select("doc_num", "representative")


@query("""SELECT o_orderkey AS id, CASE WHEN o_orderkey % 5 IN (0, 1) THEN o_orderkey % 5 WHEN o_orderkey % 5 = 2 THEN 0 END AS "try", o_orderkey * 10 AS prop_id FROM orders WHERE o_orderkey % 5 < 3""")
def street_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ordered street names; the first with an answer counts, rows of later ones do not."""
    k = F.col("o_orderkey")
    orders = table(spark, sf_dir, "orders").select(k.alias("id"), t(k).alias("number"), F.array(F.lit("LONG NAME"), F.lit("NAME")).alias("streets"))
    answer = lambda street, hit: table(spark, sf_dir, "orders").where((k % 5).isin(*hit)).select(t(k).alias("number"), F.lit(street).alias("street"), (k * 10).alias("prop_id"))
    out = lookups.street_lookup(orders, answer("LONG NAME", (0, 2)).unionByName(answer("NAME", (1, 2))))
    return out.select("id", F.col("try").cast("long").alias("try"), "prop_id")


@query("""SELECT c_custkey AS uid, CASE WHEN c_custkey % 3 = 0 THEN 27.5 + c_custkey END AS lat, CASE WHEN c_custkey % 3 = 0 THEN -97.25 END AS lon FROM customer""")
def geocoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    uid = table(spark, sf_dir, "customer").select(k.alias("uid"))
    answers = table(spark, sf_dir, "customer").where("c_custkey % 3 <> 1").select(k.alias("uid"), F.when(k % 3 == 0, "Match").otherwise("Tie").alias("match"), t("-97.25,", F.lit(27.5) + k).alias("lon_lat"))
    return lookups.geocoded(uid, answers).select("uid", "lat", "lon")


@query("""WITH r AS (SELECT o_orderkey AS id, o_orderkey % 6 AS k FROM orders)
SELECT id, CASE WHEN k = 0 THEN 'already' WHEN k = 1 THEN 'no_address' WHEN k = 2 THEN 'no_rows' WHEN k = 3 THEN 'conflict' WHEN k = 4 THEN 'no_match' ELSE 'matched' END AS result,
  CASE WHEN k = 5 THEN 'M' || id END AS new_mail, CAST(NULL AS VARCHAR) AS new_owner FROM r""")
def enrichment_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All results of an enrichment run, and what it would add."""
    k = F.col("o_orderkey") % 6
    recs = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), (k == 0).alias("is_done"), (k != 1).alias("has_address"), F.lit("").alias("mail"), F.lit("KEPT").alias("owner"))
    base = table(spark, sf_dir, "orders").where(k != 2)
    rows = base.select(F.col("o_orderkey").alias("id"), F.lit(2).alias("rank"), (k == 3).alias("clash"), (k != 4).alias("number_ok"), t("M", F.col("o_orderkey")).alias("row_mail"), F.lit("NEW").alias("row_owner"))
    rows = rows.unionByName(rows.withColumn("rank", F.lit(1)).withColumn("clash", F.lit(True)).withColumn("row_mail", F.lit("WRONG")))
    out = lookups.enrichment_plan(recs, rows, key="id", done=F.col("is_done"), asked=F.col("has_address"), order=[F.col("rank")], guard=F.col("number_ok"), conflict=F.col("clash"), fields={"mail": "row_mail", "owner": "row_owner"})
    return out.select("id", "result", "new_mail", F.col("new_owner").cast("string").alias("new_owner"))


@query("""SELECT o_orderkey AS case_number, CASE WHEN o_orderkey % 5 = 0 THEN 'no_data' WHEN o_orderkey % 7 = 0 THEN 'agency' WHEN o_totalprice < 50000 THEN 'below_min' WHEN o_orderkey % 3 = 0 THEN 'done' END AS reason FROM orders""")
def lead_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    cases = table(spark, sf_dir, "orders").select(k.alias("case_number"), F.when(k % 5 != 0, F.when(k % 14 == 0, "City of Sample").when(k % 7 == 0, "NUECES CTY").otherwise("DOE")).alias("new_owner"), F.lit("LOT 1").alias("legal"), F.col("o_totalprice").alias("balance"), F.when(k % 3 == 0, "1").alias("prop_id"), F.lit("2").alias("account"))
    return lookups.lead_choice(cases, least_balance=50000).select("case_number", "reason")


@query("""SELECT CAST(o_orderkey AS VARCHAR) AS doc_num, 'DOE ' || o_custkey AS owner, CASE o_custkey % 3 WHEN 0 THEN 'expire' WHEN 1 THEN 'other_version' ELSE 'absent' END AS action FROM orders WHERE o_orderkey % 4 = 1""")
def expiry_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    recs = table(spark, sf_dir, "orders").select(k.alias("doc_num"), F.when(k % 4 != 2, t(" DOE ", F.col("o_custkey"))).alias("owner"), F.when(k % 4 == 3, "77").alias("prop_id"), F.when(k % 4 != 0, "LOT 1").alias("legal"))
    cache = table(spark, sf_dir, "orders").where("o_custkey % 3 <> 2").select(t("DOE ", F.col("o_custkey")).alias("owner"), F.when(F.col("o_custkey") % 3 == 0, 6).otherwise(5).alias("version"))
    return lookups.expiry_plan(recs, cache)


@query("""WITH x AS (SELECT o_custkey AS run, o_orderkey AS pos, o_orderkey % 5 = 0 AS hit, sum(CASE WHEN o_orderkey % 5 = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS island FROM orders),
y AS (SELECT *, sum(CASE WHEN hit THEN 0 ELSE 1 END) OVER (PARTITION BY run, island ORDER BY pos) AS streak FROM x),
z AS (SELECT *, CASE WHEN streak = 3 THEN 'refresh' WHEN streak = 5 THEN 'abort' ELSE 'go on' END AS action FROM y)
SELECT run, pos, CAST(streak AS BIGINT) AS streak, action, coalesce(max(CASE WHEN action = 'abort' THEN 1 ELSE 0 END) OVER (PARTITION BY run ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) = 1 AS aborted FROM z""")
def breaker(spark: SparkSession, sf_dir: str) -> DataFrame:
    tries = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("run"), F.col("o_orderkey").alias("pos"), (F.col("o_orderkey") % 5 == 0).alias("hit"))
    return lookups.breaker(tries, refresh=3, abort=2).select("run", "pos", F.col("streak").cast("long").alias("streak"), "action", "aborted")


@query("""SELECT o_orderkey, o_custkey % 100 AS url, o_custkey % 100 < 60 AS found, CASE WHEN o_custkey % 100 < 60 THEN 'LEGAL ' || (o_custkey % 100) END AS legal FROM orders""")
def memoised(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_custkey") % 100).alias("url"))
    answers = asked.select("url").distinct().where("url < 60").withColumn("legal", t("LEGAL ", F.col("url")))
    return lookups.memoised(asked, answers, "url").select("o_orderkey", "url", "found", "legal")


@query("""SELECT p_partkey AS prop_id,
  'https://example.org/Property/View/' || p_partkey || '?year=' || CASE WHEN p_partkey % 2 = 0 THEN '2024' ELSE '2026' END || CASE WHEN p_partkey % 3 = 0 THEN '&ownerId=' || p_size ELSE '' END AS url,
  'ccln_addr::' || lower(p_brand) AS cache_key, p_partkey % 4 = 0 AS in_suit, p_partkey % 4 = 1 AS has_judgment, p_partkey % 4 = 3 AS bankruptcy,
  CASE p_partkey % 4 WHEN 1 THEN 'LOT 1' WHEN 2 THEN 'LOT 1 BLK 2' ELSE '' END AS legal,
  CAST(round_even((p_size * 10 + p_partkey) / 100.0, 0) AS BIGINT) * 100 AS value,
  CASE WHEN p_partkey % 2 = 0 THEN CAST(2024000000 + p_partkey AS VARCHAR) ELSE '' END AS cover_number, contains(upper(p_name), 'A') AS of_city FROM part""")
def small_projections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses of parcel pages, cache keys, flag columns, joined descriptions, summed values, cover sheets."""
    k = F.col("p_partkey")
    suit = F.when(k % 4 == 0, " l ").when(k % 4 == 1, "J").when(k % 4 == 2, "A")
    flags = identifiers.suit_flags(suit=suit, bad_address=F.lit(""), deferral=F.lit(None).cast("string"), agreement=F.lit(""), bankruptcy=F.when(k % 4 == 3, "Y"))
    parts = [F.when(k % 4 > 2, " ").when(k % 4 > 0, "LOT 1"), F.when(k % 4 == 2, " BLK  2 "), F.lit(None).cast("string")]
    sheet = F.when(k % 2 == 0, t("CERTIFICATE\nDocument Number:  ", F.lit(2024000000) + k, "\n")).otherwise("Number of Pages: 2")
    return table(spark, sf_dir, "part").select(
        k.alias("prop_id"), identifiers.parcel_url("https://example.org", k, F.when(k % 2 == 0, "2024"), F.when(k % 3 == 0, F.col("p_size"))).alias("url"), identifiers.address_cache_key(F.lower("p_brand")).alias("cache_key"),
        flags["in_suit"].alias("in_suit"), flags["has_judgment"].alias("has_judgment"), flags["bankruptcy"].alias("bankruptcy"), identifiers.joined_description(*parts).alias("legal"),
        identifiers.market_value(F.col("p_size") * 10, t(k), F.lit(""), F.lit(None).cast("string"), F.lit("x"), F.lit(0)).alias("value"), identifiers.cover_sheet_number(sheet).alias("cover_number"), identifiers.names_city("p_name", "a").alias("of_city"),
    )


@query("""SELECT CAST(o_orderkey AS VARCHAR) AS doc_num, CASE WHEN o_orderkey % 2 = 0 THEN '1997-01-02' ELSE '' END AS filed, 'DOE ' || o_custkey AS owner, 35 AS score, 'LIEN' AS doc_type, 'CITY' AS grantee FROM orders""")
def synthesised_liens(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    docs = table(spark, sf_dir, "orders").select(k.alias("doc_num"), F.when(k % 2 == 0, "1997-01-02").alias("filed"), t("DOE ", F.col("o_custkey")).alias("owner"), F.lit("LOT 1").alias("legal"))
    return identifiers.lien_of_document(docs, grantee="CITY", base_url="https://example.org").select("doc_num", "filed", "owner", "score", "doc_type", "grantee")


@query("""SELECT o_orderkey AS id, CASE WHEN o_orderkey % 3 = 0 THEN 5.0 WHEN o_orderkey % 3 = 1 THEN CAST(o_orderkey AS DOUBLE) END AS market_value FROM orders""")
def migrated_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    old = table(spark, sf_dir, "orders").select(k.alias("id"), F.when(k % 3 == 0, 5.0).alias("market_value"), F.when(k % 3 == 2, "n/a").otherwise(t("$", k)).alias("appraised_value"))
    return identifiers.to_market_value(old)


@query("""SELECT o_orderkey AS id, row_number() OVER (ORDER BY o_orderkey % 2, coalesce(CASE WHEN o_orderkey % 3 > 0 THEN o_orderkey % 100 END, 9999), o_orderkey) AS place FROM orders
QUALIFY place <= 50""")
def sale_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The next fifty sales: those to come first, then by days, unknown days last."""
    k = F.col("o_orderkey")
    sales = table(spark, sf_dir, "orders").select(k.alias("id"), F.when(k % 2 == 1, "post").otherwise("pre").alias("status"), F.when(k % 3 > 0, k % 100).alias("days_until_sale"))
    top = ranking.top_rows(sales, 50, *identifiers.by_sale("status", "days_until_sale"), F.col("id"))
    return top.withColumn("place", F.row_number().over(Window.orderBy(*identifiers.by_sale("status", "days_until_sale"), "id")).cast("long")).select("id", "place")


@query("""SELECT o_orderkey AS document, CASE o_orderkey % 4 WHEN 0 THEN 'header' WHEN 1 THEN 'filename' WHEN 2 THEN 'page_two' END AS via, CASE WHEN o_orderkey % 4 < 3 THEN CAST(o_orderkey AS VARCHAR) END AS doc_num FROM orders""")
def documents_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The number in a header counts before that of the file's name, and that before the second page's."""
    k = F.col("o_orderkey")
    docs = table(spark, sf_dir, "orders").select(k.alias("document"))
    right, wrong = t(F.col("document")), t("x", F.col("document"))
    place = F.col("document") % 4
    out = identifiers.joined_with(table(spark, sf_dir, "orders").select(t(k).alias("doc_num")), docs, header=F.when(place == 0, right).otherwise(wrong), filename=F.when(place == 1, right), page_two=F.when(place <= 2, right).otherwise(""))
    return out.select("document", "via", "doc_num")
