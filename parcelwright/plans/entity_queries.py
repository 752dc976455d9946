"""Owners, addresses, legal descriptions, parcels: classification, parsing and matching."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import addresses, codes, legal, money
from ..functions import owners as names
from ..operators import joins, legal_index, merge, ranking, summary
from .views import spread, table, view, with_views

QUERIES: dict = {}
ORACLES: dict = {}


def query(oracle: str | None = None):  # noqa: ANN201
    def add(f):  # noqa: ANN001, ANN202
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return add


KIND_SQL = """CASE WHEN trim(owner) = '' THEN 'individual'
  WHEN regexp_matches(owner, '(?i)\\b(ESTATE\\s+OF|DECEASED|DECD)\\b') THEN 'estate'
  WHEN regexp_matches(owner, '(?i)\\b(LIVING\\s+TRUST|FAMILY\\s+TRUST|REV\\s+LVG\\s+TRUST|LVG\\s+TRUST|FAM\\s+TRUST|FAM\\s+TRST|REV\\s+TRUST)\\b') THEN 'family_trust'
  WHEN regexp_matches(owner, '(?i)\\b(CITY\\s+OF|COUNTY\\s+OF|STATE\\s+OF|[A-Z]+\\s+COUNTY|TAX\\s+TRUSTEE)\\b') THEN 'government'
  WHEN regexp_matches(owner, '(?i)\\b(ISD|SCHOOL\\s+DISTRICT|COLLEGE|UNIVERSITY|ACADEMY)\\b') THEN 'school'
  WHEN len(string_split(regexp_replace(upper(owner), '\\s+(JR|SR|II|III|IV|V)$', ''), ' ')) = 2
    AND list_has_any(string_split(regexp_replace(upper(owner), '\\s+(JR|SR|II|III|IV|V)$', ''), ' '), ['BANK','BANKS','COMPANY','BAPTIST','CHURCH','TEMPLE','ACADEMY','BISHOP','LODGE']) THEN 'individual'
  WHEN regexp_matches(owner, '(?i)\\b(CHURCH|MINISTRY|BAPTIST|METHODIST|TEMPLE)\\b') THEN 'religious'
  WHEN regexp_matches(owner, '(?i)\\b(HOA|HOMEOWNERS\\s+ASSOCIATION|PROPERTY\\s+OWNERS\\s+ASSOCIATION|CONDOMINIUM\\s+ASSOCIATION|CONDO\\s+ASSOC)\\b') THEN 'hoa'
  WHEN regexp_matches(owner, '(?i)\\b(ASSOCIATION|FOUNDATION|INSTITUTE|SOCIETY)\\b') THEN 'nonprofit'
  WHEN regexp_matches(owner, '(?i)\\b(LLC|INC|CORP|LTD|HOLDINGS?|COMPANY|BANK)\\b') THEN 'company'
  WHEN regexp_matches(owner, '(?i)\\bTRUST\\b') THEN 'trust_inst' ELSE 'individual' END"""
KIND = with_views("d_owner") + f", k AS (SELECT owner_id, owner, {KIND_SQL} AS kind FROM d_owner)"


@query(KIND + " SELECT owner_id, owner, kind, kind IN ('individual', 'estate', 'family_trust') AS keep FROM k")
def owner_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = names.owner_kind("owner")
    return view(spark, sf_dir, "d_owner").select("owner_id", "owner", kind.alias("kind")).withColumn("keep", names.is_kept("kind"))


@query(KIND + " SELECT kind, CAST(count(*) AS BIGINT) AS n FROM k GROUP BY kind")
def owner_breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "d_owner").groupBy(names.owner_kind("owner").alias("kind")).agg(F.count("*").alias("n"))


@query("""SELECT p_partkey, d[1:4] || '-' || d[5:8] || '-' || d[9:12] AS account, regexp_replace(d, '\\D', '', 'g') AS prop_digits FROM (SELECT p_partkey, lpad(CAST(p_partkey * 10 AS VARCHAR), 12, '0') AS d FROM part)""")
def account_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = view(spark, sf_dir, "d_parcel")
    return p.select(F.col("prop_id").alias("p_partkey"), money.account("account_raw").alias("account"), money.digits("account_raw").alias("prop_digits"))


REASON_SQL = """CASE WHEN state_class NOT IN ('A1','B1','B2','B3','B4','B5','B6','B7','B8','B9','C1') THEN 'class'
  WHEN prop_zip NOT IN ('', '90002') THEN 'zip' WHEN NOT keep THEN 'owner' WHEN value >= 500000 THEN 'value' END"""
DELINQUENT = KIND.replace("WITH ", "WITH d_parcel AS (" + with_views("d_parcel").removeprefix("WITH d_parcel AS (").rstrip(")") + "),\n", 1) + f""", r AS (
  SELECT p.*, k.kind IN ('individual', 'estate', 'family_trust') AS keep, CAST(round_even(p.market_value / 100, 0) * 100 AS BIGINT) AS value
  FROM d_parcel p JOIN k ON p.owner_id = k.owner_id
), q AS (SELECT *, {REASON_SQL} AS reason FROM r)"""


def _delinquent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parcels with the reason that drops them, the cheapest test first."""
    p = view(spark, sf_dir, "d_parcel").join(view(spark, sf_dir, "d_owner"), "owner_id")
    p = p.withColumn("value", money.to_hundreds("market_value"))
    reason = (
        F.when(~F.col("state_class").isin(*codes.RESIDENTIAL), "class").when(~F.col("prop_zip").isin("", "90002"), "zip")
        .when(~names.is_kept(names.owner_kind("owner")), "owner").when(F.col("value") >= codes.MOST_VALUE, "value")
    )
    return p.withColumn("reason", reason)


@query(DELINQUENT + """ SELECT prop_id, value, array_to_string(list_reverse_sort(list_distinct([CAST(x AS INT) FOR x IN string_split(del_years_raw, ',')])), ',') AS years
  FROM q WHERE reason IS NULL""")
def delinquent_import(spark: SparkSession, sf_dir: str) -> DataFrame:
    years = F.array_join(codes.delinquent_years("del_years_raw").cast("array<string>"), ",")
    return _delinquent(spark, sf_dir).where("reason is null").select("prop_id", "value", years.alias("years"))


@query(DELINQUENT + " SELECT coalesce(reason, 'kept') AS reason, CAST(count(*) AS BIGINT) AS n FROM q GROUP BY 1")
def drop_reason_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.drop_reasons(_delinquent(spark, sf_dir), F.col("reason"))


@query("""SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN '100 N SAMPLE ST' WHEN 1 THEN '100 SAMPLE ST' WHEN 2 THEN (c_custkey % 90) || '-' || (c_custkey % 90 + 4) || ' SAMPLE ST' ELSE c_custkey || ' SAMPLE' END AS group_key,
  CASE c_custkey % 4 WHEN 2 THEN CAST(c_custkey % 90 AS VARCHAR) WHEN 3 THEN CAST(c_custkey AS VARCHAR) ELSE '100' END AS number,
  CASE c_custkey % 4 WHEN 0 THEN 'N SAMPLE' ELSE 'SAMPLE' END AS street FROM customer""")
def address_group_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    n = (k % 90).cast("string")
    raw = F.when(k % 4 == 0, "100 Sample St N").when(k % 4 == 1, " 100  SAMPLE ST UNIT 4").when(k % 4 == 2, F.concat(n, F.lit(" - "), (k % 90 + 4).cast("string"), F.lit(" SAMPLE ST"))).otherwise(F.concat(k.cast("string"), F.lit(" SAMPLE @ MAIN")))
    parts = addresses.query_parts(raw)
    return table(spark, sf_dir, "customer").select("c_custkey", addresses.group_key(raw).alias("group_key"), parts["number"].alias("number"), parts["street"].alias("street"))


@query("""SELECT c_custkey, c_custkey || ' SAMPLE ST' AS street, CASE WHEN c_custkey % 2 = 0 THEN 'SAMPLE CITY' ELSE '' END AS city, 'TX' AS state, '90001' AS zip FROM customer""")
def address_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    raw = F.concat(k.cast("string"), F.lit(" SAMPLE ST"), F.when(k % 2 == 0, ", SAMPLE CITY, TX 90001-1234").otherwise(" TX 90001"))
    s = addresses.split_address(raw)
    return table(spark, sf_dir, "customer").select("c_custkey", *[s[x].alias(x) for x in ("street", "city", "state", "zip")])


@query(with_views("d_parcel") + """ SELECT prop_id, regexp_replace(situs, ' +(STREET|AVE)$', '') AS full_key, regexp_replace(regexp_replace(situs, ' +(STREET|AVE)$', ''), '^(\\d+) N ', '\\1 ') AS loose_key FROM d_parcel""")
def address_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = addresses.address_words("situs")
    p = view(spark, sf_dir, "d_parcel").select("prop_id", words.alias("words"))
    return p.select("prop_id", addresses.full_key("words").alias("full_key"), addresses.key_without_direction("words").alias("loose_key"))


LABEL_SQL = "CASE WHEN state_class = 'A1' THEN 'Single-family' WHEN regexp_matches(state_class, '^B[1-9][0-9]?$') THEN 'Multifamily' WHEN state_class LIKE 'C1%' THEN 'Vacant lot' WHEN state_class = '' THEN 'Unknown' ELSE state_class END"


@query(with_views("d_parcel") + f" SELECT prop_id, {LABEL_SQL} AS label FROM d_parcel")
def class_label_violation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "d_parcel").select("prop_id", codes.class_label("state_class").alias("label"))


@query(with_views("d_parcel") + " SELECT prop_id, CASE substr(state_class, 1, 1) WHEN 'A' THEN 'Single-family' WHEN 'B' THEN 'Multifamily' WHEN 'C' THEN 'Vacant lot' WHEN 'E' THEN 'Farm / ranch' WHEN 'F' THEN 'Commercial' ELSE state_class END AS label FROM d_parcel")
def class_label_lien(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "d_parcel").select("prop_id", codes.class_label_long("state_class").alias("label"))


@query(with_views("d_parcel") + """ SELECT l_orderkey, l_linenumber, coalesce(p.state_class, '') AS state_class FROM lineitem l LEFT JOIN d_parcel p ON p.prop_id = l.l_partkey AND p.prop_id % 3 <> 0""")
def proptype_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("prop_id"), F.lit("").alias("state_class"))
    ref = view(spark, sf_dir, "d_parcel").where("prop_id % 3 <> 0").select("prop_id", F.col("state_class").alias("cls"), F.col("prop_id").alias("pos"))
    return joins.lookup(items, ref, "prop_id", "cls", "state_class").select("l_orderkey", "l_linenumber", "state_class")


# The same keys in SQL, for addresses of the view's own shape: NUMBER [N] NAME SUFFIX.
TIERS = with_views("d_parcel") + """, idx AS (
  SELECT prop_id, state_class AS cls, regexp_replace(situs, ' (STREET|AVE)$', '') AS fk, regexp_replace(regexp_replace(situs, ' (STREET|AVE)$', ''), '^(\\d+) N ', '\\1 ') AS lk FROM d_parcel WHERE prop_id % 2 = 0
), asked AS (
  SELECT prop_id AS id, regexp_replace(situs, ' (STREET|AVE)$', '') AS fk, regexp_replace(regexp_replace(situs, ' (STREET|AVE)$', ''), '^(\\d+) N ', '\\1 ') AS lk FROM d_parcel
), clear AS (SELECT lk FROM idx GROUP BY lk HAVING count(DISTINCT nullif(cls, '')) <= 1), hits AS (
  SELECT id, 'full' AS tier, i.prop_id, i.cls FROM asked a JOIN idx i ON a.fk = i.fk
  UNION ALL SELECT id, 'noprefix', i.prop_id, i.cls FROM asked a JOIN clear c ON a.lk = c.lk JOIN idx i ON i.lk = a.lk WHERE a.fk NOT IN (SELECT fk FROM idx)
), votes AS (
  SELECT id, cls FROM hits WHERE cls <> '' GROUP BY id, cls QUALIFY row_number() OVER (PARTITION BY id ORDER BY count(*) DESC, min(prop_id)) = 1
) SELECT h.id, min(h.tier) AS tier, CAST(count(*) AS BIGINT) AS candidates, coalesce(min(v.cls), '') AS cls FROM hits h LEFT JOIN votes v ON h.id = v.id GROUP BY h.id"""


@query(TIERS)
def two_tier_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = view(spark, sf_dir, "d_parcel").withColumn("words", addresses.address_words("situs"))
    index = joins.parcel_index(p.where("prop_id % 2 = 0").select("prop_id", F.col("state_class").alias("cls"), F.col("prop_id").alias("pos"), "words"))
    return joins.two_tier_vote(p.select(F.col("prop_id").alias("id"), "words"), index)


@query(with_views("d_parcel") + """ SELECT prop_id, lower(trim(regexp_replace(regexp_replace(legal, ' (BLK|LOT) [0-9]+', ' ', 'g'), '\\s+', ' ', 'g'))) AS subdivision,
  regexp_extract(legal, 'LOT ([0-9]+)', 1) AS lot, regexp_extract(legal, 'BLK ([0-9]+)', 1) AS block FROM d_parcel""")
def legal_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = view(spark, sf_dir, "d_parcel").select("prop_id", legal.parse_legal("legal").alias("p"))
    return p.select("prop_id", "p.subdivision", "p.lot", "p.block")


MATCH = with_views("d_parcel") + """, t AS (
  SELECT prop_id, owner_id, regexp_extract(legal, 'LOT ([0-9]+)', 1) AS lot, regexp_extract(legal, 'BLK ([0-9]+)', 1) AS block FROM d_parcel)
SELECT a.prop_id AS a, b.prop_id AS b FROM t a JOIN t b ON a.owner_id = b.owner_id AND a.prop_id < b.prop_id WHERE a.lot = b.lot AND a.block = b.block"""


@query(MATCH)
def legal_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pairs of parcels of one owner whose legals can be of one parcel. Every legal here has a
    word in common with every other, so lot and block decide."""
    parcels = spread(view(spark, sf_dir, "d_parcel").select("prop_id", "owner_id", "legal"), "prop_id")
    return legal_index.legal_pairs(parcels, key="prop_id", within="owner_id")


CLASSES = with_views("d_parcel") + """, t AS (
  SELECT prop_id, owner_id, regexp_extract(legal, 'SAMPLE (.*) UNIT', 1) AS kind, regexp_extract(legal, 'LOT ([0-9]+)', 1) AS lot, regexp_extract(legal, 'BLK ([0-9]+)', 1) AS block FROM d_parcel),
n AS (SELECT owner_id, lot, block, count(*) AS n FROM t GROUP BY ALL)
SELECT t.prop_id, min(t.prop_id) OVER (PARTITION BY owner_id, kind, lot, block) AS class_id, n.n - 1 AS n_links FROM t JOIN n USING (owner_id, lot, block)"""


@query(CLASSES)
def legal_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parcels of one owner whose legals read alike, and how many can be of one parcel. Every legal
    here has a word in common with every other, so lot and block decide."""
    return legal_index.legal_classes(view(spark, sf_dir, "d_parcel").select("prop_id", "owner_id", "legal"), key="prop_id", within="owner_id")


@query("""SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN array_to_string(range(p_partkey % 7, p_partkey % 7 + 3), ',') WHEN 1 THEN (p_partkey % 50) || ',' || (p_partkey % 50 + 1) ELSE (p_partkey % 50) || 'A' END AS lots,
  CASE WHEN p_partkey % 2 = 0 THEN CAST(p_size AS VARCHAR) ELSE '' END AS block FROM part""")
def lot_expand(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, size = F.col("p_partkey"), F.col("p_size").cast("string")
    s = lambda c: c.cast("string")
    lots = F.when(k % 3 == 0, F.concat(F.lit("LTS "), s(k % 7), F.lit(" THRU "), s(k % 7 + 2))).when(k % 3 == 1, F.concat(F.lit("LOT "), s(k % 50), F.lit("&"), s(k % 50 + 1))).otherwise(F.concat(F.lit("TR "), s(k % 50), F.lit("a")))
    raw = F.concat(F.when(k % 2 == 0, F.concat(F.lit("SAMPLE BLK "), size, F.lit(" "))).otherwise("SAMPLE "), lots)
    lb = legal.lot_block(raw)
    return table(spark, sf_dir, "part").select("p_partkey", F.array_join(lb["lots"], ",").alias("lots"), lb["block"].alias("block"))


UNIQUE = with_views("d_parcel") + """, t AS (
  SELECT prop_id, owner_id, regexp_extract(legal, 'LOT ([0-9]+)', 1) AS lot, regexp_extract(legal, 'BLK ([0-9]+)', 1) AS block FROM d_parcel),
leads AS (SELECT l_orderkey * 10 + l_linenumber AS lead_id, l_suppkey % 150 AS owner_id, CAST(l_partkey % 20 + 1 AS VARCHAR) AS lot, CAST(CAST(l_quantity AS INT) AS VARCHAR) AS block FROM lineitem)
SELECT lead_id, min(prop_id) AS prop_id FROM leads JOIN t USING (owner_id, lot, block) GROUP BY lead_id HAVING count(*) = 1"""


@query(UNIQUE)
def unique_lot_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leads with exactly one parcel of their owner on their lot and block. Parcels are grouped
    by owner, lot and block first, so a lead's row joins one group at most whatever its owner holds."""
    lb = view(spark, sf_dir, "d_parcel").select("prop_id", "owner_id", legal.lot_block("legal").alias("lb"))
    parcels = lb.select("prop_id", "owner_id", "lb.block", F.explode("lb.lots").alias("lot")).groupBy("owner_id", "lot", "block").agg(F.count("*").alias("n"), F.min("prop_id").alias("prop_id"))
    leads = table(spark, sf_dir, "lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("lead_id"), (F.col("l_suppkey") % 150).alias("owner_id"), (F.col("l_partkey") % 20 + 1).cast("string").alias("lot"), F.col("l_quantity").cast("int").cast("string").alias("block"))
    return joins.unique_match(leads.join(parcels, ["owner_id", "lot", "block"]), "lead_id", "prop_id", "n")


@query()
def name_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Variants of each distinct name, worked out once for each."""
    o = view(spark, sf_dir, "d_owner")
    distinct = o.select("owner").distinct().withColumn("variants", names.name_variants("owner"))
    return o.join(distinct, "owner").select("owner_id", "owner", F.array_join("variants", "; ").alias("variants"))


@query(with_views("d_owner") + """, n AS (SELECT owner, count(*) AS n FROM d_owner WHERE owner_id % 2 = 0 GROUP BY owner)
SELECT owner_id AS lead_id, owner AS name, CASE WHEN owner_id % 12 = 0 OR (owner_id % 12 = 2 AND owner_id < 100) THEN 0 ELSE 1 END AS variant_pos, n AS n_parcels FROM d_owner JOIN n USING (owner) WHERE owner <> ''""")
def variant_fallback_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Owners under the first of their names that the reference has: as they are, or as a person's last
    name first. A blank owner has no names."""
    o = view(spark, sf_dir, "d_owner")
    leads = o.select(F.col("owner_id").alias("lead_id"), names.name_variants("owner").alias("variants"))
    reference = o.where("owner_id % 2 = 0").groupBy(F.col("owner").alias("name")).agg(F.count("*").alias("n_parcels"))
    return joins.first_variant(leads, "variants", reference, "name").select("lead_id", "name", "variant_pos", "n_parcels")


@query(with_views("d_parcel") + " SELECT owner_id, prop_id, state_class FROM d_parcel QUALIFY row_number() OVER (PARTITION BY owner_id ORDER BY (state_class IN ('A1', 'C1')) DESC, (prop_zip <> '') DESC, market_value DESC, prop_id) = 1")
def best_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = view(spark, sf_dir, "d_parcel")
    return ranking.best_per(p, ["owner_id"], F.col("state_class").isin("A1", "C1").desc(), (F.col("prop_zip") != "").desc(), F.desc("market_value"), F.asc("prop_id")).select("owner_id", "prop_id", "state_class")


CACHE = with_views("d_owner") + """, g AS (
  SELECT owner_id, CASE owner_id % 3 WHEN 0 THEN '' ELSE 'SAMPLE LOT ' || (owner_id % 5) || ' BLK 1' END AS ours,
    CASE WHEN owner_id % 4 = 0 THEN '' ELSE 'SAMPLE LOT ' || (owner_id % 2) || ' BLK 1' END AS theirs FROM d_owner)
SELECT owner_id, CASE WHEN owner_id % 7 = 0 THEN 'uncached' WHEN ours = '' THEN 'optimistic' WHEN theirs = '' THEN 'skip' WHEN owner_id % 5 = owner_id % 2 THEN 'match' ELSE 'mismatch' END AS gate FROM g"""


@query(CACHE)
def cache_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("owner_id")
    s = lambda n: F.concat(F.lit("SAMPLE LOT "), (k % n).cast("string"), F.lit(" BLK 1"))
    owners = view(spark, sf_dir, "d_owner").select("owner_id", F.when(k % 3 == 0, "").otherwise(s(5)).alias("ours"))
    cache = view(spark, sf_dir, "d_owner").where(k % 7 != 0).select("owner_id", F.when(k % 4 == 0, "").otherwise(s(2)).alias("theirs"), F.lit(True).alias("cached"))
    g = owners.join(cache, "owner_id", "left")
    match = legal.legals_match(legal.parse_legal("ours"), legal.parse_legal("theirs"))
    return g.select("owner_id", F.when(F.col("cached"), joins.gate(F.col("ours"), F.col("theirs"), match)).otherwise("uncached").alias("gate"))


EVICT = with_views("d_owner") + """, r AS (SELECT owner_id, CASE WHEN owner_id % 2 = 0 THEN (owner_id || ' SAMPLE ST.') ELSE 'OTHER' END AS prop_address, CASE WHEN owner_id % 5 = 0 THEN '' ELSE 'P' || owner_id END AS prop_id FROM d_owner)
SELECT owner_id, CASE WHEN prop_id = '' AND owner_id % 2 = 0 AND owner_id % 3 = 0 THEN '' ELSE prop_address END AS prop_address, prop_id FROM r"""


@query(EVICT)
def evict_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses that came from a cached lookup go where the record lost its parcel."""
    k = F.col("owner_id")
    r = view(spark, sf_dir, "d_owner").select("owner_id", F.when(k % 2 == 0, F.concat(k.cast("string"), F.lit(" SAMPLE ST."))).otherwise("OTHER").alias("prop_address"), F.when(k % 5 == 0, "").otherwise(F.concat(F.lit("P"), k.cast("string"))).alias("prop_id"))
    cache = view(spark, sf_dir, "d_owner").where(k % 3 == 0).select("owner_id", F.concat(k.cast("string"), F.lit(" sample st")).alias("cached"))
    both = r.join(cache, "owner_id", "left")
    orphan = (F.col("prop_id") == "") & (addresses.plain("prop_address") == addresses.plain("cached")) & F.col("cached").isNotNull()
    return merge.evict(both, orphan, ["prop_address"]).select("owner_id", "prop_address", "prop_id")
