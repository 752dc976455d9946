"""Ledgers, months, snapshots, pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import codes
from ..operators import joins, ranking, state, summary
from ..sources import html
from .views import table, view, with_views

QUERIES: dict = {}
ORACLES: dict = {}


def query(oracle: str | None = None):  # noqa: ANN201
    def add(f):  # noqa: ANN001, ANN202
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return add


def violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Report rows with is_open, passes, and coordinates on some."""
    v = view(spark, sf_dir, "d_violation")
    is_open = codes.header("status").isin(*codes.OPEN_STATUSES)
    lat = F.when(F.col("pos") % 7 == 0, F.round(F.col("pos") % 90 / 10, 2))
    return v.select("ref_no", "pos", F.col("prop_id").cast("string").alias("prop_id"), "case_type", F.col("cited").cast("string").alias("cited"), is_open.alias("is_open"), (~F.col("case_type").isin(*codes.DROPPED_CASES)).alias("passes"), lat.alias("lat"), (-lat).alias("lng"))


LEDGER_COLUMNS = "ref_no string, pos long, prop_id string, case_type string, cited string, lat double, lng double, state string"
LEDGER = with_views("d_violation") + """, v AS (
  SELECT ref_no, pos, CAST(prop_id AS VARCHAR) AS prop_id, case_type, CAST(cited AS VARCHAR) AS cited, status <> 'Compliant' AS is_open, case_type <> 'Zoning' AS passes FROM d_violation),
last AS (SELECT ref_no, CASE WHEN arg_max(is_open, pos) THEN 'open' ELSE 'closed' END AS state FROM v WHERE NOT is_open OR passes GROUP BY ref_no),
opened AS (SELECT ref_no, max(pos) AS pos, arg_max(prop_id, pos) AS prop_id, arg_max(case_type, pos) AS case_type FROM v WHERE is_open AND passes GROUP BY ref_no)
SELECT l.ref_no, l.state, o.prop_id, o.case_type, o.pos FROM last l LEFT JOIN opened o ON l.ref_no = o.ref_no"""


@query(LEDGER)
def ledger_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger after two reports, the second on top of the first: as if all rows came in order."""
    v = violations(spark, sf_dir)
    empty = spark.createDataFrame([], LEDGER_COLUMNS)
    cut = table(spark, sf_dir, "events").agg(F.max("event_id")).first()[0] // 2
    once = state.ledger_merge(empty, v.where(F.col("pos") <= cut))
    return state.ledger_merge(once, v.where(F.col("pos") > cut)).select("ref_no", "state", "prop_id", "case_type", "pos")


SUMMARY = with_views("d_violation") + """, c AS (SELECT CAST(prop_id AS VARCHAR) AS prop_id, ref_no, case_type, CAST(cited AS VARCHAR) AS cited, pos,
    row_number() OVER (PARTITION BY prop_id ORDER BY cited DESC, pos) AS n, CASE WHEN pos % 5 = 0 THEN 'note ' || (pos % 3) ELSE '' END AS narrative FROM d_violation WHERE status <> 'Compliant'),
types AS (SELECT prop_id, string_agg(CASE WHEN k > 1 THEN case_type || ' ×' || k ELSE case_type END, ' · ' ORDER BY k DESC, first) AS violation_type
  FROM (SELECT prop_id, case_type, count(*) AS k, min(n) AS first FROM c GROUP BY 1, 2) GROUP BY prop_id),
told AS (SELECT prop_id, string_agg('[' || case_type || '] ' || narrative, '  •  ' ORDER BY first) AS violation_narrative
  FROM (SELECT prop_id, case_type, narrative, min(n) AS first FROM c WHERE narrative <> '' GROUP BY 1, 2, 3) GROUP BY prop_id)
SELECT c.prop_id, CAST(count(*) AS BIGINT) AS case_count, CASE WHEN count(*) > 1 THEN count(*) || ' cases: ' || string_agg(ref_no, ', ' ORDER BY n) ELSE min(ref_no) END AS case_summary,
  arg_min(ref_no, n) AS primary_case, arg_min(cited, n) AS cited, min(t.violation_type) AS violation_type, coalesce(min(d.violation_narrative), '') AS violation_narrative
FROM c JOIN types t ON c.prop_id = t.prop_id LEFT JOIN told d ON c.prop_id = d.prop_id GROUP BY c.prop_id"""


@query(SUMMARY)
def property_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = violations(spark, sf_dir).where("is_open")
    note = F.when(F.col("pos") % 5 == 0, F.concat(F.lit("note "), (F.col("pos") % 3).cast("string"))).otherwise("")
    return summary.property_summary(v.withColumn("narrative", note)).select("prop_id", "case_count", "case_summary", "primary_case", "cited", "violation_type", "violation_narrative")


MONTHS = with_views("d_case_month") + """, m AS (SELECT case_id, period, CAST(sum(DISTINCT CAST(balance AS DECIMAL(18,2))) AS DOUBLE) AS balance FROM d_case_month GROUP BY 1, 2),
p AS (SELECT period, row_number() OVER (ORDER BY period) AS n, lead(period) OVER (ORDER BY period) AS next FROM (SELECT DISTINCT period FROM m))"""


@query(MONTHS + """ SELECT case_id, min(m.period) AS first_seen, max(m.period) AS last_seen, CAST(count(*) AS BIGINT) AS n_months, round(arg_max(balance, m.period), 2) AS balance,
  arg_max(p.next, m.period) FILTER (TRUE) AS claimed_month, CASE WHEN max(m.period) = (SELECT max(period) FROM p) THEN 'active' ELSE 'claimed' END AS status
  FROM m JOIN p ON m.period = p.period GROUP BY case_id""".replace("arg_max(p.next, m.period) FILTER (TRUE)", "(SELECT q.next FROM p q WHERE q.period = max(m.period))"))
def monthly_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = state.monthly_state(state.case_months(view(spark, sf_dir, "d_case_month")))
    return out.select("case_id", "first_seen", "last_seen", "n_months", "balance", "claimed_month", "status")


@query(MONTHS + """, s AS (SELECT case_id, m.period, n, balance, lag(n) OVER w AS before, lead(n) OVER w AS after FROM m JOIN p ON m.period = p.period WINDOW w AS (PARTITION BY case_id ORDER BY n)),
gone AS (SELECT n + 1 AS n, count(*) AS removed FROM s WHERE after IS NULL OR after > n + 1 GROUP BY 1)
SELECT s.period, CAST(count(*) AS BIGINT) AS lead_count, CAST(sum(CAST(balance AS DECIMAL(18,2))) AS DOUBLE) AS total, CAST(count(*) FILTER (before IS NULL) AS BIGINT) AS added,
  CAST(count(*) FILTER (before < s.n - 1) AS BIGINT) AS reappeared, CAST(coalesce(min(removed), 0) AS BIGINT) AS removed FROM s LEFT JOIN gone g ON g.n = s.n GROUP BY s.period""")
def month_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.month_rollup(state.case_months(view(spark, sf_dir, "d_case_month")))


@query(with_views("d_case_month") + " SELECT DISTINCT case_id FROM d_case_month WHERE period = '1996-01' AND case_id NOT IN (SELECT case_id FROM d_case_month WHERE period = '1996-02')")
def dropped_off(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = view(spark, sf_dir, "d_case_month")
    return joins.gone(m.where("period = '1996-01'").select("case_id").distinct(), m.where("period = '1996-02'"), "case_id")


@query("SELECT user_id, CAST(min(CAST(ts AS DATE)) AS VARCHAR) AS first_seen, CAST(max(CAST(ts AS DATE)) AS VARCHAR) AS last_seen FROM events GROUP BY user_id")
def first_last_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("user_id", F.col("ts").cast("date").cast("string").alias("day"))
    return state.first_last_seen(e, "user_id", "day")


@query("""WITH h AS (SELECT user_id, event_id, event_type <> 'error' AS hit, sum(CAST(event_type <> 'error' AS INT)) OVER (PARTITION BY user_id ORDER BY event_id) AS island FROM events)
SELECT user_id, event_id, CASE WHEN hit THEN CAST(0 AS BIGINT) ELSE CAST(sum(CAST(NOT hit AS INT)) OVER (PARTITION BY user_id, island ORDER BY event_id) AS BIGINT) END AS streak FROM h""")
def miss_streak(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type")
    return ranking.miss_streaks(e, ["user_id"], F.col("event_type") != "error", "event_id").select("user_id", "event_id", "streak")


@query("""WITH e AS (SELECT event_id // 50 AS page, user_id FROM events), known AS (SELECT DISTINCT user_id FROM events WHERE event_type = 'signup')
SELECT page, CAST(count(*) AS BIGINT) AS n_rows, bool_and(user_id IN (SELECT user_id FROM known)) AS all_known FROM e GROUP BY page""")
def page_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages (of 50 rows) all of whose keys are known: an incremental scan stops there."""
    e = table(spark, sf_dir, "events")
    known = e.where("event_type = 'signup'").select("user_id").distinct().withColumn("known", F.lit(True))
    page = e.select(F.floor(F.col("event_id") / 50).cast("long").alias("page"), "user_id").join(known, "user_id", "left")
    return page.groupBy("page").agg(F.count("*").alias("n_rows"), F.bool_and(F.coalesce("known", F.lit(False))).alias("all_known"))


@query()
def html_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "pages").select("page_id", F.explode(html.links("html")).alias("l"))
    return p.select("page_id", "l.pos", "l.href", "l.text")


@query("""SELECT page_id, trim(regexp_replace(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '\\s+', ' ', 'g')) AS title FROM pages""")
def html_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", html.title("html").alias("title"))


@query("""WITH s AS (SELECT event_id AS pos, 'A ×2 · B' AS t) SELECT event_id, 'A,A,' || event_type AS types FROM events""".replace("WITH s AS (SELECT event_id AS pos, 'A ×2 · B' AS t) ", ""))
def ledger_seed_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.concat(F.lit("A ×2 · "), "event_type")
    return table(spark, sf_dir, "events").select("event_id", F.array_join(codes.expand_types(raw), ",").alias("types"))
