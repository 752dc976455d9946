"""Property tables derived from the supplied star schema, by SQL that Spark and DuckDB both run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: The date as of which orders-based views are read.
AS_OF = "2001-08-01"

VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "d_owner": (("customer",), """
SELECT c_custkey AS owner_id,
  CASE c_custkey % 12
    WHEN 0 THEN 'SAMPLE ' || CAST(c_custkey AS STRING) || ' HOLDINGS LLC'
    WHEN 1 THEN 'ESTATE OF DOE ' || CAST(c_custkey AS STRING)
    WHEN 2 THEN 'DOE FAM TRST ' || CAST(c_custkey AS STRING)
    WHEN 3 THEN 'SAMPLE LAND TRUST'
    WHEN 4 THEN 'SAMPLE COUNTY TRUSTEE'
    WHEN 5 THEN 'SAMPLE ISD'
    WHEN 6 THEN 'FIRST SAMPLE CHURCH OF TESTING'
    WHEN 7 THEN 'SAMPLE CONDOMINIUM ASSOCIATION'
    WHEN 8 THEN 'SAMPLE FOUNDATION'
    WHEN 9 THEN 'ALEX BANK JR'
    WHEN 10 THEN ''
    ELSE 'DOE CASEY ' || CAST(c_custkey AS STRING) END AS owner
FROM customer"""),
    "d_parcel": (("part",), """
SELECT p_partkey AS prop_id,
  lpad(CAST(p_partkey * 10 AS STRING), 12, '0') AS account_raw,
  CASE p_partkey % 8 WHEN 0 THEN 'A1' WHEN 1 THEN 'B1' WHEN 2 THEN 'B2' WHEN 3 THEN 'C1'
    WHEN 4 THEN 'F1' WHEN 5 THEN 'A1' WHEN 6 THEN 'E1' ELSE '' END AS state_class,
  CAST(100 + p_partkey % 50 AS STRING) || CASE WHEN p_partkey % 3 = 0 THEN ' N ' ELSE ' ' END
    || upper(substr(p_name, 1, 4)) || CASE WHEN p_partkey % 2 = 0 THEN ' STREET' ELSE ' AVE' END AS situs,
  'SAMPLE ' || upper(p_type) || ' UNIT ' || CAST(p_partkey % 3 + 1 AS STRING) || ' BLK '
    || CAST(p_size AS STRING) || ' LOT ' || CAST(p_partkey % 20 + 1 AS STRING) AS legal,
  round(p_retailprice * (200 + p_size * 10), 2) AS market_value,
  CASE p_partkey % 5 WHEN 0 THEN '' WHEN 1 THEN '90001' ELSE '90002' END AS prop_zip,
  '25,24,' || CAST(p_partkey % 24 AS STRING) AS del_years_raw,
  p_partkey % 150 AS owner_id
FROM part"""),
    "d_filing": (("orders",), """
SELECT CAST(2024000000 + o_orderkey AS STRING) AS doc_num, o_orderkey AS pos, o_custkey AS owner_id,
  CASE o_orderkey % 9 WHEN 0 THEN 'LIS PENDENS' WHEN 1 THEN 'NOTICE OF FORECLOSURE'
    WHEN 2 THEN 'ABSTRACT OF JUDGMENT' WHEN 3 THEN 'FEDERAL TAX LIEN' WHEN 4 THEN 'MECHANICS LIEN'
    WHEN 5 THEN 'AFFIDAVIT OF HEIRSHIP' WHEN 6 THEN 'MEDICAID LIEN'
    WHEN 7 THEN 'RELEASE OF LIS PENDENS' ELSE 'LIEN' END AS doc_type,
  CAST(o_orderdate AS DATE) AS filed, o_totalprice AS amount
FROM orders"""),
    "d_violation": (("events",), """
SELECT event_id AS pos, 'CE' || CAST(event_id % 500 AS STRING) AS ref_no, user_id AS prop_id,
  CASE event_type WHEN 'error' THEN 'Compliant' WHEN 'purchase' THEN 'New' ELSE 'In Progress' END AS status,
  CASE event_id % 4 WHEN 0 THEN 'Care of Premises' WHEN 1 THEN 'Vacant Building'
    WHEN 2 THEN 'Zoning' ELSE 'Tall Weeds' END AS case_type,
  CAST(ts AS DATE) AS cited, value AS amount
FROM events"""),
    "d_case_month": (("lineitem",), """
SELECT l_orderkey % 500 AS case_id, substr(CAST(CAST(l_shipdate AS DATE) AS STRING), 1, 7) AS period,
  round(l_extendedprice, 2) AS balance
FROM lineitem"""),
}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    tables, sql = VIEWS[name]
    for t in tables:
        sql = sql.replace(f"FROM {t}", f"FROM {{{t}}}")
    return spark.sql(sql, **{t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in tables})


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, key: str) -> DataFrame:
    """df dealt out by a key of many values over four tasks a core, for work that costs much by the row: a
    file of small rows has few row groups, and each is one task's whatever the number of cores."""
    return df.repartition(4 * df.sparkSession.sparkContext.defaultParallelism, key)


def with_views(*names: str) -> str:
    """A WITH clause of the views, for oracle SQL; more tables may follow it."""
    return "WITH " + ",\n".join(f"{n} AS ({VIEWS[n][1]})" for n in names)
