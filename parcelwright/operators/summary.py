"""Aggregates: one row per property, statistics of a list."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def property_summary(cases: DataFrame) -> DataFrame:
    """Open cases (prop_id, ref_no, case_type, narrative, cited, pos, lat, lng) to one row per property.

    Cases stand by date, the latest first, in the order of pos within a day. A type that
    occurs n times is written "T ×n", the most frequent first and then by appearance;
    narratives are written once. Rows without a property are left out. A property's cases
    are gathered in one row, as its list of case numbers is part of the result.
    """
    case = F.struct((-F.datediff(F.coalesce(F.try_to_date("cited"), F.lit("0001-01-01").cast("date")), F.lit("1970-01-01").cast("date"))).alias("late"), "pos", "ref_no", "case_type", "narrative", "cited", "lat", "lng")
    g = cases.where(F.col("prop_id").isNotNull() & (F.col("prop_id").cast("string") != "")).groupBy("prop_id").agg(F.sort_array(F.collect_list(case)).alias("c"))
    types = F.filter(F.col("c.case_type"), lambda t: F.coalesce(t, F.lit("")) != "")
    counted = F.transform(F.array_distinct(types), lambda t: F.struct((-F.size(F.filter(types, lambda x: x == t))).alias("n"), F.array_position(types, t).alias("first"), t.alias("t")))
    summary = F.transform(F.sort_array(counted), lambda s: F.when(s["n"] < -1, F.concat(s["t"], F.lit(" ×"), (-s["n"]).cast("string"))).otherwise(s["t"]))
    told = F.filter("c", lambda x: F.coalesce(x["narrative"], F.lit("")) != "")
    narratives = F.array_distinct(F.transform(told, lambda x: F.concat(F.lit("["), x["case_type"], F.lit("] "), x["narrative"])))
    numbers = F.array_join(F.col("c.ref_no"), ", ")
    first = F.element_at(F.col("c.ref_no"), 1)
    return g.select(
        "prop_id",
        F.size("c").cast("long").alias("case_count"),
        numbers.alias("case_nums"),
        F.when(F.size("c") > 1, F.concat(F.size("c").cast("string"), F.lit(" cases: "), numbers)).otherwise(first).alias("case_summary"),
        first.alias("primary_case"),
        F.element_at(F.col("c.cited"), 1).alias("cited"),
        F.array_join(summary, " · ").alias("violation_type"),
        F.array_join(narratives, "  •  ").alias("violation_narrative"),
        F.get(F.filter(F.col("c.lat"), lambda x: x.isNotNull()), F.lit(0)).alias("lat"),
        F.get(F.filter(F.col("c.lng"), lambda x: x.isNotNull()), F.lit(0)).alias("lng"),
    )


def drop_reasons(df: DataFrame, reason: Column) -> DataFrame:
    """How many rows each reason drops; "kept" for null."""
    return df.groupBy(F.coalesce(reason, F.lit("kept")).alias("reason")).agg(F.count("*").alias("n"))


def lead_stats(leads: DataFrame) -> DataFrame:
    return leads.agg(
        F.count("*").alias("total"),
        F.count_if(F.coalesce(F.trim("prop_address") != "", F.lit(False))).alias("with_address"),
        F.count_if(F.col("score") >= 70).alias("hot"),
        F.count_if(F.col("cat") == "LP").alias("lis_pendens"),
    )


def categories(leads: DataFrame, position: str) -> DataFrame:
    """Each label with its category and place, in the order of first appearance."""
    return leads.groupBy("cat_label").agg(F.min_by("cat", position).alias("cat"), F.min(position).alias("first_pos"))


def search(df: DataFrame, query: str, columns: list[str]) -> DataFrame:
    """Rows of which some column contains the text, without regard to case."""
    hit = F.lit(False)
    for c in columns:
        hit = hit | F.coalesce(F.contains(F.lower(F.col(c)), F.lit(query.lower())), F.lit(False))
    return df.where(hit)


def envelope(df: DataFrame, **more: Column) -> DataFrame:
    """One row with counts and all records as JSON, nulls written out. For lists that one file holds."""
    record = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})
    return df.agg(F.count("*").alias("total"), F.concat(F.lit("["), F.array_join(F.collect_list(record), ","), F.lit("]")).alias("records"), *[v.alias(k) for k, v in more.items()])


def match_summary(leads: DataFrame) -> DataFrame:
    """How many leads matched in full, by id only, had no owner, or were unclear (columns prop_id, address, owner, n)."""
    filled = lambda c: F.coalesce(F.trim(F.col(c).cast("string")) != "", F.lit(False))
    return leads.agg(
        F.count_if(filled("prop_id") & filled("address")).alias("matched"),
        F.count_if(filled("prop_id") & ~filled("address")).alias("id_only"),
        F.count_if(~filled("owner")).alias("no_owner"),
        F.count_if(~filled("prop_id") & (F.col("n") > 1)).alias("unclear"),
    )


def excess_store(months: DataFrame, states: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Cases with their balance by month (a map), and one row of totals.

    months: case_id, period, balance; states: see state.monthly_state.
    """
    history = months.groupBy("case_id").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("period", "balance")))).alias("balance_history"))
    cases = states.join(history, "case_id")
    n = months.select("period").distinct().agg(F.count("*").alias("n"))
    totals = cases.crossJoin(F.broadcast(n)).agg(  # n is one row
        F.count_if(F.col("status") == "active").alias("active"),
        F.count_if(F.col("status") == "claimed").alias("claimed"),
        F.round(F.sum(F.when(F.col("status") == "active", F.col("balance").cast("decimal(18,2)"))), 2).cast("double").alias("active_total"),
        F.count_if(F.col("n_months") == F.col("n")).alias("in_every_month"),
    )
    return cases, totals
