"""Incremental state in batches: the violation ledger, the months of cases, snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .ranking import best_per


def ledger_merge(ledger: DataFrame, report: DataFrame) -> DataFrame:
    """The ledger after a report.

    report: ref_no, pos (order in the file), is_open, passes (an open row's filters), lat,
    lng, and the columns of the ledger other than state. Per reference the rows count in
    order: an open row that passes is stored (its missing coordinates from what was stored before),
    an open row that fails changes nothing, any other row closes what is stored or leaves a
    closed mark. So the last row that is not a failing open one settles the state, and the
    last passing open row the data. Running a report twice changes nothing further.
    """
    data = [c for c in ledger.columns if c not in ("ref_no", "state")]
    counted = report.where(~F.col("is_open") | F.col("passes"))
    last = best_per(counted, ["ref_no"], F.col("pos").desc()).select("ref_no", F.when(F.col("is_open"), "open").otherwise("closed").alias("__state"))
    passed = report.where(F.col("is_open") & F.col("passes"))
    opened = best_per(passed, ["ref_no"], F.col("pos").desc()).select("ref_no", *[F.col(c).alias(f"__{c}") for c in data if c not in ("lat", "lng")], F.lit(True).alias("__new"))
    # Coordinates are the last ones that any of the rows gives.
    places = [F.max_by(c, F.when(F.col(c).isNotNull(), F.col("pos"))).alias(f"__{c}") for c in data if c in ("lat", "lng")]
    opened = opened.join(passed.groupBy("ref_no").agg(*places), "ref_no") if places else opened
    out = ledger.join(last, "ref_no", "full_outer").join(opened, "ref_no", "left")
    fresh = F.coalesce(F.col("__new"), F.lit(False))
    pick = lambda c: F.coalesce(F.col(f"__{c}"), F.col(c)) if c in ("lat", "lng") else F.when(fresh, F.col(f"__{c}")).otherwise(F.col(c))
    return out.select("ref_no", *[pick(c).alias(c) for c in data], F.coalesce("__state", "state").alias("state")).select(ledger.columns)


def ledger_seed(summary: DataFrame) -> DataFrame:
    """An open ledger row for each case of a published property summary (case_nums, types: arrays)."""
    return summary.select("prop_id", F.posexplode(F.arrays_zip("case_nums", "types")).alias("pos", "c")).select("prop_id", "pos", F.col("c.case_nums").alias("ref_no"), F.col("c.types").alias("case_type"), F.lit("open").alias("state"))


def ledger_or_seed(ledger: DataFrame | None, summary: DataFrame) -> DataFrame:
    """The stored ledger, or where there is none (or an empty one) that of the published summary."""
    return ledger_seed(summary) if ledger is None or ledger.isEmpty() else ledger


def cases(rows: DataFrame) -> DataFrame:
    """Rows (case_number, pos, balance, owner, plaintiff, case_type) of a month to one per case: the
    sum of distinct amounts in cents, the first owner that is filled, the first row's
    plaintiff and case type."""
    return rows.groupBy("case_number").agg(
        F.coalesce(F.sum_distinct(F.round("balance", 2).cast("decimal(18,2)")), F.lit(0)).cast("double").alias("balance"),
        F.coalesce(F.min_by("owner", F.when(F.coalesce(F.col("owner"), F.lit("")) != "", F.col("pos"))), F.lit("")).alias("owner"),
        *[F.min_by(c, "pos").alias(c) for c in ("plaintiff", "case_type")],
    )


def case_months(rows: DataFrame) -> DataFrame:
    """Rows (case_id, period, balance) to one row per case and month: balance is the sum of
    the distinct amounts, rounded to cents."""
    return rows.groupBy("case_id", "period").agg(F.round(F.sum_distinct(F.round(F.col("balance"), 2).cast("decimal(18,2)")), 2).cast("double").alias("balance"))


def monthly_state(months: DataFrame) -> DataFrame:
    """One row per case after all months, in the order of period: status active or claimed,
    claimed_month (the first month without it after the last one with it), first_seen,
    last_seen, n_months and its last balance."""
    every = months.select("period").distinct().withColumn("next_period", F.lead("period").over(Window.orderBy("period")))  # one row a month
    seen = months.groupBy("case_id").agg(F.min("period").alias("first_seen"), F.max("period").alias("last_seen"), F.count("*").alias("n_months"), F.max_by("balance", "period").alias("balance"))
    out = seen.join(every.select(F.col("period").alias("last_seen"), F.col("next_period").alias("claimed_month")), "last_seen", "left")
    return out.withColumn("status", F.when(F.col("claimed_month").isNull(), "active").otherwise("claimed"))


def month_rollup(months: DataFrame) -> DataFrame:
    """One row per month: cases, total, and how many were added, came back or went."""
    every = months.select("period").distinct().withColumn("n", F.row_number().over(Window.orderBy("period")))  # one row a month
    w = Window.partitionBy("case_id").orderBy("n")
    step = months.join(every, "period").withColumn("before", F.lag("n").over(w)).withColumn("after", F.lead("n").over(w))
    here = step.groupBy("n", "period").agg(
        F.count("*").alias("lead_count"),
        F.round(F.sum(F.col("balance").cast("decimal(18,2)")), 2).cast("double").alias("total"),
        F.count_if(F.col("before").isNull()).alias("added"),
        F.count_if(F.col("before") < F.col("n") - 1).alias("reappeared"),
    )
    left = step.where(F.col("after").isNull() | (F.col("after") > F.col("n") + 1)).groupBy((F.col("n") + 1).alias("n")).agg(F.count("*").alias("removed"))
    return here.join(left, "n", "left").select("period", "lead_count", "total", "added", "reappeared", F.coalesce("removed", F.lit(0)).cast("long").alias("removed"))


def first_last_seen(snapshots: DataFrame, key: str, date: str) -> DataFrame:
    return snapshots.groupBy(key).agg(F.min(date).alias("first_seen"), F.max(date).alias("last_seen"))
