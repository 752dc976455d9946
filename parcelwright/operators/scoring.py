"""Flags and score of a lead."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.base import blank, has, text
from ..functions.owners import ENTITY_OWNER
from .joins import with_both

# Flags by category and the parts of a score.
CATEGORY_FLAGS = (("LP", "Lis pendens"), ("NOFC", "Pre-foreclosure"), ("JUD", "Judgment lien"), ("LNFED", "Tax lien"))
LATER_FLAGS = (("PRO", "Probate / estate"), ("MEDLN", "Medicaid lien"))
BASE, PER_FLAG, COMBO, LARGE, MEDIUM, RECENT, ADDRESS = 30, 10, 20, 15, 10, 5, 5
LARGE_AMOUNT, MEDIUM_AMOUNT, RECENT_DAYS = 100_000, 50_000, 7


def flags(as_of: str) -> Column:
    """The flags of a row with cat, doc_type, owner and filed, in their fixed order."""
    recent = F.date_diff(F.lit(as_of).cast("date"), F.col("filed").cast("date")) <= RECENT_DAYS
    return F.array_compact(
        F.array(
            *[F.when(F.col("cat") == c, f) for c, f in CATEGORY_FLAGS],
            F.when((F.col("cat") == "LN") & has("doc_type", "MECH"), "Mechanic lien"),
            *[F.when(F.col("cat") == c, f) for c, f in LATER_FLAGS],
            F.when(has("owner", ENTITY_OWNER), "LLC / corp owner"),
            F.when(recent, "New this week"),
        )
    )


def score_leads(leads: DataFrame, as_of: str) -> DataFrame:
    """leads with flags and score (0 to 100).

    Owners with both a lis pendens and a foreclosure notice get the combination's points;
    blank owners never do.
    """
    keyed = leads.withColumn("__owner", F.upper(F.trim(text("owner")))).withColumn("flags", flags(as_of))
    keyed = with_both(keyed, "__owner", "cat", "LP", "NOFC", "__combo")
    points = (
        F.lit(BASE) + PER_FLAG * F.size("flags") + F.when(F.col("__combo"), COMBO).otherwise(0)
        + F.when(F.col("amount") > LARGE_AMOUNT, LARGE).when(F.col("amount") > MEDIUM_AMOUNT, MEDIUM).otherwise(0)
        + F.when(F.array_contains("flags", "New this week"), RECENT).otherwise(0)
        + F.when(~blank("prop_address"), ADDRESS).otherwise(0)
    )
    return keyed.withColumn("score", F.greatest(F.lit(0), F.least(F.lit(100), points))).drop("__owner", "__combo")
