"""Matching records with parcels: exact, in tiers, unique, by ordered fallback, corroborated.

Every join is an equi-join on a key column, so Catalyst hashes or sorts it; the reference
side is broadcast only where Spark's own statistics say that it is small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.addresses import full_key, key_without_direction
from .ranking import best_per


def lookup(df: DataFrame, reference: DataFrame, key: str, value: str, into: str) -> DataFrame:
    """df with into filled from reference[value] where it is blank; misses stay as they are.

    The reference's last row of a key counts; it must carry a column pos.
    """
    last = best_per(reference, [key], F.col("pos").desc()).select(key, F.col(value).alias("__found"))
    kept = F.nullif(F.trim(F.coalesce(F.col(into), F.lit(""))), F.lit(""))
    return df.join(last, key, "left").withColumn(into, F.coalesce(kept, F.col("__found"), F.lit(""))).drop("__found")


def parcel_index(parcels: DataFrame, words: str = "words") -> DataFrame:
    """Parcels with both match keys; those without words are left out."""
    return parcels.where(F.size(words) > 0).withColumn("full_key", full_key(words)).withColumn("loose_key", key_without_direction(words))


def two_tier(df: DataFrame, index: DataFrame, words: str = "words") -> DataFrame:
    """df (with id) and its candidate parcels: those with the same full key or, where there is
    none, those with the same key without direction if they agree on one class at most.

    Result: id, tier, prop_id, cls, pos. Keys are counted before the join, so an unclear key
    that many parcels share brings no rows.
    """
    left = df.select("id", full_key(words).alias("full_key"), key_without_direction(words).alias("loose_key"))
    exact = left.join(index.select("full_key", "prop_id", "cls", "pos"), "full_key").select("id", F.lit("full").alias("tier"), "prop_id", "cls", "pos")
    clear = index.groupBy("loose_key").agg(F.count_distinct(F.nullif("cls", F.lit(""))).alias("n")).where("n <= 1").select("loose_key")
    rest = left.join(index.select("full_key").distinct(), "full_key", "left_anti")
    loose = rest.join(clear, "loose_key").join(index.select("loose_key", "prop_id", "cls", "pos"), "loose_key").select("id", F.lit("noprefix").alias("tier"), "prop_id", "cls", "pos")
    return exact.unionByName(loose)


def two_tier_vote(df: DataFrame, index: DataFrame, words: str = "words") -> DataFrame:
    """What the candidates of `two_tier` come to: id, tier, candidates (their number), cls (their most
    frequent filled class, among equals the one with the least pos; "" without one).

    Parcels are summed up by key before they meet df, so its rows join one row at most, however many parcels share a key.
    """

    def votes(key: str) -> DataFrame:
        counts = index.groupBy(key, "cls").agg(F.count("*").alias("n"), F.min("pos").alias("first"))
        filled = F.col("cls") != ""
        vote = F.min(F.when(filled, F.struct((-F.col("n")).alias("less"), "first", "cls")))
        return counts.groupBy(key).agg(F.sum("n").alias("candidates"), F.count(F.when(filled, 1)).alias("classes"), vote["cls"].alias("cls"))

    left = df.select("id", full_key(words).alias("full_key"), key_without_direction(words).alias("loose_key"))
    full, loose = votes("full_key").select("full_key", F.struct(F.lit("full").alias("tier"), "candidates", "cls").alias("f")), votes("loose_key").where("classes <= 1").select("loose_key", F.struct(F.lit("noprefix").alias("tier"), "candidates", "cls").alias("l"))
    found = left.join(full, "full_key", "left").join(loose, "loose_key", "left").select("id", F.coalesce("f", "l").alias("v")).where("v is not null")
    return found.select("id", "v.tier", "v.candidates", F.coalesce("v.cls", F.lit("")).alias("cls"))


def majority(candidates: DataFrame, key: str, value: str, position: str) -> DataFrame:
    """The most frequent filled value of each key; among equals the one seen first."""
    counts = candidates.where(F.col(value) != "").groupBy(key, value).agg(F.count("*").alias("__n"), F.min(position).alias("__first"))
    return best_per(counts, [key], F.col("__n").desc(), F.col("__first")).select(key, value)


def unique_match(groups: DataFrame, key: str, value: str, n: str) -> DataFrame:
    """key and value of the keys that have exactly one match; a row stands for n matches, and a key's rows count together."""
    return groups.groupBy(key).agg(F.sum(n).alias("__n"), F.min(value).alias(value)).where("__n = 1").drop("__n")


def first_variant(leads: DataFrame, variants: str, reference: DataFrame, name: str) -> DataFrame:
    """For each lead the reference rows of the first of its variants that has any."""
    tried = leads.select("lead_id", F.posexplode(variants).alias("variant_pos", name))
    found = tried.join(reference, name)
    first = F.min("variant_pos").over(Window.partitionBy("lead_id"))
    return found.withColumn("__first", first).where("variant_pos = __first").drop("__first")


def gate(record_legal: Column, cached_legal: Column, match: Column) -> Column:
    """What a cached lookup may write: match, mismatch, optimistic (no legal of our own) or skip."""
    empty = lambda c: F.coalesce(F.trim(c) == "", F.lit(True))
    return F.when(empty(record_legal), "optimistic").when(empty(cached_legal), "skip").when(match, "match").otherwise("mismatch")


def with_both(df: DataFrame, key: str, category: str, a: str, b: str, into: str) -> DataFrame:
    """df with into: whether the row's key, if it is not empty, has both categories somewhere.

    Keys are reduced to those that have both before they meet the rows, so that rows of an
    empty or frequent key are nowhere gathered.
    """
    seen = df.where((F.col(key) != "") & F.col(category).isin(a, b)).groupBy(key).agg(F.count_distinct(category).alias("__n"))
    both = seen.where("__n = 2").select(key, F.lit(True).alias(into))
    return df.join(both, key, "left").withColumn(into, F.coalesce(into, F.lit(False)))


def gone(before: DataFrame, now: DataFrame, key: str) -> DataFrame:
    return before.join(now.select(key).distinct(), key, "left_anti")


def stack(sources: dict[str, DataFrame]) -> DataFrame:
    """Sources (account, address_key) to one row per property: which sources name it, and how many."""
    parts = [df.select(F.lit(name).alias("source"), F.coalesce(F.nullif(F.trim("account"), F.lit("")), F.col("address_key")).alias("property_key")) for name, df in sources.items()]
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    every = every.where(F.coalesce(F.col("property_key") != "", F.lit(False))).distinct()
    return every.groupBy("property_key").agg(F.sort_array(F.collect_set("source")).alias("sources"), F.count("*").alias("n_sources"))
