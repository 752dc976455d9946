"""Rows for a service that takes them in numbered batches, and its answers."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Rows of a batch.
BATCH = 5_000
#: Rows that one task numbers.
BUCKET = 50_000


def batched(rows: DataFrame, *, key: str = "uid", size: int = BATCH, bucket: int = BUCKET) -> DataFrame:
    """One row for each filled key with number, from 0, and batch: exactly `size` rows a batch, less in
    the last. Of a key's rows the least by all columns counts.

    Keys are dealt into buckets by hash; a bucket's rows are numbered in a task of their own, from where
    the buckets before it end. Nothing but one count a bucket meets in one place.
    """
    others = [c for c in rows.columns if c != key]
    once = rows.where(F.col(key).isNotNull())
    once = once.groupBy(key).agg(F.min(F.struct(*others)).alias("__r")).select(key, "__r.*") if others else once.distinct()
    buckets = max(1, -(-once.count() // bucket))
    once = once.withColumn("__b", F.pmod(F.xxhash64(key), F.lit(buckets)))
    sizes = once.groupBy("__b").agg(F.count("*").alias("__n"))
    starts = sizes.select("__b", (F.sum("__n").over(Window.orderBy("__b")) - F.col("__n")).alias("__start"))
    inside = F.row_number().over(Window.partitionBy("__b").orderBy(key)) - 1
    out = once.withColumn("__i", inside).join(starts, "__b").withColumn("number", F.col("__start") + F.col("__i"))
    return out.select(*rows.columns, "number", F.floor(F.col("number") / size).cast("long").alias("batch"))


def answered(batches: DataFrame, answers: DataFrame, *, key: str = "uid") -> DataFrame:
    """batches with the lat and lon that answers (batch, uid, match, lon_lat: "lon,lat") give for a row
    of the same batch. Only answers that say Match and hold two numbers count; of several the least text."""
    at = F.split("lon_lat", ",")
    good = answers.where(F.col("match") == "Match").select("batch", key, F.when(F.size(at) == 2, F.struct("lon_lat", F.get(at, F.lit(1)).try_cast("double").alias("lat"), F.get(at, F.lit(0)).try_cast("double").alias("lon"))).alias("a"))
    best = good.where("a.lat is not null and a.lon is not null").groupBy("batch", key).agg(F.min("a").alias("a"))
    return batches.join(best, ["batch", key], "left").select(*batches.columns, "a.lat", "a.lon")
