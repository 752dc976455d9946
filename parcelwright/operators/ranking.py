"""Dedup and ranking with stated tie-breakers: every rule that reads "the first one" takes a position column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RANK = "__rank"


def best_per(df: DataFrame, keys: Sequence[str], *order: Column) -> DataFrame:
    """The first row of each key by order. Null keys are keys like others."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(RANK, F.row_number().over(w)).where(F.col(RANK) == 1).drop(RANK)


def keep_first(df: DataFrame, keys: Sequence[str], position: str) -> DataFrame:
    return best_per(df, keys, F.col(position))


def keep_last(df: DataFrame, keys: Sequence[str], position: str) -> DataFrame:
    return best_per(df, keys, F.col(position).desc())


def most_specific(df: DataFrame, keys: Sequence[str], weight: Column, position: str) -> DataFrame:
    """The row of largest weight, the first among equals."""
    return best_per(df, keys, weight.desc(), F.col(position))


def top_rows(df: DataFrame, n: int, *order: Column) -> DataFrame:
    return df.orderBy(*order).limit(n)


def best_if(df: DataFrame, keys: Sequence[str], guard: Column, *order: Column) -> DataFrame:
    """The top row of each key if the guard holds for it; later rows get no chance."""
    return best_per(df, keys, *order).where(guard)


def single_or_confirmed(df: DataFrame, keys: Sequence[str], confirmed: Column, position: str) -> DataFrame:
    """A single candidate is trusted; of several the first confirmed one counts."""
    n = F.count("*").over(Window.partitionBy(*keys))
    return best_per(df.withColumn("__n", n).where((F.col("__n") == 1) | confirmed).drop("__n"), keys, F.col(position))


def miss_streaks(df: DataFrame, keys: Sequence[str], hit: Column, position: str) -> DataFrame:
    """df with streak: how many misses in a row end here; a hit has 0."""
    w = Window.partitionBy(*keys).orderBy(position)
    island = df.withColumn("__hit", hit).withColumn("__island", F.sum(F.col("__hit").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    inside = Window.partitionBy(*keys, "__island").orderBy(position)
    streak = F.sum((~F.col("__hit")).cast("long")).over(inside.rowsBetween(Window.unboundedPreceding, 0))
    return island.withColumn("streak", F.when(F.col("__hit"), F.lit(0).cast("long")).otherwise(streak)).drop("__hit", "__island")
