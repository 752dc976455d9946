"""Merging a new scan into what is stored. Blank is null, white space, zero or an empty list."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def is_blank(c: Column) -> Column:
    return F.coalesce(F.trim(c.cast("string")).isin("", "0", "0.0", "[]"), F.lit(True))


def insert_if_absent(stored: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Stored rows and those new ones whose key is not stored."""
    return stored.unionByName(new.join(stored.select(key).distinct(), key, "left_anti").select(stored.columns))


def overwrite_if_filled(stored: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """A row for each key of either side; new values count unless they are blank."""
    fields = [c for c in stored.columns if c != key]
    both = stored.alias("s").join(new.alias("n"), key, "full_outer")
    return both.select(key, *[F.when(is_blank(F.col(f"n.{c}")), F.coalesce(F.col(f"s.{c}"), F.col(f"n.{c}"))).otherwise(F.col(f"n.{c}")).alias(c) for c in fields])


def fill_blanks(new: DataFrame, stored: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """New rows, their blank fields filled with what is stored for the key."""
    old = stored.select(key, *[F.col(c).alias(f"__{c}") for c in fields])
    out = new.join(old, key, "left")
    for c in fields:
        out = out.withColumn(c, F.when(is_blank(F.col(c)) & ~is_blank(F.col(f"__{c}")), F.col(f"__{c}")).otherwise(F.col(c)))
    return out.select(new.columns)


def upsert_foreclosures(stored: DataFrame, new: DataFrame, key: str, fields: Sequence[str], as_of: str) -> DataFrame:
    """New rows with blanks filled, and the stored ones that the scan lacks unless their sale is past.

    Columns sale_date (ISO text), and the result's status (pre or post) and days until the
    sale. An empty scan leaves what is stored.
    """
    empty = new.limit(1).agg((F.count("*") == 0).alias("__empty"))
    carried = stored.join(new.select(key).distinct(), key, "left_anti").crossJoin(F.broadcast(empty))  # one row
    carried = carried.where(F.col("__empty") | is_blank(F.col("sale_date")) | (F.col("sale_date") >= as_of)).drop("__empty")
    out = fill_blanks(new, stored, key, fields).unionByName(carried.select(new.columns))
    day = F.try_to_date(F.col("sale_date"))
    return out.withColumn("status", F.when((F.coalesce(F.col("sale_date"), F.lit("")) != "") & (F.col("sale_date") < as_of), "post").otherwise("pre")).withColumn("days_until_sale", F.date_diff(day, F.lit(as_of).cast("date")))


def by_policy(records: DataFrame, extracted: DataFrame, key: str, *, owned: Sequence[str], shared: Sequence[str], force: bool = False) -> DataFrame:
    """Fields of a document merged into records: owned ones follow the document wherever it says
    something, shared ones only where the record is blank, was read before (processed) or force
    is set; all others are protected."""
    fields = [*owned, *shared]
    doc = extracted.select(key, *[F.col(c).alias(f"__{c}") for c in fields], F.lit(True).alias("__seen"))
    out = records.join(doc, key, "left")
    free = F.coalesce(F.col("processed"), F.lit(False)) | F.lit(force)
    for c in fields:
        allowed = F.lit(True) if c in owned else is_blank(F.col(c)) | free
        out = out.withColumn(c, F.when(~is_blank(F.col(f"__{c}")) & allowed, F.col(f"__{c}")).otherwise(F.col(c)))
    out = out.withColumn("processed", F.coalesce(F.col("processed"), F.lit(False)) | F.coalesce(F.col("__seen"), F.lit(False)))
    return out.select(records.columns)


def evict(records: DataFrame, when: Column, fields: Sequence[str]) -> DataFrame:
    """records with the fields emptied where when holds."""
    names = set(fields)
    hit = F.coalesce(when, F.lit(False))
    return records.select(*[F.when(hit, F.lit("")).otherwise(F.col(c)).alias(c) if c in names else F.col(c) for c in records.columns])


def fill_block(records: DataFrame, found: DataFrame, key: str, fields: Sequence[str], first: str) -> DataFrame:
    """Fields that belong together (a mailing address) are filled as one where first is blank."""
    add = found.where(~is_blank(F.col(first))).select(key, *[F.col(c).alias(f"__{c}") for c in fields])
    out = records.join(add, key, "left")
    take = is_blank(F.col(first)) & ~is_blank(F.col(f"__{first}"))
    return out.select(*[F.when(take, F.col(f"__{c}")).otherwise(F.col(c)).alias(c) if c in fields else F.col(c) for c in records.columns])


def expire(cache: DataFrame, evicted: DataFrame, key: str, version: int = 6) -> DataFrame:
    """The cache without the look-ups of evicted keys; entries of other versions are left alone."""
    return cache.join(evicted.select(key, F.lit(version).alias("version")).distinct(), [key, "version"], "left_anti").select(cache.columns)


def additions(records: DataFrame, best: DataFrame, key: str, *, fields: Mapping[str, str], block: Mapping[str, str], default: Mapping[str, str], zero_is_blank: Sequence[str] = ("market_value",)) -> DataFrame:
    """What a look-up adds to records: key and one column for each field, null where nothing is added.

    fields and block map a record's field to best's column (best has one row a key; records without one get
    nulls only). A null or blank value adds nothing, nor does 0 for zero_is_blank; other fields keep a 0. default
    gives the value of a field where best says none. Values overwrite, which is the caller's to apply.
    """
    columns = {f: c for m in (fields, block) for f, c in m.items()}
    found = records.select(key).join(best.select(key, *[F.col(c).alias(f"__{f}") for f, c in columns.items()], F.lit(True).alias("__best")), key, "left")

    def added(f: str) -> Column:
        v = F.col(f"__{f}")
        empty = F.coalesce(F.trim(v.cast("string")) == "", F.lit(True))
        if f in zero_is_blank:
            empty = empty | F.coalesce(v.try_cast("double") == 0, F.lit(False))
        given = F.when(~empty, v)
        return F.coalesce(given, F.when(F.col("__best"), F.lit(default[f]))) if f in default else given

    return found.select(key, *[added(f).alias(f) for f in columns])
