"""A keyed store of look-ups with versions and two key spaces: owners' names and addresses.

Entries by name carry the version of the look-up that made them; entries by address (a key with the
prefix of `identifiers.address_cache_key`) have none and never expire.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.base import blank
from ..functions.identifiers import ADDRESS_PREFIX
from .ranking import best_per

# The store's version, older ones whose hits still count, and what a hit must tell, in
# the order in which a missing part is named; a value of 0 tells nothing.
VERSION, OLDER = 6, (3, 4, 5)
MUST_TELL = ("appraised_value", "mail_addr", "ncad_prop_id", "ncad_legal")
SITE = "site_addr"


def is_address(key: str = "key") -> Column:
    return F.startswith(F.col(key), F.lit(ADDRESS_PREFIX))


def is_hit(site: str = SITE) -> Column:
    return ~blank(site)


def current(store: DataFrame) -> DataFrame:
    """The store in its present version: entries by address as they are, of entries by name those of VERSION
    and the hits of OLDER ones, which become VERSION. Misses of older versions and all of other versions go."""
    version = F.col("version")
    keep = is_address() | F.coalesce(version == VERSION, F.lit(False)) | (F.coalesce(version.isin(*OLDER), F.lit(False)) & is_hit())
    return store.where(F.coalesce(keep, F.lit(False))).withColumn("version", F.when(~is_address(), VERSION))


def lacks(fields: Sequence[str] = MUST_TELL) -> Column:
    """The first field that a hit lacks, null for a hit that has all and for a miss."""
    missing = lambda c: blank(c) | F.coalesce(F.col(c).try_cast("double") == 0, F.lit(False))
    first = F.coalesce(*[F.when(missing(c) if c == "appraised_value" else blank(c), F.lit(c)) for c in fields])
    return F.when(is_hit(), first)


def to_ask(keys: DataFrame, store: DataFrame, *, retry_misses: bool = False, fields: Sequence[str] = MUST_TELL) -> DataFrame:
    """keys (key) with reason, why a key must be looked up: "new", "lacks X" for a hit that was made
    before X was kept, "miss" if misses are tried again; null if it need not be. Each distinct filled key once."""
    held = current(store).select("key", F.lit(True).alias("__held"), is_hit().alias("__hit"), lacks(fields).alias("__lacks"))
    asked = keys.where(~blank("key")).select("key").distinct().join(held, "key", "left")
    reason = F.when(F.col("__held").isNull(), "new").when(F.col("__lacks").isNotNull() & ~is_address(), F.concat(F.lit("lacks "), F.col("__lacks")))
    if retry_misses:
        reason = reason.when(~F.col("__hit"), "miss")
    return asked.select("key", reason.alias("reason"))


def merged(store: DataFrame, answers: DataFrame, fields: Mapping[str, str] | Sequence[str]) -> DataFrame:
    """The current store with answers (key, pos, fields) in place of what it held for their keys; a key's
    last answer by pos counts. An answer without a site is a miss and takes the place of an old hit only if there is none."""
    names = list(fields)
    new = best_per(answers.where(~blank("key")), ["key"], F.col("pos").desc()).select("key", *[F.col(f).alias(f"__{f}") for f in names], F.lit(True).alias("__new"))
    both = current(store).withColumn("__old", F.lit(True)).join(new, "key", "full_outer")
    take = F.coalesce(F.col("__new"), F.lit(False)) & (~blank(f"__{SITE}") | ~(F.coalesce(F.col("__old"), F.lit(False)) & is_hit()))
    return both.select("key", F.when(~is_address(), VERSION).alias("version"), *[F.when(take, F.col(f"__{f}")).otherwise(F.col(f)).alias(f) for f in names])
