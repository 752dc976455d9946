"""Look-ups over landed answers: variants, address fallback, one look-up for a group, guards.

Answers of a portal are tables here. A driver is a plan: it says for each record what was
found and what would be written; writing is the caller's decision.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.identifiers import DEFAULT_YEAR
from ..functions.owners import agency
from .merge import is_blank
from .ranking import best_per


def corroborated(records: DataFrame, by_name: DataFrame, by_address: DataFrame, *, variants: str, order: Sequence[Column], confirmed: Column) -> DataFrame:
    """For each record (lead_id, variants, address_key) the best row found, and how.

    Names are tried in the order of `variants`; the first that has a confirmed row counts
    (rows of by_name: name, pos and what order and confirmed speak of), with the best row by
    order, then pos. Records without any are looked up by address_key in by_address, where a
    row has to be confirmed too. Result: lead_id, how (name or address), pos and by_name's
    other columns. Records without a row are left out.
    """
    tried = records.select("*", F.posexplode(variants).alias("variant_pos", "name"))
    named = best_per(tried.join(by_name, "name").where(confirmed), ["lead_id"], F.col("variant_pos"), *order, F.col("pos"))
    left = records.join(named.select("lead_id"), "lead_id", "left_anti").where(~is_blank(F.col("address_key")))
    placed = best_per(left.join(by_address, "address_key").where(confirmed), ["lead_id"], *order, F.col("pos"))
    columns = [c for c in by_name.columns if c != "name"]
    return named.select("lead_id", F.lit("name").alias("how"), *columns).unionByName(placed.select("lead_id", F.lit("address").alias("how"), *columns))


def in_stages(records: DataFrame, key: str, stages: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """The matches (key, ...) of the first stage that has exactly one for a record, with the
    stage's name; records matched by an earlier stage are not looked for in a later one."""
    out = None
    left = records.select(key)
    for name, matches in stages:
        alone = Window.partitionBy(key)
        hit = matches.join(left, key, "left_semi").withColumn("__n", F.count("*").over(alone)).where("__n = 1").drop("__n").withColumn("stage", F.lit(name))
        left = left.join(hit.select(key), key, "left_anti")
        out = hit if out is None else out.unionByName(hit)
    return out


def once_per_group(records: DataFrame, found: DataFrame, group: str, *, prefer: Column, position: str) -> tuple[DataFrame, DataFrame]:
    """One representative of each filled group (prefer first, then position), and records with
    what was found for their group (found: group and fields) given to every member."""
    named = records.where(F.coalesce(F.trim(F.col(group).cast("string")) != "", F.lit(False)))
    asked = best_per(named, [group], prefer.desc(), F.col(position))
    return asked, records.join(found, group, "left")


def street_lookup(records: DataFrame, answers: DataFrame) -> DataFrame:
    """The answers (number, street, pos, ...) for the first of a record's streets that has any:
    records have id, number and streets, an array in the order of trial."""
    tried = records.select("id", "number", F.posexplode("streets").alias("try", "street"))
    hit = tried.join(answers, ["number", "street"])
    return hit.withColumn("__first", F.min("try").over(Window.partitionBy("id"))).where(F.col("try") == F.col("__first")).drop("__first")


def geocoded(leads: DataFrame, answers: DataFrame) -> DataFrame:
    """leads (uid) with lat and lon of answers (uid, match, lon_lat: "lon,lat"); only answers
    that say Match and hold two numbers count, of several for a uid the least text."""
    at = F.split("lon_lat", ",")
    good = answers.where(F.col("match") == "Match").select("uid", "lon_lat", F.get(at, F.lit(1)).try_cast("double").alias("lat"), F.get(at, F.lit(0)).try_cast("double").alias("lon"))
    best = good.where("lat is not null and lon is not null").groupBy("uid").agg(F.min_by(F.struct("lat", "lon"), "lon_lat").alias("a"))
    return leads.join(best.select("uid", "a.lat", "a.lon"), "uid", "left")


def accounts(records: DataFrame, pages: DataFrame, *, key: str = "doc_num", force: bool = False, year: str = DEFAULT_YEAR) -> DataFrame:
    """What a run over parcel pages would write: key, result, account (null unless matched).

    records have prop_id, year, owner_id and account; a blank year is `year`. pages (prop_id, year, owner_id,
    account) give the account that a page shows, "" where it shows none; of several pages of a
    parcel the greatest account counts. Results: no-prop-id, skipped-already (has an
    account; with force it is read anew), matched, no-account-on-page. Each record has one row.
    """
    bare = lambda c: F.trim(F.coalesce(F.col(c).cast("string"), F.lit("")))
    id_ = ["__prop", "__year", "__owner"]
    of = lambda df: df.withColumns({"__prop": bare("prop_id"), "__year": F.when(bare("year") == "", year).otherwise(bare("year")), "__owner": bare("owner_id")})
    shown = of(pages).where("__prop <> ''").groupBy(*id_).agg(F.max(bare("account")).alias("__account"))
    asked = of(records).withColumn("__state", F.when(F.col("__prop") == "", "no-prop-id").when((bare("account") != "") & F.lit(not force), "skipped-already"))
    # Records that are not asked for share a blank key; they do not meet the pages.
    open_ = asked.where("__state is null").join(shown, id_, "left")
    done = open_.select(key, F.when(F.coalesce("__account", F.lit("")) != "", "matched").otherwise("no-account-on-page").alias("result"), F.nullif("__account", F.lit("")).alias("account"))
    return done.unionByName(asked.where("__state is not null").select(key, F.col("__state").alias("result"), F.lit(None).cast("string").alias("account")))


def enrichment_plan(records: DataFrame, rows: DataFrame, *, key: str, done: Column, asked: Column, order: Sequence[Column], guard: Column, conflict: Column, fields: dict[str, str]) -> DataFrame:
    """What an enrichment run would do: key, result, and the values to add to blank fields.

    done marks records that need nothing, asked those that can be looked up at all. Of a
    record's rows that do not conflict the best by order counts if guard holds for it. fields
    maps a record's field to the row's column. Results: already, no_address, no_rows,
    conflict (all rows do), no_match (guard), matched.
    """
    state = records.withColumn("__state", F.when(done, "already").when(~F.coalesce(asked, F.lit(False)), "no_address"))
    open_ = state.where(F.col("__state").isNull()).drop("__state")
    both = open_.join(rows, key).withColumn("__conflict", F.coalesce(conflict, F.lit(False)))
    seen = both.groupBy(key).agg(F.min("__conflict").alias("__all"))
    best = best_per(both.where(~F.col("__conflict")), [key], *order).withColumn("__good", F.coalesce(guard, F.lit(False)))
    add = {f"new_{c}": F.when(F.col("__good") & is_blank(F.col(c)) & ~is_blank(F.col(v)), F.col(v)) for c, v in fields.items()}
    best = best.select(key, "__good", *[e.alias(n) for n, e in add.items()])
    out = state.select(key, "__state").join(seen, key, "left").join(best, key, "left")
    result = F.coalesce("__state", F.when(F.col("__all").isNull(), "no_rows").when(F.col("__all"), "conflict").when(F.col("__good"), "matched").otherwise("no_match"))
    return out.select(key, result.alias("result"), *add)


def lead_choice(cases: DataFrame, *, least_balance: float, only_missing: bool = True) -> DataFrame:
    """cases with reason: why a case is not looked up (no_data, agency, below_min, done), null if it is."""
    data = is_blank(F.col("new_owner")) | is_blank(F.col("legal"))
    reason = F.when(data, "no_data").when(agency("new_owner"), "agency")
    if least_balance:
        reason = reason.when(F.coalesce(F.col("balance"), F.lit(0.0)) < least_balance, "below_min")
    if only_missing:
        reason = reason.when(~is_blank(F.col("prop_id")) & ~is_blank(F.col("account")), "done")
    return cases.withColumn("reason", reason)


def evicted(records: DataFrame) -> DataFrame:
    """doc_num and owner of records with an owner and a legal description and no parcel."""
    bare = lambda c: F.trim(F.coalesce(F.col(c).cast("string"), F.lit("")))
    return records.where((bare("owner") != "") & (bare("prop_id") == "") & (bare("legal") != "")).select(bare("doc_num").alias("doc_num"), bare("owner").alias("owner"))


def expiry_plan(records: DataFrame, cache: DataFrame, version: int = 6) -> DataFrame:
    """What expiring the cache for evicted records would do: doc_num, owner, action (expire, old
    entry of another version, absent); of several entries of an owner the newest version counts."""
    held = cache.groupBy("owner").agg(F.max("version").alias("__version"))
    out = evicted(records).join(held, "owner", "left")
    return out.select("doc_num", "owner", F.when(F.col("__version").isNull(), "absent").when(F.col("__version") == version, "expire").otherwise("other_version").alias("action"))


def breaker(lookups: DataFrame, *, refresh: int = 12, abort: int = 15, group: str = "run") -> DataFrame:
    """lookups (run, pos, hit) with streak and what a run does there: go on, refresh its session
    after `refresh` misses in a row, abort after `abort` more; aborted tells rows after the abort.

    One window over a run; a run is as long as one session's look-ups.
    """
    w = Window.partitionBy(group).orderBy("pos")
    before = w.rowsBetween(Window.unboundedPreceding, 0)
    island = F.sum(F.col("hit").cast("int")).over(before)
    inside = Window.partitionBy(group, "__island").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    out = lookups.withColumn("__island", island).withColumn("streak", F.sum((~F.col("hit")).cast("int")).over(inside))
    out = out.withColumn("action", F.when(F.col("streak") == refresh, "refresh").when(F.col("streak") == refresh + abort, "abort").otherwise("go on"))
    stopped = F.max((F.col("action") == "abort").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, -1))
    return out.withColumn("aborted", F.coalesce(stopped, F.lit(0)) == 1).drop("__island")


def memoised(requests: DataFrame, answers: DataFrame, key: str) -> DataFrame:
    """Each distinct key is looked up once, failures included, and goes back to all requests:
    requests with answers' columns and found."""
    once = requests.select(key).distinct().join(answers.withColumn("found", F.lit(True)), key, "left")
    return requests.join(once.withColumn("found", F.coalesce("found", F.lit(False))), key, "left")
