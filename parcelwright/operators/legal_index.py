"""An inverted index of parsed legal descriptions: legals_match as an equality of keys.

Two legals can be of one parcel if they share a word of the subdivision's name, do not name
different lots only, and do not name different blocks (`functions.legal.legals_match`, without
its exception for equal addresses). A stored legal therefore gets a key for each of its words,
lots and its block, with ANY beside each of them; one that is asked for names its own lots and
block, "" for parcels that name none, or ANY where it names none itself. They match if and only if
a key is the same, so a match is an equi-join, and a key that many parcels share is one
row of the index where only the first of them is wanted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.addresses import split_address
from ..functions.base import C, blank, col, first_filled, squeeze, text
from ..functions.legal import lot_set, name_words, parse_legal
from ..functions.notices import primary_name, secondary_name

#: Stands for every lot, or every block.
ANY = "*"
# Where a parcel lies whose page names no city.
CITY, STATE = "CORPUS CHRISTI", "TX"


def _keys(parsed: C, lots: Column, blocks: Column) -> Column:
    words = name_words(col(parsed)["subdivision"])
    each = lambda w: F.flatten(F.transform(lots, lambda lot: F.transform(blocks, lambda b: F.concat_ws("\x1f", w, lot, b))))
    return F.array_distinct(F.flatten(F.transform(words, each)))


def stored_keys(parsed: C) -> Column:
    """The keys under which a parsed legal is found; none if it names no subdivision."""
    p = col(parsed)
    lots, any_ = lot_set(p["lot"]), F.array(F.lit(ANY))
    none = F.array(F.lit(""), F.lit(ANY))
    return _keys(p, F.when(F.size(lots) > 0, F.concat(lots, any_)).otherwise(none), F.when(p["block"] != "", F.array(p["block"], F.lit(ANY))).otherwise(none))


def asked_keys(parsed: C) -> Column:
    """The keys under which a parsed legal's partners are found."""
    p = col(parsed)
    lots, any_ = lot_set(p["lot"]), F.array(F.lit(ANY))
    return _keys(p, F.when(F.size(lots) > 0, F.concat(lots, F.array(F.lit("")))).otherwise(any_), F.when(p["block"] != "", F.array(p["block"], F.lit(""))).otherwise(any_))


def borrower_names(raw: C) -> Column:
    """The names under which a borrower may be found: the line as it is, the first person, the second."""
    names = F.array(squeeze(raw), primary_name(raw), secondary_name(raw))
    return F.array_distinct(F.filter(F.transform(names, squeeze), lambda n: n != ""))


def without_address(records: DataFrame) -> DataFrame:
    """Records that can be looked up by their legal: no address, an owner, a subdivision or a lot."""
    return records.where(blank("prop_address") & ~blank("owner") & (~blank("legal_subdivision") | ~blank("legal_lot")))


def told_legal(lot: C, block: C, subdivision: C) -> Column:
    """What a document says of a lot as a parsed legal. Lot and block must both be told: the label after
    an empty one would be read as its value, which no parcel has, so that half a legal matches nothing."""
    said = F.concat(F.lit("Lot: "), text(lot), F.lit(" Block: "), text(block), F.lit(" Subdivision- Name: "), text(subdivision))
    return parse_legal(said)


def cross_referenced(records: DataFrame, parcels: DataFrame, *, key: str = "doc_num") -> DataFrame:
    """The parcel of each record that `without_address` takes, by name and legal: key, stage, pos,
    name, legal, situs in its parts, appraised_value.

    records have owner, prop_address, legal_lot, legal_block, legal_subdivision; parcels are what a
    search by name gives (name, pos, legal, situs, appraised_value; pos orders a name's rows).
    First ("name") the borrower's names are tried in order, and in each the first parcel whose legal matches
    counts; records without any that name a subdivision and a lot are looked for under the subdivision's name
    ("subdivision"), by the same strict test. No weaker match counts. Repeated records of a key
    get one answer; records without a match, or a parcel without a street, have no row.

    All sides are sorted and merged: what a compressed table's size says of them is far too small, and by it
    whole parcels would be broadcast through the driver.
    """
    stored = parcels.select(F.upper(squeeze("name")).alias("name"), "pos", F.explode(stored_keys(parse_legal("legal"))).alias("legal_key"))
    index = stored.groupBy("name", "legal_key").agg(F.min("pos").alias("pos"))
    asked = without_address(records).select(key, F.col("owner").alias("__owner"), "legal_lot", "legal_subdivision", told_legal("legal_lot", "legal_block", "legal_subdivision").alias("__p"))

    def found(rows: DataFrame, stage: str) -> DataFrame:
        hit = rows.withColumn("legal_key", F.explode(asked_keys("__p"))).withColumn("name", F.upper("name")).join(index.hint("merge"), ["name", "legal_key"])
        first = hit.groupBy(key).agg(F.min(F.struct("variant", "pos", "name")).alias("f"))
        return first.select(key, F.lit(stage).alias("stage"), "f.pos", "f.name")

    named = found(asked.select(key, "__p", F.posexplode(borrower_names("__owner")).alias("variant", "name")), "name")
    left = asked.join(named.select(key).hint("merge"), key, "left_anti").where(~blank("legal_subdivision") & ~blank("legal_lot"))
    placed = found(left.select(key, "__p", F.lit(0).alias("variant"), squeeze("legal_subdivision").alias("name")), "subdivision")
    site = split_address("situs")
    rows = parcels.select(F.upper(squeeze("name")).alias("name"), "pos", "legal", site.alias("s"), "appraised_value").where(F.col("s.street") != "")
    out = named.unionByName(placed).join(rows.hint("merge"), ["name", "pos"])
    return out.select(
        key, "stage", "name", "pos", "legal", F.col("s.street").alias("prop_address"), first_filled("s.city", F.lit(CITY)).alias("prop_city"),
        first_filled("s.state", F.lit(STATE)).alias("prop_state"), F.col("s.zip").alias("prop_zip"), "appraised_value",
    )


def _classed(parcels: DataFrame, key: str, within: str, legal: str) -> tuple[DataFrame, DataFrame]:
    """Parcels (key, within, __same), of which those with equal texts __same read alike, and their classes
    (within, __same, class_id, __n, __p): the least key, the number of parcels, and the parsed legal of one of them."""
    p = parcels.select(key, within, parse_legal(legal).alias("__p"))
    same = [F.array_join(F.array_sort(name_words("__p.subdivision")), " "), F.array_join(F.array_sort(F.array_distinct(lot_set("__p.lot"))), " "), F.col("__p.block")]
    p = p.select(key, within, "__p", F.concat_ws("\x1f", *same).alias("__same"))
    classes = p.groupBy(within, "__same").agg(F.min(key).alias("class_id"), F.count("*").alias("__n"), F.min_by("__p", key).alias("__p"))
    return p.select(key, within, "__same"), classes


def _linked(classes: DataFrame, within: str) -> DataFrame:
    """Classes that match, each with itself too, both ways: __asker and its __m parcels, class_id and its __n."""
    stored = classes.select(within, "class_id", "__n", F.explode(stored_keys("__p")).alias("legal_key"))
    asked = classes.select(within, F.col("class_id").alias("__asker"), F.col("__n").alias("__m"), F.explode(asked_keys("__p")).alias("legal_key"))
    return asked.join(stored, [within, "legal_key"]).select("__asker", "__m", "class_id", "__n").distinct()


def legal_classes(parcels: DataFrame, *, key: str, within: str, legal: str = "legal") -> DataFrame:
    """One row (key, class_id, n_links) for each parcel: the least key of those of the same `within` whose
    legals read alike, and how many other parcels of that `within` may be the same one by `legals_match`.

    Parcels that read alike are one class, and only classes are compared, each pair once for its
    keys in common. A legal without a subdivision links with nothing. Keys are unique.
    """
    p, classes = _classed(parcels, key, within, legal)
    links = _linked(classes, within).groupBy(F.col("__asker").alias("class_id")).agg((F.sum("__n") - 1).alias("n_links"))
    of = p.join(classes.select(within, "__same", "class_id"), [within, "__same"])
    return of.join(links, "class_id", "left").select(key, "class_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


#: Parcels of a class that are held at once, next to as many of another.
CHUNK = 1_024


def legal_pairs(parcels: DataFrame, *, key: str, within: str, legal: str = "legal", chunk: int = CHUNK) -> DataFrame:
    """All pairs (a, b) of parcels of the same `within`, a < b, that may be one parcel by `legals_match`. Keys are unique.

    Only classes are compared, as in `legal_classes`; every pair of them is then written out in full. A class's
    parcels are dealt into chunks, and each pair of chunks is a row of its own, so a task holds two chunks at a time
    whatever the size of a class, and a large class is written by many tasks.
    """
    p, classes = _classed(parcels, key, within, legal)
    chunks = lambda n: F.ceil(F.col(n) / chunk)
    members = p.join(classes.select(within, "__same", "class_id", "__n").hint("merge"), [within, "__same"])
    dealt = members.groupBy("class_id", F.pmod(F.xxhash64(key), chunks("__n")).alias("__c")).agg(F.collect_list(key).alias("keys"))
    # A match goes both ways: each pair of classes is taken once, and each pair of one class's own chunks.
    linked = _linked(classes, within).where(F.col("__asker") <= F.col("class_id")).withColumn("__own", F.col("__asker") == F.col("class_id"))
    each = linked.withColumn("__i", F.explode(F.sequence(F.lit(0), chunks("__m") - 1)))
    each = each.withColumn("__j", F.explode(F.sequence(F.when(F.col("__own"), F.col("__i")).otherwise(0), chunks("__n") - 1)))
    side = lambda of, c, keys: dealt.select(F.col("class_id").alias(of), F.col("__c").alias(c), F.col("keys").alias(keys)).hint("merge")
    both = each.join(side("__asker", "__i", "__a"), ["__asker", "__i"]).join(side("class_id", "__j", "__b"), ["class_id", "__j"])
    once = F.col("__own") & (F.col("__i") == F.col("__j"))
    pairs = both.select(once.alias("__once"), F.explode("__a").alias("x"), "__b").select("__once", "x", F.explode("__b").alias("y"))
    return pairs.where((F.col("x") < F.col("y")) | (~F.col("__once") & (F.col("x") > F.col("y")))).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
