"""A published list that lies in several places: the first copy that can be read counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.base import text

# The version of a look-up cache that may be touched.
CACHE_VERSION = "v6"


def copies(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """The files of paths that exist, whole, with the place of their path in the order: (rank, value)."""
    out = None
    for rank, path in enumerate(paths):
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        if at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at):
            one = spark.read.text(path, wholetext=True).select(F.lit(rank).alias("rank"), "value")
            out = one if out is None else out.unionByName(one)
    return out if out is not None else spark.createDataFrame([], "rank int, value string")


def _object(value: Column) -> Column:
    """The top level of a JSON object, nested values as JSON text; null for anything else."""
    return F.when(F.regexp_like(value, F.lit(r"^\s*\{")), F.from_json(value, "map<string,string>"))


def _list(value: Column) -> Column:
    return F.when(F.regexp_like(value, F.lit(r"^\s*\[")), F.from_json(value, "array<string>"))


def first_readable(files: DataFrame, *, by: Sequence[str] = (), records: str = "records", bare_list: bool = True) -> DataFrame:
    """(by, rank, envelope, records) of the first copy (by, rank, value) that can be read: an object
    with a list of records, or with bare_list a list alone, whose envelope is empty.

    envelope maps the object's other keys to their JSON text, records is an array of JSON texts. Which copy
    counts is decided from ranks alone; sources without any readable copy have no row.
    """
    by = list(by)
    value = text("value")
    whole, bare = _object(value), _list(value)
    held = F.from_json(whole[records], "array<string>")
    parsed = files.select(*by, "rank", F.when(held.isNotNull(), F.map_filter(whole, lambda k, v: k != records)).otherwise(F.when(bare.isNotNull(), F.create_map().cast("map<string,string>"))).alias("envelope"), F.coalesce(held, bare if bare_list else F.lit(None).cast("array<string>")).alias("records")).where("records is not null")
    best = parsed.groupBy(*by).agg(F.min("rank").alias("rank"))
    return parsed.join(best, [*by, "rank"], "left_semi")


def stored_again(envelope: Column, records: Column, *, fetched_at: Column, source: str) -> Column:
    """The JSON text of a list under its own envelope: fetched_at and total are renewed, source is set where
    it was missing, other keys stay as they were."""
    kept = F.map_filter(envelope, lambda k, v: ~k.isin("fetched_at", "total", "records"))
    kept = F.when(F.map_contains_key(kept, F.lit("source")), kept).otherwise(F.map_concat(kept, F.create_map(F.lit("source"), F.lit(source))))
    quoted = lambda v: F.when(F.regexp_like(v, F.lit(r'^(\{.*\}|\[.*\]|-?\d+(\.\d+)?([eE][+-]?\d+)?|true|false|null)$')), v).otherwise(F.to_json(F.array(v)).substr(F.lit(2), F.length(F.to_json(F.array(v))) - 2))
    pairs = F.transform(F.array_sort(F.map_entries(kept)), lambda e: F.concat(F.lit('"'), e["key"], F.lit('": '), quoted(e["value"])))
    rest = F.array(F.concat(F.lit('"fetched_at": "'), fetched_at, F.lit('"')), F.concat(F.lit('"total": '), F.size(records).cast("string")), F.concat(F.lit('"records": ['), F.array_join(records, ", "), F.lit("]")))
    return F.concat(F.lit("{"), F.array_join(F.concat(pairs, rest), ", "), F.lit("}"))


def cache_state(value: Column) -> Column:
    """Why a cache file may be touched or not: missing (null), unreadable, wrong_root_type,
    unsupported_version: X, malformed_data, or its version."""
    whole = _object(value)
    version, data = F.try_element_at(whole, F.lit("_version")), F.try_element_at(whole, F.lit("data"))
    broken = ~F.coalesce(F.regexp_like(value, F.lit(r"^\s*[\{\[\"\d\-tfn]")), F.lit(False)) | F.get_json_object(value, "$").isNull()
    return (
        F.when(value.isNull(), "missing").when(broken, "unreadable").when(whole.isNull(), "wrong_root_type")
        .when(~F.coalesce(version == CACHE_VERSION, F.lit(False)), F.concat(F.lit("unsupported_version: "), F.coalesce(version, F.lit("None"))))
        .when(data.isNotNull() & (data != "") & ~data.isin("0", "false", "[]", "{}") & ~F.regexp_like(data, F.lit(r"^\s*\{")), "malformed_data").otherwise(CACHE_VERSION)
    )
