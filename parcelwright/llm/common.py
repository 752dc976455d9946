"""Helpers that the corpus operators share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, which the driver and all executors see.

    Only where it is unset and everything runs in one process (tests) a temporary
    folder is set in its place.
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not path:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="parcelwright-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """df written once to the shared folder and read again: later reads survive a lost
    executor, and what is not deterministic (block numbers) is fixed by the write."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def held_out(doc_id: Column) -> Column:
    """Whether the row is kept from training: crc32 of the id as text is a multiple of 5."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def without(df: DataFrame, *names: str) -> DataFrame:
    """df less the columns that an operator is about to add, in any spelling that Spark
    would take for the same name."""
    taken = {n.lower() for n in names}
    return df.drop(*[c for c in df.columns if c.lower() in taken])


#: Over how many tasks a key's rows are spread in `spread_join`.
SPREAD = 8


def spread_join(many: DataFrame, few: DataFrame, keys: list[str], by: str, how: str = "inner", spread: int = SPREAD) -> DataFrame:
    """many joined with few on keys, where a key may have any number of rows in many and
    has one in few: the rows of a key are dealt out by `by`, and few is repeated for that."""
    salt = "__salt"
    many = many.withColumn(salt, F.pmod(F.xxhash64(F.lit(5), by), F.lit(spread)).cast("int"))
    few = few.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(spread - 1))))
    return many.join(few, [*keys, salt], how).drop(salt)


def thinned(rows: DataFrame, n: int, most: int, key: Column) -> DataFrame:
    """rows (n of them) less those that a hash of key rules out, such that somewhat more than
    `most` stay; what gathers `most` of them then has little to gather, whatever n is."""
    share = (1.2 * most + 1000) / max(1, n)
    return rows if share >= 1 else rows.where(F.pmod(F.xxhash64(F.lit(11), key), F.lit(1_000_003)) < int(share * 1_000_003) + 1)


#: ASCII bytes that are neither digits nor letters end a word.
_BREAKS = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def plain_words(text: str) -> list[bytes]:
    """Words of a text in lower case, without ASCII punctuation."""
    return text.lower().encode().translate(_BREAKS).split()


def by_groups(rows: DataFrame, keys: list[str], work: Callable[[pa.Table, np.ndarray], pa.Table], schema: str) -> DataFrame:
    """rows dealt out by keys to work, which gets the rows of many small groups at once: a
    table and the bounds of the groups in it. Groups must be of bounded size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if batch.num_rows:
                g = batch.column(batch.num_columns - 1).to_numpy()
                ends = np.flatnonzero(g[1:] != g[:-1]) + 1
                cut = int(ends[-1]) if len(ends) else 0
                if held and g[0] != held[-1].column(held[-1].num_columns - 1)[-1].as_py():
                    yield from done(held)
                    held = []
                if cut:
                    yield from done([*held, batch.slice(0, cut)])
                    held = []
                held.append(batch.slice(cut))
        if held:
            yield from done(held)

    def done(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(held).combine_chunks()
        g = table.column(table.num_columns - 1).to_numpy()
        bounds = np.concatenate(([0], np.flatnonzero(g[1:] != g[:-1]) + 1, [len(g)]))
        yield from work(table, bounds).combine_chunks().to_batches()

    dealt = rows.withColumn("__g", F.xxhash64(*keys)).repartition(F.col("__g")).sortWithinPartitions("__g")
    return dealt.mapInArrow(run, schema)
