"""Near-duplicate vectors by p-stable hashing, within equal labels.

Normalised vectors are projected on random Gaussian directions; the quantised values of
a few directions together are a bucket, and there are many tables of buckets. Vectors at
a cosine of 0.98 are 0.2 apart and share a bucket of one table or another with a
probability of 0.9995 (see `tables_for`). Buckets of the same members are one, so that
near copies, which share most of their tables, move once. Vectors that share a bucket are
compared exactly, in double precision, by blocks of bounded size: no pair is ever a row.
What leaves a block is a count for each vector and a star for each linked set. Equal
vectors of a label are one from the start.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_groups, spread_join, written
from .components import components

DIRECTIONS = 12  # in a bucket
WIDTH = 1.6  # of a quantised step
RECALL = 0.9995  # of pairs right at the threshold
CHUNK = 512
#: Pairs of which the tables are compared at once.
PAIRS = 200_000


def agreement(distance: float, width: float = WIDTH) -> float:
    """How likely one quantised projection is the same for two points so far apart."""
    r = width / distance
    return math.erf(r / math.sqrt(2)) - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))


def tables_for(threshold: float, recall: float = RECALL, directions: int = DIRECTIONS, width: float = WIDTH) -> int:
    """The number of tables at which a pair with cosine = threshold is found so surely."""
    p = agreement(math.sqrt(max(1e-12, 2 - 2 * threshold)), width) ** directions
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - p)))


def buckets_of(vectors: np.ndarray, tables: int, directions: int = DIRECTIONS, width: float = WIDTH) -> np.ndarray:
    """A 64-bit bucket for each normalised vector and table."""
    rng = np.random.default_rng([vectors.shape[1], tables])
    plane = rng.standard_normal((vectors.shape[1], tables * directions))
    shift = rng.random(tables * directions) * width
    steps = np.floor((vectors @ plane + shift) / width).astype(np.int64).reshape(len(vectors), tables, directions)
    key = np.zeros((len(vectors), tables), np.uint64)
    for i in range(directions):
        key = (key ^ steps[:, :, i].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(29)
    return key.view(np.int64)


def _hashed(tables: int):  # noqa: ANN202
    """(rep, h, copies, label_a, label_b, vector) to the same with the normalised vector as
    bytes and its bucket in each table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch["vector"]
            sizes = np.diff(lists.offsets.to_numpy())
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            starts = np.concatenate(([0], np.cumsum(sizes)))
            keys = np.zeros((len(sizes), tables), np.int64)
            units: list[bytes] = [b""] * len(sizes)
            for size in np.unique(sizes):
                at = np.flatnonzero(sizes == size)
                x = flat[starts[at][:, None] + np.arange(size)]
                x = x / np.abs(x).max(axis=1, keepdims=True)
                x = x / np.linalg.norm(x, axis=1, keepdims=True)
                keys[at] = buckets_of(x, tables)
                for k, row in zip(at.tolist(), x):
                    units[k] = row.tobytes()
            column = pa.ListArray.from_arrays(pa.array(np.arange(len(keys) + 1) * tables, pa.int32()), pa.array(keys.reshape(-1)))
            names = ["rep", "h", "copies", "label_a", "label_b"]
            yield pa.RecordBatch.from_arrays([*(batch[n] for n in names), pa.array(units, pa.binary()), column], names=[*names, "unit", "keys"])

    return run


def _rooted(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The least of the n nodes that links (i, j) lead to from each node."""
    least = np.arange(n)
    while True:
        low = np.minimum(least[i], least[j])
        new = least.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if (new == least).all():
            return least
        least = new


def _compare(threshold: float):  # noqa: ANN202
    def run(table: pa.Table, bounds: np.ndarray) -> pa.Table:
        rep, h, copies, nth, side, label = (table[c].to_numpy() for c in ("rep", "h", "copies", "nth", "side", "label_b"))
        one_chunk = table["one_chunk"].to_numpy(zero_copy_only=False)
        units = table["unit"].to_pylist()
        keys = table["keys"].combine_chunks()
        keys = keys.flatten().to_numpy().reshape(len(rep), -1)
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for first, last in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            sizes = np.fromiter(map(len, units[first:last]), np.int64, last - first)
            for size in np.unique(sizes):
                at = first + np.flatnonzero(sizes == size)
                m = np.frombuffer(b"".join([units[k] for k in at.tolist()])).reshape(len(at), -1)
                if one_chunk[first]:
                    left = right = at
                    close = np.triu(m @ m.T >= threshold, 1)
                else:
                    left, right = at[side[at] == 0], at[side[at] != 0]
                    close = m[side[at] == 0] @ m[side[at] != 0].T >= threshold
                close &= label[left][:, None] == label[right]
                i, j = np.nonzero(close)
                if not len(i):
                    continue
                i, j = left[i], right[j]
                root = _rooted(last - first, i - first, j - first)
                fresh = np.ones(len(i), bool)
                if nth[first]:  # a pair counts in the first table that it shares
                    for k in range(0, len(i), PAIRS):
                        p, q = i[k : k + PAIRS], j[k : k + PAIRS]
                        fresh[k : k + PAIRS] = ~(keys[p, : nth[first]] == keys[q, : nth[first]]).any(axis=1)
                i, j = i[fresh] - first, j[fresh] - first
                n = np.bincount(i, copies[first + j], last - first) + np.bincount(j, copies[first + i], last - first)
                linked = np.flatnonzero((n > 0) | (root != np.arange(last - first)))
                out.append((first + linked, n[linked].astype(np.int64), first + root[linked]))
        at, n, root = (np.concatenate(x) for x in zip(*out)) if out else (np.empty(0, np.int64),) * 3
        return pa.table({"rep": pa.array(rep[at], pa.int64()), "h": pa.array(h[at], pa.int64()), "n": pa.array(n, pa.int64()), "root_rep": pa.array(rep[root], pa.int64()), "root_h": pa.array(h[root], pa.int64())})

    return run


def near_vectors(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", threshold: float = 0.98, recall: float = RECALL) -> DataFrame:
    """One row (id, n_links, component_id, kept) for each row of vectors.

    Two vectors of the same length and the same label (not null) link if their cosine is at
    least threshold (a tie links). n_links counts the other rows linked directly,
    component_id is the least id that links lead to, itself included, kept marks the row with
    that id. Vectors that are null, empty or zero, that hold nulls, NaN or infinite
    components, or whose label or id is null link with nothing. Rows with the same id are
    different vectors, each with links of its own. An empty table gives no rows. Other
    columns play no part, whatever their names.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"), F.col(label_col).alias("label"))
    fine = F.col("id").isNotNull() & F.col("label").isNotNull() & F.exists("vector", lambda v: v != 0) & F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    good = rows.where(F.coalesce(fine, F.lit(False))).select("id", "label", F.transform("vector", lambda v: v + F.lit(0.0)).alias("vector"))
    tables = tables_for(threshold, recall)
    # A class is the equal vectors of a label. Its node (least id, hash) is its own even where ids repeat.
    good = good.withColumn("h", F.xxhash64("label", "vector"))
    classes = good.groupBy("label", "vector", "h").agg(F.min("id").alias("rep"), F.count("*").alias("copies"))
    classes = classes.select("rep", "h", "copies", F.xxhash64("label").alias("label_a"), F.xxhash64(F.lit(1), "label").alias("label_b"), "vector")
    classes = written(classes.mapInArrow(_hashed(tables), "rep long, h long, copies long, label_a long, label_b long, unit binary, keys array<long>"), "vectors")

    held = classes.select("rep", "h", F.posexplode("keys").alias("nth", "bucket"), "label_a").select("rep", "h", "nth", F.xxhash64("label_a", "bucket").alias("bucket"))
    full = held.groupBy("nth", "bucket").agg(F.count("*").alias("size"), F.bit_xor(F.xxhash64("rep", "h")).alias("f"), F.bit_xor(F.xxhash64(F.lit(7), "rep", "h")).alias("g")).where("size > 1")
    full = full.groupBy("size", "f", "g").agg(F.min(F.struct("nth", "bucket")).alias("b")).select("b.nth", "b.bucket", "size")
    inside = spread_join(held, full, ["nth", "bucket"], "rep")
    chunks = F.ceil(F.col("size") / CHUNK).cast("int")
    inside = inside.select("nth", "bucket", "rep", "h", chunks.alias("m"), F.pmod(F.xxhash64("rep", "h"), chunks).cast("int").alias("mine"))
    inside = inside.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("m") - 1)))
    dealt = inside.select("nth", "bucket", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), (F.col("mine") > F.col("other")).cast("int").alias("side"), (F.col("mine") == F.col("other")).alias("one_chunk"), "rep", "h")
    dealt = dealt.withColumn("group", F.xxhash64("nth", "bucket", "i", "j")).join(classes.select("rep", "h", "copies", "label_b", "unit", "keys"), ["rep", "h"])
    found = written(by_groups(dealt.select("group", "nth", "side", "one_chunk", "rep", "h", "copies", "label_b", "unit", "keys"), ["group"], _compare(threshold), "rep long, h long, n long, root_rep long, root_h long"), "near")

    node = F.struct("rep", "h")
    linked = found.groupBy("rep", "h").agg(F.sum("n").alias("n"))
    comps = components(found.select(F.struct(F.col("root_rep").alias("rep"), F.col("root_h").alias("h")).alias("a"), node.alias("b")))
    comps = comps.select("id.rep", "id.h", F.col("component.rep").alias("c"))
    per_class = classes.select("rep", "h", "copies").join(linked, ["rep", "h"], "left").join(comps, ["rep", "h"], "left")
    per_class = per_class.select("rep", "h", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n"), F.coalesce("c", "rep").alias("c"))
    # Rows find their class by two hashes of label and vector; their least id and a hash stand for it.
    # A vector may have any number of copies: its rows are dealt over tasks, and meet hashes instead of vectors.
    told = good.select("id", "h", F.xxhash64(F.lit(1), "label", "vector").alias("g"))
    of_row = spread_join(told, told.groupBy("h", "g").agg(F.min("id").alias("rep")), ["h", "g"], "id")
    of_row = spread_join(of_row, per_class, ["rep", "h"], "id").select("id", "n", "c")
    alone = rows.where(~F.coalesce(fine, F.lit(False))).select("id", F.lit(0).cast("long").alias("n"), F.col("id").alias("c"))
    return of_row.unionByName(alone).select(F.col("id").alias(id_col), F.col("n").alias("n_links"), F.col("c").alias("component_id"), F.coalesce(F.col("id") == F.col("c"), F.lit(True)).alias("kept"))
