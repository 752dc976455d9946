"""Intervals of two tables that overlap under a key, told apart by their relation.

Bounds are whole slots, both inclusive; a null end is open (infinite). Time is cut into blocks
of slots. An interval of the left side visits the block it starts in and the block it ends in; there
an IEJoin (start order, end order, the permutation between both, offsets into both, and one bitmap a
visit, scanned) enumerates the right intervals that it overlaps. All that lie in other blocks
relate to it alike, so they come as sums over the blocks before, between and after: an interval
without an end costs as much as a short one, and no pair is ever moved. A block's visits and
intervals are dealt out over salts, and sums over blocks are windows over one row a block.

Sessions are built alike: clicks of one stretch of `gap` microseconds are one fragment without
looking at any order (a map-side aggregate), and fragments join by levels of LEVEL stretches, so
that no group holds more than 2 * LEVEL rows, however many clicks a key has.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import spread_join, written

#: Slots of a block. A client's sessions lie over ten minutes apart, so that at most 1,009 of them
#: start in a block of hours.
BLOCK = 168
#: Visits, and right intervals, of a key and block that one task takes.
SALT_ROWS = 4_096
#: Stretches, or stretches of stretches, that one level of `sessions` joins.
LEVEL = 1_024
#: Microseconds from 1970 to the first and to the last timestamp of Spark.
FIRST_US, LAST_US = -62_135_596_800_000_000, 253_402_300_799_999_999
#: Relation of a left interval, by 3 * (start earlier, equal, later) + (end earlier, equal, later).
RELATIONS = ("overlaps", "finished_by", "contains", "starts", "equals", "started_by", "during", "finishes", "overlapped_by")
OVERLAPS, FINISHED_BY, CONTAINS, DURING, FINISHES = 0, 1, 2, 6, 7
BOTH_OPEN = (1, 4, 7)
#: A missing end, as a number.
OPEN = 1 << 61
#: Candidates that are tested at once.
CHUNK = 4_000_000


def micros(df: DataFrame, name: str) -> Column:
    """Microseconds since 1970 UTC of a timestamp; one without a zone is taken as UTC,
    whatever the session's zone."""
    if dict(df.dtypes)[name] == "timestamp_ntz":
        since = F.expr(f"cast(cast(`{name}` - timestamp_ntz'1970-01-01' as interval second) as decimal(20, 6))")
        return (since * 1_000_000).cast("long")
    return F.unix_micros(F.col(name).cast("timestamp"))


def floored(value: Column, size: int) -> Column:
    """value / size, rounded down, in whole numbers."""
    return F.call_function("div", value - F.pmod(value, F.lit(size)), F.lit(size))


def sessions(clicks: DataFrame, gap_us: int) -> DataFrame:
    """Rows (key, first, last, flag): a key's clicks (key, us, flag) with no more than gap_us between
    neighbours are one session; flag says whether a click at its last us has the flag.

    Rows with a null key or us are ignored, repeated rows change nothing, a null flag is false; an
    empty table gives none.
    """
    stretch = lambda c: floored(F.col(c) - FIRST_US, gap_us)
    rows = clicks.where("key is not null and us is not null").withColumn("flag", F.coalesce("flag", F.lit(False)))
    # Within one stretch neighbours are never more than the gap apart.
    pieces = rows.groupBy("key", stretch("us").alias("at")).agg(F.min("us").alias("first"), F.max(F.struct("us", "flag")).alias("end"))
    pieces = pieces.select("key", "first", F.col("end.us").alias("last"), F.col("end.flag").alias("flag"))
    width, stretches = LEVEL, (LAST_US - FIRST_US) // gap_us + 1
    pieces, done = written(_joined(pieces, stretch, width, gap_us), "sessions"), []
    while width < stretches:
        # Only what touches the edge of its group can go on in the next one.
        edge = (stretch("first") % width == 0) | (stretch("last") % width == width - 1)
        done.append(pieces.where(~edge))
        pieces, width = _joined(pieces.where(edge), stretch, width * LEVEL, gap_us), width * LEVEL
    for other in done:
        pieces = pieces.unionByName(other)
    return pieces


def _joined(pieces: DataFrame, stretch, width: int, gap_us: int) -> DataFrame:  # noqa: ANN001
    group = Window.partitionBy("key", "group").orderBy("first")
    new = F.coalesce((F.col("first") - F.lag("last").over(group) > gap_us).cast("int"), F.lit(1))
    rows = pieces.withColumn("group", floored(stretch("first"), width)).withColumn("new", new)
    rows = rows.withColumn("n", F.sum("new").over(group))
    out = rows.groupBy("key", "group", "n").agg(F.min("first").alias("first"), F.max(F.struct("last", "flag")).alias("end"))
    return out.select("key", "first", F.col("end.last").alias("last"), F.col("end.flag").alias("flag"))


def overlaps(left: DataFrame, right: DataFrame, *, block: int = BLOCK, salt_rows: int = SALT_ROWS) -> DataFrame:
    """Rows (id, relation, n_pairs, overlap, weight) for left (id, key, start, end) and right (key,
    start, end, weight): how many right intervals of the same key share a slot with the left one
    in this relation, the slots shared in all (null where both of a pair are open), the sum of weights.

    Bounds are longs, a null end is open. Rows with a null key or start, or that end before they
    start, pair with nothing; rows of an id, null too, are summed. A relation without pairs has no
    row; other columns play no part. A right interval costs one row for each block that it spans.
    """
    left, right = _usable(left, "id", "key", "start", "end"), _usable(right, "key", "start", "end", "weight")
    b0, b1 = floored(F.col("start"), block), floored(F.col("end"), block)
    # Equal intervals are one row with its count.
    right = right.groupBy("key", "start", "end").agg(F.coalesce(F.sum(F.col("weight").cast("long")), F.lit(0)).alias("weight"), F.count("*").alias("n"))
    ends = F.array(F.struct(b0.alias("block"), F.lit(True).alias("first")))
    more = F.array(F.struct(b1.alias("block"), F.lit(False).alias("first")))
    # Visits of both ends; the second one needs to know where the first one's block ends.
    visits = left.withColumn("v", F.explode(F.when(F.col("end").isNull() | (b0 == b1), ends).otherwise(F.concat(ends, more))))
    visits = written(visits.select("id", "key", "start", "end", "v.block", "v.first"), "visits")
    right = written(right.withColumn("block", b0), "intervals")

    is_open = F.col("end").isNull()
    length = F.col("end") - F.col("start") + 1
    total = lambda c, when: F.coalesce(F.sum(F.when(when, c)), F.lit(0))
    n, weight = F.col("n"), F.col("weight")
    sums = {"open_n": total(n, is_open), "open_w": total(weight, is_open), "open_s": total(n * F.col("start"), is_open), "closed_n": total(n, ~is_open), "closed_l": total(n * length, ~is_open), "closed_w": total(weight, ~is_open)}
    of_right = right.groupBy("key", "block").agg(F.lit(0).cast("long").alias("asked"), *[c.cast("long").alias(n) for n, c in sums.items()])
    of_left = visits.groupBy("key", "block").agg(F.count("*").alias("asked"))
    both = of_left.unionByName(of_right, allowMissingColumns=True).groupBy("key", "block").agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in ("asked", *sums)])
    # Per key one row a block: sums of the blocks before, and of all.
    by_key = Window.partitionBy("key")
    before = by_key.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    prefix = [F.coalesce(F.sum(n).over(before), F.lit(0)).alias(n) for n in sums]
    whole = [F.sum(n).over(by_key).alias(f"all_{n}") for n in ("closed_n", "closed_l", "closed_w", "open_n", "open_w")]
    at = both.select("key", "block", "asked", *prefix, *whole).where("asked > 0")

    # Closed intervals stand in each block that they span, open ones where they start.
    spans = F.when(is_open, F.array("block")).otherwise(F.sequence("block", F.coalesce(b1, "block")))
    pieces = right.withColumn("block", F.explode(spans))
    held = pieces.groupBy("key", "block").agg(F.count("*").alias("n_right"))
    salts = lambda n: F.ceil(F.col(n) / salt_rows).cast("int")
    at = at.join(held, ["key", "block"], "left").withColumn("ls", salts("asked")).withColumn("rs", F.coalesce(salts("n_right"), F.lit(1)))
    at = written(at.drop("asked", "n_right"), "blocks")

    # Salts of crowded blocks only, so that this side of the join is small and has no hot key.
    crowded = at.where("ls > 1 or rs > 1").select("key", "block", "ls", "rs").hint("merge")
    visits = spread_join(visits.withColumn("by", F.xxhash64("id", "start", "end")), crowded, ["key", "block"], "by", "left")
    pieces = spread_join(pieces.withColumn("by", F.xxhash64("start", "end")), crowded, ["key", "block"], "by", "left")
    one = lambda c: F.coalesce(F.col(c), F.lit(1))
    range_of = lambda n: F.sequence(F.lit(0), n - 1)
    mine = lambda c: F.pmod(F.col("by"), one(c)).cast("int")
    number = lambda c: F.coalesce(F.col(c), F.lit(OPEN))
    none = F.lit(None).cast(dict(left.dtypes)["id"])
    keys = ["key", "block", "lsalt", "rsalt", "kind"]
    sent = at.withColumn("lsalt", F.explode(range_of(F.col("ls")))).select("key", "block", "lsalt", F.lit(0).alias("rsalt"), F.lit(0).alias("kind"), none.alias("id"), F.array(*sums, *[f"all_{n}" for n in ("closed_n", "closed_l", "closed_w", "open_n", "open_w")]).alias("v"))
    sent = sent.unionByName(pieces.withColumn("rsalt", mine("rs")).withColumn("lsalt", F.explode(range_of(one("ls")))).select("key", "block", "lsalt", "rsalt", F.lit(1).alias("kind"), none.alias("id"), F.array("start", number("end"), "weight", "n").alias("v")))
    sent = sent.unionByName(visits.withColumn("lsalt", mine("ls")).withColumn("rsalt", F.explode(range_of(one("rs")))).select("key", "block", "lsalt", "rsalt", F.lit(2).alias("kind"), "id", F.array("start", number("end"), F.col("first").cast("long")).alias("v")))
    dealt = sent.repartition(*keys[:4]).sortWithinPartitions(*keys)
    found = dealt.mapInArrow(_by_block(block), f"id {dict(left.dtypes)['id']}, code int, n long, overlap long, weight long")
    found = found.groupBy("id", "code").agg(F.sum("n").alias("n_pairs"), F.sum("overlap").alias("overlap"), F.sum("weight").alias("weight"), F.max(F.col("overlap").isNull()).alias("endless")).where("n_pairs > 0")
    names = F.array(*[F.lit(r) for r in RELATIONS])
    return found.select("id", F.element_at(names, F.col("code") + 1).alias("relation"), "n_pairs", F.when(~F.col("endless"), F.col("overlap")).alias("overlap"), "weight")


def _usable(df: DataFrame, *names: str) -> DataFrame:
    return df.select(*names).where("key is not null and start is not null and (end is null or end >= start)")


def _by_block(block: int):  # noqa: ANN202
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.concat_tables([*held, pa.Table.from_batches([batch])]).combine_chunks()
            cut = int(np.flatnonzero(_changes(rows))[-1])
            if cut:  # what comes before the last group is whole
                yield from _enumerated(rows.slice(0, cut), block)
            held = [rows.slice(cut)]
        for rows in held:
            yield from _enumerated(rows, block)

    return run


def _changes(rows: pa.Table) -> np.ndarray:
    """Whether a row begins another group of (key, block, lsalt, rsalt)."""
    out = np.zeros(rows.num_rows, bool)
    out[0] = True
    for name in ("key", "block", "lsalt", "rsalt"):
        c = rows.column(name)
        out[1:] |= pc.not_equal(c.slice(1), c.slice(0, rows.num_rows - 1)).to_numpy()
    return out


def _enumerated(rows: pa.Table, block: int) -> Iterator[pa.RecordBatch]:
    """All pairs of whole groups, and what the sums over other blocks give, by visit and relation."""
    group = np.cumsum(_changes(rows)) - 1
    kind = rows.column("kind").to_numpy()
    if not (kind == 2).any():
        return
    lists = rows.column("v").combine_chunks()
    flat, starts = lists.values.to_numpy(), lists.offsets.to_numpy()[:-1]
    field = lambda which, k: flat[starts[which] + k]
    groups = group[-1] + 1
    at = np.zeros(groups, np.int64)
    at[group] = rows.column("block").to_numpy()
    sums = np.zeros((groups, 11), np.int64)
    for k in range(11):
        w = np.flatnonzero(kind == 0)
        sums[group[w], k] = field(w, k)
    r, v = np.flatnonzero(kind == 1), np.flatnonzero(kind == 2)
    p, q, weight, times, gr = field(r, 0), field(r, 1), field(r, 2), field(r, 3), group[r]
    a, e, first, gv = field(v, 0), field(v, 1), field(v, 2) == 1, group[v]
    n = len(v)
    begin = at * block  # a group's first slot
    # The second visit of an interval takes only what starts after the block of the first.
    least = np.where(first, np.iinfo(np.int64).min, (a // block + 1) * block)
    # Slots as ranks, so that (group, slot) is one number whatever the slots are.
    ranked, inverse = np.unique(np.concatenate((p, q, a, e, least, begin)), return_inverse=True)
    width = len(ranked) + 1
    rp, rq, ra, re, rl, rb = np.split(inverse, np.cumsum([len(p), len(q), n, n, n]))
    starts_key, ends_key = gr * width + rp, gr * width + rq
    order1, order2 = np.argsort(starts_key, kind="stable"), np.argsort(ends_key, kind="stable")
    place2 = np.empty(len(r), np.int64)
    place2[order2] = np.arange(len(r))
    permutation = place2[order1]  # from start order to end order
    starts_key, ends_key = starts_key[order1], ends_key[order2]
    p, q, weight, times = p[order1], q[order1], weight[order1], times[order1]
    low = np.searchsorted(starts_key, gv * width + rl, "left")
    high = np.searchsorted(starts_key, gv * width + re, "right")
    offset2 = np.searchsorted(ends_key, gv * width + ra, "left")

    out = {f: np.zeros((n, 9), np.int64) for f in ("n", "overlap", "weight")}
    many = np.maximum(high - low, 0)
    done = np.concatenate(([0], np.cumsum(many)))
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(done, done[i] + CHUNK, "right")) - 1)
        size = many[i:j]
        owner = np.repeat(np.arange(i, j), size)
        place = np.arange(done[j] - done[i]) - np.repeat(done[i:j] - done[i] - low[i:j], size)
        bits = permutation[place] >= offset2[owner]
        hit = np.flatnonzero(bits)
        owner, place = owner[hit], place[hit]
        sa, se = np.sign(a[owner] - p[place]) + 1, np.sign(e[owner] - q[place]) + 1
        until = np.minimum(e[owner], q[place])
        shared = np.where(until == OPEN, 0, until - np.maximum(a[owner], p[place]) + 1)
        cell = (owner - i) * 9 + 3 * sa + se
        for f, x in (("n", times[place]), ("overlap", shared * times[place]), ("weight", weight[place])):
            out[f][i:j] += _summed(cell, x, (j - i) * 9).reshape(-1, 9)
        i = j

    # Sums in start order of the intervals that begin in the group's block, and of those carried into it.
    own = p >= begin[np.sort(gr)] if len(r) else np.zeros(0, bool)
    shut, length = q != OPEN, np.where(q == OPEN, 0, q - p + 1) * times
    run = lambda which, x: np.concatenate(([0], np.cumsum(np.where(which, x, 0))))
    g0, g1 = np.searchsorted(starts_key, np.arange(groups) * width), np.searchsorted(starts_key, np.arange(1, groups + 1) * width)
    within = lambda c: c[g1] - c[g0]
    native_open = [within(run(own & ~shut, x)) for x in (times, weight, p * times)]
    native_shut = [within(run(own & shut, x)) for x in (times, length, weight)]
    open_before, shut_before = [sums[gv, k] for k in (0, 1, 2)], [sums[gv, k] for k in (3, 4, 5)]
    open_upto, shut_upto = [b + x[gv] for b, x in zip(open_before, native_open)], [b + x[gv] for b, x in zip(shut_before, native_shut)]
    endless = e == OPEN
    two = ~endless & (a // block != e // block)
    zero = np.zeros(n, np.int64)

    def put(which: np.ndarray, code: int, sign: int, count: np.ndarray, overlap: np.ndarray, weights: np.ndarray) -> None:
        for f, x in (("n", count), ("overlap", overlap), ("weight", weights)):
            out[f][which, code] += sign * x[which]

    # Open intervals from blocks before: they began earlier and never end.
    n0, w0, s0 = open_before
    put(first & ~endless, DURING, 1, n0, n0 * (np.where(endless, a, e) - a + 1), w0)
    put(first & endless, FINISHES, 1, n0, zero, w0)
    # Between the blocks of both ends: up to the last one, less up to the first one.
    last = np.where(endless, 0, e)
    n1, w1, s1 = open_upto
    c0, l0, x0 = shut_before
    c1, l1, x1 = shut_upto
    put(first & two, OVERLAPS, -1, n1, n1 * (last + 1) - s1, w1)
    put(first & two, CONTAINS, -1, c1, l1, x1)
    put(~first, OVERLAPS, 1, n0, n0 * (last + 1) - s0, w0)
    put(~first, CONTAINS, 1, c0, l0, x0)
    # Those that reach into the last block were enumerated there.
    upto = np.searchsorted(starts_key, gv * width + rb[gv], "left")
    reach = np.maximum(upto, low)
    carried = [c[reach] - c[low] for c in (run(~own, times), run(~own, length), run(~own, weight))]
    put(~first, CONTAINS, -1, *carried)
    # An interval without end: all that begins in later blocks.
    put(first & endless, CONTAINS, 1, *[sums[gv, 6 + k] - x for k, x in enumerate((c1, l1, x1))])
    put(first & endless, FINISHED_BY, 1, sums[gv, 9] - n1, zero, sums[gv, 10] - w1)

    who, code = np.nonzero((out["n"] != 0) | (out["overlap"] != 0) | (out["weight"] != 0))
    never = endless[who] & np.isin(code, BOTH_OPEN)
    yield pa.RecordBatch.from_arrays(
        [rows.column("id").combine_chunks().take(pa.array(v[who])), pa.array(code.astype(np.int32)), pa.array(out["n"][who, code]), pa.array(out["overlap"][who, code], mask=never), pa.array(out["weight"][who, code])],
        names=["id", "code", "n", "overlap", "weight"],
    )


def _summed(cell: np.ndarray, x: np.ndarray, size: int) -> np.ndarray:
    """Sums of whole numbers by cell, exact: halves of 31 bits stay whole as doubles."""
    high, low = x >> 31, x & 0x7FFFFFFF
    return np.bincount(cell, high, size).astype(np.int64) * (1 << 31) + np.bincount(cell, low, size).astype(np.int64)
