"""Near-duplicate documents by order MinHash.

A sketch of a document keeps its few least k-mers under a random order (k-mers of five
words, labelled by their occurrence) in the order of the text, so it agrees for two
documents if they share these k-mers and their order. Documents with a sketch in common
are candidates; banded alignment of their words decides. Texts of under fifteen words have
hardly a k-mer that an edit leaves alone; they also meet with one or two words left out.

Nothing here emits all pairs of a group. Documents of equal words are one class from the
start. Each class is first compared with the least member of each of its buckets, which
joins a group of n near copies with n comparisons. Only members that this leaves apart
from their bucket's least member are compared with the rest of the bucket, in chunks of bounded
size: first by their lengths and counts of words (which rule out no similar pair) and then,
where these leave anything, by their words, each pair in the first bucket that it shares. So every pair with a
sketch in common is decided. The rows of one bucket are dealt over many tasks throughout.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .align import within, within_many
from .common import by_groups, plain_words, spread_join, written
from .components import components

WORDS = 5  # words in a k-mer
#: Sketches of a document, and k-mers in a sketch; of texts of up to FEW_WORDS words, which have few
#: k-mers that an edit leaves alone, a sketch is one k-mer.
SKETCHES, KEPT, FEW_WORDS = 56, 2, 60
#: Texts of fewer words also have a key for each way to leave out as many as may be edited.
SHORT = 15
CHUNK = 256  # members of a star whose words are in one task
#: Members of a bucket that are compared in one task; up to SMALL of them pair by pair with
#: those of many other buckets at once, more as matrices of ROWS of them with all others.
CHUNK_COUNTS, SMALL, ROWS = 4096, 256, 64
FEW = 6  # pairs of a document from which on they are aligned in one band
#: Of the word counts by which pairs are ruled out: at first, and when the words are there.
BINS, MORE_BINS = 64, 512
#: Cells of a table of hashes that are held at once.
CELLS = 4_000_000


def word_values(words: list[bytes]) -> np.ndarray:
    import xxhash

    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def kmers(values: np.ndarray, k: int = WORDS) -> np.ndarray:
    """A hash for each run of k words; a shorter text is one run."""
    if not len(values):
        return np.empty(0, np.uint64)
    k = min(k, len(values))
    out = np.zeros(len(values) - k + 1, np.uint64)
    for i in range(k):
        out = (out ^ values[i : len(values) - k + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out


def _labelled(grams: np.ndarray) -> np.ndarray:
    """K-mers with their occurrence: equal ones get different values, the same in every document."""
    order = np.argsort(grams, kind="stable")
    ranked = grams[order]
    new = np.ones(len(ranked), bool)
    new[1:] = ranked[1:] != ranked[:-1]
    at = np.arange(len(ranked))
    nth = np.empty(len(grams), np.uint64)
    nth[order] = at - np.maximum.accumulate(np.where(new, at, 0))
    return grams + nth * np.uint64(0xD1B54A32D192ED03)


def _seeds(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240229)
    return rng.integers(0, 1 << 63, (n, 1), np.uint64), rng.integers(0, 1 << 63, (n, 1), np.uint64) | np.uint64(1)


def sketch(grams: np.ndarray, xor: np.ndarray, times: np.ndarray, kept: int = KEPT) -> np.ndarray:
    """A 64-bit key for each sketch of a document with at least one k-mer."""
    labelled = _labelled(grams)
    key = np.arange(1, len(xor) + 1, dtype=np.uint64)
    kept = min(kept, len(grams))
    step = max(1, CELLS // len(grams))
    for a in range(0, len(xor), step):
        order = (labelled ^ xor[a : a + step]) * times[a : a + step]
        order ^= order >> np.uint64(31)
        rows = np.arange(len(order))
        least = np.empty((len(order), kept), np.int64)
        for i in range(kept):
            least[:, i] = order.argmin(axis=1)
            order[rows, least[:, i]] = np.iinfo(np.uint64).max
        least.sort(axis=1)
        part = key[a : a + step]
        for i in range(kept):
            part = (part ^ grams[least[:, i]]) * np.uint64(0xC2B2AE3D27D4EB4F)
            part ^= part >> np.uint64(32)
        key[a : a + step] = part
    return key


def sketch_keys(values: np.ndarray, xor: np.ndarray, times: np.ndarray, kept: int, threshold: float) -> np.ndarray:
    """The keys of a text's sketches. Two similar texts have sketches of the same kind: a text that is
    similar to one of FEW_WORDS words has sketches of one k-mer too."""
    grams, out = kmers(values), []
    if kept == 1 or len(values) > FEW_WORDS:
        out.append(sketch(grams, xor, times, kept))
    if kept > 1 and len(values) <= FEW_WORDS / threshold + 1e-9:
        out.append(sketch(grams, xor, times, 1) ^ np.uint64(0x9E3779B97F4A7C15))
    return np.concatenate(out)


def edits_of(n: int, threshold: float) -> int:
    """How many words may differ between a text of n words and one that is not longer."""
    return int((1 - threshold) * n + 1e-9)


def left_out(values: np.ndarray, threshold: float) -> np.ndarray:
    """Keys of a text of under SHORT words: its words less any d or fewer, d being the edits
    that the longest such text similar to it may have. Two of them have such a rest in common."""
    import xxhash

    d = min(len(values), edits_of(min(int(len(values) / threshold + 1e-9), SHORT - 1), threshold))
    keys = {xxhash.xxh3_64_intdigest(np.delete(values, gone).tobytes()) for n in range(d + 1) for gone in combinations(range(len(values)), n)}
    return np.array(sorted(keys), np.uint64)


def counts(values: np.ndarray, bins: int = BINS) -> np.ndarray:
    """How many words fall into each bin, 255 at most."""
    return np.minimum(np.bincount((values % values.dtype.type(bins)).astype(np.int64), minlength=bins), 255).astype(np.uint8)


def possible(one: np.ndarray, sizes_one: np.ndarray, others: np.ndarray, sizes: np.ndarray, threshold: float) -> np.ndarray:
    """Which rows of others may be similar to the same row of one (or to the only one), all
    given as `counts` and numbers of words. An edit takes one word away at most and adds one
    at most, so no similar pair is ruled out."""
    apart = others.astype(np.int16) - one
    limit = ((1 - threshold) * np.maximum(sizes, sizes_one) + 1e-9).astype(np.int64)
    return np.maximum(np.maximum(apart, 0).sum(axis=1), np.maximum(-apart, 0).sum(axis=1)) <= limit


def _possible_matrix(a: np.ndarray, sizes_a: np.ndarray, b: np.ndarray, sizes_b: np.ndarray, threshold: float) -> np.ndarray:
    """`possible` for each row of a with each row of b."""
    a, b = np.ascontiguousarray(a.T, np.uint16), np.ascontiguousarray(b.T, np.uint16)
    both, one = np.zeros((a.shape[1], b.shape[1]), np.uint16), np.empty((a.shape[1], b.shape[1]), np.uint16)
    for x, y in zip(a, b):  # the sum of the larger count of each bin
        np.maximum.outer(x, y, out=one)
        both += one
    limit = ((1 - threshold) * np.maximum(sizes_a[:, None], sizes_b) + 1e-9).astype(np.int64)
    return both - np.minimum(a.sum(axis=0, dtype=np.int64)[:, None], b.sum(axis=0, dtype=np.int64)) <= limit


def possible_pairs(bounds: np.ndarray, odd: np.ndarray, side: np.ndarray, of: np.ndarray, size: np.ndarray, bins: np.ndarray, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of the same group that may be similar, of which one is odd, that are in
    different components and not on the same side (unless that is 0)."""

    def wanted(p: np.ndarray, q: np.ndarray) -> np.ndarray:
        return (odd[p] | odd[q]) & (of[p] != of[q]) & ((side[p] != side[q]) | (side[p] == 0))

    n = np.diff(bounds)
    small = n <= SMALL
    for part in np.array_split(np.flatnonzero(small), max(1, int((n[small] ** 2).sum() // 2_000_000))):
        rows = np.concatenate([np.arange(bounds[k], bounds[k + 1]) for k in part.tolist()]) if len(part) else np.empty(0, np.int64)
        after = np.repeat(bounds[1:][part], n[part]) - rows - 1  # rows of the group that follow
        p = np.repeat(rows, after)
        q = p + 1 + np.arange(len(p)) - np.repeat(np.cumsum(after) - after, after)
        good = wanted(p, q) & (np.minimum(size[p], size[q]) >= threshold * np.maximum(size[p], size[q]) - 1e-6)
        p, q = p[good], q[good]
        for k in range(0, len(p), 50_000):
            x, y = p[k : k + 50_000], q[k : k + 50_000]
            good = possible(bins[x], size[x], bins[y], size[y], threshold)
            yield x[good], y[good]
    for k in np.flatnonzero(~small).tolist():
        rows = bounds[k] + np.argsort(size[bounds[k] : bounds[k + 1]], kind="stable")
        for a in range(0, len(rows), ROWS):
            # Others of about their lengths stand next to each other; pairs are taken once, by the shorter one.
            p, q = rows[a : a + ROWS], rows[a:]
            q = q[: np.searchsorted(size[q], size[p[-1]] / threshold + 1e-6, "right")]
            i, j = np.nonzero(_possible_matrix(bins[p], size[p], bins[q], size[q], threshold))
            x, y = p[i[i < j]], q[j[i < j]]
            good = wanted(x, y)
            yield x[good], y[good]


def met_before(p: np.ndarray, q: np.ndarray, key: np.ndarray, keys: list[np.ndarray]) -> np.ndarray:
    """Which pairs of rows also share a bucket with a lesser key than the one they meet in: keys are all
    buckets of a row. Such a pair is decided there."""
    rows, at = np.unique(np.concatenate((p, q)), return_inverse=True)
    some = [keys[r][keys[r] < key[r]] for r in rows.tolist()]
    width = max(map(len, some), default=0)
    if not width:
        return np.zeros(len(p), bool)
    # Rows of unequal length are filled with numbers that no other row has.
    filled = (np.iinfo(np.int64).min + np.arange(len(rows)))[:, None].repeat(width, axis=1)
    for row, own in zip(filled, some):
        row[: len(own)] = own
    x, y, out = at[: len(p)], at[len(p) :], np.zeros(len(p), bool)
    step = max(1, CELLS // width)
    for a in range(0, len(p), step):
        u, v = filled[x[a : a + step]], filled[y[a : a + step]]
        for j in range(width):
            out[a : a + step] |= (u == v[:, j : j + 1]).any(axis=1)
    return out


def similar(a: np.ndarray, b: np.ndarray, threshold: float) -> bool:
    """Whether 1 - (edit distance of the words) / (longer length) reaches the threshold."""
    return within(a, b, edits_of(max(len(a), len(b)), threshold))


def _words(text: str | None) -> np.ndarray:
    return word_values(plain_words(text or ""))


def _digest(values: np.ndarray) -> tuple[int, int]:
    import xxhash

    whole = xxhash.xxh3_128_intdigest(values.tobytes())
    return (whole >> 64) - (1 << 63), (whole & ((1 << 64) - 1)) - (1 << 63)


def _sketched(sketches: int, kept: int, threshold: float):  # noqa: ANN202
    xor, times = _seeds(sketches)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, digests, sizes, bins, keys = [], [], [], [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                values = _words(text.as_py())
                if doc_id is None or not len(values):
                    continue
                ids.append(doc_id)
                digests.append(_digest(values))
                sizes.append(len(values))
                bins.append(counts(values).tobytes())
                own = sketch_keys(values, xor, times, kept, threshold)
                keys.append((np.concatenate((own, left_out(values, threshold))) if len(values) < SHORT else own).view(np.int64))
            flat = pa.array(np.concatenate(keys) if keys else np.empty(0, np.int64), pa.int64())
            ends = pa.array(np.cumsum([0, *map(len, keys)]), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array([a for a, _ in digests], pa.int64()), pa.array([b for _, b in digests], pa.int64()), pa.array(sizes, pa.int32()), pa.array(bins, pa.binary()), pa.ListArray.from_arrays(ends, flat)],
                names=["id", "one", "two", "size", "bins", "keys"],
            )

    return run


def _coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, text, one, two) to (id, words): the words as four bytes each, of texts with this digest."""
    for batch in batches:
        ids, words = [], []
        for doc_id, text, one, two in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            values = _words(text.as_py())
            if _digest(values) == (one, two):
                ids.append(doc_id)
                words.append((values >> np.uint64(32)).astype(np.uint32).tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(words, pa.binary())], names=["id", "words"])


def _read(words: bytes) -> np.ndarray:
    return np.frombuffer(words, np.uint32)


def _bins(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, BINS)


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.8, sketches: int = SKETCHES, kept: int = KEPT) -> DataFrame:
    """One row (id, class_id, kept) for each row of docs.

    Documents are linked if their words are similar (see `similar`) and they share a sketch
    (see SKETCHES for how likely that is); class_id is the least id that links lead to, kept
    marks the document with that id. Words are taken in lower case without ASCII punctuation.
    A document without words (null and empty texts too) is linked with nothing; a null id has
    a null class and is kept. Rows with the same id are one document; if their words differ,
    those with the least digest count. Texts of any length that fits in a row are taken
    whole; pairs exactly at the threshold are linked. An empty table gives no rows. Other
    columns play no part, whatever their names.
    """
    if not 0 < threshold < 1:
        raise ValueError("threshold must lie between 0 and 1")
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    base = written(docs.mapInArrow(_sketched(sketches, kept, threshold), "id long, one long, two long, size int, bins binary, keys array<long>"), "sketches")
    digest = F.struct("one", "two")
    several = written(base.groupBy("id").agg(F.min(digest).alias("m"), F.max(digest).alias("x")).where("m <> x").select("id", "m"), "several")
    base = base.join(several, "id", "left").where(F.col("m").isNull() | (F.col("m") == digest))
    classes = written(base.groupBy("one", "two").agg(F.min("id").alias("rep"), F.first("size").alias("size"), F.first("bins").alias("bins"), F.first("keys").alias("keys")), "classes")
    member = spread_join(base.select("id", "one", "two"), classes.select("one", "two", "rep"), ["one", "two"], "id").where("id <> rep").select(F.col("id").alias("a"), F.col("rep").alias("b"))

    held = classes.select("rep", F.explode("keys").alias("key"))
    buckets = held.groupBy("key").agg(F.count("*").alias("n"), F.min("rep").alias("least"), F.bit_xor(F.xxhash64("rep")).alias("f"), F.bit_xor(F.xxhash64(F.lit(7), "rep")).alias("g")).where("n > 1")
    # Buckets of the same members are one.
    buckets = buckets.groupBy("n", "least", "f", "g").agg(F.min("key").alias("key")).select("key", "n", "least")
    inside = written(spread_join(held, buckets, ["key"], "rep").select("key", "n", "least", "rep"), "buckets")
    traits = classes.select("rep", "one", "two", "size", "bins")

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                n, m = batch["size"].to_numpy(), batch["size_least"].to_numpy()
                yield batch.select(["least", "rep"]).filter(pa.array(possible(_bins(batch["bins_least"]), m, _bins(batch["bins"]), n, threshold)))

    stars = inside.where("rep <> least").select("least", "rep").distinct()
    of_least = traits.select(F.col("rep").alias("least"), F.col("size").alias("size_least"), F.col("bins").alias("bins_least")).join(stars.select("least").distinct(), "least")
    stars = spread_join(stars.join(traits.select("rep", "size", "bins"), "rep"), of_least, ["least"], "rep")
    fits = f"least(size, size_least) >= {threshold} * greatest(size, size_least) - 1e-6"
    stars = written(stars.where(fits).mapInArrow(close, "least long, rep long"), "stars")

    def texts(wanted: DataFrame, name: str) -> DataFrame:
        """The words of the documents whose ids are wanted."""
        wanted = written(wanted.distinct().join(traits.select(F.col("rep").alias("id"), "one", "two"), "id"), f"wanted_{name}")
        return written(docs.join(wanted.hint("merge"), "id").dropDuplicates(["id", "text"]).mapInArrow(_coded, "id long, words binary"), f"words_{name}")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            same = [similar(_read(a.as_py()), _read(b.as_py()), threshold) for a, b in zip(batch.column(2), batch.column(3))]
            yield batch.select([0, 1]).filter(pa.array(same, pa.bool_()))

    words = texts(stars.select(F.col("rep").alias("id")).union(stars.select(F.col("least").alias("id"))), "stars")
    # The words of a least member go once to each of the tasks that its star needs.
    size = stars.groupBy("least").agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("m"))
    pairs = spread_join(stars, size, ["least"], "rep").withColumn("part", F.pmod(F.xxhash64("rep"), F.col("m")).cast("int"))
    first = words.withColumnRenamed("id", "least").join(size, "least").select("least", F.col("words").alias("y"), F.explode(F.sequence(F.lit(0), F.col("m") - 1)).alias("part"))
    pairs = pairs.join(words.select(F.col("id").alias("rep"), F.col("words").alias("x")), "rep").join(first, ["least", "part"])
    same = pairs.select("least", "rep", "x", "y").mapInArrow(compare, "a long, b long")
    found = written(components(member.unionByName(same)), "linked")

    apart = written(_apart(inside, found, traits, threshold), "apart")
    if not apart.isEmpty():
        words = texts(apart.select(F.col("rep").alias("id")), "apart")
        more = written(_linked(apart.join(words.withColumnRenamed("id", "rep"), "rep"), threshold), "more")
        if not more.isEmpty():
            found = components(more.unionByName(found.select(F.col("component").alias("a"), F.col("id").alias("b"))))
    out = docs.select("id").join(found, "id", "left")
    class_id = F.coalesce("component", "id")
    return out.select(F.col("id").alias(id_col), class_id.alias("class_id"), F.coalesce(class_id == F.col("id"), F.lit(True)).alias("kept"))


def _apart(inside: DataFrame, found: DataFrame, traits: DataFrame, threshold: float) -> DataFrame:
    """Members (group, rep, of, odd, side) of buckets that may be similar to a member of the
    same group that the links so far (found) leave apart.

    Members apart from their bucket's least member (odd) meet the others of the bucket. A
    bucket of more than CHUNK_COUNTS members is dealt in chunks, of which any two meet.
    """
    each = inside.join(found.withColumnRenamed("id", "rep"), "rep", "left").select("key", "least", "rep", F.coalesce("component", "rep").alias("of"))
    head = each.where("rep = least").select("key", F.col("of").alias("of_least"))
    each = spread_join(each.where("rep <> least"), head, ["key"], "rep").withColumn("odd", F.col("of") != F.col("of_least"))
    mixed = each.groupBy("key").agg(F.min("of").alias("low"), F.max("of").alias("high"), F.max("odd").alias("any"), F.ceil(F.count("*") / CHUNK_COUNTS).cast("int").alias("m")).where("any and low <> high").select("key", "m")
    each = written(spread_join(each, mixed, ["key"], "rep"), "mixed")
    # A pair that shares several buckets is compared in the one with the least key.
    every = each.groupBy("rep").agg(F.collect_list("key").alias("keys"))
    each = each.join(traits.select("rep", "size", "bins").join(every, "rep"), "rep")
    each = each.withColumn("mine", F.pmod(F.xxhash64("rep"), "m").cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("m") - 1)))
    side = F.when(F.col("mine") == F.col("other"), 0).when(F.col("mine") < F.col("other"), 1).otherwise(2)
    each = each.select(F.xxhash64("key", F.least("mine", "other"), F.greatest("mine", "other")).alias("group"), "rep", "of", "odd", side.alias("side"), "key", "keys", "size", "bins")

    def may(table: pa.Table, bounds: np.ndarray) -> pa.Table:
        of, odd, side, size = (table[c].to_numpy(zero_copy_only=False) if c == "odd" else table[c].to_numpy() for c in ("of", "odd", "side", "size"))
        key, keys = _keys(table)
        keep = np.zeros(len(of), bool)
        for p, q in possible_pairs(bounds, odd, side, of, size, _bins(table["bins"]), threshold):
            new = ~met_before(p, q, key, keys)
            keep[p[new]] = keep[q[new]] = True
        return table.select(["group", "rep", "of", "odd", "side", "key", "keys"]).filter(pa.array(keep))

    return by_groups(each, ["group"], may, "group long, rep long, of long, odd boolean, side int, key long, keys array<long>")


def _keys(table: pa.Table) -> tuple[np.ndarray, list[np.ndarray]]:
    lists = table["keys"].combine_chunks()
    ends, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
    return table["key"].to_numpy(), [flat[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]


def _linked(apart: DataFrame, threshold: float) -> DataFrame:
    """Links (a, b) between the components of similar members of a group: a star for each
    set that is newly linked."""

    def compare(table: pa.Table, bounds: np.ndarray) -> pa.Table:
        of, side, odd = table["of"].to_numpy(), table["side"].to_numpy(), table["odd"].to_numpy(zero_copy_only=False)
        words = [_read(w) for w in table["words"].to_pylist()]
        size = np.fromiter(map(len, words), np.int64, len(words))
        bins = np.array([counts(w, MORE_BINS) for w in words])
        key, keys = _keys(table)
        root = {c: c for c in of.tolist()}

        def find(x: int) -> int:
            while root[x] != x:
                root[x] = x = root[root[x]]
            return x

        for p, q in possible_pairs(bounds, odd, side, of, size, bins, threshold):
            new = ~met_before(p, q, key, keys)
            p, q = p[new], q[new]
            order = np.argsort(p, kind="stable")
            p, q = p[order], q[order]
            cuts = np.flatnonzero(np.diff(p, prepend=-1, append=-1)).tolist() if len(p) else []
            for x, y in zip(cuts[:-1], cuts[1:]):
                i, home = int(p[x]), find(int(of[p[x]]))
                # One similar member joins its whole component, so a few are aligned first, then ever more.
                near, step = q[x:y].tolist(), FEW
                while near := [j for j in near if find(int(of[j])) != home]:
                    some, near, step = near[:step], near[step:], 2 * step
                    if len(some) < FEW:
                        same = [j for j in some if similar(words[i], words[j], threshold)]
                    else:
                        limits = np.array([edits_of(max(int(size[i]), int(size[j])), threshold) for j in some])
                        same = np.array(some)[within_many(words[i], [words[j] for j in some], limits)].tolist()
                    for j in same:
                        low, high = sorted((find(int(of[i])), find(int(of[j]))))
                        root[high] = low
                    home = find(int(of[i]))
        stars = [(find(c), c) for c in root if find(c) != c]
        return pa.table({"a": pa.array([x for x, _ in stars], pa.int64()), "b": pa.array([y for _, y in stars], pa.int64())})

    return by_groups(apart.select("group", "rep", "of", "odd", "side", "key", "keys", "words"), ["group"], compare, "a long, b long")
