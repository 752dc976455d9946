"""Benchmark decontamination: documents that hold a benchmark item, give or take a few words.

For each item the windows of a document are of the item's own size. Windows and items
are embedded by CGK random walks, which turn few edits into few differing places, and
bit samples of the embedding are LSH keys. Equal keys make a candidate, the exact edit
distance decides. The walks of a window and its item part at every edit and agree less
the longer they are, so the number of repetitions follows from the target recall and from
agreement measured at the item's length and edit limit. Items that would take more than
MOST_REPS are not embedded: the exact edit distance decides on all their windows.

Which windows are embedded at all follows from a lossless count: a window within d edits
of an item of n words shares at least n - 2 - 3d of its runs of three words, at about the
same offset. Items so short that this is none are cut into d + 1 pieces, one of which
stands unchanged; the exact edit distance decides around each. All of this is one pass over the documents, in batches; the benchmark is
dealt with in slices of a bounded number of words, so what is broadcast is bounded.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .align import best_place
from .blocks import NO_ID
from .common import plain_words

#: Words of benchmark items in a slice; a slice is broadcast and takes about 100 bytes a word.
SLICE_WORDS = 400_000
SAMPLED = 3  # symbols of an embedding in a key
RECALL = 0.995
MOST_REPS = 48
#: Lengths for which agreement is measured; an item is taken for the next one, and a longer
#: item than the last is not embedded.
LENGTHS = (5, 10, 15, 20, 25, 30, 40, 50, 60, 80, 100)
#: Windows at the edit limit that are made of each kind of edits, and repetitions measured.
SAMPLES, MEASURED = 100, 128
OUT = "id long, item_id long, start_word int, end_word int, edits int"


def limit_of(n: int, threshold: float) -> int:
    """The edits allowed for an item of n words."""
    return int((1 - threshold) * n + 1e-9)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def cgk_keys(windows: np.ndarray, sizes: np.ndarray, reps: int, sampled: int = SAMPLED) -> np.ndarray:
    """LSH keys (window, repetition) of windows, given as rows of word codes of which each
    row's first sizes[i] count.

    In a repetition a walk reads the window's words from the left: at step j it writes the
    word it stands on and moves on by one or not, by a random bit of (repetition, j, word);
    it takes three steps for each word. The key is of the words written at a few random steps.
    """
    n, width = windows.shape
    rows = np.arange(n)[:, None]
    padded = np.concatenate((windows.astype(np.int64), np.full((n, 1), -2)), axis=1)
    rep = np.arange(reps, dtype=np.uint64)[None, :]
    rng = np.random.default_rng(7)
    places = (rng.random((reps, sampled))[None] * (3 * sizes[:, None, None])).astype(np.int64)
    at = np.zeros((n, reps), np.int64)
    keys = np.repeat(_mix(rep * np.uint64(0x9E37) + np.uint64(1)), n, axis=0) + _mix(sizes.astype(np.uint64))[:, None]
    for j in range(3 * int(sizes.max(initial=0))):
        word = np.where(at < sizes[:, None], padded[rows, np.minimum(at, width)], -2)
        seen = _mix((word + 3).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + rep * np.uint64(0x10001) + np.uint64(j) * np.uint64(0x1000003D))
        for k in range(sampled):
            hit = places[:, :, k] == j
            if hit.any():
                keys = np.where(hit, keys + _mix((word + 3).astype(np.uint64) + np.uint64(k + 1) * np.uint64(0xABCDEF12345)), keys)
        at = np.minimum(at + (seen & np.uint64(1)).astype(np.int64), sizes[:, None])
    return keys


def _at_limit(n: int, d: int) -> np.ndarray:
    """An item of n different words and, for each kind of edits, SAMPLES windows d edits away:
    words replaced at even distances, anywhere, left out, put in."""
    rng = np.random.default_rng(n)
    item, rows = np.arange(n), [np.arange(n)]
    for kind in range(4):
        for _ in range(SAMPLES):
            at, new = rng.choice(n, d, replace=False), n + rng.permutation(n)[:d]
            if kind == 0:
                at = (np.arange(d) * n // d + rng.integers(n)) % n
            if kind < 2:
                row = item.copy()
                row[at] = new
            elif kind == 2:
                row = np.concatenate((np.delete(item, at), new))
            else:
                row = np.insert(item, at, new)[:n]
            rows.append(row)
    return np.stack(rows)


@lru_cache(None)
def _measured(n: int, d: int) -> np.ndarray:
    """Share of repetitions in which a window's key is the item's; a row for each kind of edits."""
    rows = _at_limit(n, d)
    keys = cgk_keys(rows, np.full(len(rows), n), MEASURED)
    return (keys[1:] == keys[0]).mean(axis=1).reshape(4, SAMPLES)


def repetitions(n: int, threshold: float, recall: float = RECALL) -> int:
    """How many repetitions find a window at the edit limit of an item of n words with the
    given probability, whichever kind of edits it has; 0 if MOST_REPS don't."""
    if limit_of(n, threshold) == 0:
        return 1
    longer = [m for m in LENGTHS if m >= n]
    if not longer:
        return 0
    m = longer[0]
    apart = 1 - _measured(m, min(m, math.ceil((1 - threshold) * m - 1e-9)))
    return next((r for r in range(1, MOST_REPS + 1) if (1 - (apart**r).mean(axis=1)).min() >= recall), 0)


def _runs(codes: np.ndarray, n: int) -> np.ndarray:
    """A hash for each run of n words."""
    out = np.zeros(max(0, len(codes) - n + 1), np.uint64)
    for i in range(n):
        out = _mix(out + (codes[i : len(out) + i] + 3).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return out


class Items:
    """A slice of the benchmark: word codes, runs of three words, LSH keys."""

    def __init__(self, items: list[tuple[int, list[bytes]]], threshold: float, recall: float) -> None:
        self.ids = np.array([i for i, _ in items], np.int64)
        self.code: dict[bytes, int] = {}
        self.words = [np.array([self.code.setdefault(w, len(self.code)) for w in words], np.int64) for _, words in items]
        self.sizes = np.array([len(w) for w in self.words], np.int64)
        self.limits = np.array([limit_of(n, threshold) for n in self.sizes.tolist()], np.int64)
        self.needed = self.sizes - 2 - 3 * self.limits
        reps = {n: repetitions(n, threshold, recall) for n in set(self.sizes.tolist())}
        self.reps = np.where(self.needed < 1, 0, np.array([reps[n] for n in self.sizes.tolist()], np.int64))
        pieces: dict[int, list[tuple[int, int, int]]] = {}
        for k in np.flatnonzero(self.needed < 1).tolist():
            cuts = [i * int(self.sizes[k]) // (int(self.limits[k]) + 1) for i in range(int(self.limits[k]) + 2)]
            for x, y in zip(cuts, cuts[1:]):
                if y > x:
                    pieces.setdefault(y - x, []).append((int(_runs(self.words[k][x:y], y - x)[0]), k, x))
        self.pieces = [(n, np.array([h for h, _, _ in p], np.uint64), np.array([k for _, k, _ in p], np.int64), np.array([x for _, _, x in p], np.int64)) for n, p in ((n, sorted(p)) for n, p in sorted(pieces.items()))]
        self.base = len(self.code) + 1
        grams = [self.grams(w if n > 0 else w[:0])[0] for w, n in zip(self.words, self.needed.tolist())]
        flat = np.concatenate(grams) if grams else np.empty(0, np.int64)
        item = np.repeat(np.arange(len(grams)), [len(g) for g in grams])
        offset = np.concatenate([np.arange(len(g)) for g in grams]) if grams else np.empty(0, np.int64)
        order = np.argsort(flat, kind="stable")
        self.gram_keys, first, self.gram_n = np.unique(flat[order], return_index=True, return_counts=True)
        self.gram_first, self.gram_item, self.gram_offset = first, item[order], offset[order]
        keys, owner = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
        for r in sorted(set(self.reps.tolist()) - {0}):
            rows = np.flatnonzero(self.reps == r)
            table = np.full((len(rows), int(self.sizes[rows].max())), -2, np.int64)
            for k, w in enumerate(rows.tolist()):
                table[k, : self.sizes[w]] = self.words[w]
            keys.append(cgk_keys(table, self.sizes[rows], r).reshape(-1))
            owner.append(np.repeat(rows, r))
        flat = np.concatenate(keys)
        order = np.argsort(flat, kind="stable")
        self.keys, self.key_item = flat[order], np.concatenate(owner)[order]

    def grams(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Runs of three known words, and where they start."""
        known = codes >= 0
        at = np.flatnonzero(known[:-2] & known[1:-1] & known[2:])
        return (codes[at] * self.base + codes[at + 1]) * self.base + codes[at + 2], at

    def windows(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(item, start) of the item-sized windows that share enough runs with the item."""
        none = np.empty(0, np.int64)
        grams, at = self.grams(codes)
        if not len(grams) or not len(self.gram_keys):
            return none, none
        where = np.minimum(np.searchsorted(self.gram_keys, grams), len(self.gram_keys) - 1)
        hit = self.gram_keys[where] == grams
        where, at = where[hit], at[hit]
        n = self.gram_n[where]
        flat = np.repeat(self.gram_first[where] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        item, start = self.gram_item[flat], np.repeat(at, n) - self.gram_offset[flat]
        span = 2 * self.limits[item] + 1
        bucket = np.floor_divide(start, span) + 2
        key = item * (len(codes) + 8) + bucket
        keys, which, count = np.unique(key, return_inverse=True, return_counts=True)
        both = count.copy()  # with the next bucket, and with the one before
        near = np.diff(keys) == 1
        after, before = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        after[:-1][near], before[1:][near] = count[1:][near], count[:-1][near]
        both += np.maximum(after, before)
        good = both[which] >= self.needed[item]
        pairs = np.unique(np.stack((item[good], start[good])), axis=1)
        return pairs[0], pairs[1]

    def around_pieces(self, codes: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(item, start, document) wherever a piece of a short item stands in one document."""
        found = [np.empty((3, 0), np.int64)]
        for n, keys, owner, offset in self.pieces:
            runs = _runs(codes, n)
            left, right = np.searchsorted(keys, runs), np.searchsorted(keys, runs, "right")
            at = np.flatnonzero(right > left)
            doc = np.searchsorted(ends, at, "right") - 1
            at, doc = at[at + n <= ends[doc + 1]], doc[at + n <= ends[doc + 1]]
            times = right[at] - left[at]
            flat = np.repeat(left[at] - (np.cumsum(times) - times), times) + np.arange(times.sum())
            found.append(np.stack((owner[flat], np.repeat(at, times) - offset[flat], np.repeat(doc, times))))
        item, start, doc = np.unique(np.concatenate(found, axis=1), axis=1)
        # Without edits the first place in a document is the best one.
        first = np.ones(len(item), bool)
        order = np.lexsort((start, doc, item))
        item, start, doc = item[order], start[order], doc[order]
        first[1:] = (item[1:] != item[:-1]) | (doc[1:] != doc[:-1])
        keep = first | (self.limits[item] > 0)
        return item[keep], start[keep], doc[keep]

    def candidates(self, codes: np.ndarray, item: np.ndarray, start: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Rows (item, start, lo, hi) such that an LSH key of the window is one of the item's,
        and all rows of items that are not embedded."""
        reps = self.reps[item]
        found = [np.stack((item, start, lo, hi))[:, reps == 0]]
        for r in sorted(set(reps.tolist()) - {0}):
            these = np.flatnonzero(reps == r)
            these = these[np.argsort(self.sizes[item[these]], kind="stable")]
            for a in range(0, len(these), 2048):
                part = these[a : a + 2048]
                sizes = self.sizes[item[part]]
                places = start[part, None] + np.arange(int(sizes.max()))[None]
                inside = (places >= lo[part, None]) & (places < hi[part, None])
                windows = np.where(inside, codes[np.clip(places, 0, len(codes) - 1)], -1)
                keys = cgk_keys(windows, sizes, r).reshape(-1)
                left, right = np.searchsorted(self.keys, keys), np.searchsorted(self.keys, keys, "right")
                n = right - left
                if n.sum():
                    row = part[np.repeat(np.repeat(np.arange(len(part)), r), n)]
                    flat = np.repeat(left - (np.cumsum(n) - n), n) + np.arange(n.sum())
                    found.append(np.stack((self.key_item[flat], start[row], lo[row], hi[row])))
        return np.unique(np.concatenate(found, axis=1), axis=1).T


def _stretches(found: np.ndarray, items: Items) -> list[list[int]]:
    """Candidate windows (item, start, lo, hi) of an item that overlap, as one stretch: item,
    first and last start, lo, hi. An item's best place is looked for once in a stretch."""
    if not len(found):
        return []
    found = found[np.lexsort((found[:, 1], found[:, 2], found[:, 0]))]
    item, start, lo = found[:, 0], found[:, 1], found[:, 2]
    apart = (item[1:] != item[:-1]) | (lo[1:] != lo[:-1]) | (start[1:] - start[:-1] > items.sizes[item[1:]] + 2 * items.limits[item[1:]])
    first = np.flatnonzero(np.concatenate(([True], apart)))
    last = np.append(first[1:], len(found)) - 1
    return np.stack((item[first], start[first], start[last], lo[first], found[first, 3]), axis=1).tolist()


def _find(shared, id_type=pa.int64()):  # noqa: ANN001, ANN202
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items: Items = shared.value
        code = items.code.get
        for batch in batches:
            ids, codes, bounds = [], [], [0]
            rows = []

            def search() -> None:
                flat = np.concatenate(codes)
                item, start = items.windows(flat)
                middle = np.clip(start + items.sizes[item] // 2, 0, len(flat) - 1)
                doc = np.searchsorted(np.array(bounds), middle, "right") - 1
                ends = np.array(bounds)
                short = items.around_pieces(flat, ends)
                item, start, doc = (np.concatenate(x) for x in zip((item, start, doc), short))
                best: dict[tuple[int, int], tuple[int, int, int]] = {}
                for k, first, last, lo, hi in _stretches(items.candidates(flat, item, start, ends[doc], ends[doc + 1]), items):
                    d = int(items.limits[k])
                    a, b = max(lo, first - d), min(hi, last + int(items.sizes[k]) + d)
                    if b <= a:
                        continue
                    edits, x, y = best_place(items.words[k], flat[a:b])
                    if edits <= d:
                        at = int(np.searchsorted(ends, lo, "right")) - 1, int(items.ids[k])
                        best[at] = min(best.get(at, (1 << 30, 0, 0)), (edits, a + x - lo, a + y - lo))
                rows.extend((ids[n], k, x, y, e) for (n, k), (e, x, y) in best.items())

            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = plain_words(text.as_py() or "")
                if not words:
                    continue
                ids.append(doc_id)
                codes.append(np.fromiter([code(w, -1) for w in words], np.int64, len(words)))
                bounds.append(bounds[-1] + len(words))
                if bounds[-1] > 1_000_000:
                    search()
                    ids, codes, bounds = [], [], [0]
            if codes:
                search()
            columns = list(zip(*rows)) or [[]] * 5
            kinds = (id_type, pa.int64(), pa.int32(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=[c.split()[0] for c in OUT.split(", ")])

    return run


def contaminated(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", threshold: float = 0.8, recall: float = RECALL, slice_words: int = SLICE_WORDS) -> DataFrame:
    """One row (id, item_id, start_word, end_word, edits) for each document and item it holds.

    A document of whose words some stretch is within (1 - threshold) * n edits of an item's
    n words holds the item; the place is the best one found. Words are in lower case without
    ASCII punctuation. Items of under five words must stand there unchanged at the usual
    threshold; items without words (null and empty ones) are in no document. A null or empty text holds
    nothing, an empty table of documents or items gives no rows. Of equally good places the first counts.
    Rows with the same id give rows of their own; a row without id gives rows with a null id.
    Texts of one item id are one item, of which the best place counts; those without id are one
    item whose id is null. Texts of any length that fits in a row are searched whole. Extra columns play no part;
    where id_col and item_col are one name, the item's is called item_id.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    items = benchmark.select(F.coalesce(F.col(item_col).cast("long"), F.lit(int(NO_ID))).alias("k"), F.col(item_text).alias("t")).where("t is not null").distinct()
    chars = items.agg(F.sum(F.char_length("t"))).first()[0] or 0
    slices = max(1, -(-chars // (4 * slice_words)))  # of four characters a word at least
    parts = []
    for n in range(slices):
        got = items.where(F.pmod(F.xxhash64("k"), F.lit(slices)) == n).collect()
        words = [(r.k, w) for r in sorted(got) if (w := plain_words(r.t))]
        parts.append(docs.mapInArrow(_find(spark.sparkContext.broadcast(Items(words, threshold, recall))), OUT))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    item = F.when(F.col("item_id") != int(NO_ID), F.col("item_id"))
    return out.select(F.col("id").alias(id_col), item.alias("item_id" if item_col.lower() == id_col.lower() else item_col), "start_word", "end_word", "edits")
