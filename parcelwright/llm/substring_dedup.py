"""Substring dedup: every repeat of a run of `window` words loses its words.

Difference-cover anchors: positions whose residue modulo a period lies in a difference
cover are anchors. For any two positions some shift below the period makes both of them
anchors, so two equal windows always share an equal short window at such a shift. Only
those short windows are hashed and dealt out; a window of full length is compared with
others only if one of its anchors stands elsewhere too (it extends from there). Both
comparisons are exact but for hash collisions (of 80 bits and more).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import blocks as B
from .common import written

# Perfect difference sets by their period.
COVERS = {1: (0,), 3: (0, 1), 7: (0, 1, 3), 13: (0, 1, 3, 9), 21: (0, 1, 4, 14, 16)}
#: An anchor has at least so many words, as long as the window allows it.
LEAST_ANCHOR = 8
#: Hashes in one part.
PART_HASHES = 500_000

BASE_A, BASE_B = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def _windows(values: np.ndarray, width: int, base: int) -> np.ndarray:
    """A hash for each start of width values: a polynomial modulo 2^64, mixed."""
    n = len(values)
    if n < width:
        return np.empty(0, np.uint64)
    inverse = pow(base, -1, 1 << 64)
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values * _powers(base, n), dtype=np.uint64)))
    return _mix((total[width:] - total[:-width]) * _powers(inverse, n - width + 1))


def period_for(window: int) -> int:
    return max(p for p in COVERS if p == 1 or window - (p - 1) >= LEAST_ANCHOR)


class _Hashed:
    """A block's window hashes. Everything is by position in the block's row of words."""

    def __init__(self, block: B.Block, window: int) -> None:
        import xxhash

        self.block, self.window = block, window
        self.period = period_for(window)
        self.anchor = window - (self.period - 1)
        words = np.fromiter(map(xxhash.xxh3_64_intdigest, block.words), np.uint64, len(block.words))
        self.values = words[block.codes] if len(block.codes) else np.empty(0, np.uint64)
        self.doc = np.repeat(np.arange(len(block.sizes)), block.sizes)
        self.at = np.arange(len(block.codes)) - np.repeat(block.starts[:-1], block.sizes)
        self.left = np.repeat(block.sizes, block.sizes) - self.at  # words from here to the document's end

    def anchors(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Positions, distinct hashes, which of them each position has, how often each stands here."""
        held = np.isin(np.arange(self.period), COVERS[self.period])
        fits = (self.left >= self.anchor) & (np.repeat(self.block.sizes, self.block.sizes) >= self.window)
        places = np.flatnonzero(held[self.at % self.period] & fits)
        hashes = _windows(self.values, self.anchor, BASE_A)
        distinct, which, n = np.unique(hashes[places], return_inverse=True, return_counts=True)
        return places, distinct, which, n

    def candidates(self, places: np.ndarray, twice: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Starts of full windows that hold one of the anchors that stand elsewhere too.

        Gives (starts in the order of hash and then of document and start, their hashes,
        16 bits of a second hash, the first of each run of equal hashes).
        """
        size = len(self.values)
        marks = np.zeros(size + 1, np.int64)
        marks[1:][places[twice]] = 1
        total = np.cumsum(marks)
        ends = np.minimum(np.arange(size) + self.period, size)
        starts = np.flatnonzero((self.left >= self.window) & (total[ends] > total[:size]))
        a, b = _windows(self.values, self.window, BASE_A)[starts], _windows(self.values, self.window, BASE_B)[starts]
        order = np.lexsort((starts, self._rank()[self.doc[starts]], b, a))
        starts, a, b = starts[order], a[order], b[order]
        first = np.ones(len(a), bool)
        first[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        return starts, a, b, first

    def _rank(self) -> np.ndarray:
        """The order of documents by id; null ids come last, rows of the same id by position."""
        ids = np.where(self.block.ids == B.NO_ID, np.iinfo(np.int64).max, self.block.ids)
        rank = np.empty(len(ids), np.int64)
        rank[np.argsort(ids, kind="stable")] = np.arange(len(ids))
        return rank


def _part_rows(block: int, part: np.ndarray, make) -> pa.RecordBatch:  # noqa: ANN001
    """A row for each part that occurs in part, which is in order: make gets the bounds."""
    cuts = np.flatnonzero(np.diff(part.astype(np.int64), prepend=-1, append=-1)) if len(part) else np.zeros(1, int)
    spans = list(zip(cuts[:-1].tolist(), cuts[1:].tolist()))
    return pa.record_batch(
        {"part": pa.array([int(part[a]) for a, _ in spans], pa.int32()), "block": pa.array([block] * len(spans), pa.int64()), "data": pa.array([make(a, b) for a, b in spans], pa.binary())}
    )


def _bits(answers: list[dict], part: np.ndarray) -> np.ndarray:
    """One bit for each entry; part is the entries' part, in order."""
    out = np.zeros(len(part), bool)
    for row in answers:
        a, b = np.searchsorted(part, [row["part"], row["part"] + 1])
        out[a:b] = np.unpackbits(np.frombuffer(row["data"], np.uint8), count=b - a).astype(bool)
    return out


SHORT = np.uint64((1 << 40) - 1)


def _anchor_order(hashes: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    part = ((hashes >> np.uint64(40)) % np.uint64(parts)).astype(np.int64)
    order = np.lexsort((hashes & SHORT, part))
    return order, part[order]


def _anchor_answer(rows: list[dict]) -> list[bytes]:
    lists = [np.cumsum(B.unpack(r["data"], np.uint64)) for r in rows]
    every = np.concatenate(lists)
    _, which, n = np.unique(every, return_inverse=True, return_counts=True)
    return [np.packbits(x).tobytes() for x in np.split(n[which] > 1, np.cumsum([len(x) for x in lists])[:-1])]


def _window_answer(rows: list[dict]) -> list[bytes]:
    """For each window of each block whether another block holds it earlier."""
    got = []
    for r in rows:
        n, m = int.from_bytes(r["data"][:4], "little"), int.from_bytes(r["data"][4:8], "little")
        at = r["data"][8:]
        got.append((np.cumsum(B.unpack(at[:n], np.uint64)), B.unpack(at[n : n + m], np.uint16), B.unpack(at[n + m :], np.int64)))
    sizes = [len(a) for a, _, _ in got]
    a, b, ids = (np.concatenate([g[i] for g in got]) for i in range(3))
    order = np.lexsort((np.repeat(np.arange(len(sizes)), sizes), ids, b, a))
    later = np.zeros(len(a), bool)
    later[order[1:]] = (a[order[1:]] == a[order[:-1]]) & (b[order[1:]] == b[order[:-1]])
    return [np.packbits(x).tobytes() for x in np.split(later, np.cumsum(sizes)[:-1])]


def split_words(text: str) -> list[bytes]:
    """Runs of anything but [\x20\x09-\x0D]: exactly what bytes.split() takes for white space."""
    return text.encode().split()


def substring_dedup(docs: DataFrame, *, window: int = 20, id_col: str = "doc_id", text_col: str = "text", block_chars: int = B.BLOCK_CHARS) -> DataFrame:
    """One row (id, n_words, n_removed, text) for each row of docs.

    A window is `window` consecutive words of one document. Each word covered by a window
    whose word sequence also starts earlier (smaller id, or same document, earlier start)
    goes; the others stay, joined by one space. Windows are judged on the input.

    A null or empty text has no words. Rows with the same id count in the order in which
    they are read, null ids after all others. Other columns play no part.
    """
    if window < 2:
        raise ValueError("window must be 2 or more")
    table = B.make_blocks(docs, split_words, "substrings", id_col=id_col, text_col=text_col, block_chars=block_chars)
    total = table.agg(F.sum("n_tokens")).first()[0] or 0
    period = period_for(window)
    parts = B.parts_for(total * len(COVERS[period]) // period, PART_HASHES)
    entry = "part int, block long, data binary"

    def send_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                _, hashes, _, _ = _Hashed(B.Block(row), window).anchors()
                order, part = _anchor_order(hashes, parts)
                short = hashes[order] & SHORT
                yield _part_rows(row["block"], part, lambda a, b: B.pack(np.diff(short[a:b], prepend=np.uint64(0))))

    def repeated(hashed: _Hashed, answers: list[dict]) -> tuple[np.ndarray, ...]:
        places, distinct, which, n = hashed.anchors()
        order, part = _anchor_order(distinct, parts)
        twice = n > 1
        twice[order] |= _bits(answers, part)
        starts, a, b, first = hashed.candidates(places, twice[which])
        fa, fb = a[first], b[first]
        part = (fb >> np.uint64(16)) % np.uint64(parts)
        order = np.lexsort((fa, part))
        return starts, first, fa, fb, order, part[order].astype(np.int64)

    def send_windows(block: B.Block, answers: list[dict]) -> Iterator[pa.RecordBatch]:
        hashed = _Hashed(block, window)
        starts, first, fa, fb, order, part = repeated(hashed, answers)
        ids = np.where(block.ids == B.NO_ID, np.iinfo(np.int64).max, block.ids)[hashed.doc[starts[first]]][order]
        fa, fb = fa[order], (fb[order] & np.uint64(0xFFFF)).astype(np.uint16)

        def data(a: int, b: int) -> bytes:
            x, y = B.pack(np.diff(fa[a:b], prepend=np.uint64(0))), B.pack(fb[a:b])
            return len(x).to_bytes(4, "little") + len(y).to_bytes(4, "little") + x + y + B.pack(ids[a:b])

        yield _part_rows(block.block, part, data)

    def remove(block: B.Block, answers: list[dict]) -> Iterator[dict]:
        hashed = _Hashed(block, window)
        starts, first, _, _, order, part = repeated(hashed, [r for r in answers if not r["last"]])
        later = np.zeros(len(order), bool)
        later[order] = _bits([r for r in answers if r["last"]], part)
        run = np.cumsum(first) - 1
        cut = starts[~first | later[run]] if len(starts) else starts
        edges = np.zeros(len(hashed.values) + 1, np.int64)
        np.add.at(edges, cut, 1)
        np.add.at(edges, cut + window, -1)
        keep = np.cumsum(edges)[:-1] == 0
        for k, doc_id in enumerate(block.ids.tolist()):
            span = slice(block.starts[k], block.starts[k + 1])
            left = block.codes[span][keep[span]].tolist()
            yield {"id": None if doc_id == B.NO_ID else doc_id, "n_words": int(block.sizes[k]), "n_removed": int(block.sizes[k]) - len(left), "text": b" ".join([block.words[c] for c in left]).decode()}

    def rows_of(batches: list[pa.RecordBatch]) -> pa.Table:
        return pa.Table.from_batches(batches, pa.schema([("part", pa.int32()), ("block", pa.int64()), ("data", pa.binary())]))

    def texts_of(rows: list[dict]) -> pa.Table:
        return pa.Table.from_pylist(rows, pa.schema([("id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("text", pa.string())]))

    anchors = written(B.ask(table.select("block", "ids", "sizes", "codes", "words").mapInArrow(send_anchors, entry), _anchor_answer), "anchors")
    windows = B.ask(B.tell(table, anchors, send_windows, entry, rows_of), _window_answer)
    answers = anchors.withColumn("last", F.lit(False)).unionByName(windows.withColumn("last", F.lit(True)))
    return B.tell(table, answers, remove, "id long, n_words long, n_removed long, text string", texts_of).withColumnRenamed("id", id_col)
