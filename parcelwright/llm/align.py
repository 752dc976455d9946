"""Edit distance of integer sequences, decided within a band."""

from __future__ import annotations

from bisect import bisect_left

import numpy as np


def banded(a: np.ndarray, b: np.ndarray, band: int) -> int:
    """The edit distance of a and b if it is at most band, else band + 1."""
    n, m = len(a), len(b)
    if abs(n - m) > band:
        return band + 1
    width = 2 * band + 1
    offset = np.arange(width)
    far = n + m + 1
    row = np.where(offset >= band, offset - band, far)  # cell k of row i is column i + k - band
    row[offset - band > m] = far
    same = np.zeros(width, bool)
    for i in range(1, n + 1):
        columns = i + offset - band
        lo = i - band - 1
        same[:] = False
        s, e = max(0, lo), min(m, lo + width)
        if s < e:
            same[s - lo : e - lo] = b[s:e] == a[i - 1]
        up = np.append(row[1:], far) + 1
        new = np.minimum(row + ~same, up)
        new[(columns < 0) | (columns > m)] = far
        if i <= band:
            new[band - i] = i
        row = np.minimum.accumulate(new - offset) + offset
        row[(columns < 0) | (columns > m)] = far
        if row.min() > band:
            return band + 1
    return int(min(row[m - n + band], band + 1))


#: Cells of a band that are held at once.
CELLS = 400_000


def within_many(a: np.ndarray, others: list[np.ndarray], limits: np.ndarray) -> np.ndarray:
    """Whether the edit distance of a and each of others is at most its limit, in one band for all."""
    out = np.zeros(len(others), bool)
    sizes = np.fromiter(map(len, others), np.int64, len(others))
    left = np.flatnonzero(np.abs(sizes - len(a)) <= limits)
    if not len(left):
        return out
    n, band = len(a), max(1, int(limits[left].max()))
    width, far = 2 * band + 1, np.int32(1 << 28)
    offset = np.arange(width, dtype=np.int32)
    for part in np.array_split(left, -(-len(left) * width // CELLS)):
        b = np.full((len(part), n + 2 * band + 1), -1, np.int64)
        for k, o in enumerate(part.tolist()):
            x = others[o][: n + band + 1]
            b[k, band : band + len(x)] = x
        row = np.broadcast_to(np.where(offset >= band, offset - band, far), (len(part), width)).astype(np.int32)
        for i in range(1, n + 1):
            new = row + (b[:, i - 1 : i - 1 + width] != a[i - 1])
            np.minimum(new[:, :-1], row[:, 1:] + 1, out=new[:, :-1])
            if i <= band:  # columns before the text
                new[:, : band - i], new[:, band - i] = far, i
            row = np.minimum.accumulate(new - offset, axis=1) + offset
            if i % 16 == 0:
                good = row.min(axis=1) <= limits[part]
                if not good.all():
                    row, b, part = row[good], b[good], part[good]
                    if not len(part):
                        break
        out[part] = row[np.arange(len(part)), sizes[part] - n + band] <= limits[part]
    return out


def _runs(a: np.ndarray, k: int) -> np.ndarray:
    """A hash for each run of k values."""
    out = np.zeros(len(a) - k + 1, np.uint64)
    for i in range(k):
        out = (out ^ a[i : len(a) - k + 1 + i].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out


def _bag_distance(a: np.ndarray, b: np.ndarray) -> int:
    """How many values one sequence has beyond the other, whatever their order."""
    _, n = np.unique(np.concatenate((a, b)), return_inverse=True)
    apart = np.bincount(n[: len(a)], minlength=len(a) + len(b)) - np.bincount(n[len(a) :], minlength=len(a) + len(b))
    return int(max(np.maximum(apart, 0).sum(), np.maximum(-apart, 0).sum()))


def _matched(a: np.ndarray, b: np.ndarray, k: int) -> int:
    """An upper bound of the edit distance, from runs of k values that stand once in both in the same order."""
    ua, ia, ca = np.unique(_runs(a, k), return_index=True, return_counts=True)
    ub, ib, cb = np.unique(_runs(b, k), return_index=True, return_counts=True)
    common, x, y = np.intersect1d(ua[ca == 1], ub[cb == 1], assume_unique=True, return_indices=True)
    if not len(common):
        return max(len(a), len(b))
    pa, pb = ia[ca == 1][x], ib[cb == 1][y]
    order = np.argsort(pa)
    pa, pb = pa[order], pb[order]
    if (np.diff(pb) < 0).any():  # the longest rising run of positions
        tails, at, back = [], [], np.full(len(pb), -1)
        for n, v in enumerate(pb.tolist()):
            j = bisect_left(tails, v)
            tails[j : j + 1], at[j : j + 1] = [v], [n]
            back[n] = at[j - 1] if j else -1
        keep, n = [], at[-1]
        while n >= 0:
            keep.append(n)
            n = back[n]
        pa, pb = pa[keep[::-1]], pb[keep[::-1]]
    # Each value of a run is matched, as far as the runs agree on it.
    pa, first = np.unique((pa[:, None] + np.arange(k)).reshape(-1), return_index=True)
    pb = (pb[:, None] + np.arange(k)).reshape(-1)[first]
    rising = np.concatenate(([True], pb[1:] > np.maximum.accumulate(pb)[:-1]))
    pa, pb = pa[rising], pb[rising]
    gaps = np.maximum(np.diff(pa, prepend=-1, append=len(a)), np.diff(pb, prepend=-1, append=len(b))) - 1
    return int(gaps.sum())


def within(a: np.ndarray, b: np.ndarray, limit: int) -> bool:
    """Whether the edit distance of a and b is at most limit."""
    if abs(len(a) - len(b)) > limit:
        return False
    k = min(len(a), len(b))
    differ = np.flatnonzero(a[:k] != b[:k])
    if len(differ) + abs(len(a) - len(b)) <= limit:
        return True
    head = int(differ[0])
    a, b, k = a[head:], b[head:], k - head
    differ = np.flatnonzero(a[len(a) - k :] != b[len(b) - k :])
    tail = k - 1 - int(differ[-1]) if len(differ) else k
    a, b = a[: len(a) - tail], b[: len(b) - tail]
    if max(len(a), len(b)) <= limit:
        return True
    if _bag_distance(a, b) > limit:
        return False
    # An edit takes two neighbours from their places at most.
    if min(len(a), len(b)) > 2 and _bag_distance(_runs(a, 2), _runs(b, 2)) > 2 * limit:
        return False
    if min(len(a), len(b)) > 3 and min(_matched(a, b, 3), _matched(a, b, 1)) <= limit:
        return True
    band = 16
    while band < limit:
        if banded(a, b, band) <= band:
            return True
        band *= 2
    return banded(a, b, limit) <= limit


def best_place(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """The least edit distance of item to any stretch of text, and that stretch's bounds."""
    n, m = len(item), len(text)
    row = np.zeros(m + 1, np.int64)
    start = np.arange(m + 1)
    column = np.arange(m + 1)
    for i in range(1, n + 1):
        cost = row[:-1] + (text != item[i - 1])
        up = row[1:] + 1
        new = np.empty(m + 1, np.int64)
        new[0], new[1:] = i, np.minimum(cost, up)
        begin = np.empty(m + 1, np.int64)
        begin[0], begin[1:] = 0, np.where(cost <= up, start[:-1], start[1:])
        level = new - column
        least = np.minimum.accumulate(level)
        source = np.maximum.accumulate(np.where(level == least, column, 0))
        row, start = least + column, begin[source]
    end = int(np.argmin(row))
    return int(row[end]), int(start[end]), end
