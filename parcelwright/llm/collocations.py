"""Collocations: phrases of two to four words that stand together more often than apart.

Texts are packed into blocks of one language. Words of min_count occurrences and more get a number,
and the numbers go back to the blocks; any other word, and the end of a piece, breaks what stands
about it, since no frequent phrase can hold it. Each block packs its runs of two to four numbers
into fixed 16-byte keys, counts equal ones (radix sort, run lengths) and sends each range of keys
to the task that merges that range in the same way. Ranges are cut by a bounded sample, which only
balances tasks. A word or phrase that stands everywhere is one entry for each block.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .blocks import BLOCK_CHARS, pack, pack_words, parts_for, unpack, unpack_words
from .bpe import by_part
from .common import spread_join, thinned, written

#: Entries of word lists in one part; the block number of a part's dictionary.
PART_WORDS, DICTIONARY = 150_000, -1
#: Words of the longest phrase; a key has room for so many numbers of 32 bits.
LONGEST = 4
#: Entries of the key ranges that one task merges.
RANGE_KEYS = 1_500_000
#: Ranges at most; where more would be needed, keys of a range are dealt out by hash as well.
MOST_RANGES = 8_192
#: Blocks that are sampled for the bounds of ranges, and keys taken from each.
SAMPLED, SAMPLES = 256, 128
#: Rows of a language that one task ranks.
RANKED = 50_000
BREAK = b"\xff"
#: A to Z in lower case, ends of pieces as a byte that no text holds, tab as space.
_BYTES = bytes(255 if chr(b) in ".,;:!?\n\x0b\x0c\r" else 32 if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256))
_BLOCKS = "block long, lang string, n_tokens long, n_words long, codes binary, words binary, counts binary"
WORDS = [f"w{k}" for k in range(1, LONGEST + 1)]


def tokens(text: str) -> list[bytes]:
    """Lower-cased words, and BREAK where a piece ends."""
    return text.encode().translate(_BYTES).replace(BREAK, b" \xff ").split()


def _packed(block_chars: int):  # noqa: ANN202
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, seq = TaskContext.get().partitionId() << 32, count()
        open_: dict[str, tuple] = {}
        held: defaultdict = defaultdict(int)

        def row(lang: str) -> pa.RecordBatch:
            index, codes = open_.pop(lang)
            del held[lang]
            flat = np.concatenate(codes)
            counts = np.bincount(flat, minlength=len(index))[1:].astype(np.uint32)
            values = [number + next(seq), lang, int(counts.sum()), len(counts), pack(flat), pack_words(list(index)[1:]), pack(counts)]
            types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types)], names=[c.split()[0] for c in _BLOCKS.split(", ")])

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py()
                if lang not in open_:
                    index: defaultdict = defaultdict(count().__next__)
                    index[BREAK]  # is 0
                    open_[lang] = (index, [])
                index, codes = open_[lang]
                found = tokens(text)
                found.append(BREAK)
                codes.append(np.fromiter(map(index.__getitem__, found), np.uint32, len(found)))
                held[lang] += len(text) + 1
                while sum(held.values()) > block_chars:
                    yield row(max(held, key=held.__getitem__))
        for lang in list(open_):
            yield row(lang)

    return run


def _sent(parts: int):  # noqa: ANN202
    """The words of blocks with their counts, dealt out by word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                words, counts = unpack_words(row["words"]), unpack(row["counts"], np.uint32)
                order, part = by_part(words, parts)
                cuts = np.flatnonzero(np.diff(part, prepend=-1, append=-1)) if len(part) else []
                out = []
                for a, b in zip(cuts[:-1], cuts[1:]):
                    some = pack(counts[order[a:b]])
                    out.append((int(part[a]), len(some).to_bytes(4, "little") + some + pack_words([words[k] for k in order[a:b].tolist()])))
                n = len(out)
                yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in out], pa.int32()), pa.array([row["block"]] * n, pa.int64()), pa.array([row["lang"]] * n, pa.string()), pa.array([d for _, d in out], pa.binary())], names=["part", "block", "lang", "data"])

    return run


def _numbered(sent: DataFrame, parts: int, min_count: int) -> DataFrame:
    """(block, part, lang, data): for each list of words that a block sent, their numbers (0 for a word of
    fewer than min_count occurrences), and, as block DICTIONARY, the words that have one. A part
    numbers its own words, the most frequent first, so that nothing has to be counted over all parts."""

    def run(group: pa.Table) -> pa.Table:
        part, rows, totals = group.column("part")[0].as_py(), [], defaultdict(int)
        for block, lang, data in zip(*(group.column(c).to_pylist() for c in ("block", "lang", "data"))):
            n = int.from_bytes(data[:4], "little")
            words = unpack_words(data[4 + n :])
            rows.append((block, lang, words))
            for w, c in zip(words, unpack(data[4 : 4 + n], np.uint32).tolist()):
                totals[lang, w] += c
        often = sorted((k for k, c in totals.items() if c >= min_count), key=lambda k: (-totals[k], k))
        if len(often) * parts >= 1 << 32:
            raise ValueError("more frequent words than a key has room for")
        number = {k: i * parts + part + 1 for i, k in enumerate(often)}
        out = [(block, lang, pack(np.array([number.get((lang, w), 0) for w in words], np.uint32))) for block, lang, words in rows]
        for lang in {lang for lang, _ in often}:
            own = [k for k in often if k[0] == lang]
            facts = pack(np.array([[number[k], totals[k]] for k in own], np.int64).T.copy().reshape(-1))
            out.append((DICTIONARY, lang, len(facts).to_bytes(4, "little") + facts + pack_words([w for _, w in own])))
        return pa.table({"block": pa.array([o[0] for o in out], pa.int64()), "part": pa.array([part] * len(out), pa.int32()), "lang": pa.array([o[1] for o in out], pa.string()), "data": pa.array([o[2] for o in out], pa.binary())})

    return sent.groupBy("part").applyInArrow(run, "block long, part int, lang string, data binary")


def _dictionary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            n = int.from_bytes(row["data"][:4], "little")
            ids, totals = unpack(row["data"][4 : 4 + n], np.int64).reshape(2, -1)
            words = unpack_words(row["data"][4 + n :])
            yield pa.RecordBatch.from_arrays([pa.array([row["lang"]] * len(words), pa.string()), pa.array(words, pa.binary()).cast(pa.string()), pa.array(ids), pa.array(totals)], names=["lang", "word", "id", "a"])


def radix_order(keys: np.ndarray) -> np.ndarray:
    """The order of keys (rows of uint32, first column first): one counting pass for each 16-bit digit that varies."""
    order = np.arange(len(keys))
    digits = np.ascontiguousarray(keys).view(np.uint16)  # low half, then high half of each number
    for word in reversed(range(keys.shape[1])):
        for digit in (2 * word, 2 * word + 1):
            column = digits[:, digit]
            if len(column) and (column != column[0]).any():
                order = order[np.argsort(column[order], kind="stable")]
    return order


def run_lengths(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sums of their counts."""
    if not len(keys):
        return keys, counts
    order = radix_order(keys)
    keys, counts = keys[order], counts[order]
    starts = np.flatnonzero(np.concatenate(([True], (keys[1:] != keys[:-1]).any(axis=1))))
    return keys[starts], np.add.reduceat(counts, starts)


def ngrams(ids: np.ndarray) -> np.ndarray:
    """Keys of all runs of 2 to LONGEST numbers without a 0 between."""
    keys, whole = [], ids > 0
    for n in range(2, LONGEST + 1):
        whole = whole[:-1] & (ids[n - 1 :] > 0) if len(whole) > 1 else whole[:0]
        at = np.flatnonzero(whole)
        key = np.zeros((len(at), LONGEST), np.uint32)
        for k in range(n):
            key[:, k] = ids[at + k]
        keys.append(key)
    return np.concatenate(keys)


def _pack_run(keys: np.ndarray, counts: np.ndarray) -> bytes:
    first = np.diff(keys[:, 0], prepend=np.uint32(0))
    size = pack(counts.astype(np.uint64))
    return len(size).to_bytes(8, "little") + size + pack(np.concatenate([first, *keys[:, 1:].T]).astype(np.uint32))


def _unpack_run(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = int.from_bytes(data[:8], "little")
    counts = unpack(data[8 : 8 + n], np.uint64).astype(np.int64)
    keys = np.ascontiguousarray(unpack(data[8 + n :], np.uint32).reshape(LONGEST, -1).T)
    keys[:, 0] = np.cumsum(keys[:, 0])
    return keys, counts


def _halves(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    wide = keys.astype(np.uint64)
    return wide[:, 0] << np.uint64(32) | wide[:, 1], wide[:, 2] << np.uint64(32) | wide[:, 3]


def _bounds(keys: np.ndarray, splits: np.ndarray) -> np.ndarray:
    """Where ordered keys go past each split."""
    (high, low), (sh, sl) = _halves(keys), _halves(splits)
    a, b = np.searchsorted(high, sh, "left"), np.searchsorted(high, sh, "right")
    return np.array([i + np.searchsorted(low[i:j], s, "left") if j > i else i for i, j, s in zip(a.tolist(), b.tolist(), sl)], np.int64)


def _blocks_of(docs: DataFrame, text_col: str, lang_col: str, block_chars: int) -> DataFrame:
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return written(rows.mapInArrow(_packed(block_chars), _BLOCKS), "phrases")


def _runs(blocks: DataFrame, numbers: DataFrame, parts: int) -> DataFrame:
    """(block, n, data): the counted keys of each block, in order."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        found = [d for _, d in sorted(zip(right.column("part").to_pylist(), right.column("data").to_pylist()))]
        ids = np.concatenate([unpack(d, np.uint32) for d in found]) if found else np.empty(0, np.uint32)
        out = []
        for row in left.to_pylist():
            order, _ = by_part(unpack_words(row["words"]), parts)
            known = np.zeros(len(order) + 1, np.uint32)  # 0 is BREAK
            known[order + 1] = ids
            keys = ngrams(known[unpack(row["codes"], np.uint32)])
            keys, counts = run_lengths(keys, np.ones(len(keys), np.int64))
            if len(keys):
                out.append((row["block"], len(keys), _pack_run(keys, counts)))
        return pa.table({"block": pa.array([o[0] for o in out], pa.int64()), "n": pa.array([o[1] for o in out], pa.int64()), "data": pa.array([o[2] for o in out], pa.binary())})

    return blocks.select("block", "codes", "words").groupBy("block").cogroup(numbers.groupBy("block")).applyInArrow(run, "block long, n long, data binary")


def _splits(runs: DataFrame, ranges: int, blocks: int) -> np.ndarray:
    """Bounds of so many ranges of about equal weight, from a bounded sample of blocks."""

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                keys, _ = _unpack_run(row["data"])
                keys = keys[np.unique(np.linspace(0, len(keys) - 1, SAMPLES).astype(int))].astype(np.int64)
                yield pa.RecordBatch.from_arrays([*[pa.array(c) for c in keys.T], pa.array([row["n"] / len(keys)] * len(keys))], names=[*WORDS, "weight"])

    some = thinned(runs, blocks, SAMPLED, F.col("block")).orderBy(F.xxhash64("block")).limit(SAMPLED)
    rows = some.mapInArrow(sample, ", ".join(f"{w} long" for w in WORDS) + ", weight double").collect()
    if ranges < 2 or not rows:
        return np.zeros((0, LONGEST), np.uint32)
    keys, weight = np.array([r[:LONGEST] for r in rows], np.uint32), np.array([r[LONGEST] for r in rows])
    order = radix_order(keys)
    keys, upto = keys[order], np.cumsum(weight[order])
    at = np.searchsorted(upto, upto[-1] * np.arange(1, ranges) / ranges)
    return np.unique(keys[at], axis=0)


def _counted(runs: DataFrame, min_count: int, range_keys: int) -> DataFrame:
    """(w1 to w4, a): keys with min_count occurrences and more."""
    total, blocks = runs.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    wanted = max(16, -(-total // range_keys))
    ranges = min(wanted, MOST_RANGES)
    hashed = -(-wanted // ranges)
    splits = _splits(runs, ranges, blocks)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                keys, counts = _unpack_run(row["data"])
                cuts = [0, *_bounds(keys, splits).tolist(), len(keys)]
                high, low = _halves(keys)
                share = ((high * np.uint64(0x9E3779B97F4A7C15) ^ low * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(33)) % np.uint64(hashed)
                parts, data = [], []
                for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
                    for h in np.unique(share[a:b]).tolist():
                        own = a + np.flatnonzero(share[a:b] == h)
                        parts.append(k * hashed + h)
                        data.append(_pack_run(keys[own], counts[own]))
                yield pa.RecordBatch.from_arrays([pa.array(parts, pa.int32()), pa.array(data, pa.binary())], names=["part", "data"])

    def merge(group: pa.Table) -> pa.Table:
        found = [_unpack_run(d.as_py()) for d in group.column("data")]
        keys, counts = run_lengths(np.concatenate([k for k, _ in found]), np.concatenate([c for _, c in found]))
        often = counts >= min_count
        return pa.table({**{w: pa.array(keys[often, k].astype(np.int64)) for k, w in enumerate(WORDS)}, "a": pa.array(counts[often])})

    sent = runs.mapInArrow(send, "part int, data binary")
    return sent.groupBy("part").applyInArrow(merge, ", ".join(f"{w} long" for w in WORDS) + ", a long")


def _part(words: list[Column]) -> list[Column]:
    return [w if w is not None else F.lit(0).cast("long") for w in [*words, *[None] * (LONGEST - len(words))]]


def _exact(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(19,0)")


def _inside(found: DataFrame, percent: int) -> DataFrame:
    """found less the phrases that stand in a longer one nearly as often as they stand at all."""
    w = [F.col(x) for x in WORDS]
    pieces = []
    for n in range(3, LONGEST + 1):
        for size in range(2, n):
            pieces += [F.when(F.col("size") == n, F.struct(*[c.alias(x) for c, x in zip(_part(w[s : s + size]), WORDS)])) for s in range(n - size + 1)]
    longer = found.where("size > 2").select("a", F.explode(F.filter(F.array(*pieces), lambda p: p.isNotNull())).alias("p")).groupBy(*[F.col(f"p.{x}").alias(x) for x in WORDS]).agg(F.max("a").alias("longer"))
    kept = found.join(longer, WORDS, "left")
    return kept.where(F.col("longer").isNull() | (_exact("longer") * 100 < _exact("a") * percent)).drop("longer")


def _scored(found: DataFrame, parts: DataFrame, scale: int) -> DataFrame:
    """found with l, r and score of its weakest cut. parts: the counts of all phrases and words."""
    w = [F.col(x) for x in WORDS]
    cuts = []
    for n in range(2, LONGEST + 1):
        for k in range(1, n):
            first, rest = _part(w[:k]), _part(w[k:n])
            cuts.append(F.when(F.col("size") == n, F.struct(F.lit(k).alias("k"), *[c.alias(f"f{x}") for c, x in zip(first, WORDS)], *[c.alias(f"r{x}") for c, x in zip(rest, WORDS)])))
    rows = found.withColumn("c", F.explode(F.filter(F.array(*cuts), lambda c: c.isNotNull()))).select(*WORDS, "size", "a", "c.*").withColumn("by", F.xxhash64(*WORDS))
    # A part such as a common word belongs to many phrases.
    for side, name in (("f", "l"), ("r", "r")):
        rows = spread_join(rows, parts.select(*[F.col(x).alias(f"{side}{x}") for x in WORDS], F.col("a").alias(name)), [f"{side}{x}" for x in WORDS], "by")
    score = F.call_function("div", _exact("a") * F.lit(scale).cast("decimal(9,0)"), _exact("l") + _exact("r"))
    best = rows.withColumn("cut", F.struct(score.alias("score"), "k", "l", "r")).groupBy(*WORDS, "size", "a").agg(F.min("cut").alias("cut"))
    return best.select(*WORDS, "size", "a", "cut.l", "cut.r", "cut.score")


def _best(rows: DataFrame, top: int, total: int, ranked: int) -> DataFrame:
    """The first `top` rows of each language, ranked; crowded languages in rounds of so many rows a task."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salts = -(-total // ranked)
    while salts > 1:
        some = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(salts))).orderBy(*order)
        rows = rows.withColumn("rank", F.row_number().over(some)).where(F.col("rank") <= top).drop("rank")
        salts = -(-salts * top // ranked) if ranked > 2 * top else 1
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)


def collocations(
    docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", min_count: int = 30, inside_percent: int = 80, top: int = 2_000, scale: int = 2_000_000, block_chars: int = BLOCK_CHARS, range_keys: int = RANGE_KEYS, ranked: int = RANKED
) -> DataFrame:
    """Rows (lang, rank, phrase, a, l, r, n, score): the best `top` phrases of each language.

    A to Z are lower-cased, texts split into pieces at .,;:!? and line ends, pieces into words at
    spaces and tabs. a is how often a phrase of 2 to 4 words stands within pieces, l and r the
    counts of both sides of its weakest cut, score floor(scale * a / (l + r)), n all words of the
    language. Phrases that stand inside a longer one of inside_percent of their count and more are left out.

    A null text is empty, a null lang "und"; repeated rows count as often as they stand; an
    empty table, or one without phrases of min_count, gives no rows. Ties go by count, then by the
    phrase's bytes. Columns other than text and lang play no part. A text may have 2 GB at most.
    """
    blocks = _blocks_of(docs, text_col, lang_col, block_chars)
    total = blocks.agg(F.coalesce(F.sum("n_words"), F.lit(0))).first()[0]
    parts = parts_for(total, PART_WORDS)
    # min_count of a phrase is the least that its words have.
    numbers = written(_numbered(blocks.select("block", "lang", "words", "counts").mapInArrow(_sent(parts), "part int, block long, lang string, data binary"), parts, min_count), "numbers")
    dictionary = written(numbers.where(F.col("block") == DICTIONARY).mapInArrow(_dictionary, "lang string, word string, id long, a long"), "dictionary")
    runs = written(_runs(blocks, numbers.where(F.col("block") != DICTIONARY).select("block", "part", "data"), parts), "runs")
    size = sum(((F.col(x) > 0).cast("int") for x in WORDS[1:]), F.lit(1))
    found = written(_counted(runs, min_count, range_keys).withColumn("size", size), "found")
    single = dictionary.select(F.col("id").alias("w1"), *[F.lit(0).cast("long").alias(x) for x in WORDS[1:]], "a")
    parts = found.where(F.col("size") < LONGEST).select(*WORDS, "a").unionByName(single)
    scored = written(_scored(_inside(found, inside_percent), parts, scale), "scored")
    # Numbers back to words.
    place = F.posexplode(F.slice(F.array(*WORDS), F.lit(1), F.col("size")))
    words = spread_join(scored.select(*WORDS, place.alias("at", "id")).withColumn("by", F.xxhash64(*WORDS)), dictionary.select("id", "lang", "word"), ["id"], "by")
    phrase = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda s: s["word"]), " ")
    named = words.groupBy(*WORDS).agg(F.first("lang").alias("lang"), phrase.alias("phrase")).join(scored, WORDS)
    best = _best(named.select("lang", "phrase", "a", "l", "r", "score"), top, scored.count(), ranked)
    totals = blocks.groupBy("lang").agg(F.sum("n_tokens").alias("n"))
    return best.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
