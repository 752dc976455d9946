"""Language identification: Viterbi over word scores, with spans for mixed text.

A word's score in a language is its log likelihood under character n-grams of one to four
and whole words. Its script narrows the languages down to those that were seen in that
script. The best path over a text's words pays a penalty for each switch of language.

Each distinct word of a batch is scored once. Most texts need no dynamic program: if no
stretch of words favours another language by more than the penalty, the best path is one
language throughout, and that test is a few array operations.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out, written

MAX_ROWS = 20_000  # documents to learn from, dealt evenly to the languages
SWITCH = 12.0
SIZE = 1 << 17  # hashed n-grams of one order
ORDERS = 5  # the last one is the whole word
LEAST_SHARE = 0.005  # of a language's letters in a script, for the script to count as its own
OUTSIDE = -60.0
WORD = re.compile(r"[^\W\d_]+")
#: Words that a task remembers before it starts anew.
REMEMBERED = 300_000

# First code point of each range of scripts; what lies before the first is Latin.
SCRIPTS = (
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"), (0x0600, "arabic"), (0x0700, "other"),
    (0x0900, "devanagari"), (0x0980, "bengali"), (0x0A00, "gurmukhi"), (0x0A80, "gujarati"), (0x0B00, "other"), (0x0B80, "tamil"), (0x0C00, "telugu"),
    (0x0C80, "kannada"), (0x0D00, "malayalam"), (0x0D80, "sinhala"), (0x0E00, "thai"), (0x0E80, "lao"), (0x0F00, "tibetan"), (0x1000, "myanmar"),
    (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "ethiopic"), (0x13A0, "other"), (0x1780, "khmer"), (0x1800, "other"), (0x1E00, "latin"),
    (0x1F00, "greek"), (0x2000, "other"), (0x2C60, "latin"), (0x2C80, "other"), (0x3040, "kana"), (0x3100, "other"), (0x3400, "han"), (0xA000, "other"),
    (0xAC00, "hangul"), (0xD7B0, "other"), (0xF900, "han"), (0xFB00, "latin"), (0xFB1D, "hebrew"), (0xFB50, "arabic"), (0xFE00, "other"), (0x20000, "han"),
)
SCRIPT_STARTS = [s for s, _ in SCRIPTS]
SCRIPT_NAMES = sorted({n for _, n in SCRIPTS})


def script_of(word: str) -> int:
    return SCRIPT_NAMES.index(SCRIPTS[bisect_right(SCRIPT_STARTS, ord(word[0])) - 1][1])


def words_of(text: str) -> list[str]:
    """The words of a text, each in lower case."""
    low = text.lower()
    # A letter may become several in lower case; words are then cut from the text as it is.
    return WORD.findall(low) if len(low) == len(text) else [w.lower() for w in WORD.findall(text)]


def grams(words: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """For each order the hashed n-grams of all words, and the word of each."""
    text = "".join(f"\x02{w}\x03" for w in words)
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 2
    word = np.repeat(np.arange(len(words)), sizes)
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(points))
    keys, of = [], []
    rolling = np.zeros(len(points), np.uint64)
    for n in range(1, ORDERS):
        moved = np.zeros(len(points), np.uint64)
        moved[: len(points) - n + 1] = points[n - 1 :]
        rolling = (rolling ^ moved) * np.uint64(0x9E3779B97F4A7C15)
        rolling ^= rolling >> np.uint64(29)
        fits = left >= n
        keys.append((rolling[fits] >> np.uint64(20)).astype(np.int64) % SIZE)
        of.append(word[fits])
    import xxhash

    keys.append(np.fromiter((xxhash.xxh3_64_intdigest(w) % SIZE for w in words), np.int64, len(words)))
    of.append(np.arange(len(words)))
    return keys, of


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray  # order, bucket, language: log probability
    own: np.ndarray  # script, language: whether it is written in it

    def score(self, words: list[str]) -> np.ndarray:
        """A row for each word, a column for each language."""
        total = np.zeros((len(words), len(self.languages)), np.float32)
        for n, (keys, of) in enumerate(zip(*grams(words))):
            for k in range(len(self.languages)):
                total[:, k] += np.bincount(of, self.table[n, :, k][keys], len(words)).astype(np.float32)
        scripts = np.fromiter(map(script_of, words), np.int64, len(words))
        own = self.own[scripts]
        own[~own.any(axis=1)] = True
        return total / ORDERS + np.where(own, 0, OUTSIDE).astype(np.float32)


def best_path(scores: np.ndarray, switch: float = SWITCH) -> np.ndarray | int:
    """The best language of each word; a single number where it is the same for all."""
    best = int(scores.sum(axis=0).argmax())
    gain = np.cumsum(scores - scores[:, best : best + 1], axis=0, dtype=np.float64)
    low = np.minimum.accumulate(np.concatenate((np.zeros((1, gain.shape[1])), gain)), axis=0)[:-1]
    most = (gain - low).max()
    # No stretch of another language pays for a switch to it. A path that never uses the best
    # language makes one switch less than it has stretches; it can't gain as much either.
    if most <= switch:
        others = np.delete(scores, best, axis=1)
        if most <= switch / 2 or not others.size or (others.max(axis=1) - scores[:, best]).sum(dtype=np.float64) <= switch:
            return best
    value, back = scores[0].astype(np.float64), np.zeros(scores.shape, np.int16)
    stay = np.arange(scores.shape[1])
    for t in range(1, len(scores)):
        top = int(value.argmax())
        moved = value[top] - switch > value
        back[t] = np.where(moved, top, stay)
        value = np.where(moved, value[top] - switch, value) + scores[t]
    path = np.empty(len(scores), np.int64)
    at = int(value.argmax())
    for t in range(len(scores) - 1, -1, -1):
        path[t] = at
        at = back[t, at]
    return path


def _counted(languages: list[str]):  # noqa: ANN202
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((len(languages), ORDERS, SIZE), np.uint32)
        scripts = np.zeros((len(languages), len(SCRIPT_NAMES)), np.uint32)
        for batch in batches:
            held: dict[int, dict] = defaultdict(lambda: defaultdict(int))
            for text, lang in zip(batch.column(0), batch.column(1).to_pylist()):
                words = held[languages.index(lang)]
                for w in words_of(text.as_py() or ""):
                    words[w] += 1
            for k, words in held.items():
                if not words:
                    continue
                times = np.fromiter(words.values(), np.int64, len(words))
                keys, of = grams(list(words))
                for n in range(ORDERS):
                    totals[k, n] += np.bincount(keys[n], times[of[n]], SIZE).astype(np.uint32)
                weight = times * np.fromiter(map(len, words), np.int64, len(words))
                scripts[k] += np.bincount(np.fromiter(map(script_of, words), np.int64, len(words)), weight, len(SCRIPT_NAMES)).astype(np.uint32)
        press = zstandard.ZstdCompressor(level=1).compress
        yield pa.RecordBatch.from_arrays([pa.array([press(totals.tobytes())], pa.binary()), pa.array([press(scripts.tobytes())], pa.binary())], names=["totals", "scripts"])

    return run


def learn(docs: DataFrame, max_rows: int = MAX_ROWS) -> Model | None:
    """A model from docs (id, text, lang), of which at most max_rows are used."""
    known = docs.where(F.col("lang").isNotNull() & ~held_out(F.col("id"))).select("id", "lang")
    counts = {r.lang: r.n for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # one row a language
    languages = sorted(counts)
    if not languages:
        return None
    each = max(1, max_rows // len(languages))
    share = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, min(1.0, each / n))])
    # The hash decides row by row, so that a language with most of the rows is not gathered anywhere.
    lucky = F.pmod(F.xxhash64("id"), F.lit(1_000_003)) < F.try_element_at(share, F.col("lang")) * 1_000_003
    ids = known.where(lucky).select("id").distinct().orderBy(F.xxhash64("id"), "id").limit(max_rows)
    # ids has max_rows rows at most, so it may be broadcast whatever the corpus.
    sample = docs.where("lang is not null").join(F.broadcast(written(ids, "sample")), "id", "left_semi").select("text", "lang").repartition(8)
    totals = np.zeros((len(languages), ORDERS, SIZE))
    scripts = np.zeros((len(languages), len(SCRIPT_NAMES)))
    out = zstandard.ZstdDecompressor().decompress
    for row in sample.mapInArrow(_counted(languages), "totals binary, scripts binary").toLocalIterator():
        totals += np.frombuffer(out(row.totals), np.uint32).reshape(totals.shape)
        scripts += np.frombuffer(out(row.scripts), np.uint32).reshape(scripts.shape)
    table = np.log((totals + 0.3) / (totals.sum(axis=2, keepdims=True) + 0.3 * SIZE))
    own = scripts >= LEAST_SHARE * np.maximum(1, scripts.sum(axis=1, keepdims=True))
    return Model(languages, np.ascontiguousarray(table.transpose(1, 2, 0)).astype(np.float32), own.T)


def _label(text: str, words: list[str], codes: np.ndarray, scores: np.ndarray, languages: list[str], switch: float) -> tuple[str, float, list[dict]]:
    rows = scores[codes]
    total = rows.sum(axis=0, dtype=np.float64)
    path = best_path(rows, switch)
    if isinstance(path, int):
        return languages[path], float(1 / np.exp(np.minimum(total - total[path], 700)).sum()), [{"start": 0, "end": len(text), "lang": languages[path]}]
    letters = np.bincount(path, np.fromiter(map(len, words), np.int64, len(words)), len(languages))
    best = int(letters.argmax())
    places = [m.span() for m in WORD.finditer(text)]
    cuts = [0, *(np.flatnonzero(np.diff(path)) + 1).tolist(), len(path)]
    spans = [{"start": places[a][0], "end": places[b - 1][1], "lang": languages[path[a]]} for a, b in zip(cuts[:-1], cuts[1:])]
    return languages[best], float(letters[best] / letters.sum()), spans


def _predicted(shared, switch: float):  # noqa: ANN001, ANN202
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = shared.value
        index: defaultdict = defaultdict(count().__next__)
        scores = np.zeros((0, len(model.languages)), np.float32)
        for batch in batches:
            texts, found = [t.as_py() or "" for t in batch.column(1)], []
            for a in range(0, len(texts), 500):
                if len(index) > REMEMBERED:
                    index, scores = defaultdict(count().__next__), scores[:0]
                part = texts[a : a + 500]
                words = [words_of(t) for t in part]
                codes = [np.fromiter(map(index.__getitem__, w), np.int64, len(w)) for w in words]
                new = list(index)[len(scores) :]
                if new:
                    scores = np.concatenate((scores, model.score(new)))
                found += [_label(t, w, c, scores, model.languages, switch) if w else ("und", 0.0, []) for t, w, c in zip(part, words, codes)]
            spans = pa.array([f[2] for f in found], pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string())])))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64()), spans], names=["id", "lang_pred", "score", "spans"])

    return run


def identify(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", max_rows: int = MAX_ROWS, switch: float = SWITCH) -> DataFrame:
    """One row (id, held_out, lang_pred, score, spans) for each row of docs.

    The model learns from at most max_rows documents with a language that are not held out
    (see common.held_out). lang_pred is the language with most letters on the best path,
    score the share of them (for text in one language its posterior), spans the stretches
    (start, end, lang) in code points of the text as it is. Of languages of equal score the
    first by name is taken. A text that is null or has no letter is "und" with score 0 and no
    spans, and so is every text if no language was learned. A text of any length is read as a
    whole. A row without id is labelled, and teaches nothing. Repeated rows are labelled
    alike; an empty table gives no rows; other columns play no part, whatever their names.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    model = learn(rows, max_rows)
    if model is None:
        out = rows.select("id", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"), F.expr("cast(array() as array<struct<start:int,end:int,lang:string>>)").alias("spans"))
    else:
        out = rows.select("id", "text").mapInArrow(_predicted(spark.sparkContext.broadcast(model), switch), "id long, lang_pred string, score double, spans array<struct<start:int,end:int,lang:string>>")
    return out.select(F.col("id").alias(id_col), held_out(F.col("id")).alias("held_out"), "lang_pred", "score", "spans")
