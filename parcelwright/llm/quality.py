"""Quality classifier: gradient-boosted trees over statistics of the whole text.

Statistics are worked out once for every document and written (some 30 numbers each);
texts are not shuffled. The trees are fitted on the driver from a sample of labelled
rows whose size is bounded by max_rows, and applied to all rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out, thinned, written
from .gbt import fit

MAX_ROWS = 20_000

NAMES = (
    "chars", "letters", "upper", "digits", "spaces", "lines", "stops", "commas", "marks", "bars", "hashes", "signs", "high",
    "words", "word_chars", "long_words", "short_words", "distinct", "top_word", "same_next", "same_pair", "line_words", "short_lines", "same_lines", "word_signs", "caps_words", "entropy", "half_same",
)

_KINDS = np.zeros(256, np.uint8)
for _k, _chars in enumerate(("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789", " ", "\n", ".", ",", "!?", "|", "#", "*$%&@^~+=<>_/\\{}[]"), 1):
    for _c in _chars:
        _KINDS[ord(_c)] = _k
_KINDS[128:192], _KINDS[192:] = 12, 13  # later and first bytes of letters beyond ASCII


def statistics(text: str) -> list[float]:
    """The numbers named in NAMES for one text; an empty text has zeros."""
    raw = text.encode()
    n = len(raw)
    kinds = np.bincount(_KINDS[np.frombuffer(raw, np.uint8)], minlength=14) if n else np.zeros(14)
    chars = max(1, n - int(kinds[12]))
    letters = int(kinds[1] + kinds[2] + kinds[13])
    words = raw.split()
    m = max(1, len(words))
    index: dict[bytes, int] = {}
    codes = np.fromiter([index.setdefault(w, len(index)) for w in words], np.int64, len(words))
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    counts = np.bincount(codes) if len(words) else np.zeros(1)
    pairs = codes[:-1] * (len(index) + 1) + codes[1:]
    signs = np.fromiter([not w[-1:].isalnum() and w[-1] < 128 and w[-1:] not in b".,;:" for w in index], bool, len(index))
    caps = np.fromiter([len(w) > 1 and w.isupper() for w in index], bool, len(index))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    n_lines = max(1, len(lines))
    p = counts / m
    half = len(codes) // 2
    return [
        float(np.log1p(n)), letters / chars, float(kinds[1]) / max(1, letters), kinds[3] / chars, kinds[4] / chars, kinds[5] / m,
        kinds[6] / m, kinds[7] / m, kinds[8] / m, kinds[9] / m, kinds[10] / m, kinds[11] / m, kinds[13] / chars,
        float(np.log1p(len(words))), float(sizes.sum()) / m, float((sizes > 14).sum()) / m, float((sizes < 4).sum()) / m,
        len(index) / m, float(counts.max()) / m, float((codes[1:] == codes[:-1]).sum()) / m, 1 - len(np.unique(pairs)) / max(1, len(pairs)),
        len(words) / n_lines, sum(len(x) < 30 for x in lines) / n_lines, 1 - len(set(lines)) / n_lines,
        float(signs[codes].sum()) / m, float(caps[codes].sum()) / m, float(-(p * np.log2(p + 1e-12)).sum()) / np.log2(m + 1),
        float((codes[:half] == codes[half : 2 * half]).sum()) / max(1, half),
    ]


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x = np.array([statistics(t.as_py() or "") for t in batch.column(1)], np.float32).reshape(-1, len(NAMES))
        flat = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * len(NAMES), pa.int32()), pa.array(x.reshape(-1)))
        yield pa.RecordBatch.from_arrays([batch.column(0), flat], names=["id", "x"])


def score_quality(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", max_rows: int = MAX_ROWS, threshold: float = 0.3) -> DataFrame:
    """One row (id, held_out, score, predicted) for each row of docs.

    The trees learn from at most max_rows labelled documents that are not held out (those
    of the least hash of the id; see common.held_out). predicted is 1 where the score
    reaches threshold (a tie counts). A null text is scored as an empty one, a text of any
    length as a whole; a row without id is scored, and teaches nothing. Of several labels of an id the
    largest counts; null labels and labels without a document are left out. Without any
    label every score is 0.5. Repeated rows are scored alike and count once in training; an
    empty table gives no rows; other columns play no part, whatever their names.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    x = written(rows.mapInArrow(_measure, "id long, x array<float>"), "quality")
    known = labels.where(F.col(label_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("id")).agg(F.max(label_col).alias("y")).where(~held_out(F.col("id")))
    # A little over max_rows labels pass the hash, so they may be broadcast whatever the corpus,
    # and what partitions send to the driver is bounded by them all together.
    some = written(thinned(known, known.count(), max_rows, F.col("id")), "quality_labels")
    sample = x.join(F.broadcast(some), "id").dropDuplicates(["id", "x"]).orderBy(F.xxhash64("id"), "id", "x").limit(max_rows).toPandas()
    trees = fit(np.stack(sample["x"]).astype(np.float64) if len(sample) else np.zeros((0, len(NAMES))), (sample["y"] > 0).to_numpy(np.float64))
    model = spark.sparkContext.broadcast(trees)

    @F.pandas_udf("double")
    def scored(values: pd.Series) -> pd.Series:
        return pd.Series(model.value.score(np.stack(values).astype(np.float64)) if len(values) else [], dtype="float64")

    score = x.select("id", scored("x").alias("score"))
    return score.select(F.col("id").alias(id_col), held_out(F.col("id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
