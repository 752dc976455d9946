"""Toxicity: a support vector machine on a gapped string kernel, trained on sentences.

The kernel of two runs of characters is the weighted number of subsequences of four letters
that they share, within seven letters, a weight falling with each letter left out. So
"id-iot", "i.d.i.o.t" or "idxiot" stay close to "idiot", and a stem stays close to its
inflections. A sentence is taken by its pieces: its words, and its runs of short words that
stand side by side, whose blanks are gaps that cost nothing ("you id iot" holds "id iot").
No piece crosses the end of a sentence. The kernel of a sentence with a landmark is that of
its strongest piece, so an insult weighs the same in a long sentence and in a short one.

Nystroem landmarks (pieces of training sentences) approximate the kernel's feature space, in
which a linear SVM is trained with one row for a sentence: of a toxic document its worst
sentence counts as toxic, of a clean one all do as clean. Which sentence and piece is the
worst is settled in a few rounds of training and choosing; a toxic document without any that
stands out against chance (its label may be wrong) has none. All pieces of clean sentences are
counterexamples; each round solves for those that matter, adds those that break the margin
and solves again (until there are none, which is the solution for all of them, or SOLVED times).

The trained machine is a sum over landmarks, and each landmark is a sum over subsequences.
Both sums swap, so that scoring a piece takes one look-up for each of its subsequences, in
a table of fixed size, whatever the number of landmarks. Each distinct piece of a batch is
scored once.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out, thinned, written

MAX_ROWS = 4_000  # labelled documents to learn from, half of them toxic at most
DECAY = 0.5  # for each letter left out
SPAN = 7  # letters that a subsequence may stretch over
EDGE = 31  # stands before and after a piece
OTHER = 32  # letters of other scripts have classes from here on
LANDMARKS = 300
ROUNDS = 2
#: Subsequences of four of the first 32 classes, and of the hashed ones with other letters.
PLAIN, HASHED = 1 << 20, 1 << 20
TABLE = PLAIN + HASHED
#: Words of a sentence side by side are also read as one if they have so many characters
#: together at most and one of them is so short.
JOINED, PIECE = 9, 3
REMEMBERED = 1_000_000
STRETCHED = 6  # copies of a toxic piece with a letter put in, as further examples
WORKING = 4_000  # counterexamples to begin with
SOLVED = 5  # times at most that a round adds counterexamples and solves again
CALIBRATED = 4
SURE = 0.5  # score at which a piece explains a toxic document, which else teaches nothing
OFFSETS = [(a, b, c, DECAY ** (c - 3)) for a, b, c in combinations(range(1, SPAN), 3)]
SENTENCE = re.compile(r"[.!?]+\s+|\n+")
# Signs that are read as the letter they look like.
LOOKS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s"}


#: What is passed over anyway; leaving it out first makes fewer distinct pieces.
SILENT = bytes(p for p in range(33, 128) if not chr(p).isalnum() and chr(p) not in LOOKS)


def _classes() -> np.ndarray:
    """The class of each code point: 1 to 26 for a letter by its base or by its look, OTHER
    and more for letters of other scripts, 0 for what is passed over as if it were not there."""
    out = np.zeros(0x3000, np.int64)
    for p in range(0x3000):
        base = LOOKS.get(chr(p)) or unicodedata.normalize("NFKD", chr(p))[:1].lower()
        if "a" <= base <= "z":
            out[p] = ord(base) - 96
        elif chr(p).isalpha():
            out[p] = OTHER + p
    out[0xDF] = ord("s") - 96  # ß
    out[2] = out[3] = EDGE
    return out


CLASSES = _classes()


def _subsequences(pieces: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """For each shape of gaps: the piece and the number of each subsequence, and its weight."""
    text = "".join(f"\x02{w}\x03" for w in pieces)
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int64)
    kinds = np.where(points < len(CLASSES), CLASSES[np.minimum(points, len(CLASSES) - 1)], OTHER + points)
    piece = np.repeat(np.arange(len(pieces)), np.fromiter(map(len, pieces), np.int64, len(pieces)) + 2)
    piece, kinds = piece[kinds > 0], kinds[kinds > 0]
    left = np.cumsum(np.bincount(piece))[piece] - np.arange(len(piece))
    foreign = bool((kinds >= OTHER).any())
    starts = {c: np.flatnonzero(left > c) for c in range(3, SPAN)}
    owners = {c: piece[at] for c, at in starts.items()}
    for a, b, c, weight in OFFSETS:
        at = starts[c]
        w, x, y, z = kinds[at], kinds[at + a], kinds[at + b], kinds[at + c]
        number = (w << 15) | (x << 10) | (y << 5) | z
        if foreign:
            odd = np.flatnonzero((w | x | y | z) >= OTHER)
            w, x, y, z = w[odd], x[odd], y[odd], z[odd]
            mixed = ((w * 0x9E3779B1 + x) * 0x85EBCA6B + y) * 0xC2B2AE35 + z
            number[odd] = PLAIN + (((mixed ^ (mixed >> 29)) * 0x27D4EB2F >> 17) & (HASHED - 1))
        yield owners[c], number, weight


def _stretched(piece: str, rng: np.random.Generator) -> str:
    """The piece with a letter put in, as insults are written to slip through."""
    at = int(rng.integers(1, max(2, len(piece))))
    return piece[:at] + (piece[at - 1] if rng.random() < 0.3 else chr(97 + int(rng.integers(26)))) + piece[at:]


#: Pieces that are taken apart at once.
SLICE = 20_000


def word_scores(pieces: list[str], table: np.ndarray) -> np.ndarray:
    total = np.zeros(len(pieces))
    for a in range(0, len(pieces), SLICE):
        part = total[a : a + SLICE]
        for piece, number, weight in _subsequences(pieces[a : a + SLICE]):
            if len(piece):
                part += np.bincount(piece, table[number], len(part)) * weight
    return total


def _runs(pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The runs of four classes without gaps, piece by piece, and where each piece's begin."""
    numbers, counts = [np.empty(0, np.int32)], [np.zeros(1, np.int64)]
    for a in range(0, len(pieces), SLICE):
        part = pieces[a : a + SLICE]
        piece, number, _ = next(_subsequences(part))  # the first shape has no gaps
        numbers.append(number.astype(np.int32))
        counts.append(np.bincount(piece, minlength=len(part)))
    return np.concatenate(numbers), np.cumsum(np.concatenate(counts))


def _features(pieces: list[str], columns: np.ndarray, width: int) -> np.ndarray:
    """Weights of the subsequences that have a column, a row for each piece."""
    out = np.zeros((len(pieces), width), np.float32)
    for piece, number, weight in _subsequences(pieces):
        column = columns[number]
        hit = column >= 0
        np.add.at(out, (piece[hit], column[hit]), weight)
    return out


def _kernel(pieces: list[str], columns: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """Kernel values of pieces with landmarks, given as a row for each column of subsequences."""
    out = np.zeros((len(pieces), marks.shape[1]))
    for piece, number, weight in _subsequences(pieces):
        column = columns[number]
        piece, column = piece[column >= 0], column[column >= 0]
        if len(piece):
            first = np.flatnonzero(np.diff(piece, prepend=-1))
            out[piece[first]] += weight * np.add.reduceat(marks[column], first, axis=0)
    return out


class _Numbers(dict):
    """The number of each piece in the order that they came, given when it is first asked for."""

    def __init__(self) -> None:
        self.names: list[str] = []

    def __missing__(self, piece: str) -> int:
        self[piece] = n = len(self.names)
        self.names.append(piece)
        return n


def _put(values: np.ndarray, at: int, new: np.ndarray) -> np.ndarray:
    """values with new from place at on; room is doubled, so that many small additions cost little."""
    if at + len(new) > len(values):
        values = np.concatenate((values[:at], np.zeros(max(at + len(new), 2 * len(values)) - at, values.dtype)))
    values[at : at + len(new)] = new
    return values


class Pieces:
    """Numbers for words, and for the pieces that sentences are read as. Reading costs what the
    sentences hold, however many pieces are known."""

    def __init__(self) -> None:
        self.number = _Numbers()
        self.sizes, self.sized = np.zeros(0, np.int64), 0
        self.pairs: dict[int, int] = {}

    def read(self, sentences: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The number of each piece of the sentences, and the sentence it stands in."""
        words: list[str] = []
        counts = []
        for s in sentences:
            own = s.encode().translate(None, SILENT).decode().split()
            words += own
            counts.append(len(own))
        of = np.repeat(np.arange(len(sentences)), counts)
        number = self.number.__getitem__
        codes = np.fromiter(map(number, words), np.int64, len(words))
        new = self.number.names[self.sized :]
        self.sizes = _put(self.sizes, self.sized, np.fromiter(map(len, new), np.int64, len(new)))
        self.sized += len(new)
        sizes = self.sizes[codes]
        total = np.concatenate(([0], np.cumsum(sizes)))
        found, where = [codes], [of]
        at = np.arange(len(codes))
        n = 2
        while len(at := at[at + n <= len(codes)]):
            at = at[(total[at + n] - total[at] <= JOINED) & (of[at] == of[at + n - 1])]
            here = at[np.minimum(sizes[at], sizes[at + 1]) <= PIECE] if n == 2 else at
            if n == 2:
                keys, back = np.unique((codes[here] << 32) | codes[here + 1], return_inverse=True)
                keys = keys.tolist()
                names = self.number.names
                for key in keys:
                    if key not in self.pairs:
                        self.pairs[key] = number(names[key >> 32] + " " + names[key & 0xFFFFFFFF])
                found.append(np.fromiter(map(self.pairs.__getitem__, keys), np.int64, len(keys))[back])
            else:
                found.append(np.fromiter(map(number, [" ".join(words[i : i + n]) for i in here.tolist()]), np.int64, len(here)))
            where.append(of[here])
            n += 1
        return np.concatenate(found), np.concatenate(where)


def sentences_of(text: str | None) -> list[str]:
    return SENTENCE.split((text or "").lower())


@dataclass
class Model:
    table: np.ndarray
    bias: float
    slope: float
    shift: float

    def probability(self, raw: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * (raw + self.bias) + self.shift, -50, 50)))

    def of(self, texts: list[str | None]) -> np.ndarray:
        """The probability of label 1 for each text."""
        return self.probability(Scorer(self).worst(texts))


class Scorer:
    """Scores texts by their worst sentence; pieces met before are remembered."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self.pieces, self.known, self.scored = Pieces(), np.zeros(0), 0

    def worst(self, texts: list[str | None]) -> np.ndarray:
        if len(self.pieces.number) > REMEMBERED:
            self.pieces, self.known, self.scored = Pieces(), np.zeros(0), 0
        split = [sentences_of(t) for t in texts]
        found, sentence = self.pieces.read([s for d in split for s in d])
        if new := self.pieces.number.names[self.scored :]:
            self.known = _put(self.known, self.scored, word_scores(new, self.model.table))
            self.scored += len(new)
        doc = np.repeat(np.arange(len(texts)), [len(d) for d in split])[sentence] if len(sentence) else sentence
        out = np.full(len(texts), -np.inf)
        np.maximum.at(out, doc, self.known[found])
        return np.where(np.isfinite(out), out, -1.0 - self.model.bias)


def _svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, total: float, ridge: float = 1e-4, steps: int = 12) -> np.ndarray:
    """A linear machine with squared hinge loss, by Newton steps; the last column of x is 1.
    total is the weight of all rows, those left out of x (beyond the margin) included."""
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        margin = 1 - y * (x @ w)
        on = margin > 0
        grad, hess = ridge * w, ridge * np.eye(x.shape[1])
        for a in range(0, len(x), 2000):
            part = slice(a, a + 2000)
            rows, each = x[part][on[part]].astype(np.float64), (weight[part] / total)[on[part]]
            grad = grad - rows.T @ (each * (y * margin)[part][on[part]])
            hess = hess + (rows * each[:, None]).T @ rows
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


def _surprise(toxic: np.ndarray, clean: np.ndarray, share: float) -> np.ndarray:
    """How unlikely (minus log, at least) so many toxic ones among all that hold a run are."""
    n = np.maximum(1, toxic + clean).astype(float)
    q = np.clip(toxic / n, 1e-12, 1 - 1e-12)
    return np.where(q > share, n * (q * np.log(q / share) + (1 - q) * np.log((1 - q) / (1 - share))), 0)


def _platt(raw: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the probability: one half lies in the middle of the gap that parts
    the labels with the fewest errors, the slope is the likeliest of a few."""
    order = np.argsort(raw, kind="stable")
    x, ones, zeros = raw[order], (y * weight)[order], ((1 - y) * weight)[order]
    wrong = np.concatenate(([0], np.cumsum(ones))) + np.concatenate((np.cumsum(zeros[::-1])[::-1], [0]))
    gaps = np.concatenate(([0], np.diff(x), [0]))
    at = np.lexsort((-gaps, np.round(wrong, 6)))[0]
    cut = x[0] - 1 if at == 0 else x[-1] + 1 if at == len(x) else (x[at - 1] + x[at]) / 2

    def loss(slope: float) -> float:
        z = np.clip(slope * (raw - cut), -30, 30)
        return float((weight * (np.log1p(np.exp(z)) - y * z)).sum())

    slope = min((1.0, 2.0, 3.0, 5.0, 8.0), key=loss)
    return slope, -slope * float(cut)


class _Feature:
    """From pieces to Nystroem features about landmarks."""

    def __init__(self, marks: list[str]) -> None:
        numbers = np.unique(np.concatenate([n for _, n, _ in _subsequences(marks)]))
        self.numbers, self.columns = numbers, np.full(TABLE, -1, np.int32)
        self.columns[numbers] = np.arange(len(numbers))
        z = _features(marks, self.columns, len(numbers))
        z /= np.maximum(1e-9, np.linalg.norm(z, axis=1, keepdims=True))
        values, vectors = np.linalg.eigh((z @ z.T).astype(np.float64))
        keep = values > 1e-6 * values.max()
        self.root = vectors[:, keep] / np.sqrt(values[keep])  # from kernel values to features
        self.by_column = np.ascontiguousarray(z.T)

    def __call__(self, pieces: list[str]) -> np.ndarray:
        x = np.ones((len(pieces), self.root.shape[1] + 1), np.float32)
        for a in range(0, len(pieces), 2000):
            x[a : a + 2000, :-1] = _kernel(pieces[a : a + 2000], self.columns, self.by_column) @ self.root
        return x

    def table(self, w: np.ndarray) -> np.ndarray:
        out = np.zeros(TABLE, np.float32)
        out[self.numbers] = self.by_column @ (self.root @ w[:-1])
        return out


def train(examples: Iterable[tuple[list[str], int]]) -> Model:
    """A model from documents and their labels; a document is a list of sentences. Documents
    are read one by one; what is held of each are the numbers of its pieces by sentence."""
    pieces = Pieces()
    docs: list[np.ndarray] = []  # the distinct pieces of each document
    marked = []
    for sentences, label in examples:
        docs.append(np.unique(pieces.read(sentences)[0]).astype(np.int32))
        marked.append(label)
    labels = np.array(marked, np.int64)
    none = Model(np.zeros(TABLE, np.float32), 0.0, 1.0, float(np.log((labels.sum() + 0.5) / ((1 - labels).sum() + 0.5))))
    names = pieces.number.names
    del pieces
    if not names or labels.min() == labels.max():
        return none
    rng = np.random.default_rng(5)
    # Every CALIBRATED-th document of each label is kept for the probabilities, as pieces that were
    # trained on lie farther from the threshold than others do.
    toxic, clean = (np.delete(k, slice(None, None, CALIBRATED)) if len(k) >= 20 * CALIBRATED else k for k in (np.flatnonzero(labels == y) for y in (1, 0)))

    # First guess: pieces whose runs of four classes stand in more toxic documents than clean ones.
    number, bounds = _runs(names)
    seen = np.zeros((2, TABLE), np.float32)
    for k in np.concatenate((toxic, clean)).tolist():
        d, y = docs[k], int(labels[k])
        runs = [number[bounds[w] : bounds[w + 1]] for w in d.tolist()]
        if runs:
            seen[y][np.unique(np.concatenate(runs))] += 1
    odds = np.log((seen[1] + 0.5) / (len(toxic) + 1)) - np.log((seen[0] + 0.5) / (len(clean) + 1))
    # Labels may be wrong: a run counts if chance gives hardly one of all runs so many toxic documents.
    odds[_surprise(seen[1], seen[0], len(toxic) / (len(toxic) + len(clean))) < np.log(max(2, np.count_nonzero(seen[1])))] = -9
    score = np.full(len(names), -9.0)
    np.maximum.at(score, np.repeat(np.arange(len(names)), np.diff(bounds)), odds[number])
    del number, bounds, seen, odds
    sure = np.log(3)

    of_clean = np.bincount(np.concatenate([docs[k] for k in clean]), minlength=len(names))
    of_toxic = np.bincount(np.concatenate([docs[k] for k in toxic]), minlength=len(names))
    share = of_toxic / len(toxic) - of_clean / len(clean)
    # Only a piece that toxic documents hold far more often than clean ones can explain a label.
    barred = np.where(of_toxic / len(toxic) > 5 * of_clean / len(clean), 0.0, -1e9)
    background = np.flatnonzero(of_clean)
    hard = np.empty(0, np.int64)
    table, bias = none.table, 0.0
    for _ in range(ROUNDS):
        # The worst piece of a toxic document stands in its worst sentence.
        could = score + barred
        picked = np.array([d[could[d].argmax()] for d in (docs[k] for k in toxic) if len(d) and could[d].max() > sure], np.int64)
        if not len(picked):
            return none
        positive, times = np.unique(picked, return_counts=True)
        # A piece of a clean document may still be an insult: those seen mostly in toxic ones are not counterexamples.
        negative = np.setdiff1d(np.union1d(background, hard), positive[times > 2])
        top = positive[np.argsort(-times, kind="stable")][: LANDMARKS * 3 // 4]
        marks = np.concatenate((top, rng.choice(negative, min(len(negative), LANDMARKS - len(top)), replace=False)))
        feature = _Feature([names[k] for k in marks.tolist()])
        spread = [_stretched(names[k], rng) for k in top.tolist() for _ in range(STRETCHED)]
        each = np.sqrt(times) / np.sqrt(times).sum()
        virtual = 1.5 * np.repeat(each[np.argsort(-times, kind="stable")][: len(top)], STRETCHED) / STRETCHED
        wrong = feature([names[k] for k in positive.tolist()] + spread)
        weight = np.concatenate((each, virtual)) * len(negative)
        costs = np.where(np.isin(negative, hard), 4.0, 1.0)
        # Counterexamples beyond the margin cost nothing, so only those that break it are needed.
        working = np.union1d(rng.choice(len(negative), min(len(negative), WORKING), replace=False), np.flatnonzero(costs > 1))
        held = feature([names[k] for k in negative[working].tolist()])
        for _ in range(SOLVED):
            x = np.concatenate((wrong, held))
            y = np.concatenate((np.ones(len(wrong)), -np.ones(len(held))))
            w = _svm(x, y, np.concatenate((weight, costs[working])), float(weight.sum() + costs.sum()))
            table, bias = feature.table(w), float(w[-1])
            level = word_scores([names[k] for k in negative.tolist()], table) + bias
            broken = np.setdiff1d(np.flatnonzero(level > -1), working)
            if not len(broken):
                break
            # The worst first; the others come with the next solution if they still break it.
            broken = broken[np.argsort(-level[broken], kind="stable")][: 2 * WORKING]
            order = np.argsort(np.concatenate((working, broken)), kind="stable")
            held = np.concatenate((held, feature([names[k] for k in negative[broken].tolist()])))[order]
            working = np.concatenate((working, broken))[order]
        score = word_scores(names, table) + bias
        sure = SURE
        worst = np.unique(np.concatenate([d[np.argsort(-score[d])[:3]] for d in (docs[k] for k in clean)]))
        hard = np.union1d(hard, worst[(share[worst] <= 0.0005) & (score[worst] > -0.7)])
    # A label has its documents that were not trained on, or all where there are few.
    apart = [np.setdiff1d(np.flatnonzero(labels == y), k) for y, k in ((1, toxic), (0, clean))]
    apart = [a if len(a) else k for a, k in zip(apart, (toxic, clean))]
    raw = np.array([score[docs[k]].max() if len(docs[k]) else -1.0 for k in np.concatenate(apart).tolist()])
    # The stretched pieces are toxic texts of one piece here; together they weigh a tenth of the toxic documents.
    raw = np.concatenate((raw, word_scores(spread, table) + bias))
    label = np.repeat([1.0, 0.0, 1.0], [len(apart[0]), len(apart[1]), len(spread)])
    weight = np.repeat([1.0, 1.0, 0.1 * len(apart[0]) / max(1, len(spread))], [len(apart[0]), len(apart[1]), len(spread)])
    slope, shift = _platt(raw, label, weight)
    return Model(table, bias, slope, shift)


def _scored(shared):  # noqa: ANN001, ANN202
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in batches:
            texts = [t.as_py() for t in batch.column(1)]
            out = [scorer.worst(texts[a : a + 200]) for a in range(0, len(texts), 200)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(shared.value.probability(np.concatenate(out) if out else np.empty(0)))], names=["id", "score"])

    return run


def _distinct_sentences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text, y) to the distinct sentences of each text; what a document says twice it is not judged by twice."""
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array([list(dict.fromkeys(sentences_of(t.as_py()))) for t in batch.column(0)], pa.list_(pa.string())), batch.column(1)], names=["sentences", "y"])


def score_toxicity(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", max_rows: int = MAX_ROWS, threshold: float = 0.5) -> DataFrame:
    """One row (id, held_out, score, predicted) for each row of docs.

    The machine learns from the sentences of at most max_rows labelled documents that are not
    held out (see common.held_out), half of them of label 1 where there are enough, and scores
    the whole of every text, however long, by its worst sentence. predicted is 1 where the
    score reaches threshold (a tie counts). Null and empty texts score as texts without
    insults. Of several labels of an id the largest counts; null labels, labels without a
    document and rows without an id teach nothing, but a row without id is scored. Of several
    texts of an id the greatest is learned from. Without labels of both kinds every score is
    the same. Repeated rows are scored alike; an empty table gives no rows; other columns play
    no part, whatever their names.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    known = labels.where(F.col(label_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("id")).agg((F.max(label_col) > 0).cast("int").alias("y")).where(~held_out(F.col("id")))
    counts = {r.y: r.n for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}  # two rows at most
    half = [thinned(known.where(F.col("y") == y), counts.get(y, 0), max_rows // 2, F.col("id")).orderBy(F.xxhash64("id"), "id").limit(max_rows // 2) for y in (0, 1)]
    # The chosen ids are max_rows at most, so they may be broadcast whatever the corpus.
    chosen = written(half[0].unionByName(half[1]), "toxic_sample")
    sample = rows.join(F.broadcast(chosen), "id").groupBy("id", "y").agg(F.max("text").alias("text")).orderBy("id").select("text", "y")
    model = train((r.sentences, r.y) for r in sample.mapInArrow(_distinct_sentences, "sentences array<string>, y int").toLocalIterator())
    score = rows.mapInArrow(_scored(spark.sparkContext.broadcast(model)), "id long, score double")
    return score.select(F.col("id").alias(id_col), held_out(F.col("id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
