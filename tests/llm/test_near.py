"""Near duplicates, decontamination and components against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from parcelwright.llm import align, decontaminate, embedding_dedup, order_minhash, queries
from parcelwright.llm.common import plain_words
from parcelwright.llm.components import components
from parcelwright.llm.embedding_dedup import agreement, near_vectors, tables_for

from .cases import SCHEMA, documents, words


def distance(a, b):
    d = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        p, d[0] = d[0], i
        for j, y in enumerate(b, 1):
            p, d[j] = d[j], min(d[j] + 1, d[j - 1] + 1, p + (x != y))
    return d[-1]


def test_alignment():
    rng = np.random.default_rng(1)
    for t in range(300):
        a = rng.integers(0, rng.integers(2, 30), rng.integers(0, 20))
        b = rng.integers(0, 8, rng.integers(0, 20)) if t % 3 == 0 else np.insert(np.delete(a, slice(*sorted(rng.integers(0, len(a) + 1, 2)))), 0, rng.integers(0, 5, rng.integers(0, 4)))
        d, limit = distance(a.tolist(), b.tolist()), int(rng.integers(0, 12))
        assert align.banded(a, b, limit) == min(d, limit + 1)
        assert align.within(a, b, limit) == (d <= limit)
        many = [b, a, b[:-1], np.append(a, 3), a[::-1].copy()]
        limits = np.array([limit, 0, max(0, limit - 1), 1, limit])
        assert align.within_many(a, many, limits).tolist() == [distance(a.tolist(), x.tolist()) <= n for x, n in zip(many, limits)]
        if len(a):
            e, s, t_ = align.best_place(a, b)
            assert e == min(distance(a.tolist(), b[i:j].tolist()) for i in range(len(b) + 1) for j in range(i, len(b) + 1)) == distance(a.tolist(), b[s:t_].tolist())


def roots(ids, links):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {i: find(i) for i in ids}


def test_components(spark):
    rng = random.Random(4)
    links = [(rng.randint(0, 60), rng.randint(0, 60)) for _ in range(35)] + [(i, i + 1) for i in range(100, 140)] + [(200, k) for k in range(201, 230)] + [(5, 5)]
    want = roots({x for p in links for x in p}, links)
    got = {r.id: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert {i: got.get(i, i) for i in want} == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def variants(seed=7, n=30):
    """Documents with edited copies from nearly equal to clearly different."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        w = words(rng, rng.randint(30, 200), "abcdefghijklmnop")
        out.append(" ".join(w))
        for share in (0.01, 0.03, 0.3):
            v = list(w)
            for _ in range(max(1, int(len(v) * share))):
                k = rng.randrange(len(v))
                v[k : k + 1] = rng.choice([[], ["new"], [v[k], "more"]])
            out.append(" ".join(v))
    return out


def brute_classes(texts, threshold=0.8):
    """The class of each document by edit distance of all pairs."""
    words = [order_minhash.word_values(plain_words(t or "")) for t in texts]
    links = [(a, b) for a in range(len(words)) for b in range(a) if len(words[a]) and len(words[b]) and order_minhash.similar(words[a], words[b], threshold)]
    return roots(range(len(words)), links)


SHORT = ["a b c d e", "a b c d x", "a b c d", "a b q r", "one two three four five six seven eight nine ten", "one two three 4 five six 7 eight nine ten", "one two three 4 five 6 7 eight nine ten", "one", "One!", "one one"]


@pytest.mark.parametrize("texts", [[r[1] for r in documents()], variants(), SHORT, ["a b", "a b", "b a", "!!", "", None]])
def test_order_minhash(spark, texts):
    df = spark.createDataFrame([(i, t, "x", 0) for i, t in enumerate(texts)], "doc_id long, text string, kept string, id int")
    got = {r.doc_id: r for r in order_minhash.near_duplicates(df).collect()}
    assert {i: r.class_id for i, r in got.items()} == brute_classes(texts)
    assert all(r.kept == (r.doc_id == r.class_id) for r in got.values())


def test_similarity_is_that_of_words():
    rng = random.Random(12)
    for _ in range(100):
        a = rng.choices("abcdefgh", k=rng.randint(1, 25))
        b = [x for x in a if rng.random() > 0.1] + rng.choices("abxy", k=rng.randint(0, 4))
        if b:
            want = 1 - distance(a, b) / max(len(a), len(b)) >= 0.8 - 1e-9
            code = {w: k for k, w in enumerate("abcdefghxy")}
            assert order_minhash.similar(np.array([code[x] for x in a]), np.array([code[x] for x in b]), 0.8) == want


@pytest.mark.parametrize("n, least", [(20, (1, 0.97, 0.95, 0.9)), (50, (1, 1, 0.97, 0.95)), (200, (1, 0.98, 0.95, 0.85))])
def test_recall_by_length_and_share_of_changed_words(spark, n, least):
    """Pairs of n words of which 5, 10, 15 and 19 in 100, anywhere, are others, left out or put in."""
    rng = random.Random(n)
    texts = []
    for share in (0.05, 0.1, 0.15, 0.19):
        for _ in range(100):
            w = words(rng, n, "abcdefghijklmnop")
            v = list(w)
            for k in sorted(rng.sample(range(n), int(n * share)), reverse=True):
                v[k : k + 1] = rng.choice([[], ["new"], [v[k], "more"]])
            texts += [" ".join(w), " ".join(v)]
    got = {r.doc_id: r.class_id for r in order_minhash.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert all(got[2 * i] == 2 * i for i in range(400))
    for k, floor in enumerate(least):
        assert sum(got[2 * i + 1] == 2 * i for i in range(100 * k, 100 * k + 100)) >= 100 * floor, k


def test_pairs_are_compared_where_they_first_meet():
    keys = [np.array(k, np.int64) for k in ([1, 5, 9], [5, 9], [1, 9], [9], [9, 9, -3])]
    p, q = np.array([0, 0, 1, 2, 3, 4]), np.array([1, 2, 2, 3, 4, 4])
    got = order_minhash.met_before(p, q, np.full(5, 9), keys)
    assert got.tolist() == [True, True, False, False, False, True]
    assert not order_minhash.met_before(p[:0], q[:0], np.full(5, 9), keys).any()


def test_whole_table_against_all_pairs(spark):
    """Every class of the supplied documents is that of edit distances of all pairs, but for 1 in 100."""
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    want = brute_classes([r.text for r in rows])
    got = {r.doc_id: r.class_id for r in queries.op10_order_minhash(spark, "/root/testdata/sf0.001").collect()}
    assert sum(got[r.doc_id] != rows[want[k]].doc_id for k, r in enumerate(rows)) <= len(rows) / 100
    assert set(got.values()) >= {rows[c].doc_id for c in want.values()}


def test_second_phase_finds_links_between_later_members(spark):
    """Many short documents about one long shared passage: buckets hold members that differ from the least one."""
    rng = random.Random(3)
    passage = words(rng, 60)
    texts = []
    for _ in range(25):
        own = words(rng, 25)
        texts += [" ".join(passage + own), " ".join(passage + own[:-1] + ["last"])]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id: r.class_id for r in order_minhash.near_duplicates(df).collect()} == brute_classes(texts)


@pytest.mark.parametrize("small", [0, 100])
def test_a_bucket_of_many_chunks(spark, monkeypatch, small):
    """The same with chunks so small that the bucket is dealt to many groups."""
    monkeypatch.setattr(order_minhash, "CHUNK", 4)
    monkeypatch.setattr(order_minhash, "CHUNK_COUNTS", 6)
    monkeypatch.setattr(order_minhash, "ROWS", 2)
    monkeypatch.setattr(order_minhash, "SMALL", small)
    monkeypatch.setattr(order_minhash, "FEW", 2)
    rng = random.Random(5)
    passage = words(rng, 60)
    texts = []
    for k in range(30):
        own = words(rng, 30 + k % 3 * 12)
        texts += [" ".join(passage + own), " ".join(passage + own[:-1] + ["last"])]
    texts += [" ".join([*texts[0].split(), *["x"] * (k % 4)]) for k in range(20)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id: r.class_id for r in order_minhash.near_duplicates(df).collect()} == brute_classes(texts)


def test_counts_rule_out_no_similar_pair():
    rng = np.random.default_rng(6)
    for _ in range(200):
        a = rng.integers(0, 1 << 62, rng.integers(1, 400)).astype(np.uint64)
        b = np.delete(a, rng.integers(0, len(a), int(rng.integers(0, len(a) // 5 + 1))))
        b[rng.integers(0, max(1, len(b)), int(0.1 * len(b)))] = np.uint64(7)
        if len(b) and order_minhash.similar(a, b, 0.8):
            assert order_minhash.possible(order_minhash.counts(a), np.array([len(a)]), order_minhash.counts(b)[None], np.array([len(b)]), 0.8).all()
    x = rng.integers(0, 9, (7, order_minhash.BINS)).astype(np.uint8)
    n = x.sum(axis=1).astype(np.int64)
    pairs = order_minhash._possible_matrix(x[:3], n[:3], x, n, 0.6)
    assert (pairs == [order_minhash.possible(r, k, x, n, 0.6) for r, k in zip(x[:3], n[:3])]).all()


def test_an_id_with_two_texts(spark):
    """Rows of one id are one document, and which of its texts counts does not depend on their order."""
    rows = [(5, "a b c d e f g h i j k l"), (5, "q r s t u v w x y z"), (6, "a b c d e f g h i j k l"), (7, "q r s t u v w x y z")]
    once = [sorted(map(tuple, order_minhash.near_duplicates(spark.createDataFrame(r, "doc_id long, text string").repartition(n)).collect())) for r, n in ((rows, 1), (rows[::-1], 3))]
    assert once[0] == once[1] and len(once[0]) == 4
    assert [c for i, c, _ in once[0] if i in (6, 7)] in ([5, 7], [6, 5])


def test_near_duplicates_of_nothing(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert order_minhash.near_duplicates(empty).count() == 0
    odd = spark.createDataFrame([(None, "a b c"), (1, None), (1, None)], "doc_id long, text string")
    assert sorted(str(tuple(r)) for r in order_minhash.near_duplicates(odd).collect()) == ["(1, 1, True)", "(1, 1, True)", "(None, None, True)"]


def test_decontamination(spark):
    rng = random.Random(9)
    items = [(i, " ".join(words(rng, rng.randint(8, 60)))) for i in range(12)] + [(50, None), (51, ""), (52, "two words"), (53, "four words in a row here".replace(" here", ""))]
    docs = []
    for i, t in items[:12]:
        w = t.split()
        for share in (0, 0.1, 0.19, 0.4):
            v = list(w)
            for k in rng.sample(range(len(v)), int(share * len(v))):
                v[k] = rng.choice(["sub", "other"])
            docs.append(" ".join(words(rng, 40) + v + words(rng, rng.randint(0, 40))))
        docs.append(" ".join(words(rng, 30) + w[: len(w) // 2] + ["in", *w[len(w) // 2 :]]).upper())
    docs += [None, "", "x four words in a row", " ".join(words(rng, 500))]
    df = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(docs)], "doc_id long, text string, item_id string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = {}
    for d, text in enumerate(docs):
        w = plain_words(text or "")
        for i, t in items:
            v = plain_words(t or "")
            if len(v) >= 3 and w:
                code = {x: k for k, x in enumerate(dict.fromkeys(v + w))}
                e, _, _ = align.best_place(np.array([code[x] for x in v]), np.array([code[x] for x in w]))
                if e <= decontaminate.limit_of(len(v), 0.8):
                    want[d, i] = e
    for slice_words in (400_000, 60):
        got = {(r.doc_id, r.item_id): r.edits for r in decontaminate.contaminated(df, bench, slice_words=slice_words).collect()}
        assert got == want
    assert decontaminate.contaminated(df, bench.limit(0)).count() == 0
    assert decontaminate.contaminated(df.limit(0), bench).count() == 0


def test_items_without_id_and_several_texts_of_one(spark):
    rng = random.Random(4)
    one, two, none = (" ".join(words(rng, n)) for n in (12, 20, 15))
    bench = spark.createDataFrame([(1, one), (1, two), (1, two), (None, none), (None, None), (2, "")], "item_id long, text string")
    edited = " ".join(["new", *one.split()[1:]])
    docs = [(0, f"{two} and {edited}"), (1, none), (1, none), (None, one), (2, one + " " + none), (3, " ".join(words(rng, 3_000)))]
    df = spark.createDataFrame(docs, "item_id long, text string").coalesce(1)
    for slice_words in (400_000, 10):
        got = decontaminate.contaminated(df, bench, id_col="item_id", slice_words=slice_words)
        assert len(got.columns) == 5
        got = sorted((str(r[0]), str(r[1]), r.edits, r.start_word) for r in decontaminate.contaminated(df.withColumnRenamed("item_id", "d"), bench, id_col="d", slice_words=slice_words).collect())
        assert got == [("0", "1", 0, 0), ("1", "None", 0, 0), ("1", "None", 0, 0), ("2", "1", 0, 0), ("2", "None", 0, 12), ("None", "1", 0, 0)]


@pytest.mark.parametrize("length", [20, 50, 100, 200, 400])
def test_items_of_any_length_are_found_at_the_limit(spark, length):
    """Every fifth word is another, left out or put in, in turn."""
    rng = random.Random(length)
    items, docs = [], []
    for i in range(60):
        w = words(rng, length, "abcdefghijklmnop")
        items.append((i, " ".join(w)))
        new = lambda word: [["other"], [], [word, "more"]][i % 3]
        v = [x for k, word in enumerate(w) for x in (new(word) if k % 5 == i % 4 else [word])]
        docs.append((i, " ".join(words(rng, 30) + v + words(rng, 30))))
    df, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(df, bench).collect()}
    assert got <= {(i, i) for i in range(60)}
    assert len(got) >= 59


@pytest.mark.parametrize("threshold", [0.8, 0.6])
def test_short_items(spark, threshold):
    items = [(1, "alpha"), (2, "beta gamma"), (3, "one two three"), (4, "p q r s"), (5, "v w x y z"), (6, "a b c d e f"), (7, "...")]
    texts = ["alpha", "Beta, gamma! alpha alpha", "beta x gamma", "one two three one two", "p q s", "p q r s", "v w other y z", "w x y z", "v w x y", "v w x more y z", "z y x w v", "w", "a b c e f", "beta", "gamma one two", None]
    want = {}
    for d, text in enumerate(texts):
        for i, t in items[:6]:
            v, w = plain_words(t), plain_words(text or "")
            code = {x: k for k, x in enumerate(dict.fromkeys(v + w))}
            if w and (e := align.best_place(np.array([code[x] for x in v]), np.array([code[x] for x in w]))[0]) <= int((1 - threshold) * len(v) + 1e-9):
                want[d, i] = e
    df, bench = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = [((r.doc_id, r.item_id), r.edits) for r in decontaminate.contaminated(df, bench, threshold=threshold).collect()]
    assert sorted(got) == sorted(want.items())


def test_vectors(spark):
    rng = np.random.default_rng(3)
    base = rng.standard_normal((60, 16))
    x = [*base, *(base[:20] + 0.02 * rng.standard_normal((20, 16))), *(base[:5] * 3), *base[:4], *(base[:10] + 0.2 * rng.standard_normal((10, 16)))]
    rows = [(i, [float(c) for c in np.float32(v)], int(i % 60 % 3)) for i, v in enumerate(x)]
    odd = [(900, None, 1), (901, [0.0] * 16, 1), (902, [float("nan")] + [1.0] * 15, 1), (903, [1.0, None], 1), (904, rows[0][1], None), (905, [], 1), (906, [float("inf")] * 16, 1), (907, [1.0, 2.0], 1), (908, [1.0, 2.0], 1)]
    schema = "vec_id long, embedding array<float>, label int"
    df = spark.createDataFrame(rows + odd + [rows[7]], schema).withColumn("n", F.lit(1))
    every = rows + odd + [rows[7]]
    good = [r for r in every if r[1] and r[2] is not None and None not in r[1] and np.isfinite(r[1]).all() and np.any(r[1])]
    unit = [np.array(r[1], float) / np.linalg.norm(np.array(r[1], float)) for r in good]
    pairs = [(a, b) for a in range(len(good)) for b in range(a) if good[a][2] == good[b][2] and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= 0.98]
    root = roots([r[0] for r in every], [(good[a][0], good[b][0]) for a, b in pairs])
    n = [0] * len(good)
    for a, b in pairs:
        n[a] += 1
        n[b] += 1
    want = [(r[0], k, root[r[0]], r[0] == root[r[0]]) for r, k in zip(good, n)] + [(r[0], 0, r[0], True) for r in every if r not in good and r[0] in (900, 901, 903, 904, 905, 906)]
    want += [(902, 0, 902, True)]
    got = [tuple(r) for r in near_vectors(df).collect()]
    assert sorted(got) == sorted(want)
    assert near_vectors(df.limit(0)).count() == 0


def test_rows_of_one_id_are_different_vectors(spark):
    a, b = [1.0, 0.0, 0.0], [0.0, 1.0, 0.0]
    df = spark.createDataFrame([(5, a, 1), (5, b, 2), (6, b, 2), (7, [0.0, 1.0, 0.01], 2)], "vec_id long, embedding array<double>, label int")
    assert sorted(map(tuple, near_vectors(df).collect())) == [(5, 0, 5, True), (5, 2, 5, True), (6, 2, 5, False), (7, 2, 5, False)]


def test_chunks_of_a_bucket(spark, monkeypatch):
    """A cluster of more vectors than a chunk takes, with copies."""
    monkeypatch.setattr(embedding_dedup, "CHUNK", 5)
    monkeypatch.setattr(embedding_dedup, "PAIRS", 3)
    rng = np.random.default_rng(8)
    x = rng.standard_normal(12) + 0.09 * rng.standard_normal((40, 12))
    x = np.concatenate((x, x[:6]))
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    close = unit @ unit.T >= 0.98
    df = spark.createDataFrame([(i, v.tolist(), "a") for i, v in enumerate(x)], "vec_id long, embedding array<double>, label string")
    got = {r.vec_id: r for r in near_vectors(df).collect()}
    assert [got[i].n_links for i in range(len(x))] == (close.sum(axis=1) - 1).tolist()
    root = roots(range(len(x)), np.argwhere(close).tolist())
    assert {i: r.component_id for i, r in got.items()} == root


def test_recall_of_tables():
    rng = np.random.default_rng(2)
    a = rng.standard_normal((400, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = rng.standard_normal((400, 64))
    b -= (a * b).sum(1, keepdims=True) * a
    b = 0.98 * a + np.sqrt(1 - 0.98**2) * b / np.linalg.norm(b, axis=1, keepdims=True)
    from parcelwright.llm.embedding_dedup import buckets_of

    tables = tables_for(0.98)
    assert 0 < agreement(0.2) < 1
    found = (buckets_of(a, tables) == buckets_of(b, tables)).any(axis=1).mean()
    assert found >= 0.99
