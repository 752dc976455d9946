"""Classifiers: held-out accuracy on the supplied tables, defined results for odd input."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from parcelwright.llm import gbt, language, queries, quality, toxicity
from parcelwright.llm.common import held_out

from .cases import SCHEMA

SF = "/root/testdata/sf0.01"
ODD = [(1, None, None, None, None), (2, "", "", None, None), (3, " \n", "en", None, None), (3, " \n", "en", None, None), (None, "x", "en", None, None), (4, "123 !?", "en", None, None), (5, "word " * 30_000, "en", None, None)]


def test_held_out(spark):
    import zlib

    got = spark.range(200).select("id", held_out(F.col("id")).alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 5 == 0) for r in got)


def test_trees_learn_and_stand_odd_data():
    rng = np.random.default_rng(1)
    x = rng.random((2000, 5))
    y = ((x[:, 0] > 0.5) ^ (x[:, 3] > 0.3)).astype(float)
    model = gbt.fit(x[:1500], y[:1500])
    assert ((model.score(x[1500:]) >= 0.5) == y[1500:]).mean() > 0.95
    assert np.allclose(gbt.fit(np.zeros((0, 5)), np.zeros(0)).score(x[:3]), 0.5)
    assert (gbt.fit(x, np.ones(len(x))).score(x) > 0.99).all()


def test_flat_trees_agree_with_a_walk():
    rng = np.random.default_rng(2)
    x = rng.random((300, 4))
    m = gbt.fit(x, (x[:, 1] * x[:, 2] > 0.25).astype(float), trees=5, depth=3)
    for row, got in zip(x[:40], m.score(x[:40])):
        total = m.base
        for t in range(len(m.feature)):
            node = 0
            while 2 * node + 1 < m.feature.shape[1]:
                node = 2 * node + 1 + int(row[m.feature[t][node]] > m.threshold[t][node])
            total += m.value[t][node]
        assert abs(got - 1 / (1 + np.exp(-total))) < 1e-12


def accuracy(spark, name, column):
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", F.col(column).alias("y"))
    got = queries.QUERIES[name](spark, SF).join(labels, "doc_id").where("held_out").select("predicted", "y").collect()
    assert len(got) > 50
    return sum(r.predicted == r.y for r in got) / len(got)


def test_quality(spark):
    assert accuracy(spark, "op3_quality", "quality") >= 0.95


def test_toxicity(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "toxic")
    got = queries.op2_toxicity(spark, SF).join(labels, "doc_id").where("held_out").select("predicted", "toxic").collect()
    # Six held-out documents are marked toxic here, and some of the marks are wrong.
    assert sum(r.predicted == r.toxic == 1 for r in got) >= 3
    assert sum(r.predicted > r.toxic for r in got) <= 1


def test_language(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    got = queries.op4_language(spark, SF).join(docs, "doc_id").where("held_out").collect()
    assert sum(r.lang_pred == r.lang for r in got) / len(got) >= 0.95


@pytest.mark.parametrize("labelled", [[], [(3, 1), (3, 0), (2, None), (99, 1)]])
def test_odd_documents(spark, labelled):
    docs = spark.createDataFrame(ODD, SCHEMA).withColumn("score", F.lit("clash"))
    labels = spark.createDataFrame(labelled, "doc_id long, quality int").withColumn("toxic", F.col("quality"))
    for out in (quality.score_quality(docs, labels), toxicity.score_toxicity(docs, labels)):
        rows = out.collect()
        assert len(rows) == len(ODD) and all(0 <= r.score <= 1 for r in rows)
        assert len({r.score for r in rows if r.doc_id == 3}) == 1
    lang = {r.doc_id: r for r in language.identify(docs).collect()}
    assert [lang[k].lang_pred for k in (1, 2, 3, 4)] == ["und"] * 4 and lang[1].spans == []
    assert language.identify(docs.limit(0)).count() == 0
    assert quality.score_quality(docs.limit(0), labels).count() == toxicity.score_toxicity(docs.limit(0), labels).count() == 0


def test_mixed_text_gets_spans(spark):
    rng = random.Random(1)
    kinds = {"xx": "abcdef", "yy": "uvwxyz", "gr": "αβγδεζ"}
    text = lambda k, n: " ".join("".join(rng.choices(kinds[k], k=5)) for _ in range(n))
    rows = [(i, text(k, 30), k, None, None) for i, k in enumerate(list(kinds) * 30)]
    mixed = text("xx", 20) + " " + text("gr", 30) + " " + text("yy", 25)
    docs = spark.createDataFrame([*rows, (1000, mixed, None, None, None)], SCHEMA)
    got = {r.doc_id: r for r in language.identify(docs).collect()}
    assert all(got[i].lang_pred == k for i, _, k, _, _ in rows)
    spans = got[1000].spans
    assert [s.lang for s in spans] == ["xx", "gr", "yy"] and got[1000].lang_pred == "gr"
    assert mixed[spans[1].start : spans[1].end].split()[0][0] in kinds["gr"]


def test_spans_lie_in_the_text(spark):
    """Letters that are longer in lower case move no span."""
    rows = [(i, t, k, None, None) for i, (t, k) in enumerate([("abc bca cab acb", "xx"), ("αβγ γβα βαγ αγβ", "gr")] * 20)]
    text = "İİİ abc bca cab abc acb cab bca αβγ γβα βαγ αγβ αβγ γβα"
    got = language.identify(spark.createDataFrame([*rows, (99, text, None, None, None)], SCHEMA)).where("doc_id = 99").first()
    assert [text[s.start : s.end].split()[-1] for s in got.spans] == ["bca", "γβα"] and got.spans[-1].end == len(text)


def test_best_path_is_the_best():
    rng = np.random.default_rng(3)
    for _ in range(60):
        s = rng.normal(size=(rng.integers(1, 6), 3)) * 3
        paths = np.array(np.meshgrid(*[range(3)] * len(s))).T.reshape(-1, len(s))
        value = lambda p: sum(s[t, k] for t, k in enumerate(p)) - 2.0 * sum(a != b for a, b in zip(p[:-1], p[1:]))
        got = language.best_path(s, 2.0)
        got = [got] * len(s) if isinstance(got, int) else got.tolist()
        assert abs(value(got) - max(map(value, paths))) < 1e-9


def toxic_model(letters="lmnoprstaeiu", insults=("grumblek", "zakvorn", "idiot"), n=600):
    rng = random.Random(2)
    plain = ["".join(rng.choices(letters[:8], k=2)) + "".join(rng.choices(letters[8:], k=3)) for _ in range(400)] + ["to", "me", "of", "in"]
    docs, labels = [], []
    for i in range(n):
        words = rng.choices(plain, k=20)
        if i % 3 == 0:
            words[rng.randrange(20)] = rng.choice(insults)
        docs.append([" ".join(words[:10]), " ".join(words[10:])])
        labels.append(int(i % 3 == 0))
    return toxicity.train(zip(docs, labels)), plain


def test_insults_in_disguise():
    model, plain = toxic_model()
    score = lambda text: model.of([text])[0]
    insults = ["grumblek", "grum-blek", "z.a.k.v.o.r.n", "zakxvorn", "idiot", "1d10t", "id iot", "i d i o t", "you id iot", "ZAKVORN"]
    assert {w: score("a word before " + w + " and others behind") > 0.5 for w in insults} == dict.fromkeys(insults, True)
    assert max(model.of(plain)) < 0.5
    assert score("") < 0.5 and score(None) < 0.5


def test_sentences_bound_what_is_read_together():
    model, _ = toxic_model()
    assert model.of(["so id iot there"])[0] > 0.5 > max(model.of(["so id. iot there", "so id\niot there"]))
    # What only the joined pieces tell apart is learned from sentences, not from documents.
    rng = random.Random(3)
    fill = ["".join(rng.choices("lmnoprst", k=3)) + "".join(rng.choices("aeu", k=3)) for _ in range(50)]
    pad = lambda: " ".join(rng.choices(fill, k=5))
    toxic, clean = [([f"{pad()} zak vorn {pad()}"], 1) for _ in range(60)], [([f"{pad()} zak", f"vorn {pad()}"], 0) for _ in range(60)]
    model = toxicity.train(toxic + clean)
    assert model.of(["zak vorn"])[0] > 0.5 > max(model.of(["zak. vorn", "zak", "vorn"]))


def test_an_insult_weighs_the_same_in_a_long_text():
    model, plain = toxic_model()
    long = " ".join(plain * 50)
    assert model.of([long + " idiot. " + long])[0] == pytest.approx(model.of(["idiot"])[0])


def test_toxicity_in_another_script():
    model, plain = toxic_model("бвгджзклаеиоу", ("грумблек", "заквёрн"))
    assert max(model.of(plain)) < 0.5 < min(model.of(["грумблек", "за-кв.ёрн"]))
    rng = random.Random(7)
    unseen = ["".join(rng.choices("бвгджзклмнпрст", k=3)) + "".join(rng.choices("аеиоу", k=3)) for _ in range(1000)]
    assert sum(model.of(unseen) > 0.5) == 0


def test_all_clean_pieces_and_rare_insults_count():
    """No piece of a clean document is left beyond the margin, however many there are."""
    rng = random.Random(4)
    plain = ["".join(rng.choices("lmnoprst", k=3)) + "".join(rng.choices("aeiu", k=4)) for _ in range(14_000)]
    docs = [[" ".join(plain[a : a + 100])] for a in range(0, 14_000, 100)] + [[" ".join([*rng.choices(plain, k=20), w])] for w in ["grumblek", "zakvorn"] * 3]
    model = toxicity.train(zip(docs, [0] * 140 + [1] * 6))
    assert max(model.of(plain)) < 0.5 < min(model.of(["grumblek", "zakvorn"]))


def test_word_scores_are_the_kernel():
    """The table of subsequences gives what the sum over landmarks gives."""
    words = ["idiot", "id-iot", "iddiot", "table", "a", ""]
    def features(w):
        out = {}
        for _, number, weight in toxicity._subsequences([w]):
            for n in number.tolist():
                out[n] = out.get(n, 0) + weight
        return out

    marks = {"idiot": 2.0, "tabl": -1.0}
    table = np.zeros(toxicity.TABLE)
    for m, a in marks.items():
        for n, v in features(m).items():
            table[n] += a * v
    want = [sum(a * sum(v * features(m).get(n, 0) for n, v in features(w).items()) for m, a in marks.items()) for w in words]
    assert np.allclose(toxicity.word_scores(words, table), want)


def test_reading_costs_what_the_sentences_hold():
    """However many pieces are known, a sentence of known ones makes no copy of them."""
    import tracemalloc

    scorer = toxicity.Scorer(toxicity.Model(np.zeros(toxicity.TABLE, np.float32), -1.0, 1.0, 0.0))
    many = [f"word{i}" for i in range(100_000)]
    scorer.worst([" ".join(many)])
    scorer.worst(["word5 word7"])
    tracemalloc.start()
    try:
        scorer.worst(["word5 word7"])
        assert tracemalloc.get_traced_memory()[1] < 100_000
    finally:
        tracemalloc.stop()


def test_pieces_follow_their_rule():
    """Numbers, sizes and sentences of pieces, read in one go or bit by bit, against a plain walk."""
    rng = random.Random(6)
    signs = ["a", "é", "ж", "@", "1", "-", "'", "\x7f", "ß", "中"]
    sentences = [rng.choice([" ", " ", "\t "]).join("".join(rng.choices(signs, k=rng.randrange(1, 7))) for _ in range(rng.randrange(12))) for _ in range(300)]
    want = []
    for s in sentences:
        words = "".join(c for c in s if c not in "-'\x7f").split()
        want.append([*words])
        for n in range(2, len(words) + 1):
            for i in range(len(words) - n + 1):
                size = [len(w) for w in words[i : i + n]]
                if sum(size) <= toxicity.JOINED and (n > 2 or min(size) <= toxicity.PIECE):
                    want[-1].append(" ".join(words[i : i + n]))
    for step in (1, 7, 300):
        pieces, got = toxicity.Pieces(), []
        for a in range(0, 300, step):
            found, where = pieces.read(sentences[a : a + step])
            names = list(pieces.number)
            got += [sorted(names[k] for k in found[where == i]) for i in range(len(sentences[a : a + step]))]
        assert got == [sorted(w) for w in want]
        assert list(pieces.number.values()) == list(range(len(pieces.number)))


def test_a_piece_scores_alike_beside_other_scripts():
    table = np.random.default_rng(8).normal(size=toxicity.TABLE)
    words = ["idiot", "грумблек", "id жot", "中文字符中文", "a", "", "ßßßß", "i-d-i-o-t"]
    assert np.array_equal(toxicity.word_scores(words, table), np.concatenate([toxicity.word_scores([w], table) for w in words]))
