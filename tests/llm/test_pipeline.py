"""The pipeline's stages: columns, decisions, and each against a plain version."""

import hashlib

from pyspark.sql import functions as F

import corpus_pipeline as P
from parcelwright.llm import queries
from parcelwright.llm.common import table, written

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = table(spark, SF, "documents")
    columns = docs.columns
    ids = [{r.doc_id for r in docs.select("doc_id").collect()}]
    texts = {}
    for name, stage in P.STAGES[:-1]:
        docs = written(stage(spark, docs, SF), name)
        assert docs.columns == columns
        rows = docs.collect()
        assert len(rows) == len({r.doc_id for r in rows})
        ids.append({r.doc_id for r in rows})
        texts = {r.doc_id: r.text for r in rows}
        assert ids[-1] <= ids[-2]
    labels = {r.doc_id: r.quality for r in table(spark, SF, "labels").collect()}
    good = {i for i in ids[0] if labels.get(i) == 1}
    assert len(good & ids[1]) >= 0.95 * len(good)
    assert ids[1] == ids[2]  # line dedup drops lines, not documents
    assert len(ids[3]) < len(ids[2])
    kept = [t for t in texts.values() if t]
    assert len(set(kept)) == len(kept)  # no exact copy is left

    import public_tokenizers
    import tiktoken

    from parcelwright.llm.bpe import read_ranks

    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(public_tokenizers.path(P.TOKENIZER)), special_tokens={})
    for r in P.STAGES[-1][1](spark, docs, SF).collect():
        want = library.encode_ordinary(texts[r.doc_id] or "")
        assert r.n_tokens == len(want) and r.ids_sha256 == hashlib.sha256(",".join(map(str, want)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest()


def odd_documents(spark):
    """Documents of the tables and rows of every odd kind, with extra columns of names that stages use."""
    docs = table(spark, SF, "documents")
    some = [r.text for r in docs.where("text is not null").orderBy("doc_id").limit(3).collect()]
    rows = [(None, some[0]), (None, None), (9_000, None), (9_001, ""), (9_002, some[1]), (9_002, some[1]), (9_003, " \n \n"), (9_004, "x " * 30_000)]
    more = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    return docs.unionByName(more).withColumn("component", F.lit("c")).withColumn("kept", F.lit("k")).withColumn("predicted", F.lit("p")).withColumn("item_id", F.lit("i"))


def test_stages_stand_odd_rows(spark):
    """Each stage against a plain version of what it decides, on its own input."""
    docs = odd_documents(spark).repartition(3)
    columns, plain = docs.columns, lambda df: sorted(map(str, map(tuple, df.collect())))

    scored = {(r.doc_id, r.predicted) for r in P.score_quality(docs.select("doc_id", "text"), table(spark, SF, "labels")).collect()}
    rejected = {i for i, p in scored if p == 0 and i is not None}
    good = P.quality(spark, docs, SF)
    assert good.columns == columns and plain(good) == sorted(str(tuple(r)) for r in docs.collect() if r.doc_id not in rejected)

    lined = P.lines(spark, docs, SF)
    dropped = {(r.doc_id, r.text) for r in P.line_dedup(docs.select("doc_id", "text")).select("doc_id", "text").collect()}
    assert lined.columns == columns and lined.count() == docs.count()
    assert all((r.doc_id, r.text) in dropped and r.n_chars == len(r.text) for r in lined.collect())

    near = P.near(spark, docs, SF)
    gone = {r.doc_id for r in P.near_duplicates(docs.select("doc_id", "text")).collect() if not r.kept}
    assert near.columns == columns and plain(near) == sorted(str(tuple(r)) for r in docs.collect() if r.doc_id not in gone)
    # A copy of a document goes, the document and what has no words or no id stay.
    ids = [r.doc_id for r in near.collect()]
    assert 9_002 not in ids and {9_000, 9_001, 9_003, 9_004} <= set(ids) and ids.count(None) == 2

    clean = P.decontaminate(spark, docs, SF)
    found = {r.doc_id for r in P.contaminated(docs.select("doc_id", "text"), table(spark, SF, "benchmark")).collect()}
    assert clean.columns == columns and plain(clean) == sorted(str(tuple(r)) for r in docs.collect() if r.doc_id is None or r.doc_id not in found)

    tokens = P.tokens(spark, docs, SF).collect()
    assert sorted(map(str, (r.doc_id for r in tokens))) == sorted(map(str, (r.doc_id for r in docs.collect())))
    texts = {r.doc_id: r.text or "" for r in docs.collect() if r.doc_id is not None}
    assert all(r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest() for r in tokens if r.doc_id is not None)


def test_stages_stand_empty_tables(spark):
    empty = odd_documents(spark).limit(0)
    for _, stage in P.STAGES:
        assert stage(spark, empty, SF).count() == 0


def test_registered():
    assert "pipeline" in queries.QUERIES
    assert {q.split("_")[0] for q in queries.QUERIES} == {"pipeline", *(f"op{n}" for n in range(1, 14))}
