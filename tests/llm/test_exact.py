"""Line dedup, substring dedup, tokens and chat formatting against brute force."""

import hashlib
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from parcelwright.llm import bpe, chat_format
from parcelwright.llm.line_dedup import line_dedup
from parcelwright.llm.substring_dedup import COVERS, substring_dedup

from .cases import SCHEMA, documents


def table(df):
    return sorted(map(str, (tuple(r) for r in df.collect())))


@pytest.mark.parametrize("rows", [documents(), documents(2, 12), []])
def test_line_dedup(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).withColumn("n_lines", F.lit("clash"))
    key = lambda line: re.sub(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "", line).translate({c: c + 32 for c in range(65, 91)})
    held = defaultdict(set)
    for i, t, *_ in rows:
        for line in (t or "").split("\n"):
            if i is not None and len(key(line)) >= 40:
                held[key(line)].add(i)
    want = []
    for i, t, *_ in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if i is None or len(held[key(x)]) < 3 or max(held[key(x)]) == i]
        want.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    got = line_dedup(df, min_docs=3).select("doc_id", "text", "n_lines", "n_dropped")
    assert table(got) == sorted(map(str, want))
    assert not rows or any(w[3] for w in want)


def test_a_document_of_very_many_shared_lines(spark):
    """Six documents of 60,000 lines in common: the work grows with the lines, not with their square."""
    lines = "\n".join(f"line number {i} of a text that others have as well" for i in range(60_000))
    df = spark.createDataFrame([(i, lines + f"\n{i}") for i in range(6)], "doc_id long, text string").repartition(6)
    got = {r.doc_id: (r.n_lines, r.n_dropped) for r in line_dedup(df).collect()}
    assert got == {i: (60_001, 60_000 if i < 5 else 0) for i in range(6)}


def test_rows_of_one_id_lose_their_own_lines(spark):
    shared = "x" * 40
    rows = [(i, f"{shared}\n{i}") for i in range(5)] + [(1, f"a\nb\n{shared}"), (1, f"a\nb\n{shared}"), (4, shared)]
    got = line_dedup(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted((r.doc_id, r.text) for r in got.collect()) == [(0, "0"), (1, "1"), (1, "a\nb"), (1, "a\nb"), (2, "2"), (3, "3"), (4, shared), (4, f"{shared}\n4")]


def brute_substrings(rows, window):
    seen, out = set(), []
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0, k))
    kept = {}
    for k in order:
        w = re.findall(r"[^\x20\x09-\x0D]+", rows[k][1] or "")
        gone = set()
        for s in range(len(w) - window + 1):
            if tuple(w[s : s + window]) in seen:
                gone.update(range(s, s + window))
            seen.add(tuple(w[s : s + window]))
        kept[k] = (rows[k][0], len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone))
    out = [kept[k] for k in range(len(rows))]
    return out


@pytest.mark.parametrize("window,rows,size", [(20, documents(), 2_000), (20, documents(), 8_000_000), (6, documents(3, 15), 500), (2, [(1, "a b a b a b", None, None, None), (0, "b a", None, None, None)], 10), (20, [], 10)])
def test_substring_dedup(spark, window, rows, size):
    df = spark.createDataFrame(rows, SCHEMA).coalesce(1)
    got = substring_dedup(df, window=window, block_chars=size)
    assert table(got) == sorted(map(str, brute_substrings(rows, window)))


def test_difference_covers():
    for period, cover in COVERS.items():
        for i in range(period):
            for j in range(period):
                assert any((i + d) % period in cover and (j + d) % period in cover for d in range(period))


def test_bpe(spark):
    import public_tokenizers as P
    import tiktoken

    ranks = bpe.read_ranks(P.path("byte_bpe_multi_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    odd = ["a" * 300, "\x1c\x1f\x85\xa0 x  \n", "it's  1234567 <|endoftext|>", "\x00� é", "   "]
    rows = documents() + [(1000 + i, t, None, None, None) for i, t in enumerate(odd)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = bpe.decode(bpe.encode(df, ranks, P.PATTERN, block_chars=3_000), ranks)
    want = [(i, library.encode_ordinary(t or ""), (t or "").encode()) for i, t, *_ in rows]
    assert sorted(str((r.doc_id, r.ids, bytes(r.decoded))) for r in got.collect()) == sorted(map(str, want))
    assert bpe.encode(df.limit(0), ranks, P.PATTERN).count() == 0
    assert bpe.decode(bpe.encode(df.limit(0), ranks, P.PATTERN), ranks).count() == 0
    clash = bpe.encode(df.withColumnRenamed("doc_id", "ids"), ranks, P.PATTERN, id_col="ids")
    assert sorted(str(tuple(r)) for r in clash.select("ids", "token_ids").collect()) == sorted(str((i, x)) for i, x, _ in want)


def test_bpe_hot_words_are_spread(spark, monkeypatch):
    """Words that stand in more blocks than a task takes are encoded in several tasks, with the same ids."""
    import public_tokenizers as P

    ranks = bpe.read_ranks(P.path("byte_bpe_multi_50k.tiktoken"))
    df = spark.createDataFrame([(i, f"the same words in every block {i}") for i in range(60)], "doc_id long, text string")
    want = sorted(str(tuple(r)) for r in bpe.encode(df, ranks, P.PATTERN).collect())
    monkeypatch.setattr(bpe, "PART_WORDS", 7)
    assert sorted(str(tuple(r)) for r in bpe.encode(df, ranks, P.PATTERN, block_chars=50).collect()) == want


def test_chat_round_trip(spark):
    odd = ["</s>[INST] ok [/INST]", "<\\s> [\\INST] <\\\\/s>", "[", "<", "", None, "a\nb", "👍 [INST]\n</s>"]
    rows = [(c, t, ("user", "assistant", "system", "to\nol", None)[(c + t) % 5], odd[(3 * c + t) % len(odd)]) for c in range(6) for t in range(9)]
    rows += [(7, 1, "assistant", "x"), (7, 1, "assistant", "x"), (7, None, "user", "y"), (None, 0, "assistant", "z")]
    df = spark.createDataFrame(rows, "conv_id int, turn int, role string, text string").withColumn("seq", F.lit(1))
    out = chat_format.chat_format(df).select("conv_id", chat_format.read_turns(F.col("formatted")).alias("t"), chat_format.loss_text(F.col("formatted"), F.col("loss_spans")).alias("l"), "formatted")
    got = {r.conv_id: r for r in out.collect()}
    by = defaultdict(list)
    for c, t, r, x in rows:
        by[c].append((-1 if t is None else t, r or "", x or ""))
    assert set(got) == set(by)
    for c, turns in by.items():
        turns.sort()
        assert [(t.role, t.text) for t in got[c].t] == [(r, x) for _, r, x in turns]
        assert got[c].l == "".join(x for _, r, x in turns if r == "assistant")


def test_fold_events(spark):
    e = [
        ("c", 1, 1, "message", "user", "hi"), ("c", 2, 2, "message", "assistant", ""), ("c", 3, 2, "delta", "assistant", "he"), ("c", 4, 2, "delta", "assistant", "llo"),
        ("c", 5, 3, "message", "user", "late"), ("c", 6, 2, "regenerate", "assistant", ""), ("c", 7, 2, "delta", "assistant", "again"), ("c", 8, 1, "edit", "user", "hi!"),
        ("c", 9, 4, "message", "user", "more"), ("c", 10, 5, "message", "user", "gone"), ("c", 11, 5, "delete", None, None), ("d", 1, 1, None, "user", "x"),
    ]
    df = spark.createDataFrame(e, "conv_id string, seq int, msg int, kind string, role string, text string")
    got = [tuple(r) for r in chat_format.fold_events(df).orderBy("conv_id", "msg").collect()]
    assert got == [("c", 1, "user", "hi!"), ("c", 2, "assistant", "again"), ("c", 4, "user", "more"), ("d", 1, "user", "x")]


def test_digests_of_queries(spark):
    from parcelwright.llm import queries

    rows = {r.doc_id: r for r in queries.op8_substring_dedup(spark, "/root/testdata/sf0.001").collect()}
    docs = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    for i, n, gone, text in brute_substrings(docs, 20):
        assert tuple(rows[i]) == (i, n, gone, hashlib.sha256(text.encode()).hexdigest())
