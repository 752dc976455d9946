"""Collocations, interval overlaps and secrets against plain Python."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from parcelwright.llm import collocations as C
from parcelwright.llm import interval_join as I
from parcelwright.llm import secret_scan as S

from .cases import SCHEMA, documents


def table(df):
    return sorted(map(str, (tuple(r) for r in df.collect())))


# Collocations


def brute_phrases(rows, least, top, percent=80, scale=2_000_000):
    f, n = defaultdict(Counter), Counter()
    lower = {c: c + 32 for c in range(65, 91)}
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(lower)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for m in range(1, 5):
                for i in range(len(w) - m + 1):
                    f[lang][tuple(w[i : i + m])] += 1
    out = []
    for lang, counts in f.items():
        cand = {g: a for g, a in counts.items() if len(g) > 1 and a >= least}
        inside = lambda g, h: any(h[i : i + len(g)] == g for i in range(len(h) - len(g) + 1))
        found = []
        for g, a in cand.items():
            if any(len(h) > len(g) and inside(g, h) and 100 * b >= percent * a for h, b in cand.items()):
                continue
            score, _, left, right = min((scale * a // (counts[g[:k]] + counts[g[k:]]), k, counts[g[:k]], counts[g[k:]]) for k in range(1, len(g)))
            found.append((-score, -a, " ".join(g).encode(), left, right))
        for rank, (s, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -s))
    return out


def texts(seed, n):
    rng = random.Random(seed)
    words = ["a", "B", "ç", "漢字", "x\x00", "\x85y", "new", "York", "city", "hall", " "]
    out = []
    for _ in range(n):
        some = [rng.choice(words) for _ in range(rng.randint(0, 30))]
        if rng.random() < 0.5:
            some[len(some) // 2 : len(some) // 2] = ["New", "york", "CITY", "hall"]
        out.append(("".join(w + rng.choice([" ", " ", "  ", "\t", ", ", "\n", ".", " \r\n"]) for w in some), rng.choice(["en", "de", None])))
    return [*out, (None, "en"), ("", None), ("a b " * 4_000, "long"), ("same words here", "en"), ("same words here", "en")]


@pytest.mark.parametrize("seed,n,least,top,chars,keys,ranked", [(1, 80, 3, 2000, 8_000_000, 1_000, 50_000), (2, 60, 2, 7, 200, 50, 20), (3, 0, 3, 2000, 1_000, 1_000, 50_000)])
def test_collocations(spark, seed, n, least, top, chars, keys, ranked):
    rows = texts(seed, n)
    df = spark.createDataFrame(rows, "text string, lang string").withColumn("n", F.lit("clash")).withColumn("phrase", F.lit(1)).repartition(3)
    got = C.collocations(df, min_count=least, top=top, block_chars=chars, range_keys=keys, ranked=ranked)
    assert table(got) == sorted(map(str, brute_phrases(rows, least, top)))


def test_collocations_of_nothing(spark):
    empty = spark.createDataFrame([], "text string, lang string")
    assert C.collocations(empty).collect() == []
    assert C.collocations(spark.createDataFrame([("a b c", "en")], "text string, lang string")).collect() == []


def test_keys_by_hash_within_a_range(spark, monkeypatch):
    monkeypatch.setattr(C, "MOST_RANGES", 2)
    rows = texts(5, 40)
    df = spark.createDataFrame(rows, "text string, lang string")
    assert table(C.collocations(df, min_count=2, block_chars=300, range_keys=20)) == sorted(map(str, brute_phrases(rows, 2, 2000)))


def test_radix_order():
    rng = np.random.default_rng(1)
    keys = rng.integers(0, 1 << 32, (2_000, 4), dtype=np.uint32)
    keys[::3] = keys[1::3][0]
    keys[1::3, :2] = 7
    assert [tuple(k) for k in keys[C.radix_order(keys)]] == sorted(map(tuple, keys))
    found, counts = C.run_lengths(keys, np.ones(len(keys), np.int64))
    assert Counter(map(tuple, keys)) == dict(zip(map(tuple, found), counts))


# Interval overlaps


def brute_overlaps(left, right):
    inf, out = 1 << 80, defaultdict(lambda: [0, 0, 0])
    sign = lambda a, b: (a > b) - (a < b)
    for i, k, a, z in left:
        for k2, p, q, w in right:
            if k is None or k != k2 or a is None or p is None:
                continue
            e, f = inf if z is None else z, inf if q is None else q
            if e < a or f < p or p > e or f < a:
                continue
            x = out[i, I.RELATIONS[3 * (sign(a, p) + 1) + sign(e, f) + 1]]
            x[0] += 1
            x[1] = None if x[1] is None or e == f == inf else x[1] + min(e, f) - max(a, p) + 1
            x[2] += w or 0
    return [(*k, *v) for k, v in out.items()]


def intervals(rng, n, span, weighted):
    out = []
    for i in range(n):
        a = rng.choice([None, *[rng.randint(-span, span)] * 9])
        z = None if a is None or rng.random() < 0.3 else a + rng.choice([0, 1, 3, 10, span, -1])
        k = rng.choice(["x", "x", "y", None, f"k{i % 7}"])
        out.append((k, a, z, rng.choice([None, 1, (1 << 40) + 5, 4_294_967_295])) if weighted else (rng.choice([i, i, 3, None]), k, a, z))
    return out


@pytest.mark.parametrize("seed,n,span,block,salt", [(1, 60, 40, 8, 4_096), (2, 120, 300, 24, 16), (3, 90, 5, 3, 5), (4, 50, 1 << 40, 1 << 38, 7), (5, 0, 5, 4, 4)])
def test_overlaps(spark, seed, n, span, block, salt):
    rng = random.Random(seed)
    left, right = intervals(rng, n, span, False), intervals(rng, n, span, True)
    left, right = left + left[:2], right + right[:2]
    a = spark.createDataFrame(left, "id long, key string, start long, end long").withColumn("relation", F.lit("clash")).withColumn("block", F.lit("clash"))
    b = spark.createDataFrame(right, "key string, start long, end long, weight long").withColumn("n", F.lit("clash"))
    want = brute_overlaps(left, right)
    assert table(I.overlaps(a, b, block=block, salt_rows=salt)) == sorted(map(str, want))
    assert span != 5 or n == 0 or len({w[1] for w in want}) == 9


def test_one_interval_across_all_time_is_a_few_rows(spark):
    """A wide closed interval on the left costs two visits, an open one a single visit."""
    left = spark.createDataFrame([(1, "k", 0, 10_000_000), (2, "k", 5, None)], "id long, key string, start long, end long")
    right = spark.range(3_000).select(F.lit("k").alias("key"), (F.col("id") * 3_000).alias("start"), (F.col("id") * 3_000 + 1).alias("end"), F.lit(1).alias("weight"))
    assert table(I.overlaps(left, right)) == sorted(map(str, [(1, "contains", 2_999, 5_998, 2_999), (1, "started_by", 1, 2, 1), (2, "contains", 2_999, 5_998, 2_999)]))


def brute_sessions(rows, gap):
    out = []
    by = defaultdict(list)
    for k, us, flag in rows:
        if k is not None and us is not None:
            by[k].append((us, bool(flag)))
    for k, clicks in by.items():
        clicks.sort()
        runs = [[clicks[0]]]
        for c in clicks[1:]:
            if c[0] - runs[-1][-1][0] > gap:
                runs.append([])
            runs[-1].append(c)
        out += [(k, r[0][0], r[-1][0], any(f for us, f in r if us == r[-1][0])) for r in runs]
    return out


@pytest.mark.parametrize("level", [2, 4, 1_024])
def test_sessions(spark, monkeypatch, level):
    """Sessions over many levels, before and after 1970, with ties at the end, repeats and nulls."""
    monkeypatch.setattr(I, "LEVEL", level)
    rng, gap = random.Random(level), 600_000_000
    rows = []
    for k in range(6):
        us = rng.randint(-(10**12), 10**12)
        for _ in range(rng.randint(1, 80)):
            us += rng.choice([0, 1, gap // 2, gap, gap, gap + 1, 3 * gap])
            rows.append((k, us, rng.choice([True, False, None])))
    rows += [(k, us, not f) for k, us, f in rows[::7]] + rows[:9] + [(None, 5, True), (3, None, True), (99, I.FIRST_US, True), (99, I.LAST_US, False)]
    df = spark.createDataFrame(rows, "key int, us long, flag boolean").repartition(3)
    assert table(I.sessions(df, gap)) == sorted(map(str, brute_sessions(rows, gap)))
    assert I.sessions(df.where("key > 1000"), gap).collect() == []


def test_micros_do_not_follow_the_zone(spark):
    df = spark.sql("select timestamp_ntz'2024-03-10 02:30:00.123456' as ts")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert df.select(I.micros(df, "ts")).first()[0] == 1_710_037_800_123_456
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


# Secrets


def brute_secrets(text, reach=S.REACH):
    text = text or ""
    base = [(m.start(), 0, m.end()) for m in re.finditer(S.ASSIGN, text, re.A | re.I) if len(m[2]) >= 6]
    base += [(m.start(), 1, m.end()) for m in re.finditer(S.ACCESS, text) if len(m[0]) >= 20]
    base += [(m.start(), 2, m.end()) for m in re.finditer(S.HEX, text) if len(m[0]) >= 24]
    weak = [(m.start(), 3, m.end()) for m in re.finditer(S.IDENTIFIER, text, re.A | re.I)]
    weak += [(m.start(), 4, m.end()) for m in re.finditer(S.BLOB, text) if len(m[0]) >= 20 and re.search("[A-Z]", m[0]) and re.search("[a-z]", m[0]) and re.search("[0-9]", m[0])]
    weak += [(m.start(), 5, m.end()) for m in re.finditer(S.ENDPOINT, text, re.A | re.I)]
    weak = [w for w in weak if not any(b[0] < w[2] and b[2] > w[0] for b in base)]
    para = lambda s: len(re.findall(S.BLANK, text[: s[0]]))
    linked = []
    for w in weak:
        near = [o for o in base + weak if para(o) == para(w) and o[0] < w[2] + reach and o[2] > w[0] - reach and S.ROLES[o[1]] != S.ROLES[w[1]]]
        if any(o[1] < S.N_BASE for o in near) or len({S.ROLES[o[1]] for o in near}) == 2:
            linked.append(w)
    return sorted(base), sorted(linked)


PARTS = [
    "AKIA" + "Z9" * 8, "xAKIA" + "Q" * 15, "AKIA" + "A" * 40, "deadbeef" * 3, "deadbeef" * 2 + "1234567", "Password: hunter22", "PASSWD='abc12'", "password=token:abcdefgh",
    "api_key = \"Abc/def+12=\"", "apikey:x", "ſecret=abcdefgh", "toKen=abcdefgh", "client_id=acme-7", "login: root", "https://db.example.com/x?y=1", "ftp://h", "aB3" * 8, "wJalrXUtnFEMI/K7MDENG/bPxRfiCYEXAMPLEKEY1", "word", "漢字", "👍",
]


def secret_rows(seed, n):
    rng = random.Random(seed)
    texts = ["".join(rng.choice([*PARTS, "word " * rng.randint(1, 90)]) + rng.choice([" ", " ", ", ", "\n", "\n\n", "\n \t\n", "\n\n\n", '"', ""]) for _ in range(rng.randint(0, 14))) for _ in range(n)]
    return [(i, t, None, None, None) for i, t in enumerate(texts)]


@pytest.mark.parametrize("rows", [secret_rows(1, 150), documents(), [(7, "client_id=acme " + "aB3" * 2_000 + " x " * 40 + "https://e.org", None, None, None)] * 2, []])
def test_secrets(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).withColumn("spans", F.lit("clash")).withColumn("uid", F.lit("clash")).repartition(3)
    got = [(r.doc_id, [tuple(s) for s in r.base], [tuple(s) for s in r.linked]) for r in S.scan_secrets(df).collect()]
    assert sorted(map(str, got)) == sorted(str((i, *brute_secrets(t))) for i, t, *_ in rows)
    assert len(rows) < 100 or {s[1] for _, _, linked in got for s in linked} == {3, 4, 5}


def test_weak_parts_need_their_complement(spark):
    blob, id_, place = "aB3" * 8, "client_id=acme", "https://db.example.com"
    texts = [blob, f"{id_} {blob}", f"{id_} {blob} {place}", f"{id_}\n\n{blob} {place}", f"{id_} {'word ' * 80}{blob} {place}", f"{place} token=abcdefgh"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    linked = {r.doc_id: [S.KINDS[s.kind] for s in r.linked] for r in S.scan_secrets(df).collect()}
    assert linked == {0: [], 1: [], 2: ["identifier", "blob", "endpoint"], 3: [], 4: [], 5: ["endpoint"]}


def test_secret_span_text(spark):
    df = spark.createDataFrame([(1, "é token=abcdefgh")], "doc_id long, text string")
    assert S.scan_secrets(df).select(S.as_text(F.col("base"))).first()[0] == "assign:2:16"
