"""One query for each corpus operator over its whole table, and oracle SQL where SQL can say it."""

from __future__ import annotations

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe
from . import chat_format as chat
from .collocations import collocations
from .common import table
from .decontaminate import contaminated
from .embedding_dedup import near_vectors
from .interval_join import floored, micros, overlaps, sessions
from .language import identify
from .line_dedup import line_dedup
from .order_minhash import near_duplicates
from .quality import score_quality
from .secret_scan import as_text, scan_secrets
from .toxicity import score_toxicity
from .substring_dedup import substring_dedup


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup(docs).select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text"), 256).alias("kept_sha256"))


OP1_SQL = r"""
WITH lines AS (
  SELECT doc_id, generate_subscripts(ls, 1) AS pos, unnest(ls) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents)
), keyed AS (
  SELECT doc_id, pos, line,
    translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM lines
), shared AS (
  SELECT k, max(doc_id) AS last FROM keyed WHERE length(k) >= 40
  GROUP BY k HAVING count(DISTINCT doc_id) >= 5
), marked AS (
  SELECT y.doc_id, y.pos, y.line, coalesce(y.doc_id <> s.last, FALSE) AS gone
  FROM keyed y LEFT JOIN shared s ON y.k = s.k
)
SELECT doc_id, CAST(count(*) AS BIGINT) AS n_lines, CAST(count(*) FILTER (gone) AS BIGINT) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

#: What every conversation of the query's own making says in both turns.
CONTROL_CASE = "</s>[INST] ok [/INST]"


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.createDataFrame([(-1, 0, "user", CONTROL_CASE), (-1, 1, "assistant", CONTROL_CASE)], rows.schema)
    out = chat.chat_format(rows.unionByName(more))
    turns = chat.read_turns(F.col("formatted"))
    read = out.select("conv_id", "formatted", turns.alias("turns"), chat.loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


OP5_SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), sized AS (
  SELECT *, length(role) + 1 + length(regexp_replace(text, '([\[<])(\\*)(/?(?:INST\]|s>))', '\1\\\2\3', 'g'))
    + CASE WHEN role = 'assistant' THEN 7 ELSE 13 END AS chars
  FROM rows
)
SELECT conv_id, CAST(count(*) AS BIGINT) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""

#: The rank file by whose ids the corpus is encoded.
TOKENIZER = "byte_bpe_multi_50k.tiktoken"


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ranks = bpe.read_ranks(public_tokenizers.path(TOKENIZER))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = bpe.decode(bpe.encode(docs, ranks, public_tokenizers.PATTERN), ranks)
    return out.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring_dedup(docs, window=20).select("doc_id", "n_words", "n_removed", F.sha2(F.col("text"), 256).alias("kept_sha256"))


def op10_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels").select("doc_id", "quality"))


def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return identify(docs).select("doc_id", "held_out", "lang_pred", "score")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels").select("doc_id", "toxic"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents").select("text", "lang"))


OP11_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS d, coalesce(lang, 'und') AS lang,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
), pieces AS (
  SELECT d, lang, generate_subscripts(p, 1) AS i, unnest(p) AS piece FROM (SELECT d, lang, regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]') AS p FROM docs)
), words AS (
  SELECT d, lang, i, generate_subscripts(p, 1) AS j, unnest(p) AS w FROM (SELECT d, lang, i, regexp_extract_all(piece, '[^\x20\x09]+') AS p FROM pieces)
), grams AS (
  SELECT lang, w AS w1, lead(w, 1) OVER x AS w2, lead(w, 2) OVER x AS w3, lead(w, 3) OVER x AS w4 FROM words WINDOW x AS (PARTITION BY d, i ORDER BY j)
), f AS (
  SELECT lang, [w1] AS g, count(*) AS a FROM grams GROUP BY ALL
  UNION ALL SELECT lang, [w1, w2], count(*) FROM grams WHERE w2 IS NOT NULL GROUP BY lang, w1, w2
  UNION ALL SELECT lang, [w1, w2, w3], count(*) FROM grams WHERE w3 IS NOT NULL GROUP BY lang, w1, w2, w3
  UNION ALL SELECT lang, [w1, w2, w3, w4], count(*) FROM grams WHERE w4 IS NOT NULL GROUP BY lang, w1, w2, w3, w4
), c AS (
  SELECT lang, g, a, len(g) AS m FROM f WHERE len(g) > 1 AND a >= 30
), starts AS (
  SELECT *, unnest(range(1, m + 1)) AS s FROM c WHERE m > 2
), subs AS (
  SELECT *, unnest(range(s + 1, m + 1)) AS z FROM starts
), inside AS (
  SELECT lang, g[s:z] AS g, max(a) AS longer FROM subs WHERE z - s + 1 < m GROUP BY lang, g[s:z]
), kept AS (
  SELECT c.* FROM c LEFT JOIN inside i ON i.lang = c.lang AND i.g = c.g WHERE i.longer IS NULL OR 100 * i.longer < 80 * c.a
), cuts AS (
  SELECT *, g[1:k] AS front, g[k + 1:] AS rest FROM (SELECT *, unnest(range(1, m)) AS k FROM kept)
), scored AS (
  SELECT u.lang, u.g, u.a, u.k, x.a AS l, y.a AS r, (CAST(2000000 AS HUGEINT) * u.a) // (CAST(x.a AS HUGEINT) + y.a) AS score
  FROM cuts u JOIN f x ON x.lang = u.lang AND x.g = u.front JOIN f y ON y.lang = u.lang AND y.g = u.rest
), best AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1
), ranked AS (
  SELECT *, array_to_string(g, ' ') AS phrase FROM best
), n AS (
  SELECT lang, count(*) AS n FROM words GROUP BY lang
)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM ranked) JOIN n USING (lang) WHERE rank <= 2000
"""

#: A client's clicks further apart than this are of different sessions; a slot.
SESSION_GAP_US, HOUR_US = 600_000_000, 3_600_000_000


def op12_interval_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    clicks, sales, lines = (table(spark, sf_dir, t) for t in ("clicks", "sales", "sale_lines"))
    clicks = clicks.select(F.col("client_id").alias("key"), micros(clicks, "ts").alias("us"), (F.col("kind") == "purchase").alias("flag"))
    slot = lambda c: floored(F.col(c), HOUR_US)
    found = sessions(clicks, SESSION_GAP_US)
    right = found.select("key", slot("first").alias("start"), F.when(~F.col("flag"), slot("last")).alias("end"), F.crc32(F.col("first").cast("string").cast("binary")).alias("weight"))
    shipped = lines.groupBy("sale_id").agg(F.max("shipped_at").alias("shipped_at"), F.max(F.col("shipped_at").isNull()).alias("waits"))
    shipped = shipped.select("sale_id", micros(shipped, "shipped_at").alias("shipped"), "waits")
    sold = sales.where("client_id is not null and sold_at is not null").select("sale_id", F.col("client_id").alias("key"), micros(sales, "sold_at").alias("sold"))
    sold = sold.join(shipped, "sale_id", "left").withColumn("until", F.greatest("sold", "shipped"))
    left = sold.select(F.col("sale_id").alias("id"), "key", slot("sold").alias("start"), F.when(~F.coalesce("waits", F.lit(False)), slot("until")).alias("end"))
    out = overlaps(left, right)
    return out.select(F.col("id").alias("sale_id"), "relation", "n_pairs", F.col("overlap").alias("overlap_slots"), F.col("weight").alias("sessions_crc"))


OP12_SQL = r"""
WITH c AS (
  SELECT client_id, epoch_us(ts) AS us, coalesce(kind = 'purchase', FALSE) AS buys FROM clicks WHERE client_id IS NOT NULL AND ts IS NOT NULL
), d AS (
  SELECT *, CASE WHEN us - lag(us) OVER (PARTITION BY client_id ORDER BY us) <= 600000000 THEN 0 ELSE 1 END AS new FROM c
), e AS (
  SELECT *, sum(new) OVER (PARTITION BY client_id ORDER BY us RANGE UNBOUNDED PRECEDING) AS s FROM d
), f AS (
  SELECT client_id, s, min(us) AS first, max(us) AS last FROM e GROUP BY ALL
), table_of AS (
  SELECT list_transform(range(0, 256), lambda i: list_reduce(list_prepend(i, range(0, 8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS crcs
), w AS (
  SELECT f.client_id, first // 3600000000 AS a, CASE WHEN bool_or(e.buys) THEN NULL ELSE last // 3600000000 END AS z,
    xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(first AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
      lambda c, b: xor(crcs[CAST((xor(c, b) & 255) + 1 AS BIGINT)], c >> 8))) AS crc
  FROM f JOIN e ON e.client_id = f.client_id AND e.s = f.s AND e.us = f.last CROSS JOIN table_of GROUP BY f.client_id, f.s, first, last, crcs
), l AS (
  SELECT sale_id, max(epoch_us(shipped_at)) AS last, bool_or(shipped_at IS NULL) AS waits FROM sale_lines GROUP BY sale_id
), v AS (
  SELECT s.sale_id, s.client_id, epoch_us(s.sold_at) // 3600000000 AS a,
    CASE WHEN coalesce(l.waits, FALSE) THEN NULL ELSE greatest(epoch_us(s.sold_at), l.last) // 3600000000 END AS z
  FROM sales s LEFT JOIN l ON l.sale_id = s.sale_id WHERE s.client_id IS NOT NULL AND s.sold_at IS NOT NULL
), p AS (
  SELECT v.sale_id, w.crc, sign(v.a - w.a) AS begins,
    CASE WHEN v.z IS NULL AND w.z IS NULL THEN 0 WHEN v.z IS NULL THEN 1 WHEN w.z IS NULL THEN -1 ELSE sign(v.z - w.z) END AS ends,
    least(v.z, w.z) - greatest(v.a, w.a) + 1 AS shared
  FROM v JOIN w ON v.client_id = w.client_id AND (v.z IS NULL OR w.a <= v.z) AND (w.z IS NULL OR w.z >= v.a)
)
SELECT sale_id, ['overlaps', 'finished_by', 'contains', 'starts', 'equals', 'started_by', 'during', 'finishes', 'overlapped_by'][CAST(3 * begins + ends + 5 AS BIGINT)] AS relation,
  CAST(count(*) AS BIGINT) AS n_pairs, CAST(sum(shared) AS BIGINT) AS overlap_slots, CAST(sum(crc) AS BIGINT) AS sessions_crc
FROM p GROUP BY ALL
"""

def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select("doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"), F.sha2(as_text(F.col("base")), 256).alias("base_sha256"), as_text(F.array_sort(F.concat("base", "linked"))).alias("spans"))


OP13_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS d, doc_id, coalesce(text, '') AS text FROM documents
), patterns(kind, role, pattern) AS (VALUES
  (0, 'secret', '([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)'),
  (1, 'access', 'AKIA[A-Z0-9]+'),
  (2, 'secret', '[0-9a-f]+'),
  (3, 'access', '(([Cc][Ll][Ii][Ee][Nn][Tt]|[Aa][Cc][Cc][Oo][Uu][Nn][Tt]|[Tt][Ee][Nn][Aa][Nn][Tt]|[Uu][Ss][Ee][Rr]|[Kk][Ee][Yy]|[Aa][Cc][Cc][Ee][Ss][Ss]_?[Kk][Ee][Yy])[_-]?[Ii][Dd]|[Ll][Oo][Gg][Ii][Nn]|[Uu][Ss][Ee][Rr][Nn][Aa][Mm][Ee])["'']?\x20*[:=]\x20*["'']?[A-Za-z0-9_.@-]+'),
  (4, 'secret', '[A-Za-z0-9+/_-]+'),
  (5, 'endpoint', '[A-Za-z][A-Za-z0-9+.-]*://[^\x20\x09-\x0D"''<>]+')
), lists AS (
  SELECT d, kind, role, pattern, regexp_extract_all(text, pattern) AS ms, regexp_split_to_array(text, pattern) AS gaps FROM docs, patterns WHERE regexp_matches(text, pattern)
), hits AS (
  SELECT d, kind, role, pattern, generate_subscripts(ms, 1) AS i, unnest(ms) AS m, unnest(gaps[1:len(ms)]) AS gap FROM lists
), placed AS (
  SELECT d, kind, role, pattern, m, sum(length(gap) + length(m)) OVER (PARTITION BY d, kind ORDER BY i) AS z FROM hits
), spans AS (
  SELECT d, kind, role, CAST(z - length(m) AS BIGINT) AS a, CAST(z AS BIGINT) AS z FROM placed WHERE CASE kind
    WHEN 0 THEN length(regexp_extract(m, pattern, 2)) >= 6 WHEN 1 THEN length(m) >= 20 WHEN 2 THEN length(m) >= 24
    WHEN 4 THEN length(m) >= 20 AND regexp_matches(m, '[A-Z]') AND regexp_matches(m, '[a-z]') AND regexp_matches(m, '[0-9]') ELSE TRUE END
), parts AS (
  SELECT s.*, len(regexp_extract_all(left(text, a), '\n[\x20\x09\x0D]*\n')) AS para FROM spans s JOIN docs USING (d)
  WHERE kind < 3 OR NOT EXISTS (SELECT 1 FROM spans b WHERE b.d = s.d AND b.kind < 3 AND b.a < s.z AND b.z > s.a)
), linked AS (
  SELECT w.d, w.kind, w.a, w.z FROM parts w JOIN parts o ON o.d = w.d AND o.para = w.para AND o.role <> w.role AND o.a < w.z + 300 AND o.z > w.a - 300
  WHERE w.kind >= 3 GROUP BY ALL HAVING bool_or(o.kind < 3) OR count(DISTINCT o.role) = 2
), shown AS (
  SELECT d, kind, a, ['assign', 'access', 'hex', 'identifier', 'blob', 'endpoint'][kind + 1] || ':' || a || ':' || z AS t
  FROM (SELECT d, kind, a, z FROM parts WHERE kind < 3 UNION ALL SELECT d, kind, a, z FROM linked)
)
SELECT doc_id, CAST(count(*) FILTER (kind = 0) AS BIGINT) AS n_assign, CAST(count(*) FILTER (kind = 1) AS BIGINT) AS n_access, CAST(count(*) FILTER (kind = 2) AS BIGINT) AS n_hex,
  sha256(coalesce(string_agg(t, ',' ORDER BY a, kind) FILTER (kind < 3), '')) AS base_sha256, coalesce(string_agg(t, ',' ORDER BY a, kind), '') AS spans
FROM docs LEFT JOIN shown USING (d) GROUP BY d, doc_id
"""

QUERIES = {"op13_secret_scan": op13_secret_scan, "op11_collocations": op11_collocations, "op12_interval_join": op12_interval_join, "op2_toxicity": op2_toxicity, "op4_language": op4_language, "op6_embedding_dedup": op6_embedding_dedup, "pipeline": corpus_pipeline.run, "op3_quality": op3_quality, "op9_decontaminate": op9_decontaminate, "op10_order_minhash": op10_order_minhash, "op1_line_dedup": op1_line_dedup, "op5_chat_format": op5_chat_format, "op7_bpe": op7_bpe, "op8_substring_dedup": op8_substring_dedup}
ORACLES = {"op1_line_dedup": OP1_SQL, "op5_chat_format": OP5_SQL, "op11_collocations": OP11_SQL, "op12_interval_join": OP12_SQL, "op13_secret_scan": OP13_SQL}
if corpus_pipeline.ORACLE_SQL:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
