"""The corpus pipeline: quality filter, line dedup, near dedup, decontamination, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its result is written as
Parquet and read again as the next stage's docs. All but the last return the columns of
documents, whatever else they are called.

Texts of any length that fits in a row are taken whole, an empty table gives an empty one. Rows of
one id are one document and go together; a row without id goes by no decision. A null text
counts as an empty one, of which no stage but the first has anything to decide.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelwright.llm import bpe
from parcelwright.llm.common import table, written
from parcelwright.llm.decontaminate import contaminated
from parcelwright.llm.line_dedup import line_dedup
from parcelwright.llm.order_minhash import near_duplicates
from parcelwright.llm.quality import score_quality

#: The rank file of public_tokenizers by whose ids the last stage encodes.
TOKENIZER = "byte_bpe_multi_50k.tiktoken"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go. Null and empty texts have a score as well."""
    scores = score_quality(docs, table(spark, sf_dir, "labels"))
    rejected = scores.where("predicted = 0").select("doc_id")
    return docs.join(rejected, "doc_id", "left_anti").select(docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that many documents share stay in one; n_chars follows the text. A null text comes back
    as ""; columns n_lines and n_dropped, if there are any, are the operator's."""
    out = line_dedup(docs)
    return out.withColumn("n_chars", F.char_length("text").cast("long")).select(docs.columns)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: the one with the least id. Documents without
    words are copies of none; repeated rows of the id that stays all stay."""
    gone = near_duplicates(docs).where(~F.col("kept")).select("doc_id")
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go, one whose item has no id too."""
    found = contaminated(docs, table(spark, sf_dir, "benchmark")).select("doc_id").distinct()
    return docs.join(written(found, "leaks"), "doc_id", "left_anti").select(docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of what is left, as digests of them and of the bytes that they decode to; one row for
    each row, with a null id too."""
    import public_tokenizers

    ranks = bpe.read_ranks(public_tokenizers.path(TOKENIZER))
    out = bpe.decode(bpe.encode(docs, ranks, public_tokenizers.PATTERN), ranks)
    return out.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )


STAGES = [("quality", quality), ("line_dedup", lines), ("near_dedup", near), ("decontaminate", decontaminate), ("bpe", tokens)]

#: Trees, alignment and merges are not SQL; tests/llm/test_pipeline.py holds the stages
#: against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
