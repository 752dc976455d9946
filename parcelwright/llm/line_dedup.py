"""Line dedup: lines that many documents share stay in one of them only.

Built from DataFrame functions alone. Only 128-bit keys of the long lines are dealt
out by line. They are counted with partial aggregation, so a line that half of all
documents hold is a handful of rows by then; documents find their shared lines in a join
that spreads each line over several tasks. Texts move once, to meet the list of their own
dropped keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import spread_join, without

# The white space that is stripped from both ends of a line ([\x20\x09-\x0D]).
BLANKS = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _lowered(text: Column) -> Column:
    """A-Z in lower case, nothing else. lower() does the same on plain ASCII and is far cheaper."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def _keys(text: Column, min_chars: int) -> Column:
    """For each line its key as struct(a, b), or null where the line is too short to count."""

    def key(line: Column) -> Column:
        line = F.trim(line, F.lit(BLANKS))
        return F.when(F.char_length(line) >= min_chars, F.struct(F.xxhash64(line).alias("a"), F.xxhash64(F.lit(1), line).alias("b")))

    return F.transform(F.split(_lowered(text), "\n", -1), key)


def line_dedup(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """docs with the shared lines taken out of text_col, plus n_lines and n_dropped.

    A line's key is the line stripped of blanks at both ends with A-Z lower-cased. A key
    of at least min_chars code points found in at least min_docs documents loses all its
    lines except those of the largest id that holds it; other lines stay, joined by \\n.

    A null or empty text is one empty line and comes back as "". Texts of any length that
    fits in a row are split whole; an empty table gives no rows. Rows with the same id
    count as one document and each gets the same treatment; a row without id counts for
    no document and keeps all its lines. Other columns pass through; columns already
    named n_lines or n_dropped are replaced.
    """
    docs = without(docs, "n_lines", "n_dropped", "__ld_gone", "__ld_id", "__ld_mark", "__ld_kept")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    # Equal texts of one id are treated alike, so the id and the text's hash tell which lines are meant.
    mark = F.xxhash64(text).alias("mark")
    held = (
        docs.where(F.col(id_col).isNotNull())
        .select(F.col(id_col).alias("id"), mark, F.posexplode(_keys(text, min_chars)).alias("pos", "k"))
        .where("k is not null")
        .select("id", "mark", "pos", "k.a", "k.b")
    )
    shared = held.groupBy("a", "b").agg(F.count_distinct("id").alias("n"), F.max("id").alias("last")).where(F.col("n") >= min_docs)
    gone = (
        spread_join(held, shared.select("a", "b", "last"), ["a", "b"], "id")
        .where(F.col("id") != F.col("last"))
        .groupBy(F.col("id").alias("__ld_id"), F.col("mark").alias("__ld_mark"))
        .agg(F.collect_set("pos").alias("__ld_gone"))
    )
    joined = docs.join(gone, (F.col(id_col) == F.col("__ld_id")) & (F.xxhash64(text) == F.col("__ld_mark")), "left")
    lines = F.split(text, "\n", -1)
    # Places are taken away as sets, so that the work grows with the lines, not with lines times dropped ones.
    left = lambda ls: F.transform(F.array_except(F.sequence(F.lit(0), F.size(ls) - 1), "__ld_gone"), lambda i: F.get(ls, i))
    kept = F.get(F.transform(F.array(lines), left), F.lit(0))
    rest = [c for c in docs.columns if c.lower() != text_col.lower()]
    return joined.select(
        *rest,
        text.alias("__ld_text"),
        F.size(lines).cast("long").alias("n_lines"),
        F.when(F.col("__ld_gone").isNotNull(), kept).alias("__ld_kept"),
    ).select(
        *[F.coalesce(F.array_join("__ld_kept", "\n"), F.col("__ld_text")).alias(c) if c.lower() == text_col.lower() else F.col(c) for c in docs.columns],
        "n_lines",
        F.coalesce(F.col("n_lines") - F.size("__ld_kept"), F.lit(0)).cast("long").alias("n_dropped"),
    )
