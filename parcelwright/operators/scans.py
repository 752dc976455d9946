"""What a walk over result pages keeps: where it stops, which alias and which category counts.

Pages are landed beforehand; a page is decided by what it holds, not by fetching it. Everything that
is decided is decided on counts by page or on keys alone; rows move only where a key is in dispute.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.base import blank


def pages_reached(rows: DataFrame, known: DataFrame | None = None, *, walk: Sequence[str] = ("scan",), page: str = "page", doc: str = "doc_num", page_rows: int = 50) -> DataFrame:
    """The pages (walk, page, n_rows, why) that a walk over pages 1, 2, ... takes.

    It ends before a page that is missing (or empty, which is the same here) or whose documents
    were all on earlier pages, and after one whose documents are all in known (column doc), or that has fewer
    than page_rows rows. why is "known" or "short" for such a last page, "" for others. Rows without a
    document count as rows and decide nothing else.
    """
    walk = list(walk)
    docs = rows.where(~blank(doc)).select(*walk, page, doc).distinct()
    first = docs.groupBy(*walk, doc).agg(F.min(page).alias("__first"))
    seen = docs.join(first, [*walk, doc])
    seen = seen.withColumn("__known", F.lit(False)) if known is None else seen.join(known.select(doc, F.lit(True).alias("__known")).distinct(), doc, "left")
    held = seen.groupBy(*walk, page).agg(F.count("*").alias("__docs"), F.count_if(F.col("__first") == F.col(page)).alias("__new"), F.count_if(F.coalesce("__known", F.lit(False))).alias("__known"))
    pages = rows.groupBy(*walk, page).agg(F.count("*").alias("n_rows")).join(held, [*walk, page], "left").fillna(0, ["__docs", "__new", "__known"])
    order = Window.partitionBy(*walk).orderBy(page)
    before = (F.col(page) != F.row_number().over(order)) | ((F.col("__docs") > 0) & (F.col("__new") == 0))
    all_known, short = (F.col("__docs") > 0) & (F.col("__known") == F.col("__docs")), F.col("n_rows") < page_rows
    pages = pages.withColumn("__before", before).withColumn("why", F.when(all_known, "known").when(short, "short").otherwise(""))
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    ended = F.coalesce(F.max(F.col("__before") | (F.col("why") != "")).over(earlier), F.lit(False))
    return pages.withColumn("__ended", ended).where(~F.col("__ended") & ~F.col("__before")).select(*walk, page, "n_rows", "why")


def list_scan(rows: DataFrame, known: DataFrame | None = None, **rules: object) -> DataFrame:
    """The rows of the pages that `pages_reached` takes."""
    walk = list(rules.get("walk", ("scan",)))
    return rows.join(pages_reached(rows, known, **rules), [*walk, str(rules.get("page", "page"))], "left_semi")


def in_window(filed: str, start: str, end: str) -> Column:
    """Whether an ISO date lies in the window; rows without a date are kept."""
    return F.col(filed).isNull() | (F.col(filed) == "") | ((F.col(filed) >= start) & (F.col(filed) <= end))


def first_alias(rows: DataFrame, *, category: str = "category", alias: str = "alias") -> DataFrame:
    """The rows of the first alias of each category that has any."""
    first = rows.groupBy(category).agg(F.min(alias).alias(alias))
    return rows.join(first, [category, alias], "left_semi")


def first_wins(rows: DataFrame, key: str, order: Sequence[Column]) -> DataFrame:
    """One row for each filled key: the first by order, which must tell the rows of a key apart.

    Only keys that stand more than once are looked up, so that rows meet a table of disputed keys, which
    Spark broadcasts where it is small, instead of being shuffled.
    """
    rows = rows.where(~blank(key)).withColumn("__o", F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)]))
    disputed = rows.groupBy(key).agg(F.min("__o").alias("__first"), F.count("*").alias("__n")).where("__n > 1").drop("__n")
    return rows.join(disputed, key, "left").where(F.col("__first").isNull() | (F.col("__first") == F.col("__o"))).drop("__o", "__first")


def category_scan(rows: DataFrame, *, start: str, end: str, categories: Sequence[str], specific: Mapping[str, int] | None = None, doc: str = "doc_num", filed: str = "filed") -> DataFrame:
    """Rows (category, alias, page, pos, doc, filed, ...) of a scan by categories, one for each document.

    Dates outside start to end go (they reach the reader as filters), of each category the first
    alias with rows counts, and of a document's rows the one of the most specific category (a number, 0
    unless given), then the one found first: by the order of categories, page, pos. Categories that
    are not listed are not scanned.
    """
    rank = F.lit(None).cast("int")
    for i, c in enumerate(categories):
        rank = F.coalesce(rank, F.when(F.col("category") == c, i))
    depth = F.lit(0)
    for c, n in (specific or {}).items():
        depth = F.when(F.col("category") == c, n).otherwise(depth)
    kept = first_alias(rows.where(F.col("category").isin(*categories) & in_window(filed, start, end)))
    return first_wins(kept, doc, [-depth, rank, F.col("page"), F.col("pos")])
