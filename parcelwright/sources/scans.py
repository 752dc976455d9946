"""Landed result pages on any file system that Spark reads, as a table and as a stream.

    folder/category=LP/alias=0/page=1/*.json      scanned by category
    folder/scan=1/page=1/*.json                   walked page by page, newest rows first

Files hold JSON rows, a line each, or with many_lines a list. Category and page are folders, so that
a filter on them prunes files; filters on a row's own columns are pushed to the JSON reader.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.scans import list_scan

CATEGORY_KEYS, SCAN_KEYS = "category string, alias int, page int", "scan int, page int"


def read_categories(spark: SparkSession, folder: str, row: str, *, many_lines: bool = False) -> DataFrame:
    """Rows of a scan by categories (row: the schema of a landed row)."""
    return spark.read.schema(f"{row}, {CATEGORY_KEYS}").option("multiLine", many_lines).json(folder)


def scan_stream(spark: SparkSession, folder: str, row: str) -> DataFrame:
    """The pages of list scans as a stream. A scan lands whole (its folder is renamed into place), since
    where a walk stops depends on all pages before; what was read is kept by the stream's checkpoint."""
    return spark.readStream.schema(f"{row}, {SCAN_KEYS}").json(folder)


def scan_sink(path: str, *, doc: str = "doc_num", page_rows: int = 50) -> Callable[[DataFrame, int], None]:
    """For foreachBatch: appends the rows of the pages that a walk takes whose documents path does not
    hold yet. A batch that is repeated replaces its own rows; a batch may hold several scans, of which a
    document's first counts."""

    def take(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        held = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)
        earlier = spark.read.parquet(path).where(F.col("batch") < number).select(doc).distinct() if held else None
        rows = list_scan(batch, earlier, doc=doc, page_rows=page_rows).where(F.coalesce(F.col(doc) != "", F.lit(False)))
        if earlier is not None:
            rows = rows.join(earlier, doc, "left_anti")
        rows = rows.groupBy(doc).agg(F.min_by(F.struct(*[c for c in batch.columns if c != doc]), F.struct("scan", "page")).alias("r")).select(doc, "r.*")
        rows.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return take
