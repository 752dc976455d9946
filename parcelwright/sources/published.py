"""Several outputs that change together: versions beside each other, and one commit that names the newest.

    path/versions/ID/NAME/...      an output of a version
    path/commits/0000000012        the folder of version 12; its file appears by one rename

A reader looks for the last commit, so it sees all outputs of one version; a job that fails before its
rename leaves the last one as it was. Of two writers that commit the same number one fails.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.base import text
from . import sinks


class EmptyReplacement(ValueError):
    """A filled list would be replaced by an empty one."""


def _fs(spark: SparkSession, path: str):  # noqa: ANN202
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), spark._jvm.org.apache.hadoop.fs.Path


def _last(spark: SparkSession, path: str) -> tuple[int, str]:
    """The number and the folder of the last commit; 0 and "" where there is none."""
    fs, at = _fs(spark, path)
    folder = at(f"{path}/commits")
    names = sorted(s.getPath().getName() for s in fs.listStatus(folder)) if fs.exists(folder) else []
    names = [n for n in names if n.isdigit()]
    if not names:
        return 0, ""
    return int(names[-1]), spark.read.text(f"{path}/commits/{names[-1]}").first()[0]


def published(spark: SparkSession, path: str, name: str) -> DataFrame | None:
    """An output of the last version, None before the first."""
    _, folder = _last(spark, path)
    return spark.read.parquet(f"{folder}/{name}") if folder else None


def publish(outputs: Mapping[str, DataFrame], path: str, *, guarded: str) -> int:
    """Writes all outputs as one new version and commits it; returns its number.

    If the output `guarded` is empty while the last version's is not, nothing is committed and
    EmptyReplacement is raised.
    """
    spark = outputs[guarded].sparkSession
    number, before = _last(spark, path)
    folder = f"{path}/versions/{uuid.uuid4().hex}"
    for name, df in outputs.items():
        df.write.parquet(f"{folder}/{name}")
    if before and spark.read.parquet(f"{folder}/{guarded}").isEmpty() and not spark.read.parquet(f"{before}/{guarded}").isEmpty():
        raise EmptyReplacement(f"{guarded} of {path} would become empty")
    fs, at = _fs(spark, path)
    draft, final = at(f"{folder}/commit"), at(f"{path}/commits/{number + 1:010d}")
    fs.mkdirs(final.getParent())
    out = fs.create(draft)
    out.write(bytearray(folder.encode()))
    out.close()
    # A rename onto a name that exists would move the file into it or fail, by file system: look first.
    if fs.exists(final) or not fs.rename(draft, final):
        raise OSError(f"version {number + 1} of {path} is already there")
    return number + 1


def publish_list(records: DataFrame, path: str, *, counts: Mapping[str, Column] | None = None, **stamp: Column) -> int:
    """A list as files of records and its envelope beside them, as one version. Keys of the last
    version's envelope that are not given anew stay as they were."""
    before = published(records.sparkSession, path, "envelope")
    return publish({"records": records, "envelope": sinks.list_envelope(records, before, counts=counts, **stamp)}, path, guarded="records")


def publish_foreclosures(records: DataFrame, path: str) -> int:
    """The foreclosure list, its totals and its export as one version: lists in order of sale, those
    before their sale first; totals count them by status."""
    totals = records.agg(F.count("*").alias("total"), F.count_if(F.col("status") == "pre").alias("pre_foreclosure"), F.count_if(F.col("status") == "post").alias("post_foreclosure"))
    # The list is ordered by Spark's range sort: files in the order of their names.
    ordered = records.orderBy(text("status") == "post", F.coalesce(F.col("days_until_sale"), F.lit(9_999)), "doc_num")
    export = sinks.foreclosure_rows(records)
    export = export.toDF(*[c.lower().replace(" ", "_").replace("(", "").replace(")", "") for c in export.columns])
    return publish({"list": ordered, "totals": totals, "export": export}, path, guarded="list")
