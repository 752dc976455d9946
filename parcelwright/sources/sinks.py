"""Writers: envelopes, exports, run logs. Nothing replaces a filled store by an empty one."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.summary import envelope


def replaced(df: DataFrame, path: str, fmt: str = "json") -> None:
    """df in place of what path holds: written beside it and swapped by renames of the file
    system that path lies on, so that a failed job leaves the old rows. A reader between the two
    renames finds none; the old rows then lie at path + ".old"."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    new, old, at = (jvm.org.apache.hadoop.fs.Path(p) for p in (f"{path}.new", f"{path}.old", path))
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    df.write.mode("overwrite").format(fmt).save(f"{path}.new")
    fs.delete(old, True)
    if fs.exists(at) and not fs.rename(at, old):
        raise OSError(f"can't move {path}")
    if not fs.rename(new, at):
        raise OSError(f"can't move {path}.new")
    fs.delete(old, True)


def with_envelope(stored: DataFrame, records: DataFrame, **stamp: Column) -> DataFrame:
    """The stored envelope (one row) with records, total and stamps in place of its own; its other
    keys stay. For published lists, which one file holds."""
    inner = records.agg(F.collect_list(F.struct(*records.columns)).alias("records"), F.count("*").alias("total"))
    kept = [c for c in stored.columns if c not in {"records", "total", *stamp}]
    return stored.limit(1).select(*kept).crossJoin(F.broadcast(inner)).select(*kept, "total", *[v.alias(k) for k, v in stamp.items()], "records")  # one row each


def list_envelope(records: DataFrame, stored: DataFrame | None = None, *, counts: Mapping[str, Column] | None = None, **stamp: Column) -> DataFrame:
    """One row beside a list: total, counts (aggregates over records) and stamps, and the other keys of
    the stored envelope (its first row, if there is one). The records stay where they are, however many."""
    counts = counts or {}
    own = records.agg(F.count("*").alias("total"), *[c.alias(n) for n, c in counts.items()]).select("*", *[v.alias(k) for k, v in stamp.items()])
    if stored is None:
        return own
    kept = [c for c in stored.columns if c not in {"records", *own.columns}]
    before = stored.select(*kept).limit(1)
    return own.join(F.broadcast(before), how="left", on=F.lit(True)).select(*kept, *own.columns)  # one row each


def delinquent_totals(records: DataFrame, codes: tuple[str, ...]) -> DataFrame:
    """record_count, total_owed (cents) and the sorted filter codes of a delinquent list."""
    return records.agg(F.count("*").alias("record_count"), F.round(F.coalesce(F.sum("total_owed"), F.lit(0.0)), 2).alias("total_owed")).withColumn("filter_codes", F.array(*[F.lit(c) for c in sorted(codes)]))


def ledger_totals(ledger: DataFrame, status: str = "status") -> DataFrame:
    """open_count and total_tracked of a ledger."""
    return ledger.agg(F.count_if(F.col(status) == "open").alias("open_count"), F.count("*").alias("total_tracked"))


def write_records(df: DataFrame, path: str, *, partitions: list[str] | None = None) -> bool:
    """Writes JSON records unless df is empty; says whether it wrote. The caller points
    readers at the new folder, so that they never see half of it."""
    if df.isEmpty():
        return False
    writer = df.write.mode("overwrite").option("ignoreNullFields", "false")
    (writer.partitionBy(*partitions) if partitions else writer).json(path)
    return True


def write_envelope(df: DataFrame, path: str, **more: Column) -> None:
    """One JSON document with total, records and what else is given. For published lists, which one file holds."""
    one = envelope(df, **more)
    rest = [F.concat(F.lit(f', "{c}": '), F.to_json(F.struct(F.col(c).alias("v"))).substr(F.lit(6), F.length(F.to_json(F.struct(F.col(c).alias("v")))) - 6)) for c in more]
    one.select(F.concat(F.lit('{"total": '), F.col("total").cast("string"), *rest, F.lit(', "records": '), F.col("records"), F.lit("}")).alias("value")).write.mode("overwrite").text(path)


# The header of the CRM export.
CRM_HEADER = (
    "First Name", "Last Name", "Mailing Address", "Mailing City", "Mailing State", "Mailing Zip", "Property Address", "Property City", "Property State", "Property Zip",
    "Lead Type", "Document Type", "Date Filed", "Document Number", "Amount/Debt Owed", "Seller Score", "Motivated Seller Flags", "Source", "Public Records URL",
)
CRM_COLUMNS = (
    "first_name", "last_name", "mail_address", "mail_city", "mail_state", "mail_zip", "prop_address", "prop_city", "prop_state", "prop_zip",
    "cat_label", "doc_type", "filed", "doc_num", "amount", "score", "flags", "source", "url",
)


def crm_rows(leads: DataFrame) -> DataFrame:
    """Leads under the export's header; columns they lack are empty."""
    have = set(leads.columns)
    value = {
        "amount": lambda: F.when(F.col("amount") > 0, F.format_string("%.2f", F.col("amount").cast("decimal(18,2)").cast("double"))).otherwise(""),
        "flags": lambda: F.array_join("flags", " | "),
    }
    return leads.select(*[(value[c]() if c in value and c in have else F.coalesce(F.col(c).cast("string"), F.lit("")) if c in have else F.lit("")).alias(h) for c, h in zip(CRM_COLUMNS, CRM_HEADER)])


# The header of the foreclosure export and the columns under it.
FORECLOSURE_HEADER = (
    "Sale Date", "Days Until Sale", "Status", "Doc Number", "Doc Type", "Recorded Date", "Property Address (legal)", "Owner (from PDF)", "Loan Amount (from PDF)", "Public Records URL",
)
FORECLOSURE_COLUMNS = ("sale_date", "days_until_sale", "status", "doc_num", "doc_type", "recorded", "legal", "owner", "loan_amount", "clerk_url")


def foreclosure_rows(records: DataFrame) -> DataFrame:
    """Foreclosures under the export's header; an amount has two decimals, zero and null are empty."""
    amount = F.when(F.col("loan_amount") != 0, F.format_string("%.2f", F.col("loan_amount").cast("double"))).otherwise("")
    return records.select(*[(amount if c == "loan_amount" else F.coalesce(F.col(c).cast("string"), F.lit(""))).alias(h) for c, h in zip(FORECLOSURE_COLUMNS, FORECLOSURE_HEADER)])


def applied(plan: DataFrame, path: str, *, apply: bool = False, fmt: str = "json") -> DataFrame:
    """The plan of a run; it takes the place of what path holds only with apply, and never if empty."""
    if apply and not plan.isEmpty():
        replaced(plan, path, fmt)
    return plan


def write_crm(leads: DataFrame, path: str) -> None:
    crm_rows(leads).write.mode("overwrite").option("header", True).option("emptyValue", "").csv(path)


def run_log(results: DataFrame, column: str = "result") -> DataFrame:
    return results.groupBy(column).agg(F.count("*").alias("n"))


def changes(before: DataFrame, after: DataFrame, key: str, column: str) -> DataFrame:
    """What a run would change: key, old, new. Nothing is written."""
    both = before.select(key, F.col(column).alias("old")).join(after.select(key, F.col(column).alias("new")), key)
    return both.where(~F.col("old").eqNullSafe(F.col("new")))
