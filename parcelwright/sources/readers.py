"""Readers of landed files: JSON envelopes, pipe and fixed-width exports, tax rolls, reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.base import blank, group, squeeze, text
from ..functions.money import cell


def read_envelope(spark: SparkSession, path: str, record: T.StructType, key: str = "records") -> DataFrame:
    """Records of JSON files that hold {key: [...]} or a bare list. A file that can't be read gives none."""
    raw = spark.read.text(path, wholetext=True)
    wrapped = F.from_json("value", T.StructType([T.StructField(key, T.ArrayType(record))]), {"mode": "PERMISSIVE"})[key]
    bare = F.from_json("value", T.ArrayType(record), {"mode": "PERMISSIVE"})
    is_list = F.regexp_like("value", F.lit(r"^\s*\["))
    return raw.select(F.explode(F.when(is_list, bare).otherwise(wrapped)).alias("r")).where("r is not null").select("r.*")


def read_reference(spark: SparkSession, path: str) -> DataFrame:
    """A pipe-separated export (gzip or plain), all columns as trimmed text, a byte order mark left out."""
    df = spark.read.csv(path, sep="|", header=True, encoding="UTF-8")
    return df.select(*[F.trim(text(F.col(f"`{c}`"))).alias(c.lstrip("﻿")) for c in df.columns])


def parcel_class(improved: Column, land: Column) -> Column:
    """The improvement's code, else the land's."""
    return F.coalesce(F.nullif(F.trim(text(improved)), F.lit("")), F.trim(text(land)))


def read_fixed_width(spark: SparkSession, path: str, layout: Mapping[str, tuple[int, int]]) -> DataFrame:
    """Columns by 1-based first and last byte. Lines are read as ISO-8859-1, so a byte is a character."""
    lines = spark.read.option("encoding", "ISO-8859-1").csv(path, sep="\x01", header=False, quote="", schema="value string", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    return lines.select(*[F.trim(F.substring("value", a, b - a + 1)).alias(n) for n, (a, b) in layout.items()])


def exemptions_of(df: DataFrame, key: str, names: Sequence[str]) -> DataFrame:
    """The codes whose T/F column says T, joined by ";"."""
    codes = F.array_compact(F.array(*[F.when(F.col(n) == "T", n) for n in names]))
    return df.select(key, F.array_join(codes, ";").alias("exemptions")).where("exemptions <> ''")


def read_roll(df: DataFrame, fields: Mapping[int, str]) -> DataFrame:
    """Columns of a positional table by index; whole numbers lose their fraction."""
    def value(i: int) -> Column:
        c = F.col(f"`{df.columns[i]}`")
        return cell(c) if isinstance(df.schema[i].dataType, T.NumericType) else F.trim(text(c))

    return df.select(*[value(i).alias(n) for i, n in fields.items()])


def check_header(actual: Sequence[str], expected: Mapping[int, str], drifting: Mapping[int, str] | None = None) -> None:
    """Stops if a column stands elsewhere; a drifting one need only hold its text."""
    squeezed = [" ".join(str(h).split()).upper() for h in actual]
    wrong = [f"column {i}: {name!r} expected, {squeezed[i] if i < len(squeezed) else None!r} found" for i, name in expected.items() if i >= len(squeezed) or squeezed[i] != name.upper()]
    wrong += [f"column {i}: no {part!r} in it" for i, part in (drifting or {}).items() if i >= len(squeezed) or part.upper() not in squeezed[i]]
    if wrong:
        raise ValueError("; ".join(wrong))


def by_alias(df: DataFrame, aliases: Mapping[str, Sequence[str]]) -> DataFrame:
    """Logical columns from whichever of their header names is there; missing ones are empty."""
    known = {" ".join(c.split()).lower(): c for c in df.columns}
    return df.select(*[F.coalesce(*[F.col(f"`{known[a]}`").cast("string") for a in names if a in known], F.lit("")).alias(n) for n, names in aliases.items()])


# Header names of a violation export, by the field that they stand for.
VIOLATION_HEADERS = {
    "ref_no": ("reference no", "reference number", "ref no"),
    "create": ("create date", "created date", "create"),
    "close": ("close date", "closed date"),
    "status": ("status",),
    "case_type": ("case type",),
    "address": ("address 1", "address", "address1", "situs address"),
    "parcel": ("parcel id", "parcel"),
    "narr": ("violation_narrative", "violation narrative", "narrative"),
}
#: Rows of a sheet among which its header is looked for.
HEADER_ROWS = 80


def by_header(sheet: DataFrame, names: Mapping[str, Sequence[str]] = VIOLATION_HEADERS, required: Sequence[str] = ("ref_no", "case_type", "status")) -> DataFrame:
    """Rows (file, pos, cells array of text) below each file's header, a column for each field.

    The header is the first of HEADER_ROWS rows that names all required fields, wherever they
    stand; other fields may be missing and are empty. Rows without the first required field are
    left out, and so is a file without a header (see `without_header`).
    """
    head = F.transform("cells", lambda c: F.lower(squeeze(c)))
    place = lambda n: F.array_min(F.filter(F.transform(head, lambda c, i: F.when(c.isin(*names[n]), i)), lambda i: i.isNotNull()))
    seen = sheet.where(F.col("pos") < HEADER_ROWS).select("file", "pos", F.struct(*[place(n).alias(n) for n in names]).alias("at"))
    for n in required:
        seen = seen.where(F.col(f"at.{n}").isNotNull())
    heads = seen.groupBy("file").agg(F.min("pos").alias("head"), F.min_by("at", "pos").alias("at"))
    cell = lambda n: F.coalesce(F.trim(F.get("cells", F.col(f"at.{n}"))), F.lit(""))
    return sheet.join(heads, "file").where("pos > head").select("file", "pos", *[cell(n).alias(n) for n in names]).where(F.col(required[0]) != "")


def without_header(sheet: DataFrame, rows: DataFrame) -> DataFrame:
    """The files of a sheet of which by_header gave no row."""
    return sheet.select("file").distinct().join(rows.select("file").distinct(), "file", "left_anti")


def newest(spark: SparkSession, path: str, glob: str = "*") -> str | None:
    """The file with the latest MM-DD-YYYY in its name, else the one changed last."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path).select("path", "modificationTime")
    day = F.try_to_date(F.regexp_extract("path", r"(\d{2}-\d{2}-\d{4})[^/]*$", 1), "MM-dd-yyyy")
    row = files.agg(F.max_by("path", F.struct(day.isNotNull(), day, "modificationTime", "path")).alias("p")).first()
    return row.p


def read_notices(spark: SparkSession, path: str) -> DataFrame:
    """Whole texts with the ten-digit document number of their file's name."""
    raw = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("file"), F.col("value").alias("text"))
    return raw.withColumn("doc_num", F.regexp_extract("file", r"(\d{10})", 1))


def report_rows(lines: DataFrame, key: str = "file", line: str = "pos", value: str = "value") -> DataFrame:
    """A printed report to its cases: a line with a case number and an amount opens a case, the
    style may go on over the following lines until the next one."""
    case = r"^\s*(\d{4}DCV-[\w-]+|\d{2}-\d{4,5}-\d{2}-\d-[A-Z])\s+(.*?)\s+\$?([\d,]+\.\d{2})\s*$"
    at = Window.partitionBy(key).orderBy(line)
    opened = F.when(group(value, case) != "", group(value, case))
    filled = lines.withColumn("case_number", F.last(opened, ignorenulls=True).over(at)).where("case_number is not null")
    part = F.struct(line, F.when(group(value, case) != "", group(value, case, 2)).otherwise(F.trim(value)).alias("t"))
    out = filled.where(~F.regexp_like(value, F.lit(r"(?i)^\s*(page\b|total\b|run date).*$"))).groupBy(key, "case_number")
    return out.agg(F.array_join(F.transform(F.sort_array(F.collect_list(part)), lambda p: p["t"]), " ").alias("style"), F.max(group(value, case, 3)).alias("balance_raw")).select(
        key, "case_number", squeeze("style").alias("style"), F.replace("balance_raw", F.lit(","), F.lit("")).try_cast("double").alias("balance")
    )


def usable_cache(cache: DataFrame, version: int = 6, older: Sequence[int] = (3, 4, 5)) -> DataFrame:
    """Cached look-ups: all of the current version, of older ones the hits."""
    return cache.where((F.col("version") == version) | (F.col("version").isin(*older) & F.coalesce(F.col("hit"), F.lit(False))))


def without_blank(df: DataFrame, *columns: str) -> DataFrame:
    for c in columns:
        df = df.where(~blank(c))
    return df
