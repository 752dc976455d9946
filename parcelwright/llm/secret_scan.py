"""Secrets in texts, and parts that are credentials only together.

Texts are searched once for secrets that stand for themselves (BASE) and for parts that mean nothing
alone (WEAK): an identifier, a random-looking string, an endpoint. Only their places leave the
text. A weak part's scope is what lies within `reach` code points of it, up to a blank line; an
interval join over cells of the text finds the parts of other roles in it. A weak part is reported
if one of those stands for itself, or if both other roles are there.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

#: Kinds in the order in which spans of one start are listed, and the role of each.
KINDS = ("assign", "access", "hex", "identifier", "blob", "endpoint")
ROLES = ("secret", "access", "secret", "access", "secret", "endpoint")
#: So many of KINDS stand for themselves.
N_BASE = 3

ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
LEAST = {"assign": 6, "access": 20, "hex": 24}
IDENTIFIER = r"""((client|account|tenant|user|key|access_?key)[_-]?id|login|username)["']?\x20*[:=]\x20*["']?[A-Za-z0-9_.@-]+"""
BLOB = r"[A-Za-z0-9+/_-]+"
#: A blob has 20 characters at least, among them a capital, a small letter and a digit.
LEAST_BLOB = 20
ENDPOINT = r"""[a-z][a-z0-9+.-]*://[^\x20\x09-\x0D"'<>]+"""
BLANK = r"\n[\x20\x09\x0D]*\n"
#: Code points from a weak part to what belongs to it.
REACH = 300
#: Code points of a cell of the interval join.
CELL = 256

_FLAGS = re.ASCII | re.IGNORECASE
_ASSIGN, _IDENTIFIER, _ENDPOINT, _BLANK = re.compile(ASSIGN, _FLAGS), re.compile(IDENTIFIER, _FLAGS), re.compile(ENDPOINT, _FLAGS), re.compile(BLANK)
# A run that is too short fails as a whole, so its length may stand in the pattern.
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
_BLOB = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}")
_MIXED = [re.compile(p) for p in ("[A-Z]", "[a-z]", "[0-9]")]
#: What a text in lower case must hold for a pattern to match.
_NEEDS = (("password", "passwd", "secret", "token", "apikey", "api_key"), ("id", "login", "username"))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the secrets that stand for themselves, in order of kind."""
    low = text.lower()
    out = []
    if any(w in low for w in _NEEDS[0]):
        out += [(0, *m.span()) for m in _ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    if "AKIA" in text:
        out += [(1, *m.span()) for m in _ACCESS.finditer(text)]
    return out + [(2, *m.span()) for m in _HEX.finditer(text)]


def weak_spans(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the parts that mean nothing alone and share nothing with base."""
    low = text.lower()
    out = []
    if ("=" in text or ":" in text) and any(w in low for w in _NEEDS[1]):
        out += [(3, *m.span()) for m in _IDENTIFIER.finditer(text)]
    out += [(4, *m.span()) for m in _BLOB.finditer(text) if all(p.search(m[0]) for p in _MIXED)]
    if "://" in text:
        out += [(5, *m.span()) for m in _ENDPOINT.finditer(text)]
    if base and out:
        # Base spans of different kinds may overlap: join them before looking.
        joined: list[list[int]] = []
        for _, a, b in sorted(base, key=lambda s: s[1]):
            if joined and a < joined[-1][1]:
                joined[-1][1] = max(joined[-1][1], b)
            else:
                joined.append([a, b])
        starts = [a for a, _ in joined]
        out = [s for s in out if (k := bisect_right(starts, s[2] - 1)) == 0 or joined[k - 1][1] <= s[1]]
    return out


_SPAN = pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64()), ("para", pa.int64())])


def _found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n = TaskContext.get().partitionId() << 33
    for batch in batches:
        spans = []
        for text in batch.column(1):
            text = text.as_py() or ""
            base = base_spans(text)
            all_ = base + weak_spans(text, base)
            ends = [m.end() for m in _BLANK.finditer(text)] if all_ else []
            spans.append([{"start": a, "kind": k, "end": b, "para": bisect_right(ends, a)} for k, a, b in all_])
        yield pa.RecordBatch.from_arrays([pa.array(range(n, n + len(spans)), pa.int64()), batch.column(0), pa.array(spans, pa.list_(_SPAN))], names=["uid", "id", "spans"])
        n += len(spans)


def scan_secrets(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", reach: int = REACH) -> DataFrame:
    """One row for each row of docs: id_col, base and linked, both arrays of (start, kind, end).

    base has the spans that stand for themselves, found leftmost and without overlaps within a
    kind; linked the weak parts that other parts complete. Offsets are code points, ends are
    exclusive; both are sorted by start, then kind. A null or empty text has none of either, an
    empty table gives none; ids may be null or repeated, a row stays a row. Other columns play no
    part. A text may have 2 GB at most.
    """
    kind = dict(docs.dtypes)[id_col]
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    span = "struct<start: bigint, kind: int, end: bigint, para: bigint>"
    rows = written(rows.mapInArrow(_found, f"uid long, id {kind}, spans array<{span}>"), "spans")
    linked = _linked(rows, reach).groupBy("uid").agg(F.array_sort(F.collect_list(F.struct("start", "kind", "end"))).alias("linked"))
    base = F.array_sort(F.transform(F.filter("spans", lambda s: s["kind"] < N_BASE), lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))))
    none = F.array().cast("array<struct<start: bigint, kind: int, end: bigint>>")
    out = rows.select("uid", "id", base.alias("base")).join(linked, "uid", "left")
    return out.select(F.col("id").alias(id_col), "base", F.coalesce("linked", none).alias("linked"))


def _linked(rows: DataFrame, reach: int) -> DataFrame:
    """The weak parts (uid, start, kind, end) that other parts complete."""
    roles = F.array(*[F.lit(r) for r in ROLES])
    weak = lambda c: c >= N_BASE
    parts = rows.where(F.exists("spans", lambda s: weak(s["kind"]))).where(F.size("spans") > 1).select("uid", F.explode("spans").alias("s")).select("uid", "s.*")
    parts = parts.withColumn("role", F.element_at(roles, F.col("kind") + 1))
    cells = lambda a, b: F.explode(F.sequence(F.floor(F.greatest(a, F.lit(0)) / CELL), F.floor(b / CELL)))
    scopes = parts.where(weak(F.col("kind"))).withColumn("cell", cells(F.col("start") - reach, F.col("end") + reach - 1))
    others = parts.select("uid", "para", F.col("start").alias("a"), F.col("end").alias("z"), F.col("role").alias("other"), (~weak(F.col("kind"))).alias("strong"))
    others = others.withColumn("cell", cells(F.col("a"), F.col("z") - 1))
    near = (F.col("a") < F.col("end") + reach) & (F.col("z") > F.col("start") - reach) & (F.col("other") != F.col("role"))
    met = scopes.join(others, ["uid", "para", "cell"]).where(near)
    held = met.groupBy("uid", "start", "kind", "end").agg(F.max("strong").alias("strong"), F.min("other").alias("one"), F.max("other").alias("another"))
    return held.where(F.col("strong") | (F.col("one") != F.col("another"))).select("uid", "start", "kind", "end")


def as_text(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")
