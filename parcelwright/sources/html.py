"""Tables, links and label-value pairs of HTML pages, with the standard library's parser."""

from __future__ import annotations

import re
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Cells that stand for nothing.
PLACEHOLDERS = {"", "-", "--", "N/A", "--/--/--"}


class _Reader(HTMLParser):
    """Collects links, table rows, definition pairs in one pass."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.links: list[dict] = []
        self.rows: list[list[str]] = []
        self.tables: list[int] = []  # the table of each row
        self._open, self._n_tables = [0], 0
        self.pairs: list[tuple[str, str]] = []
        self._cell: list[str] | None = None
        self._row: list[str] = []
        self._link: dict | None = None
        self._term: list[str] | None = None
        self._label = ""

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag == "a":
            self._link = {"href": dict(attrs).get("href") or "", "text": ""}
        elif tag in ("tr", "table"):
            self._close_row()
            if tag == "table":
                self._n_tables += 1
                self._open.append(self._n_tables)
        elif tag in ("td", "th"):
            self._cell = []
        elif tag in ("dt", "dd"):
            self._term = []

    def handle_endtag(self, tag: str) -> None:
        if tag == "a" and self._link is not None:
            self._link["text"] = " ".join(self._link["text"].split())
            self.links.append(self._link | {"pos": len(self.links)})
            self._link = None
        elif tag in ("td", "th") and self._cell is not None:
            self._row.append(" ".join("".join(self._cell).split()))
            self._cell = None
        elif tag in ("tr", "table"):
            self._close_row()
            if tag == "table" and len(self._open) > 1:
                self._open.pop()
        elif tag in ("dt", "dd") and self._term is not None:
            text = " ".join("".join(self._term).split())
            if tag == "dt":
                self._label = text.rstrip(":").strip()
            elif self._label:
                self.pairs.append((self._label, text))
            self._term = None

    def handle_data(self, data: str) -> None:
        if self._link is not None:
            self._link["text"] += data
        if self._cell is not None:
            self._cell.append(data)
        if self._term is not None:
            self._term.append(data)

    def _close_row(self) -> None:
        if self._row:
            self.rows.append(self._row)
            self.tables.append(self._open[-1])
            if len(self._row) == 2 and self._row[0].endswith(":"):
                self.pairs.append((self._row[0].rstrip(":").strip(), self._row[1]))
        self._row = []


def read(page: str | None) -> _Reader:
    r = _Reader()
    try:
        r.feed(page or "")
        r.close()
    except (AssertionError, ValueError):  # a page that can't be read gives what was read so far
        pass
    r._close_row()
    return r


@F.pandas_udf(T.ArrayType(T.StructType([T.StructField("pos", T.IntegerType()), T.StructField("href", T.StringType()), T.StructField("text", T.StringType())])))
def links(pages: pd.Series) -> pd.Series:
    return pages.map(lambda p: read(p).links)


@F.pandas_udf(T.ArrayType(T.MapType(T.StringType(), T.StringType())))
def table_rows(pages: pd.Series) -> pd.Series:
    """Each row of the page's tables as a map from its table's header, the table's first row;
    a row of another width has the header's first names. Placeholders are left out."""

    def rows(page: str | None) -> list[dict]:
        out: list[dict] = []
        heads: dict[int, list[str]] = {}
        found = read(page)
        for n, row in zip(found.tables, found.rows):
            if n not in heads:
                heads[n] = [re.sub(r"[^a-z0-9]+", "_", c.lower()).strip("_") for c in row]
                continue
            out.append({k: v for k, v in zip(heads[n], row) if k and v not in PLACEHOLDERS})
        return out

    return pages.map(rows)


@F.pandas_udf(T.MapType(T.StringType(), T.StringType()))
def label_pairs(pages: pd.Series) -> pd.Series:
    """Label and value of definition lists and two-cell rows; the first of a label counts."""
    return pages.map(lambda p: dict(reversed(read(p).pairs)))


def title(page: Column | str) -> Column:
    found = F.regexp_extract(F.col(page) if isinstance(page, str) else page, r"(?is)<title[^>]*>(.*?)</title>", 1)
    return F.trim(F.regexp_replace(found, r"\s+", " "))
