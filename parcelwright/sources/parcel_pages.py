"""Result lists and detail pages of a parcel search: each page is parsed once, the rest are columns."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.addresses import split_address
from ..functions.base import C, blank, col, first_filled, let, text
from ..functions.mail import mail_block, mail_lines
from ..functions.money import money

# The classes of a result's cells, and the call that opens its detail page.
CELLS = {
    "owner": "_ownerName", "situs": "_address", "type": "_propertyType", "prop_id": "_propertyId", "owner_id": "_ownerId",
    "legal": "_legalDescription", "value": "_appraisedValueDisplay", "account": "_geoId",
}
DETAIL_CALL = r"redirectToPropertyDetails\(\s*'([^']*)'\s*,\s*'([^']*)'\s*,\s*'([^']*)'"
# Words of a label that names a value, the most telling first; labels of a legal description and an account.
VALUE_LABELS = (("market", "value"), ("appraised", "value"), ("assessed", "value"), ("total", "value"))
LEGAL_LABEL = "legal description"
ACCOUNT_LABELS = ("geographic id", "geo id")

_EMPTY = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
#: What a start tag closes, and what keeps it from closing more.
_ENDS = {"td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "tr": ({"tr"}, {"table"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"})}


class _Node:
    def __init__(self, tag: str, attrs: dict) -> None:
        self.tag, self.attrs, self.parts = tag, attrs, []

    def nodes(self) -> Iterator[_Node]:
        """All nodes below, in the order of the page; by a stack, so depth has no limit."""
        waiting = [p for p in reversed(self.parts) if isinstance(p, _Node)]
        while waiting:
            node = waiting.pop()
            yield node
            waiting += [p for p in reversed(node.parts) if isinstance(p, _Node)]

    def words(self, between: str) -> str:
        """The texts below, white space squeezed, joined."""
        found, waiting = [], [self]
        while waiting:
            part = waiting.pop()
            if isinstance(part, _Node):
                waiting += reversed(part.parts)
            elif piece := " ".join(part.split()):
                found.append(piece)
        return between.join(found)

    def classes(self) -> list[str]:
        return (self.attrs.get("class") or "").split()

    def first(self, pattern: str) -> _Node | None:
        """The first node below of which a class has the pattern."""
        return next((n for n in self.nodes() if any(re.search(pattern, c, re.I) for c in n.classes())), None)


class _Tree(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = _Node("", {})
        self.open = [self.root]

    def handle_starttag(self, tag: str, attrs: list) -> None:
        closes, kept = _ENDS.get(tag, ((), ()))
        self._close(closes, kept)
        node = _Node(tag, dict(attrs))
        self.open[-1].parts.append(node)
        if tag not in _EMPTY:
            self.open.append(node)

    def handle_endtag(self, tag: str) -> None:
        self._close({tag}, {"table"} - {tag})

    def handle_data(self, data: str) -> None:
        if self.open[-1].tag not in ("script", "style"):
            self.open[-1].parts.append(data)

    def _close(self, tags: set | tuple, kept: set | tuple) -> None:
        for depth in range(len(self.open) - 1, 0, -1):
            if self.open[depth].tag in tags:
                del self.open[depth:]
                return
            if self.open[depth].tag in kept:
                return


def _tree(page: str | None) -> _Node:
    tree = _Tree()
    try:
        tree.feed(page or "")
        tree.close()
    except (AssertionError, ValueError):  # a page that can't be read gives what was read so far
        pass
    return tree.root


def _texts(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def _results(page: str | None) -> list[dict]:
    out = []
    for row in (n for n in _tree(page).nodes() if n.tag == "tr"):
        cells: dict[str, str] = {}
        for cell in (n for n in row.nodes() if n.tag == "td"):
            for c in cell.classes():
                cells.setdefault(c, cell.words(" "))
        found = {k: cells.get(c, "") for k, c in CELLS.items()}
        call = re.search(DETAIL_CALL, row.attrs.get("onclick") or "")
        found["year"] = call[2] if call else ""
        found["owner_id"] = found["owner_id"] or (call[3] if call else "")
        if found["owner"] or found["situs"] or found["prop_id"]:
            out.append(found)
    return out


@F.pandas_udf(T.ArrayType(_texts(*CELLS, "year")))
def _read_results(pages: pd.Series) -> pd.Series:
    return pages.map(_results)


def search_rows(page: C, *, default_year: str = "", by_id: bool = False) -> Column:
    """The rows of a result list, array of struct(owner, situs, type, prop_id, owner_id, year,
    legal, appraised_value, account).

    Year and owner's id come from the call that opens the detail page, the year else is the
    default. A row needs an owner or an address; with by_id a parcel's id will do.
    """
    rows = F.filter(_read_results(col(page)), lambda r: F.lit(by_id) | (r["owner"] != "") | (r["situs"] != ""))
    names = ("owner", "situs", "type", "prop_id", "owner_id")
    return F.transform(
        rows,
        lambda r: F.struct(
            *[r[n].alias(n) for n in names], F.when(r["year"] == "", default_year).otherwise(r["year"]).alias("year"), r["legal"].alias("legal"), money(r["value"]).alias("appraised_value"), r["account"].alias("account")
        ),
    )


def _detail(page: str | None) -> dict:
    """Labels (lower case) with their texts, a line for each piece of text: definition lists, then
    cards of an address, then two-cell rows; and what follows the words of a legal description."""
    root = _tree(page)
    pairs: dict[str, str] = {}
    for dl in (n for n in root.nodes() if n.tag == "dl"):
        terms, values = ([n for n in dl.nodes() if n.tag == t] for t in ("dt", "dd"))
        for term, value in zip(terms, values):
            label, said = term.words(" ").lower().rstrip(":"), value.words("\n")
            if label and said:
                pairs[label] = said
    for card in (n for n in root.nodes() if any(re.search("card|panel|section", c, re.I) for c in n.classes())):
        head, body = card.first("header|title"), card.first("body|content")
        if head is not None and body is not None:
            named = head.words(" ").lower()
            label = "situs address" if "situs" in named or "property address" in named else "mailing address" if "mail" in named else ""
            if label:
                pairs.setdefault(label, body.words("\n"))
    for row in (n for n in root.nodes() if n.tag == "tr"):
        cells = [n for n in row.nodes() if n.tag in ("td", "th")][:2]
        if len(cells) == 2:
            label, said = cells[0].words(" ").lower().rstrip(":"), cells[1].words("\n")
            if label and said:
                pairs.setdefault(label, said)
    told = re.search(r"legal\s+description\s*:?\s*([^\n]+)", root.words("\n"), re.I)
    return {"pairs": [{"label": k, "value": v} for k, v in pairs.items()], "told": told[1].strip() if told else ""}


@F.pandas_udf(T.StructType([T.StructField("pairs", T.ArrayType(_texts("label", "value"))), T.StructField("told", T.StringType())]))
def detail(pages: pd.Series) -> pd.DataFrame:
    """A detail page, read once: struct(pairs, told); the columns below take what they need of it."""
    return pd.DataFrame([_detail(p) for p in pages], columns=["pairs", "told"])


def labelled(page: C, *words: str, never: str | None = None) -> Column:
    """The text of the first label that holds all the words (and not `never`), else null."""

    def fits(p: Column) -> Column:
        test = F.lit(True) if never is None else ~F.contains(p["label"], F.lit(never))
        for w in words:
            test = test & F.contains(p["label"], F.lit(w))
        return test

    return F.get(F.filter(col(page)["pairs"], fits), F.lit(0))["value"]


def page_value(page: C) -> Column:
    """The value of a parcel: that of the most telling label which has a positive amount."""

    def amount(words: tuple[str, ...]) -> Column:
        named = F.filter(col(page)["pairs"], lambda p: F.contains(p["label"], F.lit(words[0])) & F.contains(p["label"], F.lit(words[1])))
        return F.get(F.filter(F.transform(named, lambda p: money(p["value"])), lambda v: v > 0), F.lit(0))

    return F.coalesce(*[amount(w) for w in VALUE_LABELS])


def page_record(page: C, *, city: str, state: str = "TX") -> Column:
    """struct of a page's address, mailing address and value; null where it has none of them.

    Addresses are split at commas; a city or state of the parcel that is missing is the default.
    """
    line = lambda *found: let(F.replace(F.coalesce(*found), F.lit("\n"), F.lit(" ")), split_address)
    site = line(labelled(page, "situs"), labelled(page, "property", "address")).alias("site")
    post = line(labelled(page, "mailing", "address"), labelled(page, "mail", "address"), labelled(page, "owner", "address")).alias("post")
    return let(F.struct(site, post, page_value(page).alias("value")), lambda x: _record(x["site"], x["post"], x["value"], city, state))


def _record(site: Column, post: Column, value: Column, city: str, state: str) -> Column:
    parts = [site["street"].alias("site_address"), first_filled(site["city"], F.lit(city)).alias("site_city"), first_filled(site["state"], F.lit(state)).alias("site_state"), site["zip"].alias("site_zip")]
    parts += [post[k].alias(f"mail_{n}") for k, n in (("street", "address"), ("city", "city"), ("state", "state"), ("zip", "zip"))]
    return F.when(~blank(site["street"]) | ~blank(post["street"]) | value.isNotNull(), F.struct(*parts, value.alias("appraised_value")))


def page_mail(page: C, *, cities: tuple[str, ...] = ()) -> Column:
    """The mailing block of a page, from a label of its own and never from that of the parcel; null
    where there is none."""
    block = F.coalesce(labelled(page, "mailing", "address", never="situs"), labelled(page, "mailing", never="situs"))
    return let(block, lambda b: F.when(b.isNotNull(), mail_block(b, cities=cities)))


def page_mail_lines(page: C) -> Column:
    """struct(street, city, state, zip, account) of a page's mailing cell and account number."""
    account = F.replace(text(F.coalesce(*[labelled(page, w) for w in ACCOUNT_LABELS])), F.lit("\n"), F.lit(" "))
    lines = let(labelled(page, "mailing address"), mail_lines)
    return let(lines, lambda m: F.struct(*[m[k].alias(k) for k in ("street", "city", "state", "zip")], account.alias("account")))


def page_legal(page: C) -> Column:
    """The legal description: by its label, else what follows the words anywhere, else ""."""
    return F.coalesce(F.replace(labelled(page, LEGAL_LABEL), F.lit("\n"), F.lit(" ")), col(page)["told"], F.lit(""))
