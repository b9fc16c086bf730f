"""Records out of pages: payloads in scripts, cards around links, table rows, and which
source is read by which parser."""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from presslake.functions.html import Node, parse


def embedded_records(payload: Column, marker: str, fields: dict[str, str], required: list[str], holds: str | None = None) -> Column:
    """Records of a payload of data inside a page, as an array of structs.

    Each occurrence of ``marker`` begins a record that ends before the next one.
    ``fields`` gives a pattern with one group per name, read within the record; records
    without a ``required`` field, or without the text ``holds``, are left out.  Null
    and payloads without marker give an empty array."""
    parts = F.split(F.coalesce(payload, F.lit("")), re.escape(marker), -1)
    records = F.slice(F.transform(parts, lambda p: F.concat(F.lit(marker), p)), 2, F.greatest(F.size(parts) - 1, F.lit(0)))
    if holds is not None:
        records = F.filter(records, lambda r: F.contains(r, F.lit(holds)))
    read = F.transform(records, lambda r: F.struct(*[F.regexp_extract(r, p, 1).alias(name) for name, p in fields.items()]))
    return F.filter(read, lambda r: reduce(lambda a, b: a & b, [r[name] != "" for name in required], F.lit(True)))


def unescaped(c: Column) -> Column:
    """A JSON string's contents with its escapes resolved; null if they are broken."""
    return F.from_json(F.concat(F.lit('{"x":"'), c, F.lit('"}')), "x string")["x"]


def cards_of(page: str | None, href: str, needed: list[str], pattern: str) -> list[dict]:
    """Cards around links whose address matches ``href``: the nearest element around a
    link whose text has all ``needed`` words, with what ``pattern`` finds in it."""
    out = []
    for link in parse(page).walk():
        if link.tag != "a" or not re.search(href, link.attrs.get("href", "")):
            continue
        at: Node | None = link
        while at is not None and not all(w in at.text() for w in needed):
            at = at.parent
        if at is None:
            continue
        text = " ".join(at.text().split())
        if found := re.search(pattern, text):
            out.append({"href": link.attrs["href"].strip(), "title": " ".join(link.text().split()), "found": found.group(1), "text": text})
    return out


_CARD = StructType([StructField(n, StringType()) for n in ("href", "title", "found", "text")])


def cards(page: Column, href: str, needed: list[str], pattern: str) -> Column:
    """:func:`cards_of` in Arrow batches."""
    return F.pandas_udf(lambda pages: pages.map(lambda p: cards_of(p, href, needed, pattern)), ArrayType(_CARD))(page)


def stable_address(href: Column, parameter: str, address: str) -> Column:
    """``address`` with the number that a link carries in ``parameter``, case aside; null
    without one.  Session and paging parameters of the link don't count."""
    number = F.regexp_extract(href, rf"(?i)[?&]{re.escape(parameter)}=(\d+)", 1)
    return F.when(number != "", F.concat(F.lit(address), number))


Parser = Callable[[DataFrame], DataFrame]


def dispatch(frame: DataFrame, source: str, parsers: dict[str, Parser | None], generic: Parser) -> DataFrame:
    """Rows of each source through its own parser, all others (and sources registered
    with None) through ``generic``.  Parsers give the same columns; ``parser`` names the
    one that was used.  A parser sees its source's rows only; nothing is shuffled."""
    own = {k: p for k, p in parsers.items() if p is not None}
    known = F.coalesce(F.col(source).isin(list(own)), F.lit(False)) if own else F.lit(False)
    parts = [p(frame.where(F.col(source) == k)).withColumn("parser", F.lit(k)) for k, p in own.items()]
    parts.append(generic(frame.where(~known)).withColumn("parser", F.lit("generic")))
    return reduce(DataFrame.unionByName, parts)


def guarded(c: Column, read: Callable[[pd.Series], pd.Series], kind: str) -> Column:
    """``read`` per value, a failure as a row of its own: struct (value, error)."""

    def run(values: pd.Series) -> pd.DataFrame:
        rows = []
        for v in values:
            try:
                rows.append((read(v), None))
            except Exception as e:  # whatever a parser raises is the row's error
                rows.append((None, f"{type(e).__name__}: {e}"))
        return pd.DataFrame(rows, columns=["value", "error"])

    return F.pandas_udf(run, f"value {kind}, error string")(c)
