"""Address functions.  Four normal forms with different ends; not to be merged."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Parameters that do not choose a page, for each normal form.
TRACKING_FOR_DEDUP = ["fbclid", "gclid", "mc_cid", "mc_eid", "ref", "source", "utm_campaign", "utm_content", "utm_medium", "utm_source", "utm_term"]
TRACKING_FOR_LEDGER = ["_sp", "fbclid", "gclid"]

_PARTS = r"^([A-Za-z][A-Za-z0-9+.\-]*):(?://)?([^/?#]*)([^?#]*)(?:\?([^#]*))?(?:#.*)?$"


def _part(url: Column, n: int) -> Column:
    return F.regexp_extract(F.regexp_replace(F.coalesce(url, F.lit("")), r"^\s+|\s+$", ""), _PARTS, n)


def scheme(url: Column) -> Column:
    return F.lower(_part(url, 1))


def host(url: Column) -> Column:
    return F.lower(_part(url, 2))


def path(url: Column) -> Column:
    return _part(url, 3)


def query(url: Column) -> Column:
    return _part(url, 4)


def _pairs(url: Column, dropped: list[str], dropped_prefix: str | None = None) -> Column:
    """Parameters in their order, without the dropped ones; one without value gets an empty one."""
    pairs = F.filter(F.split(query(url), "&"), lambda p: p != "")
    name = lambda p: F.lower(F.split(p, "=", 2)[0])
    keep = lambda p: ~name(p).isin(dropped) & (~F.startswith(name(p), F.lit(dropped_prefix)) if dropped_prefix else F.lit(True))
    return F.transform(F.filter(pairs, keep), lambda p: F.when(F.contains(p, F.lit("=")), p).otherwise(F.concat(p, F.lit("="))))


def _with_query(pairs: Column) -> Column:
    return F.when(F.size(pairs) > 0, F.concat(F.lit("?"), F.array_join(pairs, "&"))).otherwise("")


def dedup_key(url: Column) -> Column:
    """For exact duplicates: lower scheme and host, single slashes, no slash at the
    end, tracking parameters dropped, the others sorted, no fragment.  Blank
    addresses become "/"."""
    p = F.regexp_replace(F.regexp_replace(path(url), "/{2,}", "/"), "/+$", "")
    start = F.when(scheme(url) != "", F.concat(scheme(url), F.lit("://"), host(url))).otherwise("")
    return F.concat(start, F.when(p == "", "/").otherwise(p), _with_query(F.array_sort(_pairs(url, TRACKING_FOR_DEDUP))))


def ledger_key(url: Column) -> Column:
    """For the ledger: lower scheme and host, tracking parameters dropped, order and
    path kept, no fragment.  Blank stays empty."""
    start = F.concat(scheme(url), F.lit("://"), host(url))
    return F.when(scheme(url) == "", "").otherwise(F.concat(start, path(url), _with_query(_pairs(url, TRACKING_FOR_LEDGER, "utm_"))))


def page_address(url: Column) -> Column:
    """For scraping: lower scheme and host, single slashes, query kept, no fragment."""
    q = F.when(query(url) != "", F.concat(F.lit("?"), query(url))).otherwise("")
    return F.when(scheme(url) == "", "").otherwise(F.concat(scheme(url), F.lit("://"), host(url), F.regexp_replace(path(url), "/{2,}", "/"), q))


def without_fragment(url: Column) -> Column:
    return F.regexp_replace(F.coalesce(url, F.lit("")), "#.*$", "")


def with_parameter(url: Column, name: str, value: str) -> Column:
    """``url`` with a parameter set, replaced where it stands or appended."""
    has = url.rlike(rf"[?&]{name}=")
    mark = F.when(F.contains(url, F.lit("?")), "&").otherwise("?")
    return F.when(has, F.regexp_replace(url, rf"([?&]{name}=)[^&#]*", f"$1{value}")).otherwise(F.concat(url, mark, F.lit(f"{name}={value}")))


def last_number(url: Column) -> Column:
    """The last run of digits of the path, as feeds carry their id."""
    return F.regexp_extract(path(url), r"(\d+)\D*$", 1)


def looks_like_article(url: Column) -> Column:
    """A page with a number, a date or a long slug, no listing, search or asset."""
    p = F.lower(path(url))
    good = p.rlike(r"\d{3,}|/20\d{2}/|[a-z]+-[a-z]+-[a-z0-9]+|\.s?html?$|/s/")
    return good & ~p.rlike(r"/(?:tag|category|search|login|page)/|\.(?:jpg|png|gif|css|js|pdf)$|^/?$")


def _without_dots(p: Column) -> Column:
    """A path without "." and ".." segments, by RFC 3986, 5.2.4."""
    parts = F.split(p, "/", -1)
    dot = lambda x: x.isin(".", "..")
    pop = lambda kept: F.when(F.size(kept) > 1, F.slice(kept, 1, F.size(kept) - 1)).otherwise(kept)
    kept = F.aggregate(parts, F.array().cast("array<string>"), lambda kept, x: F.when(x == "..", pop(kept)).when(x == ".", kept).otherwise(F.array_append(kept, x)))
    ends = dot(F.element_at(parts, -1))
    return F.array_join(F.when(ends, F.array_append(kept, F.lit(""))).otherwise(kept), "/")


def resolved(base: Column, href: Column) -> Column:
    """``href`` against ``base`` by the rules of RFC 3986, 5.2; null as empty.  All in the JVM."""
    parts = r"^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(\?[^#]*)?(#.*)?$"
    trimmed = lambda c: F.regexp_replace(F.coalesce(c, F.lit("")), r"^\s+|\s+$", "")
    of = lambda c, n: F.regexp_extract(trimmed(c), parts, n)
    bs, ba, bp, bq = (of(base, n) for n in range(1, 5))
    rs, ra, rp, rq, rf = (of(href, n) for n in range(1, 6))
    own_host = ra != ""
    merged = F.when((ba != "") & (bp == ""), F.concat(F.lit("/"), rp)).otherwise(F.concat(F.regexp_extract(bp, "^(.*/)[^/]*$", 1), rp))
    path_ = F.when(own_host | F.startswith(rp, F.lit("/")), _without_dots(rp)).when(rp == "", bp).otherwise(_without_dots(merged))
    query_ = F.when((rp == "") & ~own_host & (rq == ""), bq).otherwise(rq)
    host_ = F.when(own_host, ra).otherwise(ba)
    start = F.concat(F.when(bs != "", F.concat(bs, F.lit(":"))).otherwise(""), F.when(host_ != "", F.concat(F.lit("//"), host_)).otherwise(""))
    return F.when(rs != "", trimmed(href)).otherwise(F.concat(start, path_, query_, rf))
