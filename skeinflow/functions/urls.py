"""Addresses, split by the generic syntax of RFC 3986 so that nothing throws."""

from __future__ import annotations

from urllib.parse import uses_netloc

from pyspark.sql import Column
from pyspark.sql import functions as F

from .terms import TRACKING

#: Schemes whose addresses name a host.
WITH_HOST = sorted(x for x in uses_netloc if x)
PARTS = r"^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#.*)?$"


def clean(url: Column) -> Column:
    """The address without controls and blanks around it, nor tabs and line ends within."""
    return F.regexp_replace(F.regexp_replace(url, r"^[\x00-\x20]+|[\s\p{Z}]+$", ""), r"[\t\r\n]", "")


def part(url: Column, k: int) -> Column:
    return F.regexp_extract(clean(url), PARTS, k)


def host(url: Column) -> Column:
    """Network location in lower case without a leading www."""
    return F.regexp_replace(F.lower(part(url, 2)), r"^www\.", "")


def params(url: Column) -> Column:
    """Decoded (name, value) of the query in order; empty segments go, a bare name has an empty value."""

    def decode(x: Column) -> Column:
        return F.coalesce(F.try_url_decode(x), F.replace(x, F.lit("+"), F.lit(" ")))

    def pair(kv: Column) -> Column:
        both = F.split(kv, "=", 2)
        return F.struct(decode(both[0]).alias("name"), F.coalesce(decode(F.get(both, F.lit(1))), F.lit("")).alias("value"))

    return F.transform(F.filter(F.split(part(url, 4), "&"), lambda kv: kv != ""), pair)


def encode(c: Column) -> Column:
    """Percent encoding that keeps ~ and encodes *."""
    return F.replace(F.replace(F.url_encode(c), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def canonical(url: Column) -> Column:
    """The address that tells whether two links are one: no tracking parameters, fragment, www. or closing slash."""
    names = F.array(*[F.lit(t) for t in TRACKING])
    kept = F.filter(params(url), lambda p: ~F.array_contains(names, F.lower(p["name"])))
    query = F.array_join(F.transform(kept, lambda p: F.concat(encode(p["name"]), F.lit("="), encode(p["value"]))), "&")
    scheme, where = F.lower(part(url, 1)), host(url)
    path = F.regexp_replace(part(url, 3), "/+$", "")
    path = F.when(path == "", "/").otherwise(path)
    # without a host, slashes keep a path from being read as one
    bare = path.startswith("//") | scheme.isin(*WITH_HOST)
    out = F.concat(
        F.when(scheme != "", F.concat(scheme, F.lit(":"))).otherwise(""),
        F.when(where != "", F.concat(F.lit("//"), where)).when(bare & path.startswith("/"), "//").otherwise(""),
        path,
        F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""),
    )
    return F.when(F.coalesce(url, F.lit("")) == "", "").otherwise(out)
