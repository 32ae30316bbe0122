"""Column functions on URLs, all built-in.

A URL is taken apart by one pattern that accepts what browsers accept (blanks and pipes in paths, missing paths), where
``parse_url`` fails. A text that is no absolute http(s) URL has null parts.
"""

from __future__ import annotations

import ipaddress

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_URL = r"(?i)^\s*(https?)://(?:([^/?#@\s]*)@)?([^/?#:\s]+)(?::([0-9]+))?([^?#]*)(\?[^#]*)?(#.*)?\s*$"
#: Query parameters that track a visit and tell nothing of the page.
TRACKING = r"^(utm_.*|fbclid|gclid|ref)$"


def part(col: Column, name: str) -> Column:
    """scheme, user, host, port, path, query (with ?) or fragment (with #); '' where a URL has none, null for no URL."""
    n = ["scheme", "user", "host", "port", "path", "query", "fragment"].index(name) + 1
    v = F.regexp_extract(col, _URL, n)
    v = F.lower(v) if name in ("scheme", "host") else F.when((v == ""), "/").otherwise(v) if name == "path" else v
    return F.when(col.rlike(_URL), v)


def canonical_host(col: Column) -> Column:
    """Host in lower case without a last dot and a first www."""
    return F.nullif(F.regexp_replace(part(col, "host"), r"\.$|^www\.", ""), F.lit(""))


def normalise(col: Column) -> Column:
    """URL without fragment and without a slash at the end of the path; scheme and host in lower case, the query kept."""
    path = F.regexp_replace(part(col, "path"), "/$", "")
    port = part(col, "port")
    return F.concat(part(col, "scheme"), F.lit("://"), part(col, "host"), F.when(port != "", F.concat(F.lit(":"), port)).otherwise(""), path, part(col, "query"))


def canonical(col: Column, drop: str = TRACKING) -> Column:
    """Identity of a page: normalised, host without www, parameters that match ``drop`` left out, the others sorted."""
    given = F.filter(F.split(F.substring(part(col, "query"), 2, 100_000), "&"), lambda x: (x != "") & ~F.lower(F.regexp_extract(x, "^([^=]*)", 1)).rlike(drop))
    query = F.array_join(F.array_sort(given), "&")
    path = F.regexp_replace(part(col, "path"), "/+$", "")
    return F.concat(part(col, "scheme"), F.lit("://"), canonical_host(col), F.when(path == "", "/").otherwise(path), F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))


def after_host(col: Column) -> Column:
    """Path, query and fragment in lower case; the whole text in lower case where it is no URL."""
    return F.coalesce(F.lower(F.concat(part(col, "path"), part(col, "query"), part(col, "fragment"))), F.lower(col))


def variants(col: Column) -> Column:
    """Distinct array of the up to eight spellings of a URL by scheme, www and last slash; null for no URL."""
    host, scheme, path, rest = part(col, "host"), part(col, "scheme"), part(col, "path"), F.concat(part(col, "query"), part(col, "fragment"))
    hosts = F.array(host, F.when(F.startswith(host, F.lit("www.")), F.substring(host, 5, 1000)).otherwise(F.concat(F.lit("www."), host)))
    schemes = F.array(scheme, F.when(scheme == "https", "http").otherwise("https"))
    paths = F.when(path == "/", F.array(path)).otherwise(F.array(path, F.when(F.endswith(path, F.lit("/")), F.regexp_replace(path, "/$", "")).otherwise(F.concat(path, F.lit("/")))))
    each = F.flatten(F.transform(schemes, lambda s: F.flatten(F.transform(hosts, lambda h: F.transform(paths, lambda p: F.concat(s, F.lit("://"), h, p, rest))))))
    return F.when(col.rlike(_URL), F.array_distinct(each))


def parent_host(host: Column) -> Column:
    """A host without its first label, if two labels are left."""
    rest = F.regexp_extract(host, r"^[^.]+\.(.+\..+)$", 1)
    return F.nullif(rest, F.lit(""))


def decoded(col: Column, times: int = 4) -> Column:
    """Percent decoding, as often as it changes something, at most ``times``; undecodable text stays."""
    for _ in range(times):
        col = F.coalesce(F.try_url_decode(F.replace(col, F.lit("+"), F.lit("%2B"))), col)
    return col


def allowed(col: Column, hosts: list[str], banned: str = r"(?i)/(?:cart|checkout|account|login|legal|polic(?:y|ies)|privacy|terms)(?:[/._-]|$)") -> Column:
    """Whether a URL may be fetched: https, a listed host, no user or port, and no banned word in the decoded path."""
    return F.coalesce((part(col, "scheme") == "https") & part(col, "host").isin(*hosts) & (part(col, "user") == "") & (part(col, "port") == "") & ~decoded(part(col, "path")).rlike(banned), F.lit(False))


#: Sites that host many firms, and what they are.
SHARED_SITES = {"instagram.com": "social", "facebook.com": "social", "tiktok.com": "social", "youtube.com": "social", "linkedin.com": "social", "twitter.com": "social", "x.com": "social", "yelp.com": "directory", "google.com": "directory", "linktr.ee": "link_page", "etsy.com": "marketplace", "amazon.com": "marketplace", "wixsite.com": "site_builder"}


def shared_site_kind(host: Column, sites: dict[str, str] | None = None) -> Column:
    """What kind of shared site a host is or lies under; null for a host of its own."""
    sites = SHARED_SITES if sites is None else sites
    out = F.lit(None).cast("string")
    for suffix, kind in reversed(list(sites.items())):
        out = F.when((host == suffix) | F.endswith(host, F.lit("." + suffix)), kind).otherwise(out)
    return out


def link_kind(url: Column, text: Column | None = None) -> Column:
    """product, listing or null by the shape of a URL's path, or else by the words of its link."""
    path = F.lower(part(url, "path"))
    words = F.lit("") if text is None else F.lower(F.coalesce(text, F.lit("")))
    return F.when(path.rlike(r"/(?:products?|item|p)/[^/]+/?$"), "product").when(path.rlike(r"/(?:collections?|shop|store|menu|category|catalog)(?:/|$)"), "listing").when(words.rlike(r"^(?:shop|menu|store|all coffee|our coffees?)$"), "listing")


def private_ipv4(col: Column) -> Column:
    """Whether a dotted address is private, reserved or none at all."""
    o = [F.split(col, r"\.")[i].try_cast("int") for i in range(4)]
    good = col.rlike(r"^[0-9]{1,3}(\.[0-9]{1,3}){3}$") & (F.greatest(*o) <= 255)
    a, b = o[0], o[1]
    inner = a.isin(0, 10, 127) | (a >= 224) | ((a == 100) & b.between(64, 127)) | ((a == 169) & (b == 254)) | ((a == 172) & b.between(16, 31)) | ((a == 192) & b.isin(0, 168)) | ((a == 198) & b.isin(18, 19, 51)) | ((a == 203) & (b == 0))
    return F.when(F.coalesce(good, F.lit(False)), inner).otherwise(True)


def private_ip(col: Column) -> Column:
    """The same for IPv4 and IPv6, mapped addresses included."""

    return F.pandas_udf(_private_series, T.BooleanType())(col)


def _private_series(s: pd.Series) -> pd.Series:
    def one(x) -> bool:
        try:
            ip = ipaddress.ip_address(str(x).split("%")[0])
        except ValueError:
            return True
        ip = getattr(ip, "ipv4_mapped", None) or ip
        return not ip.is_global or ip.is_multicast or ip.is_reserved

    return s.map(one).astype(bool)
