"""URL functions: RFC 3986 by one regex in the JVM; joining and quoting in Python."""

from __future__ import annotations

import re
from urllib.parse import quote, urljoin

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: scheme, authority, path, query, fragment: groups 2, 4, 5, 7, 9 (RFC 3986, appendix B).
PARTS = r"^(([^:/?#]+):)?(//([^/?#]*))?([^?#]*)(\?([^#]*))?(#(.*))?"
#: Fixed value: characters that percent-encoding leaves in a replay address.
SAFE = ":/?&=%;,+#@"


def part(url: Column, group: int) -> Column:
    return F.regexp_extract(url, PARTS, group)


def authority(url: Column) -> Column:
    """Host and port in lower case without user information."""
    return F.lower(F.regexp_replace(part(url, 4), "^.*@", ""))


def host(url: Column) -> Column:
    return F.regexp_replace(authority(url), r":\d*$", "")


def bare_host(url: Column) -> Column:
    return F.regexp_replace(host(url), r"^www\.", "")


def identity(url: Column) -> Column:
    """host (without www., with a port that isn't the scheme's own), path without slashes at its
    end, and query of an absolute URL, joined by spaces; null for null or empty."""
    scheme, name = F.lower(part(url, 2)), F.regexp_replace(authority(url), r"^www\.", "")
    default = ((scheme == "http") & name.rlike(":80$")) | ((scheme == "https") & name.rlike(":443$")) | name.rlike(":0*$")
    name = F.when(default, F.regexp_replace(name, r":\d*$", "")).otherwise(name)
    path = part(url, 5)
    path = F.when(path.isin("", "/"), "/").otherwise(F.regexp_replace(path, "/+$", ""))
    return F.when(F.coalesce(url, F.lit("")) != "", F.concat_ws(" ", name, path, part(url, 7)))


def equivalent(left: Column, right: Column) -> Column:
    return F.coalesce(identity(left) == identity(right), F.lit(False))


def archive_variants(url: Column) -> Column:
    """The forms under which an archive may hold a URL, in order, distinct: without fragment; by
    http in place of https; without query. Empty when there is no host."""
    scheme, net, path, query = part(url, 2), part(url, 4), part(url, 5), part(url, 7)
    tail = F.concat(path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))
    lead = F.when(scheme != "", F.concat(F.lower(scheme), F.lit("://"))).otherwise("//")
    forms = F.array(
        F.concat(lead, net, tail),
        F.when(F.lower(scheme) == "https", F.concat(F.lit("http://"), net, tail)),
        F.when(query != "", F.concat(lead, net, path)),
    )
    return F.when(F.coalesce(net, F.lit("")) != "", F.array_distinct(F.filter(forms, lambda x: x.isNotNull()))).otherwise(F.array().cast("array<string>"))


def capture_timestamp(url: Column) -> Column:
    return F.nullif(F.regexp_extract(F.coalesce(url, F.lit("")), r"/web/(\d{14})", 1), F.lit(""))


def is_offsite(url: Column, archive_host: str) -> Column:
    return host(url) != archive_host.lower()


def absolute(base: str | None, href: str | None) -> str | None:
    """``href`` seen from ``base``; null where it can't be read."""
    try:
        return None if href is None else urljoin(base or "", href)
    except ValueError:
        return None


def identity_text(url: str | None, base: str | None = None) -> str | None:
    """``identity`` for Python, of a URL that may be relative to ``base``; null without a host."""
    m = re.match(PARTS, absolute(base, url.strip()) or "", re.S) if url else None
    if not m or not m[4]:
        return None
    scheme, name = (m[2] or "").lower(), m[4].rpartition("@")[2].lower().removeprefix("www.")
    host_, colon, port = name.rpartition(":")
    if colon and (port.strip("0") == "" or (scheme, port) in (("http", "80"), ("https", "443"))):
        name = host_
    return f"{name} {m[5].rstrip('/') or '/'} {m[7] or ''}"


@F.pandas_udf(T.StringType())
def resolve(base: pd.Series, href: pd.Series) -> pd.Series:
    return pd.Series([absolute(b, h) for b, h in zip(base, href, strict=True)])


@F.pandas_udf(T.StringType())
def percent_encode(values: pd.Series) -> pd.Series:
    return values.map(lambda x: quote(x, safe=SAFE), na_action="ignore")


def replay_url(timestamp: Column, original: Column, archive: str = "https://web.archive.org") -> Column:
    return F.concat(F.lit(f"{archive}/web/"), timestamp, F.lit("id_/"), percent_encode(original))
