"""Keys of URLs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_AUTHORITY = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)"


def host(url: Column) -> Column:
    """Host in lower case without user, port and www; null for null, empty for a relative URL."""
    authority = F.regexp_extract(F.trim(url), _AUTHORITY, 1)
    return F.regexp_replace(F.lower(F.regexp_replace(F.regexp_replace(authority, r"^[^@]*@", ""), r":\d*$", "")), r"^www\.", "")


def path(url: Column) -> Column:
    rest = F.regexp_replace(F.trim(url), _AUTHORITY, "")
    return F.regexp_extract(rest, r"^([^?#]*)", 1)


def query(url: Column) -> Column:
    return F.regexp_extract(F.trim(url), r"\?([^#]*)", 1)


def _bare_path(url: Column) -> Column:
    return F.regexp_replace(path(url), "/+$", "")


def same_place(url: Column) -> Column:
    """Host, path without a slash at its end, and query."""
    q = query(url)
    return F.concat(host(url), _bare_path(url), F.when(q != "", F.concat(F.lit("?"), q)).otherwise(F.lit("")))


def canonical(url: Column) -> Column:
    """Host and path; scheme, www, a slash at the end, query and fragment don't count."""
    return F.concat(host(url), _bare_path(url))


def norm(url: Column) -> Column:
    """Canonical form in lower case."""
    return F.lower(canonical(url))


def is_root(url: Column) -> Column:
    return (_bare_path(url) == "") & (query(url) == "")


def scrub(url: Column) -> Column:
    """URL without query and fragment; of account pages the origin only."""
    bare = F.regexp_replace(url, r"[?#].*$", "")
    account = path(url).rlike(r"(?i)/(?:account|login|signin|sign-in|user|profile|settings|admin|cart|checkout|oauth)(?:/|$)")
    return F.when(account, F.regexp_extract(url, r"^((?:[A-Za-z][A-Za-z0-9+.-]*:)?//[^/?#]*)", 1)).otherwise(bare)


def link_state(head_code: Column, get_code: Column, insecure_code: Column) -> Column:
    """The bucket of a probed link from the status of a HEAD, a GET and a GET without certificate check."""
    ok = lambda c: c.between(200, 399)
    return (
        F.when(F.coalesce(ok(head_code) | ok(get_code), F.lit(False)), "ok").when(F.coalesce(ok(insecure_code), F.lit(False)), "certificate")
        .when(F.coalesce(get_code, head_code).isin(401, 403, 405, 429), "restricted").when(F.coalesce(get_code, head_code).isin(404, 410), "dead")
        .when(F.coalesce(get_code, head_code) >= 500, "server_error").otherwise("unreachable")
    )
