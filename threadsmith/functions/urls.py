"""URL helpers: a urlsplit-like regex split and the status-url shape used for quotes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Scheme://netloc path ?query #fragment (same regex in Spark and DuckDB)
URL_RE = "^([A-Za-z][A-Za-z0-9+.-]*):(//([^/?#]*))?([^?#]*)(\\?([^#]*))?(#.*)?$"
STATUS_URL_RE = "^https://twitter.com/([0-9A-Za-z_]*)/status/(\\d+)$"
ELLIPSIS = "…"
DISPLAY_PATH_MAX = 15


def scheme(u: Column) -> Column:
    return F.regexp_extract(u, URL_RE, 1)


def netloc(u: Column) -> Column:
    return F.regexp_extract(u, URL_RE, 3)


def path(u: Column) -> Column:
    return F.regexp_extract(u, URL_RE, 4)


def query(u: Column) -> Column:
    return F.regexp_extract(u, URL_RE, 6)


def display_url(u: Column) -> Column:
    """netloc without ``www.`` + the path, or the first 15 characters of ``path?query``
    followed by an ellipsis when ``path?query`` has 15 characters or more."""
    host = netloc(u)
    host = F.when(host.startswith("www."), F.substring(host, 5, 1 << 30)).otherwise(host)
    pq = F.concat(path(u), F.lit("?"), query(u))
    short = F.when(F.length(pq) < DISPLAY_PATH_MAX, path(u)).otherwise(
        F.concat(F.substring(pq, 1, DISPLAY_PATH_MAX), F.lit(ELLIPSIS)))
    return F.concat(host, short)


def is_link_word(w: Column) -> Column:
    return (scheme(w) != "") & (netloc(w) != "") & ~w.endswith(ELLIPSIS)


def is_status_url(u: Column) -> Column:
    return u.rlike(STATUS_URL_RE)
