"""Column functions over peer and transaction URLs, statuses and durations."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from courier.schema import HTTP_STATUS_BASE

# Statuses that count as success, per kind of request.
SUCCESS = {
    "create": (200, 201),
    "send": (200, 202),
    "read": (200,),
}

_AUTHORITY = r"^([A-Za-z][A-Za-z0-9+.\-]*)://([^/?#]*)([^?#]*)(.*)$"


def peer_url(host: Column, port: Column, secure: Column) -> Column:
    """``https`` for a secure peer, else ``http``; a null port is left out."""
    scheme = F.when(F.coalesce(secure, F.lit(False)), F.lit("https")).otherwise(F.lit("http"))
    suffix = F.coalesce(F.concat(F.lit(":"), port.cast("string")), F.lit(""))
    return F.concat(scheme, F.lit("://"), host, suffix)


def base_url(url: Column) -> Column:
    """The URL without its path."""
    return F.regexp_replace(url, _AUTHORITY, "$1://$2$4")


def url_host(url: Column) -> Column:
    return F.nullif(F.regexp_extract(url, r"^[^:/?#]+://(?:[^@/?#]*@)?([^:/?#]*)", 1), F.lit(""))


def url_port(url: Column) -> Column:
    port = F.regexp_extract(url, r"^[^:/?#]+://(?:[^@/?#]*@)?[^:/?#]*:(\d+)", 1)
    return F.nullif(port, F.lit("")).cast("int")


def raw_url(url: Column, raw_port: Column, scheme: str) -> Column:
    """The socket address of a peer: scheme and port replaced, all other parts kept."""
    user = F.regexp_extract(url, r"^[^:/?#]+://([^@/?#]*@)", 1)
    path = F.regexp_extract(url, _AUTHORITY, 3)
    rest = F.regexp_extract(url, _AUTHORITY, 4)
    port = F.coalesce(F.concat(F.lit(":"), raw_port.cast("string")), F.lit(""))
    return F.concat(F.lit(f"{scheme}://"), user, url_host(url), port, path, rest)


def last_segment(url: Column) -> Column:
    """What follows the last slash: the transaction id of a transaction URL."""
    return F.element_at(F.split(url, "/"), -1)


def status_error(status: Column) -> Column:
    """The error code that stands for an HTTP status."""
    return status + F.lit(HTTP_STATUS_BASE)


def succeeded(kind: str, status: Column) -> Column:
    """Is ``status`` a success for a create, send, extend or read request?"""
    if kind == "extend":
        return (status >= 200) & (status < 300)
    return status.isin(*SUCCESS[kind])


def duration_seconds(start: Column, end: Column) -> Column:
    """Seconds between two time-zoned timestamps."""
    return (F.unix_micros(end) - F.unix_micros(start)) / F.lit(1_000_000.0)


def leading_integer(text: Column) -> Column:
    """The integer a text starts with, 0 when it starts with none, null for null."""
    digits = F.regexp_extract(text, r"^\s*([+-]?\d+)", 1)
    return F.when(text.isNotNull(), F.coalesce(digits.try_cast("bigint"), F.lit(0)))
