"""Scalar expressions: hex and quantities, error classes, redaction of secrets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def prefixed(hexed: Column) -> Column:
    """Lower-case hex with 0x in front."""
    return F.concat(F.lit("0x"), F.lower(hexed))


def bare(text: Column) -> Column:
    """Lower-case hex without a prefix."""
    return F.regexp_replace(F.lower(text), "^0x", "")


def bytes_hex(value: Column) -> Column:
    return prefixed(F.hex(value))


def quantity(text: Column) -> Column:
    """A hex quantity (0x...), or a decimal one, as bigint; null if it is neither or needs more than 63 bits."""
    low = F.lower(F.trim(text))
    digits = F.regexp_replace(F.regexp_extract(low, "^0x([0-9a-f]+)$", 1), "^0+(?=.)", "")
    small = (F.length(digits) < 16) | ((F.length(digits) == 16) & (F.substring(digits, 1, 1) < "8"))
    return F.when((digits != "") & small, F.conv(digits, 16, 10).try_cast("bigint")).when(low.rlike("^[0-9]+$"), low.try_cast("bigint"))


def to_quantity(number: Column) -> Column:
    return F.concat(F.lit("0x"), F.lower(F.hex(number.cast("bigint"))))


def address(text: Column) -> Column:
    """The 20 bytes of an address as bare hex; null unless they are exactly 20."""
    low = bare(F.trim(text))
    return F.when(low.rlike("^[0-9a-f]{40}$"), low)


def same_hex(a: Column, b: Column) -> Column:
    return bare(a) == bare(b)


def age_seconds(now: Column, then: Column) -> Column:
    return (F.unix_micros(now) - F.unix_micros(then)) / F.lit(1_000_000)


#: Words by which a node's error text is told, in the order in which they are tried.
ERROR_WORDS = {
    "rate_limited": ("too many requests", "rate limit", "rate-limit", " 429", "status 429"),
    "provider_limit": ("more than", "too many results", "response size", "block range", "limit exceeded", "query timeout exceeded"),
    "timeout": ("timed out", "timeout", "deadline"),
    "transient": ("pruned history unavailable",),
}


def error_class(message: Column) -> Column:
    """rate_limited, provider_limit, timeout, transient or permanent; the first match counts."""
    low, out = F.lower(message), None
    for name, words in ERROR_WORDS.items():
        found = F.lit(False)
        for w in words:
            found = found | low.contains(w)
        out = F.when(found, name) if out is None else out.when(found, name)
    return out.otherwise("permanent")


def request_error_class(message: Column) -> Column:
    """Of a failed request: what isn't known is transient, but a log query by a block hash that is gone is permanent."""
    low = F.lower(message)
    gone = low.contains("eth_getlogs") & (low.contains("blockhash") | low.contains("block hash")) & low.contains("block not found")
    found = error_class(message)
    return F.when(gone, "permanent").when(found == "permanent", "transient").otherwise(found)


def http_error_class(status: Column) -> Column:
    return F.when(status.isin(408, 425) | status.between(500, 599), "transient").when(status == 429, "rate_limited").otherwise("permanent")


def redacted_url(url: Column) -> Column:
    """The URL without its password, key-like path segments and secret query values."""
    out = F.regexp_replace(url, r"^([a-zA-Z]+://[^/@:]*):[^/@]*@", "$1:redacted@")
    out = F.regexp_replace(out, r"(?i)/(v2|v3|keys?)/[^/?#]+", "/$1/redacted")
    out = F.regexp_replace(out, r"(?i)/[^/?#]*(?:apikey|api-key)[^/?#]*", "/redacted")
    secret = r"key|api_key|apikey|api-key|[^&=?#]*_key|[^&=?#]*token[^&=?#]*|[^&=?#]*secret[^&=?#]*|[^&=?#]*password[^&=?#]*"
    return F.regexp_replace(out, rf"(?i)([?&](?:{secret})=)[^&#]*", "$1redacted")


def saturating_double(value: Column, top: Column) -> Column:
    return F.least(F.when(value > top / 2, top).otherwise(value * 2), top)
