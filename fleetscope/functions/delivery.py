"""Delivery attempt classification and retry timing expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fleetscope import config as C


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def is_retryable(status, network_error) -> Column:
    s, n = _c(status), F.coalesce(_c(network_error), F.lit(False))
    return n | (s == 429) | (s >= 500)


def is_permanent(status) -> Column:
    s = _c(status)
    return (s >= 400) & (s < 500) & (s != 429)


def attempt_class(status, network_error) -> Column:
    """Class of one attempt, tested in the client's order.

    success (2xx) -> halt (401) -> payment (402) -> permanent (other 4xx but
    429) -> retryable (network, 429, 5xx) -> other (1xx, 3xx, ...).
    """
    s, n = _c(status), F.coalesce(_c(network_error), F.lit(False))
    return (F.when(~n & (s >= 200) & (s < 300), F.lit("success"))
             .when(~n & (s == 401), F.lit("halt"))
             .when(~n & (s == 402), F.lit("payment"))
             .when(~n & is_permanent(s), F.lit("permanent"))
             .when(is_retryable(s, n), F.lit("retryable"))
             .otherwise(F.lit("other")))


def parse_retry_after(text) -> Column:
    """Seconds from a Retry-After header value, or null.

    The leading integer counts (after blanks); values over the cap are
    capped; negative values, non-integers and integers outside 32 bits
    (which the client fails to parse) mean "no hint".
    """
    digits = F.regexp_extract(_c(text), r"^\s*([+-]?\d+)", 1)
    sign_neg = digits.startswith("-")
    body = F.regexp_replace(F.regexp_replace(digits, r"^[+-]", ""), r"^0+(\d)", "$1")
    value = F.when(F.length(body) <= 10, body.cast("long"))
    in_range = value.isNotNull() & (value <= F.lit(2147483647 + 1).cast("long") - F.when(sign_neg, 0).otherwise(1))
    return (F.when((F.length(digits) == 0) | ~in_range, F.lit(None).cast("int"))
             .when(sign_neg & (value > 0), F.lit(None).cast("int"))
             .otherwise(F.least(value, F.lit(C.RETRY_AFTER_CAP_SECONDS)).cast("int")))


def backoff_ms(retry_index) -> Column:
    """Backoff before retry ``i`` (0-based) without jitter: 1 s * 2^i, <= 60 s."""
    i = F.greatest(F.lit(0), F.least(_c(retry_index).cast("int"), F.lit(16)))
    return F.least((F.lit(C.BACKOFF_BASE_MS) * F.pow(F.lit(2.0), i)).cast("long"),
                   F.lit(C.BACKOFF_CAP_MS).cast("long"))
