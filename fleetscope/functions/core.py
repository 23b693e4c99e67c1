"""Time, text, validation and id expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fleetscope import config as C


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def epoch_micros(ts) -> Column:
    """Microseconds since 1970 of a ``timestamp_ntz`` (UTC wall time).

    Independent of the session time zone, unlike casting to ``timestamp``.
    """
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"),
                            _c(ts).cast("timestamp_ntz"))


def epoch_millis(ts) -> Column:
    """Milliseconds since 1970, truncated (never rounded)."""
    return F.floor(epoch_micros(ts) / F.lit(1000)).cast("long")


def iso_millis(ts) -> Column:
    """ISO-8601 UTC text with truncated milliseconds and a trailing ``Z``."""
    return F.date_format(_c(ts).cast("timestamp_ntz"), C.ISO_MILLIS_FORMAT)


def truncate(col, n: int) -> Column:
    """First ``n`` characters (counts characters, never splits one)."""
    return F.left(_c(col), F.lit(n))


def null_if_empty(col) -> Column:
    return F.when(F.length(_c(col)) > 0, _c(col))


def actor_error(actor) -> Column:
    """Rejection reason of an explicitly given actor id, else null."""
    a = _c(actor)
    return (F.when(a.isNull() | (F.length(a) == 0), F.lit("actor_empty"))
             .when(F.length(a) > C.MAX_ACTOR_LEN, F.lit("actor_too_long")))


def is_reserved_category(category) -> Column:
    return F.coalesce(_c(category).startswith(C.RESERVED_CATEGORY_PREFIX), F.lit(False))


def partition_key(col) -> Column:
    """Make an app name safe as a path component: unsafe characters -> ``_``."""
    return F.translate(_c(col), C.PATH_UNSAFE_CHARS, "_" * len(C.PATH_UNSAFE_CHARS))


def uuid7_from_key(ts, *key_cols) -> Column:
    """Deterministic UUIDv7-shaped id.

    48-bit millisecond prefix from ``ts``, version nibble 7, RFC variant, and
    the remaining bits from SHA-256 of the key, so a rerun gives the same id.
    """
    h = F.sha2(F.concat_ws("|", *[_c(k).cast("string") for k in key_cols]), 256)
    ms = F.lower(F.lpad(F.hex(epoch_millis(ts)), 12, "0"))
    variant = F.translate(F.substring(h, 4, 1), "0123456789abcdef", "89ab89ab89ab89ab")
    return F.concat(F.substring(ms, 1, 8), F.lit("-"), F.substring(ms, 9, 4), F.lit("-7"),
                    F.substring(h, 1, 3), F.lit("-"), variant, F.substring(h, 5, 3), F.lit("-"),
                    F.substring(h, 8, 12))


UUID7_PATTERN = r"^[0-9a-f]{8}-[0-9a-f]{4}-7[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}$"


def uuid7_is_valid(col) -> Column:
    return F.coalesce(_c(col).rlike(UUID7_PATTERN), F.lit(False))


def uuid7_millis(col) -> Column:
    """The embedded millisecond time of a UUIDv7 text."""
    return F.conv(F.concat(F.substring(_c(col), 1, 8), F.substring(_c(col), 10, 4)), 16, 10).cast("long")
