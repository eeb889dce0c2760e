"""Scalar column expressions (all built-in, JVM-side, codegen friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The five interaction kinds of the event contract, in contract order.
INTERACTIONS = ["VIEW", "APPLY", "FINISHED", "USER_CANCEL", "SYSTEM_CANCEL"]
# Accepted boolean spellings.
TRUE_WORDS = ["true", "1", "yes"]
FALSE_WORDS = ["false", "0", "no"]
# Fixed value: RFC 4122 DNS namespace used for name-based (v5) event ids.
DNS_NAMESPACE_HEX = "6ba7b8109dad11d180b400c04fd430c8"


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_bool(c) -> Column:
    """trim + lower; true/1/yes -> true, false/0/no -> false, anything else -> null."""
    t = F.lower(F.trim(col_(c).cast("string")))
    return F.when(t.isin(TRUE_WORDS), F.lit(True)).when(t.isin(FALSE_WORDS), F.lit(False))


def to_num(c, dtype: str = "double") -> Column:
    """Numeric coercion; unparsable text -> null (never raises under ANSI)."""
    return F.expr(f"try_cast({_sql(c)} AS {dtype})") if isinstance(c, str) else c.try_cast(dtype)


def _sql(c: str) -> str:
    return "`" + c.replace("`", "``") + "`"


def to_utc(c) -> Column:
    """Text or timestamp -> UTC wall-clock TIMESTAMP_NTZ; naive text is taken as UTC.

    Requires the session zone to be UTC (see ``session.ensure_utc``); unparsable text -> null.
    """
    s = col_(c).cast("string")
    s = F.regexp_replace(F.trim(s), "Z$", "+00:00")
    return F.try_to_timestamp(s).cast("timestamp_ntz")


def to_date_or_null(c) -> Column:
    return F.expr(f"try_cast({_sql(c)} AS DATE)") if isinstance(c, str) else c.try_cast("date")


def epoch_seconds(c) -> Column:
    """Seconds since epoch of a UTC wall-clock timestamp (double, sub-second kept)."""
    return F.unix_micros(col_(c).cast("timestamp")) / F.lit(1e6)


def fmt_ts(c) -> Column:
    """Canonical text of a timestamp for result tables (engine independent)."""
    return F.date_format(col_(c), "yyyy-MM-dd HH:mm:ss.SSSSSS")


def fmt_date(c) -> Column:
    return F.date_format(col_(c), "yyyy-MM-dd")


def r6(c) -> Column:
    return F.round(col_(c).cast("double"), 6)


def to_uuid(c) -> Column:
    """Event-id normalisation.

    A parseable UUID (optionally ``urn:uuid:``-prefixed, braced, without hyphens, any case) maps to
    its canonical lower-case form; any other text maps to the name-based UUID v5 of that text in
    the DNS namespace: SHA-1 over namespace bytes + UTF-8 name, version nibble 5, RFC 4122 variant.
    """
    raw = col_(c).cast("string")
    stripped = F.lower(F.trim(raw))
    stripped = F.regexp_replace(stripped, "^urn:uuid:", "")
    stripped = F.regexp_replace(stripped, "^\\{(.*)\\}$", "$1")
    hex32 = F.regexp_replace(stripped, "-", "")
    shaped = stripped.rlike("^[0-9a-f]{32}$|^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$")
    digest = F.sha1(F.concat(F.unhex(F.lit(DNS_NAMESPACE_HEX)), F.encode(raw, "UTF-8")))
    # version nibble (hex digit 13) := 5; variant (hex digit 17) := 10xx
    variant = F.translate(F.substring(digest, 17, 1), "0123456789abcdef", "89ab89ab89ab89ab")
    v5hex = F.concat(F.substring(digest, 1, 12), F.lit("5"), F.substring(digest, 14, 3), variant,
                     F.substring(digest, 18, 15))
    h = F.when(shaped, hex32).otherwise(v5hex)
    return F.when(raw.isNull(), F.lit(None).cast("string")).otherwise(F.concat_ws(
        "-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4),
        F.substring(h, 17, 4), F.substring(h, 21, 12)))
