"""Column expressions: cleansing, safe casts, time parsing, lookups."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def finite_or_zero(col: Column) -> Column:
    """Null, NaN and both infinities become 0.0; everything else is cast to double."""
    x = col.try_cast("double")
    return F.when(x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")), 0.0).otherwise(x)


def nan_to_null(col: Column) -> Column:
    return F.when(~F.isnan(col), col)


def category_or(col: Column, default: str = "Normal") -> Column:
    """Trimmed text; null and blank become ``default``."""
    return F.coalesce(F.nullif(F.trim(col), F.lit("")), F.lit(default))


def safe_int(col: Column, default: int = 0, dtype: str = "int") -> Column:
    """Integer, truncated toward zero; anything unreadable or out of range becomes ``default``."""
    return F.coalesce(col.try_cast(dtype), F.lit(default).cast(dtype))


def safe_float(col: Column, default: float = 0.0) -> Column:
    return F.coalesce(col.try_cast("double"), F.lit(default))


def lookup(col: Column, mapping: Mapping, default) -> Column:
    """Value of a small literal map, ``default`` for a missing key or an empty map."""
    if not mapping:
        return F.lit(default)
    pairs = [F.lit(x) for kv in mapping.items() for x in kv]
    return F.coalesce(F.create_map(*pairs)[col], F.lit(default))


_ISO = (
    r"^(?:(\d{4})-(\d{2})-(\d{2})|(\d{4})(\d{2})(\d{2}))"
    r"(?:.(\d{2})(?::?(\d{2})(?::?(\d{2})(?:[.,](\d+))?)?)?)?"
    r"(?<zone>Z|[+-]\d{2}(?::?\d{2})?)?$"
)
_ISO_ZONE_GROUP = 11


def parse_iso(col: Column) -> Column:
    """ISO-8601 text to an instant: a missing zone means UTC; null, blank and unreadable text
    give the epoch."""

    def part(group: int, default: str = "") -> Column:
        return F.coalesce(F.nullif(F.regexp_extract(col, _ISO, group), F.lit("")), F.lit(default))

    date = F.concat(
        part(1), part(4), F.lit("-"), part(2), part(5), F.lit("-"), part(3), part(6)
    )
    clock = F.concat(
        part(7, "00"), F.lit(":"), part(8, "00"), F.lit(":"), part(9, "00"),
        F.lit("."), F.substring(part(10, "0"), 1, 6),
    )
    zone = part(_ISO_ZONE_GROUP, "Z")
    zone = (
        F.when(zone == "Z", "+00:00")
        .when(F.length(zone) == 3, F.concat(zone, F.lit(":00")))
        .when(F.length(zone) == 5, F.concat(F.substring(zone, 1, 3), F.lit(":"), F.substring(zone, 4, 2)))
        .otherwise(zone)
    )
    text = F.concat(date, F.lit("T"), clock, zone)
    return F.coalesce(
        F.when(col.rlike(_ISO), text.try_cast("timestamp")), F.timestamp_seconds(F.lit(0))
    )


def format_iso(col: Column) -> Column:
    """ISO-8601 text in UTC with microseconds (the session time zone must be UTC)."""
    return F.concat(F.date_format(col, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00"))


def floor_in_hour(ts: Column, minutes: int) -> Column:
    """``ts`` floored to a multiple of ``minutes`` counted from the start of its hour.

    Keeps the input type. An interval of 60 or more gives the hour itself.
    """
    if minutes <= 0:
        raise ValueError("interval must be positive")
    past = F.make_dt_interval(
        F.lit(0), F.lit(0), F.minute(ts) % F.lit(minutes), F.extract(F.lit("SECOND"), ts)
    )
    return ts - past


def record_key(*cols: Column) -> Column:
    """A repeatable id for rows that carry none."""
    return F.md5(F.concat_ws("\u0001", *[F.coalesce(c.cast("string"), F.lit("")) for c in cols]))


def hash_rank(col: Column) -> Column:
    """A uniform 52-bit number from a key: the same on any engine with md5."""
    return F.conv(F.substring(F.md5(col.cast("string")), 1, 13), 16, 10).cast("bigint")


def half_up(col: Column, places: int) -> Column:
    """Decimal rounding, half up, on six decimal digits."""
    return F.round(col.cast("decimal(18,6)"), places).cast(f"decimal(18,{places})")
