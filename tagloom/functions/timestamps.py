"""Time expressions. All of them expect the session time zone to be UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed output format of source-local time text (day-month-year hour:minute:second).
SOURCE_LOCAL_FORMAT = "dd-MMM-yy HH:mm:ss"

# The forms met in practice, which Spark's own cast reads as they are.
_COMMON = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}:\d{2}(\.\d{1,6})?(Z|[+-]\d{2}:\d{2})?)?$"

# Any calendar date and clock time of ISO-8601, extended or basic, with optional offset.
_ISO = (
    r"^(\d{4})(-?)(\d{2})\2(\d{2})"
    r"(?:[T ](\d{2})(?:(:?)(\d{2})(?:\6(\d{2})(?:[.,](\d+))?)?)?"
    r"(?:(Z)|([+-])(\d{2})(?::?(\d{2})(?::?(\d{2}))?)?)?)?$"
)
_HAS_OFFSET = r"[T ].*(Z|[+-]\d{2}(:?\d{2}){0,2})$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _iso_local(ts: Column) -> Column:
    # Casting drops trailing zeros of the fraction; the contract wants six digits or none.
    text = ts.cast("string")
    fraction = F.when(F.length(text) > 19, F.substring(F.rpad(text, 26, "0"), 20, 7)).otherwise("")
    return F.concat(F.substring(text, 1, 10), F.lit("T"), F.substring(text, 12, 8), fraction)


def iso_utc(ts: Column | str) -> Column:
    """ISO text with a numeric offset, the form that enters the idempotency key."""
    return F.concat(_iso_local(_col(ts)), F.lit("+00:00"))


def iso_zulu(ts: Column | str) -> Column:
    """ISO text ending in Z, the form that is published."""
    return F.concat(_iso_local(_col(ts)), F.lit("Z"))


def _rebuilt(t: Column) -> Column:
    """Any accepted form as year-month-day hour:minute:second.micros and offset; else null."""

    def part(i: int, default: str) -> Column:
        return F.coalesce(F.nullif(F.regexp_extract(t, _ISO, i), F.lit("")), F.lit(default))

    micros = F.substring(F.rpad(F.regexp_extract(t, _ISO, 9), 6, "0"), 1, 6)
    text = F.concat(
        part(1, ""), F.lit("-"), part(3, ""), F.lit("-"), part(4, ""), F.lit(" "),
        part(5, "00"), F.lit(":"), part(7, "00"), F.lit(":"), part(8, "00"), F.lit("."), micros,
        part(11, "+"), part(12, "00"), F.lit(":"), part(13, "00"), F.lit(":"), part(14, "00"),
    )
    return F.when(t.rlike(_ISO), text)


def parse_timestamp(text: Column | str, default_tz: str = "UTC") -> Column:
    """ISO-8601 text to a UTC timestamp; text without offset is in ``default_tz``; bad text is null."""
    t = _col(text)
    # The less common forms are rewritten in a lambda, which keeps the generated method short.
    rare = F.element_at(F.transform(F.array(t), _rebuilt), 1)
    instant = F.when(t.rlike(_COMMON), t).when(t.isNotNull(), rare).try_cast("timestamp")
    if default_tz.upper() == "UTC":
        return instant
    return F.when(t.rlike(_HAS_OFFSET), instant).otherwise(F.to_utc_timestamp(instant, default_tz))


def floor_to_interval(ts: Column | str, seconds: int) -> Column:
    """Largest multiple of ``seconds`` since the epoch that is not after ``ts``."""
    if seconds <= 0:
        raise ValueError("seconds must be greater than zero")
    epoch = F.unix_seconds(_col(ts))
    return F.timestamp_seconds(epoch - F.pmod(epoch, F.lit(seconds)))


def partition_date(ts: Column | str) -> Column:
    """UTC calendar day of an instant; parse text with :func:`parse_timestamp` first."""
    return F.to_date(_col(ts))


def source_local_text(ts: Column | str, timezone: Column | str) -> Column:
    """Wall-clock text in the zone of the source server."""
    return F.date_format(F.from_utc_timestamp(_col(ts), timezone), SOURCE_LOCAL_FORMAT)


def in_range(ts: Column | str, start, end) -> Column:
    """Half-open range; with literal bounds the scan receives it as a pushed filter."""
    c = _col(ts)
    return (c >= F.lit(start)) & (c < F.lit(end))
