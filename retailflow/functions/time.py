"""Time expressions shared by slices, streams, events and dashboards."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DAY_SECONDS = 86400
MICROS = 1_000_000


def parse_day(day: str) -> date:
    return datetime.strptime(day.strip(), "%Y-%m-%d").date()


def next_day(day: str, days: int = 1) -> str:
    """The day cursor moved forward (or back, with negative ``days``)."""
    return (parse_day(day) + timedelta(days=days)).isoformat()


def cursor_parts(day: str) -> tuple[int, int, int]:
    d = parse_day(day)
    return d.year, d.month, d.day


def month_bounds(month: str) -> tuple[str, str]:
    """First day of a ``YYYY-MM`` month and of the month after it."""
    first = datetime.strptime(month, "%Y-%m").date()
    after = (first.replace(day=28) + timedelta(days=4)).replace(day=1)
    return first.isoformat(), after.isoformat()


def time_literal(df: DataFrame, column: str, text: str) -> Column:
    """``text`` as a literal of the column's own type.

    Equal types on both sides keep the comparison free of casts on the column,
    which is what lets the filter reach the file scan.
    """
    return F.lit(text).cast(df.schema[column].dataType)


def month_text(ts) -> Column:
    return F.date_format(ts, "yyyy-MM")


def micros_to_timestamp(micros) -> Column:
    """Epoch microseconds to a timestamp of millisecond precision."""
    micros = F.col(micros) if isinstance(micros, str) else micros
    return F.timestamp_micros(micros - F.pmod(micros, F.lit(1000)))


def iso_to_timestamp(text) -> Column:
    """ISO-8601 text such as ``2017-01-01T10:00:00Z`` to a zone-free timestamp.

    Text that is no timestamp gives null.
    """
    text = F.col(text) if isinstance(text, str) else text
    plain = F.replace(F.replace(text, F.lit("T"), F.lit(" ")), F.lit("Z"), F.lit(""))
    return plain.try_cast("timestamp_ntz")


def micros_of_day(ts) -> Column:
    """Microseconds since midnight."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    seconds = F.hour(ts) * 3600 + F.minute(ts) * 60
    fraction = (F.extract(F.lit("SECOND"), ts) * MICROS).cast("bigint")
    return seconds.cast("bigint") * MICROS + fraction


def session_of_day(ts) -> Column:
    """Name of the six-hour session of a time; first match wins.

    The bounds are closed and the last one is 23:59:00, so a time in the last
    minute of the day belongs to no session.
    """
    at = micros_of_day(ts)
    minute = 60 * MICROS
    # Session bounds in minutes and labels.
    sessions = [
        (0, 360, "1-Dawn"),
        (360, 720, "2-Morning"),
        (720, 1080, "3-Afternoon"),
        (1080, 1439, "4-Evening"),
    ]
    chain = F
    for lo, hi, label in sessions:
        chain = chain.when(at.between(lo * minute, hi * minute), F.lit(label))
    return chain


def seconds_since(ts, base) -> Column:
    """Seconds from ``base`` to ``ts`` with microsecond precision, as a double."""
    return F.timestamp_diff("MICROSECOND", base, ts) / F.lit(float(MICROS))
