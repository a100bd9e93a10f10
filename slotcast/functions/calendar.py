"""Calendar columns of a naive local timestamp.

Nothing here goes through an instant: a naive time that the session's time zone skips or
repeats is a time like any other.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SLOT_MINUTES = 15

# First and last month of season 2; every other month is season 1.
WARM_MONTHS = (4, 10)


def time_block(ts: Column, minutes: int = SLOT_MINUTES) -> Column:
    """Number of the slot within the day, from 1."""
    of_day = F.hour(ts) * 60 + F.minute(ts)
    return (F.floor(of_day / minutes) + 1).cast("int")


def hour_of_day(ts: Column) -> Column:
    """Hour 1 to 24."""
    return (F.hour(ts) + 1).cast("int")


def day_of_week(ts: Column) -> Column:
    """Monday is 0."""
    return F.weekday(ts).cast("int")


def season(month: Column) -> Column:
    return F.when(month.between(*WARM_MONTHS), 2).otherwise(1).cast("int")


def clock(ts: Column) -> Column:
    """Time of day as text."""
    return F.substring(ts.cast("string"), 12, 8)


def date_text(value: Column) -> Column:
    return F.to_date(value).cast("string")


def at(date: Column, time: Column) -> Column:
    """Date plus time-of-day text as a naive timestamp."""
    return F.to_timestamp_ntz(F.concat_ws(" ", date_text(date), time))


def add_minutes(ts: Column, minutes: Column | int) -> Column:
    """Shift a naive timestamp; the result stays naive."""
    amount = minutes if isinstance(minutes, Column) else F.lit(minutes)
    return ts + F.make_dt_interval(F.lit(0), F.lit(0), amount.cast("int"), F.lit(0))


def ntz(text: str) -> Column:
    """Naive timestamp literal."""
    return F.lit(text).cast("timestamp_ntz")


def midnight(ts: Column) -> Column:
    """First instant of the day."""
    return F.to_date(ts).cast("timestamp_ntz")


def micros(ts: Column) -> Column:
    """Microseconds since 1970-01-01 on the naive clock."""
    days = F.datediff(F.to_date(ts), F.lit("1970-01-01").cast("date")).cast("bigint")
    minutes = days * 1440 + F.hour(ts) * 60 + F.minute(ts)
    seconds = F.extract(F.lit("SECOND"), ts)
    return minutes * 60_000_000 + (seconds * 1_000_000).cast("bigint")


def calendar_columns(ts: Column) -> dict[str, Column]:
    """The calendar features of a slot."""
    return {
        "date": F.to_date(ts),
        "tb": time_block(ts),
        "hour": hour_of_day(ts),
        "dow": day_of_week(ts),
        "doy": F.dayofyear(ts).cast("int"),
        "month": F.month(ts).cast("int"),
        "year": F.year(ts).cast("int"),
    }
