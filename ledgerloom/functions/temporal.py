"""Date and time columns. Everything works on zone-free timestamps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A date and a time as text. Schema inference turns a date column into dates or
# midnights and a time column into times of some day, so both may carry a filler.
DATE_TIME = r"^(\d{4}-\d{2}-\d{2})(?: 00:00:00)? (?:\d{4}-\d{2}-\d{2} )?(\d{2}:\d{2}:\d{2})$"


def assemble_timestamp(date: Column | str, time: Column | str) -> Column:
    """Timestamp from a date and a time column; NULL when either is malformed.

    Both may be text or what schema inference makes of it.
    """
    column = lambda c: (F.col(c) if isinstance(c, str) else c).cast("string")
    joined = F.concat_ws(" ", column(date), column(time))
    text = F.regexp_replace(joined, DATE_TIME, "$1 $2")
    return F.when(joined.rlike(DATE_TIME), text.try_cast("timestamp_ntz"))


def time_columns(df: DataFrame, ts: str) -> DataFrame:
    """Derived calendar columns; year and month are integers so they prune partitions."""
    stamp = F.col(ts)
    return df.withColumns(
        {
            "event_date": F.to_date(stamp),
            "event_hour": F.hour(stamp),
            "event_week": F.date_trunc("week", stamp).cast("timestamp_ntz"),
            "event_month": F.month(stamp),
            "event_year": F.year(stamp),
        }
    )


def epoch_minute(ts: Column | str) -> Column:
    """Whole minutes since 1970-01-01 00:00 as a long."""
    stamp = F.col(ts) if isinstance(ts, str) else ts
    days = F.datediff(F.to_date(stamp), F.lit("1970-01-01").cast("date")).cast("long")
    return days * 1440 + F.hour(stamp) * 60 + F.minute(stamp)


def align(minute: Column, width: Column | int) -> Column:
    """Start minute of the epoch-aligned bucket of `width` minutes."""
    step = F.lit(width).cast("long") if isinstance(width, int) else width.cast("long")
    return minute - F.pmod(minute, step)


def minute_timestamp(minute: Column) -> Column:
    """Zone-free timestamp of an epoch minute."""
    return F.timestamp_add("MINUTE", minute, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def utc(ts: Column | str) -> Column:
    """An instant as zone-free UTC time, whatever the session zone is."""
    stamp = F.col(ts) if isinstance(ts, str) else ts
    return F.convert_timezone(None, F.lit("UTC"), stamp.cast("timestamp_ntz"))
