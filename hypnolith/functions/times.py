"""Wall-clock times in UTC, whatever the session's time zone is."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_START = "timestamp_ntz'1970-01-01 00:00:00'"


def utc_time(rows: DataFrame, column: str) -> Column:
    """A time column as UTC wall-clock time: a moment in time is moved to UTC, others are in it."""
    if rows.schema[column].dataType.typeName() == "timestamp":
        return F.expr(f"{_START} + INTERVAL '0.000001' SECOND * unix_micros(`{column}`)")
    return F.col(column).cast("timestamp_ntz")


def micros(time: Column) -> Column:
    """Microseconds from 1970 of a wall-clock time."""
    since = time - F.expr(_START)
    minutes = (F.extract(F.lit("DAY"), since) * 24 + F.extract(F.lit("HOUR"), since)) * 60 + F.extract(
        F.lit("MINUTE"), since
    )
    seconds = F.extract(F.lit("SECOND"), since) * 1000000
    return minutes.cast("long") * 60000000 + seconds.cast("long")


def date_text(time: Column) -> Column:
    """yyyy-MM-dd of a wall-clock time."""
    return F.substring(time.cast("string"), 1, 10)


def time_text(time: Column, fraction: bool = False) -> Column:
    """yyyy-MM-ddTHH:mm:ss of a wall-clock time, with .SSSSSS if there is a fraction."""
    text = time.cast("string")
    whole = F.concat(F.substring(text, 1, 10), F.lit("T"), F.substring(text, 12, 8))
    if not fraction:
        return whole
    rest = F.substring(text, 21, 6)
    return F.concat(whole, F.when(rest != "", F.concat(F.lit("."), F.rpad(rest, 6, "0"))).otherwise(F.lit("")))
