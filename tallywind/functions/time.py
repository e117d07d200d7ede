"""Decoding of epoch seconds into local wall-clock time, independent of the session time zone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def local_time(epoch: str, tz: str = "UTC") -> Column:
    """Epoch seconds as a zone-less timestamp in ``tz``."""
    utc = F.expr(f"timestamp_ntz'1970-01-01 00:00:00' + make_dt_interval(0, 0, 0, `{epoch}`)")
    return utc if tz == "UTC" else F.convert_timezone(F.lit("UTC"), F.lit(tz), utc)


def epoch_to_datetime(epoch: str, tz: str = "UTC") -> Column:
    """``YYYY-MM-DD HH:MM:SS`` text of the local time."""
    return local_time(epoch, tz).cast("string")


def day_of_month(epoch: str, tz: str = "UTC") -> Column:
    return F.dayofmonth(local_time(epoch, tz))


def day_index(epoch: str, tz: str = "UTC") -> Column:
    """Days since 1970-01-01: a day number that keeps growing across months."""
    return F.unix_date(local_time(epoch, tz).cast("date"))


def hour_of_day(epoch: str, tz: str = "UTC") -> Column:
    return F.hour(local_time(epoch, tz))


def hour_before(hour: str) -> Column:
    return F.pmod(F.col(hour) - 1, F.lit(24))


def hour_after(hour: str) -> Column:
    return F.pmod(F.col(hour) + 1, F.lit(24))


def hour_bucket(hour: str) -> Column:
    """1 for the morning (7-12), 2 for the afternoon (13-20), 3 for the night."""
    h = F.col(hour)
    return F.when(h.between(7, 12), 1).when(h.between(13, 20), 2).otherwise(3)


DAY_NUMBERS = {"month": day_of_month, "index": day_index}


def with_clock(df: DataFrame, epoch: str = "context_timestamp", tz: str = "UTC", day_number: str = "month") -> DataFrame:
    """Add ``day`` and ``hour``. The day is that of the month, or for ``index`` a number that grows across months."""
    return df.withColumns({"day": DAY_NUMBERS[day_number](epoch, tz), "hour": hour_of_day(epoch, tz)})


def check_day_number(df: DataFrame, epoch: str = "context_timestamp", tz: str = "UTC", day_number: str = "month") -> None:
    """An error where the day of the month would put later rows before earlier ones: the log spans months."""
    if day_number == "month":
        first, last = df.agg(F.min(epoch), F.max(epoch)).select(*[F.trunc(local_time(c, tz).cast("date"), "month") for c in (f"min({epoch})", f"max({epoch})")]).first()
        if first != last:
            raise ValueError("the log spans more than one month: use day_number='index' and a DayPlan in the same numbers")
