"""Civil days and epoch seconds.

Nothing here depends on the session time zone: bounds are literals, and
conversions run on zone-less timestamps with the zone named.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone, tzinfo
from zoneinfo import ZoneInfo

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

SEOUL = "Asia/Seoul"
_EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"

# The date layouts met in stored pages and API records.
DOT_LONG = "yyyy.M.d H:m"
DOT_SHORT = "yy.M.d H:m"
DASH = "yyyy-M-d H:m:s"
ISO_Z = "yyyy-M-d'T'H:m:s'Z'"


def as_date(day: str | date) -> date:
    return day if isinstance(day, date) else date.fromisoformat(day)


def _zone(name: str) -> tzinfo:
    if name[:1] in "+-":
        hours, minutes = name[1:].split(":")
        offset = timedelta(hours=int(hours), minutes=int(minutes))
        return timezone(offset if name[0] == "+" else -offset)
    return ZoneInfo(name)


def _midnight(day: date, zone: str) -> int:
    return int(datetime(day.year, day.month, day.day, tzinfo=_zone(zone)).timestamp())


def day_bounds(first: str | date, last: str | date | None = None, zone: str = SEOUL) -> tuple[int, int]:
    """First and last epoch second of the civil days ``first`` .. ``last``."""
    start = as_date(first)
    end = as_date(last) if last is not None else start
    return _midnight(start, zone), _midnight(end + timedelta(days=1), zone) - 1


def within_days(epoch: Column, first, last=None, zone: str = SEOUL) -> Column:
    """Epoch seconds inside the civil days; plain literals, so it reaches the scan."""
    lo, hi = day_bounds(first, last, zone)
    return epoch.between(F.lit(lo), F.lit(hi))


def _utc(epoch: int) -> Column:
    """A literal wall-clock timestamp in UTC."""
    return F.expr(f"TIMESTAMP_NTZ '{datetime.fromtimestamp(epoch, timezone.utc):%Y-%m-%d %H:%M:%S}'")


def between_days(utc: Column, first, last=None, zone: str = SEOUL) -> Column:
    """A UTC timestamp without zone inside the civil days of ``zone``; literal bounds on the column, for the scan."""
    lo, hi = day_bounds(first, last, zone)
    return (utc >= _utc(lo)) & (utc < _utc(hi + 1))


def in_month(utc: Column, day: str | date, zone: str = SEOUL) -> Column:
    """A UTC timestamp without zone inside the month of ``day`` in ``zone``."""
    first, following = month_bounds(day)
    return (utc >= _utc(_midnight(first, zone))) & (utc < _utc(_midnight(following, zone)))


def within_lookback(day_col: Column, day: str | date, days: int = 7) -> Column:
    """A date (or ``yyyy-MM-dd`` text) from ``days`` before ``day`` up to ``day``."""
    end = as_date(day)
    return day_col.between(F.lit((end - timedelta(days=days)).isoformat()), F.lit(end.isoformat()))


def month_bounds(day: str | date) -> tuple[date, date]:
    """First day of the month of ``day`` and of the month after."""
    first = as_date(day).replace(day=1)
    return first, (first + timedelta(days=32)).replace(day=1)


def within_month(epoch: Column, day: str | date, zone: str = SEOUL) -> Column:
    first, following = month_bounds(day)
    return (epoch >= F.lit(_midnight(first, zone))) & (epoch < F.lit(_midnight(following, zone)))


def shift_day(day: str | date, days: int = -1) -> date:
    return as_date(day) + timedelta(days=days)


def day_parts(day_col: Column) -> list[Column]:
    """Zero-padded year, month and day texts, as used in dated paths."""
    return [
        F.date_format(day_col, pattern).alias(name)
        for pattern, name in (("yyyy", "year"), ("MM", "month"), ("dd", "day"))
    ]


def to_local_timestamp(epoch: Column, zone: str = SEOUL) -> Column:
    """Epoch seconds -> wall-clock timestamp (no zone) in ``zone``."""
    utc = F.timestamp_add("SECOND", epoch, F.expr(_EPOCH))
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)


def to_local_date(epoch: Column, zone: str = SEOUL) -> Column:
    return to_local_timestamp(epoch, zone).cast("date")


def to_epoch(local: Column, zone: str = "UTC") -> Column:
    """Zone-less wall-clock timestamp in ``zone`` -> epoch seconds."""
    utc = F.convert_timezone(F.lit(zone), F.lit("UTC"), local)
    return F.timestamp_diff("SECOND", F.expr(_EPOCH), utc)


def parse_epoch(text: Column, *layouts: str, zone: str = SEOUL) -> Column:
    """Wall-clock text in one of the layouts -> epoch seconds, else NULL."""
    parsed = [F.try_to_timestamp(text, F.lit(layout)).cast("timestamp_ntz") for layout in layouts]
    return to_epoch(F.coalesce(*parsed) if len(parsed) > 1 else parsed[0], zone)


def parse_short_date(text: Column) -> Column:
    """``25. 01. 30`` -> 2025-01-30, else NULL."""
    return F.try_to_timestamp(F.concat(F.lit("20"), F.trim(text)), F.lit("yyyy. M. d")).cast("date")


def before_marker(text: Column, marker: str) -> Column:
    """Text ahead of the first marker, stripped: ``created / edited`` -> ``created``."""
    return F.regexp_replace(F.substring_index(text, marker, 1), r"^\s+|\s+$", "")


def register_sql_functions(spark: SparkSession) -> None:
    """The epoch-to-Seoul conversion for SQL users of this session."""
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION convert_unix_ts_to_seoul(unix_ts BIGINT) "
        "RETURNS TIMESTAMP_NTZ RETURN convert_timezone('UTC', 'Asia/Seoul', "
        f"timestampadd(SECOND, unix_ts, {_EPOCH}))"
    )
