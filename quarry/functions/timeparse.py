"""Zone-free parsing of the two record time formats into wall-clock time and epoch seconds.

Both formats are fixed width, so a row is first checked against a pattern and
its fields are then cut out by position; no value ever passes through a
session-time-zone ``TIMESTAMP``. Invalid calendar values (Feb 30, hour 24,
second 60, a weekday that does not match the date) give NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The tweet time format "EEE MMM dd HH:mm:ss Z yyyy" with English
# names, e.g. "Mon Jun 16 10:00:00 +0000 2014" (30 characters), and the record
# time format "yyyy/MM/dd HH:mm:ss", e.g. "2024/01/02 03:04:05" (19 characters).
# (\z, not $: that would also match before a trailing line end.)
WEEKDAYS = ["Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"]
MONTHS = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]
TWEET_TIME_PATTERN = (r"^(" + "|".join(WEEKDAYS) + r") (" + "|".join(MONTHS) + r") "
                      r"[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2} [+-][0-9]{4} [0-9]{4}\z")
SLASH_TIME_PATTERN = r"^[0-9]{4}/[0-9]{2}/[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}\z"


def _field(c: Column, pos: int, length: int) -> Column:
    return F.substring(c, pos, length).try_cast("int")


def _wall_clock(ok: Column, year: Column, month: Column, day: Column,
                hour: Column, minute: Column, second: Column) -> Column:
    # make_timestamp would roll second 60 into the next minute: reject it first.
    return F.when(ok & (second < 60) & (year >= 1),
                  F.try_make_timestamp_ntz(year, month, day, hour, minute, second))


def epoch_seconds(wall: Column) -> Column:
    """Seconds since 1970-01-01 00:00:00 of a wall-clock (NTZ) time, read as UTC."""
    return (F.unix_date(wall.cast("date")).cast("bigint") * 86400
            + F.hour(wall) * 3600 + F.minute(wall) * 60 + F.second(wall))


def parse_tweet_time(c: Column) -> Column:
    """``struct<wall: timestamp_ntz, offset_seconds: int>``; ``wall`` is NULL when invalid.

    The UTC offset is parsed and validated but not applied to ``wall``.
    """
    ok = c.rlike(TWEET_TIME_PATTERN)
    month = F.array_position(F.array(*[F.lit(m) for m in MONTHS]), F.substring(c, 5, 3)).cast("int")
    wall = _wall_clock(ok, _field(c, 27, 4), month, _field(c, 9, 2),
                       _field(c, 12, 2), _field(c, 15, 2), _field(c, 18, 2))
    off_h, off_m = _field(c, 22, 2), _field(c, 24, 2)
    offset_ok = (off_h <= 18) & (off_m <= 59) & ((off_h * 60 + off_m) <= 18 * 60)
    weekday_ok = F.date_format(wall, "EEE") == F.substring(c, 1, 3)
    sign = F.when(F.substring(c, 21, 1) == "-", F.lit(-1)).otherwise(F.lit(1))
    valid_wall = F.when(offset_ok & weekday_ok, wall)
    return F.struct(valid_wall.alias("wall"), (sign * (off_h * 3600 + off_m * 60)).alias("offset_seconds"))


def parse_slash_time(c: Column) -> Column:
    """``yyyy/MM/dd HH:mm:ss`` -> timestamp_ntz, NULL on anything else (exact width, no spaces)."""
    ok = c.rlike(SLASH_TIME_PATTERN)
    return _wall_clock(ok, _field(c, 1, 4), _field(c, 6, 2), _field(c, 9, 2),
                       _field(c, 12, 2), _field(c, 15, 2), _field(c, 18, 2))


def parse_with_pattern(c: Column, pattern: str) -> Column:
    """Any datetime pattern -> timestamp_ntz, NULL on failure, zone-free.

    Goes through the JSON reader's ``timestampNTZFormat`` because it is the
    tolerant parser that never consults the session time zone.
    """
    wrapped = F.to_json(F.struct(c.alias("t")))
    return F.from_json(wrapped, "t TIMESTAMP_NTZ", {"timestampNTZFormat": pattern})["t"]
