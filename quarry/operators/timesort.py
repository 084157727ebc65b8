"""Time-ordering of JSON-line and CSV-line records.

JSON lines: ``created_at`` in the tweet format, ``text`` (missing -> '').
Rows before ``since`` (default 2011-01-01 00:01:00, bound kept) are dropped;
the rest are ordered by epoch seconds of the wall clock (the UTC offset is
parsed but ignored unless ``honor_offset``), ties by rendered line, and
rendered ``epoch@text`` with ``\\n`` replaced by a space.

CSV lines: field ``field`` (0-based, split on ',') holds ``yyyy/MM/dd
HH:mm:ss``; lines that do not parse are returned separately as rejects and
are otherwise carried unchanged, in time order (ties by the raw line).

Order is produced by range partitioning (see ``ordering``); nothing is sorted
in one task.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from quarry.functions.text import replace_newlines
from quarry.functions.timeparse import (epoch_seconds, parse_slash_time, parse_tweet_time,
                                        parse_with_pattern)
from quarry.operators.common import require, where_here
from quarry.operators.ordering import range_sorted, with_position
from quarry.session import scratch_copy

# Fixed value: earliest kept tweet time (one minute past midnight, as in the job).
DEFAULT_SINCE = _dt.datetime(2011, 1, 1, 0, 1, 0)
SLASH_PATTERN = "yyyy/MM/dd HH:mm:ss"


def _ntz_literal(t: _dt.datetime):
    """A wall-clock literal that never passes through the session time zone
    (``F.lit(datetime)`` would build a zoned timestamp first)."""
    return F.lit(t.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")


def parse_json_records(lines: DataFrame, value_col: str = "value", honor_offset: bool = False) -> DataFrame:
    """``(value, epoch, wall, text, valid)`` per line; ``valid`` false for bad JSON, a bad
    time, or an explicit ``"text": null``.

    A line is parsed once, to a variant from which both fields come. Bad JSON includes
    a key given twice.
    """
    parsed = lines.select(F.col(value_col).alias("value"), F.try_parse_json(F.col(value_col)).alias("_v"))
    fields = parsed.select("value", F.col("_v").isNotNull().alias("_json"),
                           F.try_variant_get("_v", "$.created_at", "string").alias("_created"),
                           F.try_variant_get("_v", "$.text", "variant").alias("_text"))
    when = parse_tweet_time(F.col("_created"))
    # Only a missing key defaults to ''; null, a number, a boolean or a structure is an error.
    text = (F.when(F.schema_of_variant("_text") == "STRING", F.try_variant_get("_text", "$", "string"))
            .when(F.col("_json") & F.col("_text").isNull(), F.lit("")))
    # Each step reads the columns of the one before, so that no expression is written out twice.
    told = fields.select("value", when["wall"].alias("wall"), when["offset_seconds"].alias("_offset"), text.alias("text"))
    epoch = epoch_seconds(F.col("wall"))
    if honor_offset:
        epoch = epoch - F.col("_offset")
    return told.select("value", epoch.alias("epoch"), "wall", "text", (F.col("wall").isNotNull() & F.col("text").isNotNull()).alias("valid"))


def _rendered(records: DataFrame, since: _dt.datetime | None) -> DataFrame:
    """``(epoch, text, line)`` of valid records from ``since`` on."""
    if since is not None:
        records = where_here(records, F.col("wall") >= _ntz_literal(since))
    line = F.concat(F.col("epoch").cast("string"), F.lit("@"), replace_newlines(F.col("text")))
    return records.select("epoch", "text", line.alias("line"))


def json_time_records(lines: DataFrame, since: _dt.datetime | None = DEFAULT_SINCE,
                      on_error: str = "fail", honor_offset: bool = False,
                      value_col: str = "value") -> DataFrame:
    """``(epoch BIGINT, text STRING, line STRING)`` of kept records, unordered."""
    if on_error not in ("fail", "drop"):
        raise ValueError("on_error must be 'fail' or 'drop'")
    recs = parse_json_records(lines, value_col, honor_offset)
    if on_error == "fail":
        recs = require(recs, F.col("valid"), "unparsable JSON record, time, or null text")
    else:
        recs = where_here(recs, F.col("valid"))
    return _rendered(recs, since)


def json_time_split(lines: DataFrame, since: _dt.datetime | None = DEFAULT_SINCE, honor_offset: bool = False,
                    counts: Observation | None = None) -> tuple[DataFrame, DataFrame]:
    """``(records, rejects)``: what ``json_time_records`` keeps, and the raw lines that are no valid record.

    The lines are parsed once, into a scratch table that both sides read; of a valid record it holds no raw line.
    ``counts``, if given, has ``kept``, ``early`` (valid, but before ``since``) and ``rejected`` after that pass.
    """
    recs = parse_json_records(lines, honor_offset=honor_offset)
    if counts is not None:
        early = F.lit(False) if since is None else F.col("wall") < _ntz_literal(since)
        recs = recs.observe(counts, F.count_if(F.col("valid") & ~early).alias("kept"),
                            F.count_if(F.col("valid") & early).alias("early"), F.count_if(~F.col("valid")).alias("rejected"))
    recs = scratch_copy(recs.withColumn("value", F.when(~F.col("valid"), F.col("value"))), "json-records")
    return _rendered(recs.where("valid"), since), recs.where(~F.col("valid")).select("value")


def json_time_sort(lines: DataFrame, since: _dt.datetime | None = DEFAULT_SINCE,
                   n_partitions: int | None = None, on_error: str = "fail",
                   honor_offset: bool = False, with_pos: bool = False,
                   counts: Observation | None = None) -> DataFrame:
    """Records in time order, ties by line. They are parsed once and staged; the sampling of the range bounds and the
    sort read the staged rows. ``on_error='drop'`` leaves rejects out, ``counts`` reports them (``json_time_split``)."""
    if on_error == "fail":
        recs = scratch_copy(json_time_records(lines, since, on_error, honor_offset), "json-records")
    elif on_error == "drop":
        recs, _ = json_time_split(lines, since, honor_offset, counts)
    else:
        raise ValueError("on_error must be 'fail' or 'drop'")
    keys = ["epoch", "line"]
    return with_position(recs, keys, n_partitions=n_partitions) if with_pos \
        else range_sorted(recs, keys, n_partitions)


def csv_time_records(lines: DataFrame, field: int = 1, pattern: str = SLASH_PATTERN,
                     value_col: str = "value") -> DataFrame:
    """``(value, epoch)``; ``epoch`` NULL for a line whose time field does not parse."""
    raw = F.get(F.split(F.col("value"), ","), field)
    wall = parse_slash_time(raw) if pattern == SLASH_PATTERN else parse_with_pattern(raw, pattern)
    return lines.select(F.col(value_col).alias("value")).select("value", epoch_seconds(wall).alias("epoch"))


def csv_time_sort(lines: DataFrame, field: int = 1, pattern: str = SLASH_PATTERN,
                  n_partitions: int | None = None, with_pos: bool = False,
                  counts: Observation | None = None) -> tuple[DataFrame, DataFrame]:
    """``(sorted, rejects)``: ``sorted`` = ``(epoch, value[, pos])`` in time order,
    ``rejects`` = ``(value)`` of lines whose time does not parse.

    The lines are parsed once, into a scratch table that the sort, its sampling and the
    rejects read. ``counts``, if given, has ``kept`` and ``rejected`` after that pass.
    """
    recs = csv_time_records(lines, field, pattern)
    if counts is not None:
        recs = recs.observe(counts, F.count("epoch").alias("kept"),
                            F.count_if(F.col("epoch").isNull()).alias("rejected"))
    recs = scratch_copy(recs, "csv-records")
    good = recs.where(F.col("epoch").isNotNull())
    rejects = recs.where(F.col("epoch").isNull()).select("value")
    keys = ["epoch", "value"]
    ordered = with_position(good, keys, n_partitions=n_partitions) if with_pos \
        else range_sorted(good, keys, n_partitions)
    return ordered, rejects
