"""Time-ordering queries over lines that Spark renders from the whole ``events`` table.

JSON lines: ``created_at`` = the event time in the tweet format, with offset
``-0500`` for ``view`` events and ``+0000`` otherwise (the offset is dropped);
``text`` = ``event_type + '\\n' + props``, and no ``text`` key at all for
``error`` events (defaults to ''). CSV lines: ``event_id,time,user_id,event_type``
with the time as ``yyyy/MM/dd HH:mm:ss``, except ``error`` events, which carry
an ISO time and are rejected.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from quarry.operators import timesort
from quarry.plans.tables import table

SINCE = _dt.datetime(2024, 1, 15, 0, 0, 0)


def _clock(ts: str) -> F.Column:
    """HH:mm:ss of a wall-clock time, read field by field (no session time zone)."""
    return F.format_string("%02d:%02d:%02d", F.hour(ts), F.minute(ts), F.second(ts))


def json_lines(spark: SparkSession, sf_dir: str, which: F.Column | None = None) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    if which is not None:
        ev = ev.where(which)
    offset = F.when(F.col("event_type") == "view", F.lit("-0500")).otherwise(F.lit("+0000"))
    day = F.date_format(F.col("ts").cast("date"), "EEE MMM dd")
    created = F.concat_ws(" ", day, _clock("ts"), offset, F.format_string("%04d", F.year("ts")))
    text = F.concat(F.col("event_type"), F.lit("\n"), F.col("props"))
    line = F.when(F.col("event_type") == "error", F.to_json(F.struct(created.alias("created_at")))) \
            .otherwise(F.to_json(F.struct(created.alias("created_at"), text.alias("text"))))
    return ev.select(line.alias("value"))


def json_lines_with_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The JSON lines, but ``error`` events as no JSON, ``view`` events with a null text, ``signup`` events without a time."""
    ev = table(spark, sf_dir, "events")
    number = F.col("event_id").cast("string")
    broken = (F.when(F.col("event_type") == "error", F.concat(F.lit("not json "), number))
              .when(F.col("event_type") == "view",
                    F.concat(F.lit('{"created_at":"Mon Jan 01 00:00:00 +0000 2024","text":null,"id":'), number, F.lit("}")))
              .when(F.col("event_type") == "signup", F.concat(F.lit('{"text":"no time","id":'), number, F.lit("}"))))
    good = json_lines(spark, sf_dir, F.col("event_type").isin("click", "purchase"))
    return good.unionByName(ev.select(broken.alias("value")).where(F.col("value").isNotNull()))


def csv_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    fields = [F.year("ts"), F.month("ts"), F.dayofmonth("ts"), F.hour("ts"), F.minute("ts"), F.second("ts")]
    when = F.when(F.col("event_type") == "error", F.format_string("%04d-%02d-%02dT%02d:%02d:%02d", *fields)) \
            .otherwise(F.format_string("%04d/%02d/%02d %02d:%02d:%02d", *fields))
    return ev.select(F.concat_ws(",", F.col("event_id").cast("string"), when,
                                 F.col("user_id").cast("string"), F.col("event_type")).alias("value"))


def json_time_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timesort.json_time_records(json_lines(spark, sf_dir)).select("epoch", "text")


def json_time_since(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timesort.json_time_records(json_lines(spark, sf_dir), since=SINCE).select("epoch", "text")


def json_time_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timesort.json_time_sort(json_lines(spark, sf_dir), with_pos=True).select("pos", "epoch", "line")


def json_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines that are no valid record, as they came."""
    return timesort.json_time_split(json_lines_with_rejects(spark, sf_dir))[1]


def json_reject_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the one parse has seen: records kept, records before the bound, rejects; and how many of the kept were sorted."""
    seen = Observation()
    ordered = timesort.json_time_sort(json_lines_with_rejects(spark, sf_dir), since=SINCE, on_error="drop", with_pos=True, counts=seen)
    told = seen.get
    return ordered.agg(F.count(F.lit(1)).alias("sorted"), F.max("pos").alias("last_pos")).select(
        *[F.lit(told[c]).cast("bigint").alias(c) for c in ("kept", "early", "rejected")], "sorted", "last_pos")


def csv_time_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    ordered, _ = timesort.csv_time_sort(csv_lines(spark, sf_dir), with_pos=True)
    return ordered.select("pos", "epoch", "value")


def csv_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, rejects = timesort.csv_time_sort(csv_lines(spark, sf_dir))
    return rejects


QUERIES = {
    "json_time_extract": json_time_extract,
    "json_time_since": json_time_since,
    "json_time_sort": json_time_sort,
    "json_rejects": json_rejects,
    "json_reject_counts": json_reject_counts,
    "csv_time_sort": csv_time_sort,
    "csv_rejects": csv_rejects,
}

_JSON_EXPECTED = """
WITH recs AS (
  SELECT epoch(date_trunc('second', ts))::BIGINT AS epoch, date_trunc('second', ts) AS wall,
         CASE WHEN event_type = 'error' THEN '' ELSE event_type || chr(10) || props END AS text
  FROM events
)"""

_CSV_LINES = """
WITH lines AS (
  SELECT concat_ws(',', CAST(event_id AS VARCHAR),
           CASE WHEN event_type = 'error' THEN strftime(ts, '%Y-%m-%dT%H:%M:%S')
                ELSE strftime(ts, '%Y/%m/%d %H:%M:%S') END,
           CAST(user_id AS VARCHAR), event_type) AS value
  FROM events
),
parsed AS (
  SELECT value, try_strptime(split_part(value, ',', 2), '%Y/%m/%d %H:%M:%S') AS t FROM lines
)"""


def csv_lines_sql() -> str:
    """A CTE ``lines (value)``."""
    return _CSV_LINES


def oracle() -> dict[str, str]:
    since = SINCE.strftime("%Y-%m-%d %H:%M:%S")
    return {
        "json_time_extract": f"{_JSON_EXPECTED} SELECT epoch, text FROM recs WHERE wall >= TIMESTAMP '2011-01-01 00:01:00'",
        "json_time_since": f"{_JSON_EXPECTED} SELECT epoch, text FROM recs WHERE wall >= TIMESTAMP '{since}'",
        "json_time_sort": (f"{_JSON_EXPECTED}, lined AS (SELECT epoch, CAST(epoch AS VARCHAR) || '@' || "
                           "replace(text, chr(10), ' ') AS line FROM recs WHERE wall >= TIMESTAMP '2011-01-01 00:01:00') "
                           "SELECT row_number() OVER (ORDER BY epoch, line) - 1 AS pos, epoch, line FROM lined"),
        "json_rejects": """SELECT CASE event_type WHEN 'error' THEN 'not json ' || event_id
  WHEN 'view' THEN '{"created_at":"Mon Jan 01 00:00:00 +0000 2024","text":null,"id":' || event_id || '}'
  ELSE '{"text":"no time","id":' || event_id || '}' END AS value FROM events WHERE event_type IN ('error', 'view', 'signup')""",
        "json_reject_counts": f"""WITH seen AS (SELECT event_type NOT IN ('click', 'purchase') AS bad,
  date_trunc('second', ts) < TIMESTAMP '{since}' AS early FROM events)
SELECT count(*) FILTER (NOT bad AND NOT early) AS kept, count(*) FILTER (NOT bad AND early) AS early, count(*) FILTER (bad) AS rejected,
  count(*) FILTER (NOT bad AND NOT early) AS sorted, count(*) FILTER (NOT bad AND NOT early) - 1 AS last_pos FROM seen""",
        "csv_time_sort": (f"{_CSV_LINES} SELECT row_number() OVER (ORDER BY epoch(t)::BIGINT, value) - 1 AS pos, "
                          "epoch(t)::BIGINT AS epoch, value FROM parsed WHERE t IS NOT NULL"),
        "csv_rejects": f"{_CSV_LINES} SELECT value FROM parsed WHERE t IS NULL",
    }
