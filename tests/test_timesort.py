import glob
import os

import pytest
from pyspark.errors import PySparkException
from py4j.protocol import Py4JJavaError

from quarry.operators import timesort
from quarry.operators.ordering import with_position
from quarry.sinks.writers import write_ordered_text


def _lines(spark, rows):
    return spark.createDataFrame([(x,) for x in rows], "value STRING")


def _json(created, text=None, with_text=True):
    import json
    d = {"created_at": created}
    if with_text:
        d["text"] = text
    return json.dumps(d)


def test_json_fixture_rows(spark):
    rows = [
        _json("Mon Jun 16 10:00:00 +0000 2014", "a\nb"),
        _json("Mon Jun 16 10:00:00 +0900 2014", "c\rd"),
        _json("Sat Jan 01 00:00:59 +0000 2011", "early"),
        _json("Sat Jan 01 00:01:00 +0000 2011", "bound"),
        _json("Mon Jun 16 10:00:01 +0000 2014", with_text=False),
    ]
    out = {r.line for r in timesort.json_time_records(_lines(spark, rows)).collect()}
    assert out == {"1402912800@a b", "1402912800@c\rd", "1293840060@bound", "1402912801@"}


def test_json_honor_offset(spark):
    rows = [_json("Mon Jun 16 10:00:00 +0900 2014", "x")]
    got = timesort.json_time_records(_lines(spark, rows), honor_offset=True).first()
    assert got.epoch == 1402912800 - 9 * 3600


@pytest.mark.parametrize("bad", [
    _json("Mon Jun 16 10:00:00 +0000 2014", None),        # explicit null text
    _json("Tue Jun 16 10:00:00 +0000 2014", "wrong weekday"),
    _json("Mon Jun 6 10:00:00 +0000 2014", "one-digit day"),
    _json("Mon Jun 16 10:00:00 Z 2014", "Z offset"),
    '{"text": "no time"}',
    "not json",
])
def test_json_fail_and_drop_modes(spark, bad):
    good = _json("Mon Jun 16 10:00:00 +0000 2014", "ok")
    with pytest.raises((Py4JJavaError, PySparkException)):
        timesort.json_time_records(_lines(spark, [good, bad])).collect()
    kept = timesort.json_time_records(_lines(spark, [good, bad]), on_error="drop").collect()
    assert [r.text for r in kept] == ["ok"]


def test_csv_fixture_rows(spark):
    rows = ["1,2024/01/02 03:04:05,x", "3,2024/01/01 00:00:00", "bad", ",,", "",
            "2,2024/1/02 03:04:05,x", "7, 2024/01/02 03:04:05", "8,2024/01/02 03:04:05 ,y",
            "9,2024/01/02 03:04:60", "4,2024/02/30 10:00:00", "5,2024/01/31 24:00:00"]
    ordered, rejects = timesort.csv_time_sort(_lines(spark, rows), with_pos=True)
    got = [(r.pos, r.value) for r in ordered.orderBy("pos").collect()]
    assert got == [(0, "3,2024/01/01 00:00:00"), (1, "1,2024/01/02 03:04:05,x")]
    assert sorted(r.value for r in rejects.collect()) == sorted(rows[2:])


def test_csv_time_is_zone_free(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        ordered, _ = timesort.csv_time_sort(_lines(spark, ["6,2014/03/09 02:30:00"]))
        assert ordered.first().epoch == 1394332200
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_global_position_and_ordered_files(spark, tmp_dir):
    df = spark.range(0, 5000).selectExpr("(id * 7919) % 5000 AS k", "CAST(id AS STRING) AS v")
    pos = with_position(df, ["k"], n_partitions=7).orderBy("pos").collect()
    assert [r.pos for r in pos] == list(range(5000))
    assert [r.k for r in pos] == sorted(r.k for r in pos)
    out = os.path.join(tmp_dir, "sorted")
    write_ordered_text(df.selectExpr("k", "lpad(CAST(k AS STRING), 6, '0') AS line"), ["k"], "line", out, 7)
    lines = []
    for f in sorted(glob.glob(os.path.join(out, "part-*"))):
        lines += open(f).read().split()
    assert lines == sorted(lines) and len(lines) == 5000


def test_since_bound_is_zone_free(spark):
    rows = [_json("Sat Jan 01 00:00:59 +0000 2011", "early"), _json("Sat Jan 01 00:01:00 +0000 2011", "bound")]
    for tz in ["America/New_York", "Asia/Kolkata"]:
        spark.conf.set("spark.sql.session.timeZone", tz)
        try:
            got = [r.text for r in timesort.json_time_records(_lines(spark, rows)).collect()]
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
        assert got == ["bound"], tz


def test_text_must_be_a_json_string(spark):
    for value in (5, True, 1.5, {"a": 1}, ["x"], None):
        row = _json("Mon Jun 16 10:00:00 +0000 2014", value)
        assert timesort.json_time_records(_lines(spark, [row]), on_error="drop").count() == 0, value
        with pytest.raises((Py4JJavaError, PySparkException)):
            timesort.json_time_records(_lines(spark, [row])).collect()
    with pytest.raises((Py4JJavaError, PySparkException)):
        timesort.json_time_records(_lines(spark, [_json("Mon Jun 16 10:00:00 +0000 2014\n", "x")])).collect()


def test_rejects_are_counted_in_the_one_parse(spark):
    from pyspark.sql import Observation
    seen = Observation()
    lines = _lines(spark, ["1,2024/01/02 03:04:05,x", "bad", "2,2024/01/02 03:04:05\n", "3,2024/01/01 00:00:00"])
    ordered, rejects = timesort.csv_time_sort(lines, with_pos=True, counts=seen)
    assert seen.get == {"kept": 2, "rejected": 2}
    assert [r.value[0] for r in ordered.orderBy("pos").collect()] == ["3", "1"] and rejects.count() == 2


def test_equal_lines_are_split_over_partitions(spark):
    from quarry.operators.ordering import range_sorted
    same = _lines(spark, ["1,2024/01/02 03:04:05,x"] * 4000).repartition(8)
    sizes = range_sorted(same, ["value"], 8).rdd.glom().map(len).collect()
    assert sum(sizes) == 4000 and max(sizes) < 1500


def test_json_rejects_and_counts_come_from_one_parse(spark):
    from pyspark.sql import Observation
    seen = Observation()
    bad = ["not json", '{"text": "no time"}', _json("Mon Jun 16 10:00:00 +0000 2014", None), '{"created_at": 5}', "[1]", "", None,
           '{"text": "a", "text": "b"}']
    lines = _lines(spark, [_json("Mon Jun 16 10:00:00 +0000 2014", "b"), _json("Sat Jan 01 00:00:59 +0000 2011", "early"),
                           _json("Mon Jun 16 10:00:00 +0000 2014", with_text=False), *bad])
    records, rejects = timesort.json_time_split(lines, counts=seen)
    assert seen.get == {"kept": 2, "early": 1, "rejected": len(bad)}
    assert sorted(r.text for r in records.collect()) == ["", "b"]
    assert sorted(str(r.value) for r in rejects.collect()) == sorted(map(str, bad))
    for recs in (timesort.json_time_records(lines), timesort.json_time_records(lines, on_error="drop")):
        plan = recs._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("parseJson") == 1 and plan.count("RLIKE") <= 2
    ordered = timesort.json_time_sort(lines, on_error="drop", with_pos=True)
    assert [(r.pos, r.text) for r in ordered.orderBy("pos").collect()] == [(0, ""), (1, "b")]
