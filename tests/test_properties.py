import calendar
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from quarry.functions.timeparse import epoch_seconds, parse_slash_time, parse_tweet_time
from quarry.operators import gain as G
from quarry.operators import packs as P
from quarry.operators import valueiter as VI


def _random_times(n, seed):
    rnd = random.Random(seed)
    start = dt.datetime(1971, 1, 1)
    return [start + dt.timedelta(seconds=rnd.randrange(0, 80 * 365 * 86400)) for _ in range(n)]


def test_time_parsers_against_python(spark):
    times = _random_times(400, 11)
    rows = []
    for t in times:
        tweet = t.strftime("%a %b %d %H:%M:%S +0000 %Y")
        slash = t.strftime("%Y/%m/%d %H:%M:%S")
        rows.append((tweet, slash, calendar.timegm(t.timetuple())))
    df = spark.createDataFrame(rows, "tweet STRING, slash STRING, expected BIGINT")
    out = df.select("expected",
                    epoch_seconds(parse_tweet_time(F.col("tweet"))["wall"]).alias("a"),
                    epoch_seconds(parse_slash_time(F.col("slash"))).alias("b")).collect()
    assert all(r.a == r.expected and r.b == r.expected for r in out)


def test_time_parsers_reject_corruptions(spark):
    t = dt.datetime(2014, 6, 16, 10, 0, 0)
    bad_tweets = [
        t.strftime("Tue %b %d %H:%M:%S +0000 %Y"),          # weekday does not match
        t.strftime("%a %b %d %H:%M:%S +1900 %Y"),           # offset beyond 18 hours
        t.strftime("%a %b %d %H:%M:%S +0060 %Y"),           # offset minutes
        "Mon Jun 16 10:00:00 +0000 14",
        "mon Jun 16 10:00:00 +0000 2014",
        "Mon Jun 16 10:00:60 +0000 2014",
        "Mon Jun 31 10:00:00 +0000 2014",
        "Mon Jun 16 10:00:00 +0000 2014\n",                 # trailing line ends
    ]
    bad_slash = ["2014/6/16 10:00:00", "2014/06/16 10:00", "2014/06/16T10:00:00", "2014/13/01 00:00:00",
                 "2014/06/16 24:00:00", "2014/06/16 10:00:00.5", "0000/01/01 00:00:00", "2014/06/16 10:00:00\u2028"]
    df = spark.createDataFrame([(a, b) for a, b in zip(bad_tweets, bad_slash)], "tweet STRING, slash STRING")
    out = df.select(parse_tweet_time(F.col("tweet"))["wall"].alias("a"), parse_slash_time(F.col("slash")).alias("b"))
    assert all(r.a is None and r.b is None for r in out.collect())


def test_values_grow_from_zero_and_stay_bounded(spark):
    sizes = spark.createDataFrame([(i, float(s)) for i, s in enumerate([4, 1, 3, 2, 5, 1])], "idx INT, size DOUBLE")
    line = P.item_line(sizes)
    packs = P.attach_sizes(P.generate_packs(line, [2, 3]), line).withColumn("idx", F.col("pack_id"))
    cost = VI.cost_table(G.pair_gains(packs, [(2, 3)], 16.0))
    trans = spark.createDataFrame([(2, 3, 1.0), (3, 2, 3.0)], "from_state INT, to_state INT, weight DOUBLE")
    probs = VI.transition_probs(trans)
    previous = None
    for sweeps in (1, 2, 3):
        res = VI.value_iteration(cost, probs, packs, max_sweeps=sweeps, threshold=None)
        v = {(r.state, r.pack_id): r.v for r in res.values.collect()}
        assert all(0.0 <= x <= 16.0 / (1 - VI.GAMMA) + 1e-9 for x in v.values())
        if previous is not None:
            assert all(v[k] >= previous[k] - 1e-9 for k in v)
        previous = v
