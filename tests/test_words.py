from pyspark.sql import functions as F

from plans import plan_text
from quarry.operators import words
from quarry.sources.text import stop_words_frame


def _tokens(spark, lines):
    df = spark.createDataFrame([(x,) for x in lines], "value STRING")
    return [r.word for r in words.tokenize(df).collect()]


def test_tokenize_fixture_rows(spark):
    assert _tokens(spark, ["Don't — stop! a+b=c €5 naïve_x"]) == \
        ["don", "t", "stop", "a", "b", "c", "5", "naïve", "x"]
    assert _tokens(spark, ["", "   ", "!!!"]) == []
    assert _tokens(spark, ["ÉTÉ\tété"]) == ["été", "été"]
    assert _tokens(spark, ["x y"]) == ["x y"]
    assert _tokens(spark, ["\x01ab\x02 cd"]) == ["ab", "cd"]


def test_stop_words_exact_match(spark):
    toks = spark.createDataFrame([("don",), ("t",), ("the",), ("The",), ("x",)], "word STRING")
    stop = stop_words_frame(spark, ["don't", "the", "X"])
    kept = sorted(r.word for r in words.remove_stop_words(toks, stop).collect())
    assert kept == ["The", "don", "t", "x"]
    empty = stop_words_frame(spark, [])
    assert words.remove_stop_words(toks, empty).count() == 5


def test_count_and_topk_ties(spark):
    df = spark.createDataFrame([("b a c a b d",)], "value STRING")
    counts = words.count_words(df, None)
    assert [tuple(r) for r in words.top_words(counts, 3).collect()] == [("a", 2), ("b", 2), ("c", 1)]
    assert words.top_words(counts, 10).count() == 4
    assert words.top_words(counts, 0).count() == 0


def test_plan_is_jvm_side(spark):
    df = spark.createDataFrame([("the cat sat",)], "value STRING")
    q = words.top_words(words.count_words(df, stop_words_frame(spark)), 5)
    plan = plan_text(q)
    assert "TakeOrderedAndProject" in plan
    assert "LeftAnti" in plan and "Broadcast" in plan
    assert "Python" not in plan and "ArrowEval" not in plan
