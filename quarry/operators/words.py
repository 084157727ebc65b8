"""Word count with stop-word removal and top-k.

Plan shape: scan -> Generate(explode) -> partial HashAggregate -> Exchange
hashpartitioning(word) -> final HashAggregate -> LeftAnti join with the stop
list [-> TakeOrderedAndProject]. A word holding a third of all tokens is
collapsed to one row per task by the partial aggregate before the shuffle, so
hot words do not skew the exchange.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.text import normalise_token, raw_tokens


def tokenize(df: DataFrame, text_col: str = "value", out_col: str = "word") -> DataFrame:
    """One lower-case token per row: punctuation/symbols -> space, split on
    whitespace runs, trim, drop empty pieces, lower-case."""
    pieces = df.select(F.explode(raw_tokens(F.col(text_col))).alias("_piece"))
    return (pieces.select(normalise_token(F.col("_piece")).alias(out_col))
            .where(F.col(out_col) != ""))


def remove_stop_words(tokens: DataFrame, stop_words: DataFrame, col: str = "word") -> DataFrame:
    """Drop rows whose ``col`` is found in ``stop_words`` (column ``word``), exact match.

    Spark broadcasts the list if it is small by its own byte threshold.
    """
    stop = stop_words.select(F.col("word").alias("_stop")).distinct()
    return tokens.join(stop, tokens[col] == stop["_stop"], "left_anti")


def word_count(tokens: DataFrame, col: str = "word") -> DataFrame:
    """``(word, n BIGINT)``; counts never overflow (64-bit)."""
    return tokens.groupBy(col).agg(F.count(F.lit(1)).alias("n"))


def top_words(counts: DataFrame, k: int, col: str = "word") -> DataFrame:
    """The ``k`` most frequent words; ties broken by word ascending."""
    return counts.orderBy(F.desc("n"), F.asc(col)).limit(k)


def count_words(df: DataFrame, stop_words: DataFrame | None, text_col: str = "value") -> DataFrame:
    """Counts of the words that are not stop words. Words are counted first, so the list meets one
    row per word, never the tokens: a hot word is no hot key of that join."""
    counts = word_count(tokenize(df, text_col))
    return counts if stop_words is None else remove_stop_words(counts, stop_words)
