"""Word-count queries over whole ``documents.text``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quarry.operators import words
from quarry.plans.tables import table
from quarry.sources.text import default_stop_words, stop_words_frame, text_column

TOP_K = 20


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_column(table(spark, sf_dir, "documents"), "text")


def _stop(spark: SparkSession) -> DataFrame:
    return stop_words_frame(spark)


def word_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return words.tokenize(_lines(spark, sf_dir))


def word_stop_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return words.remove_stop_words(words.tokenize(_lines(spark, sf_dir)), _stop(spark))


def word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return words.count_words(_lines(spark, sf_dir), _stop(spark))


def word_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return words.top_words(word_count(spark, sf_dir), TOP_K)


QUERIES = {
    "word_tokens": word_tokens,
    "word_stop_filtered": word_stop_filtered,
    "word_count": word_count,
    "word_topk": word_topk,
}


def _stop_values_sql() -> str:
    rows = ", ".join("('" + w.replace("'", "''") + "')" for w in sorted(set(default_stop_words())))
    return f"stop(word) AS (VALUES {rows})"


_TOKENS_SQL = r"""
pieces AS (
  SELECT unnest(string_split_regex(regexp_replace(text, '[\p{P}\p{S}]', ' ', 'g'), '[ \t\n\x0B\f\r]+')) AS piece
  FROM documents
),
tokens AS (
  SELECT lower(regexp_replace(piece, '^[\x00-\x20]+|[\x00-\x20]+$', '', 'g')) AS word FROM pieces
),
kept AS (SELECT word FROM tokens WHERE word <> '')"""


def oracle() -> dict[str, str]:
    stop = _stop_values_sql()
    filtered = f"WITH {_TOKENS_SQL}, {stop} SELECT word FROM kept WHERE word NOT IN (SELECT word FROM stop)"
    counts = (f"WITH {_TOKENS_SQL}, {stop} SELECT word, count(*) AS n FROM kept "
              f"WHERE word NOT IN (SELECT word FROM stop) GROUP BY word")
    return {
        "word_tokens": f"WITH {_TOKENS_SQL} SELECT word FROM kept",
        "word_stop_filtered": filtered,
        "word_count": counts,
        "word_topk": f"SELECT * FROM ({counts}) ORDER BY n DESC, word ASC LIMIT {TOP_K}",
    }
