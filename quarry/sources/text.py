"""Line-oriented readers."""

from __future__ import annotations

import uuid
from importlib import resources

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def read_lines(spark: SparkSession, path: str, min_partitions: int | None = None) -> DataFrame:
    """One row per line (``value STRING``); directories, globs and compressed files work.

    Split size follows ``spark.sql.files.maxPartitionBytes``; ``min_partitions`` makes the splits
    small enough that there are at least that many (as far as the files can be split), with no shuffle.
    Split settings belong to a session, so the scan is planned in one of its own and handed over as a view.
    """
    if not min_partitions:
        return spark.read.text(path)
    narrow = spark.newSession()
    narrow.conf.set("spark.sql.files.maxPartitionBytes", spark.conf.get("spark.sql.files.maxPartitionBytes"))
    narrow.conf.set("spark.sql.files.minPartitionNum", str(min_partitions))
    narrow.conf.set("spark.sql.files.openCostInBytes", "0")
    view = f"lines_{uuid.uuid4().hex}"
    narrow.read.text(path).createGlobalTempView(view)
    lines = spark.table(f"global_temp.{view}")
    narrow.catalog.dropGlobalTempView(view)
    return lines


def ordered_lines(spark: SparkSession, path: str) -> DataFrame:
    """``value`` with its place: ``file``, ``block`` (where its input split begins) and ``line`` (its order
    within the split). The three in this order are the order of the lines in their files.

    Lines end at ``\\n`` alone, so a carriage return stays part of its line and byte counts are exact.
    """
    return spark.read.option("lineSep", "\n").text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"))


def with_offsets(lines: DataFrame) -> DataFrame:
    """``ordered_lines`` plus ``offset``: the bytes of its file before the line.

    Summed within each input split, plus the splits before it: a task holds one split at most.
    """
    size = F.octet_length("value") + 1
    split = Window.partitionBy("file", "block").orderBy("line").rowsBetween(Window.unboundedPreceding, -1)
    within = lines.withColumn("_within", F.coalesce(F.sum(size).over(split), F.lit(0)))
    sums = lines.groupBy("file", "block").agg(F.sum(size).alias("_sum"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = sums.select("file", "block", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_before"))
    return within.join(before, ["file", "block"]).withColumn("offset", F.col("_before") + F.col("_within")).drop(
        "_before", "_within")


def text_column(df: DataFrame, column: str) -> DataFrame:
    """Use any string column of a table as the line input."""
    return df.select(F.col(column).alias("value"))


def read_word_list(spark: SparkSession, path: str) -> DataFrame:
    """A word list: one entry per line, blank lines skipped, set semantics.

    Entries are compared exactly (no trimming, no case folding).
    """
    return read_lines(spark, path).where(F.col("value") != "").select(F.col("value").alias("word")).distinct()


def default_stop_words() -> list[str]:
    """Spark ML's English stop-word list (StopWordsRemover default), shipped as a file."""
    text = resources.files("quarry.resources").joinpath("stopwords_english.txt").read_text(encoding="utf-8")
    return [w for w in text.split("\n") if w != ""]


def stop_words_frame(spark: SparkSession, words: list[str] | None = None) -> DataFrame:
    words = default_stop_words() if words is None else words
    # One literal, so that Spark knows the list is small and broadcasts it.
    listed = F.explode(F.split(F.lit("\n".join(sorted(set(words)))), "\n"))
    return spark.range(1).select(listed.alias("word")).where(F.col("word") != "")
