"""Word count over a directory that keeps receiving text files.

Same operators as the batch job (tokenize, count, stop-word anti-join): the count
is a streaming aggregation whose state is kept in the checkpoint location (under
the shared checkpoint directory by default), so a restarted query resumes where
it stopped; its words meet the stop list in a stream-static anti-join.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from quarry.operators import words
from quarry.session import checkpoint_dir


def streaming_word_counts(spark: SparkSession, path: str, stop_words: DataFrame | None,
                          max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return words.count_words(reader.load(path), stop_words)


def start_word_count(counts: DataFrame, query_name: str, sink: str,
                     checkpoint_location: str | None = None, available_now: bool = False,
                     **options: str) -> StreamingQuery:
    """Complete-mode output of ``(word, n)`` to ``sink`` (a format; the memory one keeps every word on
    the driver, for tests); ``available_now`` drains the input and stops."""
    location = checkpoint_location or os.path.join(checkpoint_dir(counts.sparkSession),
                                                   f"stream-{query_name}-{uuid.uuid4().hex}")
    writer = (counts.writeStream.outputMode("complete").format(sink).queryName(query_name)
              .option("checkpointLocation", location))
    for k, v in options.items():
        writer = writer.option(k, v)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
