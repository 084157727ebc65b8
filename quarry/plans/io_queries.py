"""Readers and sinks: tables written in the text and Parquet formats of the jobs, and read back.

Files go to the shared checkpoint directory; every query returns what its reader found.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.plans import migration_queries as MQ
from quarry.plans import text_queries as TQ
from quarry.plans import time_queries as TM
from quarry.session import scratch_table_path
from quarry.sinks import writers
from quarry.sources import migration as M
from quarry.sources.text import read_lines, read_word_list


def _runs_text() -> F.Column:
    return F.array_join(F.col("runs").cast("array<string>"), ",")


N_FILES = 8  # files per migration of the pair-cost sink
PACKS_PER_FILE = 500  # lines per file of packs without ids


def _packs_folder(spark: SparkSession, packs: DataFrame, states: list[int], line: F.Column, per_file: int | None = None) -> str:
    """Pack files per state; with ``per_file``, files of so many packs whose path order is the order of the ids."""
    root = scratch_table_path(spark, "packs")
    for k in states:
        own = packs.where(F.col("state") == k)
        if per_file is None:
            own.select(line.alias("value")).write.text(f"{root}/state_{k}")
            continue
        part = F.format_string("%09d", F.floor(F.col("pack_id") / per_file))
        (own.select("pack_id", line.alias("value"), part.alias("part")).repartition("part").sortWithinPartitions("part", "pack_id")
         .select("value", "part").write.partitionBy("part").text(f"{root}/state_{k}"))
    return root


def lines_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ordered text sink and line reader, in at least 16 splits."""
    path = scratch_table_path(spark, "lines")
    writers.write_ordered_text(TM.csv_lines(spark, sf_dir), ["value"], "value", path)
    return read_lines(spark, path, min_partitions=16)


def word_list_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of ``documents`` as a word list."""
    path = scratch_table_path(spark, "words")
    TQ.word_tokens(spark, sf_dir).select(F.col("word").alias("value")).write.text(path)
    return read_word_list(spark, path)


def single_text_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The most frequent words as one text file."""
    path = scratch_table_path(spark, "top")
    writers.write_single_text(TQ.word_topk(spark, sf_dir), "word", path)
    return read_lines(spark, path)


def sizes_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_table_path(spark, "sizes")
    sizes = MQ.sizes(spark, sf_dir).withColumn("line", F.concat(F.lit(" "), F.col("size").cast("string"), F.lit("\n")))
    writers.write_ordered_text(sizes, ["idx"], "line", path)
    return M.read_sizes(spark, path)


def transitions_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_table_path(spark, "transitions")
    line = F.concat_ws(":", *[F.col(c).cast("string") for c in ("from_state", "to_state", "weight")])
    MQ.transitions(spark, sf_dir).select(line.alias("value")).write.text(path)
    return M.read_transitions(spark, path)


def packs_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    inp = MQ.Inputs(spark, sf_dir)
    line = F.concat(F.col("pack_id").cast("string"), F.lit(":"), _runs_text())
    return M.read_packs(spark, _packs_folder(spark, inp.packs, inp.states, line), inp.states).select(
        "state", "pack_id", _runs_text().alias("runs"))


def packs_by_offset_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packs without ids, several files per state: which file each is in, and the byte it starts at."""
    inp = MQ.Inputs(spark, sf_dir)
    root = _packs_folder(spark, inp.packs, inp.states, _runs_text(), PACKS_PER_FILE)
    return M.read_packs_by_offset(spark, root, inp.states).select(
        "state", "pack_id", "file_number", "offset", _runs_text().alias("runs"))


def pair_costs_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ordered pair costs per migration, each file read back in its stored order and held against the manifest's bounds."""
    path = scratch_table_path(spark, "pair-costs")
    inp = MQ.Inputs(spark, sf_dir)
    place = F.col("from_idx") * F.lit(0)
    for a, b in inp.migrations:
        here = (F.col("from_state") == a) & (F.col("to_state") == b)
        place = F.when(here, F.col("from_idx") * inp.counts[b] + F.col("to_idx")).otherwise(place)
    manifest = writers.write_pair_costs(inp.gains().withColumn("place", place), path, N_FILES, position="place")
    files = ["from_state", "to_state", "file"]
    stored = Window.partitionBy(*files).orderBy("row")
    back = writers.read_pair_costs(spark, path).select("*", F.col("_metadata.row_index").alias("row"), F.struct("from_id", "to_id").alias("key"))
    seen = back.withColumn("rises", F.coalesce(F.lag("key").over(stored) < F.col("key"), F.lit(True))).groupBy(*files).agg(
        F.count(F.lit(1)).alias("rows"), F.min("key").alias("low"), F.max("key").alias("high"), F.min("rises").alias("rises"),
        F.round(F.sum("cost"), MQ.ROUND).alias("total"), F.max("gain").alias("best"))
    agrees = F.col("rises") & (F.col("low") == F.col("first")) & (F.col("high") == F.col("last")) & (F.col("rows") == F.col("n"))
    return manifest.join(seen, files).select(
        *files, "n", F.col("first.from_id").alias("first_from"), F.col("first.to_id").alias("first_to"),
        F.col("last.from_id").alias("last_from"), F.col("last.to_id").alias("last_to"), agrees.alias("ordered"), "total", "best")


def state_values_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_table_path(spark, "state-values")
    writers.write_state_values(MQ.bellman_step(spark, sf_dir), path)
    return spark.read.schema("pack_id BIGINT, v DOUBLE, state INT").parquet(path).select("state", "pack_id", "v")


QUERIES = {
    "lines_read": lines_read,
    "word_list_read": word_list_read,
    "single_text_read": single_text_read,
    "sizes_read": sizes_read,
    "transitions_read": transitions_read,
    "packs_read": packs_read,
    "packs_by_offset_read": packs_by_offset_read,
    "pair_costs_sink": pair_costs_sink,
    "state_values_sink": state_values_sink,
}


def oracle() -> dict[str, str]:
    top, words = TQ.oracle()["word_topk"], TQ.oracle()["word_tokens"]
    packs = MQ.packs_with_runs_sql()
    return {
        "lines_read": f"{TM.csv_lines_sql()} SELECT value FROM lines",
        "word_list_read": f"SELECT DISTINCT word FROM ({words})",
        "single_text_read": f"SELECT word AS value FROM ({top})",
        "sizes_read": "SELECT CAST(c_nationkey AS INTEGER) AS idx, count(*)::DOUBLE AS size FROM customer GROUP BY 1",
        "transitions_read": MQ.transitions_sql(),
        "packs_read": f"{packs} SELECT state, pack_id, runs FROM with_runs",
        "packs_by_offset_read": f"""{packs} SELECT state, file_number * {M.FILE_STRIDE} + "offset" AS pack_id, file_number, "offset", runs FROM (
  SELECT state, runs, pack_id // {PACKS_PER_FILE} AS file_number, CAST(sum(length(runs) + 1) OVER (
    PARTITION BY state, pack_id // {PACKS_PER_FILE} ORDER BY pack_id) - length(runs) - 1 AS BIGINT) AS "offset" FROM with_runs)""",
        "pair_costs_sink": MQ.pair_cost_files_sql(N_FILES),
        "state_values_sink": MQ.oracle()["bellman_step"],
    }
