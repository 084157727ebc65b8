"""Readers for the migration inputs: item sizes, transition weights, packs.

* sizes: one number per line, spaces around it allowed, blank lines skipped
  before positions are given -> ``(idx INT, size DOUBLE)``.
* transitions: ``from:to:weight`` lines -> ``(from_state, to_state, weight)``;
  a duplicate ``(from, to)``, a state paired with itself, a negative weight or a
  malformed line is an error.
* packs: ``<root>/state_<k>`` with lines ``pack_id:n1,...,nk`` (blank lines
  skipped) -> ``(state INT, pack_id BIGINT, runs ARRAY<INT>)``; the arity must be
  ``k``. The id-less variant takes the byte offset of the line as ``pack_id``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.functions.text import jvm_trim
from quarry.operators.common import require
from quarry.operators.ordering import with_position
from quarry.sources.text import ordered_lines, with_offsets

FILE_STRIDE = 1 << 40  # ids by offset: room for one file


def _integer(text: Column) -> Column:
    """A whole number without spaces, as a bigint; anything else is NULL."""
    return F.when(text.rlike(r"^[+-]?[0-9]+\z"), text.try_cast("bigint"))


def read_sizes(spark: SparkSession, path: str) -> DataFrame:
    lines = ordered_lines(spark, path).withColumn("raw", jvm_trim(F.col("value"))).where(F.col("raw") != "")
    placed = with_position(lines, ["file", "block", "line"], pos_col="idx")
    return placed.select(F.col("idx").cast("int"), F.col("raw").cast("double").alias("size"))


def sizes_from_table(df: DataFrame, idx_col: str, size_col: str) -> DataFrame:
    return df.select(F.col(idx_col).cast("int").alias("idx"), F.col(size_col).cast("double").alias("size"))


def parse_transitions(lines: DataFrame, value_col: str = "value") -> DataFrame:
    parts = F.split(F.col(value_col), ":")
    df = lines.select(parts.alias("_p"))
    df = require(df, F.size("_p") >= 3, "transition line must be from:to:weight")
    df = require(df, _integer(F.col("_p")[0]).isNotNull() & _integer(F.col("_p")[1]).isNotNull(),
                 "states must be whole numbers without spaces")
    return validate_transitions(df.select(F.col("_p")[0].cast("int").alias("from_state"),
                                          F.col("_p")[1].cast("int").alias("to_state"),
                                          F.col("_p")[2].cast("double").alias("weight")))


def read_transitions(spark: SparkSession, path: str) -> DataFrame:
    return parse_transitions(spark.read.text(path))


def validate_transitions(df: DataFrame) -> DataFrame:
    """Raise on self-pairs, negative weights and duplicate ``(from, to)`` keys."""
    df = require(df, F.col("from_state") != F.col("to_state"), "a state cannot migrate to itself")
    df = require(df, F.col("weight") >= 0, "transition weight must be non-negative")
    dup = F.count(F.lit(1)).over(Window.partitionBy("from_state", "to_state"))
    return require(df.withColumn("_dup", dup), F.col("_dup") == 1,
                   "duplicate transition (from_state, to_state)").drop("_dup")


def _parse_runs(text: Column) -> Column:
    return F.transform(F.split(text, ","), lambda t: _integer(t).cast("int"))


def read_packs(spark: SparkSession, root: str, states: list[int]) -> DataFrame:
    frames = []
    for k in states:
        lines = spark.read.text(f"{root.rstrip('/')}/state_{k}").where(F.col("value") != "")
        parts = F.split(F.col("value"), ":")
        frames.append(lines.select(F.lit(k).alias("state"), _integer(parts[0]).alias("pack_id"),
                                   _parse_runs(parts[1]).alias("runs")))
    packs = frames[0]
    for f in frames[1:]:
        packs = packs.unionByName(f)
    return validate_packs(packs)


def read_packs_by_offset(spark: SparkSession, root: str, states: list[int]) -> DataFrame:
    """Id-less pack files: ``(state, pack_id, runs, file_number, offset)``, the byte offset of a line being its id.

    A state folder may hold several files: file number n (in path order, from 0) adds
    n * 2**40, so ids stay unique and a single file's are its offsets. A line that starts at
    2**40 or later is an error.
    """
    frames = []
    for k in states:
        lines = with_offsets(ordered_lines(spark, f"{root.rstrip('/')}/state_{k}"))
        files = with_position(lines.select("file").distinct(), ["file"], pos_col="file_number")
        placed = require(lines.join(files, "file"), F.col("offset") < FILE_STRIDE, "a pack file is longer than its stride of ids")
        frames.append(placed.where(F.col("value") != "").select(
            F.lit(k).alias("state"), (F.col("file_number") * FILE_STRIDE + F.col("offset")).alias("pack_id"),
            _parse_runs(F.col("value")).alias("runs"), "file_number", "offset"))
    packs = frames[0]
    for f in frames[1:]:
        packs = packs.unionByName(f)
    return validate_packs(packs)


def validate_packs(packs: DataFrame) -> DataFrame:
    """Arity must equal the state, every run hold at least one item, every (state, pack_id) occur once."""
    packs = require(packs, F.col("pack_id").isNotNull(), "pack ids must be whole numbers without spaces")
    packs = require(packs, F.size("runs") == F.col("state"), "pack arity must equal its state")
    packs = require(packs, F.forall("runs", lambda r: r.isNotNull() & (r >= 1)), "every run of a pack needs length >= 1")
    copies = F.count(F.lit(1)).over(Window.partitionBy("state", "pack_id"))
    return require(packs.withColumn("_copies", copies), F.col("_copies") == 1,
                   "duplicate pack (state, pack_id)").drop("_copies")
