"""Sinks: ordered text, a small result in one file, partitioned tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators.ordering import range_sorted, with_position


def write_ordered_text(df: DataFrame, keys: list[str | Column], value_col: str, path: str,
                       n_files: int | None = None, mode: str = "errorifexists") -> None:
    """``n_files`` part files whose concatenation in name order is sorted by ``keys``."""
    (range_sorted(df, keys, n_files).select(F.col(value_col).alias("value"))
     .write.mode(mode).text(path))


def write_single_text(df: DataFrame, value_col: str, path: str, mode: str = "errorifexists") -> None:
    """A small, already bounded result (e.g. a top-k) as one text file, in its order."""
    df.select(F.col(value_col).cast("string").alias("value")).coalesce(1).write.mode(mode).text(path)


def write_pair_costs(gains: DataFrame, path: str, n_files: int = 1024, position: str | None = None,
                     mode: str = "errorifexists") -> DataFrame:
    """Pair gains and costs: each migration as exactly ``n_files`` files (fewer if it has fewer pairs), in
    ``from_state=a/to_state=b/file=i``, equal in rows to one, ordered by ``(from_id, to_id)`` within and over them.

    ``position`` names a column with each pair's place within its migration from 0, where the caller knows it (a full
    product's is arithmetic); without it places come from a distributed sort. Returns the manifest, also stored as
    ``_manifest`` beside the directories: ``from_state, to_state, file, n, first, last`` with the bounds as
    ``struct<from_id, to_id>``.
    """
    keys = ["from_state", "to_state", "from_id", "to_id"]
    if position:
        placed = gains.select(*keys, "gain", "cost", F.col(position).alias("_at"))
    else:
        ranked = with_position(gains.select(*keys, "gain", "cost"), keys, pos_col="_p")
        first = ranked.groupBy("from_state", "to_state").agg(F.min("_p").alias("_first"))
        placed = ranked.join(first, ["from_state", "to_state"]).withColumn("_at", F.col("_p") - F.col("_first"))
    # One row per migration; the files of all of them, with a task for each.
    sizes = {(r["from_state"], r["to_state"]): r["n"]
             for r in gains.groupBy("from_state", "to_state").agg(F.count(F.lit(1)).alias("n")).collect()}
    size = F.lit(1).cast("bigint")
    for (a, b), n in sizes.items():
        size = F.when((F.col("from_state") == a) & (F.col("to_state") == b), F.lit(n).cast("bigint")).otherwise(size)
    file = F.floor(F.col("_at") * F.least(F.lit(n_files).cast("bigint"), size) / size).cast("int")
    dealt = (placed.withColumn("file", file).drop("_at").repartition(max(1, len(sizes) * n_files), "from_state", "to_state", "file")
             .sortWithinPartitions("from_state", "to_state", "file", "from_id", "to_id"))
    dealt.write.mode(mode).partitionBy("from_state", "to_state", "file").parquet(path)
    spark = gains.sparkSession
    key = F.struct("from_id", "to_id")
    manifest = read_pair_costs(spark, path).groupBy("from_state", "to_state", "file").agg(
        F.count(F.lit(1)).alias("n"), F.min(key).alias("first"), F.max(key).alias("last"))
    manifest.coalesce(1).write.mode(mode).parquet(f"{path}/_manifest")
    return spark.read.schema(manifest.schema).parquet(f"{path}/_manifest")


def read_pair_costs(spark: SparkSession, path: str) -> DataFrame:
    """What ``write_pair_costs`` has written, with the file number of each pair."""
    return spark.read.schema("from_id BIGINT, to_id BIGINT, gain DOUBLE, cost DOUBLE, from_state INT, to_state INT, file INT").parquet(path)


def write_state_values(values: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Values per state: one directory per state, files and rows ordered by ``pack_id``; a state
    with many packs is spread over as many files as its range of ids needs."""
    (range_sorted(values.select("state", "pack_id", "v"), ["state", "pack_id"])
     .write.mode(mode).partitionBy("state").parquet(path))
