"""Global order: range partitioning plus a dense row position.

``with_position`` numbers the rows 0..n-1 in key order without ever moving
the data to one task: rows are range-partitioned (sampled bounds, so a hot key
range is split), sorted inside each partition, and given a partition-local
index; per-partition counts (one row per partition) become offsets that are
broadcast back. The range-partitioned frame is written to the shared
checkpoint directory first, so the numbering survives a lost executor and the
two passes see the same partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.session import scratch_copy

_LOCAL_BITS = 33  # monotonically_increasing_id keeps the record number in the low 33 bits


def _partitions(df: DataFrame, n_partitions: int | None) -> int:
    if n_partitions:
        return n_partitions
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def range_sorted(df: DataFrame, keys: list[str | Column], n_partitions: int | None = None) -> DataFrame:
    """Partition ``i`` holds only keys <= those of partition ``i+1``, each sorted.

    Rows with equal keys are told apart by where they come from, so that range bounds
    can split a key that very many rows share.
    """
    n = _partitions(df, n_partitions)
    tied = df.withColumn("_tie", F.monotonically_increasing_id())
    return tied.repartitionByRange(n, *keys, "_tie").sortWithinPartitions(*keys).drop("_tie")


def with_position(df: DataFrame, keys: list[str | Column], pos_col: str = "pos",
                  n_partitions: int | None = None) -> DataFrame:
    ranged = range_sorted(df, keys, n_partitions).withColumn("_rid", F.monotonically_increasing_id())
    ranged = scratch_copy(ranged, "ranged")
    part = F.shiftright(F.col("_rid"), _LOCAL_BITS)
    local = F.col("_rid").bitwiseAND((1 << _LOCAL_BITS) - 1)
    counts = ranged.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    # One row per partition: a window over it without partitionBy is bounded by
    # the partition count, not by the data.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    out = (ranged.join(F.broadcast(offsets), part == offsets["_part"])
           .withColumn(pos_col, F.col("_offset") + local))
    return out.drop("_rid", "_part", "_offset")


def running_sums(df: DataFrame, group: str, order: str, values: list[str], block_rows: int = 100_000) -> DataFrame:
    """Replace each of ``values`` by its inclusive running sum within ``group`` in the order of ``order``.

    Rows are numbered by distributed position and summed in blocks of positions, then one row per block: no
    task holds a group. ``(group, order)`` must be unique.
    """
    placed = with_position(df, [group, order], pos_col="_p").withColumn("_block", F.floor(F.col("_p") / F.lit(block_rows)))
    placed = scratch_copy(placed, "placed")
    inside = Window.partitionBy(group, "_block").orderBy(order)
    before = Window.partitionBy(group).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    sums = placed.groupBy(group, "_block").agg(*[F.sum(v).alias(v) for v in values]).select(
        group, "_block", *[F.coalesce(F.sum(v).over(before), F.lit(0)).alias(f"_{v}") for v in values])
    within = placed.select("*", *[F.sum(v).over(inside).alias(f"_in_{v}") for v in values])
    return within.join(sums, [group, "_block"]).select(
        *[(F.col(f"_{c}") + F.col(f"_in_{c}")).alias(c) if c in values else F.col(c) for c in df.columns])
