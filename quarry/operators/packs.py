"""Packs: ways of cutting a line of N sized items into k contiguous runs.

A pack of state k is stored as its run lengths and, once the item sizes are
attached, as the exclusive end position of each run (``ends``) and the total
size of the items before that end (``cum``). Overlaps between two packs only
need these two arrays, so no per-item table is ever joined pair by pair.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.operators.common import require
from quarry.operators.ordering import with_position
from quarry.session import scratch_copy

ITEMS_PER_BLOCK = 100_000  # items whose running sum one task takes


@dataclass
class ItemLine:
    """``prefix`` has a row per cut position: ``pos`` 0..N and ``cum``, the size of the items before it."""

    prefix: DataFrame
    n_items: int
    total: float


def item_line(sizes: DataFrame) -> ItemLine:
    """Prefix sums of ``(idx, size)`` rows with idx 0..N-1, by partition totals of their range-sorted order."""
    sizes = sizes.select(F.col("idx").cast("bigint").alias("idx"), F.col("size").cast("double").alias("size"))
    ranked = with_position(sizes, ["idx"], pos_col="_p")
    ranked = require(ranked, F.col("idx") == F.col("_p"), "item positions must be 0..N-1 without gaps")
    ranked = require(ranked, F.col("size") >= 0, "item sizes must be non-negative")
    ranked = scratch_copy(ranked.withColumn("_block", F.floor(F.col("_p") / F.lit(ITEMS_PER_BLOCK))), "items")
    blocks = ranked.groupBy("_block").agg(F.sum("size").alias("_sum"))
    # One row per block of items.
    before = blocks.select("_block", (F.sum("_sum").over(Window.orderBy("_block")) - F.col("_sum")).alias("_before"))
    within = F.sum("size").over(Window.partitionBy("_block").orderBy("idx"))
    ends = (ranked.select("idx", "_block", within.alias("_within")).join(before, "_block")
            .select((F.col("idx") + 1).cast("int").alias("pos"), (F.col("_before") + F.col("_within")).alias("cum")))
    zero = sizes.sparkSession.createDataFrame([(0, 0.0)], "pos INT, cum DOUBLE")
    prefix = scratch_copy(zero.unionByName(ends), "prefix")
    head = prefix.agg(F.max("pos").alias("n"), F.max("cum").alias("total")).first()
    return ItemLine(prefix, int(head["n"]), float(head["total"]))


def _binomial(e: Column, i: int) -> Column:
    """C(e, i) for a small constant i as an exact integer expression."""
    prod = F.lit(1).cast("bigint")
    for x in range(i):
        prod = prod * (e - x)
    return prod / F.lit(math.factorial(i))


def generate_packs(line: ItemLine, states: list[int], n_partitions: int | None = None) -> DataFrame:
    """Every composition of N into k positive runs, for each k in ``states``.

    ``pack_id`` is the colexicographic rank of the cut set, so ids are dense
    (0..C(N-1,k-1)-1) and computed row by row, without a global numbering.
    Cut points are produced level by level with ``explode(sequence)``; rows are
    spread over tasks before the last level, which produces most of them.
    """
    spark = line.prefix.sparkSession
    parts = n_partitions or spark.sparkContext.defaultParallelism
    frames = []
    for k in states:
        rows = spark.range(1).select(F.lit(k).alias("state"), F.lit(line.n_items).alias("n_items"),
                                     F.array().cast("array<int>").alias("cuts"), F.lit(0).alias("_last"))
        for level in range(1, k):
            lo, hi = F.col("_last") + 1, F.col("n_items") - (k - level)
            if level == k - 1 and k > 2:
                rows = rows.repartition(parts)
            rows = (rows.select("state", "n_items", "cuts",
                                F.explode(F.when(lo <= hi, F.sequence(lo, hi))
                                          .otherwise(F.array().cast("array<int>"))).alias("_c"))
                    .select("state", "n_items", F.concat("cuts", F.array("_c")).alias("cuts"),
                            F.col("_c").alias("_last")))
        rank = F.lit(0).cast("bigint")
        for i in range(1, k):
            rank = rank + _binomial(F.col("cuts")[i - 1] - 1, i).cast("bigint")
        ends = F.concat("cuts", F.array("n_items"))
        runs = F.transform(ends, lambda e, i: e - F.when(i == 0, F.lit(0)).otherwise(ends[i - 1]))
        frames.append(rows.where(F.col("n_items") >= k)
                      .select(F.col("state").cast("int"), rank.alias("pack_id"), runs.alias("runs")))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def attach_sizes(packs: DataFrame, line: ItemLine) -> DataFrame:
    """``(state, pack_id, runs, ends, cum)``: end positions and cumulative size at each end.

    Joins the prefix sums by position; runs summing past N are an error, runs summing
    below N leave the tail unused, and a repeated (state, pack_id) is an error.
    """
    prefix = line.prefix.select(F.col("pos").alias("_pos"), F.col("cum").alias("_cum"))
    ends = F.transform("runs", lambda r, i: F.aggregate(F.slice("runs", 1, i + 1), F.lit(0), lambda a, b: a + b))
    slots = packs.select("state", "pack_id", "runs", F.posexplode(ends).alias("_slot", "_end"))
    joined = slots.join(prefix, slots["_end"] == prefix["_pos"], "left")
    joined = require(joined, F.col("_cum").isNotNull(), "pack runs sum past the number of items")
    grouped = joined.groupBy("state", "pack_id").agg(
        F.first("runs").alias("runs"), F.count(F.lit(1)).alias("_n"),
        F.array_sort(F.collect_list(F.struct("_slot", "_end", "_cum"))).alias("_e"))
    grouped = require(grouped, F.col("_n") == F.size("runs"), "duplicate pack (state, pack_id)")
    return grouped.select("state", "pack_id", "runs",
                          F.transform("_e", lambda e: e["_end"]).alias("ends"),
                          F.transform("_e", lambda e: e["_cum"]).alias("cum"))


def pack_ranges(packs: DataFrame) -> DataFrame:
    """``(state, pack_id, slot, start, end, size)`` with inclusive 0-based item ranges."""
    z = F.arrays_zip("ends", "cum")
    exploded = packs.select("state", "pack_id", "ends", "cum", F.posexplode(z).alias("slot", "_z"))
    prev_end = F.when(F.col("slot") == 0, F.lit(0)).otherwise(F.col("ends")[F.col("slot") - 1])
    prev_cum = F.when(F.col("slot") == 0, F.lit(0.0)).otherwise(F.col("cum")[F.col("slot") - 1])
    return exploded.select("state", "pack_id", F.col("slot").cast("int"),
                           prev_end.alias("start"), (F.col("_z.ends") - 1).alias("end"),
                           (F.col("_z.cum") - prev_cum).alias("size"))
