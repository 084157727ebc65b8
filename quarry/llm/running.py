"""Running totals over a global order, without a window that gathers all rows in one task."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.scratch import save


def running_total(df: DataFrame, order: list[str], value: str, into: str, name: str,
                  files: int | None = None) -> DataFrame:
    """``df`` plus ``into``: the sum of ``value`` over all rows up to and with this one in ``order``.

    The rows are range-sorted; each range keeps its own running sum and notes its
    number; the table is then written once (in at most ``files`` files) and every row
    adds the sum of the ranges before its own. Only one row per range (at most the number of shuffle
    partitions, so safely broadcast) meets in one task. ``order`` should name
    enough columns to be unique: equal rows are taken in any order.
    ``value`` is a non-null long.
    """
    # The number is the range's own, not the task's, which may write several ranges.
    ranged = df.repartitionByRange(*[F.col(c) for c in order]).sortWithinPartitions(*order).withColumn(
        "_range", F.spark_partition_id())
    schema = T.StructType(ranged.schema.fields + [T.StructField("_local", T.LongType())])

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0
        for batch in batches:
            sums = np.cumsum(batch.column(value).to_numpy(zero_copy_only=False)) + total
            total = int(sums[-1]) if len(sums) else total
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sums, pa.int64())],
                                             names=[f.name for f in schema.fields])

    saved = save(ranged.mapInArrow(local, schema), name, files)
    ranges = saved.groupBy("_range").agg(F.sum(value).alias("_sum"))
    before = ranges.select("_range", (F.sum("_sum").over(Window.orderBy("_range")) - F.col("_sum")).alias("_before"))
    return (saved.join(F.broadcast(before), "_range")
            .withColumn(into, F.col("_before") + F.col("_local")).drop("_range", "_local", "_before"))
