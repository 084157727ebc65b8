"""Small helpers shared by operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


_ROW = "_row_here"


def where_here(df: DataFrame, condition: Column) -> DataFrame:
    """``df.where(condition)``, evaluated where it stands.

    The filter reads a row number that the projection below it makes. Such a projection is not
    deterministic, so the filter is not moved below it, which would write the expressions of the columns it reads
    out once more, and below no earlier filter or join: exactly the rows that reach this point are tested.
    """
    numbered = df.withColumn(_ROW, F.monotonically_increasing_id())
    return numbered.where(F.coalesce(condition, F.lit(False)) | (F.col(_ROW) < 0)).drop(_ROW)


def require(df: DataFrame, condition: Column, message: str) -> DataFrame:
    """Keep every row, raising ``message`` on the first row where ``condition`` is not true.

    Written as a predicate: a check in a column nobody reads is pruned away. It is
    evaluated where it stands (see ``where_here``), on exactly the rows that reach this point.
    """
    numbered = df.withColumn(_ROW, F.monotonically_increasing_id())
    ok = F.coalesce(condition, F.lit(False)) | (F.col(_ROW) < 0)
    return numbered.where(F.assert_true(ok, F.lit(message)).isNull()).drop(_ROW)
