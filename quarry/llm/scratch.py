"""Intermediate tables in the shared folder the cluster names in ``spark.checkpoint.dir``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import drop_scratch, scratch_table_path


#: Documents (rows of a few hundred bytes) and bytes of text that a file of an intermediate table is for.
FILE_ROWS = 1 << 13
FILE_BYTES = 16 << 20


def files_for(spark: SparkSession, rows: int = 0, size: int = 0) -> int:
    """How many files a table on so many documents, with so many bytes of text, is worth; one a core at least."""
    return max(spark.sparkContext.defaultParallelism, -(-rows // FILE_ROWS), -(-size // FILE_BYTES))


def text_files(docs: DataFrame, text: str = "text") -> int:
    """``files_for`` a table that holds the texts of ``docs``."""
    rows, size = docs.agg(F.count("*"), F.sum(F.octet_length(text))).first()
    return files_for(docs.sparkSession, rows, size or 0)


def save(df: DataFrame, name: str, files: int | None = None) -> DataFrame:
    """Write ``df`` as a fresh Parquet table on shared storage and read it back.

    This cuts the lineage without ``localCheckpoint``: a lost executor costs a
    re-read, never a recomputation, and the reread rows are the same every time
    (needed wherever a row's partition or order was recorded in a column).

    ``files`` bounds the number of files: a small table out of a shuffle with many partitions would else be as many
    tiny files, and making one costs more than its rows (on a mounted folder a process each, for its permissions).
    """
    if files:
        df = df.coalesce(files)
    path = scratch_table_path(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._scratch_path = path
    return out


def drop(*tables: DataFrame) -> None:
    """Remove saved tables that nothing will read again."""
    for table in tables:
        drop_scratch(table.sparkSession, table._scratch_path)


def small_batches(spark: SparkSession, rows: int = 512) -> None:
    """Bound the Arrow batches handed to Python: long texts make 10,000-row batches huge."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key, "10000")) != rows:
        spark.conf.set(key, str(rows))
