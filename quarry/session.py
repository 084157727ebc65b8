"""Session helpers: building a session, and cutting lineage on shared storage."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, app: str = "quarry",
                  shuffle_partitions: int | None = None) -> SparkSession:
    """A session with AQE on and the UI off; reuses a running session."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    builder = (builder
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.adaptive.enabled", "true")
               .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
               .config("spark.sql.adaptive.skewJoin.enabled", "true"))
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared directory named by the cluster for checkpoints.

    Read from the SparkContext, then from ``spark.checkpoint.dir``. Only a
    local-mode session (tests) without either gets a private temporary folder;
    a cluster session without one is an error, because a machine-local folder
    would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set; point it at shared storage")
        configured = tempfile.mkdtemp(prefix="quarry-cp-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_copy(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared checkpoint directory and read back: lineage is cut,
    and a lost executor costs a re-read."""
    path = scratch_table_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Remove a scratch table that nothing reads any more (through Hadoop's file system, so on any store)."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
    for scope in _open:
        scope.paths = [p for p in scope.paths if p != path]


class ScratchScope:
    """Scratch tables made while the scope is the innermost one, and the results that may still read them."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: list[str] = []
        self.results: list[DataFrame] = []

    def keep(self, result: DataFrame) -> DataFrame:
        """``result`` outlives the scope: the tables that it reads itself stay."""
        self.results.append(result)
        return result

    def close(self) -> None:
        read = {part for result in self.results for file in result.inputFiles() for part in file.split("/")}
        for path in list(self.paths):
            if path.rsplit("/", 1)[-1] not in read:
                drop_scratch(self.spark, path)


_open: list[ScratchScope] = []


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[ScratchScope]:
    """Remove the scratch tables made inside once the block ends, but for those that kept results read.

    Their names are unique, so a table is told by its name in a result's input files. Cached
    frames are the maker's to release.
    """
    scope = ScratchScope(spark)
    _open.append(scope)
    try:
        yield scope
    finally:
        _open.remove(scope)
        scope.close()


def scratch_table_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the checkpoint directory for an intermediate table, removed with the innermost open scope."""
    path = os.path.join(checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex}")
    if _open:
        _open[-1].paths.append(path)
    return path
