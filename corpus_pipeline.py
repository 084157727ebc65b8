"""A corpus pipeline over ``documents``: each stage rereads what the one before it wrote."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import fairmix, fertility, oddsketch, packing, repeats
from quarry.llm.scratch import save, text_files


def _columns(docs: DataFrame) -> list[Column]:
    return [F.col(f"`{c}`") for c in docs.columns]


def _unused(docs: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``docs`` bears it."""
    while name.lower() in {c.lower() for c in docs.columns}:
        name += "_"
    return name


def _renamed(docs: DataFrame, read: list[str]) -> DataFrame:
    """``docs`` with every column but those an operator reads under a name that no operator uses."""
    return docs.select(*[F.col(f"`{c}`").alias(c if c in read else f"carried{i}") for i, c in enumerate(docs.columns)])


def _back(docs: DataFrame, out: DataFrame, read: list[str]) -> DataFrame:
    """The columns of ``docs`` from ``out``, under their own names again."""
    return out.select(*[F.col(c if c in read else f"carried{i}").alias(c) for i, c in enumerate(docs.columns)])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the quality rules reject (operator 1)."""
    return fertility.assess(docs, only_kept=True)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near duplicates, once: the smallest id (operator 8).

    A document is its id and its text, so an id that stands for two texts is two documents.
    Documents without an id belong to no group and stay.
    """
    mark = _unused(docs, "_text")
    marked = docs.withColumn(mark, F.xxhash64("text"))
    kept = oddsketch.verdicts(docs, name="stage-near").where("chosen and doc_id is not null").select(
        "doc_id", F.col("text_hash").alias(mark))
    one = marked.join(kept, ["doc_id", mark], "left_semi").dropDuplicates(["doc_id", mark])
    return one.select(*_columns(docs)).unionByName(docs.where("doc_id is null")).coalesce(text_files(docs))


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take out the passages that repeat in or across documents (operator 5); ``n_chars`` follows the text."""
    files = text_files(docs)
    left = _back(docs, repeats.remove_repeats(_renamed(docs, ["doc_id", "text"]), name="stage-repeats"), ["doc_id", "text"]).coalesce(files)
    return left.withColumn("n_chars", F.length("text").cast("long")).select(*_columns(docs)) if "n_chars" in docs.columns else left


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights: a document is left out, or repeated, as the mix takes it (operator 6)."""
    read = ["doc_id", "source", "text"]
    return _back(docs, fairmix.take(_renamed(docs, read), name="stage-mix"), read).coalesce(text_files(docs))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack what is left into sequences (operator 7)."""
    return packing.pack(docs, name="stage-pack")


STAGES = [
    ("quality_rules", quality),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("mixing", mixing),
    ("best_fit_packing", best_fit_packing),
]

#: Tokenizer verdicts have no SQL form; the stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; each result is written to shared scratch and read again."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = save(docs, name)
    return docs
