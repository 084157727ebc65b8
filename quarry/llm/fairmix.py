"""Operator 6 - mixing sources to target weights by weighted fair queueing.

Every document gets a place in its source's shuffled order. Its virtual finish time
is the source's words up to and with it, divided by the source's target. Sorting
all documents by that time interleaves the sources in proportion to their targets;
the mix is the head of that order up to the total budget. A source whose target is
above its size goes round again (its second copies finish one source size later).

Shuffled order is by a digest of the id, so it is the same on every run. Running
sums are taken over range-sorted tables (``running``), so a source with a third of
all documents is spread like any other. Only scalars reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.running import running_total
from quarry.llm.scratch import files_for, save, small_batches
from quarry.llm.textwords import Words, pieces


@dataclass(frozen=True)
class Rule:
    """``weights`` go round the sources in code point order (null last); ``share`` of all words is
    the budget; no document is taken more than ``most`` times; ``seed`` picks the shuffle."""

    weights: tuple[int, ...] = (5, 2, 1)
    share: float = 1.0
    most: int = 3
    seed: str = "mix"


def sized(docs: DataFrame, id_column: str, source: str, text: str) -> DataFrame:
    """``id, source, size`` (words) and ``_ident`` (a hash of id, source and text) of every row."""
    small_batches(docs.sparkSession)
    schema = T.StructType([T.StructField("id", docs.schema[id_column].dataType),
                           T.StructField("source", T.StringType()), T.StructField("_ident", T.LongType()),
                           T.StructField("size", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("source"), batch.column("_ident"),
                 pa.array(Words(batch.column("text")).counts, pa.int64())], names=[f.name for f in schema.fields])

    rows = docs.select(F.col(id_column).alias("id"), F.col(source).cast("string").alias("source"),
                       F.col(text).alias("text"), F.xxhash64(id_column, source, text).alias("_ident"))
    return rows.mapInArrow(run, schema)


def _targets(sources: DataFrame, rule: Rule) -> DataFrame:
    """``target``: budget shared by weight, none above ``most`` sizes, the excess shared among the rest."""
    cap = F.col("source_size") * rule.most
    level = 0.0
    total = None
    while True:
        full = cap / F.col("weight") < F.lit(level)
        row = sources.agg(F.sum("source_size"), F.sum(F.when(full, cap).otherwise(0)),
                          F.sum(F.when(full, 0).otherwise(F.col("weight")))).first()
        if total is None:
            total = min(rule.share, float(rule.most)) * float(row[0] or 0)
        if not row[2]:
            level = float("inf")
            break
        after = (total - float(row[1])) / float(row[2])
        if after <= level:
            break
        level = after
    share = F.lit(level) * F.col("weight") if level != float("inf") else cap.cast("double")
    return sources.withColumn("target", F.least(share, cap.cast("double")))


def sources_of(sizes: DataFrame, rule: Rule, name: str) -> DataFrame:
    """``source, source_size, position, weight, _earlier, target`` of every source."""
    sums = sizes.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn(
        "_null", F.col("source").isNull()).withColumn("_one", F.lit(1).cast("long"))
    placed = running_total(sums, ["_null", "source"], "_one", "position", name)
    turn = F.pmod(F.col("position") - 1, F.lit(len(rule.weights))).cast("int")
    weight = F.element_at(F.array(*[F.lit(w) for w in rule.weights]), turn + 1)
    placed = running_total(placed.withColumn("weight", weight), ["position"], "source_size", "_upto", name)
    placed = save(placed.withColumn("_earlier", F.col("_upto") - F.col("source_size")).drop("_null", "_one", "_upto"), name)
    return save(_targets(placed, rule), name)


def _counted(order: DataFrame, column: str) -> DataFrame:
    """How often each unit is taken; a unit is its id, source and ``_ident``, as texts may share the hash."""
    return order.groupBy(F.col("_ident").alias("_unit"), F.col("id").alias("_unit_id"), F.col("source").alias("_unit_source")).agg(
        F.count("*").alias(column))


def _same_unit(id_column: str, source: str) -> Column:
    return ((F.col("_ident") == F.col("_unit")) & F.col(id_column).eqNullSafe(F.col("_unit_id"))
            & F.col(source).eqNullSafe(F.col("_unit_source")))


def mix(docs: DataFrame, id_column: str = "doc_id", source: str = "source", text: str = "text",
        rule: Rule | None = None, name: str = "mix") -> tuple[DataFrame, DataFrame]:
    """``(documents, order)``.

    ``documents`` has per input row ``id, size, source_size, target, copies, taken, _ident``:
    how often the mix takes the row, and the words that makes. ``order`` has a row per taken
    copy: ``_ident, id, source, epoch, virtual_finish, words_so_far``.

    * Null, empty and word-less texts have size 0; they are taken once, when their place in the order comes.
    * A null source is a source of its own, after all others. Null ids sort first within the shuffle.
    * Rows equal in id, source and text move together, as one document of their joint size.
    * A table without words, or without rows, has targets of 0 and takes nothing.
    * Other input columns are not read.
    """
    rule = rule or Rule()
    sizes = save(sized(docs, id_column, source, text), f"{name}-sizes")
    files = files_for(docs.sparkSession, sizes.count())
    sources = sources_of(sizes, rule, f"{name}-sources")
    key = F.md5(F.concat(F.lit(f"{rule.seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))))
    units = (sizes.groupBy("id", "source", "_ident").agg(F.sum("size").alias("size"))
             .join(sources.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source")))
             .select("_ident", "id", "source", "position", "size", "source_size", "_earlier", "target", key.alias("_key")))
    places = running_total(units, ["position", "_key", "id", "_ident"], "size", "_upto", f"{name}-places", files)
    begun = F.col("_upto") - F.col("_earlier") - F.col("size") + F.col("epoch") * F.col("source_size")
    copies = (places.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(rule.most - 1))))
              .where((begun < F.col("target")) & (F.col("target") > 0))
              .withColumn("virtual_finish", (begun + F.col("size")) / F.col("target"))
              .select("_ident", "id", "source", "position", "_key", "size", "epoch", "virtual_finish"))
    budget = float(sources.agg(F.sum("target")).first()[0] or 0.0)
    order = running_total(copies, ["virtual_finish", "position", "_key", "id", "_ident", "epoch"], "size",
                          "words_so_far", f"{name}-order", files).where(F.col("words_so_far") <= F.lit(budget))
    order = order.select("_ident", "id", "source", "epoch", "virtual_finish", "words_so_far")
    counts = save(_counted(order, "copies"), f"{name}-copies", files)
    documents = (sizes.join(counts, _same_unit("id", "source"), "left")
                 .join(sources.withColumnRenamed("source", "_source").select("_source", "source_size", "target"),
                       F.col("source").eqNullSafe(F.col("_source")))
                 .withColumn("copies", F.coalesce("copies", F.lit(0)))
                 .select("id", "_ident", "size", "source_size", "target", "copies",
                         (F.col("size") * F.col("copies")).alias("taken")))
    return documents, order


def take(docs: DataFrame, id_column: str = "doc_id", source: str = "source", text: str = "text",
         rule: Rule | None = None, name: str = "mix") -> DataFrame:
    """The mixed rows themselves: each row of ``docs`` as often as the mix takes it, same columns."""
    _, order = mix(docs, id_column, source, text, rule, name)
    copies = save(_counted(order, "_copies"), f"{name}-copies", files_for(docs.sparkSession, order.count()))
    rows = docs.withColumn("_ident", F.xxhash64(id_column, source, text)).join(copies, _same_unit(id_column, source))
    return rows.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies")))).select(
        *[F.col(f"`{c}`") for c in docs.columns])
