"""Operator 11 - nearest neighbours by a block matrix join with int8 tiles.

Largest inner product. Every vector x is also kept as an int8 code: x = s q + e with
s = max |x| / 127. For two vectors

    <x, y> = <s q, t r> + <s q, f> + <e, y>,   so   |<x, y> - s t <q, r>| <= |s q| |f| + |e| |y|,

which is a bound from three stored norms. A task holds a block of queries and streams a
stripe of candidates past it: a tile product of codes gives every inner product up to its
bound, the 21st best lower bound (or exact score) so far is what an upper bound must
reach, and the pairs that do are recomputed in double precision, component after
component. Each task reports a sorted list per query; the lists of a query's stripes are
merged by a heap. Nothing is approximate in the result: a pair that is not recomputed
cannot be among the nearest.

Equal vectors are one candidate that carries its smallest ids, one more than are asked
for; equal query vectors are searched once. So a vector that a third of the rows hold
costs one column of a tile, not a column per copy. Blocks are dealt by hash, and every
candidate meets every query block: the queries are a stated set (ids divisible by
``divisor``), as an exact search needs.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.scratch import save
from quarry.llm.vectors import by_size, finite, packed, runs

#: Share of |x| |y| granted to rounding in the bounds, far above what doubles lose.
_SLACK = 1e-9


@dataclass(frozen=True)
class Rule:
    nearest: int = 20
    divisor: int = 20
    query_block: int = 2048
    stripe: int = 4096
    tile: int = 1024

    @property
    def held(self) -> int:
        """Rows kept per query vector: one more than asked for, as a query's own row is not an answer."""
        return self.nearest + 1


# --- codes ---------------------------------------------------------------------------------------

def _norms(x: np.ndarray) -> np.ndarray:
    """Euclidean norms without overflow or underflow on the way."""
    most = np.abs(x).max(axis=1)
    safe = np.where(most > 0, most, 1)
    return safe * np.sqrt(((x / safe[:, None]) ** 2).sum(axis=1)) * (most > 0)


def encode(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes, scales, and the norms of the vectors, of what the codes say, and of what they leave."""
    scale = np.abs(x).max(axis=1) / 127
    scale[scale == 0] = 1
    code = np.clip(np.rint(x / scale[:, None]), -127, 127)
    said = code * scale[:, None]
    return code.astype(np.int8), scale, _norms(x), _norms(said), _norms(x - said)


_CODED = ("node long, dim int, code binary, vector binary, scale double, norm double, said double, off double, "
          "ids binary, rows binary")


def _coded(classes: DataFrame) -> DataFrame:
    """One row per distinct vector: codes, norms and the (id, row) pairs it answers with."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node, members = batch.column("node"), batch.column("members").to_pylist()
            for at, x in by_size(batch, "vector"):
                code, scale, norm, said, off = encode(x)
                yield pa.RecordBatch.from_pydict({
                    "node": node.take(pa.array(at)), "dim": pa.array(np.full(len(at), x.shape[1]), pa.int32()),
                    "code": [r.tobytes() for r in code], "vector": [r.tobytes() for r in x],
                    "scale": scale, "norm": norm, "said": said, "off": off,
                    "ids": [np.array([m["id"] for m in members[i]], np.int64).tobytes() for i in at],
                    "rows": [np.array([m["row"] for m in members[i]], np.int64).tobytes() for i in at]})

    return classes.mapInArrow(run, _CODED)


# --- a block of queries against a stripe of candidates -------------------------------------------------

class _Block:
    """Queries, and the best rows seen for each: flat arrays sorted by query, score (largest first), id, row."""

    def __init__(self, parts: list[pa.RecordBatch], dim: int, rule: Rule):
        table = pa.concat_batches(parts)
        self.rule, self.dim = rule, dim
        self.node = table.column("node").to_numpy()
        kind = np.float32 if 127 * 127 * dim < 1 << 24 else np.float64  # in which the tile products are exact
        self.kind = kind
        self.code = packed(table.column("code"), np.int8, dim).astype(kind)
        self.flat = np.ascontiguousarray(packed(table.column("vector"), np.float64, dim).T)
        self.scale, self.norm, self.said, self.off = (table.column(c).to_numpy() for c in ("scale", "norm", "said", "off"))
        self.bar = np.full(len(self.node), -np.inf)
        none = np.zeros(0, np.int64)
        self.query, self.score, self.id, self.row = none, np.zeros(0), none, none

    def meet(self, batch: pa.RecordBatch) -> None:
        for at in range(0, batch.num_rows, self.rule.tile):
            self._tile(batch.slice(at, self.rule.tile))

    def _tile(self, part: pa.RecordBatch) -> None:
        code = packed(part.column("code"), np.int8, self.dim).astype(self.kind)
        scale, norm, said, off = (part.column(c).to_numpy() for c in ("scale", "norm", "said", "off"))
        with np.errstate(all="ignore"):  # a bound that overflows excludes nothing
            about = (self.code @ code.T).astype(np.float64) * self.scale[:, None] * scale
            err = self.said[:, None] * off + self.off[:, None] * norm + _SLACK * self.norm[:, None] * norm
            most = self.rule.held
            if part.num_rows >= most:
                lower = np.nan_to_num(about - err, nan=-np.inf, posinf=np.inf, neginf=-np.inf)
                self.bar = np.maximum(self.bar, np.partition(lower, -most, axis=1)[:, -most])
            q, c = np.nonzero(~(about + err < self.bar[:, None]))
            flat = np.ascontiguousarray(packed(part.column("vector"), np.float64, self.dim).T)
            score = np.zeros(len(q))
            for d in range(self.dim):  # component after component, as a plain sum does
                score += self.flat[d][q] * flat[d][c]
        ids = [np.frombuffer(x, np.int64) for x in part.column("ids").to_pylist()]
        rows = [np.frombuffer(x, np.int64) for x in part.column("rows").to_pylist()]
        sizes = np.array([len(x) for x in ids])
        first = np.concatenate([[0], np.cumsum(sizes)])
        again = sizes[c]
        place = np.repeat(first[c] - np.concatenate([[0], np.cumsum(again)[:-1]]) if len(c) else first[:0], again) + np.arange(again.sum())
        self._keep(np.repeat(q, again), np.repeat(score, again), np.concatenate(ids)[place], np.concatenate(rows)[place])

    def _keep(self, query: np.ndarray, score: np.ndarray, id_: np.ndarray, row: np.ndarray) -> None:
        query, score = np.concatenate([self.query, query]), np.concatenate([self.score, score])
        id_, row = np.concatenate([self.id, id_]), np.concatenate([self.row, row])
        order = np.lexsort((row, id_, -score, query))
        cuts = runs(query[order])
        rank = np.arange(len(order)) - np.repeat(cuts[:-1], np.diff(cuts))
        order = order[rank < self.rule.held]
        self.query, self.score, self.id, self.row = query[order], score[order], id_[order], row[order]
        cuts = runs(self.query)
        full = np.flatnonzero(np.diff(cuts) == self.rule.held)
        worst = self.score[cuts[1:][full] - 1]
        at = self.query[cuts[:-1][full]]
        self.bar[at] = np.fmax(self.bar[at], worst)

    def lists(self) -> pa.RecordBatch:
        cuts = runs(self.query)
        offsets = pa.array(cuts, pa.int32())
        lists = [pa.ListArray.from_arrays(offsets, pa.array(x)) for x in (self.score, self.id, self.row)]
        return pa.RecordBatch.from_arrays([pa.array(self.node[self.query[cuts[:-1]]]), *lists],
                                          names=["node", "scores", "ids", "rows"])


_LISTS = "node long, scores array<double>, ids array<long>, rows array<long>"


def _search(work: DataFrame, rule: Rule) -> DataFrame:
    """Rows sorted by (dim, block, stripe, side): queries of a block, then the candidates of the stripe."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, parts, block = None, [], None
        for batch in batches:
            columns = [batch.column(c).to_numpy() for c in ("dim", "block", "stripe", "side")]
            cuts = runs(*columns)
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                now, side = tuple(int(c[a]) for c in columns[:3]), int(columns[3][a])
                if now != key:
                    if block is not None:
                        yield block.lists()
                    key, parts, block = now, [], None
                if side == 0:
                    parts.append(batch.slice(a, b - a))
                elif parts:
                    block = block or _Block(parts, now[0], rule)
                    block.meet(batch.slice(a, b - a))
        if block is not None:
            yield block.lists()

    return work.mapInArrow(run, _LISTS)


def _merge(lists: DataFrame, rule: Rule) -> DataFrame:
    """The lists of each query (consecutive rows) merged by a heap."""
    def merged(streams: list) -> list[dict]:
        best = islice(heapq.merge(*streams), rule.held)
        return [{"score": -s, "id": i, "row": r} for s, i, r in best]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("score", pa.float64()), ("id", pa.int64()), ("row", pa.int64())]))

        def told(nodes: list[int], near: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(near, kind)], names=["node", "near"])

        node, streams = None, []
        for batch in batches:
            nodes, near = [], []
            for n, *columns in zip(*(batch.column(c).to_pylist() for c in ("node", "scores", "ids", "rows")), strict=True):
                if n != node:
                    if streams:
                        nodes.append(node)
                        near.append(merged(streams))
                    node, streams = n, []
                streams.append([(-s, i, r) for s, i, r in zip(*columns, strict=True)])
            yield told(nodes, near)
        if streams:
            yield told([node], [merged(streams)])

    return lists.mapInArrow(run, "node long, near array<struct<score:double,id:long,row:long>>")


# --- the operator ------------------------------------------------------------------------------------

def nearest(vectors: DataFrame, id_column: str = "vec_id", vector: str = "embedding", rule: Rule | None = None,
            name: str = "block") -> DataFrame:
    """``query_id``, ``rank`` (int from 1), ``id_column``, ``score`` of each query's nearest rows.

    * Queries are the rows whose id ``rule.divisor`` divides; candidates are all rows but the query's own.
      A query with fewer candidates than ``rule.nearest`` gets them all.
    * Nearest first; equal scores by smaller id. ``score`` is the inner product in double precision, summed in order.
    * Vectors that are null, empty, zero, or hold null or non-finite components take no part, nor do rows
      without an id. Vectors meet only vectors of their own length.
    * Equal rows are rows of their own: each is a query if its id is, and a candidate for the other.
    * Scores beyond the doubles come out as infinite; one that is no number ranks last.
    * An empty table gives an empty table; other input columns are not read.
    """
    rule = rule or Rule()
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_column).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector"))
    rows = rows.where(F.col("id").isNotNull() & finite(F.col("vector")) & F.exists("vector", lambda v: v != 0))
    rows = save(rows.withColumn("row", F.monotonically_increasing_id()), f"{name}-rows")

    # A limit per window is applied in every task before the exchange, so a common vector sends few rows.
    turn = F.row_number().over(Window.partitionBy("vector").orderBy("id", "row"))
    classes = (rows.withColumn("turn", turn).where(F.col("turn") <= rule.held).groupBy("vector")
               .agg(F.array_sort(F.collect_list(F.struct("id", "row"))).alias("members"))
               .withColumn("node", F.col("members")[0]["row"]))
    classes = save(classes, f"{name}-classes")
    coded = save(_coded(classes), f"{name}-coded")
    asked = save(rows.where(F.col("id") % rule.divisor == 0).join(classes.select("vector", "node"), "vector")
                 .select(F.col("id").alias("query_id"), "row", "node"), f"{name}-asked")
    asking = asked.select("node").distinct()

    n_blocks = max(1, -(-asking.count() // rule.query_block))
    n_stripes = max(1, -(-coded.count() // rule.stripe))
    block, stripe = (F.pmod(F.xxhash64("node"), F.lit(n)).cast("int") for n in (n_blocks, n_stripes))
    queries = coded.join(asking, "node").select(
        "*", block.alias("block"), F.explode(F.sequence(F.lit(0), F.lit(n_stripes - 1))).alias("stripe"), F.lit(0).alias("side"))
    candidates = coded.select(
        "*", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("block"), stripe.alias("stripe"), F.lit(1).alias("side"))
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    work = (queries.unionByName(candidates).repartition(tasks, "dim", "block", "stripe")
            .sortWithinPartitions("dim", "block", "stripe", "side"))
    lists = save(_search(work, rule), f"{name}-lists")
    near = save(_merge(lists.repartition(tasks, "node").sortWithinPartitions("node"), rule), f"{name}-near")
    others = F.slice(F.filter("near", lambda c: c["row"] != F.col("row")), 1, rule.nearest)
    return (asked.join(near, "node").select("query_id", F.posexplode(others).alias("pos", "found"))
            .select("query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("found.id").alias(id_column), "found.score"))
