"""Operator 13 - centroid clustering in integers, with PCA-rotated filtering.

Vectors are turned to integers; distances and centroids are exact integers throughout, so
the result does not depend on how rows are dealt. What is skipped is decided by a bound:
with an orthonormal rotation (principal axes of all vectors) a vector keeps its leading
coordinates p and the norm r of the rest, and

    |x - c|^2  >=  |p_x - p_c|^2 + (r_x - r_c)^2.

A vector measures the centroid of smallest bound in integers; every other centroid whose
bound does not exceed that distance is measured too; all others cannot be nearer or tie.

The driver holds the centroids and the rotation (``clusters`` x ``dims`` and ``dims`` x
``dims`` numbers, fixed by parameters). A round is one pass over the stored table: tasks
send one row per cluster and component, whatever they have read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.scratch import drop, save
from quarry.llm.vectors import by_size, finite, packed

#: Integers stay below this size, so that squared distances and sums of components fit 64 bits.
MOST = 1 << 27
#: Share of the squared norms granted to rounding in a bound.
_SLACK = 1e-9
#: Vectors compared with all centroids at once.
_ROWS = 2048


@dataclass(frozen=True)
class Rule:
    clusters: int = 40
    rounds: int = 5
    dims: int = 64
    scale: int = 256
    lead: int = 16
    seed: str = "2"


def _integers(vectors: DataFrame, rule: Rule) -> DataFrame:
    """``id``, ``ints`` (packed 32-bit integers) of the vectors that count."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, x in by_size(batch, "vector"):
                ints = np.floor(rule.scale * x)
                if np.abs(ints).max() >= MOST:
                    raise ValueError(f"components times {rule.scale} must stay below {MOST}")
                yield pa.RecordBatch.from_pydict({"id": batch.column("id").take(pa.array(at)),
                                                  "ints": [r.tobytes() for r in ints.astype(np.int32)]})

    return vectors.mapInArrow(run, "id long, ints binary")


# --- the rotation ------------------------------------------------------------------------------------

def _sums(cells: dict[str, np.ndarray]) -> pa.RecordBatch:
    """Non-empty cells of named matrices as rows (``what``, ``cell``, ``total``)."""
    rows = [(what, np.flatnonzero(m), m.ravel()) for what, m in cells.items()]
    return pa.RecordBatch.from_arrays([
        pa.array(np.concatenate([np.full(len(at), what, dtype=object) for what, at, _ in rows]), pa.string()),
        pa.array(np.concatenate([at for _, at, _ in rows])),
        pa.array(np.concatenate([m[at] for _, at, m in rows]))], names=["what", "cell", "total"])


def _gathered(sums: DataFrame, shapes: dict[str, tuple[int, ...]], kind: type) -> dict[str, np.ndarray]:
    """The matrices summed over all tasks: at most as many rows as they have cells, fetched by one job
    (``toLocalIterator`` runs a job for every partition)."""
    out = {what: np.zeros(shape, kind) for what, shape in shapes.items()}
    for row in sums.groupBy("what", "cell").agg(F.sum("total").alias("total")).collect():
        out[row.what].flat[row.cell] = row.total
    return out


@dataclass(frozen=True)
class Rotation:
    mean: np.ndarray
    axes: np.ndarray

    def split(self, ints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Leading coordinates, and the norm of the rest (taken from the rest itself, so nothing cancels)."""
        x = ints - self.mean
        lead = x @ self.axes
        return lead, np.linalg.norm(x - lead @ self.axes.T, axis=1)


def _rotation(table: DataFrame, rule: Rule) -> Rotation:
    """Principal axes of all vectors, from sums of products that tasks add up."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = {"n": np.zeros(1), "x": np.zeros(rule.dims), "xx": np.zeros((rule.dims, rule.dims))}
        for batch in batches:
            x = packed(batch.column("ints"), np.int32, rule.dims).astype(np.float64)
            cells["n"] += len(x)
            cells["x"] += x.sum(axis=0)
            cells["xx"] += x.T @ x
        yield _sums(cells)

    got = _gathered(table.mapInArrow(run, "what string, cell long, total double"),
                    {"n": (1,), "x": (rule.dims,), "xx": (rule.dims, rule.dims)}, np.float64)
    n = max(got["n"][0], 1.0)
    mean = got["x"] / n
    _, axes = np.linalg.eigh(got["xx"] / n - np.outer(mean, mean))
    return Rotation(mean, np.ascontiguousarray(axes[:, ::-1][:, :rule.lead]))


def _rotated(table: DataFrame, rotation: Rotation, rule: Rule) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lead, rest = rotation.split(packed(batch.column("ints"), np.int32, rule.dims))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([r.tobytes() for r in lead], pa.binary()), pa.array(rest)],
                                             names=["id", "ints", "lead", "rest"])

    return table.mapInArrow(run, "id long, ints binary, lead binary, rest double")


# --- assignment --------------------------------------------------------------------------------------

def _squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return ((a - b) ** 2).sum(axis=1)


def assign(ints: np.ndarray, lead: np.ndarray, rest: np.ndarray, centroids: np.ndarray,
           rotation: Rotation) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest centroid (ties: the smaller number) and squared distance of each vector, both exact; how many
    distances were measured."""
    c_lead, c_rest = rotation.split(centroids)
    size = (lead ** 2).sum(axis=1)
    c_size = (c_lead ** 2).sum(axis=1)
    bound = size[:, None] - 2 * (lead @ c_lead.T) + c_size + (rest[:, None] - c_rest) ** 2
    bound -= _SLACK * ((size + rest ** 2)[:, None] + c_size + c_rest ** 2)
    first = bound.argmin(axis=1)
    least = _squared(ints, centroids[first])
    row, number = np.nonzero(bound <= least[:, None])
    distance = _squared(ints[row], centroids[number])
    order = np.lexsort((number, distance, row))
    order = order[np.searchsorted(row[order], np.arange(len(ints)))]
    return number[order], distance[order], len(row)


def _assigned(batch: pa.RecordBatch, centroids: np.ndarray, rotation: Rotation,
              rule: Rule) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
    for at in range(0, batch.num_rows, _ROWS):
        part = batch.slice(at, _ROWS)
        ints = packed(part.column("ints"), np.int32, rule.dims).astype(np.int64)
        lead = packed(part.column("lead"), np.float64, rotation.axes.shape[1])
        number, distance, _ = assign(ints, lead, part.column("rest").to_numpy(), centroids, rotation)
        yield part, ints, number, distance


def _moved(table: DataFrame, centroids: np.ndarray, rotation: Rotation, rule: Rule) -> np.ndarray:
    """The centroids after a round; empty ones stay."""
    k = len(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = {"n": np.zeros(k, np.int64), "x": np.zeros((k, rule.dims), np.int64)}
        for batch in batches:
            for _, ints, number, _ in _assigned(batch, centroids, rotation, rule):
                np.add.at(cells["x"], number, ints)
                cells["n"] += np.bincount(number, minlength=k)
        yield _sums(cells)

    got = _gathered(table.mapInArrow(run, "what string, cell long, total long"), {"n": (k,), "x": (k, rule.dims)}, np.int64)
    some = got["n"] > 0
    out = centroids.copy()
    out[some] = got["x"][some] // got["n"][some][:, None]
    return out


# --- the operator ------------------------------------------------------------------------------------

_OUT = "cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"


def cluster(vectors: DataFrame, id_column: str = "vec_id", vector: str = "embedding", rule: Rule | None = None,
            name: str = "rotated") -> DataFrame:
    """One row per vector that counts: id, ``cluster``, ``distance``, ``cluster_inertia``, ``inertia``, ``centroid_sha256``.

    * A vector counts if it has exactly ``rule.dims`` components, none null or non-finite; others are left out.
      Each component x becomes floor(scale * x), which must stay below 2^27 in size (an error names the bound).
    * The first centroids are the ``clusters`` vectors of smallest sha256 of ``<seed>:<id>``; equal hashes (one
      id on several rows) go by the integers. A vector without an id is clustered, but starts no cluster while
      vectors with ids are left. With fewer vectors than clusters, every vector starts one.
    * Ties of distance go to the smaller cluster number. Repeated rows count each time.
    * An empty table, or one without a vector that counts, gives an empty table; other input columns are not read.
    """
    rule = rule or Rule()
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_column).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector"))
    whole = save(_integers(rows.where((F.size("vector") == rule.dims) & finite(F.col("vector"))), rule), f"{name}-ints")
    key = F.sha2(F.concat(F.lit(f"{rule.seed}:"), F.col("id").cast("string")), 256)
    first = whole.orderBy(key.asc_nulls_last(), "ints").limit(rule.clusters).select("ints").collect()
    if not first:
        return spark.createDataFrame([], f"{id_column} long, {_OUT}")
    centroids = np.array([np.frombuffer(r.ints, np.int32) for r in first]).astype(np.int64)
    rotation = _rotation(whole, rule)
    table = save(_rotated(whole, rotation, rule), f"{name}-table")
    drop(whole)
    for _ in range(rule.rounds):
        centroids = _moved(table, centroids, rotation, rule)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, _, number, distance in _assigned(batch, centroids, rotation, rule):
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(number, pa.int32()), pa.array(distance)],
                                                 names=["id", "cluster", "distance"])

    told = save(table.mapInArrow(run, "id long, cluster int, distance long"), f"{name}-told")
    drop(table)
    sums = {r.cluster: r.total for r in told.groupBy("cluster").agg(F.sum("distance").alias("total")).collect()}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    known = spark.createDataFrame([(c, total, sum(sums.values()), digest[c]) for c, total in sums.items()],
                                  "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    # One row per cluster: the side that is broadcast is bounded by a parameter.
    return told.join(F.broadcast(known), "cluster").select(
        F.col("id").alias(id_column), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
