"""Corpus-wide counts of 64-bit keys, exchanged as sorted blocks instead of one row per key.

Rows are dealt into chunks of bounded size. Each chunk lists its distinct keys in
order, with its own counts, and sends one block per hash bucket: the count table
is partitioned by hash and a key costs one entry per chunk however often it
occurs, so a very common key is no hot spot. The task of a bucket adds the
entries up and answers every chunk's block with the totals, in the block's order.
The chunk then meets its answers in a cogroup. Keys travel as byte planes of their
differences, which the shuffle's own compression packs.

Both uses of a chunk read the same exchange (Spark reuses it within a query), so
the texts are shuffled once.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of text a chunk holds on average; one longer text makes a chunk of its own size.
CHUNK_BYTES = 2 << 20
#: Keys a bucket's task holds at once, on average.
BUCKET_KEYS = 1 << 20

BLOCKS = "_chunk long, _bucket int, _keys binary, _counts binary"
ANSWERS = "_chunk long, _bucket int, _totals binary, _phase int"


def to_planes(values: np.ndarray) -> bytes:
    """Little-endian integers as byte planes: all lowest bytes first, all highest bytes last."""
    width = values.dtype.itemsize
    return np.ascontiguousarray(values.view(np.uint8).reshape(-1, width).T).tobytes()


def from_planes(block: bytes, kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    planes = np.frombuffer(block, np.uint8).reshape(width, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


@dataclass(frozen=True)
class Space:
    """``buckets`` the keys are dealt to by their highest bits, and the ``bits`` of a key that are sent:
    as many as leave a key a chance of at most 2**-30 to meet another's (all 64 from 2**34 keys on)."""

    buckets: int
    bits: int

    @staticmethod
    def of(keys: float) -> Space:
        return Space(1 << max(3, int(np.ceil(np.log2(max(1, keys / BUCKET_KEYS))))),
                     min(64, 30 + int(np.ceil(np.log2(max(2, keys))))))

    def cut(self, keys: np.ndarray) -> np.ndarray:
        return keys >> np.uint64(64 - self.bits)


def with_chunks(docs: DataFrame, text: str, key: list[str], chunk: int = CHUNK_BYTES) -> tuple[DataFrame, Space]:
    """``docs`` plus ``_chunk`` (a hash of ``key``), and the key space that its words need."""
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    chunks = max(1, -(-size // chunk))
    return docs.withColumn("_chunk", F.pmod(F.xxhash64(*key), F.lit(chunks))), Space.of(size / 5)


def blocks_of(chunk: int, keys: np.ndarray, counts: np.ndarray, space: Space) -> pa.Table:
    """One row per bucket that has keys; ``keys`` are sorted, distinct and cut to the space's bits."""
    shift = np.uint64(space.bits - (space.buckets.bit_length() - 1))
    bucket = (keys >> shift).astype(np.int32)
    cuts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(keys) else np.zeros(0, int)
    ends = np.concatenate([cuts[1:], [len(keys)]]) if len(keys) else cuts
    rows = []
    for a, b in zip(cuts.tolist(), ends.tolist(), strict=True):
        part = keys[a:b].copy()
        part[1:] -= keys[a:b - 1]
        rows.append((chunk, int(bucket[a]), to_planes(part), to_planes(counts[a:b].astype(np.uint32))))
    return pa.table({"_chunk": pa.array([r[0] for r in rows], pa.int64()),
                     "_bucket": pa.array([r[1] for r in rows], pa.int32()),
                     "_keys": pa.array([r[2] for r in rows], pa.binary()),
                     "_counts": pa.array([r[3] for r in rows], pa.binary())})


def _answer(group: pa.Table, phase: int) -> pa.Table:
    keys = [np.cumsum(from_planes(k.as_buffer(), np.uint64), dtype=np.uint64) for k in group.column("_keys")]
    counts = np.concatenate([from_planes(c.as_buffer(), np.uint32) for c in group.column("_counts")])
    _, back = np.unique(np.concatenate(keys), return_inverse=True)
    totals = np.bincount(back, weights=counts).astype(np.uint64)[back]
    ends = np.cumsum([len(k) for k in keys])
    return pa.table({"_chunk": group.column("_chunk"), "_bucket": group.column("_bucket"),
                     "_totals": pa.array([to_planes(totals[e - len(k):e]) for k, e in zip(keys, ends, strict=True)],
                                         pa.binary()),
                     "_phase": pa.array([phase] * len(keys), pa.int32())})


def ask(chunks: DataFrame, space: Space, keys_of: Callable, answers: DataFrame | None = None) -> DataFrame:
    """Count keys of ``chunks`` (which has ``_chunk``) over the corpus: a row of totals per chunk and bucket.

    ``keys_of(rows)`` gives a chunk's sorted distinct keys (cut by ``space``) and their counts there. With the ``answers`` of
    earlier questions it is ``keys_of(rows, totals)``, a list of their totals; this one's are added to them.
    """
    phase = 0 if answers is None else answers.schema["_phase"].metadata["last"] + 1

    def send(rows: pa.Table, earlier: pa.Table | None = None) -> pa.Table:
        if not rows.num_rows:
            return blocks_of(0, np.zeros(0, np.uint64), np.zeros(0, np.int64), space)
        keys, counts = keys_of(rows) if earlier is None else keys_of(rows, _totals(earlier, phase))
        return blocks_of(rows.column("_chunk")[0].as_py(), keys, counts, space)

    grouped = chunks.groupBy("_chunk")
    sent = grouped.applyInArrow(lambda rows: send(rows), BLOCKS) if answers is None else \
        grouped.cogroup(answers.groupBy("_chunk")).applyInArrow(lambda rows, earlier: send(rows, earlier), BLOCKS)
    # Dealt by chunk here and now: the next question and the end then read this one exchange, and a union
    # of such answers needs no other.
    found = sent.groupBy("_bucket").applyInArrow(lambda group: _answer(group, phase), ANSWERS).repartition("_chunk")
    both = found if answers is None else answers.unionByName(found)
    return both.withMetadata("_phase", {"last": phase})


def _totals(answers: pa.Table, phases: int) -> list[np.ndarray]:
    """Per question, the totals of a chunk's keys in their order."""
    answers = answers.sort_by([("_phase", "ascending"), ("_bucket", "ascending")])
    parts: list[list[np.ndarray]] = [[] for _ in range(phases)]
    for phase, block in zip(answers.column("_phase").to_pylist(), answers.column("_totals"), strict=True):
        parts[phase].append(from_planes(block.as_buffer(), np.uint64))
    return [np.concatenate(p) if p else np.zeros(0, np.uint64) for p in parts]


def finish(chunks: DataFrame, answers: DataFrame, last: Callable, schema) -> DataFrame:
    """``last(rows, totals)`` on every chunk, ``totals`` a list of arrays as in ``ask``."""
    phases = answers.schema["_phase"].metadata["last"] + 1

    def receive(rows: pa.Table, own: pa.Table) -> pa.Table:
        if not rows.num_rows:
            return pa.Table.from_pylist([], schema=_arrow(schema))
        return last(rows, _totals(own, phases))

    return chunks.groupBy("_chunk").cogroup(answers.groupBy("_chunk")).applyInArrow(receive, schema)


def counted(chunks: DataFrame, space: Space, keys_of: Callable, last: Callable, schema) -> DataFrame:
    """One question: ``last(rows, totals)`` with the totals of ``keys_of(rows)``."""
    return finish(chunks, ask(chunks, space, keys_of), lambda rows, totals: last(rows, totals[0]), schema)


def _arrow(schema) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    return to_arrow_schema(schema)
