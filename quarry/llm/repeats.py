"""Operator 5 - substring dedup by seed and extend.

A passage repeats when the same ``window`` consecutive words start at two places,
in one document or two. Finding them takes three steps:

1. Seeds. Every window's smallest ``gram``-word hash is its anchor (winnowing), so
   equal windows have equal anchors at the same offset. Anchors are counted over
   the corpus; about one word in fifteen is an anchor.
2. Extension. Anchors that occur twice or more pick the windows to look at: those
   around them, both ways. These are counted over the corpus by their hash, and those that
   occur again are kept. No documents are joined and no pairs are formed: a passage held by a
   million documents costs one entry per chunk of documents.
3. Adjoining repeated windows merge into maximal repeats, whose words go.

Documents with the same word sequence are one class: one of them stands for all
in step 2, and a class of several is wholly repeated if it has ``window`` words.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm import keycounts
from quarry.llm.keycounts import Space
from quarry.llm.scratch import drop, files_for, save
from quarry.llm.textwords import Words, among, sliding_min, window_hashes


@dataclass(frozen=True)
class Rule:
    """``window``: least length of a repeat in words; ``gram``: words of a seed."""

    window: int = 35
    gram: int = 8


def _windows(h: np.ndarray, rule: Rule, space: Space) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Gram hashes, each window's smallest one, and which grams are the smallest of some window."""
    grams = space.cut(window_hashes(h, rule.gram))
    span = rule.window - rule.gram + 1
    least = sliding_min(grams, span)
    # A gram is an anchor if the largest of its windows' minima is the gram itself.
    padded = np.concatenate([np.zeros(span - 1, np.uint64), least, np.zeros(span - 1, np.uint64)])
    return grams, least, ~sliding_min(~padded, span) == grams


def _sequences(words: Words, h: np.ndarray, rule: Rule):
    """``(i, hashes)`` of every text with at least a window of words."""
    for i in np.flatnonzero(words.counts >= rule.window).tolist():
        yield i, h[words.first[i]:words.first[i + 1]]


def _count(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.unique(np.concatenate(parts), return_counts=True)


def _anchor_keys(texts: pa.ChunkedArray, rule: Rule, space: Space):
    words = Words(texts)
    h = words.hashes()
    parts = []
    for _, seq in _sequences(words, h, rule):
        grams, _, anchor = _windows(seq, rule, space)
        parts.append(grams[anchor])
    return words, h, _count(parts)


def _window_keys(texts: pa.ChunkedArray, shared: list[np.ndarray], rule: Rule, space: Space):
    """Hashes of the windows whose anchor is shared; per text their places too."""
    words = Words(texts)
    h = words.hashes()
    parts, places = [], {}
    for i, seq in _sequences(words, h, rule):
        _, least, _ = _windows(seq, rule, space)
        at = np.flatnonzero(among(least, shared[i]))
        places[i] = at
        parts.append(space.cut(window_hashes(seq, rule.window)[at]))
    return words, parts, places


def _joined(words: Words, i: int, keep: np.ndarray | None = None) -> bytes:
    """The words of text ``i`` (those of ``keep``) with one space between."""
    a, b = words.first[i], words.first[i + 1]
    starts, ends = words.start[a:b], words.end[a:b]
    if keep is not None:
        starts, ends = starts[keep], ends[keep]
    data = memoryview(words.data)
    return b" ".join([data[s:e] for s, e in zip(starts.tolist(), ends.tolist(), strict=True)])


def _spans(at: np.ndarray, window: int) -> list[tuple[int, int]]:
    """Maximal repeats from the places of repeated windows: ``(first word, words)``."""
    if not len(at):
        return []
    cuts = np.flatnonzero(np.diff(at) > window)  # windows that touch or overlap are one repeat
    first = at[np.concatenate([[0], cuts + 1])]
    last = at[np.concatenate([cuts, [len(at) - 1]])] + window
    return list(zip(first.tolist(), (last - first).tolist(), strict=True))


def remove_repeats(docs: DataFrame, text: str = "text", rule: Rule | None = None, name: str = "repeats",
                   texts: bool = True) -> DataFrame:
    """``docs`` with every word of a repeated window taken out of ``text``.

    Adds ``n_words``, ``n_removed`` (long) and ``kept_sha256`` (of the kept words, one
    space between). With ``texts``, a text that lost words becomes its kept words, one
    space between, and any other stays as it is; without, ``text`` is left out.

    * Null and empty texts have no words: nothing to remove, the digest is that of ''.
    * Texts shorter than a window have no repeats.
    * Repeated rows are copies of each other like any two documents.
    * Very long texts are taken whole; an empty table gives an empty table.
    * Input columns named like an added one, or starting with ``_``, are replaced or dropped.
    """
    rule = rule or Rule()
    added = {"n_words", "n_removed", "kept_sha256"}
    carried = [f for f in docs.schema.fields if f.name not in added and not f.name.startswith("_")]
    docs = docs.select(*[f.name for f in carried])
    others = [f for f in carried if f.name != text]
    chunks, space = keycounts.with_chunks(docs, text, [f.name for f in carried if f.name in ("doc_id", text)])

    seeded = T.StructType(others + [
        T.StructField(text, T.StringType()), T.StructField("n_words", T.LongType()),
        T.StructField("_class", T.BinaryType()), T.StructField("_shared", T.BinaryType())])

    def seed(rows: pa.Table, totals: np.ndarray) -> pa.Table:
        words, h, (keys, _) = _anchor_keys(rows.column(text), rule, space)
        often = keys[totals > 1]
        shared: list[bytes | None] = [None] * words.n_texts
        for i, seq in _sequences(words, h, rule):
            grams, _, anchor = _windows(seq, rule, space)
            found = np.unique(grams[anchor])
            found = found[among(found, often)]
            if len(found):
                shared[i] = found.tobytes()
        classes = [hashlib.sha256(_joined(words, i)).digest() for i in range(words.n_texts)]
        out = rows.column(text)
        if not texts:
            out = pa.compute.if_else(pa.array([s is not None for s in shared]), out, pa.scalar(None, pa.string()))
        return pa.table([*(rows.column(f.name) for f in others), out, pa.array(words.counts, pa.int64()),
                         pa.array(classes, pa.binary()), pa.array(shared, pa.binary())],
                        names=[f.name for f in seeded.fields])

    seeds = save(keycounts.counted(chunks, space, lambda rows: _anchor_keys(rows.column(text), rule, space)[2],
                                   seed, seeded), f"{name}-seeds")

    # One row per class, and one text to stand for it. A class is met in a partial count only.
    # (Aggregates are written before they are joined: only then can Spark split a hot class.)
    sharing = seeds.where("_shared is not null").withColumn("_pick", F.hash(F.lit(0), *[f.name for f in others]))
    classes = save(sharing.groupBy("_class").agg(F.count("*").alias("_copies"), F.min("_pick").alias("_pick")),
                   f"{name}-classes", files_for(docs.sparkSession, seeds.count()))
    stands = (sharing.select("_class", text, "_shared", "_pick").join(classes, ["_class", "_pick"])
              .withColumn("_chunk", F.pmod(F.xxhash64("_class"), F.lit(1 << 40)))
              .select("_chunk", "_class", "_copies", text, "_shared"))
    size = stands.agg(F.sum(F.octet_length(text))).first()[0] or 0
    files = files_for(docs.sparkSession, size=size)
    stands = save(stands.withColumn("_chunk", F.pmod("_chunk", F.lit(max(1, -(-size // keycounts.CHUNK_BYTES))))),
                  f"{name}-stands", files)

    def shared_of(rows: pa.Table) -> list[np.ndarray]:
        return [np.frombuffer(s.as_buffer(), np.uint64) for s in rows.column("_shared")]

    def extend(rows: pa.Table, totals: np.ndarray) -> pa.Table:
        words, parts, places = _window_keys(rows.column(text), shared_of(rows), rule, space)
        keys, _ = _count(parts)
        often = keys[totals > 1]
        copies = rows.column("_copies").to_pylist()
        out = []
        ids = rows.column("_class").to_pylist()
        for (i, at), hashes in zip(places.items(), parts, strict=True):
            n = int(words.counts[i])
            spans = [(0, n)] if copies[i] > 1 else _spans(at[among(hashes, often)], rule.window)
            if spans:
                keep = np.ones(n, dtype=bool)
                for a, m in spans:
                    keep[a:a + m] = False
                left = _joined(words, i, keep)
                out.append((ids[i], int(n - keep.sum()), hashlib.sha256(left).hexdigest(),
                            left.decode("utf-8") if texts else None))
        columns = list(zip(*out, strict=True)) if out else [[]] * 4
        return pa.table([pa.array(c, t) for c, t in zip(columns, (pa.binary(), pa.int64(), pa.string(), pa.string()),
                                                        strict=True)],
                        names=[f.name for f in removed.fields])

    removed = T._parse_datatype_string("_class binary, _removed long, _sha string, _left string")
    cut = save(keycounts.counted(stands, space, lambda rows: _count(
        _window_keys(rows.column(text), shared_of(rows), rule, space)[1]), extend, removed).dropDuplicates(["_class"]),
        f"{name}-cut", files)

    drop(stands)
    left = F.coalesce("_left", text).alias(text) if texts else None
    return seeds.join(cut, "_class", "left").select(
        *[left if f.name == text else F.col(f.name) for f in carried if texts or f.name != text], "n_words",
        F.coalesce("_removed", F.lit(0)).alias("n_removed"),
        F.coalesce("_sha", F.lower(F.hex("_class"))).alias("kept_sha256"))
