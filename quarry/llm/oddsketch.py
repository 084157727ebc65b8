"""Operator 8 - near-duplicate documents by MinHash and odd sketches.

A document's set is its distinct 5-word shingles (A-Z lower-cased). Documents with
equal sets form a class. Per class, ``k`` MinHash samples are cut into bands of
``rows`` samples; classes that agree on a band are candidates. The samples are also
folded into a parity bitmap (odd sketch): two bitmaps differ in few bits where the
similarity is high, and the population count of their XOR estimates it precisely
there, so most false candidates go before any text is read. What is left is
confirmed on the full sets.

Only components are wanted, so a bucket's classes are first held against one of
them (its star), which is linear in the bucket. Those that the stars leave apart are
then compared block by block inside tasks, by bitmap and then by full sets; only links that
join something leave a task. No bucket is cut short, and no task holds more than two blocks.

A pair of similarity s is missed with probability (1 - s**rows) ** (k / rows): at
the threshold of 0.75 with the defaults, 5 in a million; at 0.8, 5 in a hundred million.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.components import components
from quarry.llm.scratch import drop, files_for, save, small_batches, text_files
from quarry.llm.textwords import Words, mix, pieces, window_hashes


@dataclass(frozen=True)
class Rule:
    """``threshold`` in percent. ``bits`` is the odd sketch's size, a multiple of 64. A candidate
    goes unread only if its estimate is below ``floor``, about five standard errors under the threshold."""

    shingle: int = 5
    threshold: int = 75
    k: int = 128
    rows: int = 4
    bits: int = 512
    floor: float = 0.5
    block: int = 1024


def shingle_sets(texts: pa.Array, size: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of every text; with fewer words, the whole sequence is one."""
    words = Words(texts, lower=True)
    h = words.hashes()
    out = []
    for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True):
        out.append(np.unique(window_hashes(h[a:b], min(size, b - a))) if b > a else np.zeros(0, np.uint64))
    return out


def _samples(sets: np.ndarray, k: int, step: int = 4096) -> np.ndarray:
    """``k`` MinHash samples (32 bits) of one non-empty set."""
    odd = mix(np.arange(1, k + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
    least = np.full(k, np.iinfo(np.uint32).max, np.uint32)
    for at in range(0, len(sets), step):
        product = odd[:, None] * sets[None, at:at + step]
        np.minimum(least, (product >> np.uint64(32)).astype(np.uint32).min(axis=1), out=least)
    return least


def _sketch(least: np.ndarray, bits: int) -> np.ndarray:
    """Parity bitmap of the samples: sample ``i`` of value ``v`` flips the bit that ``(i, v)`` hashes to."""
    place = mix((np.arange(len(least), dtype=np.uint64) << np.uint64(32)) | least) % np.uint64(bits)
    flips = np.bincount(place.astype(np.int64), minlength=bits) & 1
    return np.packbits(flips.astype(np.uint8)).view("<u8")


def _bands(least: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key per band, the band's number included."""
    cut = least[:len(least) // rows * rows].reshape(-1, rows)
    key = mix(np.arange(len(cut), dtype=np.uint64) + np.uint64(1))
    for j in range(rows):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + cut[:, j])
    return key


def estimate(differing: int, rule: Rule) -> float:
    """Similarity from the differing bits of two odd sketches: their samples' symmetric difference, as Jaccard."""
    free = 1 - 2.0 * differing / rule.bits
    return 1 + np.log(free) * rule.bits / (4.0 * rule.k) if free > 0 else float("-inf")


def _most_bits(rule: Rule) -> int:
    """Differing bits up to which the estimate is ``floor`` or more."""
    return int(rule.bits / 2 * (1 - np.exp(-4.0 * rule.k * (1 - rule.floor) / rule.bits)))


def signatures(docs: DataFrame, id_column: str, text: str, rule: Rule) -> DataFrame:
    """Per row: id, ``_text`` (hash that tells the texts of one id apart), ``n_shingles``, ``_class`` (digest of the set,
    null if empty), ``_sketch``, ``_bands``."""
    small_batches(docs.sparkSession)
    schema = T.StructType([docs.schema[id_column]] + T._parse_datatype_string(
        "_text long, n_shingles long, _class binary, _sketch array<long>, _bands array<long>").fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, text):
            rows = []
            for s in shingle_sets(batch.column(text), rule.shingle):
                if not len(s):
                    rows.append((0, None, None, None))
                    continue
                least = _samples(s, rule.k)
                rows.append((len(s), hashlib.blake2b(s.tobytes(), digest_size=16).digest(),
                             _sketch(least, rule.bits).view(np.int64), _bands(least, rule.rows).view(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(id_column), batch.column("_text"), *(pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (
                    pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64())), strict=True))],
                names=[f.name for f in schema.fields])

    return docs.select(id_column, text, F.xxhash64(text).alias("_text")).mapInArrow(run, schema)


def _confirm(pairs: DataFrame, texts: DataFrame, rule: Rule, name: str, files: int) -> DataFrame:
    """The ``(a, b)`` pairs whose full sets are similar enough.

    Each ``a`` meets its ``b`` in groups of at most about ``block`` texts, so one
    ``a`` with very many partners is spread over as many groups as it needs.
    """
    pairs = save(pairs.withColumn("_salt", F.pmod(F.xxhash64("b"), F.lit(1 << 30))), name, files)
    groups = save(pairs.groupBy("a").agg(F.ceil(F.count("*") / rule.block).alias("_groups")), name, files)
    pairs = pairs.join(groups, "a").select("a", "b", F.pmod("_salt", F.col("_groups")).alias("_group"))
    first = pairs.select("a", "_group").distinct().join(texts, F.col("a") == F.col("node")).select(
        "a", "_group", F.lit(None).cast("long").alias("b"), "text")
    other = pairs.join(texts, F.col("b") == F.col("node")).select("a", "_group", "b", "text")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, base = None, None
        for batch in pieces(batches, "text"):
            sets = shingle_sets(batch.column("text"), rule.shingle)
            found = []
            for a, g, b, s in zip(*(batch.column(c).to_pylist() for c in ("a", "_group", "b")), sets, strict=True):
                if b is None:
                    group, base = (a, g), s
                elif group == (a, g):
                    both = len(np.intersect1d(base, s, assume_unique=True))
                    if 100 * both >= rule.threshold * (len(base) + len(s) - both):
                        found.append((a, b))
            yield pa.RecordBatch.from_pylist([{"a": a, "b": b} for a, b in found],
                                             schema=pa.schema([("a", pa.int64()), ("b", pa.int64())]))

    dealt = first.union(other).repartition("a", "_group").sortWithinPartitions("a", "_group", F.col("b").asc_nulls_first())
    return save(dealt.mapInArrow(check, "a long, b long"), name, files)


def _near(pairs: DataFrame, classes: DataFrame, rule: Rule) -> DataFrame:
    """Candidate pairs whose odd sketches do not rule them out."""
    side = classes.select("node", "_sketch")
    both = (pairs.distinct()
            .join(side.select(F.col("node").alias("a"), F.col("_sketch").alias("_x")), "a")
            .join(side.select(F.col("node").alias("b"), F.col("_sketch").alias("_y")), "b"))
    differing = sum(F.bit_count(F.col("_x")[i].bitwiseXOR(F.col("_y")[i])) for i in range(rule.bits // 64))
    return both.where(differing <= _most_bits(rule)).select("a", "b")


def _blockwise(buckets: DataFrame, rule: Rule, name: str, files: int) -> DataFrame:
    """Links between different components within each bucket, block against block.

    ``buckets`` has ``_key, node, _component, _sketch, _bands, text``. A bucket of n rows is dealt into blocks and
    each pair of blocks is a group of its own. Within it a pair is looked at in the first band it agrees on,
    by bitmap, then by full sets; only links that join two components leave the task, so neither a
    crowd of similar texts nor one of almost similar texts makes more rows than it has texts.
    """
    sizes = save(buckets.groupBy("_key").agg(F.ceil(F.count("*") / rule.block).alias("_blocks")), f"{name}-sizes", files)
    own = buckets.join(sizes, "_key").withColumn("_own", F.pmod(F.xxhash64("node", F.lit(7)), F.col("_blocks")))
    dealt = own.withColumn("_with", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))).select(
        "_key", F.least("_own", "_with").alias("_i"), F.greatest("_own", "_with").alias("_j"), "_own", "node",
        "_component", "_sketch", "_bands", "text")
    most = _most_bits(rule)

    def compare(group: pa.Table) -> pa.Table:
        own, node, mark = (group.column(c).to_numpy() for c in ("_own", "node", "_component"))
        key, i, j = (group.column(c)[0].as_py() for c in ("_key", "_i", "_j"))
        bits = np.array(group.column("_sketch").to_pylist(), np.int64).view(np.uint64)
        bands = np.array(group.column("_bands").to_pylist(), np.int64)
        sets = shingle_sets(group.column("text"), rule.shingle)
        sizes = np.array([len(s) for s in sets])
        mark = mark.copy()
        left, right = np.flatnonzero(own == i), np.flatnonzero(own == j)
        found: list[dict] = []
        ends = pa.schema([("a", pa.int64()), ("b", pa.int64())])
        if not len(left) or not len(right):  # the hash may leave a block without rows
            return pa.Table.from_pylist(found, schema=ends)
        # The shingles of the right block in order, each with its text.
        held = np.concatenate([sets[q] for q in right])
        whose = np.repeat(np.arange(len(right)), sizes[right])
        order = np.argsort(held, kind="stable")
        held, whose = held[order], whose[order]
        for p in left.tolist():
            at = np.flatnonzero((mark[right] != mark[p]) & ((node[right] > node[p]) | (i != j)))
            at = at[np.bitwise_count(bits[right[at]] ^ bits[p]).sum(axis=1) <= most]
            if not len(at):
                continue
            at = at[bands[p][(bands[right[at]] == bands[p]).argmax(axis=1)] == key]
            if not len(at):
                continue
            low, high = np.searchsorted(held, sets[p], "left"), np.searchsorted(held, sets[p], "right")
            some = high - low
            place = np.arange(some.sum()) + np.repeat(low - (np.cumsum(some) - some), some)
            both = np.bincount(whose[place], minlength=len(right))[at]
            for q in right[at[100 * both >= rule.threshold * (sizes[p] + sizes[right[at]] - both)]].tolist():
                if mark[q] != mark[p]:
                    found.append({"a": int(min(node[p], node[q])), "b": int(max(node[p], node[q]))})
                    mark[mark == mark[q]] = mark[p]
        return pa.Table.from_pylist(found, schema=ends)

    return save(dealt.groupBy("_key", "_i", "_j").applyInArrow(compare, "a long, b long"), f"{name}-blockwise")


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text: str = "text", rule: Rule | None = None,
                    name: str = "near") -> DataFrame:
    """One row per document: id, ``n_shingles``, ``component_id`` (smallest id reachable over links), ``kept``.

    * Documents link if 100 * |A and B| >= threshold * |A or B| over their shingle sets.
    * Null, empty and word-less texts have the empty set and link with nothing.
    * Ids are longs. A row with a null id links with nothing: its component is null, and it is kept.
    * A row is its id and its text: rows that repeat both share a verdict, and an id that stands for different
      texts has a verdict for each.
    * Texts are taken whole; an empty table gives an empty table; other input columns are not read.
    """
    return verdicts(docs, id_column, text, rule, name).select(id_column, "n_shingles", "component_id", "kept")


def verdicts(docs: DataFrame, id_column: str = "doc_id", text: str = "text", rule: Rule | None = None,
             name: str = "near") -> DataFrame:
    """``near_duplicates`` with ``text_hash`` (``xxhash64`` of the text) and ``chosen``: true for one id and text of each
    component, the smallest by id and then by hash, however often the row is there."""
    rule = rule or Rule()
    sig = save(signatures(docs, id_column, text, rule), f"{name}-signatures").withColumnRenamed(id_column, "doc")
    files = files_for(docs.sparkSession, sig.count())
    # One row per class of equal sets, with its smallest document; numbered as it is stored.
    classes = save(sig.where("_class is not null and doc is not null").groupBy("_class").agg(
        F.min(F.struct("doc", "_text")).alias("least"), F.first("_sketch").alias("_sketch"), F.first("_bands").alias("_bands"))
        .select("_class", "least.*", "_sketch", "_bands", F.monotonically_increasing_id().alias("node")), f"{name}-classes", files)
    # Buckets with at least two classes.
    rows = classes.select("node", F.explode("_bands").alias("_key"))
    shared = save(rows.groupBy("_key").agg(F.count("*").alias("n"), F.min("node").alias("lead")).where("n > 1"),
                  f"{name}-shared", files)
    buckets = save(rows.join(shared, "_key").select("_key", "node", "lead"), f"{name}-buckets", files)
    wanted = classes.select("doc", "_text", "node").join(buckets.select("node").distinct(), "node", "left_semi")
    # The text of each class in a bucket: that of its smallest document.
    texts = save(docs.select(F.col(id_column).alias("doc"), F.xxhash64(text).alias("_text"), F.col(text).alias("text"))
                 .join(wanted, ["doc", "_text"]).select("node", "text"), f"{name}-texts", text_files(docs, text))

    links = _confirm(_near(buckets.where("node <> lead").select(F.col("lead").alias("a"), F.col("node").alias("b")),
                           classes, rule), texts, rule, f"{name}-links", files)
    # Texts with one mark are certainly in one component: the smallest text they are linked to, or themselves.
    linked = save(links.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("_low")), f"{name}-linked", files)
    now = save(buckets.select("_key", "node").join(linked, "node", "left").select(
        "_key", "node", F.coalesce("_low", "node").alias("_component")), f"{name}-now", files)
    split = save(now.groupBy("_key").agg(F.min("_component").alias("_low"), F.max("_component").alias("_high"))
                 .where("_low <> _high").select("_key"), f"{name}-split", files)
    left = (now.join(split, "_key", "left_semi").join(classes.select("node", "_sketch", "_bands"), "node")
            .join(texts, "node"))
    found = components(links.union(_blockwise(left, rule, name, files)), name, files)

    # Back to documents: a class's component, and the smallest document of each.
    signed = classes
    named = save(classes.select("_class", "doc", "_text", "node").join(found, "node", "left").select(
        "_class", "doc", "_text", F.coalesce("component", "node").alias("component")), f"{name}-named", files)
    least = save(named.groupBy("component").agg(F.min(F.struct("doc", "_text")).alias("first")), f"{name}-least", files)
    classes = save(named.join(least, "component").select("_class", "first"), f"{name}-found", files)
    drop(texts, buckets, signed, named, least)
    linked = F.when(F.col("doc").isNotNull(), F.col("_class"))
    whole = sig.select("doc", "_text", "n_shingles", linked.alias("_class")).join(classes, "_class", "left")
    own = F.coalesce("first.doc", "doc")
    is_first = (F.col("first.doc") == F.col("doc")) & (F.col("first._text") == F.col("_text"))
    return whole.select(F.col("doc").alias(id_column), "n_shingles", own.alias("component_id"),
                        own.eqNullSafe(F.col("doc")).alias("kept"), F.col("_text").alias("text_hash"),
                        F.coalesce(is_first, F.lit(True)).alias("chosen"))
