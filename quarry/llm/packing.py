"""Operator 7 - packing documents into fixed-length sequences by linear grouping.

1. Spark tokenises every document and cuts those longer than a sequence; pieces of
   full length fill a sequence each.
2. The counts per length (at most ``capacity`` numbers, whatever the data's size)
   are all the planner needs. It sorts the large lengths, cuts them into groups of
   equal cardinality, rounds each up to its group's largest, and fills sequences
   with the few sizes that gives, one configuration after the other.
3. Real documents take the places of their group's rounded size, longest first;
   small ones then go to the tightest gap that holds them (best fit).
4. The plan is a list of runs ("documents number 1000 to 1999 of length 300 open
   sequences 5000 to 5999"). Spark numbers the pieces of each length by a running
   total and looks up each number's run.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.running import running_total
from quarry.llm.scratch import files_for, save, small_batches
from quarry.llm.textwords import Words, pieces
from quarry.llm.vocab import WordTokens, byte_level_encoder, per_worker, public_path, rank_encoder


@dataclass(frozen=True)
class Rule:
    """Numbers of ``groups`` of large lengths to try (the plan with fewest sequences is used); lengths up
    to ``capacity // small`` are small. ``ranks`` is the vocabulary's rank file, if it has one: plain units
    get the same ids from it, faster."""

    capacity: int = 1024
    end_id: int = 2
    vocabulary: str = public_path("byte_bpe_50k.json")
    ranks: str | None = public_path("byte_bpe_50k.tiktoken")
    special: tuple[str, ...] = ("<|endoftext|>",)
    groups: tuple[int, ...] = (64, 128, 256, 512)
    small: int = 8


# --- token ids -------------------------------------------------------------------------------

def _odd_spaces(data: np.ndarray) -> np.ndarray:
    """Where white space begins that is not one of 0x20 and 0x09-0x0D (or a control that may count as such)."""
    n = len(data)
    b = np.concatenate([data, np.zeros(2, np.uint8)])
    one, two, three = b[:n], b[1:n + 1], b[2:n + 2]
    hit = (one >= 0x1C) & (one <= 0x1F)
    hit |= (one == 0xC2) & ((two == 0x85) | (two == 0xA0))
    e280 = (one == 0xE2) & (two == 0x80)
    hit |= e280 & ((three <= 0x8B) | (three == 0xA8) | (three == 0xA9) | (three == 0xAF))
    hit |= (one == 0xE2) & (two == 0x81) & (three == 0x9F)
    hit |= (one == 0xE1) & (two == 0x9A) & (three == 0x80)
    return hit | ((one == 0xE3) & (two == 0x80) & (three == 0x80))


def token_ids(texts: pa.Array, rule: Rule) -> tuple[np.ndarray, np.ndarray]:
    """``(ids, cuts)``: the ids of text ``i``, as the tokenizer gives them for the whole text, are
    ``ids[cuts[i]:cuts[i + 1]]``.

    The vocabulary's pattern never joins a word with white space after it, so a text is cut
    into units of white space and the word that follows, and each distinct unit is encoded
    once. Texts with other white space or a special string are encoded whole.
    """
    words = Words(texts)
    encode = per_worker(f"encode:{rule.vocabulary}", lambda: byte_level_encoder(rule.vocabulary))
    units = per_worker(f"units:{rule.vocabulary}", lambda: WordTokens([rank_encoder(rule.ranks) if rule.ranks else encode]))
    # Units: white space and a word; at the end of a text, white space alone.
    before = np.concatenate([[0], words.end[:-1]]) if len(words.end) else words.end
    firsts = words.first[:-1][words.counts > 0]
    before[firsts] = words.cuts[:-1][words.counts > 0]
    last_end = np.where(words.counts > 0, np.concatenate([[0], words.end])[words.first[1:]], words.cuts[:-1])
    tails = np.flatnonzero(last_end < words.cuts[1:])
    begin = np.insert(before, words.first[1:][tails], last_end[tails])
    end = np.insert(words.end, words.first[1:][tails], words.cuts[1:][tails])
    count = words.counts.copy()
    count[tails] += 1
    first = np.concatenate([[0], np.cumsum(count)])
    words.start, words.end = begin, end
    slots = units.lookup(words.hashes(), words.strings)
    ids, per_unit = units.expand(slots)
    cuts = np.concatenate([[0], np.cumsum(per_unit)])[first]
    # Whole texts where units would not do.
    odd = np.zeros(words.n_texts, dtype=bool)
    odd[np.searchsorted(words.cuts, np.flatnonzero(_odd_spaces(words.data)), side="right") - 1] = True
    whole = words.data.tobytes()
    for mark in rule.special:
        at = whole.find(mark.encode())
        while at >= 0:
            odd[np.searchsorted(words.cuts, at, side="right") - 1] = True
            at = whole.find(mark.encode(), at + 1)
    if not odd.any():
        return ids, cuts
    parts = [ids[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
    for i in np.flatnonzero(odd).tolist():
        parts[i] = np.array(encode([texts[i].as_py()])[0], np.int32)
    return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])])


def cut_pieces(docs: DataFrame, id_column: str, text: str, rule: Rule) -> DataFrame:
    """``id, piece, start, length, ids_crc32`` of every piece of every row."""
    small_batches(docs.sparkSession)
    schema = T.StructType([T.StructField("id", docs.schema[id_column].dataType)] + T._parse_datatype_string(
        "piece int, start long, length long, ids_crc32 long").fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            ids, cuts = token_ids(batch.column("text").fill_null(""), rule)
            rows = []
            for i, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)):
                own = np.append(ids[a:b], rule.end_id).astype("<u4")
                at, to = 0, len(own) % rule.capacity or rule.capacity
                piece = 0
                while at < len(own):
                    rows.append((i, piece, at, to - at, zlib.crc32(own[at:to].tobytes())))
                    at, to, piece = to, to + rule.capacity, piece + 1
            row, piece, start, length, crc = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(pa.array(row)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                 pa.array(length, pa.int64()), pa.array(crc, pa.int64())], names=[f.name for f in schema.fields])

    return docs.select(F.col(id_column).alias("id"), F.col(text).alias("text")).mapInArrow(run, schema)


# --- the plan --------------------------------------------------------------------------------

class Plan:
    """Runs of pieces of one length, and the sequences (in runs of equal filling) they go to."""

    def __init__(self, counts: dict[int, int], rule: Rule, groups: int):
        self.capacity, self.sequences = rule.capacity, 0
        self.next = dict.fromkeys(counts, 0)  # pieces of each length that have a place
        self.runs: list[tuple[int, int, int, int, int, int]] = []  # length, rank, count, sequence, per sequence, offset
        self.gaps: list[tuple[int, int, int]] = []  # free, first sequence, sequences: sorted
        left = dict(counts)
        full = left.pop(self.capacity, 0)
        if full:
            self._put(self.capacity, full, self._open(full), 1, 0)
        small = {s: n for s, n in left.items() if s <= self.capacity // rule.small}
        self._large(sorted(((s, n) for s, n in left.items() if s not in small), reverse=True), groups)
        for size in sorted(small, reverse=True):
            self._best_fit(size, small[size])

    def _open(self, n: int) -> int:
        self.sequences += n
        return self.sequences - n

    def _put(self, size: int, count: int, sequence: int, each: int, offset: int) -> None:
        self.runs.append((size, self.next[size], count, sequence, each, offset))
        self.next[size] += count

    def _large(self, items: list[tuple[int, int]], groups: int) -> None:
        """Group, choose configurations on the rounded sizes, put real lengths in their places."""
        per_group = -(-sum(n for _, n in items) // groups)
        grouped: list[list[list[int]]] = []
        room = 0
        for size, n in items:  # longest first; a length may belong to two groups
            while n:
                if not room:
                    grouped.append([])
                    room = per_group
                take = min(n, room)
                grouped[-1].append([size, take])
                room, n = room - take, n - take
        sizes = [g[0][0] for g in grouped]
        left = [sum(n for _, n in g) for g in grouped]
        for g in range(len(grouped)):
            while left[g]:
                config = self._configuration(g, sizes, left)
                times = min(left[i] // k for i, k in config)
                for i, k in config:
                    left[i] -= k * times
                self._substitute([grouped[i] for i, k in config for _ in range(k)], times)

    def _configuration(self, g: int, sizes: list[int], left: list[int]) -> list[tuple[int, int]]:
        """Group ``g`` and what fills its sequence best out of the sizes left: ``(group, how many)``."""
        room = self.capacity - sizes[g]
        least = next((s for s, n in zip(reversed(sizes), reversed(left), strict=True) if n), room + 1)
        reach = np.zeros(room + 1, dtype=bool)
        reach[0] = True
        made: list[tuple[int, int, np.ndarray]] = []  # group, copy, sums first reached by it
        if least <= room:
            for i in range(g, len(sizes)):
                for copy in range(1, min(left[i] - (i == g), room // sizes[i]) + 1):
                    more = np.zeros_like(reach)
                    more[sizes[i]:] = reach[:room + 1 - sizes[i]]
                    more &= ~reach
                    if not more.any():
                        break
                    made.append((i, copy, more))
                    reach = reach | more
                if reach[room]:
                    break
        config = {g: 1}
        total = int(np.flatnonzero(reach)[-1])
        for i, _, more in reversed(made):
            if more[total]:
                config[i] = config.get(i, 0) + 1
                total -= sizes[i]
        return sorted(config.items())

    def _substitute(self, slots: list[list[list[int]]], times: int) -> None:
        """``times`` sequences, each with the next longest document of every slot's group."""
        sequence = self._open(times)
        while times:
            n = min([times, *(s[0][1] for s in slots)])
            # A group that fills several slots must have enough of its length for all of them.
            for s in slots:
                n = min(n, max(1, s[0][1] // sum(s is t for t in slots)))
            offset = 0
            for s in slots:
                while not s[0][1]:
                    s.pop(0)
                take = min(n, s[0][1])
                assert take == n
                self._put(s[0][0], n, sequence, 1, offset)
                offset += s[0][0]
                s[0][1] -= n
            for s in slots:
                while s and not s[0][1]:
                    s.pop(0)
            if offset < self.capacity:
                insort(self.gaps, (self.capacity - offset, sequence, n))
            sequence, times = sequence + n, times - n

    def _best_fit(self, size: int, n: int) -> None:
        """``n`` pieces, each into the tightest gap."""
        while n:
            at = bisect_left(self.gaps, (size, -1, 0))
            if at == len(self.gaps):
                each = self.capacity // size
                insort(self.gaps, (self.capacity, self._open(-(-n // each)), -(-n // each)))
                continue
            free, sequence, count = self.gaps.pop(at)
            each = free // size
            whole = min(count, n // each)
            if whole:
                self._put(size, whole * each, sequence, each, self.capacity - free)
                n -= whole * each
                if free - each * size:
                    insort(self.gaps, (free - each * size, sequence, whole))
            if whole < count and 0 < n < each:
                self._put(size, n, sequence + whole, n, self.capacity - free)
                insort(self.gaps, (free - n * size, sequence + whole, 1))
                whole, n = whole + 1, 0
            if whole < count:
                insort(self.gaps, (free, sequence + whole, count - whole))


# --- the operator ----------------------------------------------------------------------------

def pack(docs: DataFrame, id_column: str = "doc_id", text: str = "text", rule: Rule | None = None,
         name: str = "pack") -> DataFrame:
    """Per piece: id, ``piece, start, length, ids_crc32, sequence_id, offset``.

    * Null and empty texts are documents of the end id alone.
    * Very long texts are tokenised whole, one at a time per task; only documents longer than a sequence are cut.
    * Rows are packed one by one: repeated rows and ids are each packed. Ties in length go by a hash of the id.
    * An empty table gives an empty table; other input columns are not read.
    """
    rule = rule or Rule()
    cut = save(cut_pieces(docs, id_column, text, rule), f"{name}-pieces")
    # Bounded by the capacity: one row per length.
    counts = {r[0]: r[1] for r in cut.groupBy("length").count().collect()}
    plan = min((Plan(counts, rule, g) for g in rule.groups), key=lambda p: p.sequences)
    lengths = sorted(counts)
    begin, at = {}, 0
    for s in lengths:
        begin[s], at = at, at + counts[s]
    runs = sorted((begin[size] + rank, sequence, each, offset, size)
                  for size, rank, _, sequence, each, offset in plan.runs)
    first, sequence, each, offset, size = (np.array(c, np.int64) for c in zip(*runs, strict=True)) if runs else (
        np.zeros(0, np.int64),) * 5
    schema = T.StructType([T.StructField(id_column, docs.schema[id_column].dataType)] + T._parse_datatype_string(
        "piece int, start long, length long, ids_crc32 long, sequence_id long, offset long").fields)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number = batch.column("_number").to_numpy(zero_copy_only=False) - 1
            run = np.searchsorted(first, number, side="right") - 1
            within = number - first[run]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("id", "piece", "start", "length", "ids_crc32")),
                 pa.array(sequence[run] + within // each[run]),
                 pa.array(offset[run] + within % each[run] * size[run])], names=[f.name for f in schema.fields])

    numbered = running_total(
        cut.withColumn("_one", F.lit(1).cast("long")).withColumn("_key", F.xxhash64("id", "start")),
        ["length", "_key", "id", "start", "ids_crc32"], "_one", "_number", f"{name}-numbered",
        files_for(docs.sparkSession, sum(counts.values())))
    return numbered.select("id", "piece", "start", "length", "ids_crc32", "_number").mapInArrow(place, schema)
