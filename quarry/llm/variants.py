"""Operator 12 - spelling variants by PartEnum signatures on letter multisets.

A word is a binary vector over (letter, occurrence): "banana" has a1 a2 a3 b1 n1 n2. One
inserted or deleted code point flips one place of it, a replaced one at most two, so near
words have Hamming distance at most two. PartEnum makes that an equality: the letters are
dealt into partitions, and two vectors that differ in d places agree on all but d
partitions at most. So a word has one signature for every choice of d partitions to leave
out (d = 2 of 4 for words of equal length, d = 1 of 3 for lengths one apart), namely the
letters of the partitions left in. A single edit also leaves one half of the word as it
is; a signature carries its half, so it is made once for each. Near words share a
signature, always; words that share one are joined on its hash and verified by their edit
distance. No words are compared outside that join.

The vocabulary is counted by occurrence from whole texts; frequent words are added up in
tasks before any shuffle, and meet the join once, however often they occur.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.scratch import save
from quarry.llm.textwords import LOWER, pieces

#: Letters by about how often texts have them, dealt to partitions there and back; others go by code point.
_COMMON = "etaoinshrdlucmfwygpbvkxqjz"
_LOWER = LOWER.tobytes()


@dataclass(frozen=True)
class Rule:
    shortest: int = 7
    least: int = 2
    ratio: int = 10
    drop_every: int = 31
    #: Letter partitions for words of one length (two are left out) and of lengths one apart (one is left out).
    same_parts: int = 4
    next_parts: int = 3
    #: Words counted in a task before they are sent on.
    held: int = 200_000


# --- words ---------------------------------------------------------------------------------------

def altered(run: str, prefix: int, rule: Rule) -> str:
    """A run as the corpus is taken to spell it: every 31st (by crc32 of ``<doc_id>:<run>``) loses a letter."""
    h = zlib.crc32(run.encode(), prefix)
    if h % rule.drop_every:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def count_words(docs: DataFrame, id_column: str, text: str, rule: Rule) -> DataFrame:
    """``word``, ``n`` of every distinct word that is long and frequent enough."""
    long_run = re.compile("[a-zÀ-ÿ]{%d,}" % rule.shortest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in pieces(batches, "text"):
            for id_, value in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                if not value:
                    continue
                prefix = zlib.crc32(f"{'' if id_ is None else id_}:".encode())
                for found, n in Counter(long_run.findall(value.encode().translate(_LOWER).decode())).items():
                    counts[altered(found, prefix, rule)] += n
            if len(counts) >= rule.held:
                yield pa.RecordBatch.from_pydict({"word": list(counts), "n": pa.array(counts.values(), pa.int64())})
                counts = Counter()
        yield pa.RecordBatch.from_pydict({"word": pa.array(counts, pa.string()), "n": pa.array(counts.values(), pa.int64())})

    seen = docs.select(F.col(id_column).alias("id"), F.col(text).alias("text")).mapInArrow(run, "word string, n long")
    return (seen.where(F.length("word") >= rule.shortest).groupBy("word").agg(F.sum("n").alias("n"))
            .where(F.col("n") >= rule.least))


# --- signatures ----------------------------------------------------------------------------------

class Parts:
    """Letters dealt into ``n`` partitions, and what a word shows when ``out`` of them are left out."""

    def __init__(self, n: int, out: int):
        self.n = n
        deal = [*range(n), *reversed(range(n))]
        self.of = {c: deal[i % len(deal)] for i, c in enumerate(_COMMON)}
        self.kept = [tuple(sorted(set(range(n)) - set(gone))) for gone in combinations(range(n), out)]

    def shown(self, word: str) -> list[str]:
        """For each choice of partitions, the letters of those left in, sorted."""
        cells: list[list[str]] = [[] for _ in range(self.n)]
        for c in sorted(word):
            cells[self.of[c] if c in self.of else ord(c) % self.n].append(c)
        joined = ["".join(c) for c in cells]
        return ["|".join([joined[p] for p in kept]) for kept in self.kept]


#: What a word is in a pair of near words.
SAME, SHORTER, LONGER = 0, 1, 2


def signatures(word: str, same: Parts, next_: Parts, shortest: int) -> Iterator[tuple[int, int]]:
    """(role, signature) rows of a word; a signature says the shorter length, the half kept, and the letters."""
    def rows(role: int, kind: str, length: int, halves: tuple[str, str], letters: list[str]) -> Iterator[tuple[int, int]]:
        for side, half in enumerate(halves):
            head = f"{kind}{side}{length}:{half}:"
            for i, said in enumerate(letters):
                yield role, xxhash.xxh64_intdigest(f"{head}{i}:{said}") - (1 << 63)

    n = len(word)
    yield from rows(SAME, "s", n, (word[:n // 2], word[n // 2:]), same.shown(word))
    letters = next_.shown(word)
    yield from rows(SHORTER, "n", n, (word[:n // 2], word[n // 2:]), letters)
    if n > shortest:
        half = (n - 1) // 2
        yield from rows(LONGER, "n", n - 1, (word[:half], word[half + 1:]), letters)


def _signed(words: DataFrame, rule: Rule) -> DataFrame:
    same, next_ = Parts(rule.same_parts, 2), Parts(rule.next_parts, 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place, roles, keys = [], [], []
            for i, word in enumerate(batch.column("word").to_pylist()):
                for role, key in signatures(word, same, next_, rule.shortest):
                    place.append(i)
                    roles.append(role)
                    keys.append(key)
            at = pa.array(place, pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(roles, pa.int8()),
                                              batch.column("word").take(at), batch.column("n").take(at)],
                                             names=["key", "role", "word", "n"])

    return words.mapInArrow(run, "key long, role byte, word string, n long")


def near_words(words: DataFrame, rule: Rule) -> DataFrame:
    """``a``, ``n_a``, ``b``, ``n_b``: each pair of words one edit apart, once."""
    signed = _signed(words, rule)
    a = signed.select("key", F.col("role").alias("role_a"), F.col("word").alias("a"), F.col("n").alias("n_a"))
    b = signed.select("key", F.col("role").alias("role_b"), F.col("word").alias("b"), F.col("n").alias("n_b"))
    fits = (((F.col("role_a") == SAME) & (F.col("role_b") == SAME) & (F.col("a") < F.col("b")))
            | ((F.col("role_a") == SHORTER) & (F.col("role_b") == LONGER)))
    met = a.join(b, (a["key"] == b["key"]) & fits & (F.levenshtein("a", "b", 1) == 1))
    return met.select("a", "n_a", "b", "n_b").distinct()


# --- the operator --------------------------------------------------------------------------------

def group_variants(docs: DataFrame, id_column: str = "doc_id", text: str = "text", rule: Rule | None = None,
                   name: str = "variants") -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n`` of every word of the vocabulary.

    * Words come from maximal runs of A-Z, a-z and U+00C0 to U+00FF, lower-cased in A-Z only; a null or empty
      text has none. A null id counts as an empty one in the spelling of a run. Repeated rows count each time.
    * ``form`` is the near word of largest ``n`` (ties: smallest in code-point order) if it is at least ``ratio``
      times as frequent; ``root`` follows forms to their end.
    * Words of any length are compared whole. An empty table gives an empty table; other columns are not read.
    """
    rule = rule or Rule()
    words = save(count_words(docs, id_column, text, rule), f"{name}-words")
    pairs = save(near_words(words, rule), f"{name}-pairs")
    both = pairs.select(F.col("a").alias("word"), F.struct((-F.col("n_b")).alias("less"), F.col("b").alias("near")).alias("other")) \
        .unionByName(pairs.select(F.col("b").alias("word"), F.struct((-F.col("n_a")).alias("less"), F.col("a").alias("near")).alias("other")))
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min("other").alias("other"))
    chosen = -F.col("other.less") >= rule.ratio * F.col("n")
    told = words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(chosen, F.col("other.near")).alias("form"), F.when(chosen, -F.col("other.less")).alias("form_n"))
    told = save(told, f"{name}-told")
    # A form is ``ratio`` times as frequent as its word, so chains are short; each round doubles what is followed.
    roots = save(told.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root")), f"{name}-roots")
    while True:
        ahead = roots.select(F.col("word").alias("root"), F.col("root").alias("further"))
        longer = save(roots.join(ahead, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), f"{name}-roots")
        roots = longer.select("word", "root")
        if longer.where("moved").isEmpty():
            break
    return told.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
