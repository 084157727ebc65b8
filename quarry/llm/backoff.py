"""Operator 4 - stupid-backoff scores against the n-grams of the whole corpus.

Words are the texts' runs of non-space bytes. Every n-gram of every text up to
``order`` words that can count is counted over all texts (``keycounts``: blocks of hashed keys, dealt
by hash; longer n-grams only where both shorter ones occur elsewhere). Each chunk of texts
gets the counts of its own n-grams back, and scores and sums its texts' words itself.

The score of a word is c(gram) / c(context) for the longest gram ending there that
occurs elsewhere, times ``discount`` for every shorter step; a text's own n-grams are
left out of the counts it is scored by, otherwise every gram would be known. A word
that no other text has counts as one more step down to 1 / N.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm import keycounts
from quarry.llm.keycounts import Space
from quarry.llm.scratch import small_batches
from quarry.llm.textwords import Words, pieces, sums, window_hashes

#: Larger chunks have fewer distinct n-grams a word: less to send.
CHUNK_BYTES = 8 << 20


@dataclass(frozen=True)
class Rule:
    order: int = 3
    discount: float = 0.4


def _total_words(docs: DataFrame, text: str) -> int:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, text):
            yield pa.RecordBatch.from_pydict({"n": pa.array([int(Words(batch.column(text)).counts.sum())], pa.int64())})

    return docs.select(text).mapInArrow(run, "n long").agg(F.sum("n")).first()[0] or 0


class _Chunk:
    """A chunk's n-grams, and what has been learnt about their counts in other texts.

    Words and pairs are asked for first. A longer gram can occur elsewhere only if both grams one word
    shorter do, so only those are asked for, one length at a time; all others count 0.

    ``known[k]`` has, for every word, the count elsewhere of the ``k``-gram that begins there.
    """

    def __init__(self, rows: pa.Table, rule: Rule, space: Space, totals: list[np.ndarray]):
        self.rule, self.space = rule, space
        self.words = Words(rows.column("text"))
        self.hashes = self.words.hashes()
        self.text = self.words.text_of_word()
        self.known = {0: None}
        self.keys, self.counts = self._ask(0)
        for phase, found in enumerate(totals):
            self._learn(found)
            if phase + 1 < max(1, rule.order - 1):
                self.keys, self.counts = self._ask(phase + 1)

    def _ask(self, phase: int) -> tuple[np.ndarray, np.ndarray]:
        """The distinct keys of this phase's grams and their counts; notes where each gram begins."""
        self.asked: list[tuple[int, np.ndarray]] = []
        parts = [np.zeros(0, np.uint64)]
        for k in [k for k in ((1, 2) if phase == 0 else (phase + 2,)) if k <= self.rule.order]:
            n = max(0, len(self.hashes) - k + 1)
            maybe = self.text[:n] == self.text[k - 1:k - 1 + n]
            if k > 2:
                shorter = self.known[k - 1] > 0
                maybe &= shorter[:n] & shorter[1:n + 1]
            at = np.flatnonzero(maybe)
            self.asked.append((k, at))
            parts.append(self.space.cut(window_hashes(self.hashes, k)[at]))
        keys, self.back, counts = np.unique(np.concatenate(parts), return_inverse=True, return_counts=True)
        return keys, counts

    def _learn(self, totals: np.ndarray) -> None:
        end = 0
        for k, at in self.asked:
            key = self.back[end:end + len(at)]
            end += len(at)
            # What the text itself has of the gram does not count.
            _, mine, own = np.unique(self.text[at] * len(self.keys) + key, return_inverse=True, return_counts=True)
            self.known[k] = np.zeros(len(self.hashes), np.int64)
            self.known[k][at] = totals[key].astype(np.int64) - own[mine]

    def scores(self, total: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per text: words, words by the longest gram known (a row of ``order + 1``), log score."""
        n, order = self.words.counts, self.rule.order
        others = np.maximum(total - n, 1)[self.text]
        level, value = np.zeros(len(self.text), np.int64), 1.0 / others
        for k in range(1, order + 1):
            at = np.flatnonzero(self.known[k] > 0)
            below = self.known[k - 1][at] if k > 1 else others[at]
            level[at + k - 1] = k
            value[at + k - 1] = self.known[k][at] / below
        longest = np.minimum(np.arange(len(self.text)) - self.words.first[self.text] + 1, order)
        logs = np.log(value) + (longest - level) * math.log(self.rule.discount)
        hits = np.bincount(self.text * (order + 1) + level, minlength=len(n) * (order + 1))
        return n, hits.reshape(len(n), order + 1), sums(logs, self.words.first)


def score(docs: DataFrame, id_column: str = "doc_id", text: str = "text", rule: Rule | None = None) -> DataFrame:
    """Per row: id, ``n_words``, ``n_unseen``, ``n_known_1`` .. (words by the longest gram known), ``log_score``, ``per_word``.

    * Null, empty and word-less texts have no words: ``log_score`` 0, ``per_word`` null.
    * The counts leave out the row itself, not its copies: a repeated row is known by heart.
    * With no other words in the table N counts as 1. Very long texts are scored whole.
    * An empty table gives an empty table; other input columns are not read.
    """
    rule = rule or Rule()
    small_batches(docs.sparkSession)
    docs = docs.select(F.col(id_column).alias("id"), F.col(text).alias("text"))
    total = _total_words(docs, "text")
    chunks, space = keycounts.with_chunks(docs, "text", ["id", "text"], CHUNK_BYTES)
    known = [f"n_known_{k}" for k in range(1, rule.order + 1)]
    schema = T.StructType([T.StructField(id_column, docs.schema["id"].dataType), *T._parse_datatype_string(
        "n_words long, n_unseen long, " + ", ".join(f"{c} long" for c in known) + ", log_score double, per_word double").fields])

    def question(rows: pa.Table, totals: list[np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray]:
        chunk = _Chunk(rows, rule, space, totals or [])
        return chunk.keys, chunk.counts

    answers = None
    for _ in range(max(1, rule.order - 1)):
        answers = keycounts.ask(chunks, space, question, answers)

    def finish(rows: pa.Table, totals: list[np.ndarray]) -> pa.Table:
        n, hits, logs = _Chunk(rows, rule, space, totals).scores(total)
        mean = pa.array(logs / np.maximum(n, 1), mask=n == 0)
        return pa.table([rows.column("id"), pa.array(n), *(pa.array(hits[:, k]) for k in range(rule.order + 1)),
                         pa.array(logs), mean], names=[f.name for f in schema.fields])

    return keycounts.finish(chunks, answers, finish, schema)
