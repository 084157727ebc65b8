"""Operator 10 - language identification by averaged subword embeddings.

A text is the average of the embeddings of its words' subwords: the 1 to 4 byte
grams of every lower-cased word with its ends marked, hashed to ``buckets`` rows. A
linear softmax on the average gives the language. Both are trained together by
stochastic gradient descent in numpy, on a bounded, hash-picked sample of labelled
rows; executors turn the sample into bucket counts, so the driver holds at most
``sample_rows`` sparse rows. A held-back part of the sample sets the softmax
temperature and the probability below which a prediction counts as rejected.

Prediction is one pass over all texts, without a shuffle: subwords are embedded once
per distinct word of a batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.scratch import save, small_batches
from quarry.llm.textwords import Words, mix, pieces, sums

UNKNOWN = "und"
_LETTER = regex.compile(r"\p{L}")


@dataclass(frozen=True)
class Rule:
    """``sample_rows`` bounds the labelled rows learnt from, dealt evenly over the languages;
    ``accept`` is the accuracy that accepted predictions should have on held-back rows."""

    grams: tuple[int, ...] = (1, 2, 3, 4)
    buckets: int = 1 << 15
    width: int = 16
    sample_rows: int = 2000
    epochs: int = 12
    least_steps: int = 1500
    batch: int = 16
    rate: float = 0.2
    held_back: float = 0.2
    accept: float = 0.99
    seed: int = 7


@dataclass
class Model:
    languages: list[str]
    embed: np.ndarray
    weight: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    reject_below: float = 0.0

    def probabilities(self, average: np.ndarray) -> np.ndarray:
        logits = (average.astype(np.float64) @ self.weight + self.bias) / self.temperature
        logits -= logits.max(axis=1, keepdims=True)
        e = np.exp(logits)
        return e / e.sum(axis=1, keepdims=True)


def _subwords(words: Words, rule: Rule) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(buckets, cuts, back)``: subword buckets of the distinct words (word ``i`` has ``cuts[i]:cuts[i+1]``),
    and the distinct word of every word."""
    _, where, back = np.unique(words.hashes(), return_index=True, return_inverse=True)
    start, length = words.start[where], words.end[where] - words.start[where]
    ends = np.cumsum(length + 2)
    begin = ends - length - 2
    size = int(ends[-1]) if len(ends) else 0
    owner = np.repeat(np.arange(len(where)), length + 2)
    place = np.arange(size) - begin[owner] - 1
    inner = (place >= 0) & (place < length[owner])
    text = np.where(place < 0, np.uint8(ord("<")), np.uint8(ord(">")))
    text[inner] = words.data[(start[owner] + place)[inner]]
    value = np.zeros(size, np.uint64)
    found, owners = [], []
    for n in range(1, max(rule.grams) + 1):
        if size < n:
            break
        value = value[:size - n + 1] << np.uint64(8) | text[n - 1:].astype(np.uint64)
        if n in rule.grams:
            whole = owner[:size - n + 1] == owner[n - 1:]
            key = mix(value[whole] + (np.uint64(n) << np.uint64(56)))
            found.append((key % np.uint64(rule.buckets)).astype(np.int32))
            owners.append(owner[:size - n + 1][whole])
    if not found:
        return np.zeros(0, np.int32), np.zeros(1, np.int64), back
    owners = np.concatenate(owners)
    order = np.argsort(owners, kind="stable")
    return np.concatenate(found)[order], np.searchsorted(owners[order], np.arange(len(where) + 1)), back


def _averages(texts: pa.Array, model: Model, rule: Rule) -> np.ndarray:
    words = Words(texts, lower=True)
    buckets, cuts, back = _subwords(words, rule)
    per_word = sums(model.embed[buckets], cuts)
    counts = np.diff(cuts)
    total = sums(counts[back], words.first)
    return sums(per_word[back], words.first) / np.maximum(total, 1)[:, None]


def _has_letter(texts: pa.Array) -> np.ndarray:
    return np.array([t is not None and _LETTER.search(t) is not None for t in texts.to_pylist()], dtype=bool)


def _sample(docs: DataFrame, rule: Rule) -> DataFrame:
    """Rows to learn from: ``lang`` and the bucket counts of the whole text, at most ``sample_rows`` in expectation.

    However many languages there are, each has its share of them. A row is drawn by its id and text; rows
    equal in both are learnt from once. The counts per language are a written table, so Spark knows their
    size when it chooses the join.
    """
    counts = save(docs.groupBy("lang").agg(F.count("*").alias("n")), "langid-counts")
    quota = rule.sample_rows / max(1, counts.count())
    draw = F.pmod(F.xxhash64("doc", "text", F.lit(rule.seed)), F.lit(1 << 30)) / float(1 << 30)
    picked = docs.join(counts, "lang").where(draw < F.lit(quota) / F.col("n")).withColumn(
        "key", F.xxhash64("doc", "text")).dropDuplicates(["lang", "key"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", 1 << 20):
            words = Words(batch.column("text"), lower=True)
            buckets, cuts, back = _subwords(words, rule)
            some = _has_letter(batch.column("text"))
            rows = []
            for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True):
                kinds, times = np.unique(back[a:b], return_counts=True)
                weights = np.zeros(rule.buckets, np.int64)
                for k, t in zip(kinds.tolist(), times.tolist(), strict=True):
                    np.add.at(weights, buckets[cuts[k]:cuts[k + 1]], t)
                at = np.flatnonzero(weights)
                rows.append((at.astype(np.int32), np.minimum(weights[at], 2**31 - 1).astype(np.int32)))
            out = pa.RecordBatch.from_arrays(
                [batch.column("lang"), batch.column("key"), pa.array([r[0] for r in rows], pa.list_(pa.int32())),
                 pa.array([r[1] for r in rows], pa.list_(pa.int32()))], names=["lang", "key", "buckets", "counts"])
            yield out.filter(pa.array(some))

    return picked.select("lang", "key", "text").mapInArrow(run, "lang string, key long, buckets array<int>, counts array<int>")


def _average(rows: list, embed: np.ndarray) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    parts = [(b, c / c.sum()) for b, c in rows]
    return np.stack([(embed[b] * w[:, None]).sum(axis=0) for b, w in parts]), parts


def train(sample: list[tuple[str, np.ndarray, np.ndarray]], rule: Rule) -> Model:
    """Stochastic gradient descent on ``(language, buckets, counts)`` rows, then calibration on held-back rows."""
    languages = sorted({s[0] for s in sample})
    rng = np.random.default_rng(rule.seed)
    model = Model(languages, rng.uniform(-1, 1, (rule.buckets, rule.width)) / rule.width,
                  np.zeros((rule.width, len(languages))), np.zeros(len(languages)))
    if not languages:
        return model
    known = {k: i for i, k in enumerate(languages)}
    rows = [(known[k], (np.asarray(b), np.asarray(c, np.float64))) for k, b, c in sample if len(b)]
    order = rng.permutation(len(rows))
    cut = int(len(rows) * rule.held_back)
    back, learn = [rows[i] for i in order[:cut]], [rows[i] for i in order[cut:]]
    per_epoch = max(1, -(-len(learn) // rule.batch))
    epochs = max(rule.epochs, -(-rule.least_steps // per_epoch))
    steps, step = epochs * per_epoch, 0
    for _ in range(epochs):
        turn = rng.permutation(len(learn))
        for at in range(0, len(learn), rule.batch):
            part = [learn[i] for i in turn[at:at + rule.batch]]
            average, weights = _average([p[1] for p in part], model.embed)
            error = model.probabilities(average)
            error[np.arange(len(part)), [p[0] for p in part]] -= 1
            rate = rule.rate * (1 - step / steps) / len(part)
            to_embed = error @ model.weight.T
            model.weight -= rate * average.T @ error
            model.bias -= rate * error.sum(axis=0)
            for (b, w), g in zip(weights, to_embed, strict=True):
                # By its share of the text, times the distinct buckets: a step does not shrink as texts grow.
                model.embed[b] -= rate * len(b) * w[:, None] * g[None, :]
            step += 1
    if back:
        _calibrate(model, back, rule)
    model.embed = model.embed.astype(np.float32)
    return model


def _calibrate(model: Model, back: list, rule: Rule) -> None:
    average, _ = _average([p[1] for p in back], model.embed)
    truth = np.array([p[0] for p in back])
    best, keep = np.inf, 1.0
    for temperature in np.geomspace(0.05, 20, 61):
        model.temperature = float(temperature)
        p = model.probabilities(average)[np.arange(len(truth)), truth]
        loss = -np.log(np.maximum(p, 1e-12)).mean()
        if loss < best:
            best, keep = loss, float(temperature)
    model.temperature = keep
    p = model.probabilities(average)
    sure, right = p.max(axis=1), p.argmax(axis=1) == truth
    order = np.argsort(-sure)
    accuracy = np.cumsum(right[order]) / np.arange(1, len(order) + 1)
    good = np.flatnonzero(accuracy >= rule.accept)
    model.reject_below = float(sure[order][good[-1]]) if len(good) else 1.0
    if len(good) == len(order):
        model.reject_below = 1.0 / len(model.languages)


def identify(docs: DataFrame, learn_from, id_column: str = "doc_id", text: str = "text", lang: str = "lang",
             rule: Rule | None = None) -> DataFrame:
    """Per row: id, ``lang_pred``, ``score`` (calibrated probability), ``rejected`` (below the calibrated bound).

    ``learn_from`` is a condition on ``docs``; of its rows, those with a language and a text are learnt from.

    * A null text, or one without a letter, is ``und`` with score 0, and rejected.
    * Rows that share an id are drawn apart unless their text is the same too; such copies are learnt from once.
    * With nothing to learn from every row is ``und``. With one language every text with a letter is that language.
    * Repeated rows get equal answers; texts are read whole; an empty table gives an empty table.
    * ``lang`` serves training alone; other columns are not read.
    """
    rule = rule or Rule()
    small_batches(docs.sparkSession)
    labelled = docs.where(learn_from).where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(id_column).alias("doc"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    sample = sorted(((r["lang"], r["key"], r["buckets"], r["counts"]) for r in _sample(labelled, rule).toLocalIterator()),
                    key=lambda r: (r[0], r[1], r[2]))
    model = train([(k, np.array(b, np.int64), np.array(c, np.float64)) for k, _, b, c in sample], rule)
    schema = T.StructType([T.StructField(id_column, docs.schema[id_column].dataType), *T._parse_datatype_string(
        "lang_pred string, score double, rejected boolean").fields])
    names = np.array([*model.languages, UNKNOWN], dtype=object)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # buckets x width floats: 2 MB at the defaults

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in pieces(batches, "text", 1 << 20):
            told = _has_letter(batch.column("text")) & bool(model.languages)
            best, score = np.full(batch.num_rows, len(names) - 1), np.zeros(batch.num_rows)
            if told.any():
                p = model.probabilities(_averages(batch.column("text"), model, rule))
                best[told], score[told] = p.argmax(axis=1)[told], p.max(axis=1)[told]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(names[best], pa.string()), pa.array(score),
                 pa.array(~told | (score < model.reject_below))], names=[f.name for f in schema.fields])

    return docs.select(F.col(id_column).alias("id"), F.col(text).alias("text")).mapInArrow(run, schema)
