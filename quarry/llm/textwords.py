"""Words of whole texts as numpy arrays, used inside Arrow-batched tasks.

A word is a maximal run of bytes other than 0x20 and 0x09-0x0D. Those bytes never
occur inside a multi-byte UTF-8 character, so words can be cut and hashed on the
UTF-8 buffer of an Arrow column without decoding it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute

IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20]] = True

# Whitespace of a word pattern as a Python/Java/DuckDB-neutral character class.
WORD_CLASS = r"[^\x20\x09-\x0D]+"

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32

_M1 = np.uint64(0xBF58476D1CE4E5B9)
_M2 = np.uint64(0x94D049BB133111EB)
_GOLD = np.uint64(0x9E3779B97F4A7C15)
# Words longer than this many bytes are hashed one by one.
_LONG = 64


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer (splitmix64): every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


class Words:
    """The words of a list of texts.

    ``start``/``end`` are byte positions in ``data``; the words of text ``i`` are
    ``first[i]:first[i + 1]``. Null texts have no words.
    """

    def __init__(self, texts: pa.Array, lower: bool = False):
        if isinstance(texts, pa.ChunkedArray):
            texts = texts.combine_chunks()
        texts = texts.cast(pa.large_string()).fill_null("")
        _, offsets, data = texts.buffers()
        n = len(texts)
        cuts = np.frombuffer(offsets, dtype=np.int64, count=n + 1 + texts.offset)[texts.offset:]
        raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
        raw = raw[cuts[0]:cuts[-1]] if n else raw[:0]
        self.cuts = cuts - cuts[0] if n else np.zeros(1, np.int64)
        self.data = LOWER[raw] if lower else np.ascontiguousarray(raw)
        size = len(self.data)
        inside = ~IS_SPACE[self.data]
        before = np.zeros(size, dtype=bool)
        after = np.zeros(size, dtype=bool)
        before[1:] = inside[:-1]
        after[:-1] = inside[1:]
        edges = self.cuts[1:-1]
        before[edges[edges < size]] = False
        after[edges[edges > 0] - 1] = False
        self.inside = inside
        self.start = np.flatnonzero(inside & ~before)
        self.end = np.flatnonzero(inside & ~after) + 1
        self.first = np.searchsorted(self.start, self.cuts)
        self.n_texts = n

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(self.n_texts), self.counts)

    def per_text(self, mask: np.ndarray) -> np.ndarray:
        """How many bytes of each text ``mask`` marks."""
        where = np.flatnonzero(mask)
        return np.diff(np.searchsorted(where, self.cuts))

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of every word's bytes (eight at a time; very long words one by one)."""
        start, length = self.start, self.end - self.start
        padded = np.concatenate([self.data, np.zeros(8, np.uint8)])
        eights = np.ndarray(shape=(len(padded) - 7,), dtype="<u8", buffer=padded.data, strides=(1,))
        out = mix(length.astype(np.uint64) * _GOLD)
        todo = np.flatnonzero(length <= _LONG)
        at = start[todo]
        left = length[todo]
        while len(todo):
            block = eights[at]
            short = left < 8
            if short.any():
                drop = ((8 - left[short]) * 8).astype(np.uint64)
                block[short] = (block[short] << drop) >> drop
            out[todo] = mix((out[todo] ^ block) * _GOLD + np.uint64(1))
            more = left > 8
            todo, at, left = todo[more], at[more] + 8, left[more] - 8
        view = memoryview(padded)
        for i in np.flatnonzero(length > _LONG):
            digest = hashlib.blake2b(view[start[i]:self.end[i]], digest_size=8).digest()
            out[i] = int.from_bytes(digest, "little")
        return out

    def strings(self, places: np.ndarray, begin: np.ndarray | None = None) -> list[str]:
        """The words at ``places``, each from its ``begin`` (its start unless given) to its end."""
        data = memoryview(self.data)
        starts = (self.start if begin is None else begin)[places].tolist()
        return [str(data[s:e], "utf-8", "replace") for s, e in zip(starts, self.end[places].tolist(), strict=True)]


def window_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of the ``k`` consecutive words that start at each place (``len(h) - k + 1`` of them).

    Built by doubling, so it costs O(log k) passes whatever ``k`` is.
    """
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = mix(np.full(n, k, dtype=np.uint64) * _GOLD)
    power, size, done, bits = h, 1, 0, k
    while bits:
        if bits & 1:
            out = mix(out * _M2 + power[done:done + n])
            done += size
        bits >>= 1
        if bits:
            power = mix(power[:-size] * _GOLD + (power[size:] ^ (power[size:] >> np.uint64(7))))
            size *= 2
    return out


def among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which ``values`` are in ``known``, which is sorted."""
    if not len(known):
        return np.zeros(len(values), dtype=bool)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each ``w`` consecutive values."""
    n, size = len(x) - w + 1, 1
    if n <= 0:
        return x[:0]
    out = x
    while size * 2 <= w:
        out = np.minimum(out[:-size], out[size:])
        size *= 2
    return np.minimum(out[:n], out[w - size:w - size + n])


def sums(values: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Sums of consecutive rows of ``values``; empty stretches give zeros."""
    out = np.zeros((len(cuts) - 1, *values.shape[1:]), values.dtype)
    some = np.flatnonzero(np.diff(cuts) > 0)
    if len(some):
        out[some] = np.add.reduceat(values, cuts[:-1][some], axis=0)
    return out


def pieces(batches: Iterable[pa.RecordBatch], column: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut or join batches so that each holds about ``most`` bytes of ``column`` (one row at least)."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        length = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        total = np.cumsum(length)
        at = 0
        while at < batch.num_rows:
            base = total[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(total, base + most - size, side="right")))
            to = min(to, batch.num_rows)
            held.append(batch.slice(at, to - at))
            size += int(total[to - 1] - base)
            at = to
            if size >= most or at < batch.num_rows:
                yield _joined(held)
                held, size = [], 0
    if held:
        yield _joined(held)


def _joined(held: list[pa.RecordBatch]) -> pa.RecordBatch:
    return held[0] if len(held) == 1 else pa.concat_batches(held)
