"""Public tokenizer vocabularies, applied to distinct words and remembered per worker."""

from __future__ import annotations

import os
from collections.abc import Callable
from itertools import chain

import numpy as np

#: Distinct words a worker remembers per vocabulary before it starts over.
REMEMBERED = 400_000


def public_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def _quiet() -> None:
    """One thread per task: Spark deals out the cores."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    os.environ["RAYON_NUM_THREADS"] = "1"


def byte_level_encoder(path: str) -> Callable[[list[str]], list[list[int]]]:
    """Byte-level BPE of a ``tokenizers`` file, no special tokens added."""
    _quiet()
    from tokenizers import Tokenizer
    model = Tokenizer.from_file(path)
    return lambda texts: [e.ids for e in model.encode_batch_fast(texts, add_special_tokens=False)]


def rank_encoder(path: str) -> Callable[[list[str]], list[list[int]]]:
    """Byte-level BPE of a rank file (``tiktoken``), special strings taken as text."""
    import base64

    import public_tokenizers
    import tiktoken
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    model = tiktoken.Encoding(os.path.basename(path), pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                              special_tokens={})
    return lambda texts: [model.encode_ordinary(t) for t in texts]


def piece_encoder(path: str) -> Callable[[list[str]], list[list[int]]]:
    """SentencePiece BPE with byte fallback."""
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return lambda texts: model.encode(texts, num_threads=1)


def encoder(path: str) -> Callable[[list[str]], list[list[int]]]:
    kind = path.rsplit(".", 1)[-1]
    return {"json": byte_level_encoder, "tiktoken": rank_encoder, "model": piece_encoder}[kind](path)


def fallback_ids(path: str, size: int = 1 << 17) -> np.ndarray:
    """Which ids spell single bytes that are no character of their own.

    For SentencePiece its byte pieces; for byte-level BPE the one-byte tokens
    from 0x80 up (parts of a multi-byte character that no merge put together).
    """
    out = np.zeros(size, dtype=bool)
    if path.endswith(".model"):
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        out[[i for i in range(model.get_piece_size()) if model.is_byte(i)]] = True
    elif path.endswith(".tiktoken"):
        import base64
        with open(path, "rb") as lines:
            for a, b in map(bytes.split, lines):
                byte = base64.b64decode(a)
                if len(byte) == 1 and byte[0] >= 0x80:
                    out[int(b)] = True
    else:
        raise ValueError(f"no byte-fallback rule for {path}")
    return out


class WordTokens:
    """Token ids of words under several vocabularies, encoded once per distinct word (by a
    64-bit hash) while the worker remembers it.

    Per vocabulary, ``ids`` and ``first`` form one long list: the tokens of slot ``s``
    are ``ids[first[s]:first[s + 1]]``.
    """

    def __init__(self, encoders: list[Callable[[list[str]], list[list[int]]]], most: int = REMEMBERED):
        self.encoders, self.most = encoders, most
        self._clear()

    def _clear(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.slots = np.zeros(0, np.int64)
        self.size = 0
        self.ids = [np.zeros(0, np.int32) for _ in self.encoders]
        self.first = [np.zeros(1, np.int64) for _ in self.encoders]

    def lookup(self, hashes: np.ndarray, words: Callable[[np.ndarray], list[str]]) -> np.ndarray:
        """A slot per word; ``words(places)`` gives the strings of the words that are new."""
        distinct, where, back = np.unique(hashes, return_index=True, return_inverse=True)
        if self.size + len(distinct) > self.most:
            self._clear()
        at = np.searchsorted(self.keys, distinct)
        known = np.zeros(len(distinct), dtype=bool)
        inside = at < len(self.keys)
        known[inside] = self.keys[at[inside]] == distinct[inside]
        new = np.flatnonzero(~known)
        slot = np.empty(len(distinct), np.int64)
        slot[known] = self.slots[at[known]]
        if len(new):
            strings = words(where[new])
            for v, encode in enumerate(self.encoders):
                lists = encode(strings)
                lengths = np.fromiter(map(len, lists), np.int64, len(lists))
                flat = np.fromiter(chain.from_iterable(lists), np.int32, int(lengths.sum()))
                self.ids[v] = np.concatenate([self.ids[v], flat])
                self.first[v] = np.concatenate([self.first[v], self.first[v][-1] + np.cumsum(lengths)])
            slot[new] = self.size + np.arange(len(new))
            self.size += len(new)
            self.keys = np.insert(self.keys, at[new], distinct[new])
            self.slots = np.insert(self.slots, at[new], slot[new])
        return slot[back]

    def expand(self, slots: np.ndarray, v: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """``(ids, counts)``: the tokens of the words in order, and how many each word has."""
        begin = self.first[v][slots]
        counts = self.first[v][slots + 1] - begin
        ends = np.cumsum(counts)
        total = int(ends[-1]) if len(ends) else 0
        place = np.arange(total) + np.repeat(begin - (ends - counts), counts)
        return self.ids[v][place], counts


_WORKER: dict[str, object] = {}


def per_worker(key: str, make: Callable[[], object]) -> object:
    """Keep one object per Python worker, so that tasks share loaded models."""
    if key not in _WORKER:
        _WORKER[key] = make()
    return _WORKER[key]
