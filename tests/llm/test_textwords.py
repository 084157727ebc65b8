import random
import re

import numpy as np
import pyarrow as pa

from quarry.llm import keycounts
from quarry.llm.textwords import Words, pieces, sliding_min, window_hashes

PATTERN = re.compile(r"[^\x20\x09-\x0D]+")


def texts(seed, n=300):
    rng = random.Random(seed)
    parts = ["a", "b", "ab", "é", "漢", " ", "\n", "\t", "  ", " ", "long" * 20, "long" * 40, "\x1c"]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(n)] + [None, ""]


def test_words_match_the_pattern():
    t = texts(1)
    for arr in (pa.array(t), pa.array(["zz"] + t).slice(1), pa.chunked_array([t[:7], t[7:]])):
        w = Words(arr)
        every = w.strings(np.arange(len(w.start)))
        for i, s in enumerate(t):
            assert every[w.first[i]:w.first[i + 1]] == PATTERN.findall(s or "")


def test_hashes_tell_words_apart():
    w = Words(pa.array(texts(2)))
    seen = {}
    for s, h in zip(w.strings(np.arange(len(w.start))), w.hashes().tolist(), strict=True):
        assert seen.setdefault(s, h) == h
    assert len(set(seen.values())) == len(seen)


def test_window_hashes_and_minimum():
    rng = np.random.default_rng(0)
    h = rng.integers(0, 5, 200).astype(np.uint64)
    for k in (1, 2, 3, 5, 8, 35):
        got = window_hashes(h, k)
        seen = {}
        for i, x in enumerate(got.tolist()):
            assert seen.setdefault(tuple(h[i:i + k]), x) == x
        assert len(set(seen.values())) == len(seen)
        assert sliding_min(h, k).tolist() == [h[i:i + k].min() for i in range(len(h) - k + 1)]
    assert len(window_hashes(h, 201)) == 0


def test_pieces_keep_all_rows_in_order():
    t = pa.RecordBatch.from_pydict({"text": ["x" * n for n in (0, 5, 100, 3, 0, 7, 50)] + [None]})
    got = list(pieces([t.slice(0, 3), t.slice(3), t.slice(0, 0)], "text", 20))
    assert [x for b in got for x in b.column("text").to_pylist()] == t.column("text").to_pylist()
    assert all(b.num_rows == 1 or sum(len(x or "") for x in b.column("text").to_pylist()[:-1]) < 20 for b in got)


def test_blocks_round_trip():
    keys = np.unique(np.random.default_rng(3).integers(0, 2**63, 1000).astype(np.uint64) * np.uint64(2))
    space = keycounts.Space(16, 64)
    table = keycounts.blocks_of(5, keys, np.arange(len(keys)), space)
    back = [np.cumsum(keycounts.from_planes(k.as_buffer(), np.uint64), dtype=np.uint64) for k in table["_keys"]]
    assert np.concatenate(back).tolist() == keys.tolist()
    assert [b for b, p in zip(table["_bucket"].to_pylist(), back, strict=True) for _ in p] == (keys >> np.uint64(60)).tolist()
    assert np.concatenate([keycounts.from_planes(c.as_buffer(), np.uint32) for c in table["_counts"]]).tolist() == list(range(len(keys)))


def test_key_space():
    assert keycounts.Space.of(0).buckets == 8 and keycounts.Space.of(2**40).bits == 64 and keycounts.Space.of(2**20).bits == 50
    keys = np.array([1 << 63, (1 << 63) + 1, 5], np.uint64)
    assert keycounts.Space(8, 32).cut(keys).tolist() == [1 << 31, 1 << 31, 0]
