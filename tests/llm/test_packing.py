import random
import zlib

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from quarry.llm.packing import Plan, Rule, pack, token_ids

RULE = Rule()
PARTS = ["a", "bc", "'s", " ", "  ", "\n", "\t", " ", "\x85", "\x1c", "<|endoftext|>", "é", "漢", "12", "!!", " ", "　",
         "​", "don't", "\r\n", "I'LL", " ", "’"]


def whole(texts):
    return [e.ids for e in Tokenizer.from_file(RULE.vocabulary).encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_unit_ids_are_the_tokenizers_own():
    rng = random.Random(3)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 30))) for _ in range(2000)] + ["", "x", " ", " x ", "word " * 99]
    ids, cuts = token_ids(pa.array(texts), RULE)
    for i, ref in enumerate(whole(texts)):
        assert ids[cuts[i]:cuts[i + 1]].tolist() == ref, texts[i]


def checked(counts, rule=RULE, groups=64):
    plan = Plan(counts, rule, groups)
    filled, seen = np.zeros(plan.sequences, np.int64), dict.fromkeys(counts, 0)
    spans = {}
    for size, rank, count, sequence, each, offset in plan.runs:
        assert rank == seen[size]
        seen[size] += count
        for k in range(count):
            s, o = sequence + k // each, offset + k % each * size
            spans.setdefault(s, []).append((o, size))
            filled[s] += size
    assert seen == counts and (filled <= rule.capacity).all() and (filled > 0).all()
    for parts in spans.values():
        at = 0
        for o, size in sorted(parts):
            assert o == at
            at += size
    return plan.sequences, -(-sum(s * n for s, n in counts.items()) // rule.capacity)


def test_plans_are_valid_and_close_to_the_bound():
    rng = np.random.default_rng(1)
    for sizes, slack in ((rng.integers(1, 1025, 20000), 1.02), (np.minimum(1024, rng.lognormal(5, 1, 20000).astype(int) + 1), 1.01),
                         (rng.integers(1, 60, 5000), 1.01), (np.full(1000, 512), 1.0), (np.full(1000, 300), 1.2), ([1024] * 5, 1.0)):
        values, n = np.unique(sizes, return_counts=True)
        counts = dict(zip(values.tolist(), n.tolist(), strict=True))
        best = min(checked(counts, groups=g)[0] for g in RULE.groups)
        bound = checked(counts)[1]
        assert best <= slack * bound + 1, (best, bound)
    assert checked({}) == (0, 0) and checked({513: 7}) == (7, 4) and checked({1: 3}) == (1, 1)


def test_pack_against_whole_texts(frame, hard):
    rng = random.Random(5)
    texts = [" ".join(f"w{rng.randint(0, 500)}" for _ in range(rng.choice([0, 3, 90, 400, 1500]))) for _ in range(60)]
    texts += [None, "", "x " * 1023, "x " * 1022, texts[0], texts[0]]
    df = frame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, length int").repartition(3)
    rows = pack(df).collect()
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    for i, ids in enumerate(whole(texts)):
        ids = ids + [2]
        parts = sorted(by[i], key=lambda r: r.piece)
        assert [r.piece for r in parts] == list(range(len(parts))) and [r.length for r in parts[1:]] == [1024] * (len(parts) - 1)
        at = 0
        for r in parts:
            assert r.start == at and r.ids_crc32 == zlib.crc32(np.array(ids[at:at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids) and (len(parts) == 1 or len(ids) > 1024)
    spans = {}
    for r in rows:
        spans.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in spans.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024


def test_hard_rows(hard, none):
    rows = pack(hard).collect()
    assert {r.doc_id for r in rows} == {r.doc_id for r in hard.collect()}
    assert sum(r.length for r in rows if r.doc_id == 7) == 2 * sum(r.length for r in rows if r.doc_id == 6)
    assert pack(none).count() == 0
