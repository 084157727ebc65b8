import random
import re

import numpy as np
import pyarrow as pa

from quarry.llm import oddsketch
from quarry.llm.oddsketch import Rule, _bands, _samples, _sketch, estimate, near_duplicates, shingle_sets

PATTERN = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def brute(rows):
    sets = []
    for _, text in rows:
        w = PATTERN.findall(lower(text))
        sets.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    out = []
    for i, (d, _) in enumerate(rows):
        out.append((d, len(sets[i]), min(rows[j][0] for j in range(len(rows)) if find(j) == find(i))))
    return sorted(out)


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: f"w{rng.randint(0, 3000)}"
    rows = []
    for _ in range(25):
        base = [word() for _ in range(rng.choice([3, 8, 30, 120, 300]))]
        for _ in range(rng.choice([1, 1, 2, 6, 20])):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 5, 12])):
                copy[rng.randrange(len(copy))] = word()
            rows.append((rng.choice(["  ", " ", "\n"]).join(copy)).title() if rng.random() < 0.3 else " ".join(copy))
    # A chain: each close to the next, the ends far apart.
    chain = [word() for _ in range(100)]
    for i in range(12):
        rows.append(" ".join(chain[i * 2:i * 2 + 80]))
    rows += [None, "", "a b", "A  b", "x " * 5000]
    rng.shuffle(rows)
    return list(enumerate(rows))


def test_against_brute_force(frame):
    for seed, rule in ((1, Rule()), (2, Rule(block=4)), (3, Rule(block=3))):
        rows = corpus(seed)
        got = near_duplicates(frame(rows, "doc_id long, text string").repartition(4), rule=rule).collect()
        assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute(rows)
        assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_sketch_estimates_high_similarity():
    rule = Rule()
    rng = np.random.default_rng(0)
    for same in (0.6, 0.75, 0.9, 0.97):
        errors, collided = [], 0
        for _ in range(150):
            n = 500
            both = int(round(2 * n * same / (1 + same)))
            a = rng.integers(0, 2**63, 2 * n - both).astype(np.uint64)
            x, y = _samples(a[:n], rule.k), _samples(a[n - both:], rule.k)
            bits = int(np.bitwise_count(_sketch(x, rule.bits) ^ _sketch(y, rule.bits)).sum())
            errors.append(estimate(bits, rule) - same)
            collided += bool((_bands(x, rule.rows) == _bands(y, rule.rows)).any())
            assert same < 0.74 or bits <= oddsketch._most_bits(rule)
        assert abs(np.mean(errors)) < 0.03 and np.std(errors) < 0.09
        assert same < 0.74 or collided == 150


def test_long_sets_in_steps():
    s = np.arange(10000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    assert (_samples(s, 16) == _samples(s, 16, step=777)).all()
    assert [len(x) for x in shingle_sets(pa.array(["a b c d e f", "A B c d e f a b c d e f", "a", None, ""]), 5)] == [2, 6, 1, 0, 0]


def test_hard_rows(hard, none):
    got = near_duplicates(hard).collect()
    assert len(got) == hard.count()
    by = {(r.doc_id, r.n_shingles): r for r in got}
    assert by[(7, 3)].component_id == 6 and not by[(7, 3)].kept and by[(0, 0)].kept
    assert by[(None, 3)].component_id is None and by[(None, 3)].kept
    assert near_duplicates(none).count() == 0


def test_null_ids_and_ids_of_several_texts(frame):
    one = " ".join(f"word{i}" for i in range(60))
    two = " ".join(f"other{i}" for i in range(60))
    rows = [(1, one), (None, one), (5, one + " more"), (5, two), (7, two), (9, "alone with a text of its own here"), (9, two + " end")]
    got = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_duplicates(frame(rows, "doc_id long, text string")).collect()), key=str)
    assert got == sorted([(1, 56, 1, True), (None, 56, None, True), (5, 57, 1, False), (5, 56, 5, True), (7, 56, 5, False),
                          (9, 4, 9, True), (9, 57, 5, False)], key=str)
