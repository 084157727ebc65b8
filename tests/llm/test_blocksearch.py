import random

import numpy as np
from pyspark.sql import functions as F

from quarry.llm.blocksearch import Rule, encode, nearest

SCHEMA = "vec_id long, embedding array<double>"


def _brute(rows, k=20, divisor=20):
    good = [(i, v) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    out = []
    for a, (i, v) in enumerate(good):
        if i % divisor:
            continue
        scored = []
        for b, (j, w) in enumerate(good):
            if a != b and len(v) == len(w):
                total = 0.0
                for x, y in zip(v, w):
                    total += x * y
                scored.append((-total, j))
        out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(sorted(scored)[:k])]
    return sorted(out)


def _rows(n, dim, seed, step=None):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, dim))
    if step:
        x = np.round(x * step) / step
    return [(i, [float(c) for c in v]) for i, v in enumerate(x)]


def _got(frame, rows, rule=None, schema=SCHEMA):
    return sorted(tuple(r) for r in nearest(frame(rows, schema), rule=rule).select("query_id", "rank", "vec_id", "score").collect())


def test_equal_to_brute_force_over_blocks_and_stripes(frame):
    rows = _rows(400, 12, 1)
    assert _got(frame, rows, Rule(query_block=6, stripe=50, tile=16)) == _brute(rows)


def test_ties_copies_and_a_common_vector(frame):
    rows = _rows(150, 3, 2, step=2)
    rows += [(1000 + i, [0.5, -0.5, 1.0]) for i in range(130)]  # nearly half of the rows
    rows += [(1000, [0.5, -0.5, 1.0]), (40, rows[40][1]), (41, rows[41][1])]  # repeated rows
    random.Random(1).shuffle(rows)
    assert _got(frame, rows, Rule(query_block=5, stripe=30, tile=64)) == _brute(rows)


def test_odd_rows(frame):
    rows = [(0, [1.0, 2.0]), (1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [float("nan"), 1.0]),
            (6, [float("inf"), 1.0]), (None, [9.0, 9.0]), (7, [1.0, 1.0]), (8, [1.0, 1.0, 1.0]), (20, [-1e-300, 1e-300]),
            (40, [1e-320, 0.0]), (9, [-3.0, 1e5]), (60, [1.0, 1.0, 2.0])]
    assert _got(frame, rows) == _brute(rows)


def test_few_candidates_extra_columns_and_none(frame):
    df = frame([(0, [1.0], "r"), (20, [2.0], "s"), (5, [3.0], None)], SCHEMA + ", row string").withColumn("node", F.lit("mine"))
    got = sorted(tuple(r) for r in nearest(df).collect())
    assert got == [(0, 1, 5, 3.0), (0, 2, 20, 2.0), (20, 1, 5, 6.0), (20, 2, 0, 2.0)]
    assert nearest(df.where("vec_id < 0")).collect() == []
    assert nearest(frame([(20, [1.0])], SCHEMA)).collect() == []


def test_overflowing_scores(frame):
    rows = [(0, [1e200, 1.0]), (1, [1e200, 0.0]), (2, [-1e200, 0.0]), (3, [1.0, 0.0])]
    got = _got(frame, rows)
    assert [(r[1], r[2]) for r in got] == [(1, 1), (2, 3), (3, 2)] and got[0][3] == float("inf")


def test_bounds_hold():
    rng = np.random.default_rng(5)
    x = rng.standard_normal((300, 24)) * 10.0 ** rng.integers(-6, 6, (300, 1))
    code, scale, norm, said, off = encode(x)
    about = (code.astype(int) @ code.T.astype(int)) * scale[:, None] * scale
    bound = said[:, None] * off + off[:, None] * norm
    assert (np.abs(x @ x.T - about) <= bound + 1e-9 * norm[:, None] * norm).all()
