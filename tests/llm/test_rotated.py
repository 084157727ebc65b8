import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm.rotated import MOST, Rotation, Rule, assign, cluster

SCHEMA = "vec_id long, embedding array<double>"


def _brute(rows, rule):
    kept = [(i, [int(np.floor(rule.scale * x)) for x in v]) for i, v in rows
            if v is not None and len(v) == rule.dims and None not in v and np.isfinite(v).all()]
    key = lambda r: (r[0] is None, hashlib.sha256(f"{rule.seed}:{r[0]}".encode()).hexdigest())
    centroids = [v for _, v in sorted(kept, key=key)[:rule.clusters]]

    def told():
        out = []
        for _, v in kept:
            d = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in centroids]
            out.append((d.index(min(d)), min(d)))
        return out

    for _ in range(rule.rounds):
        got = told()
        for c in range(len(centroids)):
            mine = [v for (_, v), (k, _) in zip(kept, got) if k == c]
            if mine:
                centroids[c] = [sum(col) // len(mine) for col in zip(*mine)]
    got = told()
    per = {c: sum(d for k, d in got if k == c) for c in range(len(centroids))}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, k, d, per[k], sum(per.values()), digest[k]) for (i, _), (k, d) in zip(kept, got)), key=str)


def _got(frame, rows, rule):
    return sorted((tuple(r) for r in cluster(frame(rows, SCHEMA), rule=rule).select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256").collect()), key=str)


def _rows(n, dim, seed, step=8):
    x = np.round(np.random.default_rng(seed).standard_normal((n, dim)) * step) / step
    return [(i, [float(c) for c in v]) for i, v in enumerate(x)]


def test_equal_to_brute_force(frame):
    rule = Rule(clusters=7, rounds=4, dims=6, scale=16, lead=2)
    rows = _rows(300, 6, 1)
    assert _got(frame, rows, rule) == _brute(rows, rule)


def test_ties_copies_and_empty_clusters(frame):
    rule = Rule(clusters=12, rounds=3, dims=2, scale=1, lead=1)
    rows = [(i, [float(i % 3), 0.0]) for i in range(90)] + [(500, [2.0, 0.0])]
    assert _got(frame, rows, rule) == _brute(rows, rule)


def test_odd_rows(frame):
    rule = Rule(clusters=40, rounds=2, dims=2, scale=256)
    rows = [(0, [0.5, 0.25]), (1, None), (2, []), (3, [1.0]), (4, [None, 1.0]), (5, [float("nan"), 0.0]),
            (6, [float("-inf"), 0.0]), (None, [0.1, 0.2]), (7, [-0.001, 0.0]), (8, [0.0, 0.0])]
    got = _got(frame, rows, rule)
    assert got == _brute(rows, rule) and [g[0] for g in got] == [0, 7, 8, None]


def test_extra_columns_none_and_too_large(frame):
    df = frame([(0, [0.5])], SCHEMA).withColumn("ints", F.lit("mine")).withColumn("cluster", F.lit("mine"))
    assert [(r.vec_id, r.cluster, r.distance) for r in cluster(df, rule=Rule(dims=1)).collect()] == [(0, 0, 0)]
    empty = cluster(df.where("false"), rule=Rule(dims=1))
    assert empty.collect() == [] and empty.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    with pytest.raises(Exception, match=str(MOST)):
        cluster(frame([(0, [1e30])], SCHEMA), rule=Rule(dims=1)).collect()


def test_bound_leaves_out_most_centroids_and_never_the_nearest():
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((20, 64)) * 60
    ints = np.floor(centres[rng.integers(0, 20, 2000)] + rng.standard_normal((2000, 64)) * 8).astype(np.int64)
    _, axes = np.linalg.eigh(np.cov(ints.T))
    rotation = Rotation(ints.mean(axis=0), np.ascontiguousarray(axes[:, ::-1][:, :16]))
    centroids = np.floor(centres).astype(np.int64)
    number, distance, measured = assign(ints, *rotation.split(ints), centroids, rotation)
    every = ((ints[:, None, :] - centroids) ** 2).sum(axis=2)
    assert (number == every.argmin(axis=1)).all() and (distance == every.min(axis=1)).all()
    assert measured < 2 * len(ints)


def test_jobs_do_not_grow_with_partitions(spark, frame):
    rule = Rule(clusters=3, rounds=4, dims=2, lead=1)
    rows = _rows(40, 2, 5)
    held = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in held}
    begun = spark.sparkContext._jsc.sc().dagScheduler().nextJobId()
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        assert _got(frame, rows, rule) == _brute(rows, rule)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert spark.sparkContext._jsc.sc().dagScheduler().nextJobId() - begun < 40
