import itertools
import random

import pytest

from quarry.operators.assignment import SMALL, max_weight_assignment


def _edges(spark, cells):
    return spark.createDataFrame([(g, str(x), str(y), float(w)) for g, x, y, w in cells],
                                 "grp INT, x STRING, y STRING, weight DOUBLE")


def _matrix(g, m):
    return [(g, i, j, w) for i, row in enumerate(m) for j, w in enumerate(row)]


def test_fixture_cases(spark):
    cells = (_matrix(0, [[4, 3], [3, 0]]) + _matrix(1, [[1, 7, 2]]) + _matrix(2, [[-1, -1], [-1, -1]])
             + _matrix(3, [[0]]))
    pairs, totals = max_weight_assignment(_edges(spark, cells))
    got = {r.grp: (r.total, r.n_pairs) for r in totals.collect()}
    assert got == {0: (6.0, 2), 1: (7.0, 1), 2: (-2.0, 2), 3: (0.0, 1)}
    assert pairs.where("grp = 1").first().y == "1"


def _brute(cells):
    xs = sorted({c[1] for c in cells})
    ys = sorted({c[2] for c in cells})
    w = {(c[1], c[2]): c[3] for c in cells}
    if len(xs) <= len(ys):
        return max(sum(w.get((x, p[i]), 0.0) for i, x in enumerate(xs)) for p in itertools.permutations(ys, len(xs)))
    return max(sum(w.get((p[j], y), 0.0) for j, y in enumerate(ys)) for p in itertools.permutations(xs, len(ys)))


@pytest.mark.parametrize("small", [SMALL, 0])
def test_random_groups_against_brute_force(spark, small):
    """By subsets, and by bids and paths."""
    rnd = random.Random(3)
    cells = []
    for g in range(12):
        nx, ny = rnd.randint(1, 4), rnd.randint(1, 6)
        for x in range(nx):
            for y in range(ny):
                if rnd.random() < 0.7:            # absent cells count as 0
                    cells.append((g, f"x{x}", f"y{y}", rnd.randint(-5, 9)))
    _, totals = max_weight_assignment(_edges(spark, cells), small=small)
    got = {r.grp: r.total for r in totals.collect()}
    for g in {c[0] for c in cells}:
        assert got[g] == pytest.approx(_brute([c for c in cells if c[0] == g])), g


def test_duplicates_and_nulls_are_errors(spark):
    for cells in ([(0, "a", "b", 1.0), (0, "a", "b", 1.0)], [(0, "a", "b", None)], [(0, None, "b", 1.0)],
                  [(0, "a", "b", float("nan"))]):
        df = spark.createDataFrame(cells, "grp INT, x STRING, y STRING, weight DOUBLE")
        with pytest.raises(Exception):
            max_weight_assignment(df)[1].collect()


def test_types_are_kept_and_may_differ(spark):
    df = spark.createDataFrame([(None, 1, "p", 3.0), (None, 2, "p", 5.0), (7, 1, "q", -1.0)],
                               "grp INT, x INT, y STRING, weight DOUBLE")
    pairs, totals = max_weight_assignment(df)
    assert dict(pairs.dtypes) == {"grp": "int", "x": "int", "y": "string", "weight": "double"}
    assert sorted(map(tuple, pairs.collect()), key=str) == [(7, 1, "q", -1.0), (None, 2, "p", 5.0)]
    assert {r.grp: (r.total, r.n_pairs) for r in totals.collect()} == {None: (5.0, 1), 7: (-1.0, 1)}


def test_large_sides(spark):
    """Weights a_x * b_y: the best matching pairs both sides in rank order."""
    rnd = random.Random(4)
    a = [rnd.randint(1, 50) for _ in range(14)]
    b = [rnd.randint(1, 50) for _ in range(19)]
    cells = [(0, x, y, a[x] * b[y]) for x in range(14) for y in range(19)]
    pairs, totals = max_weight_assignment(_edges(spark, cells))
    best = sum(u * v for u, v in zip(sorted(a, reverse=True), sorted(b, reverse=True)))
    assert totals.first().total == best
    rows = pairs.collect()
    assert len({r.x for r in rows}) == 14 and len({r.y for r in rows}) == 14


def _hungarian(w):
    """Maximum total of a square matrix, by shortest augmenting paths in plain Python."""
    n = len(w)
    big = max(map(max, w))
    u, v, way, p = [0] * (n + 1), [0] * (n + 1), [0] * (n + 1), [0] * (n + 1)
    for i in range(1, n + 1):
        p[0], j0 = i, 0
        least, used = [float("inf")] * (n + 1), [False] * (n + 1)
        while True:
            used[j0] = True
            i0, delta, j1 = p[j0], float("inf"), 0
            for j in range(1, n + 1):
                if not used[j]:
                    cur = big - w[i0 - 1][j - 1] - u[i0] - v[j]
                    if cur < least[j]:
                        least[j], way[j] = cur, j0
                    if least[j] < delta:
                        delta, j1 = least[j], j
            for j in range(n + 1):
                if used[j]:
                    u[p[j]] += delta
                    v[j] -= delta
                else:
                    least[j] -= delta
            j0 = j1
            if not p[j0]:
                break
        while j0:
            p[j0] = p[way[j0]]
            j0 = way[j0]
    return sum(w[p[j] - 1][j - 1] for j in range(1, n + 1))


def test_large_square_group_beside_small_ones(spark):
    """300 x 300 in one group, its cells over all tasks; other groups in the same jobs."""
    rnd = random.Random(8)
    w = [[rnd.randint(0, 1000) for _ in range(300)] for _ in range(300)]
    cells = _matrix(0, w) + _matrix(1, [[4, 3], [3, 0]]) + _matrix(2, [[1, 7, 2]])
    pairs, totals = max_weight_assignment(_edges(spark, cells))
    got = {r.grp: (r.total, r.n_pairs) for r in totals.collect()}
    assert got == {0: (_hungarian(w), 300), 1: (6.0, 2), 2: (7.0, 1)}
    rows = pairs.where("grp = 0").collect()
    assert len({r.x for r in rows}) == len({r.y for r in rows}) == 300
    assert all(r.weight == w[int(r.x)][int(r.y)] for r in rows)


def test_weights_that_are_no_whole_numbers(spark):
    rnd = random.Random(9)
    cells = [(g, x, y, rnd.uniform(-1, 1) * 10 ** rnd.randint(-3, 3)) for g in range(6) for x in range(4) for y in range(5)]
    totals = max_weight_assignment(_edges(spark, cells))[1].collect()
    for r in totals:
        assert r.total == pytest.approx(_brute([c for c in cells if c[0] == r.grp]), rel=1e-9)


def test_no_task_or_driver_holds_a_group(spark):
    """Nothing of the library's assignment leaves the JVM, in any job it runs while it is built."""
    import inspect

    from quarry.operators import assignment, auction
    for module in (assignment, auction):
        source = inspect.getsource(module)
        assert not any(word in source for word in ("applyIn", "mapIn", "udf", "numpy", "pandas", ".rdd"))


def test_steps_that_run_out_are_an_error(spark):
    from quarry.operators.auction import Rounds, best_matching
    cells = spark.createDataFrame([(0, x, y, w) for x, y, w in ((0, 0, 9), (0, 1, 8), (1, 0, 9), (1, 1, 1), (2, 0, 8), (2, 1, 7), (2, 2, 0),
                                                                   (0, 2, 0), (1, 2, 0))], "grp BIGINT, x BIGINT, y BIGINT, w BIGINT")
    with pytest.raises(RuntimeError, match="not finished"):
        best_matching(cells, 4, Rounds(steps=0))
    unfit = spark.createDataFrame([(0, 0, 0, 5), (0, 1, 0, 4)], "grp BIGINT, x BIGINT, y BIGINT, w BIGINT")
    with pytest.raises(RuntimeError, match="no element"):
        best_matching(unfit, 4)
    assert max_weight_assignment(spark.createDataFrame([], "grp INT, x STRING, y STRING, weight DOUBLE"))[1].collect() == []
