"""Migration-analysis queries on inputs that Spark derives from the test tables.

* Items: one per nation, size = customers of that nation (whole ``customer``).
* Transitions: each hour of ``events`` needs a cluster of 2, 3 or 4 nodes by the
  tercile of its event count; a change between consecutive hours is a
  migration, weighted by how often it happens. The event count is a partial
  aggregate over the whole table; the windows then run over one row per hour.
* Packs: every cut of the item line into as many runs as a state has nodes.
"""

from __future__ import annotations

import itertools
import math
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.ids import pack_pair_id, pair_id_high, pair_id_low
from quarry.operators import gain as G
from quarry.operators import packs as P
from quarry.operators import valueiter as VI
from quarry.operators.ordering import with_position
from quarry.plans.tables import table
from quarry.session import scratch_copy
from quarry.sources.migration import sizes_from_table, validate_transitions

ROUND = 6
ORACLE_SWEEPS = 5


def sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n"))
    return sizes_from_table(counts, "c_nationkey", "n")


def transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    hourly = (table(spark, sf_dir, "events").groupBy(F.date_trunc("hour", "ts").alias("hour"))
              .agg(F.count(F.lit(1)).alias("n")))
    # Terciles and neighbours by distributed position: no window over all hours in one task.
    ranked = with_position(hourly, ["n", "hour"], pos_col="rank")
    hours = ranked.count()
    small, longer = hours // 3, hours % 3  # the first tiles take one more row each
    cut = longer * (small + 1)
    tile = F.when(F.col("rank") < cut, F.floor(F.col("rank") / (small + 1))).otherwise(
        longer + F.floor((F.col("rank") - cut) / max(small, 1)))
    tier = with_position(ranked.select("hour", (tile + 2).cast("int").alias("state")), ["hour"], pos_col="at")
    steps = (tier.select("at", F.col("state").alias("to_state"))
             .join(tier.select((F.col("at") + 1).alias("at"), F.col("state").alias("from_state")), "at"))
    moves = (steps.where(F.col("from_state") != F.col("to_state"))
             .groupBy("from_state", "to_state").agg(F.count(F.lit(1)).cast("double").alias("weight")))
    return validate_transitions(moves.select(F.col("from_state").cast("int"), F.col("to_state").cast("int"),
                                             "weight"))


class Inputs:
    """Sizes, transitions and packs with sizes attached, written once per call.

    Two small results reach the driver: the item count and total (one row) and the
    distinct migrations (one row per unordered pair of states). Pack counts of generated packs are
    binomials of the item count, so the pack table is never counted.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, states: list[int] | None = None):
        self.line = P.item_line(sizes(spark, sf_dir))
        self.n_items, self.total = self.line.n_items, self.line.total
        moves = transitions(spark, sf_dir)
        if states:  # a smaller cluster: the migrations among these states alone
            moves = moves.where(F.col("from_state").isin(states) & F.col("to_state").isin(states))
        self.transitions = scratch_copy(moves, "transitions")
        self.migrations = G.canonical_migrations(self.transitions)
        self.states = sorted({s for pair in self.migrations for s in pair})
        generated = P.generate_packs(self.line, self.states)
        # Generated ids are dense ranks already.
        self.packs = scratch_copy(P.attach_sizes(generated, self.line).withColumn("idx", F.col("pack_id")), "packs")
        self.counts = {k: math.comb(self.n_items - 1, k - 1) if self.n_items >= k else 0 for k in self.states}

    def gains(self) -> DataFrame:
        return G.pair_gains(self.packs, self.migrations, self.total, self.counts)


def pack_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.pack_ranges(Inputs(spark, sf_dir).packs)


def overlap_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    inp = Inputs(spark, sf_dir)
    return G.overlap_weights(inp.packs, inp.migrations, inp.counts)


def overlap_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per run and other state: the runs it meets and the size it shares, by a plane sweep."""
    inp = Inputs(spark, sf_dir)
    return G.overlap_totals(inp.packs, inp.migrations)


def best_partners(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per pack and other state: largest gain, cheapest cost and who gives it, by the tree of cut points."""
    inp = Inputs(spark, sf_dir)
    return G.best_partners(inp.packs, inp.migrations, inp.total)


def pair_id_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    pid = pack_pair_id(F.col("l_partkey"), F.col("l_suppkey"))
    return li.select("l_partkey", "l_suppkey", pid.alias("pair_id"),
                     pair_id_high(pid).alias("hi"), pair_id_low(pid).alias("lo"))


def pair_gain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Inputs(spark, sf_dir).gains().select("from_state", "from_id", "to_state", "to_id", "gain")


def pair_cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.both_directions(Inputs(spark, sf_dir).gains()).select(
        "from_state", "from_id", "to_state", "to_id", "cost")


def sorted_pair_costs(spark: SparkSession, sf_dir: str) -> DataFrame:
    inp = Inputs(spark, sf_dir)
    return G.with_pair_positions(inp.gains(), inp.migrations, inp.counts).select(
        "pos", "from_state", "to_state", "from_id", "to_id", "gain", "cost")


def transition_probs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return VI.transition_probs(transitions(spark, sf_dir)).select(
        "from_state", "to_state", "weight", F.round("p", ROUND).alias("p"))


def _cost_and_probs(inp: Inputs) -> tuple[VI.CostTable, DataFrame]:
    cost = VI.cost_table(inp.gains())
    return cost, VI.transition_probs(inp.transitions)


def bellman_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One synchronous update of every state from V = 0."""
    inp = Inputs(spark, sf_dir)
    cost, probs = _cost_and_probs(inp)
    zero = inp.packs.select("state", "pack_id", F.lit(0.0).alias("v"))
    new = VI.bellman_update(cost, probs, zero)
    return new.select("state", "pack_id", F.round("v", ROUND).alias("v"))


def value_iteration_5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five in-order sweeps (no early stop), every pack of every state."""
    inp = Inputs(spark, sf_dir)
    cost, probs = _cost_and_probs(inp)
    res = VI.value_iteration(cost, probs, inp.packs, max_sweeps=ORACLE_SWEEPS, threshold=None)
    return res.values.select("state", "pack_id", F.round("v", ROUND).alias("v"))


def value_iteration_to_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every state at the job's discount until a sweep changes less than the threshold, or the sweeps run out
    (``converged`` is false then)."""
    inp = Inputs(spark, sf_dir)
    cost, probs = _cost_and_probs(inp)
    res = VI.value_iteration(cost, probs, inp.packs)
    return res.values.select("state", "pack_id", F.round("v", ROUND).alias("v"), F.lit(res.sweeps).alias("sweeps"),
                             F.lit(res.converged).alias("converged"))


QUERIES = {
    "value_iteration_to_threshold": value_iteration_to_threshold,
    "pack_ranges": pack_ranges,
    "overlap_weights": overlap_weights,
    "overlap_totals": overlap_totals,
    "best_partners": best_partners,
    "pair_id_pack": pair_id_pack,
    "pair_gain": pair_gain,
    "pair_cost": pair_cost,
    "sorted_pair_costs": sorted_pair_costs,
    "transition_probs": transition_probs,
    "bellman_step": bellman_step,
    "value_iteration_5": value_iteration_5,
}


# ---------------------------------------------------------------------------
# DuckDB oracles. Packs are enumerated with joins of cut positions, overlaps by
# interval arithmetic on prefix sums, and gains as the maximum over every
# injective mapping of the smaller pack's runs into the larger pack's runs.
# ---------------------------------------------------------------------------

_BASE = """
sizes AS (SELECT c_nationkey AS idx, count(*)::DOUBLE AS size FROM customer GROUP BY c_nationkey),
line AS (SELECT count(*)::INTEGER AS n_items, sum(size) AS total FROM sizes),
prefix_rows AS (SELECT idx + 1 AS pos, sum(size) OVER (ORDER BY idx) AS cum FROM sizes
                UNION ALL SELECT 0, 0.0),
prefix AS (SELECT list(cum ORDER BY pos) AS pre FROM prefix_rows),
hourly AS (SELECT date_trunc('hour', ts) AS hour, count(*) AS n FROM events GROUP BY 1),
tier AS (SELECT hour, ntile(3) OVER (ORDER BY n, hour) + 1 AS state FROM hourly),
steps AS (SELECT lag(state) OVER (ORDER BY hour) AS from_state, state AS to_state FROM tier),
trans AS (SELECT from_state::INTEGER AS from_state, to_state::INTEGER AS to_state, count(*)::DOUBLE AS weight
          FROM steps WHERE from_state IS NOT NULL AND from_state <> to_state GROUP BY 1, 2),
probs AS (SELECT from_state, to_state, weight, weight / sum(weight) OVER (PARTITION BY from_state) AS p FROM trans),
cuts AS (SELECT unnest(range(1, n_items)) AS c FROM line)"""

STATES = (2, 3, 4)


def _pack_cte(k: int) -> str:
    names = [f"c{i}" for i in range(1, k)]
    frm = ", ".join(f"(SELECT c AS {n} FROM cuts) t{n}" for n in names) + ", line"
    conds = " AND ".join(f"{names[i]} < {names[i + 1]}" for i in range(len(names) - 1)) or "TRUE"
    terms = []
    for i, n in enumerate(names, start=1):
        prod = " * ".join(f"({n} - 1 - {x})" for x in range(i))
        fact = 1
        for x in range(2, i + 1):
            fact *= x
        terms.append(f"(({prod}) // {fact})")
    rank = " + ".join(terms) if terms else "0"
    ends = ", ".join(names + ["n_items"])
    return (f"packs{k} AS (SELECT {k} AS state, ({rank})::BIGINT AS pack_id, [{ends}] AS ends "
            f"FROM {frm} WHERE {conds})")


def _cell(a: str, i: int, b: str, j: int) -> str:
    sa = "0" if i == 1 else f"{a}.ends[{i - 1}]"
    sb = "0" if j == 1 else f"{b}.ends[{j - 1}]"
    lo = f"greatest({sa}, {sb})"
    hi = f"least({a}.ends[{i}], {b}.ends[{j}])"
    return f"greatest(0.0, pre[{hi} + 1] - pre[{lo} + 1])"


def _gain_expr(ka: int, kb: int) -> str:
    sums = []
    for perm in itertools.permutations(range(1, kb + 1), ka):
        sums.append(" + ".join(_cell("a", i + 1, "b", perm[i]) for i in range(ka)))
    return sums[0] if len(sums) == 1 else "greatest(" + ", ".join(sums) + ")"


def _migrations_sql() -> str:
    return "migr AS (SELECT DISTINCT least(from_state, to_state) AS lo, greatest(from_state, to_state) AS hi FROM trans)"


@lru_cache(maxsize=1)
def _packs_sql() -> str:
    packs = ",\n".join(_pack_cte(k) for k in STATES)
    allp = " UNION ALL ".join(f"SELECT * FROM packs{k}" for k in STATES)
    return f"{packs},\npacks AS MATERIALIZED ({allp})"


@lru_cache(maxsize=1)
def _gains_sql() -> str:
    parts = []
    for lo, hi in itertools.combinations(STATES, 2):
        parts.append(
            f"SELECT {lo} AS from_state, a.pack_id AS from_id, {hi} AS to_state, b.pack_id AS to_id, "
            f"{_gain_expr(lo, hi)} AS gain FROM packs{lo} a, packs{hi} b, prefix "
            f"WHERE EXISTS (SELECT 1 FROM migr WHERE migr.lo = {lo} AND migr.hi = {hi})")
    body = " UNION ALL ".join(parts)
    return (f"{_migrations_sql()},\ngains AS MATERIALIZED (SELECT g.*, line.total - g.gain AS cost "
            f"FROM ({body}) g, line)")


def _with(*extra: str) -> str:
    return "WITH " + ",\n".join([_BASE.strip(), _packs_sql()] + list(extra))


def _ranges_sql() -> str:
    parts = []
    for k in STATES:
        for s in range(1, k + 1):
            start = "0" if s == 1 else f"ends[{s - 1}]"
            parts.append(f"SELECT state, pack_id, {s - 1} AS slot, ({start})::INTEGER AS start, "
                         f"(ends[{s}] - 1)::INTEGER AS \"end\", "
                         f"pre[ends[{s}] + 1] - pre[{start} + 1] AS size FROM packs{k}, prefix")
    return _with() + "\n" + " UNION ALL ".join(parts)


def _overlaps_sql() -> str:
    parts = []
    for lo, hi in itertools.combinations(STATES, 2):
        for i in range(1, lo + 1):
            for j in range(1, hi + 1):
                sa = "0" if i == 1 else f"a.ends[{i - 1}]"
                sb = "0" if j == 1 else f"b.ends[{j - 1}]"
                parts.append(
                    f"SELECT {lo} AS from_state, a.pack_id AS from_id, {hi} AS to_state, b.pack_id AS to_id, "
                    f"{i - 1} AS from_slot, {j - 1} AS to_slot, {_cell('a', i, 'b', j)} AS weight "
                    f"FROM packs{lo} a, packs{hi} b, prefix "
                    f"WHERE least(a.ends[{i}], b.ends[{j}]) > greatest({sa}, {sb}) "
                    f"AND EXISTS (SELECT 1 FROM migr WHERE migr.lo = {lo} AND migr.hi = {hi})")
    return _with(_migrations_sql()) + "\n" + " UNION ALL ".join(parts)


def _directed_cost_cte() -> str:
    return ("dcost AS MATERIALIZED (SELECT from_state, from_id, to_state, to_id, cost FROM gains "
            "UNION ALL SELECT to_state, to_id, from_state, from_id, cost FROM gains)")


def _update_sql(name: str, s: int, sources: dict[int, str], gamma: float = VI.GAMMA) -> str:
    vals = " UNION ALL ".join(f"SELECT {t} AS state, pack_id, v FROM {src}" for t, src in sorted(sources.items()))
    return (f"{name} AS MATERIALIZED (SELECT m.from_id AS pack_id, sum(pr.p * m.m) AS v FROM "
            f"(SELECT c.from_id, c.to_state, min(c.cost + {gamma} * vv.v) AS m FROM dcost c "
            f"JOIN ({vals}) vv ON c.to_state = vv.state AND c.to_id = vv.pack_id "
            f"WHERE c.from_state = {s} GROUP BY c.from_id, c.to_state) m "
            f"JOIN probs pr ON pr.from_state = {s} AND pr.to_state = m.to_state GROUP BY m.from_id)")


def _value_iteration_sql(sweeps: int) -> str:
    ctes = [_gains_sql(), _directed_cost_cte()]
    current = {}
    for k in STATES:
        ctes.append(f"v{k}_0 AS (SELECT pack_id, 0.0::DOUBLE AS v FROM packs{k})")
        current[k] = f"v{k}_0"
    # A state only updates when it has outgoing transitions; with the derived
    # transitions every state has some, which the Spark side checks at run time.
    for sweep in range(1, sweeps + 1):
        for s in STATES:
            name = f"v{s}_{sweep}"
            ctes.append(_update_sql(name, s, {t: current[t] for t in STATES if t != s}))
            current[s] = name
    final = " UNION ALL ".join(f"SELECT {k} AS state, pack_id, round(v, {ROUND}) AS v FROM {current[k]}"
                               for k in STATES)
    return _with(*ctes) + "\n" + final


def _full_threshold_sql() -> str:
    """Every state in order at the job's discount; the first sweep under the threshold ends it, or the last one allowed."""
    ctes = [_gains_sql(), _directed_cost_cte()]
    current, diffs, kept = {}, [], []
    for k in STATES:
        ctes.append(f"v{k}_0 AS (SELECT pack_id, 0.0::DOUBLE AS v FROM packs{k})")
        current[k] = f"v{k}_0"
    for n in range(1, VI.MAX_SWEEPS + 1):
        before = dict(current)
        for s in STATES:
            name = f"v{s}_{n}"
            ctes.append(_update_sql(name, s, {t: current[t] for t in STATES if t != s}))
            current[s] = name
        change = " + ".join(f"(SELECT sum(abs(a.v - b.v)) FROM {current[s]} a JOIN {before[s]} b USING (pack_id))" for s in STATES)
        diffs.append(f"SELECT {n} AS n, {change} AS diff")
        kept += [f"SELECT {s} AS state, pack_id, v, {n} AS n FROM {current[s]}" for s in STATES]
    ctes += [f"diffs AS ({' UNION ALL '.join(diffs)})",
             f"under AS (SELECT min(n) AS n FROM diffs WHERE diff < {VI.THRESHOLD})",
             f"stop AS (SELECT coalesce(n, {VI.MAX_SWEEPS})::INTEGER AS n, n IS NOT NULL AS converged FROM under)",
             f"swept AS ({' UNION ALL '.join(kept)})"]
    return _with(*ctes) + (f"\nSELECT state, pack_id, round(v, {ROUND}) AS v, stop.n AS sweeps, converged "
                           "FROM swept JOIN stop USING (n)")


def _bellman_sql() -> str:
    ctes = [_gains_sql(), _directed_cost_cte()]
    parts = []
    for k in STATES:
        ctes.append(f"z{k} AS (SELECT pack_id, 0.0::DOUBLE AS v FROM packs{k})")
    for s in STATES:
        ctes.append(_update_sql(f"b{s}", s, {t: f"z{t}" for t in STATES if t != s}))
        parts.append(f"SELECT {s} AS state, pack_id, round(v, {ROUND}) AS v FROM b{s}")
    return _with(*ctes) + "\n" + " UNION ALL ".join(parts)


def transitions_sql() -> str:
    return _with() + "\nSELECT from_state, to_state, weight FROM trans"


def packs_with_runs_sql() -> str:
    """A CTE ``with_runs (state, pack_id, runs)``, runs as comma-separated text."""
    parts = []
    for k in STATES:
        runs = " || ',' || ".join(f"CAST(ends[{s}] - {'0' if s == 1 else f'ends[{s - 1}]'} AS VARCHAR)" for s in range(1, k + 1))
        parts.append(f"SELECT state, pack_id, {runs} AS runs FROM packs{k}")
    return _with(f"with_runs AS ({' UNION ALL '.join(parts)})")


def _overlap_totals_sql() -> str:
    """From every cell of every pair of packs."""
    return (f"WITH cells AS ({_overlaps_sql()}), two_way AS (SELECT from_state, from_id, from_slot, to_state, weight FROM cells "
            "UNION ALL SELECT to_state, to_id, to_slot, from_state, weight FROM cells) "
            "SELECT from_state, from_id, from_slot, to_state, count(*) AS cells, sum(weight) AS shared FROM two_way GROUP BY ALL")


def _best_partners_sql() -> str:
    """From every pair of packs."""
    return _with(_gains_sql()) + (
        ", two_way AS (SELECT from_state, from_id, to_state, to_id, gain, cost FROM gains "
        "UNION ALL SELECT to_state, to_id, from_state, from_id, gain, cost FROM gains)\n"
        "SELECT from_state, from_id, to_state, max(gain) AS gain, min(cost) AS cost, arg_min(to_id, (-gain, to_id)) AS to_id "
        "FROM two_way GROUP BY from_state, from_id, to_state")


def pair_cost_files_sql(n_files: int) -> str:
    return _with(_gains_sql()) + (
        ", placed AS (SELECT *, row_number() OVER (PARTITION BY from_state, to_state ORDER BY from_id, to_id) - 1 AS place, "
        "count(*) OVER (PARTITION BY from_state, to_state) AS size FROM gains), "
        f"dealt AS (SELECT *, CAST(place * least({n_files}, size) // size AS INTEGER) AS file FROM placed)\n"
        "SELECT from_state, to_state, file, count(*) AS n, arg_min(from_id, place) AS first_from, arg_min(to_id, place) AS first_to, "
        "arg_max(from_id, place) AS last_from, arg_max(to_id, place) AS last_to, TRUE AS ordered, "
        f"round(sum(cost), {ROUND}) AS total, max(gain) AS best FROM dealt GROUP BY from_state, to_state, file")


def oracle() -> dict[str, str]:
    return {
        "pack_ranges": _ranges_sql(),
        "overlap_weights": _overlaps_sql(),
        "overlap_totals": _overlap_totals_sql(),
        "best_partners": _best_partners_sql(),
        "pair_id_pack": ("SELECT l_partkey, l_suppkey, (l_partkey << 32) | (l_suppkey & 4294967295) AS pair_id, "
                         "((l_partkey << 32) | (l_suppkey & 4294967295)) >> 32 AS hi, "
                         "((l_partkey << 32) | (l_suppkey & 4294967295)) & 4294967295 AS lo FROM lineitem"),
        "pair_gain": _with(_gains_sql()) + "\nSELECT from_state, from_id, to_state, to_id, gain FROM gains",
        "pair_cost": _with(_gains_sql(), _directed_cost_cte()) + "\nSELECT * FROM dcost",
        "sorted_pair_costs": _with(_gains_sql()) + (
            "\nSELECT row_number() OVER (ORDER BY from_state, to_state, from_id, to_id) - 1 AS pos, "
            "from_state, to_state, from_id, to_id, gain, cost FROM gains"),
        "transition_probs": _with() + f"\nSELECT from_state, to_state, weight, round(p, {ROUND}) AS p FROM probs",
        "value_iteration_to_threshold": _full_threshold_sql(),
        "bellman_step": _bellman_sql(),
        "value_iteration_5": _value_iteration_sql(ORACLE_SWEEPS),
    }
