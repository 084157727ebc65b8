"""Transition probabilities, the Bellman update, and discounted value iteration.

V_s(i) = sum_t p(s->t) * min_j (cost(i, j) + gamma * V_t(j))

One path for every size. The cost table holds each unordered migration once, on shared storage. The
loop lays it out once per state: the messages that an update of the state reads, partitioned and sorted by
the pack that sends them, ``(to_state, to_id)``, and cached. Besides the costs, every pack sends its own value
to itself, so an update is a function of V alone: it carries the packs of all other states along. V comes out
of an update partitioned by ``(state, pack_id)``, which is how the next one reads it. An update is therefore
a merge join without an exchange, a partial minimum, and one exchange of a row per pack and
task; several sweeps of updates go into one job, and V is written to shared storage between jobs. A sweep's
change per state travels with the rows and is summed by the job's observation. If a sweep in the middle
of a job meets the threshold, the job is run again up to that sweep.

Only observed scalars, and the transition table's few rows, reach the driver. Nothing is broadcast.

In-order sweeps (the default) refresh states in ascending order, each seeing
values already refreshed in the same sweep; ``mode='synchronous'`` updates
every state from the previous sweep at once. Both converge to the same fixed
point (the update is a gamma-contraction). A state without outgoing
transitions is absorbing and keeps V = 0.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from quarry.session import drop_scratch, scratch_table_path

# Fixed values of the job: discount, sweep cap, stop threshold on the summed
# absolute change of one sweep, initial value.
GAMMA = 0.9
MAX_SWEEPS = 60
THRESHOLD = 5.0
INITIAL_VALUE = 0.0

# Sweeps in one job: longer plans cost more to re-plan between their stages than the jobs they save.
SWEEPS_PER_JOB = 2


def transition_probs(transitions: DataFrame) -> DataFrame:
    """``(from_state, to_state, weight, p)`` with p = weight / sum of weights leaving the state."""
    total = F.sum("weight").over(Window.partitionBy("from_state"))
    return transitions.withColumn("p", F.col("weight") / total)


@dataclass
class CostTable:
    """Costs of unordered migrations (``from_state < to_state``), one directory per pair of states."""

    path: str
    stored: DataFrame

    def leaving(self, states: list[int] | None = None) -> DataFrame:
        """``from_state, from_id, to_state, to_id, cost`` in both directions, of the given from-states."""
        columns = ["from_state", "from_id", "to_state", "to_id", "cost"]
        swapped = self.stored.select(F.col("to_state").alias("from_state"), F.col("to_id").alias("from_id"),
                                     F.col("from_state").alias("to_state"), F.col("from_id").alias("to_id"), "cost")
        if states is None:
            return self.stored.select(*columns).unionByName(swapped)
        return (self.stored.where(F.col("from_state").isin(states)).select(*columns)
                .unionByName(swapped.where(F.col("from_state").isin(states))))

    def drop(self) -> None:
        drop_scratch(self.stored.sparkSession, self.path)


def cost_table(costs: DataFrame) -> CostTable:
    """Write the costs of unordered migrations once to the shared checkpoint directory.

    Files on shared storage survive executor loss; an update prunes to the directories
    of its state. ``drop()`` removes them.
    """
    spark = costs.sparkSession
    path = scratch_table_path(spark, "cost")
    (costs.select("from_state", "from_id", "to_state", "to_id", "cost")
     .write.partitionBy("from_state", "to_state").parquet(path))
    schema = "from_id BIGINT, to_id BIGINT, cost DOUBLE, from_state INT, to_state INT"
    return CostTable(path, spark.read.schema(schema).parquet(path))


def bellman_update(cost: CostTable, probs: DataFrame, values: DataFrame, gamma: float = GAMMA,
                   from_state: int | None = None) -> DataFrame:
    """``(state, pack_id, v)`` after one update of ``from_state`` (or of every state
    with outgoing transitions when None), reading target values from ``values``."""
    c = cost.leaving(None if from_state is None else [from_state])
    v = values.select(F.col("state").alias("to_state"), F.col("pack_id").alias("to_id"), F.col("v"))
    p = probs.select("from_state", "to_state", "p")
    if from_state is not None:
        p = p.where(F.col("from_state") == from_state)
    best = (c.join(v, ["to_state", "to_id"])
            .groupBy("from_state", "from_id", "to_state")
            .agg(F.min(F.col("cost") + F.lit(gamma) * F.col("v")).alias("m")))
    return (best.join(p, ["from_state", "to_state"])
            .groupBy("from_state", "from_id")
            .agg(F.sum(F.col("p") * F.col("m")).alias("v"))
            .select(F.col("from_state").alias("state"), F.col("from_id").alias("pack_id"), "v"))


@dataclass
class IterationResult:
    """``converged`` is false if the sweeps ran out before the change fell below the threshold."""

    values: DataFrame
    sweeps: int
    last_diff: float
    diffs: list[float] = field(default_factory=list)
    converged: bool = False


def _check_costs(cost: CostTable, transitions: list[tuple[int, int]], counts: dict[int, int]) -> None:
    """Every transition needs a cost for every pack against every pack of its target."""
    rows = cost.stored.groupBy("from_state", "to_state").agg(
        F.count(F.lit(1)).alias("n"), F.count("cost").alias("costs")).collect()
    have = {(r["from_state"], r["to_state"]): min(r["n"], r["costs"]) for r in rows}
    for a, b in transitions:
        got, want = have.get((min(a, b), max(a, b)), 0), counts[a] * counts[b]
        if got != want:
            raise ValueError(f"migration {a} -> {b}: {got} costs, expected {want}")


class _Messages:
    """What the updates of one state, or of several at once, read from V: costs of their migrations, and every pack
    to itself. Laid out by sender, the key that V comes by, and cached on top of the cost files."""

    def __init__(self, cost: CostTable, packs: DataFrame, updated: list[int], states: list[int], p: dict[tuple[int, int], float],
                 gamma: float):
        self.updated, self.states, self.p = updated, states, p
        wanted = F.lit(False)
        for a, t in p:
            if a in updated:
                wanted = wanted | ((F.col("from_state") == a) & (F.col("to_state") == t))
        moves = cost.leaving(updated).where(wanted).withColumn("share", F.lit(gamma))
        own = packs.select(F.col("state").alias("from_state"), F.col("pack_id").alias("from_id"), F.col("state").alias("to_state"),
                           F.col("pack_id").alias("to_id"), F.lit(0.0).alias("cost"), F.lit(1.0).alias("share"))
        parts = int(packs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        by_sender = ["to_state", "to_id"]
        self.rows = (moves.select(*own.columns).unionByName(own).repartition(parts, *by_sender).sortWithinPartitions(*by_sender)
                     .persist(StorageLevel.MEMORY_AND_DISK))

    def update(self, values: DataFrame, sweep: str, sweeps: list[str]) -> DataFrame:
        """``values`` (``state, pack_id, v`` and the change of each sweep of the job) after the update."""
        sent = values.withColumnsRenamed({"state": "to_state", "pack_id": "to_id"})
        own = F.col("to_state") == F.col("from_state")
        least = [F.min(F.when(F.col("to_state") == t, F.col("cost") + F.col("share") * F.col("v"))).alias(f"_m{t}") for t in self.states]
        kept = [F.min(F.when(own, F.col(d))).alias(d) for d in sweeps]
        got = self.rows.join(sent, ["to_state", "to_id"]).groupBy("from_state", "from_id").agg(*least, *kept)
        old = new = F.coalesce(*[F.when(F.col("from_state") == t, F.col(f"_m{t}")) for t in self.states])
        for s in self.updated:
            terms = [F.lit(q) * F.col(f"_m{t}") for (a, t), q in sorted(self.p.items()) if a == s]
            total = terms[0]
            for term in terms[1:]:
                total = total + term
            new = F.when(F.col("from_state") == s, total).otherwise(new)
        change = F.when(F.col("from_state").isin(self.updated), F.abs(new - old)).otherwise(F.col(sweep))
        return got.select(F.col("from_state").alias("state"), F.col("from_id").alias("pack_id"), new.alias("v"),
                          *[(change if d == sweep else F.col(d)).alias(d) for d in sweeps])


class _Values:
    """V on shared storage: ``path`` is read until ``keep`` puts the next table in its place."""

    def __init__(self, spark, start: DataFrame):
        self.spark, self.path = spark, None
        self.keep(self.write(start))

    def write(self, values: DataFrame) -> str:
        path = scratch_table_path(self.spark, "v")
        values.select(F.col("state").cast("int"), F.col("pack_id").cast("bigint"), "v").write.parquet(path)
        return path

    def keep(self, path: str) -> None:
        if self.path:
            drop_scratch(self.spark, self.path)
        self.path = path

    def read(self) -> DataFrame:
        return self.spark.read.schema("state INT, pack_id BIGINT, v DOUBLE").parquet(self.path)


def _run(values: _Values, messages: list[_Messages], n: int, n_packs: int) -> tuple[str, list[float]]:
    """``n`` sweeps in one job: where the new values are, and the change of each sweep."""
    sweeps = [f"_d{i}" for i in range(n)]
    state = values.read().select("*", *[F.lit(0.0).alias(d) for d in sweeps])
    for d in sweeps:
        for m in messages:
            state = m.update(state, d, sweeps)
    seen = Observation()
    path = values.write(state.observe(seen, F.count("v").alias("packs"), *[F.sum(d).alias(d) for d in sweeps]))
    if seen.get["packs"] != n_packs:
        raise ValueError(f"{seen.get['packs']} packs have a value, expected {n_packs}")
    return path, [float(seen.get[d] or 0.0) for d in sweeps]


def value_iteration(cost: CostTable, probs: DataFrame, packs: DataFrame, gamma: float = GAMMA,
                    max_sweeps: int = MAX_SWEEPS, threshold: float | None = THRESHOLD,
                    mode: str = "in_order", initial: float = INITIAL_VALUE,
                    sweeps_per_job: int = SWEEPS_PER_JOB) -> IterationResult:
    """Iterate until a sweep changes V by less than ``threshold`` in total (checked
    after the sweep) or ``max_sweeps`` sweeps ran; ``threshold=None`` runs all.
    ``sweeps_per_job`` changes how sweeps are grouped into jobs, and no result."""
    if mode not in ("in_order", "synchronous"):
        raise ValueError("mode must be 'in_order' or 'synchronous'")
    # One row per transition and per state, the size of the cluster being planned.
    p = {(r["from_state"], r["to_state"]): float(r["p"]) for r in probs.select("from_state", "to_state", "p").collect()}
    counts = {r["state"]: r["n"] for r in packs.groupBy("state").agg(F.count(F.lit(1)).alias("n")).collect()}
    states = sorted(set(counts) | {s for move in p for s in move})
    missing = [s for s in states if s not in counts]
    if missing:
        raise ValueError(f"no packs for states {missing}")
    _check_costs(cost, sorted(p), counts)
    active = sorted({a for a, _ in p})
    values = _Values(packs.sparkSession, packs.select("state", "pack_id", F.lit(float(initial)).alias("v")))
    diffs: list[float] = []
    converged = False
    together = [[s] for s in active] if mode == "in_order" else [active] if active else []
    messages = [_Messages(cost, packs, group, states, p, gamma) for group in together]
    while len(diffs) < max_sweeps and not converged:
        path, changes = _run(values, messages, min(sweeps_per_job, max_sweeps - len(diffs)), sum(counts.values()))
        under = [i for i, d in enumerate(changes, 1) if threshold is not None and d < threshold]
        converged = bool(under)
        if under and under[0] < len(changes):  # ended within the job: again, up to there
            drop_scratch(packs.sparkSession, path)
            path, changes = _run(values, messages, under[0], sum(counts.values()))
        values.keep(path)
        diffs += changes
    for m in messages:
        m.rows.unpersist()
    return IterationResult(values.read(), len(diffs), diffs[-1] if diffs else 0.0, diffs, converged)
