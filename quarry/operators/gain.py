"""Pairwise gain and migration cost between the packs of two states.

gain(a, b) is the maximum-weight matching between the runs of pack ``a`` and
the runs of pack ``b``, a cell weighing the total size of the items the two
runs share; cost = total size - gain.

Runs of a pack are disjoint intervals in line order, so an optimal matching
never needs two crossing cells and the gain is one fold along the staircase of
overlapping cells (``with_gain``), the same plan for every arity; no solver, no UDF.

The pair set of two states is, by definition, every pack of one state against
every pack of the other. Its size n_a * n_b is known from two counts before
anything runs, so the pair index space is generated by ``spark.range`` in
equal slices (no key, hence no skew) and each index is resolved to its two
packs with equi-joins on a dense pack index; Spark's byte threshold decides whether
a pack table is broadcast.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.operators.ordering import running_sums, with_position
from quarry.session import scratch_copy

ROWS_PER_TASK = 500_000


def with_gain(pairs: DataFrame, out: str = "gain") -> DataFrame:
    """Add the maximum-weight matching of shared size of each pair of packs, of any arity.

    Walking both packs from the left, the overlapping cells form a staircase: each step ends
    a run of a, of b, or of both. A cell may join the best matching of the cells before
    both its row and its column began, and that best never falls, so with ``row`` and ``col``
    the best totals before the current run of a and of b began, every step is
    best = max(best, min(row, col) + w). One fold over arity(a) + arity(b) steps.
    """
    ea, eb = F.col("a_ends"), F.col("b_ends")
    start = F.struct(F.lit(0).alias("i"), F.lit(0).alias("j"), F.lit(0.0).alias("at"), F.lit(0.0).alias("row"),
                     F.lit(0.0).alias("col"), F.lit(0.0).alias("best"))

    def step(s: Column, _: Column) -> Column:
        a, b = F.get(ea, s["i"]), F.get(eb, s["j"])
        here = F.when(a <= b, F.get(F.col("a_cum"), s["i"])).otherwise(F.get(F.col("b_cum"), s["j"]))
        best = F.greatest(s["best"], F.least(s["row"], s["col"]) + here - s["at"])
        moved = F.struct(
            (s["i"] + F.when(a <= b, 1).otherwise(0)).alias("i"), (s["j"] + F.when(b <= a, 1).otherwise(0)).alias("j"),
            here.alias("at"), F.when(a <= b, best).otherwise(s["row"]).alias("row"),
            F.when(b <= a, best).otherwise(s["col"]).alias("col"), best.alias("best"))
        return F.when(a.isNull() | b.isNull(), s).otherwise(moved)

    steps = F.sequence(F.lit(1), F.size(ea) + F.size(eb))
    return pairs.select(*pairs.columns, F.aggregate(steps, start, step, lambda s: s["best"]).alias(out))


def grid_overlaps(pairs: DataFrame) -> DataFrame:
    """One row per overlapping cell: ``pairs`` columns + ``a_slot, b_slot, weight``."""
    def begin(ends: str, slot: str) -> Column:
        return F.when(F.col(slot) > 0, F.get(F.col(ends), F.col(slot) - 1)).otherwise(0)

    def before(cum: str, slot: str) -> Column:
        return F.when(F.col(slot) > 0, F.get(F.col(cum), F.col(slot) - 1)).otherwise(0.0)

    slots = (pairs.withColumn("a_slot", F.explode(F.sequence(F.lit(0), F.size("a_ends") - 1)))
             .withColumn("b_slot", F.explode(F.sequence(F.lit(0), F.size("b_ends") - 1))))
    ea, eb = F.get("a_ends", "a_slot"), F.get("b_ends", "b_slot")
    sa, sb = begin("a_ends", "a_slot"), begin("b_ends", "b_slot")
    high = F.when(ea <= eb, F.get("a_cum", "a_slot")).otherwise(F.get("b_cum", "b_slot"))
    low = F.when(sa >= sb, before("a_cum", "a_slot")).otherwise(before("b_cum", "b_slot"))
    return slots.where(F.least(ea, eb) > F.greatest(sa, sb)).withColumn("weight", high - low)


def dense_index(packs: DataFrame) -> DataFrame:
    """Add ``idx`` = 0..n-1 per state in ``pack_id`` order (for packs read from files).

    Uses the distributed global position, then subtracts each state's first
    position (one row per state).
    """
    ranked = with_position(packs, ["state", "pack_id"], pos_col="_pos")
    first = ranked.groupBy("state").agg(F.min("_pos").alias("_first"))
    return (ranked.join(first, "state")
            .withColumn("idx", F.col("_pos") - F.col("_first")).drop("_pos", "_first"))


def pack_counts(packs: DataFrame) -> dict[int, int]:
    """Packs per state (one row per state reaches the driver)."""
    return {r["state"]: r["n"] for r in packs.groupBy("state").agg(F.count(F.lit(1)).alias("n")).collect()}


def _side(packs: DataFrame, state: int, prefix: str) -> DataFrame:
    return packs.where(F.col("state") == state).select(
        F.col("idx").alias(f"{prefix}_idx"), F.col("state").alias(f"{prefix}_state"),
        F.col("pack_id").alias(f"{prefix}_id"), F.col("ends").alias(f"{prefix}_ends"),
        F.col("cum").alias(f"{prefix}_cum"))


def pack_pairs(packs: DataFrame, a_state: int, b_state: int, counts: dict[int, int]) -> DataFrame:
    """Every (pack of ``a_state``, pack of ``b_state``), columns prefixed ``a_`` / ``b_``.

    ``packs`` needs ``state, pack_id, idx, ends, cum`` with ``idx`` dense per state.
    """
    spark = packs.sparkSession
    n_a, n_b = counts.get(a_state, 0), counts.get(b_state, 0)
    total = n_a * n_b
    tasks = max(spark.sparkContext.defaultParallelism, math.ceil(total / ROWS_PER_TASK))
    index = spark.range(0, total, numPartitions=tasks).select(
        (F.col("id") / F.lit(max(n_b, 1))).cast("bigint").alias("a_idx"),
        (F.col("id") % F.lit(max(n_b, 1))).alias("b_idx"))
    return index.join(_side(packs, a_state, "a"), "a_idx").join(_side(packs, b_state, "b"), "b_idx")


def canonical_migrations(transitions: DataFrame) -> list[tuple[int, int]]:
    """Distinct unordered state pairs of the transition table, ascending (few rows)."""
    pairs = transitions.select(F.least("from_state", "to_state").alias("lo"),
                               F.greatest("from_state", "to_state").alias("hi")).distinct()
    return sorted((r["lo"], r["hi"]) for r in pairs.collect())


def pair_gains(packs: DataFrame, migrations: list[tuple[int, int]], total: float,
               counts: dict[int, int] | None = None) -> DataFrame:
    """``(from_state, from_id, to_state, to_id, gain, cost)`` for each unordered
    migration (from_state < to_state); each pair is computed once."""
    counts = counts if counts is not None else pack_counts(packs)
    frames = []
    for lo, hi in migrations:
        if lo == hi:
            raise ValueError(f"a state cannot migrate to itself: {lo}")
        pairs = with_gain(pack_pairs(packs, lo, hi, counts))
        frames.append(pairs.select(F.col("a_state").alias("from_state"), F.col("a_id").alias("from_id"),
                                   F.col("b_state").alias("to_state"), F.col("b_id").alias("to_id"),
                                   "gain", F.col("a_idx").alias("from_idx"), F.col("b_idx").alias("to_idx")))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out.withColumn("cost", F.lit(float(total)) - F.col("gain"))


def with_pair_positions(gains: DataFrame, migrations: list[tuple[int, int]], counts: dict[int, int],
                        pos_col: str = "pos") -> DataFrame:
    """Position of each pair in (from_state, to_state, from_id, to_id) order, computed
    without sorting: each migration is a full product and the dense pack index
    follows pack-id order, so pos = offset of the migration + from_idx * n_to + to_idx.
    Needs the ``from_idx`` / ``to_idx`` columns of ``pair_gains``."""
    offset, pos = 0, None
    for lo, hi in sorted(migrations):
        here = (F.col("from_state") == lo) & (F.col("to_state") == hi)
        value = F.lit(offset) + F.col("from_idx") * F.lit(counts[hi]) + F.col("to_idx")
        pos = F.when(here, value) if pos is None else pos.when(here, value)
        offset += counts[lo] * counts[hi]
    return gains.withColumn(pos_col, pos.cast("bigint"))


def overlap_weights(packs: DataFrame, migrations: list[tuple[int, int]],
                    counts: dict[int, int] | None = None) -> DataFrame:
    """Long form ``(from_state, from_id, to_state, to_id, from_slot, to_slot, weight)``."""
    counts = counts if counts is not None else pack_counts(packs)
    frames = []
    for lo, hi in migrations:
        cells = grid_overlaps(pack_pairs(packs, lo, hi, counts))
        frames.append(cells.select(F.col("a_state").alias("from_state"), F.col("a_id").alias("from_id"),
                                   F.col("b_state").alias("to_state"), F.col("b_id").alias("to_id"),
                                   F.col("a_slot").alias("from_slot"), F.col("b_slot").alias("to_slot"),
                                   "weight"))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def overlap_totals(packs: DataFrame, migrations: list[tuple[int, int]]) -> DataFrame:
    """``(from_state, from_id, from_slot, to_state, cells, shared)``: per run of a pack and other state of a migration, how
    many runs of that state's packs it meets, and the size it shares with them in all.

    A plane sweep over the sorted cut points. With B(x) the runs that begin before x, E(x) those that end at x
    or earlier, and their sizes below x summed the same way, a run [s, e) meets B(e) - E(s) others and shares
    C(e) - C(s), where C(x) = (sizes before the ends) - (sizes before the beginnings) + size(x) (B(x) - E(x)). Two
    lookups per run and state replace a row per pair of runs; work and output grow with the packs, not their pairs.
    """
    spark = packs.sparkSession
    z = F.arrays_zip("ends", "cum")
    runs = packs.select("state", "pack_id", "ends", "cum", F.posexplode(z).alias("slot", "_z"))
    runs = scratch_copy(runs.select(
        "state", "pack_id", "slot", F.when(F.col("slot") == 0, F.lit(0)).otherwise(F.get("ends", F.col("slot") - 1)).alias("s"),
        F.when(F.col("slot") == 0, F.lit(0.0)).otherwise(F.get("cum", F.col("slot") - 1)).alias("s_cum"),
        F.col("_z.ends").alias("e"), F.col("_z.cum").alias("e_cum")), "runs")
    sides = spark.createDataFrame(sorted({(a, b) for a, b in migrations} | {(b, a) for a, b in migrations}), "from_state INT, to_state INT")
    # Every cut point is looked up in every state's sweep, so each state has a row for each of them.
    cuts = runs.select(F.col("s").alias("at"), F.col("s_cum").alias("at_cum")).unionByName(
        runs.select(F.col("e").alias("at"), F.col("e_cum").alias("at_cum"))).distinct()
    begins = runs.groupBy("state", F.col("s").alias("at")).agg(F.count(F.lit(1)).alias("begun"), F.sum("s_cum").alias("begun_cum"))
    finishes = runs.groupBy("state", F.col("e").alias("at")).agg(F.count(F.lit(1)).alias("ended"), F.sum("e_cum").alias("ended_cum"))
    states = sides.select(F.col("to_state").alias("state")).distinct().agg(F.collect_list("state").alias("s")).first()["s"]
    events = (cuts.select("*", F.explode(F.array([F.lit(x) for x in states])).alias("state"))
              .join(begins, ["state", "at"], "left").join(finishes, ["state", "at"], "left")
              .fillna(0, ["begun", "begun_cum", "ended", "ended_cum"]))
    values = ["begun", "begun_cum", "ended", "ended_cum"]
    own = events.select("state", "at", F.col("begun").alias("_b"), F.col("begun_cum").alias("_bc"))
    swept = running_sums(events, "state", "at", values).join(own, ["state", "at"])
    # Beginnings at a point itself are not before it.
    before = F.col("begun") - F.col("_b")
    swept = scratch_copy(swept.select(
        F.col("state").alias("to_state"), "at", before.alias("before"), "ended",
        (F.col("ended_cum") - (F.col("begun_cum") - F.col("_bc")) + F.col("at_cum") * (before - F.col("ended"))).alias("below")), "sweep")
    at_s = swept.select("to_state", F.col("at").alias("s"), F.col("ended").alias("gone"), F.col("below").alias("below_s"))
    at_e = swept.select("to_state", F.col("at").alias("e"), F.col("before").alias("come"), F.col("below").alias("below_e"))
    return (runs.join(sides, runs["state"] == sides["from_state"]).join(at_s, ["to_state", "s"]).join(at_e, ["to_state", "e"])
            .select("from_state", F.col("pack_id").alias("from_id"), F.col("slot").alias("from_slot"), "to_state",
                    (F.col("come") - F.col("gone")).alias("cells"), (F.col("below_e") - F.col("below_s")).alias("shared")))


# --- the best partner of each pack ---------------------------------------------------------------

def _walked(state: Column, cut: Column, size: Column) -> Column:
    """The staircase state of pack ``a_ends, a_cum`` after the other pack's run has ended at ``cut``, with ``size`` before it.

    Ends of the pack that come first are taken on the way; see ``with_gain`` for the recurrence. Once the
    pack has ended nothing changes.
    """
    def event(s: Column, here: Column, ends_row: Column, ends_col: Column, i: Column) -> Column:
        best = F.greatest(s["best"], F.least(s["row"], s["col"]) + here - s["at"])
        return F.struct(i.alias("i"), here.alias("at"), F.when(ends_row, best).otherwise(s["row"]).alias("row"),
                        F.when(ends_col, best).otherwise(s["col"]).alias("col"), best.alias("best"))

    def passed(s: Column, i: Column) -> Column:
        ends_first = (i >= s["i"]) & (F.get("a_ends", i) < cut)
        return F.when(ends_first, event(s, F.get("a_cum", i), F.lit(True), F.lit(False), i + 1)).otherwise(s)

    def ended(s: Column) -> Column:
        end = F.get("a_ends", s["i"])
        return F.when(end.isNull(), s).otherwise(
            event(s, size, end == cut, F.lit(True), s["i"] + F.when(end == cut, 1).otherwise(0)))

    return F.aggregate(F.sequence(F.lit(0), F.size("a_ends") - 1), state, passed, ended)


def _prefix_tree(packs: DataFrame, state: int, arity: int) -> list[DataFrame]:
    """Levels of the tree of cut points of a state: ``(node, kids)``, kids being ``(node, cut, size)`` of the nodes
    that go on by one cut; the last level's kids are ``tails``: the two last ends of the packs below, with their ids."""
    own = packs.where(F.col("state") == state)
    depth = max(0, arity - 2)
    tail = F.struct("pack_id", *[F.get(c, F.lit(arity - 1 - back)).alias(f"{name}{back}")
                                 for back in range(min(2, arity)) for c, name in (("ends", "cut"), ("cum", "size"))])
    rows = (own.groupBy(F.slice("ends", 1, depth).alias("ends"), F.slice("cum", 1, depth).alias("cum"))
            .agg(F.min("pack_id").alias("node"), F.array_sort(F.collect_list(tail)).alias("kids")))
    levels = [scratch_copy(rows, "tree")]
    for d in range(depth, 0, -1):
        kid = F.struct("node", F.get("ends", F.lit(d - 1)).alias("cut"), F.get("cum", F.lit(d - 1)).alias("size"))
        up = levels[0].groupBy(F.slice("ends", 1, d - 1).alias("ends"), F.slice("cum", 1, d - 1).alias("cum")).agg(
            F.min("node").alias("node"), F.array_sort(F.collect_list(kid)).alias("kids"))
        levels.insert(0, scratch_copy(up, "tree"))
    return [level.select("node", "kids") for level in levels]


def best_partners(packs: DataFrame, migrations: list[tuple[int, int]], total: float) -> DataFrame:
    """``(from_state, from_id, to_state, gain, cost, to_id)``: per pack and other state of a migration the largest gain, the
    cheapest cost, and the pack that gives them (ties: the smallest id). Both directions of each migration.

    Packs of the other state are read as a tree of their cut points. The staircase state of a pack against a
    prefix of cuts is computed once and goes on to all packs with that prefix; below a prefix of all but
    two ends, the packs are reduced within the row. So there is a row per pack and prefix, and none per pair
    of packs; the output has a row per pack and target.
    """
    spark = packs.sparkSession
    arity = {r["state"]: r["k"] for r in packs.groupBy("state").agg(F.max(F.size("ends")).alias("k")).collect()}
    trees = {s: _prefix_tree(packs, s, k) for s, k in arity.items()}
    zero = F.lit(0.0)
    start = F.struct(F.lit(0).alias("i"), zero.alias("at"), zero.alias("row"), zero.alias("col"), zero.alias("best"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    frames = []
    for a, b in sorted({(a, b) for a, b in migrations} | {(b, a) for a, b in migrations}):
        if a == b:
            raise ValueError(f"a state cannot migrate to itself: {a}")
        levels = trees.get(b, [])
        if a not in arity or not levels:
            continue
        here = packs.where(F.col("state") == a).select(
            F.col("pack_id").alias("from_id"), F.col("ends").alias("a_ends"), F.col("cum").alias("a_cum"),
            start.alias("state"), F.lit(b).alias("to_state"))
        # The root is one row: its kids are at most one per item.
        rows = here.join(levels[0].select(F.lit(b).alias("to_state"), "kids"), "to_state")
        for level in levels[1:]:
            opened = rows.select("from_id", "a_ends", "a_cum", "to_state", "state", F.explode("kids").alias("kid"))
            on = opened.select("from_id", "a_ends", "a_cum", "to_state", _walked(F.col("state"), F.col("kid.cut"), F.col("kid.size")).alias("state"),
                               F.col("kid.node").alias("node"))
            rows = on.join(level, "node")

        def told(tail: Column) -> Column:
            state = F.col("state") if arity[b] == 1 else _walked(F.col("state"), tail["cut1"], tail["size1"])
            return F.struct((-_walked(state, tail["cut0"], tail["size0"])["best"]).alias("less"), tail["pack_id"].alias("to_id"))

        # The fold over tails is the work; it is spread evenly over tasks by pack and prefix.
        best = rows.repartition(parts).select("from_id", "to_state", F.array_min(F.transform("kids", told)).alias("best"))
        frames.append(best.groupBy("from_id", "to_state").agg(F.min("best").alias("best")).select(
            F.lit(a).alias("from_state"), "from_id", "to_state", (-F.col("best.less")).alias("gain"),
            (F.lit(float(total)) + F.col("best.less")).alias("cost"), F.col("best.to_id").alias("to_id")))
    if not frames:
        return spark.createDataFrame([], "from_state INT, from_id BIGINT, to_state INT, gain DOUBLE, cost DOUBLE, to_id BIGINT")
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def both_directions(gains: DataFrame) -> DataFrame:
    """Each unordered pair read in both directions (a generator, no join)."""
    fwd = F.struct(F.col("from_state").alias("fs"), F.col("from_id").alias("fi"),
                   F.col("to_state").alias("ts"), F.col("to_id").alias("ti"),
                   F.col("from_idx").alias("fx"), F.col("to_idx").alias("tx"))
    back = F.struct(F.col("to_state").alias("fs"), F.col("to_id").alias("fi"),
                    F.col("from_state").alias("ts"), F.col("from_id").alias("ti"),
                    F.col("to_idx").alias("fx"), F.col("from_idx").alias("tx"))
    return (gains.select(F.explode(F.array(fwd, back)).alias("_d"), "gain", "cost")
            .select(F.col("_d.fs").alias("from_state"), F.col("_d.fi").alias("from_id"),
                    F.col("_d.ts").alias("to_state"), F.col("_d.ti").alias("to_id"), "gain", "cost",
                    F.col("_d.fx").alias("from_idx"), F.col("_d.tx").alias("to_idx")))
