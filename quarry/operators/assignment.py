"""Grouped maximum-weight assignment over long-form edges ``(group, x, y, weight)``.

Per group, every element of the smaller side is matched to a distinct element
of the larger side (also at weight <= 0), maximising the total; an absent cell
weighs 0. Only totals are unique: tied matchings may come out either way.

1. Candidates (exact, relational). With m elements on the small side, an optimal
   matching never needs a partner outside an element's m best cells: if it
   used one, one of those m cells would be free (only m-1 other elements) and
   at least as heavy. ``rank <= m`` per element leaves at most m*m cells of a
   group, however long its large side is; Spark evaluates the rank as a
   partial limit before its shuffle. Absent cells are looked for among the first
   m + degree partners of the group, of which at least m are absent if so many exist.
2. Small groups (at most ``SMALL`` candidates on either side), by subsets: element after element of the smaller side, the
   best total for each set of partners used so far is joined with the next element's cells and reduced with
   ``max_by``. A group has at most 2^SMALL sets, and all steps of all groups are one job.
3. Other groups. Bids against a price table, then shortest augmenting paths over the reduced costs, both as
   joins and aggregates over the candidates of all these groups at once (``auction``). A group's cells are spread
   over tasks by x or by y, and no task or driver holds a group.

Weights are taken as whole numbers (exact if they are whole and their spread in a group is below the bits
that are left, else to the finest power of two that fits, some 2^-40 of the spread), so a result is
optimal for those, with no tolerance.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.operators.auction import best_matching
from quarry.operators.common import require
from quarry.operators.ordering import with_position
from quarry.session import scratch_copy


#: Candidates on either side up to which a group is matched by subsets; its sets are 2^SMALL rows at most.
SMALL = 8


def _checked(edges: DataFrame, group: str, x: str, y: str, w: str) -> DataFrame:
    e = edges.select(F.col(group).alias("g"), F.col(x).alias("x"), F.col(y).alias("y"),
                     F.col(w).cast("double").alias("w"))
    e = require(e, F.col("x").isNotNull() & F.col("y").isNotNull(), "an edge needs both ends")
    e = require(e, F.col("w").isNotNull() & (F.abs("w") < float("inf")), "an edge needs a finite weight")
    cells = e.groupBy("g", "x", "y").agg(F.max("w").alias("w"), F.count(F.lit(1)).alias("copies"))
    return require(cells, F.col("copies") == 1, "duplicate edge (group, x, y)").drop("copies")


def _elements(e: DataFrame) -> DataFrame:
    """``(g, side, x, y, p)``: the distinct elements of both sides (0: x, 1: y), numbered over all, so that those of
    a group's side are consecutive."""
    xs = e.select("g", F.lit(0).alias("side"), "x", F.lit(None).cast(e.schema["y"].dataType).alias("y"))
    ys = e.select("g", F.lit(1).alias("side"), F.lit(None).cast(e.schema["x"].dataType).alias("x"), "y")
    return scratch_copy(with_position(xs.unionByName(ys).distinct(), ["g", "side", "x", "y"], pos_col="p"), "elements")


def _groups(e: DataFrame, elements: DataFrame) -> DataFrame:
    """One row per group: which side is the smaller, sizes, the first numbers of the sides, and what weights span (0 included)."""
    def of(side: int, f) -> F.Column:
        return f(F.when(F.col("side") == side, F.col("p")))

    sides = elements.groupBy("g").agg(of(0, F.count).alias("nx"), of(1, F.count).alias("ny"), of(0, F.min).alias("fx"), of(1, F.min).alias("fy"))
    weights = e.groupBy("g").agg(F.least(F.min("w"), F.lit(0.0)).alias("low"), F.greatest(F.max("w"), F.lit(0.0)).alias("high"),
                                 F.min(F.col("w") == F.floor("w")).alias("whole"))
    swap = F.col("nx") > F.col("ny")
    return scratch_copy(sides.alias("s").join(weights.alias("w"), F.expr("s.g <=> w.g")).select(
        F.col("s.g").alias("_g"), swap.alias("swap"), F.least("nx", "ny").alias("m"), F.greatest("nx", "ny").alias("n"),
        F.when(swap, F.col("fx")).otherwise(F.col("fy")).alias("first_l"), F.col("fx").alias("grp"),
        "low", (F.col("high") - F.col("low")).alias("span"), "whole"), "groups")


def _by_subsets(cells: DataFrame, size: int) -> DataFrame:
    """``(x, y)`` of an optimal matching of every x of groups with at most ``size`` x and few y. ``cells``: ``grp, x, y, w``.

    Everything is partitioned by group, so the steps need no exchange between them.
    """
    parts = int(cells.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def place(c: str) -> F.Column:
        return F.dense_rank().over(Window.partitionBy("grp").orderBy(c)) - 1

    numbered = scratch_copy(cells.select("*", place("x").alias("i"), place("y").alias("j"))
                            .selectExpr("grp", "x", "y", "w", "i", "shiftleft(1, j) AS bit"), "numbered")
    # A group with fewer x has empty steps, which pass its sets on.
    idle = (numbered.groupBy("grp").agg(F.max("i").alias("last")).where(F.col("last") < size - 1)
            .select("grp", F.explode(F.sequence(F.col("last") + 1, F.lit(size - 1))).alias("i"))
            .select("grp", F.lit(None).cast("long").alias("x"), F.lit(None).cast("long").alias("y"), F.lit(0).cast("long").alias("w"),
                    "i", F.lit(0).alias("bit")))
    steps = numbered.unionByName(idle).repartition(parts, "grp")
    sets = numbered.select("grp").distinct().repartition(parts, "grp").selectExpr(
        "grp", "0 AS used", "0L AS total", "CAST(array() AS ARRAY<BIGINT>) AS chosen")
    for i in range(size):
        sets = (sets.join(steps.where(F.col("i") == i).selectExpr("grp", "y", "w", "bit"), "grp").where("used & bit = 0")
                .selectExpr("grp", "used | bit AS used", "total + w AS total", "concat(chosen, array(y)) AS chosen")
                .groupBy("grp", "used").agg(F.expr("max_by(chosen, total) AS chosen"), F.expr("max(total) AS total")))
    best = sets.groupBy("grp").agg(F.expr("max_by(chosen, total) AS chosen"))
    taken = best.select("grp", F.posexplode("chosen").alias("i", "y")).where("y IS NOT NULL")
    return taken.join(numbered, ["grp", "i", "y"]).select("x", "y")


def _unit(bits: int) -> F.Column:
    """How many whole numbers a weight of 1 is: 1 if the group's weights are whole and span less than ``bits`` bits, else
    the power of two that makes them span that much."""
    as_they_are = (F.col("whole") & (F.col("span") < float(1 << bits))) | (F.col("span") == 0)
    return F.when(as_they_are, F.lit(1.0)).otherwise(F.pow(F.lit(2.0), F.lit(bits - 1) - F.ceil(F.log2("span"))))


def max_weight_assignment(edges: DataFrame, group: str = "grp", x: str = "x", y: str = "y",
                          weight: str = "weight", small: int = SMALL) -> tuple[DataFrame, DataFrame]:
    """Returns ``(pairs, totals)``: ``pairs`` = (group, x, y, weight) of the matching,
    ``totals`` = (group, total, n_pairs).

    Any size of either side. A null end, a null, NaN or infinite weight, or a repeated (group, x, y) is an
    error. ``x`` and ``y`` keep their types; a null group is a group of its own. ``small`` changes which way a group
    is matched, and no total.
    """
    e = scratch_copy(_checked(edges, group, x, y, weight), "edges")
    elements = _elements(e)
    groups = _groups(e, elements)
    most = int(groups.agg(F.max("m")).first()[0] or 1)
    hops = (2 * most).bit_length() + 1
    on = elements.select("g", "side", "x", "y", "p")
    # s and l are the numbers of an edge's ends on the smaller and the larger side of its group.
    cells = scratch_copy(
        e.alias("e").join(on.where("side = 0").alias("a"), F.expr("e.g <=> a.g AND e.x = a.x"))
        .join(on.where("side = 1").alias("b"), F.expr("e.g <=> b.g AND e.y = b.y")).join(groups, F.expr("e.g <=> _g"))
        .select("grp", F.when(F.col("swap"), F.col("b.p")).otherwise(F.col("a.p")).alias("s"),
                F.when(F.col("swap"), F.col("a.p")).otherwise(F.col("b.p")).alias("l"), F.col("e.w").alias("w"),
                "m", "n", "first_l", "low", _unit(60 - 2 * hops).alias("unit")), "cells")
    # Only an element without an edge to every partner can need an absent (zero) cell.
    of_group = ["grp", "m", "low", "unit"]
    short = cells.groupBy("s").agg(F.count(F.lit(1)).alias("d"), *[F.first(c).alias(c) for c in [*of_group, "n", "first_l"]]).where("d < n")
    probe = short.select("s", *of_group, F.explode(F.sequence(
        F.col("first_l"), F.col("first_l") + F.least(F.col("n"), F.col("m") + F.col("d")) - 1)).alias("l"))
    every = cells.drop("n", "first_l").unionByName(probe.join(cells, ["s", "l"], "left_anti").withColumn("w", F.lit(0.0)))
    best = Window.partitionBy("s").orderBy(F.desc("w"), F.asc("l"))
    candidates = scratch_copy(
        every.withColumn("_r", F.row_number().over(best)).where(F.col("_r") <= F.col("m"))
        .select("grp", F.col("s").alias("x"), F.col("l").alias("y"), F.col("w").alias("weight"),
                F.round((F.col("w") - F.col("low")) * F.col("unit")).cast("long").alias("w")), "candidates")
    shapes = scratch_copy(candidates.groupBy("grp").agg(F.countDistinct("x").alias("nx"), F.countDistinct("y").alias("ny"))
                          .select("grp", "nx", (F.greatest("nx", "ny") <= small).alias("small")), "shapes")
    kinds = {r["small"]: r["most"] for r in shapes.groupBy("small").agg(F.max("nx").alias("most")).collect()}
    told = candidates.select("grp", "x", "y", "w").join(shapes.select("grp", "small"), "grp")
    found = []
    if True in kinds:
        found.append(_by_subsets(told.where("small").drop("small"), kinds[True]))
    if False in kinds or not kinds:
        found.append(best_matching(told.where("NOT small").drop("small"), hops))
    found = found[0] if len(found) == 1 else found[0].unionByName(found[1])
    matched = candidates.join(found, ["x", "y"]).select(F.col("x").alias("s"), F.col("y").alias("l"), "weight")
    # Either side's element may be the x of an edge; the smaller side's has the group.
    small, large = on.select(F.col("p").alias("s"), "g", F.col("x").alias("sx"), F.col("y").alias("sy")), on.select(
        F.col("p").alias("l"), F.col("x").alias("lx"), F.col("y").alias("ly"))
    pairs = scratch_copy(matched.join(small, "s").join(large, "l").select(
        F.col("g").alias(group), F.coalesce("sx", "lx").alias(x), F.coalesce("sy", "ly").alias(y), F.col("weight").alias(weight)), "pairs")
    totals = pairs.groupBy(group).agg(F.sum(weight).alias("total"), F.count(F.lit(1)).alias("n_pairs"))
    return pairs, totals
