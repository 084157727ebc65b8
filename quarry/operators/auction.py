"""Maximum-weight matching of bipartite candidate cells by joins and aggregates alone.

Input: cells ``(grp, x, y, w)`` with whole-number weights; ids are unique over all groups, so
every group is solved by the same jobs. Each x of a group gets a y of its own. Prices, holders and
profits are tables; a round is a chain of joins and hash aggregates, a few rounds go into
one job, and what a job leaves is written to shared storage. Only counts reach the driver.

1. Bidding. Each x without a y bids for its best one: its price, plus the lead over the second best,
   plus epsilon; the highest bid takes the y. Epsilon falls from half the group's weight span by
   eighths, each time from an empty market with the prices kept, and ends at 0. A market stops once nearly all hold
   something: the last few would outbid each other for very long.
2. Cells that are exactly their x's best at these prices stay matched; the others are freed.
3. Augmentation. From all free x at once, shortest distances over the reduced costs (profit + price -
   weight, none below 0), relaxed by a join and a minimum per y until nothing changes. Prices and
   profits move by the distances, which makes shortest paths free of cost. Every tree that reaches a free
   y passes its path's y's along, so one step serves many x. At the end reduced costs are still not
   negative and matched ones are 0: the matching is optimal, with no tolerance.

In a group with more y than x the y's that stay free must keep the lowest price; there prices start at 0,
bids use no epsilon, and a step only serves the free y's that are nearest of all.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from quarry.session import drop_scratch, scratch_table_path


@dataclass(frozen=True)
class Rounds:
    """Rounds in a job, rounds a market may take, the share of x that may stay free, bits that epsilon loses from
    market to market, and steps allowed."""

    in_job: int = 5
    in_market: int = 20
    free_share: float = 0.05
    shift: int = 3
    steps: int = 100_000


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_table_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._path = path
    return out


def _dropped(table: DataFrame) -> None:
    drop_scratch(table.sparkSession, table._path)


# --- bidding -------------------------------------------------------------------------------------

def _bids(cells: DataFrame, prices: DataFrame, epsilon: str) -> DataFrame:
    """``(y, price, owner)`` after one round; a null epsilon leaves a group as it is.

    Written as text: a job holds several rounds, and a round's plan should be cheap to build.
    """
    of_x = "OVER (PARTITION BY x ORDER BY value DESC, y)"
    return (cells.join(prices, "y").selectExpr("x", "y", "price", "owner", "w - price AS value", f"{epsilon} AS epsilon")
            .selectExpr("*", "max(owner = x) OVER (PARTITION BY x) AS served", f"row_number() {of_x} AS place", f"lead(value) {of_x} AS second")
            .selectExpr("x", "y", "price", "owner",
                        "IF(place = 1 AND NOT coalesce(served, false), price + value - coalesce(second, value) + epsilon, NULL) AS bid")
            .groupBy("y").agg(F.expr("max(price) AS price"), F.expr("max(owner) AS owner"), F.expr("max(bid) AS bid"),
                              F.expr("max_by(x, bid) AS bidder"))
            .selectExpr("y", "coalesce(bid, price) AS price", "IF(bid IS NULL, owner, bidder) AS owner"))


def _market(cells: DataFrame, prices: DataFrame, start: DataFrame, epsilon: str, n_x: int, rounds: Rounds) -> DataFrame:
    """Rounds from ``start`` until few of the ``n_x`` bidders are free, a job of rounds serves no more than the one
    before, or the market's rounds are used up. ``prices`` is the table that ``start`` reads."""
    before = 0
    for _ in range(0, rounds.in_market, rounds.in_job):
        state = start
        for _ in range(rounds.in_job):
            state = _bids(cells, state, epsilon)
        seen = Observation()
        told = _written(state.observe(seen, F.count("owner").alias("served")), "prices")
        _dropped(prices)
        start = prices = told
        served = seen.get["served"]
        if n_x - served <= rounds.free_share * n_x or served <= before:
            break
        before = served
    return prices


def _warm(cells: DataFrame, groups: DataFrame, rounds: Rounds) -> DataFrame:
    """Prices and holders after markets of falling epsilon."""
    totals = groups.agg(F.sum(F.when(F.col("square"), F.col("n_x"))).alias("square"), F.coalesce(F.sum("n_x"), F.lit(0)).alias("every"),
                        F.max(F.when(F.col("square"), F.col("span"))).alias("span")).first()
    empty = "CAST(NULL AS BIGINT) AS owner"
    prices = _written(cells.select("y").distinct().selectExpr("y", "0L AS price", empty), "prices")
    shift = 1
    while totals["square"] and (shift == 1 or totals["span"] >> (shift - rounds.shift) > 1):  # until epsilon has been 1
        prices = _market(cells, prices, prices.selectExpr("y", "price", empty),
                         f"IF(square, greatest(1L, shiftright(span, {shift})), NULL)", totals["square"], rounds)
        shift += rounds.shift
    return _market(cells, prices, prices, "0L", totals["every"], rounds)


# --- augmentation --------------------------------------------------------------------------------

def _relaxed(costs: DataFrame, matched: DataFrame, reached: DataFrame) -> DataFrame:
    """``(x, key, old)``: each x by the least key of its own y, and by the key it had before, if any. Every x has a
    cell of cost 0 to its own y."""
    return (costs.join(reached.select("x", "key"), "x").groupBy("y").agg(
        F.expr("min(key + cost) AS key"), F.expr("min(IF(cost = 0, key, NULL)) AS old")).join(matched, "y").select("x", "key", "old"))


def _distances(costs: DataFrame, matched: DataFrame, free: DataFrame, rounds: Rounds) -> DataFrame:
    """Relaxed until the last round of a job changes nothing."""
    reached = _written(free.select("x", F.lit(0).cast("long").alias("key")), "reached")
    while True:
        state = reached
        for _ in range(rounds.in_job):
            state = _relaxed(costs, matched, state)
        seen = Observation()
        told = _written(state.observe(seen, F.count_if(~F.col("key").eqNullSafe(F.col("old"))).alias("changed")).select("x", "key"), "reached")
        _dropped(reached)
        reached = told
        if not seen.get["changed"]:
            return reached


def _step(cells: DataFrame, profits: DataFrame, prices: DataFrame, free: DataFrame, bits: int,
          rounds: Rounds) -> tuple[DataFrame, DataFrame, int]:
    """One augmentation step: new profits and prices, and how many x it has served.

    A key is a distance and, in its low ``bits``, the cells on the way: parents are nearer by at least one.
    """
    hops = (1 << bits) - 1
    parts = int(cells.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    reduced = F.col("profit") + F.col("price") - F.col("w")
    known = (cells.join(profits, "x").join(prices, "y").select(
        "x", "y", F.when(F.col("owner") == F.col("x"), F.lit(0).cast("long")).otherwise(F.shiftleft(reduced, bits) + 1).alias("cost")))
    at_home = free.select("x", (-F.col("x") - 1).alias("y"), F.lit(0).cast("long").alias("cost"))
    costs = known.unionByName(at_home).repartition(parts, "x").persist(StorageLevel.MEMORY_AND_DISK)
    matched = (prices.where("owner is not null").select("y", F.col("owner").alias("x"))
               .unionByName(at_home.select("y", "x")))
    reached = _distances(costs, matched, free, rounds)

    came = (costs.where("cost > 0").join(reached, "x").withColumn("far", F.col("key") + F.col("cost")).groupBy("y")
            .agg(F.min("far").alias("key"), F.min_by("x", F.struct("far", "x")).alias("parent")))
    group_of = cells.select("y", "grp", "square").distinct()
    ends = _written(came.join(group_of, "y").join(prices.select("y", "owner"), "y")
                    .withColumn("far", F.shiftright("key", bits)), "ends")
    costs.unpersist()
    limits = _written(ends.groupBy("grp").agg(
        F.when(F.max("square"), F.max("far")).otherwise(F.min(F.when(F.col("owner").isNull(), F.col("far")))).alias("limit")), "limits")
    open_ = ends.join(limits, "grp").where(F.col("owner").isNull() & (F.col("far") <= F.col("limit")))
    paths = open_.select("y", "key", F.array("parent").alias("path"), F.col("parent").alias("last"))
    longest = open_.agg(F.max(F.col("key").bitwiseAND(hops))).first()[0] or 0
    above = ends.where("owner is not null").select(F.col("owner").alias("last"), "parent")
    done = 1
    while done < longest:
        for _ in range(min(rounds.in_job, longest - done)):
            paths = paths.join(above, "last", "left").select(
                "y", "key", F.when(F.col("parent").isNull(), F.col("path")).otherwise(F.concat("path", F.array("parent"))).alias("path"),
                F.coalesce("parent", "last").alias("last"))
            done += 1
        paths = _written(paths, "paths")
    chosen = paths.groupBy("last").agg(F.min_by(F.struct("y", "path"), F.struct("key", "y")).alias("best")).select("best.*")
    links = chosen.select("y", "path", F.posexplode("path").alias("at", "x")).select(
        "x", F.when(F.col("at") == 0, F.col("y")).alias("end"), F.when(F.col("at") > 0, F.get("path", F.col("at") - 1)).alias("of"))
    home = prices.where("owner is not null").select(F.col("owner").alias("of"), F.col("y").alias("home"))
    moved = _written(links.join(home, "of", "left").select(F.coalesce("end", "home").alias("y"), F.col("x").alias("heir")), "moved")

    def shifted(far: Column) -> Column:
        return F.when(F.col("limit").isNull(), F.lit(0)).otherwise(F.least(F.coalesce(far, F.col("limit")), F.col("limit")))

    group_x = cells.select("x", "grp").distinct()
    new_profits = _written(
        profits.join(group_x, "x").join(reached, "x", "left").join(limits, "grp", "left")
        .select("x", (F.col("profit") + shifted(F.shiftright("key", bits))).alias("profit")), "profits")
    new_prices = _written(
        prices.join(group_of.select("y", "grp"), "y").join(ends.select("y", "far"), "y", "left")
        .join(limits, "grp", "left").join(moved, "y", "left")
        .select("y", (F.col("price") - shifted(F.col("far"))).alias("price"), F.coalesce("heir", "owner").alias("owner")), "prices")
    served = moved.count() - moved.join(home, moved["heir"] == home["of"], "left_semi").count()
    for table in (reached, ends, limits, moved, profits, prices):
        _dropped(table)
    return new_profits, new_prices, served


def best_matching(cells: DataFrame, bits: int, rounds: Rounds | None = None) -> DataFrame:
    """``(x, y)`` of an optimal matching of every x. ``cells``: ``grp, x, y, w`` (longs), already stored.

    Every group must be able to serve all its x (callers keep as many of the best y of each x as the
    group has x). ``bits`` bounds the cells on a path, 2 * x of a group at most. A step that serves
    nothing, or more steps than ``rounds.steps``, is an error: a partial matching is never returned.
    """
    rounds = rounds or Rounds()
    groups = _written(cells.groupBy("grp").agg(
        F.countDistinct("x").alias("n_x"), (F.countDistinct("x") == F.countDistinct("y")).alias("square"),
        (F.max("w") - F.min("w")).alias("span")), "groups")
    parts = int(cells.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Stays partitioned by y, the key that prices come by.
    cells = cells.join(groups.select("grp", "square", "span"), "grp").repartition(parts, "y").persist(StorageLevel.MEMORY_AND_DISK)
    prices = _warm(cells, groups, rounds)
    offers = cells.join(prices, "y").withColumn("value", F.col("w") - F.col("price"))
    profits = _written(offers.groupBy("x").agg(F.max("value").alias("profit")), "profits")
    kept = (offers.where(F.col("owner") == F.col("x")).join(profits, "x").where(F.col("value") == F.col("profit"))
            .select("y", F.col("x").alias("holder")))
    held = _written(prices.join(kept, "y", "left").select("y", "price", F.col("holder").alias("owner")), "prices")
    _dropped(prices)
    prices = held
    for _ in range(rounds.steps):
        free = profits.select("x").join(prices.select(F.col("owner").alias("x")), "x", "left_anti")
        free = _written(free, "free")
        if free.isEmpty():
            break
        profits, prices, served = _step(cells, profits, prices, free, bits, rounds)
        _dropped(free)
        if not served:
            raise RuntimeError("assignment: a step has served no element; a group's cells cannot serve all of it")
    else:
        raise RuntimeError(f"assignment: not finished after {rounds.steps} steps")
    cells.unpersist()
    return prices.where("owner is not null").select(F.col("owner").alias("x"), "y")
