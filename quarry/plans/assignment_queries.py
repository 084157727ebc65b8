"""Assignment query: per region, nations matched one-to-one to market segments,
weighted by how many customers of the nation are in the segment (whole ``customer``)."""

from __future__ import annotations

import itertools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators.assignment import max_weight_assignment as _mwa
from quarry.operators.ordering import with_position
from quarry.plans.tables import table


def region_segment_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    cust = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    counts = cust.groupBy("c_nationkey", "c_mktsegment").agg(F.count(F.lit(1)).cast("double").alias("weight"))
    return counts.join(nation, counts["c_nationkey"] == nation["n_nationkey"]).select(
        F.col("n_regionkey").alias("grp"), F.col("c_nationkey").cast("string").alias("x"),
        F.col("c_mktsegment").alias("y"), "weight")


def max_weight_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, totals = _mwa(region_segment_edges(spark, sf_dir))
    return totals.select(F.col("grp").alias("region"), F.round("total", 6).alias("total"), "n_pairs")


def assignment_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The matched cells: each is an edge or an absent cell, no end twice, and they add up to the total."""
    edges = region_segment_edges(spark, sf_dir)
    pairs, _ = _mwa(edges)
    known = pairs.alias("p").join(edges.alias("e"), F.expr("p.grp = e.grp AND p.x = e.x AND p.y = e.y"), "left").select(
        F.col("p.grp").alias("region"), F.col("p.x").alias("x"), F.col("p.y").alias("y"), F.col("p.weight").alias("w"),
        F.coalesce("e.weight", F.lit(0.0)).alias("edge"))
    return known.groupBy("region").agg(F.round(F.sum("edge"), 6).alias("total"), F.countDistinct("x").alias("xs"),
                                       F.countDistinct("y").alias("ys"), F.sum(F.abs(F.col("w") - F.col("edge"))).alias("off"))


def sparse_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only nations and segments with more than their region's mean count have an edge: many absent cells."""
    edges = region_segment_edges(spark, sf_dir)
    mean = edges.groupBy("grp").agg((F.sum("weight") / F.count(F.lit(1))).alias("mean"))
    kept = edges.join(mean, "grp").where(F.col("weight") > F.col("mean")).drop("mean")
    _, totals = _mwa(kept)
    return totals.select(F.col("grp").alias("region"), F.round("total", 6).alias("total"))


def large_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations against part brands, weight = customers of the nation times parts of the brand: the
    optimum pairs the two in order of their counts."""
    nations = table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("x")).agg(F.count(F.lit(1)).alias("a"))
    brands = table(spark, sf_dir, "part").groupBy(F.col("p_brand").alias("y")).agg(F.count(F.lit(1)).alias("b"))
    # Every nation with every brand, by their numbers (25 and 25, whatever the size of the tables).
    nations = with_position(nations, ["x"], pos_col="i")
    brands = with_position(brands, ["y"], pos_col="j")
    n, m = nations.count(), brands.count()
    cells = (spark.range(n * m).select(F.floor(F.col("id") / max(m, 1)).alias("i"), (F.col("id") % max(m, 1)).alias("j"))
             .join(nations, "i").join(brands, "j")
             .select(F.lit(0).alias("grp"), "x", "y", (F.col("a") * F.col("b")).cast("double").alias("weight")))
    _, totals = _mwa(cells)
    return totals.select("total", "n_pairs")


QUERIES = {"max_weight_assignment": max_weight_assignment, "assignment_pairs": assignment_pairs,
           "sparse_assignment": sparse_assignment, "large_assignment": large_assignment}


def _best_totals(cells: str) -> str:
    """Every one-to-one mapping of the 5 nations of a region onto the 5 segments; ``cells`` weighs them."""
    k = 5
    perms = " UNION ALL ".join("SELECT " + ", ".join(f"{v} AS p{i + 1}" for i, v in enumerate(p))
                               for p in itertools.permutations(range(1, k + 1)))
    joins = " ".join(f"JOIN cells c{i} ON c{i}.region = nr.region AND c{i}.ni = {i} AND c{i}.si = perms.p{i}"
                     for i in range(1, k + 1))
    total = " + ".join(f"c{i}.w" for i in range(1, k + 1))
    return f"""
WITH nat AS (SELECT n_regionkey AS region, n_nationkey,
                    row_number() OVER (PARTITION BY n_regionkey ORDER BY CAST(n_nationkey AS VARCHAR)) AS ni
             FROM nation),
seg AS (SELECT c_mktsegment, row_number() OVER (ORDER BY c_mktsegment) AS si
        FROM (SELECT DISTINCT c_mktsegment FROM customer)),
cnt AS (SELECT c_nationkey, c_mktsegment, count(*)::DOUBLE AS w FROM customer GROUP BY 1, 2),
means AS (SELECT n_regionkey AS region, avg(w) AS mean FROM cnt JOIN nation ON c_nationkey = n_nationkey GROUP BY 1),
cells AS (SELECT nat.region, nat.ni, seg.si, {cells} AS w
          FROM nat CROSS JOIN seg JOIN means ON means.region = nat.region
          LEFT JOIN cnt ON cnt.c_nationkey = nat.n_nationkey AND cnt.c_mktsegment = seg.c_mktsegment),
perms AS ({perms}),
nr AS (SELECT DISTINCT region FROM nat),
best AS (SELECT nr.region, round(max({total}), 6) AS total FROM nr CROSS JOIN perms {joins} GROUP BY nr.region)"""


def oracle() -> dict[str, str]:
    every, above = _best_totals("coalesce(cnt.w, 0.0)"), _best_totals("CASE WHEN cnt.w > mean THEN cnt.w ELSE 0.0 END")
    return {
        "max_weight_assignment": f"{every} SELECT region, total, 5::BIGINT AS n_pairs FROM best",
        "assignment_pairs": f"{every} SELECT region, total, 5::BIGINT AS xs, 5::BIGINT AS ys, 0.0::DOUBLE AS off FROM best",
        "sparse_assignment": f"{above} SELECT region, total FROM best",
        "large_assignment": """
WITH a AS (SELECT count(*)::DOUBLE AS n, row_number() OVER (ORDER BY count(*) DESC) AS k FROM customer GROUP BY c_nationkey),
b AS (SELECT count(*)::DOUBLE AS n, row_number() OVER (ORDER BY count(*) DESC) AS k FROM part GROUP BY p_brand)
SELECT sum(a.n * b.n) AS total, count(*) AS n_pairs FROM a JOIN b USING (k)""",
    }
