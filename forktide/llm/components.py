"""Connected components by alternating large-star and small-star steps (Kiveris et al., 2014), on DataFrames.

Each round is two aggregations and joins over the edges, written to the shared folder; the number of rounds grows with the
logarithm of the graph's size.  Neighbours are never gathered: a node takes the minimum of theirs, summed before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import remove, shared_dir, written


def _towards_minimum(edges: DataFrame, small: bool) -> DataFrame:
    """edges (a > b).  Every node's larger (small: not larger) neighbours are linked to the least of all it sees."""
    if small:
        sees = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    else:
        sees = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = sees.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    joined = sees.join(least, "u")
    if small:
        linked = joined.select(F.col("v").alias("a"), F.col("m").alias("b")).unionAll(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    else:
        linked = joined.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return linked.where("a > b").distinct()


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """edges (a long, b long) -> (node, component): the least node of each node's component; nodes without edges are absent."""
    spark, path = edges.sparkSession, shared_dir(edges.sparkSession)
    stars = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), path)
    mark = _mark(stars)
    while mark[0]:
        last, path = path, shared_dir(spark)
        stars = written(_towards_minimum(_towards_minimum(stars, small=False), small=True), path)
        remove(spark, last)
        before, mark = mark, _mark(stars)
        if mark == before:
            break
    roots = stars.select(F.col("b").alias("node")).distinct().withColumn("component", F.col("node"))
    return stars.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(roots)
