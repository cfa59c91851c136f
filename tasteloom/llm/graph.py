"""Connected components of an edge table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tasteloom.llm.common import write_stage


_SHARE = 1000   # a node with more than this part of all rows is met by broadcast: at most so many are


def _mark(edges: DataFrame) -> tuple:
    return edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()


def _with_least(edges: DataFrame, count: int) -> DataFrame:
    """``a, b, m``: every row with the smallest of ``a`` and its ``b``; ``count`` is the number of rows.

    The rows of a node that has more than its share stay where they are and meet the
    value by broadcast, so no task gets all of a star's centre.
    """
    least = edges.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"), F.count("*").alias("c"))
    least = write_stage(least, "least")
    heavy = F.broadcast(least.filter(F.col("c") > count / _SHARE).select("a", "m"))
    light = least.filter(F.col("c") <= count / _SHARE).select("a", "m")
    return edges.join(heavy, "a").unionByName(edges.join(heavy, "a", "left_anti").join(light, "a"))


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, root``: every node of an edge and the smallest node it is connected with.

    Edges are pairs of bigints without order; loops, repeats and nulls do no harm.
    In turns each node's larger neighbours, then its smaller ones, are tied to the
    smallest neighbour, until all that is left are stars around the roots. Each
    step is an aggregation and a join over the edges, written to the shared folder.
    """
    low, high = F.least(a, b), F.greatest(a, b)
    now = write_stage(edges.select(high.alias("a"), low.alias("b")).filter("a IS NOT NULL AND b IS NOT NULL AND a != b")
                      .distinct(), "edges")
    mark = _mark(now)
    while mark[0]:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _with_least(both, 2 * mark[0]).filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = write_stage(large.distinct(), "large-star")
        tied = _with_least(large, mark[0])
        small = tied.select(F.inline(F.array(F.struct(F.col("a"), F.col("m").alias("b")),
                                             F.struct(F.col("b").alias("a"), F.col("m").alias("b")))))
        now = write_stage(small.filter("a != b").distinct(), "small-star")
        before, mark = mark, _mark(now)
        if before == mark:
            break
    roots = now.select(F.col("b").alias("node")).distinct().withColumn("root", F.col("node"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
