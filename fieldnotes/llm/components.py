"""Connected components of a table of links, by alternating stars.

Every step is a grouped minimum and a join on narrow rows; its result is
written to the shared folder, so the lineage stays short and nothing is
gathered on the driver but a count and a checksum. Both stars only ever
replace a neighbour by a smaller one, so the rounds end by themselves.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldnotes.llm.common import stage, unstage


def _mark(links: DataFrame) -> tuple[int, int]:
    """Number of links and their checksum: equal when a round changed nothing."""
    got = links.agg(F.count(F.lit(1)).alias("n"),
                    F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("sum")).first()
    return got["n"], got["sum"]


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of ``links`` (a, b: long), where the
    component is named by its smallest node."""
    now = stage(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                .where("a != b").distinct(), "links")
    mark = _mark(now)
    while mark[0]:
        # large star: neighbours above a node go to the smallest of its neighbourhood
        both = now.union(now.select("b", "a"))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        large = (both.where("b > a").join(low, "a")
                 .select(F.col("b").alias("a"), F.col("low").alias("b")).where("a != b"))
        # small star: neighbours below a node, and itself, go to the smallest of them
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).union(low)
        before, now = now, stage(small.where("a != b").distinct(), "links")
        unstage(before)
        was, mark = mark, _mark(now)
        if mark == was:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
