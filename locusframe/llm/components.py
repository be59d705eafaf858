"""Connected components of a graph given as links, by alternating large-star
and small-star steps. Every step is joins and grouped minima; each round is
written to the shared folder. Nothing is collected but two numbers a round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locusframe.llm.common import lookup, stored


def _least(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("w"))


def _to_least(pairs: DataFrame) -> DataFrame:
    total = pairs.agg(F.count(F.lit(1)).alias("total"))
    return lookup(pairs, _least(pairs), "u", "w", total).withColumn("m", F.least("u", "m"))


def _state(links: DataFrame) -> tuple[int, int]:
    got = links.agg(F.count(F.lit(1)).alias("n"),
                    F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
    return int(got["n"]), int(got["s"] or 0)


def connected_components(links: DataFrame) -> DataFrame:
    """``links`` has long columns u, v. Returns (node, label) for every node
    that has a link; the label is the smallest node of its component. Loops
    and repeated links are allowed; an empty input gives no rows."""
    down = F.struct(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    links = stored(links.filter("u != v").select(down.alias("x")).select("x.*").distinct(), "links")
    seen = _state(links)
    while seen[0]:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _to_least(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v")
        large = stored(large.distinct(), "large-star")
        small = _to_least(large)
        links = small.select("u", F.col("m").alias("v")).unionByName(
            small.select(F.col("v").alias("u"), F.col("m").alias("v"))).filter("u != v").distinct()
        links = stored(links, "small-star")
        now = _state(links)
        if now == seen:
            break
        seen = now
    roots = links.select(F.col("v").alias("node")).distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(
        roots.select("node", F.col("node").alias("label")))
