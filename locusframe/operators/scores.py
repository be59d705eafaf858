"""Polygenic scores: all score files in one job, matched by variant id with
the effect allele required to be REF or one of the ALTs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locusframe.operators.dedupe import dedupe_exclude_all


def score_match(weights: DataFrame, sites: DataFrame, id_col: str = "rsid") -> DataFrame:
    """Join score rows (pgs, rsid, allele, beta) to sites with a unique id.
    ``eff`` = 0 when the effect allele is REF, the 1-based ALT index when it
    is an ALT, -1 when it is neither; ``reason`` = ok / no_id / no_allele."""
    uniq = dedupe_exclude_all(sites.select("vid", id_col, "ref", "alt"), id_col)
    j = weights.join(uniq, id_col, "left")
    eff = F.when(F.col("allele") == F.col("ref"), F.lit(0)).when(
        F.array_position(F.split("alt", ","), F.col("allele")) > 0,
        F.array_position(F.split("alt", ","), F.col("allele")).cast("int")).otherwise(F.lit(-1))
    reason = F.when(F.col("vid").isNull(), "no_id").when(F.col("eff") < 0, "no_allele").otherwise("ok")
    return j.withColumn("eff", F.when(F.col("vid").isNotNull(), eff)).withColumn("reason", reason)


def polygenic_score(calls: DataFrame, sites: DataFrame, weights: DataFrame,
                    id_col: str = "rsid") -> tuple[DataFrame, DataFrame]:
    """Per (pgs, sample): score = sum(beta * effect-allele copies) / called
    alleles over matched sites; missing alleles add nothing to either sum.
    Weights are added as whole numbers of 10 ** -12, in two parts of six
    places that cannot overflow, so the sum is the same in any order.  Returns (scores, unmatched score rows with their reason)."""
    m = score_match(weights, sites, id_col)
    places = F.col("beta").cast("decimal(28,12)") * F.lit(10 ** 6)
    ok = m.where(F.col("reason") == "ok").select(
        "pgs", "vid", "eff", F.floor(places).cast("long").alias("_hi"),
        ((places - F.floor(places)) * F.lit(10 ** 6)).cast("long").alias("_lo"))
    known = (F.when(F.col("a1").isNotNull(), 1).otherwise(0) + F.when(F.col("a2").isNotNull(), 1).otherwise(0))
    copies = (F.when(F.col("a1") == F.col("eff"), 1).otherwise(0) + F.when(F.col("a2") == F.col("eff"), 1).otherwise(0))
    j = calls.select("vid", "sid", "a1", "a2").join(ok, "vid")
    g = j.groupBy("pgs", "sid").agg(F.sum(known).cast("long").alias("n_alleles"),
                                    F.sum(F.col("_hi") * copies).alias("_hi"), F.sum(F.col("_lo") * copies).alias("_lo"))
    whole = F.col("_hi").cast("decimal(20,0)") * F.lit(10 ** 6) + F.col("_lo").cast("decimal(20,0)")
    g = g.select("pgs", "sid", "n_alleles", (whole.cast("decimal(38,12)") / F.lit(10 ** 12)).cast("double").alias("score_sum"))
    g = g.where(F.col("n_alleles") > 0).withColumn("score", F.col("score_sum") / F.col("n_alleles"))
    report = m.where(F.col("reason") != "ok").select("pgs", id_col, "allele", "reason")
    return g, report
