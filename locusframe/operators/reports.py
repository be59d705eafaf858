"""Per-sample report tables and call-set merging/annotation joins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sample_site_summary(calls: DataFrame, sites: DataFrame, key: str = "vid"):
    """Three per-sample summaries as a QC report lays them out:
    (filter_label, sid, n_sites) for called genotypes by site filter,
    (sid, n_snp, n_indel) and (sid, n_ti) over carrying genotypes (first
    ALT decides the class)."""
    s = sites.select(key, F.when(F.col("filter") == "PASS", "called").otherwise("filtered").alias("filter_label"),
                     F.upper("ref").alias("_r"), F.upper(F.split("alt", ",").getItem(0)).alias("_a"))
    j = calls.select(key, "sid", "a1", "a2").join(s, key)
    called = ~(F.col("a1").isNull() & F.col("a2").isNull())
    summ = j.where(called).groupBy("filter_label", "sid").agg(F.count(F.lit(1)).alias("n_sites"))
    carry = j.where((F.col("a1") > 0) | (F.col("a2") > 0))
    same = F.length("_r") == F.length("_a")
    cls = carry.groupBy("sid").agg(F.sum(F.when(same, 1).otherwise(0)).cast("long").alias("n_snp"),
                                   F.sum(F.when(~same, 1).otherwise(0)).cast("long").alias("n_indel"))
    ti = F.concat("_r", "_a").isin("AG", "GA", "CT", "TC")
    titv = carry.groupBy("sid").agg(F.sum(F.when(ti, 1).otherwise(0)).cast("long").alias("n_ti"))
    return summ, cls, titv


def report_join(summary: DataFrame, snp_indel: DataFrame, titv: DataFrame, label: str = "called") -> DataFrame:
    """Summary rows of one filter label, left-joined with the two other
    per-sample tables."""
    base = summary.where(F.col("filter_label") == label).drop("filter_label")
    return base.join(snp_indel, "sid", "left").join(titv, "sid", "left")


def cohort_merge(sets: list[DataFrame], keys: list[str]) -> DataFrame:
    """Stack call sets on the site key (absent genotypes stay absent, i.e.
    missing, in the sparse long form) and report how many sets carry each
    site (``n_sets``)."""
    tagged = [s.withColumn("_set", F.lit(i)) for i, s in enumerate(sets)]
    u = reduce(lambda a, b: a.unionByName(b), tagged)
    n = u.groupBy(*keys).agg(F.countDistinct("_set").alias("n_sets"))
    return u.join(n, keys).drop("_set")


def annotate_exact(df: DataFrame, ann: DataFrame, keys: list[str], fields: list[str], prefix: str) -> DataFrame:
    """Left join annotation fields by exact key, renamed with a prefix."""
    a = ann.select(*keys, *[F.col(c).alias(prefix + c) for c in fields])
    return df.join(a, keys, "left")
