"""Histograms, densities and coverage shares."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locusframe.session import broadcast_checked


def _bin(v, mn, mx, n_bins: int):
    return F.when(mx == mn, F.lit(0).cast("long")).otherwise(
        F.least(F.floor((v - mn) * n_bins / (mx - mn).cast("double")).cast("long"), F.lit(n_bins - 1).cast("long")))


def metric_histogram(df: DataFrame, value: str, n_bins: int = 20, by: list[str] | None = None) -> DataFrame:
    """Equal-width histogram of ``value`` per group (bins span the group's
    min..max; the max falls in the last bin). Every group has all its bins,
    empty ones with 0; a group without any value has none."""
    by = by or []
    df = df.where(F.col(value).isNotNull())
    ext = df.groupBy(*by).agg(F.min(value).alias("_mn"), F.max(value).alias("_mx")).where("_mn IS NOT NULL")
    if by:
        j = df.join(broadcast_checked(ext), by)
    else:  # one extent row: broadcast it (proven size 1) on a constant key
        j = df.withColumn("_k", F.lit(1)).join(F.broadcast(ext.withColumn("_k", F.lit(1))), "_k").drop("_k")
    b = j.select(*by, _bin(F.col(value), F.col("_mn"), F.col("_mx"), n_bins).alias("bin"))
    return _all_bins(ext, b, by, n_bins, "n")


def _all_bins(ext: DataFrame, binned: DataFrame, by: list[str], n_bins: int, out: str) -> DataFrame:
    """Rows per bin of every group of ``ext``, empty bins included: one empty
    row per bin is added before counting, so no join is needed."""
    empty = ext.select(*by, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_bins - 1).cast("long"))).alias("bin"), F.lit(0).alias("_one"))
    rows = binned.select(*by, "bin", F.lit(1).alias("_one")).unionByName(empty)
    return rows.groupBy(*by, "bin").agg(F.sum("_one").cast("long").alias(out))


def position_density(points: DataFrame, sites: DataFrame, n_bins: int = 30, contig: str = "contig",
                     pos: str = "pos", out: str = "snp_copies") -> DataFrame:
    """Count of ``points`` rows in ``n_bins`` equal bins spanning each
    contig's site positions (min..max), empty bins with 0."""
    ext = sites.groupBy(contig).agg(F.min(pos).alias("_mn"), F.max(pos).alias("_mx"))
    j = points.join(broadcast_checked(ext), contig)
    b = j.select(contig, _bin(F.col(pos), F.col("_mn"), F.col("_mx"), n_bins).alias("bin"))
    return _all_bins(ext, b, [contig], n_bins, out)


def depth_coverage(depths: DataFrame, thresholds: list[int], depth: str = "depth") -> DataFrame:
    """Share of rows with depth >= each threshold."""
    t = depths.select(depth, F.explode(F.array(*[F.lit(x) for x in thresholds])).alias("threshold"))
    return t.groupBy("threshold").agg(
        F.avg(F.when(F.col(depth) >= F.col("threshold"), 1.0).otherwise(0.0)).alias("share"))


def cumulative_depths(depths: DataFrame, key: str, depth: str = "depth", most: int = 500) -> DataFrame:
    """One row per key: ``cum``, an array of ``most`` + 1 counts; place d holds
    the rows with at least that depth (deeper ones count up to ``most``). Only
    counts per depth meet, at most ``most`` + 1 a key."""
    capped = F.least(F.greatest(F.col(depth), F.lit(0)), F.lit(most)).cast("int")
    n = depths.where(F.col(depth).isNotNull()).groupBy(key, capped.alias("_d")).agg(F.count(F.lit(1)).alias("_n"))
    g = n.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("_d", "_n")), asc=False).alias("_a"))
    # from the deepest down: the running count, held at every depth down to the next one
    start = F.struct(F.expr("cast(array() as array<bigint>)").alias("cum"), F.lit(0).cast("long").alias("n"))

    def step(s, x):
        gap = F.lit(most) - x["_d"] - F.size(s["cum"])
        total = s["n"] + x["_n"]
        return F.struct(F.concat(s["cum"], F.array_repeat(s["n"], gap), F.array(total)).alias("cum"), total.alias("n"))

    done = F.aggregate("_a", start, step, lambda s: F.concat(s["cum"], F.array_repeat(s["n"], F.lit(most + 1) - F.size(s["cum"]))))
    return g.select(key, F.reverse(done).alias("cum"))


def coverage_of_rows(rows: DataFrame, key: str, thresholds: list[int], cum: str = "cum") -> DataFrame:
    """Share of bases at each threshold from cumulative rows (place 0: all);
    a threshold beyond the row, and a row of zeros, give null."""
    t = F.explode(F.array(*[F.lit(x) for x in thresholds])).alias("threshold")
    share = F.when(F.get(cum, F.lit(0)) > 0, F.get(cum, F.col("threshold")) / F.get(cum, F.lit(0)))
    return rows.select(key, cum, t).select(key, "threshold", share.alias("share"))


def per_contig_sample_counts(carried: DataFrame) -> DataFrame:
    """Per (sample, contig): insertion, deletion, transition, transversion
    copies from carried-allele rows with ``vclass``."""
    v = F.col("vclass")
    return carried.groupBy("sid", "contig").agg(
        F.sum(F.when(v == "in", 1).otherwise(0)).cast("long").alias("n_insertion"),
        F.sum(F.when(v == "de", 1).otherwise(0)).cast("long").alias("n_deletion"),
        F.sum(F.when(v == "ts", 1).otherwise(0)).cast("long").alias("n_ti"),
        F.sum(F.when(v == "tv", 1).otherwise(0)).cast("long").alias("n_tv"))


def roll_sum(per: DataFrame, key: str) -> DataFrame:
    """Sum per-contig tables per sample; indels = insertions + deletions and
    Ti/Tv recomputed from the sums (never averaged)."""
    g = per.groupBy(key).agg(*[F.sum(c).cast("long").alias(c) for c in ("n_insertion", "n_deletion", "n_ti", "n_tv")])
    return g.withColumns({"n_indel": F.col("n_insertion") + F.col("n_deletion"),
                          "ti_tv": F.when(F.col("n_tv") > 0, F.col("n_ti") / F.col("n_tv"))})
