"""Genomic interval operators: binned range joins, merging, buffered islands,
equal-span regions, nearest feature, remapping.

Coordinates are half-open ``[start, end)`` unless stated.  Range joins use
fixed-width bins: each interval is exploded to the bins it touches and the
join is an equi join on (contig, bin) plus the exact predicate, so Spark can
hash-partition it; a pair of intervals is kept only in the bin holding
``max(start_a, start_b)``, which makes each pair appear once without a
``distinct``.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from locusframe.operators.scan import prefix_scan
from locusframe.session import cut_lineage

DEFAULT_BIN = 100_000


def _bins(start, end, width: int):
    """Array of bin ids touched by half-open [start, end) (end > start)."""
    s = F.floor(F.col(start) / width).cast("long")
    e = F.floor((F.greatest(F.col(end), F.col(start) + 1) - 1) / width).cast("long")
    return F.sequence(s, e)


def explode_bins(iv: DataFrame, start: str = "start", end: str = "end", width: int = DEFAULT_BIN,
                 out: str = "_bin") -> DataFrame:
    return iv.withColumn(out, F.explode(_bins(start, end, width)))


def fitted_width(frames: list[DataFrame], start: str, end: str, most: int) -> int:
    """The mean length of the intervals of all frames, at most ``most``. Bins
    of this width hold no more than about two rows an interval, whatever the mix
    of lengths, and about as many pairs that do not overlap as pairs that do."""
    spans = [df.select(F.greatest(F.col(end) - F.col(start), F.lit(1)).alias("n")) for df in frames]
    mean = reduce(DataFrame.unionByName, spans).agg(F.avg("n")).first()[0]
    return max(1, min(most, math.ceil(mean or 1)))


def points_in_intervals(points: DataFrame, intervals: DataFrame, pos: str = "pos",
                        contig: str = "contig", start: str = "start", end: str = "end",
                        width: int = DEFAULT_BIN, how: str = "inner") -> DataFrame:
    """Join each point to every interval with ``start <= pos < end`` on the
    same contig (``how`` = inner, left, left_semi or left_anti)."""
    p = points.withColumn("_bin", F.floor(F.col(pos) / width).cast("long"))
    iv = explode_bins(intervals.withColumnRenamed(contig, "_ic"), start, end, width)
    cond = ((p[contig] == iv["_ic"]) & (p["_bin"] == iv["_bin"])
            & (iv[start] <= p[pos]) & (p[pos] < iv[end]))
    j = p.join(iv, cond, how)
    if how in ("left_semi", "left_anti"):
        return j.drop("_bin")
    return j.drop("_bin", "_ic")


def overlap_pairs(a: DataFrame, b: DataFrame, width: int = DEFAULT_BIN, contig: str = "contig",
                  start: str = "start", end: str = "end", suffixes=("_a", "_b")) -> DataFrame:
    """All overlapping pairs (a, b) on the same contig, each pair once.
    Columns of each side get the given suffixes. ``width`` is the widest bin:
    where the intervals are shorter, so are the bins, or nearly all pairs of a bin
    would be compared for nothing."""
    sa, sb = suffixes
    width = fitted_width([a] if a is b else [a, b], start, end, width)
    ra = explode_bins(a, start, end, width).select(
        *[F.col(c).alias(c + sa) for c in a.columns], F.col("_bin"))
    rb = explode_bins(b, start, end, width).select(
        *[F.col(c).alias(c + sb) for c in b.columns], F.col("_bin").alias("_bin_b"))
    cond = ((ra[contig + sa] == rb[contig + sb]) & (ra["_bin"] == rb["_bin_b"])
            & (ra[start + sa] < rb[end + sb]) & (rb[start + sb] < ra[end + sa]))
    j = ra.join(rb, cond)
    home = F.floor(F.greatest(F.col(start + sa), F.col(start + sb)) / width).cast("long")
    return j.where(F.col("_bin") == home).drop("_bin", "_bin_b")


def merge_intervals(iv: DataFrame, contig: str = "contig", start: str = "start", end: str = "end",
                    width: int = DEFAULT_BIN) -> DataFrame:
    """Merge overlapping or touching intervals per contig -> (contig, start,
    end).  Duplicate starts are pre-aggregated (map-side), so a hot position
    cannot overload a task; the running max of ``end`` is a bucketed prefix
    scan (see :mod:`locusframe.operators.scan`)."""
    d = cut_lineage(iv.groupBy(contig, start).agg(F.max(end).alias(end))
                    .withColumn("_bk", F.floor(F.col(start) / width).cast("long")))
    d = prefix_scan(d, [contig], ["_bk"], [start], F.col(end), "max", inclusive=False, out="_prev")
    d = d.withColumn("_new", F.when(F.col("_prev").isNull() | (F.col(start) > F.col("_prev")), 1).otherwise(0))
    d = prefix_scan(cut_lineage(d), [contig], ["_bk"], [start], F.col("_new"), "sum", inclusive=True, out="_grp")
    return d.groupBy(contig, "_grp").agg(F.min(start).alias(start), F.max(end).alias(end)).drop("_grp")


def buffer_positions(pos_df: DataFrame, buffer: int, pos: str = "pos") -> DataFrame:
    """Add ``lower = max(pos - buffer, 1)`` and ``upper = pos + buffer``."""
    p = F.col(pos)
    return pos_df.withColumns({"lower": F.greatest(p - F.lit(buffer), F.lit(1)), "upper": p + F.lit(buffer)})


def buffered_islands(positions: DataFrame, buffer: int, contig: str = "contig", pos: str = "pos",
                     width: int = DEFAULT_BIN) -> DataFrame:
    """Merge the buffers around positions into islands -> (contig, start,
    end) with start = lowest lower bound and end = highest upper bound; a new
    island starts when a buffer's lower bound is above the previous upper
    bound (touching buffers join)."""
    b = buffer_positions(positions.select(contig, pos), buffer, pos)
    return merge_intervals(b.select(contig, F.col("lower").alias("start"), F.col("upper").alias("end")),
                           contig, "start", "end", width)


def equal_span_regions(islands: DataFrame, contig_rank: DataFrame, max_span: int,
                       contig: str = "contig", start: str = "start", end: str = "end",
                       width: int = 10_000_000) -> DataFrame:
    """Cut the islands, concatenated in (contig rank, contig, start) order, into N =
    ceil(S / max_span) pieces of T = ceil(S / N) span (S = total span,
    span = end - start); one output row per (region, contig) with the lowest
    start and highest end of the pieces there.  ``contig_rank`` has
    (contig, rank)."""
    isl = cut_lineage(islands.join(contig_rank, contig))
    total = isl.agg(F.sum(F.col(end) - F.col(start)).alias("s")).first()["s"] or 0
    if total == 0:
        return isl.limit(0).select(F.lit(0).alias("region"), contig, start, end)
    n = math.ceil(total / max_span)
    t = math.ceil(total / n)
    isl = isl.withColumn("_bk", F.floor(F.col(start) / width).cast("long"))
    isl = prefix_scan(isl, [], ["rank", contig, "_bk"], [start], (F.col(end) - F.col(start)).cast("long"),
                      "sum", inclusive=False, out="_c0")
    span = F.col(end) - F.col(start)
    k = F.explode(F.sequence(F.floor(F.col("_c0") / t).cast("long"),
                             F.floor((F.col("_c0") + span - 1) / t).cast("long")))
    pieces = isl.select(contig, start, end, "_c0", k.alias("region"))
    ps = F.col(start) + F.greatest(F.col("region") * t - F.col("_c0"), F.lit(0))
    pe = F.col(start) + F.least((F.col("region") + 1) * t - F.col("_c0"), span)
    pieces = pieces.select("region", contig, ps.alias("p_start"), pe.alias("p_end"))
    return pieces.groupBy("region", contig).agg(F.min("p_start").alias(start), F.max("p_end").alias(end))


def _nearest_by_bins(points: DataFrame, features: DataFrame, reach: int, width: int) -> DataFrame:
    """Every point with every feature in reach -> (_k, distance, _f)."""
    grown = features.withColumns({"_gs": F.greatest(F.col("_s") - reach, F.lit(0)), "_ge": F.col("_e") + reach})
    j = points_in_intervals(points, grown, "_p", "_c", "_gs", "_ge", width)
    dist = F.greatest(F.col("_s") - F.col("_p"), F.col("_p") - (F.col("_e") - 1), F.lit(0))
    return j.select("_k", dist.alias("distance"), "_f").where(F.col("distance") <= reach)


def _nearest_beside(points: DataFrame, features: DataFrame, reach: int, width: int) -> DataFrame:
    """Every point with the last end at or before it and with the first start
    after it, as far as in reach, each with its smallest name -> (_k, distance, _f).
    Ends are one row a position, kept in the buckets of the points that they
    reach (one or two), likewise starts."""
    wide = max(width, reach, 1)

    def edges(at: str, last: int) -> DataFrame:
        near = F.array_distinct(F.array(F.floor(F.col(at) / wide), F.floor((F.col(at) + last) / wide)))
        one = features.groupBy(at, "_c").agg(F.min(F.struct("_f")).alias("_n"))
        return one.select("_c", F.explode(near).alias("_bk"), F.col(at).alias("_x"), F.lit(0).alias("_t"),
                          F.struct(F.col(at), F.col("_n")).alias("_v" + at))

    marks = points.select("_c", F.floor(F.col("_p") / wide).alias("_bk"), F.col("_p").alias("_x"), F.lit(1).alias("_t"), "_k")
    rows = (edges("_e", reach).unionByName(edges("_s", -reach), allowMissingColumns=True)
            .unionByName(marks, allowMissingColumns=True))
    # at one position the edges come before the points, read backwards after them
    within = Window.partitionBy("_bk", "_c").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seen = rows.withColumns({"_l": F.last("_v_e", True).over(within.orderBy("_x", "_t")),
                             "_r": F.last("_v_s", True).over(within.orderBy(F.desc("_x"), F.desc("_t")))}).where("_t = 1")
    left = F.struct((F.col("_x") - (F.col("_l._e") - 1)).alias("distance"), F.col("_l._n._f").alias("_f"))
    right = F.struct((F.col("_r._s") - F.col("_x")).alias("distance"), F.col("_r._n._f").alias("_f"))
    return seen.select("_k", F.inline(F.array(left, right))).where(F.col("distance") <= reach)


def _nearest_inside(points: DataFrame, features: DataFrame, levels: int) -> DataFrame:
    """Every point in a feature with the smallest name of those that hold it, at
    distance 0 -> (_k, distance, _f). A feature is cut into blocks of lengths
    2^k at multiples of 2^k (at most two a level), a block keeps the smallest
    name, and a point asks its block of each level; no pairs of point and feature are made."""
    s, e = F.col("_s").cast("long"), F.col("_e").cast("long")

    def ident(block, k: int):
        return F.shiftleft(block, 6).bitwiseOR(F.lit(k).cast("long"))

    cut = []
    for k in range(levels):
        lo, hi = -F.shiftright(-s, k), F.shiftright(e, k)
        cut += [F.when((lo < hi) & (lo.bitwiseAND(1) == 1), ident(lo, k)),
                F.when((lo < hi) & (hi.bitwiseAND(1) == 1), ident(hi - 1, k))]
    blocks = (features.select("_c", "_f", F.explode(F.array_compact(F.array(*cut))).alias("_b"))
              .groupBy("_b", "_c").agg(F.min(F.struct("_f")).alias("_n")))
    asked = points.select("_k", "_c", F.explode(F.array(*[ident(F.shiftright(F.col("_p").cast("long"), k), k)
                                                          for k in range(levels)])).alias("_b"))
    # the planner takes the points for what they were before they were sent once a level
    return asked.hint("merge").join(blocks, ["_b", "_c"]).select("_k", F.lit(0).alias("distance"), F.col("_n._f").alias("_f"))


def nearest_feature(points: DataFrame, features: DataFrame, max_distance: int,
                    pos: str = "pos", contig: str = "contig", start: str = "start", end: str = "end",
                    name: str = "name", key: str = "vid", width: int = DEFAULT_BIN) -> DataFrame:
    """For each point, the feature with the smallest distance
    ``max(start - pos, pos - (end - 1), 0)`` within ``max_distance`` (ties by
    name).  Points without a feature in range are not returned.  The work grows
    with points and features, not with the features in reach of a point."""
    p = points.select(F.col(key).alias("_k"), F.col(contig).alias("_c"), F.col(pos).alias("_p")).where("_c IS NOT NULL AND _p >= 0")
    # a feature without a start begins at 0
    f = features.select(F.col(contig).alias("_c"), F.col(name).alias("_f"), F.coalesce(F.col(start), F.lit(0)).alias("_s"),
                        F.col(end).alias("_e")).where("_c IS NOT NULL AND _e IS NOT NULL")
    size = f.agg(F.max(F.col("_e") - F.col("_s")).alias("longest"), F.min(F.col("_e") - F.col("_s")).alias("least")).first()
    found = _nearest_beside(p, f.where("_e >= _s"), max_distance, width)
    if (size["longest"] or 0) > 0:
        found = found.unionByName(_nearest_inside(p, f.where("_e > _s"), int(size["longest"]).bit_length()))
    if (size["least"] or 0) < 0:  # ends before its start: near both ways at once
        found = found.unionByName(_nearest_by_bins(p, f.where("_e < _s"), max_distance, width))
    best = found.groupBy("_k").agg(F.min(F.struct("distance", "_f")).alias("_b"))
    return best.select(F.col("_k").alias(key), F.col("_b._f").alias("feature"), F.col("_b.distance").alias("distance"))


def interval_remap(iv: DataFrame, blocks: DataFrame, contig: str = "contig", start: str = "start",
                   end: str = "end", width: int = DEFAULT_BIN) -> tuple[DataFrame, DataFrame]:
    """Move intervals through alignment blocks (src, block_start, block_end,
    dst, shift): an interval maps when both ends fall in one block; returns
    (mapped, unmapped).  Blocks on one source contig must not overlap."""
    b = blocks.select(F.col("src").alias("_src"), F.col("block_start").alias("_bs"),
                      F.col("block_end").alias("_be"), "dst", "shift")
    rb = explode_bins(b, "_bs", "_be", width, "_bin")
    ri = iv.withColumn("_bin", F.floor(F.col(start) / width).cast("long"))
    cond = ((ri[contig] == rb["_src"]) & (ri["_bin"] == rb["_bin"]) & (rb["_bs"] <= ri[start])
            & (ri[end] <= rb["_be"]))
    mapped = (ri.join(rb, cond).select(*[c for c in iv.columns if c not in (contig, start, end)],
                                       F.col(contig).alias("src_contig"),
                                       F.col(start).alias("src_start"), F.col(end).alias("src_end"),
                                       F.col("dst").alias(contig),
                                       (F.col(start) + F.col("shift")).alias(start),
                                       (F.col(end) + F.col("shift")).alias(end)))
    unmapped = ri.join(rb, cond, "left_anti").drop("_bin")
    return mapped, unmapped


def interval_lengths(iv: DataFrame, contig: str = "contig", start: str = "start", end: str = "end") -> DataFrame:
    return iv.groupBy(contig).agg(F.sum(F.col(end) - F.col(start)).cast("long").alias("total_length"))


def contig_extent(iv: DataFrame, contig: str = "contig", start: str = "start", end: str = "end") -> DataFrame:
    return iv.groupBy(contig).agg(F.min(start).alias("min_start"), F.max(end).alias("max_end"))


def natural_contig_rank(contig: str = "contig"):
    """Natural (``-V``) order key for chr1..chr22, X, Y, M and others."""
    c = F.regexp_replace(F.col(contig), "^chr", "")
    num = c.try_cast("int")
    return (F.when(num.isNotNull(), num).when(c == "X", 1000).when(c == "Y", 1001)
            .when(c.isin("M", "MT"), 1002).otherwise(2000))


def genome_sort(df: DataFrame, contig: str = "contig", start: str = "start", end: str | None = "end",
                rank: DataFrame | None = None) -> DataFrame:
    """Order by contig (given rank table, else natural order), start, end."""
    if rank is not None:
        df = df.join(F.broadcast(rank.select(contig, F.col("rank").alias("_rk"))), contig)
        key = F.col("_rk")
    else:
        key = natural_contig_rank(contig)
    # contigs of equal rank (all beyond the numbered, X, Y and M) go by name
    cols = [key, F.col(contig), F.col(start)] + ([F.col(end)] if end else [])
    return df.orderBy(*cols).drop("_rk") if rank is not None else df.orderBy(*cols)
