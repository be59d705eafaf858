"""Moving intervals to other coordinates through chains of alignment blocks.

A chain is a set of blocks (chain, src, block_start, block_end, dst,
dst_start, strand): bases [block_start, block_end) of ``src`` are those from
``dst_start`` on, read backwards where the strand is ``-``. Blocks of one chain
do not overlap in ``src``. An interval is cut at the blocks, each piece is
moved, flipped in reverse blocks, and the pieces of a chain that land on one
contig and strand are stitched over the gaps between them. The interval is mapped
if one chain carries at least ``min_share`` of its bases; otherwise the reason
is told:

* ``deleted``: no block holds any of it;
* ``partial``: what the chains carry together is less than ``min_share``;
* ``split``: together they carry enough, but none of them alone does;
* ``duplicated``: more than one does.

The cut is an overlap join by levels, so long blocks cost no more rows than
short ones; pieces are added up map-side per interval and chain. Equal
intervals are mapped once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locusframe.operators.levels import fitted_top, overlap_pairs_by_level

BLOCK = ("chain", "src", "block_start", "block_end", "dst", "dst_start", "strand")


def remap_chains(iv: DataFrame, blocks: DataFrame, min_share: float = 0.95, contig: str = "contig", start: str = "start",
                 end: str = "end", strand: str | None = None) -> DataFrame:
    """``iv`` with new_contig, new_start, new_end, new_strand, chain, share
    (mapped share of the bases) and reason; mapped rows have a null reason,
    others null coordinates. ``strand`` names the intervals' own strand column;
    without one they count as ``+``. Empty intervals are ``deleted``."""
    if not 0 < min_share <= 1:
        raise ValueError("min_share must be above 0 and at most 1")
    spans = iv.select(F.col(contig).alias("contig"), F.col(start).cast("long").alias("start"), F.col(end).cast("long").alias("end"))
    b = blocks.select(F.col("src").alias("contig"), F.col("block_start").cast("long").alias("start"),
                      F.col("block_end").cast("long").alias("end"), "chain", "dst", F.col("dst_start").cast("long").alias("dst_start"), "strand")
    hit = overlap_pairs_by_level(spans.distinct(), b, fitted=fitted_top([spans, b]))
    lo, hi = F.greatest("start_a", "start_b"), F.least("end_a", "end_b")
    ahead = F.col("strand_b") == "+"
    first = F.when(ahead, F.col("dst_start_b") + lo - F.col("start_b")).otherwise(F.col("dst_start_b") + F.col("end_b") - hi)
    pieces = hit.select(F.col("contig_a").alias("contig"), F.col("start_a").alias("start"), F.col("end_a").alias("end"),
                        F.col("chain_b").alias("chain"), F.col("dst_b").alias("dst"), F.col("strand_b").alias("way"),
                        first.alias("new_start"), (first + hi - lo).alias("new_end"), (hi - lo).alias("bases"))
    where = ["contig", "start", "end"]
    runs = pieces.groupBy(*where, "chain", "dst", "way").agg(
        F.min("new_start").alias("new_start"), F.max("new_end").alias("new_end"), F.sum("bases").alias("bases"))
    need = F.lit(float(min_share)) * (F.col("end") - F.col("start"))
    best = F.struct(F.col("bases"), (-F.col("new_start")).alias("o"), "chain", "dst", "way", "new_start", "new_end")
    per = runs.groupBy(*where).agg(F.max(best).alias("best"), F.sum("bases").alias("all"),
                                   F.sum(F.when(F.col("bases") >= need, 1).otherwise(0)).alias("enough"))
    whole = F.col("end") - F.col("start")
    # blocks of different chains may carry the same base: together they carry no more than all
    reason = (F.when(F.col("enough") == 1, None).when(F.col("enough") > 1, "duplicated")
              .when(F.least("all", whole) >= need, "split").otherwise("partial"))
    per = per.select(*[F.col(c).alias("_" + c) for c in where], "best", F.least(F.col("all"), whole).alias("_all"), reason.alias("_reason"))
    j = iv.join(per, (F.col(contig) == F.col("_contig")) & (F.col(start) == F.col("_start")) & (F.col(end) == F.col("_end")), "left")
    ok = F.col("best").isNotNull() & F.col("_reason").isNull()
    turned = F.when(F.col("best.way") == "+", F.coalesce(F.col(strand), F.lit("+")) if strand else F.lit("+"))
    turned = turned.otherwise(F.when(F.coalesce(F.col(strand), F.lit("+")) == "+", "-").otherwise("+") if strand else F.lit("-"))
    size = (F.col(end) - F.col(start)).cast("double")
    return j.select(
        *iv.columns, F.when(ok, F.col("best.dst")).alias("new_contig"), F.when(ok, F.col("best.new_start")).alias("new_start"),
        F.when(ok, F.col("best.new_end")).alias("new_end"), F.when(ok, turned).alias("new_strand"),
        F.when(ok, F.col("best.chain")).alias("chain"),
        F.when(size > 0, F.coalesce(F.when(ok, F.col("best.bases")).otherwise(F.col("_all")), F.lit(0)) / size).otherwise(F.lit(0.0)).alias("share"),
        F.when(F.col("best").isNull(), "deleted").otherwise(F.col("_reason")).alias("reason"))
