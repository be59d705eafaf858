"""Ordered prefix scans that do not funnel a whole contig (or the whole
table) through one window partition.

A running sum/max over an ordering is split in two levels: a window inside
each (key, bucket) — buckets are coarse, order-preserving slices such as
``floor(pos / W)`` — plus an exclusive prefix over the per-bucket totals,
which is a table of one row per bucket (small), joined back on the bucket.
Every window partition is therefore bounded by the bucket size, not by the
size of the largest contig.  A scan reads its input twice (bucket totals,
then local windows), so callers chaining scans materialise the input of
each scan (``cut_lineage``) rather than recomputing upstream work.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_AGG = {"sum": F.sum, "max": F.max, "min": F.min}


def prefix_scan(df: DataFrame, part: list[str], bucket: list[str], order: list,
                value: Column, how: str = "sum", inclusive: bool = True,
                out: str = "scan") -> DataFrame:
    """Add column ``out`` = aggregate ``how`` of ``value`` over all rows of
    the same ``part`` that come before (and, when ``inclusive``, at) this row
    in (``bucket``, ``order``) order.  ``bucket`` columns must be
    non-decreasing along ``order``.

    Exclusive sums with no preceding rows give 0; exclusive max/min give null.
    """
    agg = _AGG[how]
    tmp = df.withColumn("_scan_v", value)
    end = Window.currentRow if inclusive else -1
    w_local = (Window.partitionBy(*(part + bucket)).orderBy(*order)
               .rowsBetween(Window.unboundedPreceding, end))
    local = tmp.withColumn("_scan_loc", agg("_scan_v").over(w_local))
    totals = tmp.groupBy(*(part + bucket)).agg(agg("_scan_v").alias("_scan_tot"))
    wb = (Window.partitionBy(*part).orderBy(*bucket) if part else Window.orderBy(*bucket)) \
        .rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.withColumn("_scan_off", agg("_scan_tot").over(wb)).drop("_scan_tot")
    # null keys form a group of their own, as in the window
    keys = part + bucket
    offsets = offsets.select(*[F.col(c).alias(f"_scan_k{i}") for i, c in enumerate(keys)], "_scan_off")
    same = [F.col(c).eqNullSafe(F.col(f"_scan_k{i}")) for i, c in enumerate(keys)]
    j = local.join(offsets, same).drop(*[f"_scan_k{i}" for i in range(len(keys))])
    if how == "sum":
        res = F.coalesce(F.col("_scan_off"), F.lit(0)) + F.coalesce(F.col("_scan_loc"), F.lit(0))
    elif how == "max":
        res = F.greatest(F.col("_scan_off"), F.col("_scan_loc"))
    else:
        res = F.least(F.col("_scan_off"), F.col("_scan_loc"))
    return j.withColumn(out, res).drop("_scan_v", "_scan_loc", "_scan_off")


def row_index(df: DataFrame, part: list[str], bucket: list[str], order: list,
              out: str = "row_idx") -> DataFrame:
    """0-based position of each row in (part; bucket, order) order."""
    return prefix_scan(df, part, bucket, order, F.lit(1).cast("long"), "sum", inclusive=False, out=out)
