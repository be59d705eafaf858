"""Duplicate detection and first-appearance ordering."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from locusframe.session import broadcast_checked


def duplicate_ids(df: DataFrame, col: str) -> DataFrame:
    """Ids occurring more than once, with their count."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def dedupe_exclude_all(df: DataFrame, col: str, max_dup_ids: int = 5_000_000) -> DataFrame:
    """Drop every row whose id is duplicated.  The duplicated ids come from a
    map-side-combined count; they are broadcast into an anti join when a
    bounded count proves them few, so the big side is never shuffled by a
    possibly hot id."""
    dups = duplicate_ids(df, col).select(col)
    return df.join(broadcast_checked(dups, max_dup_ids), col, "left_anti")


def unique_in_order(df: DataFrame, col: str, order: str) -> DataFrame:
    """Distinct values of ``col`` by first appearance in ``order``:
    (value, first_line, ord) with ord starting at 1."""
    first = df.groupBy(col).agg(F.min(order).alias("first_line"))
    return first.withColumn("ord", F.row_number().over(Window.orderBy("first_line")).cast("long"))
