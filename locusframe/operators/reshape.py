"""Reshaping: allele trimming, transposes, pivots, list explosion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locusframe.functions._util import col_of


def _common_suffix(a: Column, b: Column) -> Column:
    m = F.least(F.length(a), F.length(b)) - 1
    ks = F.sequence(F.lit(1), F.greatest(m, F.lit(1)))
    n = F.size(F.filter(ks, lambda k: F.substring(a, -k, k) == F.substring(b, -k, k)))
    return F.when(m >= 1, n).otherwise(F.lit(0))


def _common_prefix(a: Column, b: Column) -> Column:
    m = F.least(F.length(a), F.length(b)) - 1
    ks = F.sequence(F.lit(1), F.greatest(m, F.lit(1)))
    n = F.size(F.filter(ks, lambda k: F.substring(a, 1, k) == F.substring(b, 1, k)))
    return F.when(m >= 1, n).otherwise(F.lit(0))


def normalize_trim(df: DataFrame, pos: str = "pos", ref: str = "ref", alt: str = "alt") -> DataFrame:
    """Trim the shared suffix, then the shared prefix, of REF and ALT while
    both stay at least one base long; the position moves by the prefix
    trimmed.  (Left-alignment across repeats needs the reference sequence and
    is not part of this operator.)"""
    r, a = col_of(ref), col_of(alt)
    s = _common_suffix(r, a)
    d = df.withColumn("_s", s)
    d = d.withColumns({"_r1": F.expr(f"substring({ref}, 1, length({ref}) - _s)"),
                       "_a1": F.expr(f"substring({alt}, 1, length({alt}) - _s)")})
    p = _common_prefix(F.col("_r1"), F.col("_a1"))
    d = d.withColumn("_p", p)
    return (d.withColumns({ref: F.expr("substring(_r1, _p + 1)"), alt: F.expr("substring(_a1, _p + 1)"),
                           pos: F.col(pos) + F.col("_p")})
            .drop("_r1", "_a1", "_s", "_p"))


def shard_transpose(df: DataFrame, row: str, files: str) -> DataFrame:
    """Rows holding an ordered file list (one file per shard) -> coordinate
    form of the transpose: (shard, row, file), one row per cell.  Nothing is
    collected per shard, so a shard with every sample stays distributed."""
    return df.select(row, F.posexplode(files).alias("shard", "file"))


def shard_lists(cells: DataFrame, shard: str = "shard", row: str = "row", file: str = "file") -> DataFrame:
    """The whole transpose: per shard the files of all rows (samples), in the
    order of the row's name. A list is as long as the cohort is wide."""
    one = F.sort_array(F.collect_list(F.struct(row, file)))
    return cells.groupBy(shard).agg(one.alias("_l")).select(shard, F.col(f"_l.{file}").alias("files"))


def pivot_wide(df: DataFrame, index: list[str], column: str, value: str, values: list | None = None) -> DataFrame:
    """One column per distinct value of ``column`` (bounded domains only:
    contigs, labels, statistics).  With ``values`` the columns are fixed, and
    no extra job looks for them."""
    return df.groupBy(*index).pivot(column, values).agg(F.first(value))


def bounds_table(bounds: DataFrame, label: str, stats: list[str], labels: list[str] | None = None) -> DataFrame:
    """Per-label bound rows -> one row per statistic, one column per label."""
    long = bounds.unpivot([label], stats, "stat", "value").withColumn(label, F.col(label).cast("string"))
    return pivot_wide(long, ["stat"], label, "value", labels)


def explode_list(df: DataFrame, keep: list[str], items: Column, out: str = "item") -> DataFrame:
    return df.select(*keep, F.explode(items).alias(out))
