"""Ordering helpers: numeric keys captured by regex, dated submissions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def regex_numeric_sort(df: DataFrame, col: str, pattern: str, out: str = "num") -> DataFrame:
    """Sort by the integer captured by group 1 of ``pattern``; blank values
    are skipped."""
    d = df.where(F.length(F.trim(F.col(col))) > 0)
    d = d.withColumn(out, F.regexp_extract(F.col(col), pattern, 1).try_cast("int"))
    return d.orderBy(out)


def recent_submissions(df: DataFrame, prefix: str, rename: dict[str, str],
                       date_col: str = "submissionDate", date_fmt: str = "MM/dd/yyyy HH:mm:ss",
                       path_col: str = "path") -> DataFrame:
    """Parse submission dates, newest first, path relative to ``prefix``,
    keys renamed.  Output dates are ``yyyy-MM-dd HH:mm:ss`` strings."""
    ts = F.to_timestamp(F.col(date_col), date_fmt)
    rel = F.when(F.col(path_col).startswith(prefix), F.substring(F.col(path_col), len(prefix) + 1, 1 << 30)) \
        .otherwise(F.col(path_col))
    d = df.withColumns({"_ts": ts, "relpath": rel}).withColumnsRenamed(rename)
    d = d.withColumn("submitted", F.date_format("_ts", "yyyy-MM-dd HH:mm:ss"))
    keep = [rename.get(c, c) for c in df.columns if c not in (date_col, path_col)]
    return d.orderBy(F.desc("_ts"), *keep[:1]).select(*keep, "submitted", "relpath")
