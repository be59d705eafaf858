"""Object-path and size-formatting expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from locusframe.functions._util import col_of

# Size unit prefixes (powers of 1024) and the suffix.
SIZE_PREFIXES = ["", "k", "M", "G", "T"]
SIZE_SUFFIX = "b"
# Fixed value: variant-file extensions removed from sample names.
VARIANT_EXT_RE = r"\.[bv]cf(\.gz)?$"


def basename(path) -> Column:
    return F.substring_index(col_of(path), "/", -1)


def parent(path) -> Column:
    return F.regexp_extract(col_of(path), r"^(.*)/[^/]*$", 1)


def strip_prefix(path, prefix: str) -> Column:
    """Path relative to ``prefix`` (unchanged when it does not start with it)."""
    p = col_of(path)
    return F.when(p.startswith(prefix), F.substring(p, len(prefix) + 1, 1 << 30)).otherwise(p)


def strip_ext(name, pattern: str = VARIANT_EXT_RE) -> Column:
    return F.regexp_replace(col_of(name), pattern, "")


def human_size(size) -> Column:
    """``0 b``; else size / 1024^k with one decimal (half-up) and unit
    k, M, G, T, chosen by the largest power of 1024 not above the size."""
    s = col_of(size).cast("long")
    k = (F.when(s >= F.lit(1 << 40), 4).when(s >= F.lit(1 << 30), 3)
         .when(s >= F.lit(1 << 20), 2).when(s >= F.lit(1 << 10), 1).otherwise(0))
    v = F.round(s / F.pow(F.lit(1024.0), k), 1)
    unit = F.element_at(F.array(*[F.lit(p) for p in SIZE_PREFIXES]), k + 1)
    return F.when(s == 0, F.lit("0 " + SIZE_SUFFIX)).otherwise(
        F.format_string("%.1f %s" + SIZE_SUFFIX, v, unit))


def join_nonempty(*parts, sep: str = "/") -> Column:
    """Join parts with ``sep``, skipping nulls and empty strings."""
    return F.concat_ws(sep, *[F.nullif(col_of(p), F.lit("")) for p in parts])
