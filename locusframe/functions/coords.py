"""Coordinate and region-string expressions.

Inside the library every interval is half-open and 0-based:
``[start, end)``.  Region strings (``chr:a-b``) and interval lists are
1-based inclusive and are converted at the edges.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from locusframe.functions._util import col_of

REGION_RE = r"^([^:]+):([0-9]+)-([0-9]+)$"


def region_parse(region) -> Column:
    """``chr:a-b`` (1-based inclusive) -> struct<contig, start, end> half-open."""
    r = col_of(region)
    a = F.regexp_extract(r, REGION_RE, 2)
    b = F.regexp_extract(r, REGION_RE, 3)
    ok = r.rlike(REGION_RE)
    return F.when(ok, F.struct(F.regexp_extract(r, REGION_RE, 1).alias("contig"),
                               (a.cast("long") - 1).alias("start"),
                               b.cast("long").alias("end")))


def region_format(contig, start, end) -> Column:
    """Half-open (contig, start, end) -> ``chr:start+1-end``."""
    return F.format_string("%s:%d-%d", col_of(contig), col_of(start) + 1, col_of(end))


def add_chr(contig) -> Column:
    c = col_of(contig)
    return F.when(c.startswith("chr"), c).otherwise(F.concat(F.lit("chr"), c))


def to_one_based(start) -> Column:
    """0-based half-open start -> 1-based inclusive start (end unchanged)."""
    return col_of(start) + 1


def to_zero_based(start) -> Column:
    """1-based inclusive start -> 0-based half-open start (end unchanged)."""
    return col_of(start) - 1


def buffer_bounds(pos, buffer: int):
    """(lower, upper) = (max(pos - buffer, 1), pos + buffer)."""
    p = col_of(pos)
    return F.greatest(p - F.lit(buffer), F.lit(1)), p + F.lit(buffer)
