"""Class-label recoding and fixed-offset time-zone shifts."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from locusframe.functions._util import col_of

# Super-population labels and their integer codes, in order.
SUPER_POPULATION_CODES = {"EUR": 1, "AFR": 2, "EAS": 3, "SAS": 4, "AMR": 5}

# Zone abbreviations treated as fixed offsets (hours from UTC).
FIXED_ZONES = {"UTC": 0, "GMT": 0, "EST": -5, "MST": -7, "HST": -10}


def label_to_code(label, labels: list[str], start: int = 1) -> Column:
    """Label -> integer code by position in ``labels`` (unknown -> null)."""
    pos = F.array_position(F.array(*[F.lit(x) for x in labels]), col_of(label))
    return F.when(pos > 0, pos + F.lit(start - 1)).cast("int")


def code_to_label(code, labels: list[str], start: int = 1) -> Column:
    """Integer code -> label (out of range -> null)."""
    c = col_of(code).cast("int") - F.lit(start - 1)
    arr = F.array(*[F.lit(x) for x in labels])
    return F.when((c >= 1) & (c <= len(labels)), F.element_at(arr, c))


def _offset_hours(zone: str) -> float | None:
    if zone in FIXED_ZONES:
        return FIXED_ZONES[zone]
    m = re.fullmatch(r"([+-])(\d{2}):(\d{2})", zone)
    if m:
        h = int(m.group(2)) + int(m.group(3)) / 60
        return h if m.group(1) == "+" else -h
    return None


def tz_convert(ts, zone: str, to_utc: bool = False) -> Column:
    """Shift a UTC wall-clock timestamp into ``zone`` (or back with
    ``to_utc``).  Fixed-offset zones are plain interval arithmetic, which is
    independent of the session time zone; named zones use the session-aware
    ``from_utc_timestamp`` / ``to_utc_timestamp``."""
    t = col_of(ts)
    off = _offset_hours(zone)
    if off is not None:
        secs = int(round(off * 3600)) * (-1 if to_utc else 1)
        return t + F.make_dt_interval(secs=F.lit(secs))
    fn = F.to_utc_timestamp if to_utc else F.from_utc_timestamp
    return fn(t.cast("timestamp"), zone)
