"""Generic table operators: keyed picks, positional joins, set comparisons,
lookups and stacking.  Picks use a per-key ``min``/``max`` over a struct
(map-side combined), not a window, so a hot key is pre-aggregated before the
shuffle."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locusframe.operators.scan import row_index
from locusframe.session import broadcast_checked


def pick_first(df: DataFrame, key: list[str], order: list[str], carry: list[str],
               last: bool = False) -> DataFrame:
    """One row per key: the row first (or last) in ``order`` (ties broken by
    the carried values), returning key + order + carry columns."""
    st = F.struct(*[F.col(c) for c in order + carry])
    agg = F.max(st) if last else F.min(st)
    g = df.groupBy(*key).agg(agg.alias("_p"))
    return g.select(*key, *[F.col(f"_p.{c}").alias(c) for c in order + carry])


def paste_columns(left: DataFrame, right: DataFrame, left_order: list[str], right_order: list[str],
                  bucket_width: int = 1_000_000) -> DataFrame:
    """Glue two tables side by side by row position in their own orders.
    Fails when the row counts differ."""
    nl, nr = left.count(), right.count()
    if nl != nr:
        raise ValueError(f"paste_columns: row counts differ ({nl} vs {nr})")
    lb = F.floor(F.col(left_order[0]) / bucket_width).cast("long") if bucket_width else F.lit(0)
    rb = F.floor(F.col(right_order[0]) / bucket_width).cast("long") if bucket_width else F.lit(0)
    li = row_index(left.withColumn("_bk", lb), [], ["_bk"], left_order, "idx").drop("_bk")
    ri = row_index(right.withColumn("_bk", rb), [], ["_bk"], right_order, "idx").drop("_bk")
    return li.join(ri, "idx")


def tagged_set_compare(a: DataFrame, b: DataFrame, col: str) -> DataFrame:
    """Rows (value, side) with side only_a / only_b / both (distinct)."""
    da, db = a.select(col).distinct(), b.select(col).distinct()
    return (da.subtract(db).withColumn("side", F.lit("only_a"))
            .unionByName(db.subtract(da).withColumn("side", F.lit("only_b")))
            .unionByName(da.intersect(db).withColumn("side", F.lit("both"))))


def literal_lookup(col, mapping: dict) -> Column:
    """Look a value up in a literal map (unknown -> null)."""
    items = [x for k, v in mapping.items() for x in (F.lit(k), F.lit(v).cast("string"))]
    return F.element_at(F.create_map(*items), col if isinstance(col, Column) else F.col(col))


def lookup_join(df: DataFrame, table: DataFrame, on: str, max_rows: int = 2_000_000,
                how: str = "left") -> DataFrame:
    """Join a lookup table, broadcasting it only after a bounded count."""
    return df.join(broadcast_checked(table, max_rows), on, how)


def strict_lookup(df: DataFrame, table: DataFrame, on: str, value: str) -> DataFrame:
    """Left join that fails the job when any row finds no ``value``."""
    j = df.join(table, on, "left")
    msg = F.concat(F.lit(f"no {value} for {on} = "), F.col(on).cast("string"))
    return j.withColumn(value, F.when(F.col(value).isNull(), F.raise_error(msg)).otherwise(F.col(value)))


def stack(frames: list[DataFrame], keys: list[str] | None = None, key_col: str = "source") -> DataFrame:
    """Stack result tables by column name (missing columns -> null), with an
    optional key column naming the origin of each row."""
    if keys:
        frames = [f.withColumn(key_col, F.lit(k)) for f, k in zip(frames, keys)]
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), frames)


def columns_by_prefix(df: DataFrame, reference_prefix: str = "referenceData_",
                      system_prefix: str = "system:") -> dict[str, DataFrame]:
    """Split attribute columns into reference / system / data projections."""
    ref = [c for c in df.columns if c.startswith(reference_prefix)]
    sysk = [c for c in df.columns if c.startswith(system_prefix)]
    data = [c for c in df.columns if c not in ref and c not in sysk]
    q = lambda cs: df.select(*[F.col(f"`{c}`") for c in cs])
    return {"reference": q(ref), "system": q(sysk), "data": q(data)}
