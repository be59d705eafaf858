"""Entity tables with dynamic attributes: cells, path-rewrite planning,
nested-record flattening, typed attribute unwrapping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from locusframe.functions import paths as P
from locusframe.operators.tables import pick_first


def cells_unpivot(df: DataFrame, table: str, entity: str, columns: list[str]) -> DataFrame:
    """Entity table -> (tbl, entity, col, val) cells (string values)."""
    d = df.select(F.col(table).alias("tbl"), F.col(entity).alias("entity"),
                  *[F.col(c).cast("string").alias(c) for c in columns])
    return d.unpivot(["tbl", "entity"], columns, "col", "val")


def archive_dest(archive: str, index=None):
    """Destination of a cell: archive/tbl/entity/col[/i]/basename."""
    parts = [F.lit(archive), F.col("tbl"), F.col("entity").cast("string"), F.col("col")]
    if index is not None:
        parts.append(index.cast("string"))
    parts.append(P.basename("val"))
    return P.join_nonempty(*parts)


def first_wins_map(cells: DataFrame, prefix: str, archive: str) -> DataFrame:
    """Old path -> new path.  A path met in several cells keeps the
    destination of its first cell in (tbl, entity, col) order; the pick is a
    per-path min over a struct (combined map-side, skew-safe)."""
    c = cells.where(F.col("val").startswith(prefix)).withColumn("dest", archive_dest(archive))
    p = pick_first(c, ["val"], ["tbl", "entity", "col"], ["dest"])
    return p.select(F.col("val").alias("path"), "dest")


def path_rewrite(list_cells: DataFrame, prefix: str, archive: str) -> DataFrame:
    """Cells holding a list of values (tbl, entity, col, vals ARRAY<STRING>):
    each element under ``prefix`` maps to its archive path (index in the path
    when the cell is a list of more than one), the first cell met per path
    wins, and cells are rebuilt in element order.  Returns only cells with at
    least one change: (tbl, entity, col, new_vals)."""
    el = list_cells.select("tbl", "entity", "col", F.posexplode("vals").alias("i", "val"),
                           (F.size("vals") > 1).alias("_is_list"))
    idx = F.when(F.col("_is_list"), F.col("i"))
    moved = el.where(F.col("val").startswith(prefix)).withColumn(
        "dest", P.join_nonempty(F.lit(archive), F.col("tbl"), F.col("entity").cast("string"), F.col("col"),
                                idx.cast("string"), P.basename("val")))
    fmap = pick_first(moved, ["val"], ["tbl", "entity", "col", "i"], ["dest"]).select("val", F.col("dest").alias("_new"))
    j = el.join(fmap, "val", "left")
    changed = j.groupBy("tbl", "entity", "col").agg(
        F.max(F.col("_new").isNotNull().cast("int")).alias("_any"),
        F.sort_array(F.collect_list(F.struct("i", F.coalesce("_new", "val").alias("v")))).alias("_items"))
    return (changed.where(F.col("_any") == 1)
            .select("tbl", "entity", "col", F.transform("_items", lambda x: x["v"]).alias("new_vals")))


def update_plan(changes: DataFrame) -> DataFrame:
    """Changed cells -> one row per entity with a map column -> new value."""
    return changes.groupBy("tbl", "entity").agg(
        F.map_from_entries(F.collect_list(F.struct("col", "new_val"))).alias("updates"))


def flatten_nested(df: DataFrame, sep: str = ".", max_depth: int | None = None,
                   fields: list[str] | None = None, last_segment: bool = False) -> DataFrame:
    """Nested structs -> flat columns named by their dotted path (union of
    keys comes from the inferred schema; missing = null).  Optionally stop
    at ``max_depth``, keep only ``fields`` (dotted paths) and rename to the
    last path segment."""
    out = []

    def walk(dt: T.DataType, path: list[str], depth: int):
        if isinstance(dt, T.StructType) and (max_depth is None or depth < max_depth):
            for f in dt.fields:
                walk(f.dataType, path + [f.name], depth + 1)
        else:
            name = sep.join(path)
            out.append((name, F.col(".".join(f"`{p}`" for p in path))))

    walk(df.schema, [], 0)
    if fields is not None:
        out = [(n, c) for n, c in out if n in fields]
    return df.select(*[c.alias(n.split(sep)[-1] if last_segment else n) for n, c in out])


def keys_by_type(df: DataFrame) -> list[tuple[str, str]]:
    """(column, simple type name) for every column of a flattened frame."""
    return [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
