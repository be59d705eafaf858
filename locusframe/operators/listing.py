"""Object-listing roll-ups and copy planning/reconciliation over listing
tables ``(name, size)``.  No object-store calls: listings come in as
DataFrames (e.g. from ``binaryFile`` metadata or an inventory export)."""

from __future__ import annotations

import fnmatch

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locusframe.functions import paths as P
from locusframe.operators.scan import prefix_scan

# Transfer status letters.
STATUS_MISSING = "M"   # source object absent
STATUS_DONE = "D"      # destination already holds an object of the same size
STATUS_REDO = "R"      # destination exists with another size: replace it
STATUS_COPY = "C"      # destination absent: copy
STATUS_TOTAL = "T"     # roll-up row over all statuses of a table

# Name patterns never planned for archiving.
DEFAULT_EXCLUDES = ["PreProcessingForVariantDiscovery_GATK4", "FastqToCram"]


def ancestor_prefixes(listing: DataFrame, name: str = "name") -> DataFrame:
    """One row per (object, ancestor folder): '' is the root, then ``a/``,
    ``a/b/`` ...; ``depth`` is the number of folder levels."""
    parts = F.split(F.col(name), "/")
    idx = F.explode(F.sequence(F.lit(0), F.size(parts) - 1)).alias("depth")
    x = listing.select("*", idx)
    pref = F.when(F.col("depth") == 0, F.lit("")).otherwise(
        F.concat(F.array_join(F.slice(F.split(F.col(name), "/"), 1, F.col("depth")), "/"), F.lit("/")))
    return x.withColumn("prefix", pref)


def folder_rollup(listing: DataFrame, name: str = "name", size: str = "size") -> DataFrame:
    """Total size and object count of every folder at every depth (root = '').
    A hierarchical roll-up by exploding ancestors and one aggregation; the
    root group gets every row but is combined map-side."""
    a = ancestor_prefixes(listing.select(name, size), name)
    return a.groupBy("prefix", "depth").agg(F.sum(size).cast("long").alias("total_size"),
                                            F.count(F.lit(1)).alias("n_objects"))


def basename_stats(listing: DataFrame, basename: str = "basename", size: str = "size") -> DataFrame:
    g = listing.groupBy(basename).agg(F.count(F.lit(1)).alias("n"), F.sum(size).cast("long").alias("total_size"))
    return g.withColumn("hsize", P.human_size("total_size")).orderBy(F.desc("total_size"), basename)


def list_dir(listing: DataFrame, prefix: str, delimiter: str = "/", glob: str | None = None,
             name: str = "name") -> DataFrame:
    """Entries directly below ``prefix``: files as themselves and deeper
    objects as their immediate sub-folder (``kind`` = file / folder),
    optionally matching a glob on the entry's last part."""
    rest = F.substring(F.col(name), len(prefix) + 1, 1 << 30)
    x = listing.where(F.col(name).startswith(prefix)).select(rest.alias("_r"))
    is_dir = F.instr(F.col("_r"), delimiter) > 0
    entry = F.when(is_dir, F.concat(F.lit(prefix), F.substring_index(F.col("_r"), delimiter, 1), F.lit(delimiter))) \
        .otherwise(F.concat(F.lit(prefix), F.col("_r")))
    out = x.select(entry.alias("entry"), F.when(is_dir, "folder").otherwise("file").alias("kind")).distinct()
    if glob:
        last = F.regexp_extract(F.col("entry"), r"([^/]*)/?$", 1)
        out = out.where(last.rlike(fnmatch.translate(glob)))
    return out


def regex_partition(df: DataFrame, patterns: list[str], col: str = "name") -> DataFrame:
    """Flag rows whose ``col`` matches any pattern (``excluded``); callers
    keep either side (the reference keeps both lists)."""
    rx = "|".join(f"(?:{p})" for p in patterns)
    return df.withColumn("excluded", F.col(col).rlike(rx))


def transfer_reconcile(plan: DataFrame, source: DataFrame, dest: DataFrame) -> DataFrame:
    """Classify each planned copy (src -> dst) against the source and
    destination listings (name, size): M source missing, D same-size object
    already there, R other-size object there (replace), C copy."""
    s = source.select(F.col("name").alias("src"), F.col("size").alias("src_size"))
    d = dest.select(F.col("name").alias("dst"), F.col("size").alias("dst_size"))
    j = plan.join(s, "src", "left").join(d, "dst", "left")
    st = (F.when(F.col("src_size").isNull(), STATUS_MISSING)
          .when(F.col("dst_size") == F.col("src_size"), STATUS_DONE)
          .when(F.col("dst_size").isNotNull(), STATUS_REDO).otherwise(STATUS_COPY))
    return j.withColumn("status", st)


def cleanup_list(plan: DataFrame, source: DataFrame, dest: DataFrame) -> DataFrame:
    """Sources safe to delete: present on both sides with equal size."""
    s = source.select(F.col("name").alias("src"), F.col("size").alias("src_size"))
    d = dest.select(F.col("name").alias("dst"), F.col("size").alias("dst_size"))
    return (plan.join(s, "src").join(d, "dst")
            .where(F.col("src_size") == F.col("dst_size")).select("src", "dst", "src_size"))


def transfer_status_counts(rec: DataFrame, table: str = "tbl") -> DataFrame:
    """Counts per (table, status) plus a per-table total row (status T):
    grouping sets ((table, status), (table))."""
    r = rec.rollup(table, "status").agg(F.count(F.lit(1)).alias("n"))
    r = r.where(F.col(table).isNotNull())
    return r.withColumn("status", F.coalesce(F.col("status"), F.lit(STATUS_TOTAL)))


def size_layout(listing: DataFrame, name: str = "name", size: str = "size") -> DataFrame:
    """Start offset and extent of every folder and file in a nested layout:
    siblings are laid out consecutively inside their parent, folders before
    files, then by name; zero-size objects are dropped.  Returns
    (node, parent, is_file, extent, start)."""
    a = ancestor_prefixes(listing.where(F.col(size) > 0).select(name, size), name)
    folders = (a.where(F.col("depth") > 0)
               .groupBy(F.col("prefix").alias("node")).agg(F.sum(size).cast("long").alias("extent"))
               .withColumn("is_file", F.lit(False)))
    files = (listing.where(F.col(size) > 0)
             .select(F.col(name).alias("node"), F.col(size).cast("long").alias("extent"))
             .withColumn("is_file", F.lit(True)))
    nodes = folders.unionByName(files)
    par = F.regexp_extract(F.col("node"), r"^(.*/)?[^/]+/?$", 1)
    nodes = nodes.withColumn("parent", par)
    # running sum over siblings in (is_file, name) order, bucketed by a name
    # prefix (order-preserving inside a parent) so a folder with a very large
    # share of all objects is not one window partition
    nodes = nodes.withColumn("_bk", F.expr("substring(node, length(parent) + 1, 4)"))
    nodes = prefix_scan(nodes, ["parent"], ["is_file", "_bk"], ["node"], F.col("extent"), "sum",
                        inclusive=False, out="own").drop("_bk")
    nodes = nodes.withColumn("own", F.col("own").cast("long"))
    # start = own offset of the node plus the own offsets of all its ancestors
    anc = ancestor_prefixes(nodes.select("node"), "node").where(F.col("depth") > 0) \
        .select("node", F.col("prefix").alias("anc")).where(F.col("anc") != F.col("node"))
    offs = nodes.select(F.col("node").alias("anc"), F.col("own").alias("anc_own"))
    up = anc.join(offs, "anc").groupBy("node").agg(F.sum("anc_own").cast("long").alias("_up"))
    return (nodes.join(up, "node", "left")
            .select("node", "parent", "is_file", "extent",
                    (F.col("own") + F.coalesce(F.col("_up"), F.lit(0))).alias("start")))
