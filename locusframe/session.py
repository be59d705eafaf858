"""Session helpers: building a session for tests/bench, the shared scratch
folder, and size-checked broadcasting."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Dimension sides (contig tables, label lists, sample lists, loadings) are
# broadcast only after a bounded count proves they are below this many rows.
DEFAULT_BROADCAST_ROWS = 2_000_000
BROADCAST_BYTES = 256 << 20


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app: str = "locusframe", extra: dict | None = None) -> SparkSession:
    """Session for tests, bench and local runs. On a cluster use the
    cluster's own session; nothing here is required by the library."""
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.driver.memory", os.environ.get("LOCUSFRAME_DRIVER_MEMORY", "16g")))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by the cluster in ``spark.checkpoint.dir``.

    Only when a local session (as in tests) has none do we create one and
    register it, so that ``DataFrame.checkpoint`` works too; on a cluster a
    folder of one machine would be no use to the others, so that is an error."""
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not d and not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all machines share")
    if not d:
        d = tempfile.mkdtemp(prefix="locusframe-ckpt-")
        sc.setCheckpointDir(d)
        spark.conf.set("spark.checkpoint.dir", d)
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d.rstrip("/")


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A fresh, unique location under the shared scratch folder."""
    return f"{scratch_root(spark)}/{tag}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (survives
    executor loss, unlike a local checkpoint)."""
    scratch_root(df.sparkSession)
    return df.checkpoint(eager=True)


def broadcast_checked(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Broadcast ``df`` only when it has at most ``max_rows`` rows and some
    BROADCAST_BYTES; otherwise return it unchanged so the planner falls
    back to a shuffle join (and AQE may still convert it at run time). Rows
    and bytes are added up in every task, no row passes through a single one."""
    size = F.lit(8 * len(df.columns)).cast("long")
    for name, kind in df.dtypes:
        c = F.col(f"`{name}`")
        if kind in ("string", "binary"):
            size = size + F.coalesce(F.octet_length(c), F.lit(0))
        elif kind.startswith(("array", "struct", "map")):
            size = size + F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0))
    got = df.select(size.alias("_size")).agg(F.count(F.lit(1)).alias("n"), F.sum("_size").alias("b")).first()
    return F.broadcast(df) if got["n"] <= max_rows and (got["b"] or 0) <= BROADCAST_BYTES else df
