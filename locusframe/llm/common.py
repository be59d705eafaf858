"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import sys
import types
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from locusframe.session import scratch_path

#: A key that holds at least one row in HOT_SHARE of all rows is joined by
#: broadcast; there can be no more than HOT_SHARE such keys, at any size.
HOT_SHARE = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def body(col: str = "text") -> Column:
    """The text of a row; null counts as empty."""
    return F.coalesce(F.col(col), F.lit(""))


#: Rows of an Arrow batch at most while a stage is written: a row may hold a long text.
BATCH_ROWS = 1000
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(spark: SparkSession):
    rows = int(spark.conf.get(ARROW_ROWS))
    return settings(spark, **{ARROW_ROWS.replace(".", "__"): str(min(rows, BATCH_ROWS) if rows > 0 else BATCH_ROWS)})


def stored(df: DataFrame, tag: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read again: later
    stages read files, not a lineage that a lost executor would re-run."""
    path = scratch_path(df.sparkSession, tag)
    with small_batches(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def settings(spark: SparkSession, **conf: str):
    """Session settings (dots written as double underscores) for a block."""
    names = {k.replace("__", "."): v for k, v in conf.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def lookup(rows: DataFrame, facts: DataFrame, key: str, weight: str, total: DataFrame,
           hint: str | None = None) -> DataFrame:
    """Left join of ``rows`` to ``facts`` (one row per ``key``) that no hot
    key can unbalance.

    ``facts[weight]`` is the number of ``rows`` with that key, ``total`` a
    one-row frame with the number of all rows as ``total``. Keys holding at
    least 1/HOT_SHARE of the rows are at most HOT_SHARE many: they are
    broadcast. The others meet in an ordinary join; rows that the broadcast
    has served, and rows without a key, get a number of their own beside the
    key there, so they spread evenly and match nothing. ``hint`` names a join
    strategy for the other keys, for a plan that is the same at every size.
    """
    values = [c for c in facts.columns if c != key]
    marked = facts.withColumn("_found", F.struct(*values)).crossJoin(F.broadcast(total))  # one row on the right
    heavy = F.col(weight) * HOT_SHARE >= F.col("total")
    hot = marked.filter(heavy).select(key, F.col("_found").alias("_hot"))
    # 0 in every row, but no constant: a constant would drop out of the join keys
    never = F.when(F.col(weight) < 0, F.lit(1)).otherwise(F.lit(0))
    cold = marked.filter(~heavy).select(key, never.cast("long").alias("_spread"), F.col("_found").alias("_cold"))
    served = F.col("_hot").isNotNull() | F.col(key).isNull()
    spread = F.when(served, F.monotonically_increasing_id() + 1).otherwise(F.lit(0).cast("long"))
    out = (rows.join(F.broadcast(hot), key, "left").withColumn("_spread", spread)
           .join(cold.hint(hint) if hint else cold, [key, "_spread"], "left"))
    found = F.coalesce(F.col("_hot"), F.col("_cold"))
    return out.select(*rows.columns, *[found[c].alias(c) for c in values])


def worker_store(name: str) -> types.SimpleNamespace:
    """A named holder that lives as long as the Python worker process, so a
    cache filled by one task serves the next ones."""
    holder = sys.modules.setdefault("_locusframe_worker_store", types.ModuleType("_locusframe_worker_store"))
    if not hasattr(holder, name):
        setattr(holder, name, types.SimpleNamespace())
    return getattr(holder, name)


def fresh_worker() -> None:
    """Drop what other operators' tasks cached in this Python worker process:
    Spark hands the same workers on from stage to stage."""
    sys.modules.pop("_locusframe_worker_store", None)
