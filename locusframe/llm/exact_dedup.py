"""Exact deduplication with a stateful stream.

Arrivals (digest, stable identifier, content locator) are appended to a log.
A Structured Streaming query aggregates the log by digest in RocksDB state
without a watermark, so state lives on disk and never expires. The state is
then read as a table: per digest the identifier that stays, the locator of its
content and the number of arrivals. Digests with more than one arrival are
hits; their full texts are compared before the hit counts. Everything is
built-in DataFrame and SQL functions.

Defined results
* Null text counts as empty; empty texts are equal to each other.
* Of equal texts the row with the largest doc_id stays (null is smallest). If
  several rows share that doc_id and text, exactly one of them stays.
* Documents may arrive in any number of batches, in one session or several on
  the same folder; a row that is sent twice counts twice, and one of the two stays.
* Digests whose texts differ (a collision, or a weak digest given by the
  caller) are told apart by the texts themselves.
* Extra columns of the input are not read; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from locusframe.llm.common import body, lookup, settings, stored
from locusframe.session import scratch_path

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STATE = {"spark__sql__streaming__stateStore__providerClass": ROCKSDB,
         "spark__sql__streaming__stateStore__rocksdb__changelogCheckpointing__enabled": "true",
         "spark__sql__streaming__stateStore__rocksdb__boundedMemoryUsage": "true",
         # a store is closed once its part of a batch is committed: an open one holds 4 MB of local disk
         "spark__sql__streaming__stateStore__unloadOnCommit": "true"}


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def _located(docs: DataFrame) -> DataFrame:
    """doc_id, text, and where the content lies: file and row for a frame
    read from files, else no file and the row number of this reading."""
    try:
        at = docs.select("doc_id", "text", F.col("_metadata.file_path").alias("file"),
                         F.col("_metadata.row_index").alias("row"))
        at.schema  # noqa: B018  resolves the hidden column
        return at
    except AnalysisException:
        return docs.select("doc_id", "text", F.lit(None).cast("string").alias("file"),
                           F.monotonically_increasing_id().alias("row"))


class StreamingDedup:
    """Keyed state under ``root``; each ``ingest`` adds a batch of documents."""

    def __init__(self, spark: SparkSession, root: str | None = None,
                 digest: Callable[[Column], Column] = sha256):
        self.spark, self.digest = spark, digest
        self.root = root or scratch_path(spark, "exact-dedup")
        self.log, self.state = f"{self.root}/arrivals", f"{self.root}/state"

    def _next_batch(self) -> int:
        """Number of the batch to come: arrivals are unique by batch and number."""
        try:
            last = self.arrivals().agg(F.max("batch").alias("b")).first()["b"]
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            last = None
        return 0 if last is None else last + 1

    def ingest(self, docs: DataFrame) -> None:
        arrivals = _located(docs).select(
            "doc_id", self.digest(body()).alias("digest"), sha256(body()).alias("text_sha256"),
            F.lit(self._next_batch()).alias("batch"), F.monotonically_increasing_id().alias("arrival"), "file", "row")
        arrivals.write.mode("append").parquet(self.log)
        schema = arrivals.schema
        with settings(self.spark, **STATE):
            rows = self.spark.readStream.schema(schema).parquet(self.log)
            keyed = rows.groupBy("digest").agg(
                F.max(F.struct("doc_id", "batch", "arrival", "file", "row")).alias("keeper"),
                F.count(F.lit(1)).alias("arrivals"))
            run = (keyed.writeStream.format("noop").outputMode("update")
                   .option("checkpointLocation", self.state).trigger(availableNow=True).start())
            run.awaitTermination()

    def keyed_state(self) -> DataFrame:
        """Per digest: keeper (doc_id, batch, arrival, file, row) and arrivals."""
        with settings(self.spark, **STATE):
            raw = self.spark.read.format("statestore").load(self.state)
            return stored(raw.select("key.digest", F.col("value.max").alias("keeper"),
                                     F.col("value.count").alias("group_size")), "dedup-state")

    def arrivals(self) -> DataFrame:
        return self.spark.read.parquet(self.log)

    def decisions(self, state: DataFrame | None = None) -> DataFrame:
        """Every arrival of every batch with what the state says of its digest."""
        state = self.keyed_state() if state is None else state
        total = state.agg(F.coalesce(F.sum("group_size"), F.lit(0)).alias("total"))
        here = (F.col("arrival") == F.col("keeper.arrival")) & (F.col("batch") == F.col("keeper.batch"))
        return lookup(self.arrivals(), state, "digest", "group_size", total).select(
            "doc_id", F.col("keeper.doc_id").alias("keep_id"), "group_size", here.alias("kept"), "text_sha256",
            F.col("keeper.file").alias("keep_file"), F.col("keeper.row").alias("keep_row"), "digest")


def _differing(docs: DataFrame, hits: DataFrame, total: DataFrame, digest) -> DataFrame:
    """Digests among ``hits`` whose full texts are not all the same bytes.

    All texts of a group are equal exactly when the smallest equals the
    largest; both are aggregated map-side, so a group of any size sends one
    pair of texts per task."""
    texts = docs.select(digest(body()).alias("digest"), body().alias("text"))
    found = lookup(texts, hits.select("digest", "group_size"), "digest", "group_size", total, hint="merge")
    return (found.filter(F.col("group_size").isNotNull()).groupBy("digest")
            .agg(F.min("text").alias("least"), F.max("text").alias("most"))
            .filter(F.col("least") != F.col("most")).select("digest"))


def exact_dedup(docs: DataFrame, digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256,
    and the locator of the content that stays (keep_file, keep_row)."""
    store = StreamingDedup(docs.sparkSession, digest=digest)
    store.ingest(docs)
    state = store.keyed_state()
    total = state.agg(F.coalesce(F.sum("group_size"), F.lit(0)).alias("total"))
    hits = state.filter(F.col("group_size") > 1)
    mixed = stored(_differing(docs, hits, total, digest), "dedup-mixed")
    out = store.decisions(state)
    if not mixed.isEmpty():
        out = out.join(mixed, "digest", "left_anti").unionByName(_by_text(docs, mixed, digest))
    return out.drop("digest")


def _by_text(docs: DataFrame, mixed: DataFrame, digest) -> DataFrame:
    """The same columns for colliding digests, grouped by the full text."""
    rows = stored(_located(docs).select("doc_id", body().alias("text"), digest(body()).alias("digest"), "file", "row",
                                        F.monotonically_increasing_id().alias("arrival"))
                  .join(mixed, "digest", "left_semi"), "dedup-collisions")
    keepers = rows.groupBy("digest", "text").agg(
        F.max(F.struct("doc_id", "arrival", "file", "row")).alias("keeper"), F.count(F.lit(1)).alias("group_size"))
    return rows.join(keepers, ["digest", "text"]).select(
        "doc_id", F.col("keeper.doc_id").alias("keep_id"), "group_size",
        (F.col("arrival") == F.col("keeper.arrival")).alias("kept"), sha256(F.col("text")).alias("text_sha256"),
        F.col("keeper.file").alias("keep_file"), F.col("keeper.row").alias("keep_row"), "digest")
