"""Incremental inference: newly landed genotype files are projected onto the
reference loadings exactly once each.

A Structured Streaming query joins the landed rows with the loadings and adds
their terms up by sample in RocksDB state without a watermark, so a sample may
be spread over any files, batches and sessions and its sums never expire. The
state is read back as a table, one row per sample, and classified; what landed
before is not read again. Terms are added as whole numbers of 10 ** -12, so
the sums do not depend on the order of files or batches.

Defined results: a landing folder that does not exist, or holds no file, gives
the samples seen before (none at first); missing dosages and variants without a
loading, or with a frequency of 0 or 1, add nothing; a sample with no usable
row does not appear.
"""

from __future__ import annotations

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from locusframe.operators import forest as RF

ENTRY_SCHEMA = T.StructType([T.StructField("sample", T.StringType()), T.StructField("variant_id", T.StringType()),
                             T.StructField("dosage", T.IntegerType())])
SCALE = 10 ** 12
STATE = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
         "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true"}


def _made(spark: SparkSession, path: str) -> bool:
    """Makes the folder if it is not there; says whether it holds anything."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(conf)
    fs.mkdirs(p)
    return len(fs.listStatus(p)) > 0


def _with_state(spark: SparkSession, run):
    before = {k: spark.conf.get(k, None) for k in STATE}
    for k, v in STATE.items():
        spark.conf.set(k, v)
    try:
        return run()
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def project_stream(rows: DataFrame, loadings: DataFrame, pcs: list[str]) -> DataFrame:
    """Sums of the terms of every sample, as whole numbers of 1 / SCALE."""
    m = loadings.count()
    usable = loadings.where((F.col("af") > 0) & (F.col("af") < 1)).select("variant_id", "af", *pcs)
    norm = (F.col("dosage") - 2 * F.col("af")) / F.sqrt(F.lit(float(m)) * 2 * F.col("af") * (1 - F.col("af")))
    j = rows.where(F.col("dosage").isNotNull()).join(usable, "variant_id")
    terms = [F.round(F.col(p) * norm * SCALE).cast("decimal(28,0)").alias(p) for p in pcs]
    return j.select("sample", *terms).groupBy("sample").agg(*[F.sum(p).alias(p) for p in pcs])


def seen_sums(spark: SparkSession, checkpoint: str, pcs: list[str]) -> DataFrame:
    """(sample, PCs) of every sample in the state."""
    try:
        state = _with_state(spark, lambda: spark.read.format("statestore").load(checkpoint))
    except PySparkException as e:
        if e.getCondition() != "STDS_COMMITTED_BATCH_UNAVAILABLE":  # nothing has landed yet
            raise
        return spark.createDataFrame([], "sample string, " + ", ".join(f"{p} double" for p in pcs))
    # every component's sum bears the same name in the state: they are told apart by their places
    fields = state.schema["value"].dataType.fields
    placed = T.StructType([T.StructField(f"f{i}", f.dataType) for i, f in enumerate(fields)])
    sums = [f"f{i}" for i, f in enumerate(fields) if isinstance(f.dataType, T.DecimalType)]
    flat = state.select(F.col("key.sample").alias("sample"), F.col("value").cast(placed).alias("v"))
    return flat.select("sample", *[(F.col("v")[f].cast("double") / SCALE).alias(p) for f, p in zip(sums, pcs, strict=True)])


def run_incremental_infer(spark: SparkSession, landing: str, loadings: DataFrame, pcs: list[str], model,
                          out_path: str, checkpoint: str, schema: T.StructType = ENTRY_SCHEMA) -> None:
    """Process every file in ``landing`` not seen before (per the checkpoint)
    and write (sample, PCs, predicted) of all samples seen so far to ``out_path``."""
    _made(spark, landing)
    sums = project_stream(spark.readStream.schema(schema).parquet(landing), loadings, pcs)

    def advance():
        q = (sums.writeStream.format("noop").outputMode("update").option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
        q.awaitTermination()

    _with_state(spark, advance)
    RF.rf_predict(model, seen_sums(spark, checkpoint, pcs), "predicted").write.mode("overwrite").parquet(out_path)
