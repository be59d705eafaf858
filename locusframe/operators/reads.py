"""Sequencing-read tables: counts, mate pairing, even sharding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_count_of(spark: SparkSession, fastq_path: str) -> DataFrame:
    """Number of reads in FASTQ text = lines / 4."""
    return spark.read.text(fastq_path).agg((F.count(F.lit(1)) / 4).cast("long").alias("n_reads"))


def pair_reads(r1: DataFrame, r2: DataFrame, key: str = "read_id") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(pairs, singles from read 1, singles from read 2)."""
    a = r1.select(key, F.col("payload").alias("payload_1"))
    b = r2.select(key, F.col("payload").alias("payload_2"))
    return a.join(b, key), r1.join(r2.select(key), key, "left_anti"), r2.join(r1.select(key), key, "left_anti")


def even_split(reads: DataFrame, n: int, key: str = "read_id") -> DataFrame:
    """Assign each read (mates share ``key``) to one of ``n`` shards of equal
    size in key order: shard = floor(index * n / count)."""
    from locusframe.operators.scan import row_index
    total = reads.count()
    bk = F.floor(F.col(key) / F.lit(1_000_000)).cast("long")
    r = row_index(reads.withColumn("_bk", bk), [], ["_bk"], [key], out="_i").drop("_bk")
    return r.withColumn("shard", F.floor(F.col("_i") * n / F.lit(max(total, 1))).cast("int")).drop("_i")
