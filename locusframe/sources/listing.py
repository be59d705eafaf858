"""Object listings as DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from locusframe.functions import paths as P


def blob_listing(listing: DataFrame, name: str = "name", size: str = "size") -> DataFrame:
    """(name, basename, size) from any listing table."""
    return listing.select(F.col(name).alias("name"), P.basename(name).alias("basename"),
                          F.col(size).cast("long").alias("size"))


def file_listing(spark: SparkSession, root: str, recursive: bool = True) -> DataFrame:
    """Real files under ``root`` as (name relative to root, basename, size),
    from file metadata only (``binaryFile`` without its content column)."""
    df = (spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
          .load(root).select("path", "length"))
    rel = F.regexp_replace("path", r"^.*?" + root.rstrip("/").split("://")[-1].replace(".", r"\.") + "/", "")
    return df.select(rel.alias("name"), P.basename("path").alias("basename"), F.col("length").alias("size"))
