"""FASTQ text writing/reading for read tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locusframe.session import scratch_path


def write_fastq(reads: DataFrame, path: str, key: str = "read_id", payload: str = "payload") -> str:
    """Write (read_id, payload) rows as 4-line FASTQ records."""
    seq = F.translate(F.col(payload).cast("string"), "0123456789", "ACGTACGTAC")
    rec = F.concat_ws("\n", F.concat(F.lit("@r"), F.col(key).cast("string")), seq, F.lit("+"),
                      F.translate(seq, "ACGT", "IIII"))
    reads.select(rec.alias("value")).write.mode("overwrite").text(path)
    return path


def fixture_fastq(f) -> str:
    """FASTQ of the first-mate fixture, written once per data folder."""
    if "fastq1" not in f.extra:
        f.extra["fastq1"] = write_fastq(f.fx_read1, scratch_path(f.spark, "fastq1"))
    return f.extra["fastq1"]
