"""Streaming query: incremental inference re-aim."""

from __future__ import annotations

from pyspark.sql import functions as F

from locusframe.catalog import register
from locusframe.catalog._common import fx, parsed_calls
from locusframe.functions import genotype as G
from locusframe.session import scratch_path
from locusframe.streaming.incremental import run_incremental_infer


@register("incremental_infer")
def q_incremental_infer(spark, sf_dir):
    from locusframe.catalog.cohort import _reference
    f = fx(spark, sf_dir)
    ref = _reference(f)
    base = scratch_path(spark, "incremental")
    landing, out, ckpt = f"{base}/landing", f"{base}/out", f"{base}/_checkpoint"
    calls = parsed_calls(f).join(f.fx_site.select("vid", G.variant_id("contig", "pos", "ref", "alt").alias("variant_id")), "vid") \
        .join(f.fx_sample.select("sid", "sample", "population"), "sid")
    rows = calls.select("sample", "variant_id", G.alt_dosage("a1", "a2").alias("dosage"), "population")
    # samples land in batches, one folder write per population
    for (pop,) in rows.select("population").distinct().orderBy("population").collect():
        rows.where(F.col("population") == pop).drop("population").write.mode("append").parquet(landing)
    pcs = [f"PC{i}" for i in range(1, ref.k + 1)]
    run_incremental_infer(spark, landing, ref.loadings, pcs, ref.model, out, ckpt)
    # a second run finds nothing new: every sample is classified exactly once
    run_incremental_infer(spark, landing, ref.loadings, pcs, ref.model, out, ckpt)
    return spark.read.parquet(out).select("sample", *pcs, "predicted")
