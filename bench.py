"""Benchmark: run headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS] and
print one JSON line {"metric", "value", "unit", "queries", "sf"}.

Each query is forced to completion with a ``noop`` write (full computation,
no driver collect).  A warm-up run of the flagship query is not timed.
Set BENCH_QUERIES=all (or a comma list) to widen the set, BENCH_REPEAT=n to
take the median of n timed runs.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    # genotype QC and scores
    "variant_qc", "fill_tags", "sample_qc", "hwe_filter", "polygenic_score", "pc_project",
    "decompose", "carrier_rows",
    # sources
    "vcf_read", "issue_store", "variant_store",
    # intervals and ordered operators
    "merge_intervals", "equal_span_regions", "region_assign", "nearest_feature", "overlap_join",
    "record_shards",
    # listings, entities, text
    "folder_rollup", "transfer_reconcile", "path_rewrite", "word_count", "length_median_mass",
    # cohort analytics
    "ld_r2_pairs", "pca_hwe",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "1"))
    from locusframe.catalog import load_all
    from locusframe.session import build_session

    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=int(cpus) * 2)
    reg = load_all()
    sel = os.environ.get("BENCH_QUERIES", "")
    keys = list(reg) if sel == "all" else ([k for k in sel.split(",") if k] or HEADLINE)

    def run(k: str) -> float:
        t0 = time.perf_counter()
        reg[k].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    run("variant_qc")  # warm-up: JVM, code generation, file listing
    times: dict[str, float] = {}
    errors: dict[str, str] = {}
    for k in keys:
        try:
            times[k] = round(statistics.median(run(k) for _ in range(repeat)), 3)
        except Exception as e:  # noqa: BLE001
            errors[k] = f"{type(e).__name__}: {str(e)[:200]}"
        print(f"# {k}: {times.get(k, errors.get(k))}", file=sys.stderr, flush=True)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": times, "sf": float(m.group(1)) if m else sf_dir, "cpus": int(cpus)}
    if errors:
        out["errors"] = errors
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
