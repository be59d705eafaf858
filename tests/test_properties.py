"""Property tests for operators without an SQL oracle."""

import json
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from locusframe.catalog._common import fx, n_samples, parsed_calls
from locusframe.operators import intervals as IV
from locusframe.operators import ld as LD
from locusframe.operators import pca as PCA
from locusframe.plans import ancestry as PL

SF = "/root/testdata/sf0.01"


def test_ld_prune_independent_and_maximal(spark):
    f = fx(spark, SF)
    calls = parsed_calls(f)
    n = n_samples(f)
    keep = PL.filtered_variants(calls, f.fx_site, n, 0.0075, 1e-6)
    arrs = LD.dosage_arrays(calls.join(keep.select("vid"), "vid"), LD.sample_index(f.fx_sample), n)
    kept = {r[0] for r in PL.prune(spark, arrs, f.fx_site, keep, 0.1).collect()}
    edges = [(r[0], r[1]) for r in LD.ld_r2_pairs(arrs, f.fx_site, 1_000_000, min_r2=0.1).collect()]
    nodes = {r[0] for r in keep.select("vid").collect()}
    assert kept <= nodes and kept
    assert not [e for e in edges if e[0] in kept and e[1] in kept]          # independent
    nb = {}
    for a, b in edges:
        nb.setdefault(a, set()).add(b)
        nb.setdefault(b, set()).add(a)
    dropped = nodes - kept
    assert all(nb.get(v, set()) & kept for v in dropped)                   # maximal


def test_pca_matches_numpy(spark):
    rng = np.random.default_rng(3)
    g = rng.integers(0, 3, size=(40, 12))
    rows = [(i, [int(x) for x in g[i]]) for i in range(40)]
    arrs = spark.createDataFrame(rows, "vid long, dosages array<int>")
    norm = PCA.hwe_normalize(arrs)
    eig, scores, load = PCA.pca_hwe(norm, 3)
    p = g.mean(1) / 2
    keep = (p > 0) & (p < 1)
    z = (g[keep] - 2 * p[keep, None]) / np.sqrt(2 * p[keep, None] * (1 - p[keep, None]) * keep.sum())
    s = np.linalg.svd(z, compute_uv=False)[:3]
    assert np.allclose(np.sqrt(eig), s, rtol=1e-8)
    sc = np.array([v for _, v in sorted(scores)])
    gram = sc.T @ sc
    assert np.allclose(gram - np.diag(np.diag(gram)), 0, atol=1e-8)         # orthogonal scores
    u = np.array([r["loadings"] for r in load.orderBy("vid").collect()])
    assert np.allclose(u.T @ u, np.eye(3), atol=1e-8)                       # orthonormal loadings


def test_equal_span_regions_cover_once(spark):
    f = fx(spark, SF)
    isl = IV.buffered_islands(f.fx_site.select("contig", "pos"), 1000)
    rank = f.fx_site.select("contig").distinct().withColumn("rank", IV.natural_contig_rank("contig"))
    reg = IV.equal_span_regions(isl, rank, 1_000_000)
    total = isl.agg(F.sum(F.col("end") - F.col("start"))).first()[0]
    n = math.ceil(total / 1_000_000)
    t = math.ceil(total / n)
    # every island position falls in exactly one region
    pts = isl.select("contig", F.col("start").alias("pos"))
    hits = IV.points_in_intervals(pts, reg).groupBy("contig", "pos").count()
    assert hits.where(F.col("count") != 1).count() == 0
    assert reg.select("region").distinct().count() == n
    pieces = IV.overlap_pairs(isl.withColumn("i", F.lit(1)), reg, width=10_000_000)
    span = pieces.select("region_b", (F.least("end_a", "end_b") - F.greatest("start_a", "start_b")).alias("s")) \
        .groupBy("region_b").agg(F.sum("s").alias("s"))
    assert span.agg(F.max("s")).first()[0] <= t
    assert span.agg(F.sum("s")).first()[0] == total


def test_checkpoint_stage_runs_once(spark, tmp_path):
    from locusframe.sources.checkpoint import checkpoint_stage, resume_report
    calls = []

    @checkpoint_stage(str(tmp_path), "s1")
    def stage(sp):
        calls.append(1)
        return sp.range(5)

    assert stage(spark).count() == 5
    assert stage(spark).count() == 5
    assert len(calls) == 1
    assert resume_report(spark, str(tmp_path), ["s1", "s2"]) == [("s1", True), ("s2", False)]


def test_json_path_rewrite(spark):
    from locusframe.operators.jsonops import json_path_rewrite
    doc = {"gs://work/a": ["gs://work/b", {"k": "gs://work/c", "n": 1}], "x": "gs://other/d"}
    df = spark.createDataFrame([(json.dumps(doc),)], "j string")
    out = json.loads(json_path_rewrite(df, "j", "gs://work/", "gs://arch/").first()["rewritten"])
    assert out == {"gs://arch/a": ["gs://arch/b", {"k": "gs://arch/c", "n": 1}], "x": "gs://other/d"}


def test_json_path_rewrite_at_any_spelling(spark):
    from locusframe.operators.jsonops import json_path_rewrite
    odd = 'a"b\\c/[x]^-$1'
    docs = [r'{"t":"gs:\/\/work\/a", "u" : "\u0067s://work/b","n":1.50,"m":"x,\"gs://work/no"}', '"gs://work/top"', ' [ "gs://work/1" ]',
            r'{"a":"say \"gs://work/not\"","b":":","c":"gs://work/"}', None, "", json.dumps([odd + "tail", {odd: odd}, "z" + odd])]
    df = spark.createDataFrame(list(enumerate(docs)), "i int, j string")
    new = 'new$1\\"/'
    got = {r["i"]: r["rewritten"] for r in json_path_rewrite(df, "j", "gs://work/", new).collect()}
    assert json.loads(got[0]) == {"t": new + "a", "u": new + "b", "n": 1.5, "m": 'x,"gs://work/no'} and "1.50" in got[0]
    assert json.loads(got[1]) == new + "top" and json.loads(got[2]) == [new + "1"]
    assert json.loads(got[3]) == {"a": 'say "gs://work/not"', "b": ":", "c": new}
    assert got[4] is None and got[5] == ""
    last = json_path_rewrite(df.where("i = 6"), "j", odd, "é").first()["rewritten"]
    assert json.loads(last) == ["étail", {"é": "é"}, "z" + odd]
    with pytest.raises(ValueError):
        json_path_rewrite(df, "j", ",x", "y")


def test_rows_only_queries_run(spark, registry):
    for key in ("json_path_rewrite", "checkpoint_stage", "rf_train", "rf_predict", "pca_allele_weights"):
        assert registry[key].run(spark, SF_SMALL).count() > 0, key


def test_incremental_infer_once_per_sample(spark, registry):
    out = registry["incremental_infer"].run(spark, SF_SMALL)
    n = out.count()
    assert n == out.select("sample").distinct().count() == fx(spark, SF_SMALL).fx_sample.count()


def test_infer_samples_model_width(spark, registry):
    out = registry["infer_samples"].run(spark, SF_SMALL)
    assert out.count() == fx(spark, SF_SMALL).fx_sample.count()
    assert "predicted" in out.columns


def test_cross_validation_folds(spark, registry):
    acc = [r["accuracy"] for r in registry["rf_cross_validate"].run(spark, SF_SMALL).collect()]
    assert len(acc) == 5 and all(0.0 <= a <= 1.0 for a in acc)
