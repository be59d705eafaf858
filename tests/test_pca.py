"""Leading eigenpairs against a full decomposition."""

import numpy as np
import pytest

from locusframe.operators import pca as PCA


@pytest.mark.parametrize("n,m,k", [(120, 900, 10), (9, 40, 3), (40, 6, 10), (5, 1, 2)])
def test_top_eigenpairs(n, m, k):
    rng = np.random.default_rng(n)
    z = rng.normal(size=(m, n)) * rng.uniform(0.2, 3, (m, 1))
    widths = []

    def product(q):
        widths.append(q.shape[1])
        return z.T @ (z @ q)

    w, v = PCA.top_eigenpairs(product, n, k)
    want = np.sort(np.linalg.eigvalsh(z.T @ z))[::-1][:k]
    assert np.allclose(w, want, atol=1e-8 * want[0])
    assert np.allclose(v.T @ v, np.eye(len(w)), atol=1e-8)
    assert np.allclose(z.T @ (z @ v), v * w, atol=1e-6 * want[0])
    assert max(widths) <= 3 * (k + PCA.EXTRA)  # nothing n x n


def test_scores_and_loadings_equal_numpy(spark):
    rng = np.random.default_rng(4)
    n, m, k = 60, 300, 10
    pop = rng.integers(0, 3, n)
    g = rng.binomial(2, rng.uniform(0.1, 0.9, (m, 3))[:, pop])
    arrs = spark.createDataFrame([(i, [float(x) for x in row]) for i, row in enumerate(g)], "vid bigint, dosages array<double>")
    norm = PCA.hwe_normalize(arrs)
    eig, scores, load = PCA.pca_hwe(norm, k)
    z = np.array([r["z"] for r in norm.orderBy("vid").collect()])
    u, s, vt = np.linalg.svd(z, full_matrices=False)
    assert np.allclose(eig, s[:k] ** 2)
    got = np.array([v for _, v in sorted(scores)])
    want = vt[:k].T * s[:k]
    want *= np.sign((got * want).sum(0))
    assert np.allclose(got, want, atol=1e-6 * s[0])
    loads = np.array([r["loadings"] for r in load.orderBy("vid").collect()])
    assert np.allclose(abs((loads * u[:, :k]).sum(0)), 1, atol=1e-6)


def test_no_variants(spark):
    norm = PCA.hwe_normalize(spark.createDataFrame([], "vid bigint, dosages array<double>"))
    eig, scores, load = PCA.pca_hwe(norm, 3)
    assert eig == [] and scores == [] and load.collect() == []


def test_no_variant_passes_the_filters(spark):
    from locusframe.plans import ancestry as PL
    samples = spark.range(12).selectExpr("id AS sid", "if(id < 6, 'x', 'y') AS population")
    sites = spark.createDataFrame([(1, "chr1", 5, "A", "C")], "vid long, contig string, pos long, ref string, alt string")
    calls = spark.createDataFrame([(1, 0, "0/1", 0, 1, 2)], "vid long, sid long, gt string, a1 int, a2 int, ploidy int")
    scores, loadings, eig = PL.reference_pca(spark, calls, sites, samples, k=3, af_min=0.4)
    assert sorted(map(tuple, scores.select("sid", "PC1", "PC2", "PC3").collect())) == [(i, 0.0, 0.0, 0.0) for i in range(12)]
    assert loadings.collect() == [] and eig == [0.0] * 3
    two = PL.ancestry_round_two(spark, calls, sites, samples.selectExpr("sid", "population AS ancestry", "'r' AS cohort"), ["x", "y"], k=2, af_min=0.4)
    assert two.where("PC1 = 0 AND PC2 = 0").count() == 12


def test_scores_leave_the_driver_in_blocks(spark, monkeypatch):
    """One row a block of samples, not one Python tuple a sample."""
    from pyspark.sql import SparkSession
    m, sent, make = np.random.default_rng(2).normal(size=(1200, 3)), [], SparkSession.createDataFrame

    def seen(self, data, *a, **kw):
        sent.append(len(data))
        return make(self, data, *a, **kw)

    monkeypatch.setattr(SparkSession, "createDataFrame", seen)
    sidx = spark.range(1200).selectExpr("id * 2 AS sid", "CAST(id AS INT) AS sidx")
    df = PCA.scores_frame(spark, PCA.Scores(m), sidx, 3)
    assert sent == [3] and df.columns == ["PC1", "PC2", "PC3", "sid"]
    assert [tuple(r) for r in df.orderBy("sid").collect()] == [(*x, 2 * i) for i, x in enumerate(m.tolist())]
    assert PCA.Scores(m)[1199] == (1199, m[1199].tolist()) and len(list(PCA.Scores(m))) == 1200
    assert PCA.scores_frame(spark, PCA.Scores(np.zeros((0, 0))), sidx, 3).count() == 0
