"""Cohort analytics and machine-learning queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from locusframe.catalog import register
from locusframe.catalog._common import SQL_VQC_FILLED, fx, n_samples, parsed_calls, rounded
from locusframe.catalog.aggregates import SQL_SCORE_BODY
from locusframe.catalog.joins import SQL_AF, SQL_CLIN, _clinical, _projection
from locusframe.functions.hwe import hwe_sql
from locusframe.operators import forest as RF
from locusframe.operators import ld as LD
from locusframe.operators import pca as PCA
from locusframe.operators.regress import residualize, residualize_groups
from locusframe.operators.scores import polygenic_score
from locusframe.plans import ancestry as PL
from locusframe.session import scratch_path
from locusframe.sources.checkpoint import StageStore, files_key

AF_MIN = 0.0075  # meaningful at every fixture scale (FIXTURES caveat 1)
K = 10
EMB = 64  # entries of an embedding


def _filtered_arrays(f):
    if "ld_arrays" not in f.extra:
        calls = parsed_calls(f)
        n = n_samples(f)
        keep = PL.filtered_variants(calls, f.fx_site, n, AF_MIN, 1e-6)
        arrs = LD.dosage_arrays(calls.join(keep.select("vid"), "vid"), LD.sample_index(f.fx_sample), n)
        f.extra["ld_arrays"] = (arrs, keep)
    return f.extra["ld_arrays"]


@register("ld_r2_pairs", "WITH " + SQL_VQC_FILLED + ",\np AS " + hwe_sql("vqcf", "vid, allele") + """,
keep AS (SELECT v.vid FROM vqcf v JOIN p ON v.vid = p.vid AND v.allele = p.allele JOIN fx_site s ON v.vid = s.vid
         WHERE s.alt NOT LIKE '%,%' AND v.AC / CAST(v.AN AS DOUBLE) > 0.0075 AND p.p_hwe > 1e-6),
dense AS (SELECT k.vid, m.sid, CAST(coalesce((CASE WHEN c.a1 > 0 THEN 1 ELSE 0 END) + (CASE WHEN c.a2 > 0 THEN 1 ELSE 0 END), 0) AS DOUBLE) AS d
          FROM keep k CROSS JOIN fx_sample m LEFT JOIN pcall c ON c.vid = k.vid AND c.sid = m.sid),
arr AS (SELECT vid, list(d ORDER BY sid) AS x, CAST(count(*) AS DOUBLE) AS n, sum(d) AS sx, sum(d * d) AS sxx FROM dense GROUP BY vid),
pr AS (SELECT a.vid AS vid_a, b.vid AS vid_b, a.n * list_dot_product(a.x, b.x) - a.sx * b.sx AS num,
              a.n * a.sxx - a.sx * a.sx AS va, b.n * b.sxx - b.sx * b.sx AS vb
       FROM arr a JOIN fx_site sa ON a.vid = sa.vid JOIN fx_site sb ON sa.contig = sb.contig JOIN arr b ON b.vid = sb.vid
       WHERE (sb.pos > sa.pos OR (sb.pos = sa.pos AND b.vid > a.vid)) AND sb.pos - sa.pos <= 1000000)
SELECT vid_a, vid_b, round(CASE WHEN va > 0 AND vb > 0 THEN num * num / (va * vb) END, 6) AS r2 FROM pr""")
def q_ld_r2_pairs(spark, sf_dir):
    f = fx(spark, sf_dir)
    arrs, _ = _filtered_arrays(f)
    return rounded(LD.ld_r2_pairs(arrs, f.fx_site, 1_000_000).select("vid_a", "vid_b", "r2"))


@register("ld_prune")
def q_ld_prune(spark, sf_dir):
    f = fx(spark, sf_dir)
    arrs, keep = _filtered_arrays(f)
    return PL.prune(spark, arrs, f.fx_site, keep, 0.1)


def _pca(f):
    if "pca" not in f.extra:
        samples = f.fx_sample.select("sid", "population")
        f.extra["pca"] = PL.reference_pca(f.spark, parsed_calls(f), f.fx_site, samples, k=K, af_min=AF_MIN)
    return f.extra["pca"]


def _reference(f):
    if "reference" not in f.extra:
        samples = f.fx_sample.select("sid", "population")
        f.extra["reference"] = PL.build_reference(f.spark, parsed_calls(f), f.fx_site, samples, k=K,
                                                  af_min=AF_MIN, pca=_pca(f))
    return f.extra["reference"]


@register("pca_hwe")
def q_pca_hwe(spark, sf_dir):
    scores, _, _ = _pca(fx(spark, sf_dir))
    return rounded(scores.drop("population"))


@register("pca_allele_weights")
def q_pca_allele_weights(spark, sf_dir):
    _, loadings, eig = _pca(fx(spark, sf_dir))
    w = loadings.select("variant_id", "af", F.array(*[F.col(f"PC{i}") for i in range(1, K + 1)]).alias("loadings"))
    out = PCA.allele_weights(w, eig, key="variant_id")
    return rounded(RF.pc_columns(out, "weights", K, prefix="W").drop("weights"))


@register("build_reference")
def q_build_reference(spark, sf_dir):
    return rounded(_reference(fx(spark, sf_dir)).scores)


@register("staged_reference", "WITH " + SQL_VQC_FILLED + ",\np AS " + hwe_sql("vqcf", "vid, allele") + """,
keep AS (SELECT v.vid FROM vqcf v JOIN p ON v.vid = p.vid AND v.allele = p.allele JOIN fx_site s ON v.vid = s.vid
         WHERE s.alt NOT LIKE '%,%' AND v.AC / CAST(v.AN AS DOUBLE) > 0.0075 AND p.p_hwe > 1e-6)
SELECT 'filtered' AS stage, (SELECT count(*) FROM keep) AS n, 1 AS first_run, 0 AS second_run, 0 AS other_forest
UNION ALL SELECT 'arrays', (SELECT count(*) FROM keep), 1, 0, 0
UNION ALL SELECT 'pruned', NULL, 1, 0, 0
UNION ALL SELECT 'components', (SELECT count(*) FROM fx_sample), 1, 0, 0
UNION ALL SELECT 'model', NULL, 1, 0, 1""")
def q_staged_reference(spark, sf_dir):
    """The reference built as stored stages, built again, and built with
    another forest: which stages ran each time, and the rows that they hold."""
    f = fx(spark, sf_dir)
    samples = f.fx_sample.select("sid", "population")
    inputs = [files_key(x) for x in (f.fx_call, f.fx_site, f.fx_sample)]
    root, ran, held = scratch_path(spark, "staged-reference"), [], {}
    for trees in (20, 20, 30):
        store = StageStore(spark, root)
        ref = PL.build_reference_staged(store, parsed_calls(f), f.fx_site, samples, inputs, k=K, af_min=AF_MIN, n_trees=trees)
        ran.append(store.computed)
        held["components"] = ref.scores.count()
    settings = {"af_min": AF_MIN, "hwe_min": 1e-6}
    key, t = store.tables("filtered", settings, inputs, dict)
    held["filtered"] = t["keep"].count()
    held["arrays"] = store.tables("arrays", {}, [key], dict)[1]["arrays"].count()
    rows = [(s, held.get(s), *(int(s in r) for r in ran)) for s in ("filtered", "arrays", "pruned", "components", "model")]
    return spark.createDataFrame(rows, "stage string, n long, first_run int, second_run int, other_forest int")


@register("infer_samples")
def q_infer_samples(spark, sf_dir):
    from locusframe.catalog.sources import fixture_vcf
    from locusframe.sources.vcf import read_vcf
    f = fx(spark, sf_dir)
    ref = _reference(f)
    entries = read_vcf(spark, fixture_vcf(f), keep_sites=PL.loading_sites(ref)).entries \
        .select("contig", "pos", "ref", "alt", "sample", "gt")
    return rounded(PL.infer_samples(spark, ref, entries))


def _emb(f):
    e = f.embeddings
    pcs = RF.pc_columns(e.select("vec_id", "label", F.transform("embedding", lambda x: x.cast("double")).alias("s")),
                        "s", EMB).drop("s")
    cohort = F.when(F.col("label") == 9, "case").when(F.col("label") == 8, "control").otherwise("reference")
    return pcs.withColumns({"population": F.col("label").cast("string"), "cohort": cohort})


PCS = [f"PC{i}" for i in range(1, EMB + 1)]


@register("train_test_by_cohort", """
SELECT vec_id, CASE WHEN label = 9 THEN 'case' WHEN label = 8 THEN 'control' ELSE 'reference' END AS cohort,
       CASE WHEN label IN (8, 9) THEN 'predict' ELSE 'train' END AS role FROM embeddings""")
def q_train_test_by_cohort(spark, sf_dir):
    e = _emb(fx(spark, sf_dir))
    return e.select("vec_id", "cohort", F.when(F.col("cohort") == "reference", "train").otherwise("predict").alias("role"))


def _model(f):
    if "emb_model" not in f.extra:
        tr = _emb(f).where(F.col("cohort") == "reference")
        f.extra["emb_model"] = RF.rf_train(tr, PCS, "population")
    return f.extra["emb_model"]


@register("rf_train")
def q_rf_train(spark, sf_dir):
    m = _model(fx(spark, sf_dir))
    return spark.createDataFrame([(p, float(v)) for p, v in zip(PCS, RF.importances(m))], "feature string, importance double")


@register("rf_predict")
def q_rf_predict(spark, sf_dir):
    f = fx(spark, sf_dir)
    test = _emb(f).where(F.col("cohort") != "reference")
    return RF.rf_predict(_model(f), test.drop("population"), "predicted").select("vec_id", "cohort", "predicted")


@register("rf_cross_validate")
def q_rf_cross_validate(spark, sf_dir):
    tr = _emb(fx(spark, sf_dir)).where(F.col("cohort") == "reference")
    acc = RF.rf_cross_validate(tr, PCS, "population", "vec_id", k=5)
    return spark.createDataFrame([(i, a) for i, a in enumerate(acc)], "fold int, accuracy double")


@register("ancestry_round_two")
def q_ancestry_round_two(spark, sf_dir):
    f = fx(spark, sf_dir)
    lab = _clinical(f).select("sid", F.col("population").alias("ancestry"),
                               F.coalesce("cohort", F.lit("reference")).alias("cohort"))
    labels = [r[0] for r in lab.select("ancestry").distinct().orderBy("ancestry").collect()]
    return rounded(PL.ancestry_round_two(spark, parsed_calls(f), f.fx_site, lab, labels, k=K, af_min=AF_MIN))


@register("final_lists", "WITH " + SQL_CLIN + """
SELECT m.sample AS sample_id, c.population, c.cohort AS role FROM clin c JOIN fx_sample m ON c.sid = m.sid
WHERE c.cohort IN ('case', 'control')""")
def q_final_lists(spark, sf_dir):
    f = fx(spark, sf_dir)
    lab = _clinical(f).join(f.fx_sample.select("sid", "sample"), "sid")
    return PL.final_lists(lab)


@register("pgs_residualize", "WITH " + SQL_AF + ",\n" + SQL_SCORE_BODY + """,
sc AS (SELECT m.pgs, c.sid,
         sum(m.beta * ((CASE WHEN c.a1 = m.eff THEN 1 ELSE 0 END) + (CASE WHEN c.a2 = m.eff THEN 1 ELSE 0 END)))
         / sum((CASE WHEN c.a1 IS NULL THEN 0 ELSE 1 END) + (CASE WHEN c.a2 IS NULL THEN 0 ELSE 1 END)) AS score
       FROM m JOIN pcall c ON m.vid = c.vid WHERE m.eff >= 0 GROUP BY m.pgs, c.sid
       HAVING sum((CASE WHEN c.a1 IS NULL THEN 0 ELSE 1 END) + (CASE WHEN c.a2 IS NULL THEN 0 ELSE 1 END)) > 0),
j AS (SELECT sc.pgs, sc.sid, sc.score, proj.l1 FROM sc JOIN proj ON sc.sid = proj.sid),
fit AS (SELECT pgs, regr_slope(score, l1) AS b, regr_intercept(score, l1) AS a FROM j GROUP BY pgs)
SELECT j.pgs, j.sid, round(j.score - (fit.a + fit.b * j.l1), 6) AS residual FROM j JOIN fit ON j.pgs = fit.pgs""")
def q_pgs_residualize(spark, sf_dir):
    f, proj = _projection(spark, sf_dir)
    scores, _ = polygenic_score(parsed_calls(f), f.fx_site, f.fx_weight)
    j = scores.select("pgs", "sid", "score").join(proj.select("sid", "l1"), "sid")
    return rounded(residualize(j, "score", "l1", ["pgs"]).select("pgs", "sid", "residual"))


@register("pgs_residualize_pcs", "WITH " + SQL_AF + ",\n" + SQL_SCORE_BODY + """,
sc AS (SELECT m.pgs, c.sid,
         sum(m.beta * ((CASE WHEN c.a1 = m.eff THEN 1 ELSE 0 END) + (CASE WHEN c.a2 = m.eff THEN 1 ELSE 0 END)))
         / sum((CASE WHEN c.a1 IS NULL THEN 0 ELSE 1 END) + (CASE WHEN c.a2 IS NULL THEN 0 ELSE 1 END)) AS score
       FROM m JOIN pcall c ON m.vid = c.vid WHERE m.eff >= 0 GROUP BY m.pgs, c.sid
       HAVING sum((CASE WHEN c.a1 IS NULL THEN 0 ELSE 1 END) + (CASE WHEN c.a2 IS NULL THEN 0 ELSE 1 END)) > 0),
j AS (SELECT sc.pgs, sc.sid, sc.score, proj.l1, proj.l2, proj.l3 FROM sc JOIN proj ON sc.sid = proj.sid),
c AS (SELECT pgs, covar_pop(l1, l1) AS a, covar_pop(l1, l2) AS b, covar_pop(l1, l3) AS c, covar_pop(l2, l2) AS d, covar_pop(l2, l3) AS e,
        covar_pop(l3, l3) AS f, covar_pop(l1, score) AS p, covar_pop(l2, score) AS q, covar_pop(l3, score) AS r,
        avg(l1) AS m1, avg(l2) AS m2, avg(l3) AS m3, avg(score) AS my FROM j GROUP BY pgs),
det AS (SELECT *, a * (d * f - e * e) - b * (b * f - c * e) + c * (b * e - c * d) AS det FROM c),
fit AS (SELECT pgs, m1, m2, m3, my, (p * (d * f - e * e) - b * (q * f - r * e) + c * (q * e - r * d)) / det AS b1,
          (a * (q * f - r * e) - p * (b * f - c * e) + c * (b * r - c * q)) / det AS b2,
          (a * (d * r - e * q) - b * (b * r - c * q) + p * (b * e - c * d)) / det AS b3 FROM det)
SELECT j.pgs, j.sid, round(score - my - b1 * (l1 - m1) - b2 * (l2 - m2) - b3 * (l3 - m3), 6) AS residual FROM j JOIN fit ON j.pgs = fit.pgs""")
def q_pgs_residualize_pcs(spark, sf_dir):
    f, proj = _projection(spark, sf_dir)
    scores, _ = polygenic_score(parsed_calls(f), f.fx_site, f.fx_weight)
    j = scores.select("pgs", "sid", "score").join(proj.select("sid", "l1", "l2", "l3"), "sid")
    return rounded(residualize_groups(j, "score", ["l1", "l2", "l3"], ["pgs"]).select("pgs", "sid", "residual"))
