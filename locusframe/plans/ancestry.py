"""Ancestry workflows composed from the operators: build a reference
(QC filters -> LD prune -> PCA -> population join -> forest), infer samples
(projection -> prediction, all input files in one job), second-round
per-ancestry PCA, and final case/control lists."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from locusframe.functions import genotype as G
from locusframe.operators import calls as C
from locusframe.operators import forest as RF
from locusframe.operators import ld as LD
from locusframe.operators import pca as PCA
from locusframe.operators.ancestry import pc_project
from locusframe.session import broadcast_checked, cut_lineage
from locusframe.sources.checkpoint import StageStore


@dataclass
class Reference:
    scores: DataFrame        # sid, PC1..PCk, population
    loadings: DataFrame      # variant_id, af, PC1..PCk
    eigenvalues: list[float]
    model: PipelineModel | RF.TF.TaskForest
    k: int


def _pcs(k):
    return [f"PC{i}" for i in range(1, k + 1)]


def filtered_variants(calls: DataFrame, sites: DataFrame, n_samples: int, af_min: float,
                      hwe_min: float) -> DataFrame:
    """Biallelic variants passing AF > af_min and HWE p > hwe_min after
    missing -> hom-ref, with MAF for pruning priority."""
    bi = sites.where(~F.col("alt").contains(","))
    q = C.variant_qc(C.decompose(calls, bi), n_samples, fill_homref=True, sites=bi)
    q = C.with_hwe(q).where((F.col("AF_alt") > af_min) & (F.col("p_hwe") > hwe_min))
    return q.select("vid", F.least("AF_alt", 1 - F.col("AF_alt")).alias("maf"))


def prune(spark: SparkSession, arrs: DataFrame, sites: DataFrame, keep: DataFrame, r2: float = 0.1,
          window: int = 1_000_000) -> DataFrame:
    """LD-prune the kept variants: edges r^2 > r2 within the window, MIS by
    (MAF desc, pos, vid)."""
    a = arrs.join(keep.select("vid"), "vid")
    edges = LD.ld_r2_pairs(a, sites, window, min_r2=r2).select("vid_a", "vid_b")
    nodes = keep.join(sites.select("vid", "pos"), "vid").select(
        "vid", F.struct((-F.col("maf")).alias("m"), "pos", "vid").alias("prio"))
    return LD.ld_prune(spark, nodes, edges)


def reference_pca(spark: SparkSession, calls: DataFrame, sites: DataFrame, samples: DataFrame,
                  k: int = 10, af_min: float = 0.01, hwe_min: float = 1e-6, r2: float = 0.1):
    """QC filters -> LD prune -> HWE-normalised PCA.  Returns (scores with
    population, loadings keyed by variant_id with af and PC columns,
    eigenvalues)."""
    sidx = LD.sample_index(samples)
    n = samples.count()
    keep = cut_lineage(filtered_variants(calls, sites, n, af_min, hwe_min))
    # dense arrays only for variants that passed the filters
    arrs = cut_lineage(LD.dosage_arrays(calls.join(keep.select("vid"), "vid"), sidx, n, fill_homref=True))
    kept = prune(spark, arrs, sites, keep, r2)
    norm = cut_lineage(PCA.hwe_normalize(arrs.join(kept, "vid")))
    eig, scores, load = PCA.pca_hwe(norm, k, samples=n)
    pcs = _pcs(k)
    sc = PCA.scores_frame(spark, scores, sidx, k).join(samples.select("sid", "population"), "sid")
    vid_key = sites.select("vid", G.variant_id("contig", "pos", "ref", "alt").alias("variant_id"))
    lw = RF.pc_columns(load.join(vid_key, "vid"), "loadings", k).select("variant_id", "af", *pcs)
    return sc, cut_lineage(lw), eig


def build_reference(spark: SparkSession, calls: DataFrame, sites: DataFrame, samples: DataFrame,
                    k: int = 10, af_min: float = 0.01, hwe_min: float = 1e-6, r2: float = 0.1,
                    n_trees: int = RF.N_TREES, max_depth: int = 30, pca=None) -> Reference:
    """``calls`` (vid, sid, a1, a2), ``sites`` (vid, contig, pos, ref, alt),
    ``samples`` (sid, population).  ``pca`` may pass a finished
    :func:`reference_pca` result (stage reuse)."""
    sc, lw, eig = pca or reference_pca(spark, calls, sites, samples, k, af_min, hwe_min, r2)
    model = RF.rf_train(sc, _pcs(k), "population", n_trees=n_trees, max_depth=max_depth)
    return Reference(sc, lw, eig, model, k)


def build_reference_staged(store: StageStore, calls: DataFrame, sites: DataFrame, samples: DataFrame, inputs: list[str],
                           k: int = 10, af_min: float = 0.01, hwe_min: float = 1e-6, r2: float = 0.1,
                           n_trees: int = RF.N_TREES, max_depth: int = 30, seed: int = 7) -> Reference:
    """:func:`build_reference` as stored stages. ``inputs`` are the keys of
    what ``calls``, ``sites`` and ``samples`` read (see ``files_key``). What is
    finished is read back, the trained model included; a changed setting runs
    the stages that depend on it and no others."""
    spark = store.spark
    sidx = LD.sample_index(samples)

    def filtered():
        return {"keep": filtered_variants(calls, sites, samples.count(), af_min, hwe_min)}

    key, t = store.tables("filtered", {"af_min": af_min, "hwe_min": hwe_min}, inputs, filtered)
    keep = t["keep"]

    def arrays():
        return {"arrays": LD.dosage_arrays(calls.join(keep.select("vid"), "vid"), sidx, samples.count(), fill_homref=True)}

    array_key, t = store.tables("arrays", {}, [key], arrays)
    arrs = t["arrays"]
    key, t = store.tables("pruned", {"r2": r2}, [array_key], lambda: {"kept": prune(spark, arrs, sites, keep, r2)})
    kept = t["kept"]

    def components():
        eig, scores, load = PCA.pca_hwe(cut_lineage(PCA.hwe_normalize(arrs.join(kept, "vid"))), k, samples=sidx.count())
        names = sites.select("vid", G.variant_id("contig", "pos", "ref", "alt").alias("variant_id"), "contig", "pos", "ref", "alt")
        cols = ["variant_id", "contig", "pos", "ref", "alt", "af", *_pcs(k)]
        return {"scores": PCA.scores_frame(spark, scores, sidx, k).join(samples.select("sid", "population"), "sid"),
                "loadings": RF.pc_columns(load.join(names, "vid"), "loadings", k).select(*cols),
                "eigenvalues": spark.createDataFrame([(i, float(e)) for i, e in enumerate(eig)], "component int, value double")}

    key, t = store.tables("components", {"k": k}, [key], components)
    model_settings = {"n_trees": n_trees, "max_depth": max_depth, "seed": seed}
    _, model = store.model("model", model_settings, [key], lambda: RF.rf_train(
        t["scores"], _pcs(k), "population", n_trees=n_trees, max_depth=max_depth, seed=seed))
    eig = [r["value"] for r in t["eigenvalues"].orderBy("component").collect()]  # k rows
    return Reference(t["scores"], t["loadings"], eig, model, k)


def loading_sites(ref: Reference) -> DataFrame:
    """(variant_id, contig, pos, ref, alt) of the reference loadings."""
    if "contig" in ref.loadings.columns:
        return ref.loadings.select("variant_id", "contig", F.col("pos").cast("long").alias("pos"), "ref", "alt")
    # contig names may hold "_" themselves: the last three parts are pos, ref and alt
    parts = F.split("variant_id", "_")
    parts = F.concat(F.array(F.array_join(F.slice(parts, F.lit(1), F.size(parts) - 3), "_")), F.slice(parts, -3, 3))
    return ref.loadings.select("variant_id", parts.getItem(0).alias("contig"),
                               parts.getItem(1).cast("long").alias("pos"),
                               parts.getItem(2).alias("ref"), parts.getItem(3).alias("alt"))


def infer_samples(spark: SparkSession, ref: Reference, entries: DataFrame) -> DataFrame:
    """Project new samples (long entries with contig, pos, ref, alt, sample,
    gt and optionally file) onto the reference loadings and classify them.
    Fails when the model width differs from the number of components.
    Reading with ``read_vcf(..., keep_sites=loading_sites(ref))`` keeps
    only loading sites before sample columns are exploded."""
    n_features = len(RF.model_features(ref.model))
    if n_features != ref.k:
        raise ValueError(f"model expects {n_features} PCs, loadings have {ref.k}")
    keys = [c for c in ("file", "sample") if c in entries.columns]
    # keep only entries at loading sites (a broadcast of the bounded loading
    # key set) before any genotype is parsed
    e = entries.select("contig", "pos", "ref", "alt", "gt", *keys).join(
        broadcast_checked(loading_sites(ref), 5_000_000), ["contig", "pos", "ref", "alt"])
    parsed = C.parse_calls(e)
    calls = parsed.select("variant_id", F.concat_ws("|", *keys).alias("sid"), *keys, "a1", "a2")
    pcs = _pcs(ref.k)
    proj = pc_project(calls, ref.loadings, pcs, key="variant_id", sample="sid", carry=keys)
    return RF.rf_predict(ref.model, proj, "predicted").drop("sid")


def ancestry_round_two(spark: SparkSession, calls: DataFrame, sites: DataFrame, labelled: DataFrame,
                       labels: list[str], k: int = 2, af_min: float = 0.01, hwe_min: float = 1e-6,
                       r2: float = 0.1) -> DataFrame:
    """Per ancestry label (a driver loop; each label is its own Spark jobs):
    subset samples, filter, prune, PCA, attach the cohort label; results are
    stacked as (ancestry, sid, PC1..PCk, cohort).  A label of n samples
    has n - 1 components at most; the PCs beyond are null."""
    out = None
    for lab in labels:
        s = labelled.where(F.col("ancestry") == lab).select("sid", "cohort")
        if s.limit(2).count() < 2:
            sc = s.select(*[F.lit(None).cast("double").alias(p) for p in _pcs(k)], "sid", "cohort", F.lit(lab).alias("ancestry"))
            out = sc if out is None else out.unionByName(sc, allowMissingColumns=True)
            continue
        c = calls.join(s.select("sid"), "sid", "left_semi")
        sidx = LD.sample_index(s)
        n = s.count()
        keep = cut_lineage(filtered_variants(c, sites, n, af_min, hwe_min))
        arrs = cut_lineage(LD.dosage_arrays(c.join(keep.select("vid"), "vid"), sidx, n, fill_homref=True))
        kept = prune(spark, arrs, sites, keep, r2)
        norm = PCA.hwe_normalize(arrs.join(kept, "vid"))
        kk = min(k, n - 1)
        _, scores, _ = PCA.pca_hwe(norm, kk, samples=n)
        sc = PCA.scores_frame(spark, scores, sidx, kk).join(s, "sid").withColumn("ancestry", F.lit(lab))
        sc = sc.withColumns({p: F.lit(None).cast("double") for p in _pcs(k)[kk:]})
        out = sc if out is None else out.unionByName(sc, allowMissingColumns=True)
    return out


def final_lists(labelled: DataFrame, sample: str = "sample", population: str = "population",
                cohort: str = "cohort") -> DataFrame:
    """Per population, its case and control lists stacked as
    (sample_id, population, role) in one projection."""
    return (labelled.where(F.col(cohort).isin("case", "control"))
            .select(F.col(sample).alias("sample_id"), F.col(population).alias("population"),
                    F.col(cohort).alias("role")))
