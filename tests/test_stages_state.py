"""Content-keyed stages and the keyed state of incremental inference."""

import numpy as np
from pyspark.sql import functions as F

from locusframe.operators import forest as RF
from locusframe.plans import ancestry as PL
from locusframe.sources.checkpoint import StageStore, files_key
from locusframe.streaming.incremental import run_incremental_infer


def test_stage_keys(spark, tmp_path):
    raw = f"{tmp_path}/raw"
    spark.range(10).write.parquet(raw)
    runs = []

    def plan(factor, trees):
        store = StageStore(spark, f"{tmp_path}/stages")
        df = spark.read.parquet(raw)
        key, a = store.tables("scaled", {"factor": factor}, [files_key(df)], lambda: {
            "x": df.withColumn("y", F.col("id") * factor), "n": df.agg(F.count("id").alias("n"))})
        train = a["x"].withColumn("population", F.when(F.col("y") > 4 * factor, "b").otherwise("a")).withColumn("y", F.col("y").cast("double"))
        _, model = store.model("model", {"trees": trees}, [key], lambda: RF.rf_train(train, ["y"], n_trees=trees))
        runs.append(store.computed)
        return sorted(r["y"] for r in a["x"].collect()), a["n"].first()["n"], len(model.stages[2].trees)

    assert plan(2, 3) == ([2 * i for i in range(10)], 10, 3)
    assert plan(2, 3) == ([2 * i for i in range(10)], 10, 3)
    assert plan(2, 5)[2] == 5
    assert plan(3, 5)[0] == [3 * i for i in range(10)]
    spark.range(12).write.mode("overwrite").parquet(raw)
    assert plan(2, 3)[1] == 12
    assert runs == [["scaled", "model"], [], ["model"], ["scaled", "model"], ["scaled", "model"]]


def test_finished_stages_start_no_job(spark, tmp_path):
    def stage():
        store = StageStore(spark, f"{tmp_path}/s")
        return store.tables("t", {}, ["k"], lambda: {"x": spark.range(5).where("id > 1")})[1]["x"]

    stage()
    sc = spark.sparkContext
    sc.setJobGroup("second run", "")
    df = stage()
    assert len(sc.statusTracker().getJobIdsForGroup("second run")) == 0
    sc.setJobGroup("", "")
    assert df.count() == 3


def test_batches_restart_and_empty_landing(spark, tmp_path):
    rng = np.random.default_rng(1)
    pcs = ["PC1", "PC2"]
    loads = [(f"v{i}", float(rng.uniform(0.1, 0.9)) if i else 1.0, *map(float, rng.normal(size=2))) for i in range(30)]
    loadings = spark.createDataFrame(loads, "variant_id string, af double, PC1 double, PC2 double")
    train = spark.createDataFrame([(float(i), float(-i), "ab"[i % 2]) for i in range(20)], "PC1 double, PC2 double, population string")
    model = RF.rf_train(train, pcs, n_trees=3)
    landing, out, ckpt = (f"{tmp_path}/{x}" for x in ("landing", "out", "ckpt"))

    def run():
        run_incremental_infer(spark, landing, loadings, pcs, model, out, ckpt)
        return {r["sample"]: (r["PC1"], r["PC2"], r["predicted"]) for r in spark.read.parquet(out).collect()}

    assert run() == {}  # nothing has landed, not even the folder
    rows = [(s, f"v{i}", int(rng.integers(0, 3)) if rng.random() < 0.9 else None) for s in ("all", "s1", "s2", "s3") for i in range(32)]

    def want(some):
        sums = {}
        for s, v, d in some:
            hit = next((x for x in loads if x[0] == v and 0 < x[1] < 1), None)
            if hit and d is not None:
                z = (d - 2 * hit[1]) / np.sqrt(len(loads) * 2 * hit[1] * (1 - hit[1]))
                sums[s] = sums.get(s, 0) + np.array(hit[2:]) * z
        return sums

    batches = [[r for i, r in enumerate(rows) if r[0] == name or (r[0] == "all" and i % 3 == k)] for k, name in enumerate(("s1", "s2", "s3"))]
    landed = []
    for b in batches:  # one sample is spread over all batches; every run is a new query on the same checkpoint
        spark.createDataFrame(b, "sample string, variant_id string, dosage int").write.mode("append").parquet(landing)
        landed += b
        got, expected = run(), want(landed)
        assert set(got) == set(expected)
        assert all(np.allclose(got[s][:2], expected[s], atol=1e-9) for s in got)
    assert run() == got


def test_contigs_with_underscores(spark):
    loads = spark.createDataFrame([("chr1_KI270706v1_random_12_A_G", 0.5, 1.0), ("chr2_5_AC_T", 0.5, 1.0)], "variant_id string, af double, PC1 double")
    ref = PL.Reference(None, loads, [], None, 1)
    assert sorted(tuple(r)[1:] for r in PL.loading_sites(ref).collect()) == [("chr1_KI270706v1_random", 12, "A", "G"), ("chr2", 5, "AC", "T")]
