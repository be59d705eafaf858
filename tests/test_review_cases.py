"""Cases the fixtures do not hold: call-less sites, null cells, null scan keys,
several VCF headers, samples spread over stream files."""

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from locusframe.operators import calls as C
from locusframe.operators import intervals as IV
from locusframe.operators.filters import variants_to_table
from locusframe.operators.scan import row_index
from locusframe.operators.stats import metric_histogram
from locusframe.plans import ancestry as PL
from locusframe.sources.store import variant_store
from locusframe.sources.vcf import read_vcf

CALLS = "vid bigint, sid bigint, a1 int, a2 int, ploidy int"


def test_sites_without_calls_stay(spark):
    sites = spark.createDataFrame([(1, "A", "G"), (2, "C", "T,G")], "vid bigint, ref string, alt string")
    calls = spark.createDataFrame([(1, 1, 0, 1, 2)], CALLS)
    d = C.decompose(calls, sites)
    for fill, an in ((False, 0), (True, 6)):
        qc = {(r["vid"], r["allele"]): r for r in C.variant_qc(d, 3, fill_homref=fill, sites=sites).collect()}
        assert set(qc) == {(1, 1), (2, 1), (2, 2)}
        assert (qc[2, 2]["AN"], qc[2, 2]["AC"]) == (an, 0)
    assert {(r["vid"], r["allele"]): r["mean_af"] for r in C.mean_af(d, 2, sites=sites).collect()} == {(1, 1): 0.25, (2, 1): 0, (2, 2): 0}
    tags = {(r["vid"], r["allele"]): (r["AN"], r["AC"], r["NS"]) for r in C.fill_tags(calls, sites).collect()}
    assert tags == {(1, 1): (2, 1, 1), (2, 1): (0, 0, 0), (2, 2): (0, 0, 0)}


def test_table_keeps_null_cells_in_place(spark):
    sites = spark.createDataFrame([(1,), (2,)], "vid bigint")
    e = spark.createDataFrame([(1, "a", "0/1", None), (1, "b", None, 7), (1, "c", "1/1", 3)], "vid bigint, sample string, gt string, dp int")
    rows = {r["vid"]: r.asDict() for r in variants_to_table(sites, e, ["vid"], ["gt", "dp"]).collect()}
    assert rows[1] == {"vid": 1, "a_gt": "0/1", "a_dp": None, "b_gt": None, "b_dp": 7, "c_gt": "1/1", "c_dp": 3}
    assert set(rows[2].values()) == {2, None}


def test_scan_keeps_null_keys(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 1)], "bk string, v int")
    assert sorted((str(r["bk"]), r["v"], r["row_idx"]) for r in row_index(df, [], ["bk"], ["bk", "v"]).collect()) == [
        ("None", 1, 0), ("None", 2, 1), ("a", 1, 2)]


def test_unknown_contigs_do_not_interleave(spark):
    df = spark.createDataFrame([("chrUn_B", 1, 2), ("chrUn_A", 5, 6), ("chrUn_B", 7, 8), ("chrX", 1, 2)], "contig string, start int, end int")
    assert [r["contig"] for r in IV.genome_sort(df).collect()] == ["chrX", "chrUn_A", "chrUn_B", "chrUn_B"]


def test_records_without_a_header_fail(spark, tmp_path):
    head = "##fileformat=VCFv4.2\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\t{}\n"
    rec = "chr1\t{}\t.\tA\tG\t.\tPASS\t.\tGT\t0/1\n"
    (tmp_path / "a.vcf").write_text(head.format("s1") + rec.format(1))
    (tmp_path / "b.vcf").write_text(head.format("s2") + rec.format(2))
    assert read_vcf(spark, str(tmp_path)).entries.count() == 2
    (tmp_path / "c.vcf").write_text(rec.format(3))
    with pytest.raises(ValueError):
        read_vcf(spark, str(tmp_path))


def test_sample_spread_over_stream_files(spark, tmp_path, monkeypatch):
    from locusframe.streaming import incremental as INC
    monkeypatch.setattr(INC.RF, "rf_predict", lambda model, df, out: df.withColumn(out, F.lit("x")))
    loadings = spark.createDataFrame([(f"v{i}", 0.5, 1.0) for i in range(6)], "variant_id string, af double, PC1 double")
    landing, out, mark = (str(tmp_path / x) for x in ("landing", "out", "mark"))

    def land(part):
        rows = spark.createDataFrame([(s, f"v{i}", 2) for s in "ab" for i in part], INC.ENTRY_SCHEMA)
        rows.repartition(5).write.mode("append").parquet(landing)
        INC.run_incremental_infer(spark, landing, loadings, ["PC1"], None, out, mark)
        return {r["sample"]: round(r["PC1"], 9) for r in spark.read.parquet(out).collect()}

    half = land(range(3))
    whole = land(range(3, 6))
    assert set(whole) == {"a", "b"} and all(whole[s] == pytest.approx(2 * half[s]) for s in whole)


def test_forests_and_round_two_at_full_size(spark, registry, monkeypatch):
    from locusframe.catalog import cohort as CO
    asked = {}

    def cross(df, features, label, key, k=5, **kw):
        asked["cross"] = (features, kw)
        return [1.0] * k

    def two(spark, calls, sites, labelled, labels, k=2, **kw):
        asked["k"] = k
        return labelled.select(F.lit(0.0).alias("PC1"))

    monkeypatch.setattr(CO.RF, "rf_cross_validate", cross)
    monkeypatch.setattr(CO.PL, "ancestry_round_two", two)
    registry["rf_cross_validate"].run(spark, SF_SMALL)
    registry["ancestry_round_two"].run(spark, SF_SMALL)
    f = CO.fx(spark, SF_SMALL)
    forest = CO._model(f).stages[-1]
    width = len(f.embeddings.first()["embedding"])
    assert len(asked["cross"][0]) == forest.numFeatures == width == 64 and asked["cross"][1] == {}
    assert forest.getNumTrees == CO.RF.N_TREES == 100 and forest.getOrDefault("maxDepth") == 30
    assert asked["k"] == 10


def test_round_two_fills_missing_components(spark):
    sites = spark.createDataFrame([(i, "chr1", 1 + 2_000_000 * i, "A", "C", f"r{i}") for i in range(4)],
                                  "vid long, contig string, pos long, ref string, alt string, rsid string")
    gts = [(0, 1), (1, 1), (0, 0), (0, 1), (1, 1), (0, 1), (0, 0), (0, 1), (0, 1), (0, 0), (0, 1), (0, 1)]
    calls = spark.createDataFrame([(i // 3, i % 3, *g, 2) for i, g in enumerate(gts)], CALLS)
    lab = spark.createDataFrame([(i, "X", "case") for i in range(3)], "sid long, ancestry string, cohort string")
    out = PL.ancestry_round_two(spark, calls, sites, lab, ["X"], k=5)
    assert {f"PC{i}" for i in range(1, 6)} <= set(out.columns)
    assert all(r["PC1"] is not None and r["PC3"] is None and r["PC5"] is None for r in out.collect())


def test_overlaps_of_all_interval_classes(spark, registry):
    out = registry["overlap_join_blocks"].run(spark, SF_SMALL)
    names = {r["name"] for r in out.select("name").distinct().collect()}
    assert names == {"1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"}


def test_records_wider_than_the_header_fail(spark, tmp_path):
    head = "##fileformat=VCFv4.2\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\ts1\ts2\n"
    rec = "chr1\t{}\t.\tA\tG\t.\tPASS\t.\tGT\t0/1\t1/1{}\n"
    (tmp_path / "a.vcf").write_text(head + rec.format(1, "") + rec.format(2, "\t0/1"))
    with pytest.raises(Exception, match="more entries than its header"):
        read_vcf(spark, str(tmp_path)).entries.collect()
    (tmp_path / "a.vcf").write_text(head + rec.format(1, ""))
    assert [r["sample"] for r in read_vcf(spark, str(tmp_path)).entries.orderBy("col").collect()] == ["s1", "s2"]


def test_store_keeps_unlisted_contigs_and_repeated_records(spark, tmp_path):
    head = "##fileformat=VCFv4.2\n##contig=<ID=chr1>\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\ts1\ts2\n"
    rec = "{}\t5\t.\tA\tG,T\t.\tPASS\t.\tGT\t0/1\t{}\n"
    (tmp_path / "a.vcf").write_text(head + rec.format("chr1", "1/2") + rec.format("chr1", "0/0") + rec.format("chrUn_B", "1/1") + rec.format("chrUn_A", "0/0"))
    st = variant_store(read_vcf(spark, str(tmp_path)), ["chr1", "chr2"])
    assert {(r["name"], r["cid"], r["loci"]) for r in st["contig"].collect()} == {("chr1", 0, 2), ("chr2", 1, 0), ("chrUn_A", 2, 1), ("chrUn_B", 3, 1)}
    got = st["variant"].join(st["locus"], "line").select("line", "cid", "col", "alt").collect()
    # the two records of chr1 are loci of their own: three carried copies in the first, one in the second
    assert sorted((r["cid"], r["col"], r["alt"]) for r in got) == sorted(
        [(0, 0, "G"), (0, 1, "G"), (0, 1, "T"), (0, 0, "G"), (2, 0, "G"), (3, 0, "G"), (3, 1, "G"), (3, 1, "G")])
    assert len({r["line"] for r in got if r["cid"] == 0}) == 2


def test_zero_rows_stay(spark):
    sites = spark.createDataFrame([(1, "A", "G"), (2, "C", "T")], "vid bigint, ref string, alt string")
    calls = spark.createDataFrame([(1, 1, 0, 1, 2)], CALLS)
    samples = spark.createDataFrame([(1,), (7,)], "sid bigint")
    qc = {r["sid"]: (r["n_het"], r["n_snp"], r["n_singleton"], r["ti_tv"]) for r in C.sample_qc(calls, sites, samples=samples).collect()}
    assert qc == {1: (1, 1, 1, None), 7: (0, 0, 0, None)}
    assert {r["vid"]: (r["snp_copies"], r["indel_copies"]) for r in C.site_allele_counts(calls, sites).collect()} == {1: (1, 0), 2: (0, 0)}
    v = spark.createDataFrame([("a", 0), ("a", 10), ("a", 10), ("b", 3), ("c", None)], "g string, x int")
    hist = sorted((r["g"], r["bin"], r["n"]) for r in metric_histogram(v, "x", 3, ["g"]).collect())
    assert hist == [("a", 0, 1), ("a", 1, 0), ("a", 2, 2), ("b", 0, 1), ("b", 1, 0), ("b", 2, 0)]
    assert sorted((r["bin"], r["n"]) for r in metric_histogram(v, "x", 2).collect()) == [(0, 2), (1, 2)]


def test_regions_of_unnamed_contigs_do_not_interleave(spark):
    isl = spark.createDataFrame([("chrUn_B", 0, 10), ("chrUn_A", 5, 15), ("chrUn_B", 20, 30), ("chrUn_A", 40, 50)], "contig string, start bigint, end bigint")
    rank = isl.select("contig").distinct().withColumn("rank", IV.natural_contig_rank("contig"))
    got = sorted(tuple(r) for r in IV.equal_span_regions(isl, rank, 20).collect())
    assert got == [(0, "chrUn_A", 5, 50), (1, "chrUn_B", 0, 30)]
