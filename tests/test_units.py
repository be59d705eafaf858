"""Hand-made cases for the quirks listed in SURVEY §7.5 and the golden BED."""

from pyspark.sql import functions as F

from locusframe.functions import coords as K
from locusframe.functions import genotype as G
from locusframe.functions import paths as P
from locusframe.functions.hwe import hwe_mid_p
from locusframe.operators import calls as C
from locusframe.operators import intervals as IV
from locusframe.operators import reshape as RS


def test_gt_parse_quirks(spark):
    df = spark.createDataFrame([("0/1",), ("1",), ("./1",), ("10/12",), ("0|1",), ("./.",), (None,)], "gt string")
    rows = C.parse_calls(df).collect()
    got = [(r.gt, r.a1, r.a2, r.phased, r.ploidy) for r in rows]
    assert got == [("0/1", 0, 1, False, 2), ("1", 1, None, False, 1), ("./1", None, 1, False, 2),
                   ("10/12", 10, 12, False, 2), ("0|1", 0, 1, True, 2), ("./.", None, None, False, 2),
                   (None, None, None, None, None)]


def test_info_flag_and_star(spark):
    df = spark.createDataFrame([("DP=3;DB;AF=0.5", "A,*")], "info string, alt string")
    r = df.select(G.info_to_map("info").alias("m"), G.star_to_dash("alt").alias("a")).first()
    assert r.m == {"DP": "3", "DB": None, "AF": "0.5"} and r.a == "A,-"


def test_variant_class_cases(spark):
    cases = [(".", "A", "nr"), ("AC", "A", "de"), ("A", "AC", "in"), ("AC", "GT", "mp"), ("A", "G", "ts"),
             ("C", "T", "ts"), ("A", "C", "tv"), ("A", "*", None), ("N", "A", None)]
    df = spark.createDataFrame([c[:2] for c in cases], "ref string, alt string")
    got = [r[0] for r in df.select(G.variant_class("ref", "alt")).collect()]
    assert got == [c[2] for c in cases]


def test_hwe_check_values():
    assert abs(hwe_mid_p(10, 0, 5) - 4.998e-05) < 1e-8
    assert abs(hwe_mid_p(50, 40, 10) - 0.55583012) < 1e-8


def test_bed_golden_lengths(spark):
    # the four-interval test BED: chr1 = 100 + 200, chr2 = 30 + 20
    bed = spark.createDataFrame([("chr1", 0, 100), ("chr1", 300, 500), ("chr2", 0, 30), ("chr2", 40, 60)],
                                "contig string, start long, end long")
    got = {r.contig: r.total_length for r in IV.interval_lengths(bed).collect()}
    assert got == {"chr1": 300, "chr2": 50}


def test_merge_touching_intervals(spark):
    iv = spark.createDataFrame([("c", 0, 10), ("c", 10, 20), ("c", 25, 30), ("c", 26, 28), ("d", 5, 6)],
                               "contig string, start long, end long")
    got = sorted(tuple(r) for r in IV.merge_intervals(iv, width=7).select("contig", "start", "end").collect())
    assert got == [("c", 0, 20), ("c", 25, 30), ("d", 5, 6)]


def test_region_round_trip(spark):
    df = spark.createDataFrame([("chr2:11-20",)], "r string")
    p = df.select(K.region_parse("r").alias("p")).first().p
    assert (p.contig, p.start, p.end) == ("chr2", 10, 20)
    assert spark.range(1).select(K.region_format(F.lit("chr2"), F.lit(10), F.lit(20))).first()[0] == "chr2:11-20"


def test_human_size(spark):
    df = spark.createDataFrame([(0,), (416,), (3866,), (1280,), (5 * 1024 ** 3,)], "s long")
    assert [r[0] for r in df.select(P.human_size("s")).collect()] == ["0 b", "416.0 b", "3.8 kb", "1.3 kb", "5.0 Gb"]


def test_normalize_trim(spark):
    df = spark.createDataFrame([(100, "TACG", "TAG"), (5, "GA", "GC"), (7, "A", "T")], "pos long, ref string, alt string")
    got = [tuple(r) for r in RS.normalize_trim(df).collect()]
    assert got == [(101, "AC", "A"), (6, "A", "C"), (7, "A", "T")]


def test_empty_vcf_reads_header_only(spark, tmp_path):
    from locusframe.sources.vcf import read_vcf
    p = tmp_path / "empty.vcf"
    p.write_text("##fileformat=VCFv4.2\n##contig=<ID=chr1,length=10>\n"
                 "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tS1\tS2\n")
    t = read_vcf(spark, str(p))
    assert t.entries.count() == 0 and t.samples.count() == 2 and t.contigs.count() == 1


def test_sharded_write_keeps_header_when_empty(spark, tmp_path):
    from locusframe.sources.vcf import write_vcf
    rec = spark.createDataFrame([], "shard long, contig string, pos long, value string")
    out = write_vcf(rec, ["##fileformat=VCFv4.2", "#CHROM\tPOS"], str(tmp_path / "o"), shard="shard")
    back = spark.read.text(out).collect()
    assert [r.value for r in back] == ["##fileformat=VCFv4.2", "#CHROM\tPOS"]


def test_interval_list_in_sorted_parts(spark, tmp_path):
    import glob

    from locusframe.sources.tables import interval_list_write
    iv = spark.range(4000).selectExpr("concat('chr', 1 + id % 2) AS contig", "(id * 37) % 4001 AS start", "(id * 37) % 4001 + 5 AS end", "'n' AS name")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        path = interval_list_write(iv, [("chr2", 9), ("chr1", 9)], f"{tmp_path}/o")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    parts = sorted(glob.glob(f"{path}/part-*"))
    lines = [x.split("\t") for p in parts for x in open(p).read().splitlines()]
    assert len(parts) > 1 and [x[0] for x in lines[:3]] == ["@HD", "@SQ", "@SQ"] and len(lines) == 4003
    keys = [({"chr2": 0, "chr1": 1}[x[0]], int(x[1])) for x in lines[3:]]
    assert keys == sorted(keys)
