"""Typed fields: split per ALT and joined back."""

import random

import pytest
from pyspark.sql import functions as F

from locusframe.operators import fields as FL

HEADER = ['##INFO=<ID=AF,Number=A,Type=Float,Description="a, b">', '##INFO=<ID=DB,Number=0,Type=Flag,Description="">',
          '##FORMAT=<ID=AD,Number=R,Type=Integer,Description="x">', '##FORMAT=<ID=PL,Number=G,Type=Integer,Description="x">',
          '##FORMAT=<ID=RNC,Number=2,Type=Character,Description="x">', '##contig=<ID=chr1,length=9>', '##FORMAT=<ID=GQ,Number=1,Type=Integer,Description="x">']


@pytest.fixture
def declared(spark):
    return FL.header_fields(spark.createDataFrame([(x,) for x in HEADER + HEADER[:1]], "value string"))


def test_header(spark, declared):
    assert [(f.kind, f.name, f.number, f.sql_type) for f in declared] == [
        ("FORMAT", "AD", "R", "int"), ("FORMAT", "GQ", "1", "int"), ("FORMAT", "PL", "G", "int"), ("FORMAT", "RNC", "2", "string"),
        ("INFO", "AF", "A", "double"), ("INFO", "DB", "0", "boolean")]
    with pytest.raises(ValueError, match="different"):
        FL.header_fields(spark.createDataFrame([(HEADER[0],), (HEADER[0].replace("Number=A", "Number=1"),)], "value string"))


def test_genotype_places(spark):
    pairs = [(j, k) for k in range(12) for j in range(k + 1)]
    df = spark.createDataFrame([(i, j, k) for i, (j, k) in enumerate(pairs)], "i int, j int, k int")
    j, k = FL.genotype_alleles(F.col("i"))
    out = df.select("i", "j", "k", FL.genotype_place(F.col("j"), F.col("k")).alias("p"), j.alias("a"), k.alias("b")).collect()
    assert all((r["p"], r["a"], r["b"]) == (r["i"], r["j"], r["k"]) for r in out)


def test_split_and_join(spark, declared):
    rng = random.Random(2)
    fields = [f for f in declared if f.kind == "FORMAT"]
    rows, want = [], {}
    for i in range(200):
        n = rng.randrange(1, 5)
        size = rng.choice([(n + 1) * (n + 2) // 2, (n + 1) * (n + 2) // 2, n + 1])
        ad = [rng.choice([".", "x", str(rng.randrange(99))]) for _ in range(n + 1)]
        pl = [str(rng.randrange(99)) for _ in range(size)]
        parts = {"GT": "0/1", "AD": ",".join(ad), "PL": ",".join(pl), "RNC": "I,.", "GQ": "7"}
        if rng.random() < 0.2:
            parts["PL"] = "."
        if rng.random() < 0.2:
            del parts["AD"]
        rows.append((i, ",".join("ACGT"[:n]), ":".join(parts), ":".join(parts.values())))
        nums = [int(x) if x.isdigit() else None for x in ad] if "AD" in parts else None
        # a list of unreadable values cannot be told from a missing one after the split of its own ALTs
        pairs = [(j, k) for k in range(n + 1) for j in range(k + 1)]
        whole = None if parts["PL"] == "." else [int(x) for x in pl]
        if whole and size != n + 1:
            whole = [v if j in (0, k) else None for v, (j, k) in zip(whole, pairs)]
        want[i] = (",".join("ACGT"[:n]), nums, 7, whole, ["I", "."])
    df = spark.createDataFrame(rows, "vid int, alt string, format string, entry string")
    split = FL.split_fields(FL.with_format(df, fields), fields)
    one = {(r["vid"], r["allele"]): r for r in split.collect()}
    for i, (alts, ad, _, _, _) in want.items():
        for a in range(1, len(alts.split(",")) + 1):
            assert one[i, a]["alt"] == "ACGT"[a - 1] and one[i, a]["AD"] == (None if ad is None else [ad[0], ad[a]])
    got = {r["vid"]: (r["alt"], r["AD"], r["GQ"], r["PL"], r["RNC"]) for r in FL.join_fields(split, ["vid"], fields).collect()}
    assert got == want


def test_info_and_missing(spark, declared):
    fields = [f for f in declared if f.kind == "INFO"]
    rows = [(1, "A,C", "DB;AF=0.5,."), (2, "A", "AF=0.1"), (3, "A", "."), (4, "A", None), (5, "A", "AFX=1;AF"), (6, "A,C", "AF=.")]
    df = FL.with_info(spark.createDataFrame(rows, "vid int, alt string, info string"), fields)
    out = [(r["vid"], r["allele"], r["AF"], r["DB"]) for r in FL.split_fields(df, fields).orderBy("vid", "allele").collect()]
    assert out == [(1, 1, 0.5, True), (1, 2, None, True), (2, 1, 0.1, False), (3, 1, None, False), (4, 1, None, False),
                   (5, 1, None, False), (6, 1, None, False), (6, 2, None, False)]
    assert FL.split_fields(df.limit(0), fields).collect() == []
