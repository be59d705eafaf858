"""The table function against the DataFrame form."""

import pytest
from pyspark.sql import functions as F

from locusframe.functions import udtf as UD
from locusframe.operators import calls as C


def test_equals_the_dataframe_form(spark):
    UD.register(spark)
    calls = spark.createDataFrame([(1, 10, 0, 1), (1, 11, None, 2), (2, 10, 1, 1), (2, 11, None, None), (3, 10, 12, 0)],
                                  "vid bigint, sid bigint, a1 int, a2 int")
    sites = spark.createDataFrame([(1, "A", "G,T"), (2, "C", "T"), (3, "C", ",".join("ACGT"[i % 4] * (i + 1) for i in range(12)))],
                                  "vid bigint, ref string, alt string")
    got = spark.sql("SELECT vid, sid, allele, alt, r1, r2 FROM decompose(TABLE(SELECT c.*, s.ref, s.alt FROM {c} c JOIN {s} s ON c.vid = s.vid))",
                    c=calls, s=sites)
    want = C.decompose(calls, sites).select("vid", "sid", "allele", "alt", "r1", "r2")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.count() == 18


def test_columns_and_empty(spark):
    UD.register(spark)
    none = spark.createDataFrame([], "x date, a1 int, a2 int, ref string, alt string")
    got = spark.sql("SELECT * FROM decompose(TABLE(SELECT * FROM {t}))", t=none)
    assert got.columns == ["x", "ref", "allele", "alt", "r1", "r2"] and got.collect() == []
    with pytest.raises(Exception, match="missing: alt"):
        spark.sql("SELECT * FROM decompose(TABLE(SELECT a1, a2, ref FROM {t}))", t=none).collect()
    null = spark.createDataFrame([(1, 0, "A", None)], "a1 int, a2 int, ref string, alt string")
    assert spark.sql("SELECT * FROM decompose(TABLE(SELECT * FROM {t}))", t=null).where(F.lit(True)).collect() == []


def test_rows_do_not_become_a_batch_each(spark):
    UD.register(spark)
    calls = spark.range(3).selectExpr("id", "0 AS a1", "1 AS a2", "'A' AS ref", "'C,G' AS alt")
    got = spark.sql("SELECT * FROM decompose(TABLE(SELECT * FROM {t}))", t=calls)
    assert "ArrowEvalPythonUDTF" not in got._jdf.queryExecution().executedPlan().toString()
    assert got.count() == 6
