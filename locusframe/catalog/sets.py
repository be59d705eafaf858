"""Sort, limit and set-operation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from locusframe.catalog import register
from locusframe.catalog._common import fx
from locusframe.catalog.aggregates import SQL_WORDS_SING
from locusframe.operators import intervals as IV
from locusframe.operators import tables as TB
from locusframe.operators import text as TX
from locusframe.operators.cohort import add_reference_controls, case_control_sets
from locusframe.operators.sorting import recent_submissions, regex_numeric_sort


@register("regex_numeric_sort", """
SELECT name, CAST(regexp_extract(name, '/([0-9]+)/part', 1) AS INTEGER) AS num FROM fx_blob
WHERE length(trim(name)) > 0 ORDER BY num""")
def q_regex_numeric_sort(spark, sf_dir):
    return regex_numeric_sort(fx(spark, sf_dir).fx_blob.select("name"), "name", r"/([0-9]+)/part")


@register("genome_sort", """
SELECT contig, start_pos, end_pos, name FROM fx_interval
ORDER BY CAST(substr(contig, 4) AS INTEGER), start_pos, end_pos""")
def q_genome_sort(spark, sf_dir):
    iv = fx(spark, sf_dir).fx_interval
    return IV.genome_sort(iv, start="start_pos", end="end_pos").select("contig", "start_pos", "end_pos", "name")


@register("recent_submissions", """
SELECT o_orderkey AS id, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS submitted, o_orderstatus AS state,
       'submissions/' || o_orderkey AS relpath
FROM orders ORDER BY o_orderdate DESC, o_orderkey""")
def q_recent_submissions(spark, sf_dir):
    o = fx(spark, sf_dir).orders
    raw = o.select(F.col("o_orderkey").alias("submissionId"),
                   F.date_format("o_orderdate", "MM/dd/yyyy HH:mm:ss").alias("submissionDate"),
                   F.col("o_orderstatus").alias("status"),
                   F.concat(F.lit("gs://work/submissions/"), F.col("o_orderkey").cast("string")).alias("path"))
    return recent_submissions(raw, "gs://work/", {"submissionId": "id", "status": "state"})


@register("longest_words", "WITH " + SQL_WORDS_SING + """
SELECT word, length(word) AS len FROM (SELECT word FROM ws GROUP BY word HAVING count(*) = 1) t
ORDER BY length(word) DESC, word LIMIT 20""")
def q_longest_words(spark, sf_dir):
    wc = TX.word_count(TX.singularize(TX.words(fx(spark, sf_dir).documents)))
    return TX.longest_words(wc, 1, 20)


SQL_CC = """merged AS (SELECT DISTINCT m.sample FROM fx_call c JOIN fx_sample m ON c.sid = m.sid),
ref AS (SELECT sample FROM fx_sample WHERE population IN ('EUROPE', 'ASIA')),
ctl AS (SELECT s_name AS sample FROM supplier WHERE s_acctbal >= 5000)"""


def _cc_inputs(f):
    merged = f.fx_call.select("sid").distinct().join(f.fx_sample, "sid").select("sample")
    ref = f.fx_sample.where(F.col("population").isin("EUROPE", "ASIA")).select("sample")
    ctl = f.supplier.where(F.col("s_acctbal") >= 5000).select(F.col("s_name").alias("sample"))
    return merged, ref, ctl


@register("case_control_sets", "WITH " + SQL_CC + """
SELECT sample, 'case' AS label FROM ((SELECT sample FROM merged EXCEPT SELECT sample FROM ref) EXCEPT SELECT sample FROM ctl) a
UNION ALL SELECT sample, 'control' FROM (SELECT sample FROM ctl EXCEPT SELECT sample FROM ref) b""")
def q_case_control_sets(spark, sf_dir):
    return case_control_sets(*_cc_inputs(fx(spark, sf_dir)))


@register("key_set_compare", """
WITH a AS (SELECT DISTINCT substr('cfgA.' || user_id, 6) AS key FROM events WHERE event_type = 'click'),
b AS (SELECT DISTINCT substr('cfgB.' || user_id, 6) AS key FROM events WHERE event_type = 'view')
SELECT key, 'only_a' AS side FROM (SELECT key FROM a EXCEPT SELECT key FROM b) x
UNION ALL SELECT key, 'only_b' FROM (SELECT key FROM b EXCEPT SELECT key FROM a) y
UNION ALL SELECT key, 'both' FROM (SELECT key FROM a INTERSECT SELECT key FROM b) z""")
def q_key_set_compare(spark, sf_dir):
    e = fx(spark, sf_dir).events
    from locusframe.functions.paths import strip_prefix
    a = e.where(F.col("event_type") == "click").select(
        strip_prefix(F.concat(F.lit("cfgA."), F.col("user_id").cast("string")), "cfgA.").alias("key"))
    b = e.where(F.col("event_type") == "view").select(
        strip_prefix(F.concat(F.lit("cfgB."), F.col("user_id").cast("string")), "cfgB.").alias("key"))
    return TB.tagged_set_compare(a, b, "key")


@register("concat_results", """
SELECT sid, sample, population, 'EUROPE' AS source, CAST(sid * 2 AS BIGINT) AS extra FROM fx_sample WHERE population = 'EUROPE'
UNION ALL SELECT sid, sample, population, 'OTHER', NULL FROM fx_sample WHERE population <> 'EUROPE'""")
def q_concat_results(spark, sf_dir):
    s = fx(spark, sf_dir).fx_sample
    a = s.where(F.col("population") == "EUROPE").withColumn("extra", (F.col("sid") * 2).cast("long"))
    b = s.where(F.col("population") != "EUROPE")
    return TB.stack([a, b], ["EUROPE", "OTHER"]).select("sid", "sample", "population", "source", "extra")


@register("add_reference_controls", "WITH " + SQL_CC + """
SELECT sample, 'control' AS label, 'control_file' AS origin FROM ctl
UNION ALL SELECT sample, 'control', 'reference' FROM ref""")
def q_add_reference_controls(spark, sf_dir):
    _, ref, ctl = _cc_inputs(fx(spark, sf_dir))
    return add_reference_controls(ctl, ref, include=True)
