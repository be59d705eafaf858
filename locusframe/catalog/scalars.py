"""Scalar-function queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from locusframe.catalog import register
from locusframe.catalog._common import (SQL_PCALL, SQL_SALT, SQL_VQC_FILLED, fx, n_samples,
                                        parsed_calls, rounded)
from locusframe.functions import coords as K
from locusframe.functions import genotype as G
from locusframe.functions import labels as L
from locusframe.functions import paths as P
from locusframe.functions.hwe import hwe_exact_p, hwe_sql
from locusframe.operators import calls as C


@register("gt_parse", "WITH " + SQL_PCALL + """
SELECT vid, sid, gt, a1, a2, ploidy, gt LIKE '%|%' AS phased FROM pcall""")
def q_gt_parse(spark, sf_dir):
    c = parsed_calls(fx(spark, sf_dir))
    return c.select("vid", "sid", "gt", "a1", "a2", "ploidy", "phased")


@register("gt_fill_homref", """
SELECT vid, sid, CASE WHEN gt IS NULL OR regexp_matches(gt, '^\\.([/|]\\.)*$') THEN '0/0' ELSE gt END AS gt
FROM fx_call""")
def q_gt_fill_homref(spark, sf_dir):
    c = fx(spark, sf_dir).fx_call
    return c.select("vid", "sid", G.gt_fill_homref("gt").alias("gt"))


@register("alt_dosage", "WITH " + SQL_PCALL + """
SELECT vid, sid, CASE WHEN a1 IS NULL AND a2 IS NULL THEN NULL
  ELSE (CASE WHEN a1 > 0 THEN 1 ELSE 0 END) + (CASE WHEN a2 > 0 THEN 1 ELSE 0 END) END AS dosage
FROM pcall""")
def q_alt_dosage(spark, sf_dir):
    c = parsed_calls(fx(spark, sf_dir))
    return c.select("vid", "sid", G.alt_dosage("a1", "a2").alias("dosage"))


@register("variant_class", "WITH " + SQL_SALT + """
SELECT vid, allele, ref, alt,
  CASE WHEN ref = '.' THEN 'nr' WHEN length(alt) < length(ref) THEN 'de' WHEN length(alt) > length(ref) THEN 'in'
       WHEN length(ref) > 1 THEN 'mp' WHEN upper(ref) || upper(alt) IN ('AG', 'GA', 'CT', 'TC') THEN 'ts'
       WHEN upper(ref) IN ('A','C','G','T') AND upper(alt) IN ('A','C','G','T') AND upper(ref) <> upper(alt) THEN 'tv' END AS vclass
FROM salt""")
def q_variant_class(spark, sf_dir):
    s = C.split_alleles(fx(spark, sf_dir).fx_site)
    return s.select("vid", "allele", "ref", "alt", G.variant_class("ref", "alt").alias("vclass"))


@register("snp_or_indel", "WITH " + SQL_SALT + """
SELECT vid, allele, CASE WHEN length(ref) <> length(alt) THEN 1 ELSE 0 END AS is_indel FROM salt""")
def q_snp_or_indel(spark, sf_dir):
    s = C.split_alleles(fx(spark, sf_dir).fx_site)
    return s.select("vid", "allele", G.snp_or_indel("ref", "alt").alias("is_indel"))


@register("info_to_map", """
SELECT vid, sid, split_part(kv, '=', 1) AS key,
       CASE WHEN strpos(kv, '=') > 0 THEN substr(kv, strpos(kv, '=') + 1) END AS value
FROM (SELECT vid, sid, unnest(string_split(info, ';')) AS kv FROM fx_entry) t""")
def q_info_to_map(spark, sf_dir):
    e = fx(spark, sf_dir).fx_entry
    return e.select("vid", "sid", F.explode(G.info_to_map("info")).alias("key", "value"))


@register("format_to_map", """
SELECT vid, sid, string_split(format, ':')[i] AS key, string_split(entry, ':')[i] AS value
FROM (SELECT *, unnest(range(1, least(len(string_split(format, ':')), len(string_split(entry, ':'))) + 1)) AS i
      FROM fx_entry) t""")
def q_format_to_map(spark, sf_dir):
    e = fx(spark, sf_dir).fx_entry
    return e.select("vid", "sid", F.explode(G.format_to_map("format", "entry")).alias("key", "value"))


@register("region_parse", """
SELECT region, contig, CAST(a AS BIGINT) - 1 AS start_pos, CAST(b AS BIGINT) AS end_pos,
       contig || ':' || a || '-' || b AS formatted
FROM (SELECT contig || ':' || (start_pos + 1) || '-' || end_pos AS region, contig,
             CAST(start_pos + 1 AS VARCHAR) AS a, CAST(end_pos AS VARCHAR) AS b FROM fx_interval) t""")
def q_region_parse(spark, sf_dir):
    i = fx(spark, sf_dir).fx_interval
    r = i.select(K.region_format("contig", "start_pos", "end_pos").alias("region"))
    p = r.withColumn("_p", K.region_parse("region"))
    return p.select("region", F.col("_p.contig").alias("contig"), F.col("_p.start").alias("start_pos"),
                    F.col("_p.end").alias("end_pos"),
                    K.region_format("_p.contig", "_p.start", "_p.end").alias("formatted"))


@register("coord_shift", """
SELECT CASE WHEN contig LIKE 'chr%' THEN contig ELSE 'chr' || contig END AS contig,
       start_pos + 1 AS start_1based, end_pos AS end_inclusive, start_pos AS start_0based, name
FROM (SELECT replace(contig, 'chr', '') AS contig, start_pos, end_pos, name FROM fx_interval) t""")
def q_coord_shift(spark, sf_dir):
    i = fx(spark, sf_dir).fx_interval.withColumn("contig", F.regexp_replace("contig", "chr", ""))
    one = i.select(K.add_chr("contig").alias("contig"), K.to_one_based("start_pos").alias("start_1based"),
                   F.col("end_pos").alias("end_inclusive"), "name")
    return one.withColumn("start_0based", K.to_zero_based("start_1based"))


@register("variant_id", """
SELECT vid, contig || '_' || pos || '_' || ref || '_' || alt AS variant_id FROM fx_site""")
def q_variant_id(spark, sf_dir):
    s = fx(spark, sf_dir).fx_site
    return s.select("vid", G.variant_id("contig", "pos", "ref", "alt").alias("variant_id"))


@register("star_to_dash", """
SELECT vid, translate(CASE WHEN vid % 17 = 0 THEN alt || ',*' ELSE alt END, '*', '-') AS alt FROM fx_site""")
def q_star_to_dash(spark, sf_dir):
    s = fx(spark, sf_dir).fx_site
    # sites with a spanning deletion carry an extra '*' ALT in this query's input
    a = F.when(F.col("vid") % 17 == 0, F.concat("alt", F.lit(",*"))).otherwise(F.col("alt"))
    return s.select("vid", G.star_to_dash(a).alias("alt"))


@register("hwe_exact_p", "WITH " + SQL_VQC_FILLED + """,
p AS """ + hwe_sql("vqcf", "vid, allele") + """
SELECT v.vid, v.allele, v.n_hom_ref, v.n_het, v.n_hom_alt, round(p.p_hwe, 6) AS p_hwe
FROM vqcf v JOIN p ON v.vid = p.vid AND v.allele = p.allele""")
def q_hwe_exact_p(spark, sf_dir):
    f = fx(spark, sf_dir)
    q = C.variant_qc(C.decompose(parsed_calls(f), f.fx_site), n_samples(f), fill_homref=True, sites=f.fx_site)
    return rounded(q.select("vid", "allele", "n_hom_ref", "n_het", "n_hom_alt",
                            hwe_exact_p("n_hom_ref", "n_het", "n_hom_alt").alias("p_hwe")))


@register("human_size", """
SELECT name, size, CASE WHEN size = 0 THEN '0 b' ELSE printf('%.1f %sb', round(size / pow(1024.0, k), 1), ['', 'k', 'M', 'G', 'T'][k + 1]) END AS hsize
FROM (SELECT name, size, CASE WHEN size >= 1099511627776 THEN 4 WHEN size >= 1073741824 THEN 3
        WHEN size >= 1048576 THEN 2 WHEN size >= 1024 THEN 1 ELSE 0 END AS k FROM fx_blob) t""")
def q_human_size(spark, sf_dir):
    b = fx(spark, sf_dir).fx_blob
    return b.select("name", "size", P.human_size("size").alias("hsize"))


@register("path_parts", """
SELECT name, regexp_extract(name, '[^/]*$') AS basename, regexp_extract(name, '^(.*)/[^/]*$', 1) AS parent,
       regexp_replace(name, '^src[0-9]+/', '') AS relpath,
       regexp_replace(regexp_replace(name, '[^/]*/', '', 'g'), '\\.txt$', '') AS stem
FROM fx_blob""")
def q_path_parts(spark, sf_dir):
    b = fx(spark, sf_dir).fx_blob
    return b.select("name", P.basename("name").alias("basename"), P.parent("name").alias("parent"),
                    F.regexp_replace("name", r"^src[0-9]+/", "").alias("relpath"),
                    P.strip_ext(P.basename("name"), r"\.txt$").alias("stem"))


@register("path_template", """
SELECT entity, concat_ws('/', 'gs://archive', NULLIF('samples', ''), NULLIF(CAST(entity AS VARCHAR), ''),
                         NULLIF('cram', ''), NULLIF(regexp_extract(cram, '[^/]*$'), '')) AS dest
FROM fx_entity""")
def q_path_template(spark, sf_dir):
    e = fx(spark, sf_dir).fx_entity
    return e.select("entity", P.join_nonempty(F.lit("gs://archive"), F.lit("samples"), F.col("entity").cast("string"),
                                              F.lit("cram"), P.basename("cram")).alias("dest"))


@register("tz_convert", """
SELECT event_id, strftime(ts - INTERVAL 5 HOUR, '%Y-%m-%d %H:%M:%S') AS ts_est,
       strftime(ts + INTERVAL 5 HOUR, '%Y-%m-%d %H:%M:%S') AS ts_utc_from_est
FROM events""")
def q_tz_convert(spark, sf_dir):
    e = fx(spark, sf_dir).events
    fmt = "yyyy-MM-dd HH:mm:ss"
    return e.select("event_id", F.date_format(L.tz_convert("ts", "EST"), fmt).alias("ts_est"),
                    F.date_format(L.tz_convert("ts", "EST", to_utc=True), fmt).alias("ts_utc_from_est"))


FIXTURE_LABELS = ["EUROPE", "AFRICA", "ASIA", "MIDDLE EAST", "AMERICA"]


@register("label_recode", """
SELECT sid, population, list_position(['EUROPE', 'AFRICA', 'ASIA', 'MIDDLE EAST', 'AMERICA'], population) AS code,
       ['EUROPE', 'AFRICA', 'ASIA', 'MIDDLE EAST', 'AMERICA'][list_position(['EUROPE', 'AFRICA', 'ASIA', 'MIDDLE EAST', 'AMERICA'], population)] AS label_back
FROM fx_sample""")
def q_label_recode(spark, sf_dir):
    s = fx(spark, sf_dir).fx_sample
    c = s.select("sid", "population", L.label_to_code("population", FIXTURE_LABELS).alias("code"))
    return c.withColumn("label_back", L.code_to_label("code", FIXTURE_LABELS))
