"""Aggregation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from locusframe.catalog import register
from locusframe.catalog._common import (SQL_DCALL, SQL_NSAMP, SQL_VQC_AGG, fx, n_samples,
                                        parsed_calls, rounded)
from locusframe.operators import calls as C
from locusframe.sources import packed as PK


@register("variant_qc", ("WITH " + SQL_DCALL + ",\n" + SQL_NSAMP + ",\n" + SQL_VQC_AGG + """
SELECT vid, allele, AC, AN, n_called, n - n_called AS n_not_called,
       round(n_called / CAST(n AS DOUBLE), 6) AS call_rate, n_het, n_hom_ref, n_hom_alt, n_hemi,
       round(CASE WHEN AN > 0 THEN AC / CAST(AN AS DOUBLE) END, 6) AS AF_alt,
       round(CASE WHEN AN > 0 THEN 1 - AC / CAST(AN AS DOUBLE) END, 6) AS AF_ref
FROM vqc0, nsamp"""))
def q_variant_qc(spark, sf_dir):
    f = fx(spark, sf_dir)
    d = C.decompose(parsed_calls(f), f.fx_site)
    return rounded(C.variant_qc(d, n_samples(f), sites=f.fx_site))


SQL_PACKED_QC = "WITH " + SQL_DCALL + ",\n" + SQL_NSAMP + ",\n" + SQL_VQC_AGG + """,
full_qc AS (SELECT s.contig, s.pos, s.ref, s.old_alt, s.alt, s.allele, n, coalesce(n_called, 0) AS n_called, coalesce(AN, 0) AS AN, coalesce(AC, 0) AS AC,
  coalesce(n_het, 0) AS n_het, coalesce(n_hom_ref, 0) AS n_hom_ref, coalesce(n_hom_alt, 0) AS n_hom_alt, coalesce(n_hemi, 0) AS n_hemi
  FROM salt s LEFT JOIN vqc0 v ON s.vid = v.vid AND s.allele = v.allele, nsamp)
SELECT contig, pos, ref, old_alt, alt, allele, n_called, AN, AC, n_het, n_hom_ref, n_hom_alt, n_hemi, n - n_called AS n_not_called,
  round(n_called / CAST(n AS DOUBLE), 6) AS call_rate, round(CASE WHEN AN > 0 THEN AC / CAST(AN AS DOUBLE) END, 6) AS AF_alt,
  round(CASE WHEN AN > 0 THEN 1 - AC / CAST(AN AS DOUBLE) END, 6) AS AF_ref FROM full_qc"""


@register("packed_variant_qc", SQL_PACKED_QC)
def q_packed_variant_qc(spark, sf_dir):
    from locusframe.catalog.sources import fixture_vcf
    qc = PK.packed_variant_qc(PK.read_packed(spark, fixture_vcf(fx(spark, sf_dir))))
    return rounded(qc.drop("id", "qual", "filter", "info").withColumn("allele", F.col("allele").cast("long")))


@register("packed_sample_qc", "WITH " + SQL_DCALL + """,
per AS (SELECT sid, CAST(sum(CASE WHEN k > 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_called,
  CAST(sum(CASE WHEN k = 2 AND d = 1 THEN 1 ELSE 0 END) AS BIGINT) AS n_het, CAST(sum(CASE WHEN k = 2 AND d = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_hom_ref,
  CAST(sum(CASE WHEN k = 2 AND d = 2 THEN 1 ELSE 0 END) AS BIGINT) AS n_hom_alt, CAST(sum(CASE WHEN k = 1 THEN 1 ELSE 0 END) AS BIGINT) AS n_hemi
  FROM dcall GROUP BY sid)
SELECT s.sample, coalesce(n_called, 0) AS n_called, coalesce(n_het, 0) AS n_het, coalesce(n_hom_ref, 0) AS n_hom_ref,
  coalesce(n_hom_alt, 0) AS n_hom_alt, coalesce(n_hemi, 0) AS n_hemi FROM fx_sample s LEFT JOIN per p ON s.sid = p.sid""")
def q_packed_sample_qc(spark, sf_dir):
    from locusframe.catalog.sources import fixture_vcf
    from locusframe.sources import vcf as V
    path = fixture_vcf(fx(spark, sf_dir))
    names, _ = V.header_tables(V.vcf_header_only(spark, path))
    got = PK.packed_sample_qc(PK.read_packed(spark, path)).withColumnRenamed("sample", "col")
    return got.join(names.drop("file").distinct(), "col").drop("col")


from locusframe.catalog._common import SQL_PCALL, SQL_SALT, SQL_VQC_FILLED  # noqa: E402
from locusframe.functions.hwe import hwe_sql  # noqa: E402
from locusframe.operators import intervals as IV  # noqa: E402
from locusframe.operators import listing as LS  # noqa: E402
from locusframe.operators import text as TX  # noqa: E402
from locusframe.operators.reads import read_count_of  # noqa: E402
from locusframe.operators.scores import polygenic_score  # noqa: E402
from locusframe.operators.dedupe import dedupe_exclude_all, duplicate_ids, unique_in_order  # noqa: E402
from locusframe.operators.stats import (coverage_of_rows, cumulative_depths, depth_coverage, metric_histogram,  # noqa: E402
                                        position_density)

SQL_CARRIED = SQL_PCALL + ",\n" + """carried AS (
  SELECT c.vid, c.sid, a AS allele, s.ref, string_split(s.alt, ',')[a] AS alt, s.contig, s.pos
  FROM (SELECT vid, sid, unnest([a1, a2]) AS a FROM pcall) c JOIN fx_site s ON c.vid = s.vid
  WHERE a > 0)"""

SQL_CLASS = """CASE WHEN ref = '.' THEN 'nr' WHEN length(alt) < length(ref) THEN 'de' WHEN length(alt) > length(ref) THEN 'in'
       WHEN length(ref) > 1 THEN 'mp' WHEN upper(ref) || upper(alt) IN ('AG', 'GA', 'CT', 'TC') THEN 'ts'
       WHEN upper(ref) IN ('A','C','G','T') AND upper(alt) IN ('A','C','G','T') AND upper(ref) <> upper(alt) THEN 'tv' END"""

# A 25-contig header (autosomes, X, Y, M) used where a contig list is needed.
HEADER_CONTIGS = [f"chr{i}" for i in range(1, 23)] + ["chrX", "chrY", "chrM"]


@register("count_variants", "WITH " + SQL_CARRIED + " SELECT count(*) AS n_variants FROM carried")
def q_count_variants(spark, sf_dir):
    f = fx(spark, sf_dir)
    return C.carrier_rows(parsed_calls(f), f.fx_site).agg(F.count(F.lit(1)).alias("n_variants"))


@register("loci_per_contig", """
SELECT h.contig, coalesce(n, 0) AS n_loci
FROM (SELECT unnest(['chr' || x FOR x IN range(1, 23)] || ['chrX', 'chrY', 'chrM']) AS contig) h
LEFT JOIN (SELECT contig, count(*) AS n FROM fx_site GROUP BY contig) c ON h.contig = c.contig""")
def q_loci_per_contig(spark, sf_dir):
    f = fx(spark, sf_dir)
    header = spark.createDataFrame([(c,) for c in HEADER_CONTIGS], "contig string")
    counts = f.fx_site.groupBy("contig").agg(F.count(F.lit(1)).alias("n"))
    return (header.join(counts, "contig", "left")
            .select("contig", F.coalesce(F.col("n"), F.lit(0)).cast("long").alias("n_loci")))


@register("mean_af", "WITH " + SQL_VQC_FILLED + """
SELECT vid, allele, round(AC / (2.0 * n_called), 6) AS mean_af FROM vqcf""")
def q_mean_af(spark, sf_dir):
    f = fx(spark, sf_dir)
    d = C.decompose(parsed_calls(f), f.fx_site)
    return rounded(C.mean_af(d, n_samples(f), sites=f.fx_site))


@register("fill_tags", "WITH " + SQL_PCALL + ",\n" + SQL_SALT + """,
site AS (SELECT vid, CAST(sum((CASE WHEN a1 IS NULL THEN 0 ELSE 1 END) + (CASE WHEN a2 IS NULL THEN 0 ELSE 1 END)) AS BIGINT) AS AN,
                CAST(sum(CASE WHEN a1 IS NOT NULL OR a2 IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS NS
         FROM pcall GROUP BY vid),
per AS (
  SELECT c.vid, s.allele,
    CAST(sum((CASE WHEN a1 = allele THEN 1 ELSE 0 END) + (CASE WHEN a2 = allele THEN 1 ELSE 0 END)) AS BIGINT) AS AC,
    CAST(sum(CASE WHEN a1 IS NOT NULL AND a2 IS NOT NULL AND a1 = a2 THEN (CASE WHEN a1 = allele THEN 2 ELSE 0 END) ELSE 0 END) AS BIGINT) AS AC_Hom,
    CAST(sum(CASE WHEN a1 IS NOT NULL AND a2 IS NOT NULL AND a1 <> a2 THEN (CASE WHEN a1 = allele THEN 1 ELSE 0 END) + (CASE WHEN a2 = allele THEN 1 ELSE 0 END) ELSE 0 END) AS BIGINT) AS AC_Hemi0,
    CAST(sum(CASE WHEN ploidy = 1 THEN (CASE WHEN a1 = allele THEN 1 ELSE 0 END) ELSE 0 END) AS BIGINT) AS AC_Hemi,
    CAST(sum(CASE WHEN a1 = 0 AND a2 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS rr,
    CAST(sum(CASE WHEN (a1 = 0 AND a2 = allele) OR (a1 = allele AND a2 = 0) THEN 1 ELSE 0 END) AS BIGINT) AS ra,
    CAST(sum(CASE WHEN a1 = allele AND a2 = allele THEN 1 ELSE 0 END) AS BIGINT) AS aa
  FROM pcall c JOIN salt s ON c.vid = s.vid GROUP BY c.vid, s.allele),
p AS """ + hwe_sql("per", "vid, allele", "rr", "ra", "aa", "p_hwe") + """,
e AS (SELECT vid, allele, least(1.0, sum(CASE WHEN hh >= h0 THEN ph ELSE 0 END) / sum(ph)) AS exc
      FROM (SELECT *, exp(lp - max(lp) OVER (PARTITION BY vid, allele)) AS ph
            FROM (SELECT *, hh * ln(2) - lgamma((a - hh) / 2 + 1) - lgamma(hh + 1) - lgamma(n - (a + hh) / 2 + 1) AS lp
                  FROM (SELECT vid, allele, ra AS h0, rr + ra + aa AS n, least(2 * rr + ra, 2 * aa + ra) AS a,
                               unnest(range(least(2 * rr + ra, 2 * aa + ra) % 2, least(2 * rr + ra, 2 * aa + ra) + 1, 2)) AS hh
                        FROM per) x) y) z GROUP BY vid, allele)
SELECT per.vid, per.allele, AC, AC_Hom, AC_Hemi0 AS AC_Het, AC_Hemi, AN, NS,
       round(CASE WHEN AN > 0 THEN AC / CAST(AN AS DOUBLE) END, 6) AS AF,
       round(least(CASE WHEN AN > 0 THEN AC / CAST(AN AS DOUBLE) END, 1 - CASE WHEN AN > 0 THEN AC / CAST(AN AS DOUBLE) END), 6) AS MAF,
       round(p.p_hwe, 6) AS HWE, round(CASE WHEN rr + ra + aa = 0 THEN 1.0 ELSE e.exc END, 6) AS ExcHet
FROM per JOIN site ON per.vid = site.vid
JOIN p ON per.vid = p.vid AND per.allele = p.allele
JOIN e ON per.vid = e.vid AND per.allele = e.allele""")
def q_fill_tags(spark, sf_dir):
    f = fx(spark, sf_dir)
    return rounded(C.fill_tags(parsed_calls(f), f.fx_site).select(
        "vid", "allele", "AC", "AC_Hom", "AC_Het", "AC_Hemi", "AN", "NS", "AF", "MAF", "HWE", "ExcHet"))


@register("sample_qc", "WITH " + SQL_CARRIED + """,
cls AS (SELECT *, """ + SQL_CLASS + """ AS vclass, abs(length(alt) - length(ref)) AS ilen FROM carried),
pa AS (SELECT sid,
   CAST(sum(CASE WHEN vclass IN ('ts', 'tv') THEN 1 ELSE 0 END) AS BIGINT) AS n_snp,
   CAST(sum(CASE WHEN vclass = 'in' THEN 1 ELSE 0 END) AS BIGINT) AS n_insertion,
   CAST(sum(CASE WHEN vclass = 'de' THEN 1 ELSE 0 END) AS BIGINT) AS n_deletion,
   CAST(sum(CASE WHEN vclass = 'ts' THEN 1 ELSE 0 END) AS BIGINT) AS n_ti,
   CAST(sum(CASE WHEN vclass = 'tv' THEN 1 ELSE 0 END) AS BIGINT) AS n_tv,
   CAST(sum(CASE WHEN vclass IN ('in', 'de') AND ilen <= 2 THEN 1 ELSE 0 END) AS BIGINT) AS i12,
   CAST(sum(CASE WHEN vclass IN ('in', 'de') AND ilen = 3 THEN 1 ELSE 0 END) AS BIGINT) AS i3
  FROM cls GROUP BY sid),
sg AS (SELECT sid, count(*) AS n_singleton FROM (SELECT vid, allele, min(sid) AS sid FROM carried GROUP BY vid, allele HAVING count(*) = 1) t GROUP BY sid),
gc AS (SELECT sid,
   CAST(sum(CASE WHEN a1 IS NOT NULL AND a2 IS NOT NULL AND a1 <> a2 THEN 1 ELSE 0 END) AS BIGINT) AS n_het,
   CAST(sum(CASE WHEN a1 = 0 AND a2 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_hom_ref,
   CAST(sum(CASE WHEN a1 = a2 AND a1 > 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_hom_var
  FROM pcall GROUP BY sid)
SELECT m.sid, coalesce(n_het, 0) AS n_het, coalesce(n_hom_ref, 0) AS n_hom_ref, coalesce(n_hom_var, 0) AS n_hom_var, coalesce(n_snp, 0) AS n_snp, coalesce(n_insertion, 0) AS n_insertion,
       coalesce(n_deletion, 0) AS n_deletion, coalesce(n_ti, 0) AS n_ti, coalesce(n_tv, 0) AS n_tv,
       coalesce(n_singleton, 0) AS n_singleton,
       round(CASE WHEN n_tv > 0 THEN n_ti / CAST(n_tv AS DOUBLE) END, 6) AS ti_tv,
       round(CASE WHEN i3 > 0 THEN i12 / CAST(i3 AS DOUBLE) END, 6) AS indel_1_2_to_3
FROM fx_sample m LEFT JOIN gc ON m.sid = gc.sid LEFT JOIN pa ON m.sid = pa.sid LEFT JOIN sg ON m.sid = sg.sid""")
def q_sample_qc(spark, sf_dir):
    f = fx(spark, sf_dir)
    return rounded(C.sample_qc(parsed_calls(f), f.fx_site, samples=f.fx_sample))


@register("qc_roll_sum", "WITH " + SQL_CARRIED + """,
cls AS (SELECT *, """ + SQL_CLASS + """ AS vclass FROM carried),
per_contig AS (SELECT sid, contig,
   CAST(sum(CASE WHEN vclass = 'in' THEN 1 ELSE 0 END) AS BIGINT) AS n_insertion,
   CAST(sum(CASE WHEN vclass = 'de' THEN 1 ELSE 0 END) AS BIGINT) AS n_deletion,
   CAST(sum(CASE WHEN vclass = 'ts' THEN 1 ELSE 0 END) AS BIGINT) AS n_ti,
   CAST(sum(CASE WHEN vclass = 'tv' THEN 1 ELSE 0 END) AS BIGINT) AS n_tv
  FROM cls GROUP BY sid, contig)
SELECT sid, CAST(sum(n_insertion) AS BIGINT) AS n_insertion, CAST(sum(n_deletion) AS BIGINT) AS n_deletion,
       CAST(sum(n_insertion) + sum(n_deletion) AS BIGINT) AS n_indel,
       CAST(sum(n_ti) AS BIGINT) AS n_ti, CAST(sum(n_tv) AS BIGINT) AS n_tv,
       round(CASE WHEN sum(n_tv) > 0 THEN sum(n_ti) / CAST(sum(n_tv) AS DOUBLE) END, 6) AS ti_tv
FROM per_contig GROUP BY sid""")
def q_qc_roll_sum(spark, sf_dir):
    from locusframe.operators.stats import per_contig_sample_counts, roll_sum
    f = fx(spark, sf_dir)
    per = per_contig_sample_counts(C.carrier_rows(parsed_calls(f), f.fx_site.select("vid", "ref", "alt"))
                                   .join(f.fx_site.select("vid", "contig"), "vid"))
    return rounded(roll_sum(per, "sid"))


@register("site_allele_counts", "WITH " + SQL_CARRIED + """
SELECT s.vid, count(c.vid) FILTER (length(c.alt) = length(c.ref)) AS snp_copies,
       count(c.vid) FILTER (length(c.alt) <> length(c.ref)) AS indel_copies
FROM fx_site s LEFT JOIN carried c ON s.vid = c.vid GROUP BY s.vid""")
def q_site_allele_counts(spark, sf_dir):
    f = fx(spark, sf_dir)
    return C.site_allele_counts(parsed_calls(f), f.fx_site)


@register("position_density", "WITH " + SQL_CARRIED + """,
ext AS (SELECT contig, min(pos) AS mn, max(pos) AS mx FROM fx_site GROUP BY contig),
b AS (SELECT c.contig, CASE WHEN e.mx = e.mn THEN 0 ELSE least(CAST(floor((c.pos - e.mn) * 30 / CAST(e.mx - e.mn AS DOUBLE)) AS BIGINT), 29) END AS bin
      FROM carried c JOIN ext e ON c.contig = e.contig WHERE length(c.alt) = length(c.ref))
SELECT a.contig, a.bin, count(b.bin) AS snp_copies FROM (SELECT contig, unnest(range(0, 30)) AS bin FROM ext) a
LEFT JOIN b ON a.contig = b.contig AND a.bin = b.bin GROUP BY a.contig, a.bin""")
def q_position_density(spark, sf_dir):
    f = fx(spark, sf_dir)
    c = C.carrier_rows(parsed_calls(f), f.fx_site).join(f.fx_site.select("vid", "contig", "pos"), "vid")
    snps = c.where(F.length("alt") == F.length("ref"))
    return position_density(snps, f.fx_site, n_bins=30)


@register("metric_histogram", """
WITH ext AS (SELECT s.contig, min(c.dp) AS mn, max(c.dp) AS mx FROM fx_call c JOIN fx_site s ON c.vid = s.vid GROUP BY s.contig)
SELECT a.contig, a.bin, count(t.bin) AS n FROM (SELECT contig, unnest(range(0, 20)) AS bin FROM ext) a LEFT JOIN (
  SELECT s.contig, CASE WHEN e.mx = e.mn THEN 0 ELSE least(CAST(floor((c.dp - e.mn) * 20 / CAST(e.mx - e.mn AS DOUBLE)) AS BIGINT), 19) END AS bin
  FROM fx_call c JOIN fx_site s ON c.vid = s.vid JOIN ext e ON s.contig = e.contig) t ON a.contig = t.contig AND a.bin = t.bin
GROUP BY a.contig, a.bin""")
def q_metric_histogram(spark, sf_dir):
    f = fx(spark, sf_dir)
    v = f.fx_call.join(f.fx_site.select("vid", "contig"), "vid")
    return metric_histogram(v, "dp", n_bins=20, by=["contig"])


@register("interval_lengths", """
SELECT contig, CAST(sum(end_pos - start_pos) AS BIGINT) AS total_length FROM fx_interval GROUP BY contig""")
def q_interval_lengths(spark, sf_dir):
    return IV.interval_lengths(fx(spark, sf_dir).fx_interval, start="start_pos", end="end_pos")


@register("contig_extent", """
SELECT contig, min(start_pos) AS min_start, max(end_pos) AS max_end FROM fx_interval GROUP BY contig""")
def q_contig_extent(spark, sf_dir):
    return IV.contig_extent(fx(spark, sf_dir).fx_interval, start="start_pos", end="end_pos")


@register("basename_stats", """
SELECT basename, count(*) AS n, CAST(sum(size) AS BIGINT) AS total_size,
  CASE WHEN sum(size) = 0 THEN '0 b' ELSE printf('%.1f %sb', round(sum(size) / pow(1024.0, k), 1), ['', 'k', 'M', 'G', 'T'][k + 1]) END AS hsize
FROM (SELECT *, max(CASE WHEN s >= 1099511627776 THEN 4 WHEN s >= 1073741824 THEN 3 WHEN s >= 1048576 THEN 2 WHEN s >= 1024 THEN 1 ELSE 0 END) OVER (PARTITION BY basename) AS k
      FROM (SELECT *, sum(size) OVER (PARTITION BY basename) AS s FROM fx_blob) a) t
GROUP BY basename, k""")
def q_basename_stats(spark, sf_dir):
    return LS.basename_stats(fx(spark, sf_dir).fx_blob)


@register("folder_rollup", """
SELECT prefix, depth, CAST(sum(size) AS BIGINT) AS total_size, count(*) AS n_objects
FROM (SELECT size, d AS depth,
             CASE WHEN d = 0 THEN '' ELSE array_to_string(string_split(name, '/')[1:d], '/') || '/' END AS prefix
      FROM (SELECT name, size, unnest(range(0, len(string_split(name, '/')))) AS d FROM fx_blob) x) t
GROUP BY prefix, depth""")
def q_folder_rollup(spark, sf_dir):
    return LS.folder_rollup(fx(spark, sf_dir).fx_blob)


ANCESTRY_ORDER = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]


@register("ancestry_counts", """
WITH lab AS (SELECT s.sid, s.population AS ancestry, CASE WHEN p.s_acctbal < 0 THEN 'case' ELSE 'control' END AS cohort
             FROM fx_sample s JOIN supplier p ON s.sid = p.s_suppkey),
grid AS (SELECT cohort, unnest(['AFRICA', 'AMERICA', 'ASIA', 'EUROPE', 'MIDDLE EAST']) AS ancestry,
                unnest(range(1, 6)) AS ord FROM (SELECT DISTINCT cohort FROM lab) c)
SELECT g.cohort, g.ancestry, g.ord, count(l.sid) AS n
FROM grid g LEFT JOIN lab l ON g.cohort = l.cohort AND g.ancestry = l.ancestry
GROUP BY g.cohort, g.ancestry, g.ord""")
def q_ancestry_counts(spark, sf_dir):
    from locusframe.operators.cohort import ancestry_counts
    f = fx(spark, sf_dir)
    lab = (f.fx_sample.join(f.supplier.select(F.col("s_suppkey").alias("sid"), "s_acctbal"), "sid")
           .select("sid", F.col("population").alias("ancestry"),
                   F.when(F.col("s_acctbal") < 0, "case").otherwise("control").alias("cohort")))
    return ancestry_counts(lab, ANCESTRY_ORDER)


@register("duplicate_ids", "SELECT rsid, count(*) AS n FROM fx_site GROUP BY rsid HAVING count(*) > 1")
def q_duplicate_ids(spark, sf_dir):
    return duplicate_ids(fx(spark, sf_dir).fx_site, "rsid")


@register("dedupe_exclude_all", """
SELECT vid, rsid, contig || '_' || pos || '_' || ref || '_' || alt AS variant_id
FROM fx_site WHERE rsid IN (SELECT rsid FROM fx_site GROUP BY rsid HAVING count(*) = 1)""")
def q_dedupe_exclude_all(spark, sf_dir):
    from locusframe.functions.genotype import variant_id
    s = fx(spark, sf_dir).fx_site.withColumn("variant_id", variant_id("contig", "pos", "ref", "alt"))
    return dedupe_exclude_all(s, "rsid").select("vid", "rsid", "variant_id")


SQL_SCORE_BODY = """uniq AS (SELECT * FROM fx_site WHERE rsid IN (SELECT rsid FROM fx_site GROUP BY rsid HAVING count(*) = 1)),
m AS (SELECT w.pgs, w.rsid, w.allele, w.beta, u.vid,
             CASE WHEN w.allele = u.ref THEN 0 ELSE coalesce(list_position(string_split(u.alt, ','), w.allele), -1) END AS eff
      FROM fx_weight w LEFT JOIN uniq u ON w.rsid = u.rsid)"""
SQL_SCORE = SQL_PCALL + ",\n" + SQL_SCORE_BODY


@register("polygenic_score", "WITH " + SQL_SCORE + """
SELECT m.pgs, c.sid,
       CAST(sum((CASE WHEN c.a1 IS NULL THEN 0 ELSE 1 END) + (CASE WHEN c.a2 IS NULL THEN 0 ELSE 1 END)) AS BIGINT) AS n_alleles,
       floor(CAST(sum(CAST(m.beta AS DECIMAL(28,12)) * ((CASE WHEN c.a1 = m.eff THEN 1 ELSE 0 END) + (CASE WHEN c.a2 = m.eff THEN 1 ELSE 0 END)))
                  AS DOUBLE) * 1e6 + 0.5) / 1e6 AS score_sum,
       floor(CAST(sum(CAST(m.beta AS DECIMAL(28,12)) * ((CASE WHEN c.a1 = m.eff THEN 1 ELSE 0 END) + (CASE WHEN c.a2 = m.eff THEN 1 ELSE 0 END)))
                  AS DOUBLE) / sum((CASE WHEN c.a1 IS NULL THEN 0 ELSE 1 END) + (CASE WHEN c.a2 IS NULL THEN 0 ELSE 1 END)) * 1e6 + 0.5) / 1e6 AS score
FROM m JOIN pcall c ON m.vid = c.vid WHERE m.eff > 0 OR (m.eff = 0)
GROUP BY m.pgs, c.sid
HAVING sum((CASE WHEN c.a1 IS NULL THEN 0 ELSE 1 END) + (CASE WHEN c.a2 IS NULL THEN 0 ELSE 1 END)) > 0""")
def q_polygenic_score(spark, sf_dir):
    f = fx(spark, sf_dir)
    scores, _ = polygenic_score(parsed_calls(f), f.fx_site, f.fx_weight)
    # scores lie on halves of the last place: both sides round the same double half up
    half_up = {c: F.floor(F.col(c) * F.lit(1e6) + F.lit(0.5)) / F.lit(1e6) for c in ("score_sum", "score")}
    return scores.withColumns(half_up)


@register("transfer_status_counts", """
WITH r AS (SELECT split_part(b.name, '/', 1) AS tbl,
                  CASE WHEN s.size IS NULL THEN 'M' WHEN d.size = s.size THEN 'D' WHEN d.size IS NOT NULL THEN 'R' ELSE 'C' END AS status
           FROM fx_blob b LEFT JOIN fx_source s ON b.name = s.name LEFT JOIN fx_dest d ON b.name = d.name)
SELECT tbl, status, count(*) AS n FROM r GROUP BY tbl, status
UNION ALL SELECT tbl, 'T' AS status, count(*) AS n FROM r GROUP BY tbl""")
def q_transfer_status_counts(spark, sf_dir):
    f = fx(spark, sf_dir)
    plan = f.fx_blob.select(F.col("name").alias("src"), F.col("name").alias("dst"),
                            F.split("name", "/").getItem(0).alias("tbl"))
    rec = LS.transfer_reconcile(plan, f.fx_source, f.fx_dest)
    return LS.transfer_status_counts(rec, "tbl")


@register("word_count", """
SELECT word, count(*) AS n FROM (
  SELECT lower(trim(w, '.,();:')) AS word FROM (SELECT unnest(regexp_split_to_array(text, '[\\s-]')) AS w FROM documents) a) b
WHERE length(word) > 0 GROUP BY word""")
def q_word_count(spark, sf_dir):
    return TX.word_count(TX.words(fx(spark, sf_dir).documents))


SQL_WORDS_SING = """ws AS (SELECT CASE WHEN word IN ('biobanks', 'variants', 'drivers', 'associations', 'drivers', 'exomes', 'algorithms',
           'scripts', 'genotypes', 'gvcfs', 'practices', 'dimensions', 'points', 'costs', 'demographics')
      THEN substr(word, 1, length(word) - 1) ELSE word END AS word FROM (
  SELECT lower(trim(w, '.,();:')) AS word FROM (SELECT unnest(regexp_split_to_array(text, '[\\s-]')) AS w FROM documents) a) b
  WHERE length(word) > 0)"""


@register("singularize_count", "WITH " + SQL_WORDS_SING + " SELECT word, count(*) AS n FROM ws GROUP BY word")
def q_singularize_count(spark, sf_dir):
    return TX.word_count(TX.singularize(TX.words(fx(spark, sf_dir).documents)))


@register("length_median_mass", "WITH " + SQL_WORDS_SING + """,
m AS (SELECT median(length(word)) AS median_len FROM ws)
SELECT CAST(m.median_len AS DOUBLE) AS median_len,
       CAST(sum(CASE WHEN length(word) = m.median_len THEN length(word) ELSE 0 END) AS BIGINT) AS chars_equal,
       CAST(sum(CASE WHEN length(word) < m.median_len THEN length(word) ELSE 0 END) AS BIGINT) AS chars_under,
       CAST(sum(CASE WHEN length(word) > m.median_len THEN length(word) ELSE 0 END) AS BIGINT) AS chars_over
FROM ws, m GROUP BY m.median_len""")
def q_length_median_mass(spark, sf_dir):
    return TX.length_median_mass(TX.singularize(TX.words(fx(spark, sf_dir).documents)))


@register("mean_length_no_stop", "WITH " + SQL_WORDS_SING + """
SELECT count(*) AS n_words, round(avg(length(word)), 6) AS mean_len FROM ws
WHERE word NOT IN ('the', 'an', 'a', 'as', 'to', 'of', 'and', 'then', 'in', 'for', 'we', 'are')""")
def q_mean_length_no_stop(spark, sf_dir):
    wc = TX.word_count(TX.singularize(TX.words(fx(spark, sf_dir).documents)))
    return rounded(TX.mean_length_excluding(wc))


@register("depth_coverage", """
SELECT t AS threshold, round(sum(CASE WHEN depth >= t THEN 1 ELSE 0 END) / CAST(count(*) AS DOUBLE), 6) AS share
FROM fx_depth, (SELECT unnest([20, 50, 100, 150]) AS t) th GROUP BY t""")
def q_depth_coverage(spark, sf_dir):
    return rounded(depth_coverage(fx(spark, sf_dir).fx_depth, [20, 50, 100, 150]))


@register("depth_rows", """
WITH g AS (SELECT gene % 10 AS panel, depth FROM fx_depth)
SELECT panel, t AS threshold, round(count(*) FILTER (depth >= t) / CAST(count(*) AS DOUBLE), 6) AS share
FROM g, (SELECT unnest([0, 1, 20, 50, 100, 150, 199]) AS t) th GROUP BY panel, t""")
def q_depth_rows(spark, sf_dir):
    d = fx(spark, sf_dir).fx_depth.select((F.col("gene") % 10).alias("panel"), "depth")
    return rounded(coverage_of_rows(cumulative_depths(d, "panel"), "panel", [0, 1, 20, 50, 100, 150, 199]))


@register("words_by_count", """
WITH wc AS (SELECT word, count(*) AS n FROM (
  SELECT lower(trim(w, '.,();:')) AS word FROM (SELECT unnest(regexp_split_to_array(text, '[\\s-]')) AS w FROM documents) a) b
  WHERE length(word) > 0 GROUP BY word),
r AS (SELECT word, n, (row_number() OVER (PARTITION BY n ORDER BY encode(word)) - 1) // 500 AS chunk FROM wc)
SELECT n, chunk, count(*) AS n_words, string_agg(word, ' ' ORDER BY encode(word)) AS words FROM r GROUP BY n, chunk""")
def q_words_by_count(spark, sf_dir):
    w = TX.words_by_count(TX.word_count(TX.words(fx(spark, sf_dir).documents)), 500)
    return w.select("n", "chunk", F.size("words").cast("long").alias("n_words"), F.array_join("words", " ").alias("words"))


@register("unique_in_order", """
SELECT contig, min(vid) AS first_line, row_number() OVER (ORDER BY min(vid)) AS ord FROM fx_site GROUP BY contig""")
def q_unique_in_order(spark, sf_dir):
    return unique_in_order(fx(spark, sf_dir).fx_site, "contig", "vid")


@register("read_count", "SELECT count(*) AS n_reads FROM fx_read1")
def q_read_count(spark, sf_dir):
    from locusframe.sources.reads import fixture_fastq
    f = fx(spark, sf_dir)
    return read_count_of(spark, fixture_fastq(f))
