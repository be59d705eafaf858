"""Join queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from locusframe.catalog import register
from locusframe.catalog._common import SQL_NSAMP, SQL_PCALL, SQL_SALT, fx, n_samples, parsed_calls, rounded
from locusframe.operators import ancestry as AN
from locusframe.operators import calls as C
from locusframe.operators import intervals as IV
from locusframe.operators import levels as LV
from locusframe.operators import remap as RM
from locusframe.operators import listing as LS
from locusframe.operators import tables as TB
from locusframe.operators.reads import pair_reads
from locusframe.operators.scores import score_match

PCS = ["l1", "l2", "l3"]

SQL_AF = SQL_PCALL + ",\n" + SQL_NSAMP + """,
af AS (SELECT vid, sum(coalesce(CASE WHEN a1 IS NULL AND a2 IS NULL THEN NULL
                         ELSE (CASE WHEN a1 > 0 THEN 1 ELSE 0 END) + (CASE WHEN a2 > 0 THEN 1 ELSE 0 END) END, 0)) / (2.0 * max(n)) AS af
       FROM pcall, nsamp GROUP BY vid),
lw AS (SELECT l.*, af.af FROM fx_loading l LEFT JOIN af ON l.vid = af.vid),
proj AS (
  SELECT sid, sum(l1 * z) AS l1, sum(l2 * z) AS l2, sum(l3 * z) AS l3
  FROM (SELECT c.sid, lw.l1, lw.l2, lw.l3,
               ((CASE WHEN a1 > 0 THEN 1 ELSE 0 END) + (CASE WHEN a2 > 0 THEN 1 ELSE 0 END) - 2 * lw.af)
               / sqrt((SELECT count(*) FROM fx_loading) * 2 * lw.af * (1 - lw.af)) AS z
        FROM pcall c JOIN lw ON c.vid = lw.vid
        WHERE NOT (c.a1 IS NULL AND c.a2 IS NULL) AND lw.af > 0 AND lw.af < 1) t
  GROUP BY sid)"""


def _projection(spark, sf_dir):
    f = fx(spark, sf_dir)
    calls = parsed_calls(f)
    lw = AN.loadings_with_af(f.fx_loading, AN.site_af(calls, n_samples(f)))
    return f, AN.pc_project(calls, lw, PCS)


@register("pc_project", "WITH " + SQL_AF + """
SELECT sid, round(l1, 6) AS l1, round(l2, 6) AS l2, round(l3, 6) AS l3 FROM proj""")
def q_pc_project(spark, sf_dir):
    return rounded(_projection(spark, sf_dir)[1])


@register("loadings_with_af", "WITH " + SQL_AF + """
SELECT vid, l1, l2, l3, round(af, 6) AS af FROM lw""")
def q_loadings_with_af(spark, sf_dir):
    f = fx(spark, sf_dir)
    return rounded(AN.loadings_with_af(f.fx_loading, AN.site_af(parsed_calls(f), n_samples(f))))


SQL_CLIN = """clin AS (SELECT s.sid, s.population, CASE WHEN p.s_acctbal < 0 THEN 'case' WHEN p.s_acctbal > 9000 THEN 'control' END AS cohort
            FROM fx_sample s JOIN supplier p ON s.sid = p.s_suppkey)"""


def _clinical(f):
    return (f.fx_sample.join(f.supplier.select(F.col("s_suppkey").alias("sid"), "s_acctbal"), "sid")
            .select("sid", "population", F.when(F.col("s_acctbal") < 0, "case")
                    .when(F.col("s_acctbal") > 9000, "control").alias("cohort")))


@register("pcs_with_clinical", "WITH " + SQL_AF + ",\n" + SQL_CLIN + """
SELECT p.sid, round(p.l1, 6) AS l1, round(p.l2, 6) AS l2, c.population, coalesce(c.cohort, c.population) AS label
FROM proj p LEFT JOIN clin c ON p.sid = c.sid""")
def q_pcs_with_clinical(spark, sf_dir):
    f, p = _projection(spark, sf_dir)
    j = p.select("sid", "l1", "l2").join(_clinical(f), "sid", "left")
    return rounded(j.select("sid", "l1", "l2", "population",
                            F.coalesce(F.col("cohort"), F.col("population")).alias("label")))


@register("cohort_label", "WITH " + SQL_AF + """
SELECT p.sid, coalesce(c.cohort, 'control') AS cohort FROM proj p
LEFT JOIN (SELECT s_suppkey AS sid, 'case' AS cohort FROM supplier WHERE s_acctbal < 0) c ON p.sid = c.sid""")
def q_cohort_label(spark, sf_dir):
    f, p = _projection(spark, sf_dir)
    cases = f.supplier.where(F.col("s_acctbal") < 0).select(F.col("s_suppkey").alias("sid"), F.lit("case").alias("cohort"))
    return (TB.lookup_join(p.select("sid"), cases, "sid")
            .select("sid", F.coalesce(F.col("cohort"), F.lit("control")).alias("cohort")))


@register("population_lookup", "WITH " + SQL_AF + """
SELECT p.sid, s.population FROM proj p JOIN fx_sample s ON p.sid = s.sid""")
def q_population_lookup(spark, sf_dir):
    f, p = _projection(spark, sf_dir)
    return TB.strict_lookup(p.select("sid"), f.fx_sample.select("sid", "population"), "sid", "population")


@register("keep_variants", """
SELECT c.vid, c.sid, c.gt FROM fx_call c WHERE c.vid IN (SELECT vid FROM fx_site WHERE filter = 'PASS')""")
def q_keep_variants(spark, sf_dir):
    f = fx(spark, sf_dir)
    keep = f.fx_site.where(F.col("filter") == "PASS").select("vid")
    return f.fx_call.select("vid", "sid", "gt").join(keep, "vid", "left_semi")


@register("exclude_samples", """
SELECT c.vid, c.sid FROM fx_call c WHERE c.sid NOT IN (SELECT sid FROM fx_sample WHERE population = 'ASIA')""")
def q_exclude_samples(spark, sf_dir):
    f = fx(spark, sf_dir)
    ex = f.fx_sample.where(F.col("population") == "ASIA").select("sid")
    return f.fx_call.select("vid", "sid").join(ex, "sid", "left_anti")


@register("report_join", "WITH " + SQL_PCALL + """,
summ AS (SELECT CASE WHEN s.filter = 'PASS' THEN 'called' ELSE 'filtered' END AS filter_label, c.sid, count(*) AS n_sites
         FROM pcall c JOIN fx_site s ON c.vid = s.vid WHERE NOT (c.a1 IS NULL AND c.a2 IS NULL) GROUP BY 1, 2),
cls AS (SELECT c.sid, CAST(sum(CASE WHEN length(s.ref) = length(string_split(s.alt, ',')[1]) THEN 1 ELSE 0 END) AS BIGINT) AS n_snp,
               CAST(sum(CASE WHEN length(s.ref) <> length(string_split(s.alt, ',')[1]) THEN 1 ELSE 0 END) AS BIGINT) AS n_indel
        FROM pcall c JOIN fx_site s ON c.vid = s.vid WHERE c.a1 > 0 OR c.a2 > 0 GROUP BY c.sid),
titv AS (SELECT c.sid, CAST(sum(CASE WHEN upper(s.ref) || upper(string_split(s.alt, ',')[1]) IN ('AG','GA','CT','TC') THEN 1 ELSE 0 END) AS BIGINT) AS n_ti
         FROM pcall c JOIN fx_site s ON c.vid = s.vid WHERE c.a1 > 0 OR c.a2 > 0 GROUP BY c.sid)
SELECT s.sid, s.n_sites, cls.n_snp, cls.n_indel, titv.n_ti FROM summ s
LEFT JOIN cls ON s.sid = cls.sid LEFT JOIN titv ON s.sid = titv.sid WHERE s.filter_label = 'called'""")
def q_report_join(spark, sf_dir):
    from locusframe.operators.reports import report_join, sample_site_summary
    f = fx(spark, sf_dir)
    summ, cls, titv = sample_site_summary(parsed_calls(f), f.fx_site)
    return report_join(summ, cls, titv, "called")


@register("cohort_merge", """
WITH e AS (SELECT s.contig, s.pos, s.ref, s.alt, c.sid, c.gt, CASE WHEN p.s_acctbal < 0 THEN 'A' ELSE 'B' END AS cs
           FROM fx_call c JOIN fx_site s ON c.vid = s.vid JOIN supplier p ON c.sid = p.s_suppkey),
k AS (SELECT contig, pos, ref, alt, count(DISTINCT cs) AS n_sets FROM e GROUP BY ALL)
SELECT e.contig, e.pos, e.ref, e.alt, e.sid, e.gt, k.n_sets FROM e JOIN k USING (contig, pos, ref, alt)""")
def q_cohort_merge(spark, sf_dir):
    from locusframe.operators.reports import cohort_merge
    f = fx(spark, sf_dir)
    e = (f.fx_call.join(f.fx_site.select("vid", "contig", "pos", "ref", "alt"), "vid")
         .join(f.supplier.select(F.col("s_suppkey").alias("sid"), "s_acctbal"), "sid"))
    a = e.where(F.col("s_acctbal") < 0).select("contig", "pos", "ref", "alt", "sid", "gt")
    b = e.where(~(F.col("s_acctbal") < 0)).select("contig", "pos", "ref", "alt", "sid", "gt")
    return cohort_merge([a, b], ["contig", "pos", "ref", "alt"])


@register("annotate_exact", "WITH " + SQL_SALT + """,
ann AS (SELECT s.contig, s.pos, s.ref, string_split(s.alt, ',')[1] AS alt, p.p_name AS gene, p.p_type AS consequence
        FROM fx_site s JOIN part p ON s.vid = p.p_partkey)
SELECT salt.vid, salt.allele, ann.gene AS ann_gene, ann.consequence AS ann_consequence
FROM salt LEFT JOIN ann ON salt.contig = ann.contig AND salt.pos = ann.pos AND salt.ref = ann.ref AND salt.alt = ann.alt""")
def q_annotate_exact(spark, sf_dir):
    from locusframe.operators.reports import annotate_exact
    f = fx(spark, sf_dir)
    ann = (f.fx_site.join(f.part.select(F.col("p_partkey").alias("vid"), "p_name", "p_type"), "vid")
           .select("contig", "pos", "ref", F.split("alt", ",").getItem(0).alias("alt"),
                   F.col("p_name").alias("gene"), F.col("p_type").alias("consequence")))
    s = C.split_alleles(f.fx_site).select("vid", "allele", "contig", "pos", "ref", "alt")
    return annotate_exact(s, ann, ["contig", "pos", "ref", "alt"], ["gene", "consequence"], "ann_") \
        .select("vid", "allele", "ann_gene", "ann_consequence")


@register("nearest_feature", """
SELECT vid, feature, distance FROM (
  SELECT s.vid, i.name AS feature, greatest(i.start_pos - s.pos, s.pos - (i.end_pos - 1), 0) AS distance,
         row_number() OVER (PARTITION BY s.vid ORDER BY greatest(i.start_pos - s.pos, s.pos - (i.end_pos - 1), 0), i.name) AS rn
  FROM fx_site s JOIN fx_interval i ON s.contig = i.contig AND s.pos >= i.start_pos - 10000 AND s.pos < i.end_pos + 10000) t
WHERE rn = 1 AND distance <= 10000""")
def q_nearest_feature(spark, sf_dir):
    f = fx(spark, sf_dir)
    feats = f.fx_interval.select("contig", F.col("start_pos").alias("start"), F.col("end_pos").alias("end"), "name")
    return IV.nearest_feature(f.fx_site.select("vid", "contig", "pos"), feats, 10_000, width=50_000)


SQL_MERGED = """d AS (SELECT contig, start_pos, max(end_pos) AS end_pos FROM fx_interval GROUP BY contig, start_pos),
p AS (SELECT *, max(end_pos) OVER (PARTITION BY contig ORDER BY start_pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev FROM d),
g AS (SELECT *, sum(CASE WHEN prev IS NULL OR start_pos > prev THEN 1 ELSE 0 END) OVER (PARTITION BY contig ORDER BY start_pos ROWS UNBOUNDED PRECEDING) AS grp FROM p),
merged AS (SELECT contig, min(start_pos) AS start_pos, max(end_pos) AS end_pos FROM g GROUP BY contig, grp)"""


@register("region_assign", "WITH " + SQL_MERGED + """
SELECT s.vid, m.contig, m.start_pos, m.end_pos FROM fx_site s JOIN merged m
ON s.contig = m.contig AND m.start_pos <= s.pos AND s.pos < m.end_pos""")
def q_region_assign(spark, sf_dir):
    f = fx(spark, sf_dir)
    iv = f.fx_interval.select("contig", F.col("start_pos").alias("start"), F.col("end_pos").alias("end"))
    regions = IV.merge_intervals(iv)
    j = IV.points_in_intervals(f.fx_site.select("vid", "contig", "pos"), regions, width=10_000)
    return j.select("vid", "contig", F.col("start").alias("start_pos"), F.col("end").alias("end_pos"))


@register("overlap_join", """
SELECT a.contig, a.name AS name_a, a.start_pos AS start_a, a.end_pos AS end_a, b.name AS name_b, b.start_pos AS start_b, b.end_pos AS end_b
FROM fx_interval a JOIN fx_interval b ON a.contig = b.contig AND a.start_pos < b.end_pos AND b.start_pos < a.end_pos""")
def q_overlap_join(spark, sf_dir):
    f = fx(spark, sf_dir)
    iv = f.fx_interval.select("contig", F.col("start_pos").alias("start"), F.col("end_pos").alias("end"), "name")
    p = IV.overlap_pairs(iv, iv, width=10_000)
    return p.select(F.col("contig_a").alias("contig"), "name_a", "start_a", "end_a", "name_b", "start_b", "end_b")


@register("overlap_levels", """
SELECT a.contig, a.kind AS kind_a, a.start_pos AS start_a, a.end_pos AS end_a, b.kind AS kind_b, b.start_pos AS start_b, b.end_pos AS end_b
FROM fx_span a JOIN fx_span b ON a.contig = b.contig AND a.start_pos < b.end_pos AND b.start_pos < a.end_pos
WHERE a.kind <> 'short' AND b.kind <> 'long'""")
def q_overlap_levels(spark, sf_dir):
    s = fx(spark, sf_dir).fx_span.select("contig", F.col("start_pos").alias("start"), F.col("end_pos").alias("end"), "kind")
    p = LV.overlap_pairs_by_level(s.where("kind <> 'short'"), s.where("kind <> 'long'"))
    return p.select(F.col("contig_a").alias("contig"), "kind_a", "start_a", "end_a", "kind_b", "start_b", "end_b")


@register("points_levels", """
SELECT s.vid, count(p.contig) AS n, count(*) FILTER (p.kind = 'short') AS n_short, coalesce(max(p.end_pos - p.start_pos), 0) AS longest
FROM fx_site s LEFT JOIN fx_span p ON s.contig = p.contig AND p.start_pos <= s.pos AND s.pos < p.end_pos GROUP BY s.vid""")
def q_points_levels(spark, sf_dir):
    f = fx(spark, sf_dir)
    s = f.fx_span.select("contig", F.col("start_pos").alias("start"), F.col("end_pos").alias("end"), "kind")
    j = LV.points_by_level(f.fx_site.select("vid", "contig", "pos"), s, how="left")
    return j.groupBy("vid").agg(F.count("kind").alias("n"), F.count(F.when(F.col("kind") == "short", 1)).alias("n_short"),
                                F.coalesce(F.max(F.col("end") - F.col("start")), F.lit(0)).alias("longest"))


@register("remap_chains", """
WITH p AS (SELECT i.contig, i.start_pos, i.end_pos, c.chain, c.dst, c.strand, greatest(i.start_pos, c.block_start) AS lo, least(i.end_pos, c.block_end) AS hi,
             c.block_start, c.block_end, c.dst_start
           FROM (SELECT DISTINCT contig, start_pos, end_pos FROM fx_interval) i
           JOIN fx_chain c ON i.contig = c.src AND i.start_pos < c.block_end AND c.block_start < i.end_pos),
r AS (SELECT contig, start_pos, end_pos, chain, dst, strand, CAST(sum(hi - lo) AS BIGINT) AS bases,
        min(dst_start + CASE WHEN strand = '+' THEN lo - block_start ELSE block_end - hi END) AS s,
        max(dst_start + CASE WHEN strand = '+' THEN hi - block_start ELSE block_end - lo END) AS e
      FROM p GROUP BY contig, start_pos, end_pos, chain, dst, strand),
q AS (SELECT *, bases >= 0.7 * (end_pos - start_pos) AS ok FROM r),
g AS (SELECT contig, start_pos, end_pos, count(*) FILTER (ok) AS enough, least(sum(bases), end_pos - start_pos) AS together FROM q GROUP BY contig, start_pos, end_pos)
SELECT i.contig, i.start_pos, i.end_pos, q.dst AS new_contig, q.s AS new_start, q.e AS new_end, q.strand AS new_strand, q.chain,
  round(coalesce(q.bases, g.together, 0) / CAST(i.end_pos - i.start_pos AS DOUBLE), 6) AS share,
  CASE WHEN g.contig IS NULL THEN 'deleted' WHEN g.enough = 1 THEN NULL WHEN g.enough > 1 THEN 'duplicated'
       WHEN g.together >= 0.7 * (i.end_pos - i.start_pos) THEN 'split' ELSE 'partial' END AS reason
FROM fx_interval i LEFT JOIN g ON i.contig = g.contig AND i.start_pos = g.start_pos AND i.end_pos = g.end_pos
LEFT JOIN q ON g.enough = 1 AND q.ok AND i.contig = q.contig AND i.start_pos = q.start_pos AND i.end_pos = q.end_pos""")
def q_remap_chains(spark, sf_dir):
    f = fx(spark, sf_dir)
    iv = f.fx_interval.select("contig", "start_pos", "end_pos")
    return rounded(RM.remap_chains(iv, f.fx_chain, 0.7, start="start_pos", end="end_pos"))


@register("overlap_join_blocks", """
SELECT i.contig, i.name, i.start_pos AS start_a, i.end_pos AS end_a, b.block_start AS start_b, b.block_end AS end_b
FROM fx_interval i JOIN fx_block b ON i.contig = b.src AND i.start_pos < b.block_end AND b.block_start < i.end_pos""")
def q_overlap_join_blocks(spark, sf_dir):
    f = fx(spark, sf_dir)
    a = f.fx_interval.select("contig", F.col("start_pos").alias("start"), F.col("end_pos").alias("end"), "name")
    b = f.fx_block.select(F.col("src").alias("contig"), F.col("block_start").alias("start"), F.col("block_end").alias("end"))
    p = IV.overlap_pairs(a, b, width=10_000)
    return p.select(F.col("contig_a").alias("contig"), F.col("name_a").alias("name"), "start_a", "end_a", "start_b", "end_b")


@register("paste_columns", """
SELECT l.idx, l.vid, l.contig, r.rsid, r.ref FROM
 (SELECT row_number() OVER (ORDER BY vid) - 1 AS idx, vid, contig FROM fx_site) l JOIN
 (SELECT row_number() OVER (ORDER BY p_partkey) - 1 AS idx, CASE WHEN p_size = 50 THEN 'rs_dup' ELSE 'rs' || p_partkey END AS rsid, p_name AS ref FROM part) r
 ON l.idx = r.idx""")
def q_paste_columns(spark, sf_dir):
    f = fx(spark, sf_dir)
    left = f.fx_site.select("vid", "contig")
    right = f.part.select("p_partkey", F.when(F.col("p_size") == 50, "rs_dup")
                          .otherwise(F.concat(F.lit("rs"), F.col("p_partkey").cast("string"))).alias("rsid"),
                          F.col("p_name").alias("ref"))
    return TB.paste_columns(left, right, ["vid"], ["p_partkey"]).select("idx", "vid", "contig", "rsid", "ref")


@register("score_match", """
WITH uniq AS (SELECT * FROM fx_site WHERE rsid IN (SELECT rsid FROM fx_site GROUP BY rsid HAVING count(*) = 1))
SELECT w.pgs, w.rsid, w.allele,
  CASE WHEN u.vid IS NULL THEN 'no_id' WHEN w.allele = u.ref OR list_position(string_split(u.alt, ','), w.allele) > 0 THEN 'ok' ELSE 'no_allele' END AS reason
FROM fx_weight w LEFT JOIN uniq u ON w.rsid = u.rsid""")
def q_score_match(spark, sf_dir):
    f = fx(spark, sf_dir)
    return score_match(f.fx_weight, f.fx_site).select("pgs", "rsid", "allele", "reason")


@register("pair_reads", """
SELECT a.read_id, 'pair' AS kind FROM fx_read1 a JOIN fx_read2 b ON a.read_id = b.read_id
UNION ALL SELECT read_id, 'single1' FROM fx_read1 WHERE read_id NOT IN (SELECT read_id FROM fx_read2)
UNION ALL SELECT read_id, 'single2' FROM fx_read2 WHERE read_id NOT IN (SELECT read_id FROM fx_read1)""")
def q_pair_reads(spark, sf_dir):
    f = fx(spark, sf_dir)
    pairs, s1, s2 = pair_reads(f.fx_read1, f.fx_read2)
    return (pairs.select("read_id", F.lit("pair").alias("kind"))
            .unionByName(s1.select("read_id", F.lit("single1").alias("kind")))
            .unionByName(s2.select("read_id", F.lit("single2").alias("kind"))))


def _plan(f):
    return f.fx_blob.select(F.col("name").alias("src"), F.col("name").alias("dst"))


@register("transfer_reconcile", """
SELECT b.name AS src, CASE WHEN s.size IS NULL THEN 'M' WHEN d.size = s.size THEN 'D' WHEN d.size IS NOT NULL THEN 'R' ELSE 'C' END AS status
FROM fx_blob b LEFT JOIN fx_source s ON b.name = s.name LEFT JOIN fx_dest d ON b.name = d.name""")
def q_transfer_reconcile(spark, sf_dir):
    f = fx(spark, sf_dir)
    return LS.transfer_reconcile(_plan(f), f.fx_source, f.fx_dest).select("src", "status")


@register("cleanup_list", """
SELECT b.name AS src FROM fx_blob b JOIN fx_source s ON b.name = s.name JOIN fx_dest d ON b.name = d.name WHERE s.size = d.size""")
def q_cleanup_list(spark, sf_dir):
    f = fx(spark, sf_dir)
    return LS.cleanup_list(_plan(f), f.fx_source, f.fx_dest).select("src")


@register("key_lookup", """
WITH ws AS (SELECT DISTINCT source AS workspace, 'gs://fc-' || source AS bucket FROM documents)
SELECT b.name, ws.workspace, replace(ws.bucket, 'gs://', '') AS bucket_name, w2.workspace AS workspace_back
FROM fx_blob b JOIN ws ON split_part(b.name, '/', 1) = ws.workspace
JOIN ws w2 ON w2.bucket = 'gs://' || replace(ws.bucket, 'gs://', '')""")
def q_key_lookup(spark, sf_dir):
    f = fx(spark, sf_dir)
    ws = f.documents.select(F.col("source").alias("workspace")).distinct() \
        .withColumn("bucket", F.concat(F.lit("gs://fc-"), F.col("workspace")))
    b = f.fx_blob.select("name", F.split("name", "/").getItem(0).alias("workspace"))
    fwd = TB.lookup_join(b, ws, "workspace", how="inner") \
        .withColumn("bucket_name", F.regexp_replace("bucket", "^gs://", ""))
    back = ws.select(F.col("bucket").alias("_b"), F.col("workspace").alias("workspace_back"))
    j = fwd.withColumn("_b", F.concat(F.lit("gs://"), F.col("bucket_name")))
    return TB.lookup_join(j, back, "_b", how="inner").select("name", "workspace", "bucket_name", "workspace_back")


# Study -> capture kit (unknown studies map to null).
CAPTURE_KITS = {
    "AAPC": None,
    "Broad/Cornell": "SureSelectv4",
    "CMI": "Nextera Rapid Capture",
    "Nelson": "Nimblegen SeqCapv3",
    "NEPC": "SureSelectv4",
    "PROSNEOLCM": "SureSelectv4",
    "PCF_SU2C": "SureSelectv4",
    "TCGA": "SureSelectv4",
}
STUDY_ORDER = list(CAPTURE_KITS) + ["UNLISTED"]


@register("literal_map_lookup", """
WITH m AS (SELECT * FROM (VALUES ('AAPC', NULL), ('Broad/Cornell', 'SureSelectv4'), ('CMI', 'Nextera Rapid Capture'),
   ('Nelson', 'Nimblegen SeqCapv3'), ('NEPC', 'SureSelectv4'), ('PROSNEOLCM', 'SureSelectv4'), ('PCF_SU2C', 'SureSelectv4'),
   ('TCGA', 'SureSelectv4')) t(study, kit)),
d AS (SELECT doc_id, ['AAPC', 'Broad/Cornell', 'CMI', 'Nelson', 'NEPC', 'PROSNEOLCM', 'PCF_SU2C', 'TCGA', 'UNLISTED'][
        CAST(regexp_extract(source, '[0-9]+') AS INTEGER) % 9 + 1] AS study FROM documents)
SELECT d.doc_id, d.study, m.kit FROM d LEFT JOIN m ON d.study = m.study""")
def q_literal_map_lookup(spark, sf_dir):
    d = fx(spark, sf_dir).documents
    idx = F.regexp_extract("source", "[0-9]+", 0).cast("int") % len(STUDY_ORDER) + 1
    s = d.select("doc_id", F.element_at(F.array(*[F.lit(x) for x in STUDY_ORDER]), idx).alias("study"))
    return s.withColumn("kit", TB.literal_lookup("study", CAPTURE_KITS))


@register("interval_remap", """
SELECT i.contig AS src_contig, i.start_pos AS src_start, i.end_pos AS src_end, b.dst AS contig,
       i.start_pos + b.shift AS start_pos, i.end_pos + b.shift AS end_pos, 'mapped' AS status
FROM fx_interval i JOIN fx_block b ON i.contig = b.src AND b.block_start <= i.start_pos AND i.end_pos <= b.block_end
UNION ALL
SELECT i.contig, i.start_pos, i.end_pos, NULL, NULL, NULL, 'unmapped' FROM fx_interval i
WHERE NOT EXISTS (SELECT 1 FROM fx_block b WHERE i.contig = b.src AND b.block_start <= i.start_pos AND i.end_pos <= b.block_end)""")
def q_interval_remap(spark, sf_dir):
    f = fx(spark, sf_dir)
    iv = f.fx_interval.select("contig", F.col("start_pos").alias("start"), F.col("end_pos").alias("end"))
    mapped, unmapped = IV.interval_remap(iv, f.fx_block)
    m = mapped.select("src_contig", "src_start", "src_end", "contig", F.col("start").alias("start_pos"),
                      F.col("end").alias("end_pos"), F.lit("mapped").alias("status"))
    u = unmapped.select(F.col("contig").alias("src_contig"), F.col("start").alias("src_start"),
                        F.col("end").alias("src_end"), F.lit(None).cast("string").alias("contig"),
                        F.lit(None).cast("long").alias("start_pos"), F.lit(None).cast("long").alias("end_pos"),
                        F.lit("unmapped").alias("status"))
    return m.unionByName(u)
