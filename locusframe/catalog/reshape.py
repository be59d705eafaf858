"""Array / map / JSON / reshaping queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from locusframe.catalog import register
from locusframe.catalog._common import SQL_DCALL, fx, parsed_calls, rounded
from locusframe.catalog.aggregates import SQL_CARRIED, SQL_CLASS
from locusframe.functions import udtf as UD
from locusframe.operators import calls as C
from locusframe.operators import entities as EN
from locusframe.operators import fields as FL
from locusframe.operators import jsonops as JS
from locusframe.operators import leftalign as LA
from locusframe.operators import reshape as RS
from locusframe.operators.filters import pc_box_bounds
from locusframe.session import cut_lineage, scratch_path


@register("decompose", "WITH " + SQL_DCALL + " SELECT vid, allele, sid, alt, r1, r2 FROM dcall")
def q_decompose(spark, sf_dir):
    f = fx(spark, sf_dir)
    return C.decompose(parsed_calls(f), f.fx_site).select("vid", "allele", "sid", "alt", "r1", "r2")


@register("decompose_udtf", "WITH " + SQL_DCALL + " SELECT vid, sid, ref, allele, alt, r1, r2 FROM dcall")
def q_decompose_udtf(spark, sf_dir):
    f = fx(spark, sf_dir)
    UD.register(spark)
    return spark.sql("""SELECT vid, sid, ref, CAST(allele AS BIGINT) AS allele, alt, r1, r2 FROM decompose(TABLE(
                          SELECT c.vid, c.sid, c.a1, c.a2, s.ref, s.alt FROM {calls} c JOIN {sites} s ON c.vid = s.vid))""",
                     calls=parsed_calls(f), sites=f.fx_site)


@register("normalize_trim", """
WITH salt AS (SELECT vid, pos - 1 AS pos, 'T' || ref || 'G' AS ref, 'T' || string_split(alt, ',')[i] || 'G' AS alt, i AS allele
              FROM (SELECT *, unnest(range(1, len(string_split(alt, ',')) + 1)) AS i FROM fx_site) x),
s1 AS (SELECT *, CASE WHEN least(length(ref), length(alt)) - 1 >= 1 THEN
         len(list_filter(range(1, least(length(ref), length(alt))), lambda k: right(ref, k) = right(alt, k))) ELSE 0 END AS s FROM salt),
s2 AS (SELECT vid, allele, pos, left(ref, length(ref) - s) AS r1, left(alt, length(alt) - s) AS a1 FROM s1),
s3 AS (SELECT *, CASE WHEN least(length(r1), length(a1)) - 1 >= 1 THEN
         len(list_filter(range(1, least(length(r1), length(a1))), lambda k: left(r1, k) = left(a1, k))) ELSE 0 END AS p FROM s2)
SELECT vid, allele, pos + p AS pos, substr(r1, p + 1) AS ref, substr(a1, p + 1) AS alt FROM s3""")
def q_normalize_trim(spark, sf_dir):
    s = C.split_alleles(fx(spark, sf_dir).fx_site)
    padded = s.select("vid", "allele", (F.col("pos") - 1).alias("pos"),
                      F.concat(F.lit("T"), "ref", F.lit("G")).alias("ref"),
                      F.concat(F.lit("T"), "alt", F.lit("G")).alias("alt"))
    return RS.normalize_trim(padded)


@register("left_align", """
WITH seqs AS (SELECT contig, string_agg(seq, '' ORDER BY vid) AS seq FROM fx_refpiece GROUP BY contig),
ev AS (SELECT v.*, s.seq, length(ref) > length(alt) AS del, CASE WHEN length(ref) > length(alt) THEN substr(ref, 2)
         WHEN length(alt) > length(ref) THEN substr(alt, 2) END AS d
       FROM fx_indel v JOIN seqs s ON v.contig = s.contig),
k AS (SELECT *, coalesce(list_position(list_transform(range(0, pos - 1),
        lambda j: substr(seq, pos - j, 1) <> substr(d, length(d) - CAST(j % length(d) AS BIGINT), 1)), true) - 1, pos - 1) AS k FROM ev WHERE d IS NOT NULL),
m AS (SELECT *, CAST(k % length(d) AS BIGINT) AS turn, substr(seq, pos - k, 1) AS base FROM k),
e AS (SELECT *, base || right(d, turn) || left(d, length(d) - turn) AS event FROM m)
SELECT vid, contig, pos - k AS pos, CASE WHEN del THEN event ELSE base END AS ref, CASE WHEN del THEN base ELSE event END AS alt FROM e
UNION ALL SELECT vid, contig, pos, ref, alt FROM ev WHERE d IS NULL""")
def q_left_align(spark, sf_dir):
    f = fx(spark, sf_dir)
    windows = cut_lineage(LA.reference_windows(f.fx_refpiece.select("contig", "start", "seq"), width=256, halo=64))
    return LA.left_align(f.fx_indel, windows, width=256, halo=64).select("vid", "contig", "pos", "ref", "alt")


# Header lines of the fields in fx_typed and fx_info.
FIELD_HEADER = [
    '##INFO=<ID=AC,Number=A,Type=Integer,Description="x">', '##INFO=<ID=AF,Number=A,Type=Float,Description="x">',
    '##INFO=<ID=DB,Number=0,Type=Flag,Description="x">', '##INFO=<ID=NS,Number=1,Type=Integer,Description="x">',
    '##FORMAT=<ID=AD,Number=R,Type=Integer,Description="x">', '##FORMAT=<ID=DP,Number=1,Type=Integer,Description="x">',
    '##FORMAT=<ID=PL,Number=G,Type=Integer,Description="x">', '##FORMAT=<ID=VAF,Number=A,Type=Float,Description="x">']

SQL_TYPED = """t0 AS (SELECT vid, sid, ref, alt, gt, string_split(entry, ':') AS e, string_split(alt, ',') AS alts FROM fx_typed),
typed AS (SELECT vid, sid, ref, alt, gt, alts, CASE WHEN e[2] <> '.' THEN string_split(e[2], ',') END AS ad, CAST(e[3] AS INTEGER) AS dp,
  CASE WHEN e[4] <> '.' THEN string_split(e[4], ',') END AS pl, string_split(e[5], ',') AS vaf FROM t0)"""


def _fields(spark, kind):
    lines = spark.createDataFrame([(x,) for x in FIELD_HEADER], "value string")
    return [x for x in FL.header_fields(lines) if x.kind == kind]


def _split_entries(spark, sf_dir):
    fields = _fields(spark, "FORMAT")
    return FL.split_fields(FL.with_format(fx(spark, sf_dir).fx_typed, fields).drop("entry", "format"), fields), fields


@register("format_fields", "WITH " + SQL_TYPED + """
SELECT vid, sid, allele, alts[allele] AS alt, dp, CAST(ad[1] AS INTEGER) AS ad_ref, CAST(ad[allele + 1] AS INTEGER) AS ad_alt,
  CAST(pl[1] AS INTEGER) AS pl_hom_ref, CAST(pl[1 + allele * (allele + 1) // 2] AS INTEGER) AS pl_het,
  CAST(pl[1 + allele * (allele + 1) // 2 + allele] AS INTEGER) AS pl_hom_alt, CAST(vaf[allele] AS DOUBLE) AS vaf
FROM (SELECT *, unnest(range(1, len(alts) + 1)) AS allele FROM typed) x""")
def q_format_fields(spark, sf_dir):
    d, _ = _split_entries(spark, sf_dir)
    return d.select("vid", "sid", F.col("allele").cast("long").alias("allele"), "alt", F.col("DP").alias("dp"),
                    F.get("AD", F.lit(0)).alias("ad_ref"), F.get("AD", F.lit(1)).alias("ad_alt"), F.get("PL", F.lit(0)).alias("pl_hom_ref"),
                    F.get("PL", F.lit(1)).alias("pl_het"), F.get("PL", F.lit(2)).alias("pl_hom_alt"), F.col("VAF").alias("vaf"))


@register("info_fields", """
WITH s AS (SELECT vid, alt, info, string_split(alt, ',') AS alts, string_split(regexp_extract(info, 'AC=([^;]*)', 1), ',') AS ac,
  string_split(regexp_extract(info, 'AF=([^;]*)', 1), ',') AS af FROM fx_info)
SELECT vid, allele, alts[allele] AS alt, TRY_CAST(ac[allele] AS INTEGER) AS ac, TRY_CAST(af[allele] AS DOUBLE) AS af,
  CAST(regexp_extract(info, 'NS=([0-9]+)', 1) AS INTEGER) AS ns, info LIKE 'DB;%' AS db
FROM (SELECT *, unnest(range(1, len(alts) + 1)) AS allele FROM s) x""")
def q_info_fields(spark, sf_dir):
    fields = _fields(spark, "INFO")
    d = FL.split_fields(FL.with_info(fx(spark, sf_dir).fx_info, fields), fields)
    return d.select("vid", F.col("allele").cast("long").alias("allele"), "alt", F.col("AC").alias("ac"), F.col("AF").alias("af"),
                    F.col("NS").alias("ns"), F.col("DB").alias("db"))


@register("fields_rejoined", "WITH " + SQL_TYPED + """
SELECT vid, sid, alt, dp, array_to_string(ad, ',') AS ad, array_to_string(list_transform(vaf, lambda x: CAST(round(CAST(x AS DOUBLE) * 100) AS BIGINT)), ',') AS vaf_pct,
  CASE WHEN len(alts) = 2 AND pl IS NOT NULL THEN pl[1] || ',' || pl[2] || ',' || pl[3] || ',' || pl[4] || ',.,' || pl[6]
       ELSE array_to_string(pl, ',') END AS pl
FROM typed""")
def q_fields_rejoined(spark, sf_dir):
    d, fields = _split_entries(spark, sf_dir)
    j = FL.join_fields(d, ["vid", "sid"], fields)
    pct = F.transform("VAF", lambda x: F.round(x * 100).cast("long").cast("string"))
    return j.select("vid", "sid", "alt", F.col("DP").alias("dp"), F.array_join("AD", ",").alias("ad"), F.array_join(pct, ",").alias("vaf_pct"),
                    F.array_join("PL", ",", ".").alias("pl"))


@register("carrier_rows", "WITH " + SQL_CARRIED.replace(
    "unnest([a1, a2]) AS a FROM pcall", "unnest([a1, a2]) AS a, unnest([1, 2]) AS copy FROM pcall").replace(
    "SELECT c.vid, c.sid, a AS allele", "SELECT c.vid, c.sid, c.copy, a AS allele") + """,
cls AS (SELECT *, """ + SQL_CLASS + """ AS vclass FROM carried)
SELECT vid, sid, copy, allele, ref, alt, vclass FROM cls""")
def q_carrier_rows(spark, sf_dir):
    f = fx(spark, sf_dir)
    return C.carrier_rows(parsed_calls(f), f.fx_site)


def _nested_json_path(f):
    if "nested_json" not in f.extra:
        e = f.events
        doc = F.to_json(F.struct(F.col("event_id").alias("id"),
                                 F.struct(F.col("user_id").alias("id"), F.col("event_type").alias("kind")).alias("user"),
                                 F.when(F.col("event_type") == "error",
                                        F.struct(F.col("value").alias("value"), F.col("props").alias("raw"))).alias("meta")))
        path = scratch_path(f.spark, "nested-json")
        e.select(doc.alias("value")).write.mode("overwrite").text(path)
        f.extra["nested_json"] = path
    return f.extra["nested_json"]


@register("flatten_nested", """
SELECT event_id AS id, CASE WHEN event_type = 'error' THEN props END AS "meta.raw",
       CASE WHEN event_type = 'error' THEN value END AS "meta.value", user_id AS "user.id", event_type AS "user.kind"
FROM events""")
def q_flatten_nested(spark, sf_dir):
    f = fx(spark, sf_dir)
    nested = spark.read.json(_nested_json_path(f))
    return EN.flatten_nested(nested)


def _attr_json(f):
    e = f.fx_entity
    files = F.struct(F.lit("AttributeValue").alias("itemsType"), F.array("cram", "ref_file").alias("items"))
    ref = F.struct(F.lit("sample").alias("entityType"), F.concat(F.lit("s"), F.col("entity").cast("string")).alias("entityName"))
    refs = F.struct(F.lit("EntityReference").alias("itemsType"),
                    F.array(ref, F.struct(F.lit("sample").alias("entityType"), F.col("note").alias("entityName"))).alias("items"))
    extra = F.struct(F.col("note").alias("k"), F.lit(1).alias("v"))
    attrs = F.to_json(F.struct(F.col("cram"), files.alias("files"), ref.alias("subject"), refs.alias("peers"), extra.alias("extra")))
    return e.select("entity", attrs.alias("attributes"))


@register("typed_attributes", """
SELECT entity, 'cram' AS attr, 'scalar' AS kind, cram AS value FROM fx_entity
UNION ALL SELECT entity, 'files', 'list', cram || ',' || ref_file FROM fx_entity
UNION ALL SELECT entity, 'subject', 'reference', 's' || entity FROM fx_entity
UNION ALL SELECT entity, 'peers', 'reference_list', 's' || entity || ',' || note FROM fx_entity
UNION ALL SELECT entity, 'extra', 'json', '{"k":"' || note || '","v":1}' FROM fx_entity""")
def q_typed_attributes(spark, sf_dir):
    return JS.typed_attributes(_attr_json(fx(spark, sf_dir)), "entity", "attributes")


@register("keys_by_type", """
SELECT 'cram' AS key, 'string' AS jtype, count(*) AS n_rows FROM fx_entity
UNION ALL SELECT 'files', 'object', count(*) FROM fx_entity
UNION ALL SELECT 'subject', 'object', count(*) FROM fx_entity
UNION ALL SELECT 'peers', 'object', count(*) FROM fx_entity
UNION ALL SELECT 'extra', 'object', count(*) FROM fx_entity""")
def q_keys_by_type(spark, sf_dir):
    return JS.keys_by_type(_attr_json(fx(spark, sf_dir)), "attributes")


SQL_CELLS = """cells AS (
  SELECT 'sample' AS tbl, entity, 'cram' AS col, cram AS val FROM fx_entity
  UNION ALL SELECT 'sample', entity, 'ref_file', ref_file FROM fx_entity
  UNION ALL SELECT 'sample', entity, 'note', note FROM fx_entity)"""


@register("cells_unpivot", "WITH " + SQL_CELLS + " SELECT tbl, entity, col, val FROM cells")
def q_cells_unpivot(spark, sf_dir):
    e = fx(spark, sf_dir).fx_entity.withColumn("tbl", F.lit("sample"))
    return EN.cells_unpivot(e, "tbl", "entity", ["cram", "ref_file", "note"])


SQL_LIST_CELLS = """lc AS (
  SELECT 'sample' AS tbl, entity, 'files' AS col, [cram, ref_file] AS vals FROM fx_entity
  UNION ALL SELECT 'sample', entity, 'cram', [cram] FROM fx_entity),
el AS (SELECT tbl, entity, col, len(vals) > 1 AS is_list, i - 1 AS i, vals[i] AS val
       FROM (SELECT *, unnest(range(1, len(vals) + 1)) AS i FROM lc) x),
mv AS (SELECT *, concat_ws('/', 'gs://archive', tbl, CAST(entity AS VARCHAR), col, CASE WHEN is_list THEN CAST(i AS VARCHAR) END,
                           regexp_extract(val, '[^/]*$')) AS dest FROM el WHERE starts_with(val, 'gs://work/')),
fm AS (SELECT val, dest FROM (SELECT val, dest, row_number() OVER (PARTITION BY val ORDER BY tbl, entity, col, i) AS rn FROM mv) t WHERE rn = 1),
rw AS (SELECT el.tbl, el.entity, el.col, el.i, coalesce(fm.dest, el.val) AS v, fm.dest IS NOT NULL AS changed
       FROM el LEFT JOIN fm ON el.val = fm.val)"""


@register("path_rewrite", "WITH " + SQL_LIST_CELLS + """
SELECT tbl, entity, col, string_agg(v, ';' ORDER BY i) AS new_vals FROM rw GROUP BY tbl, entity, col HAVING bool_or(changed)""")
def q_path_rewrite(spark, sf_dir):
    e = fx(spark, sf_dir).fx_entity
    lc = (e.select(F.lit("sample").alias("tbl"), "entity", F.lit("files").alias("col"), F.array("cram", "ref_file").alias("vals"))
          .unionByName(e.select(F.lit("sample").alias("tbl"), "entity", F.lit("cram").alias("col"), F.array("cram").alias("vals"))))
    r = EN.path_rewrite(lc, "gs://work/", "gs://archive")
    return r.select("tbl", "entity", "col", F.array_join("new_vals", ";").alias("new_vals"))


@register("json_path_rewrite", """
SELECT entity, replace('{"cram":"' || cram || '","files":{"itemsType":"AttributeValue","items":["' || cram || '","' || ref_file
  || '"]},"subject":{"entityType":"sample","entityName":"s' || entity || '"},"peers":{"itemsType":"EntityReference","items":[{"entityType":"sample","entityName":"s'
  || entity || '"},{"entityType":"sample","entityName":"' || note || '"}]},"extra":{"k":"' || note || '","v":1}}', '"gs://work/', '"gs://archive/work/') AS rewritten
FROM fx_entity""")
def q_json_path_rewrite(spark, sf_dir):
    a = _attr_json(fx(spark, sf_dir))
    return JS.json_path_rewrite(a, "attributes", "gs://work/", "gs://archive/work/").select("entity", "rewritten")


@register("update_plan", "WITH " + SQL_LIST_CELLS + """
SELECT entity, count(*) AS n_updates, string_agg(col, ',' ORDER BY col) AS cols FROM (
  SELECT tbl, entity, col FROM rw GROUP BY tbl, entity, col HAVING bool_or(changed)) t GROUP BY tbl, entity""")
def q_update_plan(spark, sf_dir):
    e = fx(spark, sf_dir).fx_entity
    lc = (e.select(F.lit("sample").alias("tbl"), "entity", F.lit("files").alias("col"), F.array("cram", "ref_file").alias("vals"))
          .unionByName(e.select(F.lit("sample").alias("tbl"), "entity", F.lit("cram").alias("col"), F.array("cram").alias("vals"))))
    changes = EN.path_rewrite(lc, "gs://work/", "gs://archive").withColumn("new_val", F.array_join("new_vals", ";"))
    plan = EN.update_plan(changes)
    return plan.select("entity", F.size("updates").cast("long").alias("n_updates"),
                       F.array_join(F.array_sort(F.map_keys("updates")), ",").alias("cols"))


@register("pc_columns", """
SELECT vec_id, """ + ", ".join(f"round(CAST(embedding[{i}] AS DOUBLE), 6) AS PC{i}" for i in range(1, 11)) + " FROM embeddings")
def q_pc_columns(spark, sf_dir):
    from locusframe.operators.forest import pc_columns
    e = fx(spark, sf_dir).embeddings
    return rounded(pc_columns(e.select("vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("scores")),
                              "scores", 10).drop("scores"))


@register("shard_transpose", """
SELECT i - 1 AS shard, sample, sample || '.region' || (i - 1) || '.g.vcf.gz' AS file
FROM (SELECT sample, unnest(range(1, 6)) AS i FROM fx_sample) t""")
def q_shard_transpose(spark, sf_dir):
    s = fx(spark, sf_dir).fx_sample
    files = F.transform(F.sequence(F.lit(0), F.lit(4)),
                        lambda i: F.concat(F.col("sample"), F.lit(".region"), i.cast("string"), F.lit(".g.vcf.gz")))
    return RS.shard_transpose(s.select("sample", files.alias("files")), "sample", "files") \
        .select(F.col("shard").cast("long").alias("shard"), "sample", "file")


@register("shard_lists", """
SELECT i - 1 AS shard, array_to_string(list(sample || '.region' || (i - 1) || '.g.vcf.gz' ORDER BY sample), ' ') AS files
FROM (SELECT sample, unnest(range(1, 6)) AS i FROM fx_sample) t GROUP BY i""")
def q_shard_lists(spark, sf_dir):
    cells = q_shard_transpose(spark, sf_dir)
    return RS.shard_lists(cells, row="sample").select("shard", F.array_join("files", " ").alias("files"))


# The labels of the embeddings and the contigs of the fixture sites.
LABELS = [str(i) for i in range(10)]
AUTOSOMES = [f"chr{i}" for i in range(1, 23)]


@register("bounds_table", """
WITH pcs AS (SELECT label, CAST(embedding[1] AS DOUBLE) AS pc1, CAST(embedding[2] AS DOUBLE) AS pc2 FROM embeddings),
b AS (SELECT label, avg(pc1) - 2 * stddev_samp(pc1) AS pc1_min, avg(pc1) + 2 * stddev_samp(pc1) AS pc1_max,
             avg(pc2) - 2 * stddev_samp(pc2) AS pc2_min, avg(pc2) + 2 * stddev_samp(pc2) AS pc2_max FROM pcs GROUP BY label),
l AS (UNPIVOT b ON pc1_min, pc1_max, pc2_min, pc2_max INTO NAME stat VALUE value)
SELECT stat, """ + ", ".join(f"""max(CASE WHEN label = {x} THEN round(value, 6) END) AS "{x}" """ for x in LABELS) + "FROM l GROUP BY stat")
def q_bounds_table(spark, sf_dir):
    e = fx(spark, sf_dir).embeddings
    pcs = e.select("label", F.element_at("embedding", 1).cast("double").alias("pc1"),
                   F.element_at("embedding", 2).cast("double").alias("pc2"))
    b = rounded(pc_box_bounds(pcs, "label", 2.0))
    return RS.bounds_table(b, "label", ["pc1_min", "pc1_max", "pc2_min", "pc2_max"], LABELS)


@register("contig_unstack", "WITH " + SQL_CARRIED + """
SELECT sid, """ + ", ".join(f"max(CASE WHEN contig = '{x}' THEN n END) AS {x}" for x in AUTOSOMES) + """
FROM (SELECT sid, contig, count(*) AS n FROM carried GROUP BY sid, contig) p GROUP BY sid""")
def q_contig_unstack(spark, sf_dir):
    f = fx(spark, sf_dir)
    c = C.carrier_rows(parsed_calls(f), f.fx_site.select("vid", "ref", "alt")).join(f.fx_site.select("vid", "contig"), "vid")
    per = c.groupBy("sid", "contig").agg(F.count(F.lit(1)).alias("n"))
    return RS.pivot_wide(per, ["sid"], "contig", "n", AUTOSOMES)


@register("explode_list", """
SELECT entity, item, CASE WHEN contains(item, '/shared/') THEN 'shared' ELSE 'own' END AS kind
FROM (SELECT entity, unnest([cram, ref_file]) AS item FROM fx_entity) t""")
def q_explode_list(spark, sf_dir):
    e = fx(spark, sf_dir).fx_entity
    x = RS.explode_list(e, ["entity"], F.array("cram", "ref_file"))
    return x.withColumn("kind", F.when(F.col("item").contains("/shared/"), "shared").otherwise("own"))
