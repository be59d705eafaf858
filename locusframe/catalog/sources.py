"""Source and sink queries.

Each query writes files derived by Spark from the fixture tables into the
shared scratch folder (``spark.checkpoint.dir``) and reads them back with the
library's readers, so the work grows with the tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from locusframe.catalog import register
from locusframe.catalog._common import fx
from locusframe.catalog.aggregates import HEADER_CONTIGS
from locusframe.functions import genotype as G
from locusframe.functions.coords import region_format
from locusframe.operators import intervals as IV
from locusframe.operators import listing as LS
from locusframe.operators.scan import row_index
from locusframe.session import scratch_path
from locusframe.sources import blockvcf as BV
from locusframe.sources import tables as ST
from locusframe.sources import vcf as V
from locusframe.sources.checkpoint import checkpoint_stage
from locusframe.sources.listing import blob_listing

# hg38 autosome lengths.
HG38_LENGTHS = {
    "chr1": 248956422, "chr2": 242193529, "chr3": 198295559, "chr4": 190214555, "chr5": 181538259,
    "chr6": 170805979, "chr7": 159345973, "chr8": 145138636, "chr9": 138394717, "chr10": 133797422,
    "chr11": 135086622, "chr12": 133275309, "chr13": 114364328, "chr14": 107043718, "chr15": 101991189,
    "chr16": 90338345, "chr17": 83257441, "chr18": 80373285, "chr19": 58617616, "chr20": 64444167,
    "chr21": 46709983, "chr22": 50818468,
}
MISSING_ENTRY = "./.:.:."
META = ['##FORMAT=<ID=GT,Number=1,Type=String,Description="Genotype">',
        '##FORMAT=<ID=DP,Number=1,Type=Integer,Description="Read depth">',
        '##FORMAT=<ID=GQ,Number=1,Type=Integer,Description="Genotype quality">']
N_HEADER = 1 + len(META) + len(HEADER_CONTIGS) + 1
SHARD_RECORDS = 100


PART_BYTES = 32 << 20  # of record text a task makes
MAX_PARTS = 4096


def _fixture_records(f):
    """Sparse records of the fixture cohort, what makes their lines, and the
    number of tasks that fits the lines."""
    sites = f.fx_site.select("vid", "contig", "pos", F.col("rsid").alias("id"), "ref", "alt",
                             F.col("qual").cast("string").alias("qual"), "filter",
                             F.concat(F.lit("VID="), F.col("vid").cast("string")).alias("info"),
                             F.lit("GT:DP:GQ").alias("format"))
    sids = [r[0] for r in f.fx_sample.select("sid").orderBy("sid").collect()]
    rec = V.sparse_records(sites, f.fx_entry.select("vid", "sid", "entry"), sids)
    size = f.fx_site.count() * (len(sids) * (len(MISSING_ENTRY) + 1) + 100)
    return rec, V.record_text(len(sids), MISSING_ENTRY), min(MAX_PARTS, 1 + size // PART_BYTES)


def _sample_names(f):
    return [r[0] for r in f.fx_sample.select("sample", "sid").orderBy("sid").collect()]


def fixture_vcf(f) -> str:
    """The fixture cohort written once as VCF text (one folder)."""
    if "vcf" not in f.extra:
        hdr = V.header_lines([(c, HG38_LENGTHS.get(c)) for c in HEADER_CONTIGS], _sample_names(f), META)
        rec, text, parts = _fixture_records(f)
        f.extra["vcf"] = V.write_vcf(rec, hdr, scratch_path(f.spark, "fixture-vcf"), text=text, parts=parts, compression="gzip")
    return f.extra["vcf"]


SQL_DENSE = """dense AS (
  SELECT s.contig, s.pos, s.ref, s.alt, m.sample, coalesce(e.entry, './.:.:.') AS entry, s.vid
  FROM fx_site s CROSS JOIN fx_sample m LEFT JOIN fx_entry e ON e.vid = s.vid AND e.sid = m.sid)"""


@register("vcf_read", "WITH " + SQL_DENSE + """
SELECT contig, pos, ref, alt, sample, split_part(entry, ':', 1) AS gt FROM dense""")
def q_vcf_read(spark, sf_dir):
    t = V.read_vcf(spark, fixture_vcf(fx(spark, sf_dir)))
    return t.entries.select("contig", "pos", "ref", "alt", "sample", "gt")


def _block_vcf(f) -> str:
    """The fixture cohort as block gzip parts."""
    if "block_vcf" not in f.extra:
        hdr = V.header_lines([(c, HG38_LENGTHS.get(c)) for c in HEADER_CONTIGS], _sample_names(f), META)
        rec, text, parts = _fixture_records(f)
        f.extra["block_vcf"] = BV.write_blocks(rec.repartition(parts, "vid").select(text.alias("value")), hdr,
                                               scratch_path(f.spark, "block-vcf"))
    return f.extra["block_vcf"]


@register("vcf_blocks", "WITH " + SQL_DENSE + """
SELECT s.contig, s.pos, s.rsid AS id, s.ref, s.alt, s.filter, count(*) AS n_entries, count(*) FILTER (d.entry LIKE '0/1:%') AS n_het
FROM fx_site s JOIN dense d ON s.vid = d.vid GROUP BY s.vid, s.contig, s.pos, s.rsid, s.ref, s.alt, s.filter""")
def q_vcf_blocks(spark, sf_dir):
    BV.register(spark)
    df = (spark.read.format("vcf").schema("contig string, pos long, id string, ref string, alt string, filter string, entries array<string>")
          .option("splitBytes", str(1 << 20)).load(_block_vcf(fx(spark, sf_dir))))
    het = F.size(F.filter("entries", lambda e: e.startswith("0/1:")))
    return df.select("contig", "pos", "id", "ref", "alt", "filter", F.size("entries").cast("long").alias("n_entries"), het.cast("long").alias("n_het"))


@register("vcf_region", """
SELECT contig, pos, ref, alt FROM fx_site WHERE (contig = 'chr3' AND pos BETWEEN 1000000 AND 3000000) OR contig = 'chr20'""")
def q_vcf_region(spark, sf_dir):
    BV.register(spark)
    path = _block_vcf(fx(spark, sf_dir))
    index = BV.build_index(spark, path, scratch_path(spark, "block-vcf-index"), split_bytes=1 << 18)
    return (spark.read.format("vcf").schema("contig string, pos long, ref string, alt string").option("index", index)
            .option("region", "chr3:1000000-3000000,chr20").load(path))


@register("vcf_header", """
SELECT 'contig' AS kind, c AS value FROM (SELECT unnest(['chr' || x FOR x IN range(1, 23)] || ['chrX', 'chrY', 'chrM']) AS c) a
UNION ALL SELECT 'sample', sample FROM fx_sample""")
def q_vcf_header(spark, sf_dir):
    h = V.vcf_header_only(spark, fixture_vcf(fx(spark, sf_dir)))
    samples, contigs = V.header_tables(h)
    return (contigs.select(F.lit("contig").alias("kind"), F.col("contig").alias("value"))
            .unionByName(samples.select(F.lit("sample").alias("kind"), F.col("sample").alias("value"))))


def _annotated_table(f):
    if "annot" not in f.extra:
        path = scratch_path(f.spark, "annotated")
        meta = f.spark.createDataFrame([(0, "## ENSEMBL VARIANT EFFECT PREDICTOR"), (1, "## Output produced by a test"),
                                        (2, "## Column descriptions follow"),
                                        (3, "#Uploaded_variation\tLocation\tAllele\tGene")], "o int, value string")
        body = f.fx_site.select(F.lit(4).alias("o"), F.concat_ws(
            "\t", "rsid", F.concat("contig", F.lit(":"), F.col("pos").cast("string")), "alt", "rsid").alias("value"))
        meta.unionByName(body).orderBy("o").select("value").write.mode("overwrite").text(path)
        f.extra["annot"] = path
    return f.extra["annot"]


@register("header_body_split", """
SELECT 3 AS n_meta, 'Uploaded_variation' || chr(9) || 'Location' || chr(9) || 'Allele' || chr(9) || 'Gene' AS header,
       (SELECT count(*) FROM fx_site) AS n_data""")
def q_header_body_split(spark, sf_dir):
    meta, header, body = ST.header_body_split(spark, _annotated_table(fx(spark, sf_dir)))
    m = meta.agg(F.count(F.lit(1)).cast("int").alias("n_meta"))
    h = header.agg(F.first("header").alias("header"))
    b = body.agg(F.count(F.lit(1)).alias("n_data"))
    one = F.lit(1).alias("_k")
    return m.select("*", one).join(h.select("*", one), "_k").join(b.select("*", one), "_k").drop("_k")


@register("vcf_write_shards", """
SELECT shard, count(*) AS n_records, """ + str(N_HEADER) + """ AS n_header FROM (
  SELECT CAST(floor((row_number() OVER (ORDER BY CAST(substr(contig, 4) AS INTEGER), pos, vid) - 1) / 100) AS BIGINT) AS shard FROM fx_site) t
GROUP BY shard""")
def q_vcf_write_shards(spark, sf_dir):
    f = fx(spark, sf_dir)
    rec, text, parts = _fixture_records(f)
    rec = rec.withColumns({"_rk": IV.natural_contig_rank("contig"),
                                           "_bk": F.floor(F.col("pos") / 1_000_000).cast("long")})
    rec = row_index(rec, [], ["_rk", "contig", "_bk"], ["pos", "vid"], out="_i") \
        .withColumn("shard", F.floor(F.col("_i") / SHARD_RECORDS).cast("long"))
    hdr = V.header_lines([(c, HG38_LENGTHS.get(c)) for c in HEADER_CONTIGS], _sample_names(f), META)
    path = V.write_vcf(rec, hdr, scratch_path(spark, "vcf-shards"), shard="shard", order=["_rk", "pos", "vid"],
                       text=text, parts=parts, compression="gzip")
    back = spark.read.text(path)  # partition discovery restores the shard column
    return back.groupBy(F.col("shard").cast("long").alias("shard")).agg(
        F.sum(F.when(~F.col("value").startswith("#"), 1).otherwise(0)).cast("long").alias("n_records"),
        F.sum(F.when(F.col("value").startswith("#"), 1).otherwise(0)).cast("int").alias("n_header"))


SAMPLE_SCHEMA = T.StructType([T.StructField("sid", T.LongType()), T.StructField("sample", T.StringType()),
                              T.StructField("population", T.StringType())])


def _sample_tsv(f):
    if "tsv" not in f.extra:
        f.extra["tsv"] = ST.tsv_write(f.fx_sample, scratch_path(f.spark, "samples-tsv"))
    return f.extra["tsv"]


@register("tsv_read", "SELECT sid, population FROM fx_sample")
def q_tsv_read(spark, sf_dir):
    return ST.tsv_read(spark, _sample_tsv(fx(spark, sf_dir)), SAMPLE_SCHEMA, ["sid", "population"])


@register("tsv_write", "SELECT sid, sample, population FROM fx_sample")
def q_tsv_write(spark, sf_dir):
    f = fx(spark, sf_dir)
    path = ST.tsv_write(f.fx_sample, scratch_path(spark, "tsv-write"))
    return spark.read.csv(path, sep="\t", header=True, schema=SAMPLE_SCHEMA)


def _bed(f):
    if "bed" not in f.extra:
        path = scratch_path(f.spark, "bed")
        f.fx_interval.select(F.concat_ws("\t", "contig", F.col("start_pos").cast("string"),
                                         F.col("end_pos").cast("string"), "name").alias("value")) \
            .write.mode("overwrite").text(path)
        f.extra["bed"] = path
    return f.extra["bed"]


@register("bed_read", "SELECT contig, start_pos AS start, end_pos AS \"end\" FROM fx_interval")
def q_bed_read(spark, sf_dir):
    return ST.bed_read(spark, _bed(fx(spark, sf_dir)))


def _interval_list(f):
    if "ilist" not in f.extra:
        iv = f.fx_interval.select("contig", F.col("start_pos").alias("start"), F.col("end_pos").alias("end"), "name")
        f.extra["ilist"] = ST.interval_list_write(iv, list(HG38_LENGTHS.items()), scratch_path(f.spark, "ilist"))
    return f.extra["ilist"]


@register("interval_list_write", """
SELECT '@HD' || chr(9) || 'VN:1.6' || chr(9) || 'SO:coordinate' AS value
UNION ALL SELECT '@SQ' || chr(9) || 'SN:' || c || chr(9) || 'LN:' || n FROM (VALUES """ + ", ".join(
    f"('{c}', {n})" for c, n in HG38_LENGTHS.items()) + """) t(c, n)
UNION ALL SELECT contig || chr(9) || (start_pos + 1) || chr(9) || end_pos || chr(9) || '+' || chr(9) || name FROM fx_interval""")
def q_interval_list_write(spark, sf_dir):
    return spark.read.text(_interval_list(fx(spark, sf_dir)))


@register("interval_list_read", "SELECT contig, start_pos AS start, end_pos AS \"end\", name FROM fx_interval")
def q_interval_list_read(spark, sf_dir):
    return ST.interval_list_read(spark, _interval_list(fx(spark, sf_dir)))


def _report_json(f):
    if "report" not in f.extra:
        calls = f.fx_call.where(F.col("gt") != "./.").join(f.fx_site.select("vid", "contig"), "vid") \
            .join(f.fx_sample.select("sid", "sample"), "sid")
        per = calls.groupBy("contig", "sid", "sample").agg(
            F.count(F.lit(1)).alias("n_called"), F.sum(F.when(F.col("gt") == "1/1", 1).otherwise(0)).alias("n_hom_var"))
        rows = per.groupBy("contig").agg(F.sort_array(F.collect_list(F.struct(
            "sid", F.array(F.col("sample"), F.col("n_called").cast("string"), F.col("n_hom_var").cast("string")).alias("vals")))).alias("r"))
        cols = F.array(*[F.struct(F.lit(n).alias("name")) for n in ("Sample", "nCalled", "nHomVar")])
        doc = rows.select(F.to_json(F.create_map(F.lit("By Sample"), F.create_map(
            F.col("contig"), F.struct(F.struct(cols.alias("columns"),
                                               F.transform("r", lambda x: x["vals"]).alias("datasets")).alias("data"))))).alias("value"))
        path = scratch_path(f.spark, "report-json")
        doc.write.mode("overwrite").text(path)
        f.extra["report"] = path
    return f.extra["report"]


@register("report_json_read", """
WITH per AS (SELECT s.contig, c.sid, m.sample, count(*) AS n_called, sum(CASE WHEN c.gt = '1/1' THEN 1 ELSE 0 END) AS n_hom_var
             FROM fx_call c JOIN fx_site s ON c.vid = s.vid JOIN fx_sample m ON c.sid = m.sid WHERE c.gt <> './.' GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY contig ORDER BY sid) - 1 AS row FROM per)
SELECT contig AS section, row, 'Sample' AS "column", sample AS value FROM r
UNION ALL SELECT contig, row, 'nCalled', CAST(n_called AS VARCHAR) FROM r
UNION ALL SELECT contig, row, 'nHomVar', CAST(n_hom_var AS VARCHAR) FROM r""")
def q_report_json_read(spark, sf_dir):
    cells = ST.report_json_read(spark, _report_json(fx(spark, sf_dir)), multi_line=False)
    return cells.select("section", F.col("row").cast("long").alias("row"), "column", "value")


def _chunks(f):
    if "chunks" not in f.extra:
        b = f.fx_block
        line = F.concat_ws("\t", (F.col("block_start") / 100000).cast("long").cast("string"), "src",
                           region_format("src", "block_start", "block_end"),
                           region_format("src", F.greatest(F.col("block_start") - 1000, F.lit(0)), F.col("block_end") + 1000))
        path = scratch_path(f.spark, "chunks")
        b.select(line.alias("value")).write.mode("overwrite").text(path)
        f.extra["chunks"] = path
    return f.extra["chunks"]


@register("chunk_list_read", """
SELECT lpad(CAST(CAST(block_start / 100000 AS BIGINT) AS VARCHAR), 4, '0') AS chunk, src AS contig,
       block_start AS in_start, block_end AS in_end, greatest(block_start - 1000, 0) AS out_start, block_end + 1000 AS out_end
FROM fx_block""")
def q_chunk_list_read(spark, sf_dir):
    return ST.chunk_list_read(spark, _chunks(fx(spark, sf_dir)))


@register("variant_store", "WITH " + """
loc AS (SELECT vid, contig, pos, ref, alt, row_number() OVER (ORDER BY CAST(substr(contig, 4) AS INTEGER), pos, ref, alt) - 1 AS line FROM fx_site),
pc AS (SELECT c.vid, m.sample, unnest([TRY_CAST(string_split(c.gt, '/')[1] AS INTEGER), TRY_CAST(string_split(c.gt, '/')[2] AS INTEGER)]) AS a
       FROM fx_call c JOIN fx_sample m ON c.sid = m.sid),
v AS (SELECT l.line, l.contig, l.pos, pc.sample, l.ref, string_split(l.alt, ',')[pc.a] AS alt FROM pc JOIN loc l ON pc.vid = l.vid WHERE pc.a > 0)
SELECT line, contig, pos, sample, alt, """ + """CASE WHEN ref = '.' THEN 'nr' WHEN length(alt) < length(ref) THEN 'de' WHEN length(alt) > length(ref) THEN 'in'
       WHEN length(ref) > 1 THEN 'mp' WHEN upper(ref) || upper(alt) IN ('AG', 'GA', 'CT', 'TC') THEN 'ts'
       WHEN upper(ref) IN ('A','C','G','T') AND upper(alt) IN ('A','C','G','T') AND upper(ref) <> upper(alt) THEN 'tv' END AS vclass
FROM v""")
def q_variant_store(spark, sf_dir):
    from locusframe.sources.store import variant_store
    t = V.read_vcf(spark, fixture_vcf(fx(spark, sf_dir)))
    store = variant_store(t, HEADER_CONTIGS)
    v = store["variant"].join(store["locus"].select("line", "cid", "pos", "ref"), "line") \
        .join(store["contig"].select("cid", F.col("name").alias("contig")), "cid") \
        .join(store["sample"].select("col", F.col("name").alias("sample")), "col")
    return v.select("line", "contig", "pos", "sample", "alt", F.col("class").alias("vclass"))


@register("issue_store", """
SELECT s.contig, s.pos, m.sample, e.entry FROM fx_entry e JOIN fx_site s ON e.vid = s.vid JOIN fx_sample m ON e.sid = m.sid
WHERE len(string_split(e.entry, ':')) <> len(string_split(e.format, ':'))""")
def q_issue_store(spark, sf_dir):
    from locusframe.sources.store import issue_store
    t = V.read_vcf(spark, fixture_vcf(fx(spark, sf_dir)))
    return issue_store(t)["issue"].select("contig", "pos", "sample", "entry")


@register("blob_listing", "SELECT name, basename, size FROM fx_blob")
def q_blob_listing(spark, sf_dir):
    return blob_listing(fx(spark, sf_dir).fx_blob)


@register("list_dir", """
SELECT DISTINCT CASE WHEN strpos(r, '/') > 0 THEN 'src1/' || split_part(r, '/', 1) || '/' ELSE 'src1/' || r END AS entry,
       CASE WHEN strpos(r, '/') > 0 THEN 'folder' ELSE 'file' END AS kind
FROM (SELECT substr(name, 6) AS r FROM fx_blob WHERE starts_with(name, 'src1/')) t""")
def q_list_dir(spark, sf_dir):
    return LS.list_dir(fx(spark, sf_dir).fx_blob, "src1/")


@register("checkpoint_stage", "SELECT contig, count(*) AS n FROM fx_site GROUP BY contig")
def q_checkpoint_stage(spark, sf_dir):
    f = fx(spark, sf_dir)
    root = scratch_path(spark, "stages")

    @checkpoint_stage(root, "loci")
    def loci(sp):
        return f.fx_site.groupBy("contig").agg(F.count(F.lit(1)).alias("n"))

    first = loci(spark)
    return loci(spark).unionByName(first).groupBy("contig").agg(F.max("n").alias("n"))
