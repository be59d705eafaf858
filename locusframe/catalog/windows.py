"""Windowed / ordered queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from locusframe.catalog import register
from locusframe.catalog._common import fx
from locusframe.catalog.joins import SQL_MERGED
from locusframe.operators import intervals as IV
from locusframe.operators import listing as LS
from locusframe.operators import tables as TB
from locusframe.operators.reads import even_split, pair_reads
from locusframe.operators.scan import row_index

BUFFER = 1000
MAX_SPAN = 1_000_000
SHARD_RECORDS = 100


@register("merge_intervals", "WITH " + SQL_MERGED + " SELECT contig, start_pos, end_pos FROM merged")
def q_merge_intervals(spark, sf_dir):
    iv = fx(spark, sf_dir).fx_interval.select("contig", F.col("start_pos").alias("start"), F.col("end_pos").alias("end"))
    m = IV.merge_intervals(iv, width=50_000)
    return m.select("contig", F.col("start").alias("start_pos"), F.col("end").alias("end_pos"))


@register("buffer_positions", "SELECT vid, greatest(pos - 1000, 1) AS lower, pos + 1000 AS upper FROM fx_site")
def q_buffer_positions(spark, sf_dir):
    return IV.buffer_positions(fx(spark, sf_dir).fx_site, BUFFER).select("vid", "lower", "upper")


SQL_ISLANDS = """b AS (SELECT contig, greatest(pos - 1000, 1) AS lo, pos + 1000 AS hi FROM fx_site),
bd AS (SELECT contig, lo, max(hi) AS hi FROM b GROUP BY contig, lo),
bp AS (SELECT *, max(hi) OVER (PARTITION BY contig ORDER BY lo ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev FROM bd),
bg AS (SELECT *, sum(CASE WHEN prev IS NULL OR lo > prev THEN 1 ELSE 0 END) OVER (PARTITION BY contig ORDER BY lo ROWS UNBOUNDED PRECEDING) AS grp FROM bp),
islands AS (SELECT contig, min(lo) AS start_pos, max(hi) AS end_pos FROM bg GROUP BY contig, grp)"""


def _islands(f):
    return IV.buffered_islands(f.fx_site.select("contig", "pos"), BUFFER, width=200_000)


@register("buffered_islands", "WITH " + SQL_ISLANDS + " SELECT contig, start_pos, end_pos FROM islands")
def q_buffered_islands(spark, sf_dir):
    return _islands(fx(spark, sf_dir)).select("contig", F.col("start").alias("start_pos"), F.col("end").alias("end_pos"))


SQL_REGIONS = SQL_ISLANDS + """,
tot AS (SELECT sum(end_pos - start_pos) AS s FROM islands),
par AS (SELECT s, CAST(ceil(s / ceil(s / 1000000.0)) AS BIGINT) AS t FROM tot),
ic AS (SELECT i.*, CAST(substr(contig, 4) AS INTEGER) AS rk,
              coalesce(sum(end_pos - start_pos) OVER (ORDER BY CAST(substr(contig, 4) AS INTEGER), start_pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS c0
       FROM islands i),
pc AS (SELECT ic.*, par.t, unnest(range(CAST(floor(c0 / par.t) AS BIGINT), CAST(floor((c0 + end_pos - start_pos - 1) / par.t) AS BIGINT) + 1)) AS region
       FROM ic, par),
regions AS (SELECT region, contig, min(start_pos + greatest(region * t - c0, 0)) AS start_pos,
                   max(start_pos + least((region + 1) * t - c0, end_pos - start_pos)) AS end_pos
            FROM pc GROUP BY region, contig)"""


def _contig_rank(f):
    return f.fx_site.select("contig").distinct().withColumn("rank", IV.natural_contig_rank("contig"))


def _regions(f):
    return IV.equal_span_regions(_islands(f), _contig_rank(f), MAX_SPAN)


@register("equal_span_regions", "WITH " + SQL_REGIONS + " SELECT region, contig, start_pos, end_pos FROM regions")
def q_equal_span_regions(spark, sf_dir):
    r = _regions(fx(spark, sf_dir))
    return r.select("region", "contig", F.col("start").alias("start_pos"), F.col("end").alias("end_pos"))


@register("fragment_assign", "WITH " + SQL_REGIONS + """
SELECT s.vid, r.region FROM fx_site s JOIN regions r ON s.contig = r.contig AND r.start_pos <= s.pos AND s.pos < r.end_pos""")
def q_fragment_assign(spark, sf_dir):
    f = fx(spark, sf_dir)
    j = IV.points_in_intervals(f.fx_site.select("vid", "contig", "pos"), _regions(f), width=1_000_000)
    return j.select("vid", "region")


@register("record_shards", """
SELECT vid, CAST(floor((row_number() OVER (ORDER BY CAST(substr(contig, 4) AS INTEGER), pos, vid) - 1) / 100) AS BIGINT) AS shard
FROM fx_site""")
def q_record_shards(spark, sf_dir):
    s = fx(spark, sf_dir).fx_site.select("vid", "contig", "pos").withColumns({
        "_rk": IV.natural_contig_rank("contig"), "_bk": F.floor(F.col("pos") / 1_000_000).cast("long")})
    # contigs of equal rank (all without a number, X, Y or M) go by name
    r = row_index(s, [], ["_rk", "contig", "_bk"], ["pos", "vid"], out="_i")
    return r.select("vid", F.floor(F.col("_i") / SHARD_RECORDS).cast("long").alias("shard"))


@register("even_split", """
WITH p AS (SELECT a.read_id FROM fx_read1 a JOIN fx_read2 b ON a.read_id = b.read_id)
SELECT read_id, CAST(floor((row_number() OVER (ORDER BY read_id) - 1) * 8 / (SELECT count(*) FROM p)) AS INTEGER) AS shard FROM p""")
def q_even_split(spark, sf_dir):
    f = fx(spark, sf_dir)
    pairs, _, _ = pair_reads(f.fx_read1, f.fx_read2)
    return even_split(pairs.select("read_id"), 8).select("read_id", "shard")


@register("pick_consequence", """
SELECT vid, consequence, rnk FROM (
  SELECT l_partkey AS vid, l_returnflag || l_linestatus AS consequence, l_linenumber AS rnk,
         row_number() OVER (PARTITION BY l_partkey ORDER BY l_linenumber, l_orderkey, l_suppkey, l_returnflag || l_linestatus) AS rn
  FROM lineitem) t WHERE rn = 1""")
def q_pick_consequence(spark, sf_dir):
    li = fx(spark, sf_dir).lineitem.select(
        F.col("l_partkey").alias("vid"), F.concat("l_returnflag", "l_linestatus").alias("consequence"),
        F.col("l_linenumber").alias("rnk"), "l_orderkey", "l_suppkey")
    p = TB.pick_first(li, ["vid"], ["rnk", "l_orderkey", "l_suppkey", "consequence"], [])
    return p.select("vid", "consequence", "rnk")


@register("size_layout", """
WITH f AS (SELECT name, size FROM fx_blob WHERE size > 0),
anc AS (SELECT name, size, d, array_to_string(string_split(name, '/')[1:d], '/') || '/' AS prefix
        FROM (SELECT name, size, unnest(range(1, len(string_split(name, '/')))) AS d FROM f) x),
nodes AS (SELECT prefix AS node, CAST(sum(size) AS BIGINT) AS extent, false AS is_file FROM anc GROUP BY prefix
          UNION ALL SELECT name, CAST(size AS BIGINT), true FROM f),
np AS (SELECT *, regexp_extract(node, '^(.*/)?[^/]+/?$', 1) AS parent FROM nodes),
own AS (SELECT *, coalesce(sum(extent) OVER (PARTITION BY parent ORDER BY is_file, node ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS own FROM np),
na AS (SELECT node, array_to_string(string_split(node, '/')[1:d], '/') || '/' AS anc
       FROM (SELECT node, unnest(range(1, len(string_split(node, '/')))) AS d FROM own) x),
up AS (SELECT na.node, sum(o.own) AS up FROM na JOIN own o ON o.node = na.anc WHERE na.anc <> na.node GROUP BY na.node)
SELECT own.node, own.parent, own.is_file, own.extent, CAST(own.own + coalesce(up.up, 0) AS BIGINT) AS start
FROM own LEFT JOIN up ON own.node = up.node""")
def q_size_layout(spark, sf_dir):
    return LS.size_layout(fx(spark, sf_dir).fx_blob)


SQL_CELLS = """cells AS (
  SELECT 'sample' AS tbl, entity, 'cram' AS col, cram AS val FROM fx_entity
  UNION ALL SELECT 'sample', entity, 'ref_file', ref_file FROM fx_entity)"""


@register("first_wins_map", "WITH " + SQL_CELLS + """
SELECT val AS path, dest FROM (
  SELECT val, 'gs://archive/' || tbl || '/' || entity || '/' || col || '/' || regexp_extract(val, '[^/]*$') AS dest,
         row_number() OVER (PARTITION BY val ORDER BY tbl, entity, col) AS rn
  FROM cells WHERE starts_with(val, 'gs://work/')) t WHERE rn = 1""")
def q_first_wins_map(spark, sf_dir):
    from locusframe.operators.entities import cells_unpivot, first_wins_map
    e = fx(spark, sf_dir).fx_entity
    cells = cells_unpivot(e.withColumn("tbl", F.lit("sample")), "tbl", "entity", ["cram", "ref_file"])
    return first_wins_map(cells, "gs://work/", "gs://archive")


@register("last_wins_upsert", """
SELECT user_id, event_type, value FROM (
  SELECT user_id, event_type, value, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) t
WHERE rn = 1""")
def q_last_wins_upsert(spark, sf_dir):
    e = fx(spark, sf_dir).events
    return TB.pick_first(e, ["user_id"], ["ts", "event_id"], ["event_type", "value"], last=True) \
        .select("user_id", "event_type", "value")
