"""Fixture views over the driver's synthetic tables.

Each view is plain SQL that Spark SQL and DuckDB both accept unchanged.
Spark builds them with ``spark.sql(text, **frames)`` (DataFrame parameters,
no global temp views); the DuckDB oracle inlines them as ``WITH`` clauses via
:func:`oracle`.  The view texts are the test inputs described in FIXTURES.md.
"""

from __future__ import annotations

import re
import threading

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
               "events", "documents", "embeddings", "pages", "benchmark", "labels",
               "conversations")

# The fixture view texts (FIXTURES.md part B).
FIXTURE_SQL: dict[str, str] = {
    "fx_site": """
SELECT p_partkey AS vid, 'chr' || (1 + p_partkey % 22) AS contig, 1 + (p_partkey * 7919) % 5000000 AS pos,
 CASE WHEN p_size = 50 THEN 'rs_dup' ELSE 'rs' || p_partkey END AS rsid,
 CASE WHEN p_partkey % 13 = 0 THEN substr('ACGT', 1 + p_size % 4, 1) || 'AC' ELSE substr('ACGT', 1 + p_size % 4, 1) END AS ref,
 CASE WHEN p_partkey % 13 = 0 THEN substr('ACGT', 1 + p_size % 4, 1)
      WHEN p_partkey % 11 = 0 THEN substr('ACGT', CAST(1 + (p_size + 1 + p_partkey % 3) % 4 AS INT), 1) || ',' || substr('ACGT', 1 + p_size % 4, 1) || 'TT'
      ELSE substr('ACGT', CAST(1 + (p_size + 1 + p_partkey % 3) % 4 AS INT), 1) END AS alt,
 p_retailprice AS qual, CASE WHEN p_type = 'ECONOMY' THEN 'LowQual' ELSE 'PASS' END AS filter
FROM {part}""",
    "fx_sample": """
SELECT s_suppkey AS sid, s_name AS sample, r_name AS population
FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey""",
    "fx_call": """
SELECT vid, sid, CASE WHEN q <= 3 THEN './.' WHEN q <= 30 THEN '0/0' WHEN q <= 40 THEN '0/1'
  WHEN q <= 45 AND vid % 11 = 0 AND vid % 13 <> 0 THEN '1/2' WHEN q <= 45 THEN '0/1' ELSE '1/1' END AS gt,
 CAST(q AS INT) AS dp, fmt
FROM (SELECT l_partkey AS vid, l_suppkey AS sid, max(l_quantity) AS q, max(l_returnflag) AS fmt
      FROM {lineitem} GROUP BY l_partkey, l_suppkey) t""",
    "fx_entry": """
SELECT c.vid, c.sid, 'GT:DP:GQ' AS format, CASE WHEN c.fmt = 'R' THEN c.gt || ':' || c.dp ELSE c.gt || ':' || c.dp || ':' || (c.dp % 60) END AS entry,
 'DP=' || c.dp || ';SET=' || s.filter || ';AQ=' || (c.vid % 7) AS info
FROM {fx_call} c JOIN {fx_site} s ON c.vid = s.vid""",
    "fx_interval": """
SELECT 'chr' || (1 + o_custkey % 22) AS contig, (o_orderkey * 37) % 1000000 AS start_pos,
 (o_orderkey * 37) % 1000000 + 1 + CAST(floor(o_totalprice) AS BIGINT) % 400 AS end_pos, o_orderpriority AS name
FROM {orders}""",
    "fx_block": """
SELECT DISTINCT contig AS src, CAST(floor(start_pos / 100000) AS BIGINT) * 100000 AS block_start,
 CAST(floor(start_pos / 100000) AS BIGINT) * 100000 + 90000 AS block_end, contig AS dst,
 CAST(floor(start_pos / 100000) AS BIGINT) * 100 + 5000 AS shift
FROM {fx_interval}""",
    "fx_weight": """
SELECT p_brand AS pgs, CASE WHEN p_size = 50 THEN 'rs_dup' ELSE 'rs' || p_partkey END AS rsid,
 CASE WHEN p_size % 7 = 0 THEN 'N' WHEN p_partkey % 13 = 0 THEN substr('ACGT', 1 + p_size % 4, 1)
      ELSE substr('ACGT', CAST(1 + (p_size + 1 + p_partkey % 3) % 4 AS INT), 1) END AS allele,
 round(p_retailprice / 1000.0 - 1.4, 4) AS beta
FROM {part}""",
    "fx_loading": """
SELECT vid, ((vid * 7) % 13 - 6) / CAST(100 AS DOUBLE) AS l1, ((vid * 5) % 11 - 5) / CAST(100 AS DOUBLE) AS l2, ((vid * 3) % 17 - 8) / CAST(100 AS DOUBLE) AS l3
FROM {fx_site}""",
    "fx_blob": """
SELECT doc_id, source || '/' || lang || '/' || doc_id || '/part' || (doc_id % 7) || '.txt' AS name,
 'part' || (doc_id % 7) || '.txt' AS basename, n_chars AS size
FROM {documents}""",
    "fx_source": """
SELECT name, size FROM {fx_blob} WHERE doc_id % 10 <> 0""",
    "fx_dest": """
SELECT name, CASE WHEN doc_id % 2 = 0 THEN size ELSE size + 1 END AS size FROM {fx_blob} WHERE doc_id % 3 = 0""",
    "fx_entity": """
SELECT doc_id AS entity, CASE WHEN lang = 'es' THEN 's3://other/' || name ELSE 'gs://work/' || name END AS cram,
 'gs://work/shared/' || basename AS ref_file, basename AS note
FROM (SELECT b.doc_id, d.lang, b.name, b.basename FROM {fx_blob} b JOIN {documents} d ON b.doc_id = d.doc_id) t""",
    "fx_read1": """
SELECT o_orderkey AS read_id, o_custkey AS payload FROM {orders} WHERE o_orderkey % 10 <> 0""",
    "fx_read2": """
SELECT o_orderkey AS read_id, o_custkey AS payload FROM {orders} WHERE o_orderkey % 7 <> 0""",
    # one piece of sequence a site: a base, then a repeat; some runs are longer than several windows
    "fx_refpiece": """
SELECT vid, contig, unit, seq, 1 + coalesce(sum(length(seq)) OVER (
  PARTITION BY contig ORDER BY vid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
FROM (SELECT vid, contig, unit, substr('ACGT', CAST(1 + (vid * 7) % 4 AS INT), 1) || repeat(unit, copies) AS seq
      FROM (SELECT vid, contig, substr('ACGT', CAST(1 + vid % 4 AS INT), 1)
              || CASE WHEN vid % 3 = 0 THEN '' ELSE substr('ACGT', CAST(1 + (vid * 5) % 4 AS INT), 1) || 'C' END AS unit,
              CASE WHEN vid % 67 = 0 THEN 300 ELSE CAST(3 + vid % 9 AS INT) END AS copies FROM {fx_site}) a) b""",
    # events at the right end of a piece's repeat: the last unit gone, one unit more, or another base
    "fx_indel": """
SELECT vid, contig, CAST(start + length(seq) - 1 - CASE WHEN vid % 2 = 0 AND vid % 7 <> 0 THEN length(unit) ELSE 0 END AS BIGINT) AS pos,
 right(unit, 1) || CASE WHEN vid % 2 = 0 AND vid % 7 <> 0 THEN unit ELSE '' END AS ref,
 CASE WHEN vid % 7 = 0 THEN 'T' ELSE right(unit, 1) || CASE WHEN vid % 2 = 0 THEN '' ELSE unit END END AS alt
FROM {fx_refpiece}""",
    # typed sub-fields: AD per allele, PL per genotype, VAF per ALT; a tenth of AD and of PL is missing
    "fx_typed": """
SELECT vid, sid, ref, alt, gt, 'GT:AD:DP:PL:VAF' AS format,
 gt || ':' || CASE WHEN dp % 10 = 1 THEN '.' ELSE dp || ',' || (dp * 3 % 17) || CASE WHEN two THEN ',' || (dp * 5 % 13) ELSE '' END END
 || ':' || dp || ':' || CASE WHEN dp % 10 = 2 THEN '.' ELSE '0,' || (dp % 29) || ',' || (vid % 31)
   || CASE WHEN two THEN ',' || (sid % 37) || ',' || (dp * 7 % 41) || ',' || (vid * 3 % 43) ELSE '' END END
 || ':0.' || (10 + dp) || CASE WHEN two THEN ',0.' || (60 - dp % 40) ELSE '' END AS entry
FROM (SELECT c.vid, c.sid, c.gt, c.dp, s.ref, s.alt, s.alt LIKE '%,%' AS two
      FROM {fx_call} c JOIN {fx_site} s ON c.vid = s.vid) t""",
    "fx_info": """
SELECT vid, ref, alt, CASE WHEN vid % 5 = 0 THEN 'DB;' ELSE '' END || 'AC=' || (vid % 50) || CASE WHEN alt LIKE '%,%' THEN ',' || (vid % 9) ELSE '' END
 || ';AF=0.' || (10 + vid % 80) || CASE WHEN alt LIKE '%,%' THEN ',.' ELSE '' END || ';NS=' || (vid % 90) AS info
FROM {fx_site}""",
    # intervals of every length: short ones, ten times and a thousand times as long, and whole contigs
    "fx_span": """
SELECT contig, start_pos, end_pos, 'short' AS kind FROM {fx_interval}
UNION ALL SELECT contig, start_pos, start_pos + (end_pos - start_pos) * 1000, 'long' FROM {fx_interval} WHERE start_pos % 50 = 0
UNION ALL SELECT contig, start_pos, start_pos + 10000000, 'wide' FROM {fx_interval} WHERE start_pos % 997 = 0
UNION ALL SELECT contig, CAST(0 AS BIGINT), CAST(248956422 AS BIGINT), 'contig' FROM {fx_interval} GROUP BY contig""",
    # two blocks per 100 kb, a gap of 100 between them; every third pair lies in reverse, every seventh has a second chain
    "fx_chain": """
SELECT src || ':' || block_start AS chain, src, block_start, block_start + 40000 AS block_end, dst,
 block_start + CASE WHEN rev THEN 50000 + shift ELSE shift END AS dst_start, CASE WHEN rev THEN '-' ELSE '+' END AS strand
FROM (SELECT *, CAST(floor(block_start / 100000) AS BIGINT) % 3 = 0 AS rev FROM {fx_block}) a
UNION ALL
SELECT src || ':' || block_start, src, block_start + 40100, block_end, dst,
 block_start + CASE WHEN rev THEN shift ELSE 40100 + shift END, CASE WHEN rev THEN '-' ELSE '+' END
FROM (SELECT *, CAST(floor(block_start / 100000) AS BIGINT) % 3 = 0 AS rev FROM {fx_block}) b
UNION ALL
SELECT 'second ' || src || ':' || block_start, src, block_start + 20000, block_start + 30000, 'chr1', block_start * 2, '+'
FROM {fx_block} WHERE CAST(floor(block_start / 100000) AS BIGINT) % 7 = 1""",
    "fx_depth": """
SELECT l_partkey AS gene, CAST(sum(l_quantity) AS BIGINT) % 200 AS depth FROM {lineitem} GROUP BY l_partkey""",
}

_PLACEHOLDER = re.compile(r"\{([a-z_0-9]+)\}")


def _deps(name: str) -> list[str]:
    return _PLACEHOLDER.findall(FIXTURE_SQL[name])


class Fixtures:
    """Lazily loaded base tables and fixture views for one data folder."""

    _cache: dict[tuple[int, str, str], "Fixtures"] = {}
    _lock = threading.Lock()

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._frames: dict[str, DataFrame] = {}
        self.extra: dict[str, object] = {}  # per-folder derived artefacts (written files)

    @classmethod
    def of(cls, spark: SparkSession, sf_dir: str) -> "Fixtures":
        # the application id guards against a new session reusing the id()
        # of a stopped one (cached frames would point at a dead context)
        key = (id(spark), spark.sparkContext.applicationId, sf_dir.rstrip("/"))
        with cls._lock:
            if key not in cls._cache or cls._cache[key].spark is not spark:
                cls._cache[key] = cls(spark, sf_dir)
            return cls._cache[key]

    def table(self, name: str) -> DataFrame:
        if name not in self._frames:
            if name in BASE_TABLES:
                self._frames[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
            elif name in FIXTURE_SQL:
                params = {d: self.table(d) for d in _deps(name)}
                self._frames[name] = self.spark.sql(FIXTURE_SQL[name], **params)
            else:
                raise KeyError(name)
        return self._frames[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name in ("spark", "sf_dir", "extra"):
            raise AttributeError(name)
        try:
            return self.table(name)
        except KeyError as e:
            raise AttributeError(name) from e


def oracle(body: str) -> str:
    """Prefix ``body`` with ``WITH`` clauses for every fixture view it uses
    (recursively, dependencies first), with base tables named plainly."""
    order: list[str] = []

    def visit(n: str) -> None:
        for d in _deps(n):
            if d in FIXTURE_SQL:
                visit(d)
        if n not in order:
            order.append(n)

    for n in re.findall(r"\bfx_[a-z0-9]+\b", body):
        if n in FIXTURE_SQL:
            visit(n)
    if not order:
        return body.strip()
    ctes = ",\n".join(
        f"{n} AS ({_PLACEHOLDER.sub(lambda m: m.group(1), FIXTURE_SQL[n]).strip()})" for n in order)
    b = body.strip()
    if re.match(r"(?is)^with\s", b):
        return f"WITH {ctes},\n{b[4:].lstrip()}"
    return f"WITH {ctes}\n{b}"
