"""Shared inputs for registered queries, and matching SQL fragments for the
oracles (fixture views are inlined by :func:`locusframe.fixtures.oracle`)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from locusframe.fixtures import Fixtures
from locusframe.operators import calls as C


def fx(spark: SparkSession, sf_dir: str) -> Fixtures:
    return Fixtures.of(spark, sf_dir)


def parsed_calls(f: Fixtures) -> DataFrame:
    return C.parse_calls(f.fx_call)


def n_samples(f: Fixtures) -> int:
    if "n_samples" not in f.extra:
        f.extra["n_samples"] = f.fx_sample.count()
    return f.extra["n_samples"]


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every floating column (oracles round the same way)."""
    return df.select(*[F.round(F.col(c), digits).alias(c) if t in ("double", "float") else F.col(c)
                       for c, t in df.dtypes])


# Parsed calls: a1, a2 (null for '.'), ploidy.
SQL_PCALL = """pcall AS (
  SELECT vid, sid, gt, dp, fmt,
         TRY_CAST(string_split(replace(gt, '|', '/'), '/')[1] AS INTEGER) AS a1,
         TRY_CAST(string_split(replace(gt, '|', '/'), '/')[2] AS INTEGER) AS a2,
         len(string_split(replace(gt, '|', '/'), '/')) AS ploidy
  FROM fx_call)"""

# One row per (site, ALT).
SQL_SALT = """salt AS (
  SELECT vid, contig, pos, ref, i AS allele, string_split(alt, ',')[i] AS alt, alt AS old_alt
  FROM (SELECT *, unnest(range(1, len(string_split(alt, ',')) + 1)) AS i FROM fx_site) x)"""

# Decomposed calls with k (known alleles) and d (copies of this ALT).
SQL_DCALL = SQL_PCALL + ",\n" + SQL_SALT + """,
dcall AS (
  SELECT *, (CASE WHEN r1 IS NULL THEN 0 ELSE 1 END) + (CASE WHEN r2 IS NULL THEN 0 ELSE 1 END) AS k,
         coalesce(r1, 0) + coalesce(r2, 0) AS d
  FROM (SELECT c.vid, c.sid, c.a1, c.a2, c.ploidy, s.allele, s.ref, s.alt, s.contig, s.pos,
               CASE WHEN c.a1 = 0 THEN 0 WHEN c.a1 = s.allele THEN 1 END AS r1,
               CASE WHEN c.a2 = 0 THEN 0 WHEN c.a2 = s.allele THEN 1 END AS r2
        FROM pcall c JOIN salt s ON c.vid = s.vid) y)"""

SQL_NSAMP = "nsamp AS (SELECT count(*) AS n FROM fx_sample)"

SQL_VQC_AGG = """vqc0 AS (
  SELECT vid, allele,
         CAST(sum(CASE WHEN k > 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_called,
         CAST(sum(k) AS BIGINT) AS AN, CAST(sum(d) AS BIGINT) AS AC,
         CAST(sum(CASE WHEN k = 2 AND d = 1 THEN 1 ELSE 0 END) AS BIGINT) AS n_het,
         CAST(sum(CASE WHEN k = 2 AND d = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_hom_ref,
         CAST(sum(CASE WHEN k = 2 AND d = 2 THEN 1 ELSE 0 END) AS BIGINT) AS n_hom_alt,
         CAST(sum(CASE WHEN k = 1 THEN 1 ELSE 0 END) AS BIGINT) AS n_hemi
  FROM dcall GROUP BY vid, allele)"""

# Filled (missing -> hom-ref) variant QC, as the build path uses it.
SQL_VQC_FILLED = SQL_DCALL + ",\n" + SQL_NSAMP + ",\n" + SQL_VQC_AGG + """,
vqcf AS (
  SELECT vid, allele, AC, AN + 2 * (n - n_called) AS AN, n AS n_called, n_het,
         n_hom_ref + (n - n_called) AS n_hom_ref, n_hom_alt, n_hemi
  FROM vqc0, nsamp)"""
