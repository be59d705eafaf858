"""Genotype and VCF-field scalar expressions.

All functions return Spark ``Column`` expressions built from built-in SQL
functions, so they stay inside whole-stage code generation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from locusframe.functions._util import col_of


def gt_parse(gt) -> Column:
    """``a/b`` or ``a|b`` (or haploid ``a``) -> struct<a1:int, a2:int,
    phased:boolean, ploidy:int>. ``.`` alleles are null; any allele index is
    allowed (also >= 10)."""
    g = col_of(gt)
    parts = F.split(g, r"[/|]")
    a1 = F.element_at(parts, 1).try_cast("int")
    a2 = F.when(F.size(parts) >= 2, F.element_at(parts, 2).try_cast("int"))
    return F.when(g.isNull(), F.lit(None)).otherwise(F.struct(
        a1.alias("a1"), a2.alias("a2"),
        g.contains("|").alias("phased"),
        F.size(parts).alias("ploidy")))


def gt_fill_homref(gt) -> Column:
    """Fully missing genotype (null, ``.``, ``./.``, ``.|.``) -> ``0/0``."""
    g = col_of(gt)
    return F.when(g.isNull() | g.rlike(r"^\.([/|]\.)*$"), F.lit("0/0")).otherwise(g)


def allele_known(a) -> Column:
    return F.when(col_of(a).isNotNull(), F.lit(1)).otherwise(F.lit(0))


def alt_dosage(a1, a2) -> Column:
    """Copies of any non-reference allele among the known alleles; null when
    both alleles are unknown."""
    x, y = col_of(a1), col_of(a2)
    n = F.when(x > 0, 1).otherwise(0) + F.when(y > 0, 1).otherwise(0)
    return F.when(x.isNull() & y.isNull(), F.lit(None).cast("int")).otherwise(n)


def recode_to_allele(a, j) -> Column:
    """Decomposition recode for ALT index ``j`` (1-based): this ALT -> 1,
    REF -> 0, any other ALT or unknown -> null."""
    x = col_of(a)
    return F.when(x == 0, F.lit(0)).when(x == col_of(j), F.lit(1)).otherwise(F.lit(None).cast("int"))


def variant_class(ref, alt) -> Column:
    """``nr`` REF is '.', ``de`` ALT shorter, ``in`` ALT longer, ``mp`` same
    length > 1, ``ts`` A<->G or C<->T, ``tv`` other single-base ACGT pairs,
    null otherwise (e.g. ``*`` or non-ACGT bases)."""
    r, a = F.upper(col_of(ref)), F.upper(col_of(alt))
    pair = F.concat(r, a)
    return (F.when(r == ".", "nr")
            .when(F.length(a) < F.length(r), "de")
            .when(F.length(a) > F.length(r), "in")
            .when(F.length(r) > 1, "mp")
            .when(pair.isin("AG", "GA", "CT", "TC"), "ts")
            .when(r.isin("A", "C", "G", "T") & a.isin("A", "C", "G", "T") & (r != a), "tv"))


def snp_or_indel(ref, alt) -> Column:
    """1 when REF and ALT lengths differ (indel), else 0."""
    return F.when(F.length(col_of(ref)) != F.length(col_of(alt)), 1).otherwise(0)


def info_to_map(info) -> Column:
    """``k=v;k2=v2;FLAG`` -> map<string,string>; flags get a null value."""
    return F.str_to_map(col_of(info), F.lit(";"), F.lit("="))


def format_to_map(fmt, entry) -> Column:
    """Zip FORMAT keys with one sample's values; the shorter list wins."""
    k = F.split(col_of(fmt), ":")
    v = F.split(col_of(entry), ":")
    n = F.least(F.size(k), F.size(v))
    return F.map_from_arrays(F.slice(k, 1, n), F.slice(v, 1, n))


def variant_id(contig, pos, ref, alt) -> Column:
    """``contig_pos_ref_alt``."""
    return F.concat_ws("_", col_of(contig), col_of(pos).cast("string"), col_of(ref), col_of(alt))


def star_to_dash(alt) -> Column:
    """Spanning-deletion allele ``*`` -> ``-`` (ALT field only)."""
    return F.translate(col_of(alt), "*", "-")
