"""Genotype-call operators over the long entry form ``(vid, sid, gt, ...)``.

Every operator here is a single aggregation or an equi join keyed by the
variant (or sample); Spark pre-aggregates map-side, so the shuffled volume is
one partial row per (partition, key), not one row per genotype.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locusframe.functions import genotype as G
from locusframe.functions.hwe import excess_het, hwe_exact_p


def parse_calls(entries: DataFrame, gt: str = "gt") -> DataFrame:
    """Add ``a1, a2, phased, ploidy`` parsed from the GT string.  The GT is
    split once in a projection and the fields are read from that array
    (rather than re-evaluating a struct expression per field)."""
    cols = entries.columns
    # '|' -> '/' then a single-character split (no regular expression)
    d = entries.withColumn("_gp", F.split(F.translate(F.col(gt), "|", "/"), "/"))
    return d.select(*cols,
                    F.element_at("_gp", 1).try_cast("int").alias("a1"),
                    F.when(F.size("_gp") >= 2, F.element_at("_gp", 2).try_cast("int")).alias("a2"),
                    F.col(gt).contains("|").alias("phased"),
                    F.when(F.col(gt).isNotNull(), F.size("_gp")).alias("ploidy"))


def split_alleles(sites: DataFrame, alt: str = "alt") -> DataFrame:
    """One row per (site, ALT): ``allele`` is the 1-based ALT index and
    ``alt`` the single allele; the original ALT list is kept as ``old_alt``."""
    return (sites.select("*", F.posexplode(F.split(F.col(alt), ",")).alias("_i", "_alt"))
            .withColumn("old_alt", F.col(alt))
            .withColumn("allele", (F.col("_i") + 1).cast("int"))
            .withColumn(alt, F.col("_alt")).drop("_i", "_alt"))


def decompose(calls: DataFrame, sites: DataFrame, key: str = "vid") -> DataFrame:
    """Biallelic view of multi-allelic sites: one row per (call, ALT) with
    alleles recoded to that ALT (this ALT -> 1, REF -> 0, other ALT -> null).

    ``calls`` needs ``key, a1, a2`` (see :func:`parse_calls`); ``sites`` needs
    ``key, ref, alt``. The join is on the variant key; the site side is one
    row per variant, so it is the small side of a shuffle join (or of a
    broadcast when AQE measures it small)."""
    alts = split_alleles(sites.select(key, "ref", "alt"))
    return (calls.join(alts, key)
            .withColumn("r1", G.recode_to_allele("a1", F.col("allele")))
            .withColumn("r2", G.recode_to_allele("a2", F.col("allele"))))


def _known(c):
    return F.when(F.col(c).isNotNull(), 1).otherwise(0)


def allele_stats(dcalls: DataFrame) -> DataFrame:
    """Per-row known-allele count ``k`` and ALT copies ``d`` for recoded
    alleles ``r1, r2``."""
    k = _known("r1") + _known("r2")
    d = F.coalesce(F.col("r1"), F.lit(0)) + F.coalesce(F.col("r2"), F.lit(0))
    return dcalls.withColumns({"k": k, "d": d})


def _all_alleles(agg: DataFrame, sites: DataFrame | None, keys: tuple[str, ...]) -> DataFrame:
    """Counts per (site, ALT) with zeros for ALTs of ``sites`` that no call
    row mentions; the join runs on the aggregate, not on the calls."""
    if sites is None:
        return agg
    every = split_alleles(sites.select(*[k for k in keys if k != "allele"], "ref", "alt")).select(*keys)
    return every.join(agg, list(keys), "left").fillna(0, [c for c in agg.columns if c not in keys])


def variant_qc(dcalls: DataFrame, n_samples: int, fill_homref: bool = False,
               keys: tuple[str, ...] = ("vid", "allele"), sites: DataFrame | None = None) -> DataFrame:
    """Per decomposed variant: AC, AN, AF (ref/alt), n_called, n_not_called,
    call_rate, n_het, n_hom_ref, n_hom_alt, n_hemi.

    Absent (sample, variant) pairs count as not called.  With
    ``fill_homref`` every uncalled sample counts as 0/0 (AN grows by two per
    filled sample) without materialising those rows.  ``sites`` adds the
    sites without any call row."""
    s = allele_stats(dcalls)
    agg = s.groupBy(*keys).agg(
        F.sum(F.when(F.col("k") > 0, 1).otherwise(0)).cast("long").alias("n_called"),
        F.sum("k").cast("long").alias("AN"),
        F.sum("d").cast("long").alias("AC"),
        F.sum(F.when((F.col("k") == 2) & (F.col("d") == 1), 1).otherwise(0)).cast("long").alias("n_het"),
        F.sum(F.when((F.col("k") == 2) & (F.col("d") == 0), 1).otherwise(0)).cast("long").alias("n_hom_ref"),
        F.sum(F.when((F.col("k") == 2) & (F.col("d") == 2), 1).otherwise(0)).cast("long").alias("n_hom_alt"),
        F.sum(F.when(F.col("k") == 1, 1).otherwise(0)).cast("long").alias("n_hemi"))
    agg = _all_alleles(agg, sites, keys)
    n = F.lit(int(n_samples)).cast("long")
    if fill_homref:
        miss = n - F.col("n_called")
        agg = agg.withColumns({"n_hom_ref": F.col("n_hom_ref") + miss,
                               "AN": F.col("AN") + 2 * miss, "n_called": n})
    af = F.when(F.col("AN") > 0, F.col("AC") / F.col("AN"))
    return agg.withColumns({
        "n_not_called": n - F.col("n_called"),
        "call_rate": F.col("n_called") / n,
        "AF_alt": af,
        "AF_ref": F.when(F.col("AN") > 0, 1 - af)})


def with_hwe(qc: DataFrame, out: str = "p_hwe") -> DataFrame:
    """Attach the HWE exact mid-p computed from the diploid genotype counts."""
    return qc.withColumn(out, hwe_exact_p("n_hom_ref", "n_het", "n_hom_alt"))


def mean_af(dcalls: DataFrame, n_samples: int | None = None,
            keys: tuple[str, ...] = ("vid", "allele"), sites: DataFrame | None = None) -> DataFrame:
    """Mean ALT dosage / 2 per variant over called samples; when
    ``n_samples`` is given, uncalled samples count as 0 (filled hom-ref).
    ``sites`` adds the sites without any call row (null over no samples)."""
    s = allele_stats(dcalls).where(F.col("k") > 0)
    g = s.groupBy(*keys).agg(F.sum("d").alias("_s"), F.count(F.lit(1)).alias("_n"))
    g = _all_alleles(g, sites, keys)
    denom = F.lit(int(n_samples)) if n_samples is not None else F.when(F.col("_n") > 0, F.col("_n"))
    return g.select(*keys, (F.col("_s") / denom / 2).alias("mean_af"))


def fill_tags(calls: DataFrame, sites: DataFrame, key: str = "vid") -> DataFrame:
    """Per site and ALT: AN, AC, AC_Hom, AC_Het, AC_Hemi, AF, MAF, NS, HWE,
    ExcHet recomputed from the (not decomposed) genotypes.

    AN and NS are site-level (all called alleles); the others count copies of
    the given ALT. HWE/ExcHet use the biallelic genotype classes of the ALT."""
    site_level = calls.groupBy(key).agg(
        F.sum(_known("a1") + _known("a2")).cast("long").alias("AN"),
        F.sum(F.when(F.col("a1").isNotNull() | F.col("a2").isNotNull(), 1).otherwise(0)).cast("long").alias("NS"))
    d = decompose(calls, sites, key)
    diploid_known = F.col("a1").isNotNull() & F.col("a2").isNotNull()
    copies = (F.when(F.col("a1") == F.col("allele"), 1).otherwise(0)
              + F.when(F.col("a2") == F.col("allele"), 1).otherwise(0))
    per_alt = d.groupBy(key, "allele").agg(
        F.sum(copies).cast("long").alias("AC"),
        F.sum(F.when(diploid_known & (F.col("a1") == F.col("a2")), copies).otherwise(0)).cast("long").alias("AC_Hom"),
        F.sum(F.when(diploid_known & (F.col("a1") != F.col("a2")), copies).otherwise(0)).cast("long").alias("AC_Het"),
        F.sum(F.when(F.col("ploidy") == 1, copies).otherwise(0)).cast("long").alias("AC_Hemi"),
        F.sum(F.when((F.col("r1") == 0) & (F.col("r2") == 0), 1).otherwise(0)).cast("long").alias("_rr"),
        F.sum(F.when((F.col("r1") + F.col("r2")) == 1, 1).otherwise(0)).cast("long").alias("_ra"),
        F.sum(F.when((F.col("r1") == 1) & (F.col("r2") == 1), 1).otherwise(0)).cast("long").alias("_aa"))
    out = _all_alleles(per_alt, sites, (key, "allele")).join(site_level, key, "left").fillna(0, ["AN", "NS"])
    af = F.when(F.col("AN") > 0, F.col("AC") / F.col("AN"))
    return (out.withColumns({"AF": af, "MAF": F.least(af, 1 - af),
                             "HWE": hwe_exact_p("_rr", "_ra", "_aa"),
                             "ExcHet": excess_het("_rr", "_ra", "_aa")})
            .drop("_rr", "_ra", "_aa"))


def carrier_rows(calls: DataFrame, sites: DataFrame, key: str = "vid") -> DataFrame:
    """One row per carried ALT copy: (key, sid, copy index, allele index, ref,
    alt, class). A hom-alt call gives two rows."""
    c = (calls.select(key, "sid", F.posexplode(F.array("a1", "a2")).alias("copy", "a"))
         .where(F.col("a") > 0))
    s = sites.select(key, "ref", F.split("alt", ",").alias("_alts"))
    return (c.join(s, key)
            .select(key, "sid", (F.col("copy") + 1).cast("int").alias("copy"),
                    F.col("a").alias("allele"), "ref",
                    F.element_at("_alts", F.col("a")).alias("alt"))
            .withColumn("vclass", G.variant_class("ref", "alt")))


def sample_qc(calls: DataFrame, sites: DataFrame, key: str = "vid", samples: DataFrame | None = None) -> DataFrame:
    """Per sample (of ``samples``, if given: those without a call have zeros): n_snp, n_insertion, n_deletion, n_het, n_hom_ref,
    n_hom_var, n_singleton, n_ti, n_tv, ti_tv, indel_1_2_to_3 ratio.

    Allele classes come from the decomposed ALT each carried copy belongs to;
    genotype classes from the original call; a singleton is a carried ALT
    whose cohort allele count is 1 (found from the per-variant aggregate, not
    by joining counts back to every entry)."""
    carried = carrier_rows(calls, sites, key)
    ilen = F.abs(F.length("alt") - F.length("ref"))
    per_alt = carried.groupBy("sid").agg(
        F.sum(F.when(F.col("vclass").isin("ts", "tv"), 1).otherwise(0)).cast("long").alias("n_snp"),
        F.sum(F.when(F.col("vclass") == "in", 1).otherwise(0)).cast("long").alias("n_insertion"),
        F.sum(F.when(F.col("vclass") == "de", 1).otherwise(0)).cast("long").alias("n_deletion"),
        F.sum(F.when(F.col("vclass") == "ts", 1).otherwise(0)).cast("long").alias("n_ti"),
        F.sum(F.when(F.col("vclass") == "tv", 1).otherwise(0)).cast("long").alias("n_tv"),
        F.sum(F.when(F.col("vclass").isin("in", "de") & (ilen <= 2), 1).otherwise(0)).cast("long").alias("_i12"),
        F.sum(F.when(F.col("vclass").isin("in", "de") & (ilen == 3), 1).otherwise(0)).cast("long").alias("_i3"))
    singles = (carried.groupBy(key, "allele")
               .agg(F.count(F.lit(1)).alias("_ac"), F.first("sid").alias("sid"))
               .where(F.col("_ac") == 1)
               .groupBy("sid").agg(F.count(F.lit(1)).alias("n_singleton")))
    both = F.col("a1").isNotNull() & F.col("a2").isNotNull()
    gclass = calls.groupBy("sid").agg(
        F.sum(F.when(both & (F.col("a1") != F.col("a2")), 1).otherwise(0)).cast("long").alias("n_het"),
        F.sum(F.when(both & (F.col("a1") == 0) & (F.col("a2") == 0), 1).otherwise(0)).cast("long").alias("n_hom_ref"),
        F.sum(F.when(both & (F.col("a1") == F.col("a2")) & (F.col("a1") > 0), 1).otherwise(0)).cast("long").alias("n_hom_var"))
    if samples is not None:
        gclass = samples.select("sid").distinct().join(gclass, "sid", "left")
    out = (gclass.join(per_alt, "sid", "left").join(singles, "sid", "left")
           .fillna(0, ["n_het", "n_hom_ref", "n_hom_var", "n_snp", "n_insertion", "n_deletion", "n_ti", "n_tv", "_i12", "_i3", "n_singleton"]))
    return (out.withColumns({
        "ti_tv": F.when(F.col("n_tv") > 0, F.col("n_ti") / F.col("n_tv")),
        "indel_1_2_to_3": F.when(F.col("_i3") > 0, F.col("_i12") / F.col("_i3"))})
        .drop("_i12", "_i3"))


def site_allele_counts(calls: DataFrame, sites: DataFrame, key: str = "vid") -> DataFrame:
    """Non-reference allele copies per site split into SNP and indel copies
    (indel = ALT length differs from REF); zeros where nobody carries one."""
    c = carrier_rows(calls, sites, key)
    indel = F.length("alt") != F.length("ref")
    counts = c.groupBy(key).agg(
        F.sum(F.when(~indel, 1).otherwise(0)).cast("long").alias("snp_copies"),
        F.sum(F.when(indel, 1).otherwise(0)).cast("long").alias("indel_copies"))
    return sites.select(key).distinct().join(counts, key, "left").fillna(0, ["snp_copies", "indel_copies"])
