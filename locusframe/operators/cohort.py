"""Cohort bookkeeping: label counts, case/control sets, final lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def ancestry_counts(labelled: DataFrame, order: list[str], cohort: str = "cohort",
                    ancestry: str = "ancestry") -> DataFrame:
    """Samples per (cohort, ancestry) over a fixed label order; labels with
    no sample count 0.  ``ord`` is the 1-based label position."""
    grid = (labelled.select(cohort).distinct()
            .select(cohort, F.posexplode(F.array(*[F.lit(x) for x in order])).alias("_p", ancestry))
            .withColumn("ord", (F.col("_p") + 1).cast("long")).drop("_p"))
    counts = labelled.groupBy(cohort, ancestry).agg(F.count(F.lit(1)).alias("n"))
    return (grid.join(counts, [cohort, ancestry], "left")
            .select(cohort, ancestry, "ord", F.coalesce(F.col("n"), F.lit(0)).cast("long").alias("n")))


def case_control_sets(merged: DataFrame, reference: DataFrame, controls: DataFrame,
                      col: str = "sample") -> DataFrame:
    """cases = merged - reference - controls; controls = control list -
    reference; returned as (sample, label)."""
    cases = merged.select(col).subtract(reference.select(col)).subtract(controls.select(col))
    ctl = controls.select(col).subtract(reference.select(col))
    return (cases.withColumn("label", F.lit("case"))
            .unionByName(ctl.withColumn("label", F.lit("control"))))


def add_reference_controls(controls: DataFrame, reference: DataFrame, include: bool = True,
                           col: str = "sample") -> DataFrame:
    """Control pool, optionally with the reference samples relabelled as
    controls; ``origin`` tells where each row came from."""
    c = controls.select(col, F.lit("control").alias("label"), F.lit("control_file").alias("origin"))
    if not include:
        return c
    r = reference.select(col, F.lit("control").alias("label"), F.lit("reference").alias("origin"))
    return c.unionByName(r)
