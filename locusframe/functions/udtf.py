"""Table functions for SQL.

``decompose(TABLE(...))`` is sugar over :func:`locusframe.operators.calls.decompose`
for sessions that speak SQL alone: each call of a multi-allelic site becomes one
row per ALT, alleles recoded to that ALT. It passes calls through Python row
by row (with Arrow, Spark makes a batch of what each row gives, which takes ten
times as long), so large tables are better served by the DataFrame form, which
stays in the JVM.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.functions import udtf
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult


class Decompose:
    """Input: a table with a1, a2 (allele numbers; null unknown), ref and alt
    (comma-separated), and any other columns. Output: the other columns, ref,
    allele (from 1), alt, r1 and r2 (this ALT 1, REF 0, else null). A null alt
    gives no rows."""

    NEEDED = ("a1", "a2", "ref", "alt")

    @staticmethod
    def analyze(calls: AnalyzeArgument) -> AnalyzeResult:
        if not calls.isTable:
            raise ValueError("decompose needs a table: decompose(TABLE(...))")
        missing = [c for c in Decompose.NEEDED if c not in calls.dataType.names]
        if missing:
            raise ValueError(f"decompose needs the columns {', '.join(Decompose.NEEDED)}; missing: {', '.join(missing)}")
        out = T.StructType([f for f in calls.dataType.fields if f.name not in ("a1", "a2", "alt")])
        for name, kind in (("allele", T.IntegerType()), ("alt", T.StringType()), ("r1", T.IntegerType()), ("r2", T.IntegerType())):
            out = out.add(name, kind)
        return AnalyzeResult(schema=out)

    def eval(self, row):
        if row["alt"] is None:
            return
        kept = [row[c] for c in row.__fields__ if c not in ("a1", "a2", "alt")]
        for i, alt in enumerate(row["alt"].split(","), 1):
            yield (*kept, i, alt, *(0 if a == 0 else 1 if a == i else None for a in (row["a1"], row["a2"])))


def register(spark: SparkSession) -> None:
    """Makes the table functions known to a session."""
    spark.udtf.register("decompose", udtf(Decompose, useArrow=False))
