"""Tabular text sources and sinks: TSV, BED, interval lists, QC report JSON,
chunk lists, annotated tables with meta headers, FASTQ-like line files."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from locusframe.functions import coords as K

BED_SCHEMA = T.StructType([T.StructField("contig", T.StringType()), T.StructField("start", T.LongType()),
                           T.StructField("end", T.LongType())])


def tsv_read(spark: SparkSession, path, schema: T.StructType | str, columns: list[str] | None = None,
             sep: str = "\t") -> DataFrame:
    """Tab table with a header, explicit schema (no inference), optional
    column subset."""
    df = spark.read.csv(path, sep=sep, header=True, schema=schema)
    return df.select(*columns) if columns else df


def tsv_write(df: DataFrame, path: str, sep: str = "\t") -> str:
    """Write with a header, always tab-separated by default."""
    df.write.mode("overwrite").csv(path, sep=sep, header=True)
    return path


def bed_read(spark: SparkSession, path) -> DataFrame:
    """Headerless BED: first three columns typed; track/browser/# lines skipped."""
    lines = spark.read.text(path).where(~F.col("value").rlike(r"^(#|track|browser)") & (F.length("value") > 0))
    c = F.split("value", "\t")
    return lines.select(c[0].alias("contig"), c[1].cast("long").alias("start"), c[2].cast("long").alias("end"))


def interval_list_read(spark: SparkSession, path, add_chr: bool = False) -> DataFrame:
    """Interval list: skip '@' header lines; 1-based inclusive -> 0-based
    half-open; optional 'chr' prefix."""
    lines = spark.read.text(path).where(~F.col("value").startswith("@") & (F.length("value") > 0))
    c = F.split("value", "\t")
    contig = K.add_chr(c[0]) if add_chr else c[0]
    return lines.select(contig.alias("contig"), (c[1].cast("long") - 1).alias("start"),
                        c[2].cast("long").alias("end"), F.element_at(c, 5).alias("name"))


def interval_list_write(iv: DataFrame, contigs: list[tuple[str, int]], path: str) -> str:
    """BED-style intervals -> interval list with a sequence-dictionary header
    (@HD, one @SQ per contig), 1-based inclusive, strand '+'; sorted parts, the
    header in the first: in order of name they are one list."""
    spark = iv.sparkSession
    head = ["@HD\tVN:1.6\tSO:coordinate"] + [f"@SQ\tSN:{c}\tLN:{n}" for c, n in contigs]
    hdr = spark.createDataFrame(pd.DataFrame({"_o": range(len(head)), "value": head}))
    rank = {c: i for i, (c, _) in enumerate(contigs)}
    rk = F.element_at(F.create_map(*[x for c, i in rank.items() for x in (F.lit(c), F.lit(i))]), F.col("contig"))
    body = iv.select(F.lit(len(head)).alias("_o"), rk.alias("_rk"), "start",
                     F.concat_ws("\t", "contig", (F.col("start") + 1).cast("string"), F.col("end").cast("string"),
                                 F.lit("+"), F.coalesce(F.col("name"), F.lit("."))).alias("value"))
    allr = hdr.select("_o", F.lit(None).cast("int").alias("_rk"), F.lit(None).cast("long").alias("start"), "value") \
        .unionByName(body)
    allr.orderBy("_o", "_rk", "start").select("value").write.mode("overwrite").text(path)
    return path


def report_json_read(spark: SparkSession, path, group: str = "By Sample", multi_line: bool = True) -> DataFrame:
    """QC report JSON ({group: {section: {data: {columns: [{name}], datasets:
    [[...]]}}}}) -> long rows (file, section, row, column, value)."""
    raw = spark.read.option("multiLine", multi_line).json(path).withColumn("file", F.input_file_name())
    g = raw.select("file", F.col(f"`{group}`").alias("g"))
    sections = [f.name for f in g.schema["g"].dataType.fields]
    parts = []
    for s in sections:
        d = g.select("file", F.lit(s).alias("section"),
                     F.col(f"g.`{s}`.data.columns").alias("cols"), F.col(f"g.`{s}`.data.datasets").alias("ds"))
        rows = d.select("file", "section", "cols", F.posexplode("ds").alias("row", "vals"))
        cells = rows.select("file", "section", "row", F.posexplode("vals").alias("ci", "value"), "cols")
        parts.append(cells.select("file", "section", "row",
                                  F.element_at("cols", F.col("ci") + 1)["name"].alias("column"),
                                  F.col("value").cast("string").alias("value")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def chunk_list_read(spark: SparkSession, path, pad: int = 4) -> DataFrame:
    """Chunk rows: id, contig, input region, output region (tab or space
    separated); regions parsed to half-open coordinates, id zero-padded."""
    lines = spark.read.text(path).where(F.length(F.trim("value")) > 0)
    c = F.split(F.trim("value"), r"[\t ]+")
    d = lines.select(c[0].alias("id"), c[1].alias("contig"), c[2].alias("in_region"), c[3].alias("out_region"))
    ir, orr = K.region_parse("in_region"), K.region_parse("out_region")
    return d.select(F.lpad("id", pad, "0").alias("chunk"), "contig",
                    ir["start"].alias("in_start"), ir["end"].alias("in_end"),
                    orr["start"].alias("out_start"), orr["end"].alias("out_end"))


def header_body_split(spark: SparkSession, path) -> tuple[DataFrame, DataFrame]:
    """Annotated table with '##' meta lines and a '#'-prefixed column
    header: returns (meta lines, data rows split on tabs with the header
    names are left to the caller): returns (meta lines, header without its
    '#', body lines)."""
    lines = spark.read.text(path)
    meta = lines.where(F.col("value").startswith("##"))
    header = lines.where(F.col("value").startswith("#") & ~F.col("value").startswith("##")) \
        .select(F.regexp_replace("value", "^#", "").alias("header"))
    body = lines.where(~F.col("value").startswith("#"))
    return meta, header, body
