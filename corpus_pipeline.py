"""The corpus pipeline: quality, exact copies, near copies, repeated passages,
packing. Each stage reads all that the stage before kept.

Null text counts as empty throughout; a row without doc_id is treated by its
text alone (repeated rows share one fate, but an exact copy always leaves one
row). Extra columns of the documents are carried to the last stage, whatever
their names: helper columns take names that the documents do not have. Every
stage gives an empty table for an empty table.
``ORACLE_SQL`` is None: n-gram models, SimHash components and token ids are
beyond SQL; tests/llm holds the stages against brute force.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from locusframe.llm import exact_dedup, importance, packing, simhash, suffix_dedup
from locusframe.llm.common import body, stored, table

def _free(docs: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``docs`` has it."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def _chosen(docs: DataFrame, found: DataFrame, how: str) -> DataFrame:
    """``docs`` joined with ``found`` (doc_id, key: digest of a text, and
    more) on both, null ids included; its columns get names of their own."""
    names = {c: _free(docs, f"_found_{c}") for c in found.columns}
    key = F.sha2(body(), 256)
    other = found.select(*[F.col(c).alias(n) for c, n in names.items()])
    return docs.join(other, (key == F.col(names["key"])) & F.col("doc_id").eqNullSafe(F.col(names["doc_id"])), how)


def _one_each(docs: DataFrame, found: DataFrame) -> DataFrame:
    """The rows of ``found``, once each: several rows may share doc_id and text."""
    key = _free(docs, "_text_key")
    rows = _chosen(docs, found, "left_semi").withColumn(key, F.sha2(body(), 256))
    return rows.dropDuplicates(["doc_id", key]).select(*docs.columns)


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling selects."""
    chosen = importance.select(docs, table(spark, sf_dir, "labels"), keyed=True)
    dropped = chosen.filter(~F.col("selected")).select("doc_id", "key").distinct()
    return _chosen(docs, dropped, "left_anti").select(*docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts: that with the largest doc_id."""
    kept = exact_dedup.exact_dedup(docs).filter("kept").select("doc_id", F.col("text_sha256").alias("key"))
    return _one_each(docs, kept)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component: that with the smallest doc_id
    (a null doc_id is larger than any other, ties go by the text's digest)."""
    near = simhash.near_duplicates(docs)
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "key"))
    return _one_each(docs, near.groupBy("label").agg(first.alias("x")).select("x.doc_id", "x.key"))


def cut_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that an earlier document has. A character
    that a passage covers in part stays whole."""
    cut = suffix_dedup.remove_repeats(docs, texts=False).filter("n_removed > 0").select("doc_id", "key", "spans")
    found = _chosen(docs, cut.dropDuplicates(["doc_id", "key"]), "left")
    spans = F.col(_free(docs, "_found_spans"))
    raw = body().cast("binary")
    # spans widen inward to whole characters: continuation bytes are 0x80 to 0xBF
    pairs = F.sequence(F.lit(0), F.size(spans) - 2, F.lit(2))

    def continuation(at):
        octet = F.conv(F.hex(F.substr(raw, at + 1, F.lit(1))), 16, 10).cast("int")
        return octet.between(0x80, 0xBF)

    def forward(at):
        return (F.when(~F.coalesce(continuation(at), F.lit(False)), at).when(~F.coalesce(continuation(at + 1), F.lit(False)), at + 1)
                .when(~F.coalesce(continuation(at + 2), F.lit(False)), at + 2).otherwise(at + 3))

    def back(at):
        return (F.when(~F.coalesce(continuation(at), F.lit(False)), at).when(~F.coalesce(continuation(at - 1), F.lit(False)), at - 1)
                .when(~F.coalesce(continuation(at - 2), F.lit(False)), at - 2).otherwise(at - 3))

    cuts = _free(docs, "_whole")
    found = found.withColumn(cuts, F.when(spans.isNotNull(), F.transform(
        pairs, lambda i: F.struct(forward(F.get(spans, i)).alias("a"), back(F.get(spans, i + 1)).alias("b")))))
    whole = F.col(cuts)
    # the pieces between two cuts meet as hex text: one pass over them, however many there are
    gaps = F.transform(F.sequence(F.lit(0), F.size(whole)), lambda i: F.hex(F.substr(
        raw, F.coalesce(F.get(whole, i - 1)["b"], F.lit(0)) + 1,
        F.coalesce(F.get(whole, i)["a"], F.octet_length(body())) - F.coalesce(F.get(whole, i - 1)["b"], F.lit(0)))))
    kept = F.unhex(F.array_join(gaps, "")).cast("string")
    out = found.withColumn("text", F.when(spans.isNotNull(), kept).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(spans.isNotNull(), F.char_length("text").cast(
            docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document's tokens lies in the training sequences."""
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", keep_quality),
    ("exact copies", drop_copies),
    ("near copies", drop_near_copies),
    ("passages", cut_passages),
    ("packing", pack),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
