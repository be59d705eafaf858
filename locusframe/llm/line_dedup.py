"""Line deduplication over whole texts.

Every text is split at ``\\n`` and its lines are exploded with their positions.
A line's key is the line without blanks (``[\\x20\\x09-\\x0D]``) at both ends, A-Z
lower-cased; it travels as the first 128 bits of its SHA-256. Distinct documents
are counted per hash, and a hash that at least ``min_docs`` documents hold marks
its lines in all of them but the first. The marked positions come back to their
document, which is put together again from the lines between them. Texts move
once, in that last join; before it only hashes do. Built-in functions only.

Defined results
* Null or empty text is one empty line. A line that stays keeps its blanks and
  case; a text whose lines all go becomes empty.
* Keys under ``min_chars`` code points are never dropped. Equal lines of one
  document count as one document and share one fate.
* Rows with one doc_id are one document, whatever their texts; rows without
  doc_id together are one document, larger than any other.
* Extra columns of the input are not read; an empty table gives no rows.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locusframe.llm.common import body, lookup, stored

MIN_CHARS, MIN_DOCS = 10, 2
BLANKS = " \t\x0b\x0c\r\n"


def _lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, nothing else: ``lower`` does that where all is ASCII."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def _bound(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once: an expression named inside
    a lambda is otherwise evaluated anew for every element."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _document(docs: DataFrame) -> DataFrame:
    """doc_id, text, and the row's key: rows equal in both share it."""
    row = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.lit(":"), body())
    return docs.select("doc_id", body().alias("text"), F.unhex(F.sha2(row, 256)).alias("key"))


def line_hashes(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """A row per line whose key is long enough: doc_id, key (of the row),
    pos (of the line) and hash."""
    lines = F.split(_lower_ascii(F.col("text")), "\n", -1)

    def hashed(line: Column) -> Column:
        return _bound(F.btrim(line, F.lit(BLANKS)), lambda k: F.when(
            F.char_length(k) >= min_chars, F.substring(F.unhex(F.sha2(k, 256)), 1, 16)))

    rows = _document(docs).select("doc_id", "key", F.posexplode(F.transform(lines, hashed)).alias("pos", "hash"))
    return rows.filter("hash IS NOT NULL")


def repeated(lines: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """Per hash that at least ``min_docs`` documents hold: first (the smallest
    document), and weight, the number of its lines. Lines of a document are
    added up before documents are counted, so a hot line sends one row a task."""
    order = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id")
    return (lines.groupBy("hash", "doc_id").agg(F.count(F.lit(1)).alias("n"))
            .groupBy("hash").agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("weight"), F.min(order).alias("first"))
            .filter(F.col("docs") >= min_docs).select("hash", "weight", "first"))


def _without(lines: Column, gone: Column) -> Column:
    """Lines outside the ascending positions ``gone``, joined again: the runs
    between two of them, so a text is passed over once."""
    def run(i: Column) -> Column:
        start = F.coalesce(F.get(gone, i - 1) + 1, F.lit(0))
        return F.slice(lines, start + 1, F.coalesce(F.get(gone, i), F.size(lines)) - start)

    return F.array_join(F.flatten(F.transform(F.sequence(F.lit(0), F.size(gone)), run)), "\n")


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """Per row: doc_id, n_lines, dropped (positions, ascending), kept (text)."""
    lines = stored(line_hashes(docs, min_chars), "line-hashes")
    facts = repeated(lines, min_docs)
    found = lookup(lines, facts, "hash", "weight", lines.agg(F.count(F.lit(1)).alias("total")))
    marked = (found.filter(F.col("first").isNotNull() & ~F.col("first.doc_id").eqNullSafe(F.col("doc_id")))
              .groupBy("key").agg(F.sort_array(F.collect_set("pos")).alias("dropped"), F.count(F.lit(1)).alias("n")))
    # each copy of a row marks every position once
    marked = stored(marked.withColumn("n", F.expr("n div size(dropped)")), "line-drops")
    rows = lookup(_document(docs), marked, "key", "n", docs.agg(F.count(F.lit(1)).alias("total")))
    text, gone = F.col("text"), F.col("dropped")
    split = F.split(text, "\n", -1)
    kept = F.when(gone.isNull(), text).otherwise(_bound(split, lambda x: _without(x, gone)))
    none = F.expr("cast(array() as array<int>)")
    return rows.select("doc_id", F.size(split).cast("long").alias("n_lines"), F.coalesce(gone, none).alias("dropped"), kept.alias("kept"))
