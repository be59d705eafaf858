"""Token counts by scanning flat token files for separators.

A token file is nothing but unsigned 16-bit ids, documents one after another,
each closed by an end-of-document id; there is no index. The scan looks at
blocks of a file, finds the separators of a block in one vector operation,
and stitches documents across block boundaries with prefix scans over the
blocks: counts of separators give the ordinals, the last separator seen so far
gives the start of a block's first document.

``write_token_files`` makes such files with Spark's own writer, on whatever
file system the session can reach. It opens a document with its doc_id as five
digits of base 50000, so counts can be told apart without an index.

Defined results
* Null text counts as empty: no tokens between header and separator.
* A document after the last separator of a file is reported with closed false.
* Null doc_ids come back null; repeated rows are documents of their own. Extra
  columns are not read; an empty table or file gives no rows.
* A file must fit the reader's 2 GB; a larger corpus has more files.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from locusframe.llm.common import body, settings, small_batches
from locusframe.llm.tokenise import load

END_ID = 50256
BASE, DIGITS = 50_000, 5
NO_ID = BASE ** DIGITS - 1
BLOCK_TOKENS = 1 << 20


def _header(doc_id) -> bytes:
    v = NO_ID if pd.isna(doc_id) else int(doc_id) % (1 << 64)
    return np.array([v // BASE ** i % BASE for i in range(DIGITS)], "<u2").tobytes()


def write_token_files(docs: DataFrame, path: str, folder: str, end_id: int = END_ID) -> None:
    """Writes the documents' ids under ``folder``, one file per task. Strings
    of special tokens are ordinary text, so ``end_id`` only ends documents."""
    with open(path, encoding="utf-8") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())  # one vocabulary file

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = load(spec.value, plain_specials=True).encode
        for b in batches:
            ids = [_header(d) + np.frombuffer(encode(t), "<u4").astype("<u2").tobytes()
                   for d, t in zip(b["doc_id"], b["text"], strict=True)]
            yield pd.DataFrame({"ids": ids})

    tokens = docs.select("doc_id", body().alias("text")).mapInPandas(run, "ids binary")
    # the writer puts the bytes out as they are; its line separator is the end id
    with small_batches(docs.sparkSession):
        (tokens.select(F.col("ids").cast("string").alias("value")).write.option("encoding", "ISO-8859-1")
         .option("lineSep", int(end_id).to_bytes(2, "little").decode("latin-1")).text(folder))


def scan(ids: np.ndarray, end_id: int = END_ID, block: int = BLOCK_TOKENS) -> tuple[np.ndarray, np.ndarray, bool]:
    """Start and length of each document in a file's ids (an open last one
    included), and whether the last one is closed."""
    blocks = range(0, len(ids), block)
    found = [np.flatnonzero(ids[a:a + block] == end_id) + a for a in blocks]
    counts = np.array([len(f) for f in found], np.int64)
    first = np.cumsum(counts) - counts  # ordinal of the first document that ends in the block
    last = np.maximum.accumulate(np.array([f[-1] if len(f) else -1 for f in found], np.int64))
    into = np.concatenate(([-1], last[:-1])) if len(last) else last  # separator before the block
    ends = np.empty(int(counts.sum()), np.int64)
    starts = np.empty_like(ends)
    for f, n, i, s in zip(found, counts.tolist(), first.tolist(), into.tolist(), strict=True):
        if n:
            ends[i:i + n] = f
            starts[i] = s + 1
            starts[i + 1:i + n] = f[:-1] + 1
    at = int(last[-1]) + 1 if len(last) else 0
    closed = at == len(ids)
    if not closed:
        starts, ends = np.append(starts, at), np.append(ends, len(ids))
    return starts, ends - starts, closed


def count_tokens(spark: SparkSession, folder: str, end_id: int = END_ID, block: int = BLOCK_TOKENS,
                 header: bool = True) -> DataFrame:
    """Per document of every token file: doc_id, file, ordinal, start (in the
    file, header included), n_tokens (without header and separator), closed."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for name, content in zip(b["path"], b["content"], strict=True):
                ids = np.frombuffer(content, "<u2")
                starts, lengths, closed = scan(ids, end_id, block)
                n = len(starts)
                doc = np.zeros(n, object)
                if header:
                    digits = ids[np.minimum(starts[:, None] + np.arange(DIGITS), len(ids) - 1)].astype(object)
                    doc = sum((digits[:, i] * BASE ** i for i in range(DIGITS)), doc)
                    lengths = lengths - DIGITS
                yield pd.DataFrame({
                    "doc_id": pd.array([None if not header or v == NO_ID else int(v) - (int(v) >> 63 << 64)
                                        for v in doc], "Int64"),
                    "file": name.rsplit("/", 1)[-1], "ordinal": np.arange(n), "start": starts, "n_tokens": lengths,
                    "closed": np.arange(n) < n - (not closed)})

    with settings(spark, spark__sql__execution__arrow__maxRecordsPerBatch="1"):
        files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder).select("path", "content")
        return files.mapInPandas(
            run, "doc_id bigint, file string, ordinal bigint, start bigint, n_tokens bigint, closed boolean")
