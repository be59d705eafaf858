"""Word statistics over document text (whole texts, distributed explode +
aggregate; medians come from a length histogram, never from a global sort
or a collected list)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from locusframe.operators.scan import row_index

# Separators and the characters stripped from word ends.
WORD_SPLIT = r"(?U)[\s-]"
STRIP_CHARS = ".,();:"
# The plural list whose final 's' is dropped.
PLURALS = ["biobanks", "variants", "drivers", "associations", "drivers", "exomes", "algorithms",
           "scripts", "genotypes", "gvcfs", "practices", "dimensions", "points", "costs",
           "demographics"]
# The stop words left out of the mean word length.
STOP_WORDS = ["the", "an", "a", "as", "to", "of", "and", "then", "in", "for", "we", "are"]


def words(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per word: split on whitespace and '-', strip ``.,();:`` from
    both ends, lower-case, drop empties."""
    raw = docs.select(*keep, F.explode(F.split(F.col(text), WORD_SPLIT)).alias("_w"))
    w = raw.select(*keep, F.lower(F.btrim(F.col("_w"), F.lit(STRIP_CHARS))).alias("word"))
    return w.where(F.length("word") > 0)


def singularize(w: DataFrame, plurals: list[str] = PLURALS, col: str = "word") -> DataFrame:
    """Drop the final character of words in ``plurals``."""
    c = F.col(col)
    return w.withColumn(col, F.when(c.isin(*plurals), F.expr(f"substring({col}, 1, length({col}) - 1)"))
                        .otherwise(c))


def word_count(w: DataFrame, col: str = "word") -> DataFrame:
    return w.groupBy(col).agg(F.count(F.lit(1)).alias("n"))


def count_spectrum(wc: DataFrame) -> DataFrame:
    """Inverse view: for each count, how many distinct words have it and the
    total characters in them (no per-count word lists are collected)."""
    return wc.groupBy("n").agg(F.count(F.lit(1)).alias("n_words"),
                               F.sum(F.length("word")).cast("long").alias("n_chars"))


def words_by_count(wc: DataFrame, chunk: int = 1000) -> DataFrame:
    """The inverse of a word count: (n, chunk, words), words of one count in
    order, in lists of at most ``chunk`` words; most words share the count
    of one, so a count alone would be one huge group."""
    placed = row_index(wc.withColumn("_head", F.substring("word", 1, 2)), ["n"], ["_head"], ["word"], "_at")
    g = placed.groupBy("n", F.floor(F.col("_at") / chunk).cast("long").alias("chunk"))
    return g.agg(F.sort_array(F.collect_list("word")).alias("words"))


def length_median_mass(w: DataFrame, col: str = "word") -> DataFrame:
    """Median word length (numpy convention: mean of the two middle values
    for an even count) and total characters in words whose length is equal
    to, under and over the median.  Works on the length histogram (one row
    per distinct length), so nothing grows with the number of words."""
    hist = w.groupBy(F.length(col).alias("len")).agg(F.count(F.lit(1)).alias("cnt"))
    win = Window.orderBy("len").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    h = hist.withColumns({"cum": F.sum("cnt").over(win), "tot": F.sum("cnt").over(Window.partitionBy())})
    lo_rank = F.floor((F.col("tot") + 1) / 2)
    hi_rank = F.floor(F.col("tot") / 2) + 1
    h = h.withColumns({"_lo": F.when(F.col("cum") >= lo_rank, F.col("len")),
                       "_hi": F.when(F.col("cum") >= hi_rank, F.col("len"))})
    whole = Window.partitionBy()
    h = h.withColumn("median_len", (F.min("_lo").over(whole) + F.min("_hi").over(whole)) / 2.0)
    lc = F.col("len") * F.col("cnt")
    return h.agg(F.first("median_len").alias("median_len"),
                 F.sum(F.when(F.col("len") == F.col("median_len"), lc).otherwise(0)).cast("long").alias("chars_equal"),
                 F.sum(F.when(F.col("len") < F.col("median_len"), lc).otherwise(0)).cast("long").alias("chars_under"),
                 F.sum(F.when(F.col("len") > F.col("median_len"), lc).otherwise(0)).cast("long").alias("chars_over"))


def mean_length_excluding(wc: DataFrame, stop: list[str] = STOP_WORDS) -> DataFrame:
    """Number of word occurrences and their mean length, stop words left out."""
    k = wc.where(~F.col("word").isin(*stop))
    return k.agg(F.sum("n").cast("long").alias("n_words"),
                 (F.sum(F.col("n") * F.length("word")) / F.sum("n")).alias("mean_len"))


def longest_words(wc: DataFrame, count: int = 1, k: int = 20) -> DataFrame:
    """Words seen exactly ``count`` times, longest first (ties by word), top k."""
    return (wc.where(F.col("n") == count)
            .select("word", F.length("word").alias("len"))
            .orderBy(F.desc("len"), F.asc("word")).limit(k))
