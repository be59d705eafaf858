"""Quality by importance resampling.

Two generative models count hashed n-grams: one in the raw corpus (all
documents), one in target documents (all rows labelled good).
A document's log importance weight is the sum of its n-grams' log ratios,
divided by the root of their number (sums of long texts would drown the rest).
Gumbel noise on the log weights turns the k largest into a sample drawn
without replacement in proportion to the weights. k is the number of documents
whose weight reaches a threshold fitted on labelled rows.

An n-gram is a run of four bytes of the text (white space as one
blank), or a pair of neighbouring words, told apart by whether they are equal.

Defined results
* Null text counts as empty; an empty text has weight 0, as no n-gram speaks
  for or against it.
* Noise depends on doc_id and text alone: the same rows get the same noise in
  every run, and repeated rows stay or go together (``selected`` may then hold
  more than k rows, never fewer).
* Without labels of a kind the threshold is minus infinity: all are selected.
* Extra columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locusframe.llm.common import body, small_batches, stored
from locusframe.llm.grams import chunks, hashed, joined, mixed
from locusframe.operators.scan import prefix_scan
from locusframe.session import broadcast_checked

ORDERS, BITS = (4,), 17
SIZE = len(ORDERS) * (1 << BITS) + 2
#: Share of the rows labelled good that the threshold may cost.
GOOD_LOSS = 0.005
#: Log weights are this many times the standardised sums; more leaves less to the noise.
SHARPNESS = 10.0
SMOOTH = 1.0
LARGEST = (1 << 63) - 1


def _clean(text: str) -> bytes:
    return b" ".join(text.encode().split())


def _features(texts: list[bytes]):
    """Per group of n-grams: bucket of every place, and per text the first
    and the end place."""
    buf, starts, ends = joined(texts)
    for i, n in enumerate(ORDERS):
        h = hashed(buf, n, BITS) + i * (1 << BITS)
        yield h, starts, np.maximum(starts, ends - n + 1)
    # neighbouring words: equal or not, from a hash of each word
    blank = np.concatenate(([True], buf == 32))
    blank[starts[starts < len(blank)]] = True
    first = np.flatnonzero(blank[:-1] & (buf != 32)) if len(buf) else np.zeros(0, np.int64)
    place = mixed(np.arange(len(buf), dtype=np.uint64))
    stops = np.concatenate((first[1:], [len(buf)]))
    value = np.zeros(len(buf) + 1, np.uint64)
    inside = np.arange(len(buf)) - np.repeat(first, stops - first) if len(first) and first[0] == 0 else np.zeros(len(buf), np.int64)
    np.cumsum(np.where(buf == 32, np.uint64(0), mixed(buf.astype(np.uint64)) * (place[inside] | np.uint64(1))),
              out=value[1:], dtype=np.uint64)
    word = value[stops] - value[first]
    same = (word[1:] == word[:-1]).astype(np.int64) + len(ORDERS) * (1 << BITS)
    at, end = np.searchsorted(first, starts), np.searchsorted(first, ends)
    yield same, np.minimum(at, len(same)), np.clip(end - 1, np.minimum(at, len(same)), len(same))


def _counts(texts: list[bytes]) -> np.ndarray:
    out = np.zeros(SIZE, np.int64)
    for a, b in chunks(texts):
        for h, at, end in _features(texts[a:b]):
            use = np.zeros(len(h) + 1, np.int64)
            np.add.at(use, at, 1)
            np.add.at(use, end, -1)
            out += np.bincount(h[np.cumsum(use)[:-1] > 0], minlength=SIZE)
    return out


def log_weights(texts: list[bytes], ratio: np.ndarray) -> np.ndarray:
    """Per text the sum of its n-grams' log ratios over the root of their
    number, which makes long and short texts comparable, times SHARPNESS."""
    out, n = np.zeros(len(texts)), np.zeros(len(texts))
    for a, b in chunks(texts):
        for h, at, end in _features(texts[a:b]):
            run = np.concatenate(([0.0], np.cumsum(ratio[h])))
            out[a:b] += run[end] - run[at]
            n[a:b] += end - at
    return SHARPNESS * out / np.sqrt(np.maximum(n, 1))


def _labelled(labels: DataFrame, quality: int) -> DataFrame:
    return labels.filter(F.col("quality") == quality).select("doc_id").dropna().distinct()


def fit_ratio(docs: DataFrame, labels: DataFrame) -> np.ndarray:
    """Log ratio per n-gram bucket of target and raw probabilities."""
    target = broadcast_checked(_labelled(labels, 1).withColumn("target", F.lit(True)))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        raw, tgt = np.zeros(SIZE, np.int64), np.zeros(SIZE, np.int64)
        for b in batches:
            texts, of = [_clean(t) for t in b["text"]], b["target"].eq(True).to_numpy(bool)
            raw += _counts(texts)
            tgt += _counts([t for t, o in zip(texts, of, strict=True) if o])
        at = np.flatnonzero(raw)
        yield pd.DataFrame({"bucket": at, "raw": raw[at], "tgt": tgt[at]})

    rows = docs.select("doc_id", body().alias("text")).join(target, "doc_id", "left").select("text", "target")
    sums = (rows.mapInPandas(run, "bucket bigint, raw bigint, tgt bigint")
            .groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("tgt").alias("tgt")))
    with small_batches(docs.sparkSession):
        got = sums.toPandas()  # SIZE rows at most
    raw, tgt = np.zeros(SIZE), np.zeros(SIZE)
    raw[got["bucket"]], tgt[got["bucket"]] = got["raw"], got["tgt"]
    ratio = np.zeros(SIZE)
    groups = [slice(i << BITS, (i + 1) << BITS) for i in range(len(ORDERS))] + [slice(SIZE - 2, SIZE)]
    for g in groups:
        if not tgt[g].sum():
            continue
        p, q = tgt[g] + SMOOTH * raw[g] / max(1.0, raw[g].mean()), raw[g] + SMOOTH
        ratio[g] = np.log(np.maximum(p, 1e-9) / p.sum()) - np.log(q / q.sum())
    return np.clip(ratio, -5, 5)


def weigh(docs: DataFrame, ratio: np.ndarray) -> DataFrame:
    """doc_id, key, log_weight and gumbel_key (weight plus noise)."""
    model = docs.sparkSession.sparkContext.broadcast(ratio)  # SIZE numbers, whatever the input

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"doc_id": b["doc_id"], "key": b["key"], "seed": b["seed"],
                                "log_weight": log_weights([_clean(t) for t in b["text"]], model.value)})

    kind = docs.schema["doc_id"].dataType.simpleString()
    out = (docs.select("doc_id", F.sha2(body(), 256).alias("key"), F.xxhash64("doc_id", body()).alias("seed"),
                       body().alias("text"))
           .mapInPandas(run, f"doc_id {kind}, key string, seed bigint, log_weight double"))
    u = (F.shiftrightunsigned("seed", 11) + 0.5) / float(1 << 53)
    return out.withColumn("gumbel_key", F.col("log_weight") - F.log(-F.log(u)))


def fit_threshold(weighed: DataFrame, labels: DataFrame, loss: float = GOOD_LOSS) -> float:
    """The weight that separates all labelled rows best among those that cost
    at most ``loss`` of the good ones: between two neighbouring weights, or
    the smallest. Spark adds up what lies below each weight."""
    kinds = [weighed.join(broadcast_checked(_labelled(labels, q)), "doc_id", "left_semi")
             .select("log_weight", F.lit(1 - q).alias("bad"), F.lit(q).alias("good")) for q in (0, 1)]
    seen = stored(kinds[0].unionByName(kinds[1]).groupBy("log_weight").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
                  .withColumn("slice", F.floor(F.col("log_weight") * 8)), "labelled-weights")
    total = seen.agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")).first()
    if not total["bad"] or not total["good"]:
        return float("-inf")
    below = prefix_scan(seen, [], ["slice"], ["log_weight"], F.col("bad"), inclusive=False, out="caught")
    below = prefix_scan(below, [], ["slice"], ["log_weight"], F.col("good"), inclusive=False, out="lost")
    lost = F.col("lost") / total["good"]
    best = (below.filter(lost <= loss).orderBy((F.col("caught") / total["bad"] - lost).desc(), "log_weight")
            .select("log_weight").first()["log_weight"])
    last = seen.filter(F.col("log_weight") < best).agg(F.max("log_weight")).first()[0]
    return float(best if last is None else (best + last) / 2)


def _ordered(c) -> Column:
    """A number to the millionth as a non-negative long; larger stays larger."""
    return F.floor((F.greatest(F.lit(-1e12), F.least(F.lit(1e12), c)) + 1e12) * 1e6).cast("long")


def kth_largest(rows: DataFrame, col: str, k: int) -> int:
    """The k-th largest of ``_ordered(col)``, by narrowing its bits 14 at a
    time: a few grouped counts, no sort."""
    bits = rows.select(_ordered(F.col(col)).alias("_bits"))
    low = 0
    for shift, width in ((50, 14), (36, 14), (22, 14), (8, 14), (0, 8)):
        here = bits.filter(F.shiftright("_bits", shift + width) == (low >> (shift + width))) if low or shift < 50 else bits
        part = F.shiftright("_bits", shift).bitwiseAND(F.lit((1 << width) - 1))
        for r in here.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("p")).collect():
            if r["n"] >= k:
                low |= int(r["p"]) << shift
                break
            k -= r["n"]
    return low


def select(docs: DataFrame, labels: DataFrame, keyed: bool = False) -> DataFrame:
    """doc_id, log_weight, gumbel_key, selected: the Gumbel top-k; with
    ``keyed`` also ``key``, the sha256 of the text."""
    ratio = fit_ratio(docs, labels)
    rows = stored(weigh(docs, ratio), "weights")
    bar = fit_threshold(rows, labels)
    k = rows.filter(F.col("log_weight") >= bar).count()
    cut = kth_largest(rows, "gumbel_key", k) if k else LARGEST
    return rows.select("doc_id", *["key"] * keyed, "log_weight", "gumbel_key",
                       (_ordered(F.col("gumbel_key")) >= cut).alias("selected"))
