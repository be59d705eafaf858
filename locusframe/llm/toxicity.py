"""Toxicity by subword-bag embeddings averaged into a linear softmax.

A word is the bag of its byte n-grams (word boundaries included), hashed into
rows of one embedding table; its vector is their mean. A span of a few words
is the mean of its words, and a linear softmax over two classes reads it. A
text is as toxic as its most toxic span, so a long text does not dilute one
insult. Embeddings and softmax are trained jointly in numpy on a bounded
sample of labelled rows; a misspelt word shares most n-grams with the word.

As the class score is linear in the embeddings, scoring needs one number per
bucket, which is what is sent to the tasks.

Defined results
* Null text counts as empty; a text without words gets the bias alone.
* Scores depend on the text alone: equal texts have equal scores.
* Without training rows of both classes, or words in them, every score is the share of class 1
  among the training rows (0 if there are none).
* Rows repeat as they come; extra columns are not read; an empty table gives
  no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locusframe.llm.common import body
from locusframe.llm.grams import chunks, hashed

ORDERS, BITS, DIM = (4, 5, 6), 18, 4
SPAN = 4
#: Training rows of each class at most.
TOXIC_ROWS, CLEAN_ROWS = 1_000, 2_000
EPOCHS, RATE, DECAY, SEED = 40, 0.3, 1e-4, 7


def _buffer(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased words, one blank before each and one at the end, of all
    texts; and the number of words of each text."""
    words = [t.lower().encode().split() for t in texts]
    flat = b" " + b"".join(w + b" " for ws in words for w in ws)
    return np.frombuffer(flat, np.uint8), np.array([len(w) for w in words], np.int64)


def _grams(buf: np.ndarray):
    """Per order: bucket of each place whose n bytes lie within one word and
    the blanks around it, and the number of that word."""
    blank = buf == 32
    seen = np.cumsum(blank)
    for n in ORDERS:
        if len(buf) < n:
            continue
        h = hashed(buf, n, BITS)
        end = len(h)
        # blanks strictly between the first and the last byte
        inner = seen[n - 2:n - 2 + end] - seen[:end] if n > 2 else np.zeros(end, np.int64)
        at = np.flatnonzero(inner == 0)
        yield h[at], seen[at] - 1


def word_scores(buf: np.ndarray, words: int, weight: np.ndarray) -> np.ndarray:
    """Mean weight of each word's n-grams; 0 for a word too short to have any."""
    total, count = np.zeros(words), np.zeros(words)
    for h, word in _grams(buf):
        total += np.bincount(word, weight[h], words)[:words]
        count += np.bincount(word, minlength=words)[:words]
    return total / np.maximum(count, 1)


def _spans(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and length of each span: every run of SPAN words, or the whole of
    a shorter text; and the first span of each text that has words."""
    per = np.where(sizes > 0, np.maximum(sizes - SPAN + 1, 1), 0)
    first = np.cumsum(sizes) - sizes
    return (np.repeat(first, per) + _ramp(per), np.repeat(np.minimum(sizes, SPAN), per),
            (np.cumsum(per) - per)[sizes > 0])


def _means(scores: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Mean of each span; a running sum would round by a word's place in the buffer."""
    total = np.zeros(len(start))
    for i in range(SPAN):
        total += np.where(i < length, scores[np.minimum(start + i, len(scores) - 1)], 0)
    return total / length


def most_toxic(scores: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Per text the largest span mean; 0 for a text without words."""
    out = np.zeros(len(sizes))
    if len(scores):
        start, length, text = _spans(sizes)
        out[sizes > 0] = np.maximum.reduceat(_means(scores, start, length), text)
    return out


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


class ToxicityModel:
    """``weight`` per bucket and ``bias``: the log odds of class 1."""

    def __init__(self, weight: np.ndarray, bias: float):
        self.weight, self.bias = weight, bias

    def score(self, texts: list[str]) -> np.ndarray:
        out = []
        for a, b in chunks(texts):
            buf, sizes = _buffer(texts[a:b])
            out.append(_sigmoid(most_toxic(word_scores(buf, int(sizes.sum()), self.weight), sizes) + self.bias))
        return np.concatenate([np.zeros(0), *out])


def train(texts: list[str], labels: np.ndarray, epochs: int = EPOCHS, seed: int = SEED) -> ToxicityModel:
    """Joint training of embeddings and softmax by Adagrad. In each epoch a
    text is represented by the span that scores highest at the time."""
    y = np.asarray(labels, float)
    size = 1 << BITS
    if not len(y) or y.min() == y.max() or not any(t.split() for t in texts):
        share = float(y.mean()) if len(y) else 0.0
        return ToxicityModel(np.zeros(size), float(np.log(max(share, 1e-12) / max(1 - share, 1e-12))))
    # each different word once; ``code`` says which word stands at each place
    lists = [t.lower().encode().split() for t in texts]
    sizes = np.array([len(x) for x in lists], np.int64)
    code, different = pd.factorize(np.array([w for x in lists for w in x], object))
    words, different = len(different), list(different)
    del lists
    grams = list(_grams(np.frombuffer(b" " + b"".join(w + b" " for w in different), np.uint8)))
    # start: how much more often a bucket is met in texts of class 1
    of = np.repeat(np.arange(len(texts)), sizes)
    met = np.unique(of * max(words, 1) + code)
    seen = [np.bincount((met % max(words, 1))[y[met // max(words, 1)] == c], minlength=words) for c in (0, 1)]
    freq = [sum((np.bincount(h, n[w], size) for h, w in grams), np.zeros(size)) for n in seen]
    odds = np.log((freq[1] + 1) / (freq[1].sum() + size)) - np.log((freq[0] + 1) / (freq[0].sum() + size))
    rng = np.random.default_rng(seed)
    emb = rng.normal(0, 0.01, (size, DIM))
    emb[:, 0] += odds
    soft = rng.normal(0, 0.1, (DIM, 2))
    soft[0] += (-0.5, 0.5)
    bias = np.zeros(2)
    sums = [np.full(a.shape, 1e-6) for a in (emb, soft, bias)]
    start, length, text = _spans(sizes)
    some = sizes > 0
    # n-grams in order of their word, to cut out a span's quickly
    h = np.concatenate([np.zeros(0, np.int32), *(x.astype(np.int32) for x, _ in grams)])
    w = np.concatenate([np.zeros(0, np.int32), *(x.astype(np.int32) for _, x in grams)])
    del grams, met, of
    order = np.argsort(w, kind="stable")
    h, w = h[order], w[order]
    count = np.bincount(w, minlength=words)[:words]
    begin = np.cumsum(count) - count
    share = np.clip(y[some].mean(), 1e-9, 1 - 1e-9)
    balance = np.where(y[some] == 1, 0.5 / share, 0.5 / (1 - share))
    for _ in range(epochs):
        weight = emb @ (soft[:, 1] - soft[:, 0])
        run = np.concatenate(([0.0], np.cumsum(weight[h])))
        score = ((run[begin + count] - run[begin]) / np.maximum(count, 1))[code]
        mean = _means(score, start, length)
        top = np.maximum.reduceat(mean, text)
        owner = np.repeat(np.arange(len(text)), np.diff(np.append(text, len(mean))))
        hit = np.flatnonzero(mean == top[owner])
        best = hit[np.unique(owner[hit], return_index=True)[1]]  # first span with the largest mean
        # the chosen spans' n-grams, each with its share in the span's mean
        word = code[np.repeat(start[best], length[best]) + _ramp(length[best])]
        span = np.repeat(np.arange(len(best)), length[best])
        gram = np.repeat(begin[word], count[word]) + _ramp(count[word])
        share = np.repeat(1.0 / (length[best][span] * np.maximum(count[word], 1)), count[word])
        row = np.repeat(span, count[word])
        bucket = h[gram]
        vec = np.stack([np.bincount(row, emb[bucket, d] * share, len(best)) for d in range(DIM)], axis=1)
        logit = vec @ soft + bias
        p = np.exp(logit - logit.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        err = (p - np.stack([1 - y[some], y[some]], axis=1)) * (balance / len(best))[:, None]
        back = err @ soft.T
        used, place = np.unique(bucket, return_inverse=True)
        g_emb = np.stack([np.bincount(place, back[row, d] * share, len(used)) for d in range(DIM)], axis=1)
        g_emb += DECAY * emb[used] / len(best)
        for p_, g, s, at in ((emb, g_emb, sums[0], used), (soft, vec.T @ err, sums[1], slice(None)),
                             (bias, err.sum(axis=0), sums[2], slice(None))):
            s[at] += g * g
            p_[at] -= RATE * g / np.sqrt(s[at])
    return ToxicityModel(emb @ (soft[:, 1] - soft[:, 0]), float(bias[1] - bias[0]))


def _ramp(sizes: np.ndarray) -> np.ndarray:
    """0, 1, ... up to each size, one after another."""
    return np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def held_out(doc_id="doc_id"):
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0


def training_rows(docs: DataFrame, labels: DataFrame, toxic: int = TOXIC_ROWS, clean: int = CLEAN_ROWS) -> pd.DataFrame:
    """text and label of at most so many labelled rows of each class, none of
    them held out, chosen by a hash of the id."""
    known = (labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    picked = [known.filter(F.col("toxic") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
              for c, n in ((1, toxic), (0, clean))]
    ids = F.broadcast(picked[0].unionByName(picked[1]))  # at most toxic + clean ids
    one = docs.select("doc_id", body().alias("text")).join(ids, "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
    return one.orderBy("doc_id").toPandas()


def score(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """doc_id, score of every text."""
    shared = docs.sparkSession.sparkContext.broadcast((model.weight.astype(np.float32), model.bias))  # 2^BITS numbers

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        weight, bias = shared.value
        m = ToxicityModel(weight, bias)
        for b in batches:
            yield pd.DataFrame({"doc_id": b["doc_id"], "score": m.score(b["text"].tolist())})

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", body().alias("text")).mapInPandas(run, f"doc_id {kind}, score double")


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    rows = training_rows(docs, labels)
    model = train(rows["text"].tolist(), rows["toxic"].to_numpy())
    return score(docs, model).select("doc_id", held_out().alias("held_out"), "score",
                                     (F.col("score") >= 0.5).cast("int").alias("predicted"))
