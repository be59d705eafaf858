"""Spelling variants by a trie of letter counts.

Words and their counts are gathered from whole texts. A word's frequency
vector holds, level by level, how often each letter group occurs in it. One
edit changes a vector by at most one count too many and one too few, so words
are arranged in a trie by successive counts, and a depth-first search from the
root spends a budget of one surplus and one deficit. Words that a leaf holds
are compared letter by letter.

The trie is cut at a depth into shards, each a branch that holds at most
``SHARD_WORDS`` words (the depth is taken from exact counts; only words that
agree in every count, anagrams, stay together beyond that). The search above
the cut is done by sending a word to every branch that its budget reaches and
that is larger than its own, so a pair of words meets in exactly one shard.
A shard searches its branch for all its words and visitors at once: a node of
the trie carries the words still alive with what is left of their budgets.
It sends on, per word, the number of near words and the best one, not pairs.

Defined results
* Null text has no words. ``doc_id`` enters the choice of a letter to drop; a
  missing doc_id counts as an empty string there.
* Lower-casing touches A-Z alone; words are case-sensitive beyond that.
* Of near words with equal counts the smallest in code-point order is the best.
* Repeated rows count as often as they occur. Extra columns are not read; an
  empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locusframe.llm.common import body, settings, stored

# Letter groups, one a level: frequent letters of European languages first, one each.
GROUPS = (*"eaionrstludcmhpgbfyvwkxzjq", "àáâãäåæç", "èéêë", "ìíîïñòóôõöø")
DROP_EVERY, MIN_CHARS, MIN_COUNT, RATIO = 31, 7, 2, 10
SHARD_WORDS = 40_000
#: A node of so few words is a leaf.
LEAF_WORDS = 16
#: Pairs at a leaf beyond which words meet by their remainders instead of one by one.
MANY_PAIRS = 1 << 16
#: Letters of a word that is compared in a matrix; longer ones are compared one by one.
SHORT = 48
#: A task's own counts are sent on when they hold about so many bytes.
COUNT_BYTES = 32 << 20
ROWS_AT_ONCE = 500
RUN = re.compile("[a-zÀ-ÿ]+")


def document_words(doc_id, text: str, drop_every: int = DROP_EVERY) -> Counter:
    """Counts of a text's lower-cased letter runs. Where ``drop_every``
    divides the checksum h of ``<doc_id>:<run>``, letter h % length goes."""
    runs = Counter(RUN.findall(text.encode().lower().decode()))  # lower() of bytes is that of ASCII
    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    out: Counter = Counter()
    for run, n in runs.items():
        h = zlib.crc32(run.encode(), start)
        if h % drop_every == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1:]
        out[run] += n
    return out


def word_counts(docs: DataFrame, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT, drop_every: int = DROP_EVERY) -> DataFrame:
    """word, n over all documents. A task adds up what it reads, in bounded memory."""
    def count(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: Counter = Counter()
        size = 0

        def sent() -> pd.DataFrame:
            return pd.DataFrame({"word": list(held), "n": list(held.values())}).astype({"word": object, "n": "int64"})

        for b in it:
            for d, t in zip(b["doc_id"], b["text"], strict=True):
                for w, n in document_words(d, t, drop_every).items():
                    if len(w) >= min_chars:
                        if w not in held:
                            size += 150 + len(w)
                        held[w] += n
                if size > COUNT_BYTES:
                    yield sent()
                    held.clear()
                    size = 0
        yield sent()

    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), body().alias("text"))
    parts = rows.mapInPandas(count, "word string, n bigint")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


def _vector(word: Column) -> Column:
    return F.array(*[(F.char_length(word) - F.char_length(F.translate(word, g, ""))).cast("int") for g in GROUPS])


def branch_depth(words: DataFrame, limit: int) -> int:
    """Levels above the cut: the fewest that leave at most ``limit`` words in every branch."""
    sizes = words.groupBy(_vector(F.col("word")).alias("v")).agg(F.count(F.lit(1)).alias("n"))
    levels = F.transform(F.sequence(F.lit(1), F.lit(len(GROUPS))), lambda k: F.slice("v", 1, k))
    most = (sizes.select(F.explode(levels).alias("p"), "n").groupBy("p").agg(F.sum("n").alias("n"))
            .groupBy(F.size("p").alias("depth")).agg(F.max("n").alias("most")))
    fit = most.filter(F.col("most") <= limit).agg(F.min("depth").alias("d")).first()["d"]
    return fit or len(GROUPS)


def shards(words: DataFrame, depth: int) -> DataFrame:
    """Words in their own branch and, as visitors, in each larger branch that
    one surplus and one deficit reach: shard, word, n, own."""
    def branch(up: int | None, down: int | None) -> Column:
        counts = [F.get("_v", F.lit(i)) + (1 if i == up else -1 if i == down else 0) for i in range(depth)]
        name = F.concat_ws(",", *counts)
        return name if down is None else F.when(counts[down] >= 0, name)

    # larger: the first count that differs is the one with more
    moves = [(i, j) for i in range(depth) for j in (None, *range(i + 1, depth))]
    reached = F.array_compact(F.array(branch(None, None), *[branch(i, j) for i, j in moves]))
    rows = words.withColumn("_v", _vector(F.col("word"))).select("word", "n", F.posexplode(reached).alias("_at", "shard"))
    return rows.select("shard", "word", "n", (F.col("_at") == 0).alias("own"))


# --- inside a shard -----------------------------------------------------------------------------

_LEVEL = np.full(256, len(GROUPS), np.int64)
for _i, _g in enumerate(GROUPS):
    _LEVEL[list(_g.encode("latin-1"))] = _i


class Words:
    """Words of a shard as vectors and, the short ones, as rows of letters."""

    def __init__(self, words: list[str]):
        raw = [w.encode("latin-1") for w in words]
        self.raw, self.length = raw, np.array([len(w) for w in raw], np.int64)
        owner = np.repeat(np.arange(len(raw)), self.length)
        level = _LEVEL[np.frombuffer(b"".join(raw), np.uint8)]
        wide = len(GROUPS) + 1  # the last column takes letters of no group
        counts = np.bincount(owner * wide + level, minlength=len(raw) * wide).reshape(-1, wide)
        self.vector = counts.astype(np.int32)
        self.odd = ((counts & 1) << np.arange(wide)).sum(1).astype(np.uint32)
        self.short = self.length <= SHORT
        self.letters = np.zeros((len(raw), SHORT + 1), np.uint8)
        for i in np.flatnonzero(self.short):
            self.letters[i, :self.length[i]] = np.frombuffer(raw[i], np.uint8)

    def near(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether words ``a`` and ``b`` (pairwise) are one edit apart."""
        swap = self.length[a] > self.length[b]
        a, b = np.where(swap, b, a), np.where(swap, a, b)
        gap = self.length[b] - self.length[a]
        out = np.zeros(len(a), bool)
        plain = self.short[a] & self.short[b]
        same = np.flatnonzero(plain & (gap == 0))
        out[same] = (self.letters[a[same]] != self.letters[b[same]]).sum(1) == 1
        more = np.flatnonzero(plain & (gap == 1))
        x, y = self.letters[a[more]], self.letters[b[more]]
        ahead = np.logical_and.accumulate(x == y, axis=1)[:, :-1]  # still equal from the left
        out[more] = (ahead | (x[:, :-1] == y[:, 1:])).all(1)
        for i in np.flatnonzero(~plain & (gap <= 1)):
            out[i] = one_edit(self.raw[a[i]], self.raw[b[i]])
        return out


def one_edit(a: bytes, b: bytes) -> bool:
    """``a`` is no longer than ``b``; exactly one letter replaced or inserted."""
    k = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    if len(a) == len(b):
        return k < len(a) and a[k + 1:] == b[k + 1:]
    return len(b) == len(a) + 1 and a[k:] == b[k + 1:]


def by_remainders(raw: list[bytes], asked: np.ndarray, held: np.ndarray) -> set[tuple[int, int]]:
    """Near pairs of a crowded leaf: words that are equal without one letter
    at one place, or where one is the other without a letter."""
    whole = {raw[w]: w for w in held.tolist()}
    rest = defaultdict(list)
    for w in held.tolist():
        for i in range(len(raw[w])):
            rest[i, raw[w][:i] + raw[w][i + 1:]].append(w)
    shorter = defaultdict(set)
    for (_, r), ws in rest.items():
        shorter[r].update(ws)
    out = set()
    for q in asked.tolist():
        for i in range(len(raw[q])):
            r = raw[q][:i] + raw[q][i + 1:]
            out.update((q, w) for w in rest.get((i, r), ()) if raw[w] != raw[q])
            if r in whole:
                out.add((q, whole[r]))
        out.update((q, w) for w in shorter.get(raw[q], ()))
    return out


def search(words: Words, held: np.ndarray, asked: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Near pairs (asked, held), by depth-first search of the trie of ``held``."""
    levels = words.vector.shape[1]
    held = held[np.lexsort(words.vector[held].T[::-1])]  # the trie: ranges of one order
    vec = words.vector
    stack = [] if not len(held) else [(0, len(held), 0, asked, np.zeros(len(asked), bool), np.zeros(len(asked), bool))]
    while stack:
        lo, hi, level, q, up, down = stack.pop()
        if hi - lo <= LEAF_WORDS or level == levels:
            yield from _leaf(words, held[lo:hi], level, q, up, down)
            continue
        col, mine = vec[held[lo:hi], level], vec[q, level]
        cuts = [0, *(np.flatnonzero(col[1:] != col[:-1]) + 1).tolist(), hi - lo]
        for a, b in zip(cuts, cuts[1:], strict=False):
            more = mine - col[a]
            stay = np.flatnonzero(((more == 0) | ((more == 1) & ~up) | ((more == -1) & ~down)))
            if len(stay):
                m = more[stay]
                stack.append((lo + a, lo + b, level + 1, q[stay], up[stay] | (m == 1), down[stay] | (m == -1)))


def _leaf(words: Words, held, level, q, up, down):
    vec = words.vector
    if len(q) * len(held) > MANY_PAIRS and len(held) > LEAF_WORDS:
        pairs = by_remainders(words.raw, q, held)
        if pairs:
            a, b = np.array(sorted(pairs), np.int64).T
            yield a, b
        return
    # a budget of one surplus and one deficit turns at most two counts from odd to even or back
    step = max(1, MANY_PAIRS // len(held))
    for at in range(0, len(q), step):
        part = slice(at, at + step)
        i, j = np.nonzero(np.bitwise_count(words.odd[q[part]][:, None] ^ words.odd[held][None, :]) <= 2)
        a, b = q[part][i], held[j]
        more = vec[a, level:] - vec[b, level:]  # the levels that the node has not spent
        ok = (up[part][i] + np.maximum(more, 0).sum(1) <= 1) & (down[part][i] - np.minimum(more, 0).sum(1) <= 1)
        a, b = a[ok], b[ok]
        hit = words.near(a, b)
        yield a[hit], b[hit]


def judge_shard(pdf: pd.DataFrame) -> pd.DataFrame:
    """Per word of a shard that has near words there: their number, and the best."""
    own = pdf["own"].to_numpy(bool)
    word = pdf["word"].tolist()
    words, n = Words(word), pdf["n"].to_numpy(np.int64)
    held = np.flatnonzero(own)
    found = [(a, b) for a, b in search(words, held, np.arange(len(own))) if len(a)]
    none = np.zeros(0, np.int64)
    a, b = (np.concatenate([none, *x]) for x in (zip(*found, strict=True) if found else ((), ())))
    visit = ~own[a]  # own words have found each other from both sides
    a, b = np.concatenate([a, b[visit]]), np.concatenate([b, a[visit]])
    place = np.empty(len(word), np.int64)
    place[sorted(range(len(word)), key=words.raw.__getitem__)] = np.arange(len(word))
    order = np.lexsort((place[b], -n[b], a))
    a, b = a[order], b[order]
    first = np.flatnonzero(np.concatenate(([True], a[1:] != a[:-1]))) if len(a) else none
    return pd.DataFrame({"word": [word[i] for i in a[first]], "n_near": np.diff(np.append(first, len(a))),
                         "best": [word[i] for i in b[first]], "best_n": n[b[first]]}).astype({"word": object, "best": object})


def near_words(words: DataFrame, shard_words: int = SHARD_WORDS) -> DataFrame:
    """Per word with near words: n_near, best (near word of largest n) and best_n."""
    dealt = shards(words, branch_depth(words, shard_words))
    found = dealt.groupBy("shard").applyInPandas(judge_shard, "word string, n_near bigint, best string, best_n bigint")
    return (found.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("less"), "best")).alias("b"))
            .select("word", "n_near", F.col("b.best").alias("best"), (-F.col("b.less")).alias("best_n")))


def _roots(forms: DataFrame, steps: int) -> DataFrame:
    """word, root for words with a form: chains of at most ``steps`` forms,
    their length halved in every round."""
    roots = forms.select("word", F.col("form").alias("root"))
    while steps > 1:
        nxt = roots.select(F.col("word").alias("root"), F.col("root").alias("_far"))
        roots = stored(roots.join(nxt, "root", "left").select("word", F.coalesce("_far", "root").alias("root")), "spelling-roots")
        steps = -(-steps // 2)
    return roots


def variants(docs: DataFrame, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT, ratio: int = RATIO,
             drop_every: int = DROP_EVERY, shard_words: int = SHARD_WORDS) -> DataFrame:
    """Per word: form (the near word it is a variant of), root, n, n_near, form_n."""
    if ratio < 2 or min_count < 1:
        raise ValueError("ratio must be at least 2 (forms are followed upwards) and min_count at least 1")
    with settings(docs.sparkSession, spark__sql__execution__arrow__maxRecordsPerBatch=str(ROWS_AT_ONCE)):
        words = stored(word_counts(docs, min_chars, min_count, drop_every), "spelling-words")
    near = near_words(words, shard_words)
    rows = words.join(near, "word", "left")
    known = F.col("best_n") >= ratio * F.col("n")
    rows = stored(rows.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
                              F.when(known, F.col("best")).alias("form"), F.when(known, F.col("best_n")).alias("form_n")), "spelling-forms")
    most = rows.agg(F.max("n").alias("n")).first()["n"] or 0
    steps = 0  # every form is at least ``ratio`` times as frequent
    while min_count * ratio ** (steps + 1) <= most:
        steps += 1
    roots = _roots(rows.filter("form IS NOT NULL"), steps)
    return rows.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
