"""Best-fit packing by patterns from non-negative least squares.

The histogram of piece lengths is all the planning needs. Patterns of up to
three lengths that fill a sequence exactly are enumerated; non-negative least
squares fits how often each is used; the counts are rounded down to what the
histogram holds, and what is left is packed best-fit, longest first. The plan
says, per length, which ranks go to which slot of which sequences; Spark
numbers the pieces of each length and looks their slot up.

Defined results
* Null text counts as empty; an empty document is its end token alone.
* A document longer than ``max_len`` is cut into pieces of ``max_len`` tokens,
  the first of which may be shorter; others are never cut.
* Repeated rows are packed once each. Extra columns are not read. An empty
  table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from locusframe.llm.common import body, stored
from locusframe.llm.tokenise import load

MAX_LEN, END_ID = 1024, 2
#: Lengths are planned in steps of so many tokens (rounded up).
STEP = 2
#: Shares of the fitted counts that are tried; what is not used is packed best-fit.
SHARES = (1.0, 0.75, 0.5, 0.25)
#: Lengths under 1/SHORT of a sequence are in no pattern: they fill what gaps remain.
SHORT = 8
GROUP_ROWS = 20_000


def token_pieces(docs: DataFrame, path: str, max_len: int = MAX_LEN, end_id: int = END_ID) -> DataFrame:
    """doc_id, piece, start, length, ids (binary, unsigned 32-bit
    little-endian) of every document's tokens and ``end_id``."""
    with open(path, encoding="utf-8") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())  # one vocabulary file
    end = int(end_id).to_bytes(4, "little")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = load(spec.value).encode
        for b in batches:
            rows = []
            for doc, text in zip(b["doc_id"], b["text"], strict=True):
                ids = encode(text) + end
                n = len(ids) // 4
                first = (n - 1) % max_len + 1
                cuts = [0, *range(first, n + 1, max_len)]
                rows += [(doc, i, s, e - s, ids[4 * s:4 * e])
                         for i, (s, e) in enumerate(zip(cuts, cuts[1:], strict=False))]
            yield pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids"]).astype(
                {"piece": "int32", "start": "int64", "length": "int64"})

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", body().alias("text")).mapInPandas(
        run, f"doc_id {kind}, piece int, start bigint, length bigint, ids binary")


def patterns(size: int, least: int = 1) -> np.ndarray:
    """Every one, two or three lengths from ``least`` on that sum to ``size``
    (0: no length)."""
    a = np.arange(1, size // 2 + 1)
    two = np.stack([a, size - a, 0 * a], axis=1)
    x, y = np.meshgrid(np.arange(1, size + 1), np.arange(1, size + 1), indexing="ij")
    z = size - x - y
    three = np.stack([x, y, z], axis=-1)[(x <= y) & (y <= z)]
    every = np.concatenate([[[size, 0, 0]], two, three])
    return every[((every >= least) | (every == 0)).all(axis=1)]


def nnls(pats: np.ndarray, counts: np.ndarray, block: int = 64, rounds: int = 200) -> np.ndarray:
    """Non-negative x minimising |A x - counts|, by active sets: column p of A
    counts the lengths in pattern p. ``counts[0]`` is ignored."""
    target = counts.astype(float)
    target[0] = 0
    x, active = np.zeros(len(pats)), np.zeros(len(pats), bool)

    def product(v: np.ndarray) -> np.ndarray:
        out = np.bincount(pats.ravel(), np.repeat(v, 3), len(target))
        out[0] = 0
        return out

    best = np.inf
    for _ in range(rounds):
        residual = target - product(x)
        slope = residual[pats].sum(axis=1)
        slope[active] = 0
        new = np.argsort(-slope)[:block]
        new = new[slope[new] > 1e-6 * max(1.0, target.max())]
        loss = float(residual @ residual)
        if not len(new) or loss >= best * (1 - 1e-6):
            break
        best = loss
        active[new] = True
        while True:
            on = np.flatnonzero(active)
            a = np.zeros((len(target), len(on)))
            for k in range(3):
                np.add.at(a, (pats[on, k], np.arange(len(on))), 1.0)
            a[0] = 0
            s = np.linalg.solve(a.T @ a + 1e-9 * np.eye(len(on)), a.T @ target)
            if (s > 0).all():
                x[:] = 0
                x[on] = s
                break
            bad = s <= 0
            step = np.min(x[on][bad] / np.maximum(x[on][bad] - s[bad], 1e-300))
            x[on] = np.maximum(0, x[on] + step * (s - x[on]))
            active[on[bad & (x[on] <= 1e-12)]] = False
            x[~active] = 0
    return x


def _best_fit(left: dict[int, int], max_len: int) -> list[tuple[tuple[int, ...], int]]:
    """Best fit, longest first, on counts: (lengths, number of sequences)."""
    room: dict[int, dict[tuple[int, ...], int]] = {}  # free tokens -> contents -> sequences
    for length in sorted(left, reverse=True):
        n = left[length]
        while n:
            free = min((r for r in room if r >= length), default=None)
            if free is None:
                each = max_len // length
                full, rest = divmod(n, each)
                for fill, times in ((each, full), (rest, 1)):
                    if fill and times:
                        at = room.setdefault(max_len - fill * length, {})
                        at[(length,) * fill] = at.get((length,) * fill, 0) + times
                break
            held = room[free]
            contents = next(iter(held))
            take = min(n, held[contents])
            held[contents] -= take
            if not held[contents]:
                del held[contents]
                if not held:
                    del room[free]
            at = room.setdefault(free - length, {})
            at[(*contents, length)] = at.get((*contents, length), 0) + take
            n -= take
    return [(contents, n) for held in room.values() for contents, n in held.items()]


def plan(histogram: dict[int, int], max_len: int = MAX_LEN, step: int = STEP,
         shares: tuple[float, ...] = SHARES) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of a sequence, number of such sequences) using each length as
    often as the histogram has it. The fitted counts are rounded down at each
    of ``shares`` of their size; the plan with the fewest sequences is taken."""
    size = max_len // step
    counts = np.zeros(size + 1)
    by_step: dict[int, list[int]] = {}
    for k in sorted(k for k, n in histogram.items() if n):
        counts[-(-k // step)] += histogram[k]
        by_step.setdefault(-(-k // step), []).append(k)
    pats = patterns(size, size // SHORT)
    fitted = nnls(pats, counts)
    plans = [_rounded(histogram, pats, fitted * s, by_step, max_len) for s in shares]
    return min(plans, key=lambda c: sum(n for _, n in c))


def _rounded(histogram: dict[int, int], pats: np.ndarray, fitted: np.ndarray, by_step: dict[int, list[int]],
             max_len: int) -> list[tuple[tuple[int, ...], int]]:
    left = {k: n for k, n in histogram.items() if n}
    out: list[tuple[tuple[int, ...], int]] = []
    times = np.floor(fitted + 1e-6).astype(int)
    for p in np.argsort(-times, kind="stable"):
        n = int(times[p])
        if not n:
            break
        slots = [s for s in pats[p].tolist() if s]
        while n > 0:
            # one concrete length per slot; as many sequences as all of them allow
            chosen = []
            for s in slots:
                fits = [k for k in by_step.get(s, []) if left.get(k, 0) > chosen.count(k)]
                if not fits:
                    break
                chosen.append(max(fits, key=lambda k: left[k]))
            if len(chosen) < len(slots):
                break
            take = min([n, *(left[k] // chosen.count(k) for k in chosen)])
            if not take:
                break
            out.append((tuple(chosen), take))
            for k in chosen:
                left[k] -= take
            n -= take
    return out + _best_fit({k: n for k, n in left.items() if n}, max_len)


def slots(classes: list[tuple[tuple[int, ...], int]]) -> pd.DataFrame:
    """Per length and run of ranks: first sequence, and offset there."""
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for lengths, n in classes:
        offset = 0
        for k in lengths:
            first = used.get(k, 0)
            rows.append((k, first, first + n, sequence, offset))
            used[k] = first + n
            offset += k
        sequence += n
    return pd.DataFrame(rows, columns=["length", "first_rank", "end_rank", "first_sequence", "offset"], dtype="int64")


def pack(pieces: DataFrame, max_len: int = MAX_LEN) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to rows that have a ``length`` of 1
    to ``max_len``. ``pieces`` should be stored: it is read three times."""
    spark = pieces.sparkSession
    hist = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not hist:
        return pieces.withColumn("sequence_id", F.lit(0).cast("long")).withColumn("offset", F.lit(0).cast("long"))
    # a length may hold any share of the rows: it is numbered in groups of bounded size
    salts = max(1, -(-max(hist.values()) // GROUP_ROWS))
    rows = pieces.withColumn("_salt", F.pmod(F.xxhash64("_row"), F.lit(salts)))
    before = Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    starts = (rows.groupBy("length", "_salt").agg(F.count(F.lit(1)).alias("_n"))
              .withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n"))
    within = Window.partitionBy("length", "_salt").orderBy("_row")
    ranked = (rows.withColumn("_within", F.row_number().over(within) - 1)
              .join(starts, ["length", "_salt"]).withColumn("_rank", F.col("_before") + F.col("_within")))
    # as many rows as slots in the plan: bounded by the lengths, not by the data
    where = spark.createDataFrame(slots(plan(hist, max_len))).withColumnRenamed("length", "_length")
    fits = ((F.col("length") == F.col("_length")) & (F.col("_rank") >= F.col("first_rank"))
            & (F.col("_rank") < F.col("end_rank")))
    return ranked.join(F.broadcast(where), fits).select(
        *pieces.columns, (F.col("first_sequence") + F.col("_rank") - F.col("first_rank")).alias("sequence_id"), "offset")


def pack_documents(docs: DataFrame, path: str, max_len: int = MAX_LEN, end_id: int = END_ID,
                   keep_ids: bool = False) -> DataFrame:
    """Packed pieces: doc_id, piece, start, length, ids_crc32, sequence_id,
    offset; and the ids themselves on request."""
    rows = token_pieces(docs, path, max_len, end_id).withColumn("ids_crc32", F.crc32("ids"))
    if not keep_ids:
        rows = rows.drop("ids")
    return pack(stored(rows.withColumn("_row", F.monotonically_increasing_id()), "pieces"), max_len).drop("_row")


def sequences(packed: DataFrame, max_len: int = MAX_LEN) -> DataFrame:
    """sequence_id and ``ids``: the token ids of each packed sequence. A
    sequence has at most ``max_len`` tokens, so its group is bounded."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(F.col("p"), F.lit(b""), lambda a, x: F.concat(a, x["ids"]))
    return packed.groupBy("sequence_id").agg(parts.alias("p")).select("sequence_id", joined.alias("ids"))
