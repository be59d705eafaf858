"""Duplicate passages by a sparse, hash-ordered index of suffixes.

A byte goes when a string of ``length`` bytes that covers it also starts in a
document with a smaller doc_id. Documents are gathered into batches. A batch
gets an array over chosen suffixes: in every window of ``length`` bytes
the k-byte word with the smallest hash is an anchor, so equal windows choose
the same anchor at the same place, and a run of windows with one anchor is one
entry. Entries are sorted by the hash of the word the suffix starts with; for
finding equal windows any fixed order of the words serves as well as the
alphabetical one, and mixed hashes split evenly.

The arrays are dealt by ranges of that order, and the arrays of all batches
are merged within a range:
* an entry whose whole run also starts in an earlier document is covered;
* an entry whose word is met in another document with another run may match in
  part: its windows are compared one by one, in a second index of the same
  kind keyed by window;
* other entries match nothing.
Runs and windows count as equal by 96 bits of hashes. Within a batch all this
is settled before anything is sent, so a word or window held by any number of
documents sends a batch's first document only.

Defined results
* Null text counts as empty; texts under ``length`` bytes lose nothing.
* A document never loses bytes to itself or to one with an equal doc_id (so
  repeated rows stay alike); a null doc_id counts as larger than any other.
* Extra columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locusframe.llm.common import body, fresh_worker, settings, stored
from locusframe.llm.grams import ODD, mixed
from locusframe.session import scratch_path

LENGTH, WORD = 50, 20
#: Rows above half a heap region (512 KB) would be allocated one by one, and fragment an executor's heap.
BATCH_BYTES = 384 << 10
RANGE_BYTES = 16 << 20
#: Rows hold whole batches: they go to Python a few at a time.
ONE_ROW = {"spark__sql__execution__arrow__maxRecordsPerBatch": "16"}
DOCS_AT_ONCE = 500
LAST = np.iinfo(np.int64).max  # stands for a null doc_id
CHUNK_BITS = 20
U = np.uint64


def batches(docs: DataFrame, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """Documents in rows of about ``batch_bytes`` of text: batch, doc_ids,
    keys (a digest of each text), ends (of each text in the blob), blob. They
    are a table in the shared folder, bucketed by batch, so what is found for
    a batch is joined to it later without moving the texts again."""
    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fresh_worker()
        number = TaskContext.get().partitionId() << 32
        ids, keys, texts, size = [], [], [], 0
        for b in it:
            for d, k, t in zip(b["doc_id"].astype("Int64").fillna(LAST).astype("int64"), b["key"], b["text"], strict=True):
                raw = t.encode()
                ids.append(d)
                keys.append(k)
                texts.append(raw)
                size += len(raw)
                if size >= batch_bytes:
                    yield _batch(number, ids, keys, texts)
                    ids, keys, texts, size, number = [], [], [], 0, number + 1
        if ids:
            yield _batch(number, ids, keys, texts)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.sha2(body(), 256).alias("key"), body().alias("text"))
    spark = docs.sparkSession
    path = scratch_path(spark, "suffix_batches")
    name = path.rsplit("/", 1)[-1].replace("-", "_")
    made = rows.mapInPandas(run, "batch bigint, doc_ids array<bigint>, keys array<string>, ends binary, blob binary")
    with settings(spark, spark__sql__execution__arrow__maxRecordsPerBatch=str(DOCS_AT_ONCE)):
        # zstd streams leave no direct buffer behind per file, as snappy codecs do until the next full collection
        (made.write.bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), "batch")
         .option("compression", "zstd").option("path", path).saveAsTable(name))
    return spark.table(name)


def _batch(number, ids, keys, texts) -> pd.DataFrame:
    ends = np.cumsum([len(t) for t in texts]).astype(np.int64)
    return pd.DataFrame({"batch": [number], "doc_ids": [ids], "keys": [keys], "ends": [ends.tobytes()],
                         "blob": [b"".join(texts)]})


def _eights(buf: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on, as one word."""
    n = len(buf) - 7
    out = np.empty(max(n, 0), U)
    for r in range(min(8, max(n, 0))):
        m = (n - r + 7) // 8
        out[r::8] = np.frombuffer(buf[r:r + 8 * m].tobytes(), "<u8")
    return out


def _hash_at(eights: np.ndarray, at: np.ndarray, length: int, seed: int = 0) -> np.ndarray:
    """Hash of the ``length`` bytes from each of the places ``at`` on."""
    out = np.full(len(at), length + (seed << 32), U)
    for o in (*range(0, length - 8, 8), length - 8):
        out = mixed((out ^ eights[at + o]) + ODD)
    return out


class Entries:
    """The sparse suffix array of a batch: sorted by word hash ``h``, run hash
    ``s`` and document; ``at`` and ``n``: first window and their number."""

    def __init__(self, blob: bytes, ends: np.ndarray, ids: np.ndarray, length: int, word: int):
        buf = np.frombuffer(blob, np.uint8)
        self.eights, self.length = _eights(buf), length
        starts = np.concatenate(([0], ends[:-1]))
        inside = np.zeros(len(buf) + 1, np.int8)  # places where a window fits its document
        fits = ends - starts >= length
        inside[starts[fits]] += 1
        inside[ends[fits] - length + 1] -= 1
        inside = np.cumsum(inside[:-1], dtype=np.int8) > 0
        found = [self._chunk(a, inside, word) for a in range(0, max(0, len(buf) - length + 1), (1 << CHUNK_BITS) - 64)]
        none = np.zeros(0, np.int64)
        h, at, n = (np.concatenate([none.astype(U) if i == 0 else none, *(f[i] for f in found)]) for i in range(3))
        first, last = (_hash_at(self.eights, x, length) for x in (at, at + n - 1))
        s = (mixed(first ^ mixed(last + U(1)) ^ (n.astype(U) * ODD)) >> U(32)).astype(np.uint32)
        s[s == 0] = 1  # 0 marks a word with several runs
        doc = ids[np.searchsorted(ends, at, "right")]
        h = mixed(h)  # anchors are the smallest hashes of their windows: mixed once more they deal evenly
        order = np.argsort(h, kind="stable")
        hs = h[order]
        twice = np.zeros(len(hs), bool)
        twice[1:] = hs[1:] == hs[:-1]
        twice[:-1] |= twice[1:]
        some = order[twice]
        order[twice] = some[np.lexsort((doc[some], s[some], h[some]))]
        self.h, self.s, self.doc, self.at, self.n = h[order], s[order], doc[order], at[order], n[order]
        self._settle()

    def _chunk(self, a: int, inside: np.ndarray, word: int):
        """Entries of the windows that start in one chunk of the blob."""
        width = self.length - word + 1
        b = min(a + (1 << CHUNK_BITS) - 64, len(inside) - self.length + 1)
        span = self.eights[a:b + width - 1 + word - 8]
        m = b - a + width - 1
        h = np.full(m, word, U)
        for o in (*range(0, word - 8, 8), word - 8):
            h = mixed((h ^ span[o:o + m]) + ODD)
        low = U((1 << CHUNK_BITS) - 1)
        least = (h & ~low) | np.arange(m, dtype=U)
        have = 1
        while 2 * have <= width:
            least = np.minimum(least[:-have], least[have:])
            have *= 2
        if have < width:
            least = np.minimum(least[:have - width], least[width - have:])
        place = (least & low).astype(np.int64)
        ok = inside[a:b]
        new = np.concatenate(([True], (place[1:] != place[:-1]) | (ok[1:] != ok[:-1])))
        first = np.flatnonzero(new)
        n = np.diff(np.append(first, len(place)))
        use = ok[first]
        return h[place[first[use]]], first[use] + a, n[use]

    def _settle(self) -> None:
        """What the batch alone decides: ``covered`` and ``mixed`` entries,
        and which to send, with one marker for each mixed word."""
        h, s, doc = self.h, self.s, self.doc
        n = len(h)
        word = np.concatenate(([True], h[1:] != h[:-1])) if n else np.zeros(0, bool)
        run = word | np.concatenate(([True], s[1:] != s[:-1])) if n else word
        of_word, of_run = np.cumsum(word) - 1, np.cumsum(run) - 1
        least = doc[run][of_run] if n else doc
        self.covered = least < doc
        if n:
            at = np.flatnonzero(word)
            low, high = np.minimum.reduceat(doc, at), np.maximum.reduceat(doc, at)
            several = (low < high) & (np.add.reduceat(run.astype(np.int64), at) > 1)
        else:
            several = np.zeros(0, bool)
        in_mixed = several[of_word] if n else word
        self.mixed = in_mixed & ~self.covered
        self.marker = in_mixed & word
        self.sent = self.marker | ~(in_mixed | self.covered)

    def windows(self, which: np.ndarray) -> np.ndarray:
        """Start of every window of some entries."""
        n = self.n[which]
        return np.repeat(self.at[which] - (np.cumsum(n) - n), n) + np.arange(n.sum())


def _pack(h: np.ndarray, doc: np.ndarray, *rest: np.ndarray) -> bytes:
    """A sorted run: hashes, documents (as numbers into a list), and more."""
    ids, number = np.unique(doc, return_inverse=True)
    table = zlib.compress(np.diff(ids, prepend=0).tobytes(), 1)
    number = number.astype(np.uint16 if len(ids) <= 1 << 16 else np.uint32)
    head = np.array([len(h), len(table), number.itemsize], np.int64).tobytes()
    return b"".join([head, table, h.tobytes(), number.tobytes(), *(r.tobytes() for r in rest)])


def _unpack(raw: bytes, *kinds) -> tuple[np.ndarray, ...]:
    n, table, item = np.frombuffer(raw, np.int64, 3).tolist()
    ids = np.cumsum(np.frombuffer(zlib.decompress(raw[24:24 + table]), np.int64))
    at = 24 + table
    out = [np.frombuffer(raw, U, n, at)]
    at += 8 * n
    out.append(ids[np.frombuffer(raw, np.uint16 if item == 2 else np.uint32, n, at)])
    at += item * n
    for k in kinds:
        out.append(np.frombuffer(raw, k, n, at))
        at += n * np.dtype(k).itemsize
    return tuple(out)


def _ranges(h: np.ndarray, count: int) -> np.ndarray:
    """Range number of each hash: ``count`` ranges in hash order."""
    return ((h >> U(32)) * U(count) >> U(32)).astype(np.int64)


def _slices(h: np.ndarray, count: int):
    part = _ranges(h, count)
    cut = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1]))) if len(h) else np.zeros(0, np.int64)
    for a, b in zip(cut.tolist(), [*cut[1:].tolist(), len(h)], strict=False):
        yield int(part[a]), a, b


class Merged:
    """Sorted runs of one range merged into one, by hash and check together:
    96 bits say that two strings are equal. ``groups`` numbers equal hashes,
    ``equals`` equal pairs, in the merged order; ``place`` leads back."""

    def __init__(self, h: np.ndarray, check: np.ndarray):
        order = np.argsort(h, kind="stable")  # sorted runs: a merge
        hs = h[order]
        twice = np.zeros(len(hs), bool)
        twice[1:] = hs[1:] == hs[:-1]
        twice[:-1] |= twice[1:]
        some = order[twice]
        order[twice] = some[np.lexsort((check[some], h[some]))]
        c = check[order]
        none = np.zeros(0, bool)
        new = np.concatenate(([True], hs[1:] != hs[:-1])) if len(h) else none
        other = new | np.concatenate(([True], c[1:] != c[:-1])) if len(h) else none
        self.order, self.hash_at, self.pair_at = order, np.flatnonzero(new), np.flatnonzero(other)
        self.groups, self.equals = np.cumsum(new) - 1, np.cumsum(other) - 1

    def back(self, values: np.ndarray) -> np.ndarray:
        """Values of the merged order in the order of the input."""
        out = np.empty_like(values)
        out[self.order] = values
        return out

    def least(self, values: np.ndarray) -> np.ndarray:
        """The smallest value of each element's pair."""
        if not len(values):
            return values
        return self.back(np.minimum.reduceat(values[self.order], self.pair_at)[self.equals])

    def spread(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The smallest and the largest value of each element's hash."""
        if not len(values):
            return values, values
        v = values[self.order]
        return tuple(self.back(f.reduceat(v, self.hash_at)[self.groups]) for f in (np.minimum, np.maximum))


def _joined(sent: list[tuple[np.ndarray, ...]], kinds: tuple) -> tuple[np.ndarray, ...]:
    return tuple(np.concatenate([np.zeros(0, k), *x]) for k, x in zip(kinds, zip(*sent, strict=True) if sent else [()] * len(kinds), strict=True))


def _dealt(rows: DataFrame, work, schema: str) -> DataFrame:
    return rows.groupBy("part").applyInPandas(work, schema)


def _judge_entries(pdf: pd.DataFrame) -> pd.DataFrame:
    """One range of the order: per batch the verdict on each entry it sent
    (1 covered, 2 compare windows, 0 neither)."""
    fresh_worker()
    sent = [_unpack(raw, np.uint32) for raw in pdf["payload"]]
    cuts = np.cumsum([len(x[0]) for x in sent])[:-1] if sent else []
    h, doc, s = _joined(sent, (U, np.int64, np.uint32))
    one = Merged(h, s)
    covered = (one.least(doc) < doc) & (s > 0)
    (low, high), (low_s, high_s) = one.spread(doc), one.spread(s)
    several = (low_s == 0) | ((low < high) & (low_s < high_s))
    verdict = np.where(covered, 1, np.where(several & (s > 0), 2, 0)).astype(np.uint8)
    return pd.DataFrame({"batch": pdf["batch"], "part": pdf["part"], "payload": [x.tobytes() for x in np.split(verdict, cuts)]})


def _judge_windows(pdf: pd.DataFrame) -> pd.DataFrame:
    """One range of window hashes: the starts of windows that an earlier
    document has; covered spans (part -1) pass through."""
    own = pdf["kind"].to_numpy() == 0
    sent = [_unpack(raw, np.int32, np.uint32) for raw in pdf.loc[own, "payload"]]
    cuts = np.cumsum([len(x[0]) for x in sent])[:-1] if sent else []
    h, doc, at, check = _joined(sent, (U, np.int64, np.int32, np.uint32))
    gone = Merged(h, check).least(doc) < doc
    hits = [x[g] for x, g in zip(np.split(at, cuts), np.split(gone, cuts), strict=True)] if sent else []
    out = pd.DataFrame({"batch": pdf.loc[own, "batch"], "kind": 0, "payload": [x.astype(np.int32).tobytes() for x in hits]})
    return pd.concat([out, pdf.loc[~own, ["batch", "kind", "payload"]]])


def _merged(first: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of half-open spans, as sorted separate spans."""
    if not len(first):
        return first, end
    order = np.argsort(first, kind="stable")
    first, end = first[order], np.maximum.accumulate(end[order])
    new = np.concatenate(([True], first[1:] > end[:-1]))
    cut = np.flatnonzero(new)
    return first[cut], end[np.append(cut[1:], len(end)) - 1]


def _collected(rows: DataFrame) -> DataFrame:
    """Payloads of each batch in one row; a batch's share is bounded by its
    size, whatever the corpus."""
    item = F.struct(*[c for c in ("part", "kind", "payload") if c in rows.columns])
    return rows.groupBy("batch").agg(F.sort_array(F.collect_list(item)).alias("found")).hint("shuffle_hash")


def remove_repeats(docs: DataFrame, length: int = LENGTH, word: int = WORD, batch_bytes: int = BATCH_BYTES,
                   range_bytes: int = RANGE_BYTES, texts: bool = True) -> DataFrame:
    """Per document: doc_id, key (sha256 of the text), n_bytes, n_removed,
    spans (starts and ends of removed runs, one after another), kept (binary).
    Without ``texts`` there is no ``kept``, and the last step reads no text."""
    if not 8 <= word <= length:
        raise ValueError("word must be 8 to length bytes")
    spark = docs.sparkSession
    table = batches(docs, batch_bytes)
    total = table.agg(F.sum(F.octet_length("blob")).alias("n")).first()["n"] or 0
    count = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // range_bytes))

    def entries(row) -> Entries:
        return Entries(row["blob"], np.frombuffer(row["ends"], np.int64), np.asarray(row["doc_ids"], np.int64), length, word)

    def rows(it: Iterator[pd.DataFrame]):
        fresh_worker()
        for b in it:
            for _, row in b.iterrows():
                yield row

    def index(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for row in rows(it):
            e = entries(row)
            h, doc, s = e.h[e.sent], e.doc[e.sent], np.where(e.marker, np.uint32(0), e.s)[e.sent]
            got = [(p, row["batch"], _pack(h[a:b], doc[a:b], s[a:b])) for p, a, b in _slices(h, count)]
            yield pd.DataFrame(got, columns=["part", "batch", "payload"]).astype({"part": "int64", "batch": "int64"})

    sent = table.select("batch", "doc_ids", "ends", "blob").mapInPandas(index, "part bigint, batch bigint, payload binary")
    with settings(spark, **ONE_ROW):
        verdicts = stored(_dealt(sent, _judge_entries, "batch bigint, part bigint, payload binary"), "suffix-verdicts")

    def compare(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for row in rows(it):
            e = entries(row)
            found = row["found"] if row["found"] is not None else []
            verdict = np.zeros(len(e.h), np.uint8)
            verdict[e.sent] = np.frombuffer(b"".join(f["payload"] for f in found), np.uint8)
            verdict[e.covered], verdict[e.mixed] = 1, 2
            at = e.windows(verdict == 2)
            h = _hash_at(e.eights, at, length)
            ends, ids = np.frombuffer(row["ends"], np.int64), np.asarray(row["doc_ids"], np.int64)
            doc = ids[np.searchsorted(ends, at, "right")]
            check = (_hash_at(e.eights, at, length, 1) >> U(32)).astype(np.uint32)
            order = np.argsort(h, kind="stable")
            h, check, doc, at = h[order], check[order], doc[order], at[order]
            here = Merged(h, check).least(doc) < doc
            first, end = _merged(np.concatenate([e.at[verdict == 1], at[here]]),
                                 np.concatenate([(e.at + e.n - 1 + length)[verdict == 1], at[here] + length]))
            h, doc, at, check = h[~here], doc[~here], at[~here].astype(np.int32), check[~here]
            got = [(p, row["batch"], 0, _pack(h[a:b], doc[a:b], at[a:b], check[a:b])) for p, a, b in _slices(h, count)]
            got.append((row["batch"] % count, row["batch"], 1, np.stack([first, end]).astype(np.int64).tobytes()))
            yield pd.DataFrame(got, columns=["part", "batch", "kind", "payload"]).astype(
                {"part": "int64", "batch": "int64", "kind": "int64"})

    todo = table.select("batch", "doc_ids", "ends", "blob").join(_collected(verdicts), "batch", "left")
    asked = todo.mapInPandas(compare, "part bigint, batch bigint, kind bigint, payload binary")
    with settings(spark, **ONE_ROW):
        spans = stored(_dealt(asked, _judge_windows, "batch bigint, kind bigint, payload binary"), "suffix-spans")

    def cut(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for row in rows(it):
            ends = np.frombuffer(row["ends"], np.int64)
            starts = np.concatenate(([0], ends[:-1]))
            gone = [np.frombuffer(f["payload"], np.int64).reshape(2, -1) for f in row["found"] if f["kind"] == 1]
            at = np.concatenate([np.zeros(0, np.int32)] + [np.frombuffer(f["payload"], np.int32)
                                                           for f in row["found"] if f["kind"] == 0]).astype(np.int64)
            first, end = _merged(np.concatenate([at, *(g[0] for g in gone)]), np.concatenate([at + length, *(g[1] for g in gone)]))
            out = []
            lo, hi = np.searchsorted(end, starts, "right"), np.searchsorted(first, ends, "left")
            for i, (d, k) in enumerate(zip(row["doc_ids"], row["keys"], strict=True)):
                a, b = int(starts[i]), int(ends[i])
                # texts adjoin in the blob, so spans of neighbours may have merged
                own = [(max(a, int(first[j])) - a, min(b, int(end[j])) - a) for j in range(lo[i], hi[i]) if a < b]
                cuts = [v for xy in own for v in xy]
                out.append((None if d == LAST else d, k, b - a, sum(y - x for x, y in own), cuts))
                if texts:
                    stay = zip([a, *(a + y for _, y in own)], [*(a + x for x, _ in own), b], strict=True)
                    out[-1] += (b"".join(row["blob"][x:y] for x, y in stay),)
            pdf = pd.DataFrame(out, columns=columns)
            yield pdf.astype({"doc_id": "Int64", "n_bytes": "int64", "n_removed": "int64"})

    schema = "doc_id bigint, key string, n_bytes bigint, n_removed bigint, spans array<int>" + (", kept binary" if texts else "")
    columns = [c.split()[0] for c in schema.split(", ")]
    todo = (table if texts else table.drop("blob")).join(_collected(spans), "batch")
    return todo.mapInPandas(cut, schema)
