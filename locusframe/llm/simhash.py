"""SimHash near-duplicates found with BK-trees.

Fingerprints of all documents are compared, not pairs of documents: equal
fingerprints are one node. Two fingerprints within ``radius`` differing bits
agree on at least two of radius + 2 bit blocks, so every pair of blocks deals
the fingerprints into shards by the bits in those blocks. Each shard builds a
BK-tree (children keyed by integer Hamming distance to the parent) and is
searched with all its fingerprints, following only edges within the radius.
A shard above ``tree_size`` is cut into trees of about that size, and each
tree meets the fingerprints of every piece. A shard returns a spanning star
of its links; components are found on the fingerprints.

Defined results
* Null text counts as empty. A text without words has fingerprint zero and is
  linked like any other.
* component_id is the smallest doc_id reachable, itself included; null only
  where no reachable row has a doc_id.
* Repeated rows and copies share one fingerprint and component. Extra columns
  are not read; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locusframe.llm.common import body, lookup, stored
from locusframe.llm.components import connected_components

SHINGLE, RADIUS, TREE_SIZE = 4, 4, 2048
BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1)


def simhash(text: bytes, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of the word shingles of a UTF-8 text."""
    words = text.lower().split()  # bytes: A-Z only, ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - shingle + 1)
    last = ends[shingle - 1:] if len(words) >= shingle else ends[-1:]
    digest = xxhash.xxh64_intdigest
    hashes = [digest(joined[a:b], 42) for a, b in zip(starts[:n].tolist(), last.tolist(), strict=True)]
    octets = np.array(hashes, dtype=">u8").view(np.uint8).reshape(n, 8)
    if n < 512:
        ones = np.unpackbits(octets, axis=1).sum(axis=0, dtype=np.int64)
    else:
        ones = np.concatenate([np.bincount(octets[:, i], minlength=256) @ BITS for i in range(8)])
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, key (sha256 of the text) and ``fp`` (64 bits as a signed long)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            fp = np.array([simhash(t.encode(), shingle) for t in b["text"]], dtype=np.uint64)
            yield pd.DataFrame({"doc_id": b["doc_id"], "key": b["key"], "fp": fp.view(np.int64)})

    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, key string, fp bigint"
    return docs.select("doc_id", F.sha2(body(), 256).alias("key"), body().alias("text")).mapInPandas(run, schema)


class BKTree:
    """A BK-tree over distinct 64-bit codes, built and searched in batches:
    a node splits its codes, or the queries at it, by distance to its own."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.children: list[dict[int, int]] = [{} for _ in codes]
        todo = [np.arange(len(codes))] if len(codes) else []
        while todo:
            own = todo.pop()
            node, rest = own[0], own[1:]
            if not len(rest):
                continue
            d = np.bitwise_count(codes[rest] ^ codes[node])
            for e in np.unique(d).tolist():
                below = rest[d == e]
                self.children[node][e] = int(below[0])
                todo.append(below)

    def search(self, queries: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """All (query index, node index) within ``radius``."""
        qs, ns = [], []
        todo = [(0, np.arange(len(queries)))] if len(self.codes) else []
        while todo:
            node, at = todo.pop()
            d = np.bitwise_count(queries[at] ^ self.codes[node]).astype(np.int16)
            hit = at[d <= radius]
            qs.append(hit)
            ns.append(np.full(len(hit), node))
            for e, child in self.children[node].items():
                go = at[np.abs(d - e) <= radius]
                if len(go):
                    todo.append((child, go))
        none = np.zeros(0, np.int64)
        return np.concatenate([none, *qs]), np.concatenate([none, *ns])


def _stars(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Per vertex the smallest vertex of its component, for links a-b."""
    label = np.arange(n)
    while True:
        low = label.copy()
        np.minimum.at(low, a, label[b])
        np.minimum.at(low, b, label[a])
        low = low[low]
        if (low == label).all():
            return label
        label = low


def _shard_links(codes: np.ndarray, asked: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links of one tree of ``codes`` searched with ``asked``."""
    q, n = BKTree(codes).search(asked, radius)
    every, place = np.unique(np.concatenate([codes, asked]), return_inverse=True)
    label = _stars(len(every), place[n], place[len(codes) + q])
    own = np.flatnonzero(label != np.arange(len(every)))
    return every[own], every[label[own]]


def _blocks(count: int) -> list[int]:
    """Masks that cut 64 bits into ``count`` runs of nearly equal length."""
    cuts = [64 * i // count for i in range(count + 1)]
    return [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(cuts, cuts[1:], strict=False)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def links(codes: DataFrame, radius: int = RADIUS, tree_size: int = TREE_SIZE) -> DataFrame:
    """Spanning links (u, v) between distinct fingerprints ``fp`` at most
    ``radius`` bits apart."""
    masks = [_signed(a | b) for a, b in combinations(_blocks(radius + 2), 2)]
    dealt = codes.select("fp", F.explode(F.array(*[
        F.struct(F.lit(i).alias("pair"), F.col("fp").bitwiseAND(F.lit(m)).alias("shard"))
        for i, m in enumerate(masks)])).alias("x")).select("fp", "x.pair", "x.shard")
    large = (dealt.groupBy("pair", "shard").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > tree_size)
             .select("pair", "shard", F.ceil(F.col("n") / tree_size).cast("int").alias("trees")))
    cut = (dealt.join(large, ["pair", "shard"], "left")
           .withColumn("trees", F.coalesce("trees", F.lit(1)))
           .withColumn("own", F.pmod(F.xxhash64("fp"), F.col("trees")).cast("int")))
    # the piece is a tree once, and is asked of its own tree and of every later one
    asks = F.transform(F.sequence(F.lit(0), F.col("own")), lambda t: F.struct(
        t.alias("tree"), F.col("own").alias("piece"), F.lit(True).alias("asked")))
    builds = F.transform(F.sequence(F.col("own"), F.col("trees") - 1), lambda p: F.struct(
        F.col("own").alias("tree"), p.alias("piece"), F.lit(False).alias("asked")))
    sides = (cut.select("fp", "pair", "shard", F.explode(F.when(F.col("trees") == 1, F.array(F.struct(
        F.lit(0).alias("tree"), F.lit(0).alias("piece"), F.lit(False).alias("asked")))).otherwise(
            F.concat(asks, builds))).alias("x")).select("fp", "pair", "shard", "x.*"))
    key = ["pair", "shard", "tree", "piece"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept: pd.DataFrame | None = None
        for b in batches:
            kept = b if kept is None else pd.concat([kept, b], ignore_index=True)
            same = (kept[key].to_numpy() == kept[key].iloc[-1].to_numpy()).all(axis=1)
            done = int(len(kept) - same[::-1].argmin()) if not same.all() else 0
            if done:
                yield _of_shards(kept.iloc[:done])
                kept = kept.iloc[done:].reset_index(drop=True)
        if kept is not None and len(kept):
            yield _of_shards(kept)

    def _of_shards(rows: pd.DataFrame) -> pd.DataFrame:
        k = rows[key].to_numpy()
        at = np.flatnonzero(np.concatenate(([True], (k[1:] != k[:-1]).any(axis=1))))
        end = np.concatenate((at[1:], [len(rows)]))
        fp, asked = rows["fp"].to_numpy().view(np.uint64), rows["asked"].to_numpy()
        out = []
        for a, b in zip(at[end - at > 1].tolist(), end[end - at > 1].tolist(), strict=True):
            tree = fp[a:b][~asked[a:b]]
            out.append(_shard_links(tree, fp[a:b][asked[a:b]] if asked[a:b].any() else tree, radius))
        none = np.zeros(0, np.uint64)
        return pd.DataFrame({"u": np.concatenate([none, *(x for x, _ in out)]).view(np.int64),
                             "v": np.concatenate([none, *(x for _, x in out)]).view(np.int64)})

    return sides.repartition(*key).sortWithinPartitions(*key).mapInPandas(run, "u bigint, v bigint")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS,
                    tree_size: int = TREE_SIZE) -> DataFrame:
    """Per document doc_id, fingerprint (16 hex digits), component_id; and
    key (sha256 of the text) and label (a number of the component)."""
    fps = stored(fingerprints(docs, shingle), "simhash")
    codes = stored(fps.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n")), "codes")
    label = connected_components(links(codes.select("fp"), radius, tree_size))
    of = codes.join(label.withColumnRenamed("node", "fp"), "fp", "left").withColumn("label", F.coalesce("label", "fp"))
    of = stored(of, "simhash-labels")
    groups = of.groupBy("label").agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("w"))
    facts = lookup(of.select("fp", "n", "label"), groups, "label", "w", of.agg(F.count(F.lit(1)).alias("total")))
    total = codes.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"))
    found = lookup(fps, facts.select("fp", "n", "component_id", "label"), "fp", "n", total)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id", "key", "label")
