"""HWE-normalised PCA of dosage arrays.

The leading eigenpairs of Z'Z (Z: variants x samples) by block subspace
iteration from a random start: a block of k + ``EXTRA`` sample vectors is
multiplied by Z'Z in one Spark job a round, then orthonormalised and rotated to
its Ritz vectors. Each round searches the block, its residual and its last
step together, which takes a few dozen rounds where plain powers take
hundreds. Nothing samples x samples is formed anywhere: the driver holds a few
matrices of samples x 3 (k + EXTRA), a task one more and the rows of one Arrow
batch. The variant loadings are computed distributed.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from locusframe.operators.ld import with_moments
from locusframe.session import cut_lineage

EXTRA = 10  # vectors beyond the wanted ones
TOLERANCE, ROUNDS = 1e-8, 300
SUM_BLOCK = 512  # samples of a partial sum that travel as one row
BATCH_BYTES, FIRST_ROWS = 32 << 20, 256  # of an Arrow batch; rows while their width is not known
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def hwe_normalize(arrs: DataFrame, m: int | None = None, key: str = "vid") -> DataFrame:
    """(key, idx, af, z ARRAY<DOUBLE>) with z = (g - 2p) / sqrt(2p(1-p) m),
    p = mean dosage / 2; monomorphic variants are removed; m = number of
    remaining variants unless given."""
    v = with_moments(arrs).withColumn("af", F.col("sx") / (2 * F.col("n")))
    v = v.where((F.col("af") > 0) & (F.col("af") < 1))
    if m is None:
        m = v.count()
    sd = F.sqrt(2 * F.col("af") * (1 - F.col("af")) * F.lit(float(m)))
    z = F.transform("dosages", lambda g: (g - 2 * F.col("af")) / sd)
    # row index of the distributed matrix: the numeric key itself, else a
    # 64-bit hash (any distinct long works; no global ordering is needed)
    numeric = dict(v.dtypes)[key] in ("bigint", "int", "smallint", "tinyint")
    v = v.withColumn("idx", F.col(key).cast("long") if numeric else F.xxhash64(key))
    return v.select(key, "idx", "af", z.alias("z"))


@contextmanager
def _arrow_rows(spark, rows: int):
    """At most ``rows`` rows in an Arrow batch: a row is as wide as the cohort."""
    before = spark.conf.get(ARROW_ROWS)
    spark.conf.set(ARROW_ROWS, str(max(1, rows)))
    try:
        yield
    finally:
        spark.conf.set(ARROW_ROWS, before)


def _as_bytes(norm: DataFrame) -> DataFrame:
    """``z`` as the bytes of its doubles: read in every round, they reach
    numpy without a conversion of each number."""
    def run(it):
        for b in it:
            b["z"] = [np.asarray(z, np.float64).tobytes() for z in b["z"]]
            yield b

    kinds = [T.StructField(f.name, T.BinaryType()) if f.name == "z" else f for f in norm.schema.fields]
    return norm.mapInPandas(run, T.StructType(kinds))


def _rows(b: pd.DataFrame) -> np.ndarray:
    return np.frombuffer(b"".join(b["z"])).reshape(len(b), -1)


def gram_product(norm: DataFrame, q: np.ndarray) -> np.ndarray:
    """Z'(Z q) for the rows ``z`` (bytes) of ``norm``: every task sums over its rows,
    partial sums meet by blocks of samples, and what comes back is q's size."""
    spark, (n, width) = norm.sparkSession, q.shape
    sent = spark.sparkContext.broadcast(q)

    def multiply(it):
        out = np.zeros((n, width))
        for b in it:
            if len(b):
                z = _rows(b)
                out += z.T @ (z @ sent.value)
        at = range(0, n, SUM_BLOCK)
        yield pd.DataFrame({"block": list(at), "part": [out[a:a + SUM_BLOCK].tobytes() for a in at]})

    def add(it):
        sums: dict[int, np.ndarray] = {}
        for b in it:
            for a, raw in zip(b["block"], b["part"], strict=True):
                x = np.frombuffer(raw).reshape(-1, width)
                sums[a] = sums[a] + x if a in sums else x
        yield pd.DataFrame({"block": list(sums), "part": [x.tobytes() for x in sums.values()]}).astype({"block": "int64", "part": object})

    schema = "block bigint, part binary"
    parts = norm.select("z").mapInPandas(multiply, schema).repartition("block")
    out = np.zeros((n, width))
    for r in parts.mapInPandas(add, schema).collect():  # n x width in all
        x = np.frombuffer(r["part"]).reshape(-1, width)
        out[r["block"]:r["block"] + len(x)] = x
    sent.unpersist()
    return out


def _orthonormal(s: np.ndarray) -> np.ndarray:
    """An orthonormal basis of the columns of ``s``, which is overwritten; directions
    that are combinations of others, but for rounding, go."""
    scale = np.linalg.norm(s, axis=0)
    s = s if scale.all() else s[:, scale > 0]
    s /= scale[scale > 0]
    u, sv, _ = np.linalg.svd(s, full_matrices=False)
    return u[:, sv > 1e-10 * sv[0]]


def top_eigenpairs(product, n: int, k: int, extra: int = EXTRA, tolerance: float = TOLERANCE, rounds: int = ROUNDS,
                   seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """The k largest eigenvalues and vectors of a symmetric positive n x n
    operator known by ``product(q)`` alone."""
    width = min(n, k + extra)
    x = step = np.zeros((n, 0))
    search = np.linalg.qr(np.random.default_rng(seed).standard_normal((n, width)))[0]
    for _ in range(rounds):
        gs = product(search)
        h = search.T @ gs
        w, c = np.linalg.eigh((h + h.T) / 2)
        w, c = w[::-1][:width], c[:, ::-1][:, :width]
        old, x, rest = x, search @ c, gs @ c
        del search, gs  # as wide as all that is kept
        step = x - old @ (old.T @ x) if old.shape[1] else step
        del old
        rest -= x * w
        if np.linalg.norm(rest[:, :k], axis=0).max(initial=0) <= tolerance * max(w[0], 1e-300):
            break
        rest -= x @ (x.T @ rest)
        search = _orthonormal(np.hstack([x, rest, step]))
    return w[:k], x[:, :k]


class Scores(Sequence):
    """(sample index, [k scores]) of every sample, kept as one matrix: as Python
    objects they would take many times the driver's room."""

    def __init__(self, matrix: np.ndarray):
        self.matrix = matrix

    def __len__(self):
        return len(self.matrix)

    def __getitem__(self, i: int):
        return range(len(self))[i], self.matrix[i].tolist()

    def __eq__(self, other):
        return list(self) == list(other)


def pca_hwe(norm: DataFrame, k: int, key: str = "vid", samples: int = 0):
    """Returns (eigenvalues list, :class:`Scores` [(sample_index, [k])],
    loadings DataFrame (key, af, loadings ARRAY<DOUBLE>)).

    Eigenpairs of Z'Z give V and s (scores = V s); a last pass computes the
    variant loadings U = Z V / s in Arrow batches. Signs are fixed so that the
    largest-magnitude sample coordinate of each component is positive.

    Without a variant nothing tells how many samples there are; given by
    ``samples``, each of them has the scores 0 of a matrix without rows."""
    spark = norm.sparkSession
    with _arrow_rows(spark, FIRST_ROWS):
        norm = cut_lineage(_as_bytes(norm.select(key, "af", "z")))  # read again in every round
    n = (norm.select(F.max(F.octet_length("z"))).first()[0] or 0) // 8
    fit = BATCH_BYTES // (8 * max(n, 1))
    with _arrow_rows(spark, fit):
        w, V = top_eigenpairs(lambda q: gram_product(norm, q), n, k) if n \
            else (np.zeros(min(k, samples)), np.zeros((samples, min(k, samples))))
    w = np.clip(w, 0.0, None)
    signs = np.sign(V[np.abs(V).argmax(axis=0), range(V.shape[1])]) if n else np.zeros(V.shape[1])
    signs[signs == 0] = 1
    s = np.sqrt(w)
    eig = w.tolist()
    scores = Scores(V * (signs * s))
    proj = V / (signs * np.where(s > 0, s, 1.0))
    del V
    bproj = spark.sparkContext.broadcast(proj)

    def loadings_batches(it):
        for pdf in it:
            u = (_rows(pdf) if len(pdf) else np.zeros((0, proj.shape[0]))) @ bproj.value
            yield pd.DataFrame({key: pdf[key], "af": pdf["af"], "loadings": list(u)})

    schema = T.StructType([norm.schema[key], T.StructField("af", T.DoubleType()),
                           T.StructField("loadings", T.ArrayType(T.DoubleType()))])
    with _arrow_rows(spark, fit):
        loadings = cut_lineage(norm.select(key, "af", "z").mapInPandas(loadings_batches, schema))
    return eig, scores, loadings


def scores_frame(spark, scores: Scores, sidx: DataFrame, k: int, prefix: str = "PC") -> DataFrame:
    """Sample-index scores -> (sid, PC1..PCk) by joining the sample index. They
    leave the driver as blocks of samples and become rows in tasks."""
    names = [f"{prefix}{j}" for j in range(1, k + 1)]
    m = scores.matrix
    if len(m) and m.shape[1] != k:
        raise ValueError(f"{m.shape[1]} components, {k} are needed")
    blocks = spark.createDataFrame([(a, bytearray(m[a:a + SUM_BLOCK].astype(np.float64).tobytes())) for a in range(0, len(m), SUM_BLOCK)],
                                   "first long, part binary")

    def rows(it):
        for b in it:
            for a, part in zip(b["first"], b["part"], strict=True):
                x = np.frombuffer(part).reshape(-1, k)
                yield pd.DataFrame({"sidx": np.arange(a, a + len(x)), **{c: x[:, j] for j, c in enumerate(names)}})

    df = blocks.mapInPandas(rows, "sidx long, " + ", ".join(f"{c} double" for c in names))
    return df.join(sidx, "sidx").drop("sidx")


def allele_weights(loadings: DataFrame, eig: list[float], key: str = "vid") -> DataFrame:
    """Per-variant weights scaled like PLINK's variant weights:
    loading * sqrt(eigenvalue) per component."""
    sq = F.array(*[F.lit(math.sqrt(max(e, 0.0))) for e in eig])
    return loadings.select(key, "af", F.zip_with("loadings", sq, lambda a, b: a * b).alias("weights"))
