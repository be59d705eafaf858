"""Overlap joins by levels, chained remaps and grouped fits against brute force."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from locusframe.operators import levels as LV
from locusframe.operators import remap as RM
from locusframe.operators.regress import fit_groups, residualize_groups

IV = "contig string, start bigint, end bigint, name string"


def spans(seed, n):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        size = rng.choice([0, 1, 1, 50, 16384, 16385, 10**5, 10**6, 10**8, 3 * 10**9])
        a = rng.choice([0, 16383, 16384, 8 * 16384, rng.randrange(2 * 10**6)])
        out.append((rng.choice(["chr1", "chr2"]), a, a + size, f"{seed}-{i % 40}"))
    return out


def meets(x, y):
    return x[0] == y[0] and x[1] < y[2] and y[1] < x[2] and x[2] > x[1] and y[2] > y[1]


def test_pairs_and_points(spark):
    a, b = spans(1, 150), spans(2, 150)
    da, db = spark.createDataFrame(a, IV), spark.createDataFrame(b, IV)
    got = Counter(tuple(r) for r in LV.overlap_pairs_by_level(da, db).collect())
    assert got == Counter((*x, *y) for x in a for y in b if meets(x, y))
    assert LV.overlap_pairs_by_level(da.limit(0), db).collect() == []
    pts = [(i, c, p) for i, (c, p) in enumerate([(x[0], x[1]) for x in b] + [(x[0], max(0, x[2] - 1)) for x in a] + [("chr9", 4), ("chr1", 10**10)])]
    dp = spark.createDataFrame(pts, "id int, contig string, pos bigint")
    want = [(p, x) for p in pts for x in a if x[0] == p[1] and x[1] <= p[2] < x[2]]
    inner = Counter(tuple(r) for r in LV.points_by_level(dp, da).collect())
    assert inner == Counter((*p, *x[1:]) for p, x in want)
    hit = {p[0] for p, _ in want}
    assert {r["id"] for r in LV.points_by_level(dp, da, how="left_semi").collect()} == hit
    assert {r["id"] for r in LV.points_by_level(dp, da, how="left_anti").collect()} == {p[0] for p in pts} - hit
    left = LV.points_by_level(dp, da, how="left").collect()
    assert len(left) == len(want) + len(pts) - len(hit)


def brute_remap(iv, blocks, share):
    out = []
    for c, a, e, way in iv:
        runs = {}
        for chain, src, bs, be, dst, ds, s in blocks:
            lo, hi = max(a, bs), min(e, be)
            if src == c and lo < hi:
                n = ds + (lo - bs if s == "+" else be - hi)
                r = runs.setdefault((chain, dst, s), [0, n, n])
                r[0], r[1], r[2] = r[0] + hi - lo, min(r[1], n), max(r[2], n + hi - lo)
        need = share * (e - a)
        good = [(k, v) for k, v in runs.items() if v[0] >= need]
        total = min(sum(v[0] for v in runs.values()), e - a)
        if not runs:
            out.append((c, a, e, way, None, None, None, None, None, "deleted"))
        elif len(good) == 1:
            (chain, dst, s), v = good[0]
            strand = way if s == "+" else "-" if way == "+" else "+"
            out.append((c, a, e, way, dst, v[1], v[2], strand, chain, None))
        else:
            out.append((c, a, e, way, None, None, None, None, None, "duplicated" if good else "split" if total >= need else "partial"))
    return Counter(out)


@pytest.mark.parametrize("seed", [1, 2])
def test_remap(spark, seed):
    rng = random.Random(seed)
    blocks = []
    for chain in range(12):
        at, to, way, dst = rng.randrange(3000), rng.randrange(10**6), rng.choice("+-"), rng.choice(["n1", "n2"])
        parts = []
        for _ in range(rng.randrange(1, 6)):
            size = rng.choice([5, 40, 300])
            parts.append((at, at + size))
            at += size + rng.randrange(0, 30)
        low, high = parts[0][0], parts[-1][1]
        for a, e in parts:
            blocks.append((f"c{chain}", rng.choice(["s1"]), a, e, dst, to + (a - low if way == "+" else high - e), way))
    iv = [("s1", a, a + rng.choice([0, 1, 20, 200, 900]), rng.choice("+-")) for a in (rng.randrange(3500) for _ in range(300))] + [("s9", 1, 5, "+")]
    iv += iv[:5]
    df = spark.createDataFrame(iv, "contig string, start bigint, end bigint, strand string")
    b = spark.createDataFrame(blocks, "chain string, src string, block_start bigint, block_end bigint, dst string, dst_start bigint, strand string")
    got = RM.remap_chains(df, b, 0.6, strand="strand").collect()
    assert Counter((*tuple(r)[:9], r["reason"]) for r in got) == brute_remap(iv, blocks, 0.6)
    assert all((r["share"] >= 0.6) == (r["reason"] != "partial") for r in got if r["reason"] not in ("deleted",))
    assert RM.remap_chains(df.limit(0), b).collect() == []


def test_group_fits_equal_numpy(spark):
    rng = np.random.default_rng(3)
    rows = []
    for g in ("a", "b", None, "one"):
        for _ in range(1 if g == "one" else 60):
            x = rng.normal(size=3) * [1, 1e-4, 1e4] + [5, 0, 1e6]
            rows.append((g, *map(float, x), float(x @ [2, 3e3, 1e-4] + rng.normal())))
    rows.append(("a", None, 1.0, 1.0, 1.0))
    df = spark.createDataFrame(rows, "g string, x1 double, x2 double, x3 double, y double").withColumn("x4", F.col("x1") * 2)
    xs = ["x1", "x2", "x3"]
    out = residualize_groups(df, "y", xs, ["g"]).collect()
    assert len(out) == len(rows)
    for g in ("a", "b", None):
        part = [r for r in out if r["g"] == g and r["x1"] is not None]
        x = np.array([[1.0, *(r[c] for c in xs)] for r in part])
        x[:, 1:] -= x[:, 1:].mean(0)
        y, res = np.array([r["y"] for r in part]), np.array([r["residual"] for r in part])
        s = np.abs(x).max(0)
        want = y - (x / s) @ np.linalg.lstsq(x / s, y, rcond=None)[0]
        assert np.allclose(res, want, atol=1e-6)
        assert np.abs((x / s).T @ res).max() < 1e-6  # orthogonal to every covariate
    assert [r["residual"] for r in out if r["x1"] is None] == [None]
    assert abs(next(r["residual"] for r in out if r["g"] == "one")) < 1e-9
    # covariates that depend on each other give the same residuals
    again = {(r["g"], r["y"]): r["residual"] for r in residualize_groups(df, "y", [*xs, "x4"], ["g"]).collect()}
    assert all(r["residual"] is None or abs(again[r["g"], r["y"]] - r["residual"]) < 1e-5 for r in out)
    whole = residualize_groups(df, "y", xs).where("residual IS NOT NULL").agg(F.sum("residual")).first()[0]
    assert abs(whole) < 1e-5
    assert fit_groups(df.limit(0), "y", xs, ["g"]).collect() == []


def test_points_by_level_broadcasts_no_exploded_points(spark):
    from locusframe.operators import levels as LV
    points = spark.range(50).selectExpr("id AS vid", "'chr1' AS contig", "id * 10 AS pos")
    iv = spark.range(50).selectExpr("'chr1' AS contig", "id * 10 AS start", "id * 10 + 1 AS end", "'k' AS kind")
    for how in ("inner", "left", "left_semi"):
        got = LV.points_by_level(points, iv, how=how)
        assert "Broadcast" not in got._jdf.queryExecution().executedPlan().toString()
        assert got.count() == 50


@pytest.mark.parametrize("top", range(LV.LEVELS))
def test_pairs_are_the_same_with_every_top_level(spark, top):
    odd = [(None, 0, 9, "n"), ("chr1", None, 9, "s"), ("chr1", 0, None, "e"), ("chr1", 40, 20, "turned"), ("chr1", -20000, 5, "below")]
    a, b = [x for x in spans(3, 80) if x[2] < 10**9] + odd, [x for x in spans(4, 80) if x[2] < 10**9] + odd * 2
    da, db = spark.createDataFrame(a, IV), spark.createDataFrame(b, IV)
    want = Counter((*x, *y) for x in a for y in b if None not in (*x, *y) and meets(x, y))
    for many in (1, 10**9):  # rows said to be few, and too many to broadcast
        got = LV.overlap_pairs_by_level(da, db, fitted=(top, [many, many]))
        assert Counter(tuple(r) for r in got.collect()) == want


def _laid_out(df):
    """Rows that the run plan laid into bins."""
    df.collect()
    todo, rows = [df._jdf.queryExecution().executedPlan()], 0
    while todo:
        n = todo.pop()
        if "AdaptiveSparkPlan" in n.nodeName():
            todo.append(n.executedPlan())
        elif "QueryStage" in n.nodeName():
            todo.append(n.plan())
        else:
            if n.nodeName() == "Generate":
                rows += n.metrics().get("numOutputRows").get().value()
            todo += [n.children().apply(i) for i in range(n.children().size())]
    return rows


def test_overlap_pairs_send_short_intervals_once(spark):
    a = spark.range(20).selectExpr("'chr1' AS contig", "id * 200000 AS start", "id * 200000 + 100000 AS end", "'long' AS kind")
    b = spark.range(4000).selectExpr("'chr1' AS contig", "id * 1000 AS start", "id * 1000 + 20 AS end", "'short' AS kind")
    pairs = LV.overlap_pairs_by_level(a, b)
    assert pairs.count() == 2000
    assert _laid_out(pairs) < 6000  # once a level: 24,000


def test_fitted_top_counts_rows(spark):
    wide = spark.range(1000).selectExpr("'chr1' AS contig", "id * 1000 AS start", "id * 1000 + 100000000 AS end")
    point = spark.range(1000).selectExpr("'chr1' AS contig", "id * 1000 AS start", "id * 1000 + 1 AS end")
    assert LV.fitted_top([wide.limit(1), point]) == (1, [763, 2000])  # wide: 6,104 rows at level 0
    assert LV.fitted_top([wide, point])[0] == 4  # bins of 67,108,864 bases
    assert LV.fitted_top([point, point]) == (0, [1000, 1000])
    assert LV.fitted_top([point.limit(0), point.limit(0)]) == (0, [0, 0])
    assert LV.fitted_top([point.limit(5), point.limit(5).selectExpr("contig", "start", "start + 2000000000 AS end")])[0] > 0
