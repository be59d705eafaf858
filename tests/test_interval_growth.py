"""Range joins whose work must not grow with the intervals around a point."""

import random

import pytest

from locusframe.operators import intervals as IV


def _brute(points, feats, reach):
    best = {}
    for v, c, p in points:
        for fc, s, e, n in feats:
            if c is None or p is None or p < 0 or fc != c or e is None:
                continue
            d = max(0, p - (e - 1), *([] if s is None else [s - p]))
            lo = max((0 if s is None else s) - reach, 0)
            if lo <= p < e + reach and d <= reach:
                cand = (d, n is not None, n or "")
                best[v] = min(best.get(v, cand), cand)
    return {v: (b[0], b[2] if b[1] else None) for v, b in best.items()}


@pytest.mark.parametrize("reach,width", [(50, 200), (300, 100), (0, 10)])
def test_nearest_feature_equals_brute_force(spark, reach, width):
    r = random.Random(reach)
    feats = [(r.choice(["a", "b"]), s := r.randrange(3000), s + r.choice([0, 1, 7, 64, 65, 400]), r.choice("pqrstu")) for _ in range(60)]
    feats += [("a", 900, 870, "inverted"), ("a", None, 40, "open"), (None, 5, 9, "x"), ("b", 10, None, "y"), ("b", 2000, 2010, None)] + feats[:5]
    points = [(i, r.choice(["a", "b", "z"]), r.randrange(-20, 3600)) for i in range(400)] + [(7, "a", 871), (7, "b", 3), (None, "a", 885), (900, None, 5), (901, "a", None)]
    f = spark.createDataFrame(feats, "contig string, start long, end long, name string")
    p = spark.createDataFrame(points, "vid long, contig string, pos long")
    got = IV.nearest_feature(p, f, reach, width=width)
    assert got.dtypes == [("vid", "bigint"), ("feature", "string"), ("distance", "bigint")]
    rows = got.collect()
    assert len(rows) == len({x["vid"] for x in rows})
    assert {x["vid"]: (x["distance"], x["feature"]) for x in rows} == _brute(points, feats, reach)


def _largest_rows(df):
    """Rows out of the widest operator of the run plan."""
    df.collect()
    todo, most = [df._jdf.queryExecution().executedPlan()], 0
    while todo:
        n = todo.pop()
        if "AdaptiveSparkPlan" in n.nodeName():
            todo.append(n.executedPlan())
            continue
        if "QueryStage" in n.nodeName():
            todo.append(n.plan())
        m = n.metrics().get("numOutputRows")
        most = max(most, m.get().value() if m.isDefined() else 0)
        todo += [n.children().apply(i) for i in range(n.children().size())]
    return most


def test_nearest_feature_makes_no_pair_of_point_and_feature(spark):
    f = spark.range(4000).selectExpr("'a' AS contig", "id AS start", "id + 20 AS end", "concat('n', id) AS name")
    p = spark.range(2000).selectExpr("id AS vid", "'a' AS contig", "id * 2 AS pos")
    assert _largest_rows(IV.nearest_feature(p, f, 1000, width=5000)) < 60_000  # pairs in reach: about 3.5 million


def test_overlap_pairs_bins_as_narrow_as_the_intervals(spark):
    r = random.Random(3)
    iv = [("a", s := r.randrange(4000), s + r.choice([0, 1, 5, 9])) for _ in range(500)] + [("a", 100, 2600), ("a", 50, 40), ("b", 3, 8), (None, 3, 8)]
    df = spark.createDataFrame(iv, "contig string, start long, end long")
    assert IV.fitted_width([df], "start", "end", 10_000) < 20
    assert IV.fitted_width([df], "start", "end", 4) == 4
    assert IV.fitted_width([df.limit(0)], "start", "end", 10) == 1
    got = sorted(tuple(x) for x in IV.overlap_pairs(df, df, width=10_000).select("start_a", "end_a", "start_b", "end_b").collect())
    assert got == sorted((a[1], a[2], b[1], b[2]) for a in iv for b in iv if a[0] and a[0] == b[0] and a[1] < b[2] and b[1] < a[2])
