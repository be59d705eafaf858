"""Cumulative depth rows, words by count, and the size check of broadcasts."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from locusframe import session
from locusframe.operators import stats as ST
from locusframe.operators import text as TX


@pytest.mark.parametrize("most", [0, 5, 500])
def test_cumulative_depths(spark, most):
    rng = random.Random(most)
    rows = [(rng.choice(["a", "b", None]), rng.choice([0, 1, 3, 5, 6, 499, 500, 900])) for _ in range(200)] + [("none", None), ("one", 2)]
    df = spark.createDataFrame(rows, "gene string, depth int")
    got = {r["gene"]: r["cum"] for r in ST.cumulative_depths(df, "gene", most=most).collect()}
    held = defaultdict(list)
    for g, d in rows:
        if d is not None:
            held[g].append(d)
    assert got == {g: [sum(min(x, most) >= d for x in v) for d in range(most + 1)] for g, v in held.items()}
    shares = ST.coverage_of_rows(ST.cumulative_depths(df, "gene", most=most), "gene", [0, 1, 501]).collect()
    for r in shares:
        v = held[r["gene"]]
        want = {0: 1.0, 1: sum(x >= 1 for x in v) / len(v) if most else None, 501: None}[r["threshold"]]
        assert r["share"] == want


def test_words_by_count(spark):
    rng = random.Random(2)
    counts = {f"w{rng.randrange(10**6)}{c}": rng.choice([1, 1, 1, 2, 7]) for c in "abcdeé" for _ in range(40)}
    df = spark.createDataFrame(list(counts.items()), "word string, n bigint")
    got = TX.words_by_count(df, 25).collect()
    assert all(len(r["words"]) <= 25 for r in got)
    lists = defaultdict(list)
    for r in sorted(got, key=lambda r: r["chunk"]):
        lists[r["n"]] += r["words"]
    assert lists == {n: sorted((w for w in counts if counts[w] == n), key=str.encode) for n in set(counts.values())}
    assert Counter(w for v in lists.values() for w in v) == Counter(counts.keys())
    assert TX.words_by_count(df.limit(0)).collect() == []


def test_broadcast_needs_few_rows_and_few_bytes(spark, monkeypatch):
    hinted = lambda df: "ResolvedHint" in df._jdf.queryExecution().analyzed().toString()
    df = spark.range(50).select("id", F.repeat(F.lit("x"), 100).alias("s"), F.array("id").alias("a"))
    assert hinted(session.broadcast_checked(df)) and not hinted(session.broadcast_checked(df, 49))
    monkeypatch.setattr(session, "BROADCAST_BYTES", 4000)
    assert not hinted(session.broadcast_checked(df))
    assert hinted(session.broadcast_checked(df.limit(0)))
