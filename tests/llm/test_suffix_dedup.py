"""Suffix-array dedup against a direct search of every window."""

import random

import pytest

from locusframe.llm import suffix_dedup as S


def brute(rows, length):
    """Per row: removed byte places, by looking every window up."""
    first = {}
    for d, t in rows:
        raw = (t or "").encode()
        for i in range(len(raw) - length + 1):
            w = raw[i:i + length]
            key = float("inf") if d is None else d
            first[w] = min(first.get(w, key), key)
    out = []
    for d, t in rows:
        raw, gone = (t or "").encode(), set()
        for i in range(len(raw) - length + 1):
            if first[raw[i:i + length]] < (float("inf") if d is None else d):
                gone.update(range(i, i + length))
        out.append((d, bytes(b for i, b in enumerate(raw) if i not in gone), len(gone)))
    return out


def corpus(seed):
    rng = random.Random(seed)
    words = ["the", "of", "and", "éà", "thing", "on", "blue", "ing", "x"]
    text = lambda n: " ".join(rng.choice(words) + rng.choice(["", "s", "ly", str(rng.randrange(99))]) for _ in range(n))
    passages = [text(n) for n in (12, 14, 30, 80)]
    rows = []
    for i in range(60):
        parts = [text(rng.randrange(1, 40))]
        for p in passages:
            if rng.random() < 0.4:
                a = rng.randrange(0, 30)
                parts += [p[a:] if rng.random() < 0.3 else p, text(rng.randrange(0, 9))]
        rng.shuffle(parts)
        rows.append((rng.randrange(40) if rng.random() < 0.2 else i, " ".join(parts)))
    rows += [rows[3], (rows[5][0] + 100, rows[5][1]), (None, rows[7][1]), (None, rows[7][1]), (500, None), (501, ""),
             (502, "ab " * 700), (503, "ab " * 300), (-4, "ab " * 40)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,batch_bytes,length,word", [(1, 1 << 20, 50, 20), (2, 2000, 50, 20), (3, 700, 30, 12)])
def test_matches_direct_search(spark, seed, batch_bytes, length, word):
    rows = corpus(seed)
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = S.remove_repeats(df, length=length, word=word, batch_bytes=batch_bytes).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2])
    assert sorted(((r["doc_id"], bytes(r["kept"]), r["n_removed"]) for r in got), key=key) == sorted(brute(rows, length), key=key)
    for r in got:
        cuts = list(zip(r["spans"][::2], r["spans"][1::2]))
        assert sum(b - a for a, b in cuts) == r["n_removed"]
        assert all(a < b for a, b in cuts) and all(x[1] < y[0] for x, y in zip(cuts, cuts[1:]))
    slim = S.remove_repeats(df, length=length, word=word, batch_bytes=batch_bytes, texts=False)
    assert slim.columns == ["doc_id", "key", "n_bytes", "n_removed", "spans"]
    assert sorted((str(r["doc_id"]), r["key"], r["spans"]) for r in slim.collect()) == sorted(
        (str(r["doc_id"]), r["key"], r["spans"]) for r in got)


def test_empty_and_clashing_columns(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string, batch int, part string")
    assert S.remove_repeats(df).count() == 0
    one = spark.createDataFrame([(1, "abc", 9, "p")], "doc_id bigint, text string, batch int, part string")
    assert [(r["doc_id"], r["n_bytes"], bytes(r["kept"]), r["n_removed"], r["spans"]) for r in S.remove_repeats(one).collect()] == [
        (1, 3, b"abc", 0, [])]


def test_colliding_hashes(spark, monkeypatch):
    """Word and window hashes of a few bits: the check bits tell strings apart."""
    full = S._hash_at
    monkeypatch.setattr(S, "_hash_at", lambda e, at, n, seed=0: full(e, at, n, seed) if seed else full(e, at, n) & S.U(0xF00000003))
    rows = corpus(4)
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2])
    got = S.remove_repeats(df, batch_bytes=1500).collect()
    assert sorted(((r["doc_id"], bytes(r["kept"]), r["n_removed"]) for r in got), key=key) == sorted(brute(rows, 50), key=key)
