"""Spelling variants against a brute force over all pairs of words."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from locusframe.llm import spelling as W

SCHEMA = "doc_id bigint, text string, word string, n int, own int, shard string, best string, form string, root string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "w", 1, 2, "s", "b", "f", "r") for i, t in rows], SCHEMA)


def distance_one(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def counted(rows, drop_every, min_chars, min_count):
    n = Counter()
    for d, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if h % drop_every == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= min_chars and c >= min_count}


def brute(rows, drop_every=31, min_chars=7, min_count=2, ratio=10):
    n = counted(rows, drop_every, min_chars, min_count)
    near = {w: [x for x in n if distance_one(w, x)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= ratio * n[w] else None
    out = set()
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return out


def corpus(seed):
    rng = random.Random(seed)
    stems = ["thinking", "thought", "écluses", "Éclusesà", "naïveté", "STRANGE", "strange", "stranger", "ß" * 8, "abababab", "x÷y×zzzz",
             "e" * 60, "q" * 30 + "rst" * 20]
    rows = []
    for i in range(60):
        ws = []
        for _ in range(rng.randrange(0, 60)):
            w = list(rng.choice(stems[:1] * 12 + stems))
            for _ in range(rng.choice([0, 0, 0, 0, 1, 1, 2])):
                k = rng.randrange(len(w))
                w[k:k + rng.choice([0, 1])] = rng.choice(["", rng.choice("abeé×")])
            ws.append("".join(w))
        rows.append((i, rng.choice([" ", ", ", "\n", "1"]).join(ws)))
    return rows + [(None, rows[3][1]), (None, None), (-7, ""), (5, rows[4][1]), rows[6], rows[6], (2**62, "日本語 thinking İstanbul")]


@pytest.mark.parametrize("seed,shard_words,leaf,many", [(1, 40_000, 16, 1 << 16), (2, 40, 3, 1 << 16), (3, 60, 4, 8)])
def test_matches_brute_force(spark, monkeypatch, seed, shard_words, leaf, many):
    monkeypatch.setattr(W, "LEAF_WORDS", leaf)
    monkeypatch.setattr(W, "MANY_PAIRS", many)
    monkeypatch.setattr(W, "COUNT_BYTES", 20_000)
    rows = corpus(seed)
    got = W.variants(frame(spark, rows), shard_words=shard_words).collect()
    assert len(got) == len({r["word"] for r in got})
    assert {(r["word"], r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in got} == brute(rows)


def test_chains_of_forms(spark):
    steps = [("abcdefg", 2), ("abcdefgh", 25), ("abcdefghi", 300), ("abcdefghij", 3100), ("abcdefghijk", 32000)]
    rows = [(1, " ".join(" ".join([w] * n) for w, n in steps))]
    got = {r["word"]: r for r in W.variants(frame(spark, rows), drop_every=2**31 - 1).collect()}
    assert [got[w]["root"] for w, _ in steps] == ["abcdefghijk"] * 5
    assert [got[w]["form"] for w, _ in steps] == [w for w, _ in steps[1:]] + [None]


def test_ties_go_by_code_points(spark):
    rows = [(1, " ".join(["strange"] + ["strange"] + ["strangé"] * 20 + ["stranga"] * 20 + ["strangz"] * 20))]
    got = {r["word"]: r["form"] for r in W.variants(frame(spark, rows), drop_every=2**31 - 1).collect()}
    assert got["strange"] == "stranga"


def test_anagrams_meet_by_their_remainders():
    rng = random.Random(5)
    words = sorted({"".join(rng.sample("abcdefgg", 8)) for _ in range(900)} | {"".join(rng.sample("abcdefg", 7)) for _ in range(300)})
    held = W.Words(words)
    every = np.arange(len(words))
    want = {(i, j) for i in range(len(words)) for j in range(len(words)) if distance_one(words[i], words[j])}
    assert W.by_remainders(held.raw, every, every) == want
    got = [x for x in W.search(held, every, every)]
    assert {(int(a), int(b)) for x, y in got for a, b in zip(x, y)} == want == {
        p for p in want} and sum(len(x) for x, _ in got) == len(want)


def test_long_words_and_empty_table(spark):
    long = "longword" * 3_000
    rows = [(1, f"{long} {long} {long[:-1]} {long[:-1]} {'z' + long[1:]} {'z' + long[1:]}")]
    got = {r["word"]: r["n_near"] for r in W.variants(frame(spark, rows), drop_every=2**31 - 1).collect()}
    assert got == {long: 2, long[:-1]: 1, "z" + long[1:]: 1}
    assert W.variants(frame(spark, [])).collect() == []
