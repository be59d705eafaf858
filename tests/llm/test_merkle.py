"""Merkle manifest against a brute force that sorts all leaves."""

import hashlib
import random
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from locusframe.llm import merkle as M

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, idx int, grp string, hash string, key int, altered string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    d, t, lang, s, n = row
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (d, s, lang, n, t)))


def tampered(row):
    d, t, lang, s, n = row
    if d is None or t is None or zlib.crc32(str(d).encode()) % 2:
        return row
    return d, t.replace("\n", ""), lang, s, n


def tree(nodes):
    """Levels, lowest first."""
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i:i + 3]) for i in range(0, len(out[-1]), 3)])
    return out


def walk(levels, i, node):
    """Siblings on the way up, and the top folded from ``node``."""
    sibs = []
    for level in levels[:-1]:
        j = i // 3 * 3
        run = level[j:j + 3]
        sibs += run[:i - j] + run[i - j + 1:]
        run[i - j] = node
        node, i = h(*run), i // 3
    return sibs, node


def brute(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[3], []).append(r)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        groups[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[s] = tree([leaf(r) for r in groups[s]])
    over = tree([trees[s][-1][0] for s in order])
    out = []
    for k, s in enumerate(order):
        for i, r in enumerate(groups[s]):
            low, node = walk(trees[s], i, leaf(tampered(r)))
            high, top = walk(over, k, node)
            out.append((r[0], leaf(r), trees[s][-1][0], over[-1][0], h(*low, *high), top, top == over[-1][0]))
    return Counter(out)


def manifest(spark, rows):
    df = spark.createDataFrame([(*r, 1, "g", "h", 2, "a") for r in rows], SCHEMA)
    alter = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    return Counter(tuple(r) for r in M.manifest(M.leaves(df, alter, F.replace("text", F.lit("\n"), F.lit("")))).collect())


def corpus(seed, n=300):
    rng = random.Random(seed)
    ids = rng.sample([*range(-200, 400), *(rng.randrange(-2**62, 2**62) for _ in range(60)), 2**63 - 1, -2**63, 63, 64, 4095, 4096], n)
    rows = [(d, rng.choice([None, "", "a\nb", "no newline", "\n", "é\n日本", "x" * 50]), rng.choice(["en", None, "fr"]),
             rng.choice(["a", "a", "a", "b", "", "é", "src10", "src9", None]), rng.choice([None, 3, -1])) for d in ids]
    rows += [(5000 + i, "only", "en", f"lone {i}", 4) for i in range(5)]
    return rows


@pytest.mark.parametrize("seed,levels", [(1, 6), (2, 1), (3, 2)])
def test_matches_brute_force(spark, monkeypatch, seed, levels):
    monkeypatch.setattr(M, "BLOCK_LEVELS", levels)
    rows = corpus(seed)
    if seed > 1:  # repeated and missing ids, equal rows
        rows += [rows[0], rows[0], (rows[1][0], "other", None, rows[1][3], 1), (None, "t", "en", "a", 1), (None, "u", "en", "a", 1),
                 (None, "t", "en", "a", 1), (None, None, None, None, None)]
    assert manifest(spark, rows) == brute(rows)


def test_small_tables(spark):
    assert manifest(spark, []) == Counter()
    for n in (1, 2, 3, 4):
        rows = [(i, "a\nb", "en", "s", 3) for i in range(n)]
        assert manifest(spark, rows) == brute(rows)


def test_long_text_and_dense_ids(spark):
    rows = [(i, f"text\n{i}", "en", "hot" if i % 3 else "s", i) for i in range(9000)] + [(9000, "long\n" * 400_000, "en", "s", 1)]
    got = manifest(spark, rows)
    assert got == brute(rows)
    assert all(r[6] == (zlib.crc32(str(r[0]).encode()) % 2 == 1) for r in got)
