"""Left-alignment against a brute force that moves one base at a time."""

import random

import pytest

from locusframe.operators import leftalign as LA


def brute(pos, ref, alt, seq):
    """Drop equal last bases, extending to the left where an allele would be
    empty, until nothing changes; then drop equal first bases."""
    if not set(ref + alt) <= set("ACGTN"):
        return pos, ref, alt
    if ref == alt:  # no variant
        return pos, ref[0], alt[0]
    while ref[-1] == alt[-1] and (min(len(ref), len(alt)) > 1 or pos > 1):
        if min(len(ref), len(alt)) == 1:
            pos -= 1
            ref, alt = seq[pos - 1] + ref, seq[pos - 1] + alt
        ref, alt = ref[:-1], alt[:-1]
    while min(len(ref), len(alt)) > 1 and ref[0] == alt[0]:
        pos, ref, alt = pos + 1, ref[1:], alt[1:]
    return pos, ref, alt


def corpus(seed):
    rng = random.Random(seed)
    seqs = {}
    for c in ("chr1", "chr2", "chrUn_KI270706v1"):
        out = ""
        while len(out) < 700:
            out += "".join(rng.choice("ACGT") for _ in range(rng.randrange(0, 12)))
            out += "".join(rng.choice("ACGT") for _ in range(rng.randrange(1, 5))) * rng.randrange(1, 60)
        seqs[c] = "A" * 40 + out
    rows = []
    for i in range(400):
        c = rng.choice(list(seqs))
        s = seqs[c]
        p = rng.randrange(1, len(s) - 20)
        pad = rng.randrange(0, 4)
        n = rng.randrange(1, 9)
        if i % 3 == 0:
            ref, alt = s[p - 1:p + n + pad], s[p - 1] + s[p + n:p + n + pad]
        elif i % 3 == 1:
            put = (s[p:p + rng.randrange(1, 5)] or "A") * rng.randrange(1, 3)
            ref, alt = s[p - 1:p + pad], s[p - 1] + put + s[p:p + pad]
        else:
            ref, alt = s[p - 1:p + pad], rng.choice("ACGT") + s[p:p + pad]
        rows.append((i, c, p, ref, alt))
    s = seqs["chr1"]
    rows += [(900, "chr1", 5, s[4:8], s[7]), (901, "chr1", 1, s[0:3], s[0]), (902, "chr1", 2, s[1], "<DEL>"), (903, "chr1", 2, s[1], "*"),
             (904, "chr1", 300, s[299:360], s[299])]
    return seqs, rows


@pytest.mark.parametrize("seed,width,halo", [(1, 16, 5), (2, 100, 1), (3, 4096, 64)])
def test_matches_brute_force(spark, seed, width, halo):
    seqs, rows = corpus(seed)
    pieces, at = [], 0
    for c, s in seqs.items():
        at = 0
        while at < len(s):
            n = random.Random(at + seed).choice([1, 7, 60, 333])
            pieces.append((c, at + 1, s[at:at + n].lower() if n == 7 else s[at:at + n]))
            at += n
    windows = LA.reference_windows(spark.createDataFrame(pieces, "contig string, start bigint, seq string"), width, halo)
    got = LA.left_align(spark.createDataFrame(rows, "vid int, contig string, pos int, ref string, alt string"), windows, width, halo)
    assert got.columns == ["vid", "contig", "pos", "ref", "alt"]
    assert {tuple(r) for r in got.collect()} == {(v, c, *brute(p, r, a, seqs[c])) for v, c, p, r, a in rows}


def test_outside_the_windows_and_empty(spark):
    schema = "vid int, contig string, pos int, ref string, alt string"
    windows = LA.reference_windows(spark.createDataFrame([("chr1", 1, "ACCCCG")], "contig string, start int, seq string"), 8, 2)
    rows = [(1, "chr9", 5, "CC", "C"), (2, "chr1", 4, "CC", "C"), (3, "chr1", 70, "CC", "C")]
    got = {r["vid"]: tuple(r)[2:] for r in LA.left_align(spark.createDataFrame(rows, schema), windows, 8, 2).collect()}
    assert got == {1: (5, "CC", "C"), 2: (1, "AC", "A"), 3: (70, "CC", "C")}
    assert LA.left_align(spark.createDataFrame([], schema), windows, 8, 2).collect() == []
