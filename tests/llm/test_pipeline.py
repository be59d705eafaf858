"""The stages of the corpus pipeline against brute force."""

import random
from collections import Counter, defaultdict

import corpus_pipeline as CP
import public_tokenizers
import pytest
import xxhash
from tokenizers import Tokenizer

from locusframe.llm import importance

DOCS = "doc_id bigint, text string, n_chars int, key string, spans string, label string"


def corpus():
    rng = random.Random(5)
    words = ["the", "of", "naïve", "日本", "thing", "on", "blue", "river", "stone", "x"]
    text = lambda n: " ".join(rng.choice(words) + str(rng.randrange(999)) for _ in range(n))
    passages = [text(n) for n in (15, 40, 90)]
    texts = []
    for _ in range(40):
        parts = [text(rng.randrange(3, 60)), *[p for p in passages if rng.random() < 0.3], text(5)]
        rng.shuffle(parts)
        texts.append(" ".join(parts))
    base = text(400)
    texts += [base, base + " end", base.replace("the", "The"), texts[0], texts[0], texts[7], None, "", "a", "日" * 60, "本" + "日" * 60]
    rows = list(zip(range(len(texts)), texts))
    rng.shuffle(rows)
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(d, t, len(t or ""), "k", "s", "l") for d, t in rows], DOCS)


def brute_copies(rows):
    best = {}
    for d, t in rows:
        best[t or ""] = max(best.get(t or "", (d, t)), (d, t), key=lambda r: r[0])
    return sorted(best.values(), key=lambda r: r[0])


def fingerprint(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        lowered = lowered.replace(c, " ")
    w = [x for x in lowered.split(" ") if x]
    grams = [" ".join(w[i:i + 4]) for i in range(max(1, len(w) - 3))] if w else []
    h = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_near(rows):
    fps, group = {d: fingerprint(t) for d, t in rows}, {d: d for d, _ in rows}
    changed = True
    while changed:
        changed = False
        for a in fps:
            for b in fps:
                if (fps[a] ^ fps[b]).bit_count() <= 4 and group[a] < group[b]:
                    group[b], changed = group[a], True
    return [(d, t) for d, t in rows if group[d] == d]


def brute_cut(rows):
    first = {}
    for d, t in rows:
        raw = (t or "").encode()
        for i in range(len(raw) - 49):
            first[raw[i:i + 50]] = min(first.get(raw[i:i + 50], d), d)
    out = []
    for d, t in rows:
        raw, gone = (t or "").encode(), set()
        for i in range(len(raw) - 49):
            if first[raw[i:i + 50]] < d:
                gone.update(range(i, i + 50))
        kept, at = [], 0
        for c in t or "":
            n = len(c.encode())
            if not gone.issuperset(range(at, at + n)):
                kept.append(c)
            at += n
        out.append((d, "".join(kept) if gone else t))
    return out


def pairs(df):
    got = df.collect()
    assert all(r["n_chars"] == len(r["text"] or "") for r in got)
    assert {(r["key"], r["spans"], r["label"]) for r in got} <= {("k", "s", "l")}
    return sorted((r["doc_id"], r["text"]) for r in got)


@pytest.mark.parametrize("stage,brute", [(CP.drop_copies, brute_copies), (CP.drop_near_copies, brute_near), (CP.cut_passages, brute_cut)])
def test_stage(spark, stage, brute):
    rows = corpus()
    assert pairs(stage(spark, frame(spark, rows), "")) == sorted(brute(sorted(rows, key=lambda r: r[0])))
    none = stage(spark, frame(spark, rows).limit(0), "")
    assert none.count() == 0 and none.columns == frame(spark, rows).columns


def test_quality_stage(spark, tmp_path):
    rows = corpus()
    docs = frame(spark, rows)
    labels = spark.createDataFrame([(d, int(d % 2), 0) for d, _ in rows], "doc_id bigint, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    chosen = {r["doc_id"] for r in importance.select(docs, labels).filter("selected").collect()}
    assert chosen and pairs(CP.keep_quality(spark, docs, str(tmp_path))) == sorted((d, t) for d, t in rows if d in chosen)


def test_run(spark, tmp_path):
    rows = corpus()
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    want = brute_cut(brute_near(brute_copies(rows)))  # without labels the first stage keeps all
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces, places = Counter(), defaultdict(list)
    for r in CP.run(spark, str(tmp_path)).collect():
        pieces[r["doc_id"]] += r["length"]
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    assert pieces == {d: len(tok.encode(t or "", add_special_tokens=False).ids) + 1 for d, t in want}
    for p in places.values():
        p.sort()
        assert [o for o, _ in p] == [sum(n for _, n in p[:i]) for i in range(len(p))] and sum(n for _, n in p) <= 1024


def test_clashing_columns(spark):
    """Columns named like the stages' helpers keep their values."""
    names = ["_text_key", "_spans", "_id", "_cut", "_whole", "_found_key", "_found_doc_id", "_FOUND_spans", "key"]
    rows = corpus()
    df = spark.createDataFrame([(d, t, *(f"{c}{d}" for c in names)) for d, t in rows],
                               "doc_id bigint, text string, " + ", ".join(f"{c} string" for c in names))
    for stage, want in ((CP.drop_copies, brute_copies), (CP.drop_near_copies, brute_near), (CP.cut_passages, brute_cut)):
        got = stage(spark, df, "").collect()
        assert sorted((r["doc_id"], r["text"] or "") for r in got) == sorted((d, t or "") for d, t in want(rows)), stage
        assert all(r[c] == f"{c}{r['doc_id']}" for r in got for c in names)
        assert stage(spark, df.limit(0), "").collect() == []
