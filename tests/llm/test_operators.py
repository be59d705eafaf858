"""Operators of the llm subpackage against brute force, libraries and SQL."""

import hashlib
import random
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from locusframe.llm import (bpe, chat_format, components, exact_dedup, importance, packing, queries, simhash, syncmers,
                            token_files, toxicity)

BYTE, WORD = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))
CLASH = "doc_id bigint, text string, digest string, keep_id string, fp string, length string, n int"
TEXTS = [None, "", " ", "a", "The cat sat on the mat, twice.", "The cat sat on the mat, twice.", "é ü ñ  x\n\ny <|endoftext|> z",
         "don't WE'LL ΑΣ İ \x1c ok", "word " * 3000, "日本 語 テキスト"]


def frame(spark, texts=TEXTS, ids=None):
    ids = ids or [*range(len(texts) - 1), None]
    return spark.createDataFrame([(i, t, "d", "k", "f", "l", 1) for i, t in zip(ids, texts)], CLASH)


def empty(spark):
    return spark.createDataFrame([], CLASH)


def test_oracles(spark, duck):
    from conftest import SF_SMALL
    from oracle_check import canon
    for key, sql in queries.ORACLES.items():
        df = queries.QUERIES[key](spark, SF_SMALL)
        cur = duck.execute(sql)
        cols = [d[0] for d in cur.description]
        assert canon(df.columns, [tuple(r) for r in df.collect()]) == canon(cols, cur.fetchall()), key


@pytest.mark.parametrize("digest", [exact_dedup.sha256, lambda c: F.substring(F.sha2(c, 256), 1, 1)])
def test_exact_dedup(spark, digest):
    texts = [*TEXTS, *TEXTS, "a", "a"]
    ids = [*range(len(TEXTS)), *range(50, 50 + len(TEXTS)), 7000, 7000]
    out = exact_dedup.exact_dedup(frame(spark, texts, ids), digest).collect()
    groups = {}
    for i, t in zip(ids, texts):
        groups.setdefault(t or "", []).append(i)
    assert Counter((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in out) == Counter(
        (i, max(g), len(g), hashlib.sha256(t.encode()).hexdigest()) for t, g in groups.items() for i in g)
    assert sum(r["kept"] for r in out) == len(groups)
    assert exact_dedup.exact_dedup(empty(spark), digest).count() == 0


def test_exact_dedup_over_batches(spark):
    store = exact_dedup.StreamingDedup(spark)
    store.ingest(frame(spark, ["x", "x", "y", None], [1, 2, 3, 4]))
    store.ingest(frame(spark, ["x", "z", "x"], [1, 5, 2]))
    again = exact_dedup.StreamingDedup(spark, store.root)  # a later session goes on with the same state
    again.ingest(frame(spark, ["", "y", "w"], [9, 0, 7]))
    again.ingest(empty(spark))
    out = again.decisions().collect()
    assert Counter((r["doc_id"], r["keep_id"], r["group_size"]) for r in out) == Counter(
        [(1, 2, 4), (2, 2, 4), (1, 2, 4), (2, 2, 4), (3, 3, 2), (0, 3, 2), (4, 9, 2), (9, 9, 2), (5, 5, 1), (7, 7, 1)])
    assert sorted(r["doc_id"] for r in out if r["kept"]) == [2, 3, 5, 7, 9]


def test_chat_layouts(spark):
    recs = ['{"messages":[{"role":"user","content":"<|im_end|> <\\\\|"},{"role":"assistant","content":"x\\ny"}]}',
            '{"conversations":[{"from":"human","value":null},{"from":"gpt","value":"v"}]}', '{"odd":1}', "bad", None,
            '{"prompt":{"system":"s","user":"u"},"response":"r"}', '[{"role":"a\\n<|\\\\n","content":"t"}]']
    df = spark.createDataFrame([(i, r) for i, r in enumerate(recs)], "id int, record string")
    out = chat_format.read_back(chat_format.format_chats(chat_format.canonical_turns(df))).orderBy("id").collect()
    assert [r["layout"] for r in out] == ["messages", "conversations", None, None, None, "nested prompt", "turn list"]
    assert all(r["turns"] == r["read_turns"] for r in out)
    assert [r["loss_texts"] for r in out] == [["x\ny"], ["v"], [], [], [], ["r"], []]
    assert out[0]["formatted"].count("<|im_end|>") == 2


def test_packing(spark):
    docs = frame(spark)
    rows = packing.pack_documents(docs, BYTE, keep_ids=True).collect()
    lib = Tokenizer.from_file(BYTE)
    ids = Counter(tuple(lib.encode(t or "", add_special_tokens=False).ids) + (2,) for t in TEXTS)
    pieces = {}
    for r in rows:
        assert r["ids_crc32"] == zlib.crc32(bytes(r["ids"])) and len(r["ids"]) == 4 * r["length"] <= 4096
        pieces.setdefault(r["doc_id"], []).append(r)
    got = Counter()
    for p in pieces.values():
        p.sort(key=lambda r: r["piece"])
        assert [r["start"] for r in p] == np.cumsum([0, *(r["length"] for r in p)])[:-1].tolist()
        assert all(r["length"] == 1024 for r in p[1:])
        got[tuple(np.frombuffer(b"".join(bytes(r["ids"]) for r in p), "<u4").tolist())] += 1
    assert got == ids
    seqs = {}
    for r in rows:
        seqs.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for s in seqs.values():
        s.sort()
        assert [o for o, _ in s] == np.cumsum([0, *(n for _, n in s)])[:-1].tolist() and sum(n for _, n in s) <= 1024
    assert packing.pack_documents(empty(spark), BYTE).count() == 0


def test_packing_plan():
    rng = np.random.default_rng(5)
    hist = dict(enumerate(np.bincount(rng.integers(1, 1025, 20000), minlength=1025).tolist()))
    classes = packing.plan(hist)
    used = Counter()
    for lengths, n in classes:
        assert sum(lengths) <= 1024
        for k in lengths:
            used[k] += n
    assert used == Counter({k: n for k, n in hist.items() if n})
    assert sum(n for _, n in classes) <= 1.01 * sum(k * n for k, n in hist.items()) / 1024


def test_toxicity():
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("aeioulnrst") for _ in range(rng.randrange(2, 9)))
    text = lambda bad: " ".join([*(word() for _ in range(40)), *(["stupidity"] if bad else []), *(word() for _ in range(40))])
    y = np.array([i % 3 == 0 for i in range(300)])
    model = toxicity.train([text(b) for b in y], y)
    test = np.array([i % 2 == 0 for i in range(100)])
    assert ((model.score([text(b) for b in test]) >= 0.5) == test).mean() > 0.95
    assert model.score([word() + " stupidty " + word()])[0] > 0.5  # unseen misspelling
    assert model.score(["", " "])[0] == model.score([""])[0]
    assert toxicity.train([], np.zeros(0)).score(["x"])[0] < 0.5


def test_toxicity_scores_every_span():
    rng = np.random.default_rng(3)
    lists = [rng.normal(size=n) for n in (0, 1, 3, 4, 5, 9, 0, 40)]
    want = [max((x[i:i + 4].mean() for i in range(max(1, len(x) - 3))), default=0) if len(x) else 0 for x in lists]
    got = toxicity.most_toxic(np.concatenate(lists), np.array([len(x) for x in lists]))
    assert np.allclose(got, want)
    for front in range(4):  # two neighbours count alike wherever they stand
        x = np.zeros(12)
        x[front + 2:front + 4] = 1
        assert toxicity.most_toxic(x, np.array([12]))[0] == 0.5


def test_toxicity_query_edges(spark):
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, None), (None, 1)], "doc_id bigint, toxic int")
    out = toxicity.classify(frame(spark), labels).collect()
    assert len(out) == len(TEXTS) and all(0 <= r["score"] <= 1 for r in out)
    assert toxicity.classify(empty(spark), labels).count() == 0


def test_importance(spark):
    vals = [3.5, -2.0, 3.5, 0.0, 1e9, -1e9, 7.25]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    for k in range(1, len(vals) + 1):
        cut = importance.kth_largest(df, "v", k)
        want = sum(v >= sorted(vals)[-k] for v in vals)
        assert df.filter(importance._ordered(F.col("v")) >= cut).count() == want
    good, bad = "the cat and the dog sat on the mat and sang. " * 5, "BUY!! NOW!! CHEAP!! $$$ " * 8
    docs = frame(spark, [good + str(i) for i in range(40)] + [bad + str(i) for i in range(10)], list(range(50)))
    labels = spark.createDataFrame([(i, int(i < 40)) for i in range(0, 50, 2)], "doc_id bigint, quality int")
    out = importance.select(docs, labels).collect()
    assert {r["doc_id"] for r in out if r["selected"]} == set(range(40))
    assert importance.select(empty(spark), labels).count() == 0
    assert all(r["selected"] for r in importance.select(frame(spark), labels.limit(0)).collect())


def brute_simhash(text):
    words = bytes(c + 32 if 65 <= c <= 90 else c for c in text.encode()).split()
    if not words:
        return 0
    grams = [b" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("tree_size", [2048, 3])
def test_simhash(spark, tree_size):
    rng = random.Random(4)
    base = [" ".join(rng.choice("abcdefgh") * rng.randrange(1, 4) for _ in range(200)) for _ in range(6)]
    texts = [*TEXTS]
    for b in base:
        for _ in range(12):
            w = b.split()
            w[rng.randrange(200)] = "zz"
            texts.append(" ".join(w))
    fps = [brute_simhash(t or "") for t in texts]
    parent = list(range(len(texts)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in combinations(range(len(texts)), 2):
        if (fps[i] ^ fps[j]).bit_count() <= 4:
            a, b = sorted((root(i), root(j)))
            parent[b] = a
    ids = [10 * i for i in range(len(texts))]
    out = {r["doc_id"]: r for r in simhash.near_duplicates(frame(spark, texts, ids), tree_size=tree_size).collect()}
    assert [out[i]["fingerprint"] for i in ids] == [f"{f:016x}" for f in fps]
    assert [out[i]["component_id"] for i in ids] == [10 * root(i) for i in range(len(texts))]
    if tree_size == 3:
        assert simhash.near_duplicates(empty(spark)).count() == 0


def test_components_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 100), (200, 201), (201, 200)], "u bigint, v bigint")
    got = {r["node"]: r["label"] for r in components.connected_components(links).collect()}
    assert got == {**{i: 0 for i in range(61)}, 200: 200, 201: 200}


def test_bpe(spark):
    lib = Tokenizer.from_file(WORD)
    texts = [*TEXTS, "<|startoftext|>Hi THERE<|endoftext|>", "é́ a\tb"]
    out = bpe.decode(bpe.encode(frame(spark, texts, list(range(len(texts)))), WORD), WORD).collect()
    for r in out:
        ids = lib.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids
        assert np.frombuffer(bytes(r["ids"]), "<u4").tolist() == ids
        assert r["decoded"] == lib.decode(ids, skip_special_tokens=False)
    assert bpe.round_trip(empty(spark), WORD).count() == 0


@pytest.mark.parametrize("block", [1, 7, 1 << 20])
def test_token_files(spark, tmp_path, block):
    token_files.write_token_files(frame(spark), BYTE, f"{tmp_path}/t")
    lib = Tokenizer.from_file(BYTE)
    lib.encode_special_tokens = True
    got = token_files.count_tokens(spark, f"{tmp_path}/t", block=block).collect()
    want = Counter((i if i < len(TEXTS) - 1 else None, len(lib.encode(t or "", add_special_tokens=False).ids))
                   for i, t in enumerate(TEXTS))
    assert Counter((r["doc_id"], r["n_tokens"]) for r in got) == want and all(r["closed"] for r in got)


def test_separator_scan():
    starts, lengths, closed = token_files.scan(np.array([9, 9, 0, 0, 5, 5], "<u2"), 0, 2)
    assert (starts.tolist(), lengths.tolist(), closed) == ([0, 3, 4], [2, 0, 2], False)
    assert token_files.scan(np.zeros(0, "<u2"), 0)[0].tolist() == []




@pytest.mark.parametrize("rows_per_bucket", [4096, 2])
def test_syncmers(spark, rows_per_bucket):
    rng = random.Random(8)
    texts = [" ".join(rng.choice("abcdefgh") * rng.randrange(1, 5) for _ in range(rng.randrange(0, 80))) for _ in range(30)]
    texts[4] = texts[5] = "one two three four five six seven eight nine ten"
    texts[6] = None
    ids = rng.sample(range(1000), len(texts))
    out = {r["doc_id"]: r for r in syncmers.compare_edits(frame(spark, texts, ids), rows_per_bucket).collect()}
    order = sorted(zip(ids, texts), reverse=True)
    for n, (i, t) in enumerate(order):
        t, nxt = t or "", order[(n + 1) % len(order)][1] or ""
        half = len(t) // 2
        assert out[i]["n_chars"] == len(t)
        assert out[i]["edited_sha256"] == hashlib.sha256((t[:len(t) - half] + nxt[:half]).encode()).hexdigest()
        assert 0 <= out[i]["near_edited"] <= 1 and 0 <= out[i]["near_next"] <= 1
    assert out[ids[4]]["fingerprint"] == out[ids[5]]["fingerprint"]
    assert syncmers.compare_edits(empty(spark)).count() == 0
    one = syncmers.compare_edits(frame(spark, ["a b c d e f g h i j k l"], [3])).first()
    assert one["near_next"] == 1.0


def test_syncmers_cover_long_texts(spark):
    rng = random.Random(9)
    words = [f"w{rng.randrange(10**9)}" for _ in range(4000)]
    few = list(words)
    for at in (100, 900, 1700, 2500, 3300):
        few[at] = "changed"
    shared = [f"v{rng.randrange(10**9)}" for _ in range(4000)]
    shared[1000:1040] = words[1000:1040]
    texts = [" ".join(x) for x in (words, few, shared)]
    got = syncmers.compare_edits(frame(spark, texts, [3, 2, 1])).orderBy(F.desc("doc_id")).collect()
    anchors = [{f"{a['hash']:08x}" for a in r["a"]} for r in
               syncmers.with_anchors(frame(spark, texts, [3, 2, 1]), "text", "a").orderBy(F.desc("doc_id")).collect()]
    for i, r in enumerate(got):
        nxt = anchors[(i + 1) % 3]
        assert r["fingerprint"] == "".join(sorted(anchors[i])) and len(anchors[i]) > 1000
        assert r["near_next"] == len(anchors[i] & nxt) / len(anchors[i] | nxt)
    assert 0.98 < got[0]["near_next"] < 1 and 0 < got[1]["near_next"] < 0.05 and 0 < got[2]["near_next"] < 0.05


def brute_aligned(a, b):
    first = lambda x: {h: min(p for p, g in x if g == h) for _, h in x}
    a, b = first(a), first(b)
    if not a or not b:
        return 1.0 if not a and not b else 0.0
    shifts = Counter(b[h] - a[h] for h in set(a) & set(b))
    return max(shifts.values(), default=0) / min(len(a), len(b))


def test_syncmer_positions(spark):
    rng = random.Random(12)
    paragraphs = [[f"w{rng.randrange(10**9)}" for _ in range(50)] for _ in range(40)]
    other = [f"v{rng.randrange(10**9)}" for _ in range(2000)]
    words = sum(paragraphs, [])
    mixed = sum(rng.sample(paragraphs, 40), [])
    put = words[:700] + ["put", "in", "here"] + words[700:]
    tail = other[:10] + words
    texts = [" ".join(x) for x in (words, mixed, words, put, words, tail, words, words, other, [], ["a"] * 60)] + [None, ""]
    ids = list(range(len(texts), 0, -1))
    got = syncmers.compare_edits(frame(spark, texts, ids)).orderBy(F.desc("doc_id")).collect()
    near, at = [r["near_next"] for r in got], [r["aligned_next"] for r in got]
    assert near[0] > 0.8 and at[0] < 0.2          # the same paragraphs in another order
    assert near[2] > 0.98 and 0.6 < at[2] < 0.7   # three words put in after 700 of 2,000
    assert near[4] > 0.98 and at[4] > 0.99        # all moved by ten words
    assert (near[6], at[6]) == (1.0, 1.0) and at[7] < 0.01 and at[11] == 1.0 and at[9] == 0.0
    found = {r["doc_id"]: [tuple(a) for a in r["a"]] for r in syncmers.with_anchors(frame(spark, [t or "" for t in texts], ids), "text", "a").collect()}
    for i, r in enumerate(got):
        assert abs(r["aligned_next"] - brute_aligned(found[ids[i]], found[ids[(i + 1) % len(ids)]])) < 1e-12


def test_syncmers_without_blanks(spark):
    rng = random.Random(10)
    han = "".join(chr(rng.randrange(0x4E00, 0x9FA0)) for _ in range(1500))
    wide = "".join(chr(rng.randrange(0x20000, 0x20200)) for _ in range(600))  # two UTF-16 units each
    base = "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/") for _ in range(1500))
    for text in (han, wide, base, "x = 1; " + base):
        edit = text[:400] + "?!" + text[401:]
        got = syncmers.compare_edits(frame(spark, [text, edit, base[::-1]], [3, 2, 1])).orderBy(F.desc("doc_id")).collect()
        assert 0.9 < got[0]["near_next"] < 1 and got[1]["near_next"] < 0.01
        assert 0.2 < got[0]["near_edited"]
    edge = ["a" * 24, "a" * 25]
    rows = syncmers.with_anchors(frame(spark, [edge[0], edge[1], f"b {edge[1]}"], [1, 2, 3]), "text", "a").orderBy("doc_id").collect()
    assert [len(r["a"]) for r in rows] == [1, 18, 18 + (rows[2]["a"][0]["pos"] == 0)]


def test_closed_syncmers_by_hand(spark):
    words = "a b c d e f g h a b c d e x y z".split()
    df = spark.createDataFrame([(" ".join(words),)], "text string")
    got = syncmers.with_anchors(df, "text", "a").first()["a"]
    sign = lambda x: x - (1 << 64) if x >> 63 else x

    def chained(values):
        seed = 42
        for v in values:
            seed = xxhash.xxh64_intdigest((v % (1 << 64)).to_bytes(8, "little"), seed)
        return sign(seed)

    h = [sign(xxhash.xxh64_intdigest(w, 42)) for w in words]
    want = []
    for i in range(len(h) - 4):
        inner = [chained(h[j:j + 2]) for j in range(i, i + 4)]
        if min(inner) in (inner[0], inner[3]):
            want.append((i, chained(h[i:i + 5]) & 0xFFFFFFFF))
    assert [tuple(a) for a in got] == want
