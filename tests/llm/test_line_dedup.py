"""Line dedup against a brute force over lists of lines."""

import random
from collections import Counter, defaultdict

import pytest

from locusframe.llm import line_dedup as L

BLANKS = " \t\n\x0b\x0c\r"
SCHEMA = "doc_id bigint, text string, hash string, key int, pos string, first string, n int, _hot int"
UP = {c: c + 32 for c in range(65, 91)}


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "h", 1, "p", "f", 2, 3) for i, t in rows], SCHEMA)


def brute(rows, min_chars, min_docs):
    order = lambda d: (d is None, d or 0)
    key = lambda line: line.strip(BLANKS).translate(UP)
    holders = defaultdict(set)
    for d, t in rows:
        for line in (t or "").split("\n"):
            holders[key(line)].add(order(d))
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        gone = [i for i, x in enumerate(lines) if len(key(x)) >= min_chars and len(holders[key(x)]) >= min_docs
                and min(holders[key(x)]) != order(d)]
        out.append((d, len(lines), tuple(gone), "\n".join(x for i, x in enumerate(lines) if i not in set(gone))))
    return Counter(out)


def corpus(seed):
    rng = random.Random(seed)
    pool = ["", " ", "short", "exactly10!", "\t EXACTLY10! \r", "Éclair au chocolat", "éclair au chocolat", "a line that many share",
            "A Line That Many SHARE  ", "İstanbul ΑΣ line", "日本語のテキストの一行です", "x" * 3000, " nbsp line here", "tab\tinside line"]
    rows = [(i, "\n".join(rng.choice(pool) + (str(rng.randrange(5)) if rng.random() < .3 else "")
                          for _ in range(rng.randrange(1, 12)))) for i in range(80)]
    rows += [(3, "a line that many share\nother text of three"), (3, rows[3][1]), rows[5], rows[5], (None, rows[7][1]), (None, rows[7][1]),
             (None, "only without an id"), (-5, None), (90, ""), (91, "\n"), (92, "\n\n" + "a line that many share\n" * 400)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,min_chars,min_docs", [(1, 10, 2), (2, 0, 5), (3, 4, 3)])
def test_matches_brute_force(spark, seed, min_chars, min_docs):
    rows = corpus(seed)
    got = L.dedup_lines(frame(spark, rows), min_chars, min_docs).collect()
    assert Counter((r["doc_id"], r["n_lines"], tuple(r["dropped"]), r["kept"]) for r in got) == brute(rows, min_chars, min_docs)


def test_hot_line_and_long_text(spark):
    long = "\n".join(f"line number {i} of a long text" for i in range(60000))
    rows = [(i, f"the very same first line\nbody {i} of the document") for i in range(3000)] + [(9000, long), (9001, long)]
    got = {r["doc_id"]: r for r in L.dedup_lines(frame(spark, rows)).collect()}
    assert got[0]["kept"] == rows[0][1] and got[2999]["kept"] == "body 2999 of the document"
    assert got[9000]["kept"] == long and got[9001]["kept"] == "" and got[9001]["n_lines"] == 60000 == len(got[9001]["dropped"])


def test_empty_table_and_one_document(spark):
    assert L.dedup_lines(frame(spark, [])).collect() == []
    one = L.dedup_lines(frame(spark, [(1, "a repeated line\na repeated line")])).collect()
    assert [(r["n_lines"], r["dropped"], r["kept"]) for r in one] == [(2, [], "a repeated line\na repeated line")]


def test_no_python_workers(spark):
    plan = L.dedup_lines(frame(spark, corpus(1)))._jdf.queryExecution().toString()
    assert "Python" not in plan and "InPandas" not in plan and "InArrow" not in plan
