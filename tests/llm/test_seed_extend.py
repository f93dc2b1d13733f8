import random
import re

import numpy as np

from skein.llm import seed_extend as se, textops

from .conftest import EDGE

WORD = re.compile("[^\x20\x09-\x0D]+")


def brute(rows, width=20):
    """By every window in order of id and start; rows of one id stand for one document."""
    first, out = {}, []
    words = [(2**63 - 1 if d is None else d, WORD.findall(t or "")) for d, t in rows]
    for d, w in words:
        for i in range(len(w) - width + 1):
            key = tuple(w[i:i + width])
            first[key] = min(first.get(key, (d, i)), (d, i))
    for (d, w), (doc_id, _) in zip(words, rows):
        gone = set()
        for i in range(len(w) - width + 1):
            if first[tuple(w[i:i + width])] < (d, i):
                gone |= set(range(i, i + width))
        spans = sum(i in gone and i - 1 not in gone for i in range(len(w)))
        out.append((doc_id, len(w), len(gone), spans, " ".join(x for i, x in enumerate(w) if i not in gone)))
    return sorted(out, key=repr)


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_whole_table_is_brute_force(spark):
    docs = textops.documents(spark, "/root/testdata/sf0.01")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = result(se.cut_repeats(docs))
    assert got == brute(rows) and sum(r[2] > 0 for r in got) > 20


def test_random_passages_with_ties_and_repeated_rows(spark, monkeypatch):
    rng = random.Random(8)
    pool = [" ".join(rng.choice("abcdefgh") for _ in range(rng.randrange(10, 60))) for _ in range(12)]
    rows = []
    for i in range(160):
        parts = [rng.choice(pool) if rng.random() < 0.7 else " ".join(rng.choice("abc") for _ in range(rng.randrange(30)))
                 for _ in range(rng.randrange(6))]
        rows.append((rng.choice([i, i, 7, None]), rng.choice([" ", "\n", "  "]).join(parts)))
    rows += rows[:20] + [(500, "x " * 3000), (501, "x " * 50), (502, pool[0]), (503, pool[0])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(se.cut_repeats(df.repartition(3))) == brute(rows)


def test_anchors_follow_content():
    rng = np.random.default_rng(9)
    w = rng.integers(0, 2**63, 400).astype(np.uint64)
    w[200:260] = w[20:80]
    first, anchor, gram = se.winnow(w, np.array([0, 150, 400]))
    by = dict(zip(first.tolist(), zip((anchor - first).tolist(), gram.tolist())))
    assert set(by) == set(range(131)) | set(range(150, 381))
    assert all(by[i] == by[i + 180] for i in range(20, 61))
    h = se.window_hashes(w, first)
    at = dict(zip(first.tolist(), h.tolist()))
    assert at[25] == at[205] and len(set(h.tolist())) == len(h) - 41


def test_edge_rows(spark, edge, empty):
    assert result(se.cut_repeats(edge)) == brute([(r[0], r[1]) for r in EDGE])
    assert se.cut_repeats(empty).count() == 0
