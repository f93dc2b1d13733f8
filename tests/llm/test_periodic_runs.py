import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from skein.llm import periodic_runs as pr, textops

from .conftest import EDGE, SF

WORD = re.compile("[^\x20\x09-\x0D]+")


def brute_runs(w, least=12):
    """Every maximal stretch by definition: for each period the maximal blocks of w[i] == w[i + p]."""
    n, out = len(w), {}
    for p in range(1, n // 2 + 1):
        i = 0
        while i + p < n:
            j = i
            while j + p < n and w[j] == w[j + p]:
                j += 1
            if j > i and j - i + p >= max(least, 2 * p):
                out.setdefault((i, j - i + p), p)  # the smallest period comes first
            i = max(j, i + 1)
    return sorted((s, l, p) for (s, l), p in out.items())


def brute_row(doc_id, text):
    w = WORD.findall(text or "")
    n, h = len(w), zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(w)
    gone = {i for s, l, p in runs for i in range(s + p, s + l)}
    best = min(((-l, s, p) for s, l, p in runs), default=None)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (len(runs), *((best[1], -best[0], best[2], 1000 * -best[0] // best[2]) if best else (None,) * 4),
            sha("".join(f"{s},{l},{p}\n" for s, l, p in runs)), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


def test_runs_of_random_words():
    rng = random.Random(4)
    for round_ in range(300):
        rows = []
        for _ in range(rng.randrange(1, 6)):
            w = []
            while len(w) < rng.randrange(150):
                part = [rng.randrange(rng.choice([2, 3, 50])) for _ in range(rng.randrange(1, 30))]
                w += part * rng.choice([1, 1, 2, 3, 7])
            rows.append(np.array(w, np.int64))
        least = rng.choice([2, 12])
        got = list(zip(*(c.tolist() for c in pr.maximal_runs(rows, least))))
        assert got == [(r, *x) for r, w in enumerate(rows) for x in brute_runs(w.tolist(), least)]


def test_extensions_from_cover_samples():
    rng = np.random.default_rng(5)
    assert {(a - b) % pr.MODULUS for a in pr.COVER for b in pr.COVER} == set(range(pr.MODULUS))
    for alphabet, n in ((1, 400), (2, 700), (3, 90)):
        x = np.append(rng.integers(0, alphabet, n), 99)
        x[n // 2:n] = x[:n - n // 2]
        i, j = rng.integers(0, n, 3000), rng.integers(0, n, 3000)
        i, j = i[i != j], j[i != j]
        want = [next((t for t in range(n + 1) if max(a, b) + t > n or x[a + t] != x[b + t])) for a, b in zip(i, j)]
        ext = pr.Extensions(x)
        assert ext.common(i, j).tolist() == want and ext.samples is not None


def test_query_is_brute_force(spark):
    rows = textops.documents(spark, SF).select("doc_id", "text").collect()
    got = {r.doc_id: tuple(r)[1:] for r in pr.op12_periodic_runs(spark, SF).collect()}
    want = {r.doc_id: brute_row(r.doc_id, r.text) for r in rows}
    assert got == want and sum(v[0] > 0 for v in got.values()) > len(got) // 20


def test_edge_rows(spark, edge, empty):
    got = sorted(((r.doc_id or 0, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in pr.periodic_runs(edge).collect()))
    want = []
    for d, t, _ in EDGE:
        w = WORD.findall(t or "")
        runs = brute_runs(w) if len(w) < 5000 else [(0, 30_000, 1)]
        gone = {i for s, l, p in runs for i in range(s + p, s + l)}
        want.append((d or 0, len(w), runs, " ".join(x for i, x in enumerate(w) if i not in gone)))
    assert got == sorted(want)
    assert pr.periodic_runs(empty).count() == 0
    altered = {(r.doc_id, r.text) for r in pr.with_planted_periods(edge).collect()}
    assert (1, None) in altered and (None, EDGE[8][1]) in altered
