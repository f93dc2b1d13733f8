import random
import re
import zlib
from collections import Counter, defaultdict

from skein.llm import spelling_trie as st, textops

from .conftest import SF

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_counts(rows, modulus=None, least=6):
    n = Counter()
    for d, t in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = w.translate(LOWER)
            h = zlib.crc32(f"{d}:{w}".encode())
            if modulus and d is not None and h % modulus == 0:
                k = h % len(w)
                w = w[:k] + w[k + 1:]
            if len(w) >= least:
                n[w] += 1
    return n


def brute_groups(n, ratio=5):
    """By shared one-deletion strings, checked pair by pair."""
    shapes = defaultdict(set)
    for w in n:
        for i in range(len(w)):
            shapes[w[:i] + "*" + w[i + 1:]].add(w)  # replaced there
            shapes[w[:i] + w[i + 1:]].add(w)
        shapes[w].add(w)
    near = defaultdict(set)
    for s, group in shapes.items():
        for a in group:
            for b in group:
                if a < b and ("*" in s or s in (a, b)):
                    near[a].add(b)
                    near[b].add(a)
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= ratio * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, n[w], len(near[w]), form[w], n[form[w]] if form[w] else None, root))
    return sorted(out)


def groups(df):
    return sorted((r.word, r.n, r.n_near, r.form, r.form_n, r.root) for r in df.collect())


def test_query_is_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    n = brute_counts([(r.doc_id, r.text) for r in textops.documents(spark, sf).select("doc_id", "text").collect()], 199)
    want = brute_groups(Counter({w: c for w, c in n.items() if c >= 5}))
    got = groups(st.op11_spelling_trie(spark, sf))
    assert got == want and any(x[3] for x in got) and len(got) > 100


def test_random_words(spark):
    rng = random.Random(6)
    words = {"".join(rng.choice("abé") for _ in range(rng.randrange(1, 9))) for _ in range(400)}
    words |= {"", "z" * 3000, "z" * 3001, "z" * 2999 + "y", "q" * 2000, "q" * 900 + "r" + "q" * 1099, "ab" * 700}
    n = Counter({w: rng.choice([1, 5, 25, 125]) for w in words - {""}})
    got = groups(st.variant_groups(spark.createDataFrame(list(n.items()), "word string, n long")))
    assert got == brute_groups(n)


def test_edge_rows(spark, edge, empty):
    rows = [(r.doc_id, r.text) for r in edge.collect()]
    got = {r.word: r.n for r in st.word_counts(edge, 1, 3).collect()}
    assert got == {w: c for w, c in brute_counts(rows, 3, 1).items()}
    assert st.variant_groups(st.word_counts(empty)).count() == 0
    long = groups(st.variant_groups(st.word_counts(edge)))
    assert ("z" * 70_000, 1, 0, None, None, "z" * 70_000) in long
