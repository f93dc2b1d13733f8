import collections
import hashlib
import random
import re

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from tokenizers import Tokenizer, models

from skein.llm import (bpe, components, decontaminate, jaccard_join, order_minhash, pii, quality, suffix_dedup, textops,
                       token_count, toxicity, url_filter)

from .conftest import EDGE, SF

RANKS = P.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="session")
def texts(spark):
    return [(r.doc_id, r.text) for r in textops.documents(spark, SF).select("doc_id", "text").collect()]


# --- byte BPE

def reference_bpe():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})


def test_bpe_is_the_public_encoding_and_round_trips(spark, edge, empty, texts):
    ref = reference_bpe()
    got = {r.doc_id: r for r in bpe.op3_byte_bpe(spark, SF).collect()}
    for d, t in texts:
        ids = np.array(ref.encode_ordinary(t or ""), "<u4")
        assert (got[d].n_tokens, got[d].ids_sha256) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest())
        assert got[d].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()
    small = edge
    tokens = bpe.encode_documents(small, RANKS, P.PATTERN)
    back = sorted((r.doc_id or 0, bytes(r.data)) for r in bpe.decode_documents(tokens, RANKS, P.PATTERN).collect())
    assert back == sorted((r.doc_id or 0, (r.text or "").encode()) for r in small.collect())
    assert bpe.encode_digest(empty, RANKS, P.PATTERN).count() == 0


def test_bpe_appends_and_edits_reencode_only_near_the_change():
    enc, ref, rng = bpe.PrefixEncoder(bpe.read_ranks(RANKS), P.PATTERN), reference_bpe(), random.Random(1)
    text = "The quick brown fox's 12345 jumps  over\n\n the lazy dog. " * 20
    x = enc.edited(text)
    for _ in range(60):
        a = rng.randrange(len(text) + 1)
        b = min(len(text), a + rng.randrange(5))
        new = rng.choice(["", "x", " ", "'s", "\n", " 12", "é", "  "])
        text = text[:a] + new + text[b:]
        x.replace(a, b, new)
        assert x.ids() == ref.encode_ordinary(text)
    before = x.encoded_pieces
    x.append(" more")
    assert x.ids() == ref.encode_ordinary(text + " more") and x.encoded_pieces - before < 8


def test_bpe_neighbours_are_those_of_the_merges():
    enc, rng = bpe.PrefixEncoder(bpe.read_ranks(RANKS), P.PATTERN), random.Random(10)
    tokens = list(enc.halves)
    assert enc.rising
    for _ in range(20_000):
        a, b = rng.choice(tokens), rng.choice(tokens[:rng.choice([300, 3000, len(tokens)])])
        assert enc._may_follow(a, b) == (enc._merge(enc.bytes_of[a] + enc.bytes_of[b])[0] == [a, b])
    for piece in ("aaaaaaaaaaaa", "ababababab", "      ", "日本日本日本", "\u0301" * 9, "zzzz" * 50):
        assert enc.piece(piece.encode()) == reference_bpe()._encode_single_piece(piece.encode())


# --- token counts

def test_token_counts_are_those_of_the_public_unigram_tokenizer(spark, edge, empty, texts):
    path = P.path("piece_bpe_32k.model")
    vocabulary = token_count.unigram_vocabulary(path)
    ref = Tokenizer(models.Unigram([("<unk>", 0.0), *vocabulary], unk_id=0))
    got = {r.doc_id: r.n_tokens for r in token_count.op10_token_counts(spark, SF).collect()}
    for d, t in texts:
        assert got[d] == (len(ref.encode(token_count.MARK + t.replace(" ", token_count.MARK)).ids) if t else 0)
    tie = token_count.CountViterbi([("a", -1.0), ("ab", -2.0), ("b", -1.0), (token_count.MARK, -1.0)])
    assert tie.segment("ab") == (-2.0, 1, 0)  # the longer piece wins a tie
    assert tie.segment("ab??")[1:] == (2, 1)  # unknowns fuse
    counts = {(r.doc_id, r.n_tokens) for r in token_count.count_tokens(edge, path).collect()}
    assert (1, 0) in counts and (2, 0) in counts and len([c for c in counts if c[0] == 4]) == 1
    assert token_count.count_tokens(empty, path).count() == 0


# --- URL filters

def test_url_rules(spark):
    cases = {
        "http://A.Example.org/es/x?y": ("a.example.org", "/es/x", "example.org/es/", "block"),
        "https://example.org/en/12": ("example.org", "/en/12", "example.org/en/1", "block"),
        "https://notexample.org/en/12": ("notexample.org", "/en/12", "org/", "allow"),
        "https://x.com/de/#a": ("x.com", "/de/", "com/de/", "block"),
        "https://x.net/a.org/b": ("x.net", "/a.org/b", None, "allow"),
        "https://x.org": ("x.org", "", None, "allow"),
        "https://a.casino.net/": ("a.casino.net", "/", None, "block"),
        "no scheme": ("", "", None, "allow"), None: ("", "", None, "allow"), "://": ("", "", None, "allow"),
    }
    df = spark.createDataFrame([(i, u, "c") for i, u in enumerate(cases)] * 2, "page_id long, url string, host string")
    got = url_filter.judge_urls(df).collect()
    assert len(got) == 2 * len(cases)
    for r in got:
        assert (r.host, r.path, r.rule, r.verdict) == list(cases.values())[r.page_id]
    assert url_filter.judge_urls(df.limit(0)).count() == 0


def test_shift_and_is_glob_matching():
    rng = random.Random(2)
    globs = ["".join(rng.choice(["a", "b", "/", "*", "**"]) for _ in range(rng.randrange(1, 40))) for _ in range(12)]
    globs = [re.sub(r"\*{3,}", "**", g) for g in globs]
    strings = ["".join(rng.choice("ab/") for _ in range(rng.randrange(30))) for _ in range(200)]
    hit = url_filter.ShiftAnd([url_filter.Glob(g.encode(), i) for i, g in enumerate(globs)]).match([s.encode() for s in strings])
    for j, g in enumerate(globs):
        pattern = re.compile("".join({"**": ".*", "*": "[^/]*"}.get(p, re.escape(p)) for p in re.split(r"(\*\*?)", g)))
        assert [bool(pattern.fullmatch(s)) for s in strings] == hit[:, j].tolist(), g


# --- personal data

PATTERNS = (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")


def brute_spans(text):
    out = []
    for kind, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == 1 and any(int(x) > 255 for x in m.group().split(".")):
                continue
            if kind == 2 and not (16 <= len(digits) <= 19 and pii.luhn(digits)):
                continue
            if kind == 3 and not 8 <= len(digits) <= 15:
                continue
            out.append((kind, *m.span()))
    return out


def test_base_spans_are_the_patterns(texts):
    rng = random.Random(3)
    for _ in range(8000):
        t = "".join(rng.choice("a@..-+0123459 ()é") for _ in range(rng.randrange(40)))
        assert pii.base_spans(t) == brute_spans(t), t
    t = "card 4111 1111 1111 1111, +1 (555) 010-9999 a.b@c.example.org 10.0.0.255 10.0.0.256"
    assert [k for k, _, _ in pii.base_spans(t)] == [0, 1, 2, 3] and pii.base_spans(t) == brute_spans(t)
    for _, x in texts:
        assert pii.base_spans(x) == brute_spans(x)


def test_disclosing_terms(spark, edge, empty):
    rows = [(i, f"filler number{i} the contact zaphod writes from ann@example.org today the word{i}\nthe plain line{i}", "s")
            for i in range(5)] + [(10 + i, f"the other line{i} with writes and contact today from filler", "s") for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, base string")
    got = {r.doc_id: r for r in pii.find_spans(df).collect()}
    text = dict((r[0], r[1]) for r in rows)
    assert len(got) == len(rows)
    for d, r in got.items():
        terms = {text[d][s.start:s.end] for s in r.terms}
        assert terms == ({"zaphod"} if d < 5 else set())
        assert [(s.kind, s.start, s.end) for s in r.base] == brute_spans(text[d])
    clean = {r.doc_id: r.text for r in pii.sanitise(df).collect()}
    assert clean[0] == text[0].replace("ann@example.org", "[EMAIL]").replace("zaphod", "") and clean[12] == text[12]
    # copies of one line are no further evidence
    same = spark.createDataFrame([(i, "solo bob@example.org", "s") for i in range(6)], "doc_id long, text string, base string")
    assert all(not r.terms for r in pii.find_spans(same).collect())
    assert sorted((r.doc_id or 0, r.text) for r in pii.sanitise(edge).collect() if r.text) == sorted(
        (r[0] or 0, r[1]) for r in EDGE if r[1])
    assert pii.sanitise(edge).count() == len(EDGE) and pii.find_spans(empty).count() == 0


def test_disclosing_terms_on_other_lines(spark):
    rows = [(i, f"Trillian greets number{i}\nreach ann@example.org now\nplace{i} and trillian again", "s") for i in range(4)]
    rows += [(10, "trillian was named here\nwithout any address", "s"), (11, "reach bob@example.org now\nzarniwoop", "s"),
             (12, "reach bob@example.org now\nzarniwoop called", "s")]
    rows += [(20 + i, f"greets and again line{i}\nreach place now", "s") for i in range(60)]
    # a name that is judged on the address's line stands on another line too
    rows += [(100 + i, f"slartibart at cat@example.org day{i}" + "\nSLARTIBART agrees" * (i == 2), "s") for i in range(6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, base string")
    text = {r[0]: r[1] for r in rows}

    def found(**options):
        return {r.doc_id: [text[r.doc_id][s.start:s.end] for s in r.terms] for r in pii.find_spans(df, **options).collect() if r.terms}

    judged = {100 + i: ["slartibart", "SLARTIBART"] if i == 2 else ["slartibart"] for i in range(6)}
    assert found() == judged
    # two meetings are too few, and a document without the address has nothing to disclose
    assert found(by_document=True) == judged | {i: ["Trillian", "trillian"] for i in range(4)}
    clean = {r.doc_id: r.text for r in pii.sanitise(df, by_document=True).collect()}
    assert clean[0] == " greets number0\nreach [EMAIL] now\nplace0 and  again" and clean[10] == text[10]
    # copies of one text are no further evidence
    same = spark.createDataFrame([(i, "solo\nbob@example.org", "s") for i in range(6)] + [(9, "other", "s")], df.schema)
    assert all(not r.terms for r in pii.find_spans(same, by_document=True).collect())


# --- decontamination

def test_decontamination_is_brute_force(spark, edge, empty, texts):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    got = {(r.doc_id, r.item_id): r.similarity for r in decontaminate.op1_decontamination(spark, SF).collect()}

    def cut(t):
        return re.findall(r"[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", re.sub("[A-Z]+", lambda m: m.group().lower(), t))

    want = {}
    for d, t in texts:
        w = cut(t)
        for i, item in items:
            v = cut(item)
            k = min(5, len(v))
            bag = collections.Counter(tuple(v[j:j + k]) for j in range(len(v) - k + 1))
            if not any(g in bag for g in zip(*[w[j:] for j in range(k)])):
                continue
            for s in range(max(1, len(w) - len(v) + 1)):
                c = collections.Counter(tuple(w[j:j + k]) for j in range(s, min(s + len(v), len(w)) - k + 1))
                sim = sum((c & bag).values()) / sum((c | bag).values())
                if sim >= 0.8:
                    want[d, i] = max(want.get((d, i), 0), sim)
    assert want and got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-12 for k in want)


def test_decontamination_edges(spark, edge, empty, monkeypatch):
    passage = " ".join(f"word{i}" for i in range(40))
    near = passage.replace("word1 ", "other ", 1)
    docs = spark.createDataFrame([(1, "x " * 900 + passage.upper() + " y " * 50, "s"), (2, near, "s"), (3, "x y z " * 100, "s"),
                                  (4, None, "s"), (5, "", "s"), (1, passage, "s")], "doc_id long, text string, item_id string")
    bench = spark.createDataFrame([(7, passage), (7, passage), (8, ""), (9, None), (10, "tiny item"), (11, "a b c d e " * 9)],
                                  "item_id long, text string")
    got = sorted((r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, bench).collect())
    assert got == [(1, 7)] * 4 + [(2, 7)] * 2
    assert sorted(r.doc_id for r in decontaminate.remove_contaminated(docs, bench).collect()) == [3, 4, 5]
    monkeypatch.setattr(decontaminate, "SLICE_CHARS", 40)  # several passes give the same
    assert sorted((r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, bench).collect()) == got
    assert decontaminate.contaminated(empty, bench).count() == 0
    assert decontaminate.contaminated(edge, bench.limit(0)).count() == 0


def test_multi_index_finds_all_within_the_radius():
    rng = np.random.default_rng(4)
    items = rng.integers(0, 256, (300, 16), dtype=np.uint8)
    flips = np.packbits(rng.random((300, 128)) < 0.2, axis=1)
    windows = np.concatenate([items ^ flips, rng.integers(0, 256, (200, 16), dtype=np.uint8)])
    w, i = decontaminate.SizeClass(list(range(300)), items).within(windows)
    distance = np.bitwise_count(windows[:, None] ^ items[None]).sum(2)
    assert set(zip(w.tolist(), i.tolist())) == {tuple(x) for x in np.argwhere(distance <= decontaminate.RADIUS).tolist()}


# --- Jaccard join

def shingle_set(text):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m.group().lower(), text or "")) if x]
    return {tuple(w[i:i + 4]) for i in range(len(w) - 3)} if len(w) >= 4 else {tuple(w)} if w else set()


def brute_components(rows):
    sets = [shingle_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and 100 * min(len(a), len(b)) >= 85 * max(len(a), len(b)) and rows[i][0] is not None and rows[j][0] is not None:
                o = len(a & b)
                if 100 * o >= 85 * (len(a) + len(b) - o):
                    root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return sorted(((d, len(sets[i]), least.get(find(i)) if d is not None else None) for i, (d, _) in enumerate(rows)), key=str)


def test_jaccard_components_are_brute_force(spark, edge, empty, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK", 8)  # large groups are cut into blocks
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(300)]
    rows = []
    for family in range(6):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([5, 12, 60, 200]))]
        for _ in range(25):
            w = list(base)
            for _ in range(rng.randrange(0, max(2, len(w) // 25))):
                w[rng.randrange(len(w))] = rng.choice(vocabulary)
            rows.append((len(rows), " ".join(w) + rng.choice(["", " ", "\n"])))
    rows += [(len(rows) + i, " ".join(rng.choice(vocabulary) for _ in range(30))) for i in range(20)]
    rows += [(r[0] + 10_000 if r[0] is not None else None, r[1]) for r in EDGE]
    df = spark.createDataFrame([(*r, "n") for r in rows], "doc_id long, text string, node string")
    got = sorted((tuple(r) for r in jaccard_join.linked_components(df).collect()), key=str)
    assert got == brute_components(rows)
    assert jaccard_join.linked_components(empty).count() == 0


def test_bitmap_bound_is_never_below_the_overlap():
    rng = np.random.default_rng(6)
    for _ in range(200):
        common = rng.integers(0, 1 << 63, rng.integers(0, 200), dtype=np.uint64)
        a, b = (np.unique(np.concatenate([common, rng.integers(0, 1 << 63, rng.integers(1, 900), dtype=np.uint64)])) for _ in "ab")
        o = len(np.intersect1d(a, b))
        assert jaccard_join.overlap_bound(jaccard_join.bitmap(a), len(a), jaccard_join.bitmap(b), len(b)) >= o


def test_components(spark):
    rng = random.Random(7)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(500 + i, 501 + i) for i in range(40)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {n: n for e in edges for n in e}
    for _ in range(300):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    assert got == {n: r for n, r in root.items() if any(a != b for a, b in edges if n in (a, b))}


# --- order MinHash

def test_order_minhash_edits_and_likeness(spark, edge, empty, texts):
    rows = {r.doc_id: r for r in order_minhash.op4_order_minhash(spark, SF).collect()}
    order = sorted(texts, key=lambda r: -r[0])
    for i, (d, t) in enumerate(order):
        after = order[(i + 1) % len(order)][1]
        edited = t[:len(t) - len(t) // 2] + after[:len(t) // 2]
        assert (rows[d].n_chars, rows[d].edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
    same = {}
    for d, t in texts:
        assert same.setdefault(t, rows[d].fingerprint) == rows[d].fingerprint
    assert np.mean([r.near_edited > r.near_next for r in rows.values()]) > 0.9
    got = order_minhash.fingerprint_documents(edge).collect()
    assert len(got) == len(EDGE) and {r.fingerprint for r in got if r.doc_id in (1, 2, 7)} == {""}
    assert order_minhash.fingerprint_documents(empty).count() == 0
    one = order_minhash.fingerprint_documents(edge.where("doc_id = 6")).collect()[0]
    assert one.near_next == 1.0


def test_order_minhash_numbers_occurrences_and_sees_order(spark):
    from pyspark.sql import functions as F
    w = [f"w{i}" for i in range(400)]
    cases = {"a": w, "moved": w[200:] + w[:200], "shuffled": random.Random(8).sample(w, 400), "twice": w + w}
    df = spark.createDataFrame([(k, " ".join(v)) for k, v in cases.items()], "k string, t string")
    fp = {r.k: set(r.f) for r in df.select("k", order_minhash.fingerprint(F.col("t")).alias("f")).collect()}
    like = {k: len(fp["a"] & v) / len(fp["a"]) for k, v in fp.items()}
    assert like["a"] == 1 and 0.2 < like["moved"] < 1 and like["shuffled"] < 0.1 and like["twice"] < 1
    # sorted hashes against numbering by hand
    s = spark.createDataFrame([([(1, 5), (1, 7), (1, 9), (3, 1), (4, 2), (4, 3)],)], "s array<struct<h:bigint,p:int>>")
    got = s.select(order_minhash._numbered(F.col("s")).alias("q")).first().q
    want = s.select(F.array(*[F.xxhash64(F.lit(h).cast("bigint"), F.lit(o)) for h, o in
                              [(1, 0), (1, 1), (1, 2), (3, 0), (4, 0), (4, 1)]]).alias("q")).first().q
    assert [x.q for x in got] == want


# --- suffix dedup

def brute_repeats(rows):
    own = {}
    for d, t in rows:
        b = (t or "").encode()
        for i in range(len(b) - 49 if d is not None else 0):
            own[b[i:i + 50]] = min(own.get(b[i:i + 50], d), d)
    out = []
    for d, t in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - 49 if d is not None else 0):
            if own[b[i:i + 50]] < d:
                gone[i:i + 50] = True
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((d, len(b), int(gone.sum()), int((gone[:-1] & ~gone[1:]).sum()), kept))
    return sorted(out, key=str)


@pytest.mark.parametrize("split", [None, 1])
def test_suffix_dedup_is_brute_force(spark, edge, empty, monkeypatch, split):
    if split:
        monkeypatch.setattr(suffix_dedup, "SPLIT_FROM", 50)
    rng = random.Random(9)
    passages = ["".join(rng.choice("ab cdé") for _ in range(rng.choice([48, 49, 50, 51, 80, 300]))) for _ in range(8)]
    rows = [(i, "".join(rng.choice([rng.choice(passages), "".join(rng.choice("xyz ") for _ in range(rng.randrange(60)))])
                        for _ in range(rng.randrange(6)))) for i in range(120)]
    rows += [(r[0] + 200 if r[0] is not None else None, r[1]) for r in EDGE if r[0] != 5] + [(3, rows[5][1])]
    df = spark.createDataFrame([(*r, "k") for r in rows], "doc_id long, text string, kept string")
    got = sorted((tuple(r) for r in suffix_dedup.remove_repeats(df).collect()), key=str)
    assert [(*g[:4], bytes(g[4])) for g in got] == brute_repeats(rows)
    assert suffix_dedup.remove_repeats(empty).count() == 0


def test_suffix_sort():
    rng = np.random.default_rng(10)
    data = rng.integers(97, 100, 4000).astype(np.uint8)
    starts, segment = rng.permutation(3900)[:2500], rng.integers(0, 7, 2500)
    order = suffix_dedup.Suffixes(data, 50).sort(starts, segment)
    key = [(int(segment[i]), data[starts[i]:starts[i] + 50].tobytes()) for i in order]
    assert key == sorted(key) and sorted(order) == list(range(2500))


# --- classifiers

def test_counterfactual_penalty_levels_identity_terms(spark):
    rng = random.Random(11)
    fill = [f"word{i}" for i in range(60)]
    rows = []
    for i in range(600):
        toxic = i % 3 == 0
        group = "muslim" if rng.random() < (0.6 if toxic else 0.05) else "christian" if rng.random() < 0.3 else ""
        rows.append((i, int(toxic), " ".join(rng.sample(fill, 20) + [group] + (["scumbag"] if toxic and rng.random() < 0.8 else [])) + "."))
    sample = spark.createDataFrame(rows, "doc_id long, y int, text string")
    counts = {0: 400, 1: 200}
    probe = spark.createDataFrame([(1, f"a neutral {t} text") for t in ("muslim", "christian", "jewish")] + [(2, "a scumbag text")],
                                  "doc_id long, text string")

    def gap(strength):
        s = [r.score for r in toxicity.score(probe, toxicity.fit(sample, counts, counterfactual=strength)).collect()]
        return max(s[:3]) - min(s[:3]), s[3] - max(s[:3])

    assert gap(0.0)[0] > 0.1 and gap(50.0)[0] < 0.02 and gap(50.0)[1] > 0.3


def test_toxicity_and_quality_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r.doc_id: r for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}

    def auc(rows, name):
        s = sorted((r.score, getattr(labels[r.doc_id], name)) for r in rows if r.held_out and r.doc_id in labels)
        rank = [i for i, (_, y) in enumerate(s) if y]
        n1, n0 = len(rank), len(s) - len(rank)
        return (sum(rank) - n1 * (n1 - 1) / 2) / (n1 * n0)

    for query, name in ((toxicity.op2_toxicity, "toxic"), (quality.op8_pu_quality, "quality")):
        rows = query(spark, sf).collect()
        assert len(rows) == 1000 and auc(rows, name) > 0.95
        assert all(0 <= r.score <= 1 for r in rows)


def test_classifiers_edges(spark, edge, empty):
    no = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for module, label in ((toxicity, "toxic"), (quality, "quality")):
        model = toxicity.fit(*toxicity.labelled_sample(edge, no, label, (10, 10))) if module is toxicity else quality.fit(
            *quality.samples(edge, no))[0]
        got = module.score(edge, model).collect()
        assert len(got) == len(EDGE) and all(r.score == 0.5 for r in got) and module.score(empty, model).count() == 0
    some = spark.createDataFrame([(i, i % 2, i % 2) for i in range(9)], "doc_id long, quality int, toxic int")
    fitted = quality.fit(*quality.samples(edge, some))[0]
    assert len(quality.score(edge, fitted).collect()) == len(EDGE)
    assert quality.keep_good(edge, fitted).columns == edge.columns


def test_prior_estimate():
    rng = np.random.default_rng(12)
    good, bad = rng.normal(0, 1, (3000, quality.N_MEASURES)), rng.normal(3, 1, (900, quality.N_MEASURES))
    model, prior = quality.fit(good[:1500], np.concatenate([good[1500:], bad]))
    assert abs(prior - 1500 / 2400) < 0.1  # the smallest of many ratios lies low on few rows
    assert (model.logit(model.cells(good)) > 0).mean() > 0.95 and (model.logit(model.cells(bad)) < 0).mean() > 0.95
