import corpus_pipeline
from skein.llm import textops

from .conftest import SF
from .test_operators import brute_components, brute_spans


def test_stages_decide_as_brute_force(spark):
    docs = textops.documents(spark, SF)
    columns = docs.columns
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, textops.store(stage(spark, docs, SF), f"test-{name}")
        kept[name] = (before, docs)
        if name != "tokens":
            assert docs.columns == columns and docs.schema == before.schema
    before, after = kept["near_duplicates"]
    rows = [(r.doc_id, r.text) for r in before.collect()]
    stay = {d for d, _, c in brute_components(rows) if d == c}
    assert {r.doc_id for r in after.collect()} == stay
    before, after = kept["decontamination"]
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    left = {r.doc_id for r in after.collect()}
    for r in before.collect():
        if any(i in r.text for i in items):
            assert r.doc_id not in left
    before, after = kept["personal_data"]
    texts = {r.doc_id: r.text for r in before.collect()}
    assert {r.doc_id for r in after.collect()} == set(texts)
    for r in after.collect():
        assert r.n_chars == len(r.text) and (r.text == texts[r.doc_id] or brute_spans(texts[r.doc_id]))
        assert not any(k == 0 for k, _, _ in brute_spans(r.text))
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    gone = {r.doc_id for r in kept["quality"][0].collect()} - {r.doc_id for r in kept["quality"][1].collect()}
    assert not any(labels.get(d) == 1 for d in gone)
    assert docs.count() == len(texts)
    assert corpus_pipeline.run(spark, SF).count() == len(texts)


def brute_stay(rows, k=5, percent=80):
    """Rows that the near-duplicate stage keeps, by all pairs of the shingle sets."""
    words = [(t or "").lower().split() for _, t in rows]
    sets = [{tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set() for w in words]
    least = [d for d, _ in rows]
    changed = True
    while changed:
        changed = False
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                o = len(a & b)
                if a and b and 100 * o >= percent * (len(a) + len(b) - o) and least[j] < least[i]:
                    least[i], changed = least[j], True
    return sorted(r for r, d in zip(rows, least) if r[0] == d)


def test_near_duplicates_are_five_words_at_four_fifths(spark):
    words = [f"w{i}" for i in range(200)]
    texts = [words, words[:165], words + [f"x{i}" for i in range(44)], words[:150] + [f"y{i}" for i in range(10)] + words[170:],
             words[:156], words + [f"z{i}" for i in range(60)], [f"v{i}" for i in range(100)], [f"v{i}" for i in range(3, 100)]]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    got = corpus_pipeline.near_duplicate_stage(spark, spark.createDataFrame(rows, "doc_id long, text string"), SF).collect()
    want = brute_stay(rows)
    assert sorted((r.doc_id, r.text) for r in got) == want
    # at four words and 0.85 more would stay
    assert {d for d, _ in want} < {d for d, _ in brute_stay(rows, 4, 85)}


def test_near_duplicates_of_one_id_are_judged_by_their_own_text(spark):
    words = [f"w{i}" for i in range(100)]
    copy, other = " ".join(words[2:]), " ".join(f"v{i}" for i in range(50))
    rows = [(3, " ".join(words), "a"), (5, copy, "b"), (5, copy, "c"), (5, other, "d"), (5, other, "d"), (5, None, "e"),
            (5, "", "f"), (None, copy, "g")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, text_key string")
    got = corpus_pipeline.near_duplicate_stage(spark, docs, SF)
    assert got.columns == docs.columns
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted((r for r in rows if r[2] not in "bc"), key=str)
