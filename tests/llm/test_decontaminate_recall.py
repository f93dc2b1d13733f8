"""Recall of the fingerprints by band of similarity, for passages with and without repeated runs, and long texts."""

import random

import numpy as np
import pytest

from skein.llm import decontaminate as dc


def bag(words, k=5):
    w = np.array([hash(x) & (2**63 - 1) for x in words], np.uint64)
    grams, _ = dc.shingles(w, np.array([0, len(w)]), k)
    return np.unique(grams, return_counts=True)


def found(item, text):
    index = dc.BenchmarkIndex([(1, " ".join(item))])
    raw = np.frombuffer(" ".join(text).encode(), np.uint8)
    return bool(index.matches(raw, np.array([0, len(raw)]), dc.THRESHOLD))


@pytest.mark.parametrize("plain, run", [(116, 14), (200, 20), (2100, 54), (60, 0), (300, 150), (40, 60)])
def test_recall_with_another_run_in_its_place(plain, run):
    """The same words with a run of one token against a run of another, and a few words changed."""
    rng = random.Random(plain)
    hit = total = 0
    for trial in range(60):
        words = [f"w{trial}x{i}" for i in range(plain)]
        at = rng.randrange(plain)
        item = words[:at] + ["alpha"] * run + words[at:]
        text = list(item)
        if trial % 2 and run:  # another token's run, as far as the similarity stays above the threshold
            part = [i for i, x in enumerate(text) if x == "alpha"][:max(0, int(0.08 * len(item)))]
            for i in part:
                text[i] = "beta"
        else:
            for i in rng.sample(range(len(text)), max(1, len(text) // 70)):
                text[i] = f"changed{i}"
        if dc.weighted_jaccard(bag(text), bag(item)) < dc.THRESHOLD:
            continue
        total += 1
        hit += found(item, ["before"] * 3 + text + ["after"] * 3)
    assert total >= 20 and hit >= 0.9 * total, (hit, total)


def test_the_reviewed_cases():
    """An item with a run of one token against the same passage with a whole run of another."""
    for plain, run in ((116, 14), (200, 20), (2100, 54)):
        hits = 0
        for trial in range(30):
            words = [f"t{trial}y{i}" for i in range(plain)]
            item, text = words + ["alpha"] * run, words + ["beta"] * run
            if dc.weighted_jaccard(bag(text), bag(item)) >= dc.THRESHOLD:
                hits += found(item, text)
            else:
                hits += 1
        assert hits >= 27, (plain, run, hits)


def test_sliding_votes_are_those_of_each_window():
    rng = np.random.default_rng(11)
    grams = rng.integers(0, 6, 80).astype(np.uint64)
    for m in (1, 7, 80):
        votes = dc.window_votes(grams, m)
        for t in range(80 - m + 1):
            w = grams[t:t + m]
            number = np.array([(w[:i + 1] == w[i]).sum() for i in range(m)])
            assert (votes[t] == dc.simhash_bits(w, number).sum(0)).all()
    assert len(dc.window_votes(grams[:3], 3)) == 1


def test_a_very_long_text(spark):
    passage = " ".join(f"word{i}" for i in range(40))
    docs = spark.createDataFrame([(1, "a " * 30_000 + passage + " z" * 30_000), (2, "z" * 70_000), (3, "a " * 60_000)],
                                 "doc_id long, text string")
    bench = spark.createDataFrame([(7, passage), (8, "a " * 50)], "item_id long, text string")
    assert sorted((r.doc_id, r.item_id) for r in dc.contaminated(docs, bench).collect()) == [(1, 7), (1, 8), (3, 8)]
