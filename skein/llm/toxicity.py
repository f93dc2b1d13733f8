"""Toxicity by a counterfactual-regularised linear classifier.

Features are the presence of words and of word beginnings (4 and 6 bytes) in a whole text, hashed. A logistic model is
fitted on a bounded sample of labelled rows with an L1 penalty and a counterfactual penalty: in the labelled sentences
every identity term is swapped for the other terms of its group, and the squared change of the score (log-odds) that
the swap makes is charged. Terms of one group thus end with equal weights, so that a neutral mention of a group does
not raise the score.

The sample is the first rows of each class in the order of a hash of the id; class weights restore the whole table's
proportions. Only the sample's feature lists reach the driver (at most ``MAX_POSITIVE + MAX_NEGATIVE`` documents).
Scoring reads each whole text once, in place.

Defined results: null and empty texts get the score of no features; repeated rows get equal scores; with no labelled
rows of one class all scores are that of the other (0.5 without any). Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from pyspark.sql import DataFrame, functions as F

from skein.llm.textops import NOT_ALNUM, LOWER_ASCII, chunks, crc_fold, documents, mix, prefix_hash, span_hash, words

MAX_POSITIVE = 4_000
MAX_NEGATIVE = 8_000
FEATURE_BITS = 22
THRESHOLD = 0.3
L1 = 2e-4
COUNTERFACTUAL = 10.0

# Groups of identity terms that may stand for each other.
IDENTITY_GROUPS = (
    ("woman", "man"), ("women", "men"), ("girl", "boy"), ("female", "male"), ("girls", "boys"),
    ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist", "sikh"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "atheists", "sikhs"),
    ("gay", "straight", "lesbian", "bisexual", "transgender", "queer"),
    ("black", "white", "asian", "latino", "african", "european", "arab"),
    ("immigrant", "refugee", "foreigner", "native"), ("immigrants", "refugees", "foreigners", "natives"),
    ("old", "young"), ("deaf", "blind", "disabled"),
    ("femme", "homme"), ("femmes", "hommes"), ("musulman", "juif"), ("noir", "blanc"),
    ("frau", "mann"), ("frauen", "männer"), ("christen", "muslime", "juden"),
    ("mujer", "hombre"), ("mujeres", "hombres"), ("musulmanes", "cristianos"),
)

#: A feature of fewer labelled toxic texts has no weight.
MIN_TOXIC = 3


def word_features(data: np.ndarray, offsets: np.ndarray):
    """Feature numbers of every word (word, 4-byte and 6-byte beginning) and the row of each."""
    hashes, starts, ends, bounds = words(data, offsets, NOT_ALNUM)
    rows = np.repeat(np.arange(len(offsets) - 1), np.diff(bounds))
    c = prefix_hash(LOWER_ASCII[data])
    feats, where = [hashes], [rows]
    for k in (4, 6):
        at = np.flatnonzero(ends - starts >= k)
        feats.append(mix(span_hash(c, starts[at], starts[at] + k), k))
        where.append(rows[at])
    return (np.concatenate(feats) >> np.uint64(64 - FEATURE_BITS)).astype(np.int64), np.concatenate(where)


def term_features(term: str) -> np.ndarray:
    raw = np.frombuffer(term.encode(), np.uint8)
    return np.unique(word_features(raw, np.array([0, len(raw)]))[0])


def _extract(groups):
    terms = sorted({t for g in groups for t in g})

    def run(batches):
        keys = {int(h): t for h, t in zip(_term_hashes(terms), terms)}
        known = np.array(sorted(keys), np.uint64)
        for batch in batches:
            for lo, hi, data, off in chunks(batch.column(2)):
                feats, rows = word_features(data, off)
                order = np.unique((rows << FEATURE_BITS) | feats)
                cut = np.searchsorted(order, np.arange(hi - lo + 1) << FEATURE_BITS)
                low = (order & ((1 << FEATURE_BITS) - 1)).astype("<u4")
                ids, y = batch.column(0)[lo:hi], batch.column(1)[lo:hi]
                mentions = _mentions(data, off, known, keys)
                yield pa.RecordBatch.from_arrays(
                    [ids, y, pa.array([low[a:b].tobytes() for a, b in zip(cut, cut[1:])], pa.binary()),
                     pa.array(mentions, pa.list_(pa.string()))], names=["doc_id", "y", "features", "mentions"])

    return run


def _term_hashes(terms):
    raw = [np.frombuffer(t.encode(), np.uint8) for t in terms]
    off = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    return words(np.concatenate(raw), off, NOT_ALNUM)[0]


def _mentions(data, off, known, keys) -> list[list[str]]:
    """Identity terms of each row, once for each sentence that holds them (sentences end at . ! ? or a line end)."""
    hashes, starts, _, bounds = words(data, off, NOT_ALNUM)
    at = np.flatnonzero(np.isin(hashes, known))
    stops = np.flatnonzero(np.isin(data, np.frombuffer(b".!?\n", np.uint8)))
    sentence = np.searchsorted(stops, starts[at])
    row = np.searchsorted(bounds, at, "right") - 1
    out: list[list[str]] = [[] for _ in range(len(off) - 1)]
    for r, _, h in sorted({(int(r), int(s), int(h)) for r, s, h in zip(row, sentence, hashes[at])}):
        out[r].append(keys[h])
    return out


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, limits, id_col="doc_id", text_col="text"):
    """(sampled rows ``doc_id, y, text``, rows of each class) of labelled documents outside the held-out fold."""
    known = labels.where(F.col(label).isNotNull() & F.col(id_col).isNotNull() & (crc_fold(id_col) != 2)).groupBy(
        F.col(id_col).cast("bigint").alias("doc_id")).agg(F.max(label).cast("int").alias("y"))
    counts = dict(known.groupBy("y").count().collect())
    picked = None
    for y, limit in enumerate(limits):
        part = known.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
        picked = part if picked is None else picked.union(part)
    # bounded by the sum of the limits: two integers a row
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text")).join(
        F.broadcast(picked), "doc_id")
    return rows.select("doc_id", "y", "text"), counts


def fit(sample: DataFrame, counts: dict, groups=IDENTITY_GROUPS, l1: float = L1,
        counterfactual: float = COUNTERFACTUAL, rounds: int = 300) -> dict:
    """Sparse weights ``{"features": sorted ids, "weights": ..., "bias": b}`` from ``doc_id, y, text`` rows."""
    rows = sample.mapInArrow(_extract(groups), "doc_id bigint, y int, features binary, mentions array<string>").collect()
    rows.sort(key=lambda r: (r.doc_id, r.y, r.features))
    y = np.array([r.y for r in rows], float)
    if not len(y) or y.min() == y.max():
        return {"features": np.zeros(0, np.int64), "weights": np.zeros(0),
                "bias": 0.0 if not len(y) else 6.0 if y[0] else -6.0}
    feats = [np.frombuffer(r.features, "<u4") for r in rows]
    row = np.repeat(np.arange(len(y)), [len(f) for f in feats])
    flat = np.concatenate(feats).astype(np.int64)
    # a feature of fewer than three toxic texts, or not clearly commoner in them, says nothing about the next one;
    # identity terms always stay
    positive = np.bincount(flat[y[row] == 1], minlength=1 << FEATURE_BITS)
    negative = np.bincount(flat[y[row] == 0], minlength=1 << FEATURE_BITS)
    keep = (positive >= MIN_TOXIC) & (
        positive / y.sum() >= 3 * negative / (len(y) - y.sum()))
    swaps: dict[tuple[str, str], int] = {}
    members = {t: [u for u in g if u != t] for g in groups for t in g}
    for r in rows:
        for t in r.mentions:
            for u in members[t]:
                swaps[t, u] = swaps.get((t, u), 0) + 1
    for pair in swaps:
        for t in pair:
            keep[term_features(t)] = True
    ids = np.flatnonzero(keep)
    place = np.full(1 << FEATURE_BITS, -1, np.int32)
    place[ids] = np.arange(len(ids))
    use = place[flat] >= 0
    row, col = row[use], place[flat[use]]
    diff = np.zeros((len(swaps), len(ids))) if len(ids) else np.zeros((0, 0))
    for i, ((a, b), n) in enumerate(sorted(swaps.items())):
        diff[i, place[term_features(b)]] += 1
        diff[i, place[term_features(a)]] -= 1
        diff[i] *= np.sqrt(n / sum(swaps.values()))
    # class weights: the whole table's shares
    total = sum(counts.values())
    weight = np.where(y == 1, counts.get(1, 0) / max(1, y.sum()), counts.get(0, 0) / max(1, (1 - y).sum())) / total
    size, n = len(ids), len(y)
    # the more toxic texts share a feature, the cheaper its weight
    charge = l1 * np.maximum(1, 20 / np.maximum(positive[ids], 1))
    # bound of the curvature, for the step: sum of weight * |x|^2 / 4 over a power iteration
    v = np.ones(size + 1)
    for _ in range(20):
        z = np.bincount(row, v[col], n) + v[-1]
        u = np.append(np.bincount(col, (weight * z)[row], size), (weight * z).sum()) / 4
        u[:size] += 2 * counterfactual * diff.T @ (diff @ v[:size])
        step = np.linalg.norm(u) / max(np.linalg.norm(v), 1e-12)
        v = u / max(np.linalg.norm(u), 1e-12)
    w = np.zeros(size + 1)
    prior = np.clip((weight * y).sum(), 1e-3, 1 - 1e-3)
    w[-1] = np.log(prior / (1 - prior))
    ahead, t = w.copy(), 1.0
    for _ in range(rounds):
        z = np.bincount(row, ahead[col], n) + ahead[-1]
        r = weight * (1 / (1 + np.exp(-np.clip(z, -40, 40))) - y)
        g = np.append(np.bincount(col, r[row], size), r.sum())
        g[:size] += 2 * counterfactual * diff.T @ (diff @ ahead[:size])
        new = ahead - g / (1.1 * step)
        new[:size] = np.sign(new[:size]) * np.maximum(np.abs(new[:size]) - charge / (1.1 * step), 0)
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead = new + (t - 1) / t_new * (new - w)
        w, t = new, t_new
    some = np.flatnonzero(w[:size])
    return {"features": ids[some], "weights": w[some], "bias": float(w[-1])}


def score(docs: DataFrame, model: dict, threshold: float = THRESHOLD, id_col="doc_id", text_col="text") -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every whole text. The model is bounded by the sample's features."""
    features, weights, bias = model["features"], model["weights"], model["bias"]

    def run(batches):
        table = np.zeros(1 << FEATURE_BITS, np.float32)
        table[features] = weights
        for batch in batches:
            out = np.zeros(batch.num_rows)
            for lo, hi, data, off in chunks(batch.column(2)):
                feats, rows = word_features(data, off)
                hit = np.flatnonzero(table[feats])
                pairs = np.unique((rows[hit] << FEATURE_BITS) | feats[hit])
                out[lo:hi] = np.bincount(pairs >> FEATURE_BITS, table[pairs & ((1 << FEATURE_BITS) - 1)], hi - lo)
            s = 1 / (1 + np.exp(-np.clip(out + bias, -40, 40)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(s), pa.array((s >= threshold).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"])

    src = docs.select(F.col(id_col).cast("bigint").alias("doc_id"),
                      F.coalesce(crc_fold(id_col) == 2, F.lit(False)).alias("held_out"), F.col(text_col).alias("text"))
    return src.mapInArrow(run, "doc_id bigint, held_out boolean, score double, predicted int")


def op2_toxicity(spark, sf_dir):
    """Toxicity scores of every document, learnt from labels.toxic outside the held-out fold."""
    docs = documents(spark, sf_dir)
    sample, counts = labelled_sample(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), "toxic",
                                     (MAX_NEGATIVE, MAX_POSITIVE))
    return score(docs, fit(sample, counts))
