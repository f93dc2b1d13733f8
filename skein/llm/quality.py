"""Quality by positive-unlabelled learning.

The classifier sees trusted positives (labelled good rows) and unlabelled web text, never a labelled negative. It
minimises the non-negative unbiased risk

    prior * E_P[l(f)] + max(0, E_U[l(-f)] - prior * E_P[l(-f)]),    l the logistic loss,

by gradient steps; where the second term turns negative, the step lifts it instead. The prior is estimated first:
a positive-against-unlabelled ranking is fitted, and the prior is the smallest ratio of the two samples' shares above
a score, with a deviation term for thin tails.

Features are style measures of a whole text (character classes, word lengths, repetition), each cut into bins at
the unlabelled sample's quantiles. Both samples are bounded (``MAX_SAMPLE`` rows each, first in the order of a hash of
the id, outside the held-out fold); only their measures reach the driver. Scoring reads each whole text once, in place.

Defined results: null and empty texts have zero measures and get a score like any text; repeated rows get equal
scores; texts of any length are read whole; with fewer than two positives or texts there is no model: all scores are 0.5,
``predicted`` is 0, and ``keep_good`` keeps every row, as nothing speaks against any. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa

from pyspark.sql import DataFrame, functions as F

from skein.llm.textops import LOWER_ASCII, SPACE, chunks, crc_fold, documents, mix, words

MAX_SAMPLE = 12_000
THRESHOLD = 0.7
BINS = 20
#: Further quantiles that are bin edges.
TAILS = [0.002, 0.01, 0.02, 0.98, 0.99, 0.998]

_CLASS = np.zeros((7, 256), np.float32)  # upper, lower, digit, symbol, mark, exclamation, other bytes
_CLASS[0, 65:91] = _CLASS[1, 97:123] = _CLASS[2, 48:58] = 1
_CLASS[3, list(b"#$%&*@^~=<>{}[]|\\/_+")] = 1
_CLASS[4, list(b".,;:'\"()-")] = 1
_CLASS[5, list(b"!?")] = 1
_CLASS[6, 128:] = 1
N_MEASURES = 18


def measures(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Style measures of each row, rows x N_MEASURES."""
    n = len(offsets) - 1
    size = np.diff(offsets).astype(float)
    out = np.zeros((n, N_MEASURES))
    some = np.maximum(size, 1)

    def per_row(flags) -> np.ndarray:
        c = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return (c[offsets[1:]] - c[offsets[:-1]]).astype(float)

    kinds = np.stack([per_row(k[data]) for k in _CLASS.astype(bool)])
    out[:, 0] = np.log1p(size)
    out[:, 1:8] = (kinds / some).T
    letters = np.maximum(kinds[0] + kinds[1] + kinds[6], 1)
    out[:, 8] = kinds[0] / letters
    hashes, starts, ends, bounds = words(data, offsets, SPACE)
    count = np.diff(bounds).astype(float)
    many = np.maximum(count, 1)
    row = np.repeat(np.arange(n), np.diff(bounds))
    out[:, 9] = np.log1p(count)
    length = (ends - starts).astype(float)
    out[:, 10] = np.bincount(row, length, n) / many
    out[:, 11] = np.sqrt(np.maximum(np.bincount(row, length ** 2, n) / many - out[:, 10] ** 2, 0))
    out[:, 12] = per_row(data == 10) / many
    if len(hashes):
        same = np.zeros(len(hashes), bool)
        same[1:] = (hashes[1:] == hashes[:-1]) & (row[1:] == row[:-1])
        out[:, 13] = np.bincount(row[same], minlength=n) / many
        for col, h in ((14, hashes), (15, _pairs(hashes))):
            key = mix(h ^ (row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
            _, first = np.unique(key, return_index=True)
            out[:, col] = np.bincount(row[first], minlength=n) / many
        last = LOWER_ASCII[data[ends - 1]]
        out[:, 16] = np.bincount(row[(_CLASS[3, last] > 0) | (_CLASS[5, last] > 0)], minlength=n) / many
        out[:, 17] = np.bincount(row[length == 1], minlength=n) / many
    return out


def _pairs(hashes: np.ndarray) -> np.ndarray:
    return mix(hashes * np.uint64(0xD6E8FEB86659FD93) + np.roll(hashes, 1))


def _measure(batches):
    for batch in batches:
        for lo, hi, data, off in chunks(batch.column(1)):
            m = measures(data, off)
            yield pa.RecordBatch.from_arrays([batch.column(0)[lo:hi], pa.FixedSizeListArray.from_arrays(
                pa.array(m.ravel()), N_MEASURES).cast(pa.list_(pa.float64()))], names=["kind", "m"])


def samples(docs: DataFrame, labels: DataFrame, label="quality", limit=MAX_SAMPLE, id_col="doc_id", text_col="text"):
    """Measures of the positive and of the unlabelled sample, both outside the held-out fold."""
    good = labels.where((F.col(label) == 1) & (crc_fold(id_col) != 2)).select(
        F.col(id_col).cast("bigint").alias("doc_id")).distinct()
    web = docs.where(crc_fold(id_col) != 2).select(F.col(id_col).cast("bigint").alias("doc_id")).distinct()
    picked = None
    for kind, ids in enumerate((web, good)):
        part = ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit).select("doc_id", F.lit(kind).alias("kind"))
        picked = part if picked is None else picked.union(part)
    # bounded by twice the limit: two integers a row
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text")).join(
        F.broadcast(picked), "doc_id").select("kind", "text")
    got = rows.mapInArrow(_measure, "kind int, m array<double>").collect()
    # an order that says nothing about the text, for fitting on one half and measuring on the other
    got.sort(key=lambda r: hashlib.blake2b(repr(r).encode()).digest())
    return tuple(np.array([r.m for r in got if r.kind == k]).reshape(-1, N_MEASURES) for k in (1, 0))


class Binned:
    """Additive model over binned measures."""

    def __init__(self, unlabelled: np.ndarray):
        # the same quantiles at every size, the tails cut finer; equal edges of few or tied rows fall together
        q = np.concatenate([np.linspace(0, 1, BINS + 1)[1:-1], TAILS])
        self.edges = [np.unique(np.quantile(unlabelled[:, j], np.sort(q)))
                      for j in range(unlabelled.shape[1])]
        self.begin = np.concatenate([[0], np.cumsum([len(e) + 1 for e in self.edges])])
        self.weights = np.zeros(self.begin[-1] + 1)

    def cells(self, m: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, m[:, j], "right") + self.begin[j] for j, e in enumerate(self.edges)], 1)

    def logit(self, cells: np.ndarray, w=None) -> np.ndarray:
        w = self.weights if w is None else w
        return w[cells].sum(1) + w[-1]

    def gradient(self, cells: np.ndarray, slope: np.ndarray) -> np.ndarray:
        g = np.bincount(cells.ravel(), np.repeat(slope, cells.shape[1]), len(self.weights))
        g[-1] = slope.sum()
        return g


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _adam(size: int, gradient, rounds: int, l2: float, rate=0.05):
    w, m, v = np.zeros(size), np.zeros(size), np.zeros(size)
    for t in range(1, rounds + 1):
        g = gradient(w)
        g[:-1] += l2 * w[:-1]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return w


def estimate_prior(score_p: np.ndarray, score_u: np.ndarray) -> float:
    """Share of positives among the unlabelled: the share_U / share_P above the score where this ratio plus its
    deviation is smallest."""
    cuts = np.unique(np.quantile(score_p, np.linspace(0.02, 0.95, 100)))
    p = np.maximum(1 - np.searchsorted(np.sort(score_p), cuts, "left") / len(score_p), 1e-9)
    u = 1 - np.searchsorted(np.sort(score_u), cuts, "left") / len(score_u)
    ratio = u / p
    spread = np.sqrt(u * (1 - u) / len(score_u) + ratio ** 2 * p * (1 - p) / len(score_p)) / p
    best = np.argmin(ratio + spread)
    return float(np.clip(ratio[best], 0.01, 0.99))


def fit(positive: np.ndarray, unlabelled: np.ndarray, rounds: int = 600) -> tuple[Binned | None, float]:
    """(model, prior); no model without rows of either kind."""
    if len(positive) < 2 or len(unlabelled) < 2:
        return None, 0.5
    model = Binned(unlabelled)
    cp, cu = model.cells(positive), model.cells(unlabelled)
    l2 = 3.0 / (len(positive) + len(unlabelled))

    def ranked(half: int) -> np.ndarray:
        p, u = cp[half::2], cu[half::2]

        def slope(w):
            sp, su = _sigmoid(model.logit(p, w)), _sigmoid(model.logit(u, w))
            return model.gradient(p, (sp - 1) / len(p)) + model.gradient(u, su / len(u))

        return _adam(len(model.weights), slope, rounds // 2, 2 * l2)

    # ranked on one half of the rows, measured on the other, so that fitting does not flatter the positives
    both = [(ranked(h), cp[1 - h::2], cu[1 - h::2]) for h in (0, 1)]
    prior = float(np.mean([estimate_prior(model.logit(p, w), model.logit(u, w)) for w, p, u in both]))

    def pu_risk(w):
        fp, fu = model.logit(cp, w), model.logit(cu, w)
        sp, su = _sigmoid(fp), _sigmoid(fu)
        negative = np.logaddexp(0, fu).mean() - prior * np.logaddexp(0, fp).mean()
        g_neg = model.gradient(cu, su / len(cu)) - prior * model.gradient(cp, sp / len(cp))
        if negative < 0:
            return -g_neg
        return prior * model.gradient(cp, (sp - 1) / len(cp)) + g_neg

    model.weights = _adam(len(model.weights), pu_risk, rounds, l2)
    return model, prior


def score(docs: DataFrame, model: Binned | None, threshold: float = THRESHOLD, id_col="doc_id",
          text_col="text") -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every whole text."""
    def run(batches):
        for batch in batches:
            s = np.full(batch.num_rows, 0.5)
            if model is not None:
                for lo, hi, data, off in chunks(batch.column(2)):
                    s[lo:hi] = _sigmoid(model.logit(model.cells(measures(data, off))))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(s), pa.array((s >= threshold).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"])

    src = docs.select(F.col(id_col).cast("bigint").alias("doc_id"),
                      F.coalesce(crc_fold(id_col) == 2, F.lit(False)).alias("held_out"), F.col(text_col).alias("text"))
    return src.mapInArrow(run, "doc_id bigint, held_out boolean, score double, predicted int")


def keep_good(docs: DataFrame, model: Binned | None, threshold: float = THRESHOLD, text_col="text") -> DataFrame:
    """Rows of ``docs`` whose text scores at least ``threshold``, all columns as they are, in one pass; all
    rows where there is no model."""
    at = docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            s = np.full(batch.num_rows, 1.0)
            if model is not None:
                for lo, hi, data, off in chunks(batch.column(at)):
                    s[lo:hi] = _sigmoid(model.logit(model.cells(measures(data, off))))
            yield batch.filter(pa.array(s >= threshold))

    return docs.mapInArrow(run, docs.schema)


def op8_pu_quality(spark, sf_dir):
    """Quality scores of every document, learnt from labels.quality = 1 and unlabelled documents."""
    docs = documents(spark, sf_dir)
    model, _ = fit(*samples(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    return score(docs, model)
