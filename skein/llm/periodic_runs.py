"""Periodic runs of words: maximal stretches that repeat their first words with a smallest period.

A run of period p and length at least 2 p holds a multiple i of p among its first p places (a harmonic grid: n / p places
for each p, n log n in all), and there word i equals word i + p. From every such pair the longest common extensions
forward (of i and i + p) and backward (of the words before them) give the maximal stretch.

Common extensions come from a difference cover: of every 31 places only the six of a perfect difference set are sampled,
and for any two places some shift below 31 puts both on a sample. So a query compares at most 30 words, and most queries
end there; where all are equal, the rest is the smallest common prefix between the two samples' ranks among the sorted
sampled suffixes, by a sparse table of minima. Samples are sorted by their first 31 words, then by doubling the sorted
length through the ranks of the samples behind; the doubling's ranks also give neighbours' common prefixes.

Several short texts share one word array; each ends in a word of its own, so nothing reaches into the next. Texts lie in
order of falling length, so a period only visits texts that can hold it. Words are numbered exactly (no hashes).

Documents are independent, so this is one pass without a shuffle. Working memory follows the larger of ``CHUNK_BYTES`` and
the longest text, about 100 bytes a word.

Defined results: null and empty texts, and texts without words, have no runs and an empty collapsed text; a stretch found
with several periods counts once, with the smallest; repeated rows and rows without an id are each treated on their own;
texts of any length are read whole; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from pyspark.sql import DataFrame, functions as F

from skein.llm.textops import SPACE, chunks, documents, word_ids

MIN_LENGTH = 12
#: A perfect difference set: every remainder modulo 31 is a difference of two of its members.
MODULUS = 31
COVER = np.array([1, 5, 11, 24, 25, 27])
#: Grid pairs that are extended at once.
PAIRS = 1 << 18
_WORDS = "[^\\x20\\x09-\\x0D]+"


def _shifts() -> np.ndarray:
    """shifts[a, b]: the smallest shift that puts remainders a and b both into the cover."""
    held = np.zeros(MODULUS, bool)
    held[COVER] = True
    t = np.arange(MODULUS)
    both = held[(t[:, None, None] + t) % MODULUS] & held[(t[None, :, None] + t) % MODULUS]
    return both.argmax(2)


_SHIFT = _shifts()


def _refine(rank: np.ndarray, tied: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Split groups of equal rank (the place of the group's first member) among ``tied`` by ``key``; returns those still
    tied."""
    order = np.lexsort((key, rank[tied]))
    at, r, k = tied[order], rank[tied[order]], key[order]
    new_group = np.append(True, r[1:] != r[:-1])
    new_key = new_group | np.append(True, k[1:] != k[:-1])
    place = np.arange(len(at))
    group = np.maximum.accumulate(np.where(new_group, place, 0))
    part = np.maximum.accumulate(np.where(new_key, place, 0))
    rank[at] = r + part - group
    alone = new_key & np.append(new_key[1:], True)
    return np.sort(at[~alone])


class CoverSamples:
    """Sorted cover-sampled suffixes of a word array (a suffix sorts before its continuations), with minima of their
    common prefixes."""

    def __init__(self, x: np.ndarray):
        n = len(x)
        self.slot = np.full(n, -1, np.int64)
        places = (np.arange(0, n, MODULUS)[:, None] + COVER).reshape(-1)
        places = places[places < n]
        self.slot[places] = np.arange(len(places))
        bits = (int(x.max()) + 1).bit_length()
        step = max(1, 62 // bits)
        wide = np.concatenate([x + 1, np.zeros(MODULUS + step, x.dtype)])  # zero: behind the end
        rank, tied = np.zeros(len(places), np.int64), np.arange(len(places))
        for lo in range(0, MODULUS, step):
            if not len(tied):
                break
            key = np.zeros(len(tied), np.int64)
            for j in range(lo, min(lo + step, MODULUS)):
                key = (key << bits) | wide[places[tied] + j]
            tied = _refine(rank, tied, key)
        levels = [rank.copy()]
        reach = MODULUS
        while len(tied):
            behind = places[tied] + reach
            key = np.where(behind < n, levels[-1][self.slot[np.minimum(behind, n - 1)]], -1)
            tied = _refine(rank, tied, key)
            levels.append(rank.copy())
            reach *= 2
        self.rank = rank
        order = np.empty(len(places), np.int64)
        order[rank] = np.arange(len(places))
        self.table = [self._common(x, places[order[:-1]], places[order[1:]], levels)]
        have = 1
        while have * 2 <= len(self.table[0]):
            low = self.table[-1]
            self.table.append(np.minimum(low[:-have], low[have:]))
            have *= 2

    def _common(self, x, a, b, levels) -> np.ndarray:
        """Common prefixes of neighbours, by halving lengths and at last word by word."""
        n, a, b = len(x), a.copy(), b.copy()
        start = a.copy()
        for k in range(len(levels) - 1, -1, -1):
            ok = np.flatnonzero(np.maximum(a, b) < n)
            same = ok[levels[k][self.slot[a[ok]]] == levels[k][self.slot[b[ok]]]]
            a[same] += MODULUS << k
            b[same] += MODULUS << k
        left = np.arange(len(a))
        for _ in range(MODULUS):
            left = left[np.maximum(a[left], b[left]) < n]
            left = left[x[a[left]] == x[b[left]]]
            if not len(left):
                break
            a[left] += 1
            b[left] += 1
        return a - start

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Common prefix of the suffixes at sampled places a and b (different)."""
        r, s = self.rank[self.slot[a]], self.rank[self.slot[b]]
        lo, hi = np.minimum(r, s), np.maximum(r, s)
        level = np.frexp((hi - lo).astype(float))[1] - 1
        out = np.empty(len(a), np.int64)
        for k in np.unique(level):
            at = np.flatnonzero(level == k)
            out[at] = np.minimum(self.table[k][lo[at]], self.table[k][hi[at] - (1 << int(k))])
        return out


class Extensions:
    """Longest common extensions inside an array."""

    def __init__(self, x: np.ndarray):
        self.x, self.samples = x, None

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words from places i and j on agree; i and j differ, and both lie inside."""
        x, n = self.x, len(self.x)
        shift = _SHIFT[i % MODULUS, j % MODULUS]
        out = np.zeros(len(i), np.int64)
        left = np.arange(len(i))
        synchronised = []
        for t in range(MODULUS):
            done = shift[left] == t
            synchronised.append(left[done])
            left = left[~done]
            left = left[np.maximum(i[left], j[left]) + t < n]
            left = left[x[i[left] + t] == x[j[left] + t]]
            out[left] = t + 1
            if not len(left):
                break
        at = np.concatenate(synchronised)
        at = at[np.maximum(i[at], j[at]) + shift[at] < n]
        if len(at):
            # a sample whose own word differs needs no sorted suffixes
            at = at[x[i[at] + shift[at]] == x[j[at] + shift[at]]]
        if len(at):
            if self.samples is None:
                self.samples = CoverSamples(x)
            out[at] = shift[at] + self.samples.common(i[at] + shift[at], j[at] + shift[at])
        return out


def maximal_runs(rows: list[np.ndarray], min_length: int = MIN_LENGTH):
    """(row, start, length, period) of every run of each row of word numbers, by row, start and period."""
    none = np.zeros(0, np.int64)
    lengths = np.array([len(r) for r in rows], np.int64)
    order = np.argsort(-lengths, kind="stable")
    order = order[lengths[order] >= max(2, min_length)]
    if not len(order):
        return none, none, none, none
    top = 1 + max(int(rows[r].max()) for r in order)
    x = np.concatenate([part for k, r in enumerate(order) for part in (rows[r], [top + k])]).astype(np.int64)
    begin = np.concatenate([[0], np.cumsum(lengths[order] + 1)])
    forward, backward = Extensions(x), Extensions(np.ascontiguousarray(x[::-1]))
    # where the rows that can hold a period end
    limit = begin[np.searchsorted(-lengths[order], -2 * np.arange(lengths[order[0]] // 2 + 1), "right")]
    found, held, size = [], [], 0

    def extend():
        i, p = (np.concatenate(c) for c in zip(*held))
        more = forward.common(i, i + p)
        less = np.zeros(len(i), np.int64)
        inner = np.flatnonzero(i > 0)
        less[inner] = backward.common(len(x) - i[inner], len(x) - i[inner] - p[inner])
        ok = more + less >= np.maximum(p, min_length - p)
        found.append(_smallest_periods(np.stack([i - less, p + more + less, p], 1)[ok]))

    small = x.astype(np.int32) if x.max() < 1 << 31 else x
    for p in range(1, len(limit)):
        grid = small[:limit[p]:p]
        k = np.flatnonzero(grid[1:] == grid[:-1])
        if len(k):
            held.append((k * p, np.full(len(k), p)))
            size += len(k)
            if size >= PAIRS:
                extend()
                held, size = [], 0
    if size:
        extend()
    s = _smallest_periods(np.concatenate([np.zeros((0, 3), np.int64), *found]))
    at = np.searchsorted(begin, s[:, 0], "right") - 1
    row, start = order[at], s[:, 0] - begin[at]
    by = np.lexsort((s[:, 2], start, row))
    return row[by], start[by], s[by, 1], s[by, 2]


def _smallest_periods(s: np.ndarray) -> np.ndarray:
    """Of equal stretches (start, length, period) the one with the smallest period."""
    s = s[np.lexsort((s[:, 2], s[:, 1], s[:, 0]))]
    return s[np.append(True, (s[1:, :2] != s[:-1, :2]).any(1))[:len(s)]]


def _collapsed(ids, names: pa.Array, bounds, row, start, length, period) -> pa.Array:
    """Each row's words without those that a run holds after its first period, joined by one space."""
    cover = np.zeros(len(ids) + 1, np.int64)
    np.add.at(cover, bounds[row] + start + period, 1)
    np.add.at(cover, bounds[row] + start + length, -1)
    keep = np.cumsum(cover)[:-1] == 0
    at = np.concatenate([[0], np.cumsum(keep)])[bounds].astype(np.int32)
    kept = names.take(pa.array(ids[keep]))
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(at), kept), b" ").cast(pa.string())


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_SCHEMA = "doc_id bigint, n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"


def periodic_runs(docs: DataFrame, min_length: int = MIN_LENGTH, id_col="doc_id", text_col="text") -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` for each row: its runs of at least ``min_length`` words by start and period,
    and its words without what runs repeat after their first period, joined by one space."""
    def run(batches):
        for batch in batches:
            for lo, hi, data, off in chunks(batch.column(1)):
                ids, names, bounds = word_ids(data, off, ~SPACE[data])
                row, start, length, period = maximal_runs([ids[a:b] for a, b in zip(bounds[:-1], bounds[1:])], min_length)
                at = np.searchsorted(row, np.arange(hi - lo + 1)).astype(np.int32)
                runs = pa.StructArray.from_arrays([pa.array(c) for c in (start, length, period)], fields=list(_RUN))
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(lo, hi - lo), pa.array(np.diff(bounds), pa.int64()),
                    pa.ListArray.from_arrays(pa.array(at), runs),
                    _collapsed(ids, names, bounds, row, start, length, period)],
                    names=["doc_id", "n_words", "runs", "collapsed"])

    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, _SCHEMA)


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """``doc_id, text``: texts whose crc32 of the id is a multiple of ten repeat a stretch of their words up to the end."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g, words = F.floor(h / 10), F.regexp_extract_all("text", F.lit(_WORDS), F.lit(0))
    docs = docs.select("doc_id", "text", F.when(h % 10 == 0, words).alias("w"), g.alias("g")).withColumn("n", F.size("w"))
    docs = docs.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    docs = docs.withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)))
    i = F.sequence(F.lit(0), F.col("n") - 1)
    moved = F.transform(i, lambda k: F.get("w", F.when(k < F.col("a"), k).otherwise(
        F.col("a") + (k - F.col("a")) % F.col("p")).cast("int")))
    return docs.select("doc_id", F.when(F.col("n") > 0, F.array_join(moved, " ")).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark, sf_dir):
    """Runs of every document, its longest run, and digests of all runs and of the collapsed text."""
    found = periodic_runs(with_planted_periods(documents(spark, sf_dir)))
    best = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("less"), r["start"], r["period"])))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), F.col("best.start").alias("start"),
        (-F.col("best.less")).alias("length"), F.col("best.period").alias("period"),
        F.expr("(-1000 * best.less) div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
