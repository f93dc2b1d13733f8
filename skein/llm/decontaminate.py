"""Benchmark decontamination: item-sized windows of every document against the benchmark's fingerprints.

Windows have as many words as the item they are compared with. A window's five-word shingles vote on a 128-bit SimHash,
each occurrence by the shingle and its number among the equal ones, so that a repeated shingle has as many independent
votes as it weighs and the bit distance follows the weighted similarity also where a run of one word or a table makes up
much of the item. Per item size the items' fingerprints lie in a multi-index of 16 blocks of
8 bits: two fingerprints within the radius of 36 bits agree in some block up to two bits, so the blocks' tables of
values up to two bits away give every item within the radius. These candidates are checked exactly: the weighted
Jaccard similarity of the two shingle bags must reach the threshold.

A similarity above zero needs a common shingle, so only windows that hold a shingle of an item of their size are
fingerprinted; this loses nothing. At a similarity of exactly 0.8 the expected distance is 19 bits with a deviation
of 4, so about 2 in 100,000 such windows lie beyond the radius; shifted windows of the same passage count as well. An
item of few numbered shingles deviates more: ``tests/llm/test_decontaminate_recall.py`` measures recall by band of
similarity, with and without repeated runs. A sliding window's votes change by two numbered shingles a step: the one that
comes in with its count in the window, and the one that leaves with its count before.

The benchmark is the small side, but its size is checked: it is dealt into slices of about ``SLICE_CHARS``
characters, each slice is read by the driver and sent to the tasks, and the documents are passed over once for each
slice, so what is sent has a fixed bound. Documents are never shuffled.

Words are runs of letters and digits with A-Z lower-cased. Defined results: null and empty documents or items match
nothing; an item of fewer than five words is one shingle; a document with fewer words than an item is one window;
repeated documents and items are matched each on their own; texts of any length are read whole; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from pyspark.sql import DataFrame, functions as F

from skein.llm.textops import NOT_ALNUM, chunks, documents, mix, shingles, words

SHINGLE = 5
THRESHOLD = 0.8
RADIUS = 36
BLOCKS = 16
SLICE_CHARS = 8_000_000
_SLOTS = 1 << 20


def simhash_bits(grams: np.ndarray, number: np.ndarray) -> np.ndarray:
    """+1/-1 votes of each shingle's occurrence of that number (from 1) on 128 bits."""
    grams = grams ^ mix(number.astype(np.uint64), 13)
    both = np.stack([mix(grams, 11), mix(grams, 12)], 1).view(np.uint8).reshape(len(grams), 16)
    return np.unpackbits(both, axis=1).astype(np.int8) * 2 - 1


def fingerprints(votes: np.ndarray) -> np.ndarray:
    """128-bit fingerprints as 16 bytes from vote sums (a tie is a zero bit)."""
    return np.packbits(votes > 0, axis=1)


class Occurrences:
    """How often each shingle occurs before any place."""

    def __init__(self, grams: np.ndarray):
        n = len(grams)
        self.size = n + 1
        _, self.kind = np.unique(grams, return_inverse=True)
        self.sorted = np.sort(self.kind * self.size + np.arange(n))
        self.first = np.searchsorted(self.sorted, self.kind * self.size)

    def before(self, which: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Occurrences of the shingle at ``which`` before ``place``."""
        return np.searchsorted(self.sorted, self.kind[which] * self.size + place) - self.first[which]


def window_votes(grams: np.ndarray, m: int) -> np.ndarray:
    """Vote sums of the numbered shingles of every m consecutive ones."""
    seen = Occurrences(grams)
    head = np.arange(min(m, len(grams)))
    first = simhash_bits(grams[head], seen.before(head, head) + 1).sum(0, dtype=np.int32)[None]
    t = np.arange(1, len(grams) - m + 1)
    if not len(t):
        return first
    enters, leaves = t + m - 1, t - 1
    come = simhash_bits(grams[enters], seen.before(enters, t + m) - seen.before(enters, t))
    go = simhash_bits(grams[leaves], seen.before(leaves, t + m - 1) - seen.before(leaves, t - 1))
    return np.concatenate([first, first + np.cumsum(come - go, 0, dtype=np.int32)])


class SizeClass:
    """Items of one size in words, with their multi-index."""

    def __init__(self, items: list[int], prints: np.ndarray):
        self.items, self.prints = np.array(items), prints
        near = np.bitwise_count(np.arange(256, dtype=np.uint8)[:, None] ^ np.arange(256, dtype=np.uint8)) <= RADIUS // BLOCKS
        # table[block, value]: packed bits of the items whose block is at most two bits away
        self.table = np.stack([np.packbits(near[:, prints[:, j]], axis=1) for j in range(BLOCKS)])

    def within(self, windows: np.ndarray):
        """(window, item) numbers of all fingerprints within the radius."""
        left, right = [], []
        step = max(1, (1 << 24) // max(1, len(self.items)))
        for lo in range(0, len(windows), step):
            w = windows[lo:lo + step]
            hit = self.table[0][w[:, 0]]
            for j in range(1, BLOCKS):
                hit = hit | self.table[j][w[:, j]]
            i, k = np.nonzero(np.unpackbits(hit, axis=1, count=len(self.items)))
            close = np.bitwise_count(w[i] ^ self.prints[k]).sum(1) <= RADIUS
            left.append(i[close] + lo)
            right.append(self.items[k[close]])
        return np.concatenate(left), np.concatenate(right)


class BenchmarkIndex:
    """Items of one slice: their shingle bags, fingerprints by size, and the sizes each shingle occurs in."""

    def __init__(self, rows: list[tuple]):
        self.ids = [r[0] for r in rows]
        self.bags: list[tuple[np.ndarray, np.ndarray] | None] = []
        sizes: dict[int, list[int]] = {}
        prints = {}
        pairs: dict[int, list[tuple[int, int]]] = {}
        for i, (_, text) in enumerate(rows):
            raw = np.frombuffer((text or "").encode(), np.uint8)
            w, *_ = words(raw, np.array([0, len(raw)]), NOT_ALNUM)
            n = len(w)
            if not n:
                self.bags.append(None)
                continue
            k = min(n, SHINGLE)
            grams, _ = shingles(w, np.array([0, n]), k)
            self.bags.append(np.unique(grams, return_counts=True))
            sizes.setdefault(n, []).append(i)
            prints[i] = fingerprints(window_votes(grams, len(grams)))[0]
            pairs.setdefault(k, []).extend((int(g), n) for g in self.bags[-1][0])
        self.classes = {n: SizeClass(items, np.stack([prints[i] for i in items])) for n, items in sizes.items()}
        # by shingle length: sorted shingles, and the item sizes of each (repeated shingles are neighbours)
        self.anchors = {}
        for k, found in pairs.items():
            found = sorted(set(found))
            grams = np.array([g for g, _ in found], np.uint64)
            slots = np.zeros(_SLOTS, bool)
            slots[(grams >> np.uint64(44)).astype(np.int64)] = True
            self.anchors[k] = (grams, np.array([n for _, n in found]), slots)

    def matches(self, data: np.ndarray, offsets: np.ndarray, threshold: float) -> dict[tuple[int, int], tuple[float, int, int]]:
        """(row, item) -> (best similarity, its first word, words in the window)."""
        hashes, _, _, bounds = words(data, offsets, NOT_ALNUM)
        best: dict[tuple[int, int], tuple[float, int, int]] = {}
        for k, (known, sizes, slots) in self.anchors.items():
            grams, at = shingles(hashes, bounds, k)
            if not len(grams):
                continue
            maybe = np.flatnonzero(slots[(grams >> np.uint64(44)).astype(np.int64)])
            lo = np.searchsorted(known, grams[maybe], "left")
            count = np.searchsorted(known, grams[maybe], "right") - lo
            anchor = np.repeat(maybe, count)
            size = sizes[np.repeat(lo - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())] if count.sum() else np.zeros(0, int)
            for n in np.unique(size):
                self._windows(int(n), k, at[anchor[size == n]], hashes, bounds, threshold, best)
        return best

    def _windows(self, n, k, anchors, hashes, bounds, threshold, best):
        """All windows of n words that hold an anchor: fingerprint, candidates, exact similarity."""
        row = np.searchsorted(bounds, anchors, "right") - 1
        first, last = bounds[row], bounds[row + 1]
        lo = np.maximum(anchors - (n - k), first)
        hi = np.minimum(anchors, np.maximum(last - n, first))
        lo = np.minimum(lo, hi)
        reach = hi - lo + 1
        starts = np.unique(np.repeat(lo - np.concatenate([[0], np.cumsum(reach)[:-1]]), reach) + np.arange(reach.sum()))
        row = np.searchsorted(bounds, starts, "right") - 1
        ends = np.minimum(starts + n, bounds[row + 1])
        # runs of neighbouring windows share one table of running votes
        cut = np.flatnonzero(np.append(True, (np.diff(starts) > n) | (np.diff(row) > 0)))
        for a, b in zip(cut, np.append(cut[1:], len(starts))):
            s, e, r = starts[a:b], ends[a:b], int(row[a])
            span = hashes[s[0]:e[-1]]
            grams, _ = shingles(span, np.array([0, len(span)]), k)
            from_, to = s - s[0], np.maximum(e - s[0] - k + 1, s - s[0])
            prints = fingerprints(window_votes(grams, int(to[0] - from_[0]))[from_])
            for w, item in zip(*self.classes[n].within(prints)):
                sim = weighted_jaccard(np.unique(grams[from_[w]:to[w]], return_counts=True), self.bags[item])
                key = (r, int(item))
                if sim >= threshold and sim > best.get(key, (-1.0,))[0]:
                    best[key] = (sim, int(s[w] - bounds[r]), int(e[w] - s[w]))


def weighted_jaccard(a, b) -> float:
    """Sum of the smaller weights over the sum of the larger, of two (shingles, weights)."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    common = np.minimum(a[1][i], b[1][j]).sum()
    total = a[1].sum() + b[1].sum() - common
    return float(common / total) if total else 0.0


def _slices(benchmark: DataFrame, id_col="item_id", text_col="text"):
    """The items in lists of about SLICE_CHARS characters."""
    items = benchmark.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where("length(text) > 0")
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = int(size // SLICE_CHARS) + 1
    for i in range(n):
        part = items if n == 1 else items.where(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == i)
        yield [(r.id, r.text) for r in part.collect()]


MATCHES = "doc_id bigint, item_id bigint, similarity double, first_word bigint, n_words bigint"


def contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, id_col="doc_id",
                 text_col="text", item_col="item_id") -> DataFrame:
    """A row for each document and item that meet: ``doc_id, item_id, similarity, first_word, n_words`` of the best
    window. Documents that meet no item have no row."""
    src = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    out = None
    for rows in _slices(benchmark, item_col):
        def run(batches, rows=rows):
            index = BenchmarkIndex(rows)
            for batch in batches:
                for lo, hi, data, off in chunks(batch.column(1)):
                    found = sorted(index.matches(data, off, threshold).items())
                    ids = batch.column(0)[lo:hi].to_pylist()
                    yield pa.RecordBatch.from_arrays([
                        pa.array([ids[r] for (r, _), _ in found], pa.int64()),
                        pa.array([index.ids[i] for (_, i), _ in found], pa.int64()),
                        pa.array([v[0] for _, v in found], pa.float64()), pa.array([v[1] for _, v in found], pa.int64()),
                        pa.array([v[2] for _, v in found], pa.int64())],
                        names=["doc_id", "item_id", "similarity", "first_word", "n_words"])

        part = src.mapInArrow(run, MATCHES)
        out = part if out is None else out.union(part)
    return out


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, text_col="text",
                        item_col="item_id") -> DataFrame:
    """Rows of ``docs`` that meet no item, all columns as they are, in place."""
    at = docs.columns.index(text_col)
    for rows in _slices(benchmark, item_col):
        def run(batches, rows=rows):
            index = BenchmarkIndex(rows)
            for batch in batches:
                clean = np.ones(batch.num_rows, bool)
                for lo, _, data, off in chunks(batch.column(at)):
                    for row, _ in index.matches(data, off, threshold):
                        clean[lo + row] = False
                yield batch.filter(pa.array(clean))

        docs = docs.mapInArrow(run, docs.schema)
    return docs


def op1_decontamination(spark, sf_dir):
    """Every pair of a document and a benchmark item that it holds, over all documents and items."""
    return contaminated(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
