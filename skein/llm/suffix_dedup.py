"""Repeated passages: bytes covered by a 50-byte string that also starts in a document with a smaller id.

Suffixes are sorted with hashes: prefix polynomial hashes tell by binary search how far two suffixes agree, so a
comparison costs log(length) steps, and a mergesort on these comparisons puts equal strings side by side; neighbours
that agree over the whole length are then compared byte by byte. To spread this over a cluster, suffixes that can be
equal are brought together by anchors: of every 50 bytes' 31 twenty-byte grams the one with the smallest hash is an
anchor, so equal strings have an anchor of the same content at the same place, and only suffixes around the same
anchor need a common sort.

1. Anchors of every document go to buckets by their gram, as packed arrays (a task combines grams that several of its
   documents hold first); back come the grams that at least two documents hold.
2. An anchor stands for the windows of which it is the first smallest gram. Around each shared anchor the bytes of its
   windows, its context, go to buckets by gram. Equal ones are combined first: all but the smallest id's are then
   decided. A gram so common that its bucket would grow without bound is split: its windows go out by their own content,
   equal ones combined first as well.
3. A bucket's equal contexts are combined. Windows that different contexts of a gram share follow from the pairs' common
   extensions, by prefix hashes and binary search, where a gram has few (``PAIRS``), and else from a suffix sort of the
   windows; a window is repeated if a smaller id has it.
4. Repeated windows return to their documents, whose bytes are cut.

Buckets follow the input's size, so no task holds more than a bucket and no document's bytes are sent more often than
its shared anchors ask for. The driver holds scalars and the list of split grams (at most ``MAX_SPLIT``).

Defined results: null texts count as empty; texts under 50 bytes keep everything; rows without an id neither lose bytes
nor make others lose them; repeated rows of one id are not smaller than each other, so they are treated alike; extra
columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa

from pyspark.sql import DataFrame, functions as F

from skein.llm.textops import ROW_CHUNK_BYTES, byte_hash, chunks, documents, mix, powers, prefix_hash, release, store

LENGTH = 50
GRAM = 20
SPAN = LENGTH - GRAM  # a window begins at most so many bytes before its anchor
WIDE = LENGTH + SPAN  # bytes around an anchor that its windows cover
#: Bytes of documents in a bucket, about; a sixteenth as many anchors.
BUCKET_BYTES = 8_000_000
FLUSH_ANCHORS = 500_000
FLUSH_BYTES = 16_000_000
#: Contexts that are combined, or sorted, at once.
PIECE = 20_000
MAX_SPLIT = 100_000
#: A gram is split if it is at least so frequent, or one in MAX_SPLIT of all anchors.
SPLIT_FROM = 20_000
#: A task reports how often a gram occurs from this count on.
REPORT_FROM = 50

_CONTEXT = np.dtype([("key", "<u8"), ("doc", "<i8"), ("uid", "<i8"), ("pos", "<u4"), ("lo", "u1"), ("hi", "u1"),
                     ("bytes", "u1", (WIDE,))])
_MARK = np.dtype([("uid", "<i8"), ("pos", "<u4"), ("mask", "<u4")])
#: A gram that other documents hold as well, for one of its documents: the low 40 bits of its hash.
_PLACE = np.dtype([("uid", "<i8"), ("low", "<u4"), ("high", "u1")])
_LOW40 = np.uint64((1 << 40) - 1)
_AT = np.arange(WIDE, dtype=np.uint8)
#: Up to so many different contexts of a gram are compared pair by pair; more are suffix-sorted window by window.
PAIRS = 48


def anchors(data: np.ndarray, offsets: np.ndarray):
    """(row, position, gram hash, first and last begin of its windows) of every anchor; positions in ``data``."""
    none = np.zeros(0, np.int64)
    empty = none, none, np.zeros(0, np.uint64), none, none
    n = len(data)
    if n < LENGTH:
        return empty
    c = prefix_hash(data)
    grams = mix((c[GRAM:] - c[:-GRAM]) * powers(n + 1)[1][:n - GRAM + 1])
    rank = (grams >> np.uint64(32)).astype(np.uint32)
    # the smallest rank of 31 consecutive grams
    least, have = rank, 1
    while have * 2 <= SPAN + 1:
        least = np.minimum(least[:-have], least[have:])
        have *= 2
    least = np.minimum(least[:len(rank) - SPAN], least[SPAN + 1 - have:][:len(rank) - SPAN])
    # windows that lie in one row; the others have no say (0 is below every rank but 0 itself)
    ok = np.zeros(len(least) + 1, np.int8)
    ends = np.maximum(offsets[1:] - LENGTH + 1, offsets[:-1])
    some = ends > offsets[:-1]
    np.add.at(ok, offsets[:-1][some], 1)
    np.add.at(ok, ends[some], -1)
    inside = np.cumsum(ok)[:-1].astype(bool)
    floor = np.where(inside, least, 0)
    # a gram is an anchor if it is the smallest of some window: its rank equals the largest minimum around it
    reach = np.concatenate([np.zeros(SPAN, np.uint32), floor, np.zeros(SPAN, np.uint32)])
    best, have = reach, 1
    while have * 2 <= SPAN + 1:
        best = np.maximum(best[:-have], best[have:])
        have *= 2
    best = np.maximum(best[:len(rank)], best[SPAN + 1 - have:][:len(rank)])
    at = np.flatnonzero((best == rank) & (best > 0))
    row = np.searchsorted(offsets, at, "right") - 1
    # windows of which an anchor is the first smallest: they begin after the last earlier anchor that ranks no higher
    # and end before the next that ranks lower comes in
    r = rank[at].astype(np.int64)
    first = np.maximum(at - SPAN, offsets[row])
    last = np.minimum(at, offsets[row + 1] - LENGTH)
    for k in range(1, SPAN + 1):
        before = at[k:] - at[:-k]
        near = before <= SPAN
        if not near.any():
            break
        lower = near & (r[:-k] <= r[k:])
        first[k:] = np.where(lower, np.maximum(first[k:], at[:-k] + 1), first[k:])
        lower = near & (r[k:] < r[:-k])
        last[:-k] = np.where(lower, np.minimum(last[:-k], at[k:] - SPAN - 1), last[:-k])
    return row, at, grams[at], first, last


def _by_bucket(bucket: np.ndarray) -> np.ndarray:
    """Stable order by bucket; numpy sorts 16 bits by digits."""
    small = len(bucket) and bucket.max() < 1 << 16
    return np.argsort(bucket.astype(np.uint16) if small else bucket, kind="stable")


def _pack(records: np.ndarray, bucket: np.ndarray, first: int = 0, kind: int = 0):
    """Rows (bucket, kind, bytes) of records by bucket."""
    order = _by_bucket(bucket)
    records, bucket = records[order], bucket[order]
    cut = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(bucket) else np.zeros(0, np.int64)
    return ([int(b) + first for b in bucket[cut]], [kind] * len(cut),
            [records[a:b].tobytes() for a, b in zip(cut, np.append(cut[1:], len(records)))])


def _rows(*packed) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([
        pa.array([b for p in packed for b in p[0]], pa.int64()), pa.array([k for p in packed for k in p[1]], pa.int32()),
        pa.array([x for p in packed for x in p[2]], pa.binary())], names=["bucket", "kind", "data"])


_ROWS = "bucket bigint, kind int, data binary"
# kinds of rows
_GRAMS, _KNOWN, _PLACES, _COUNTS, _CONTEXTS, _WINDOWS, _MARKS, _TEXTS = range(8)
_COUNT = np.dtype([("key", "<u8"), ("n", "<i8")])


def _pack_grams(key, uid, bucket, first=0):
    """Gram records by bucket in columns: 40 bits of the gram, and the document once for a run."""
    order = _by_bucket(bucket)
    key, uid, bucket = key[order], uid[order], bucket[order]
    cut = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(bucket) else np.zeros(0, np.int64)
    low, high = _split40(key)
    out = []
    for a, b in zip(cut, np.append(cut[1:], len(key))):
        runs = np.flatnonzero(np.append(True, uid[a + 1:b] != uid[a:b - 1]))
        out.append(b"".join((
            np.array([b - a, len(runs)], "<u4").tobytes(), low[a:b].tobytes(), high[a:b].tobytes(),
            uid[a:b][runs].tobytes(), np.diff(np.append(runs, b - a)).astype("<u4").tobytes())))
    return [int(b) + first for b in bucket[cut]], [_GRAMS] * len(cut), out


def _split40(key):
    return (key & np.uint64(0xFFFFFFFF)).astype("<u4"), ((key >> np.uint64(32)) & np.uint64(0xFF)).astype("u1")


def _join40(low, high):
    return low | (high.astype(np.uint64) << np.uint64(32))


def _unpack_grams(blob: bytes):
    n, r = (int(x) for x in np.frombuffer(blob, "<u4", 2))
    key = _join40(np.frombuffer(blob, "<u4", n, 8), np.frombuffer(blob, "u1", n, 8 + 4 * n))
    uid = np.frombuffer(blob, "<i8", r, 8 + 5 * n)
    return key, np.repeat(uid, np.frombuffer(blob, "<u4", r, 8 + 5 * n + 8 * r))


def _places(key, uid):
    out = np.empty(len(key), _PLACE)
    out["uid"] = uid
    out["low"], out["high"] = _split40(key)
    return out


def _shared(key: np.ndarray, uid: np.ndarray):
    """(order by key, begin of each key's run, run of each element, whether the run has two different uids)."""
    order = np.argsort(key)
    k, u = key[order], uid[order]
    new = np.append(True, k[1:] != k[:-1]) if len(k) else np.zeros(0, bool)
    begin = np.flatnonzero(new)
    run = np.cumsum(new) - 1
    many = np.minimum.reduceat(u, begin) != np.maximum.reduceat(u, begin) if len(k) else np.zeros(0, bool)
    return order, begin, run, many


def _send_anchors(n_gram, n_doc):
    def run(batches):
        held, size = [], 0

        def flush():
            uid, key = (np.concatenate(x) for x in zip(*held))
            order, begin, run_, many = _shared(key, uid)
            count = np.bincount(run_)
            spread = np.zeros(len(key), bool)
            spread[order] = many[run_]
            place = _places(key[spread], uid[spread])
            first = key[order[begin]]
            known = first[many]
            told = np.empty(int((count >= REPORT_FROM).sum()), _COUNT)
            told["key"], told["n"] = first[count >= REPORT_FROM], count[count >= REPORT_FROM]
            one = ~spread
            return _rows(
                _pack_grams(key[one], uid[one], _bucket(key[one], n_gram)),
                _pack(known & _LOW40, _bucket(known, n_gram), kind=_KNOWN),
                _pack(place, place["uid"] % n_doc, n_gram, _PLACES),
                _pack(told, np.zeros(len(told), np.int64), n_gram + n_doc, _COUNTS))

        for batch in batches:
            ids = batch.column(0).to_numpy()
            for lo, hi, data, off in chunks(batch.column(1), ROW_CHUNK_BYTES):
                row, _, key, _, _ = anchors(data, off)
                held.append((ids[lo:hi][row], key))
                size += len(key)
                if size >= FLUSH_ANCHORS:
                    yield flush()
                    held, size = [], 0
        if size:
            yield flush()

    return run


def _bucket(key: np.ndarray, n: int) -> np.ndarray:
    return (mix(key, 5) % np.uint64(n)).astype(np.int64)


def _meet_anchors(n_gram, n_doc):
    """Of one bucket's grams: the places of those that at least two documents hold, by document bucket."""
    def run(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        by_kind = {}
        for kind, data in zip(table.column("kind").to_pylist(), table.column("data").to_pylist()):
            by_kind.setdefault(kind, []).append(data)
        out = []
        if bucket < n_gram:
            key, uid = (np.concatenate(x) for x in zip(*[_unpack_grams(b) for b in by_kind[_GRAMS]])) if (
                _GRAMS in by_kind) else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
            known = np.frombuffer(b"".join(by_kind.get(_KNOWN, [])), "<u8")
            order, begin, run_, many = _shared(key, uid)
            if len(begin):
                many = many | np.isin(key[order[begin]], known)
                hit = order[many[run_]]
                place = _places(key[hit], uid[hit])
                out.append(_pack(place, place["uid"] % n_doc, 0, _PLACES))
        elif bucket < n_gram + n_doc:
            out.append(([bucket - n_gram], [_PLACES], [b"".join(by_kind[_PLACES])]))
        else:
            told = np.frombuffer(b"".join(by_kind[_COUNTS]), _COUNT)
            key, at = np.unique(told["key"], return_inverse=True)
            total = np.empty(len(key), _COUNT)
            total["key"], total["n"] = key, np.bincount(at, told["n"], len(key))
            out.append(([-1], [_COUNTS], [total.tobytes()]))
        return pa.Table.from_batches([_rows(*out)])

    return run


def _frequent(split_from):
    def run(batches):
        for batch in batches:
            for blob in batch.column(0).to_pylist():
                told = np.frombuffer(blob, _COUNT)
                yield pa.RecordBatch.from_arrays([pa.array(told["key"][told["n"] >= split_from].view(np.int64))], names=["key"])

    return run


def _send_texts(n):
    """Documents by home (their uid's remainder; n higher without an id), packed and compressed."""
    def run(batches):
        held, size = [], 0

        def flush():
            docs, uids, homes = (np.concatenate(x) for x in zip(*[h[:3] for h in held]))
            length = np.concatenate([np.diff(h[4]) for h in held])
            data = np.concatenate([h[3] for h in held])
            begin = np.concatenate([[0], np.cumsum(length)])
            order = np.argsort(homes, kind="stable")
            cut = np.flatnonzero(np.append(True, np.diff(homes[order]) != 0))
            out = []
            for a, b in zip(cut, np.append(cut[1:], len(order))):
                at = order[a:b]
                raw = b"".join([np.int64(len(at)).tobytes(), docs[at].tobytes(), uids[at].tobytes(), length[at].tobytes(),
                                *[data[begin[i]:begin[i + 1]].tobytes() for i in at]])
                out.append(_zip(raw))
            return _rows(([int(h) for h in homes[order][cut]], [_TEXTS] * len(cut), out))

        for batch in batches:
            known = ~np.array(batch.column(0).is_null())
            docs = batch.column(0).fill_null(0).to_numpy(zero_copy_only=False)
            uids = batch.column(1).to_numpy(zero_copy_only=False)
            for lo, hi, data, off in chunks(batch.column(2)):
                held.append((docs[lo:hi], uids[lo:hi], np.where(known[lo:hi], 0, n) + uids[lo:hi] % n, data, off))
                size += len(data)
                if size >= FLUSH_BYTES:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    return run


def _zip(raw: bytes) -> bytes:
    return len(raw).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True)


def _unzip(blob: bytes) -> bytes:
    return pa.decompress(blob[8:], int.from_bytes(blob[:8], "little"), "zstd", asbytes=True)


def _grouped(table: pa.Table):
    """Yield (ids, uids, bytes, offsets) of packed documents, about ROW_CHUNK_BYTES at a time: the more tasks sent records to
    a bucket, the smaller these are, so small ones are joined."""
    held, size = [], 0

    def joined():
        docs, uids, text, length = (np.concatenate(x) if len(x) > 1 else x[0] for x in zip(*held))
        return docs, uids, text, np.concatenate([[0], np.cumsum(length)])

    for blob in table.column("data"):
        raw = _unzip(blob.as_py())
        n = int(np.frombuffer(raw, "<i8", 1)[0])
        docs, uids, length = (np.frombuffer(raw, "<i8", n, 8 + 8 * n * k) for k in range(3))
        off = np.concatenate([[0], np.cumsum(length)])
        text, lo = np.frombuffer(raw, "u1", -1, 8 + 24 * n), 0
        while lo < n:
            hi = min(n, max(lo + 1, int(np.searchsorted(off, off[lo] + ROW_CHUNK_BYTES - size, "right")) - 1))
            if held and size + off[hi] - off[lo] > ROW_CHUNK_BYTES:
                yield joined()
                held, size = [], 0
                continue
            held.append((docs[lo:hi], uids[lo:hi], text[off[lo]:off[hi]], length[lo:hi]))
            size += off[hi] - off[lo]
            lo = hi
    if held:
        yield joined()


def _send_contexts(n_gram, n_doc, split):
    """Of one bucket of documents and its shared places: the bytes around them by gram, equal ones combined."""
    def run(key, docs: pa.Table, places: pa.Table) -> pa.Table:
        place = np.frombuffer(b"".join(places.column("data").to_pylist()), _PLACE) if len(places) else np.zeros(0, _PLACE)
        # a hash of (document, gram) for the lookup; a chance hit only sends a context in vain
        wanted = np.unique(_pair_hash(place["uid"], _join40(place["low"], place["high"])))
        kept, marks = [], []
        for ids, uids, data, off in _grouped(docs) if len(docs) and len(place) else ():
            row, at, gram, first, last = anchors(data, off)
            padded = np.concatenate([np.zeros(SPAN, np.uint8), data, np.zeros(WIDE, np.uint8)])
            around = np.lib.stride_tricks.sliding_window_view(padded, WIDE)  # row i: from byte i - SPAN on
            look = _pair_hash(uids[row], gram & _LOW40)
            hit = np.flatnonzero(wanted[np.minimum(np.searchsorted(wanted, look), len(wanted) - 1)] == look)
            for a in range(0, len(hit), PIECE):
                h = hit[a:a + PIECE]
                rec = np.zeros(len(h), _CONTEXT)
                rec["key"], rec["uid"], rec["doc"] = gram[h], uids[row[h]], ids[row[h]]
                rec["pos"] = at[h] - off[row[h]]
                rec["lo"], rec["hi"] = SPAN + first[h] - at[h], SPAN + last[h] - at[h] + LENGTH
                rec["bytes"] = around[at[h]] * _inside(rec)
                rec, decided = _combine(rec)
                kept.append(rec)
                marks.append(decided)
        if not kept:
            return pa.Table.from_batches([_rows()])
        rec = np.concatenate(kept)
        common = np.isin(rec["key"], split)
        apart = rec[common]
        apart, packed = apart[np.argsort(apart["key"], kind="stable")], []
        for a in range(0, len(apart), PIECE):
            part, decided = _windows_apart(apart[a:a + PIECE])
            packed.append(_pack_contexts(part, _bucket(part["key"], n_gram), _WINDOWS))
            marks.append(decided)
        marks = np.concatenate(marks)
        return pa.Table.from_batches([_rows(
            _pack_contexts(rec[~common], _bucket(rec["key"][~common], n_gram)), *packed,
            _pack(marks, marks["uid"] % n_doc, n_gram, _MARKS))])

    return run


def _pair_hash(uid, key):
    return mix(uid.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + key)


def _pack_contexts(rec: np.ndarray, bucket: np.ndarray, kind: int = _CONTEXTS):
    """Contexts by bucket, in columns and compressed, without the bytes outside their windows; keys follow from the
    bytes."""
    order = _by_bucket(bucket)
    rec, bucket = rec[order], bucket[order]
    cut = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(bucket) else np.zeros(0, np.int64)
    inside = _inside(rec)
    out = []
    for a, b in zip(cut, np.append(cut[1:], len(rec))):
        part = rec[a:b]
        out.append(_zip(np.uint32(b - a).tobytes() + b"".join(part[c].tobytes() for c in ("doc", "uid", "pos", "lo", "hi"))
                        + part["bytes"][inside[a:b]].tobytes()))
    return [int(b) for b in bucket[cut]], [kind] * len(cut), out


def _inside(rec: np.ndarray) -> np.ndarray:
    """Of a context's bytes those that its windows cover."""
    return (_AT >= rec["lo"][:, None]) & (_AT < rec["hi"][:, None])


def _unpack_contexts(blobs, kind: int):
    """Yield the contexts of packed records of one kind, about PIECE at a time: records are small where the buckets are
    many."""
    raws, sizes, total = [], [], 0
    for i, blob in enumerate(blobs):
        raws.append(_unzip(blob))
        sizes.append(int.from_bytes(raws[-1][:4], "little"))
        total += sizes[-1]
        if total < PIECE and i + 1 < len(blobs):
            continue
        rec, at = np.zeros(total, _CONTEXT), [4] * len(raws)
        for c in ("doc", "uid", "pos", "lo", "hi"):
            rec[c] = np.concatenate([np.frombuffer(r, _CONTEXT[c], n, a) for r, n, a in zip(raws, sizes, at)])
            at = [a + n * _CONTEXT[c].itemsize for a, n in zip(at, sizes)]
        full = np.zeros((len(rec), WIDE), np.uint8)
        full[_inside(rec)] = np.concatenate([np.frombuffer(r, "u1", -1, a) for r, a in zip(raws, at)])
        rec["bytes"] = full
        rec["key"] = context_hash(rec) if kind == _WINDOWS else mix(byte_hash(full[:, SPAN:SPAN + GRAM]))
        yield rec
        raws, sizes, total = [], [], 0


def _windows_apart(rec: np.ndarray):
    """Contexts of split grams as one record for each window, with the window's own hash as its key; equal ones are combined:
    (windows left, marks)."""
    kept, marks = [np.zeros(0, _CONTEXT)], [np.zeros(0, _MARK)]
    for o in range(SPAN + 1):
        part = rec[(rec["lo"] <= o) & (rec["hi"] >= o + LENGTH)].copy()
        part["lo"], part["hi"] = o, o + LENGTH
        part["bytes"][:, :o] = part["bytes"][:, o + LENGTH:] = 0
        part["key"] = context_hash(part)
        part, decided = _combine(part)
        kept.append(part)
        marks.append(decided)
    return np.concatenate(kept), np.concatenate(marks)


def context_hash(rec: np.ndarray) -> np.ndarray:
    """Hash of a context's bytes and of where they lie around the gram."""
    out = np.empty(len(rec), np.uint64)
    for at in range(0, len(rec), PIECE):
        part = rec[at:at + PIECE]
        words = np.ascontiguousarray(part["bytes"]).view("<u8")
        h = part["lo"] * np.uint64(257) + part["hi"]
        for j in range(words.shape[1]):
            h = mix(h ^ words[:, j], j + 1)
        out[at:at + PIECE] = h
    return out


def _full_mask(rec: np.ndarray) -> np.ndarray:
    """Bits of the window offsets that lie in the document."""
    lo = rec["lo"].astype(np.uint64)
    n = np.maximum(rec["hi"].astype(np.int64) - LENGTH - rec["lo"] + 1, 0).astype(np.uint64)
    return (((np.uint64(1) << n) - np.uint64(1)) << lo).astype(np.uint32)


def _same_context(rec: np.ndarray):
    """Contexts with equal ones as neighbours, smallest id first (brought together by a hash, compared whole); True where
    a new one begins."""
    rec = rec[np.lexsort((rec["doc"], context_hash(rec), rec["key"]))]
    new = np.ones(len(rec), bool)
    for at in range(1, len(rec), PIECE):
        x, y = rec[at - 1:at - 1 + PIECE][:len(rec) - at], rec[at:at + PIECE]
        new[at:at + PIECE] = (x["key"] != y["key"]) | (x["lo"] != y["lo"]) | (x["hi"] != y["hi"]) | (x["bytes"] != y["bytes"]).any(1)
    return rec, new


def _combine(rec: np.ndarray):
    """(contexts left, marks): of equal contexts those of the smallest id stay, all windows of the others are repeats."""
    rec, new = _same_context(rec)
    least = rec["doc"][new][np.cumsum(new) - 1] if len(rec) else rec["doc"]
    later = rec["doc"] > least
    marks = np.empty(int(later.sum()), _MARK)
    marks["uid"], marks["pos"], marks["mask"] = rec["uid"][later], rec["pos"][later], _full_mask(rec[later])
    return rec[~later], marks


class Suffixes:
    """Suffixes of one buffer, compared over at most ``limit`` bytes by prefix hashes."""

    def __init__(self, data: np.ndarray, limit: int):
        self.data, self.limit = data, limit
        self.c = prefix_hash(data)
        self.q = powers(len(data) + 1)[1]

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common extension of the suffixes at a and b, up to the limit."""
        out = np.full(len(a), self.limit)
        qa, qb, ca, cb = self.q[a], self.q[b], self.c[a], self.c[b]
        part = np.flatnonzero((self.c[a + self.limit] - ca) * qa != (self.c[b + self.limit] - cb) * qb)
        a, b, qa, qb, ca, cb = a[part], b[part], qa[part], qb[part], ca[part], cb[part]
        lo, step = np.zeros(len(a), np.int64), 1 << (self.limit.bit_length() - 1)
        while step and len(a):
            mid = np.minimum(lo + step, self.limit)
            same = (self.c[a + mid] - ca) * qa == (self.c[b + mid] - cb) * qb
            lo = np.where(same, mid, lo)
            step >>= 1
        out[part] = lo
        return out

    def less(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        n = self.common(a, b)
        last = len(self.data) - 1
        return (n < self.limit) & (self.data[np.minimum(a + n, last)] < self.data[np.minimum(b + n, last)])

    def sort(self, starts: np.ndarray, segment: np.ndarray) -> np.ndarray:
        """Order that sorts the suffixes within each segment: a bottom-up mergesort, all segments side by side. A
        merged place is the place in the own run plus the rank in the other run, found by binary search."""
        order = np.argsort(segment, kind="stable")
        seg = segment[order]
        new = np.append(True, seg[1:] != seg[:-1]) if len(seg) else np.zeros(0, bool)
        begin = np.flatnonzero(new)
        size = np.diff(np.append(begin, len(seg)))
        base, total = np.repeat(begin, size), np.repeat(size, size)
        width = 1
        while len(size) and width < size.max():
            live = np.flatnonzero(total > width)
            local = live - base[live]
            run = local // width
            lo = np.minimum((run ^ 1) * width, total[live])
            hi = np.minimum(lo + width, total[live])
            left, right, sibling = lo.copy(), hi.copy(), base[live]
            mine = starts[order[live]]
            is_left = run % 2 == 0
            for _ in range(int(width).bit_length()):
                open_ = np.flatnonzero(left < right)
                if not len(open_):
                    break
                mid = (left[open_] + right[open_]) >> 1
                other = starts[order[sibling[open_] + mid]]
                own = mine[open_]
                # equal suffixes of the left run come first
                go = np.where(is_left[open_], self.less(other, own), ~self.less(own, other))
                left[open_] = np.where(go, mid + 1, left[open_])
                right[open_] = np.where(go, right[open_], mid)
            place = sibling + (run & ~1) * width + (local - run * width) + (left - lo)
            moved = order.copy()
            moved[place] = order[live]
            order = moved
            width *= 2
        return order


def repeated_windows(rec: np.ndarray) -> np.ndarray:
    """Marks of the windows of a bucket's contexts that a smaller id has as well."""
    rec, new = _same_context(rec)
    if not len(rec):
        return np.zeros(0, _MARK)
    which = np.cumsum(new) - 1
    unique = rec[new]  # smallest id first
    least = unique["doc"]
    mask = np.where(rec["doc"] > least[which], _full_mask(rec), 0).astype(np.uint32)
    # windows of grams with different contexts
    group = np.cumsum(np.append(True, unique["key"][1:] != unique["key"][:-1])) - 1
    several = np.flatnonzero(np.bincount(group)[group] > 1)
    found = np.zeros(len(unique), np.uint32)
    few = np.bincount(group)[group[several]] <= PAIRS
    found |= _paired_windows(unique, group, several[few])
    several, at = several[~few], 0
    while at < len(several):
        end = min(at + PIECE // 4, len(several))
        while end < len(several) and group[several[end]] == group[several[end - 1]]:
            end += 1
        part = several[at:end]
        found[part] |= _sorted_windows(unique[part], group[part])
        at = end
    mask |= np.where(rec["doc"] == least[which], found[which], 0).astype(np.uint32)
    out = np.empty(int((mask > 0).sum()), _MARK)
    out["uid"], out["pos"], out["mask"] = rec["uid"][mask > 0], rec["pos"][mask > 0], mask[mask > 0]
    return out


def _paired_windows(ctx: np.ndarray, group: np.ndarray, some: np.ndarray) -> np.ndarray:
    """For distinct contexts (of grams with few): bits of the windows that a context of the same gram and a smaller id
    has, from the pairs' common extensions to the left and to the right of the gram."""
    out, size = np.zeros(len(ctx), np.uint32), np.bincount(group)
    for at in range(0, len(some), PIECE):
        part = some[at:at + PIECE]
        for k in range(1, PAIRS):
            part = part[size[group[part]] > k]
            if not len(part):
                break
            for x, y in ((part, part + k), (part, part - k)):
                ok = (y >= 0) & (y < len(ctx))
                x, y = x[ok], y[ok]
                ok = (group[x] == group[y]) & (ctx["doc"][y] < ctx["doc"][x])
                x, y = x[ok], y[ok]
                if not len(x):
                    continue
                a, b = ctx["bytes"][x], ctx["bytes"][y]
                right = Suffixes(np.concatenate([a[:, SPAN:].reshape(-1), b[:, SPAN:].reshape(-1)]), LENGTH)
                left = Suffixes(np.concatenate([a[:, SPAN - 1::-1].reshape(-1), b[:, SPAN - 1::-1].reshape(-1)]), SPAN)
                i = np.arange(len(x))
                r = right.common(i * LENGTH, (len(x) + i) * LENGTH)
                l = left.common(i * SPAN, (len(x) + i) * SPAN)
                lo = np.maximum(np.maximum(ctx["lo"][x], ctx["lo"][y]), SPAN - l).astype(np.int64)
                hi = np.minimum(np.minimum(ctx["hi"][x], ctx["hi"][y]).astype(np.int64), SPAN + r) - LENGTH
                # against collisions: the bytes that the extensions call equal
                inside = (np.arange(WIDE) >= lo[:, None]) & (np.arange(WIDE) < hi[:, None] + LENGTH)
                true = ((a == b) | ~inside).all(1) & (hi >= lo)
                n = np.where(true, hi - lo + 1, 0).astype(np.uint64)
                bits = (((np.uint64(1) << n) - np.uint64(1)) << np.where(true, lo, 0).astype(np.uint64)).astype(np.uint32)
                np.bitwise_or.at(out, x, bits)
    return out


def _met_again(hashes: np.ndarray) -> np.ndarray:
    """Whether another element has the same hash."""
    order = np.argsort(hashes)
    equal = hashes[order[1:]] == hashes[order[:-1]]
    out = np.zeros(len(hashes), bool)
    out[order[1:][equal]] = out[order[:-1][equal]] = True
    return out


def _sorted_windows(ctx: np.ndarray, group: np.ndarray) -> np.ndarray:
    """For distinct contexts: bits of the windows that a context of the same gram and a smaller id has."""
    data = np.ascontiguousarray(ctx["bytes"]).reshape(-1)
    offset = np.arange(SPAN + 1)
    i, o = np.nonzero((offset >= ctx["lo"][:, None]) & (offset + LENGTH <= ctx["hi"][:, None]))
    starts, segment = i * WIDE + o, group[i] * (SPAN + 1) + o
    suffixes = Suffixes(data, LENGTH)
    # a window that is alone in its segment by its whole hash has no equal
    again = _met_again(mix((suffixes.c[starts + LENGTH] - suffixes.c[starts]) * suffixes.q[starts])
                       + segment.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    i, o, starts, segment = i[again], o[again], starts[again], segment[again]
    order = suffixes.sort(starts, segment)
    s, seg, doc = starts[order], segment[order], ctx["doc"][i[order]]
    same = np.zeros(len(s), bool)
    same[1:] = (seg[1:] == seg[:-1]) & (suffixes.common(s[1:], s[:-1]) == LENGTH)
    where = np.flatnonzero(same)
    window = np.arange(LENGTH)
    for lo in range(0, len(where), 1 << 15):  # byte by byte, against collisions
        w = where[lo:lo + (1 << 15)]
        same[w] = (data[s[w, None] + window] == data[s[w - 1, None] + window]).all(1)
    block = np.cumsum(~same) - 1
    least = np.minimum.reduceat(doc, np.flatnonzero(~same)) if len(s) else doc
    hit = order[doc > least[block]] if len(s) else order
    out = np.zeros(len(ctx), np.uint32)
    np.bitwise_or.at(out, i[hit], np.uint32(1) << o[hit].astype(np.uint32))
    return out


def _meet_contexts(n_gram, n_doc):
    def run(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        data = table.column("data").to_pylist()
        if bucket >= n_gram:
            return pa.Table.from_batches([_rows(([bucket - n_gram], [_MARKS], [b"".join(data)]))])
        by_kind = {}
        for kind, blob in zip(table.column("kind").to_pylist(), data):
            by_kind.setdefault(kind, []).append(blob)
        marks = repeated_windows(np.concatenate([r for k in by_kind for r in _unpack_contexts(by_kind[k], k)]))
        return pa.Table.from_batches([_rows(_pack(marks, marks["uid"] % n_doc, 0, _MARKS))])

    return run


def removed_runs(n: int, starts: np.ndarray) -> np.ndarray:
    """Maximal runs covered by windows that begin at ``starts``, as rows (start, end)."""
    starts = np.unique(starts)
    if not len(starts):
        return np.zeros((0, 2), np.int64)
    cut = np.flatnonzero(np.append(True, np.diff(starts) > LENGTH))
    return np.stack([starts[cut], starts[np.append(cut[1:], len(starts)) - 1] + LENGTH], 1)


def _cut(n):
    return lambda key, docs, marks: _without_marked(docs, marks, key[0].as_py() < n)


def _without_marked(docs: pa.Table, marks: pa.Table, known: bool) -> pa.Table:
    mark = np.frombuffer(b"".join(marks.column("data").to_pylist()), _MARK) if len(marks) else np.zeros(0, _MARK)
    mark = mark[np.argsort(mark["uid"], kind="stable")]
    offset = np.arange(SPAN + 1)
    out = []
    for ids, uids, data, off in _grouped(docs) if len(docs) else ():
        lo, hi = (np.searchsorted(mark["uid"], uids, side) for side in ("left", "right"))
        for i, doc in enumerate(ids.tolist()):
            m = mark[lo[i]:hi[i]]
            j, o = np.nonzero((m["mask"][:, None] >> offset) & 1)
            runs = removed_runs(off[i + 1] - off[i], m["pos"][j].astype(np.int64) - SPAN + o)
            text = data[off[i]:off[i + 1]]
            parts, at = [], 0
            for s, e in runs:
                parts.append(text[at:s].tobytes())
                at = e
            kept = b"".join(parts) + text[at:].tobytes()
            out.append((doc if known else None, len(text), len(text) - len(kept), len(runs), kept))
    cols = list(zip(*out)) if out else [()] * 5
    return pa.table({"doc_id": pa.array(cols[0], pa.int64()), "n_bytes": pa.array(cols[1], pa.int64()),
                     "n_removed": pa.array(cols[2], pa.int64()), "n_spans": pa.array(cols[3], pa.int64()),
                     "kept": pa.array(cols[4], pa.binary())})


def remove_repeats(docs: DataFrame, id_col="doc_id", text_col="text") -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept`` (the bytes that remain) for each row."""
    spark = docs.sparkSession
    src = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    src = src.withColumn("uid", F.xxhash64("doc_id", "text").bitwiseAND(F.lit((1 << 63) - 1)))
    long = src.where(f"doc_id is not null and octet_length(text) >= {LENGTH}")
    size = long.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n = max(parts, int(size) // BUCKET_BYTES + 1)
    split_from = max(SPLIT_FROM, int(size) // 16 // MAX_SPLIT)

    met = store(long.select("uid", "text").mapInArrow(_send_anchors(n, n), _ROWS).groupBy("bucket").applyInArrow(
        _meet_anchors(n, n), _ROWS), "repeats-places")
    release(spark)
    # at most one in split_from anchors can be so frequent
    counts = met.where(f"kind = {_COUNTS}").select("data").mapInArrow(_frequent(split_from), "key bigint").collect()
    split = np.array(sorted(r.key for r in counts), np.int64).view(np.uint64)
    texts = long.select("doc_id", "uid", "text").mapInArrow(_send_texts(n), _ROWS)
    places = met.where(f"kind = {_PLACES}")
    sent = texts.groupBy("bucket").cogroup(places.groupBy("bucket")).applyInArrow(_send_contexts(n, n, split), _ROWS)
    marks = store(sent.groupBy("bucket").applyInArrow(_meet_contexts(n, n), _ROWS), "repeats-marks")
    release(spark)
    every = src.select("doc_id", "uid", "text").mapInArrow(_send_texts(n), _ROWS)
    return every.groupBy("bucket").cogroup(marks.groupBy("bucket")).applyInArrow(
        _cut(n), "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary")


def op7_suffix_dedup(spark, sf_dir):
    """Bytes of every document that repeat 50 bytes or more of a document with a smaller id."""
    return remove_repeats(documents(spark, sf_dir)).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
