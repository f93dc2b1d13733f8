"""Repeated passages of words: seed and extend.

A window is 20 consecutive words of a document; a window repeats if its words also start earlier (a smaller id, or the
same id and an earlier start). Words that repeating windows cover are removed.

1. Seeds. Of every window's sixteen five-word grams the one with the smallest hash (the leftmost of equal ones) is its
   anchor, so equal windows have an equal anchor at an equal place, and neighbouring windows mostly share one (winnowing).
   Anchors meet by their gram; back come those that occur more than once.
2. Extension. A shared anchor is extended to both sides as far as the windows of which it is the anchor reach, at most 15
   words each way. Two occurrences of a gram agree on the window ``o`` words before the anchor exactly if they agree on o
   words to the left and 15 - o to the right of the gram; that agreement is read from hashes of word spans, for all
   occurrences of a gram at once instead of pair by pair. Of the occurrences that agree the earliest stays; the others
   repeat it.
3. Maximal repeats. Windows that repeat return to their documents, where neighbouring and overlapping ones join to maximal
   passages of at least 20 words, which are cut.

No window's decision needs two texts at one place, and no pairs are listed. Hot passages: a task first compares what it
holds itself. Of a gram that several of its documents hold it sends one note (known: it is shared), and of equal windows
the earliest; the others are decided at once. So a passage in a third of all documents costs a record for each piece of
``FLUSH_WORDS`` words, not for each document. Records are packed arrays by bucket; buckets grow in number with the input.

Identity: windows are equal if their 64-bit hashes are and their grams, hashed independently, fall into the same bucket; a
window's mark carries 32 bits of its hash back, which also tells rows of one id with different texts apart.

Defined results: null and empty texts have no words; texts under 20 words keep all; rows of one id are one document to
each other (only an earlier start counts, so repeated rows are treated alike); rows without an id count as one document
behind all others; texts of any length are read whole, a text being the largest unit in memory; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from pyspark.sql import DataFrame, functions as F

from skein.llm.textops import SPACE, chunks, documents, mix, powers, word_ids, words

WINDOW = 20
GRAM = 5
SPAN = WINDOW - GRAM
#: Bytes of text in a bucket of documents, about.
BUCKET_BYTES = 8_000_000
#: Words of documents that a task compares before it sends.
FLUSH_WORDS = 3_000_000
NO_ID = np.int64(2**63 - 1)

_SEED = np.dtype([("key", "<u8"), ("doc", "<i8"), ("pos", "<u4")])
_PLACE = np.dtype([("doc", "<i8"), ("pos", "<u4")])
_HIT = np.dtype([("key", "<u8"), ("doc", "<i8"), ("pos", "<u4")])
_MARK = np.dtype([("doc", "<i8"), ("pos", "<u4"), ("check", "<u4")])
_SEEDS, _KNOWN, _PLACES, _HITS, _MARKS = range(5)
_ROWS = "bucket bigint, kind int, data binary"


def winnow(hashes: np.ndarray, bounds: np.ndarray):
    """(first word, anchor's first word, anchor's gram hash) of every window of every row."""
    n = len(hashes) - WINDOW + 1
    none = np.zeros(0, np.int64)
    if n < 1:
        return none, none, np.zeros(0, np.uint64)
    grams = np.zeros(len(hashes) - GRAM + 1, np.uint64)
    for j in range(GRAM):
        grams = grams * np.uint64(0xD6E8FEB86659FD93) + hashes[j:j + len(grams)]
    grams = mix(grams, GRAM)
    # leftmost smallest of 2, 4, 8 and 16 consecutive grams
    least, at, have = grams, np.arange(len(grams), dtype=np.int32), 1
    while have < SPAN + 1:
        further = least[have:] < least[:-have]
        at = np.where(further, at[have:], at[:-have])
        least = np.where(further, least[have:], least[:-have])
        have *= 2
    row_end = np.repeat(bounds[1:], np.diff(bounds))[:n]
    first = np.flatnonzero(np.arange(n) + WINDOW <= row_end)
    return first, at[first].astype(np.int64), least[first]


assert (SPAN + 1) & SPAN == 0, "the halving search needs a power of two"


def window_hashes(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Hashes of the windows that begin at ``first``, from word hashes of another salt than the grams'."""
    p, q = powers(len(hashes) + 1)
    c = np.empty(len(hashes) + 1, np.uint64)
    c[0] = 0
    np.cumsum(mix(hashes, 77) * p[:len(hashes)], out=c[1:])
    return mix((c[first + WINDOW] - c[first]) * q[first], 78)


def _bucket(key: np.ndarray, n: int) -> np.ndarray:
    return (mix(key, 6) % np.uint64(n)).astype(np.int64)


def _home(doc: np.ndarray, n: int) -> np.ndarray:
    return (mix(doc.view(np.uint64), 7) % np.uint64(n)).astype(np.int64)


def _records(dtype, **fields) -> np.ndarray:
    out = np.empty(len(next(iter(fields.values()))), dtype)
    for name, values in fields.items():
        out[name] = values
    return out


def _parts(records: np.ndarray, bucket: np.ndarray, kind: int, first: int = 0):
    """(bucket, kind, bytes) of records by bucket."""
    order = np.argsort(bucket, kind="stable")
    records, bucket = records[order], bucket[order]
    cut = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])[:len(bucket)])
    return [(int(bucket[a]) + first, kind, records[a:b].tobytes()) for a, b in zip(cut, np.append(cut[1:], len(records)))]


def _rows(parts) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([p[0] for p in parts], pa.int64()), pa.array([p[1] for p in parts], pa.int32()),
                                       pa.array([p[2] for p in parts], pa.binary())], names=["bucket", "kind", "data"])


def _repeated(key: np.ndarray):
    """Whether each key occurs more than once."""
    order = np.argsort(key, kind="stable")
    k = key[order]
    same = k[1:] == k[:-1]
    out = np.zeros(len(key), bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out


def _send_seeds(n):
    """Anchors by bucket of their gram. Grams that occur more than once in the piece are known to be shared: their places
    go straight on to their documents' buckets (n higher), and one note goes to the gram's."""
    def run(batches):
        held, size = [], 0

        def flush():
            key, doc, pos = (np.concatenate(c) for c in zip(*held))
            many = _repeated(key)
            known = np.unique(key[many])
            place = _records(_PLACE, doc=doc[many], pos=pos[many])
            seed = _records(_SEED, key=key[~many], doc=doc[~many], pos=pos[~many])
            return _rows(_parts(seed, _bucket(seed["key"], n), _SEEDS) + _parts(known, _bucket(known, n), _KNOWN)
                         + _parts(place, _home(doc[many], n), _PLACES, n))

        for batch in batches:
            ids = batch.column(0).to_numpy()
            for lo, hi, data, off in chunks(batch.column(1)):
                hashes, _, _, bounds = words(data, off, SPACE, lower=False)
                _, anchor, gram = winnow(hashes, bounds)
                one = np.append(True, anchor[1:] != anchor[:-1])[:len(anchor)]
                anchor, gram = anchor[one], gram[one]
                row = np.searchsorted(bounds, anchor, "right") - 1
                held.append((gram, ids[lo:hi][row], (anchor - bounds[row]).astype(np.uint32)))
                size += len(hashes)
                if size >= FLUSH_WORDS:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    return run


def _by_kind(table: pa.Table, kind: int, dtype) -> np.ndarray:
    data = [d for k, d in zip(table.column("kind").to_pylist(), table.column("data").to_pylist()) if k == kind]
    return np.frombuffer(b"".join(data), dtype)


def _join_seeds(n):
    """Places of the grams of one bucket that occur more than once."""
    def run(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        if bucket >= n:
            return pa.Table.from_batches([_rows([(bucket - n, _PLACES, d) for d in table.column("data").to_pylist()])])
        seed = _by_kind(table, _SEEDS, _SEED)
        hit = seed[_repeated(seed["key"]) | np.isin(seed["key"], _by_kind(table, _KNOWN, "<u8"))]
        place = _records(_PLACE, doc=hit["doc"], pos=hit["pos"])
        return pa.Table.from_batches([_rows(_parts(place, _home(place["doc"], n), _PLACES))])

    return run


def _doc_ids(table: pa.Table) -> np.ndarray:
    return table.column("doc").to_numpy().astype(np.int64)


def _earliest(key: np.ndarray, doc: np.ndarray, pos: np.ndarray):
    """For records of equal windows: (which one to send for each key, whether each is later than another of its key)."""
    order = np.lexsort((pos, doc, key))
    k, d, p = key[order], doc[order], pos[order]
    new = np.append(True, k[1:] != k[:-1])[:len(k)]
    head = np.maximum.accumulate(np.where(new, np.arange(len(k)), 0))
    later = np.zeros(len(k), bool)
    later[order] = (d != d[head]) | (p != p[head])
    return order[new], later


def _extend(n):
    """Windows of the shared anchors of one bucket of documents, by bucket of the gram; those that are later than an equal
    one of the piece are marked at once."""
    def run(key_, docs: pa.Table, places: pa.Table) -> pa.Table:
        if not len(places) or not len(docs):
            return pa.Table.from_batches([_rows([])])
        place = np.unique(_by_kind(places, _PLACES, _PLACE))
        ids, out, held, size = _doc_ids(docs), [], [], 0

        def flush():
            gram, key, doc, pos = (np.concatenate(c) for c in zip(*held))
            some, later = _earliest(key, doc, pos)
            # the first of a key may stand for rows of one place in several rows of one id
            hit = _records(_HIT, key=key[some], doc=doc[some], pos=pos[some])
            out.extend(_parts(hit, _bucket(gram[some], n), _HITS))
            mark = _records(_MARK, doc=doc[later], pos=pos[later], check=(key[later] >> np.uint64(32)).astype(np.uint32))
            out.extend(_parts(mark, _home(mark["doc"], n), _MARKS, n))

        for lo, hi, data, off in chunks(docs.column("text").combine_chunks()):
            hashes, _, _, bounds = words(data, off, SPACE, lower=False)
            first, anchor, gram = winnow(hashes, bounds)
            row = np.searchsorted(bounds, first, "right") - 1
            here = _records(_PLACE, doc=ids[lo:hi][row], pos=(anchor - bounds[row]).astype(np.uint32))
            shared = _member(here, place)
            first, row, gram = first[shared], row[shared], gram[shared]
            if len(first):
                held.append((gram, window_hashes(hashes, first), ids[lo:hi][row], (first - bounds[row]).astype(np.uint32)))
                size += len(first)
                if size >= FLUSH_WORDS:
                    flush()
                    held, size = [], 0
        if held:
            flush()
        return pa.Table.from_batches([_rows(out)])

    return run


def _member(records: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Whether each (doc, pos) is among ``known``, which are sorted and distinct."""
    lo = np.searchsorted(known["doc"], records["doc"], "left")
    docs, at = np.unique(records["doc"], return_inverse=True)
    number = np.full(len(known), -1, np.int64)
    where = np.searchsorted(docs, known["doc"])
    ok = where < len(docs)
    ok[ok] = docs[where[ok]] == known["doc"][ok]
    number[ok] = where[ok]
    known_key = (number[ok].astype(np.uint64) << np.uint64(32)) | known["pos"][ok]
    key = (at.astype(np.uint64) << np.uint64(32)) | records["pos"]
    if not len(known_key):
        return np.zeros(len(records), bool)
    i = np.minimum(np.searchsorted(known_key, key), len(known_key) - 1)
    return known_key[i] == key


def _decide(n):
    """Of one bucket's equal windows all but the earliest are marked."""
    def run(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        if bucket >= n:
            return pa.Table.from_batches([_rows([(bucket - n, _MARKS, d) for d in table.column("data").to_pylist()])])
        hit = _by_kind(table, _HITS, _HIT)
        _, later = _earliest(hit["key"], hit["doc"], hit["pos"])
        hit = hit[later]
        mark = _records(_MARK, doc=hit["doc"], pos=hit["pos"], check=(hit["key"] >> np.uint64(32)).astype(np.uint32))
        return pa.Table.from_batches([_rows(_parts(mark, _home(mark["doc"], n), _MARKS))])

    return run


_KEPT = "doc_id bigint, n_words bigint, n_removed bigint, n_spans bigint, kept string"


def _cut(key_, docs: pa.Table, marks: pa.Table) -> pa.Table:
    """The documents of one bucket without their maximal repeats."""
    mark = np.unique(_by_kind(marks, _MARKS, _MARK)) if len(marks) else np.zeros(0, _MARK)
    out = []
    if not len(docs):
        return pa.Table.from_batches([], pa.schema(_KEPT_SCHEMA))
    ids = _doc_ids(docs)
    for lo, hi, data, off in chunks(docs.column("text").combine_chunks()):
        number, names, bounds = word_ids(data, off, ~SPACE[data])
        doc = ids[lo:hi]
        # every mark with every row of its id
        a, b = np.searchsorted(mark["doc"], doc, "left"), np.searchsorted(mark["doc"], doc, "right")
        row = np.repeat(np.arange(hi - lo), b - a)
        at = np.arange(len(row)) - np.repeat(np.cumsum(b - a) - (b - a), b - a) + np.repeat(a, b - a)
        start = bounds[row] + mark["pos"][at].astype(np.int64)
        ok = start + WINDOW <= bounds[row + 1]
        row, at, start = row[ok], at[ok], start[ok]
        if len(start):
            hashes, *_ = words(data, off, SPACE, lower=False)
            true = (window_hashes(hashes, start) >> np.uint64(32)).astype(np.uint32) == mark["check"][at]
            start = start[true]
        cover = np.zeros(len(number) + 1, np.int64)
        np.add.at(cover, start, 1)
        np.add.at(cover, start + WINDOW, -1)
        gone = np.cumsum(cover)[:-1] > 0
        begins = gone.copy()
        begins[1:] &= ~gone[:-1]
        begins[bounds[:-1][bounds[:-1] < len(gone)]] |= gone[bounds[:-1][bounds[:-1] < len(gone)]]
        left = np.concatenate([[0], np.cumsum(~gone)])[bounds]
        spans = np.concatenate([[0], np.cumsum(begins)])[bounds]
        kept = pa.ListArray.from_arrays(pa.array(left.astype(np.int32)), names.take(pa.array(number[~gone])))
        n_words = np.diff(bounds)
        out.append(pa.RecordBatch.from_arrays([
            pa.array(doc, mask=doc == NO_ID), pa.array(n_words, pa.int64()), pa.array(n_words - np.diff(left), pa.int64()),
            pa.array(np.diff(spans), pa.int64()), pc.binary_join(kept, b" ").cast(pa.string())],
            schema=pa.schema(_KEPT_SCHEMA)))
    return pa.Table.from_batches(out, pa.schema(_KEPT_SCHEMA))


_KEPT_SCHEMA = [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
                ("kept", pa.string())]


def cut_repeats(docs: DataFrame, id_col="doc_id", text_col="text") -> DataFrame:
    """``doc_id, n_words, n_removed, n_spans, kept`` for each row: its words, those that maximal repeats cover, how many
    stretches of them there are, and the other words joined by one space."""
    spark = docs.sparkSession
    src = docs.select(F.coalesce(F.col(id_col).cast("bigint"), F.lit(int(NO_ID))).alias("doc"),
                      F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    size = src.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(size) // BUCKET_BYTES + 1)

    def homes(batches):
        for batch in batches:
            home = _home(batch.column(0).to_numpy(), n)
            yield pa.RecordBatch.from_arrays([pa.array(home), *batch.columns], names=["bucket", "doc", "text"])

    # both cogroups read this one exchange of the texts
    texts = src.mapInArrow(homes, "bucket bigint, doc bigint, text string").groupBy("bucket")
    places = src.mapInArrow(_send_seeds(n), _ROWS).groupBy("bucket").applyInArrow(_join_seeds(n), _ROWS)
    windows = texts.cogroup(places.groupBy("bucket")).applyInArrow(_extend(n), _ROWS)
    marks = windows.groupBy("bucket").applyInArrow(_decide(n), _ROWS)
    return texts.cogroup(marks.groupBy("bucket")).applyInArrow(_cut, _KEPT)


def op13_seed_extend(spark, sf_dir):
    """Words of every document without those of windows that also start earlier."""
    return cut_repeats(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"), "n_spans")


OP13_SQL = """
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(ws[i:i + 19], ' ') AS win
  FROM (SELECT doc_id, ws, unnest(generate_series(1, len(ws) - 19)) AS i FROM w WHERE len(ws) >= 20)),
later AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY win ORDER BY doc_id, i) AS r FROM windows)
  WHERE r > 1),
word AS (SELECT doc_id, i, ws[i] AS word FROM (SELECT doc_id, ws, unnest(generate_series(1, len(ws))) AS i FROM w)),
judged AS (
  SELECT word.doc_id, word.i, word.word,
         max(later.i) OVER (PARTITION BY word.doc_id ORDER BY word.i ROWS UNBOUNDED PRECEDING) AS last
  FROM word LEFT JOIN later ON later.doc_id = word.doc_id AND later.i = word.i),
marked AS (
  SELECT doc_id, i, word, coalesce(i < last + 20, false) AS gone FROM judged),
runs AS (
  SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY i), false) AS begins FROM marked),
per AS (
  SELECT doc_id, count(*) AS n, count(*) FILTER (gone) AS removed, count(*) FILTER (begins) AS spans,
         coalesce(string_agg(word, ' ' ORDER BY i) FILTER (NOT gone), '') AS kept
  FROM runs GROUP BY doc_id)
SELECT w.doc_id, coalesce(per.n, 0)::BIGINT AS n_words, coalesce(per.removed, 0)::BIGINT AS n_removed,
       sha256(coalesce(per.kept, '')) AS kept_sha256, coalesce(per.spans, 0)::BIGINT AS n_spans
FROM w LEFT JOIN per ON per.doc_id = w.doc_id
"""
