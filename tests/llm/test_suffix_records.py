"""op7: the records that tasks send each other stay few, whatever the number of buckets and of common passages."""

import numpy as np
import pyarrow as pa

from skein.llm import suffix_dedup as sd


def _documents(texts):
    """One packed record for each text, as a bucket gets them from many tasks."""
    out = []
    for i, t in enumerate(texts):
        raw = t.encode()
        out.append(sd._zip(b"".join(np.int64(v).tobytes() for v in (1, i, i + 1000, len(raw))) + raw))
    return pa.table({"bucket": pa.array([0] * len(out), pa.int64()), "kind": pa.array([sd._TEXTS] * len(out), pa.int32()),
                     "data": pa.array(out, pa.binary())})


def _texts(n, passage):
    rng = np.random.default_rng(5)
    return ["".join(chr(97 + c) for c in rng.integers(0, 26, 200)) + passage +
            "".join(chr(97 + c) for c in rng.integers(0, 26, 200)) for _ in range(n)]


def test_small_records_of_documents_are_read_together():
    texts = _texts(150, "")
    got = list(sd._grouped(_documents(texts)))
    assert len(got) == 1  # was one for each record
    ids, uids, data, off = got[0]
    assert ids.tolist() == list(range(150)) and (uids == ids + 1000).all()
    assert [data[a:b].tobytes().decode() for a, b in zip(off[:-1], off[1:])] == texts


def test_long_documents_are_read_apart(monkeypatch):
    monkeypatch.setattr(sd, "ROW_CHUNK_BYTES", 1000)
    texts = ["a" * n for n in (10, 2500, 400, 400, 400, 1000, 1)]
    got = list(sd._grouped(_documents(texts)))
    assert [ids.tolist() for ids, *_ in got] == [[0], [1], [2, 3], [4], [5], [6]]
    assert [d[a:b].tobytes().decode() for _, _, d, off in got for a, b in zip(off[:-1], off[1:])] == texts


def test_windows_of_common_grams_are_combined_and_sent_in_one_record():
    passage = "".join(chr(65 + c) for c in np.random.default_rng(6).integers(0, 26, 120))
    texts = _texts(40, passage)
    docs = _documents(texts)
    data, off = np.frombuffer("".join(texts).encode(), np.uint8), np.cumsum([0, *map(len, texts)])
    row, at, key, _, _ = sd.anchors(data, off)
    held = [k for k in np.unique(key) if len(set(row[key == k])) == 40]  # grams inside the passage
    assert held
    hit = np.isin(key, held)
    place = sd._places(key[hit], row[hit] + 1000)
    places = pa.table({"data": pa.array([place.tobytes()], pa.binary())})
    sent = sd._send_contexts(2, 2, np.array(held, np.uint64))(None, docs, places)
    kinds = sent.column("kind").to_numpy()
    assert (kinds == sd._WINDOWS).sum() <= 2  # a bucket gets one record; was one for each of up to 31 begins
    blobs = [d for d, k in zip(sent.column("data").to_pylist(), kinds) if k == sd._WINDOWS]
    windows = np.concatenate(list(sd._unpack_contexts(blobs, sd._WINDOWS)))
    # windows inside the passage are there once, by the smallest id; the others' are decided
    assert len(np.unique(windows["key"])) == len(windows)
    text = [w.tobytes().strip(b"\0").decode() for w in windows["bytes"]]
    assert {d for d, t in zip(windows["doc"], text) if t in passage} == {0}
    marks = np.frombuffer(b"".join(d for d, k in zip(sent.column("data").to_pylist(), kinds) if k == sd._MARKS), sd._MARK)
    assert 1000 not in marks["uid"] and len(set(marks["uid"])) == 39


def test_grams_with_many_contexts_equal_brute_force():
    """More than ``PAIRS`` different contexts of a gram, few of which share a window."""
    rng = np.random.default_rng(7)
    gram = rng.integers(65, 91, sd.GRAM).astype(np.uint8)
    rec = np.zeros(200, sd._CONTEXT)
    sides = rng.integers(97, 123, (12, sd.WIDE)).astype(np.uint8)
    for i in range(len(rec)):
        left, right = (sides[j] if j < 12 else rng.integers(97, 123, sd.WIDE).astype(np.uint8) for j in rng.integers(0, 15, 2))
        rec["lo"][i] = rng.integers(0, 10)
        rec["hi"][i] = rng.integers(rec["lo"][i] + sd.LENGTH, sd.WIDE + 1)
        body = np.concatenate([left[:sd.SPAN], gram, right[:sd.SPAN]])
        rec["bytes"][i] = np.where((np.arange(sd.WIDE) >= rec["lo"][i]) & (np.arange(sd.WIDE) < rec["hi"][i]), body, 0)
        rec["doc"][i], rec["uid"][i], rec["pos"][i], rec["key"][i] = i % 150, i, i, 9
    want, least = {}, {}
    windows = [(i, o, (o, rec["bytes"][i, o:o + sd.LENGTH].tobytes())) for i in range(len(rec))
               for o in range(rec["lo"][i], int(rec["hi"][i]) - sd.LENGTH + 1)]
    for i, _, w in windows:
        least[w] = min(least.get(w, 1 << 60), rec["doc"][i])
    for i, o, w in windows:
        if rec["doc"][i] > least[w]:
            want[i] = want.get(i, 0) | 1 << o
    got = {int(m["uid"]): int(m["mask"]) for m in sd.repeated_windows(rec)}
    assert got == want and want
