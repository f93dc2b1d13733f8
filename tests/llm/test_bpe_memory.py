import hashlib

import numpy as np
import public_tokenizers
import pyarrow as pa

from skein.llm import bpe

PATH, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


class Docs:
    """Stands for a table: keeps the function that each task runs."""

    def selectExpr(self, *columns):
        return self

    def mapInArrow(self, run, schema):
        self.run = run
        return self


def batch(texts):
    return pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts, pa.string())], names=["doc_id", "text"])


def test_a_worker_holds_nothing_of_the_texts_after_a_task(monkeypatch):
    monkeypatch.setattr(bpe, "PART_BYTES", 40)
    texts = ["Unwordlike wordlings, qzxv!", None, "", "x" * 300, "Größenwahn naïveté 東京都 " * 5, "Unwordlike wordlings, qzxv!"]
    fresh = bpe.PrefixEncoder(bpe.read_ranks(PATH), PATTERN)
    packed = [fresh.packed(t or "") for t in texts]
    assert fresh.recent and fresh.stable
    enc = bpe._encoder(PATH, PATTERN)
    for _ in range(2):
        run = bpe.encode_digest(Docs(), PATH, PATTERN).run
        rows = [r for b in run([batch(texts), batch([])]) for r in b.to_pylist()]
        assert [r["ids_sha256"] for r in rows] == [hashlib.sha256(p).hexdigest() for p in packed]
        assert [r["decoded_sha256"] for r in rows] == [hashlib.sha256((t or "").encode()).hexdigest() for t in texts]
        assert not (enc.recent or enc.older or enc.stable or enc.edges)
        ids = [r["ids"] for b in bpe.encode_documents(Docs(), PATH, PATTERN).run([batch(texts)]) for r in b.to_pylist()]
        assert ids == [np.frombuffer(p, "<u4").tolist() for p in packed]
        assert not (enc.recent or enc.older or enc.stable or enc.edges)


def test_a_task_that_is_ended_early_holds_nothing_either():
    rows = bpe.encode_digest(Docs(), PATH, PATTERN).run(iter([batch(["Unwordlike qzxv"]), batch(["more"])]))
    next(rows)
    assert bpe._encoder(PATH, PATTERN).recent
    rows.close()
    assert not bpe._encoder(PATH, PATTERN).recent
