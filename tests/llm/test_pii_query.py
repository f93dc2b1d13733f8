"""The whole query against the plain patterns, and texts that would once have filled a task's memory."""

import hashlib
import re
import resource

from skein.llm import pii, textops

from .test_operators import brute_spans

KINDS = ["email", "ip", "card", "phone"]


def test_query_equals_the_patterns_on_the_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    got = pii.op6_pii(spark, sf).collect()
    rows = {r.doc_id: r.text for r in textops.documents(spark, sf).select("doc_id", "text").collect()}
    assert len(got) == len(rows)
    for r in got:
        spans = sorted(brute_spans(rows[r.doc_id] or ""))
        text = ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in spans)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == x for k, _, _ in spans) for x in range(4)]
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert re.sub(r",?term:\d+:\d+", "", r.spans).lstrip(",") == text
    assert len({(r.n_email, r.n_ip, r.n_card, r.n_phone) for r in got}) > 2


def test_counts_by_kind(spark, tmp_path):
    texts = ["10.0.0.1", "a@b.co c@d.co e@f.co", "4111 1111 1111 1111", "+1 (555) 010-9999 and 10.0.0.2", None, ""]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: (r.n_email, r.n_ip, r.n_card, r.n_phone) for r in pii.op6_pii(spark, str(tmp_path)).collect()}
    assert got == {0: (0, 1, 0, 0), 1: (3, 0, 0, 0), 2: (0, 0, 1, 0), 3: (0, 1, 0, 1), 4: (0,) * 4, 5: (0,) * 4}


def test_a_long_line_of_entities_is_counted_in_bounded_pieces():
    line = " ".join(f"user{i}@mail{i}.example.org zork{i} {'blah ' * 50}" for i in range(1000))
    assert len(line) > 280_000
    spans = pii.base_spans(line)
    held = sorted({pii.entity_key(k, line[s:e]) for k, s, e in spans})
    import pyarrow as pa
    batch = pa.RecordBatch.from_pylist([{"key": "k", "text": line, "base": [
        {"kind": k, "start": s, "end": e} for k, s, e in spans], "held": held}])
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    pairs = 0
    for out in pii._meet(pii._line_units, 3)(iter([batch])):
        assert out.num_rows <= pii.FLUSH_PAIRS + 1100
        pairs += out.num_rows
    assert pairs == 1000 * 1001
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 400_000  # KB


def test_columns_of_any_name_come_through(spark):
    df = spark.createDataFrame([(1, "mail ann@example.org", "a", "b", "c")], "doc_id long, text string, key string, base string, _key string")
    r = pii.sanitise(df).collect()[0]
    assert r.asDict() == {"doc_id": 1, "text": "mail [EMAIL]", "key": "a", "base": "b", "_key": "c"}
