"""Personal data and the terms that give it away.

Base spans are email, ip, card and phone patterns. The method adds an information-theoretic step: how strongly a
term reveals a protected entity (one concrete email, ip, card or phone) is its pointwise mutual information with it,
estimated from the whole corpus's lines:

    PMI(entity; term) = log(N * n(entity, term) / (n(entity) * n(term)))

with N the corpus's lines and n(.) the lines that hold the entity, the term, or both. A term whose PMI reaches
``alpha`` times the entity's own information -log(n(entity) / N), and which meets it in at least ``min_support``
different lines (copies of a line are one), discloses it. With ``by_document``, as in the registered queries, the same
is also counted over whole documents instead of lines (copies of a text are one), so that a name on another line than
the entity is judged too; a term that either count finds discloses. It is removed or generalised wherever it stands in
the documents that hold the entity; a document without the entity has nothing for it to disclose and keeps it. Terms
are words of at least three letters or digits, lower-cased, outside base spans.

Plan: one pass finds base spans and the entities of each line; a second counts the lines and documents of every term,
combined in each task before the shuffle. Only entities of ``min_support`` different lines (or texts) can be judged, so
only their lines' (or documents') terms are paired; pairs are counted in each task and sent whenever ``FLUSH_PAIRS`` are
held, so one long line with many entities and terms needs no more memory than many short ones. Pairs and counts are
joined by key, and the judged pairs with the term places of the documents that hold the entity. Only N is collected;
nothing is broadcast by hint and no group is gathered but a row's own spans.

Defined results: null texts count as empty; empty texts have no spans and the hash of the empty string; repeated rows
are judged each on its own and, as the same lines, add no evidence. Spans are code points, the end exclusive. Very long
texts and lines are read whole. Extra columns of any name come through ``sanitise`` as they are.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import pyarrow as pa
import xxhash

from pyspark.sql import DataFrame, functions as F

from skein.llm.textops import documents, fresh_names, store

KINDS = ("email", "ip", "card", "phone")
#: Share of an entity's own information that a term must carry to count as disclosing it.
ALPHA = 0.9
#: Distinct lines (or texts) in which entity and term must meet.
MIN_SUPPORT = 3
#: Pairs a task counts before it sends them.
FLUSH_PAIRS = 200_000

# Fixed by the task. Possessive forms match what the plain patterns match, without backtracking; an ip can only begin
# at the first digit of a run, since a later digit of the run meets the same continuation.
_EMAIL_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?+[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_TERM = re.compile(r"[^\W_]{3,}")


def luhn(digits: str) -> bool:
    total = 0
    for i, ch in enumerate(reversed(digits)):
        d = int(ch)
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def _emails(text: str):
    """Matches of local@domain, found from each ``@`` outwards: the local part is the run before it."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _EMAIL_DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind index, start, end) by kind, then start."""
    out = [(0, s, e) for s, e in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            out.append((1, *m.span()))
    for m in _CARD.finditer(text):
        d = _digits(m.group()) if m.end() - m.start() < 64 else ""
        if 16 <= len(d) <= 19 and luhn(d):
            out.append((2, *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= sum("0" <= c <= "9" for c in m.group()) <= 15:
                out.append((3, *m.span()))
    return out


def entity_key(kind: int, value: str) -> str:
    """What a span names: emails without case, numbers without their separators."""
    return f"{KINDS[kind]}:{value.lower() if kind == 0 else value if kind == 1 else _digits(value)}"


def _lines(text: str):
    at = 0
    for line in text.split("\n"):
        yield at, line
        at += len(line) + 1


def line_key(line: str) -> int:
    return int.from_bytes(hashlib.blake2b(line.encode(), digest_size=8).digest(), "little", signed=True)


def line_terms(line: str, spans) -> list[tuple[str, int, int]]:
    """(term, start, end) of the words of a line that touch none of ``spans`` (line offsets)."""
    spans = sorted(spans)
    out, i = [], 0
    for m in _TERM.finditer(line):
        while i < len(spans) and spans[i][1] <= m.start():
            i += 1
        if i == len(spans) or spans[i][0] >= m.end():
            out.append((m.group().lower(), m.start(), m.end()))
    return out


_FOUND = ("key string, doc_id bigint, n_lines bigint, text string, named array<struct<entity:string,line:bigint>>, "
          "base array<struct<kind:int,start:int,end:int>>")


def _entity_lines(text: str, spans):
    """(line, its spans as line offsets) for each line that holds an entity."""
    k, spans = 0, sorted(spans, key=lambda s: s[2])
    for at, line in _lines(text):
        inside = []
        while k < len(spans) and spans[k][2] <= at + len(line):
            inside.append(spans[k])
            k += 1
        if inside:
            yield line, [(kind, s - at, e - at) for kind, s, e in inside]


def _named(text: str, spans) -> list[dict]:
    """Each line's entities, with the line's hash; one entry for an entity and a line."""
    return [{"entity": entity, "line": key} for line, inside in _entity_lines(text, spans) for key in [line_key(line)]
            for entity in sorted({entity_key(kind, line[s:e]) for kind, s, e in inside})]


def _row_key(id_col: str, text_col: str):
    """Rows with the same id and the same text have the same spans; others are told apart."""
    return F.concat_ws(":", F.col(id_col).cast("string"), F.hex(F.xxhash64(text_col)), F.length(text_col))


def _find(batches):
    for batch in batches:
        for lo in range(0, batch.num_rows, 512):
            part = batch.slice(lo, 512)
            base, named, lines, texts = [], [], [], []
            for text in part.column(2).to_pylist():
                spans = base_spans(text or "")
                base.append([dict(zip(("kind", "start", "end"), s)) for s in spans])
                named.append(_named(text, spans) if spans else [])
                lines.append(text.count("\n") + 1 if text else 0)
                texts.append(text if spans else None)
            schema = pa.schema([
                ("key", pa.string()), ("doc_id", pa.int64()), ("n_lines", pa.int64()), ("text", pa.string()),
                ("named", pa.list_(pa.struct([("entity", pa.string()), ("line", pa.int64())]))),
                ("base", pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())])))])
            yield pa.RecordBatch.from_arrays([
                part.column(0), part.column(1), pa.array(lines, pa.int64()), pa.array(texts, pa.string()),
                pa.array(named, schema.field(4).type), pa.array(base, schema.field(5).type)], schema=schema)


def _term_hash(term: str) -> int:
    return xxhash.xxh64_intdigest(term) - (1 << 63)


def _count_terms(batches):
    """Lines and documents that hold each term, as partial counts by the term's hash."""
    counts: Counter = Counter()
    held: Counter = Counter()

    def flush():
        keys = pa.array([_term_hash(t) for t in counts], pa.int64())
        return pa.RecordBatch.from_arrays([keys, pa.array(counts.values(), pa.int64()), pa.array(
            [held[t] for t in counts], pa.int64())], names=["term_key", "lines", "docs"])

    for batch in batches:
        for text in batch.column(0).to_pylist():
            lines = [set(_TERM.findall(line)) for line in (text or "").lower().split("\n")]
            for terms in lines:
                counts.update(terms)
            held.update(lines[0].union(*lines[1:]))
            if len(counts) > 400_000:
                yield flush()
                counts.clear()
                held.clear()
    if counts:
        yield flush()


def _held_rows(batches):
    """(key, text, base, entities) of each row of ``key, text, base, held``, few at a time."""
    for batch in batches:
        for lo in range(0, batch.num_rows, 64):
            yield from zip(*(c.to_pylist() for c in batch.slice(lo, 64).columns))


def _text_terms(batches):
    """(key, text, terms with their places, entities) of each row of ``key, text, base, held``."""
    for key, text, base, held in _held_rows(batches):
        places: dict[str, list] = {}
        for term, s, e in line_terms(text, [(x["start"], x["end"]) for x in base]):
            places.setdefault(term, []).append({"start": s, "end": e})
        yield key, text, places, held


def _line_units(batches):
    """(line hash, its terms, its entities among the row's) of each line that holds one of the row's entities."""
    for _, text, base, held in _held_rows(batches):
        for line, inside in _entity_lines(text, [(x["kind"], x["start"], x["end"]) for x in base]):
            here = sorted({entity_key(kind, line[s:e]) for kind, s, e in inside}.intersection(held))
            if here:
                yield line_key(line), {t for t, _, _ in line_terms(line, [(s, e) for _, s, e in inside])}, here


def _document_units(batches):
    """(text hash, its terms, the row's entities) of each row."""
    for _, text, places, held in _text_terms(batches):
        yield line_key(text), places, held


def _meet(units, min_support):
    """Lines or documents that hold an entity and a term, as partial counts with up to ``min_support`` of the different
    ones. A task holds at most FLUSH_PAIRS pairs, also within one line."""
    def run(batches):
        met: dict[tuple[str, str], tuple[list, set]] = {}

        def flush():
            out = pa.RecordBatch.from_arrays([
                pa.array([e for e, _ in met], pa.string()), pa.array([t for _, t in met], pa.string()),
                pa.array([n[0] for n, _ in met.values()], pa.int64()),
                pa.array([list(x) for _, x in met.values()], pa.list_(pa.int64()))], names=["entity", "term", "n", "texts"])
            met.clear()
            return out

        for same, terms, entities in units(batches):
            for entity in entities:
                for term in terms:
                    n, texts = met.setdefault((entity, term), ([0], set()))
                    n[0] += 1
                    if len(texts) < min_support:
                        texts.add(same)
                if len(met) > FLUSH_PAIRS:
                    yield flush()
        if met:
            yield flush()

    return run


def _places(batches):
    """Every place of every term, with every entity of ``held``."""
    schema = pa.schema([("key", pa.string()), ("entity", pa.string()), ("term", pa.string()),
                        ("places", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))])
    rows = []

    def flush():
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

    for key, _, places, held in _text_terms(batches):
        for entity in held:
            for term, at in places.items():
                rows.append((key, entity, term, at))
                if len(rows) >= 10_000:
                    yield flush()
                    rows.clear()
    if rows:
        yield flush()


def find_spans(docs: DataFrame, alpha: float = ALPHA, min_support: int = MIN_SUPPORT, id_col="doc_id",
               text_col="text", by_document: bool = False) -> DataFrame:
    """``key, doc_id, base, terms`` for each row: base spans, and the places of disclosing terms."""
    src = docs.select(_row_key(id_col, text_col).alias("key"), F.col(id_col).cast("bigint").alias("doc_id"),
                      F.col(text_col).alias("text"))
    found = store(src.mapInArrow(_find, _FOUND), "pii-found")
    n_lines, n_docs = (float(x or 0) for x in found.agg(F.sum("n_lines"), F.count_if(F.col("n_lines") > 0)).first())

    held = found.where("size(base) > 0").select("key", "text", "base")
    lines = found.select("key", F.inline("named"))
    named = lines.groupBy("key", "entity").agg(F.count("*").alias("n"))

    def holders(entities: DataFrame) -> DataFrame:
        """Rows that hold some of the entities, and which."""
        return held.join(named.join(entities.select("entity"), "entity").groupBy("key").agg(
            F.collect_set("entity").alias("held")), "key")

    def pairs(units, entities: DataFrame, whole: bool) -> DataFrame:
        """Pairs that meet often enough, of entities that do; ``entities`` has n_e and different lines or texts."""
        often = entities.where(F.col("support") >= min_support).select("entity", "n_e")
        met = holders(often).mapInArrow(_meet(units, min_support),
                                        "entity string, term string, n bigint, texts array<bigint>")
        return met.groupBy("entity", "term").agg(F.sum("n").alias("n_et"), F.size(F.array_distinct(F.flatten(
            F.collect_list("texts")))).alias("support")).where(F.col("support") >= min_support).join(
                often, "entity").select("entity", "term", "n_et", "n_e", F.lit(whole).alias("whole"))

    pair = pairs(_line_units, lines.groupBy("entity").agg(
        F.count("*").alias("n_e"), F.countDistinct("line").alias("support")), False)
    if by_document:
        texts = found.select(F.xxhash64("text").alias("same"), F.explode(F.array_distinct("named.entity")).alias("entity"))
        pair = pair.union(pairs(_document_units, texts.groupBy("entity").agg(
            F.count("*").alias("n_e"), F.countDistinct("same").alias("support")), True))

    def add_key(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array([_term_hash(t) for t in b.column(1).to_pylist()], pa.int64())],
                names=["entity", "term", "n_et", "n_e", "whole", "term_key"])

    pair = pair.mapInArrow(
        add_key, "entity string, term string, n_et bigint, n_e bigint, whole boolean, term_key bigint")
    counted = src.select("text").mapInArrow(_count_terms, "term_key bigint, lines bigint, docs bigint").groupBy(
        "term_key").agg(F.sum("lines").alias("lines"), F.sum("docs").alias("docs"))
    n, n_t = F.when(F.col("whole"), n_docs).otherwise(n_lines), F.when(F.col("whole"), F.col("docs")).otherwise(F.col("lines"))
    told = store(pair.join(counted, "term_key")
                 .withColumn("pmi", F.log(n * F.col("n_et") / (F.col("n_e") * n_t)))
                 .where((F.col("pmi") > 0) & (F.col("pmi") >= alpha * F.log(n / F.col("n_e")))).select("entity", "term")
                 .distinct(), "pii-told")
    placed = holders(told.select("entity").distinct()).mapInArrow(
        _places, "key string, entity string, term string, places array<struct<start:int,end:int>>")
    terms = placed.join(told, ["entity", "term"]).groupBy("key").agg(
        F.sort_array(F.array_distinct(F.flatten(F.collect_list("places")))).alias("terms"))
    none = F.array().cast("array<struct<start:int,end:int>>")
    return found.select("key", "doc_id", "base").join(terms, "key", "left").select(
        "key", "doc_id", "base", F.coalesce("terms", none).alias("terms"))


def sanitise(docs: DataFrame, alpha: float = ALPHA, min_support: int = MIN_SUPPORT, id_col="doc_id",
             text_col="text", by_document: bool = False) -> DataFrame:
    """``docs`` with personal data replaced by its kind; disclosing terms become ``[NUMBER]`` if they are digits
    (generalised) and go otherwise. Rows and the other columns stay as they are."""
    names = docs.columns
    key, base_col, terms_col = fresh_names(docs, "key", "base", "terms")
    spans = find_spans(docs, alpha, min_support, id_col, text_col, by_document).where("size(base) > 0").groupBy("key").agg(
        F.first("base").alias(base_col), F.first("terms").alias(terms_col)).withColumnRenamed("key", key)
    schema = docs.schema
    at = names.index(text_col)

    def rewrite(batches):
        for batch in batches:
            texts = batch.column(at).to_pylist()
            base, terms = batch.column(len(names)).to_pylist(), batch.column(len(names) + 1).to_pylist()
            new = [_replace(t, b, w) if b else t for t, b, w in zip(texts, base, terms)]
            cols = [*batch.columns[:len(names)]]
            cols[at] = pa.array(new, pa.string())
            yield pa.RecordBatch.from_arrays(cols, names=names)

    joined = docs.withColumn(key, _row_key(id_col, text_col)).join(spans, key, "left")
    return joined.select(*[F.col(f"`{c}`") for c in names], base_col, terms_col).mapInArrow(rewrite, schema)


def _replace(text: str, base, terms) -> str:
    marks = [(s["start"], s["end"], f"[{KINDS[s['kind']].upper()}]") for s in base]
    marks += [(s["start"], s["end"], "[NUMBER]" if text[s["start"]:s["end"]].isdigit() else "") for s in terms]
    out, done = [], 0
    for s, e, mark in sorted(marks):
        if s >= done:
            out += [text[done:s], mark]
        done = max(done, e)
    return "".join(out) + text[done:]


def op6_pii(spark, sf_dir):
    """Base spans with their hash, and all spans with the disclosing terms, of every document."""
    found = find_spans(documents(spark, sf_dir), by_document=True)
    kinds = F.array(*[F.lit(k) for k in KINDS])
    written = F.transform("base", lambda s: F.concat_ws(":", kinds[s["kind"]], s["start"], s["end"]))
    more = F.transform("terms", lambda s: F.concat_ws(":", F.lit("term"), s["start"], s["end"]))

    def count(kind: int):
        return F.size(F.filter("base", lambda span: span["kind"] == F.lit(kind))).cast("bigint")

    counts = [count(kind).alias(f"n_{name}") for kind, name in enumerate(KINDS)]
    return found.select("doc_id", *counts, F.sha2(F.array_join(written, ",").cast("binary"), 256).alias("base_sha256"),
                        F.array_join(F.concat(written, more), ",").alias("spans"))
