"""Spelling variants: words one edit apart, found by walking a relational trie level by level.

The trie of all words is a table of edges (node, label, child), nodes being prefixes where words part or end; chains
between them are one edge with a longer label. A frontier of states (word, position, node, edits) begins with every word
at the root. One level is a join of the frontier with the edges of its nodes: a label equal to the word's next code points
moves on with the same edits; a state without an edit may also take a label that is one edit away from the word's next
code points (one replaced, or one of the word's deleted). States that reach a word's end at a node where another word ends,
with one edit, are neighbours. Of a pair only one direction is walked (the longer word to the shorter, or to the larger in
code-point order), the other is its mirror image. States die where no label fits, where the words below a node have too
many or too few code points left, or where none goes on with the word's next one, so the frontier shrinks quickly; it is
written at every level, which ends its lineage.

Joins are on the node, for states with an edit also on the label's first code point. The few nodes near the root, which
all words share, are salted: their edges (one for a letter at most) are repeated and the states spread over the copies.

A word's form is its neighbour of the largest count (ties: the smallest in code-point order) if that count is at least
``ratio`` times its own; its root is the end of the chain of forms, found by doubling the chains' steps.

Words are maximal runs of ASCII and Latin-1 letters (``[A-Za-z\\u00C0-\\u00FF]+``), A-Z lower-cased. Node identities are
64-bit hashes of prefixes; found pairs are checked with the words themselves.

Defined results: null and empty texts have no words; words of any length are walked whole; repeated rows count each; extra
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from pyspark.sql import DataFrame, Window, functions as F

from skein.llm.textops import LOWER_ASCII, chunks, documents, mix, powers, stored_steps, word_ids

MIN_CHARS = 6
MIN_COUNT = 5
RATIO = 5
#: Copies of the rows of the root and of the nodes one and two code points below it, which many words share.
SALTS = (64, 16, 4)

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_LEAD = 0xC3  # the first byte of U+00C0 to U+00FF


def _letters(data: np.ndarray) -> np.ndarray:
    lead = data == _LEAD
    inside = _LETTER[data] | lead
    inside[1:] |= lead[:-1]
    return inside


def _dropped_letters(ids, rows, names: list[bytes], prefixes: list[bytes | None], modulus: int):
    """Pairs (row, word) whose crc32 with the row's prefix is a multiple of ``modulus``: (row, word number, new word)."""
    base = [None if p is None else zlib.crc32(p) for p in prefixes]
    for r, w in zip(rows.tolist(), ids.tolist()):
        if base[r] is not None:
            h = zlib.crc32(names[w], base[r])
            if h % modulus == 0:
                word = names[w].decode()
                k = h % len(word)
                yield r, w, word[:k] + word[k + 1:]


def word_counts(docs: DataFrame, min_chars: int = MIN_CHARS, drop_modulus: int | None = None, id_col="doc_id",
                text_col="text") -> DataFrame:
    """``word, n`` of all words of at least ``min_chars`` code points. With ``drop_modulus`` every word whose crc32 of
    ``<id>:<word>`` is a multiple of it loses the code point at that number modulo its length (rows without an id lose
    none). Counted by pieces of text before the shuffle."""
    def run(batches):
        for batch in batches:
            for lo, hi, data, off in chunks(batch.column(1)):
                low = LOWER_ASCII[data]
                ids, names, bounds = word_ids(low, off, _letters(low))
                if not len(ids):
                    continue
                n = np.bincount(ids, minlength=len(names))
                words, counts = names.cast(pa.string()), [n]
                if drop_modulus:
                    row = np.repeat(np.arange(hi - lo), np.diff(bounds))
                    pair, many = np.unique(row * len(names) + ids, return_counts=True)
                    prefixes = [None if d is None else b"%d:" % d for d in batch.column(0).slice(lo, hi - lo).to_pylist()]
                    changed = list(_dropped_letters(pair % len(names), pair // len(names), names.to_pylist(), prefixes,
                                                    drop_modulus))
                    lost = many[np.searchsorted(pair, [r * len(names) + w for r, w, _ in changed])]
                    np.subtract.at(n, [w for _, w, _ in changed], lost)
                    words = pa.concat_arrays([words, pa.array([t for _, _, t in changed], pa.string())])
                    counts.append(lost.astype(np.int64))
                n = np.concatenate(counts)
                keep = pa.array((n > 0) & (pc.utf8_length(words).to_numpy() >= min_chars))
                yield pa.RecordBatch.from_arrays([words.filter(keep), pa.array(n).filter(keep)], names=["word", "n"])

    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


ROOT = 0


def _prefixes(batches):
    """(word id, depth, node, next code point or -1 at the end, code points left) of every prefix of every word."""
    for batch in batches:
        for lo in range(0, batch.num_rows, 1024):
            part = batch.slice(lo, 1024)
            wid, depth, node, following = [], [], [], []
            for key, word in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                points = np.frombuffer(word.encode("utf-32-le"), "<u4").astype(np.uint64)
                c = np.cumsum(mix(points + np.uint64(1)) * powers(len(points))[0])
                wid.append(np.full(len(points) + 1, key, np.int64))
                depth.append(np.arange(len(points) + 1, dtype=np.int32))
                node.append(np.append(np.uint64(ROOT), mix(c ^ mix(depth[-1][1:].astype(np.uint64)))).view(np.int64))
                following.append(np.append(points, np.uint64(0)).astype(np.int32))
                following[-1][-1] = -1
            left = [d[::-1] for d in depth]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(c)) for c in (wid, depth, node, following, left)],
                names=["wid", "depth", "node", "following", "left"])


def _salts(depth="depth"):
    out = F.lit(1)
    for d, n in enumerate(SALTS):
        out = F.when(F.col(depth) == d, F.lit(n)).otherwise(out)
    return out


def _salt(depth="depth"):
    """Which copy a word's row meets."""
    return F.pmod(F.col("wid"), _salts(depth)).cast("int")


def _copies(df: DataFrame, depth="depth") -> DataFrame:
    return df.withColumn("salt", F.explode(F.sequence(F.lit(0), _salts(depth) - 1)))


def trie_edges(words: DataFrame, keep) -> DataFrame:
    """The compressed trie of ``wid, word`` as ``node, depth, label, child, child_depth`` (depths in code points), and of
    each child: ``end_wid`` (the word that ends there, or null), ``least`` and ``most`` code points that its words have
    left, and ``nexts``, the code points that go on from it."""
    prefixes = keep(words.select("wid", "word").mapInArrow(
        _prefixes, "wid bigint, depth int, node bigint, following int, left int"), "trie-prefixes")
    kept = prefixes.groupBy("node").agg(
        F.min("following").alias("lo"), F.max("following").alias("hi"), F.min("depth").alias("d"),
        F.min("left").alias("least"), F.max("left").alias("most")).where("lo = -1 or lo < hi or d = 0")
    path = Window.partitionBy("wid").orderBy("depth")
    met = prefixes.drop("left").withColumn("salt", _salt()).join(
        _copies(kept, "d").select("node", "salt", "least", "most"), ["node", "salt"])
    steps = met.select(
        "wid", F.lag("node").over(path).alias("node"), F.lag("depth").over(path).alias("depth"),
        F.col("node").alias("child"), F.col("depth").alias("child_depth"), "following", "least", "most")
    # all words below a child name the same edge
    edges = steps.where("node is not null").groupBy("child").agg(
        *[F.min(c).alias(c) for c in ("node", "depth", "child_depth", "least", "most", "wid")],
        F.min(F.when(F.col("following") == -1, F.col("wid"))).alias("end_wid"))
    edges = keep(edges.join(words.select("wid", "word"), "wid").select(
        "node", "depth", F.substring("word", F.col("depth") + 1, F.col("child_depth") - F.col("depth")).alias("label"),
        "child", "child_depth", "end_wid", "least", "most"), "trie-nodes")
    nexts = edges.groupBy(F.col("node").alias("child")).agg(
        F.array_join(F.collect_set(F.substring("label", 1, 1)), "").alias("nexts"))
    return edges.join(nexts, "child", "left").fillna("", "nexts")


def one_edit_pairs(words: DataFrame, keep) -> DataFrame:
    """``wid, near_wid``, both directions, of all words of ``wid, word`` that one inserted, deleted or replaced code point
    turns into each other. ``keep(df, label)`` writes a step and reads it back. A state's position is told by ``rest``, the
    word's code points from there on."""
    edges = keep(_copies(trie_edges(words, keep)), "trie-edges")
    by_node = edges.hint("shuffle_hash")
    by_first = edges.withColumn("first", F.substring("label", 1, 1)).hint("shuffle_hash")
    frontier = words.select("wid", F.col("word").alias("rest"), F.lit(ROOT).cast("bigint").alias("node"),
                            F.lit(0).alias("depth"), F.lit(0).alias("edits"), F.lit(None).cast("bigint").alias("end_wid"))
    pairs = None
    label, rest, size = F.col("label"), F.col("rest"), F.length("label")
    here, longer, left = F.substring("rest", F.lit(1), size), F.substring("rest", F.lit(1), size + 1), F.length("rest") - size
    fits = F.startswith(rest, label)

    def arrives(n, step):
        """The child's words go on as the state with n code points left does, as far as its node tells."""
        return (n >= F.col("least")) & (n <= F.col("most")) & F.contains(F.col("nexts"), F.substring("rest", size + step, F.lit(1)))

    def state(step, edits):
        return F.struct(F.substring("rest", size + step, F.length("rest")).alias("rest"), F.lit(edits).alias("edits"))

    moves = F.array(
        F.when(fits & (left > 0) & (left >= F.col("least")) & (left - 1 <= F.col("most")), state(1, 0)),
        F.when((label > here) & (left >= 0) & arrives(left, 1) & ((size == 1) | (F.levenshtein(label, here, 1) == 1)),
               state(1, 1)),
        # a deletion behind a label that fits belongs to the next label, unless the word ends there
        F.when((left >= 1) & arrives(left - 1, 2) & (~fits | ((left == 1) & F.col("end_wid").isNotNull()))
               & (F.levenshtein(label, longer, 1) == 1), state(2, 1)))
    while True:
        salted = frontier.withColumn("salt", _salt()).drop("end_wid", "depth")
        clean = salted.where("edits = 0").drop("edits").join(by_node, ["node", "salt"]).select(
            "wid", F.explode(moves).alias("to"), "child", "child_depth", "end_wid").where("to is not null").select(
                "wid", "to.rest", "to.edits", "child", "child_depth", "end_wid")
        edited = salted.where("edits = 1").withColumn("first", F.substring("rest", 1, 1)).join(
            by_first, ["node", "salt", "first"]).where(fits & arrives(left, 1)).select(
                "wid", F.substring("rest", size + 1, F.length("rest")).alias("rest"), F.lit(1).alias("edits"), "child",
                "child_depth", "end_wid")
        frontier = keep(clean.union(edited).select(
            "wid", "rest", F.col("child").alias("node"), F.col("child_depth").alias("depth"), "edits", "end_wid"),
            "trie-frontier")
        if frontier.isEmpty():
            break
        met = frontier.where("edits = 1 and rest = ''").select("wid", F.col("end_wid").alias("near_wid"))
        pairs = met if pairs is None else pairs.union(met)
        frontier = frontier.where("rest <> ''")
    if pairs is None:
        return words.select("wid", F.col("wid").alias("near_wid")).limit(0)
    # the levels are read once for both directions
    both = F.array(F.struct("wid", "near_wid"), F.struct(F.col("near_wid").alias("wid"), F.col("wid").alias("near_wid")))
    return pairs.select(F.inline(both)).distinct()


def _roots(forms: DataFrame, keep) -> DataFrame:
    """``wid, root``: the end of each chain of ``wid, form_wid``; every round doubles the steps followed."""
    now = keep(forms.select("wid", F.col("form_wid").alias("root")), "trie-roots")
    while True:
        next_ = now.select(F.col("wid").alias("root"), F.col("root").alias("further"))
        now = keep(now.join(next_, "root", "left").select("wid", F.coalesce("further", "root").alias("root"),
                                                          F.col("further").isNotNull().alias("moved")), "trie-roots")
        if now.where("moved").isEmpty():
            return now.select("wid", "root")
        now = now.select("wid", "root")


def variant_groups(counts: DataFrame, ratio: int = RATIO) -> DataFrame:
    """``word, n, n_near, form, form_n, root`` of each row of ``word, n`` (distinct words)."""
    with stored_steps(counts.sparkSession) as keep:
        words = keep(counts.select(F.xxhash64("word").alias("wid"), "word", "n"), "trie-words")
        pairs = one_edit_pairs(words.select("wid", "word"), keep)
        other = words.select(F.col("wid").alias("near_wid"), F.col("word").alias("near"), F.col("n").alias("near_n"))
        near = pairs.join(words, "wid").join(other, "near_wid").where(F.levenshtein("word", "near", 1) == 1)
        best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near"), F.col("near_wid")))
        judged = keep(near.groupBy("wid", "word", "n").agg(F.count("*").alias("n_near"), best.alias("best")).select(
            "wid", "n_near", F.when(-F.col("best.less") >= ratio * F.col("n"), F.col("best")).alias("best")), "trie-judged")
        roots = _roots(judged.where("best is not null").select("wid", F.col("best.near_wid").alias("form_wid")), keep)
        roots = roots.join(words.select(F.col("wid").alias("root"), F.col("word").alias("root_word")), "root")
        out = words.join(judged, "wid", "left").join(roots.select("wid", "root_word"), "wid", "left")
        return keep(out.select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), F.col("best.near").alias("form"),
            (-F.col("best.less")).alias("form_n"), F.coalesce("root_word", "word").alias("root")), "trie-groups", result=True)


def op11_spelling_trie(spark, sf_dir):
    """Variant groups of all documents' words of at least six code points and five occurrences."""
    counts = word_counts(documents(spark, sf_dir), drop_modulus=199)
    return variant_groups(counts.where(F.col("n") >= MIN_COUNT))
