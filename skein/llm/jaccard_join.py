"""N-gram Jaccard join: all documents whose word-shingle sets reach a Jaccard similarity, as linked components.

Documents with equal sets are one node. Two nodes can only link if they share a token among the first
``n - ceil(t n) + 1`` of each set in one global order; the order puts shingles that a corpus-wide count sketch calls
rare first, so that tokens of common passages rarely bring documents together. Nodes that share such a token meet in
tiles of compatible size bands; there a hashed bitmap of each set bounds the overlap from above (every bit of one
that the other lacks stands for at least one shingle of its own), and only pairs whose bound reaches the threshold go
to the exact intersection of the sorted arrays.

Only connectivity is asked for, so dense groups never become all pairs: a tile first names, among its pairs that pass
the bound, just a forest of the likeliest ones; these are checked exactly, links are closed to components, and the tiles
name a forest between the components that are left. What remains in the end, every pair of different components that
passes the bound, is checked whole. No link between different components is skipped, so the components are exact.
Large groups are cut into blocks, a tile for each pair of blocks.

Shingles are 64-bit hashes; a pair of different shingles is equal with a chance of 2^-64. Nothing grows on the driver:
it holds the sketch (65,536 counts) and scalars. Tokens travel as packed arrays, one row for a (task, bucket), and the
number of buckets follows the input.

Defined results: null and empty texts, and texts without words, have empty sets and are linked with nothing (their
component is their own id); repeated rows share a node; rows without an id get a null component and link nothing;
extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from pyspark.sql import DataFrame, functions as F

from skein.llm.components import components
from skein.llm.textops import (
    ROW_CHUNK_BYTES, SPACE, chunks, documents, mix, release, shingles, signed, store, words)

SHINGLE = 4
PERCENT = 85
SKETCH_CELLS = 1 << 16
BLOCK = 512
#: Token records in one bucket, about.
BUCKET_RECORDS = 1_000_000
#: Records a task gathers before it sends them.
FLUSH_RECORDS = 200_000

_TOKEN = np.dtype([("token", "<u8"), ("node", "<i8"), ("n", "<u4"), ("pos", "<u4")])


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each row; with fewer than k words the whole sequence is one shingle."""
    hashes, _, _, bounds = words(data, offsets, SPACE)
    grams, at = shingles(hashes, bounds, k)
    cut = np.searchsorted(at, bounds)
    out = []
    for i in range(len(offsets) - 1):
        n = bounds[i + 1] - bounds[i]
        if n >= k:
            out.append(np.unique(grams[cut[i]:cut[i + 1]]))
        elif n:
            out.append(mix(shingles(hashes[bounds[i]:bounds[i + 1]], np.array([0, n]), int(n))[0], int(n)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def set_id(s: np.ndarray) -> int:
    """One number for a set, whatever the order of its members."""
    sums = np.array([mix(s, 0x1234567).sum(dtype=np.uint64), mix(s, 0x89ABCDE).sum(dtype=np.uint64)])
    return int(signed(mix(sums[:1] ^ mix(sums[1:]), len(s)))[0])


def bitmap(s: np.ndarray) -> np.ndarray:
    """Hashed bitmap as 64-bit words; its size is a power of two over twice the set's, between 64 and 65,536 bits."""
    bits = 64
    while bits < 2 * len(s) and bits < 65_536:
        bits *= 2
    out = np.zeros(bits // 64, np.uint64)
    at = (s & np.uint64(bits - 1)).astype(np.int64)
    np.bitwise_or.at(out, at >> 6, np.uint64(1) << (at & 63).astype(np.uint64))
    return out


def fold(b: np.ndarray, size: int) -> np.ndarray:
    while len(b) > size:
        b = b[:len(b) // 2] | b[len(b) // 2:]
    return b


def needed(na, nb, percent: int = PERCENT):
    """Smallest overlap that links sets of these sizes: 100 o >= percent (na + nb - o)."""
    return -(-percent * (na + nb) // (100 + percent))


def overlap_bound(ba, na, bb, nb) -> int:
    size = min(len(ba), len(bb))
    a, b = fold(ba, size), fold(bb, size)
    return min(na - int(np.bitwise_count(a & ~b).sum()), nb - int(np.bitwise_count(b & ~a).sum()))


def _describe(k):
    """One row for each document (id, text's hash, size, node, bitmap) and, at a task's end, one with its sketch."""
    def run(batches):
        sketch = np.zeros(SKETCH_CELLS, np.int64)

        def rows(ids, text_keys, n, nodes, maps, cells):
            return pa.RecordBatch.from_arrays([
                ids, text_keys, pa.array(n, pa.int64()), pa.array(nodes, pa.int64()), pa.array(maps, pa.binary()),
                pa.array(cells, pa.list_(pa.int64()))], names=["doc_id", "text_key", "n", "node", "bitmap", "cells"])

        for batch in batches:
            for lo, hi, data, off in chunks(batch.column(1), ROW_CHUNK_BYTES):
                sets = shingle_sets(data, off, k)
                flat = np.concatenate(sets)
                sketch += np.bincount((flat >> np.uint64(48)).astype(np.int64), minlength=SKETCH_CELLS)
                yield rows(batch.column(0)[lo:hi], batch.column(2)[lo:hi], [len(s) for s in sets], [set_id(s) for s in sets],
                           [bitmap(s).tobytes() for s in sets], [None] * (hi - lo))
        if sketch.any():
            none = pa.array([None], pa.int64())
            yield rows(none, none, [None], [None], [None], [sketch])

    return run


def _tokens(k, percent, levels, n_buckets):
    """Packed prefix tokens of every node a task sees, by bucket."""
    def run(batches):
        seen: set[int] = set()
        held, size = [], 0

        def flush():
            rec = np.concatenate(held)
            bucket = (mix(rec["token"], 77) % np.uint64(n_buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            rec, bucket = rec[order], bucket[order]
            cut = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
            return pa.RecordBatch.from_arrays([
                pa.array(bucket[cut], pa.int64()),
                pa.array([rec[a:b].tobytes() for a, b in zip(cut, np.append(cut[1:], len(rec)))], pa.binary())],
                names=["bucket", "records"])

        for batch in batches:
            for lo, hi, data, off in chunks(batch.column(1), ROW_CHUNK_BYTES):
                for doc, s in zip(batch.column(0)[lo:hi].to_pylist(), shingle_sets(data, off, k)):
                    n = len(s)
                    if doc is None or not n or (node := set_id(s)) in seen:
                        continue
                    if len(seen) > 1_000_000:
                        seen.clear()
                    seen.add(node)
                    keys = (levels[(s >> np.uint64(48)).astype(np.int64)] << np.uint64(56)) | (s & np.uint64((1 << 56) - 1))
                    keys.sort()
                    p = n - (percent * n + 99) // 100 + 1
                    rec = np.empty(p, _TOKEN)
                    rec["token"], rec["node"], rec["n"], rec["pos"] = keys[:p], node, n, np.arange(p)
                    held.append(rec)
                    size += p
                if size >= FLUSH_RECORDS:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    return run


def _meetings(percent):
    """Of one bucket: the members of tokens that two or more nodes share, as far as they can link there."""
    return lambda table: _met(table, percent)


def _fits(na, pa_, nb, pb, percent):
    """Sizes within the threshold, and enough left behind the shared token for the overlap that is needed. At the
    first token that two linked sets share this holds, so no link is lost."""
    rest = 1 + np.minimum(na - pa_ - 1, nb - pb - 1)
    return (100 * np.minimum(na, nb) >= percent * np.maximum(na, nb)) & (rest >= needed(na, nb, percent))


def _has_partner(rec: np.ndarray, percent: int, look: int = 8) -> np.ndarray:
    """Members that fit some other member of their token; in groups of more than ``look`` all are kept."""
    n, pos, token = rec["n"].astype(np.int64), rec["pos"].astype(np.int64), rec["token"]
    new = np.append(True, token[1:] != token[:-1]) if len(rec) else np.zeros(0, bool)
    group = np.cumsum(new) - 1
    keep = np.bincount(group)[group] > look if len(rec) else new
    for k in range(1, min(look, len(rec))):
        ok = (token[k:] == token[:-k]) & _fits(n[k:], pos[k:], n[:-k], pos[:-k], percent)
        keep[k:] |= ok
        keep[:-k] |= ok
    return keep


def _met(table: pa.Table, percent: int) -> pa.Table:
    rec = np.frombuffer(b"".join(table.column("records").to_pylist()), _TOKEN)
    rec = rec[np.lexsort((rec["node"], rec["token"]))]
    new = np.ones(len(rec), bool)
    new[1:] = (rec["token"][1:] != rec["token"][:-1]) | (rec["node"][1:] != rec["node"][:-1])
    rec = rec[new]
    first = np.ones(len(rec), bool)
    first[1:] = rec["token"][1:] != rec["token"][:-1]
    group = np.cumsum(first) - 1
    rec = rec[np.bincount(group)[group] >= 2]
    rec = rec[_has_partner(rec, percent)]
    return pa.table({"token": signed(rec["token"].copy()), "node": rec["node"].copy(), "n": rec["n"].astype(np.int64),
                     "pos": rec["pos"].astype(np.int64)})


class _Tile:
    """Members of one tile, ascending by size, with their bitmaps in one matrix for each bitmap length."""

    def __init__(self, maps: list[bytes]):
        self.length = np.array([len(m) // 8 for m in maps])
        self.rows = np.zeros(len(maps), np.int64)
        self.matrix = {}
        for size in np.unique(self.length):
            at = np.flatnonzero(self.length == size)
            self.rows[at] = np.arange(len(at))
            self.matrix[size, size] = np.frombuffer(b"".join(maps[i] for i in at), "<u8").reshape(len(at), size)

    def folded(self, length: int, size: int) -> np.ndarray:
        if (length, size) not in self.matrix:
            m = self.folded(length, 2 * size)
            self.matrix[length, size] = m[:, :size] | m[:, size:]
        return self.matrix[length, size]

    def bounds(self, i: int, js: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Largest possible overlap of member i with each of js."""
        out = np.empty(len(js), np.int64)
        for length in np.unique(self.length[js]):
            at = np.flatnonzero(self.length[js] == length)
            size = min(length, self.length[i])
            mine = self.folded(self.length[i], size)[self.rows[i]]
            theirs = self.folded(length, size)[self.rows[js[at]]]
            out[at] = np.minimum(n[i] - np.bitwise_count(mine & ~theirs).sum(1, dtype=np.int64),
                                 n[js[at]] - np.bitwise_count(theirs & ~mine).sum(1, dtype=np.int64))
        return out


def _tiles(percent, whole):
    """Pairs of nodes of different components that share a token, fit in size and pass the bitmap bound: all of them
    (``whole``), or of each tile a forest of the likeliest; and every node of such a pair (with no partner named)."""
    def run(key, table: pa.Table, bitmaps: pa.Table) -> pa.Table:
        known = dict(zip(bitmaps.column("which").to_pylist(), bitmaps.column("bitmap")))
        tile, token = table.column("tile").to_numpy(), table.column("token").to_numpy()
        order = np.lexsort((table.column("n").to_numpy(), tile, token))
        token, tile = token[order], tile[order]
        block, node, root, n, pos = (table.column(c).to_numpy()[order] for c in ("block", "node", "root", "n", "pos"))
        cut = np.flatnonzero(np.append(True, (token[1:] != token[:-1]) | (tile[1:] != tile[:-1])))
        pairs, live = set(), set()
        for lo, hi in zip(cut, np.append(cut[1:], len(node))):
            if (root[lo:hi] == root[lo]).all():
                continue
            members, found = None, []
            # a tile of two blocks compares across them; pairs inside a block have a tile of their own
            across = tile[lo] >> 20 != tile[lo] & 0xFFFFF
            far = np.searchsorted(n[lo:hi] * percent, 100 * n[lo:hi], "right") + lo
            for i in range(lo, hi - 1):
                js = np.arange(i + 1, far[i - lo])
                fits = (root[js] != root[i]) & _fits(n[i], pos[i], n[js], pos[js], percent)
                if across:
                    fits &= block[js] != block[i]
                js = js[fits]
                if not len(js):
                    continue
                members = members or _Tile([known[k].as_py() for k in node[lo:hi].tolist()])
                bound = members.bounds(i - lo, js - lo, n[lo:hi])
                ok = bound >= needed(n[i], n[js], percent)
                if ok.any():
                    found.append((np.full(int(ok.sum()), i), js[ok], bound[ok] / (n[i] + n[js[ok]] - bound[ok])))
            if not found:
                continue
            i, j, like = (np.concatenate(x) for x in zip(*found))
            live.update(node[i].tolist(), node[j].tolist())
            if not whole:
                best = np.argsort(-like, kind="stable")
                kept, tree = [], {}
                for e in best:
                    x, y = _find(tree, root[i[e]]), _find(tree, root[j[e]])
                    if x != y:
                        tree[x] = y
                        kept.append(e)
                i, j = i[kept], j[kept]
            pairs.update(zip(np.minimum(node[i], node[j]).tolist(), np.maximum(node[i], node[j]).tolist()))
        both = np.array(sorted(pairs), np.int64).reshape(-1, 2)
        alone = np.array(sorted(live), np.int64)
        none = np.concatenate([np.zeros(len(both), bool), np.ones(len(alone), bool)])
        return pa.table({"a": np.concatenate([both[:, 0], alone]),
                         "b": pa.array(np.concatenate([both[:, 1], alone]), mask=none)})

    return run


def _find(tree: dict, x):
    while x in tree:
        x = tree[x]
    return x


def _exact(percent):
    def run(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(x.as_buffer(), "<u8"), np.frombuffer(y.as_buffer(), "<u8")
                o = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * o >= percent * (len(x) + len(y) - o))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _members(k):
    def run(batches):
        for batch in batches:
            for lo, hi, data, off in chunks(batch.column(1), ROW_CHUNK_BYTES):
                rows = [(node, s) for node, s in zip(batch.column(0)[lo:hi].to_pylist(), shingle_sets(data, off, k))
                        if set_id(s) == node]
                yield pa.RecordBatch.from_arrays([
                    pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1].tobytes() for r in rows], pa.binary())],
                    names=["node", "members"])

    return run


def linked_components(docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT, id_col="doc_id",
                      text_col="text", text_key: bool = False) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for each row, and its text's xxhash64 as ``text_key`` if asked for, which tells
    rows of one id apart."""
    spark = docs.sparkSession
    src = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    described = store(src.withColumn("text_key", F.xxhash64("text")).mapInArrow(
        _describe(k), "doc_id bigint, text_key bigint, n bigint, node bigint, bitmap binary, cells array<bigint>"), "jaccard-docs")
    rows = described.where("n is not null").select("doc_id", "n", "node", "text_key")

    # the sketch: shingles' counts by the first 16 bits of their hash, on a logarithmic scale
    cells = described.where("cells is not null").select(F.posexplode("cells").alias("cell", "c")).groupBy("cell").agg(
        F.sum("c").alias("c")).collect()
    levels = np.zeros(SKETCH_CELLS, np.uint64)
    for cell, c in cells:
        levels[cell] = min(255, int(6 * np.log2(1 + c)))

    live = rows.where("n > 0 and doc_id is not null")
    total = live.agg(F.sum(F.expr(f"n - ceil({percent} * n / 100) + 1"))).first()[0] or 0
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n_buckets = max(parts, int(total) // BUCKET_RECORDS + 1)
    tokens = src.mapInArrow(_tokens(k, percent, levels, n_buckets), "bucket bigint, records binary")
    met = store(tokens.groupBy("bucket").applyInArrow(
        _meetings(percent), "token bigint, node bigint, n bigint, pos bigint"), "jaccard-met")
    maps = described.where("n > 0 and doc_id is not null").select("node", "bitmap").dropDuplicates(["node"])

    def tiles(members: DataFrame, roots: DataFrame | None, whole: bool) -> DataFrame:
        if roots is None:
            members = members.withColumn("root", F.col("node"))
        else:
            members = members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        split = members.groupBy("token").agg(F.count("*").alias("c"), F.min("root").alias("lo"), F.max("root").alias("hi")).where(
            "lo <> hi").select("token", F.ceil(F.col("c") / BLOCK).cast("bigint").alias("blocks"))
        placed = members.join(split, "token").withColumn("block", F.pmod(F.xxhash64("node", "token"), F.col("blocks")))
        placed = placed.withColumn("tile", F.explode(F.transform(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1), lambda o: (
            F.shiftleft(F.least(o, F.col("block")), 20) + F.greatest(o, F.col("block"))))))
        placed = placed.select(F.pmod(F.xxhash64("token", "tile"), F.lit(4 * n_buckets)).alias("bucket"), "token", "tile",
                               "block", "node", "root", "n", "pos")
        # a node's bitmap goes once to every bucket that has it
        shown = placed.select("bucket", "node").distinct().toDF("at", "which").join(maps.toDF("which", "bitmap"), "which")
        shown = shown.select("at", "which", "bitmap")
        return placed.groupBy("bucket").cogroup(shown.groupBy("at")).applyInArrow(
            _tiles(percent, whole), "a bigint, b bigint")

    first = store(tiles(met, None, False).distinct(), "jaccard-pairs")
    release(spark)
    # only nodes that pass a bound can link: their sets, and their meetings
    able = first.where("b is null").select(F.col("a").alias("node"))
    reps = live.groupBy("node").agg(F.min("doc_id").alias("doc_id"))
    texts = src.join(able.join(reps, "node"), "doc_id").select("node", "text")
    sets = store(texts.mapInArrow(_members(k), "node bigint, members binary").dropDuplicates(["node"]), "jaccard-sets")
    release(spark)
    met = store(met.join(able, "node", "left_semi"), "jaccard-able")

    def verified(pairs: DataFrame) -> DataFrame:
        for side in ("a", "b"):
            pairs = pairs.join(sets.select(F.col("node").alias(side), F.col("members").alias(f"members_{side}")), side)
        return store(pairs.select("a", "b", "members_a", "members_b").mapInArrow(
            _exact(percent), "a bigint, b bigint"), "jaccard-links")

    tried = first.where("b is not null")
    links = verified(tried)
    roots = components(links, "jaccard-roots")
    for whole in (False, True):
        pairs = store(tiles(met, roots, whole).where("b is not null").distinct().join(tried, ["a", "b"], "left_anti"),
                      "jaccard-pairs")
        tried = tried.union(pairs)
        links = links.union(verified(pairs))
        release(spark)
        roots = components(links, "jaccard-roots")

    placed = live.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    smallest = placed.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    final = placed.join(smallest, "root").select("node", "component_id").distinct()
    return rows.join(final, "node", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.when(F.col("doc_id").isNotNull(), F.col("component_id"))).otherwise(F.col("doc_id")).alias("component_id"),
        *["text_key"] * text_key)


def op5_jaccard_join(spark, sf_dir):
    """Components of all documents under 4-word shingles and a Jaccard similarity of 0.85."""
    return linked_components(documents(spark, sf_dir))


OP5_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS (SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
      ELSE list_distinct(list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' '))) END AS sh FROM w),
e AS (SELECT doc_id, unnest(sh) AS g FROM s),
o AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS i FROM e x JOIN e y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM o JOIN s sa ON sa.doc_id = a JOIN s sb ON sb.doc_id = b
      WHERE 100 * i >= 85 * (len(sa.sh) + len(sb.sh) - i)),
r(d, c) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.d, l.b FROM r JOIN l ON l.a = r.c)
SELECT s.doc_id, CAST(len(sh) AS BIGINT) AS n_shingles, min(c) AS component_id
FROM s JOIN r ON r.d = s.doc_id GROUP BY s.doc_id, len(sh)
"""
