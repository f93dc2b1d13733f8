"""Order MinHash fingerprints, in DataFrame functions only.

A text's k-mers are its runs of ``K`` white-space separated words (a shorter text is one k-mer), each numbered by its
occurrence, so that repeats stay apart. One 64-bit hash of (k-mer, occurrence) both deals the k-mers into ``BINS`` bins
and ranks them there; a bin keeps its ``KEEP`` smallest, puts them back in text order and hashes that tuple. A block of
text that moves or is rewritten changes the order inside the tuples, so likeness follows edit distance, not just the
set of k-mers. The fingerprint is the list of (bin, tuple hash); bins without k-mers are left out. The likeness of two
fingerprints is the share of bins, among those either has, in which their tuples agree.

Everything is array expressions on one row; intermediate arrays are bound once by ``_let``. Occurrence numbers come from
the sorted k-mer hashes: an element equal to its left neighbour finds the begin of its run by halving steps, so even a
text of one repeated word costs n log n.

The next document in descending order of ids is found without a global sort: ids are dealt into ranges of ``RANGE``
values, and the first row of every range also visits the range before it; each range is ordered on its own.

Defined results: null texts count as empty; texts without words have an empty fingerprint, like only another empty one
(1.0); equal texts have equal fingerprints; a null id comes last; rows of one id follow each other in the order of a hash
of their texts; the only row of a table is its own next. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from skein.llm.textops import documents, store

K = 3
BINS = 64
KEEP = 2
RANGE = 2048
_STEPS = [1 << i for i in range(26, -1, -1)]


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once for a row."""
    return F.transform(F.array(value), body)[0]


def _kmers(words: Column, k: int) -> Column:
    """(hash, position) of each k-mer."""
    def at(i):
        return F.struct(F.xxhash64(*[F.get(words, i + j) for j in range(k)]).alias("h"), i.alias("p"))

    n = F.size(words)
    one = F.array(F.struct(F.xxhash64(F.array_join(words, " ")).alias("h"), F.lit(0).alias("p")))
    none = F.array().cast("array<struct<h:bigint,p:int>>")
    return F.when(n >= k, F.transform(F.sequence(F.lit(0), F.greatest(n - k, F.lit(0))), at)).when(n > 0, one).otherwise(none)


def _numbered(s: Column) -> Column:
    """Of sorted (hash, position): (hash of k-mer and occurrence number, position)."""
    def number(x, i):
        def back(start, step):
            return F.when((start >= step) & (F.get(s, start - step)["h"] == x["h"]), start - step).otherwise(start)

        run = F.aggregate(F.array(*[F.lit(v) for v in _STEPS]), i, back)
        occurrence = F.when((i > 0) & (F.get(s, i - 1)["h"] == x["h"]), i - run).otherwise(F.lit(0))
        return F.struct(F.xxhash64(x["h"], occurrence).alias("q"), x["p"].alias("p"))

    return F.transform(s, number)


def _bin(q: Column, bins: int) -> Column:
    return F.shiftright(q, 64 - (bins.bit_length() - 1)) + bins // 2


def _smallest(t: Column, bins: int, keep: int) -> Column:
    """Of (hash, position) sorted by hash, the first ``keep`` of each bin as (bin, position, hash) in text order."""
    chosen = F.filter(t, lambda x, i: (i < keep) | (_bin(F.get(t, i - keep)["q"], bins) != _bin(x["q"], bins)))
    return F.sort_array(F.transform(chosen, lambda x: F.struct(
        _bin(x["q"], bins).alias("b"), x["p"].alias("p"), x["q"].alias("q"))))


def _tuples(u: Column) -> Column:
    """bin * 2^32 + 32 bits of the hash of the bin's ordered tuple."""
    def of(x, i):
        right, left = F.get(u, i + 1), F.get(u, F.greatest(i - 1, F.lit(0)))
        pair = F.when(right["b"] == x["b"], F.xxhash64(x["q"], right["q"])).when(
            (i > 0) & (left["b"] == x["b"]), F.lit(None)).otherwise(F.xxhash64(x["q"]))
        return F.shiftleft(x["b"].cast("bigint"), 32) + pair.bitwiseAND(F.lit(0xFFFFFFFF))

    return F.filter(F.transform(u, of), lambda v: v.isNotNull())


def fingerprint(text: Column, k: int = K, bins: int = BINS) -> Column:
    """The fingerprint of a text column as array<bigint>, ascending by bin. ``bins`` is a power of two."""
    words = F.filter(F.split(F.coalesce(text, F.lit("")), r"\s+"), lambda w: w != "")
    return _let(words, lambda w: _let(F.sort_array(_kmers(w, k)), lambda s: _let(F.sort_array(_numbered(s)), lambda t: _let(
        _smallest(t, bins, KEEP), _tuples))))


def written(print_: Column) -> Column:
    """Ten hexadecimal digits for each bin."""
    return F.array_join(F.transform(print_, lambda v: F.lpad(F.lower(F.hex(v)), 10, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Share of the bins that either fingerprint has in which both agree; 1.0 for two empty ones."""
    def bins(c):
        return F.transform(c, lambda v: F.shiftright(v, 32))

    either = F.size(F.array_union(bins(a), bins(b)))
    return F.when(either == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / F.greatest(either, F.lit(1)))


def _following(values: DataFrame, low: int, high: int) -> DataFrame:
    """``v, next``: the next larger value (null after the largest) of distinct values between low and high."""
    narrow = high - low < RANGE
    group = F.lit(0).cast("bigint") if narrow else F.expr(f"(v - pmod(v, {RANGE})) div {RANGE}")
    inner = values.withColumn("g", group).withColumn("next", F.lead("v").over(Window.partitionBy("g").orderBy("v")))
    if narrow:
        return inner.select("v", "next")
    inner = store(inner, "omh-order")
    heads = inner.groupBy("g").agg(F.min("v").alias("head"))
    order = _following(heads.select(F.col("g").alias("v")), low // RANGE, high // RANGE).toDF("g", "after")
    link = order.join(heads.withColumnRenamed("g", "after"), "after").select("g", "head")
    return inner.join(link, "g", "left").select("v", F.coalesce("next", "head").alias("next"))


def with_next(rows: DataFrame) -> DataFrame:
    """``doc_id, text, print, next_text, next_print`` from ``doc_id, text, print``, in descending order of ids."""
    keyed = rows.select("*", F.coalesce("doc_id", F.lit(-(1 << 63))).alias("k"), F.xxhash64("text").alias("h"))
    keyed = keyed.withColumn("range", F.expr(f"(k - pmod(k, {RANGE})) div {RANGE}"))
    heads = store(keyed.groupBy("range").agg(F.max(F.struct("k", "h")).alias("m")).select("range", "m.k", "m.h"), "omh-heads")
    ends = heads.agg(F.min("range"), F.max("range")).first()
    if ends[0] is None:
        return rows.select("doc_id", "text", "print", F.col("text").alias("next_text"), F.col("print").alias("next_print"))
    order = _following(heads.select(F.col("range").alias("v")), *ends).toDF("range", "host")
    # the first row of a range is also the guest that ends the range above; the table's first ends the lowest range
    guests = store(heads.join(order, "range").select("range", "k", "h", F.coalesce("host", F.lit(ends[0])).alias("host")), "omh-guests")
    placed = keyed.join(guests, ["range", "k", "h"], "left").select(
        "doc_id", "text", "print", "k", "h", F.inline(F.filter(F.array(
            F.struct(F.col("range").alias("place"), F.lit(0).alias("guest")),
            F.struct(F.col("host").alias("place"), F.lit(1).alias("guest"))), lambda x: x["place"].isNotNull())))
    w = Window.partitionBy("place").orderBy("guest", F.desc("k"), F.desc("h"))
    return placed.withColumn("next_text", F.lead("text").over(w)).withColumn("next_print", F.lead("print").over(w)).where(
        "guest = 0").select("doc_id", "text", "print", "next_text", "next_print")


def fingerprint_documents(docs: DataFrame, id_col="doc_id", text_col="text") -> DataFrame:
    """Fingerprints of every text and of its edited text (the last half replaced by as many of the first characters
    of the next document), and their likenesses."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    near = with_next(rows.withColumn("print", fingerprint(F.col("text"))))
    n, half = F.length("text"), F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.substr(F.col("text"), F.lit(1), n - half), F.substr(F.col("next_text"), F.lit(1), half))
    near = near.withColumn("edited", edited)
    near = near.select("doc_id", n.cast("bigint").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
                       "print", "next_print", fingerprint(F.col("edited")).alias("edited_print"))
    return near.select("doc_id", "n_chars", "edited_sha256", written(F.col("print")).alias("fingerprint"),
                       written(F.col("edited_print")).alias("edited_fingerprint"),
                       likeness(F.col("print"), F.col("edited_print")).alias("near_edited"),
                       likeness(F.col("print"), F.col("next_print")).alias("near_next"))


def op4_order_minhash(spark, sf_dir):
    """Order MinHash fingerprints of every document and of its edited text."""
    return fingerprint_documents(documents(spark, sf_dir))
