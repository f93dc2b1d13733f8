"""Shared helpers of the corpus operators: Arrow text buffers, vectorised word and shingle hashes, stored tables.

Words, shingles and windows are handled as 64-bit hashes in numpy arrays inside Arrow batches; no Python
object is made per word. A batch is cut into chunks of at most ``CHUNK_BYTES`` (one longer text is a chunk of
its own), so the working memory of a task does not depend on the batch or the partition.
"""

from __future__ import annotations

import contextlib
import gc
import uuid

import numpy as np
import pyarrow as pa

from pyspark.sql import DataFrame, SparkSession, functions as F

from skein.session import ensure_checkpoint_dir

CHUNK_BYTES = 2 << 20
#: For passes that need more memory for a byte and gain nothing by larger chunks.
ROW_CHUNK_BYTES = 256 << 10

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_INV = pow(_BASE, -1, 1 << 64)
_TABLE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)
_powers = {"p": np.ones(1, np.uint64), "q": np.ones(1, np.uint64)}

LOWER_ASCII = np.arange(256, dtype=np.uint8)
LOWER_ASCII[65:91] += 32
#: 0x20 and 0x09-0x0D separate words.
SPACE = np.zeros(256, bool)
SPACE[[0x20, 9, 10, 11, 12, 13]] = True
#: Everything in ASCII but letters and digits separates words; bytes of other characters belong to words.
NOT_ALNUM = np.ones(256, bool)
NOT_ALNUM[48:58] = NOT_ALNUM[65:91] = NOT_ALNUM[97:123] = NOT_ALNUM[128:] = False


def store(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet below the cluster's checkpoint folder and read it back: lineage ends here and a
    lost executor costs a read, not the work before it."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def stored_steps(spark: SparkSession):
    """``keep(df, label)`` writes a step as ``store`` does; when the block ends, the files of all steps but those kept with
    ``result=True`` are replaced by empty tables."""
    steps = []

    def keep(df: DataFrame, label: str, result: bool = False) -> DataFrame:
        path = f"{ensure_checkpoint_dir(spark)}/{label}-{uuid.uuid4().hex}"
        df.write.parquet(path)
        if not result:
            steps.append((path, df.schema))
        return spark.read.schema(df.schema).parquet(path)

    yield keep
    for path, schema in steps:
        spark.createDataFrame([], schema).write.mode("overwrite").parquet(path)


def fresh_names(df: DataFrame, *wanted: str) -> list[str]:
    """Column names that ``df`` does not have, in any case."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in wanted:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner drop the shuffle files of finished steps now: it does so when the driver collects garbage,
    which a small driver may not do for long."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def crc_fold(id_col="doc_id"):
    """crc32 of the id as text, modulo 4."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 4


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """First n powers of the hash base and of its inverse, modulo 2^64."""
    if len(_powers["p"]) < n:
        size = max(n, CHUNK_BYTES + 1)
        for key, base in (("p", _BASE), ("q", _INV)):
            out = np.empty(size, np.uint64)
            out[0], have = 1, 1
            while have < size:
                k = min(have, size - have)
                out[have:have + k] = out[:k] * _U(pow(base, have, 1 << 64))
                have += k
            _powers[key] = out
    return _powers["p"][:n], _powers["q"][:n]


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    x = x ^ _U(salt)
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and row offsets of a string column, null as empty, without copying when there are no nulls."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw, off


def chunks(column: pa.Array, limit: int = CHUNK_BYTES):
    """Yield (first row, end row, bytes, offsets from 0) for runs of whole rows of at most ``limit`` bytes."""
    raw, off = text_buffers(column)
    lo, n = 0, len(off) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + limit, "right")) - 1)
        hi = min(hi, n)
        yield lo, hi, raw[off[lo]:off[hi]], off[lo:hi + 1] - off[lo]
        lo = hi


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """c[i] = polynomial hash of the first i bytes; ``span_hash`` reads the hash of any span from it."""
    p, _ = powers(len(data) + 1)
    c = np.empty(len(data) + 1, np.uint64)
    c[0] = 0
    np.cumsum(_TABLE[data] * p[:len(data)], out=c[1:])
    return c


def span_hash(c: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    _, q = powers(len(c))
    return (c[ends] - c[starts]) * q[starts]


def byte_hash(rows: np.ndarray) -> np.ndarray:
    """Polynomial hash of each row of a byte matrix."""
    return (_TABLE[rows] * powers(rows.shape[1])[0]).sum(1, dtype=np.uint64)


def stretches(inside: np.ndarray, offsets: np.ndarray):
    """Maximal stretches of marked bytes in each row: (start, end, rows' first stretch index with the end appended)."""
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(inside))]
    first[cuts] |= inside[cuts]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    last[cuts - 1] |= inside[cuts - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def words(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray, lower: bool = True):
    """Words of each row: (hash, start, end, rows' first word index with the end appended)."""
    b = LOWER_ASCII[data] if lower else data
    starts, ends, bounds = stretches(~separators[b], offsets)
    return mix(span_hash(prefix_hash(b), starts, ends)), starts, ends, bounds


def word_ids(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray):
    """Exact numbers of the words that ``inside`` marks: (number of each word, the words by number, rows' first word index
    with the end appended)."""
    starts, ends, bounds = stretches(inside, offsets)
    at = np.zeros(len(starts) + 1, np.int32)
    np.cumsum(ends - starts, out=at[1:])
    coded = pa.Array.from_buffers(pa.binary(), len(starts), [
        None, pa.py_buffer(at), pa.py_buffer(data[inside])]).dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary, bounds


def shingles(hashes: np.ndarray, bounds: np.ndarray, k: int):
    """Hashes of k consecutive words that lie in one row, and the index of each shingle's first word."""
    if len(hashes) < k:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    n = len(hashes) - k + 1
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out = out * _U(0xD6E8FEB86659FD93) + hashes[j:j + n]
    row_end = np.repeat(bounds[1:], np.diff(bounds))
    at = np.flatnonzero(np.arange(n) + k <= row_end[:n])
    return mix(out[at]), at


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
