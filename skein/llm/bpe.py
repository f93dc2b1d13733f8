"""Byte-level BPE by prefix dynamic programming.

For every byte prefix of a piece the last token of its only valid encoding is kept. A token may follow the last
token before it exactly when the pair is stable, i.e. the merges leave the two tokens' joined bytes as these two
tokens; an encoding is the merges' own result exactly when all neighbours are stable. So the table answers any
prefix's encoding by walking back, an append only extends it, and an edit invalidates it only from the edit on (and
only in the pieces that the edit touches).

Texts are cut into pieces by the tokenizer's pattern; pieces are encoded separately. A piece that is itself in the
vocabulary is that one token, as in the public encoder. A bounded cache of pieces spares repeated ones.

The tokens that end at each byte come from an Aho-Corasick automaton over the vocabulary. Whether two tokens are stable
neighbours is told from the ends they show each other while they are merged, and remembered.

Defined results: null texts count as empty, empty texts have no ids, repeated rows are encoded each on its own, pieces and
texts of any length are encoded whole.
"""

from __future__ import annotations

import base64
import contextlib
import hashlib
import itertools
import os
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex

from pyspark.sql import DataFrame

from skein.llm.textops import chunks, documents

CACHE_SIZE = 200_000
#: Pieces longer than this are not cached.
CACHE_PIECE = 48
#: Bytes of text that are cut into pieces at a time.
PART_BYTES = 1 << 20
#: Pairs of neighbouring tokens that are remembered.
STABLE_SIZE = 1_000_000


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


class PrefixEncoder:
    """Encoder over one rank table."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.bytes_of = {r: t for t, r in ranks.items()}
        self.sizes = {r: len(t) for t, r in ranks.items()}
        self.longest = max(map(len, ranks))
        self.split = regex.compile(pattern)
        self.shift = max(self.bytes_of).bit_length()
        # the two tokens that a token is merged from at last; a token that its own bytes' merges do not give never appears
        # inside a longer piece and is left out
        self.halves: dict[int, tuple[int, int] | None] = {}
        for t, r in ranks.items():
            ids, halves = self._merge(t)
            if ids == [r]:
                self.halves[r] = halves
        #: Merges then happen in order of rank, which the quick test of neighbours relies on.
        self.rising = all(h is None or max((x for x in h if len(self.bytes_of[x]) > 1), default=-1) < r
                          for r, h in self.halves.items())
        self.forget()
        self.tokens = ahocorasick.Automaton()
        for r in self.halves:
            t = self.bytes_of[r]
            self.tokens.add_word(t.decode("latin-1"), (r, len(t)))
        self.tokens.make_automaton()

    def forget(self) -> None:
        """Drop what was remembered of texts."""
        self.stable: dict[int, bool] = {}
        self.recent: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.edges: dict[tuple[int, int], list[tuple[bytes, int]]] = {}

    def _merge(self, data: bytes) -> tuple[list[int], tuple[int, int] | None]:
        """Ids of ``data`` by the merges (join the neighbours of lowest rank, leftmost first, until none can be), and the
        two tokens joined last."""
        parts, halves = [data[i:i + 1] for i in range(len(data))], None
        while len(parts) > 1:
            rank, i = min(((self.ranks.get(parts[i] + parts[i + 1], 1 << 62), i) for i in range(len(parts) - 1)))
            if rank == 1 << 62:
                break
            halves = self.ranks[parts[i]], self.ranks[parts[i + 1]]
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return [self.ranks[p] for p in parts], halves

    def _edge(self, token: int, side: int) -> list[tuple[bytes, int]]:
        """What stands at a token's left (0) or right (1) end while it is merged: (bytes, rank of the merge that ends it),
        from the single byte on."""
        found = self.edges.get((token, side))
        if found is None:
            found, until = [], 1 << 62
            while True:
                found.append((self.bytes_of[token], until))
                if self.halves[token] is None:
                    break
                until, token = token, self.halves[token][side]
            found.reverse()
            self.edges[self.ranks[found[-1][0]], side] = found
        return found

    def _may_follow(self, a: int, b: int) -> bool:
        """Whether the merges of a's and b's joined bytes leave a and b: no merge crosses the border while both sides'
        ends grow. Of merges of one rank the leftmost comes first."""
        if not self.rising:
            return self._merge(self.bytes_of[a] + self.bytes_of[b])[0] == [a, b]
        left, right, rank = self._edge(a, 1), self._edge(b, 0), self.ranks.get
        i = j = 0
        while True:
            x, x_until = left[i]
            y, y_until = right[j]
            across = rank(x + y)
            if across is not None and across < x_until and across <= y_until:
                return False
            if x_until <= y_until:
                if x_until == 1 << 62:
                    return True
                i += 1
            else:
                j += 1

    def extend(self, last: list[int], data: bytes, start: int) -> None:
        """Fill ``last[i]`` (last token of the encoding of data[:i+1]) for i >= start; the entries before stay."""
        del last[start:]
        stable, shift, done = self.stable, self.shift, start
        # a token that ends at or after ``start`` may begin up to longest - 1 bytes before
        begin = max(0, start - self.longest + 1)
        for end, (token, size) in self.tokens.iter(data[begin:].decode("latin-1")):
            end += begin
            if end != done:  # known already (the encoding of a prefix is unique), or before the start
                continue
            # the longest comes first; where none of the longer is the last token, the single byte is
            if size > 1 and end >= size:
                key = last[end - size] << shift | token
                known = stable.get(key)
                if known is None:
                    if len(stable) >= STABLE_SIZE:
                        for old in list(itertools.islice(stable, STABLE_SIZE // 2)):
                            del stable[old]
                    known = stable[key] = self._may_follow(last[end - size], token)
                if not known:
                    continue
            last.append(token)
            done += 1
        if done != len(data):
            raise ValueError("a byte is missing from the rank table")

    def walk_back(self, last: list[int]) -> list[int]:
        ids, at = [], len(last)
        while at:
            ids.append(last[at - 1])
            at -= self.sizes[last[at - 1]]
        return ids[::-1]

    def piece(self, data: bytes) -> list[int]:
        if (whole := self.ranks.get(data)) is not None:
            return [whole]
        last: list[int] = []
        self.extend(last, data, 0)
        return self.walk_back(last)

    def packed(self, text: str) -> bytes:
        """Ids of a whole text as little-endian unsigned 32-bit integers."""
        return self.packed_all([text])[0]

    def packed_all(self, texts: list[str]) -> list[bytes]:
        """``packed`` of each text. Pieces that no text before had are taken in order, so that each extends the table of
        the beginning that it shares with the one before."""
        recent, older = self.recent, self.older
        cut = [self.split.findall(text) for text in texts]
        new: dict[str, bytes] = {}
        for pieces in cut:
            for p in pieces:
                if p not in recent and p not in new:
                    new[p] = older.get(p)
        last: list[int] = []
        before = b""
        for data, p in sorted((p.encode(), p) for p, ids in new.items() if ids is None):
            if (whole := self.ranks.get(data)) is not None:
                new[p] = np.array([whole], "<u4").tobytes()
                continue
            same = len(os.path.commonprefix((before, data)))
            self.extend(last, data, same)
            before = data
            new[p] = np.array(self.walk_back(last), "<u4").tobytes()
        out = [b"".join([recent[p] if p in recent else new[p] for p in pieces]) for pieces in cut]
        if len(recent) >= CACHE_SIZE // 2:
            # pieces that were not met since the last turn go
            self.older, self.recent = recent, {}
        self.recent.update((p, ids) for p, ids in new.items() if len(p) <= CACHE_PIECE)
        return out

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.packed(text), "<u4").tolist()

    def decode(self, ids) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))

    def edited(self, text: str) -> "EditedText":
        return EditedText(self, text)


class EditedText:
    """A text whose encoding follows appends and edits; only pieces near a change are encoded anew.

    The pattern looks at most one character past a piece (white space before a word), so pieces that end more than
    one character before a change stay. Behind a change pieces are cut until a cut falls on an old one again.
    """

    def __init__(self, encoder: PrefixEncoder, text: str = ""):
        self.encoder, self.text = encoder, ""
        self.ends: list[int] = []
        self.tables: list[list[int]] = []
        self.pieces: list[str] = []
        self.encoded_pieces = 0
        self.replace(0, 0, text)

    def append(self, more: str) -> None:
        self.replace(len(self.text), len(self.text), more)

    def replace(self, start: int, end: int, new: str) -> None:
        """Put ``new`` in the place of text[start:end]."""
        shift = len(new) - (end - start)
        text = self.text[:start] + new + self.text[end:]
        keep = int(np.searchsorted(np.array(self.ends, np.int64), start - 1, "left"))
        keep = max(0, keep - 1)
        at = self.ends[keep - 1] if keep else 0
        old = {e + shift: i for i, e in enumerate(self.ends) if e > end}
        pieces, ends, tables = self.pieces[:keep], self.ends[:keep], self.tables[:keep]
        for m in self.encoder.split.finditer(text, at):
            pieces.append(m.group())
            ends.append(m.end())
            tables.append(self._table(m.group(), len(pieces) - 1))
            if m.end() in old and m.end() > start + len(new) + 1:
                i = old[m.end()]
                pieces += self.pieces[i + 1:]
                ends += [e + shift for e in self.ends[i + 1:]]
                tables += self.tables[i + 1:]
                break
        self.text, self.pieces, self.ends, self.tables = text, pieces, ends, tables

    def _table(self, piece: str, near: int) -> list[int]:
        """Prefix table of a piece; one with a common beginning with the old piece at that place is extended."""
        data = piece.encode()
        last: list[int] = []
        if near < len(self.pieces):
            before = self.pieces[near].encode()
            same = next((i for i, (x, y) in enumerate(zip(before, data)) if x != y), min(len(before), len(data)))
            last = self.tables[near][:same]
        self.encoded_pieces += 1
        self.encoder.extend(last, data, len(last))
        return last

    def ids(self) -> list[int]:
        out = []
        for piece, table in zip(self.pieces, self.tables):
            whole = self.encoder.ranks.get(piece.encode())
            out += [whole] if whole is not None else self.encoder.walk_back(table)
        return out


@lru_cache(2)
def _encoder(path: str, pattern: str) -> PrefixEncoder:
    return PrefixEncoder(read_ranks(path), pattern)


@contextlib.contextmanager
def _in_task(path: str, pattern: str):
    """The encoder, which a worker keeps for its next tasks; what it remembers of texts goes when the task ends, as the
    worker then waits, or runs other stages, with whatever it holds."""
    encoder = _encoder(path, pattern)
    try:
        yield encoder
    finally:
        encoder.forget()
        pa.default_memory_pool().release_unused()


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str, id_col="doc_id", text_col="text") -> DataFrame:
    """``doc_id, ids`` (array of the token ids) for every whole text; the rank file must exist on the executors."""
    def run(batches):
        with _in_task(ranks_path, pattern) as enc:
            for part in _parts(batches):
                blobs = enc.packed_all([t or "" for t in part.column(1).to_pylist()])
                ids = np.frombuffer(b"".join(blobs), "<u4").astype(np.int32)
                off = np.concatenate([[0], np.cumsum([len(b) // 4 for b in blobs])]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.ListArray.from_arrays(pa.array(off), pa.array(ids))], names=["doc_id", "ids"])

    return docs.selectExpr(f"cast(`{id_col}` as bigint) as doc_id", f"`{text_col}` as text").mapInArrow(
        run, "doc_id bigint, ids array<int>")


def decode_documents(tokens: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """``doc_id, data`` (binary) from ``doc_id, ids``."""
    def run(batches):
        enc = _encoder(ranks_path, pattern)
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                part = batch.slice(lo, 1024)
                data = [enc.decode(ids or []) for ids in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(data, pa.binary())], names=["doc_id", "data"])

    return tokens.select("doc_id", "ids").mapInArrow(run, "doc_id bigint, data binary")


def _parts(batches):
    """The rows of ``batches``, texts in the second column, so many at a time that their pieces need little memory."""
    for batch in batches:
        for lo, hi, _, _ in chunks(batch.column(1), PART_BYTES):
            yield batch.slice(lo, hi - lo)


DIGEST_SCHEMA = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"


def encode_digest(docs: DataFrame, ranks_path: str, pattern: str, id_col="doc_id", text_col="text") -> DataFrame:
    """Token count and hashes of the packed ids and of the bytes that decoding these ids gives, in one pass."""
    def run(batches):
        with _in_task(ranks_path, pattern) as enc:
            for part in _parts(batches):
                blobs = enc.packed_all([t or "" for t in part.column(1).to_pylist()])
                back = [hashlib.sha256(enc.decode(np.frombuffer(b, "<u4").tolist())).hexdigest() for b in blobs]
                yield pa.RecordBatch.from_arrays([
                    part.column(0), pa.array([len(b) // 4 for b in blobs], pa.int64()),
                    pa.array([hashlib.sha256(b).hexdigest() for b in blobs]), pa.array(back),
                ], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.selectExpr(f"cast(`{id_col}` as bigint) as doc_id", f"`{text_col}` as text").mapInArrow(
        run, DIGEST_SCHEMA)


def op3_byte_bpe(spark, sf_dir):
    """Encode and decode every document by the multilingual rank file."""
    import public_tokenizers
    return encode_digest(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
                         public_tokenizers.PATTERN)
