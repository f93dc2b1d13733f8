"""Token counts without the tokens: a count-only Viterbi over a unigram vocabulary.

Aho-Corasick enumerates every vocabulary piece that ends at a position; the dynamic programme keeps only the best
score and its number of pieces. Tie rules are those of the public unigram tokenizer: a candidate replaces the
current best of a position only if it scores strictly more, and candidates come by ascending start, so the longest
piece wins a tie; a character no single piece covers is an unknown of score ``lowest - 10`` and consecutive
unknowns fuse into one token.

A text is the piece mark, then the text with every space turned into a mark; no other normalisation. No piece has a
mark after another character (checked when the vocabulary is read; else whole texts are segmented), so a text is
cut before each mark that follows another character, and a run of such segments needs each distinct segment once:
scores and counts add up. Scores here are integers, so sums are exact. Unknowns fuse only inside a segment, since
every later segment begins with the mark, a piece of the vocabulary.

Defined results: null and empty texts have no tokens; repeated rows are counted each on its own.
"""

from __future__ import annotations

import re
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa

from pyspark.sql import DataFrame

from skein.llm.textops import documents

MARK = "▁"
SCHEMA = "doc_id bigint, n_tokens bigint, best_score double, n_unknown bigint"
#: Distinct segments a worker remembers at once.
CACHE_SIZE = 300_000
_SEGMENT = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")


def unigram_vocabulary(path: str) -> list[tuple[str, float]]:
    """Normal pieces of a sentencepiece model with their scores (control, unknown and byte pieces are left out)."""
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(sp.id_to_piece(i), sp.get_score(i)) for i in range(sp.get_piece_size())
            if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]


class CountViterbi:
    """Best score, piece count and unknown count of a marked text."""

    def __init__(self, vocabulary: list[tuple[str, float]], cache_size: int = CACHE_SIZE):
        self.automaton = ahocorasick.Automaton()
        for piece, score in vocabulary:
            self.automaton.add_word(piece, (len(piece), float(score)))
        self.automaton.make_automaton()
        self.unknown = min(s for _, s in vocabulary) - 10.0
        self.by_segment = not any(MARK in p.lstrip(MARK) for p, _ in vocabulary) and any(p == MARK for p, _ in vocabulary)
        self.cache: dict[str, tuple[float, int, int]] = {}
        self.cache_size = cache_size

    def segment(self, s: str) -> tuple[float, int, int]:
        """(score, tokens, unknown tokens) of one segment."""
        n = len(s)
        ends: list[list] = [[] for _ in range(n)]
        for e, match in self.automaton.iter(s):
            ends[e].append(match)
        score, count, unk, in_unk = [0.0] * (n + 1), [0] * (n + 1), [0] * (n + 1), [False] * (n + 1)
        for e in range(n):
            best, frm, single = None, -1, False
            for length, sc in ends[e]:  # longest first: ascending start
                single = single or length == 1
                total = score[e + 1 - length] + sc
                if best is None or total > best:
                    best, frm = total, e + 1 - length
            if not single and (best is None or score[e] + self.unknown > best):
                score[e + 1] = score[e] + self.unknown
                fused = in_unk[e]
                count[e + 1], unk[e + 1], in_unk[e + 1] = count[e] + (not fused), unk[e] + (not fused), True
            else:
                score[e + 1], count[e + 1], unk[e + 1] = best, count[frm] + 1, unk[frm]
        return score[n], count[n], unk[n]

    def text(self, text: str | None) -> tuple[float, int, int]:
        if not text:
            return 0.0, 0, 0
        marked = MARK + text.replace(" ", MARK)
        if not self.by_segment:
            return self.segment(marked)
        score, count, unk = 0.0, 0, 0
        get = self.cache.get
        for s in _SEGMENT.findall(marked):
            r = get(s)
            if r is None:
                if len(self.cache) >= self.cache_size:
                    self.cache.clear()
                r = self.segment(s)
                if len(s) <= 64:
                    self.cache[s] = r
            score += r[0]
            count += r[1]
            unk += r[2]
        return score, count, unk


@lru_cache(2)
def _counter(path: str) -> CountViterbi:
    return CountViterbi(unigram_vocabulary(path))


def count_tokens(docs: DataFrame, model_path: str, id_col="doc_id", text_col="text") -> DataFrame:
    """Token count, best score and unknown count of every whole text; ``model_path`` must exist on the executors."""
    def run(batches):
        counter = _counter(model_path)
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                rows = [counter.text(t) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([
                    part.column(0), pa.array([r[1] for r in rows], pa.int64()),
                    pa.array([r[0] for r in rows], pa.float64()), pa.array([r[2] for r in rows], pa.int64()),
                ], names=["doc_id", "n_tokens", "best_score", "n_unknown"])

    return docs.selectExpr(f"cast(`{id_col}` as bigint) as doc_id", f"`{text_col}` as text").mapInArrow(run, SCHEMA)


def op10_token_counts(spark, sf_dir):
    """Unigram token counts of every document."""
    import public_tokenizers
    return count_tokens(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))
