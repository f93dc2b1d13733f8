"""URL filters by a bit-parallel wildcard automaton.

All glob rules are packed into one multiword Shift-And automaton: every pattern character owns a bit, a wildcard is a
self-loop on the bit before it (``*`` for a run without ``/``, ``**`` for any run). One pass over the characters of a canonical URL (``host`` + ``path``) moves the
states of all rules at once; numpy moves them for all URLs of an Arrow batch together. The rule set is the only
thing sent to the tasks; it is a fixed parameter, not data.

Defined results: null or scheme-less URLs have an empty host and path, fit no host rule and get the default
verdict; repeated rows are judged each on its own; extra input columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from pyspark.sql import DataFrame, functions as F

#: Fixed by the task: (verdict, host, path).
RULES = (
    ("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"), ("block", "com", "/de/"),
)
#: Globs over host + path that block a URL no rule fits.
SPAM_GLOBS = ("**cheap-pills**", "**spam-farm**", "**casino**", "**viagra**", "**/wp-login**")

SCHEMA = "page_id bigint, host string, path string, rule string, verdict string"


@dataclass(frozen=True)
class Glob:
    """``**`` matches any run of bytes, ``*`` any run without ``/``; other bytes match themselves. ``rule`` is an
    index given back on a match."""

    pattern: bytes
    rule: int


class ShiftAnd:
    """Globs packed into 64-bit words; ``match`` returns which globs fit each whole input string."""

    def __init__(self, globs: list[Glob]):
        self.rules = np.array([g.rule for g in globs], np.int64)
        places, anything, segment, starts, finals = [], [], [], [], []
        for g in globs:
            # one start bit without a character, then one bit for each literal byte
            starts.append(len(places))
            places.append(-1)
            for i, part in enumerate(re.split(rb"(\*\*?)", g.pattern)):
                if i % 2:
                    (anything if part == b"**" else segment).append(len(places) - 1)
                else:
                    places.extend(part)
            finals.append(len(places) - 1)
        self.n_words = (len(places) + 63) // 64
        self.accept = np.zeros((256, self.n_words), np.uint64)
        for i, ch in enumerate(places):
            if ch >= 0:
                self.accept[ch, i // 64] |= np.uint64(1) << np.uint64(i % 64)
        self.loop = np.tile(self._pack(anything + segment), (256, 1))
        self.loop[0x2F] = self._pack(anything)
        self.start = self._pack(starts)
        self.finals = np.array(finals)

    def _pack(self, bits) -> np.ndarray:
        out = np.zeros(self.n_words, np.uint64)
        for i in bits:
            out[i // 64] |= np.uint64(1) << np.uint64(i % 64)
        return out

    def match(self, strings: list[bytes]) -> np.ndarray:
        """Boolean matrix, strings x globs."""
        result = np.zeros((len(strings), len(self.finals)), bool)
        lengths = np.array([len(s) for s in strings], np.int64)
        order = np.argsort(-lengths, kind="stable")  # longest first: those still running are a prefix
        lengths = lengths[order]
        data = np.frombuffer(b"".join(strings[i] for i in order), np.uint8)
        begin = np.concatenate([[0], np.cumsum(lengths)])[:-1]
        state = np.tile(self.start, (len(strings), 1))
        one, top = np.uint64(1), np.uint64(63)
        for at in range(int(lengths[0]) if len(strings) else 0):
            live = int(np.searchsorted(-lengths, -at, "left"))
            s = state[:live]
            moved = s << one
            moved[:, 1:] |= s[:, :-1] >> top
            ch = data[begin[:live] + at]
            state[:live] = (moved & self.accept[ch]) | (s & self.loop[ch])
        hit = (state[:, self.finals // 64] >> (self.finals % 64).astype(np.uint64)) & one
        result[order] = hit.astype(bool)
        return result


def host_rule_globs(rules=RULES, spam=SPAM_GLOBS) -> list[Glob]:
    """Two globs for a host rule (the host itself and its subdomains), one for each spam glob."""
    globs = []
    for i, (_, host, path) in enumerate(rules):
        globs += [Glob(f"{host}{path}**".encode(), i), Glob(f"*.{host}{path}**".encode(), i)]
    return globs + [Glob(g.encode(), len(rules) + i) for i, g in enumerate(spam)]


def judge_urls(pages: DataFrame, rules=RULES, spam=SPAM_GLOBS, id_col="page_id", url_col="url") -> DataFrame:
    """One row for each page: host, path, the longest fitting rule as ``host/path`` (null if none), the verdict.

    The automaton runs over ``host + path``; a slash begins every non-empty path and cannot be in a host, and the
    wildcard of a host rule does not cross one, so host rules never match inside a path.
    """
    rules, spam = tuple(rules), tuple(spam)
    names = [h + p for _, h, p in rules]
    order = sorted(range(len(rules)), key=lambda i: (-len(names[i]), i))
    if any("*" in n for n in names):
        raise ValueError("host rules hold no wildcard; give a glob in spam instead")
    globs = host_rule_globs(rules, spam)

    def run(batches):
        automaton = ShiftAnd(globs)
        for batch in batches:
            hosts, paths = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            hit = automaton.match([(h + p).encode() for h, p in zip(hosts, paths)])
            fits = np.zeros((len(hosts), len(rules) + len(spam)), bool)
            for j, r in enumerate(automaton.rules):
                fits[:, r] |= hit[:, j]
            best = np.full(len(hosts), -1)
            for i in reversed(order):
                best[fits[:, i]] = i
            spammy = fits[:, len(rules):].any(axis=1)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), batch.column(2),
                pa.array([names[b] if b >= 0 else None for b in best], pa.string()),
                pa.array([rules[b][0] if b >= 0 else "block" if s else "allow" for b, s in zip(best, spammy)],
                         pa.string()),
            ], names=["page_id", "host", "path", "rule", "verdict"])

    url = F.coalesce(F.col(url_col), F.lit(""))
    rest = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + F.lit(3))).otherwise(F.lit(""))
    base = pages.select(F.col(id_col).cast("bigint").alias("page_id"), rest.alias("_rest"))
    lowered = F.translate(F.regexp_extract("_rest", r"(?s)^([^/?#]*)", 1),
                          "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    parts = base.select("page_id", lowered.alias("host"),
                        F.regexp_extract("_rest", r"(?s)^[^/?#]*([^?#]*)", 1).alias("path"))
    return parts.mapInArrow(run, SCHEMA)


def op9_url_filter(spark, sf_dir):
    """Every page URL judged by the fixed rules, else by the spam globs (block) or the default (allow)."""
    return judge_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def _fits(host, path):
    return f"((host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{path}'))"


_ORDERED = sorted(RULES, key=lambda r: -len(r[1] + r[2]))
OP9_SQL = f"""
WITH u AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
           FROM pages),
p AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1, 's') AS path FROM u),
r AS (SELECT *, CASE {' '.join(f"WHEN {_fits(h, p)} THEN '{h}{p}'" for _, h, p in _ORDERED)} END AS rule FROM p)
SELECT page_id, host, path, rule,
       CASE {' '.join(f"WHEN rule = '{h}{p}' THEN '{v}'" for v, h, p in _ORDERED)}
            WHEN {' OR '.join(f"contains(host || path, '{g.strip('*')}')" for g in SPAM_GLOBS)} THEN 'block'
            ELSE 'allow' END AS verdict
FROM r
"""
