"""Periodic runs of words, by an enhanced suffix array and its branching tandem repeats.

A run is a stretch of consecutive words with smallest period q that no neighbour extends.  Texts are
looked at whole, each by itself; a task works on blocks of texts in one suffix array:

1. A word of a run with exponent e occurs floor(e) times in it, so stretches between words that are rarer
   than that in their text are all that can hold a run.  Stretches are laid end to end; codes are made
   different between them, so nothing matches across.
2. Suffix array by prefix doubling; the ranks of every doubling are kept, which gives the common prefix
   of any two suffixes, also the LCP array of neighbours, by a descent through them.
3. Every boundary of the LCP array splits its LCP interval (previous and next smaller value) in two.  For
   each suffix i of the smaller side the inverse array is asked whether i + depth or i - depth stands on the
   other side.  If so, two equal words of length ``depth`` stand side by side and the next word differs: a branching
   tandem repeat.  No tree is built, only arrays; taking the smaller side makes it n log n questions.
4. Every run ends in one branching square of its period.  Squares are rotated to the left while the word
   before equals the last one of their first half; this gives the run's start.  Squares of a multiple of the period
   end at the same word and have the same extent: of these the smallest period stays.
"""

from __future__ import annotations

import hashlib
import re
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
MIN_WORDS, MIN_EXPONENT = 6, 4
#: Words of one suffix array, when texts are shorter than that; a text is never cut.
BLOCK_WORDS = 1 << 18
#: Bytes of text that a task hands to one block at most; again a text is never cut.
BLOCK_BYTES = 4 << 20
#: Questions asked at a time.
QUESTIONS = 1 << 21


class SuffixArray:
    """Suffix array, its inverse and LCP array of a code array, with common prefixes of any two suffixes."""

    def __init__(self, codes: np.ndarray):
        n = self.n = len(codes)
        rank = np.unique(codes, return_inverse=True)[1].astype(np.int32)
        self.ranks = [rank]  # ranks[k]: order of the first 2^k codes of every suffix
        self.order = np.argsort(rank, kind="stable").astype(np.int32)
        step = 1
        while n and int(rank.max()) + 1 < n:
            key = rank.astype(np.int64) * (n + 1)
            key[: n - step] += rank[step:] + 1
            self.order = np.argsort(key, kind="stable").astype(np.int32)
            sorted_key = key[self.order]
            new = np.empty(n, np.int32)
            new[self.order] = np.concatenate(([0], np.cumsum(sorted_key[1:] != sorted_key[:-1])))
            rank = new
            step *= 2
            self.ranks.append(rank)
        self.inverse = np.empty(n, np.int32)
        self.inverse[self.order] = np.arange(n, dtype=np.int32)
        #: lcp[k]: common prefix of the suffixes of rank k - 1 and k; 0 at both ends
        self.lcp = np.zeros(n + 1, np.int32)
        if n > 1:
            self.lcp[1:n] = self.common(self.order[:-1], self.order[1:])

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Length of the common prefix of suffixes i and j (different ones)."""
        i, j = i.astype(np.int64), j.astype(np.int64)
        out = np.zeros(len(i), np.int32)
        for k in range(len(self.ranks) - 1, -1, -1):
            at = np.flatnonzero(np.maximum(i, j) + (1 << k) <= self.n)
            at = at[self.ranks[k][i[at]] == self.ranks[k][j[at]]]
            i[at] += 1 << k
            j[at] += 1 << k
            out[at] += 1 << k
        return out


def intervals(lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each k in [1, n): first rank of the interval of lcp[k], and the rank after its last one.

    lcp has a 0 at both ends.  Of equal values the first one splits the whole interval, the next
    one what is left after it.
    """
    n = len(lcp) - 1
    left, right = [0] * (n + 1), [n] * (n + 1)
    values, stack = lcp.tolist(), []
    for k in range(1, n):
        v = values[k]
        while stack and values[stack[-1]] > v:
            right[stack.pop()] = k
        left[k] = stack[-1] if stack else 0
        stack.append(k)
    return np.array(left[1:n], np.int64), np.array(right[1:n], np.int64)


def squares(codes: np.ndarray, longest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, depth) of every branching tandem repeat whose depth is at most ``longest`` at its start."""
    none = np.zeros(0, np.int64)
    if len(codes) < 2:
        return none, none
    sa = SuffixArray(codes)
    k = np.arange(1, sa.n, dtype=np.int64)
    left, right = intervals(sa.lcp)
    depth = sa.lcp[1 : sa.n].astype(np.int64)
    go = (depth > 0) & (depth <= longest[sa.order[k]])  # both sides of a boundary lie in one stretch
    k, left, right, depth = k[go], left[go], right[go], depth[go]
    first = k - left <= right - k  # the smaller side: [left, k) or [k, right)
    a, b = np.where(first, left, k), np.where(first, k, right)
    c, d = np.where(first, k, left), np.where(first, right, k)
    starts, depths = [none], [none]
    upto = np.cumsum(b - a)
    at = 0
    while at < len(k):
        end = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + QUESTIONS, side="right")))
        size = (b - a)[at:end]
        which = np.repeat(np.arange(at, end), size)
        place = np.arange(len(which)) - np.repeat(np.cumsum(size) - size, size) + a[which]
        i, w = sa.order[place].astype(np.int64), depth[which]
        for j in (i + w, i - w):
            ok = (j >= 0) & (j < sa.n)
            r = sa.inverse[np.where(ok, j, 0)]
            hit = np.flatnonzero(ok & (r >= c[which]) & (r < d[which]))
            starts.append(np.minimum(i, j)[hit])
            depths.append(w[hit])
        at = end
    return np.concatenate(starts), np.concatenate(depths)


def _rotations(codes: np.ndarray, begin: int, i: int, w: int) -> int:
    """How far the square at i can be rotated to the left without passing ``begin``."""
    done, step = 0, 16
    while i - done > begin:
        n = min(step, i - done - begin)
        x, y = codes[i - done - n : i - done], codes[i + w - done - n : i + w - done]
        differ = np.flatnonzero(x != y)
        if len(differ):
            return done + n - 1 - int(differ[-1])
        done, step = done + n, step * 2
    return done


def runs_of(codes: np.ndarray, begins: np.ndarray, sizes: np.ndarray, min_words: int, min_exponent: int) -> np.ndarray:
    """Rows (start, length, period) of the runs of the stretches [begin, begin + size) of ``codes``, in order."""
    i, w = squares(codes, np.repeat(sizes // min_exponent, sizes))
    # a run of more than two periods goes on to the left of its last square; ask that before looking further
    begin = np.repeat(begins, sizes)
    back = max(min_exponent - 2, 0) * w
    far = i - back
    go = far >= begin[i] if len(i) else np.zeros(0, bool)
    i, w, far = i[go], w[go], far[go]
    near = i - (far < i)
    go = (codes[near] == codes[near + w]) & (codes[far] == codes[far + w])
    i, w = i[go], w[go]
    order = np.lexsort((w, i + 2 * w))
    found: list[tuple[int, int, int]] = []
    last = (-1, 0, 1)  # end, length and period of the run before
    for s, q in zip(i[order].tolist(), w[order].tolist(), strict=True):
        e = s + 2 * q
        if e == last[0] and q % last[2] == 0 and 2 * q <= last[1]:
            continue
        start = s - _rotations(codes, int(begin[s]), s, q)
        if e - start >= max(min_words, min_exponent * q):
            if not (found and last[0] == e and found[-1][0] == start):
                found.append((start, e - start, q))
                last = (e, e - start, q)
    return np.array(sorted(found), np.int64).reshape(-1, 3)


def block_runs(texts: list[np.ndarray], min_words: int = MIN_WORDS, min_exponent: int = MIN_EXPONENT) -> list[np.ndarray]:
    """For each array of word codes: its runs as rows (start, length, period), by start, then period."""
    stretch_codes, text_of, first = [], [], []
    for t, codes in enumerate(texts):
        if len(codes) < min_words:
            continue
        often = np.bincount(codes)[codes] >= min_exponent
        turn = np.flatnonzero(np.diff(np.concatenate(([False], often, [False]))))
        for a, b in zip(turn[::2].tolist(), turn[1::2].tolist(), strict=True):
            if b - a >= min_words:
                stretch_codes.append(codes[a:b])
                text_of.append(t)
                first.append(a)
    none = np.zeros((0, 3), np.int64)
    if not stretch_codes:
        return [none] * len(texts)
    sizes = np.array([len(s) for s in stretch_codes], np.int64)
    begins = np.cumsum(sizes) - sizes
    span = 1 + max(int(s.max()) for s in stretch_codes)
    codes = np.concatenate(stretch_codes).astype(np.int64) + np.repeat(np.arange(len(sizes)) * span, sizes)
    codes = np.unique(codes, return_inverse=True)[1].astype(np.int64)
    found = runs_of(codes, begins, sizes, min_words, min_exponent)
    own: list[list] = [[] for _ in texts]
    if len(found):
        which = np.searchsorted(begins, found[:, 0], side="right") - 1
        for s, (start, length, period) in zip(which.tolist(), found.tolist(), strict=True):
            own[text_of[s]].append((start - int(begins[s]) + first[s], length, period))
    return [np.array(sorted(o, key=lambda r: (r[0], r[2])), np.int64).reshape(-1, 3) if o else none for o in own]


def repeat_words(words: list[bytes], key: int) -> list[bytes]:
    """The words with a period laid over them, as told by the digits of ``key``; unchanged for nine keys of ten."""
    n, g = len(words), key // 10
    if key % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    unit = words[a : a + p]
    return words[:a] + (unit * (-(-(n - a) // p)))[: n - a]


def _digest(words: list[bytes], runs: np.ndarray) -> tuple:
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in runs.tolist())
    keep = words
    if len(runs):
        gone = np.zeros(len(words) + 1, np.int64)
        np.add.at(gone, runs[:, 0] + runs[:, 2], 1)
        np.add.at(gone, runs[:, 0] + runs[:, 1], -1)
        keep = [words[i] for i in np.flatnonzero(np.cumsum(gone[:-1]) == 0).tolist()]
    best = (None, None, None, None)
    if len(runs):
        # greatest length / period, compared without division; ties: smallest start, then period
        s, length, q = runs[0].tolist()
        for s2, l2, q2 in runs[1:].tolist():
            if l2 * q > length * q2:
                s, length, q = s2, l2, q2
        best = (s, length, q, 1000 * length // q)
    return (len(words), len(runs), *best, hashlib.sha256(listed.encode()).hexdigest(), b" ".join(keep), runs.ravel().tolist())


SCHEMA = "n_words long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed string, runs array<long>, collapsed_sha256 string"
_ARROW = pa.struct([(c, pa.int64()) for c in ("n_words", "n_runs", "start", "length", "period", "exponent_milli")] + [("runs_sha256", pa.string()), ("collapsed", pa.string()), ("runs", pa.list_(pa.int64())), ("collapsed_sha256", pa.string())])


def detect_runs(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    min_words: int = MIN_WORDS,
    min_exponent: int = MIN_EXPONENT,
    lay_periods: bool = False,
    texts: bool = True,
) -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_words, n_runs, start, length, period and exponent_milli of the
    run of greatest exponent, runs_sha256, collapsed, runs (start, length, period of each, flat) and collapsed_sha256.

    Words are ``[^\\x20\\x09-\\x0D]+`` of the whole text, numbered from 0.  A run has at least ``min_words`` words and
    ``min_exponent`` periods.  ``collapsed`` holds the words that no run contains after its first period, joined by one
    space (null unless ``texts``).  ``lay_periods`` first repeats words of one text in ten, chosen by crc32 of the id's
    decimal digits, as the contract of ``op13`` has it (rows without an id: unchanged).

    Null, empty and blank texts have no words and no runs; of runs of equal exponent the first start, then
    the smallest period counts; repeated rows are treated each; an empty table gives an empty table; other
    columns are left out, whatever their names.
    """

    def found(batches):
        for batch in batches:
            ids, blobs = batch.column(0), batch.column(1).cast(pa.large_binary())
            keys = batch.column(2).to_pylist()
            at = 0
            while at < len(blobs):
                held, codes, n, size = [], [], 0, 0
                begin = at
                while at < len(blobs) and n < BLOCK_WORDS and size < BLOCK_BYTES:
                    raw = blobs[at].as_py()
                    words = WORD.findall(raw)
                    if lay_periods and keys[at] is not None:
                        words = repeat_words(words, zlib.crc32(keys[at].encode()))
                    held.append(words)
                    codes.append(pd.factorize(np.array(words, object))[0] if words else np.zeros(0, np.int64))
                    n, size, at = n + len(words), size + len(raw), at + 1
                rows = []
                for words, runs in zip(held, block_runs(codes, min_words, min_exponent), strict=True):
                    row = _digest(words, runs)
                    sha = hashlib.sha256(row[7]).hexdigest()
                    rows.append((*row[:7], row[7].decode() if texts else None, row[8], sha))
                cols = [pa.array([r[c] for r in rows], f.type) for c, f in enumerate(_ARROW)]
                yield pa.RecordBatch.from_arrays([ids.slice(begin, at - begin), *cols], names=["doc_id", *[f.name for f in _ARROW]])

    step = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"), F.col(doc_id).cast("string").alias("key"))
    kind = step.schema["doc_id"].dataType.simpleString()
    return step.mapInArrow(found, f"doc_id {kind}, {SCHEMA}")
