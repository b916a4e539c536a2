"""Language-model scoring by partial matching over bytes (PPM, escape method D).

The model is a trie of byte contexts of up to ORDER bytes with the counts of the bytes
that follow them in the training documents.  The probability of a byte is that of its
longest context that has seen it, (2n - 1) / 2T for n of T counted bytes; every longer
context that has not pays an escape, D / 2T for D distinct bytes; bytes that a longer
context has seen are excluded from the shorter ones.  Below order 0 the bytes left over are equally likely.
Texts are lower-cased (A-Z); the mark 0xFF, in no UTF-8 text, stands before a text as
context and after it as its end.

A byte's probability depends on its last ORDER bytes only, so a chunk asks once for each
distinct run of ORDER + 1 bytes in it.  Buckets are dealt by the last two context bytes:
all contexts of two bytes and more that a run falls back on are in its bucket, and
the rest of the trie, 256 x 256 counts, is broadcast.  The trie is never in one
place: it grows with the corpus over the buckets.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.llm.chunks import LOWER, MARK, PAD, Chunk, Hasher, bucket_of, buckets_of, chunked, counted, deltas, each, mix, pack, rows, split_by, unpack
from headway.session import materialize

ORDER = 5  # PAD marks before each text are its first context
ALPHABET = 256
STRIPE = 1 << 21
CHUNK_BYTES = 8 << 20
ASK = ["bucket", "kind", "chunk", "asked"]
ASK_SCHEMA = "bucket int, kind int, chunk long, asked binary"
ANSWER = ["chunk", "kind", "answer", "distinct"]
ANSWER_SCHEMA = "chunk long, kind int, answer binary, distinct long"
RUNS, WORDS = 0, 1


def lowered(c: Chunk) -> np.ndarray:
    return LOWER[c.data]


def coded_positions(c: Chunk) -> tuple[np.ndarray, np.ndarray]:
    """(first, one past the last) coded byte of each text; the last one is its end mark."""
    return c.starts, c.ends + 1


def runs_at(data: np.ndarray, a: int, b: int) -> np.ndarray:
    """The ORDER + 1 bytes that end at each position a <= i < b, as integers."""
    out = np.zeros(b - a, np.uint64)
    for k in range(ORDER, -1, -1):
        out <<= np.uint64(8)
        out |= data[a - k : b - k]
    return out


def coded(c: Chunk) -> np.ndarray:
    """Marks the coded positions of a chunk."""
    step = np.zeros(len(c.data) + 1, np.int8)
    a, b = coded_positions(c)
    step[a] += 1
    step[b] -= 1
    return np.cumsum(step[:-1], dtype=np.int8).astype(bool)


def run_counts(c: Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Distinct runs of a chunk and how often its training texts hold them."""
    data, is_coded = lowered(c), coded(c)
    train = np.repeat(c.flags, c.sizes + PAD)
    train = np.concatenate((train, np.zeros(PAD, bool)))
    train = np.roll(train, 1)  # an end mark belongs to the text before it
    keys, counts = [], []
    for a in range(PAD, len(data), STRIPE):
        b = min(len(data), a + STRIPE)
        own = is_coded[a:b]
        k = np.sort(runs_at(data, a, b)[own] << np.uint64(1) | train[a:b][own])
        first = np.flatnonzero(np.concatenate(([True], k[1:] != k[:-1])))
        n = np.diff(np.append(first, len(k)))
        k = k[first]
        keys.append(k >> np.uint64(1))
        counts.append(np.where(k & np.uint64(1), n, 0))
    if not keys:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return counted(np.concatenate(keys), np.concatenate(counts))


_HASH = Hasher(101)


def word_hashes(c: Chunk) -> tuple[np.ndarray, np.ndarray]:
    starts, ends, doc = c.words()
    return _HASH.runs(_HASH.prefix(lowered(c)), starts, ends), doc


def run_bucket(keys: np.ndarray, buckets: int) -> np.ndarray:
    return bucket_of(mix((keys >> np.uint64(8)) & np.uint64(0xFFFF) | np.uint64(1 << 40)), buckets)


def asks(chunks: DataFrame, buckets: int) -> DataFrame:
    def ask(batches):
        for c in each(batches):
            out = []
            words, doc = word_hashes(c)
            for kind, (keys, counts) in ((RUNS, run_counts(c)), (WORDS, counted(words, c.flags[doc].astype(np.int64)))):
                order, at = split_by(run_bucket(keys, buckets) if kind == RUNS else bucket_of(keys, buckets), buckets)
                for b in np.flatnonzero(np.diff(at)):
                    own = order[at[b] : at[b + 1]]
                    out.append({"bucket": b, "kind": kind, "chunk": c.id, "asked": pack(deltas(keys[own]), counts[own].astype(np.uint32))})
            yield rows(out, ASK)

    return chunks.mapInPandas(ask, ASK_SCHEMA)


def pair_counts(chunks: DataFrame) -> np.ndarray:
    """[byte, next byte] counts of the training texts: the trie's first two levels (256 x 256)."""

    def count(batches):
        total = np.zeros(ALPHABET * ALPHABET, np.int64)
        for c in each(batches):
            data, is_coded = lowered(c), coded(c)
            train = np.roll(np.concatenate((np.repeat(c.flags, c.sizes + PAD), np.zeros(PAD, bool))), 1)
            at = np.flatnonzero(is_coded & train)
            total += np.bincount(data[at - 1].astype(np.int64) * ALPHABET + data[at], minlength=len(total))
        at = np.flatnonzero(total)
        yield pd.DataFrame({"pair": at.astype(np.int32), "n": total[at]})

    out = np.zeros(ALPHABET * ALPHABET, np.int64)
    for r in chunks.mapInPandas(count, "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n")).collect():  # 65,536 rows at most
        out[r["pair"]] = r["n"]
    return out.reshape(ALPHABET, ALPHABET)


class Level:
    """The contexts of one order: symbol counts, and for each context T and D."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        self.keys, self.counts = counted(keys, counts)
        self.contexts, first = np.unique(self.keys >> np.uint64(8), return_index=True)
        self.first = first
        self.total = np.add.reduceat(self.counts, first) if len(first) else first
        self.distinct = np.diff(np.append(first, len(self.keys)))

    def count(self, keys: np.ndarray) -> np.ndarray:
        return _look(self.keys, self.counts, keys)

    def by_context(self, values: np.ndarray) -> np.ndarray:
        return np.add.reduceat(values, self.first) if len(self.first) else values[:0]

    def of(self, contexts: np.ndarray, values: np.ndarray) -> np.ndarray:
        return _look(self.contexts, values, contexts)


def _look(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The value of each wanted key; 0 where it is not there."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], 0)


def log_probabilities(asked: np.ndarray, keys: np.ndarray, counts: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """log10 probability of the last byte of each asked run after the others.

    ``keys`` and ``counts``: the trained runs with the same two bytes before the last as
    those asked for; ``pairs``: all pair counts.
    """
    mask = lambda k: np.uint64((1 << (8 * (k + 1))) - 1)
    levels = {ORDER: Level(keys, counts)}
    for k in range(ORDER - 1, 1, -1):
        levels[k] = Level(levels[k + 1].keys & mask(k), levels[k + 1].counts)
    single = pairs.sum(axis=0)
    codes = np.arange(ALPHABET * ALPHABET, dtype=np.uint64)
    seen = pairs.ravel() > 0
    levels[1] = Level(codes[seen], pairs.ravel()[seen])
    levels[0] = Level(codes[:ALPHABET][single > 0], single[single > 0])
    out = np.zeros(len(asked))
    open_ = np.ones(len(asked), bool)
    above_d = np.zeros(len(asked), np.int64)  # distinct bytes that longer contexts have seen
    above_t = np.zeros(len(asked), np.int64)  # how often this context has seen those
    for k in range(ORDER, -1, -1):
        level, q = levels[k], asked & mask(k)
        context = q >> np.uint64(8)
        n, t, d = level.count(q), level.of(context, level.total), level.of(context, level.distinct)
        left_d, left_t = d - above_d, t - above_t
        known = open_ & (n > 0)
        out[known] += np.log10((2 * n - 1)[known] / (2 * left_t)[known])
        open_ &= n == 0
        escape = open_ & (left_d > 0)
        out[escape] += np.log10(left_d[escape] / (2 * left_t)[escape])
        above_d = d
        if k:
            below = levels[k - 1]
            of_shorter = level.by_context(below.count(level.keys & mask(k - 1)))
            above_t = level.of(context, of_shorter)
    out[open_] -= np.log10(ALPHABET - np.count_nonzero(single))
    return out


def answers(asked: DataFrame, pairs: np.ndarray) -> DataFrame:
    shared = asked.sparkSession.sparkContext.broadcast(pairs)  # 512 KB, whatever the corpus

    def answer(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for kind, part in pdf.groupby("kind"):
            asked = [unpack(b, np.uint64, np.uint32) for b in part["asked"]]
            keys = [np.cumsum(step, dtype=np.uint64) for step, _ in asked]
            every, total = counted(np.concatenate(keys), np.concatenate([n for _, n in asked]).astype(np.int64))
            known = total > 0
            value = log_probabilities(every, every[known], total[known], shared.value).astype(np.float32) if kind == RUNS else total.astype(np.uint32)
            for i, (chunk, own) in enumerate(zip(part["chunk"], keys, strict=True)):
                out.append({"chunk": chunk, "kind": kind, "answer": pack(deltas(own), value[np.searchsorted(every, own)]), "distinct": int(known.sum()) if kind == WORDS and not i else 0})
        return rows(out, ANSWER)

    return asked.groupBy("bucket").applyInPandas(answer, ANSWER_SCHEMA)


def _together(part: pd.DataFrame, dtype) -> tuple[np.ndarray, np.ndarray]:
    """All keys of a chunk, sorted, and their answers."""
    had = [unpack(b, np.uint64, dtype) for b in part["answer"]]
    keys = np.concatenate([np.zeros(0, np.uint64), *[np.cumsum(step, dtype=np.uint64) for step, _ in had]])
    value = np.concatenate([np.zeros(0, dtype), *[v for _, v in had]])
    order = np.argsort(keys)
    return keys[order], value[order]


def _chunk_scores(chunk: pd.DataFrame, answered: pd.DataFrame) -> pd.DataFrame:
    frames = []
    for row in chunk.to_dict("records"):
        c = Chunk(row)
        keys, log_p = _together(answered[answered["kind"] == RUNS], np.float32)
        data, is_coded = lowered(c), coded(c)
        total = np.zeros(len(data) + 1)
        for a in range(PAD, len(data), STRIPE):
            b = min(len(data), a + STRIPE)
            codes, distinct = pd.factorize(runs_at(data, a, b)[is_coded[a:b]])
            value = np.zeros(b - a)
            value[is_coded[a:b]] = log_p[np.searchsorted(keys, distinct)].astype(np.float64)[codes]
            total[a + 1 : b + 1] = value
        total = np.cumsum(total)
        first, last = coded_positions(c)
        words, doc = word_hashes(c)
        keys, counts = _together(answered[answered["kind"] == WORDS], np.uint32)
        n = counts[np.searchsorted(keys, words)].astype(np.int64) if len(words) else np.zeros(0, np.int64)
        by_doc = lambda v, doc=doc, m=len(c): np.bincount(doc, v, m)
        frames.append(
            pd.DataFrame(
                {
                    "doc_id": pd.array(c.doc_ids(), "Int64"),
                    "learned": c.flags,
                    "n_words": by_doc(np.ones(len(doc))).astype(np.int64),
                    "n_known_words": by_doc(n > 0).astype(np.int64),
                    "log_counts": by_doc(np.log10(n + 1.0)),
                    "n_bytes": c.sizes,
                    "score": total[last] - total[first],
                }
            )
        )
    return pd.concat(frames) if frames else pd.DataFrame({"doc_id": [], "learned": [], "n_words": [], "n_known_words": [], "log_counts": [], "n_bytes": [], "score": []})


def score_documents(docs: DataFrame, learn: Column, doc_id: str = "doc_id", text: str = "text", buckets: int | None = None, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """One row for each row of ``docs``: doc_id, learned, n_tokens, n_known, train_tokens,
    n_bytes (long), base_score, score, bits_per_byte (double).

    The model learns from the rows where ``learn`` is true.  Tokens: lower-cased words
    and one end.  base_score: sum of log10((c + 1) / (N + V + 1)) over the tokens.  score:
    log10 probability of the lower-cased text and its end.

    Null and empty texts hold the end only; rows without an id or with an id that
    occurs again are scored each by itself; without training rows every byte has
    probability 1/256; an empty table gives an empty table; other columns are left out.
    """
    spark = docs.sparkSession
    b = buckets_of(spark, buckets)
    chunks = chunked(docs, "ppm-chunks", doc_id, text, learn, chunk_bytes)
    answered = materialize(answers(asks(chunks, b), pair_counts(chunks)), "ppm-answers", compression="zstd")
    distinct = answered.agg(F.sum("distinct")).first()[0] or 0
    scored = chunks.groupBy("chunk").cogroup(answered.groupBy("chunk")).applyInPandas(
        _chunk_scores, "doc_id long, learned boolean, n_words long, n_known_words long, log_counts double, n_bytes long, score double"
    )
    trained = train_size(chunks)
    ends, n = trained["texts"], trained["texts"] + trained["words"]
    v = distinct + (ends > 0)
    tokens = F.col("n_words") + 1
    return scored.select(
        "doc_id",
        "learned",
        tokens.alias("n_tokens"),
        (F.col("n_known_words") + (1 if ends else 0)).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        "n_bytes",
        (F.col("log_counts") + math.log10(ends + 1) - tokens * math.log10(n + v + 1)).alias("base_score"),
        "score",
        (-F.col("score") * math.log2(10) / (F.col("n_bytes") + 1)).alias("bits_per_byte"),
    )


def train_size(chunks: DataFrame) -> dict[str, int]:
    """Training texts and their words."""

    def count(batches):
        for c in each(batches):
            _, _, doc = c.words()
            yield pd.DataFrame({"texts": [int(c.flags.sum())], "words": [int(c.flags[doc].sum())]})

    r = chunks.mapInPandas(count, "texts long, words long").agg(F.sum("texts"), F.sum("words")).first()
    return {"texts": r[0] or 0, "words": r[1] or 0}


assert ORDER <= PAD and MARK == 0xFF
