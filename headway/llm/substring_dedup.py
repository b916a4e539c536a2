"""Substring deduplication by word windows, behind a count-min prefilter.

First pass: sketches of the hashes of all windows, merged bucket by bucket (``sketch``);
the estimates are never too small, so no repeated window is lost.  Second pass: only
windows estimated repeated are grouped exactly (by 96 bits of hash) to find the first
place of each.  A word goes if it is in a window that also starts earlier.

Equal windows of a chunk are asked about once, by their first place in it, so a
passage that a third of all documents hold costs its bucket one row for each chunk.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from headway.llm import sketch
from headway.llm.chunks import Chunk, Hasher, buckets_of, chunked, deltas, each, pack, rows, split_by, unpack
from headway.session import materialize

WINDOW = 20
ASK_SCHEMA = "bucket int, chunk long, asked binary"
ANSWER_SCHEMA = "chunk long, gone binary"
OUT_SCHEMA = "doc_id long, n_words long, n_removed long, n_spans long, kept string"
DIGEST_SCHEMA = "doc_id long, n_words long, n_removed long, n_spans long, kept_sha256 string"
_WORD, _FIRST, _SECOND = Hasher(201), Hasher(202), Hasher(203)


class Windows:
    """The word windows of a chunk: where they start (as words of the chunk) and their hashes."""

    def __init__(self, c: Chunk, window: int):
        self.chunk = c
        self.starts, self.ends, self.doc = c.words()
        self.words = _WORD.runs(_WORD.prefix(c.data), self.starts, self.ends)
        whole = self.doc[window - 1 :] == self.doc[: max(0, len(self.doc) - window + 1)]
        self.at = np.flatnonzero(whole)
        self.hash = _FIRST.sequences(self.words, window)[self.at]
        self.window = window

    def firsts(self, pick: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first, again): of the picked windows, the first place of each in document order, and the other places."""
        c = self.chunk
        by_id = np.argsort(c.ids, kind="stable")
        rank = np.empty(len(c), np.int64)
        rank[by_id] = np.arange(len(c))
        at = np.flatnonzero(pick)
        order = np.lexsort((self.at[at], rank[self.doc[self.at[at]]], self.hash[at]))
        h = self.hash[at][order]
        new = np.concatenate((np.ones(min(1, len(h)), bool), h[1:] != h[:-1]))
        return np.sort(at[order[new]]), at[order[~new]]


def _asks(window: int, buckets: int, width: int):
    def ask(chunk: pd.DataFrame, reply: pd.DataFrame) -> pd.DataFrame:
        out = []
        for row in chunk.to_dict("records"):
            w = Windows(Chunk(row), window)
            first, _ = w.firsts(sketch.estimated(reply, w.hash, buckets, width))
            second = _SECOND.sequences(w.words, window)[w.at[first]]
            order, at = split_by(((w.hash[first] >> np.uint64(20)) % np.uint64(buckets)).astype(np.uint32), buckets)
            for b in np.flatnonzero(np.diff(at)):
                own = order[at[b] : at[b + 1]]
                k = first[own]
                out.append({"bucket": b, "chunk": w.chunk.id, "asked": pack(w.hash[k], (second[own] >> np.uint64(32)).astype(np.uint32), deltas(k.astype(np.uint32)), w.chunk.ids[w.doc[w.at[k]]])})
        return rows(out, ["bucket", "chunk", "asked"])

    return ask


def _answer(pdf: pd.DataFrame) -> pd.DataFrame:
    """For each chunk, its windows that another chunk holds at an earlier place."""
    parts = [unpack(b, np.uint64, np.uint32, np.uint32, np.int64) for b in pdf["asked"]]
    h, h2 = (np.concatenate([p[i] for p in parts]) for i in (0, 1))
    place = np.concatenate([np.cumsum(p[2], dtype=np.uint32) for p in parts])
    doc = np.concatenate([p[3] for p in parts])
    chunk = np.repeat(pdf["chunk"].to_numpy(), [len(p[0]) for p in parts])
    order = np.lexsort((chunk, doc, h2, h))
    later = np.zeros(len(h), bool)
    same = (h[order][1:] == h[order][:-1]) & (h2[order][1:] == h2[order][:-1])
    later[order[1:][same]] = True
    out = []
    for c in np.unique(chunk[later]):
        out.append({"chunk": c, "gone": pack(deltas(np.sort(place[later & (chunk == c)])))})
    return rows(out, ["chunk", "gone"])


def _removed(w: Windows, reply: pd.DataFrame, gone: pd.Series, buckets: int, width: int) -> np.ndarray:
    """True for every word of the chunk that goes."""
    _, again = w.firsts(sketch.estimated(reply, w.hash, buckets, width))
    windows = np.concatenate([again, *[np.cumsum(unpack(b, np.uint32)[0], dtype=np.int64) for b in gone]]).astype(np.int64)
    step = np.zeros(len(w.doc) + 1, np.int64)
    np.add.at(step, w.at[windows], 1)
    np.add.at(step, w.at[windows] + w.window, -1)
    return np.cumsum(step[:-1]) > 0


def _kept(window: int, buckets: int, width: int, digest: bool):
    def keep(chunk: pd.DataFrame, other: pd.DataFrame) -> pd.DataFrame:
        frames = []
        for row in chunk.to_dict("records"):
            w = Windows(Chunk(row), window)
            c = w.chunk
            gone = _removed(w, other[other["gone"].isna()], other["gone"].dropna(), buckets, width)
            start = gone & np.concatenate((np.ones(min(1, len(gone)), bool), ~gone[:-1] | (w.doc[1:] != w.doc[:-1])))
            count = lambda v, w=w, c=c: np.bincount(w.doc[v], minlength=len(c)).astype(np.int64)
            at = np.searchsorted(w.doc, np.arange(len(c) + 1))
            raw, texts = c.data.tobytes(), []
            begins, ends = w.starts.tolist(), w.ends.tolist()
            for d in range(len(c)):
                text = b" ".join([raw[begins[i] : ends[i]] for i in (np.flatnonzero(~gone[at[d] : at[d + 1]]) + at[d]).tolist()])
                texts.append(hashlib.sha256(text).hexdigest() if digest else text.decode("utf-8"))
            frames.append(pd.DataFrame({"doc_id": pd.array(c.doc_ids(), "Int64"), "n_words": np.diff(at), "n_removed": count(gone), "n_spans": count(start), "kept": texts}))
        out = pd.concat(frames) if frames else pd.DataFrame(columns=["doc_id", "n_words", "n_removed", "n_spans", "kept"])
        return out.rename(columns={"kept": "kept_sha256"}) if digest else out

    return keep


def dedup_substrings(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, buckets: int | None = None, chunk_bytes: int | None = None, digest: bool = False
) -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_words, n_removed, n_spans (removed runs) and
    ``kept``, the kept words joined by one space (``digest``: kept_sha256 instead).

    Words are ``[^\\x20\\x09-\\x0D]+``.  A word goes if a window of ``window`` words that covers it
    also starts earlier: in a smaller id, or before it in the same text; windows are
    those of the input.

    Null and empty texts have no words and an empty result; fewer words than a window
    are kept; rows without an id come before all others; rows that share an id are
    ordered as they are stored; an empty table gives an empty table; other columns are
    left out.
    """
    b = buckets_of(docs.sparkSession, buckets)
    chunks = chunked(docs, "windows-chunks", doc_id, text, **({"chunk_bytes": chunk_bytes} if chunk_bytes else {}))
    width = sketch.width_for(chunks, b, 6.5)
    found = sketch.replies(chunks, lambda c: Windows(c, window).hash, b, width)
    reply = materialize(found, "windows-sketch", compression="uncompressed")
    asked = chunks.groupBy("chunk").cogroup(reply.groupBy("chunk")).applyInPandas(_asks(window, b, width), ASK_SCHEMA)
    answer = asked.groupBy("bucket").applyInPandas(_answer, ANSWER_SCHEMA)
    both = reply.unionByName(answer, allowMissingColumns=True)
    out = chunks.groupBy("chunk").cogroup(both.groupBy("chunk"))
    return out.applyInPandas(_kept(window, b, width, digest), DIGEST_SCHEMA if digest else OUT_SCHEMA)
