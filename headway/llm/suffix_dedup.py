"""Suffix-array deduplication of byte strings of ``K`` bytes and more.

The suffixes of all texts are never sorted in one place.  Every K-byte window has an
anchor, its ANCHOR-byte run of smallest hash (the leftmost of equals); neighbouring
windows with the same anchor make one string.  Equal windows have equal anchors at
equal places, so two windows can only be equal if their strings have one anchor, and
then they stand in the same column, counted from the anchor.  Strings are dealt
by anchor; those of anchors that occur once (count-min sketch, ``sketch``) stay home.

Where strings of one anchor meet, their collection is built column by column from the
right: every round inserts one symbol of each string before its suffix, by a stable
sort by symbol of the order so far, and brings the Burrows-Wheeler column and
the longest common prefixes of neighbours up to date.  Suffixes of different columns
never need comparing, so a round costs its column, not the whole collection.  The
rounds read and replace one block for the column; the long-lived files (chunks,
sketch, strings, answers) are Spark's own, read in sequence.  Runs of neighbours with
a common prefix of K bytes or more are equal windows; the earliest stays.

Hot anchors: equal strings of a chunk are sent once.  Anchors that count HOT or more,
such as those at the edge of a passage that very many texts hold, would still bring
many different strings together; their windows are dealt one by one, by their own hash,
so that equal windows alone meet, one for each chunk.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from headway.llm import sketch
from headway.llm.chunks import Chunk, Hasher, bucket_of, buckets_of, chunked, deltas, each, pack, rows, split_by, unpack
from headway.session import materialize

K, ANCHOR = 100, 40
HOT = 2000
CHUNK_BYTES = 4 << 20
STRINGS, WINDOWS = 0, 1
ASK = ["bucket", "kind", "chunk", "asked", "bytes"]
ASK_SCHEMA = "bucket int, kind int, chunk long, asked binary, bytes binary"
ANSWER_SCHEMA = "chunk long, kind int, gone binary"
OUT_SCHEMA = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"
DIGEST_SCHEMA = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
_ONE, _TWO = Hasher(301), Hasher(302)
_PLACE = np.uint64(0xFFFFFFFF)


def anchored(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, prefix: np.ndarray, k: int, anchor: int):
    """(start, end, anchor) of the strings of all texts, as places in ``data``; and the anchors' hashes."""
    n = len(data)
    none = np.zeros(0, np.int64)
    if n < k:
        return none, none, none, np.zeros(0, np.uint64)
    at = np.arange(n - anchor + 1)
    least = _ONE.runs(prefix, at, at + anchor)
    least &= ~_PLACE
    least |= at.astype(np.uint64)
    have, want = 1, k - anchor + 1
    while have < want:
        step = min(have, want - have)
        least = np.minimum(least[:-step], least[step:])
        have += step
    place = (least & _PLACE).astype(np.int64)  # the anchor of the window at each position
    inside = np.zeros(len(place) + 1, np.int32)
    long = ends - starts >= k
    np.add.at(inside, starts[long], 1)
    np.add.at(inside, np.minimum(ends[long] - k + 1, len(place)), -1)
    inside = np.cumsum(inside[:-1]) > 0
    change = np.ones(len(place), bool)
    change[1:] = (place[1:] != place[:-1]) | (inside[1:] != inside[:-1])
    first = np.flatnonzero(change)
    last = np.append(first[1:], len(place))
    own = inside[first]
    first, last = first[own], last[own]
    a = place[first]
    return first, last - 1 + k, a, _ONE.runs(prefix, a, a + anchor)


class Strings:
    """The anchored strings of a chunk."""

    def __init__(self, c: Chunk, k: int, anchor: int):
        self.chunk, self.k = c, k
        self.prefix = _ONE.prefix(c.data)
        self.start, self.end, self.anchor, self.key = anchored(c.data, c.starts, c.ends, self.prefix, k, anchor)
        self.doc = np.searchsorted(c.ends, self.start, side="right")
        by_id = np.argsort(c.ids, kind="stable")
        self.rank = np.empty(len(c), np.int64)
        self.rank[by_id] = np.arange(len(c))

    def split(self, reply: pd.DataFrame, buckets: int, width: int) -> tuple[np.ndarray, np.ndarray]:
        """(strings to be compared, strings to be compared window by window)."""
        often = np.flatnonzero(sketch.estimated(reply, self.key, buckets, width))
        hot = sketch.estimated(reply, self.key[often], buckets, width, "hot")
        return often[~hot], often[hot]

    def firsts(self, at: np.ndarray, start: np.ndarray, hashes: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Indices into ``at`` of the first of each equal hash in document order, and of the others."""
        order = np.lexsort((start, self.rank[doc], hashes))
        h = hashes[order]
        new = np.concatenate((np.ones(min(1, len(h)), bool), h[1:] != h[:-1]))
        return np.sort(order[new]), order[~new]

    def strings(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        h = _ONE.runs(self.prefix, self.start[at], self.end[at])
        first, again = self.firsts(at, self.start[at], h, self.doc[at])
        return at[first], at[again]

    def windows(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Start, hash and text of the windows of the strings ``at``, and which are first (others again)."""
        count = self.end[at] - self.start[at] - self.k + 1
        start = np.repeat(self.start[at] - np.cumsum(count) + count, count) + np.arange(count.sum())
        h = _ONE.runs(self.prefix, start, start + self.k)
        first, again = self.firsts(start, start, h, np.repeat(self.doc[at], count))
        return start, h, first, again


def _asks(k: int, anchor: int, buckets: int, width: int):
    def ask(chunk: pd.DataFrame, reply: pd.DataFrame) -> pd.DataFrame:
        out = []
        for row in chunk.to_dict("records"):
            s = Strings(Chunk(row), k, anchor)
            c = s.chunk
            usual, hot = s.split(reply, buckets, width)
            first, _ = s.strings(usual)
            order, at = split_by(bucket_of(s.key[first], buckets), buckets)
            raw = c.data.tobytes()
            for b in np.flatnonzero(np.diff(at)):
                own = first[order[at[b] : at[b + 1]]]
                begin, end = s.start[own], s.end[own]
                asked = pack(s.key[own], c.ids[s.doc[own]], deltas(own.astype(np.uint32)), (end - begin).astype(np.uint32), (s.anchor[own] - begin).astype(np.uint32))
                text = b"".join([raw[i:j] for i, j in zip(begin.tolist(), end.tolist(), strict=True)])
                out.append({"bucket": b, "kind": STRINGS, "chunk": c.id, "asked": asked, "bytes": pack(np.frombuffer(text, np.uint8))})
            if len(hot):
                start, h, new, _ = s.windows(hot)
                h2 = _TWO.runs(_TWO.prefix(c.data), start, start + k)
                new = new[np.argsort(start[new], kind="stable")]
                doc = np.searchsorted(c.ends, start, side="right")
                order, at = split_by(bucket_of(h[new], buckets), buckets)
                for b in np.flatnonzero(np.diff(at)):
                    own = new[order[at[b] : at[b + 1]]]
                    asked = pack(h[own], h2[own], c.ids[doc[own]], deltas(start[own].astype(np.uint32)))
                    out.append({"bucket": b, "kind": WINDOWS, "chunk": c.id, "asked": asked, "bytes": None})
        return rows(out, ASK)

    return ask


def columns(text: np.ndarray, begin: np.ndarray, offset: np.ndarray, size: np.ndarray, group: np.ndarray, cap: int):
    """Column-wise construction of the collections of all groups, from the right.

    String i is text[begin : begin + size] with its anchor ``offset`` bytes in; groups are
    dealt in ascending order.  Yields for each column (counted from the anchor): the
    strings with a symbol there in the order of their suffixes, the Burrows-Wheeler
    column (the byte before each suffix, 0 at a string's start) and the common prefix
    of each suffix with the one before it in its group (up to ``cap``, else 0).
    """
    right = size - offset
    enter = np.argsort(-right, kind="stable")
    upto = np.searchsorted(-right[enter], -np.arange(int(right.max(initial=0)) + 2), side="right")  # of at least so many
    entered = 0
    order = np.zeros(0, np.int64)
    lcp = np.zeros(0, np.int32)
    if not len(begin):
        return
    for c in range(int(right.max()) - 1, -int(offset.max()) - 1, -1):
        more = int(upto[max(0, c + 1)])
        if more > entered:  # empty suffixes come first in their groups
            order = np.concatenate((np.sort(enter[entered:more]), order))
            lcp = np.concatenate((np.zeros(more - entered, np.int32), lcp))
            entered = more
            by_group = np.argsort(group[order], kind="stable")
            order, lcp = order[by_group], lcp[by_group]
        stay = np.flatnonzero(offset[order] >= -c)
        own = order[stay]
        symbol = text[begin[own] + offset[own] + c]
        key = group[own].astype(np.int64) << 8 | symbol
        new = np.argsort(key, kind="stable")
        was, key = stay[new], key[new]
        same = np.flatnonzero(key[1:] == key[:-1]) + 1
        a, b = was[same - 1] + 1, was[same] + 1
        common = lcp[b - 1].copy()
        far = np.flatnonzero(b - a > 1)
        if len(far):
            bounds = np.column_stack((a[far], b[far])).ravel()
            common[far] = np.minimum.reduceat(np.append(lcp, 0), bounds)[::2]
        order = own[new]
        lcp = np.zeros(len(order), np.int32)
        lcp[same] = np.minimum(common + 1, cap)
        before = np.where(offset[order] > -c, text[np.maximum(begin[order] + offset[order] + c - 1, 0)], 0)
        yield c, order, before, lcp


def repeated_windows(text, begin, offset, size, group, owner, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(string, window) of every window that a string with a smaller owner holds in its group."""
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    for c, order, _, lcp in columns(text, begin, offset, size, group, k):
        if not (lcp >= k).any():
            continue
        first = np.flatnonzero(lcp < k)
        least = np.minimum.reduceat(owner[order], first)
        later = order[owner[order] != np.repeat(least, np.diff(np.append(first, len(order))))]
        found.append((later, c + offset[later]))
    return tuple(np.concatenate([f[i] for f in found]) for i in (0, 1))


def _runs(string: np.ndarray, window: np.ndarray):
    """(string, first window, count) of maximal runs."""
    order = np.lexsort((window, string))
    string, window = string[order], window[order]
    new = np.concatenate((np.ones(min(1, len(string)), bool), (string[1:] != string[:-1]) | (window[1:] != window[:-1] + 1)))
    first = np.flatnonzero(new)
    return string[first], window[first], np.diff(np.append(first, len(string)))


def _answer_strings(pdf: pd.DataFrame, k: int) -> list[dict]:
    parts = [unpack(b, np.uint64, np.int64, np.uint32, np.uint32, np.uint32) for b in pdf["asked"]]
    key, doc, size, offset = (np.concatenate([p[i] for p in parts]) for i in (0, 1, 3, 4))
    name = np.concatenate([np.cumsum(p[2], dtype=np.uint32) for p in parts])
    chunk = np.repeat(pdf["chunk"].to_numpy(), [len(p[0]) for p in parts])
    size, offset = size.astype(np.int64), offset.astype(np.int64)
    text = np.concatenate([unpack(b, np.uint8)[0] for b in pdf["bytes"]])
    begin = np.cumsum(size) - size
    h1, h2 = (x.runs(x.prefix(text), begin, begin + size) for x in (_ONE, _TWO))
    by_place = np.lexsort((name, chunk, doc))
    place = np.empty(len(key), np.int64)
    place[by_place] = np.arange(len(key))
    order = np.lexsort((place, h2, h1, offset, key))
    fresh = np.ones(len(order), bool)
    for v in (key, offset, h1, h2):
        fresh[1:] &= v[order][1:] == v[order][:-1]
    fresh[1:] = ~fresh[1:]
    different, copies = order[fresh], order[~fresh]  # in the order of the anchors
    gone = [(copies, np.zeros(len(copies), np.int64), size[copies] - k + 1)]
    new_key = np.concatenate((np.ones(min(1, len(different)), bool), key[different][1:] != key[different][:-1]))
    group = np.cumsum(new_key) - 1
    several = np.bincount(group, minlength=1)[group] > 1 if len(group) else np.zeros(0, bool)
    own, group = different[several], group[several]
    s, w = repeated_windows(text, begin[own], offset[own], size[own], group, place[own], k)
    s, w, n = _runs(s, w)
    gone.append((own[s], w, n))
    string, window, count = (np.concatenate([g[i] for g in gone]) for i in range(3))
    out = []
    by_chunk = np.argsort(chunk[string], kind="stable")
    string, window, count = string[by_chunk], window[by_chunk], count[by_chunk]
    which, first = np.unique(chunk[string], return_index=True)
    bounds = np.append(first, len(string))
    for c, a, b in zip(which, bounds[:-1], bounds[1:], strict=True):
        out.append({"chunk": c, "kind": STRINGS, "gone": pack(name[string[a:b]], window[a:b].astype(np.uint32), count[a:b].astype(np.uint32))})
    return out


def _answer_windows(pdf: pd.DataFrame) -> list[dict]:
    parts = [unpack(b, np.uint64, np.uint64, np.int64, np.uint32) for b in pdf["asked"]]
    h, h2, doc = (np.concatenate([p[i] for p in parts]) for i in (0, 1, 2))
    start = np.concatenate([np.cumsum(p[3], dtype=np.uint32) for p in parts])
    chunk = np.repeat(pdf["chunk"].to_numpy(), [len(p[0]) for p in parts])
    order = np.lexsort((chunk, doc, h2, h))
    later = np.zeros(len(h), bool)
    later[order[1:][(h[order][1:] == h[order][:-1]) & (h2[order][1:] == h2[order][:-1])]] = True
    return [{"chunk": c, "kind": WINDOWS, "gone": pack(start[later & (chunk == c)])} for c in np.unique(chunk[later])]


def _answers(k: int):
    def answer(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(own := pdf[pdf["kind"] == STRINGS]):
            out += _answer_strings(own, k)
        if len(own := pdf[pdf["kind"] == WINDOWS]):
            out += _answer_windows(own)
        return rows(out, ["chunk", "kind", "gone"])

    return answer


def _removed(s: Strings, reply: pd.DataFrame, answer: pd.DataFrame, buckets: int, width: int) -> np.ndarray:
    """True for every byte of the chunk that goes."""
    usual, hot = s.split(reply, buckets, width)
    step = np.zeros(len(s.chunk.data) + 1, np.int64)

    def cut(start: np.ndarray, windows) -> None:
        np.add.at(step, start, 1)
        np.add.at(step, start + windows + s.k - 1, -1)

    _, again = s.strings(usual)
    cut(s.start[again], s.end[again] - s.start[again] - s.k + 1)
    for blob in answer[answer["kind"] == STRINGS]["gone"]:
        name, window, count = (x.astype(np.int64) for x in unpack(blob, np.uint32, np.uint32, np.uint32))
        cut(s.start[name] + window, count)
    if len(hot):
        start, _, _, more = s.windows(hot)
        cut(start[more], 1)
    for blob in answer[answer["kind"] == WINDOWS]["gone"]:
        cut(unpack(blob, np.uint32)[0].astype(np.int64), 1)
    return np.cumsum(step[:-1]) > 0


def _kept(k: int, anchor: int, buckets: int, width: int, digest: bool):
    def keep(chunk: pd.DataFrame, other: pd.DataFrame) -> pd.DataFrame:
        frames = []
        for row in chunk.to_dict("records"):
            s = Strings(Chunk(row), k, anchor)
            c = s.chunk
            gone = _removed(s, other[other["gone"].isna()], other[other["gone"].notna()], buckets, width)
            total = np.concatenate(([0], np.cumsum(gone)))
            begins = np.concatenate(([0], np.cumsum(gone & ~np.concatenate(([False], gone[:-1])))))
            texts = []
            for d in range(len(c)):
                text = c.text(d)
                if total[c.ends[d]] > total[c.starts[d]]:
                    text = text[~gone[c.starts[d] : c.ends[d]]]
                texts.append(hashlib.sha256(text).hexdigest() if digest else text.tobytes())
            frames.append(pd.DataFrame({"doc_id": pd.array(c.doc_ids(), "Int64"), "n_bytes": c.sizes, "n_removed": total[c.ends] - total[c.starts], "n_spans": begins[c.ends] - begins[c.starts], "kept": texts}))
        out = pd.concat(frames) if frames else pd.DataFrame(columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])
        return out.rename(columns={"kept": "kept_sha256"}) if digest else out

    return keep


def dedup_suffixes(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = K, anchor: int = ANCHOR, hot: int = HOT, buckets: int | None = None, chunk_bytes: int = CHUNK_BYTES, digest: bool = False
) -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_bytes, n_removed, n_spans (maximal removed runs)
    and ``kept``, the bytes left (``digest``: kept_sha256 instead).

    A byte of the UTF-8 text goes if a string of ``k`` bytes that covers it also starts
    earlier: in a smaller id, or before it in the same text (overlaps count).  Strings are
    those of the input and never cross texts.  ``anchor`` < ``k`` and ``hot`` change the work,
    not the result.

    Null and empty texts have no bytes; texts shorter than ``k`` are kept; rows without an
    id come before all others; rows that share an id are ordered as they are stored; an
    empty table gives an empty table; other columns are left out.
    """
    b = buckets_of(docs.sparkSession, buckets)
    chunks = chunked(docs, "suffix-chunks", doc_id, text, chunk_bytes=chunk_bytes)
    width = sketch.width_for(chunks, b, 0.5 * (k - anchor + 2))
    found = sketch.replies(chunks, lambda c: Strings(c, k, anchor).key, b, width, hot)
    reply = materialize(found, "suffix-sketch", compression="uncompressed")
    asked = chunks.groupBy("chunk").cogroup(reply.groupBy("chunk")).applyInPandas(_asks(k, anchor, b, width), ASK_SCHEMA)
    answer = asked.groupBy("bucket").applyInPandas(_answers(k), ANSWER_SCHEMA)
    both = reply.unionByName(answer, allowMissingColumns=True)
    out = chunks.groupBy("chunk").cogroup(both.groupBy("chunk"))
    return out.applyInPandas(_kept(k, anchor, b, width, digest), DIGEST_SCHEMA if digest else OUT_SCHEMA)
