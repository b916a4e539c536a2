"""Benchmark decontamination with a generalised suffix automaton.

The automaton holds every run of words of the normalised benchmark items.  Document
words stream through it; at each word it knows the longest run ending there that
some item contains.  Runs of ``n`` words or more, and whole items that are shorter, are
hits: their spans are removed, and documents covered beyond a limit are rejected.

The benchmark is cut into blocks of bounded size by a hash of the item id; one block's
automaton at a time is broadcast, so its size has a bound that does not depend on the
number of items.  Documents never shuffle.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.llm.text import with_columns
from headway.session import materialize

#: Words of the letters and digits class, on lower-cased UTF-8 bytes.
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
BLOCK_WORDS = 1_000_000
FOUND = "n_words long, longest long, starts array<int>, ends array<int>, items array<string>"
NAMES = ["n_words", "longest", "starts", "ends", "items"]


def words_of(text: str | None) -> list[bytes]:
    return WORD.findall((text or "").encode("utf-8", "replace").lower())


class SuffixAutomaton:
    """Generalised suffix automaton of word sequences, with the items that hold each run."""

    def __init__(self, n: int):
        self.n = n
        self.to: list[dict[bytes, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        self.ends: dict[int, set[str]] = {}  # items that have a prefix ending in the state
        self.short: dict[int, list[tuple[int, str]]] = {}  # whole items of fewer than n words
        self._items: dict[int, frozenset[str]] = {}

    def _state(self, length: int, to: dict, link: int) -> int:
        self.to.append(to)
        self.link.append(link)
        self.length.append(length)
        return len(self.to) - 1

    def _split(self, p: int, w: bytes, q: int) -> int:
        """The state of the runs through ``p`` that end with ``w``, cut off from longer ones in ``q``."""
        if self.length[q] == self.length[p] + 1:
            return q
        c = self._state(self.length[p] + 1, dict(self.to[q]), self.link[q])
        while p >= 0 and self.to[p].get(w) == q:
            self.to[p][w] = c
            p = self.link[p]
        self.link[q] = c
        return c

    def _extend(self, last: int, w: bytes) -> int:
        q = self.to[last].get(w)
        if q is not None:
            return self._split(last, w, q)
        new = self._state(self.length[last] + 1, {}, 0)
        p = last
        while p >= 0 and w not in self.to[p]:
            self.to[p][w] = new
            p = self.link[p]
        if p >= 0:
            self.link[new] = self._split(p, w, self.to[p][w])
        return new

    def add(self, item: str, words: list[bytes]) -> None:
        last = 0
        for w in words:
            last = self._extend(last, w)

    def finish(self, items: list[tuple[str, list[bytes]]]) -> None:
        """Marks the states of every item once all have been added."""
        for item, words in items:
            v = 0
            for w in words:
                v = self.to[v][w]
                if len(words) >= self.n:
                    self.ends.setdefault(v, set()).add(item)
            if 0 < len(words) < self.n:
                self.short.setdefault(v, []).append((len(words), item))
        self.children: dict[int, list[int]] = {}
        for v in range(1, len(self.to)):
            self.children.setdefault(self.link[v], []).append(v)
        # nearest state with a whole short item, itself included
        self.near = [-1] * len(self.to)
        for v in sorted(range(1, len(self.to)), key=self.length.__getitem__):
            self.near[v] = v if v in self.short else self.near[self.link[v]]

    def items_with_window(self, v: int) -> frozenset[str]:
        """Items that hold the last n words of the runs in ``v`` (n words or more)."""
        while self.length[self.link[v]] >= self.n:
            v = self.link[v]
        if v not in self._items:
            found, stack = set(), [v]
            while stack:
                u = stack.pop()
                found |= self.ends.get(u, set())
                stack += self.children.get(u, ())
            self._items[v] = frozenset(found)
        return self._items[v]

    def scan(self, words: list[bytes]) -> tuple[int, list[int], list[int], set[str]]:
        """Longest match, hit spans [start, end) in words, items found."""
        to, link, length, near, n = self.to, self.link, self.length, self.near, self.n
        root = to[0]
        starts: list[int] = []
        ends: list[int] = []
        items: set[str] = set()
        v = l = longest = 0
        for i, w in enumerate(words):
            t = to[v].get(w)
            if t is None:
                if v:
                    v = link[v]
                    while v and w not in to[v]:
                        v = link[v]
                    l = length[v]
                    t = to[v].get(w)
                if t is None:
                    v = l = 0
                    continue
            v = t
            l += 1
            if l > longest:
                longest = l
            hit = 0
            if l >= n:
                hit = n
                items |= self.items_with_window(v)
            u = near[v]
            while u >= 0:
                for size, item in self.short[u]:
                    if size <= l:
                        hit = max(hit, size)
                        items.add(item)
                u = near[link[u]]
            if hit:
                a = i + 1 - hit
                while starts and ends[-1] >= a:  # joins spans that touch or overlap
                    a = min(a, starts.pop())
                    ends.pop()
                starts.append(a)
                ends.append(i + 1)
        return longest, starts, ends, items


def automaton(items: list[tuple[str, list[bytes]]], n: int) -> SuffixAutomaton:
    sam = SuffixAutomaton(n)
    for item, words in items:
        sam.add(item, words)
    sam.finish(items)
    return sam


def joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans that touch or overlap made one, in order."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and out[-1][1] >= a:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _scan_expr(spark, items: list[tuple[str, list[bytes]]], n: int, text: Column, before: Column | None) -> Column:
    """What the items' automaton finds in ``text``, with what earlier blocks have found."""
    shared = spark.sparkContext.broadcast(automaton(items, n))

    def found(texts: pd.Series) -> list[list]:
        rows = []
        for t in texts:
            words = words_of(t)
            longest, starts, ends, items = shared.value.scan(words)
            rows.append([len(words), longest, starts, ends, sorted(items)])
        return rows

    @F.pandas_udf(FOUND)
    def first(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame(found(texts), columns=NAMES)

    @F.pandas_udf(FOUND)
    def later(texts: pd.Series, had: pd.DataFrame) -> pd.DataFrame:
        rows = found(texts)
        for row, old in zip(rows, had.itertuples(index=False), strict=True):
            spans = joined([*zip(row[2], row[3], strict=True), *zip(old.starts.tolist(), old.ends.tolist(), strict=True)])
            row[1] = max(row[1], old.longest)
            row[2], row[3] = [x for x, _ in spans], [x for _, x in spans]
            row[4] = sorted({*row[4], *old.items})
        return pd.DataFrame(rows, columns=NAMES)

    return first(text) if before is None else later(text, before)


def _cut(texts: pd.Series, starts: pd.Series, ends: pd.Series) -> pd.Series:
    """Texts without the characters from the first to the last word of each span."""
    out = []
    for t, a, b in zip(texts, starts, ends, strict=True):
        if t is None or len(a) == 0:
            out.append(t)
            continue
        raw = t.encode("utf-8", "replace")
        at = [m.span() for m in WORD.finditer(raw.lower())]
        kept, upto = [], 0
        for i, j in zip(a, b, strict=True):
            kept.append(raw[upto : at[i][0]])
            upto = at[j - 1][1]
        out.append(b"".join([*kept, raw[upto:]]).decode("utf-8", "replace"))
    return pd.Series(out, dtype=object)


def scan_documents(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", n: int = 10, block_words: int = BLOCK_WORDS
) -> DataFrame:
    """``docs`` plus n_words, longest (longest match in words), n_hit (long), starts and ends
    (hit spans in words), items (ids as strings, sorted).

    Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z.  An item of fewer
    than ``n`` words, but not none, counts as a whole.  Null and empty texts have no
    words; an item without words is never found; items that share an id count as
    one; an empty benchmark finds nothing; columns of these names are replaced.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col(item_id).cast("string").alias("id"), F.col(item_text).alias("text")).where(F.col("text").isNotNull())
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // (4 * block_words)))
    out = docs.select(F.struct("*").alias("row"), F.col(text).alias("text"))
    for b in range(blocks):
        part = [(r["id"] or "", words_of(r["text"])) for r in items.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == b).toLocalIterator()]
        out = out.select("row", "text", _scan_expr(spark, part, n, F.col("text"), F.col("found") if b else None).alias("found"))
        if b + 1 < blocks:
            out = materialize(out, "decontaminate-block")
    flat = out.select(*[F.col("row").getField(c).alias(c) for c in docs.columns], F.col("found").alias("found in text"))
    f = F.col("`found in text`")
    hit = F.aggregate(F.zip_with(f["starts"], f["ends"], lambda a, b: b - a), F.lit(0).cast("long"), lambda acc, x: acc + x)
    return with_columns(flat, {**{k: f[k] for k in NAMES}, "n_hit": hit}).drop("found in text")


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text", max_coverage: float = 0.5, **how) -> DataFrame:
    """``docs`` with hit spans cut out of ``text``; documents with more than ``max_coverage``
    of their words hit are dropped.  Columns as in ``docs``; cases as in ``scan_documents``.
    """
    scanned = scan_documents(docs.select(F.struct("*").alias("row"), F.col(text).alias("text")), benchmark, "text", **how)
    kept = scanned.where(F.col("n_hit") <= max_coverage * F.col("n_words"))
    cut = kept.select("row", F.pandas_udf(_cut, "string")("text", "starts", "ends").alias("cut"))
    return cut.select(*[F.col("cut").alias(c) if c == text else F.col("row").getField(c).alias(c) for c in docs.columns])
