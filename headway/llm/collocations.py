"""Phrase collocations of every language by best-first growth with branch and bound.

A phrase of 2 to 5 words that occurs ``min_count`` times is scored by its weakest cut into two parts,
floor(1000 * a * n / (l * r)): a, l, r are the counts of the phrase and its parts, n that of all words of the language.

* Nodes are prefixes.  A phrase is no commoner than its rest after the first word (a <= r), so no phrase
  under the first word w scores above floor(1000 * n / f(w)): the count of the prefix bounds all that grows from it.
* The frontier holds first words in the order of that bound (rarest first).  A step takes the best part of
  the frontier, by share of the occurrences, and grows it word by word; only prefixes that are frequent grow on.
* A part of a phrase may begin with a word that has not been grown.  Those parts are counted by themselves,
  but only for phrases whose known cuts still reach the language's ``top``-th score.
* The search ends when no first word left has a bound that reaches the ``top``-th surviving score of its
  language; equal scores are grown as well, so ties are settled.
* Whether a longer phrase of the same count holds a phrase is known when it is counted: it must then always
  have the same word before or after it.  Counts carry the smallest and largest neighbour along.

Frequent words get ids, so keys are exact.  Texts are stored as chunks of one language, words as numbers of
a dictionary of the chunk; a scan emits each different phrase of a task once (as far as HELD_ROWS allow), and Spark adds up:
a phrase that holds a third of all places is one row a task.
Pairs that may be frequent (by a sketch that never counts too little), prefixes that may grow, and parts to be
counted, reach the scans as bit filters of fixed size (FILTER_BITS); a false positive is counted exactly like any
other and then dropped, so results do not depend on the size.
"""

from __future__ import annotations

import re
import sys

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from headway.llm.chunks import buckets_of, mix
from headway.session import materialize

MIN_COUNT, TOP, LONGEST = 100, 2000, 5
CHUNK_BYTES = 8 << 20
FILTER_BITS = 1 << 22
BLOCK = 1 << 13
#: Phrases that a scanning task holds before it sends them on.
HELD_ROWS = 1 << 20
#: Shares of the occurrences up to which the frontier is grown step by step, best bounds first; then what is left.
SHARES = (0.6,)
TOKEN = re.compile(rb"[^\x20\x09\x0A]+|\x0A")
#: A-Z to lower case, every character that ends a piece to a line feed.
_TABLE = bytearray(range(256))
_TABLE[0x41:0x5B] = bytes(range(0x61, 0x7B))
for _c in b".,;:!?\x0a\x0b\x0c\x0d":
    _TABLE[_c] = 0x0A
TABLE = bytes(_TABLE)
NO_WORD = -1

CHUNK_SCHEMA = "chunk long, lang string, n_words long, words array<binary>, counts array<long>, codes binary"


def _chunks(docs: DataFrame, lang: str, text: str, chunk_bytes: int) -> DataFrame:
    """Stored chunks: the words of whole texts of one language as codes of the chunk's dictionary; -1 between pieces."""
    from pyspark import TaskContext

    fields = pa.schema([("chunk", pa.int64()), ("lang", pa.string()), ("n_words", pa.int64()), ("words", pa.list_(pa.binary())), ("counts", pa.list_(pa.int64())), ("codes", pa.binary())])

    def pack(batches):
        part, seq, held = TaskContext.get().partitionId(), 0, 0
        texts: dict[str, list[bytes]] = {}

        def out(language):
            nonlocal seq
            tokens = np.array(TOKEN.findall(b"\n".join(texts.pop(language)).translate(TABLE)), object)
            codes, words = pd.factorize(tokens) if len(tokens) else (np.zeros(0, np.int64), tokens)
            codes, words = codes.astype(np.int32), list(words)
            if b"\n" in words:
                gap = words.index(b"\n")
                codes = np.where(codes == gap, NO_WORD, codes - (codes > gap)).astype(np.int32)
                del words[gap]
            counts = np.bincount(codes[codes >= 0], minlength=len(words))
            row = [[(part << 32) + seq], [language], [int(counts.sum())], [words], [counts.tolist()], [zstandard.compress(codes.tobytes(), 1)]]
            seq += 1
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(row, fields, strict=True)], schema=fields)

        for batch in batches:
            for language, t in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.large_binary()), strict=True):
                raw = t.as_py()
                texts.setdefault(language, []).append(raw)
                held += len(raw) + 64
                if held >= chunk_bytes:  # all languages together, so that many languages need no more memory
                    for k in list(texts):
                        yield out(k)
                    held = 0
        for k in list(texts):
            yield out(k)

    cols = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")), F.coalesce(F.col(text).cast("string"), F.lit("")))
    return materialize(cols.mapInArrow(pack, CHUNK_SCHEMA), "phrase-chunks")


ANSWER_SCHEMA = "chunk long, lang string, codes array<int>, ids array<long>, fs array<long>, words array<string>"


def _coded(chunks: DataFrame, min_count: int, buckets: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(words: lang, id, word, f of frequent words; totals: lang, n; coded: chunk, lang, data, n_codes, codes, ids, fs).

    Each chunk sends its dictionary once, dealt to buckets by word; a bucket adds up the counts, gives frequent words
    their ids and answers each chunk with what it knows of that chunk's words.
    """
    totals = materialize(chunks.groupBy("lang").agg(F.sum("n_words").alias("n")), "phrase-totals")

    def ask(batches):
        for batch in batches:
            for r in range(batch.num_rows):
                words = np.array(batch.column("words")[r].as_py(), object)
                counts = batch.column("counts")[r].values.to_numpy()
                bucket = (pd.util.hash_array(words, categorize=False) % np.uint64(buckets)).astype(np.int64) if len(words) else np.zeros(0, np.int64)
                order = np.argsort(bucket, kind="stable")
                bounds = np.searchsorted(bucket[order], np.arange(buckets + 1))
                own = np.flatnonzero(np.diff(bounds))
                parts = [order[bounds[b] : bounds[b + 1]] for b in own]
                cols = [[words[p].tolist() for p in parts], [counts[p].tolist() for p in parts], [p.tolist() for p in parts]]
                head = [own.tolist(), [batch.column("chunk")[r].as_py()] * len(own), [batch.column("lang")[r].as_py()] * len(own)]
                kinds = [pa.int32(), pa.int64(), pa.string(), pa.list_(pa.binary()), pa.list_(pa.int64()), pa.list_(pa.int32())]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip([*head, *cols], kinds, strict=True)], names=["bucket", "chunk", "lang", "words", "counts", "codes"])

    def answer(pdf: pd.DataFrame) -> pd.DataFrame:
        out, given = [], int(pdf["bucket"].iloc[0]) << 36
        for lang, own in pdf.sort_values(["lang", "chunk"]).groupby("lang"):
            size = own["words"].map(len).to_numpy()
            code, words = pd.factorize(np.concatenate(own["words"].to_numpy()))
            f = np.bincount(code, weights=np.concatenate(own["counts"].to_numpy()), minlength=len(words)).astype(np.int64)
            often = np.flatnonzero(f >= min_count)
            ids = np.full(len(words), NO_WORD, np.int64)
            ids[often] = given + np.arange(len(often))
            given += len(often)
            out.append((None, lang, None, ids[often].tolist(), f[often].tolist(), [words[i].decode() for i in often]))
            for chunk, codes, mine in zip(own["chunk"], own["codes"], np.split(code, np.cumsum(size)[:-1]), strict=True):
                known = ids[mine] >= 0
                if known.any():
                    out.append((chunk, lang, codes[known].tolist(), ids[mine][known].tolist(), f[mine][known].tolist(), None))
        return pd.DataFrame(out, columns=["chunk", "lang", "codes", "ids", "fs", "words"]).astype({"chunk": "Int64"})

    asked = chunks.select("chunk", "lang", "words", "counts").mapInArrow(ask, "bucket int, chunk long, lang string, words array<binary>, counts array<long>, codes array<int>")
    answers = materialize(asked.groupBy("bucket").applyInPandas(answer, ANSWER_SCHEMA), "phrase-answers")
    words = answers.where(F.col("chunk").isNull()).select("lang", F.explode(F.arrays_zip("ids", "words", "fs")).alias("w"))
    words = materialize(words.select("lang", F.col("w.ids").alias("id"), F.col("w.words").alias("word"), F.col("w.fs").alias("f")), "phrase-words")
    own = answers.where(F.col("chunk").isNotNull()).groupBy("chunk").agg(F.collect_list(F.struct("codes", "ids", "fs")).alias("known"))
    own = own.select("chunk", *[F.flatten(F.col("known").getField(c)).alias(c) for c in ("codes", "ids", "fs")])
    coded = chunks.select("chunk", "lang", F.col("codes").alias("data"), F.size("words").alias("n_codes")).join(own, "chunk")
    return words, totals, materialize(coded, "phrase-coded")


def slots(columns: list[np.ndarray], bits: int) -> np.ndarray:
    """Place of each row of ids in a bit filter."""
    h = np.full(len(columns[0]), len(columns), np.uint64)
    for c in columns:
        h = mix(h + np.uint64(0x9E3779B97F4A7C15) ^ c.astype(np.int64).view(np.uint64))
    return (h % np.uint64(bits)).astype(np.int64)


def _filter(phrases: DataFrame, m: int, bits: int) -> np.ndarray:
    """Bit filter of the first ``m`` ids of ``phrases`` (p: array of ids): at most bits / 8 bytes reach the driver."""

    def words(batches):
        for batch in batches:
            ids = batch.column(0).flatten().to_numpy()
            ids = ids.reshape(batch.num_rows, -1)[:, :m] if len(ids) else np.zeros((0, m), np.int64)
            at = np.unique(slots(list(ids.T), bits))
            yield pa.RecordBatch.from_arrays([pa.array((at >> 5).astype(np.int32)), pa.array(np.int64(1) << (at & 31))], names=["w", "bits"])

    found = phrases.select("p").mapInArrow(words, "w int, bits long").groupBy("w").agg(F.bit_or("bits").alias("bits"))
    rows = found.toPandas()  # at most bits / 32 numbers
    out = np.zeros(bits // 32, np.uint32)
    out[rows["w"].to_numpy(np.int64)] = rows["bits"].to_numpy(np.int64).astype(np.uint32)
    return out.view(np.uint8) if sys.byteorder == "little" else out.byteswap().view(np.uint8)


def _has(bits: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether each place is set; place 0 is the lowest bit of the first byte."""
    return (bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)


def _word_ids(batch, r: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(ids, counts, n) of the n words of a chunk; ids has one NO_WORD before and LONGEST + 1 after."""
    codes = np.frombuffer(zstandard.decompress(batch.column("data")[r].as_py()), np.int32)
    size = batch.column("n_codes")[r].as_py()
    at = batch.column("codes")[r].values.to_numpy()
    ids, fs = np.full(size + 1, NO_WORD, np.int64), np.zeros(size + 1, np.int64)
    ids[at], fs[at] = batch.column("ids")[r].values.to_numpy(), batch.column("fs")[r].values.to_numpy()
    w = np.concatenate(([NO_WORD], ids[codes], np.full(LONGEST + 1, NO_WORD)))  # code -1 takes the last entry
    return w, fs[codes], len(codes)


def _pairs_filter(active: DataFrame, min_count: int, cells: int) -> np.ndarray:
    """Bit filter of the pairs that may occur ``min_count`` times: one row of a count-min sketch, whose cells never
    count less than any pair in them.  A task keeps one sketch of fixed size and sends it in blocks."""

    def sketch(batches):
        total = np.zeros(cells, np.int64)
        for batch in batches:
            for r in range(batch.num_rows):
                w, f, n = _word_ids(batch, r)
                lo, hi = batch.column("lo")[r].as_py(), batch.column("hi")[r].as_py()
                at = np.flatnonzero((w[1 : n + 1] >= 0) & (w[2 : n + 2] >= 0) & (f > lo) & (f <= hi)) + 1
                total += np.bincount(slots([w[at], w[at + 1]], cells), minlength=cells)
        parts = np.minimum(total, (1 << 31) - 1).astype(np.int32).reshape(-1, 8 * BLOCK)
        own = np.flatnonzero(parts.any(axis=1))
        packed = [zstandard.compress(parts[b].view(np.uint8).reshape(-1, 4).T.tobytes(), 1) for b in own]
        yield pa.RecordBatch.from_arrays([pa.array(own, pa.int32()), pa.array(packed, pa.binary())], names=["b", "bits"])

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(8 * BLOCK, np.int64)
        for blob in pdf["bits"]:
            planes = np.frombuffer(zstandard.decompress(blob), np.uint8).reshape(4, -1)
            total += np.ascontiguousarray(planes.T).view(np.int32).ravel()
        return pd.DataFrame({"b": pdf["b"].iloc[:1], "bits": [np.packbits(total >= min_count, bitorder="little").tobytes()]})

    out = np.zeros(cells // 8, np.uint8)
    for r in active.mapInArrow(sketch, "b int, bits binary").groupBy("b").applyInPandas(merge, "b int, bits binary").toLocalIterator():
        out[r.b * BLOCK : r.b * BLOCK + BLOCK] = np.frombuffer(r.bits, np.uint8)
    return out


def _count(coded: DataFrame, m: int, min_count: int, bits: int, grown: np.ndarray | None, wanted: np.ndarray | None, name: str) -> DataFrame:
    """Stored (p, a, stays) of the frequent phrases of ``m`` words; stays: no longer phrase always holds it.

    ``coded`` carries lo and hi: phrases whose first word has a count in (lo, hi] are counted where their first
    m - 1 words are in ``grown`` (m = 2: where the pair is); or, with ``wanted``, those in it whatever their first word.
    """
    spark = coded.sparkSession
    held = spark.sparkContext.broadcast((grown, wanted))
    names = [*[f"w{i}" for i in range(m)], "c", "l0", "l1", "r0", "r1"]
    prefix = max(m - 1, 2)

    def combined(key, counts, sides):
        """Equal phrases added up: keys, counts and the smallest and largest neighbours."""
        order = np.lexsort(key[::-1])
        key, counts, sides = [k[order] for k in key], counts[order], [s[order] for s in sides]
        first = np.ones(len(order), bool)
        first[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in key])
        first = np.flatnonzero(first)
        ends = [f.reduceat(s, first) for s, f in zip(sides, (np.minimum, np.maximum, np.minimum, np.maximum), strict=True)]
        return [k[first] for k in key], np.add.reduceat(counts, first), ends

    def scan(batches):
        grown, wanted = held.value
        parts, size = [], 0  # what the chunks of the task have, combined when it is HELD_ROWS

        def joined():
            cols = [np.concatenate([x[i] for x in parts]) for i in range(m + 5)]
            key, counts, ends = combined(cols[:m], cols[m], cols[m + 1 :])
            return [*key, counts, *ends]

        for batch in batches:
            for r in range(batch.num_rows):
                w, f, n = _word_ids(batch, r)
                go = w[1 : n + 1] >= 0
                if wanted is None:
                    go &= (f > batch.column("lo")[r].as_py()) & (f <= batch.column("hi")[r].as_py())
                for i in range(1, m):
                    go &= w[1 + i : n + 1 + i] >= 0
                at = np.flatnonzero(go) + 1
                key = [w[at + i] for i in range(m)]
                keep = _has(grown, slots(key[:prefix], 8 * len(grown))) if wanted is None else _has(wanted, slots(key, bits))
                at, key = at[keep], [k[keep] for k in key]
                if not len(at):
                    continue
                before, after = w[at - 1], w[at + m]
                key, counts, ends = combined(key, np.ones(len(at), np.int64), [before, before, after, after])
                parts.append([*key, counts, *ends])
                size += len(counts)
                if size >= HELD_ROWS:
                    parts = [joined()]
                    size = len(parts[0][0])
                    if size >= HELD_ROWS // 2:
                        yield pa.RecordBatch.from_arrays([pa.array(c) for c in parts[0]], names=names)
                        parts, size = [], 0
        if parts:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in joined()], names=names)

    found = coded.mapInArrow(scan, ", ".join(f"{c} long" for c in names))
    total = found.groupBy(*names[:m]).agg(F.sum("c").alias("a"), F.min("l0").alias("l0"), F.max("l1").alias("l1"), F.min("r0").alias("r0"), F.max("r1").alias("r1")).where(F.col("a") >= min_count)
    inside = ((F.col("l0") == F.col("l1")) & (F.col("l0") >= 0)) | ((F.col("r0") == F.col("r1")) & (F.col("r0") >= 0))
    return materialize(total.select(F.array(*names[:m]).alias("p"), "a", (F.lit(m == LONGEST) | ~inside).alias("stays")), name)


def cut_score(a: str, n: str, left: str, right: str) -> Column:
    """floor(1000 * a * n / (l * r)) of columns, in decimals: exact for counts of up to 15 digits."""
    big = lambda c: f"cast(`{c}` as decimal(15,0))"
    return F.expr(f"(cast(1000 as decimal(4,0)) * {big(a)} * {big(n)}) div ({big(left)} * {big(right)})")


def _steps(words: DataFrame, shares: tuple) -> DataFrame:
    """(lang, cuts): for each share, the count up to which first words hold at most that share of their language's occurrences."""
    by_count = words.groupBy("lang", "f").agg(F.sum("f").alias("mass"))  # one row for each different count
    own = Window.partitionBy("lang")
    cum = by_count.select("lang", "f", (F.sum("mass").over(own.orderBy("f")) / F.sum("mass").over(own)).alias("upto"))
    cuts = [F.coalesce(F.max(F.when(F.col("upto") <= s, F.col("f"))), F.min("f")) for s in shares]
    return materialize(cum.groupBy("lang").agg(F.array(*cuts).alias("cuts")), "phrase-steps")


def _cuts(phrases: DataFrame, known: DataFrame, words: DataFrame, totals: DataFrame) -> DataFrame:
    """Every cut of surviving phrases: lang, n, p, a, k, l, r (null: not counted yet), rest, score."""
    own = words.select("lang", F.col("id").alias("w0"))
    base = phrases.where("stays").select("p", "a", F.get("p", F.lit(0)).alias("w0")).join(own, "w0").join(totals, "lang")
    cut = base.select("lang", "n", "p", "a", F.explode(F.sequence(F.lit(1), F.size("p") - 1)).alias("k"))
    cut = cut.select("*", F.expr("slice(p, 1, k)").alias("head"), F.expr("slice(p, k + 1, size(p) - k)").alias("rest"))
    head, rest = (known.select(F.col("p").alias(c), F.col("a").alias(x)) for c, x in (("head", "l"), ("rest", "r")))
    cut = cut.join(head, "head").join(rest, "rest", "left")
    return cut.select("lang", "n", "p", "a", "k", "l", "r", "rest", cut_score("a", "n", "l", "r").alias("score"))


def _weakest(cuts: DataFrame) -> DataFrame:
    """Phrases with the lowest of their known cuts: lang, n, p, a, l, r, score, open (whether a cut is not known)."""
    least = F.min(F.when(F.col("r").isNotNull(), F.struct("score", "k", "l", "r"))).alias("m")
    out = cuts.groupBy("lang", "n", "p", "a").agg(least, F.max(F.col("r").isNull()).alias("open"))
    return out.select("lang", "n", "p", "a", "m.l", "m.r", "m.score", "open")


def _reached(scored: DataFrame, totals: DataFrame, top: int) -> DataFrame:
    """(lang, reach): the ``top``-th score of every language; 0 where it has fewer phrases."""
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score")))  # partial top rows before the shuffle
    best = scored.select("lang", "score").select("lang", "score", place.alias("place")).where(F.col("place") <= top)
    last = best.groupBy("lang").agg(F.max("place").alias("have"), F.min("score").alias("least"))
    reach = F.when(F.col("have") >= top, F.col("least")).otherwise(F.lit(0)).cast("long")
    return totals.join(last, "lang", "left").select("lang", "n", F.coalesce(reach, F.lit(0)).alias("reach"))


def collocations(
    docs: DataFrame,
    lang: str = "lang",
    text: str = "text",
    min_count: int = MIN_COUNT,
    top: int = TOP,
    chunk_bytes: int = CHUNK_BYTES,
    bits: int = FILTER_BITS,
    shares: tuple = SHARES,
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the first ``top`` phrases of every language.

    A-Z is lower-cased; texts are split at ``[.,;:!?\\x0A-\\x0D]`` into pieces, those at ``[\\x20\\x09]+`` into words.  Phrases
    of 2 to 5 words that stand ``min_count`` times or more within pieces are candidates; those that always stand in one
    longer candidate are dropped.  Order: score descending, a descending, phrase ascending by its bytes; of equal
    cuts the one with the shorter first part counts.

    Null languages are ``und``; null, empty and blank texts have no words; repeated rows count as often as they occur;
    a language without candidates and an empty table give no rows; other columns are left out, whatever their names.
    ``chunk_bytes`` and ``bits`` (a power of two, at least 2^16) should grow with the corpus; results do not depend on them.
    """
    bits = max(bits, 8 * BLOCK)
    words, totals, coded = _coded(_chunks(docs, lang, text, chunk_bytes), min_count, buckets_of(docs.sparkSession))
    steps = _steps(words, shares)
    singles = words.select(F.array("id").alias("p"), F.col("f").alias("a"))
    tables, scored = [singles], None
    reach = totals.select("lang", "n", F.lit(0).cast("long").alias("reach"))
    limits = steps.select("lang", "cuts", F.lit(0).cast("long").alias("hi"))
    for step in range(len(shares) + 1):
        # a first word is grown while floor(1000 * n / f) reaches the score
        bound = F.when(F.col("reach") > 0, F.expr("(1000 * cast(n as decimal(20,0))) div reach")).otherwise(F.lit((1 << 63) - 1))
        share = F.get("cuts", F.lit(step)) if step < len(shares) else bound
        now = limits.join(reach, "lang").select("lang", "cuts", F.col("hi").alias("lo"), F.greatest("hi", F.least(share, bound)).cast("long").alias("hi"))
        limits = materialize(now, "phrase-limits")
        active = coded.join(limits.where("lo < hi").select("lang", "lo", "hi"), "lang")
        fresh, before = [], None
        for m in range(2, LONGEST + 1):
            grown = _pairs_filter(active, min_count, bits) if before is None else _filter(before, m - 1, bits)
            before = _count(active, m, min_count, bits, grown, None, f"phrase-{step}-{m}")
            fresh.append(before)
            if before.isEmpty():
                break
        tables += [t.select("p", "a") for t in fresh]
        phrases = _all(fresh)
        cuts = materialize(_cuts(phrases, _all(tables), words, totals), "phrase-cuts")
        weak = _weakest(cuts)
        settled = weak.where(~F.col("open")).drop("open")
        least = _reached(_with(scored, settled), totals, top).select("lang", "reach")
        missing = materialize(weak.where("open").join(least, "lang").where(F.col("score") >= F.col("reach")).select("p"), "phrase-open")
        parts = materialize(cuts.where(F.col("r").isNull()).join(missing, "p", "left_semi").select(F.col("rest").alias("p")).distinct(), "phrase-parts")
        counted = []
        for m in range(2, LONGEST):
            part = parts.where(F.size("p") == m)
            if not part.isEmpty():
                everywhere = coded.select("*", F.lit(0).cast("long").alias("lo"), F.lit(0).cast("long").alias("hi"))
                counted.append(_count(everywhere, m, min_count, bits, None, _filter(part, m, bits), f"phrase-{step}-part-{m}").select("p", "a").join(part, "p", "left_semi"))
        if counted:
            tables.append(materialize(_all(counted), "phrase-counted"))
            again = phrases.join(missing, "p", "left_semi")
            settled = settled.unionByName(_weakest(_cuts(again, _all(tables).dropDuplicates(["p"]), words, totals)).drop("open"))
            # phrases grown later are counted again; one count of each is enough
            tables = [materialize(_all(tables).dropDuplicates(["p"]), "phrase-known")]
        scored = materialize(_with(scored, settled), "phrase-scored")
        reach = materialize(_reached(scored, totals, top), "phrase-reach")

    best = scored.join(reach.select("lang", "reach"), "lang").where(F.col("score") >= F.col("reach")).drop("reach")
    name = best.select("p", F.posexplode("p").alias("i", "id")).join(words.select("id", "word"), "id")
    name = name.groupBy("p").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", "word"))), lambda x: x["word"]), " ").alias("phrase"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    out = best.join(name, "p").select("lang", F.row_number().over(order).cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
    return out.where(F.col("rank") <= top)


def _all(tables: list[DataFrame]) -> DataFrame:
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    return out


def _with(scored: DataFrame | None, settled: DataFrame) -> DataFrame:
    return settled if scored is None else scored.unionByName(settled)
