"""Near-duplicate groups by HyperMinHash sketches, banding and exact verification.

1. A document's set holds its distinct 5-word shingles.  Equal sets are one node.
2. Sketch: a shingle's hash picks one of REGISTERS registers; a register keeps, of the
   smallest hash it has seen, the number of leading zeros and MANTISSA bits after them
   (16 bits in all).
3. Bands of ROWS registers are hashed; nodes that share a band are candidates.  Sets of
   few shingles, which one differing shingle can part in every band, also meet by
   the smallest hashes that any set as similar must share (prefix filter, exact).
4. The Jaccard similarity of a candidate pair is estimated from equal registers, less
   the equal ones expected by chance, and pairs clearly under the threshold go.
5. The others are verified on their full sets; components of the verified links follow.

No bucket emits its pairs.  First every node of a bucket is held against the bucket's
smallest node only, which joins nearly all copies of a group.  Buckets that then hold
nodes of more than one component are dealt out in blocks of bounded size.  Blocks carry
prints, 16 bits of every shingle, whose matches are never fewer than the shingles two sets
share; so pairs are settled where they meet, and only those whose prints meet the threshold
go on, each from the bucket of the first band it shares: first as many as join the components
of a lot, then all that are left across components.  So no link that bands and sketches show
is lost, and none inside a component is looked at twice.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.llm.chunks import LOWER, MARK, PAD, SPACE, Hasher, mix
from headway.session import materialize

SHINGLE = 5
THRESHOLD = 75  # per cent: 100 * intersection >= THRESHOLD * union
REGISTERS, MANTISSA = 128, 10
ROWS = 4
#: Sets of up to so many shingles meet every set that meets the threshold with them.
SMALL = 16
EMPTY = 0xFFFF
BLOCK = 1024
LOT = 10_000
#: Pairs of a lot that are looked at side by side.
PAIRS = 1 << 14
#: Shingles up to which all of a set have a print; larger sets halve by hash until so many are left.
PRINTS = 1024
STRIPE = 1 << 20
#: Deviations of the estimate under the threshold at which a pair is still verified.
DEVIATIONS = 5.0
#: Share of registers equal by chance for large sets of one size, times 2^MANTISSA (published constant).
CHANCE = 0.169919487159739093975315012348
_WORD, _SHINGLE, _PRINT = Hasher(501), Hasher(502), Hasher(503)


def shingle_sets(texts):
    """Sorted distinct 64-bit shingle hashes of each text, in turn; empty for null and blank ones.

    Texts are hashed STRIPE bytes at a time, so memory does not follow the batch.
    """
    raws, held = [], 0
    for t in texts:
        raws.append((t or "").encode("utf-8", "replace"))
        held += len(raws[-1])
        if held >= STRIPE:
            yield from _sets(raws)
            raws, held = [], 0
    if raws:
        yield from _sets(raws)


def _sets(raws: list[bytes]) -> list[np.ndarray]:
    data = LOWER[np.frombuffer(b"".join([b"\xff" * PAD + r for r in raws]) + b"\xff" * PAD, np.uint8)]
    ends = np.cumsum([len(r) + PAD for r in raws])
    space = SPACE[data]
    turn = np.flatnonzero(space[1:] != space[:-1]) + 1
    starts, stops = turn[::2], turn[1::2]
    words = _WORD.runs(_WORD.prefix(data), starts, stops)
    first = np.searchsorted(starts, ends - [len(r) for r in raws])
    last = np.append(first[1:], len(words))
    grams = _SHINGLE.sequences(words, SHINGLE)
    out = []
    for a, b in zip(first.tolist(), last.tolist(), strict=True):
        if b - a >= SHINGLE:
            out.append(np.unique(grams[a : b - SHINGLE + 1]))
        elif b > a:
            out.append(_SHINGLE.sequences(words[a:b], b - a) ^ np.uint64(b - a))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def registers(shingles: np.ndarray) -> np.ndarray:
    """The sketch of a set of sorted hashes; EMPTY where no hash falls."""
    out = np.full(REGISTERS, EMPTY, np.uint16)
    bits = REGISTERS.bit_length() - 1
    at = (shingles >> np.uint64(64 - bits)).astype(np.int64)
    first = np.flatnonzero(np.concatenate((np.ones(min(1, len(at)), bool), at[1:] != at[:-1])))
    rest = (shingles[first] << np.uint64(bits)) >> np.uint64(11)  # 53 bits, exact as a double
    top = np.frexp(rest.astype(np.float64))[1]
    mantissa = np.where(top > MANTISSA + 1, rest >> np.maximum(top - MANTISSA - 1, 0).astype(np.uint64), rest) & np.uint64((1 << MANTISSA) - 1)
    out[at[first]] = ((53 - top).astype(np.uint64) << np.uint64(MANTISSA) | mantissa).astype(np.uint16)
    return out


def band_hashes(sketches: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(a hash of each band, whether it has a register in use) of rows of sketches."""
    rows = sketches.reshape(len(sketches), -1, ROWS)
    code = rows.astype(np.uint64) @ np.array([1 << (16 * i) for i in range(ROWS)], np.uint64)
    return mix(code + np.arange(1, rows.shape[1] + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)), (rows != EMPTY).any(axis=-1)


def band_keys(sketch: np.ndarray) -> np.ndarray:
    """A hash of each band that has a register in use."""
    keys, used = band_hashes(sketch[None])
    return keys[used]


def first_shared(keys: np.ndarray, used: np.ndarray, bucket: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Whether the bucket that shows rows x and y is that of the first band they share, or they share none."""
    same = (keys[x] == keys[y]) & used[x]
    return ~same.any(axis=1) | (keys[x, same.argmax(axis=1)] == bucket[x])


def prints(shingles: np.ndarray) -> np.ndarray:
    """Level, number of prints that the next level keeps, and 16 bits of each of the sorted hashes that begin with ``level`` zero bits."""
    level, kept = 0, shingles
    while len(kept) > PRINTS:
        level += 1
        kept = kept[: np.searchsorted(kept, np.uint64(1 << (64 - level)))]
    half = np.searchsorted(kept, np.uint64(1 << (63 - level)))
    return np.concatenate(([level, half], kept & np.uint64(0xFFFF))).astype(np.uint16)


def resembling(held: list[np.ndarray], x: np.ndarray, y: np.ndarray, threshold: int) -> tuple[np.ndarray, np.ndarray]:
    """(similarity, whether the pair is to be verified) of rows x and y by their prints.

    Equal shingles have equal prints, so the similarity is never under that of the (halved) sets: no pair of
    level 0 that meets the threshold is left out.  Halved sets are samples and have the estimate's deviations.
    """
    level = np.array([p[0] for p in held], np.int64)
    both, size = np.full(len(x), np.inf), np.full(len(x), np.inf)  # pairs further apart than a level are verified
    table = np.zeros(1 << 16, np.int64)
    order = np.argsort(x, kind="stable")
    for own in np.split(order, np.flatnonzero(np.diff(x[order])) + 1) if len(x) else []:
        i = x[own[0]]
        gap = level[y[own]] - level[i]
        for g in (-1, 0, 1):
            at = own[gap == g]
            if not len(at):
                continue
            mine = held[i][2 : 2 + int(held[i][1])] if g > 0 else held[i][2:]
            theirs = [held[j][2 : 2 + int(held[j][1])] if g < 0 else held[j][2:] for j in y[at].tolist()]
            value, count = np.unique(mine, return_counts=True)
            table[value] = count
            sizes = np.array([len(t) for t in theirs])
            upto = np.concatenate(([0], np.cumsum(table[np.concatenate(theirs)])))
            ends = np.cumsum(sizes)
            table[value] = 0
            both[at] = np.minimum(upto[ends] - upto[ends - sizes], np.minimum(sizes, len(mine)))
            size[at] = len(mine) + sizes - both[at]
    far = np.isinf(size)
    sim = np.where(far, 1.0, both / np.where(far, 1.0, np.maximum(size, 1)))
    t = threshold / 100
    halved = np.maximum(level[x], level[y]) > 0
    slack = DEVIATIONS * np.sqrt(t * (1 - t) / np.maximum(size, 1))
    return sim, far | np.where(halved, sim >= t - slack, 100 * both >= threshold * size)


def prefix_keys(shingles: np.ndarray, threshold: int) -> np.ndarray:
    """Keys of a small set of sorted hashes, one of which every set shares that meets the threshold with it; none of larger sets.

    Such a pair has at least ceil(threshold * n / 100) of the n hashes in common, so its smallest
    common hash is one of the first n + 1 less that many of either set.
    """
    n = len(shingles)
    if n * threshold > 100 * SMALL:  # too large to be the like of a small set
        return np.zeros(0, np.uint64)
    return mix(shingles[: n + 1 - max(1, -(-threshold * n // 100))] ^ _PRINT.value[8])


def estimates(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Collision-corrected Jaccard estimate of rows of sketches, and the registers in use."""
    used = ((a != EMPTY) | (b != EMPTY)).sum(axis=-1)
    equal = ((a == b) & (a != EMPTY)).sum(axis=-1)
    r = n_a / np.maximum(n_b, 1)
    chance = CHANCE / (1 << MANTISSA) * 4 * r / (1 + r) ** 2
    return np.maximum(0.0, (equal - chance * (used - equal)) / np.maximum(used, 1)), used


def likely(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, threshold: int) -> tuple[np.ndarray, np.ndarray]:
    """(estimate, whether the pair is to be verified)."""
    est, used = estimates(a, b, n_a, n_b)
    t = threshold / 100
    slack = DEVIATIONS * np.sqrt(t * (1 - t) / np.maximum(used, 1))
    close = 100 * np.minimum(n_a, n_b) >= threshold * np.maximum(n_a, n_b)
    return est, close & (est >= t - slack)


def _sketch_column(text: Column, threshold: int) -> Column:
    @F.pandas_udf("n long, node binary, regs binary, few array<long>")
    def sketch(texts: pd.Series) -> pd.DataFrame:
        out = []
        for s in shingle_sets(texts):
            a, b = np.uint64(len(s)), np.uint64(0)
            if len(s):
                a, b = np.bitwise_xor.reduce(s) + a, mix(s ^ _PRINT.value[7]).sum(dtype=np.uint64)
            out.append((len(s), np.array([a, b], ">u8").tobytes() if len(s) else None, registers(s).tobytes(), prefix_keys(s, threshold).view(np.int64)))
        return pd.DataFrame(out, columns=["n", "node", "regs", "few"])

    return sketch(text)


def _prints(text: Column) -> Column:
    @F.pandas_udf("binary")
    def held(texts: pd.Series) -> pd.Series:
        return pd.Series([prints(s).tobytes() for s in shingle_sets(texts)], dtype=object)

    return held(text)


def _bands(regs: Column) -> Column:
    @F.pandas_udf("array<long>")
    def bands(blobs: pd.Series) -> pd.Series:
        return pd.Series([band_keys(np.frombuffer(b, np.uint16)).view(np.int64) for b in blobs], dtype=object)

    return bands(regs)


def _likely(threshold: int, *cols: str) -> Column:
    @F.pandas_udf("est double, go boolean")
    def held(a: pd.Series, b: pd.Series, n_a: pd.Series, n_b: pd.Series) -> pd.DataFrame:
        stack = lambda s: np.frombuffer(b"".join(s), np.uint16).reshape(len(s), REGISTERS)
        est, go = likely(stack(a), stack(b), n_a.to_numpy(), n_b.to_numpy(), threshold)
        return pd.DataFrame({"est": est, "go": go})

    return held.asNondeterministic()(*cols)  # or a filter on it has it evaluated twice, in two workers a task


def _linked(threshold: int, a: str, b: str) -> Column:
    """Whether two texts meet the threshold on their full sets."""

    @F.pandas_udf("boolean")
    def linked(x: pd.Series, y: pd.Series) -> pd.Series:
        out, had = [], (None, None)
        for s, t in zip(x, y, strict=True):
            if had[0] != s:
                had = (s, *shingle_sets([s]))
            u, (v,) = had[1], shingle_sets([t])
            both = np.intersect1d(u, v, assume_unique=True).size
            out.append(bool(len(u) and len(v) and 100 * both >= threshold * (len(u) + len(v) - both)))
        return pd.Series(out, dtype=bool)

    return linked(a, b)


def components(edges: DataFrame, name: str = "components", most_rounds: int = 60) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b): the smallest node of its component.

    Alternating large-star and small-star steps; every round is a stored table.
    """
    e = materialize(edges.select("a", "b").where(F.col("a") != F.col("b")).distinct(), name)
    had = None
    for _ in range(most_rounds):
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # stored, so that both sides of the join come from a shuffle and a hub's edges can be split
        least = materialize(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), name)
        large = both.join(least, "a").where((F.col("b") > F.col("a")) & (F.col("b") != F.col("m"))).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # every edge of large goes from a node to a smaller one
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        e = materialize(small.select("e.a", "e.b").where(F.col("a") != F.col("b")).distinct(), name)
        now = tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == had or not now[0]:
            return e.select(F.col("a").alias("node"), F.col("b").alias("root"))
        had = now
    raise RuntimeError("components did not settle")


def _with_text(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    out = pairs
    for side in ("b", "a"):
        t = texts.select(F.col("node").alias(side), F.col("text").alias(f"text_{side}"))
        out = out.join(t, side)
    return out


def _verified(pairs: DataFrame, texts: DataFrame, threshold: int) -> DataFrame:
    return materialize(_with_text(pairs.select("a", "b"), texts).where(_linked(threshold, "text_a", "text_b")).select("a", "b"), "near-links")


def _across(members: DataFrame, threshold: int, every: bool) -> DataFrame:
    """(a, b) of pairs across components that their prints put at the threshold, in the buckets of ``members``
    (key, g, node, root, n, regs, prints); without ``every``: no more than join the components of a lot.

    A bucket of g members is dealt in ceil(g / BLOCK) blocks; every two blocks meet, in at
    most 2 * BLOCK rows.  Python gets such meetings by the lot, about LOT rows at a time.
    """
    blocks = F.ceil(F.col("g") / BLOCK).cast("int")
    own = members.select("*", blocks.alias("k"), F.pmod(F.hash("node"), blocks).alias("own"))
    dealt = own.select("*", F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("other"))
    dealt = dealt.select("key", "node", "root", "n", "regs", "prints", "own", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"))
    size = members.agg(F.sum(F.ceil(F.col("g") / BLOCK))).first()[0] or 0
    lots = max(1, int(size) // LOT)

    def meet(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["key", "p", "q"], kind="stable", ignore_index=True)
        regs = np.frombuffer(b"".join(pdf["regs"]), np.uint16).reshape(len(pdf), REGISTERS)
        held = [np.frombuffer(b, np.uint16) for b in pdf["prints"]]
        keys, used = band_hashes(regs)
        bucket = pdf["key"].to_numpy(np.int64).view(np.uint64)
        n, block = pdf["n"].to_numpy(), pdf["own"].to_numpy()
        root = pd.factorize(pdf["root"].map(bytes))[0]
        new = np.flatnonzero(pdf[["key", "p", "q"]].ne(pdf[["key", "p", "q"]].shift()).any(axis=1).to_numpy())
        one_block = (pdf["p"] == pdf["q"]).to_numpy()
        joined = np.arange(len(pdf))  # of each root the one it has been joined with; without ``every`` only
        found: list[tuple[np.ndarray, np.ndarray]] = []

        def settle(pairs):
            nonlocal joined
            x, y = (np.concatenate([p[k] for p in pairs]) for k in (0, 1))
            go = joined[root[x]] != joined[root[y]]
            go &= one_block[x] | (block[x] != block[y])
            go &= 100 * np.minimum(n[x], n[y]) >= threshold * np.maximum(n[x], n[y])
            x, y = x[go], y[go]
            go = first_shared(keys, used, bucket, x, y)
            x, y = x[go], y[go]
            go = likely(regs[x], regs[y], n[x], n[y], threshold)[1]
            x, y = x[go], y[go]
            sim, go = resembling(held, x, y, threshold)
            x, y, sim = x[go], y[go], sim[go]
            if not every and len(x):
                own = joined.tolist()

                def top(r):
                    while own[r] != r:
                        own[r] = own[own[r]]
                        r = own[r]
                    return r

                taken = []
                for i in np.argsort(-sim, kind="stable").tolist():
                    a, b = top(root[x[i]]), top(root[y[i]])
                    if a != b:
                        own[a] = b
                        taken.append(i)
                x, y = x[taken], y[taken]
                joined = np.array(own)
                while (joined[joined] != joined).any():
                    joined = joined[joined]
            found.append((x, y))

        size, pairs = 0, []
        for a, b in zip(new.tolist(), [*new[1:].tolist(), len(pdf)], strict=True):
            if (root[a:b] == root[a]).all():
                continue
            step = max(1, PAIRS // (b - a))
            for at in range(a, b, step):
                x, y = np.triu_indices(min(step, b - at), 1, b - at)
                pairs.append((x + at, y + at))
                size += len(x)
                if size >= PAIRS:
                    settle(pairs)
                    size, pairs = 0, []
        if pairs:
            settle(pairs)
        none = np.zeros(0, np.int64)
        x, y = (np.concatenate([none, *[f[k] for f in found]]) for k in (0, 1))
        nodes, roots = pdf["node"].to_numpy(), pdf["root"].to_numpy()
        swap = np.array([bytes(roots[u]) > bytes(roots[v]) for u, v in zip(x, y, strict=True)], bool)
        x, y = np.where(swap, y, x).astype(np.int64), np.where(swap, x, y).astype(np.int64)
        return pd.DataFrame({"a": nodes[x], "b": nodes[y]})

    lot = F.pmod(F.xxhash64("key", "p", "q"), F.lit(lots))
    return dealt.groupBy(lot.alias("lot")).applyInPandas(meet, "a binary, b binary").distinct()


def _groups(docs: DataFrame, doc_id: str, text: str, threshold: int) -> tuple[DataFrame, DataFrame]:
    """(sketched rows: id, th, n, node, regs; roots: node, root)."""
    step = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).select("id", F.xxhash64("text").alias("th"), _sketch_column(F.col("text"), threshold).alias("s"))
    rows = materialize(step.select("id", "th", "s.n", "s.node", "s.regs", "s.few"), "near-sketches")
    nodes = rows.where(F.col("n") > 0).groupBy("node").agg(F.first("n").alias("n"), F.first("regs").alias("regs"), F.first("few").alias("few"))
    nodes = materialize(nodes, "near-nodes")
    bands = nodes.select("node", F.explode(F.concat(_bands(F.col("regs")), "few")).alias("key"))
    buckets = materialize(bands.groupBy("key").agg(F.count(F.lit(1)).alias("g"), F.min("node").alias("lead")).where(F.col("g") > 1), "near-buckets")
    members = materialize(bands.join(buckets, "key"), "near-members")

    own = nodes.select(F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("regs").alias("regs_b"))
    lead = nodes.select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("regs").alias("regs_a"))
    pairs = members.where(F.col("node") != F.col("lead")).select(F.col("lead").alias("a"), F.col("node").alias("b")).distinct()
    held = pairs.join(own, "b").join(lead, "a").select("a", "b", _likely(threshold, "regs_a", "regs_b", "n_a", "n_b").alias("e"))
    stars = materialize(held.select("a", "b", "e.est", "e.go").where("go").select("a", "b", "est"), "near-stars")

    # texts of the nodes that share a bucket, one for each node
    busy = members.select("node").distinct()
    one = rows.where(F.col("n") > 0).groupBy("node").agg(F.min(F.struct("id", "th")).alias("r")).join(busy, "node").select("node", "r.id", "r.th")
    one = materialize(one, "near-busy")
    t = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"), F.xxhash64(text).alias("th")).alias("t")
    texts = t.join(one.alias("o"), F.col("t.id").eqNullSafe(F.col("o.id")) & (F.col("t.th") == F.col("o.th"))).select("node", "text").dropDuplicates(["node"])
    texts = materialize(texts, "near-texts", compression="zstd")

    best = stars.groupBy("b").agg(F.max_by("a", F.struct("est", "a")).alias("a"))
    links = _verified(best, texts, threshold)
    roots = components(links, "near-roots")

    la, lb = (roots.select(F.col("node").alias(x), F.col("root").alias(f"r{x}")) for x in "ab")
    left = stars.join(best.select("b", F.col("a").alias("had")), "b").where(F.col("a") != F.col("had"))
    left = left.join(la, "a", "left").join(lb, "b", "left").where(F.coalesce("ra", "a") != F.coalesce("rb", "b"))
    links, roots = _more(links, roots, _verified(left, texts, threshold))

    tried = stars.select("a", "b").union(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))  # or in one component
    # a bucket's smallest node has been held against all others
    others = members.where((F.col("g") > 2) & (F.col("node") != F.col("lead")))
    held = None
    for every in (False, True):
        m = others.join(roots, "node", "left").select("key", "g", "node", F.coalesce("root", "node").alias("root"))
        mixed = m.groupBy("key").agg(F.min("root").alias("x"), F.max("root").alias("y")).where(F.col("x") != F.col("y")).select("key")
        mixed = materialize(mixed, "near-mixed")
        if mixed.isEmpty():
            break
        m = materialize(m.join(mixed, "key"), "near-meeting")
        if held is None:  # components only grow, so the second time has no other nodes
            own = nodes.select("node", "n", "regs").join(texts, "node").join(m.select("node").distinct(), "node", "left_semi")
            held = materialize(own.select("node", "n", "regs", _prints(F.col("text")).alias("prints")), "near-prints")
        left = _across(m.join(held, "node"), threshold, every).join(tried, ["a", "b"], "left_anti")
        links, roots = _more(links, roots, _verified(left, texts, threshold))
    return rows, roots


def _more(links: DataFrame, roots: DataFrame, new: DataFrame) -> tuple[DataFrame, DataFrame]:
    if new.isEmpty():
        return links, roots
    links = links.union(new)
    return links, components(links, "near-roots")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: int = THRESHOLD) -> DataFrame:
    """One row for each row of ``docs``: doc_id, text_hash, n_shingles, component_id, kept.

    Shingles are 5 lower-cased (A-Z) words ``[^\\x20\\x09-\\x0D]+``; a text of fewer words has the
    whole sequence as one.  Texts are linked when 100 * intersection >= threshold * union
    of their sets; component_id is the smallest id that links reach; kept: it is the row's
    own id.

    Null and blank texts have no shingles and are linked with nothing; equal sets are
    linked; rows without an id take the component's id and are kept only where no
    row of the component has one; rows that share an id and a component are all kept or
    all dropped; an empty table gives an empty table; other columns are left out.
    """
    rows, roots = _groups(docs, doc_id, text, threshold)
    own = rows.join(roots, "node", "left").select("id", "th", "n", F.coalesce("root", "node").alias("root"))
    own = materialize(own, "near-rooted")
    least = materialize(own.where(F.col("n") > 0).groupBy("root").agg(F.min("id").alias("component_id")), "near-least")
    out = own.join(least, "root", "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id"))
    return out.select(
        F.col("id").alias("doc_id"),
        F.col("th").alias("text_hash"),
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
    )


def drop_near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: int = THRESHOLD) -> DataFrame:
    """The kept rows of ``docs``, with all their columns; cases as in ``near_duplicates``."""
    kept = near_duplicates(docs, doc_id, text, threshold).where("kept").select(F.col("doc_id").alias("kept id"), F.col("text_hash").alias("kept th"))
    kept = materialize(kept.distinct(), "near-kept")
    return docs.join(kept, docs[doc_id].eqNullSafe(kept["kept id"]) & (F.xxhash64(docs[text]) == kept["kept th"]), "left_semi")


assert MARK == 0xFF and EMPTY > (53 << MANTISSA | (1 << MANTISSA) - 1)
