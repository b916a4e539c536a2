"""Byte-level BPE with a given rank table: encoding and decoding.

A text is cut by the pattern of the vocabulary; every piece is merged by itself.  A
segment tree over the byte positions of the piece holds the rank of the pair that
starts at each live position; the root gives the leftmost smallest one, and a merge
updates the leaves of the merged pair and its live neighbour, O(log n) each.  So a
piece of n bytes takes O(n log n), also where a text has no white space at all.

The rank table is read on the driver and broadcast (its size is that of the vocabulary,
whatever the data).  A worker remembers the ids of pieces it has met lately, up to a bound, in two
generations, so that common pieces outlast rare ones.
"""

from __future__ import annotations

import base64
import hashlib
import struct

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.llm.text import with_columns

NONE = 1 << 62
REMEMBERED_PIECES = 1 << 16
#: Characters of text that are encoded, and leave a worker, at a time.
OUT_BYTES = 1 << 20
REMEMBERED_BYTES = 64
#: Pieces of up to so many bytes are merged side by side, in matrices of about CELLS leaves.
SIDE_BY_SIDE = 256
CELLS = 1 << 16


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def merge_piece(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Token ids of one piece."""
    rank_of = ranks.get
    whole = rank_of(piece)
    if whole is not None:
        return [whole]
    n = len(piece)
    if n == 0:
        return []
    size = 1 << (n - 1).bit_length()
    # leaves: the rank of the pair that starts at each byte; the last byte starts none
    tree = [NONE] * size + [rank_of(piece[i : i + 2], NONE) for i in range(n - 1)] + [NONE] * (size - n + 1)
    for i in range(size - 1, 0, -1):
        a, b = tree[2 * i], tree[2 * i + 1]
        tree[i] = a if a <= b else b
    after = list(range(1, n + 1))  # start of the next live token
    before = list(range(-1, n - 1))
    while (least := tree[1]) != NONE:
        i = 1
        while i < size:
            i *= 2
            if tree[i] != least:
                i += 1
        i -= size
        j = after[i]
        k = after[i] = after[j]
        updates = [(j, NONE), (i, NONE)]
        if k < n:
            before[k] = i
            updates[1] = (i, rank_of(piece[i : after[k]], NONE))
        h = before[i]
        if h >= 0:
            updates.append((h, rank_of(piece[h:k], NONE)))
        for leaf, rank in updates:
            leaf += size
            tree[leaf] = rank
            leaf >>= 1
            while leaf:
                a, b = tree[2 * leaf], tree[2 * leaf + 1]
                if b < a:
                    a = b
                if tree[leaf] == a:
                    break
                tree[leaf] = a
                leaf >>= 1
    ids, i = [], 0
    while i < n:
        ids.append(ranks[piece[i : after[i]]])
        i = after[i]
    return ids


class Pairs:
    """Rank of every two adjacent tokens that make a token, looked up for arrays of ids."""

    def __init__(self, ranks: dict[bytes, int]):
        found = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    found[left << 32 | right] = rank
        self.keys = np.array(sorted(found), np.int64)
        self.ranks = np.array([found[k] for k in self.keys.tolist()], np.int64)

    def of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.full(len(left), NONE)
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NONE)


def merge_pieces(pieces: list[bytes], bytes_of: np.ndarray, pairs: Pairs) -> list[bytes]:
    """Ids (little-endian unsigned 32-bit) of pieces of at most ``size`` bytes each, all merged side by side.

    One row a piece: the same segment trees as in :func:`merge_piece`, as a matrix.  A round takes each
    piece's leftmost least pair and updates the paths of the merged start, the start that died and the live
    neighbour before; pieces without a pair left are done.  ``bytes_of``: ids of the 256 single bytes.
    """
    n = np.array([len(p) for p in pieces])
    size = 1 << max(1, int(n.max() - 1).bit_length())
    steps = size.bit_length() - 1
    flat = np.frombuffer(b"".join(p.ljust(size, b"\0") for p in pieces), np.uint8).reshape(len(pieces), size)
    place = np.arange(size)
    live = place < n[:, None]
    token = bytes_of[flat]
    after = np.broadcast_to(place + 1, token.shape).copy()
    before = np.broadcast_to(place - 1, token.shape).copy()
    tree = np.full((len(pieces), 2 * size), NONE)
    has = place[None, :-1] + 1 < n[:, None]
    tree[:, size : 2 * size - 1] = np.where(has, pairs.of(token[:, :-1].ravel(), token[:, 1:].ravel()).reshape(len(pieces), -1), NONE)
    for w in (size >> s for s in range(1, steps + 1)):
        tree[:, w : 2 * w] = np.minimum(tree[:, 2 * w : 4 * w : 2], tree[:, 2 * w + 1 : 4 * w : 2])
    row = np.flatnonzero(tree[:, 1] != NONE)
    while len(row):
        least = tree[row, 1]
        i = np.ones(len(row), np.int64)
        for _ in range(steps):
            i *= 2
            i += tree[row, i] != least
        i -= size
        j = after[row, i]
        k = after[row, j]
        token[row, i], after[row, i], live[row, j] = least, k, False
        more = k < n[row]
        before[row[more], k[more]] = i[more]
        h = before[row, i]
        some = h >= 0
        tree[row, size + j] = NONE
        tree[row, size + i] = np.where(more, pairs.of(least, token[row, np.minimum(k, size - 1)]), NONE)
        tree[row[some], size + h[some]] = pairs.of(token[row[some], h[some]], least[some])
        for leaf, r in ((j, row), (i, row), (h[some], row[some])):
            leaf = leaf + size
            for _ in range(steps):
                leaf >>= 1
                tree[r, leaf] = np.minimum(tree[r, 2 * leaf], tree[r, 2 * leaf + 1])
        row = row[tree[row, 1] != NONE]
    ids = token[live].astype("<u4").tobytes()
    ends = np.cumsum(live.sum(axis=1)) * 4
    return [ids[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]


class Codec:
    """Encodes texts to little-endian unsigned 32-bit ids and back."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex

        self.find = regex.compile(pattern).findall
        self.ranks = ranks
        self.tokens: list[bytes] = [b""] * (1 + max(ranks.values(), default=0))
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.pairs = Pairs(ranks)
        self.bytes_of = np.array([ranks.get(bytes([b]), -1) for b in range(256)], np.int64)
        # two generations: pieces met lately, and those of the generation before, which come back when met again
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _learn(self, pieces: set[str]) -> dict[str, bytes]:
        """Ids of pieces that the younger generation does not know; short ones are remembered."""
        out, left = {}, {}
        for p in pieces:
            ids = self.older.get(p)
            if ids is None:
                raw = p.encode("utf-8", "replace")
                rank = self.ranks.get(raw)
                if rank is None and 1 < len(raw) <= SIDE_BY_SIDE:
                    left.setdefault((len(raw) - 1).bit_length(), []).append((p, raw))
                    continue
                found = [rank] if rank is not None else merge_piece(raw, self.ranks)
                ids = struct.pack(f"<{len(found)}I", *found)
            out[p] = ids
        for bits, own in left.items():
            most = max(1, CELLS >> bits)
            for at in range(0, len(own), most):
                part = own[at : at + most]
                out.update(zip([p for p, _ in part], merge_pieces([raw for _, raw in part], self.bytes_of, self.pairs), strict=True))
        if len(self.known) + len(out) > REMEMBERED_PIECES:
            self.known, self.older = {}, self.known
        self.known.update((p, ids) for p, ids in out.items() if len(p) <= REMEMBERED_BYTES)
        return out

    def encode_all(self, texts: list[str]) -> list[bytes]:
        known = self.known.get
        pieces = [self.find(t) for t in texts]
        found = [list(map(known, own)) for own in pieces]
        new = self._learn({p for own, ids in zip(pieces, found, strict=True) if None in ids for p, i in zip(own, ids, strict=True) if i is None})
        return [b"".join([new[p] if i is None else i for p, i in zip(own, ids, strict=True)] if None in ids else ids) for own, ids in zip(pieces, found, strict=True)]

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]

    def decode(self, ids: bytes) -> bytes:
        tokens = self.tokens
        return b"".join([tokens[i] for i in np.frombuffer(ids, "<u4").tolist()])


def groups(texts, most: int):
    """``texts`` in turn, in lists of about ``most`` characters; a text is never cut."""
    own, held = [], 0
    for t in texts:
        own.append(t)
        held += len(t) + 16
        if held >= most:
            yield own
            own, held = [], 0
    if own:
        yield own


#: The worker's codec and what it was made for: one at a time, whatever queries a reused worker serves.
_CODEC: list = [None, None]


def codec_of(broadcast, pattern: str) -> Codec:
    """The worker's codec for a broadcast rank table."""
    key = (broadcast._jbroadcast.id() if broadcast._jbroadcast else broadcast._path or id(broadcast), pattern)
    if _CODEC[0] != key:
        _CODEC[:] = [key, Codec(broadcast.value, pattern)]
    return _CODEC[1]


def encode_expr(spark: SparkSession, ranks: dict[bytes, int], pattern: str, text: Column) -> Column:
    """Column expression: ids of ``text`` as little-endian unsigned 32-bit integers (binary)."""
    shared = spark.sparkContext.broadcast(ranks)

    @F.pandas_udf("binary")
    def encode(texts: pd.Series) -> pd.Series:
        codec = codec_of(shared, pattern)
        return pd.Series([ids for own in groups((t or "" for t in texts), OUT_BYTES) for ids in codec.encode_all(own)], dtype=object)

    return encode(text)


def decode_expr(spark: SparkSession, ranks: dict[bytes, int], pattern: str, ids: Column) -> Column:
    """Column expression: the bytes that the ids stand for (binary)."""
    shared = spark.sparkContext.broadcast(ranks)

    @F.pandas_udf("binary")
    def decode(blobs: pd.Series) -> pd.Series:
        codec = codec_of(shared, pattern)
        return pd.Series([codec.decode(b or b"") for b in blobs], dtype=object)

    return decode(ids)


def encode_documents(docs: DataFrame, vocabulary: str, pattern: str, text: str = "text") -> DataFrame:
    """``docs`` plus ids (binary) and n_tokens (long).

    Null and empty texts have no ids; repeated rows are encoded each; columns named
    like the added ones are replaced; an empty table gives an empty table.
    """
    ids = encode_expr(docs.sparkSession, read_ranks(vocabulary), pattern, F.col(text))
    out = with_columns(docs, {"ids": ids})
    return with_columns(out, {"n_tokens": (F.octet_length("ids") / 4).cast("long")})


def encode_and_decode(docs: DataFrame, vocabulary: str, pattern: str, text: str = "text") -> DataFrame:
    """``docs`` with n_tokens, ids (binary) and in place of ``text`` the text that the ids decode to, in one pass.

    One codec a worker; results leave it about OUT_BYTES of text at a time.  Null texts become empty; cases as in
    ``encode_documents``.
    """
    import pyarrow as pa

    shared = docs.sparkSession.sparkContext.broadcast(read_ranks(vocabulary))
    keep = [c for c in docs.columns if c != text and c.lower() not in ("ids", "n_tokens")]
    step = docs.select(*[F.col(f"`{c}`") for c in keep], F.coalesce(F.col(text).cast("string"), F.lit("")).alias(text))
    fields = step.select(*[F.col(f"`{c}`") for c in keep], F.lit(0).cast("long").alias("n_tokens"), F.lit(b"").alias("ids"), F.col(f"`{text}`")).schema

    def run(batches):
        codec = codec_of(shared, pattern)
        for batch in batches:
            begin = 0
            for own in groups((t.as_py() for t in batch.column(batch.num_columns - 1)), OUT_BYTES):
                ids = codec.encode_all(own)
                back = [codec.decode(i).decode() for i in ids]
                cols = [c.slice(begin, len(own)) for c in batch.columns[:-1]]
                cols += [pa.array([len(i) // 4 for i in ids], pa.int64()), pa.array(ids, pa.binary()), pa.array(back, pa.string())]
                yield pa.RecordBatch.from_arrays(cols, names=[*keep, "n_tokens", "ids", text])
                begin += len(own)

    return step.mapInArrow(run, fields)


def round_trip(docs: DataFrame, vocabulary: str, pattern: str, text: str = "text") -> DataFrame:
    """``docs`` plus n_tokens, ids_sha256 and decoded_sha256 of encoding and decoding ``text``.

    The digests are taken where the ids are, so that neither ids nor decoded bytes
    travel back; cases as in ``encode_documents``.
    """
    shared = docs.sparkSession.sparkContext.broadcast(read_ranks(vocabulary))

    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def digests(texts: pd.Series) -> pd.DataFrame:
        codec, rows = codec_of(shared, pattern), []
        for ids in (i for own in groups((t or "" for t in texts), OUT_BYTES) for i in codec.encode_all(own)):
            rows.append((len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(codec.decode(ids)).hexdigest()))
        return pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    out = docs.select(F.struct("*").alias("row"), digests(F.col(text)).alias("d"))
    flat = out.select(*[F.col("row").getField(c).alias(c) for c in docs.columns], F.col("d").alias("digests of text"))
    names = ("n_tokens", "ids_sha256", "decoded_sha256")
    return with_columns(flat, {k: F.col("`digests of text`").getField(k) for k in names}).drop("digests of text")
