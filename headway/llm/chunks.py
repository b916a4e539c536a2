"""Documents packed into chunks, and hashing of their words and bytes with numpy.

Operators that ask the whole corpus about every word window or byte context would
shuffle a row for each.  They work on chunks instead: a chunk row holds the texts of
some documents; a task reads a chunk, asks about its *distinct* keys, one small binary
array for each bucket of keys; Spark groups the arrays by bucket, each bucket answers
every chunk with one array; and the chunk meets its answers again by its id.  So equal
keys are combined before the shuffle, and however often a key occurs, a bucket sees
it once for each chunk at most.

The chunk table is stored, so that ids and row order stay as they are when a task runs
again after an executor is lost.  ``chunk_bytes`` should grow with the corpus (some
hundred MB on hundreds of TB): asks are chunks x buckets rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.session import materialize

CHUNK_BYTES = 4 << 20
#: Bytes that stand before each text and after the last; 0xFF is in no UTF-8 text.
PAD = 8
MARK = 0xFF
NO_ID = -(2**63)

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E), MARK]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

CHUNK_SCHEMA = "chunk long, n_bytes long, ids binary, flags binary, sizes binary, data binary"


def chunked(docs: DataFrame, name: str, doc_id: str = "doc_id", text: str = "text", flag: Column | None = None, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Stored chunks of (doc_id, text, flag); null ids are NO_ID, null texts empty.

    ``data``: each text as UTF-8 after PAD marks, and PAD marks at the end, compressed.  A text is
    never cut: a chunk holds whole texts, one at least.
    """
    import pyarrow as pa
    from pyspark import TaskContext

    def pack(batches):
        part, seq = TaskContext.get().partitionId(), 0
        rows: list[tuple[int, int, bytes]] = []
        held = 0

        def out():
            data = bytearray()
            for _, _, t in rows:
                data += b"\xff" * PAD + t
            data += b"\xff" * PAD
            cols = [
                np.array([r[0] for r in rows], np.int64).tobytes(),
                np.array([r[1] for r in rows], np.uint8).tobytes(),
                np.array([len(r[2]) for r in rows], np.int64).tobytes(),
                zstandard.compress(bytes(data), 1),
            ]
            numbers = [pa.array([(part << 32) + seq], pa.int64()), pa.array([len(data)], pa.int64())]
            return pa.RecordBatch.from_arrays([*numbers, *[pa.array([c], pa.binary()) for c in cols]], names=["chunk", "n_bytes", "ids", "flags", "sizes", "data"])

        for batch in batches:
            texts = batch.column(2).cast(pa.large_binary())
            for i, f, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts, strict=True):
                raw = t.as_py()
                rows.append((i, f, raw))
                held += len(raw)
                if held >= chunk_bytes:
                    yield out()
                    seq, rows, held = seq + 1, [], 0
        if rows:
            yield out()

    cols = docs.select(
        F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID)),
        (F.lit(0) if flag is None else F.coalesce(flag, F.lit(False)).cast("int")),
        F.coalesce(F.col(text).cast("string"), F.lit("")),
    )
    return materialize(cols.mapInArrow(pack, CHUNK_SCHEMA), name, compression="uncompressed")


def buckets_of(spark: SparkSession, buckets: int | None = None) -> int:
    """Number of key buckets: four for each shuffle partition unless given."""
    return buckets or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))


class Chunk:
    """One chunk row: arrays over its documents and bytes."""

    def __init__(self, row):
        self.id = int(row["chunk"])
        self.ids = np.frombuffer(row["ids"], np.int64)
        self.flags = np.frombuffer(row["flags"], np.uint8).astype(bool)
        self.sizes = np.frombuffer(row["sizes"], np.int64)
        self.data = np.frombuffer(zstandard.decompress(row["data"]), np.uint8)
        ends = np.cumsum(self.sizes + PAD)
        self.starts = ends - self.sizes  # first byte of each text
        self.ends = ends

    def __len__(self) -> int:
        return len(self.ids)

    def text(self, d: int) -> np.ndarray:
        return self.data[self.starts[d] : self.ends[d]]

    def doc_ids(self) -> list[int | None]:
        return [None if i == NO_ID else int(i) for i in self.ids]

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(starts, ends, doc) of the words ``[^\\x20\\x09-\\x0D]+``, in order."""
        space = SPACE[self.data]
        turn = np.flatnonzero(space[1:] != space[:-1]) + 1  # data begins and ends with marks
        starts, ends = turn[::2], turn[1::2]
        return starts, ends, np.searchsorted(self.ends, starts, side="right")


def each(batches):
    """Chunks of the pandas batches of a mapInPandas function."""
    for batch in batches:
        for row in batch.to_dict("records"):
            yield Chunk(row)


def mix(h: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on every bit of ``h`` (a 64-bit finaliser)."""
    h = h.copy()
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


class Hasher:
    """Polynomial hashes modulo 2^64 of byte runs, from prefix sums; random values for bytes.

    All hashers of a process share the powers of one base; they differ in their values.
    """

    base = 0x9E3779B97F4A7C15
    inverse = pow(base, -1, 2**64)
    _up = _down = np.ones(1, np.uint64)

    def __init__(self, seed: int):
        r = np.random.default_rng(seed)
        self.value = r.integers(1, 2**63, 256, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)

    @classmethod
    def _powers(cls, n: int) -> None:
        if len(cls._up) < n:
            n += n // 8
            up, down = np.full(n, np.uint64(cls.base)), np.full(n, np.uint64(cls.inverse))
            up[0] = down[0] = 1
            cls._up = np.multiply.accumulate(up, out=up)
            cls._down = np.multiply.accumulate(down, out=down)

    def prefix(self, data: np.ndarray) -> np.ndarray:
        self._powers(len(data) + 1)
        out = np.zeros(len(data) + 1, np.uint64)
        step = self.value[data]
        step *= self._up[: len(data)]
        np.cumsum(step, out=out[1:])
        return out

    def runs(self, prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hash of the bytes [start, end) of each run, wherever it stands."""
        return mix((prefix[ends] - prefix[starts]) * self._down[starts])

    def sequences(self, codes: np.ndarray, k: int) -> np.ndarray:
        """Hash of the ``k`` codes from each position on; len(codes) - k + 1 of them."""
        if len(codes) < k:
            return np.zeros(0, np.uint64)
        self._powers(len(codes) + 1)
        p = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(mix(codes ^ self.value[0]) * self._up[: len(codes)], out=p[1:])
        return mix((p[k:] - p[:-k]) * self._down[: len(codes) - k + 1])


def split_by(bucket: np.ndarray, buckets: int):
    """(order, bounds): positions sorted by bucket, stably, and where each bucket begins."""
    order = np.argsort(bucket, kind="stable")
    return order, np.searchsorted(bucket[order], np.arange(buckets + 1))


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    return ((keys >> np.uint64(33)) % np.uint64(buckets)).astype(np.int32)


def counted(keys: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, and the sum of their weights."""
    if not len(keys):
        return keys, weight
    order = np.argsort(keys, kind="stable")
    keys, weight = keys[order], weight[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[first], np.add.reduceat(weight, first)


def pack(*arrays: np.ndarray) -> bytes:
    """Integer arrays as one compressed binary value, byte planes apart."""
    planes = [np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T.tobytes() for a in arrays]
    return zstandard.compress(b"".join(planes), 1)


def unpack(blob: bytes, *dtypes) -> list[np.ndarray]:
    """The arrays of ``pack``, all of one length."""
    raw = np.frombuffer(zstandard.decompress(blob), np.uint8)
    sizes = [np.dtype(t).itemsize for t in dtypes]
    n = len(raw) // sum(sizes)
    out, at = [], 0
    for t, size in zip(dtypes, sizes, strict=True):
        out.append(np.ascontiguousarray(raw[at : at + n * size].reshape(size, n).T).view(t).ravel())
        at += n * size
    return out


def deltas(sorted_values: np.ndarray) -> np.ndarray:
    return np.diff(sorted_values, prepend=sorted_values.dtype.type(0))


def rows(records: list[dict], schema: list[str]) -> pd.DataFrame:
    return pd.DataFrame({k: [r[k] for r in records] for k in schema}, columns=schema)
