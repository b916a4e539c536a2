"""Count-min sketches over the keys of chunks: which keys may occur more than once?

Every chunk makes a sketch of its own keys: ROWS rows of cells with counts.  A key's
hash first picks a bucket, then a cell in each row of that bucket's part of the sketch;
only the cells that are not zero are sent.  Sketches merge by adding, bucket by bucket,
so the merged sketch is spread over the buckets and never in one place.  A key's
estimate, the smallest of its cells, is never below its count, so keys estimated as
single are single.  Each chunk gets back which of its own cells count two or more, and
which count ``hot`` or more.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.chunks import deltas, each, mix, pack, rows, unpack

ROWS = 2
HOT = 1 << 30
ASK_SCHEMA = "bucket int, chunk long, part int, cells binary"
REPLY_SCHEMA = "chunk long, bucket int, part int, often binary, hot binary"
_SEED = [np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)]


def cells_of(keys: np.ndarray, part: int, buckets: int, width: int) -> np.ndarray:
    """bucket << 32 | cell of each key in one row of the sketch."""
    bucket = (keys >> np.uint64(40)) % np.uint64(buckets)
    return bucket << np.uint64(32) | (mix(keys ^ _SEED[part]) >> np.uint64(16)) % np.uint64(width)


def width_for(chunks: DataFrame, buckets: int, bytes_per_key: float) -> int:
    """Cells of a row in each bucket: about six for each key, from the bytes of all chunks."""
    total = chunks.agg(F.sum("n_bytes")).first()[0] or 0
    return 1 << max(12, int(6 * total / bytes_per_key / buckets).bit_length())


def replies(chunks: DataFrame, keys_of, buckets: int, width: int, hot: int = HOT) -> DataFrame:
    """(chunk, bucket, part, often, hot): packed cells of the chunk that count twice or more, and hot ones."""

    def ask(batches):
        for c in each(batches):
            keys, out = keys_of(c), []
            for part in range(ROWS):
                cells = np.sort(cells_of(keys, part, buckets, width))
                first = np.flatnonzero(np.concatenate((np.ones(min(1, len(cells)), bool), cells[1:] != cells[:-1])))
                count = np.minimum(np.diff(np.append(first, len(cells))), 255).astype(np.uint8)
                cells = cells[first]
                at = np.searchsorted(cells, np.arange(buckets + 1, dtype=np.uint64) << np.uint64(32))
                for b in np.flatnonzero(np.diff(at)):
                    own = (cells[at[b] : at[b + 1]] & np.uint64(0xFFFFFFFF)).astype(np.uint32)
                    out.append({"bucket": b, "chunk": c.id, "part": part, "cells": pack(deltas(own), count[at[b] : at[b + 1]])})
            yield rows(out, ["bucket", "chunk", "part", "cells"])

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for part, asked in pdf.groupby("part"):
            total = np.zeros(width, np.uint32)
            own = []
            for blob in asked["cells"]:
                step, count = unpack(blob, np.uint32, np.uint8)
                own.append(np.cumsum(step, dtype=np.uint32))
                total[own[-1]] += count
            for chunk, bucket, cells in zip(asked["chunk"], asked["bucket"], own, strict=True):
                n = total[cells]
                often, very = cells[n > 1], cells[n >= hot]
                if len(often):
                    out.append({"chunk": chunk, "bucket": bucket, "part": part, "often": pack(deltas(often)), "hot": pack(deltas(very))})
        return rows(out, ["chunk", "bucket", "part", "often", "hot"])

    return chunks.mapInPandas(ask, ASK_SCHEMA).groupBy("bucket").applyInPandas(merge, REPLY_SCHEMA)


def _within(values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    if not len(values):
        return np.zeros(len(wanted), bool)
    return values[np.minimum(np.searchsorted(values, wanted), len(values) - 1)] == wanted


def estimated(reply: pd.DataFrame, keys: np.ndarray, buckets: int, width: int, column: str = "often") -> np.ndarray:
    """True for the keys of a chunk whose every cell is in its replies."""
    found = np.ones(len(keys), bool)
    for part in range(ROWS):
        own = reply[reply["part"] == part]
        cells = [np.zeros(0, np.uint64)]
        for bucket, blob in sorted(zip(own["bucket"], own[column], strict=True)):
            cells.append(np.cumsum(unpack(blob, np.uint32)[0], dtype=np.uint64) | np.uint64(bucket) << np.uint64(32))
        at = np.flatnonzero(found)
        found[at] = _within(np.concatenate(cells), cells_of(keys[at], part, buckets, width))
    return found
