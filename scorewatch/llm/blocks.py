"""Exact matching of many hashes without a row per hash.

Texts are dealt into chunks of bounded size. A task sends the sorted hashes of its chunk as
packed arrays, one for each bucket of the hash space; a bucket is matched by one task, which
answers each chunk. A hash occurs at most once in what a chunk sends, so that a hash which
very many texts share adds one entry for each chunk and makes no bucket large.
"""

from __future__ import annotations

import math
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of text in a chunk, and hashes in a bucket, on average.
CHUNK_BYTES, BUCKET_HASHES = 6_000_000, 1 << 21


def sizes(docs: DataFrame, text_col: str = "text") -> tuple[int, int]:
    """Chunks and buckets for these texts, from their bytes."""
    total = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    return max(1, math.ceil(total / CHUNK_BYTES)), max(1, math.ceil(total / 6 / BUCKET_HASHES))


def chunked(rows: DataFrame, chunks: int) -> DataFrame:
    """Rows with their chunk, dealt by id and text: rows without an id, or many of one id, are
    no group of their own. Where a row goes depends on its values alone, so that a task that
    runs again finds the same chunk."""
    return rows.withColumn("chunk", F.pmod(F.xxhash64("id", "text"), F.lit(chunks)).cast("int"))


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of each sorted 64-bit key: equal parts of the range of the top 32 bits."""
    return ((keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def by_bucket(keys: np.ndarray, buckets: int) -> Iterator[tuple[int, int, int]]:
    """(bucket, from, to) of the runs of sorted keys."""
    place = bucket_of(keys, buckets)
    cut = np.flatnonzero(np.diff(place, prepend=-1))
    for a, b in zip(cut, [*cut[1:], len(keys)], strict=True):
        yield int(place[a]), int(a), int(b)


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as one binary value, each behind its length in bytes."""
    return b"".join(x for a in arrays for x in (struct.pack("<q", a.nbytes), a.tobytes()))


def unpack(raw: bytes, *kinds: str) -> list[np.ndarray]:
    out, at = [], 0
    for kind in kinds:
        size = struct.unpack_from("<q", raw, at)[0]
        out.append(np.frombuffer(raw, kind, size // np.dtype(kind).itemsize, at + 8))
        at += 8 + size
    return out


def table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    columns = list(zip(*rows, strict=True)) or [()] * len(schema)
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema)
