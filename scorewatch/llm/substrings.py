"""Substring deduplication by fixed-block anchors.

Every text is cut into non-overlapping blocks of `block` words, the reference blocks; every
rolling window of `block` words of all texts probes them. With `block` = (window + 1) // 2
any `window` equal words hold a whole reference block, so no repeat is missed. A hit is
extended on both sides, word by word, to the windows of `window` words that hold it; windows
that an earlier text has too are joined to maximal exact repeats and removed.

How it runs: texts are dealt into chunks, chunks exchange packed sorted hashes by bucket
(`blocks`), and each chunk is told which of its hashes others share. Pairs are never formed:
a passage in a third of all texts adds one entry for each chunk. Blocks are matched on 32
bits in a bucket, which only selects candidates; windows are held equal on 96 bits.

Ids are integers; a repeat stays in the text with the smallest id. Rows of one id are
separate texts that do not remove each other's windows. A row without an id keeps all its
words and removes nothing elsewhere. Null texts count as empty and stay null. Other
columns are carried along in a struct, whatever their names; an empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scorewatch.llm import blocks
from scorewatch.llm.words import U64, Words, windows, word_slices

WINDOW = 13
FAR, NEAR = np.iinfo(np.int64).max, np.iinfo(np.int64).min
_SENT = pa.schema([("bucket", pa.int64()), ("chunk", pa.int32()), ("data", pa.binary())])
_BACK = pa.schema([("chunk", pa.int32()), ("bucket", pa.int64()), ("data", pa.binary())])
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _place(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket and 32 more bits of each hash, in one number that sorts by bucket."""
    return blocks.bucket_of(keys, buckets).astype(np.uint64) << U64(32) | keys & U64(0xFFFFFFFF)


def _runs(places: np.ndarray):
    """(bucket, from, to) of sorted places."""
    bucket = (places >> U64(32)).astype(np.int64)
    cut = np.flatnonzero(np.diff(bucket, prepend=-1))
    return [(int(bucket[a]), int(a), int(b)) for a, b in zip(cut, [*cut[1:], len(places)], strict=True)]


def _probes(texts: pa.ChunkedArray, size: int, buckets: int):
    """Per slice: rows, words, window starts, their places."""
    for i, j, words in word_slices(texts):
        at, keys = windows(words.hashes(), words.first, size)
        yield i, j, words, at, _place(keys, buckets)


def _send(table: pa.Table, size: int, buckets: int) -> pa.Table:
    """Distinct window hashes of a chunk; which of them are blocks, and which in two texts."""
    place, block, text = [], [], []
    for i, _, words, at, p in _probes(table["text"], size, buckets):
        own = words.text_of[at]
        place.append(p)
        block.append((at - words.first[own]) % size == 0)
        text.append(own + i)
    place, block, text = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (place, block, text))
    if not len(place):
        return blocks.table([], _SENT)
    order = np.argsort(place, kind="stable")
    place, block, text = place[order], block[order], text[order]
    start = np.flatnonzero(np.diff(place, prepend=place[0] + U64(1)))
    block = np.logical_or.reduceat(block, start)
    many = np.maximum.reduceat(text, start) != np.minimum.reduceat(text, start)
    place = place[start]
    low = place.astype(np.uint32)
    chunk = table["chunk"][0].as_py()
    rows = [
        (b, chunk, blocks.pack(low[x:y], np.packbits(block[x:y]), np.packbits(many[x:y]))) for b, x, y in _runs(place)
    ]
    return blocks.table(rows, _SENT)


def _answer(table: pa.Table) -> pa.Table:
    """Of a bucket, what each chunk shares: a block of any text, in two texts or more."""
    lows, block, many = [], [], []
    for raw in table["data"]:
        low, b, m = blocks.unpack(raw.as_py(), "u4", "u1", "u1")
        lows.append(low)
        block.append(np.unpackbits(b, count=len(low)))
        many.append(np.unpackbits(m, count=len(low)))
    every = np.concatenate(lows)
    order = np.argsort(every, kind="stable")
    start = np.flatnonzero(np.diff(every[order].astype(np.int64), prepend=-1))
    count = np.diff(start, append=len(every))
    is_block = np.maximum.reduceat(np.concatenate(block)[order], start) > 0
    twice = (count > 1) | (np.maximum.reduceat(np.concatenate(many)[order], start) > 0)
    shared = np.empty(len(every), bool)
    shared[order] = np.repeat(is_block & twice, count)
    bucket = table["bucket"][0].as_py()
    rows, at = [], 0
    for chunk, low in zip(table["chunk"].to_pylist(), lows, strict=True):
        found = low[shared[at : at + len(low)]]
        at += len(low)
        if len(found):
            rows.append((chunk, bucket, blocks.pack(found)))
    return blocks.table(rows, _BACK)


def _ids(table: pa.Table, missing: int) -> np.ndarray:
    return table["id"].fill_null(missing).to_numpy()


def _wide(words: Words, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts of windows and 64 + 32 bits of their hash."""
    at, a = windows(words.hashes(0), words.first, size)
    _, b = windows(words.hashes(1), words.first, size)
    return at, a, b.astype(np.uint32)


def _groups(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by hash, and where each hash begins in it."""
    order = np.lexsort((b, a))
    x, y = a[order], b[order]
    new = np.ones(len(a), bool)
    new[1:] = (x[1:] != x[:-1]) | (y[1:] != y[:-1])
    return order, np.flatnonzero(new)


def _planes(x: np.ndarray) -> np.ndarray:
    """Bytes of integers, all first bytes first: small ids compress well in this form."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(-1, 8).T)


def _extend(key, table: pa.Table, shared: pa.Table, size: int, window: int, buckets: int) -> pa.Table:
    """Windows around the hits of a chunk, each with the smallest id that has it there."""
    if not table.num_rows or not shared.num_rows:
        return blocks.table([], _SENT)
    hits = np.concatenate(
        [
            blocks.unpack(raw, "u4")[0].astype(np.uint64) | U64(b) << U64(32)
            for b, raw in zip(shared["bucket"].to_pylist(), shared["data"].to_pylist(), strict=True)
        ]
    )
    hits.sort()
    ids = _ids(table, FAR)
    first, second, owner = [], [], []
    for i, _, words, at, place in _probes(table["text"], size, buckets):
        found = hits[np.minimum(np.searchsorted(hits, place), len(hits) - 1)] == place
        edge = np.zeros(len(words.start) + 1, np.int64)
        begin = at[found]
        np.add.at(edge, np.maximum(begin - (window - size), 0), 1)
        np.add.at(edge, begin + 1, -1)
        near = np.cumsum(edge[:-1]) > 0
        at, a, b = _wide(words, window)
        pick = near[at]
        first.append(a[pick])
        second.append(b[pick])
        owner.append(ids[i + words.text_of[at[pick]]])
    a, b, owner = np.concatenate(first), np.concatenate(second), np.concatenate(owner)
    if not len(a):
        return blocks.table([], _SENT)
    order, start = _groups(a, b)
    owner = np.minimum.reduceat(owner[order], start)
    a, b = a[order][start], b[order][start]
    chunk = table["chunk"][0].as_py()
    rows = [
        (k, chunk, blocks.pack(a[x:y], b[x:y], _planes(owner[x:y]))) for k, x, y in blocks.by_bucket(a, buckets)
    ]
    return blocks.table(rows, _SENT)


def _owners(table: pa.Table) -> pa.Table:
    """Of a bucket, the windows of each chunk that a smaller id outside the chunk has."""
    parts = [blocks.unpack(raw.as_py(), "u8", "u4", "u1") for raw in table["data"]]
    a, b = (np.concatenate([p[k] for p in parts]) for k in (0, 1))
    owner = np.concatenate([np.ascontiguousarray(p[2].reshape(8, -1).T).view(np.int64).ravel() for p in parts])
    order, start = _groups(a, b)
    least = np.empty(len(a), np.int64)
    least[order] = np.repeat(np.minimum.reduceat(owner[order], start), np.diff(start, append=len(a)))
    earlier = least < owner
    rows, at = [], 0
    bucket = table["bucket"][0].as_py()
    for chunk, p in zip(table["chunk"].to_pylist(), parts, strict=True):
        found = earlier[at : at + len(p[0])]
        at += len(p[0])
        if found.any():
            rows.append((chunk, bucket, blocks.pack(p[0][found], p[1][found])))
    return blocks.table(rows, _BACK)


def _remove(key, table: pa.Table, earlier: pa.Table, window: int) -> pa.Table:
    """Cut the repeats out of the texts of a chunk."""
    parts = [blocks.unpack(raw, "u8", "u4") for raw in earlier["data"].to_pylist()] if earlier.num_rows else []
    a, b, owner, own, spots = [], [], [], [], []
    ids, mine = _ids(table, FAR), _ids(table, NEAR)
    firsts, starts, ends = [], [], []
    base = 0
    for i, _, words in word_slices(table["text"]):
        at, x, y = _wide(words, window)
        text = i + words.text_of[at]
        a.append(x)
        b.append(y)
        owner.append(ids[text])
        own.append(mine[text])
        spots.append(at + base)
        firsts.append(words.first[:-1] + base)
        begin = words.offsets[:-1][words.text_of]
        starts.append(words.start - begin)
        ends.append(words.end - begin)
        base += len(words.start)
    count = sum(len(x) for x in a)
    first = np.concatenate([*firsts, [base]]) if firsts else np.zeros(1, np.int64)
    a = np.concatenate([*a, *(p[0] for p in parts)]) if a else np.zeros(0, np.uint64)
    b = np.concatenate([*b, *(p[1] for p in parts)]) if b else np.zeros(0, np.uint32)
    owner = np.concatenate([*owner, np.full(len(a) - count, NEAR + 1)]) if owner else np.zeros(0, np.int64)
    gone = np.zeros(base + 1, np.int64)
    if count:
        order, start = _groups(a, b)
        least = np.empty(len(a), np.int64)
        least[order] = np.repeat(np.minimum.reduceat(owner[order], start), np.diff(start, append=len(a)))
        repeated = np.concatenate(spots)[least[:count] < np.concatenate(own)]
        np.add.at(gone, repeated, 1)
        np.add.at(gone, repeated + window, -1)
    gone = np.cumsum(gone[:-1]) > 0
    start = np.concatenate(starts) if starts else np.zeros(0, np.int64)
    end = np.concatenate(ends) if ends else np.zeros(0, np.int64)
    counts, removed, texts, spans = [], [], [], []
    for k, text in enumerate(table["text"].to_pylist()):
        cut = gone[first[k] : first[k + 1]]
        edges = np.flatnonzero(np.diff(cut, prepend=False, append=False)).tolist() if cut.any() else []
        own = list(zip(edges[::2], edges[1::2], strict=True))
        if own:
            text = _cut(text.encode(), start[first[k] : first[k + 1]], end[first[k] : first[k + 1]], own)
        counts.append(len(cut))
        removed.append(int(cut.sum()))
        texts.append(text)
        spans.append([{"start": x, "end": y} for x, y in own])
    columns = [table["id"], pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(texts, pa.string())]
    columns += [pa.array(spans, _SPANS), table["rest"]]
    return pa.table(columns, ["id", "n_words", "n_removed", "kept", "spans", "rest"])


def _cut(raw: bytes, start: np.ndarray, end: np.ndarray, spans: list[tuple[int, int]]) -> str:
    """A text without some runs of words; each goes with the white space behind it."""
    out, at = [], 0
    for x, y in spans:
        out.append(raw[at : start[x]])
        at = int(start[y]) if y < len(start) else int(end[-1])
    return b"".join([*out, raw[at:]]).decode()


def deduplicate(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_words, n_removed, kept (the text without the repeats; else unchanged),
    the removed spans (in words, end exclusive), and rest, a struct of all other columns."""
    size = (window + 1) // 2
    others = [docs[f"`{c}`"] for c in docs.columns if c not in (id_col, text_col)]
    plain = docs.select(
        docs[id_col].cast("bigint").alias("id"),
        docs[text_col].cast("string").alias("text"),
        F.struct(*others, F.lit(True).alias("row")).alias("rest"),
    )
    chunks, buckets = blocks.sizes(plain)
    texts = blocks.chunked(plain, chunks)
    span = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
    kinds = T.StructType(
        [
            T.StructField("id", T.LongType()),
            T.StructField("n_words", T.LongType()),
            T.StructField("n_removed", T.LongType()),
            T.StructField("kept", T.StringType()),
            T.StructField("spans", T.ArrayType(span)),
            T.StructField("rest", plain.schema["rest"].dataType),
        ]
    )

    sent = texts.groupBy("chunk").applyInArrow(
        lambda t: _send(t, size, buckets), "bucket bigint, chunk int, data binary"
    )
    shared = sent.groupBy("bucket").applyInArrow(_answer, "chunk int, bucket bigint, data binary")
    around = (
        texts.groupBy("chunk")
        .cogroup(shared.groupBy("chunk"))
        .applyInArrow(
            lambda k, t, s: _extend(k, t, s, size, window, buckets), "bucket bigint, chunk int, data binary"
        )
    )
    earlier = around.groupBy("bucket").applyInArrow(_owners, "chunk int, bucket bigint, data binary")
    kept = (
        texts.groupBy("chunk")
        .cogroup(earlier.groupBy("chunk"))
        .applyInArrow(lambda k, t, s: _remove(k, t, s, window), kinds)
    )
    return kept.withColumnRenamed("id", id_col)
