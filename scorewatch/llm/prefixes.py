"""Fingerprints of documents from prefix polynomial hashes.

The prefix array of a text holds, for every i, the sum of its first i code points times powers
of a base, modulo the prime 2^31 - 1; two bases make 62 bits. From it the hash of any span is one
subtraction and one product, so that spans are compared without their letters, the longest
common extension of two places is found by binary search, and the array of a text that is put
together from two others follows from theirs.

A fingerprint is text: length, hash of the whole, hashes of the prefixes and of the suffixes
whose lengths are powers of 2^(1/4), and the SKETCH smallest (mixed) hashes of all spans of SPAN
code points. Its size grows with the logarithm of the text. The likeness of two fingerprints is

* 1 if lengths and whole hashes agree;
* else the greater of two shares, below 1: common prefix and suffix, each found by binary search
  over the grid, by the longer text; and twice the common spans by all spans of both (from the
  sketches). The first sees one changed stretch, the second text that has moved.

Equal texts have equal fingerprints, whatever else their rows hold. A null text counts as empty;
the fingerprints of empty texts are equal, their likeness is 1, and 0 with any other text. A text
of fewer than SPAN code points is one span. In :func:`edits` rows without an id come last and ties
of an id go by a hash of the text; repeated rows each have their line; a single row is its own
next one. An empty table gives no rows, and other columns do not matter.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scorewatch.llm.words import mix
from scorewatch.operators.ordered import dealt

PRIME = 2**31 - 1
SPAN, SKETCH = 24, 64
#: Rows that go past each other in one task, on average.
PART_ROWS = 4096
_M, _SHIFT = np.uint64(PRIME), np.uint64(31)
_BASES = (1_204_862_863, 1_771_875_989)
#: Lengths of the prefixes and suffixes in a fingerprint.
GRID = sorted({round(2 ** (k / 4)) for k in range(4 * 40)})


def _mod(x: np.ndarray) -> np.ndarray:
    """x modulo 2^31 - 1, for x below 2^62."""
    x = (x & _M) + (x >> _SHIFT)
    x = (x & _M) + (x >> _SHIFT)
    return np.where(x >= _M, x - _M, x)


class _Powers:
    """Powers of a base and of its inverse, grown by doubling."""

    def __init__(self, base: int):
        self.bases = base, pow(base, -1, PRIME)
        self.up = self.down = np.ones(1, np.uint64)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        while len(self.up) < n:
            size = len(self.up)
            self.up, self.down = (
                np.concatenate([p, _mod(p * np.uint64(pow(b, size, PRIME)))])
                for p, b in zip((self.up, self.down), self.bases, strict=True)
            )
        return self.up, self.down


_POWERS = tuple(_Powers(b) for b in _BASES)


class Prefixes:
    """Prefix arrays of one text."""

    def __init__(self, lanes: list[np.ndarray]):
        self.lanes = lanes
        self.n = len(lanes[0]) - 1

    @classmethod
    def of(cls, text: str) -> Prefixes:
        codes = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64) + np.uint64(1)
        lanes = []
        for powers in _POWERS:
            sums = np.zeros(len(codes) + 1, np.uint64)
            np.cumsum(_mod(codes * powers.to(len(codes) + 1)[0][: len(codes)]), out=sums[1:])
            lanes.append(_mod(sums))
        return cls(lanes)

    def joined(self, head: int, other: Prefixes, length: int) -> Prefixes:
        """Arrays of this text's first ``head`` code points followed by another's first ``length``."""
        lanes = []
        for own, theirs, powers in zip(self.lanes, other.lanes, _POWERS, strict=True):
            tail = _mod(own[head] + _mod(powers.to(head + 1)[0][head] * theirs[1 : length + 1]))
            lanes.append(np.concatenate([own[: head + 1], tail]))
        return Prefixes(lanes)

    def lane(self, k: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        p = self.lanes[k]
        down = _POWERS[k].to(self.n + 1)[1]
        return _mod(_mod(p[end] + _M - p[start]) * down[start])

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """62-bit hashes of spans [start, end)."""
        return (self.lane(0, start, end) << _SHIFT) | self.lane(1, start, end)

    def span(self, start: int, end: int) -> int:
        return int(self.spans(np.array([start]), np.array([end]))[0])


def extension(a: Prefixes, i: int, b: Prefixes, j: int) -> int:
    """How many code points from place i of a and place j of b are equal."""
    low, high = 0, min(a.n - i, b.n - j)
    while low < high:
        middle = (low + high + 1) // 2
        if a.span(i, i + middle) == b.span(j, j + middle):
            low = middle
        else:
            high = middle - 1
    return low


class Fingerprint(NamedTuple):
    n: int
    whole: int
    prefixes: tuple[int, ...]
    suffixes: tuple[int, ...]
    sketch: tuple[int, ...]

    def __str__(self) -> str:
        lists = ("".join(f"{x:08x}" for x in part) for part in self[2:])
        return ":".join([f"{self.n:x}", f"{self.whole:016x}", *lists])

    @classmethod
    def parse(cls, text: str) -> Fingerprint:
        n, whole, *lists = text.split(":")
        parts = (tuple(int(x[i : i + 8], 16) for i in range(0, len(x), 8)) for x in lists)
        return cls(int(n, 16), int(whole, 16), *parts)


def _smallest(hashes: np.ndarray) -> np.ndarray:
    """The SKETCH smallest distinct hashes, ascending."""
    few = 4 * SKETCH
    if len(hashes) > few:
        near = np.unique(np.partition(hashes, few)[:few])
        if len(near) >= SKETCH:
            return near[:SKETCH]
    return np.unique(hashes)[:SKETCH]


def fingerprint(p: Prefixes) -> Fingerprint:
    n = p.n
    if n == 0:
        return Fingerprint(0, 0, (), (), ())
    size = np.array(GRID[: bisect_left(GRID, n + 1)])
    width = min(n, SPAN)
    at = np.arange(n - width + 1)
    spans = mix(p.lane(0, at, at + width)) >> np.uint64(32)
    # One lane is enough for the grids: 31 bits a step, and the search takes a handful of steps.
    heads = p.lane(1, np.zeros(len(size), np.int64), size)
    tails = p.lane(1, n - size, np.full(len(size), n))
    return Fingerprint(n, p.span(0, n), tuple(heads.tolist()), tuple(tails.tolist()), tuple(_smallest(spans).tolist()))


def _common(a: tuple[int, ...], b: tuple[int, ...]) -> int:
    """The longest length on the grid at which both agree."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[middle - 1] == b[middle - 1]:
            low = middle
        else:
            high = middle - 1
    return GRID[low - 1] if low else 0


def likeness(a: Fingerprint, b: Fingerprint) -> float:
    if a.n == b.n and a.whole == b.whole:
        return 1.0
    short, long = sorted((a.n, b.n))
    if short == 0:
        return 0.0
    ends = min(short, _common(a.prefixes, b.prefixes) + _common(a.suffixes, b.suffixes)) / long
    union = sorted({*a.sketch, *b.sketch})[:SKETCH]
    both = len({*a.sketch} & {*b.sketch} & {*union})
    moved = 2 * both / (len(union) + both)
    return min(max(ends, moved), long / (long + 1))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_chars, fingerprint) of every text."""
    rows = docs.select(docs[id_col].alias("id"), F.coalesce(docs[text_col], F.lit("")).alias("text"))
    schema = T.StructType([T.StructField("id", rows.schema["id"].dataType), T.StructField("n_chars", T.LongType()), T.StructField("fingerprint", T.StringType())])
    return rows.mapInArrow(_plain, schema).withColumnRenamed("id", id_col)


def _plain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [fingerprint(Prefixes.of(x.as_py())) for x in batch.column(1)]
        made = [pa.array([f.n for f in found], pa.int64()), pa.array([str(f) for f in found], pa.string())]
        yield pa.RecordBatch.from_arrays([batch.column(0), *made], ["id", "n_chars", "fingerprint"])


class _Text:
    def __init__(self, text: str):
        self.text = text
        self.prefixes = Prefixes.of(text)
        self.fingerprint = fingerprint(self.prefixes)


_RESULT = [
    T.StructField("n_chars", T.LongType()),
    T.StructField("edited_sha256", T.StringType()),
    T.StructField("fingerprint", T.StringType()),
    T.StructField("edited_fingerprint", T.StringType()),
    T.StructField("near_edited", T.DoubleType()),
    T.StructField("near_next", T.DoubleType()),
]
_TYPES = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]


def _edit(own: _Text, following: _Text) -> tuple:
    """Result columns of a text whose last half gives way to the start of the following one."""
    n = own.prefixes.n
    tail = min(n // 2, following.prefixes.n)
    edited = own.text[: n - n // 2] + following.text[:tail]
    other = fingerprint(own.prefixes.joined(n - n // 2, following.prefixes, tail))
    return (
        n,
        hashlib.sha256(edited.encode()).hexdigest(),
        str(own.fingerprint),
        str(other),
        likeness(own.fingerprint, other),
        likeness(own.fingerprint, following.fingerprint),
    )


def _along(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every row beside the one before it. A part begins with a row of another part, marked as such."""
    before = None
    for batch in batches:
        marks, ids, texts = batch.columns
        kept, rows = [], []
        for i, (mark, text) in enumerate(zip(marks.to_pylist(), texts, strict=True)):
            own = _Text(text.as_py())
            if not mark:
                kept.append(i)
                rows.append(_edit(own, before))
            before = own
        made = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [[]] * len(_TYPES), _TYPES, strict=True)]
        yield pa.RecordBatch.from_arrays([ids.take(pa.array(kept, pa.int64())), *made], ["id", *(f.name for f in _RESULT)])


def _place(row: Column, firsts: list[Column]) -> Column:
    """How many of the ascending ``firsts`` are at or below a row, less one, by binary search."""
    table = F.array(*firsts)
    widths = F.array(*[F.lit(1 << i) for i in reversed(range(len(firsts).bit_length()))])

    def step(found: Column, width: Column) -> Column:
        return F.when(F.get(table, found + width - 1) <= row, found + width).otherwise(found)

    return F.aggregate(widths, F.lit(0), step) - 1


def edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_rows: int = PART_ROWS) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness.

    In the edited text the last half (rounded down) gives way to as much of the start of the next
    text, by descending id; the first follows the last. Ids alone are ordered first and cut into
    parts of about ``part_rows`` rows; the driver sees the first and the last id of each part. Texts
    are then shuffled once, to their part, where each part also gets the last text of the part
    before it, and go past their neighbours in order of the id.
    """
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    rows = docs.select(docs[id_col].alias("id"), F.xxhash64(text).alias("tie"), text.alias("text"))
    order = ["id", "tie"]
    at = F.struct(*order)
    parts = -(-max(1, docs.count()) // part_rows)
    cut = dealt(rows.select(*order), [], order, parts)
    ends = [tuple(r) for r in cut.groupBy("_ordered_part").agg(F.min(at), F.max(at)).sort("_ordered_part").collect()]
    fields = [T.StructField("id", rows.schema["id"].dataType), *_RESULT]
    if not ends:
        return docs.sparkSession.createDataFrame([], T.StructType(fields)).withColumnRenamed("id", id_col)

    id_type = rows.schema["id"].dataType
    firsts = [F.struct(F.lit(first.id).cast(id_type).alias("id"), F.lit(first.tie).cast("bigint").alias("tie")) for _, first, _ in ends]
    own = rows.select(*order, "text", _place(at, firsts).alias("part"), F.lit(False).alias("mark"))
    # The part after the last one is the first: ascending, every row takes from the one before it.
    lasts = [(last.id, last.tie, (k + 1) % len(ends)) for k, (_, _, last) in enumerate(ends)]
    schema = T.StructType([T.StructField("end", id_type), T.StructField("end_tie", T.LongType()), T.StructField("part", T.IntegerType())])
    wanted = F.broadcast(docs.sparkSession.createDataFrame(lasts, schema))  # one row per part
    before = rows.join(wanted, rows["id"].eqNullSafe(wanted["end"]) & (rows["tie"] == wanted["end_tie"]))
    before = before.select(*order, "text", "part", F.lit(True).alias("mark")).dropDuplicates(["part"])
    sent = own.union(before).repartitionById(len(ends), "part")
    along = sent.sortWithinPartitions("part", F.desc("mark"), *order).select("mark", "id", "text")
    return along.mapInArrow(_along, T.StructType(fields)).withColumnRenamed("id", id_col)
