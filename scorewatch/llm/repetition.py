"""Quality rules from repetition: suffix arrays over the words of each text.

The suffixes of a text are sorted by prefix doubling; neighbours in that order and the words
they have in common (the intervals of the longest-common-prefix array) give the maximal
repeated word sequences. Those of `min_words` or more are united as spans. A text fails when
the spans cover more than `max_covered` of its words or the longest repeat is longer than
`max_longest` words.

Many texts are sorted at once, in slices of bounded size; words of different texts never
compare equal. Null and empty texts have no words and fail the base rule on length. Repeated
rows are judged each for itself; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from scorewatch.llm.words import SPACE, STEP, U64, Words, mix, slices, split_words, windows

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True

MIN_WORDS, MAX_COVERED, MAX_LONGEST = 8, 0.4, 100


def suffix_order(h: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Places of all suffixes, sorted by text and then by words (in the order of hashes).

    Prefix doubling: a place's rank is the index of its group of equals in the sorted
    order; groups with more than one place are split by the rank `step` words further on.
    """
    n = len(h)
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    end = np.repeat(first[1:], np.diff(first))
    order = np.lexsort((h, text))
    new = np.ones(n, bool)
    new[1:] = (h[order][1:] != h[order][:-1]) | (text[order][1:] != text[order][:-1])
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    step = 1
    size = np.bincount(rank, minlength=n)
    open_ = np.flatnonzero(size[rank] > 1)
    while len(open_):
        ahead = open_ + step
        key = np.where(ahead < end[open_], rank[np.minimum(ahead, n - 1)], -1)
        own = rank[open_]
        by = np.lexsort((key, own))
        at, own, key = open_[by], own[by], key[by]
        group = np.ones(len(at), bool)
        group[1:] = own[1:] != own[:-1]
        part = group.copy()
        part[1:] |= key[1:] != key[:-1]
        i = np.arange(len(at))
        begin = np.maximum.accumulate(np.where(group, i, 0))
        rank[at] = own + np.maximum.accumulate(np.where(part, i, 0)) - begin
        alone = part & np.concatenate([part[1:], [True]])
        open_ = at[~alone]
        step *= 2
    order = np.empty(n, np.int64)
    order[rank] = np.arange(n)
    return order


def common_prefixes(h: np.ndarray, first: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Words that each suffix in the order shares with the one before it; 0 for the first.

    Bisection on hashes of prefixes, all neighbours at once.
    """
    n = len(h)
    out = np.zeros(n, np.int64)
    if n < 2:
        return out
    end = np.repeat(first[1:], np.diff(first))
    a, b = order[:-1], order[1:]
    power = np.cumprod(np.full(n + 1, STEP, np.uint64))
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(mix(h) * power[:n], out=total[1:])
    most = np.where(end[a] == end[b], np.minimum(end[a] - a, end[b] - b), 0)
    pick = np.flatnonzero((most > 0) & (h[a] == h[b]))
    a, b, low, high = a[pick], b[pick], np.ones(len(pick), np.int64), most[pick]
    while len(a) and (low < high).any():
        middle = (low + high + 1) // 2
        left = (total[a + middle] - total[a]) * power[np.maximum(b - a, 0)]
        right = (total[b + middle] - total[b]) * power[np.maximum(a - b, 0)]
        same = left == right
        low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
    out[pick + 1] = low
    return out


def repeats(words: Words, min_words: int) -> tuple[np.ndarray, np.ndarray]:
    """Per text: words covered by repeats of `min_words` or more, and the longest repeat."""
    h, first, n = words.hashes(), words.first, len(words.start)
    covered, longest = np.zeros(len(first) - 1, np.int64), np.zeros(len(first) - 1, np.int64)
    if not n:
        return covered, longest
    order = suffix_order(h, first)
    shared = common_prefixes(h, first, order)
    reach = np.zeros(n, np.int64)
    reach[order] = np.maximum(shared, np.concatenate([shared[1:], [0]]))
    text = words.text_of
    np.maximum.at(longest, text, reach)
    edge = np.zeros(n + 1, np.int64)
    begins = np.flatnonzero(reach >= min_words)
    np.add.at(edge, begins, 1)
    np.add.at(edge, begins + reach[begins], -1)
    inside = np.cumsum(edge[:-1]) > 0
    np.add.at(covered, text, inside)
    return covered, longest


def repeat_words(words: Words, size: int = 3) -> np.ndarray:
    """Per text: words in windows of `size` words that occur twice or more in the text."""
    at, key = windows(words.hashes(), words.first, size)
    out = np.zeros(len(words.first) - 1, np.int64)
    if not len(at):
        return out
    text = words.text_of
    order = np.lexsort((key, text[at]))
    k, t = key[order], text[at][order]
    same = (k[1:] == k[:-1]) & (t[1:] == t[:-1])
    twice = np.zeros(len(at), bool)
    twice[1:] |= same
    twice[:-1] |= same
    inside = np.zeros(len(words.start), bool)
    for j in range(size):
        inside[at[order[twice]] + j] = True
    np.add.at(out, text, inside)
    return out


def per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Count of the flagged bytes of each text."""
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def duplicate_lines(raw: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in raw.split(b"\n") if x.split()]
    return len(lines) - len(set(lines))


def measure(data: np.ndarray, offsets: np.ndarray, min_words: int) -> list[np.ndarray]:
    words = split_words(data, offsets)
    letter = ~SPACE[data] & ((data & 0xC0) != 0x80)
    covered, longest = repeats(words, min_words)
    lines = [duplicate_lines(data[a:b].tobytes()) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
    return [
        words.count,
        per_text(letter, offsets),
        per_text(SYMBOLS[data], offsets),
        np.array(lines, np.int64),
        repeat_words(words),
        covered,
        longest,
    ]


FIELDS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "covered_words", "longest_repeat")


def judge(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_words: int = MIN_WORDS,
    max_covered: float = MAX_COVERED,
    max_longest: int = MAX_LONGEST,
) -> DataFrame:
    """Per row: the measures, base_failed, and kept, which is false for failures of either kind."""
    plain = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    names = [id_col, *FIELDS, "base_failed", "kept"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, offsets in slices(batch.column(1)):
                found = measure(data, offsets, min_words)
                n, repeated, covered, longest = found[0], found[4], found[5], found[6]
                failed = (n < 50) | (100 * repeated > 50 * n)
                kept = ~failed & (covered <= max_covered * n) & (longest <= max_longest)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), *map(pa.array, found), pa.array(failed), pa.array(kept)], names
                )

    schema = T.StructType(
        [T.StructField(id_col, plain.schema["id"].dataType)]
        + [T.StructField(f, T.LongType()) for f in FIELDS]
        + [T.StructField("base_failed", T.BooleanType()), T.StructField("kept", T.BooleanType())]
    )
    return plain.mapInArrow(run, schema)
