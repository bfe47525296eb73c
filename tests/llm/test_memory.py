"""What a Python worker takes for a batch follows the slice, not the batch."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from scorewatch.llm import minhash, quality, words


def texts(n=4_000):
    """About 4 MB of words, in texts of about a KB."""
    draw = np.random.default_rng(3)
    return [" ".join(f"w{x}" for x in draw.integers(0, 100_000, 150)) for _ in range(n)]


def profiles(column):
    ids = pa.array(range(len(column)))
    batch = pa.RecordBatch.from_arrays([ids, ids, column], ["id", "text_hash", "text"])
    return minhash._profile(5)(iter([batch]))


def bags(column):
    batch = pa.RecordBatch.from_arrays([pa.array([1.0] * len(column)), column], ["label", "text"])
    return quality._bags(iter([batch]), 12)


@pytest.mark.parametrize("made", [profiles, bags])
def test_a_large_batch_is_worked_off_in_small_slices(monkeypatch, made):
    monkeypatch.setattr(words, "_POWERS", [words._Powers(1), words._Powers(2)])
    column = pa.array(texts())
    tracemalloc.start()
    try:
        rows = sum(b.num_rows for b in made(column))
        peak = tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()
    assert rows == len(column) and peak < 60


@pytest.mark.parametrize("size", [1, 3_000, 10**9])
def test_no_result_depends_on_the_slice(size):
    column = pa.array([None, "", "a b", "A b", " ", *texts(40)])
    whole = [(w.count, np.split(w.hashes(), w.first[1:-1])) for _, _, w in words.word_slices(column)]
    parts = [(w.count, np.split(w.hashes(), w.first[1:-1])) for _, _, w in words.word_slices(column, size=size)]
    for k in (0, 1):
        a, b = ([x for found in made for x in found[k]] for made in (whole, parts))
        assert len(a) == len(b) == len(column) and all(np.array_equal(x, y) for x, y in zip(a, b, strict=True))
