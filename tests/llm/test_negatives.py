"""Hard negatives against brute force over all pairs."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from scorewatch.llm import negatives
from scorewatch.llm.queries import QUERIES

SCHEMA = "vec_id bigint, embedding array<float>, label int, row int, id string, slice int, score double"


def whole(vector):
    if vector is None or any(x is None or not math.isfinite(x) for x in vector):
        return None
    return [math.floor(256 * float(np.float32(x))) for x in vector]


def by_force(rows, every=100, k=5):
    """Rows are (id, vector, label); equal ids and vectors are rows of their own."""
    took = []
    for place, (i, vector, label) in enumerate(rows):
        v = whole(vector)
        if v is not None and label is not None:
            took.append((i, v, (label + 1) % 10 if i is not None and i % 7 == 0 else label, place))
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    order = lambda r: (-r[0], r[1] is None, r[1] or 0, r[2])
    out = []
    for i, v, label, place in took:
        if i is None or i % every:
            continue
        scored = [(dot(v, w), j, p, other) for j, w, other, p in took if p != place]
        own = sorted((r for r in scored if r[3] == label), key=order)[:k]
        rest = sorted((r for r in scored if r[3] != label), key=order)
        for positive, j, *_ in own:
            fit = [r for r in rest if 80 * positive <= 100 * r[0] <= 100 * positive][:k]
            out += [(i, j, rank, r[1], positive, r[0]) for rank, r in enumerate(fit, 1)]
    return sorted(out, key=str)


def mined(spark, rows, every=100, **sizes):
    frame = spark.createDataFrame([(*r, 1, "x", 2, 0.5) for r in rows], SCHEMA).repartition(3)
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return sorted((tuple(r) for r in negatives.mine(frame, label, F.col("id") % every == 0, **sizes).collect()), key=str)


def drawn(seed, n, width=12, spread=0.4):
    """Rows around few directions, some of them of very different lengths."""
    rng = np.random.default_rng(seed)
    heads = rng.normal(size=(6, width))
    return [
        (i, (heads[rng.integers(6)] + spread * rng.normal(size=width) * rng.choice([0.1, 1, 5])).tolist(), int(rng.integers(10)))
        for i in range(n)
    ]


def test_the_table(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    found = sorted((tuple(r) for r in QUERIES["op13_hard_negatives"](spark, sf_dir).collect()), key=str)
    assert found == by_force(rows) and found


@pytest.mark.parametrize(("seed", "sizes"), [(1, {}), (2, {"slice_rows": 40, "anchor_rows": 7}), (3, {"sample": 5})])
def test_rows_around_few_directions(spark, seed, sizes):
    rows = drawn(seed, 700)
    assert mined(spark, rows, 10, **sizes) == by_force(rows, 10)


def test_a_vector_that_most_rows_share(spark):
    """Ties by the hundred: smaller ids come first, over all slices."""
    rows = drawn(4, 300)
    rows = [(i, rows[8][1] if i % 3 else v, label) for i, v, label in rows]
    assert mined(spark, rows, 20, slice_rows=30) == by_force(rows, 20)


def test_odd_rows(spark):
    v = [0.5, -0.25, 0.125]
    rows = drawn(5, 60, 3) + [
        (100, v, 1), (101, v, 1), (102, v, 2), (103, [0.5, None, 0.1], 1), (104, None, 1), (105, [float("nan"), 0.0, 0.0], 1),
        (106, [float("inf"), 0.0, 0.0], 1), (107, v, None), (108, [], 1), (109, [0.5], 2), (110, [0.0] * 3, 2), (None, v, 3),
        (None, v, 1), (200, [0.0] * 3, 4), (300, [], 4), (-100, [-x for x in v], 1), (202, [0.5, -0.25, 0.125, 3.0], 1),
    ]
    assert mined(spark, rows) == by_force(rows)
    assert mined(spark, [(100, v, 1)]) == [] and mined(spark, []) == [] and mined(spark, [(1, v, 1)]) == []
    assert mined(spark, [(100, v, 1), (3, v, 1)]) == []


def test_repeated_rows_are_rows_of_their_own(spark):
    v = [0.5, -0.25]
    rows = [(100, v, 1), (100, v, 1), (102, v, 2), (102, v, 2)]
    assert mined(spark, rows) == by_force(rows)


def test_bounds_hold():
    """No score from a place on is above what the list says for it."""
    rng = np.random.default_rng(3)
    for spread in (0.05, 0.5, 3):
        members = (100 * (rng.normal(size=8) + spread * rng.normal(size=(20, 8)))).astype(np.int64)
        x = (300 * rng.normal(size=(500, 8)) * rng.lognormal(size=(500, 1))).astype(np.int64)
        shared = negatives.Shared(members, x)
        scores = members @ x[shared.order].T
        for at in range(0, 500, 50):
            assert (scores[:, at:].max(axis=1) <= shared.limits(at)).all()


def test_vectors_too_long_to_bound(spark):
    rows = [(100, [1e7, 1.0], 1), (101, [1e7, 2.0], 1), (102, [9e6, 1.0], 2), (103, [1e6, 5.0], 3)]
    assert mined(spark, rows) == by_force(rows)
