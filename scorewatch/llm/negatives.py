"""Hard negatives for anchors, by walking lists that all anchors of a cluster share.

Vectors are whole numbers, floor(256 x), and a score is their inner product. By the cluster of
anchors with centre c, no member of which lies further than the angle t from c, a candidate x at
the angle a from c scores at most |u| |x| cos(max(0, a - t)) with a member u. So candidates are
sorted once per cluster by |x| cos(max(0, a - t)), and every member walks that list from the top.
Its walk ends, certified, when |u| times the next bound is below the score that its last place
takes so far. Scores are exact throughout; only what cannot matter is left out.

1. Centres: spherical k-means over at most ``sample`` anchors. Every row goes to its nearest centre;
   the rows of a centre are dealt into slices of about equal size, those of a large one into many,
   by a hash, so that a vector that a third of all rows share is spread too.
2. Positives: anchors walk one slice of their own centre first, which gives every anchor a score
   to beat; then each of the other slices, from which only rows that beat it come back.
3. Negatives: the same with the positives' scores as caps: for each anchor and positive the first
   ``k`` rows of another label with floor_percent * positive <= 100 * score <= 100 * positive.

Anchors against slices are the only pairs of rows there are, in blocks of bounded size: at most
``anchor_rows`` anchors meet about ``slice_rows`` candidates in a task.

Rows with a null label, a null vector, or a null or non-finite component take no part. Vectors of
different lengths count as padded with zeros, an empty one as zeros. A row without an id is a
candidate like others, behind all ids in a tie, and never an anchor. Every row is a row of its own:
a repeated one is another row, so that it may be a positive of its twin, and both have lines when
they are anchors; ties of equal ids are rows that differ in nothing that counts or go by row
number. Anchors without a positive or without a fitting negative have no lines. Scores beyond
2^63 wrap round as Spark's do; where vectors are that long, walks go to the end. An empty table
gives no rows. Other columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scorewatch.session import stage

#: Anchors that the centres are fitted on, and centres.
SAMPLE, CENTRES = 4_000, 32
#: Candidates in a slice and anchors in a block, at most (slices: on average).
SLICE_ROWS, ANCHOR_ROWS = 16_384, 8_192
#: Members of a cluster within a block, and candidates scored at a step of a walk.
MEMBERS, STEP = 64, 256


def quantised(vectors: DataFrame, label: Column, id_col: str, vector_col: str, scale: int = 256) -> DataFrame:
    """(row, id, label, v) of the rows that take part, written once, so that row numbers stay."""
    x = F.col(vector_col)
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < F.lit(float("inf"))))
    whole = F.transform(x, lambda c: F.floor(c.cast("double") * scale))
    kept = vectors.where(label.isNotNull() & x.isNotNull() & finite)
    rows = kept.select(F.col(id_col).cast("bigint").alias("id"), label.cast("bigint").alias("label"), whole.alias("v"))
    return stage(rows.withColumn("row", F.monotonically_increasing_id()), "vectors")


def _matrix(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    """Lists as rows of a matrix, padded with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(column), width), np.int64)
    out[np.repeat(np.arange(len(column)), sizes), np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = (
        column.flatten().to_numpy(zero_copy_only=False)
    )
    return out


def _unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(float)
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)


def centres_of(x: np.ndarray, count: int, rounds: int = 8) -> np.ndarray:
    """Spherical k-means; unit vectors."""
    u = _unit(x)
    centres = u[np.random.default_rng(7).permutation(len(u))[:count]]
    for _ in range(rounds):
        near = np.argmax(u @ centres.T, axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, u)
        centres = np.where(np.linalg.norm(sums, axis=1, keepdims=True) > 0, _unit(sums), centres)
    return centres


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers; through doubles where those are exact."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if most < 2.0**53:
        return (a.astype(float) @ b.T.astype(float)).astype(np.int64)
    with np.errstate(over="ignore"):
        return a @ b.T


class Shared:
    """Candidates in the order in which all members of a cluster walk them."""

    def __init__(self, members: np.ndarray, x: np.ndarray):
        u = _unit(members)
        centre = _unit(u.sum(axis=0, keepdims=True))[0]
        lengths, norms = np.linalg.norm(x.astype(float), axis=1), np.linalg.norm(members.astype(float), axis=1)
        cosines = np.clip(_unit(x) @ centre, -1, 1)
        # Members and candidates of no length score 0 whatever the angle.
        real = norms > 0
        spread = np.arccos(np.clip(u[real] @ centre, -1, 1)).max(initial=0)
        # Rounding may take a little from an angle; never from a bound.
        bound = lengths * np.cos(np.maximum(0, np.arccos(cosines) - spread - 1e-7))
        bound += 1e-9 * lengths + 1e-9
        if lengths.max(initial=0) * norms.max(initial=0) >= 2.0**62:
            bound[:] = np.inf
        self.order = np.argsort(-bound, kind="stable")
        self.bound, self.norms = bound[self.order], norms

    def limits(self, at: int) -> np.ndarray:
        """What each member may still score from place ``at`` on; a member of no length scores 0."""
        with np.errstate(invalid="ignore"):
            return np.where(self.norms > 0, self.norms * self.bound[at], 0.0)


class Best:
    """The first k candidates of many searches: highest score, then smallest id, then row."""

    def __init__(self, k: int, floors: np.ndarray):
        self.k = k
        #: Scores below this cannot matter to a search.
        self.need = floors.astype(np.int64)
        self.found: list[list[tuple[int, int, int]]] = [[] for _ in floors]

    def add(self, searches: np.ndarray, scores: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        order = np.lexsort((rows, ids, -scores, searches))
        firsts = np.flatnonzero(np.diff(searches[order], prepend=-1))
        # Of very many equal scores, no more than k of a search become Python objects.
        for a, b in zip(firsts.tolist(), [*firsts[1:].tolist(), len(order)], strict=True):
            s, own = int(searches[order[a]]), order[a : min(b, a + self.k)]
            new = zip((-scores[own]).tolist(), ids[own].tolist(), rows[own].tolist(), strict=True)
            best = sorted([*self.found[s], *new])[: self.k]
            self.found[s] = best
            if len(best) == self.k:
                self.need[s] = max(self.need[s], -best[-1][0])


def walk(members: np.ndarray, x: np.ndarray, searches: int, fits, best: Best, ids: np.ndarray, rows: np.ndarray) -> None:
    """Every member walks the shared list; member m's searches are m * searches and following.

    ``fits(members, candidates, scores)`` gives a mask (searches, members, candidates).
    """
    shared = Shared(members, x)
    active = np.arange(len(members))
    for at in range(0, len(x), STEP):
        least = best.need.reshape(-1, searches)[active].min(axis=1)
        active = active[shared.limits(at)[active] >= least]
        if not len(active):
            return
        near = shared.order[at : at + STEP]
        scores = _product(members[active], x[near])
        need = best.need.reshape(-1, searches)[active]
        mask = fits(active, near, scores) & (scores[None] >= need.T[:, :, None])
        s, m, c = np.nonzero(mask)
        if len(s):
            best.add(active[m] * searches + s, scores[m, c], ids[near[c]], rows[near[c]])


_LAST = np.iinfo(np.int64).max
_LEAST = np.iinfo(np.int64).min


def _numbers(table: pa.Table, name: str, missing: int = _LAST) -> np.ndarray:
    return table.column(name).fill_null(missing).to_numpy()


def _clusters(table: pa.Table) -> Iterator[np.ndarray]:
    """Members of a block, by centre, in groups of MEMBERS."""
    of = _numbers(table, "centre")
    order = np.argsort(of, kind="stable")
    for run in np.split(order, np.flatnonzero(np.diff(of[order])) + 1):
        for i in range(0, len(run), MEMBERS):
            yield run[i : i + MEMBERS]


def _near_positives(anchors: pa.Table, slice_: pa.Table, width: int, k: int) -> pa.Table:
    x, ids, rows, labels = _matrix(slice_.column("v"), width), *(_numbers(slice_, c) for c in ("id", "row", "label"))
    u, own, own_label = _matrix(anchors.column("v"), width), _numbers(anchors, "row"), _numbers(anchors, "label")
    floors = _numbers(anchors, "floor", _LEAST)
    out = []
    for m in _clusters(anchors) if len(x) else ():
        best = Best(k, floors[m])

        def fits(members, near, scores, m=m):
            same = own_label[m[members], None] == labels[None, near]
            return (same & (own[m[members], None] != rows[None, near]))[None]

        walk(u[m], x, 1, fits, best, ids, rows)
        out += [(own[a], *f) for a, found in zip(m, best.found, strict=True) for f in found]
    return _table(out, ["anchor", "score", "id", "row"])


def _near_negatives(anchors: pa.Table, slice_: pa.Table, width: int, k: int, share: int) -> pa.Table:
    x, ids, rows, labels = _matrix(slice_.column("v"), width), *(_numbers(slice_, c) for c in ("id", "row", "label"))
    u, own, own_label = _matrix(anchors.column("v"), width), _numbers(anchors, "row"), _numbers(anchors, "label")
    caps, seeds = (anchors.column(c).combine_chunks() for c in ("caps", "floors"))
    sizes = np.diff(caps.offsets.to_numpy())
    searches = int(sizes.max(initial=0))
    # Places that an anchor has no positive for want a score above all.
    cap, need = np.full((len(u), searches), _LEAST), np.full((len(u), searches), _LAST)
    filled = np.arange(searches)[None] < sizes[:, None]
    cap[filled] = caps.flatten().to_numpy(zero_copy_only=False)
    seed = seeds.flatten().fill_null(_LEAST).to_numpy(zero_copy_only=False)
    # 100 * score >= share * cap, in whole numbers; Python's, since these may pass 2^63.
    need[filled] = [max(s, -(-share * c // 100)) for c, s in zip(cap[filled].tolist(), seed.tolist(), strict=True)]
    out = []
    for m in _clusters(anchors) if len(x) and searches else ():
        best = Best(k, need[m].ravel())

        def fits(members, near, scores, m=m):
            other = own_label[m[members], None] != labels[None, near]
            return other[None] & (scores[None] <= cap[m[members]].T[:, :, None])

        walk(u[m], x, searches, fits, best, ids, rows)
        for s, found in enumerate(best.found):
            out += [(own[m[s // searches]], s % searches, *f) for f in found]
    return _table(out, ["anchor", "place", "score", "id", "row"])


def _table(rows: list[tuple], names: list[str]) -> pa.Table:
    columns = zip(*rows, strict=True) if rows else [[]] * len(names)
    made = dict(zip(names, (np.array(c, np.int64) for c in columns), strict=True))
    made["score"] = -made["score"]
    return pa.table({n: pa.array(c, mask=c == _LAST if n == "id" else None) for n, c in made.items()})


def mine(
    vectors: DataFrame,
    label: Column,
    anchor: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    positives: int = 5,
    k: int = 5,
    floor_percent: int = 80,
    slice_rows: int = SLICE_ROWS,
    anchor_rows: int = ANCHOR_ROWS,
    sample: int = SAMPLE,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``anchor`` is a condition on a column ``id``. What the driver sees is bounded: ``sample`` vectors,
    and a count per centre.
    """
    rows = quantised(vectors, label, id_col, vector_col)
    is_anchor = F.coalesce(anchor, F.lit(False))
    total, queries, width = rows.agg(F.count("*"), F.count_if(is_anchor), F.max(F.size("v"))).first()
    if not queries:
        schema = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
        return rows.sparkSession.createDataFrame([], schema)
    width = max(1, width)
    drawn = rows.where(is_anchor).orderBy(F.xxhash64("row")).limit(sample).select("v").toArrow()
    centres = centres_of(_matrix(drawn.column(0), width), CENTRES)

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = _matrix(b.column(b.schema.get_field_index("v")), width)
            at = np.argmax(_unit(v) @ centres.T, axis=1) if len(v) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(at, pa.int64())], [*b.schema.names, "centre"])

    schema = "id bigint, label bigint, v array<bigint>, row bigint, centre bigint"
    rows = stage(rows.mapInArrow(nearest, schema), "centred")
    # A slice is a part of one centre's rows; a slice is smaller where rows are few, for the sake of
    # the number of tasks.
    size = min(slice_rows, max(256, -(-total // 64)))
    counts = sorted(tuple(r) for r in rows.groupBy("centre").count().collect())
    parts = {c: -(-n // size) for c, n in counts}
    first = dict(zip(parts, np.cumsum([0, *parts.values()]).tolist()))
    places = {c: F.struct(F.lit(first[c]).alias("first"), F.lit(n).alias("parts")) for c, n in parts.items()}
    at = F.create_map(*[x for c, place in places.items() for x in (F.lit(c), place)])[F.col("centre")]
    rows = rows.withColumn("slice", (at["first"] + F.pmod(F.xxhash64("row"), at["parts"])).cast("bigint"))
    slices = sum(parts.values())
    blocks = -(-queries // anchor_rows)
    anchors = rows.where(is_anchor).withColumn("block", F.pmod(F.xxhash64("row", F.lit(1)), F.lit(blocks)).cast("int"))
    asked = ["row", "label", "v", "centre", "block"]

    def search(anchors: DataFrame, step, schema: str, home: bool) -> DataFrame:
        """Matches of every anchor in its own slice, or in all others."""
        if home:
            sent = anchors.select(*asked, *extra, "slice")
        else:
            every = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(slices - 1).cast("bigint")))
            sent = anchors.select(*asked, *extra, F.col("slice").alias("own"), every.alias("slice"))
            sent = sent.where("slice <> own").drop("own")
        block = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
        # Both sides come from one table; new columns keep them apart.
        dealt = rows.select(*[F.col(c).alias(c) for c in ("row", "id", "label", "v", "slice")], block)
        return sent.groupBy("slice", "block").cogroup(dealt.groupBy("slice", "block")).applyInArrow(step, schema)

    order = [F.desc("score"), F.asc_nulls_last("id"), F.asc("row")]

    def first_of(matches: DataFrame, n: int, *by: str) -> DataFrame:
        rank = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
        return matches.withColumn("rank", rank).where(F.col("rank") <= n)

    def in_two_steps(anchors: DataFrame, step, schema: str, n: int, by: list[str], with_floors) -> DataFrame:
        at_home = stage(search(anchors, step, schema, True), "home")
        beaten = first_of(at_home, n, *by).where(F.col("rank") == n).select(*by, F.col("score").alias("floor"))
        beyond = search(with_floors(anchors, beaten), step, schema, False)
        return stage(first_of(at_home.unionByName(beyond), n, *by), "found")

    extra = ["floor"]

    def positive_floors(anchors: DataFrame, beaten: DataFrame) -> DataFrame:
        return anchors.drop("floor").join(beaten.withColumnRenamed("anchor", "row"), "row", "left")

    found = in_two_steps(
        anchors.withColumn("floor", F.lit(None).cast("bigint")),
        lambda a, s: _near_positives(a, s, width, positives),
        "anchor bigint, score bigint, id bigint, row bigint",
        positives,
        ["anchor"],
        positive_floors,
    )
    # Places from 0, as the searches of an anchor are numbered.
    found = found.select("anchor", (F.col("rank") - 1).alias("place"), F.col("id").alias("positive_id"), F.col("score").alias("cap"))

    extra = ["caps", "floors"]
    places = found.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("place", "cap"))).alias("places"))
    with_caps = anchors.join(places.withColumnRenamed("anchor", "row"), "row").withColumn("caps", F.col("places.cap"))
    with_caps = with_caps.withColumn("floors", F.transform("places", lambda p: F.lit(None).cast("bigint"))).drop("places")

    def negative_floors(anchors: DataFrame, beaten: DataFrame) -> DataFrame:
        known = beaten.groupBy(F.col("anchor").alias("row")).agg(F.map_from_entries(F.collect_list(F.struct("place", "floor"))).alias("known"))
        floors = F.transform("floors", lambda _, i: F.try_element_at("known", i.cast("bigint")))
        return anchors.join(known, "row", "left").withColumn("floors", F.coalesce(floors, "floors")).drop("known")

    negatives = in_two_steps(
        with_caps,
        lambda a, s: _near_negatives(a, s, width, k, floor_percent),
        "anchor bigint, place bigint, score bigint, id bigint, row bigint",
        k,
        ["anchor", "place"],
        negative_floors,
    )
    named = anchors.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id"))
    return negatives.join(found, ["anchor", "place"]).join(named, "anchor").select(
        "anchor_id",
        "positive_id",
        "rank",
        F.col("id").alias("negative_id"),
        F.col("cap").alias("positive_score"),
        F.col("score").alias("negative_score"),
    )
