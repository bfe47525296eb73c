"""Near-duplicate documents from bottom-k sketches made with one hash function.

A document's set holds the hashes of its distinct shingles; its sketch is the k smallest.
Documents with equal sets form a class, of which one member goes on. Retained values are
inverted: every value leads to the classes that keep it. A class enters only the lists of
its rarest values, as many as any class with the wanted similarity must meet in one (prefix
filter; exact for sets up to k, whose partners may be larger; beyond k sized for OVERLAP common
values, which a pair at the threshold misses with a probability of about 1e-6). A value that most texts share is therefore
used only by texts that consist of such values.

Within a list, members are paired with its middle, the member that shares most of its values
with others: the original of a group of edited copies, and both full sets are compared. After that, members of
different components are paired where a link is still possible (`_crossing`); such a pair is
estimated from the union of both sketches, and what may reach the threshold is verified on the
full sets. So a group of m copies costs about m pairs, and no link between different
components is lost.

Texts without words have an empty set and link with nothing. Fewer words than a shingle
count as one shingle. Rows of one id with equal sets are one class; a row without an id
links with nothing and is kept. Repeated rows come out as often as they come in. Other
columns are ignored, whatever their names; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scorewatch.llm.graph import components, stage
from scorewatch.llm.words import STEP, U64, Words, mix, windows, word_slices

SHINGLE, PERCENT = 5, 80
#: Values in a sketch; how many of them two sketches at the threshold have in common at
#: least; the least estimate (in percent) that goes to verification.
SKETCH, OVERLAP, LEAST_ESTIMATE = 128, 80, 62
VOID = np.iinfo(np.uint64).max


def shingles(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts, and where each text's begin."""
    h, n = words.hashes(), words.count
    at, key = windows(h, words.first, size)
    text = words.text_of
    short = np.flatnonzero((n > 0) & (n < size))
    whole = np.zeros(len(short), np.uint64)
    for j in range(size - 1):
        more = n[short] > j
        whole[more] = whole[more] * STEP + h[words.first[short[more]] + j]
    key = np.concatenate([key, mix(whole)])
    owner = np.concatenate([text[at], short])
    order = np.lexsort((key, owner))
    key, owner = key[order], owner[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (owner[1:] != owner[:-1])
    key, owner = key[new], owner[new]
    return key, np.searchsorted(owner, np.arange(len(n) + 1))


def _profile(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, words in word_slices(batch.column(2), lower=True):
                keys, first = shingles(words, size)
                signed = keys.view(np.int64)
                count = np.diff(first)
                lists = [signed[a : a + SKETCH][: b - a] for a, b in zip(first[:-1], first[1:], strict=True)]
                prints = [
                    hashlib.blake2b(keys[a:b].tobytes(), digest_size=16).digest()
                    for a, b in zip(first[:-1], first[1:], strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(i, j - i),
                        batch.column(1).slice(i, j - i),
                        pa.array(count),
                        pa.array(prints, pa.binary()),
                        pa.array(lists, pa.list_(pa.int64())),
                    ],
                    ["id", "text_hash", "n", "print", "sketch"],
                )

    return run


def _matrix(column: pa.ListArray) -> np.ndarray:
    """Sketches as rows, filled up with VOID."""
    sizes = np.diff(column.offsets.to_numpy())
    out = np.full((len(column), SKETCH), VOID, np.uint64)
    out[np.arange(SKETCH) < sizes[:, None]] = column.flatten().to_numpy().view(np.uint64)
    return out


def estimates(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of common values among the k smallest of both sketches together."""
    both = np.sort(np.concatenate([a, b], axis=1), axis=1)
    valid = both[:, :-1] != VOID
    twice = (both[:, 1:] == both[:, :-1]) & valid
    first = np.ones(both.shape, bool)
    first[:, 1:] = ~(both[:, 1:] == both[:, :-1])
    first &= both != VOID
    rank = np.cumsum(first, axis=1)
    common = (twice & (rank[:, :-1] <= SKETCH)).sum(axis=1)
    total = np.minimum(rank[:, -1], SKETCH)
    return common / np.maximum(total, 1)


def _estimated(least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 2000):
                part = batch.slice(i, 2000)
                good = estimates(_matrix(part.column(2)), _matrix(part.column(3))) >= least
                yield part.select(["a", "b"]).filter(pa.array(good))

    return run


def _compared(size: int):
    """Sizes of both full sets, common values, and what only the second set has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 200):
                part = batch.slice(i, 200)
                left, rows = {}, []
                for side in (2, 3):
                    for x, y, words in word_slices(part.column(side), lower=True):
                        keys, first = shingles(words, size)
                        for k in range(x, y):
                            own = keys[first[k - x] : first[k - x + 1]]
                            if side == 2:
                                left[k] = own
                            else:
                                only = np.setdiff1d(own, left[k], assume_unique=True)
                                rows.append((len(left[k]), len(own), len(own) - len(only), only.view(np.int64)))
                columns = [pa.array([r[k] for r in rows], pa.int64()) for k in range(3)]
                only = pa.array([r[3] for r in rows], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), *columns, only], ["a", "b", "n_a", "n_b", "common", "only"]
                )

    return run


def _near(a: Column, b: Column, percent: int) -> Column:
    """Sizes that allow the similarity."""
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row: id, n_shingles, component_id (the smallest id reachable over links), and
    kept, true for the row of that id."""
    plain = docs.select(docs[id_col].cast("bigint").alias("id"), docs[text_col].cast("string").alias("text"))
    hashed = plain.select("id", F.xxhash64("text").alias("text_hash"), "text")
    kind = "id bigint, text_hash bigint, n bigint, print binary, sketch array<bigint>"
    profile = stage(hashed.mapInArrow(_profile(shingle), kind), "profiles")
    classes = stage(
        profile.where("n > 0 AND id IS NOT NULL")
        .groupBy("print")
        .agg(F.min(F.struct("id", "text_hash", "n", "sketch")).alias("r"))
        .select(F.xxhash64("print").alias("node"), F.col("r.id").alias("rep"), "r.text_hash", "r.n", "r.sketch"),
        "classes",
    )

    postings = classes.select("node", "n", F.explode("sketch").alias("value"))
    counted = postings.groupBy("value").agg(F.count("*").alias("df")).where("df > 1")
    held = (
        postings.join(counted, "value")
        .groupBy("node", "n")
        .agg(F.array_sort(F.collect_list(F.struct("df", "value"))).alias("held"), F.sum("df").alias("weight"))
    )
    size = F.least("n", F.lit(SKETCH))
    exact = F.col("n") - F.floor((percent * F.col("n") + 99) / 100) + 1
    # A partner beyond a sketch retains SKETCH values, of which the set lacks most - n at most, so
    # that they share SKETCH - (most - n) retained ones at least.
    most = F.floor(100 * F.col("n") / percent)
    exact = F.greatest(exact, most - SKETCH + 1)
    prefix = F.when(F.col("n") <= SKETCH, exact).otherwise(SKETCH - OVERLAP + 1)
    room = (prefix - (size - F.size("held"))).cast("int")
    lists = stage(
        held.where(room > 0)
        .select(
            "node",
            "n",
            F.struct(F.size("held").alias("shared"), "weight", "node").alias("rank"),
            F.explode(F.slice("held", 1, room)).alias("h"),
        )
        .select("node", "n", "rank", F.col("h.value").alias("value")),
        "lists",
    )
    nodes = lists.select("node").distinct()
    texts = stage(
        hashed.join(
            classes.join(nodes, "node", "left_semi").select("node", F.col("rep").alias("id"), "text_hash"),
            ["id", "text_hash"],
        )
        .groupBy("node")
        .agg(F.min("text").alias("text")),
        "texts",
    )
    sketches = classes.select("node", "sketch")

    def estimated(pairs: DataFrame) -> DataFrame:
        """Pairs whose sketches say that they may be similar."""
        near = pairs.join(sketches.select(F.col("node").alias("a"), F.col("sketch").alias("x")), "a")
        near = near.join(sketches.select(F.col("node").alias("b"), F.col("sketch").alias("y")), "b")
        likely = near.select("a", "b", "x", "y").mapInArrow(
            _estimated(LEAST_ESTIMATE / 100), "a bigint, b bigint"
        )
        return stage(likely, "likely")

    def compare(pairs: DataFrame) -> DataFrame:
        """Both full sets of each pair."""
        full = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("x")), "a")
        full = full.join(texts.select(F.col("node").alias("b"), F.col("text").alias("y")), "b")
        kind = "a bigint, b bigint, n_a bigint, n_b bigint, common bigint, only array<bigint>"
        return full.select("a", "b", "x", "y").mapInArrow(_compared(shingle), kind)

    linked = 100 * F.col("common") >= percent * (F.col("n_a") + F.col("n_b") - F.col("common"))

    middle = lists.groupBy("value").agg(F.max(F.struct("rank", "n")).alias("m"), F.count("*").alias("c")).where("c > 1")
    middle = middle.select("value", F.col("m.rank.node").alias("a"), F.col("m.n").alias("n_a"))
    star = (
        lists.join(middle, "value")
        .where(F.col("node") != F.col("a"))
        .where(_near(F.col("n"), F.col("n_a"), percent))
        .select("a", F.col("node").alias("b"))
        .distinct()
    )
    tested = stage(star, "star")
    compared = stage(compare(tested), "compared")
    first = compared.where(linked).select("a", "b")
    groups = components(first)
    rest = _crossing(lists, middle, compared, groups, percent)
    seen = tested.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    rest = stage(rest.join(seen, ["a", "b"], "left_anti"), "crossing")
    second = compare(estimated(rest)).where(linked).select("a", "b")
    second = stage(second, "links")

    found = components(first.union(second))
    by_node = classes.select("node", "rep").join(
        found.withColumnRenamed("component", "group"), "node", "left"
    )
    by_node = by_node.select("node", "rep", F.coalesce("group", "node").alias("group"))
    least = by_node.groupBy("group").agg(F.min("rep").alias("component_id"))
    answer = by_node.join(least, "group").select("node", "component_id")
    rows = profile.select("id", "n", F.when(F.col("n") > 0, F.xxhash64("print")).alias("node"))
    rows = rows.join(answer, "node", "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id"))
    return rows.select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )



def _crossing(
    lists: DataFrame, middle: DataFrame, compared: DataFrame, groups: DataFrame, percent: int
) -> DataFrame:
    """Pairs of members of different components that may be similar and were not compared.

    Members x and y of a list that were both compared with its middle c, x without a link to
    it, are similar only if they have values in common that c lacks, or if all they need of each
    other lies in c. The first are met over the values that c lacks, but only over their rarest
    ones: how many they must share beside c follows from their sizes and what they have of c
    (prefix filter, exact). For the second, both must have so much in common with c as they
    need of each other. Only members that were
    not compared with c, as their sizes forbid a link to it, are paired over the
    list itself. So edited copies of one text, each too far from the others, make no pairs.
    """
    placed = lists.join(groups, "node", "left").select(
        "value", "node", "n", F.coalesce("component", "node").alias("component")
    )
    split = placed.groupBy("value").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi")
    mixed = placed.join(split.select("value"), "value", "left_semi").join(middle.select("value", "a"), "value")
    with_middle = compared.select("a", F.col("b").alias("node"), F.lit(True).alias("hit"))
    mixed = mixed.join(with_middle, ["a", "node"], "left").select(
        "value", "node", "n", "component", (F.col("hit").isNotNull() | (F.col("a") == F.col("node"))).alias("known")
    )
    members = compared.join(groups.withColumnRenamed("node", "b"), "b", "left").select(
        F.col("a").alias("middle"),
        F.col("b").alias("node"),
        F.col("n_b").alias("n"),
        F.coalesce("component", "b").alias("component"),
        "common",
        "only",
    )

    def pairs(rows: DataFrame, keys: list[str], extra: Column) -> DataFrame:
        x = rows.select(*keys, *(F.col(c).alias(f"x_{c}") for c in rows.columns if c not in keys))
        y = rows.select(*keys, *(F.col(c).alias(f"y_{c}") for c in rows.columns if c not in keys))
        both = x.join(y, keys).where(extra & (F.col("x_component") != F.col("y_component")))
        both = both.where(_near(F.col("x_n"), F.col("y_n"), percent))
        return both.select(F.least("x_node", "y_node").alias("a"), F.greatest("x_node", "y_node").alias("b"))

    once = F.col("x_node") < F.col("y_node")
    unknown = pairs(mixed, ["value"], once & ~(F.col("x_known") & F.col("y_known")))
    need = percent * (F.col("x_n") + F.col("y_n"))
    most = F.least("x_common", "y_common")
    lacking = members.select("middle", "node", "n", "component", "common", F.explode("only").alias("value"))
    shared = lacking.groupBy("middle", "value").agg(
        F.count("*").alias("df"), F.min("component").alias("lo"), F.max("component").alias("hi")
    )
    shared = shared.where("lo <> hi").select("middle", "value", "df")
    # With its values in order of rarity, `left` says how many a member has from this one on. The
    # first value that two members share must leave each as many as they need beside the middle.
    rarest_last = Window.partitionBy("middle", "node").orderBy(F.desc("df"), F.desc("value"))
    beside = lacking.join(shared, ["middle", "value"]).withColumn("left", F.row_number().over(rarest_last))
    beside = stage(beside.where(percent * F.col("n") <= 100 * (F.col("common") + F.col("left"))).drop("df"), "beside")
    enough = (need <= (100 + percent) * (most + F.least("x_left", "y_left"))) & (need > (100 + percent) * most)
    outside = pairs(beside, ["middle", "value"], once & enough)
    order = (F.col("x_n") < F.col("y_n")) | ((F.col("x_n") == F.col("y_n")) & once)
    inside = pairs(members.drop("only"), ["middle"], order & (need <= (100 + percent) * most))
    return unknown.union(outside).union(inside).distinct()
